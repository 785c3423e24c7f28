"""Folding a log of fetches into current pages, in batch and as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Fixed value: days a capture stays fresh.
FRESH_DAYS = 30


def fold(fetches: DataFrame, url: str = "url", at: str = "fetched_at", sha: str = "content_sha", tie: str = "id") -> DataFrame:
    """(url, first_fetched_at, last_fetched_at, content_sha, n_fetches): the newest fetch wins, the first date stays.

    Plain aggregates with a map side, so a url with very many fetches is combined before the shuffle.
    """
    newest = F.max_by(sha, F.struct(at, tie))
    return fetches.where(F.col(url).isNotNull()).groupBy(url).agg(F.min(at).alias("first_fetched_at"), F.max(at).alias("last_fetched_at"), newest.alias("content_sha"), F.count("*").alias("n_fetches"))


def change_flags(fetches: DataFrame, url: str = "url", at: str = "fetched_at", sha: str = "content_sha", tie: str = "id") -> DataFrame:
    """Adds state: `new` at first sight, else `changed` or `unchanged` against the fetch before."""
    before = F.lag(sha).over(Window.partitionBy(url).orderBy(at, tie))
    first = F.row_number().over(Window.partitionBy(url).orderBy(at, tie)) == 1
    return fetches.withColumn("state", F.when(first, "new").when(before.eqNullSafe(F.col(sha)), "unchanged").otherwise("changed"))


def kept_ocr(fetches: DataFrame, url: str = "url", at: str = "fetched_at", sha: str = "content_sha", ocr: str = "ocr_text", tie: str = "id") -> DataFrame:
    """(url, ocr_text): the last OCR text of the newest run of equal bytes; new bytes without one have none."""
    w = Window.partitionBy(url).orderBy(at, tie)
    fresh = (~F.lag(sha).over(w).eqNullSafe(F.col(sha)) | (F.row_number().over(w) == 1)).cast("int")
    runs = fetches.withColumn("_f", fresh).withColumn("_run", F.sum("_f").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    per_run = runs.groupBy(url, "_run").agg(F.max_by(ocr, F.when(F.col(ocr).isNotNull(), F.struct(at, tie))).alias(ocr))
    return per_run.groupBy(url).agg(F.max_by(ocr, "_run").alias(ocr))


def newest_alias(pages: DataFrame, requested: Column, url: str = "url", at: str = "last_fetched_at") -> DataFrame:
    """(alias_url, url): where a requested address led last, ties to the smaller address."""
    rows = pages.select(requested.alias("alias_url"), F.col(url).alias("_url"), F.col(at).alias("_at")).where(F.col("alias_url").isNotNull())
    w = Window.partitionBy("alias_url").orderBy(F.col("_at").desc_nulls_last(), "_url")
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").select("alias_url", F.col("_url").alias("url"))


def holdings(requested: DataFrame, wanted: Column, pages: DataFrame, aliases: DataFrame) -> DataFrame:
    """Adds outcome (`cached`, `redirected`, `missing`, `invalid`) and the stored url of every requested address."""
    rows = requested.withColumn("_wanted", wanted)
    held = pages.select(F.col("url").alias("_held")).distinct()
    led = aliases.select(F.col("alias_url").alias("_alias"), F.col("url").alias("_led"))
    joined = rows.join(held, F.col("_wanted") == F.col("_held"), "left").join(led, F.col("_wanted") == F.col("_alias"), "left")
    outcome = F.when(F.col("_wanted").isNull(), "invalid").when(F.col("_held").isNotNull(), "cached").when(F.col("_led").isNotNull(), "redirected").otherwise("missing")
    return joined.withColumn("outcome", outcome).withColumn("stored_url", F.coalesce("_held", "_led")).drop("_wanted", "_held", "_alias", "_led")


def freshness(pages: DataFrame, now: Column, at: str = "last_fetched_at", days: int = FRESH_DAYS) -> DataFrame:
    return pages.withColumn("plan", F.when(F.datediff(now, F.col(at)) <= days, "skip").otherwise("fetch"))


def newest_ok(fetches: DataFrame, ok: Column, url: str = "url", at: str = "fetched_at", tie: str = "id") -> DataFrame:
    """(url, fetched_at, id) of the newest good fetch; filtered first, collapsed after."""
    good = fetches.where(ok)
    return good.groupBy(url).agg(F.max(at).alias(at), F.max_by(tie, F.struct(at, tie)).alias(tie))


def resolved_text(changed: Column, source: Column, unavailable: Column, stored: Column, new: Column) -> Column:
    """Unchanged bytes keep a manual transcription, and stored text while the extractor is unavailable; else the new text."""
    keep = ~changed & ((source == "manual") | unavailable)
    return F.when(keep, stored).otherwise(new)


def is_thin(body: Column, ocr: Column, text: Column, least: int = 200) -> Column:
    return F.length(F.trim(F.coalesce(body, ocr, text, F.lit("")))) < least


def is_newer_capture(captured_at: Column, held_at: Column) -> Column:
    return held_at.isNull() | (captured_at > held_at)


def stream_fold(source: DataFrame, target: str, checkpoint: str, buckets: int = 16):
    """Fold a streaming fetch log into `target`, a Parquet table partitioned by url bucket; runs until the input is used up.

    Each micro-batch folds itself, merges with the stored rows of the buckets it touches and rewrites those alone.
    Late fetches lose to newer stored rows, and a batch that runs twice changes nothing. State lives in the
    table, so a lost executor costs a retried task.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark: SparkSession = batch.sparkSession
        fresh = batch.withColumn("bucket", F.pmod(F.xxhash64("url"), F.lit(buckets)).cast("int")).select("bucket", "url", F.col("fetched_at").alias("first_fetched_at"), F.col("fetched_at").alias("last_fetched_at"), "content_sha", F.col("id").alias("last_id"))
        path = spark._jvm.org.apache.hadoop.fs.Path(target)
        exists = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
        rows = fresh
        if exists:
            touched = fresh.select("bucket").distinct()
            rows = fresh.unionByName(spark.read.parquet(target).join(F.broadcast(touched), "bucket", "left_semi").select(fresh.columns))
        newest = F.struct("last_fetched_at", "last_id")
        folded = rows.groupBy("bucket", "url").agg(F.min("first_fetched_at").alias("first_fetched_at"), F.max("last_fetched_at").alias("last_fetched_at"), F.max_by("content_sha", newest).alias("content_sha"), F.max_by("last_id", newest).alias("last_id"))
        from evidentia.session import stored

        done = stored(folded, "fold")  # the target is read and rewritten, so the new rows must stand elsewhere first
        done.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(target)

    return source.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def hourly_freshness(source: DataFrame, at: str = "fetched_at", late: str = "1 day") -> DataFrame:
    """Fetches per hour with a watermark, for a stream or a table."""
    return source.withWatermark(at, late).groupBy(F.window(at, "1 hour").alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("hour"), "n")


def keyed_by_final(responses: DataFrame, final: Column, requested: Column) -> DataFrame:
    """Adds url, the final address normalised, which is the key; the requested one stays in raw_url."""
    return responses.withColumns({"url": F.coalesce(final, requested), "raw_url": requested})


def append_fetches(rows: DataFrame, path: str) -> None:
    """Append fetches, failed ones too, to a Parquet log; imports carry no status."""
    imported = F.coalesce(F.col("imported"), F.lit(False))
    rows.withColumn("http_status", F.when(~imported, F.col("http_status"))).write.mode("append").parquet(path)


def missing_blobs(pages: DataFrame, blobs: DataFrame, sha: str = "content_sha") -> DataFrame:
    """Pages whose content no blob holds."""
    return pages.where(F.col(sha).isNotNull()).join(blobs.select(sha).distinct(), sha, "left_anti")


def chosen_track(tracks: DataFrame, key: str, original: str) -> DataFrame:
    """One caption track per video: manual before automatic.

    Manual tracks prefer English; automatic ones the original language as `<lang>-orig`, the language itself, English,
    then the rest. Ties go by code.
    """
    english = F.col("language").startswith("en")
    manual = F.when(english, 0).otherwise(1)
    automatic = F.when(F.col("language") == F.concat(F.col(original), F.lit("-orig")), 0).when(F.col("language") == F.col(original), 1).when(english, 2).otherwise(3)
    order = Window.partitionBy(key).orderBy(F.when(F.col("manual"), 0).otherwise(1), F.when(F.col("manual"), manual).otherwise(automatic), "language")
    return tracks.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")
