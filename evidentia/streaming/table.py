"""A keyed capture table on plain Parquet: append-only deltas, merge on read, and compaction of the buckets that need it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ROW = "url string, first_fetched_at timestamp, last_fetched_at timestamp, content_sha string, last_id long"
_MANIFEST = "level int, bucket int, generation long, through long, rows long, folder int"
#: Small buckets share a folder: a generation has at most FOLDERS of them, and more only if those held more than FOLDER_ROWS rows each.
FOLDERS, FOLDER_ROWS = 64, 1 << 18


@dataclass
class CaptureTable:
    """The newest capture of every url, under one shared folder.

    * `delta/batch=N`: the fold of micro-batch N, written over if the batch runs twice;
    * `base/level=L/generation=G/bucket=B`: compacted rows of bucket B, and of those after it that share its folder; a url's bucket is its hash modulo 2^L;
    * `manifest/commit=C`: (level, bucket, generation, through, rows, folder), which generation of a bucket counts and up to which batch its
      deltas are inside it. A commit is one small file written last, so files of a failed compaction are never read.

    A bucket is compacted when its deltas exceed `share` of its base rows; when the buckets hold more than `bucket_rows`
    rows on average, the next compaction rewrites the whole table once with twice as many buckets. All other writes are as large as what arrived.
    """

    spark: SparkSession
    path: str
    share: float = 0.25
    bucket_rows: int = 1 << 20
    first_level: int = 2

    def _exists(self, name: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def _read(self, name: str, schema: str) -> DataFrame:
        if not self._exists(name):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/{name}").parquet(f"{self.path}/{name}")

    def manifest(self) -> tuple[int, DataFrame]:
        """The newest level, and (bucket, generation, through, rows, folder) of its buckets; none before the first compaction.

        A level has a bucket for every `bucket_rows` rows, so the driver may hold its list.
        """
        rows = self._read("manifest", _MANIFEST + ", commit long")
        newest = F.struct("generation", "through", "rows", F.coalesce("folder", "bucket").alias("folder"))
        known = rows.groupBy("level", "bucket").agg(F.max_by(newest, "commit").alias("m")).select("level", "bucket", "m.*").collect()
        level = max((r["level"] for r in known), default=self.first_level)
        return level, self.spark.createDataFrame([r[1:] for r in known if r["level"] == level], "bucket int, generation long, through long, rows long, folder int")

    def _bucket(self, level: int):
        return F.pmod(F.xxhash64("url"), F.lit(1 << level)).cast("int")

    def _pending(self, level: int, held: DataFrame) -> DataFrame:
        """Delta rows that no compaction holds yet, with their bucket."""
        rows = self._read("delta", _ROW + ", batch long").withColumn("bucket", self._bucket(level))
        return rows.join(F.broadcast(held.select("bucket", "through")), "bucket", "left").where(F.col("through").isNull() | (F.col("batch") > F.col("through"))).drop("through")

    @staticmethod
    def _span(level: int, rows: int) -> int:
        """How many buckets one folder holds."""
        folders = FOLDERS
        while folders * FOLDER_ROWS < rows:
            folders *= 2
        return max(1, (1 << level) // folders)

    def _base(self, level: int, held: DataFrame) -> DataFrame:
        """Rows of the buckets' own generations; only folders that a bucket uses are read."""
        used = sorted({(r["generation"], r["folder"]) for r in held.where("rows > 0").select("generation", "folder").collect()})
        schema = _ROW + ", level int, generation long, bucket int"
        if not used:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.path}/base/level={level}/generation={g}/bucket={b}" for g, b in used]
        rows = self.spark.read.schema(schema).option("basePath", f"{self.path}/base").parquet(*paths).withColumn("bucket", self._bucket(level))
        return rows.join(F.broadcast(held.select("generation", "bucket")), ["generation", "bucket"])

    @staticmethod
    def folded(rows: DataFrame, *keys: str) -> DataFrame:
        """One row per url: the first time stays, the newest capture wins, ties by id; folding twice changes nothing."""
        newest = F.struct("last_fetched_at", "last_id")
        return rows.groupBy(*keys, "url").agg(
            F.min("first_fetched_at").alias("first_fetched_at"), F.max("last_fetched_at").alias("last_fetched_at"), F.max_by("content_sha", newest).alias("content_sha"), F.max_by("last_id", newest).alias("last_id")
        )

    def read(self) -> DataFrame:
        """(url, first_fetched_at, last_fetched_at, content_sha, last_id): base and pending deltas merged."""
        return self.folded(self._merged(*self.manifest()))

    def _merged(self, level: int, held: DataFrame) -> DataFrame:
        columns = [c.split(" ")[0] for c in _ROW.split(", ")]
        return self._base(level, held).select(columns).unionByName(self._pending(level, held).select(columns))

    def append(self, fetches: DataFrame, batch: int) -> None:
        """Write a micro-batch's fold as delta number `batch`. Rows without a url are no captures."""
        rows = fetches.where("url is not null").select("url", F.col("fetched_at").alias("first_fetched_at"), F.col("fetched_at").alias("last_fetched_at"), "content_sha", F.col("id").alias("last_id"))
        self.folded(rows).write.mode("overwrite").parquet(f"{self.path}/delta/batch={batch}")

    def compact(self, batch: int) -> list[int]:
        """Compact what is due after `batch`, and return the buckets that were rewritten; those of a new level are all its own."""
        level, manifest = self.manifest()
        waiting = {r["bucket"]: r["n"] for r in self._pending(level, manifest).groupBy("bucket").agg(F.count("*").alias("n")).collect()}
        rows_of = {r["bucket"]: r["rows"] for r in manifest.collect()}
        held = sum(rows_of.values())
        due = sorted(b for b, n in waiting.items() if n > self.share * rows_of.get(b, 0))
        grown = held > self.bucket_rows << level
        if not due and not grown:
            return []
        rows = self._merged(level, manifest)
        if grown:
            level += 1
            while held > self.bucket_rows << level:
                level += 1
            rows, due = rows.withColumn("bucket", self._bucket(level)), list(range(1 << level))
        else:
            rows = rows.withColumn("bucket", self._bucket(level))
        named = self.spark.createDataFrame([(b,) for b in due], "bucket int")
        if len(due) < 1 << level:
            rows = rows.join(F.broadcast(named), "bucket", "left_semi")
        span = F.lit(self._span(level, held + sum(waiting.values())))
        folder = f"{self.path}/base/level={level}/generation={batch}"
        shared = self.folded(rows, "bucket").withColumn("bucket", (F.col("bucket") - F.col("bucket") % span).cast("int"))
        shared.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(folder)
        written = self.spark.read.schema(_ROW + ", bucket int").parquet(folder).groupBy(self._bucket(level).alias("bucket")).agg(F.count("*").alias("rows"), F.first("bucket").alias("folder"))
        named = named.join(written, "bucket", "left").withColumn("folder", F.coalesce("folder", "bucket"))
        commit = named.select(F.lit(level).alias("level"), "bucket", F.lit(batch).cast("long").alias("generation"), F.lit(batch).cast("long").alias("through"), F.coalesce("rows", F.lit(0)).cast("long").alias("rows"), "folder")
        commit.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/commit={batch}")
        return due

    def vacuum(self) -> int:
        """Delete deltas that every bucket's base holds, and generations that no bucket uses; call it while nothing reads. Returns how many folders went."""
        fs = self.spark._jvm.org.apache.hadoop.fs.Path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())
        level, manifest = self.manifest()
        kept = manifest.collect()
        used = {(r["generation"], r["folder"]) for r in kept}
        through = min(r["through"] for r in kept) if kept and len(kept) == 1 << level else -1
        gone = []
        for status in fs.globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/delta/batch=*")):
            if int(status.getPath().getName().split("=")[1]) <= through:
                gone.append(status.getPath())
        for status in fs.globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/base/level=*/generation=*/bucket=*")):
            names = [int(p.split("=")[1]) for p in status.getPath().toString().split("/")[-3:]]
            if names[0] != level or (names[1], names[2]) not in used:
                gone.append(status.getPath())
        return sum(bool(fs.delete(p, True)) for p in gone)


def stream_into(source: DataFrame, table: CaptureTable, checkpoint: str):
    """Stream a fetch log (id, url, fetched_at, content_sha) into the table until the input is used up.

    A late fetch loses to a newer one wherever that stands, and a batch that runs again writes its own delta over.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        table.append(batch, batch_id)
        table.compact(batch_id)

    return source.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
