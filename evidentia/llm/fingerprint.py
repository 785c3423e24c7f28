"""Operator 8: canonical exact fingerprints, in DataFrame functions alone."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Repeated fingerprints that may be broadcast to prune the text scan (16 bytes each); beyond it the scan is joined by shuffle.
BROADCAST_PRINTS = 500_000


def canonical(text: Column) -> Column:
    """Compatibility composition (NFKC), full case folding, white space runs to one blank, trimmed."""
    composed = F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), text, F.lit(True))
    folded = F.reflect(F.lit("com.ibm.icu.lang.UCharacter"), F.lit("foldCase"), composed, F.lit(True))
    return F.trim(F.regexp_replace(folded, r"(?U)\s+", " "))


def _halves(canon: Column) -> list[Column]:
    return [F.xxhash64(canon).alias("f1"), F.xxhash64(F.lit("second half"), canon).alias("f2")]


def _shown(f1: Column, f2: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(f1), 16, "0"), F.lpad(F.hex(f2), 16, "0")))


def printed(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add canon, f1 and f2. Null text counts as empty."""
    return docs.withColumn("canon", canonical(F.coalesce(F.col(text), F.lit("")))).select("*", *_halves(F.col("canon")))


def collisions(docs: DataFrame, text: str = "text") -> DataFrame:
    """(f1, f2) of buckets whose members differ in bytes: expected empty, but compared all the same.

    Only texts of buckets with several members are compared; each bucket keeps its least and greatest canonical
    text while it is combined, so a bucket of any size needs no more than two texts anywhere.
    """
    prints = printed(docs.select(F.col(text).alias("text")), "text")
    repeated = prints.groupBy("f1", "f2").agg(F.count("*").alias("n")).where("n > 1").select("f1", "f2")
    few = repeated.limit(BROADCAST_PRINTS + 1).count() <= BROADCAST_PRINTS
    again = prints.join(F.broadcast(repeated) if few else repeated, ["f1", "f2"], "left_semi")
    return again.groupBy("f1", "f2").agg(F.min("canon").alias("least"), F.max("canon").alias("greatest")).where("least <> greatest").select("f1", "f2")


def with_next(docs: DataFrame, key: str, order: list[Column], columns: list[str]) -> DataFrame:
    """Add next_<column> from the following row by descending key; after the last row comes the first.

    Rows are dealt into ranges of keys cut at quantiles, and the first row of each range also visits the range
    before it, so one shuffle and one window per range give every row its neighbour, and no task sees
    all rows.
    """
    spark = docs.sparkSession
    parts = max(1, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    fractions = [k / parts for k in range(parts + 1)]
    found = docs.agg(F.percentile_approx(key, F.array(*map(F.lit, fractions)), max(10_000, 10 * parts)).alias("q"), F.max(key).alias("top")).first()
    heads = sorted({*(found["q"] or []), *([found["top"]] if found["top"] is not None else [])}, reverse=True)
    if not heads:
        bucket, visited = F.lit(0), F.lit(0)
    else:
        size = max(1, math.isqrt(len(heads)))
        groups = [heads[k : k + size] for k in range(0, len(heads), size)]
        lists = F.array(*(F.array(*map(F.lit, g)) for g in groups))
        firsts = F.array(*(F.lit(g[0]) for g in groups))
        group = F.size(F.filter(firsts, lambda h: h >= F.col(key)))
        within = F.size(F.filter(F.element_at(lists, group), lambda h: h >= F.col(key)))
        bucket = F.when(F.col(key).isNull(), len(heads) - 1).otherwise((group - 1) * size + within - 1)
        is_head = F.array_contains(F.element_at(lists, F.col("group")), F.col(key))
        visited = F.when(is_head, F.pmod(F.col("bucket") - 1, F.lit(len(heads))))
        docs = docs.withColumn("group", F.when(F.col(key).isNull(), F.lit(1)).otherwise(group))
    dealt = docs.withColumn("bucket", bucket).withColumn("visited", visited).drop("group")
    places = F.array(F.struct(F.col("bucket").alias("at"), F.lit(False).alias("guest")), F.struct(F.col("visited").alias("at"), F.lit(True).alias("guest")))
    dealt = dealt.withColumn("place", F.explode(F.filter(places, lambda p: p["at"].isNotNull()))).select("*", F.col("place.at").alias("at"), F.col("place.guest").alias("guest")).drop("place", "bucket", "visited")
    after = Window.partitionBy("at").orderBy("guest", *order)
    return dealt.select("*", *(F.lead(c).over(after).alias(f"next_{c}") for c in columns)).where("not guest").drop("at", "guest")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, one row per input row.

    (key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next). The edited text ends in
    the next document's beginning, in descending key order, rows of one key by their text and null keys
    last. A fingerprint is 128 bits of xxhash over the canonical text; where a bucket holds different
    canonical texts, their SHA-256 is appended. Likeness is 1 if fingerprint and canonical bytes are
    equal, else 0. Null text is empty; repeated rows keep their rows; other columns are not read; an
    empty table gives an empty result.
    """
    plain = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    prints = printed(plain).drop("canon")
    near = with_next(prints, "key", [F.col("key").desc_nulls_last(), F.col("text")], ["text", "f1", "f2"])
    half = (F.length("text") / 2).cast("int")
    edited = F.concat(F.col("text").substr(F.lit(1), F.length("text") - half), F.col("next_text").substr(F.lit(1), half))
    rows = near.withColumn("edited", edited).withColumn("e_canon", canonical(F.col("edited")))
    rows = rows.select("*", *(h.alias(f"e{k}") for k, h in enumerate(_halves(F.col("e_canon")), 1)))

    def like(a: str, b: str, same: Column) -> Column:
        return F.when((F.col("f1") == F.col(a)) & (F.col("f2") == F.col(b)), same.cast("double")).otherwise(0.0)

    rows = rows.select(
        "key", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "text", "e_canon", "f1", "f2", "e1", "e2",
        like("e1", "e2", canonical(F.col("text")) == F.col("e_canon")).alias("near_edited"),
        like("next_f1", "next_f2", canonical(F.col("text")) == canonical(F.col("next_text"))).alias("near_next"),
    )
    mine, theirs = _shown(F.col("f1"), F.col("f2")), _shown(F.col("e1"), F.col("e2"))
    odd = collisions(plain)
    if not odd.isEmpty():
        for a, b, name in (("f1", "f2", "odd"), ("e1", "e2", "e_odd")):
            flagged = odd.select(F.col("f1").alias("o1"), F.col("f2").alias("o2"), F.lit(True).alias(name))
            rows = rows.join(flagged, (F.col(a) == F.col("o1")) & (F.col(b) == F.col("o2")), "left").drop("o1", "o2")
        rows = rows.withColumn("canon", canonical(F.col("text")))
        mine = F.concat(mine, F.when(F.col("odd"), F.concat(F.lit("-"), F.sha2("canon", 256))).otherwise(""))
        theirs = F.concat(theirs, F.when(F.col("e_odd"), F.concat(F.lit("-"), F.sha2("e_canon", 256))).otherwise(""))
    return rows.select(F.col("key").alias(key), "n_chars", "edited_sha256", mine.alias("fingerprint"), theirs.alias("edited_fingerprint"), "near_edited", "near_next")
