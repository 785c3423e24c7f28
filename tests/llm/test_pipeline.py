"""The pipeline's stages take effect, and its result is whole."""

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from evidentia.llm import lines


def test_pipeline(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    now, columns = docs, docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, sf).cache()
        assert now.columns == columns, name
        assert now.schema == docs.schema or [f.dataType for f in now.schema] == [f.dataType for f in docs.schema]
    assert 0 < now.count() <= docs.count()
    kept = Counter(t for r in now.select("text").collect() for t in r.text.split("\n") if any(c.isalpha() for c in t))
    assert max(kept.values()) == 1
    pieces = corpus_pipeline.STAGES[-1][1](spark, now, sf)
    assert {r[0] for r in pieces.select("doc_id").distinct().collect()} == {r[0] for r in now.select("doc_id").collect()}
    assert pieces.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0


SAME = "the quick brown fox jumps over the lazy dog and runs into the deep dark wood at night"


def odd_documents(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and columns whose names the operators use inside."""
    rows = [
        (1, f"{SAME}\nthe first of all lines", "en", "a", 5, 1.0),
        (2, f"{SAME} long\nanother line that stands alone here", None, None, None, None),
        (2, f"{SAME} long\nanother line that stands alone here", None, None, None, None),
        (3, None, "en", "a", None, 2.0),
        (4, "", "en", "a", 0, 3.0),
        (5, "12 ½ ---", "en", "a", 8, 4.0),
        (None, "a text without a key that nobody else has at all", "en", None, 3, None),
        (6, "word of the " * 20_000, "en", "b", 240_000, 5.0),
        (7, "the first of all lines", "en", "b", 22, 6.0),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, bucket double")


def test_stages_on_odd_rows(spark, sf):
    docs = odd_documents(spark)
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["language"](spark, docs, sf)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "2", "6", "7", "None"]  # null, empty and letterless texts go
    lines = stages["line_dedup"](spark, docs, sf)
    assert lines.columns == docs.columns and lines.count() == docs.count()
    texts = {(r.doc_id, r.n_chars): r.text for r in lines.collect() if r.doc_id != 2}
    assert texts[3, None] is None and texts[4, 0] == "" and texts[5, 8] == "12 ½ ---" and texts[7, 0] == ""
    assert texts[1, len(f"{SAME}\nthe first of all lines")] == f"{SAME}\nthe first of all lines"
    twos = sorted(r.text for r in lines.where("doc_id = 2").collect())
    assert twos == ["", "another line that stands alone here"]  # the near line went, and the repeated row lost all
    near = stages["near_dedup"](spark, docs, sf)
    assert near.columns == docs.columns
    assert sorted(str(r.doc_id) for r in near.collect()) == ["1", "2", "2", "3", "5", "6", "7", "None"]  # null and empty are one group
    packed = stages["packing"](spark, docs, sf)
    assert packed.select("doc_id").distinct().count() == 8
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, docs.limit(0), sf)
        assert empty.count() == 0
        assert name == "packing" or empty.columns == docs.columns


def test_line_stage_loses_no_pair(spark, sf, monkeypatch):
    """Forty lines around one short passage, in one block: each copy with a letter of every other word changed goes, though they share no other word pair."""
    monkeypatch.setattr(lines, "_crossed", lambda sketch: F.array(F.lit(1).cast("long")))
    rng = np.random.default_rng(31)
    words = lambda n: ["".join(chr(97 + int(c)) for c in rng.integers(0, 26, int(rng.integers(3, 10)))) for _ in range(n)]
    passage, rows = words(10), []
    for k in range(20):
        line = [*words(25), *passage, *words(25)]
        rows += [(2 * k, " ".join(line)), (2 * k + 1, " ".join(w if 25 <= i < 35 or i % 2 else "é" + w[1:] for i, w in enumerate(line)))]
    left = corpus_pipeline.drop_repeated_lines(spark, spark.createDataFrame(rows, "doc_id long, text string"), sf).collect()
    assert {r.doc_id: r.text for r in left} == {k: "" if k % 2 else t for k, t in rows}
