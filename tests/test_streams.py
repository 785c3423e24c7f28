"""The capture table's deltas and compactions, and keyed change events with late, repeated and idle urls."""

import datetime as dt
import os

from pyspark.sql import functions as F

from evidentia.plans import streams
from evidentia.streaming import captures, changes
from evidentia.streaming.table import CaptureTable, stream_into

LOG = "id long, url string, fetched_at timestamp, content_sha string"


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def files_of(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def shown(rows):
    return sorted((r.url, r.first_fetched_at, r.last_fetched_at, r.content_sha) for r in rows.collect())


def test_only_due_buckets_are_rewritten(spark, tmp_path):
    table = CaptureTable(spark, str(tmp_path / "t"), share=0.5, bucket_rows=1000, first_level=2)
    log = [(i, f"u{i % 40}", at(1, i % 24), f"s{i % 3}") for i in range(120)]
    table.append(spark.createDataFrame(log, LOG), 0)
    assert table.compact(0) == [0, 1, 2, 3]
    before = files_of(f"{tmp_path}/t/base")
    one = [r for r in spark.range(40).select(F.concat(F.lit("u"), "id").alias("url")).withColumn("b", table._bucket(2)).collect()]
    mine = [r.url for r in one if r.b == 2]
    more = [(1000 + i, u, at(3), "new") for i, u in enumerate(mine)] + [(2000, next(r.url for r in one if r.b == 1), at(1), "late"), (2001, None, at(9), "x")]
    table.append(spark.createDataFrame(more, LOG), 1)
    assert table.compact(1) == [2]  # the others' deltas are too small a share
    after = files_of(f"{tmp_path}/t/base")
    assert all(after[f] == m for f, m in before.items())
    assert {f.split("/bucket=")[1].split("/")[0] for f in set(after) - set(before)} == {"2"}
    table.append(spark.createDataFrame(more, LOG), 1)  # the batch runs again
    assert table.compact(1) == []
    whole = shown(captures.fold(spark.createDataFrame(log + more, LOG)))
    assert shown(table.read()) == whole
    assert table.vacuum() == 2 and shown(table.read()) == whole  # delta 0 and the old generation of bucket 2
    assert table.compact(2) == []


def test_buckets_grow_with_the_table(spark, tmp_path):
    table = CaptureTable(spark, str(tmp_path / "t"), bucket_rows=10, first_level=0)
    log = [(i, f"u{i}", at(1 + i % 20), "s") for i in range(100)]
    spark.createDataFrame(log, LOG).repartition(2).write.parquet(f"{tmp_path}/log")
    stream_into(spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/log"), table, f"{tmp_path}/c").awaitTermination()
    level, manifest = table.manifest()
    table.append(spark.createDataFrame(log[:3], LOG), 7)
    table.compact(7)
    grown, after = table.manifest()
    assert grown > level >= 0 and after.count() == 1 << grown
    assert shown(table.read()) == shown(captures.fold(spark.createDataFrame(log, LOG)))
    assert CaptureTable(spark, str(tmp_path / "none")).read().count() == 0


def test_small_buckets_share_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("evidentia.streaming.table.FOLDERS", 4)
    table = CaptureTable(spark, str(tmp_path / "t"), bucket_rows=2, first_level=5)
    log = [(i, f"u{i % 200}", at(1 + i % 20), f"s{i % 3}") for i in range(400)]
    more = [(1000 + i, f"u{i}", at(25), "new") for i in range(0, 200, 9)]
    for batch, rows in enumerate((log, more, more[:3], more)):
        table.append(spark.createDataFrame(rows, LOG), batch)
        table.compact(batch)
        folders = [os.listdir(f.path) for level in os.scandir(tmp_path / "t/base") for f in os.scandir(level.path)]
        assert all(len([b for b in f if b.startswith("bucket=")]) <= 4 for f in folders)
        seen = log + more * (batch > 0)
        assert shown(table.read()) == shown(captures.fold(spark.createDataFrame(seen, LOG)))
    level, manifest = table.manifest()
    assert manifest.count() == 1 << level > 32
    assert table.vacuum() > 0 and shown(table.read()) == shown(captures.fold(spark.createDataFrame(seen, LOG)))


def test_a_delivery_is_as_many_files_as_it_needs(spark, sf, tmp_path, monkeypatch):
    one = shown(streams.stream_capture_table(spark, sf))
    events = sorted(map(tuple, streams.stream_change_events(spark, sf).collect()))
    monkeypatch.setattr(streams, "_FILE_ROWS", 100)
    streams._delivered(spark, sf, f"{tmp_path}/log")
    files = files_of(f"{tmp_path}/log")
    assert len(files) > 5 and len(files) % 5 == 0
    assert shown(streams.stream_capture_table(spark, sf)) == one
    assert sorted(map(tuple, streams.stream_change_events(spark, sf).collect())) == events
    streams._land(spark.createDataFrame([(1, "a", at(1), "x")], LOG), f"{tmp_path}/few", 3)
    assert len(files_of(f"{tmp_path}/few")) == 3


def test_change_events(spark, sf, tmp_path):
    """In order, streamed events are the batch's; late and repeated fetches give none; an idle url is forgotten."""
    parts = [
        [(1, "a", at(1), "x"), (2, "a", at(2), "x"), (3, "b", at(2), "y"), (9, None, at(2), "z")],
        [(4, "a", at(3), "w"), (1, "a", at(1), "x"), (5, "b", at(1), "late")],
        [(6, "c", at(20), "q")],  # the watermark passes
        [(7, "c", at(20, 1), "q")],  # timers of a and b fire here
        [(8, "a", at(20, 2), "w"), (10, "c", at(20, 3), "r")],
    ]
    for rows in parts:
        spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(f"{tmp_path}/log")
    source = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/log")
    changes.write_changes(source, f"{tmp_path}/out", f"{tmp_path}/check", "5 days", 3_600_000).awaitTermination()
    got = sorted((r.id, r.url, r.state) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == [(1, "a", "new"), (2, "a", "unchanged"), (3, "b", "new"), (4, "a", "changed"), (6, "c", "new"), (7, "c", "unchanged"), (8, "a", "new"), (10, "c", "changed")]


def test_registered_stream_forgets_idle_urls(spark, sf):
    got = streams.stream_change_events(spark, sf)
    assert got.where("state = 'new'").count() > got.select("url").distinct().count()
