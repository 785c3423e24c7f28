"""Streamed queries: the capture table with deltas, keyed change events, and fetches per hour with late ones."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.plans import table
from evidentia.plans.corpus import _FETCH
from evidentia.session import shared_dir
from evidentia.streaming import captures, changes
from evidentia.streaming.table import CaptureTable, stream_into

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


_LOG = "id long, url string, fetched_at timestamp, content_sha string"
#: Five deliveries by time; each seventeenth fetch comes one delivery late, each twenty-third is delivered twice, and a fifth of the urls rest for
#: three deliveries.
_DELIVERIES = f"""f as ({_FETCH}), s as (select id, url, fetched_at, content_sha, least(4, floor((epoch_us(fetched_at) - (select min(epoch_us(fetched_at)) from f)) / (6 * 86400000000)))::int as part from f
  where not (url[-1] in ('0', '5') and part between 1 and 3)),
d as (select id, url, fetched_at, content_sha, case when id % 17 = 0 then least(4, part + 1) else part end as batch from s union all select id, url, fetched_at, content_sha, least(4, part + 2) from s where id % 23 = 0)"""


#: Fetches that a file of a delivery holds, about.
_FILE_ROWS = 1 << 18


def _land(rows: DataFrame, folder: str, files: int) -> None:
    """Append exactly `files` files, empty ones at need, so that a trigger of so many files takes a delivery."""
    spark = rows.sparkSession
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/part-*")
    fs = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    before = len(fs.globStatus(pattern) or [])
    rows.repartition(files).write.mode("append").parquet(folder)
    while len(fs.globStatus(pattern)) < before + files:
        rows.limit(0).coalesce(1).write.mode("append").parquet(folder)


def _delivered(spark: SparkSession, sf: str, folder: str) -> DataFrame:
    """The fetch log as a stream of five deliveries, in order, each of as many files as the largest needs."""
    events = table(spark, sf, "events")
    log = events.select(F.col("event_id").alias("id"), F.concat(F.lit("https://h/"), "user_id").alias("url"), F.col("ts").cast("timestamp").alias("fetched_at"), F.md5("event_type").alias("content_sha"))
    start = log.agg(F.min("fetched_at").alias("start"))
    part = F.least(F.lit(4), F.floor((F.unix_micros("fetched_at") - F.unix_micros("start")) / (6 * 86_400_000_000))).cast("int")
    placed = log.crossJoin(F.broadcast(start)).withColumn("part", part).where(~(F.col("url").rlike("[05]$") & F.col("part").between(1, 3)))
    batch = F.when(F.col("id") % 17 == 0, F.least(F.lit(4), F.col("part") + 1)).otherwise(F.col("part"))
    again = placed.where("id % 23 = 0").withColumn("batch", F.least(F.lit(4), F.col("part") + 2))
    rows = placed.withColumn("batch", batch).unionByName(again).drop("start", "part")
    largest = rows.groupBy("batch").count().agg(F.max("count")).first()[0] or 0
    files = max(1, -(-largest // _FILE_ROWS))
    for n in range(5):  # one delivery after another, as files arrive
        _land(rows.where(F.col("batch") == n).drop("batch"), folder, files)
    return spark.readStream.schema(_LOG).option("maxFilesPerTrigger", files).parquet(folder)


@query(f"with {_DELIVERIES} select url, strftime(min(fetched_at), '%Y-%m-%d %H:%M:%S') as first_fetched_at, strftime(max(fetched_at), '%Y-%m-%d %H:%M:%S') as last_fetched_at, arg_max(content_sha, (fetched_at, id)) as content_sha from d group by url")
def stream_capture_table(spark, sf):
    """The fold of five deliveries with late and repeated fetches, through deltas and compactions."""
    base = f"{shared_dir(spark)}/captures-{uuid.uuid4().hex}"
    held = CaptureTable(spark, f"{base}/table", bucket_rows=32)
    stream_into(_delivered(spark, sf, f"{base}/log"), held, f"{base}/checkpoint").awaitTermination()
    shown = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return held.read().select("url", shown("first_fetched_at"), shown("last_fetched_at"), "content_sha")


#: Fetches may come nine days late; a url is forgotten two days after its last fetch, once the watermark has passed.
_LATE_DAYS, _IDLE_HOURS = 9, 48


@query(f"""with {_DELIVERIES},
u as (select distinct url, batch, fetched_at, id, content_sha from d),
b as (select batch, max(fetched_at) as newest from d group by batch),
w as (select x.batch, (select max(newest) from b where b.batch < x.batch) - interval {_LATE_DAYS} day as mark from (select unnest(range(6)) as batch) x),
v as (select u.*, (select max((p.fetched_at, p.id)) from u p where p.url = u.url and p.batch < u.batch) as seen from u),
l as (select *, lag(content_sha) over k as last_sha, lag(fetched_at) over k as last_at from v where seen is null or (fetched_at, id) > seen window k as (partition by url order by fetched_at, id)),
e as (select l.*, lag(batch) over (partition by url order by fetched_at, id) as last_batch from l)
select url, id, case when last_at is null or (last_batch < e.batch and exists (select 1 from w where w.batch = e.batch - 1 and w.mark >= last_at + interval {_IDLE_HOURS} hour)) then 'new' when last_sha = content_sha then 'unchanged' else 'changed' end as state from e""")
def stream_change_events(spark, sf):
    """Events of the same deliveries with keyed state: a late or repeated fetch gives none, an idle url is new again."""
    base = f"{shared_dir(spark)}/changes-{uuid.uuid4().hex}"
    source = _delivered(spark, sf, f"{base}/log")
    changes.write_changes(source, f"{base}/events", f"{base}/checkpoint", f"{_LATE_DAYS} days", _IDLE_HOURS * 3_600_000).awaitTermination()
    return spark.read.schema("url string, id long, state string").parquet(f"{base}/events")


@query(f"with {_DELIVERIES} select date_trunc('hour', fetched_at) as hour, count(*) as n from d group by 1")
def stream_hourly_fetches(spark, sf):
    """Deliveries per hour, streamed under a watermark that late fetches are within."""
    base = f"{shared_dir(spark)}/hours-{uuid.uuid4().hex}"
    counts = captures.hourly_freshness(_delivered(spark, sf, f"{base}/log"), late="30 days")
    landed: dict[str, str] = {}

    def land(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/counts/batch={batch_id}")
        landed["last"] = f"{base}/counts/batch={batch_id}"

    counts.writeStream.outputMode("update").foreachBatch(land).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    updates = spark.read.schema("hour timestamp, n long, batch long").option("basePath", f"{base}/counts").parquet(f"{base}/counts")
    return updates.groupBy(F.col("hour").cast("timestamp_ntz").alias("hour")).agg(F.max_by("n", "batch").alias("n"))
