"""Source and sink queries: files are written to the shared folder from the tables, in the shapes that exports have, and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from evidentia.operators import checks
from evidentia.plans import table
from evidentia.session import shared_dir
from evidentia.sources import readers

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _folder(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("select c_custkey, c_name, c_nationkey from customer")
def exploded_object(spark, sf):
    """Files of one object that holds an array of at most a thousand records, exploded to typed rows."""
    path = _folder(spark, "objects")
    rows = table(spark, sf, "customer").select(F.floor(F.col("c_custkey") / 1000).alias("chunk"), F.struct("c_custkey", "c_name", "c_nationkey").alias("record"))
    whole = rows.groupBy("chunk").agg(F.to_json(F.struct(F.collect_list("record").alias("games"))).alias("value"))
    whole.write.partitionBy("chunk").text(path)
    read = spark.read.schema("games array<struct<c_custkey: long, c_name: string, c_nationkey: int>>").option("multiLine", True).json(path)
    return read.select(F.inline("games"))


@query("select n_nationkey::bigint as n_nationkey, n_name, n_regionkey::bigint as n_regionkey from nation")
def array_file(spark, sf):
    """A JSON array file, its schema inferred."""
    path = _folder(spark, "array")
    rows = table(spark, sf, "nation").groupBy().agg(F.to_json(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name", "n_regionkey")))).alias("value"))  # the file is one value by its format
    rows.coalesce(1).write.text(path)
    return readers.array_json(spark, path).select("n_nationkey", "n_name", "n_regionkey")


@query("""
select s_suppkey::bigint as id, s_name as name, case when s_suppkey % 2 = 0 then s_acctbal end as balance, case when s_suppkey % 2 = 0 then '2024-02-01 00:00:00' else '2024-01-01 00:00:00' end as snapshot from supplier
""")
def snapshot_files(spark, sf):
    """Two snapshots with different columns, each in files of at most a thousand records, united by name; each record gets its file's time."""
    path = _folder(spark, "snapshots")
    rows = table(spark, sf, "supplier")
    for n, (at, columns) in enumerate((("2024-02-01T00:00:00", ["id", "name", "balance"]), ("2024-01-01T00:00:00", ["id", "name"]))):
        part = rows.where(F.col("s_suppkey") % 2 == n).select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"), F.floor(F.col("s_suppkey") / 2000).alias("chunk"))
        whole = part.groupBy("chunk").agg(F.to_json(F.struct(F.lit(at).alias("LastRefreshDateUtc"), F.collect_list(F.struct(*columns)).alias("Data"))).alias("value"))
        whole.withColumn("n", F.lit(n)).write.mode("append").partitionBy("n", "chunk").text(path)
    return readers.snapshots(spark, [path]).select("id", "name", "balance", F.date_format("snapshot_utc", "yyyy-MM-dd HH:mm:ss").alias("snapshot"))


@query("select doc_id, lang, source, n_chars from documents")
def jsonl_round_trip(spark, sf):
    """JSON lines written in order with every key on every row, and read back under a schema that lets no key vanish."""
    path = _folder(spark, "lines")
    rows = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    readers.write_jsonl(rows, path, "doc_id")
    return readers.strict_jsonl(spark, path, rows.schema)


@query("select page_id, url, case when page_id % 3 > 0 then 'q ' || page_id end as query from pages where page_id % 5 > 0")
def work_list_file(spark, sf):
    """A work list of addresses and queries; blank and # lines are passed over."""
    path = _folder(spark, "work")
    k = F.col("page_id")
    line = F.when(k % 5 == 0, F.when(k % 2 == 0, "").otherwise(F.concat(F.lit("# "), "url"))).otherwise(F.concat(F.lit(" "), "url", F.when(k % 3 > 0, F.concat(F.lit("\t q "), k)).otherwise("")))
    table(spark, sf, "pages").select(line.alias("value")).write.text(path)
    # pages may share an address: equal lines are told apart by their count alone, and the n-th of them is the n-th page's
    nth = F.row_number().over(Window.partitionBy("url", "query").orderBy("page_id")).alias("nth")
    asked = table(spark, sf, "pages").where(k % 5 > 0).select("page_id", F.trim("url").alias("url"), F.when(k % 3 > 0, F.concat(F.lit("q "), k)).alias("query")).select("*", nth).alias("a")
    listed = readers.work_list(spark, path).select("*", F.row_number().over(Window.partitionBy("url", "query").orderBy("url")).alias("nth")).alias("l")
    same = (F.col("a.url") == F.col("l.url")) & F.col("a.query").eqNullSafe(F.col("l.query")) & (F.col("a.nth") == F.col("l.nth"))
    return listed.join(asked, same).select("page_id", "l.url", "l.query")


@query("""
select page_id, case page_id % 4 when 0 then 'pdf' when 1 then 'html' when 2 then 'vtt' end as kind, case when page_id % 4 = 3 then 'content-type' when page_id % 3 = 0 then 'too-large' end as reason from pages
""")
def size_caps(spark, sf):
    """Why a response is passed over: its type, or its size for that type."""
    k = F.col("page_id")
    content = F.when(k % 4 == 0, F.to_binary(F.lit("255044462D31"), F.lit("hex"))).when(k % 4 == 2, F.to_binary(F.lit("WEBVTT"), F.lit("utf-8"))).otherwise(F.to_binary(F.lit("<html>"), F.lit("utf-8")))
    declared = F.when(k % 4 == 1, "text/html; charset=utf-8").otherwise("application/octet-stream")
    kind = readers.sniff(content, declared)
    return table(spark, sf, "pages").select("page_id", kind.alias("kind"), readers.skip_reason(kind, F.length("html") + F.when(k % 3 == 0, 300_000_000).otherwise(0)).alias("reason"))


@query("select k, case when k % 2 = 0 then 'unchanged' else 'content differs' end as verdict from (select distinct page_id % 4 as k from pages)")
def verified_tree(spark, sf):
    """A tree of files against its manifest: each file is hashed again."""
    path = _folder(spark, "tree")
    table(spark, sf, "pages").select(F.col("url").alias("value"), (F.col("page_id") % 4).alias("k")).repartition("k").write.partitionBy("k").text(path)
    here = readers.manifest(spark, path, r"/[._][^/]*$").withColumn("k", F.regexp_extract("path", "/k=([0-9]+)/", 1).cast("long"))
    noted = here.select("path", "size", F.when(F.col("k") % 2 == 0, F.col("sha256")).otherwise("0").alias("sha256"))
    return readers.verify(here, noted).withColumn("k", F.regexp_extract("path", "/k=([0-9]+)/", 1).cast("long")).select("k", "verdict")


@query("select event_type, count(*) as n, max(value) as most from events where value > 10 group by event_type")
def external_relation(spark, sf):
    """A relation of another system registered for ad hoc SQL."""
    readers.external(spark, "fetch_log", "parquet", path=f"{sf}/events.parquet")
    return spark.sql("select event_type, count(*) as n, max(value) as most from fetch_log where value > 10 group by event_type")


@query("select doc_id, null::varchar as note from documents")
def absent_source(spark, sf):
    """A source that is absent gives an empty typed relation, so that later joins still plan."""
    notes = readers.or_empty(spark, f"{sf}/no-such-notes.parquet", "doc_id long, note string")
    return table(spark, sf, "documents").select("doc_id").join(notes, "doc_id", "left")


@query("""
select table_name as relation, column_name, column_index - 1 as position from duckdb_columns() where table_name in ('region', 'nation', 'customer', 'supplier', 'part', 'orders', 'lineitem', 'events', 'documents', 'embeddings', 'pages', 'benchmark', 'labels', 'conversations')
""")
def catalog_columns(spark, sf):
    """Columns of all relations as rows."""
    names = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
    return checks.schema_rows({n: table(spark, sf, n) for n in names}).select("relation", "column_name", "position")


@query("""
select page_id, unnest(range(1, 3)) as n, '2011010' || (page_id % 9 + 1) || '00000' || unnest(range(1, 3)) as timestamp, url as original, case when page_id % 2 = 0 then '200' else '404' end as statuscode from pages
""")
def capture_index(spark, sf):
    """Capture lists, arrays whose first row names the fields, as rows."""
    k = F.col("page_id")
    status = F.when(k % 2 == 0, "200").otherwise("404")
    row = lambda n: F.array(status, F.concat(F.lit("2011010"), k % 9 + 1, F.lit(f"00000{n}")), F.lit("text/html"), F.col("url"))
    head = F.array(*map(F.lit, ("statuscode", "timestamp", "mimetype", "original")))
    lists = table(spark, sf, "pages").select("page_id", F.to_json(F.array(head, row(1), row(2))).alias("body"))
    return readers.capture_list(lists, "body", "page_id").select("page_id", F.substring("timestamp", -1, 1).cast("long").alias("n"), "timestamp", "original", "statuscode")
