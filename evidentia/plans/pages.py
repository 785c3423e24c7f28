"""Page and capture queries: tracks, redirects, logs, blobs, records, annotations, dates and labels."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from evidentia.functions import parse, urls
from evidentia.operators import records
from evidentia.plans import table
from evidentia.plans.corpus import _LINES, _marked
from evidentia.session import shared_dir
from evidentia.streaming import captures

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@query("""
with t as (select l_orderkey as video, l_linenumber % 3 = 0 as manual, ['en-GB', 'fr', 'de-orig', 'de', 'en', 'es', 'it'][l_linenumber] as language, case when l_orderkey % 2 = 0 then 'de' else 'fr' end as original from lineitem)
select video, manual, language from t qualify row_number() over (partition by video order by case when manual then 0 else 1 end,
  case when manual then case when language like 'en%' then 0 else 1 end when language = original || '-orig' then 0 when language = original then 1 when language like 'en%' then 2 else 3 end, language) = 1
""")
def track_choice(spark, sf):
    """One caption track per video, by kind and language."""
    codes = F.array(*map(F.lit, ("en-GB", "fr", "de-orig", "de", "en", "es", "it")))
    n = F.col("l_linenumber")
    tracks = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("video"), (n % 3 == 0).alias("manual"), F.get(codes, n - 1).alias("language"), F.when(F.col("l_orderkey") % 2 == 0, "de").otherwise("fr").alias("original"))
    return captures.chosen_track(tracks, "video", "original").select("video", "manual", "language")


@query("""
select page_id, case when page_id % 3 = 0 then 'https://moved.org/' || page_id else 'https://asked.org/' || page_id end as url, 'https://asked.org/' || page_id as raw_url from pages
""")
def redirect_keys(spark, sf):
    """A redirected response is kept under its final address, the requested one beside it."""
    k = F.col("page_id")
    asked = F.concat(F.lit("https://asked.org/"), k)
    final = F.when(k % 3 == 0, urls.normalize(F.concat(F.lit("HTTPS://Moved.org:443/"), k, F.lit("/#top"))))
    return captures.keyed_by_final(table(spark, sf, "pages"), final, asked).select("page_id", "url", "raw_url")


@query("select user_id, count(*) as fetches, count(*) filter (where event_id % 5 <> 0) as answered, count(*) filter (where event_id % 5 <> 0 and event_id % 7 = 0) as failed from events group by user_id")
def fetch_log(spark, sf):
    """Two appends to a fetch log, failures kept, imports without a status; read back and counted."""
    path = f"{shared_dir(spark)}/fetches-{uuid.uuid4().hex}"
    k = F.col("event_id")
    rows = table(spark, sf, "events").select("event_id", "user_id", F.when(k % 7 == 0, 404).otherwise(200).alias("http_status"), (k % 5 == 0).alias("imported"))
    captures.append_fetches(rows.where("event_id % 2 = 0"), path)
    captures.append_fetches(rows.where("event_id % 2 = 1"), path)
    return spark.read.parquet(path).groupBy("user_id").agg(F.count("*").alias("fetches"), F.count("http_status").alias("answered"), F.count_if(F.col("http_status") >= 400).alias("failed"))


@query("select page_id, md5(html) as content_sha from pages where md5(html) not in (select md5(html) from pages where page_id % 4 > 0)")
def missing_blobs(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", F.md5("html").alias("content_sha"))
    return captures.missing_blobs(pages, pages.where("page_id % 4 > 0")).select("page_id", "content_sha")


@query("""
select page_id, case when page_id % 2 = 0 then page_id end as held_id, case when page_id % 2 = 0 then 'https://p.org/' || page_id end as held_url from pages
""")
def page_record(spark, sf):
    """The stored page under any spelling of its address; nothing where none is held."""
    k = F.col("page_id")
    asked = table(spark, sf, "pages").select(F.concat(F.lit("HTTPS://P.org/"), k, F.lit("/?utm_source=x")).alias("request"))
    held = table(spark, sf, "pages").where("page_id % 2 = 0").select("page_id", F.concat(F.lit("https://p.org/"), k).alias("url"))
    found = records.page_records(asked, held)
    return found.select(F.regexp_extract("request", "/([0-9]+)/", 1).cast("long").alias("page_id"), F.col("page.page_id").alias("held_id"), F.col("page.url").alias("held_url"))


@query("select doc_id as document_id, '2024-01-0' || (doc_id % 9 + 1) as hunted_at, case when doc_id % 2 = 0 then 'old' else 'new' end as note from documents where doc_id % 2 = 0 or doc_id % 3 = 0")
def hunts(spark, sf):
    """Dated negative results, each once."""
    k = F.col("doc_id")
    rows = lambda note, test: table(spark, sf, "documents").where(test).select(k.alias("document_id"), F.concat(F.lit("2024-01-0"), k % 9 + 1).alias("hunted_at"), F.lit(note).alias("note"))
    return records.record_hunts(rows("old", "doc_id % 2 = 0"), rows("new", "doc_id % 3 = 0"))


@query("""
select case when doc_id % 5 > 0 then 'https://d.org/' || doc_id end as url, case when doc_id % 5 > 0 and doc_id % 4 < 3 and doc_id % 2 = 0 then doc_id end as owned_id, 'c' || (doc_id % 4) as document_class,
  case when doc_id % 5 = 0 then 'no address' when doc_id % 4 = 3 then 'unknown class' end as refusal from documents
""")
def bulk_annotation(spark, sf):
    """A work list's classes, unknown addresses registered and bad rows refused one by one."""
    k = F.col("doc_id")
    docs = table(spark, sf, "documents")
    work = docs.select(F.when(k % 5 > 0, F.concat(F.lit("https://D.org/"), k)).otherwise("  ").alias("url"), F.concat(F.lit("c"), k % 4).alias("document_class"))
    owners = docs.where("doc_id % 2 = 0").select(F.concat(F.lit("https://d.org/"), k).alias("url"), k.alias("document_id"))
    found = records.annotate(work, owners, ["c0", "c1", "c2"])
    return found.select("url", F.when(F.col("document_id") < 2**62, F.col("document_id")).alias("owned_id"), "document_class", "refusal")


@query("""
select page_id, 'Maker ' || page_id as name, case when page_id % 3 > 0 then 1971 end as first_year, case when page_id % 2 = 0 then 1983 end as last_year, 'term ' || page_id as term, case when page_id % 3 < 2 then 'other' end as alias,
  case when page_id % 3 = 2 then 'noun' end as entity_type, case page_id % 4 when 0 then '2020-03' when 1 then '2021-04-05' end as stated, case when page_id % 2 = 0 then '2019-01-02' else '2018-01-02' end as file_date from pages
""")
def page_texts(spark, sf):
    """Manufacturer cells, glossary terms, dates that a page states, and dates of document files."""
    k = F.col("page_id")
    cell = F.concat(F.lit("Maker "), k, F.lit(" ("), F.when(k % 3 > 0, "1971").otherwise("0"), F.lit("-"), F.when(k % 2 == 0, "1983").otherwise("now"), F.lit(")"))
    term = F.concat(F.lit("term "), k, F.when(k % 3 == 0, " (or other)").when(k % 3 == 1, " (pronounced other)").otherwise(" (Noun)"))
    html = F.concat("html", F.when(k % 4 == 0, '<time datetime="2020-03">').when(k % 4 == 1, '<meta property="article:published_time" content="2021-04-05T00:00">').otherwise(""))
    date = parse.file_date(F.when(k % 2 == 0, "D:20190102030405Z").otherwise("D:bad"), F.lit("D:20180102"))
    rows = table(spark, sf, "pages").select("page_id", parse.stated_years(cell).alias("c"), parse.term_parts(term).alias("t"), parse.page_date(html).alias("stated"), date.alias("file_date"))
    return rows.select("page_id", "c.*", "t.*", "stated", "file_date")


@query(rf"""with {_LINES},
r as (select doc_id, line_no, line, last_value(case when heading is not null then line_no end ignore nulls) over w as section_start, last_value(heading ignore nulls) over w as section, 1 + sum((line = chr(12) and line_no < last_line)::int) over w as page_no from l2 window w as (partition by doc_id order by line_no)),
h as (select doc_id, line_no as first_line, line_no + 1 as last_line from r where contains(line, ' of the '))
select h.doc_id, first_line, last_line, case when min(coalesce(section_start, -1)) = max(coalesce(section_start, -1)) then min(section) end as section, list_sort(list(distinct page_no::bigint)) as pages
from h join r on r.doc_id = h.doc_id and r.line_no between first_line and last_line where trim(line) <> '' and line <> chr(12) group by all""")
def hit_labels(spark, sf):
    """Two-line hits with their section, if they stay in one, and the pages that they touch."""
    lines = _marked(spark, sf)
    hits = lines.where(F.contains("line", F.lit(" of the "))).select("doc_id", F.col("line_no").cast("long").alias("first_line"), (F.col("line_no") + 1).cast("long").alias("last_line"))
    return records.hit_labels(lines, hits, "doc_id")
