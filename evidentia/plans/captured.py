"""Queries on metadata beside the text: heads, carriers, and extraction done anew from stored bytes."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidentia.plans import table
from evidentia.session import stored
from evidentia.sources import metadata, tables

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@query(r"""
with t as (select page_id, html, nullif(trim(regexp_replace(replace(replace(replace(replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&amp;', '&'), '\s+', ' ', 'g')), '') as title from pages),
l as (select page_id, 0 as rank, 'title: ' || title as line from t where title is not null
  union all select page_id, 1, 'description: About ' || page_id from t where page_id % 2 = 0
  union all select page_id, 2, 'og:description: about ' || page_id from t where page_id % 6 = 0
  union all select page_id, 6, 'author: Ann & Bo' from t where page_id % 3 = 0
  union all select page_id, 7, 'og:title: Page ' || page_id from t where page_id % 5 = 0
  union all select page_id, 12, 'article:tag: one' from t where page_id % 4 = 1
  union all select page_id, 12.5, 'article:tag: two' from t where page_id % 4 = 1)
select page_id, string_agg(line, chr(10) order by rank) as lines, case when page_id % 5 = 0 then 'Page ' || page_id end as og_title from l group by page_id
""")
def head_lines(spark, sf):
    """Head metadata of pages, with descriptions, authors, tags and junk put before their markup."""
    k = F.col("page_id")
    meta = lambda name, content: F.concat(F.lit(f"<meta {name} content='"), content, F.lit("'>"))
    some = [
        (k % 5 == 0, meta('property="og:title"', F.concat(F.lit("Page  "), k))),
        (k % 6 == 0, meta("property='OG:Description'", F.concat(F.lit("about "), k))),
        (k % 2 == 0, meta("name=twitter:description", F.concat(F.lit("About "), k))),
        (k % 2 == 0, meta("name=description", F.concat(F.lit(" About "), k, F.lit("\n")))),
        (k % 3 == 0, meta("name=author", F.lit("Ann &amp; Bo"))),
        (k % 4 == 1, F.concat(meta("property=article:tag", F.lit("one")), meta("property=article:tag", F.lit("two")), meta("property=article:tag", F.lit("one")))),
        (k >= 0, meta("name=viewport", F.lit("wide"))),
    ]
    pages = table(spark, sf, "pages").select("page_id", F.concat(*(F.when(when, html).otherwise("") for when, html in some), "html").alias("html"))
    found = metadata.head_metadata(tables.tag_stream(pages))
    return found.select("page_id", F.array_join("lines", "\n").alias("lines"), "og_title")


@query("""
with r as (select page_id, 'https://v/' || page_id as url, page_id % 7 as a, page_id % 5 as b from pages)
select url, case when a = 0 then 'failed' when a = 1 then 'no track' when page_id % 3 = 0 then 'new' when b < 2 then 'changed' else 'unchanged' end as outcome, case when a <> 0 then 200 end as http_status,
  case when a > 1 then case when b = 4 then 'extracted ' || page_id else 'Video ' || page_id end end as title, case when a > 1 then case when b = 4 then 'extracted' else 'carrier' end end as title_source,
  case when a > 1 and b <> 3 then '2020-01-0' || (b + 1) end as last_updated, case when a > 1 and b <> 3 then 'carrier' end as last_updated_source from r
""")
def carrier_overlay(spark, sf):
    """Carriers asked for: what they say over what was extracted, field by field, and those that leave an audit row alone."""
    k = F.col("page_id")
    asked = table(spark, sf, "pages").select(k, F.concat(F.lit("https://v/"), k).alias("url"))
    answered = asked.where("page_id % 7 <> 0")
    carrier = answered.select(
        "url", F.when(k % 7 != 1, F.md5(F.concat(F.lit("track "), k))).alias("track_sha"), F.when(k % 5 != 4, F.concat(F.lit("Video "), k)).alias("title"),
        F.when(k % 5 != 3, F.concat(F.lit("2020-01-0"), k % 5 + 1)).alias("last_updated"),
    )
    held = asked.where("page_id % 3 <> 0").select("url", F.md5(F.concat(F.when(k % 5 < 2, "old ").otherwise("track "), k)).alias("content_sha"))
    outcomes = metadata.carrier_outcomes(asked.select("url"), carrier, held)
    extracted = asked.where("page_id % 7 > 1").select("url", F.concat(F.lit("extracted "), k).alias("title"), F.lit(None).cast("string").alias("last_updated"))
    merged = metadata.overlay(extracted, carrier, "url", ["title", "last_updated"])
    return outcomes.join(merged, "url", "left").select("url", "outcome", "http_status", "title", "title_source", "last_updated", "last_updated_source")


def _versions(spark, sf):
    """Pages whose text, their first heading, was extracted by one of two versions or by hand, and their bytes."""
    pages, k = table(spark, sf, "pages"), F.col("page_id")
    first = F.regexp_extract("html", "<h1>([^<]*)</h1>", 1)
    rows = pages.select(
        k, F.sha2("html", 256).alias("content_sha"), F.when(k % 8 == 0, "manual").otherwise("html").alias("text_source"), F.when(k % 6 == 0, "v2").when(k % 5 == 0, None).otherwise("v1").alias("extractor"),
        F.when(k % 8 == 0, "by hand").when(k % 7 == 0, "stale").when(k % 10 == 3, F.lower(F.trim(first))).otherwise(first).alias("text"),
    )
    blobs = pages.where("page_id % 9 <> 0").select(F.sha2("html", 256).alias("content_sha"), F.when(k % 11 == 0, F.concat("html", F.lit("\x00"))).otherwise(F.col("html")).alias("content"))
    return rows, blobs


_SECOND = r"nullif(trim(regexp_extract(html, '<h1>([^<]*)</h1>', 1)), '')"


@query(rf"""
with p as (select page_id as k, regexp_extract(html, '<h1>([^<]*)</h1>', 1) as first, lower({_SECOND}) as second, sha256(html) as sha, case when page_id % 6 = 0 then 'v2' when page_id % 5 = 0 then null else 'v1' end as extractor from pages),
b as (select sha, k as bk from p where k % 9 <> 0 qualify row_number() over (partition by sha order by k) = 1),
t as (select p.*, case when k % 8 = 0 then 'by hand' when k % 7 = 0 then 'stale' when k % 10 = 3 then second else first end as text, b.bk from p left join b on b.sha = p.sha),
o as (select *, case when k % 8 = 0 then 'manual' when extractor = 'v2' then 'current' when bk is null then 'missing blob' when bk % 11 = 0 then 'undecodable' when second is null then 'empty' when second = text then 'unchanged' else 'rewritten' end as outcome from t)
select k as page_id, case when outcome = 'rewritten' then second else text end as text, case when outcome in ('rewritten', 'unchanged', 'empty', 'undecodable') then 'v2' else extractor end as extractor, outcome from o
""")
def reextraction(spark, sf):
    """A new version of an extractor over stored bytes: only pages of older versions are read, and outcomes come from the texts."""
    rows, blobs = _versions(spark, sf)
    second = lambda due: due.select("content_sha", F.lower(F.trim(F.regexp_extract("content", "<h1>([^<]*)</h1>", 1))).alias("text"))
    done = stored(metadata.reextract(rows, blobs, second, "v2", "page_id"), "reextracted")
    return done.select("page_id", "text", "extractor", "outcome")
