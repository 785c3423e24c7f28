"""Queries that find a block by its name, say why none is found, and clean texts of captures."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidentia.functions import text as tx
from evidentia.operators import navigate, records
from evidentia.plans import table
from evidentia.plans.corpus import _OUTLINE, _marked

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


_ASKED = f"""{_OUTLINE},
pg0 as (select *, 1 + sum((line = chr(12) and line_no < last_line)::int) over (partition by doc_id order by line_no) as page_no from l2),
pg as (select doc_id, page_no, coalesce(trim(array_to_string(list(line order by line_no) filter (where line <> chr(12)), chr(10))), '') as sheet from pg0 group by doc_id, page_no),
pn as (select doc_id, max(page_no) as n, max(length(sheet)) as longest from pg group by doc_id),
f as (select doc_id, arg_min(lower(heading), line_no) as first from h group by doc_id),
r as (select doc_id, unnest(['page 2', 'page 99', 'nosuch']) as request from pn union all select doc_id, first from f union all select doc_id, first[1:length(first) - 2] from f where length(first) > 4)"""


def _requests(lines):
    """Of every document the pages 2 and 99, its first heading in lower case, a part of that, and a name that none has."""
    first = lines.where("heading is not null").groupBy("doc_id").agg(F.min_by(F.lower("heading"), "line_no").alias("first"))
    part = F.when(F.length("first") > 4, F.expr("substring(first, 1, length(first) - 2)"))
    names = F.filter(F.array(F.col("first"), part), lambda x: x.isNotNull())
    some = lines.select("doc_id").distinct().select("doc_id", F.explode(F.array(F.lit("page 2"), F.lit("page 99"), F.lit("nosuch"))).alias("heading"))
    return some.unionByName(first.select("doc_id", F.explode(names).alias("heading")))


@query(f"""with {_ASKED}
select r.doc_id, request, 'text' as tier, 'page' as kind, pg.page_no::bigint as line_no, length(sheet)::bigint as chars from r join pg on pg.doc_id = r.doc_id and request = 'page ' || page_no join pn on pn.doc_id = r.doc_id and n > 1
union all select r.doc_id, request, 'text', 'section', s.line_no::bigint, chars from r join s on s.doc_id = r.doc_id and lower(s.heading) = request join pn on pn.doc_id = r.doc_id where not (n > 1 and regexp_matches(request, '^page [0-9]+$'))""")
def named_blocks(spark, sf):
    """Pages and sections by name, all that answer."""
    lines = _marked(spark, sf)
    found = records.named_blocks(_requests(lines), lines, "doc_id")
    return found.select("doc_id", F.col("heading").alias("request"), "tier", "kind", "line_no", F.length("text").cast("long").alias("chars"))


@query(f"""with {_ASKED}
select r.doc_id, request, case when coalesce(longest, 0) = 0 then 'no text'
  when regexp_matches(request, '^page [0-9]+$') then case when n <= 1 then 'not paginated' when regexp_extract(request, '[0-9]+')::int > n then 'out of range'
    when (select trim(sheet) from pg where pg.doc_id = r.doc_id and 'page ' || page_no = request) = '' then 'empty sheet' end
  when exists (select 1 from h where h.doc_id = r.doc_id and lower(heading) = request) then null
  when exists (select 1 from h where h.doc_id = r.doc_id and (contains(lower(heading), request) or contains(request, lower(heading)))) then 'near heading' else 'unknown' end as reason
from r join pn on pn.doc_id = r.doc_id""")
def miss_reasons(spark, sf):
    """Why a name finds nothing; null where it finds something."""
    lines = _marked(spark, sf)
    heads = lines.where("heading is not null").select("doc_id", "heading")
    return records.miss_reason(_requests(lines), navigate.page_blocks(lines, "doc_id"), heads, "doc_id").withColumnRenamed("heading", "request")


@query("""
with l as (select doc_id, unnest(range(len(string_split(text, chr(10))))) as i, unnest(string_split(text, chr(10))) as line from documents)
select doc_id, 'source: ' || any_value(source) || chr(10) || 'lang: ' || any_value(lang) as metadata, (length(any_value(text)))::bigint as body_chars from documents where doc_id % 2 = 0 group by doc_id
union all select doc_id, '', length(text)::bigint from documents where doc_id % 2 = 1 and text not like '---%'
""")
def metadata_and_body(spark, sf):
    """Frontmatter of every second document and what follows it."""
    head = F.concat(F.lit("---\nsource: "), "source", F.lit("\nlang: "), "lang", F.lit("\n---\n"))
    docs = table(spark, sf, "documents").where("doc_id % 2 = 0 or text not like '---%'").select("doc_id", F.concat(F.when(F.col("doc_id") % 2 == 0, head).otherwise(""), "text").alias("text"))
    blocks = records.metadata_block(navigate.lines_table(docs, "doc_id", "text", frontmatter=True), "doc_id")
    return blocks.select("doc_id", F.coalesce("metadata", F.lit("")).alias("metadata"), F.length("body").cast("long").alias("body_chars"))


@query(f"""with {_ASKED}, t as (select conv_id as doc_id, count(*) as turns from conversations group by conv_id)
select coalesce(pn.doc_id, t.doc_id) as doc_id, case when n > 1 then 'text' when turns > 1 then 'ocr' end as tier from pn full join t on t.doc_id = pn.doc_id""")
def paging_tiers(spark, sf):
    """Which tier defines a document's pages: its text, or else the machine-read one, here a conversation's turns."""
    turns = table(spark, sf, "conversations").groupBy(F.col("conv_id").alias("doc_id")).agg(F.count("*").alias("page_no"))
    return records.paging_tier(_marked(spark, sf).select("doc_id", "page_no"), turns, "doc_id")


@query("""
select d.doc_id as document_id, source as title, 'https://a/' || d.doc_id || ' main,https://b/' || d.doc_id || ' copy' as urls,
  coalesce((select string_agg(c, ',' order by c) from (select 'quality ' || quality as c from labels l where l.doc_id = d.doc_id union all select 'toxic ' || toxic from labels l where l.doc_id = d.doc_id and toxic = 1)), '') as classes,
  case when d.doc_id % 3 = 0 then '2020-01-01 nothing,2020-02-01 again nothing' else '' end as hunts from documents d
""")
def nested_records(spark, sf):
    """A document with its addresses, classes and hunts nested, shown as lists."""
    docs, k = table(spark, sf, "documents"), F.col("doc_id")
    labels = table(spark, sf, "labels")
    ids = docs.select(k.alias("document_id"), F.col("source").alias("title"))
    urls = docs.select(k.alias("document_id"), F.explode(F.array(F.struct(F.concat(F.lit("https://b/"), k).alias("url"), F.lit("copy").alias("role")), F.struct(F.concat(F.lit("https://a/"), k).alias("url"), F.lit("main").alias("role")))).alias("u")).select("document_id", "u.*")
    judged = labels.select(k.alias("document_id"), F.explode(F.array(F.concat(F.lit("quality "), "quality"), F.when(F.col("toxic") == 1, F.concat(F.lit("toxic "), "toxic")))).alias("document_class"), F.lit("label").alias("source")).where("document_class is not null")
    hunts = docs.where("doc_id % 3 = 0").select(k.alias("document_id"), F.expr("inline(array(struct('2020-02-01' as hunted_at, 'again nothing' as note), struct('2020-01-01' as hunted_at, 'nothing' as note)))"))
    found = records.document_records(ids, urls, judged, hunts)
    listed = lambda c, f: F.array_join(F.transform(c, f), ",").alias(c)
    return found.select("document_id", "title", listed("urls", lambda x: F.concat_ws(" ", x["url"], x["role"])), listed("classes", lambda x: x["document_class"]), listed("hunts", lambda x: F.concat_ws(" ", x["hunted_at"], x["note"])))


@query(r"""
with l as (select doc_id, text, list_transform(range(len(string_split(text, chr(10)))), lambda i: {'i': i, 'line': string_split(text, chr(10))[i + 1]}) as x from documents)
select doc_id, case when regexp_matches(text, '\S') then md5(replace(text, chr(12), chr(10))) end as plain, case when doc_id % 10 = 0 then null else array_to_string(list_transform(list_filter(x, lambda s: (s.i * 37 + doc_id) % 10 >= 6), lambda s: s.line), chr(10)) end as kept,
  len(list_filter(x, lambda s: (s.i * 37 + doc_id) % 10 >= 6))::int as lines from l where doc_id % 10 = 0 or len(list_filter(x, lambda s: (s.i * 37 + doc_id) % 10 >= 6)) > 0
""")
def cleaned_texts(spark, sf):
    """Texts with a byte-order mark and foreign line ends made plain, and machine-read lines of enough confidence."""
    k = F.col("doc_id")
    docs = table(spark, sf, "documents").withColumn("raw", F.concat(F.lit("\ufeff"), F.replace("text", F.lit("\n"), F.lit("\r\n"))))
    read = F.transform(F.split("text", "\n"), lambda line, i: F.struct(((i * 37 + k) % 10 / 10).alias("confidence"), line.alias("text")))
    found = docs.select("doc_id", F.md5(tx.plain_text(F.col("raw"))).alias("plain"), tx.ocr_text(read).alias("ocr"), F.size(F.filter(read, lambda x: x["confidence"] >= 0.6)).alias("lines"))
    return found.where("doc_id % 10 = 0 or lines > 0").select("doc_id", "plain", F.when(k % 10 != 0, F.col("ocr")).alias("kept"), "lines")
