"""Corpus queries: URLs, pages, quoting, search, captures, library."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.functions import text as tx
from evidentia.functions import urls
from evidentia.operators import library, navigate, search
from evidentia.plans import table
from evidentia.session import shared_dir
from evidentia.sources import html, readers, tables
from evidentia.streaming import captures

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


_NORM = r"""lower(regexp_extract(url, '^(https?)://', 1)) || '://' || lower(regexp_extract(url, '^https?://([^/?#]*)', 1))
  || case when regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) in ('', '/') then '/' else regexp_replace(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1), '/+$', '') end
  || case when len(list_filter(string_split(regexp_extract(url, '\?([^#]*)', 1), '&'), lambda p: p <> '' and not starts_with(p, 'utm_source='))) > 0
     then '?' || array_to_string(list_sort(list_filter(string_split(regexp_extract(url, '\?([^#]*)', 1), '&'), lambda p: p <> '' and not starts_with(p, 'utm_source='))), '&') else '' end"""


@query(f"select page_id, {_NORM} as url from pages")
def url_normalize(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", urls.normalize(F.col("url")).alias("url"))


@query(f"""
with n as (select page_id, {_NORM} as u, {_NORM.replace('url', "replace(url, 'https://', 'http://')")} as alias from pages),
held as (select distinct u from n where page_id % 3 = 0), al as (select alias, u from n where page_id % 3 = 1 qualify row_number() over (partition by alias order by page_id desc, u) = 1)
select n.page_id, case when h.u is not null then 'cached' when al.u is not null then 'redirected' else 'missing' end as outcome, coalesce(h.u, al.u) as stored_url
from n left join held h on h.u = n.u left join al on al.alias = n.u
""")
def url_have(spark, sf):
    """Which requested addresses are held, by themselves or through the newest alias."""
    p = table(spark, sf, "pages").select("page_id", "url", urls.normalize(F.col("url")).alias("u"))
    held = p.where("page_id % 3 = 0").select(F.col("u").alias("url"))
    led = captures.newest_alias(p.where("page_id % 3 = 1").select("page_id", F.col("url").alias("raw"), F.col("u").alias("url")), urls.normalize(F.replace("raw", F.lit("https://"), F.lit("http://"))), at="page_id")
    return captures.holdings(p.select("page_id", "u"), F.col("u"), held, led).select("page_id", "outcome", "stored_url")


def _parsed(spark, sf):
    return html.pages_parsed(table(spark, sf, "pages"))


@query(r"""
with a as (select page_id, url, unnest(regexp_extract_all(html, '<a\s+href="([^"#][^"]*)"', 1)) as href from pages)
select distinct page_id, lower(regexp_extract(url, '^(https?://[^/?#]*)', 1)) || case when starts_with(href, '/') then href else '/' || href end as link from a where href <> '/'
""")
def page_links(spark, sf):
    """Outbound links of every page, resolved, normalised and distinct."""
    return html.outbound_links(_parsed(spark, sf)).select("page_id", "link")


@query(r"""
with a as (select distinct page_id, unnest(regexp_extract_all(html, '<a\s+href="([^"#][^"]*)"', 1)) as href from pages), x as (select lower(regexp_extract(href, '/[^/]*\.([A-Za-z0-9]{1,5})$', 1)) as ext from a where href <> '/')
select case when ext = '' then '(none)' else ext end as ext, count(*) as n from x group by all
""")
def link_ext_histogram(spark, sf):
    links = html.outbound_links(_parsed(spark, sf))
    return links.groupBy(F.coalesce(F.nullif("ext", F.lit("")), F.lit("(none)")).alias("ext")).agg(F.count("*").alias("n"))


@query(r"select page_id, nullif(trim(regexp_replace(replace(replace(replace(replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&amp;', '&'), '\s+', ' ', 'g')), '') as title from pages")
def page_title(spark, sf):
    return _parsed(spark, sf).select("page_id", "title")


@query()
def page_text(spark, sf):
    """Body text of every page, with its length and whether it is thin."""
    p = _parsed(spark, sf)
    return p.select("page_id", "title", "body", F.coalesce(F.length("body"), F.lit(0)).alias("chars"), captures.is_thin(F.col("body"), F.lit(None).cast("string"), F.lit(None).cast("string")).alias("thin"))


_SENT = r"""select doc_id, unnest(list_filter(list_transform(string_split(regexp_replace(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), '[\n\f]+', chr(1), 'g'), chr(1)), lambda s: trim(s, E' \t\n\r\f\x0b')), lambda s: s <> '')) as sentence from documents"""


@query(f"with s as ({_SENT}) select doc_id, count(*) as n_sentences, max(length(sentence))::int as longest, sum(length(sentence))::bigint as chars from s group by doc_id")
def sentences(spark, sf):
    s = table(spark, sf, "documents").select("doc_id", F.explode(tx.sentences(F.col("text"))).alias("sentence"))
    return s.groupBy("doc_id").agg(F.count("*").alias("n_sentences"), F.max(F.length("sentence")).alias("longest"), F.sum(F.length("sentence").cast("long")).alias("chars"))


@query(rf"with s as ({_SENT}) select doc_id, sentence from s where contains(lower(trim(regexp_replace(sentence, '\s+', ' ', 'g'))), 'of the')")
def quote_hits(spark, sf):
    """Sentences that hold a needle, verbatim."""
    return navigate.quote_sentences(table(spark, sf, "documents"), "Of  the", "doc_id").select("doc_id", "sentence")


def _marked_texts(spark, sf):
    """Documents with headings and pages put between their lines: a heading before every fifth, a page end after every eighth."""
    extra = lambda l, i: F.concat(
        F.when(i % 5 == 0, F.array(F.concat(F.repeat(F.lit("#"), F.floor(i / 5).cast("int") % 3 + 1), F.lit(" "), F.substring(l, 1, 20)))).otherwise(F.array().cast("array<string>")),
        F.array(l), F.when(i % 8 == 7, F.array(F.lit("\f"))).otherwise(F.array().cast("array<string>")),
    )
    return table(spark, sf, "documents").select("doc_id", F.array_join(F.flatten(F.transform(F.split("text", "\n"), extra)), "\n").alias("text"))


def _marked(spark, sf):
    """Their lines."""
    return navigate.lines_table(_marked_texts(spark, sf), "doc_id")


_LINES = r"""
l0 as (select doc_id, unnest(range(len(string_split(text, chr(10))))) as i, unnest(string_split(text, chr(10))) as raw from documents),
la as (select doc_id, i, 0 as sub, repeat('#', ((i // 5) % 3 + 1)::int) || ' ' || raw[1:20] as line from l0 where i % 5 = 0 union all select doc_id, i, 1, raw from l0 union all select doc_id, i, 2, chr(12) from l0 where i % 8 = 7),
l1 as (select doc_id, row_number() over (partition by doc_id order by i, sub) - 1 as line_no, i, sub, line from la),
l2 as (select *, (i // 5) % 3 + 1 as level, case when sub = 0 and regexp_matches(line, '^#{1,6}\s+\S') then trim(regexp_replace(regexp_replace(line, '^#{1,6}\s+', ''), '\s+#*\s*$', '')) end as heading,
  max(case when line <> '' then line_no end) over (partition by doc_id) as last_line from l1)"""


@query(rf"""with {_LINES}, p as (select *, 1 + sum((line = chr(12) and line_no < last_line)::int) over (partition by doc_id order by line_no) as page_no from l2)
select doc_id, page_no::bigint as page_no, length(trim(array_to_string(list(line order by line_no) filter (where line <> chr(12)), chr(10)))) as chars from p group by doc_id, page_no""")
def page_blocks(spark, sf):
    return navigate.page_blocks(_marked(spark, sf), "doc_id").select("doc_id", "page_no", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("chars"))


@query(rf"""with {_LINES}, h as (select doc_id, line_no, heading, level from l2 where heading is not null),
e as (select h.*, (select min(k.line_no) from h k where k.doc_id = h.doc_id and k.line_no > h.line_no and k.level <= h.level) as stop from h),
m as (select doc_id, max(line_no) as last from l2 group by doc_id)
select e.doc_id, heading, level::int as level, e.line_no::int as line_no, coalesce(stop - 1, last)::int as end_line,
  (select sum(length(line) + 1) - 1 from l2 where l2.doc_id = e.doc_id and l2.line_no between e.line_no and coalesce(stop - 1, last))::bigint as chars
from e join m on m.doc_id = e.doc_id""")
def section_blocks(spark, sf):
    """Sections with their extent and size."""
    return navigate.sections(_marked(spark, sf), "doc_id").withColumn("chars", F.col("chars").cast("long"))


_OUTLINE = rf"""{_LINES}, h as (select doc_id, line_no, heading, level from l2 where heading is not null),
e as (select h.*, (select min(k.line_no) from h k where k.doc_id = h.doc_id and k.line_no > h.line_no and k.level <= h.level) as stop from h),
z as (select doc_id, max(line_no) as last from l2 group by doc_id),
s as (select e.doc_id, e.heading, e.level, e.line_no, (select sum(length(line) + 1) - 1 from l2 where l2.doc_id = e.doc_id and l2.line_no between e.line_no and coalesce(stop - 1, z.last))::bigint as chars,
  coalesce(lead(level) over (partition by e.doc_id order by e.line_no) <= level, true) as leaf from e join z on z.doc_id = e.doc_id),
a as (select s.doc_id, s.line_no, k.level as above, max(k.line_no) as pos, arg_max(k.heading, k.line_no) as name from s join h k on k.doc_id = s.doc_id and k.line_no < s.line_no and k.level < s.level group by all),
b as (select *, max(pos) over (partition by doc_id, line_no order by above rows between unbounded preceding and 1 preceding) as higher from a),
p as (select doc_id, line_no, string_agg(name, ' > ' order by above) as path from b where higher is null or pos > higher group by all),
o as (select s.doc_id, coalesce(path, '') as path, heading, level::int as level, min(s.line_no)::int as line_no, sum(chars)::bigint as chars, count(*) as n
  from s left join p on p.doc_id = s.doc_id and p.line_no = s.line_no group by s.doc_id, coalesce(path, ''), heading, level, case when leaf then -1 else s.line_no end)"""


@query(f"with {_OUTLINE} select * from o where chars >= 40")
def outline(spark, sf):
    """Headings under their ancestors, repeats collapsed, small ones left out."""
    return navigate.outline(navigate.sections(_marked(spark, sf), "doc_id"), "doc_id", 40)


@query(f"""with {_OUTLINE}, g as (select doc_id, line_no, 1 + sum((line = chr(12) and line_no < last_line)::int) over (partition by doc_id order by line_no) as page_no from l2),
w as (select doc_id, count(*) filter (where chars < 40) as withheld from o group by doc_id), k as (select o.*, page_no from o join g on g.doc_id = o.doc_id and g.line_no = o.line_no where chars >= 40)
select w.doc_id, path, heading, level, k.line_no, page_no::bigint as page_no, chars, n, withheld from w left join k on k.doc_id = w.doc_id""")
def outline_pages(spark, sf):
    """The outline with pages, and how many entries of each document are withheld as too small."""
    return navigate.paged_outline(_marked(spark, sf), "doc_id", 40)


@query(rf"""with {_LINES},
f as (select doc_id, line_no, lower(trim(regexp_replace(line, '\s+', ' ', 'g'))) as form, last_value(case when heading is not null then line_no end ignore nulls) over (partition by doc_id order by line_no) as sec from l2),
k as (select *, sum(length(form) + 1) over (partition by doc_id order by line_no) - length(form) - 1 as start from f where form <> ''),
j as (select doc_id, string_agg(form, ' ' order by line_no) as whole from k group by doc_id),
q as (select doc_id, unnest(string_split(whole, 'of the')) as part, unnest(range(len(string_split(whole, 'of the')))) as i from j where contains(whole, 'of the')),
t as (select doc_id, sum(length(part) + 6) over (partition by doc_id order by i) - 6 as pos, i, max(i) over (partition by doc_id) as n from q),
h as (select t.doc_id, t.i, max(k.line_no) filter (where k.start <= t.pos) as first, max(k.line_no) filter (where k.start <= t.pos + 5) as last from t join k on k.doc_id = t.doc_id where t.i < t.n group by all),
x as (select doc_id, coalesce(sec, -1) as sec, min(line_no) as low, max(line_no) as high from f group by all),
w as (select h.doc_id, x.sec, greatest(h.first - 1, x.low) as a, greatest(least(h.last + 1, x.high), h.last) as b from h join f on f.doc_id = h.doc_id and f.line_no = h.first join x on x.doc_id = h.doc_id and x.sec = coalesce(f.sec, -1)),
u as (select *, case when a <= max(b) over (partition by doc_id, sec order by a, b rows between unbounded preceding and 1 preceding) then 0 else 1 end as fresh from w),
v as (select *, sum(fresh) over (partition by doc_id, sec order by a, b, fresh desc rows between unbounded preceding and current row) as island from u)
select doc_id, sec::int as section_start, min(a)::int as first_line, max(b)::int as last_line, count(*) as matches from v group by doc_id, sec, island""")
def quote_windows(spark, sf):
    """Occurrences with a line of context, clipped to sections and merged."""
    return navigate.quote_windows(_marked(spark, sf), "of the", 1, "doc_id")


@query(r"""
with l as (select doc_id, unnest(range(len(string_split(text, chr(10))))) as line_no, trim(unnest(string_split(text, chr(10)))) as line from documents)
select doc_id, line_no::int as line_no, line from (select *, lag(line) over (partition by doc_id order by line_no) as last from l where line <> '') where last is null or last <> line
""")
def transcript_collapse(spark, sf):
    """Lines of every text, blank ones out, runs of one line collapsed."""
    docs = table(spark, sf, "documents").select("doc_id", F.translate("text", "<>", "()").alias("text"))
    return navigate.transcript(docs, "doc_id", "text").withColumn("line", F.translate("line", "()", "()"))


_TOKENS = "translate(lower(text), 'àáâãäåçèéêëìíîïñòóôõöùúûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy')"


@query(rf"""with t as (select doc_id, unnest(regexp_extract_all({_TOKENS}, '[\p{{L}}\p{{N}}]+')) as term from documents), f as (select doc_id, term, count(*) as tf from t group by all)
select term, count(*) as df, sum(tf)::bigint as cf, max(tf) as most from f group by term""")
def postings_df(spark, sf):
    """Document and collection frequency of every term."""
    words = table(spark, sf, "documents").select("doc_id", F.explode(tx.tokens(F.coalesce("text", F.lit("")))).alias("term"))
    p = words.groupBy("doc_id", "term").agg(F.count("*").alias("tf"))
    return p.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"), F.max("tf").alias("most"))


def _bm25_sql(source: str, words: list[str]) -> str:
    tf = ", ".join(f"len(list_filter(toks, lambda x: x = '{w}')) as tf{k}" for k, w in enumerate(words))
    stats = ", ".join(f"count(*) filter (where tf{k} > 0) as df{k}" for k in range(len(words)))
    part = " + ".join(f"greatest(ln((n - df{k} + 0.5) / (df{k} + 0.5)), 1e-6) * tf{k} * 2.2 / (tf{k} + 1.2 * (0.25 + 0.75 * len / avg_len))" for k in range(len(words)))
    where = " and ".join(f"tf{k} > 0" for k in range(len(words)))
    return f"""with d as ({source}), t as (select doc_id, regexp_extract_all({_TOKENS}, '[\\p{{L}}\\p{{N}}]+') as toks from d), h as (select doc_id, len(toks) as len, {tf} from t),
s as (select count(*) as n, avg(len) as avg_len, {stats} from h) select doc_id, round({part}, 6) as score from h, s where {where}"""


@query(_bm25_sql("select doc_id, text from documents", ["license", "under"]))
def bm25_search(spark, sf):
    """Every document that holds both words, scored."""
    return search.bm25(table(spark, sf, "documents"), [["license"], ["under"]], "doc_id", "text").select("doc_id", F.round("score", 6).alias("score"))


@query(rf"""with t as (select doc_id, ' ' || array_to_string(regexp_extract_all({_TOKENS}, '[\p{{L}}\p{{N}}]+'), '  ') || ' ' as x from documents)
select doc_id, ((length(x) - length(replace(x, ' of  the ', ''))) / 9)::bigint as n from t where contains(x, ' of  the ')""")
def phrase_search(spark, sf):
    """How often a phrase occurs in each document: consecutive positions."""
    hits = search.phrase_hits(table(spark, sf, "documents"), [["of", "the"]], "doc_id", "text")
    return hits.where("tf0 > 0").select("doc_id", F.col("tf0").cast("long").alias("n"))


_TIERS = f"""with a as ({_bm25_sql("select doc_id, text from documents", ["license"])}), b as ({_bm25_sql("select conv_id as doc_id, string_agg(text, ' ' order by turn) as text from conversations group by conv_id", ["there"])}),
m as (select coalesce(a.doc_id, b.doc_id) as doc_id, a.score as text_score, b.score as ocr_score, greatest(a.score, b.score) as score from a full join b on a.doc_id = b.doc_id)
select *, case when text_score >= score then 'text' else 'ocr' end as tier from m order by score desc, doc_id limit 30"""


@query(_TIERS)
def two_tier_search(spark, sf):
    """Two text spaces ranked apart and merged, one row per document; the limit is the feature."""
    c = table(spark, sf, "conversations").groupBy(F.col("conv_id").alias("doc_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda s: s["text"]), " ").alias("text"))
    first = search.bm25(table(spark, sf, "documents"), [["license"]], "doc_id", "text").withColumn("score", F.round("score", 6))
    second = search.bm25(c, [["there"]], "doc_id", "text").withColumn("score", F.round("score", 6))
    return search.two_tier(first, second, "doc_id", 30)


@query(rf"""with {_LINES},
r as (select doc_id, line_no, coalesce(last_value(case when heading is not null then line_no end ignore nulls) over (partition by doc_id order by line_no), -1) as sec, regexp_extract_all({_TOKENS.replace("text", "line")}, '[\p{{L}}\p{{N}}]+') as w from l2),
c as (select *, sum(len(w)) over (partition by doc_id order by line_no) as stop from r),
x as (select doc_id, line_no, sec, stop - len(w) as start, unnest(w) as term, unnest(range(len(w))) as p from c),
y as (select *, start + p as pos, lead(term) over (partition by doc_id order by start + p) as next from x),
h as (select doc_id, sec, line_no, pos - 15 as lo, pos + 16 as hi from y where term = 'of' and next = 'the'),
n as (select h.doc_id, h.sec, h.lo, h.hi, h.line_no, min(c.line_no) as a, max(c.line_no) as b from h join c on c.doc_id = h.doc_id and c.sec = h.sec and len(c.w) > 0 and c.stop - len(c.w) <= h.hi and c.stop > h.lo group by all),
u as (select *, case when a <= max(b) over (partition by doc_id, sec order by a, b, lo rows between unbounded preceding and 1 preceding) then 0 else 1 end as fresh from n),
v as (select *, sum(fresh) over (partition by doc_id, sec order by a, b, lo rows between unbounded preceding and current row) as island from u)
select doc_id, sec::int as section_start, min(a)::int as first_line, max(b)::int as last_line, count(*) as matches from v group by doc_id, sec, island""")
def search_windows(spark, sf):
    """Matches with about thirty surrounding words, in whole lines."""
    return search.match_windows(_marked(spark, sf), ["of", "the"], 30, "doc_id")


@query(f"""with h as ({_bm25_sql("select doc_id, text from documents", ["license"])}), x as (select h.doc_id, h.score, source from h join documents d on d.doc_id = h.doc_id),
t as (select source, row_number() over (order by max(score) desc, source) as doc_rank from x group by source)
select x.source, x.doc_id, x.score, doc_rank, row_number() over (partition by x.source order by x.score desc, x.doc_id) as hit_rank from x join t on t.source = x.source where doc_rank <= 20""")
def doc_grouped_hits(spark, sf):
    """The best twenty sources by their best document, with all their hits; the limit is the feature."""
    docs = table(spark, sf, "documents")
    hits = search.bm25(docs, [["license"]], "doc_id", "text").select("doc_id", F.round("score", 6).alias("score")).join(docs.select("doc_id", "source"), "doc_id")
    found = search.grouped_hits(hits, "source", "doc_id", 20)
    return found.select("source", "doc_id", "score", F.col("doc_rank").cast("long").alias("doc_rank"), F.col("hit_rank").cast("long").alias("hit_rank"))


@query("""
with m as (select d.doc_id, source || ' ' || lang || case when quality = 1 then ' good' else '' end as meta from documents d left join labels l on l.doc_id = d.doc_id)
select doc_id, meta from m where list_contains(string_split(meta, ' '), 'fr') and list_contains(string_split(meta, ' '), 'good')
""")
def metadata_search(spark, sf):
    """Documents found by metadata alone: source, language, judgment."""
    d = table(spark, sf, "documents").select("doc_id", "source", "lang").join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    meta = d.select("doc_id", library.metadata_text([F.col("source"), F.col("lang"), F.when(F.col("quality") == 1, "good")]).alias("meta"))
    return meta.where(F.array_contains(tx.tokens(F.col("meta")), "fr") & F.array_contains(tx.tokens(F.col("meta")), "good"))


def _fetches(spark, sf):
    """The event log as a fetch log: user is the url, event type the content."""
    return table(spark, sf, "events").select(F.col("event_id").alias("id"), F.concat(F.lit("https://h/"), "user_id").alias("url"), F.col("ts").alias("fetched_at"), F.md5("event_type").alias("content_sha"), F.when(F.col("value") > 50, F.concat(F.lit("ocr "), "event_id")).alias("ocr_text"))


_FETCH = "select event_id as id, 'https://h/' || user_id as url, ts as fetched_at, md5(event_type) as content_sha, case when value > 50 then 'ocr ' || event_id end as ocr_text from events"
_FOLD = f"with f as ({_FETCH}) select url, strftime(min(fetched_at), '%Y-%m-%d %H:%M:%S') as first_fetched_at, strftime(max(fetched_at), '%Y-%m-%d %H:%M:%S') as last_fetched_at, arg_max(content_sha, (fetched_at, id)) as content_sha"


def _shown(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)


@query(_FOLD + ", count(*) as n_fetches from f group by url")
def capture_fold(spark, sf):
    return captures.fold(_fetches(spark, sf)).select("url", _shown("first_fetched_at"), _shown("last_fetched_at"), "content_sha", "n_fetches")


@query(f"""with f as ({_FETCH}), r as (select *, sum(fresh) over (partition by url order by fetched_at, id) as run from (select *, case when lag(content_sha) over w is not distinct from content_sha then 0 else 1 end as fresh from f window w as (partition by url order by fetched_at, id))),
g as (select url, run, arg_max(ocr_text, (fetched_at, id)) filter (where ocr_text is not null) as ocr_text from r group by url, run)
select url, ocr_text from g qualify row_number() over (partition by url order by run desc) = 1""")
def ocr_retention(spark, sf):
    """OCR text that survives the fold: the last one of the newest run of equal bytes."""
    return captures.kept_ocr(_fetches(spark, sf))


@query(f"with f as ({_FETCH}) select id, case when lag(id) over w is null then 'new' when lag(content_sha) over w = content_sha then 'unchanged' else 'changed' end as state from f window w as (partition by url order by fetched_at, id)")
def change_flags(spark, sf):
    return captures.change_flags(_fetches(spark, sf)).select("id", "state")


@query(f"with f as ({_FETCH}), p as (select url, max(fetched_at) as newest from f group by url) select url, case when date_diff('day', newest::date, (select max(newest) from p)::date) <= 30 then 'skip' else 'fetch' end as plan from p")
def freshness_plan(spark, sf):
    pages = captures.fold(_fetches(spark, sf))
    newest = pages.agg(F.max("last_fetched_at").alias("now"))
    return captures.freshness(pages.crossJoin(F.broadcast(newest)), F.col("now")).select("url", "plan")


@query(f"with f as ({_FETCH}) select url, strftime(fetched_at, '%Y-%m-%d %H:%M:%S') as fetched_at, id from f where ocr_text is not null qualify row_number() over (partition by url order by fetched_at desc, id desc) = 1")
def newest_ok_capture(spark, sf):
    return captures.newest_ok(_fetches(spark, sf), F.col("ocr_text").isNotNull()).select("url", _shown("fetched_at"), "id")


@query(_FOLD + " from f group by url")
def stream_capture_fold(spark, sf):
    """The same fold, streamed from the event files in micro-batches."""
    base = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    _fetches(spark, sf).drop("ocr_text").repartition(3).write.parquet(f"{base}/log")
    source = spark.readStream.schema(spark.read.parquet(f"{base}/log").schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/log")
    captures.stream_fold(source, f"{base}/pages", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/pages").select("url", _shown("first_fetched_at"), _shown("last_fetched_at"), "content_sha")


@query("""
with u as (select distinct 'https://h/' || o_custkey as url from orders), o as (select distinct 'https://h/' || c_custkey as url, c_custkey as owner from customer where c_custkey % 2 = 0)
select u.url, o.owner as known_owner, o.url is null as minted from u left join o on o.url = u.url
""")
def backfill_register(spark, sf):
    """Every address gets a document: its owner's, or a new one."""
    owned = table(spark, sf, "customer").where("c_custkey % 2 = 0").select(F.concat(F.lit("https://h/"), "c_custkey").alias("url"), F.col("c_custkey").alias("document_id"))
    wanted = table(spark, sf, "orders").select(F.concat(F.lit("https://h/"), "o_custkey").alias("url"))
    done = library.register(wanted, owned)
    return done.select("url", F.when(~F.col("minted"), F.col("document_id")).alias("known_owner"), "minted")


@query("""
with g as (select md5(text) as h, min(doc_id) as document_id, count(*) as n_merged from documents group by all)
select document_id, (select source from documents d where d.doc_id = g.document_id) as source, (select lang from documents d where d.doc_id = g.document_id) as lang, n_merged from g
""")
def merge_works(spark, sf):
    """Exact copies become one work; the smallest id survives."""
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("document_id"), "source", "lang", F.md5("text").alias("h"))
    first = d.groupBy("h").agg(F.min("document_id").alias("survivor"))
    pairs = d.join(first, "h").where("document_id <> survivor").select(F.col("document_id").alias("loser"), "survivor")
    merged, _ = library.merge_documents(d, pairs, ["source", "lang"])
    return merged.select("document_id", "source", "lang", "n_merged")


@query("""
with d as (select doc_id, md5(text) as h, source, lang from documents), s as (select h, min(doc_id) as survivor from d group by h)
select s.survivor as document_id, d.doc_id as loser, 'source' as field, d.source as value from d join s on s.h = d.h join d k on k.doc_id = s.survivor where d.doc_id <> s.survivor and d.source <> k.source
union all select s.survivor, d.doc_id, 'lang', d.lang from d join s on s.h = d.h join d k on k.doc_id = s.survivor where d.doc_id <> s.survivor and d.lang <> k.lang
""")
def merge_conflicts(spark, sf):
    """Values that the merge of exact copies leaves out, reported."""
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("document_id"), "source", "lang", F.md5("text").alias("h"))
    first = d.groupBy("h").agg(F.min("document_id").alias("survivor"))
    pairs = d.join(first, "h").where("document_id <> survivor").select(F.col("document_id").alias("loser"), "survivor")
    return library.merge_documents(d, pairs, ["source", "lang"])[1]


@query("""
with r as (select l_orderkey as doc, l_orderkey * 10 + l_linenumber as row_id, case when l_linenumber % 2 = 1 then l_suppkey % 5 end as machine, case when l_linenumber % 3 = 0 then null else 'm' || (l_suppkey % 3) end as maker from lineitem),
s as (select doc, count(*) as n_rows, count(distinct machine) as machines, count(distinct maker) as makers from r group by doc)
select doc, n_rows, machines, makers from s
""")
def subject_widths(spark, sf):
    """Identity widths per document before its subjects are unified."""
    r = _subjects(spark, sf)
    return r.groupBy("doc").agg(F.count("*").alias("n_rows"), F.count_distinct("machine").alias("machines"), F.count_distinct("maker").alias("makers"))


def _subjects(spark, sf):
    l = table(spark, sf, "lineitem")
    return l.select(F.col("l_orderkey").alias("doc"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_id"), F.when(F.col("l_linenumber") % 2 == 1, F.col("l_suppkey") % 5).alias("machine"), F.when(F.col("l_linenumber") % 3 != 0, F.concat(F.lit("m"), F.col("l_suppkey") % 3)).alias("maker"))


@query("""
with recursive r as (select l_orderkey as doc, l_orderkey * 10 + l_linenumber as row_id, case when l_linenumber % 2 = 1 then l_suppkey % 5 end as machine, case when l_linenumber % 3 = 0 then null else 'm' || (l_suppkey % 3) end as maker from lineitem),
e as (select a.row_id as a, b.row_id as b from r a join r b on a.doc = b.doc and (a.machine = b.machine or a.maker = b.maker)),
c(x, y) as (select row_id, row_id from r union select c.x, e.b from c join e on e.a = c.y)
select r.doc, g.subject, count(*) as n_rows, count(distinct machine) > 1 or count(distinct maker) > 1 as conflict from r join (select x, min(y) as subject from c group by x) g on g.x = r.row_id group by all
""")
def unify_subjects(spark, sf):
    """Rows of a document that share an identity become one subject; clashing identities are reported."""
    return library.unify_subjects(_subjects(spark, sf), "doc", ["machine", "maker"], []).select("doc", "subject", "n_rows", "conflict")


@query("""
select o_orderkey, coalesce(case when o_orderkey % 3 = 0 then 'AUTOMOBILE' end, c_mktsegment) as value, coalesce(case when o_orderkey % 3 = 0 then 'AUTOMOBILE' end <> c_mktsegment, false) as mismatch
from orders left join customer on c_custkey = o_custkey
""")
def enrich_refs(spark, sf):
    """Stored values are filled from the catalog, never replaced; differences are reported."""
    refs = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 3 == 0, "AUTOMOBILE").alias("stored"))
    catalog = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("resolved"))
    return library.enrich_refs(refs, catalog, "o_custkey", "stored", "resolved").select("o_orderkey", "value", "mismatch")


@query("""
with v as (select distinct lang as document_class from documents union select 'none') select v.document_class, count(d.doc_id) as n from v left join (select lang, doc_id from documents where doc_id in (select doc_id from labels where quality = 1)) d on d.lang = v.document_class group by all
""")
def class_counts(spark, sf):
    """Documents per class, classes without any included."""
    d = table(spark, sf, "documents").select("doc_id", F.col("lang").alias("document_class"))
    vocabulary = d.select("document_class").distinct().union(spark.createDataFrame([("none",)], "document_class string"))
    judged = d.join(table(spark, sf, "labels").where("quality = 1").select("doc_id"), "doc_id", "left_semi").withColumnRenamed("doc_id", "document_id")
    return library.class_counts(vocabulary, judged)


@query("""
select page_id, case page_id % 4 when 0 then 'pdf' when 1 then 'png' when 2 then 'html' end as kind, case when page_id % 4 = 3 then 'content-type' when page_id % 4 = 2 and octet_length(encode(html)) > 20000000 then 'too-large' end as skip_reason from pages
""")
def sniff_types(spark, sf):
    """Types by signature or declaration, and why a response is skipped."""
    k, body = F.col("page_id") % 4, F.encode("html", "UTF-8")
    content = F.when(k == 0, F.concat(F.to_binary(F.lit("255044462D"), F.lit("hex")), body)).when(k == 1, F.concat(F.to_binary(F.lit("89504E470D0A1A0A"), F.lit("hex")), body)).otherwise(body)
    declared = F.when(k == 2, "text/html; charset=utf-8").otherwise("application/octet-stream")
    rows = table(spark, sf, "pages").select("page_id", readers.sniff(content, declared).alias("kind"), F.length(body).cast("long").alias("size"))
    return rows.select("page_id", "kind", readers.skip_reason(F.col("kind"), F.col("size")).alias("skip_reason"))


@query("""
select p.page_id, q.page_id as first_page from pages p join (select md5(html) as h, min(page_id) as page_id from pages group by all) q on q.h = md5(p.html)
""")
def content_addressed(spark, sf):
    """Blobs by content: which page first held the same bytes."""
    p = table(spark, sf, "pages").select("page_id", F.sha2("html", 256).alias("sha"))
    return p.join(p.groupBy("sha").agg(F.min("page_id").alias("first_page")), "sha").select("page_id", "first_page")


@query(r"""
with t as (select page_id, unnest(regexp_extract_all(regexp_replace(regexp_replace(html, '<(script|style)[^>]*>.*?</(script|style)>', '<\1>', 'gs'), '<!--.*?-->', '', 'gs'), '<([a-z][a-z0-9]*)', 1)) as tag from pages)
select tag, count(*) as n, count(distinct page_id) as pages from t group by tag
""")
def page_tag_counts(spark, sf):
    """How often each tag stands in the pages, from the tag stream."""
    return tables.tag_stream(table(spark, sf, "pages")).groupBy("tag").agg(F.count("*").alias("n"), F.count_distinct("page_id").alias("pages"))


@query("""
with t as (select page_id, case page_id % 5 when 0 then html || 'é' when 1 then url || 'é ' when 2 then url || 'ああああ' when 3 then url || 'あ' || chr(65533) else html || 'é' end as text from pages)
select page_id, case page_id % 5 when 1 then 'windows-1252' when 2 then 'cp932' when 3 then 'cp932' else 'utf-8' end as charset, page_id % 5 = 3 as lossy, length(text)::bigint as chars, md5(text) as digest from t
""")
def page_charsets(spark, sf):
    """Page bytes of several charsets decoded: stated, stated and broken, unknown, and left to a guess."""
    k = F.col("page_id")
    ending = lambda text, code: F.concat(F.encode(text, "UTF-8"), F.to_binary(F.lit(code), F.lit("hex")))
    content = (
        F.when(k % 5 == 1, ending(F.col("url"), "E920")).when(k % 5 == 2, ending(F.col("url"), "82A082A082A082A0"))
        .when(k % 5 == 3, ending(F.col("url"), "82A082")).otherwise(ending(F.col("html"), "C3A9"))
    )
    stated = F.when(k % 5 == 0, "text/html; charset=UTF-8").when(k % 5 == 3, 'text/html; charset="Shift_JIS"').when(k % 5 == 4, "text/html; charset=x-none").otherwise("text/html")
    p = table(spark, sf, "pages").select("page_id", content.alias("content"), stated.alias("content_type"))
    return tables.decoded(p, "page_id").select("page_id", "charset", "lossy", F.length("text").cast("long").alias("chars"), F.md5("text").alias("digest"))


@query("""
select doc_id, case when doc_id % 11 = 0 then 'url' when doc_id % 7 = 0 then 'date' when doc_id % 5 = 0 then 'type' when trim(text) = '' then 'blank' when doc_id % 3 = 0 and doc_id % 2 = 0 then 'held' end as refusal from documents
""")
def import_refusals(spark, sf):
    """Validation of imports derived from documents: why each is refused, or null."""
    k = F.col("doc_id")
    url = F.when(k % 11 == 0, "nowhere").otherwise(F.concat(F.lit("https://h/"), k))
    at = F.when(k % 7 == 0, "yesterday").otherwise(F.lit("2020-01-02T03:04:05Z"))
    reason = tables.refusal_reason(url, at, F.when(k % 5 != 0, "text"), F.lit(False), F.col("text"), k % 3 == 0, k % 2 == 1)
    return table(spark, sf, "documents").select("doc_id", reason.alias("refusal"))


@query("""
select doc_id, case when doc_id % 4 = 0 then 'manual' when doc_id % 9 = 0 then 'missing blob' when trim(text) = '' then 'empty' when source = 'src0' then 'unchanged' else 'rewritten' end as outcome from documents
""")
def reextraction_plan(spark, sf):
    """Outcome of a re-extraction job derived from documents, in the order of its skip reasons."""
    k, text = F.col("doc_id"), F.col("text")
    old = F.when(F.col("source") == "src0", text).otherwise(F.concat(text, F.lit(".")))
    outcome = tables.reextraction_outcome(F.when(k % 4 == 0, "manual").otherwise("html"), k % 9 != 0, F.lit(False), F.lit(True), old, text)
    return table(spark, sf, "documents").select("doc_id", outcome.alias("outcome"))


@query("""
with h as (select doc_id, contains(lower(text), 'license') as by_text, source in ('src1', 'src2') as by_meta, doc_id % 4 <> 0 as captured from documents)
select doc_id, case when not captured then 'not acquired' when by_text then 'held' else 'held, metadata only' end as part from h where by_text and captured or by_meta
""")
def result_partition(spark, sf):
    """Search results as held, held by metadata alone, or not acquired."""
    d = table(spark, sf, "documents").select("doc_id", F.lower("text").contains("license").alias("by_text"), F.col("source").isin("src1", "src2").alias("by_meta"), (F.col("doc_id") % 4 != 0).alias("captured"))
    part = F.when(~F.col("captured"), "not acquired").when(F.col("by_text"), "held").otherwise("held, metadata only")
    return d.where((F.col("by_text") & F.col("captured")) | F.col("by_meta")).select("doc_id", part.alias("part"))
