"""Record queries: projections, lookups, the document library, addresses and captures."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidentia.functions import parse, urls
from evidentia.operators import library, reconcile, records
from evidentia.plans import table
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
select p_partkey, 'G' || (p_partkey // 10) as group_id, case when p_partkey % 3 > 0 then 'M' || (p_partkey % 10) end as machine_id, case when p_partkey % 3 = 2 then 'A' || p_size end as alias_id,
  case when p_size <= 40 then (p_partkey % 3 > 0) end as resolvable from part
""")
def dashed_ids(spark, sf):
    """Group, machine and alias of a dashed id; resolvable is unknown for the category that has no ids yet."""
    k = F.col("p_partkey")
    text = F.concat(F.lit("G"), F.floor(k / 10).cast("string"), F.when(k % 3 > 0, F.concat(F.lit("-M"), k % 10)).otherwise(""), F.when(k % 3 == 2, F.concat(F.lit("-A"), "p_size")).otherwise(""))
    category = F.when(F.col("p_size") > 40, "open").otherwise("closed")
    return table(spark, sf, "part").select("p_partkey", records.dashed_id(text).alias("d"), records.is_resolvable(category, text, "^G[0-9]+-M", "open").alias("resolvable")).select("p_partkey", "d.*", "resolvable")


@query("select * exclude (p_retailprice) replace (lower(p_name) as p_name) rename (p_size as size, p_brand as brand) from part")
def exclude_replace_rename(spark, sf):
    """All columns but one, one replaced, two renamed; a rename of an absent column is passed over."""
    part = reconcile.replaced(reconcile.without(table(spark, sf, "part"), "p_retailprice"), p_name=F.lower("p_name"))
    return reconcile.renamed(part, {"p_size": "size", "p_brand": "brand", "absent": "unseen"})


@query("select o_orderkey, case when o_custkey % 50 <> 0 then o_orderpriority end as o_orderpriority, case when o_custkey % 50 <> 0 then o_totalprice end as o_totalprice from orders")
def null_override(spark, sf):
    """Listed records lose their values of some columns and keep their rows."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
    listed = table(spark, sf, "customer").where("c_custkey % 50 = 0").select(F.col("c_custkey").alias("o_custkey"))
    return reconcile.nulled(orders, listed, ["o_custkey"], ["o_orderpriority", "o_totalprice"]).select("o_orderkey", "o_orderpriority", "o_totalprice")


@query("""
select o_orderkey, coalesce(c.c_mktsegment, s.s_name) as owner from orders
left join customer c on c.c_custkey = o_custkey and c.c_custkey % 3 <> 0 left join supplier s on s.s_suppkey = o_custkey
""")
def two_path_lookup(spark, sf):
    """The first lookup's value, else the second's."""
    first = table(spark, sf, "customer").where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    second = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("o_custkey"), "s_name")
    found = reconcile.enrich_one_to_one(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), [(first, ["o_custkey"]), (second, ["o_custkey"])])
    return found.select("o_orderkey", F.coalesce("c_mktsegment", "s_name").alias("owner"))


@query("select p_partkey, s_suppkey from part, supplier where list_contains([p_partkey % 100, p_size], s_suppkey)")
def list_membership(spark, sf):
    """A join on membership of a list: the list is exploded to distinct keys, so it is an equality join."""
    wanted = table(spark, sf, "part").select("p_partkey", F.explode(F.array_distinct(F.array(F.col("p_partkey") % 100, F.col("p_size").cast("long")))).alias("s_suppkey"))
    return wanted.join(table(spark, sf, "supplier").select("s_suppkey"), "s_suppkey").select("p_partkey", "s_suppkey")


@query("select p_partkey, w, case w when 'SMALL' then 'size' when 'LARGE' then 'size' when 'PROMO' then 'offer' end as target from (select p_partkey, unnest(string_split(p_type, ' ')) as w from part) where w in ('SMALL', 'LARGE', 'PROMO')")
def ruled_values(spark, sf):
    """Only values that a rule names, with the rule's target."""
    rules = spark.createDataFrame([("SMALL", "size"), ("LARGE", "size"), ("PROMO", "offer")], "w string, target string")
    return table(spark, sf, "part").select("p_partkey", F.explode(F.split("p_type", " ")).alias("w")).join(F.broadcast(rules), "w").select("p_partkey", "w", "target")  # three rules


@query("""
select l_orderkey, l_partkey, l_suppkey from lineitem l where exists (select 1 from lineitem r where r.l_returnflag = 'R' and r.l_orderkey = l.l_orderkey and r.l_suppkey = l.l_suppkey and r.l_linestatus = l.l_linestatus)
""")
def three_key_semi(spark, sf):
    lines = table(spark, sf, "lineitem")
    keys = ["l_orderkey", "l_suppkey", "l_linestatus"]
    return lines.join(lines.where("l_returnflag = 'R'").select(*keys), keys, "left_semi").select("l_orderkey", "l_partkey", "l_suppkey")


@query("select p_type, count(*) as n, lower(split_part(p_type, ' ', 1)) as head, strlen(p_type)::int as size from part group by p_type")
def parse_distinct(spark, sf):
    """Distinct texts are parsed once each, however many rows hold them."""
    once = table(spark, sf, "part").groupBy("p_type").agg(F.count("*").alias("n"))
    return once.select("p_type", "n", F.lower(F.split_part("p_type", F.lit(" "), F.lit(1))).alias("head"), F.length("p_type").alias("size"))


@query("""
select source, count(*) as n, count(*) filter (where l.doc_id is null) as gap from documents d left join labels l on l.doc_id = d.doc_id group by source
""")
def coverage_gap(spark, sf):
    """How many rows of each group a second source does not cover."""
    covered = table(spark, sf, "labels").select("doc_id", F.lit(True).alias("covered"))
    return table(spark, sf, "documents").join(covered, "doc_id", "left").groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("covered").isNull()).alias("gap"))


@query("select w as label, count(*) as n from (select unnest(string_split(p_type, ' ')) as w from part) where w not in ('BRASS', 'STEEL', 'TIN', 'COPPER') group by w")
def unknown_labels(spark, sf):
    """Labels outside a vocabulary with their frequency."""
    words = table(spark, sf, "part").select(F.explode(F.split("p_type", " ")).alias("label"))
    return words.where(~F.col("label").isin("BRASS", "STEEL", "TIN", "COPPER")).groupBy("label").agg(F.count("*").alias("n"))


@query("""
with r as (select c_custkey, c_acctbal, row_number() over (order by c_acctbal desc, c_custkey) as place, count(*) over () as total from customer)
select c_custkey, place, greatest(total - 25, 0) as withheld from r where place <= 25
""")
def top_and_withheld(spark, sf):
    """The first 25 and how many the limit keeps back; the limit is the feature."""
    return reconcile.top_withheld(table(spark, sf, "customer"), [F.desc("c_acctbal"), F.asc("c_custkey")], 25).select("c_custkey", "place", "withheld")


@query("""
with s as (select doc_id as url, 'text' as tier, unnest(range(1, doc_id % 3 + 2)) as k from documents union all select doc_id, 'ocr', unnest(range(1, doc_id % 2 + 2)) from documents),
n as (select url, tier, k, case when url % 5 = 0 then 'intro ' || k else 'page ' || k end as name from s)
select url, tier, name, row_number() over (partition by url order by case when url % 5 <> 0 then k end, tier, k) as ord from n
""")
def interleaved_tiers(spark, sf):
    """Sections of both tiers by sheet where all are pages, else tier by tier."""
    key = F.col("doc_id")
    side = lambda tier, most: table(spark, sf, "documents").select(key.alias("url"), F.lit(tier).alias("tier"), F.explode(F.sequence(F.lit(1), (key % most + 1).cast("int"))).alias("line_no"))
    rows = side("text", 3).unionByName(side("ocr", 2)).withColumn("name", F.concat(F.when(F.col("url") % 5 == 0, "intro ").otherwise("page "), "line_no"))
    return records.interleaved(rows).select("url", "tier", "name", F.col("ord").cast("long").alias("ord"))


_OWNED = "owned as (select doc_id as document_id, 'https://h' || (doc_id % 9) || '.org/d/' || doc_id as url from documents)"


def _owned(spark, sf):
    k = F.col("doc_id")
    return table(spark, sf, "documents").select(k.alias("document_id"), F.concat(F.lit("https://h"), k % 9, F.lit(".org/d/"), k).alias("url"))


@query(f"""
with {_OWNED}, r as (select url as requested, 'https://h' || ((document_id + 1) % 9) || '.org/d/' || (document_id + case when document_id % 3 = 0 then 1 when document_id % 3 = 1 then 0 else 1000000 end) as final, document_id from owned where document_id % 2 = 0)
select r.requested, r.final, case when b.document_id is null then 'adopt' when b.document_id = r.document_id then 'none' else 'conflict' end as action, r.document_id from r left join owned b on b.url = r.final
""")
def adopt_redirects(spark, sf):
    """What becomes of a redirect's target: adopted if nobody owns it, a conflict if another document does."""
    owned = _owned(spark, sf)
    k = F.col("document_id")
    target = F.concat(F.lit("https://h"), (k + 1) % 9, F.lit(".org/d/"), k + F.when(k % 3 == 0, 1).when(k % 3 == 1, 0).otherwise(1_000_000))
    return library.adopt_redirects(owned.where("document_id % 2 = 0").select(F.col("url").alias("requested"), target.alias("final")), owned)


@query(f"""
with {_OWNED}, r as (select case when doc_id % 2 = 0 then doc_id::varchar else 'HTTPS://H' || (doc_id % 9) || '.ORG/d/' || doc_id || '/#x' end as ref, doc_id from documents where doc_id % 3 = 0)
select r.ref, o.document_id from r join owned o on o.document_id = r.doc_id
""")
def resolve_refs(spark, sf):
    """References by number or by any spelling of an owned address."""
    k = F.col("doc_id")
    refs = table(spark, sf, "documents").where("doc_id % 3 = 0").select(F.when(k % 2 == 0, k.cast("string")).otherwise(F.concat(F.lit("HTTPS://H"), k % 9, F.lit(".ORG/d/"), k, F.lit("/#x"))).alias("ref"))
    return records.resolve_refs(refs, table(spark, sf, "documents").select(k.alias("document_id")), _owned(spark, sf))


@query("select doc_id as document_id, case when doc_id % 4 = 0 then 'set' when doc_id % 4 = 1 then null else source end as source, lang from documents")
def set_fields(spark, sf):
    """Changes with a flag of their own: setting null differs from leaving alone."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("document_id"), "source", "lang")
    k = F.col("document_id")
    changes = docs.where("document_id % 4 < 3").select("document_id", F.when(k % 4 == 0, "set").alias("source"), (k % 4 < 2).alias("set_source"))
    return records.set_fields(docs, changes, ["source"])


@query("""
with j as (select doc_id as document_id, 'q' || quality as document_class, 'auto' as source, 0 as fresh from labels union all select doc_id, 'q' || (doc_id % 2), 'person', 1 from labels where doc_id % 3 = 0)
select document_id, document_class, source from j qualify row_number() over (partition by document_id, document_class order by case source when 'person' then 1 else 2 end, fresh) = 1
""")
def class_judgments(spark, sf):
    """One judgment per document and class; a person's beats a rule's."""
    labels = table(spark, sf, "labels")
    held = labels.select(F.col("doc_id").alias("document_id"), F.concat(F.lit("q"), "quality").alias("document_class"), F.lit("auto").alias("source"))
    given = labels.where("doc_id % 3 = 0").select(F.col("doc_id").alias("document_id"), F.concat(F.lit("q"), F.col("doc_id") % 2).alias("document_class"), F.lit("person").alias("source"))
    return library.class_judgments(held, given, ["person", "auto"])


@query(f"""
with {_OWNED}, f as (select url, case when document_id % 5 = 0 then 404 else 200 end as http_status, document_id from owned where document_id % 2 = 0)
select o.url, o.document_id % 4 = 0 as captured, o.document_id % 4 <> 0 and f.http_status is not null and f.http_status <> 200 as blocked from owned o left join f on f.url = o.url
""")
def acquisition(spark, sf):
    """Captured, and blocked: not captured and last answered with another status than 200."""
    owned = _owned(spark, sf)
    k = F.col("document_id")
    fetch = lambda n, status: owned.where("document_id % 2 = 0").select("url", status.alias("http_status"), F.lit(n).alias("fetched_at"), F.lit(n).alias("id"))
    fetches = fetch(1, F.lit(500)).unionByName(fetch(2, F.when(k % 5 == 0, 404).otherwise(200)))
    return records.acquisition(owned, owned.where("document_id % 4 = 0").select("url"), fetches).select("url", "captured", "blocked")


@query(f"""
with {_OWNED} select source as ref, document_id, url, case when document_id % 3 = 0 then url else 'https://new.org/' || document_id end as page_url
from owned join documents on doc_id = document_id where document_id % 3 < 2
""")
def captures_for_refs(spark, sf):
    """A citation's documents, their addresses, and the page held under each, by itself or its alias."""
    owned = _owned(spark, sf)
    docs = table(spark, sf, "documents").select(F.col("source").alias("ref"), F.col("doc_id").alias("document_id"))
    pages = owned.where("document_id % 3 = 0").select("url")
    aliases = owned.where("document_id % 3 = 1").select(F.col("url").alias("alias_url"), F.concat(F.lit("https://new.org/"), "document_id").alias("url"))
    return records.captures_for_refs(docs.select("ref").distinct(), docs, owned, pages, aliases)


@query(f"""
with {_OWNED}, c as (select document_id, string_agg(distinct k, ',' order by k) as classes from (select doc_id as document_id, unnest(['q' || quality, 't' || toxic]) as k from labels) group by document_id)
select o.url, o.document_id, c.classes, s.subjects from owned o left join c on c.document_id = o.document_id left join (select doc_id, case when doc_id % 4 = 0 then source when doc_id % 4 = 1 then lang else 'maker' end as subjects from documents where doc_id % 4 < 3) s on s.doc_id = o.document_id
""")
def decorated_hits(spark, sf):
    """Hits with their document, its classes and its subjects' names."""
    owned, docs = _owned(spark, sf), table(spark, sf, "documents")
    classes = table(spark, sf, "labels").select(F.col("doc_id").alias("document_id"), F.explode(F.array(F.concat(F.lit("q"), "quality"), F.concat(F.lit("t"), "toxic"))).alias("document_class"))
    k = F.col("doc_id")
    subjects = docs.where("doc_id % 4 < 3").select(k.alias("document_id"), F.when(k % 4 == 0, F.col("source")).alias("label"), F.when(k % 4 < 2, F.col("lang")).alias("machine"), F.lit("maker").alias("maker"))
    return records.decorated(owned.select("url"), owned, classes, subjects)


@query("""
with f as (select 'https://x.org/' || (p_partkey % 7) || '/' || p_brand || '-' || (p_partkey // 7) || '.pdf' as url, lower(p_brand || '-' || (p_partkey // 7) || '.pdf') as basename from part)
select url, basename, count(*) over (partition by basename) as merge_hint from (select distinct * from f)
""")
def listing_seed(spark, sf):
    """One document per file address, with how many addresses share its base name."""
    k = F.col("p_partkey")
    files = table(spark, sf, "part").select(F.concat(F.lit("https://x.org/"), k % 7, F.lit("/"), "p_brand", F.lit("-"), F.floor(k / 7).cast("string"), F.lit(".pdf")).alias("url"))
    return records.listing_seed(files).select("url", "basename", "merge_hint")


@query("""
select page_id, case page_id % 4 when 0 then 'https://web.archive.org/web/20110203040506/' || url else url end as raw_url, page_id % 4 = 0 as archived,
  case when page_id % 4 = 0 then '2011-02-03' end as capture_date, case when page_id % 3 < 2 then 'https://www.youtube.com/watch?v=abcdef' || page_id end as video from pages
""")
def archive_and_video(spark, sf):
    """Archive addresses with their capture date, and one key for all forms of a video address."""
    k = F.col("page_id")
    raw = F.when(k % 4 == 0, F.concat(F.lit("https://web.archive.org/web/20110203040506/"), "url")).otherwise(F.col("url"))
    video = F.when(k % 3 == 0, F.concat(F.lit("https://youtu.be/abcdef"), k)).when(k % 3 == 1, F.concat(F.lit("http://m.youtube.com/watch?t=1&v=abcdef"), k)).otherwise(F.concat(F.lit("https://example.org/v/"), k))
    return table(spark, sf, "pages").select("page_id", raw.alias("raw_url"), urls.is_archived(raw).alias("archived"), F.nullif(urls.capture_date(raw), F.lit("")).alias("capture_date"), urls.canonical_video(video).alias("video"))


@query("""
select p_partkey, case when p_partkey % 2 = 0 then 'Acme_' || split_part(p_name, ' ', 1) end as publisher, (1900 + p_partkey % 100)::int as year, case when p_partkey % 3 < 2 then (p_partkey % 12 + 1)::int end as month,
  case when p_partkey % 3 = 0 then (p_partkey % 28 + 1)::int end as day, case p_partkey % 3 when 0 then 'day' when 1 then 'month' else 'year' end as precision,
  p_size::bigint * 1000 as units, p_size / 10.0 as score, p_size::bigint as ratings, regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g') as slug
from part
""")
def catalog_texts(spark, sf):
    """Publisher prefixes, partial dates, production, ratings and slugs of texts made from parts."""
    k, size = F.col("p_partkey"), F.col("p_size")
    year = F.lit(1900) + k % 100
    date = F.concat(F.initcap(F.get(F.array(*map(F.lit, parse.MONTH_NAMES)), (k % 12).cast("int"))), F.when(k % 3 == 0, F.concat(F.lit(" "), k % 28 + 1, F.lit(", "))).otherwise(", "), year)
    d = parse.partial_date(F.when(k % 3 == 2, year.cast("string")).otherwise(date))
    made = parse.production(F.concat(F.format_number(size * 1000, 0), F.lit(" units (confirmed)")))
    rated = parse.rating(F.concat(F.lit("Average rating: "), F.format_number(size / 10, 1), F.lit("/10 ("), size, F.lit(" ratings/1 comment)")))
    name = F.when(k % 2 == 0, F.concat(F.lit("Acme_"), F.split_part("p_name", F.lit(" "), F.lit(1)), F.lit("_1979_manual.pdf"))).otherwise(F.lit("1979_manual.pdf"))
    rows = table(spark, sf, "part").select("p_partkey", parse.publisher_prefix(name).alias("publisher"), d.alias("d"), made.alias("m"), rated.alias("r"), parse.slug(F.col("p_name")).alias("slug"))
    return rows.select("p_partkey", "publisher", "d.year", "d.month", "d.day", "d.precision", "m.units", "r.score", "r.ratings", "slug")


@query("""
select p_partkey, p_brand as maker, case when p_partkey % 2 = 0 then (1950 + p_partkey % 50)::int end as year, p_name as title, p_type as field, list_sort(['b ' || p_size, 'c ' || p_brand]) as aliases, [p_name] as see_also from part
""")
def wiki_texts(spark, sf):
    """Game references, infobox fields, aliases and see-also targets of texts made from parts."""
    k = F.col("p_partkey")
    ref = F.concat("p_brand", F.lit("’s "), F.when(k % 2 == 0, F.concat(F.lit(1950) + k % 50, F.lit(" "))).otherwise(""), F.lit("‘"), "p_name", F.lit("’"))
    wiki = F.concat(F.lit("{{Box\n| type = [[x|"), "p_type", F.lit("]]\n| other = 1\n}}"))
    gloss = F.concat(F.lit("A thing. Also called c "), "p_brand", F.lit(". Also known as b "), "p_size", F.lit(". See also "), "p_name", F.lit("."))
    g = parse.game_reference(ref)
    return table(spark, sf, "part").select("p_partkey", g["maker"].alias("maker"), g["year"].alias("year"), g["title"].alias("title"), parse.infobox(wiki, "type").alias("field"), parse.aliases_of(gloss).alias("aliases"), parse.see_also(gloss).alias("see_also"))


@query("""
with t as (select lower(p_name) as slug, max('see ' || lower(p_brand)) as text from part group by lower(p_name)), b as (select distinct lower(p_brand) as slug from part)
select t.slug, b.slug as target from t join b on t.text = 'see ' || b.slug
""")
def see_also_backfill(spark, sf):
    """A see-also name becomes a link where a glossary entry has its slug."""
    entries = table(spark, sf, "part").groupBy(F.lower("p_name").alias("slug")).agg(F.max(F.concat(F.lit("See "), F.lower("p_brand"))).alias("text"))
    known = table(spark, sf, "part").select(parse.slug(F.col("p_brand")).alias("_slug"), F.lower("p_brand").alias("target")).distinct()
    named = entries.select("slug", F.explode(parse.see_also(F.col("text"))).alias("name"))
    return named.join(known, parse.slug(F.col("name")) == F.col("_slug")).select("slug", "target")


@query("""
select event_id, case when event_id % 3 <> 0 and (event_id % 5 = 0 or event_id % 7 = 0) then 'stored' else 'new' end as text, value > 90 and value is not null as thin_or_newer,
  case when event_id % 4 = 0 then event_type else 'old' end as ocr_text, case when event_id % 6 <> 0 then 'body' end as moved_text, case when event_id % 6 = 0 then 'body' end as moved_ocr from events
""")
def capture_updates(spark, sf):
    """Re-extraction keeps what it must, a newer capture wins, OCR goes in by address and content, and old rows move their text."""
    k = F.col("event_id")
    rows = table(spark, sf, "events").select("event_id", "value", "event_type", F.concat(F.lit("u"), k).alias("url"), F.md5("event_type").alias("content_sha"), F.lit("old").alias("ocr_text"))
    results = rows.select("url", F.when(k % 4 == 0, F.col("content_sha")).otherwise(F.lit("other")).alias("content_sha"), F.col("event_type").alias("ocr_text"))
    written = records.guarded_ocr_write(rows, results)
    moved = records.migrated(rows.select("event_id", F.lit("body").alias("text"), F.lit(None).cast("string").alias("ocr_text"), F.when(k % 6 == 0, "ocr").otherwise("html").alias("text_source")))
    text = captures.resolved_text(k % 3 == 0, F.when(k % 5 == 0, "manual").otherwise("html"), k % 7 == 0, F.lit("stored"), F.lit("new"))
    newer = captures.is_newer_capture(F.col("value"), F.lit(90.0))
    return written.join(moved.select("event_id", F.col("text").alias("moved_text"), F.col("ocr_text").alias("moved_ocr")), "event_id").select("event_id", text.alias("text"), newer.alias("thin_or_newer"), "ocr_text", "moved_text", "moved_ocr")


@query("""
select 'https://h.org/' || user_id as url, case when count(*) filter (where value <= 80) > 0 then 'found' else 'refused' end as outcome, min(strftime(ts, '%Y%m%d%H%M%S')) filter (where value <= 80) as timestamp from events group by user_id
""")
def oldest_captures(spark, sf):
    """The oldest capture of every address under a prefix; a refused lookup is no negative."""
    rows = table(spark, sf, "events").select(F.concat(F.lit("https://h.org/"), "user_id", F.lit("?utm_source=x")).alias("original"), F.date_format("ts", "yyyyMMddHHmmss").alias("timestamp"), (F.col("value") > 80).alias("refused"))
    return records.oldest_captures(rows, "https://h.org/").select("url", "outcome", "timestamp")


@query("""
select doc_id, case when doc_id % 4 = 0 then 'https://a.org/' || doc_id when doc_id % 4 = 1 then 'http://b.org/x' else 'https://b.org/x' end as base from documents
""")
def resolution_base(spark, sf):
    """What relative links of a stored page resolve against: the archived origin, the raw address, or the key."""
    k = F.col("doc_id")
    own = F.when(k % 4 == 0, F.concat(F.lit("https://a.org/"), k)).otherwise(F.lit("https://b.org/x"))
    raw = F.when(k % 4 == 0, F.concat(F.lit("https://web.archive.org/web/20110203040506/http://a.org/"), k)).when(k % 4 == 1, "http://b.org/x").when(k % 4 == 2, "https://moved.org/y").otherwise(F.lit(None))
    return table(spark, sf, "documents").select("doc_id", urls.resolution_base(own, raw).alias("base"))


@query(f"with {_OWNED} select case when document_id % 10 = 1 then document_id - 1 else document_id end as document_id, url from owned")
def merge_children(spark, sf):
    """Addresses of merged documents go to the survivor."""
    owned = _owned(spark, sf)
    pairs = owned.where("document_id % 10 = 1").select(F.col("document_id").alias("loser"), (F.col("document_id") - 1).alias("survivor"))
    return library.move_children(owned, library.merge_map(pairs))
