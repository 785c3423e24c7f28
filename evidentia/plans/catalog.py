"""Catalog queries: reconciliation, parsing, classification, checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.functions import parse
from evidentia.operators import checks as q
from evidentia.operators import classify, reconcile
from evidentia.plans import table
from evidentia.sources.readers import watermarks

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@query("""
select event_id, user_id, event_type, value, ts < (select max(ts) from events) as carried_forward
from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1
""")
def latest_wins(spark: SparkSession, sf: str) -> DataFrame:
    """Newest record per entity, whole, with carried_forward."""
    won = reconcile.latest_wins(table(spark, sf, "events"), ["user_id"], "ts", [F.desc("event_id")])
    return won.select("event_id", "user_id", "event_type", "value", "carried_forward")


@query("""
select o_orderkey, o_custkey, o_orderstatus from orders o
where not exists (select 1 from customer c where c.c_custkey = o.o_custkey and c.c_acctbal < 0)
""")
def retraction_anti(spark, sf):
    """Records whose key is on the retracted list go."""
    retracted = table(spark, sf, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return table(spark, sf, "orders").join(retracted, "o_custkey", "left_anti").select("o_orderkey", "o_custkey", "o_orderstatus")


@query("select doc_id, lang, source, n_chars from documents d where exists (select 1 from labels l where l.doc_id = d.doc_id)")
def restrict_semi(spark, sf):
    """The secondary source keeps only ids that the authoritative one lists."""
    return table(spark, sf, "documents").join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi").select("doc_id", "lang", "source", "n_chars")


@query("""
select o_orderkey, c_mktsegment, n_name, r_name from orders left join customer on c_custkey = o_custkey
left join nation on n_nationkey = c_nationkey left join region on r_regionkey = n_regionkey
""")
def enrich_no_fanout(spark, sf):
    """A chain of lookups that keeps the row count."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment")
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    r = table(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    base = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return reconcile.enrich_one_to_one(base, [(c, ["o_custkey"]), (n, ["c_nationkey"]), (r, ["n_regionkey"])]).select("o_orderkey", "c_mktsegment", "n_name", "r_name")


@query("""
select d.doc_id, coalesce(case when n_chars >= 1000 then n_chars end, l.quality) as filled,
  case when n_chars >= 1000 then 'documents' when l.quality is not null then 'labels' end as filled_src,
  case when l.quality is null then null when toxic = 1 then 'manufacture' when n_chars > 2000 then 'project' else 'project_inferred' end as kind
from documents d left join labels l on l.doc_id = d.doc_id
""")
def gap_fill_provenance(spark, sf):
    """Primary value, else secondary, with its source; and an ordered-evidence kind."""
    d = table(spark, sf, "documents").select("doc_id", "n_chars").join(table(spark, sf, "labels"), "doc_id", "left")
    filled, src = reconcile.gap_fill(F.when(F.col("n_chars") >= 1000, F.col("n_chars")), F.col("quality").cast("long"), ("documents", "labels"))
    kind = F.when(F.col("quality").isNull(), F.lit(None)).when(F.col("toxic") == 1, "manufacture").when(F.col("n_chars") > 2000, "project").otherwise("project_inferred")
    return d.select("doc_id", filled.alias("filled"), src.alias("filled_src"), kind.alias("kind"))


@query("""
select c_custkey, case when c_mktsegment in ('BUILDING', 'HOUSEHOLD') then null else c_mktsegment end as segment from customer
where lower(c_name) not in ('unknown', 'n/a') and c_name not ilike '%undisclosed%'
""")
def sentinel_to_null(spark, sf):
    rows = table(spark, sf, "customer").where(parse.is_person(F.col("c_name")))
    return rows.select("c_custkey", reconcile.sentinel_to_null(F.col("c_mktsegment"), ["BUILDING", "HOUSEHOLD"]).alias("segment"))


_HEADER = """case o_orderkey % 5
  when 0 then 'Cat No. ' || o_orderkey || ' / ' || strftime(o_orderdate, '%B %-d, %Y') || ' / ' || (o_orderkey % 4 + 1) || ' Players'
  when 1 then 'Cat No. ' || o_orderkey || ' / ' || strftime(o_orderdate, '%B, %Y') || ' / 1 Player'
  when 2 then 'Cat No. ' || o_orderkey || ' / ' || strftime(o_orderdate, '%Y')
  when 3 then 'Cat No. ' || o_orderkey
  else 'Cat No ' || o_orderkey || ' / soon' end"""


@query(rf"""
with h as (select o_orderkey, {_HEADER} as t from orders),
g as (select o_orderkey, regexp_extract(t, '^Cat No\. (\d+)(?: / ([A-Za-z]+ \d{{1,2}}, \d{{4}}|[A-Za-z]+, \d{{4}}|\d{{4}}))?(?: / (\d+) Players?)?$', ['a', 'b', 'c']) as g from h),
d as (select *, nullif(g.b, '') as date_text, try_strptime(nullif(g.b, ''), '%B %d, %Y') as d1, try_strptime(nullif(g.b, ''), '%B, %Y') as d2, try_strptime(nullif(g.b, ''), '%Y') as d3 from g)
select o_orderkey, try_cast(nullif(g.a, '') as integer) as number, try_cast(nullif(g.c, '') as smallint) as players, date_text,
  year(coalesce(d1, d2, d3))::smallint as "year", month(coalesce(d1, d2))::smallint as "month", day(d1)::smallint as "day" from d
""")
def header_grammar(spark, sf):
    """Header lines made from orders, parsed to typed parts; anything off the grammar stays unparsed."""
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    head = F.concat(F.lit("Cat No. "), key)
    dated = lambda f: F.concat(head, F.lit(" / "), F.date_format(day, f))
    text = (
        F.when(key % 5 == 0, F.concat(dated("MMMM d, yyyy"), F.lit(" / "), key % 4 + 1, F.lit(" Players")))
        .when(key % 5 == 1, F.concat(dated("MMMM, yyyy"), F.lit(" / 1 Player")))
        .when(key % 5 == 2, dated("yyyy")).when(key % 5 == 3, head).otherwise(F.concat(F.lit("Cat No "), key, F.lit(" / soon")))
    )
    return table(spark, sf, "orders").select("o_orderkey", parse.header_line(text, r"Cat No\.").alias("h")).select("o_orderkey", "h.*")


@query("""
with s as (select s_suppkey, s_suppkey % 8 as f, 'Maker ' || s_suppkey as m, '19' || lpad((s_suppkey % 100)::varchar, 2, '0') as y from supplier),
p as (select s_suppkey, m || case f when 2 then '-Co' when 4 then ' (Europe)' when 5 then ' (East) (Ltd.)' when 6 then '. Bros.' when 7 then ' & (Sons)' else '' end as company_name, case f when 1 then 'Brand ' || s_suppkey when 5 then 'B-' || s_suppkey end as trade_name,
  case f when 0 then 'Town, State' when 2 then 'Ville' when 6 then 'St. Paul (Minn.)' end as place, case when f in (0, 4, 5) then y::int end as year_start, case when f in (0, 4) then 1999 end as year_end,
  case f when 1 then 1971 when 6 then 1971 when 7 then y::int end as single_year from s)
select s_suppkey, company_name, trade_name, coalesce(trade_name, company_name) as brand, place, year_start, year_end, single_year,
  (select min(year(l_shipdate)) from lineitem l where l.l_suppkey = p.s_suppkey)::int as first_year, (select max(year(l_shipdate)) from lineitem l where l.l_suppkey = p.s_suppkey)::int as last_year from p
""")
def company_parse(spark, sf):
    """Company strings made from suppliers, parsed once per distinct spelling; with the first and last year of what they shipped."""
    k, year = F.col("s_suppkey"), F.concat(F.lit("19"), F.lpad((F.col("s_suppkey") % 100).cast("string"), 2, "0"))
    forms = [
        F.concat(F.lit(", of Town, State ("), year, F.lit("-1999)")),
        F.concat(F.lit(" (1971) [Trade Name: Brand "), k, F.lit("]")),
        F.lit("-Co, of Ville (1980)"),
        F.lit(","),
        F.concat(F.lit(" (Europe) ("), year, F.lit("-1999)")),
        F.concat(F.lit(" (East) (Ltd.) ("), year, F.lit("-now) [Trade Name: B-"), k, F.lit("]")),
        F.lit(". Bros., of St. Paul (Minn.), (1971)"),
        F.concat(F.lit(" & (Sons) ("), year, F.lit(")")),
    ]
    tail = F.lit(None).cast("string")
    for n, form in enumerate(forms):
        tail = F.when(k % 8 == n, form).otherwise(tail)
    years = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.min(F.year("l_shipdate")).alias("first_year"), F.max(F.year("l_shipdate")).alias("last_year"))
    named = table(spark, sf, "supplier").select("s_suppkey", F.concat(F.lit("Maker "), k, tail).alias("text"))
    parsed = named.select("text").distinct().select("text", parse.company(F.col("text")).alias("c"))
    return named.join(parsed, "text").join(years, "s_suppkey", "left").select("s_suppkey", "c.*", "first_year", "last_year")


@query("select event_id, user_id, cast(json_extract(props, '$.k') as bigint) as k from events where cast(json_extract(props, '$.k') as bigint) is not null")
def props_flatten(spark, sf):
    parsed = table(spark, sf, "events").select("event_id", "user_id", F.from_json("props", "k long").alias("p"))
    return parsed.where("p.k is not null").select("event_id", "user_id", "p.k")


@query("select p_partkey, unnest(string_split(p_name, ' ')) as keyword from part")
def keyword_explode(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.explode(F.split("p_name", " ")).alias("keyword"))


@query("""
with c as (select o_orderkey, 'status' as role, o_orderstatus as names from orders union all select o_orderkey, 'priority', replace(o_orderpriority, '-', ',') from orders),
s as (select o_orderkey, role, trim(unnest(string_split(names, ','))) as person from c)
select * from s where lower(person) not in ('(undisclosed)', 'undisclosed', 'unknown', 'missing', 'null', 'undefined', 'n/a', 'none', 'tbd', 'tba', '?', '') and person not ilike '%(undisclosed)%' and person not ilike '%unknown%'
""")
def credits_stack(spark, sf):
    """Role columns of comma-separated names to one row per person, in one pass over the table."""
    roles = F.array(F.struct(F.lit("status").alias("role"), F.col("o_orderstatus").alias("names")), F.struct(F.lit("priority").alias("role"), F.replace("o_orderpriority", F.lit("-"), F.lit(",")).alias("names")))
    stacked = table(spark, sf, "orders").select("o_orderkey", F.inline(roles)).select("o_orderkey", "role", F.explode(parse.people(F.col("names"))).alias("person"))
    return stacked.where(parse.is_person(F.col("person")))


#: A small vocabulary over part names and document texts: class, pattern, needed literals, containers, denial.
PATTERNS = [
    ("article_the", r"(?<![0-9A-Za-z_])the(?![0-9A-Za-z_])", ["the"], None, None),
    ("ends_ing", r"[a-z]ing(?![0-9A-Za-z_])", ["ing"], None, None),
    ("license", r"(?i)released under .{1,20} license", ["license"], None, None),
    ("umlaut", r"[äöüß]", None, None, r"[éèê]"),
    ("accent", r"[éèêçñóí]", None, None, None),
]
EDGES = [("article_the", "english"), ("ends_ing", "english"), ("english", "prose"), ("umlaut", "german"), ("german", "prose"), ("accent", "romance"), ("romance", "prose"), ("license", "legal")]
_EDGES_SQL = "(values " + ", ".join(f"('{a}', '{b}')" for a, b in EDGES) + ") as e(child, parent)"
_CLASSIFIED = r"""
  select doc_id, 'article_the' as document_class from documents where regexp_matches(text, '(?:^|[^0-9A-Za-z_])the(?:[^0-9A-Za-z_]|$)')
  union all select doc_id, 'ends_ing' from documents where regexp_matches(text, '[a-z]ing(?:[^0-9A-Za-z_]|$)')
  union all select doc_id, 'license' from documents where regexp_matches(text, '(?i)released under .{1,20} license')
  union all select doc_id, 'umlaut' from documents where regexp_matches(text, '[äöüß]') and not regexp_matches(text, '[éèê]')
  union all select doc_id, 'accent' from documents where regexp_matches(text, '[éèêçñóí]')"""


def _classified(spark, sf):
    return classify.classify(table(spark, sf, "documents").select("doc_id", "text"), PATTERNS, "text").select("doc_id", "document_class")


@query(_CLASSIFIED)
def pattern_classify(spark, sf):
    return _classified(spark, sf)


def _edges(spark):
    return spark.createDataFrame(EDGES, "child string, parent string")


@query(f"""
with recursive c(child, ancestor) as (select child, parent from {_EDGES_SQL} union select c.child, e.parent from c join {_EDGES_SQL} on e.child = c.ancestor),
m as ({_CLASSIFIED})
select child, ancestor, (select count(*) from m where m.document_class = c.child) as n_documents from c
""")
def class_closure(spark, sf):
    """Every class with each of its ancestors, and how many documents carry it."""
    counts = _classified(spark, sf).groupBy(F.col("document_class").alias("child")).agg(F.count("*").alias("n"))
    closed = classify.closure(_edges(spark))
    return closed.join(counts, "child", "left").select("child", "ancestor", F.coalesce("n", F.lit(0)).alias("n_documents"))


@query(f"""
with recursive c(child, ancestor) as (select child, parent from {_EDGES_SQL} union select c.child, e.parent from c join {_EDGES_SQL} on e.child = c.ancestor),
m as ({_CLASSIFIED}),
b as (select doc_id, document_class, false as inherited from m union all select m.doc_id, c.ancestor, true from m join c on c.child = m.document_class)
select doc_id, coalesce(array_to_string(list_sort(list_distinct(list(document_class) filter (where not inherited))), ','), '') as class_matches,
  array_to_string(list_sort(list_distinct(list(document_class))), ',') as class_rolled_up from b group by doc_id
""")
def class_rollup(spark, sf):
    """Literal classes, and classes with their ancestors, per document."""
    listed = table(spark, sf, "documents").select("doc_id", classify.class_list(PATTERNS, "text").alias("own")).where("size(own) > 0")
    return listed.select("doc_id", F.array_join("own", ",").alias("class_matches"), F.array_join(classify.rolled_up("own", classify.closed(EDGES)), ",").alias("class_rolled_up"))


@query("""
select l_partkey, count(distinct l_orderkey) as models, count(distinct l_suppkey) as makers,
  case when count(distinct case when l_returnflag = 'R' then null else l_linenumber end) > 0 and count(distinct case when l_returnflag <> 'R' then null else l_orderkey end) = 0 then count(distinct l_linenumber) end as platforms,
  case when count(distinct l_orderkey) = 0 then null when count(distinct l_suppkey) > 1 then 'multi_manufacturer' when count(distinct l_orderkey) > 1 then 'multi_model' else 'single_model' end as subject_scope
from lineitem group by l_partkey
""")
def identity_scope(spark, sf):
    """Subject widths per identity, a guarded count, and the scope they imply."""
    value = F.when(F.col("l_returnflag") != "R", F.col("l_linenumber"))
    counted = table(spark, sf, "lineitem").groupBy("l_partkey").agg(
        F.count_distinct("l_orderkey").alias("models"), F.count_distinct("l_suppkey").alias("makers"), classify.guarded_distinct(value, F.col("l_orderkey")).alias("platforms")
    )
    return counted.withColumn("subject_scope", classify.subject_scope(F.col("models"), F.col("makers")))


@query("""
with p as (select p_partkey, p_brand, p_partkey % 13 as f, case p_partkey % 13 when 1 then 'GB' when 5 then 'GB' when 2 then 'ES' when 6 then 'ES' else 'US' end as jurisdiction, p_partkey % 13 in (0, 3, 4, 11) as is_design, p_name from part),
n as (select *, case f when 0 then 'D' || (p_partkey + 100000) when 1 then '1' || (p_partkey % 900 + 100) || '123' when 2 then '' || (p_partkey % 50 + 70000) when 3 then 'D96384' when 4 then 'D' || (p_partkey % 1000 + 89000)
    when 5 then '' || (p_partkey % 90 + 1234500) when 6 then '' || (p_partkey % 50 + 70000) when 7 then '' || (p_partkey % 70 + 1925000) when 8 then '3' || (p_partkey % 900 + 100) || '888.' when 9 then '3404' || (p_partkey % 900 + 100)
    when 10 then '' || (p_partkey % 70 + 1925000) when 11 then 'D87' || (p_partkey % 900 + 100) end as number, case f when 0 then p_name when 10 then 'BALL GAME' end as title from p),
s as (select jurisdiction, number, count(distinct p_partkey) as models, count(distinct p_brand) as makers from n where number is not null group by all)
select p_partkey, n.jurisdiction, is_design, n.number, title, models, makers, case when models is null then null when makers > 1 then 'multi_manufacturer' when models > 1 then 'multi_model' else 'single_model' end as subject_scope
from n left join s on s.jurisdiction = n.jurisdiction and s.number = n.number
""")
def patents(spark, sf):
    """Patent names made from parts, parsed once per distinct name, with the scope of each patent."""
    k = F.col("p_partkey")
    three = F.lpad((k % 900 + 100).cast("string"), 3, "0")
    forms = [
        F.concat(F.lit("US Design Patent "), k + 100000, F.lit(" ["), "p_name", F.lit("]")),
        F.concat(F.lit("U.K. Patent 1,"), three, F.lit(",123")),
        F.concat(F.lit("Spanish Patent "), k % 50 + 70000),
        F.lit("Patent No. D96,384"),
        F.concat(F.lit("Drawing D"), k % 1000 + 89000),
        F.concat(F.lit("GB"), k % 90 + 1234500),
        F.concat(F.lit("Patente de invencion #"), k % 50 + 70000),
        F.concat(F.lit("US"), k % 70 + 1925000, F.lit("_pdf")),
        F.concat(F.lit("Patent_3,"), three, F.lit(",888.pdf")),
        F.concat(F.lit("Patent-3404"), three),
        F.concat(F.lit("Patent (#"), k % 70 + 1925000, F.lit(") [BALL GAME]")),
        F.concat(F.lit("Patent D87,"), three),
    ]
    name = F.lit("Zipper patent drawing")
    for n, form in enumerate(forms):
        name = F.when(k % 13 == n, form).otherwise(name)
    named = table(spark, sf, "part").select("p_partkey", "p_brand", name.alias("name"))
    parsed = named.select("p_partkey", "p_brand", parse.patent(F.col("name")).alias("p")).select("p_partkey", "p_brand", "p.*")
    scope = parsed.where("number is not null").groupBy("jurisdiction", "number").agg(F.count_distinct("p_partkey").alias("models"), F.count_distinct("p_brand").alias("makers"))
    return parsed.join(scope, ["jurisdiction", "number"], "left").select("p_partkey", "jurisdiction", "is_design", "number", "title", "models", "makers", classify.subject_scope(F.col("models"), F.col("makers")).alias("subject_scope"))


@query("""
with a as (select p_partkey, p_partkey % 8 as f, p_size as z, case p_partkey % 8 when 0 then p_type when 1 then p_brand when 3 then 'Coin_Slot' when 6 then 'T.N.T. - Amusements' end as publication, p_type, p_brand from part),
b as (select p_partkey, publication, case f when 0 then z || '-' || (z + 2) when 2 then z || '-' || (z + 2) when 3 then z::varchar when 7 then z || ', ' || (z + 1) end as pages,
  case f when 0 then 'Mar ''7' || (p_partkey % 10) when 1 then 'June 1985' when 3 then 'March 19' || (70 + p_partkey % 10) when 4 then 'Mar.1975' when 6 then 'Sept-92' when 7 then 'Dec, 1961' end as issue_date,
  case f when 0 then p_type || z || '/' || (p_partkey % 10) when 1 then p_brand when 2 then z::varchar when 3 then z || '/' || (p_partkey % 10) when 7 then z::varchar else '' end as name, f from a)
select p_partkey, publication, pages, issue_date, count(*) over (partition by f, name) as referencing from b
""")
def trade_articles(spark, sf):
    """Article names made from parts, parsed; an article is its display name."""
    k = F.col("p_partkey")
    name = (
        F.when(k % 8 == 0, F.concat("p_type", F.lit(" Magazine Article, pages "), "p_size", F.lit("-"), F.col("p_size") + 2, F.lit(", Mar '7"), k % 10))
        .when(k % 8 == 1, F.concat("p_brand", F.lit(" Ad, June 1985")))
        .when(k % 8 == 2, F.concat(F.lit("Factory Tour (Coin Slot, Spring 1992, pages "), "p_size", F.lit("-"), F.col("p_size") + 2, F.lit(")")))
        .when(k % 8 == 3, F.concat(F.lit("Coin_Slot Article (March 19"), k % 10 + 70, F.lit("), page "), "p_size", F.lit(".")))
        .when(k % 8 == 4, F.lit("Ad Mar.1975"))
        .when(k % 8 == 6, F.lit("T.N.T. - Amusements Article [Sept-92]"))
        .when(k % 8 == 7, F.concat(F.lit("Loose (page "), "p_size", F.lit(", "), F.col("p_size") + 1, F.lit("; Dec, 1961)")))
        .otherwise(F.lit("Adverse notes, loose"))
    )
    rows = table(spark, sf, "part").select("p_partkey", name.alias("name"))
    counts = rows.groupBy("name").agg(F.count("*").alias("referencing"))
    return rows.join(counts, "name").select("p_partkey", parse.article(F.col("name")).alias("a"), "referencing").select("p_partkey", "a.*", "referencing")


@query(r"""
with w as (select lang, unnest(regexp_extract_all(lower(text), '[a-z]+')) as word from documents)
select word, max((lang = 'en')::int) as in_en, max((lang = 'fr')::int) as in_fr, max((lang = 'de')::int) as in_de, max((lang = 'en')::int) + max((lang = 'fr')::int) + max((lang = 'de')::int) as n_sources
from w where lang in ('en', 'fr', 'de') group by word
""")
def presence_matrix(spark, sf):
    """Which language's documents hold each word."""
    words = table(spark, sf, "documents").where("lang in ('en', 'fr', 'de')").select("lang", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0)))).alias("word"))
    return reconcile.tagged_presence(words, "word", "lang", ["en", "fr", "de"])


def _checks(spark, sf):
    o, c, d, l = (table(spark, sf, t) for t in ("orders", "customer", "documents", "labels"))
    return [
        q.Check("order_missing_id", "identity", "error", q.null_key(o, "o_orderkey", "o_custkey")),
        q.Check("document_text_repeated", "identity", "error", q.not_unique(d.select(F.md5("text").alias("h")), ["h"])),
        q.Check("label_orphan", "reference", "error", q.orphans(l, "doc_id", d, "doc_id")),
        q.Check("order_without_customer", "reference", "error", q.orphans(o, "o_custkey", c.where("c_mktsegment <> 'MACHINERY'"), "c_custkey")),
        q.Check("language_outside_domain", "domain", "error", q.outside_domain(d, "lang", ["en", "fr", "de"])),
        q.Check("text_ambiguous_language", "identity", "warning", q.ambiguous(d.select(F.md5("text").alias("h"), "lang"), "h", "lang")),
        q.Check("customer_in_debt", "value", "warning", c.where("c_acctbal < 0").select(F.col("c_custkey").alias("detail"))),
        q.Check("toxic_but_good", "value", "warning", l.where("toxic = 1 and quality = 1").select(F.col("doc_id").alias("detail"))),
    ]


@query("""
select 'identity' as category, 'order_missing_id' as check_name, o_custkey::varchar as detail from orders where o_orderkey is null
union all select 'identity', 'document_text_repeated', md5(text) from documents group by text having count(*) > 1
union all select 'reference', 'label_orphan', doc_id::varchar from labels where doc_id not in (select doc_id from documents)
union all select 'reference', 'order_without_customer', o_custkey::varchar from orders where not exists (select 1 from customer where c_custkey = o_custkey and c_mktsegment <> 'MACHINERY')
union all select 'domain', 'language_outside_domain', lang from documents where lang not in ('en', 'fr', 'de')
""")
def check_report(spark, sf):
    """All error checks as one plan."""
    return q.violations(_checks(spark, sf))


@query("""
select 'text_ambiguous_language' as check_name, count(*) as cnt from (select text from documents group by text having count(distinct lang) > 1) having count(*) > 0
union all select 'customer_in_debt', count(*) from customer where c_acctbal < 0 having count(*) > 0
union all select 'toxic_but_good', count(*) from labels where toxic = 1 and quality = 1 having count(*) > 0
""")
def warning_report(spark, sf):
    return q.warning_counts(_checks(spark, sf))


@query("""
select 'events' as artefact, count(*) as n_records, strftime(max(ts), '%Y-%m-%d %H:%M:%S') as observed_at from events
union all select 'orders', count(*), strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') from orders
union all select 'lineitem', count(*), strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S') from lineitem
union all select 'documents', count(*), null from documents union all select 'pages', count(*), null from pages
""")
def ingest_watermarks(spark, sf):
    names = ["events", "orders", "lineitem", "documents", "pages"]
    return watermarks({n: table(spark, sf, n) for n in names}, {"events": "ts", "orders": "o_orderdate", "lineitem": "l_shipdate"})


@query("""
with l as (select doc_id::varchar as path, length(text)::bigint as size, md5(text) as sha256 from documents where doc_id % 7 <> 0),
r as (select doc_id::varchar as path, (length(text) + case when doc_id % 11 = 0 then 1 else 0 end)::bigint as size from documents where doc_id % 5 <> 0),
m as (select doc_id::varchar as path, case when doc_id % 13 = 0 then 'x' else md5(text) end as sha256 from documents where doc_id % 3 <> 0)
select coalesce(l.path, r.path) as path, case when l.path is null then 'orphan' when r.path is null then 'new' when l.size <> r.size then 'size differs' when m.path is null then 'not in manifest' when l.sha256 <> m.sha256 then 'content differs' else 'unchanged' end as reason
from l full join r on l.path = r.path left join m on m.path = coalesce(l.path, r.path) where not (l.path is null and m.path is null)
""")
def manifest_diff(spark, sf):
    """Sync plan between local files, a listing and a manifest, all derived from documents."""
    d = table(spark, sf, "documents").select("doc_id", F.col("doc_id").cast("string").alias("path"), F.length("text").cast("long").alias("size"), F.md5("text").alias("sha256"))
    listing = d.where("doc_id % 5 <> 0").select("path", (F.col("size") + F.when(F.col("doc_id") % 11 == 0, 1).otherwise(0)).alias("size"))
    known = d.where("doc_id % 3 <> 0").select("path", F.when(F.col("doc_id") % 13 == 0, "x").otherwise(F.col("sha256")).alias("sha256"))
    return reconcile.manifest_diff(d.where("doc_id % 7 <> 0").select("path", "size", "sha256"), listing, known)


@query("""
select conv_id, turn, role from conversations qualify row_number() over (partition by conv_id order by case role when 'assistant' then 0 when 'user' then 1 else 2 end, length(text) desc, turn) = 1
""")
def ranked_choice(spark, sf):
    """One row per conversation by ranked preference."""
    rank = F.when(F.col("role") == "assistant", 0).when(F.col("role") == "user", 1).otherwise(2)
    return reconcile.ranked_choice(table(spark, sf, "conversations"), ["conv_id"], [rank, F.length("text").desc(), F.col("turn")]).select("conv_id", "turn", "role")


@query("select c_custkey, c_nationkey, c_mktsegment, count(*) over () as n_total from customer order by c_acctbal desc, c_custkey limit 50")
def top_with_total(spark, sf):
    """A limited report that still says how many there were; the count is a one-row aggregate, no window over all rows."""
    c = table(spark, sf, "customer")
    total = c.agg(F.count("*").alias("n_total"))
    return c.orderBy(F.desc("c_acctbal"), "c_custkey").limit(50).select("c_custkey", "c_nationkey", "c_mktsegment").crossJoin(F.broadcast(total))


@query("""
with k as (select s_nationkey as nation from supplier union select c_nationkey from customer)
select nation, (select count(*) from supplier where s_nationkey = nation) as suppliers, nation in (select c_nationkey from customer) as has_customers from k
""")
def key_union(spark, sf):
    """Set union of keys with guarded counts."""
    s = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"), F.lit(1).alias("s"), F.lit(0).alias("c"))
    c = table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation"), F.lit(0).alias("s"), F.lit(1).alias("c"))
    return s.unionByName(c).groupBy("nation").agg(F.sum("s").alias("suppliers"), (F.max("c") == 1).alias("has_customers"))
