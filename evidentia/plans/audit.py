"""Data-quality reports: every check of one severity in one plan, over relations made from the tables.

Keys with a given remainder carry a planted fault, so each check has rows to find at every size.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from evidentia.functions import parse
from evidentia.operators import checks as q
from evidentia.operators import reconcile
from evidentia.operators.checks import Check, violations
from evidentia.plans import table

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _models(spark, sf):
    """Catalog records: a header line beside typed columns."""
    k = F.col("o_orderkey")
    players = (k % 4 + 1).cast("int")
    date = F.when(k % 79 == 0, F.lit("Smarch, 1999")).when(k % 3 == 0, F.date_format("o_orderdate", "MMMM, yyyy")).otherwise(F.date_format("o_orderdate", "MMMM d, yyyy"))
    header = F.when(k % 83 == 0, F.concat(F.lit("Catalogue "), k)).otherwise(F.concat(F.lit("Cat No. "), k + (k % 89 == 0).cast("int"), F.lit(" / "), date, F.lit(" / "), players, F.when(players == 1, " Player").otherwise(" Players")))
    rows = table(spark, sf, "orders").select("o_orderkey", F.when(k % 97 != 0, k).alias("id"), players.alias("players"), "o_custkey", parse.header_line(header, r"Cat No\.").alias("h"))
    return rows.select("o_orderkey", "id", "players", "o_custkey", "h.number", F.col("h.players").alias("h_players"), "h.date_text", "h.year", "h.month", "h.day")


#: What a model's header says, told by its key alone.
_M = """m as (select o_orderkey as k, case when o_orderkey % 97 <> 0 then o_orderkey end as id, o_custkey,
  o_orderkey % 83 <> 0 as parsed, o_orderkey % 89 = 0 and o_orderkey % 83 <> 0 as off, o_orderkey % 79 = 0 and o_orderkey % 83 <> 0 as odd_date, o_orderkey % 3 = 0 and o_orderkey % 79 <> 0 and o_orderkey % 83 <> 0 as month_only from orders)"""

ROLES = ["DesignBy", "ArtBy"]
RULES = ["click", "view"]


def _credits(spark, sf):
    return table(spark, sf, "part").select(F.col("p_name").alias("DesignBy"), F.col("p_brand").alias("ArtBy"), F.col("p_type").alias("WhistleBy"), F.col("p_size").alias("SpecialSize"), F.col("p_partkey").alias("part_id"))


def _parents(spark, sf):
    """Child and parent classes; some name what no vocabulary has."""
    k = F.col("n_nationkey")
    return table(spark, sf, "nation").select((k + F.when(k % 11 == 0, 100).otherwise(0)).alias("child"), (F.col("n_regionkey") + F.when(k % 7 == 0, 100).otherwise(0)).alias("parent"))


@query(f"""
with {_M},
t as (select k, id from m union all select k, id from m where k % 71 = 0),
pa as (select n_nationkey + case when n_nationkey % 11 = 0 then 100 else 0 end as child, n_regionkey + case when n_nationkey % 7 = 0 then 100 else 0 end as parent from nation),
ty as (select distinct p_type from part)
select 'catalog' as category, 'record_missing_id' as check_name, k::varchar as detail from m where id is null
union all select 'secondary', 'record_missing_id', p_partkey::varchar from part where p_partkey % 53 = 0
union all select 'catalog', 'header_misaligned', k::varchar from m where off
union all select 'catalog', 'staged_not_unique', id::varchar from t where id is not null group by id having count(*) > 1
union all select 'catalog', 'staged_drops_rows', (select count(*) from orders) || ' <> ' || (select count(*) from m where id is not null) where (select count(*) from m where id is null) > 0
union all select 'catalog', 'credit_role_unclaimed', column_name from (describe select p_name as "DesignBy", p_brand as "ArtBy", p_type as "WhistleBy", p_size as "SpecialSize", p_partkey as part_id from part) where column_name like '%By' and column_name not in ('DesignBy', 'ArtBy')
union all select 'catalog', 'specialty_unmapped', event_type || ': ' || count(*) from events where event_type not in ('click', 'view') group by event_type
union all select 'catalog', 'specialty_target_unknown', l_returnflag || '' from lineitem where l_returnflag not in ('A', 'N')
union all select 'catalog', 'specialty_duplicated', n_regionkey::varchar from nation group by n_regionkey having count(*) > 1
union all select 'catalog', 'special_column_appeared', column_name from (describe select p_name as "DesignBy", p_brand as "ArtBy", p_type as "WhistleBy", p_size as "SpecialSize", p_partkey as part_id from part) where column_name ilike 'special%'
union all select 'classes', 'pattern_orphan', o_custkey::varchar from orders o where o_custkey not in (select c_custkey from customer where c_custkey % 7 <> 0)
union all select 'classes', 'parent_orphan_child', child::varchar from pa where child not in (select n_nationkey from nation)
union all select 'classes', 'parent_orphan_parent', parent::varchar from pa where parent not in (select r_regionkey from region)
union all select 'classes', 'unknown_kind', source from documents where source not in (select distinct source from documents where doc_id % 2 = 0 and doc_id % 3 = 0)
union all select 'classes', 'needle_uncovered', p_type || ': ' || unnest([lower(split_part(p_type, ' ', 2)), upper(p_type[1:3])]) from ty
""")
def source_errors(spark, sf):
    """Errors that stop a build, as rows: keys, grain, parsing, vocabularies, references."""
    m = _models(spark, sf)
    credits, parents = _credits(spark, sf), _parents(spark, sf)
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    events = table(spark, sf, "events")
    rules = events.select("event_type").where(F.col("event_type").isin(RULES))
    staged = m.unionByName(m.where("o_orderkey % 71 = 0"))
    secondary = table(spark, sf, "part").select("p_partkey", F.when(F.col("p_partkey") % 53 != 0, F.col("p_partkey")).alias("pid"))
    docs = table(spark, sf, "documents")
    low = F.lower("p_type")
    word = lambda n: F.split_part(low, F.lit(" "), F.lit(n))
    # alternatives: the first word in a group with another, the second alone; literals cover the first only, one is upper case
    vocabulary = table(spark, sf, "part").select("p_type").distinct().select("p_type", F.concat(word(1), F.lit("(s|es)?|"), word(2)).alias("pattern"), F.array(word(1), F.upper(F.substring("p_type", 1, 3))).alias("needles"))
    found = [
        Check("record_missing_id", "catalog", "error", q.null_key(m, "id", "o_orderkey")),
        Check("record_missing_id", "secondary", "error", q.null_key(secondary, "pid", "p_partkey")),
        Check("header_misaligned", "catalog", "error", q.disagreeing(m, [("number", "o_orderkey"), ("h_players", "players")], "o_orderkey")),
        Check("staged_not_unique", "catalog", "error", q.not_unique(staged.where("id is not null"), ["id"])),
        Check("staged_drops_rows", "catalog", "error", q.count_differs(table(spark, sf, "orders"), m.where("id is not null"))),
        Check("credit_role_unclaimed", "catalog", "error", q.columns_like(credits, "By$", tuple(ROLES))),
        Check("specialty_unmapped", "catalog", "error", q.unmapped(events, "event_type", rules, "event_type")),
        Check("specialty_target_unknown", "catalog", "error", q.outside_domain(table(spark, sf, "lineitem"), "l_returnflag", ["A", "N"])),
        Check("specialty_duplicated", "catalog", "error", q.not_unique(nation, ["n_regionkey"])),
        Check("special_column_appeared", "catalog", "error", q.columns_like(credits, "(?i)^special")),
        Check("pattern_orphan", "classes", "error", q.orphans(table(spark, sf, "orders"), "o_custkey", table(spark, sf, "customer").where("c_custkey % 7 <> 0"), "c_custkey")),
        Check("parent_orphan_child", "classes", "error", q.orphans(parents, "child", nation, "n_nationkey")),
        Check("parent_orphan_parent", "classes", "error", q.orphans(parents, "parent", region, "r_regionkey")),
        Check("unknown_kind", "classes", "error", q.orphans(docs, "source", docs.where("doc_id % 2 = 0 and doc_id % 3 = 0"), "source")),
        Check("needle_uncovered", "classes", "error", q.uncovered_branches(vocabulary, "p_type", "pattern", "needles")),
    ]
    return violations(found)


@query(f"""
with {_M},
newest as (select event_id, user_id, ts from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1),
snap as (select distinct o_custkey from orders where o_orderdate >= (select max(o_orderdate) from orders) - interval 90 day),
p as (select p_partkey as a, p_partkey + 1 as b from part where p_partkey % 5 = 0)
select 'catalog' as category, 'records_carried_forward' as check_name, user_id::varchar as detail from newest where ts < (select max(ts) from events)
union all select 'catalog', 'retraction_contradicted', c_custkey::varchar from customer where c_acctbal < 0 and c_custkey in (select o_custkey from snap)
union all select 'catalog', 'entity_ambiguous', l_partkey::varchar from lineitem group by l_partkey having count(distinct l_suppkey) > 1
union all select 'catalog', 'duplicate_unconfirmed', p.a || ' = ' || p.b from p left join part x on x.p_partkey = p.a left join part y on y.p_partkey = p.b where not coalesce(x.p_brand = y.p_brand, false)
union all select 'catalog', 'header_unparsed', k::varchar from m where not parsed
union all select 'archive', 'model_not_in_dump', k::varchar from (select distinct l_orderkey as k from lineitem) where k not in (select id from m where id is not null) and k not in (select o_orderkey from orders where o_orderkey % 2 = 0)
union all select 'archive', 'credit_role_unrecognised', w || ': ' || count(*) from (select distinct p_partkey, unnest(string_split(p_type, ' ')) as w from part) where w not in ('STANDARD', 'SMALL', 'MEDIUM', 'LARGE', 'ECONOMY', 'PROMO') group by w
union all select 'archive', 'header_date_inferred', k::varchar from m where month_only
union all select 'catalog', 'header_date_unrecognised', k::varchar from m where odd_date
""")
def source_warnings(spark, sf):
    """What a build only counts: carried forward, contradicted, ambiguous, unconfirmed, unparsed, unlisted, inferred."""
    m = _models(spark, sf)
    orders, part, lines = table(spark, sf, "orders"), table(spark, sf, "part"), table(spark, sf, "lineitem")
    won = reconcile.latest_wins(table(spark, sf, "events"), ["user_id"], "ts", [F.desc("event_id")])
    last = orders.agg(F.max("o_orderdate").alias("last"))
    snapshot = orders.crossJoin(F.broadcast(last)).where(F.col("o_orderdate") >= F.col("last") - F.expr("interval 90 days")).select("o_custkey").distinct()  # one row is broadcast
    retracted = table(spark, sf, "customer").where("c_acctbal < 0").join(snapshot, F.col("c_custkey") == F.col("o_custkey"), "left_semi")
    pairs = part.where("p_partkey % 5 = 0").select(F.col("p_partkey").alias("a"), (F.col("p_partkey") + 1).alias("b"))
    said = F.col("number").isNotNull()
    found = [
        Check("records_carried_forward", "catalog", "warning", won.where("carried_forward").select(F.col("user_id").alias("detail"))),
        Check("retraction_contradicted", "catalog", "warning", retracted.select(F.col("c_custkey").alias("detail"))),
        Check("entity_ambiguous", "catalog", "warning", q.ambiguous(lines, "l_partkey", "l_suppkey")),
        Check("duplicate_unconfirmed", "catalog", "warning", q.pair_unconfirmed(pairs, part, "p_partkey", ["p_brand"])),
        Check("header_unparsed", "catalog", "warning", m.where(~said).select(F.col("o_orderkey").alias("detail"))),
        Check("model_not_in_dump", "archive", "warning", q.missing_from_all(lines, "l_orderkey", [(m.where("id is not null"), "id"), (orders.where("o_orderkey % 2 = 0"), "o_orderkey")])),
        Check("credit_role_unrecognised", "archive", "warning", q.listed_values(part.select("p_partkey", F.split("p_type", " ").alias("words")), "p_partkey", "words", ["STANDARD", "SMALL", "MEDIUM", "LARGE", "ECONOMY", "PROMO"])),
        Check("header_date_inferred", "archive", "warning", m.where(said & F.col("year").isNotNull() & F.col("day").isNull()).select(F.col("o_orderkey").alias("detail"))),
        Check("header_date_unrecognised", "catalog", "warning", m.where(said & F.col("date_text").isNotNull() & F.col("year").isNull()).select(F.col("o_orderkey").alias("detail"))),
    ]
    return violations(found, "warning")


LAYERS = ["raw", "staging", "mart", "checks"]


@query("""
with r as (select case n_nationkey % 5 when 0 then n_name else ['raw', 'staging', 'mart', 'checks'][n_nationkey % 4 + 1] || '.' || n_name end as name from nation),
d as (select doc_id, text, case when doc_id % 6 = 0 then text || chr(12) || 'x' else text end as ocr from documents),
u as (select doc_id, source, doc_id // 4 as url from documents)
select 'structure' as category, 'sentinel_not_translated' as check_name, c_custkey::varchar as detail from customer where c_mktsegment = 'MACHINERY'
union all select 'structure', 'models_grain', (select count(*) from part) || ' <> ' || (select count(distinct p_brand) from part) where (select count(*) from part) <> (select count(distinct p_brand) from part)
union all select 'structure', 'object_outside_layers', name from r where not (contains(name, '.') and split_part(name, '.', 1) in ('raw', 'staging', 'mart', 'checks'))
union all select 'structure', 'column_not_snake_case', column_name from (describe select p_name as "DesignBy", p_brand as "ArtBy", p_type as "WhistleBy", p_size as "SpecialSize", p_partkey as part_id from part) where not regexp_full_match(column_name, '[a-z][a-z0-9_]*')
union all select 'structure', 'stub_differs', 'DesignBy string <> ArtBy string' union all select 'structure', 'stub_differs', 'ArtBy string <> DesignBy string'
union all select 'text', 'sheet_count', doc_id::varchar from d where doc_id % 6 = 0
union all select 'text', 'round_trip', doc_id::varchar from documents where doc_id % 10 = 0
union all select 'library', 'scope_domain', source from documents where source not in ('src0', 'src1', 'src2')
union all select 'library', 'id_by_scope', doc_id::varchar from labels where (toxic = 1) <> (quality = 1)
union all select 'library', 'blank_label', doc_id::varchar from documents where doc_id % 13 = 0
union all select 'library', 'url_of_two_documents', url::varchar from u group by url having count(distinct doc_id) > 1
union all select 'library', 'primary_not_unique', source from documents where lang = 'fr' group by source having count(*) > 1
union all select 'library', 'index_drift', case when d.doc_id is null then 'not stored ' else 'not indexed ' end || coalesce(d.doc_id, i.k) from documents d full join (select doc_id + case when doc_id % 17 = 0 then 1000000000 else 0 end as k from documents) i on i.k = d.doc_id where d.doc_id is null or i.k is null
""")
def structure_errors(spark, sf):
    """Checks of the built relations and of the document library: sentinels, grain, layers, names, stubs, guards, constraints, index."""
    part, docs, labels = table(spark, sf, "part"), table(spark, sf, "documents"), table(spark, sf, "labels")
    credits = _credits(spark, sf)
    key = F.col("n_nationkey")
    names = table(spark, sf, "nation").select(F.when(key % 5 == 0, F.col("n_name")).otherwise(F.concat_ws(".", F.get(F.array(*map(F.lit, LAYERS)), (key % 4).cast("int")), "n_name")).alias("name"))
    text = F.coalesce(F.col("text"), F.lit(""))
    tiers = docs.select("doc_id", text.alias("text"), F.when(F.col("doc_id") % 6 == 0, F.concat(text, F.lit("\fx"))).otherwise(text).alias("ocr"))
    marked = docs.select("doc_id", text.alias("text"), F.concat(F.lit("\ue000"), F.when(F.col("doc_id") % 10 == 0, F.concat(text, F.lit("!"))).otherwise(text), F.lit("\ue001")).alias("marked"))
    urls = docs.select("doc_id", F.floor(F.col("doc_id") / 4).cast("long").alias("url"))
    indexed = docs.select((F.col("doc_id") + F.when(F.col("doc_id") % 17 == 0, 1_000_000_000).otherwise(0)).alias("k"))
    named = docs.select("doc_id", F.when(F.col("doc_id") % 13 == 0, F.lit("  ")).otherwise(F.col("source")).alias("label"))
    found = [
        Check("sentinel_not_translated", "structure", "error", q.still_sentinel(table(spark, sf, "customer"), "c_custkey", "c_mktsegment", ["MACHINERY"])),
        Check("models_grain", "structure", "error", q.count_differs(part, part.select("p_brand").distinct())),
        Check("object_outside_layers", "structure", "error", q.unlayered(names, "name", LAYERS)),
        Check("column_not_snake_case", "structure", "error", q.columns_like(credits, "^(?![a-z][a-z0-9_]*$)")),
        Check("stub_differs", "structure", "error", q.schema_mismatch(credits, credits.select("ArtBy", "DesignBy", *credits.columns[2:]))),
        Check("sheet_count", "text", "error", q.part_counts_differ(tiers, "doc_id", "text", "ocr")),
        Check("round_trip", "text", "error", q.round_trip_broken(marked, "doc_id", "marked", "text", "\ue000\ue001")),
        Check("scope_domain", "library", "error", q.outside_domain(docs, "source", ["src0", "src1", "src2"])),
        Check("id_by_scope", "library", "error", labels.where("(toxic = 1) <> (quality = 1)").select(F.col("doc_id").alias("detail"))),
        Check("blank_label", "library", "error", q.blank(named, "doc_id", "label")),
        Check("url_of_two_documents", "library", "error", q.ambiguous(urls, "url", "doc_id")),
        Check("primary_not_unique", "library", "error", q.not_unique(docs.where("lang = 'fr'"), ["source"])),
        Check("index_drift", "library", "error", q.index_drift(docs, "doc_id", indexed, "k")),
    ]
    return violations(found)
