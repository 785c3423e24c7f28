"""Queries over the whole vocabularies: files classed by all patterns, the class graph, credits of all roles, and spellings that expire."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.functions import vocabulary as voc
from evidentia.operators import classify, credits
from evidentia.plans import table

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


#: What files are called here, several classes at once among them.
KINDS = [
    "Operations Manual", "Shop Manual & Schematic", "Owner's Manual", "Installation Instructions", "Wiring (harness)", "Engineering Drawing 12", "CAD overlay template", "BOM", "Theory of Operation",
    "Parts List", "Switches, chart", "Lamps/Solenoid list", "DIP Switch settings", "Score Motor", "Rubber Ring Chart", "Adjustments", "Service Bulletin 7", "Notice to Operators", "Flyer", "Promotional Folder",
    "Feature Matrix: features list", "Press Release", "Replay Cards", "Promo photo", "Score Card", "Warranty", "Packing List", "How-to-Play", "Rulesheet guide", "Letter from Q&A", "Memo", "Plastics, decals",
    "Images of", "Music tune", "Sound ROMs V1.0", "All Sound Files", "Movie", "EPROM set", "Retrofit kit", "Errata", "Patent 1,234,567", "Coin Slot article", "Spinning Reels", "Promenade", "Manually made",
]
_CONTAINERS = ["pdf", "zip", "jpg", "txt", "mp3"]


def _literal(v) -> str:
    if v is None:
        return "null"
    return "[" + ", ".join(map(_literal, v)) + "]" if isinstance(v, list) else "'" + v.replace("'", "''") + "'"


_PATTERNS = "p(cls, pattern, required, allowed, denied) as (values " + ", ".join("(" + ", ".join(map(_literal, r)) + ")" for r in voc.CLASS_PATTERNS) + ")"
_PARENTS = "e(child, parent) as (values " + ", ".join(f"('{a}', '{b}')" for a, b in voc.CLASS_PARENTS) + ")"
_NAMES = f"f as (select p_partkey as k, p_brand || ' ' || {_literal(KINDS)}[(p_partkey % {len(KINDS)})::int + 1] || ' ' || p_name as name, {_literal(_CONTAINERS)}[(p_partkey // 3 % 5)::int + 1] as container from part)"
_MATCHED = "m as (select distinct k, cls from f join p on regexp_matches(lower(name), pattern) and (allowed is null or list_contains(allowed, container)) and (denied is null or not regexp_matches(lower(name), denied)))"


def _files(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("p_partkey")
    kind = F.get(F.array(*map(F.lit, KINDS)), (k % len(KINDS)).cast("int"))
    container = F.get(F.array(*map(F.lit, _CONTAINERS)), (F.floor(k / 3) % 5).cast("int"))
    return table(spark, sf, "part").select(k.alias("k"), F.lower(F.concat_ws(" ", "p_brand", kind, "p_name")).alias("name"), container.alias("container"))


@query(f"""with {_PATTERNS}, {_NAMES}, {_MATCHED}, {_PARENTS},
u as (select k, cls from m union select k, parent from m join e on e.child = cls)
select f.k, (select string_agg(cls, ',' order by cls) from m where m.k = f.k) as classes, (select string_agg(cls, ',' order by cls) from u where u.k = f.k) as rolled_up from f""")
def vocabulary_classes(spark, sf):
    """Files named after parts, by all patterns of the vocabulary, with their classes' ancestors."""
    found = classify.classify_many(_files(spark, sf), voc.CLASS_PATTERNS, "name", "container")
    joined = lambda c: F.nullif(F.array_join(c, ","), F.lit(""))
    return found.select("k", joined("classes").alias("classes"), joined(classify.rolled_up("classes", classify.closed(voc.CLASS_PARENTS))).alias("rolled_up"))


@query(f"""with {_PATTERNS}, d as (select doc_id as k, lower(text || ' ' || {_literal(KINDS)}[(doc_id % {len(KINDS)})::int + 1]) as name from documents),
m as (select distinct k, cls from d join p on regexp_matches(name, pattern) and allowed is null and (denied is null or not regexp_matches(name, denied)))
select k as doc_id, string_agg(cls, ',' order by cls) as classes from m group by k""")
def vocabulary_texts(spark, sf):
    """The patterns without containers over whole texts, in one pass of the automaton."""
    kind = F.get(F.array(*map(F.lit, KINDS)), (F.col("doc_id") % len(KINDS)).cast("int"))
    docs = table(spark, sf, "documents").select("doc_id", F.lower(F.concat_ws(" ", "text", kind)).alias("name"))
    found = classify.classify_many(docs, [p for p in voc.CLASS_PATTERNS if p[3] is None], "name")
    return found.where("size(classes) > 0").select("doc_id", F.array_join("classes", ",").alias("classes"))


@query(f"""with {_PATTERNS}, {_PARENTS}, c as (select distinct cls from p union select parent from e),
{_NAMES}, {_MATCHED}, n as (select cls, count(*) as n from m group by cls)
select c.cls as document_class, case when c.cls in ('patent', 'trade_article') then c.cls else 'document' end as source_kind, (select min(parent) from e where child = c.cls) as parent_class,
  (select count(*) from p where p.cls = c.cls) as patterns, coalesce(n.n, 0) as files from c left join n on n.cls = c.cls""")
def vocabulary_report(spark, sf):
    """Every class with its kind, parent, number of patterns and files, zeros kept."""
    files = classify.classify_many(_files(spark, sf), voc.CLASS_PATTERNS, "name", "container").select(F.explode("classes").alias("document_class")).groupBy("document_class").agg(F.count("*").alias("files"))
    patterns = voc.relation(spark, "class_patterns").groupBy("document_class").agg(F.count("*").alias("patterns"))
    parents = voc.relation(spark, "class_parents").select(F.col("child").alias("document_class"), F.col("parent").alias("parent_class"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return voc.relation(spark, "classes").join(parents, "document_class", "left").join(patterns, "document_class", "left").join(files, "document_class", "left").select("document_class", "source_kind", "parent_class", zero("patterns"), zero("files"))


#: The dump's role fields, made from a part: number, and who is named in it.
_NAMED = ["'Ann ' || p_brand", "'Bo, ' || p_name", "'(undisclosed)'", "'Cy, , unknown, TBA'", "null", "p_type || ',Eve'", "''"]
_ROLE_SQL = " union all ".join(f"select k, '{role}' as role, '{slug}' as role_slug, {named} as names from b" for (role, slug, field, _), named in zip(voc.CREDIT_ROLES, _NAMED))


@query(f"""with b as (select p_partkey as k, * from part),
d as (select k, role, role_slug, trim(unnest(string_split(names, ','))) as person from ({_ROLE_SQL}) where names <> ''),
a as (select k, 'Concept' as role, 'concept' as role_slug, 'Gil ' || k as person from b where k % 3 = 0)
select k, role, role_slug, person from (select * from d union all select * from a)
where lower(person) not in ('(undisclosed)', 'undisclosed', 'unknown', 'missing', 'null', 'undefined', 'n/a', 'none', 'tbd', 'tba', '?', '') and person not ilike '%(undisclosed)%' and person not ilike '%unknown%'""")
def credits_all_roles(spark, sf):
    """People of all roles: the dump's seven fields, and the one role that only archived pages supply; their other credits are not believed over the dump."""
    part, k = table(spark, sf, "part"), F.col("p_partkey")
    fields = [r[2] for r in voc.CREDIT_ROLES if r[2]]
    models = part.select(k.alias("k"), *(F.expr(e).alias(f) for f, e in zip(fields, ["concat('Ann ', p_brand)", "concat('Bo, ', p_name)", "'(undisclosed)'", "'Cy, , unknown, TBA'", "cast(null as string)", "concat(p_type, ',Eve')", "''"])))
    pages = part.where("p_partkey % 3 = 0").select(k.alias("k"), F.expr("array(named_struct('role', 'Concept by', 'name', concat('Gil ', p_partkey)), named_struct('role', 'Design by', 'name', 'Zed'), named_struct('role', 'Magic by', 'name', 'Yan'))").alias("credits"))
    return credits.credits(models, pages, "k")


_SPELLINGS = [("Dots/Animation by", "animation", "1995-01-01", None), ("Animation by", "animation", "1990-01-01", "1996-07-01"), ("Display by", "animation", "2999-01-01", None), ("Display by", "art", "1992-01-01", "1994-01-01")]


@query("""with s(label, slug, since, until) as (values """ + ", ".join("(" + ", ".join(map(_literal, r)) + ")" for r in _SPELLINGS) + """),
o as (select o_orderkey, o_orderdate::date as day, ['Dots/Animation by', 'Animation by', 'Display by', 'Paint by'][(o_orderkey % 4)::int + 1] as label from orders)
select o.o_orderkey, o.label, (select slug from s where s.label = o.label and s.since::date <= o.day and (s.until is null or o.day < s.until::date)) as role_slug from o""")
def credit_labels_as_of(spark, sf):
    """Labels decoded by the vocabulary of their snapshot's day: an expired spelling still decodes old snapshots, a future one none yet."""
    labels = F.array(*map(F.lit, ["Dots/Animation by", "Animation by", "Display by", "Paint by"]))
    rows = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"), F.get(labels, (F.col("o_orderkey") % 4).cast("int")).alias("label"))
    spellings = spark.createDataFrame(_SPELLINGS, "label string, role_slug string, since string, until string").select("label", "role_slug", F.col("since").cast("date").alias("since"), F.col("until").cast("date").alias("until"))
    return credits.as_of(rows, spellings, "label", "day").select("o_orderkey", "label", "role_slug")
