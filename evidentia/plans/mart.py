"""Published catalog relations: files with classes and scope, models with sentinels and duplicates, entities, machines, specialties."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidentia.functions import parse
from evidentia.operators import classify, reconcile
from evidentia.plans import table

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


KINDS = ["Manual", "Schematic Diagram", "Flyer", "ROM set", "Rule Card", "Service Bulletin", "Playfield photo", "notes"]
CONTAINERS = ["pdf", "zip", "jpg", "txt", ""]
#: Class, pattern, literals of which one must occur, containers, pattern that denies.
VOCABULARY = [
    ("manual", r"(?i)manual", ["manual"], ["pdf", "txt"], None),
    ("schematic", r"(?i)schematic", ["schematic"], ["pdf", "jpg"], None),
    ("flyer", r"(?i)flyer|brochure", ["flyer", "brochure"], ["pdf", "jpg"], None),
    ("rom", r"(?i)(?<![a-z])rom(?![a-z])", ["rom"], ["zip"], None),
    ("rule_card", r"(?i)(?:rule|instruction)[ _]card", ["card"], ["pdf", "jpg"], None),
    ("bulletin", r"(?i)service[ _]bulletin", ["bulletin"], ["pdf"], None),
    ("photo", r"(?i)photo|playfield", ["photo", "playfield"], ["jpg"], None),
    ("loose_card", r"(?i)card", ["card"], None, r"(?i)rule"),
]
PARENTS = [("manual", "document"), ("schematic", "document"), ("bulletin", "manual"), ("rule_card", "document"), ("flyer", "promotion"), ("photo", "image"), ("rom", "software")]

_FILES = """f as (select p_partkey as k, p_brand, p_size, p_brand || '_' || (1950 + p_size) || '_' || ['Manual', 'Schematic Diagram', 'Flyer', 'ROM set', 'Rule Card', 'Service Bulletin', 'Playfield photo', 'notes'][p_partkey % 8 + 1] || case when p_partkey % 5 < 4 then '.' || ['pdf', 'zip', 'jpg', 'txt'][p_partkey % 5 + 1] else '' end as name,
  case when p_partkey % 5 < 4 then ['pdf', 'zip', 'jpg', 'txt'][p_partkey % 5 + 1] end as container from part),
c as (select *, case k % 8 when 0 then case when k % 5 in (0, 3) then 'manual' end when 1 then case when k % 5 in (0, 2) then 'schematic' end when 2 then case when k % 5 in (0, 2) then 'flyer' end when 3 then case when k % 5 = 1 then 'rom' end
  when 4 then case when k % 5 in (0, 2) then 'rule_card' end when 5 then case when k % 5 = 0 then 'bulletin' end when 6 then case when k % 5 = 2 then 'photo' end end as cls from f)"""


def _files(spark, sf):
    """Files of parts: the brand, a year and a kind, in one of four containers or none."""
    k = F.col("p_partkey")
    container = F.nullif(F.get(F.array(*map(F.lit, CONTAINERS)), (k % 5).cast("int")), F.lit(""))
    name = F.concat("p_brand", F.lit("_"), F.lit(1950) + F.col("p_size"), F.lit("_"), F.get(F.array(*map(F.lit, KINDS)), (k % 8).cast("int")), F.coalesce(F.concat(F.lit("."), container), F.lit("")))
    return table(spark, sf, "part").select(k.alias("k"), "p_brand", "p_size", name.alias("name")).withColumn("container", parse.container(F.col("name")))


@query(f"with {_FILES} select k, name, cls as document_class from c where cls is not null")
def file_classes(spark, sf):
    """Every class that a file matches: literal, pattern, container, denial."""
    return classify.classify(_files(spark, sf), VOCABULARY, "name", "container").select("k", "name", "document_class")


@query(f"""with {_FILES},
s as (select name, count(distinct k) as models, count(distinct p_brand) as makers from c where container is not null and container <> 'jpg' group by name)
select k, c.name, container, cls as class_matches, case cls when 'manual' then 'document,manual' when 'schematic' then 'document,schematic' when 'bulletin' then 'bulletin,document,manual' when 'rule_card' then 'document,rule_card'
  when 'flyer' then 'flyer,promotion' when 'photo' then 'image,photo' when 'rom' then 'rom,software' end as class_rolled_up,
  case when s.models is null then null when makers > 1 then 'multi_manufacturer' when models > 1 then 'multi_model' else 'single_model' end as subject_scope from c left join s on s.name = c.name
""")
def documents_mart(spark, sf):
    """One row per file: classes as matched and rolled up, and a scope for what is no image and has a container."""
    files = _files(spark, sf)
    own = files.withColumn("own", classify.class_list(VOCABULARY, "name", "container"))
    rolled = own.select("k", "name", "container", F.nullif(F.array_join("own", ","), F.lit("")).alias("class_matches"), F.nullif(F.array_join(classify.rolled_up("own", classify.closed(PARENTS)), ","), F.lit("")).alias("class_rolled_up"))
    able = files.where("container is not null and container <> 'jpg'")
    scope = able.groupBy("name").agg(F.count_distinct("k").alias("models"), F.count_distinct("p_brand").alias("makers"))
    scoped = scope.select("name", classify.subject_scope(F.col("models"), F.col("makers")).alias("subject_scope"))
    return rolled.join(scoped, "name", "left").select("k", "name", "container", "class_matches", "class_rolled_up", "subject_scope")


@query("""
select p_partkey, w as wording, case w when 'STANDARD' then 'type' when 'PROMO' then 'type' when 'SMALL' then 'size' when 'LARGE' then 'size' end as entity_type,
  case w when 'STANDARD' then 'T-1' when 'PROMO' then 'open' when 'SMALL' then 'S-1' when 'LARGE' then 'S-3' end as public_id, case w when 'PROMO' then null else true end as resolvable
from (select p_partkey, unnest(string_split(p_type, ' ')) as w from part) where w in ('STANDARD', 'PROMO', 'SMALL', 'LARGE')
""")
def specialty_decode(spark, sf):
    """Wordings that a rule names, with their entity type and public id; a category without ids yet is neither resolvable nor not."""
    from evidentia.operators.records import is_resolvable

    rules = spark.createDataFrame([("STANDARD", "type", "T-1"), ("PROMO", "type", "open"), ("SMALL", "size", "S-1"), ("LARGE", "size", "S-3")], "wording string, entity_type string, public_id string")
    each = table(spark, sf, "part").select("p_partkey", F.explode(F.split("p_type", " ")).alias("wording")).join(F.broadcast(rules), "wording")  # four rules
    return each.select("p_partkey", "wording", "entity_type", "public_id", is_resolvable(F.col("public_id"), F.col("public_id"), "^[A-Z]-[0-9]+$", "open").alias("resolvable"))


@query("""
with n as (select event_id, user_id, event_type, value, ts, ts < (select max(ts) from events) as carried_forward from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1)
select user_id, event_id, event_type, value, carried_forward from n where user_id not in (select c_custkey from customer where c_acctbal < 0)
""")
def merged_models(spark, sf):
    """The newest record of each entity, less the retracted ones."""
    won = reconcile.latest_wins(table(spark, sf, "events"), ["user_id"], "ts", [F.desc("event_id")])
    retracted = table(spark, sf, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("user_id"))
    return won.join(retracted, "user_id", "left_anti").select("user_id", "event_id", "event_type", "value", "carried_forward")


@query("""
select o_orderkey as model_id, c.c_mktsegment as maker, n.n_name as place, case when o_orderkey % 97 = 0 then null when o_orderkey % 83 <> 0 then coalesce(year(o_orderdate), 0)::int else l.first_year end as year,
  case when o_orderkey % 97 = 0 then null when o_orderkey % 83 <> 0 then 'header' when l.first_year is not null then 'lines' end as year_source,
  case when l.n is null then null when l.returned > 0 then 'manufacture' when l.n > 3 then 'project' else 'project_inferred' end as date_kind
from orders o left join customer c on c.c_custkey = o.o_custkey left join nation n on n.n_nationkey = c.c_nationkey
left join (select l_orderkey, count(*) as n, count(*) filter (where l_returnflag = 'R') as returned, min(year(l_shipdate))::int as first_year from lineitem group by l_orderkey) l on l.l_orderkey = o.o_orderkey
""")
def staged_models(spark, sf):
    """Staged models: looked up, gaps filled from a second source with provenance, listed ones nulled, the date's kind by ordered evidence."""
    k = F.col("o_orderkey")
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("returned"), F.min(F.year("l_shipdate")).alias("first_year"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("maker"), "c_nationkey")
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("place"))
    base = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    rows = reconcile.enrich_one_to_one(base, [(c, ["o_custkey"]), (n, ["c_nationkey"]), (lines, ["o_orderkey"])])
    year, source = reconcile.gap_fill(F.when(k % 83 != 0, F.year("o_orderdate")), F.col("first_year"), ("header", "lines"))
    kind = F.when(F.col("n").isNull(), F.lit(None)).when(F.col("returned") > 0, "manufacture").when(F.col("n") > 3, "project").otherwise("project_inferred")
    staged = rows.select(k.alias("model_id"), "maker", "place", year.alias("year"), source.alias("year_source"), kind.alias("date_kind"))
    listed = table(spark, sf, "orders").where("o_orderkey % 97 = 0").select(k.alias("model_id"))
    return reconcile.nulled(staged, listed, ["model_id"], ["year", "year_source"])


@query("""
with d as (select p_partkey as model_id, p_name as name, case when p_size in (0, 32) then null else p_size end as size, min(p_partkey) over (partition by p_name, p_brand) as first_id from part)
select model_id, name, size, case when first_id <> model_id then first_id end as duplicate_of from d
""")
def mart_models(spark, sf):
    """Published names and sentinels; a duplicate is annotated with the record it repeats, never filtered."""
    part = table(spark, sf, "part")
    first = part.groupBy("p_name", "p_brand").agg(F.min("p_partkey").alias("first_id"))
    rows = part.join(first, ["p_name", "p_brand"]).select(F.col("p_partkey").alias("model_id"), F.col("p_name").alias("name"), reconcile.sentinel_to_null(F.col("p_size"), [0, 32]).alias("size"), "first_id")
    return rows.select("model_id", "name", "size", F.when(F.col("first_id") != F.col("model_id"), F.col("first_id")).alias("duplicate_of"))


@query("""
select 'maker' as entity, s_suppkey as id, s_name as name from supplier union all select 'owner', c_custkey, c_name from customer where c_acctbal >= 0 union all select 'retracted', c_custkey, null from customer where c_acctbal < 0
""")
def mart_entities(spark, sf):
    """Entities of every kind, and the retracted list."""
    c = table(spark, sf, "customer")
    owner = c.select(F.when(F.col("c_acctbal") >= 0, "owner").otherwise("retracted").alias("entity"), F.col("c_custkey").alias("id"), F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("name")).where("c_acctbal is not null")
    return table(spark, sf, "supplier").select(F.lit("maker").alias("entity"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")).unionByName(owner)


@query("""
select l_partkey as machine_id, list_sort(list(distinct l_suppkey)) as manufacturers, count(distinct l_orderkey) as images from lineitem group by l_partkey
""")
def machines(spark, sf):
    """One row per machine: its distinct manufacturers and how many images it has."""
    lines = table(spark, sf, "lineitem")
    return lines.groupBy(F.col("l_partkey").alias("machine_id")).agg(F.array_sort(F.collect_set("l_suppkey")).alias("manufacturers"), F.count_distinct("l_orderkey").alias("images"))


@query("""
with w as (select lang, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z]+'))) as word from documents)
select word, max((lang = 'en')::int) as in_en, max((lang = 'fr')::int) as in_fr, max((lang = 'de')::int) as in_de, max((lang = 'es')::int) as in_es,
  max((lang = 'en')::int) + max((lang = 'fr')::int) + max((lang = 'de')::int) + max((lang = 'es')::int) as n_sources, min(lang) as first_source from w where lang in ('en', 'fr', 'de', 'es') group by word
""")
def glossary_comparison(spark, sf):
    """Which of four sources has each entry, from one pass over the tagged rows, and the source that leads it."""
    words = table(spark, sf, "documents").where(F.col("lang").isin("en", "fr", "de", "es")).select("lang", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0)))).alias("word"))
    return reconcile.tagged_presence(words, "word", "lang", ["en", "fr", "de", "es"], F.min("lang").alias("first_source"))
