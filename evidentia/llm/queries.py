"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from evidentia.llm.lines import dedup_lines

    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from evidentia.llm.topk import top_k

    return top_k(table(spark, sf_dir, "embeddings"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from evidentia.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from evidentia.llm.bpe import encode

    coded = encode(table(spark, sf_dir, "documents"), tokenizer_path(), decoded=True)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from evidentia.llm.minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def captures_and_lists(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Fetch times and dated list entries derived from the pages: a third of all hosts, domains and paths gets listed."""
    from evidentia.llm.urlfilter import keys_of

    day = F.col("page_id") * 7919 % 1461
    captures = pages.select("page_id", "url", F.expr("timestamp '2020-01-01 00:00:00'").alias("start"), day.alias("day"), (F.col("page_id") % 24).alias("hour"))
    captures = captures.select("page_id", "url", F.expr("start + make_interval(0, 0, 0, cast(day as int), cast(hour as int))").alias("fetched_at"))
    patterns = pages.select(F.explode(keys_of(F.col("url"))).alias("pattern")).distinct()
    h = F.conv(F.substring(F.md5("pattern"), 1, 6), 16, 10).cast("long")
    hashed = patterns.select("pattern", h.alias("h")).where("h % 3 = 0")
    entries = hashed.selectExpr(
        "pattern",
        "case when h % 5 = 0 then 'allow' else 'block' end as verdict",
        "explode(array(named_struct('change', 'add', 'day', h % 700), named_struct('change', 'remove', 'day', h % 700 + 100 + h % 500), named_struct('change', 'add', 'day', h % 700 + 700 + h % 300))) as e",
    )
    return captures, entries.selectExpr("pattern", "verdict", "e.change as change", "timestamp '2020-01-01 00:00:00' + make_interval(0, 0, 0, cast(e.day as int)) as effective")


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from evidentia.llm.urlfilter import evaluate

    captures, entries = captures_and_lists(table(spark, sf_dir, "pages"))
    return evaluate(captures, entries)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from evidentia.llm.language import predict

    return predict(table(spark, sf_dir, "documents"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from evidentia.llm.fingerprint import fingerprints

    return fingerprints(table(spark, sf_dir, "documents"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from evidentia.llm.chat import events_of, format_events, with_probe

    return format_events(events_of(with_probe(spark, table(spark, sf_dir, "conversations"))))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from evidentia.llm.lattice import score_documents

    return score_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from evidentia.llm.negatives import hard_negatives

    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.select("vec_id", "embedding", moved.alias("label")))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from evidentia.llm.quality import score_quality

    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from evidentia.llm.centroids import cluster_vectors

    return cluster_vectors(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_top_k": op2_top_k,
    "op3_packing": op3_packing,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_bpe": op5_bpe,
    "op6_url_filters": op6_url_filters,
    "op7_language": op7_language,
    "op8_fingerprints": op8_fingerprints,
    "op9_chat": op9_chat,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_quality": op12_quality,
    "op13_centroids": op13_centroids,
}

ORACLES: dict[str, str] = {
    "op6_url_filters": r"""
with c as (
  select page_id, timestamp '2020-01-01' + to_days(cast(page_id * 7919 % 1461 as int)) + to_hours(page_id % 24) as fetched_at,
         lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)', 1)) as host,
         list_filter(string_split(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//[^/?#]*(/[^?#]*)', 1), '/'), lambda s: s <> '') as steps
  from pages),
k as (
  select page_id, fetched_at, unnest(list_concat(
      list_transform(range(1, greatest(len(string_split(host, '.')), 2)), lambda i: array_to_string(string_split(host, '.')[i:], '.')),
      list_transform(range(1, len(steps) + 1), lambda j: host || '/' || array_to_string(steps[1:j], '/')))) as pattern
  from c where host <> ''),
p as (select distinct pattern, cast('0x' || substr(md5(pattern), 1, 6) as bigint) as h from k),
e as (
  select pattern, h, 'add' as change, h % 700 as day from p where h % 3 = 0
  union all select pattern, h, 'remove', h % 700 + 100 + h % 500 from p where h % 3 = 0
  union all select pattern, h, 'add', h % 700 + 700 + h % 300 from p where h % 3 = 0),
i as (
  select pattern, case when h % 5 = 0 then 'allow' else 'block' end as verdict, change, timestamp '2020-01-01' + to_days(cast(day as int)) as valid_from,
         coalesce(lead(timestamp '2020-01-01' + to_days(cast(day as int))) over (partition by pattern order by day, change), timestamp '9999-12-31') as valid_to
  from e),
m as (
  select k.page_id, i.pattern, i.verdict, row_number() over (partition by k.page_id order by length(i.pattern) desc, i.pattern desc) as r, count(*) over (partition by k.page_id) as n
  from k join i on k.pattern = i.pattern and i.change = 'add' and k.fetched_at >= i.valid_from and k.fetched_at < i.valid_to)
select c.page_id, coalesce(m.n, 0) as n_active, coalesce(m.verdict, 'none') as decision, m.pattern
from c left join m on m.page_id = c.page_id and m.r = 1
""",
    "op11_hard_negatives": """
with r as (
  select vec_id as id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.id as anchor_id, b.id as other, a.label = b.label as same, list_dot_product(a.v, b.v)::bigint as score from r a join r b on a.id % 100 = 0 and a.id <> b.id),
p as (select anchor_id, other as positive_id, score as positive_score from s where same qualify row_number() over (partition by anchor_id order by score desc, other) <= 5)
select anchor_id, positive_id, (row_number() over (partition by anchor_id, positive_id order by score desc, other))::int as rank, other as negative_id, positive_score, score as negative_score
from p join s using (anchor_id) where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
qualify row_number() over (partition by anchor_id, positive_id order by score desc, other) <= 10
""",
    "op13_centroids": """
with rows_ as (
  select vec_id as id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
c0 as (select row_number() over (order by h) - 1 as c, v from (select sha256('1:' || id) as h, v from rows_ order by h limit 16)),
a1 as (select id, v, arg_min(c, (d, c)) as c, min(d) as d from (
    select rows_.id, rows_.v, c0.c, list_sum(list_transform(list_zip(rows_.v, c0.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d from rows_ cross join c0) group by id, v),
c1 as (select c, list(m order by p) as v from (
    select a1.c, p, (sum(v[p]) - ((sum(v[p]) % count(*)) + count(*)) % count(*)) // count(*) as m from a1 cross join (select unnest(range(1, 65)) as p) group by a1.c, p) group by c
  union all select c, v from c0 where c not in (select c from a1)),
a2 as (select id, v, arg_min(c, (d, c)) as c, min(d) as d from (
    select rows_.id, rows_.v, c1.c, list_sum(list_transform(list_zip(rows_.v, c1.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d from rows_ cross join c1) group by id, v),
c2 as (select c, list(m order by p) as v from (
    select a2.c, p, (sum(v[p]) - ((sum(v[p]) % count(*)) + count(*)) % count(*)) // count(*) as m from a2 cross join (select unnest(range(1, 65)) as p) group by a2.c, p) group by c
  union all select c, v from c1 where c not in (select c from a2)),
a3 as (select id, v, arg_min(c, (d, c)) as c, min(d) as d from (
    select rows_.id, rows_.v, c2.c, list_sum(list_transform(list_zip(rows_.v, c2.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d from rows_ cross join c2) group by id, v),
c3 as (select c, list(m order by p) as v from (
    select a3.c, p, (sum(v[p]) - ((sum(v[p]) % count(*)) + count(*)) % count(*)) // count(*) as m from a3 cross join (select unnest(range(1, 65)) as p) group by a3.c, p) group by c
  union all select c, v from c2 where c not in (select c from a3)),
a4 as (select id, v, arg_min(c, (d, c)) as c, min(d) as d from (
    select rows_.id, rows_.v, c3.c, list_sum(list_transform(list_zip(rows_.v, c3.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d from rows_ cross join c3) group by id, v)
select a4.id as vec_id, a4.c::int as cluster, a4.d as distance, (sum(a4.d) over (partition by a4.c))::bigint as cluster_inertia, (sum(a4.d) over ())::bigint as inertia,
       sha256(array_to_string(c3.v, ',')) as centroid_sha256
from a4 join c3 on c3.c = a4.c
""",
}
