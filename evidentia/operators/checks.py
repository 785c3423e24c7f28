"""Data-quality checks: each is a query whose rows are violations."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    name: str
    category: str
    severity: str  # "error" or "warning"
    rows: DataFrame  # one column, `detail`, per violation


class ChecksFailed(Exception):
    """Errors were found; `counts` has them by category and check."""

    def __init__(self, counts: list):
        super().__init__("; ".join(f"{r['category']}/{r['check_name']}: {r['n']}" for r in counts))
        self.counts = counts


def violations(checks: list[Check], severity: str = "error") -> DataFrame:
    """All violations of one severity as one plan: (category, check_name, detail)."""
    out = None
    for c in checks:
        if c.severity == severity:
            part = c.rows.select(F.lit(c.category).alias("category"), F.lit(c.name).alias("check_name"), F.col("detail").cast("string").alias("detail"))
            out = part if out is None else out.unionByName(part)
    return out


def warning_counts(checks: list[Check]) -> DataFrame:
    return violations(checks, "warning").groupBy("check_name").agg(F.count("*").alias("cnt"))


def enforce(checks: list[Check]) -> None:
    """Raise if any error check has rows; the counts, not the rows, come to the driver."""
    found = violations(checks)
    if found is not None:
        counts = found.groupBy("category", "check_name").agg(F.count("*").alias("n")).orderBy("category", "check_name").collect()
        if counts:
            raise ChecksFailed(counts)


def null_key(df: DataFrame, key: str, detail: str) -> DataFrame:
    return df.where(F.col(key).isNull()).select(F.col(detail).cast("string").alias("detail"))


def not_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(F.concat_ws(",", *(F.col(k).cast("string") for k in keys)).alias("detail"))


def orphans(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Values without a parent row; null refers to nothing and is no orphan."""
    p = parent.select(F.col(parent_column).alias("_p")).distinct()
    return df.where(F.col(column).isNotNull()).join(p, F.col(column) == F.col("_p"), "left_anti").select(F.col(column).cast("string").alias("detail"))


def outside_domain(df: DataFrame, column: str, domain: list) -> DataFrame:
    return df.where(~F.col(column).isin(domain)).select(F.col(column).cast("string").alias("detail"))


def ambiguous(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.groupBy(key).agg(F.count_distinct(value).alias("n")).where("n > 1").select(F.col(key).cast("string").alias("detail"))


def schema_rows(frames: dict[str, DataFrame]) -> DataFrame:
    """(relation, column_name, data_type, position) of the given relations."""
    spark = next(iter(frames.values())).sparkSession
    rows = [(name, f.name, f.dataType.simpleString(), k) for name, df in frames.items() for k, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "relation string, column_name string, data_type string, position int")


def schema_mismatch(real: DataFrame, stub: DataFrame) -> DataFrame:
    """Columns where a stub differs from the real relation in name, type or order."""
    spark = real.sparkSession
    a, b = ([(f.name, f.dataType.simpleString()) for f in df.schema.fields] for df in (real, stub))
    longest = max(len(a), len(b))
    pad = lambda x: x + [None] * (longest - len(x))
    shown = lambda x: " ".join(x) if x else "nothing"
    return spark.createDataFrame([(f"{shown(x)} <> {shown(y)}",) for x, y in zip(pad(a), pad(b)) if x != y], "detail string")


def disagreeing(df: DataFrame, pairs: list[tuple[str, str]], detail: str) -> DataFrame:
    """Rows where a parsed value is present and differs from its typed column."""
    off = F.lit(False)
    for parsed, typed in pairs:
        off = off | (F.col(parsed).isNotNull() & ~F.col(parsed).eqNullSafe(F.col(typed)))
    return df.where(off).select(F.col(detail).cast("string").alias("detail"))


def count_differs(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row with both counts if two relations differ in their number of rows."""
    a, b = left.agg(F.count("*").alias("a")), right.agg(F.count("*").alias("b"))
    return a.crossJoin(b).where("a <> b").select(F.concat_ws(" <> ", "a", "b").alias("detail"))  # one row each


def columns_like(df: DataFrame, pattern: str, known: tuple[str, ...] = ()) -> DataFrame:
    """Columns whose name matches a regular expression and is not in a vocabulary."""
    rows = schema_rows({"relation": df}).where(F.col("column_name").rlike(pattern))
    return (rows.where(~F.col("column_name").isin(*known)) if known else rows).select(F.col("column_name").alias("detail"))


def unmapped(df: DataFrame, column: str, rules: DataFrame, rule_column: str) -> DataFrame:
    """Values without a rule, grouped, with how often they occur."""
    r = rules.select(F.col(rule_column).alias("_r")).distinct()
    left = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return left.join(r, F.col(column) == F.col("_r"), "left_anti").select(F.concat_ws(": ", F.col(column).cast("string"), "n").alias("detail"))


def uncovered_branches(vocabulary: DataFrame, name: str, pattern: str, needles: str) -> DataFrame:
    """Top-level alternatives of a pattern that hold none of its literals, and literals that are not lower case.

    Groups are emptied first, innermost first, so that only bars outside of them part alternatives.
    """
    flat = F.regexp_replace(F.regexp_replace(F.col(pattern), r"\([^()]*\)", ""), r"\([^()]*\)", "")
    bare = lambda b: ~F.exists(F.col(needles), lambda n: F.contains(F.lower(b), n))
    found = F.concat(F.filter(F.split(flat, r"\|"), bare), F.filter(F.col(needles), lambda n: n != F.lower(n)))
    return vocabulary.select(F.col(name).cast("string").alias("name"), F.explode(found).alias("part")).select(F.concat_ws(": ", "name", "part").alias("detail"))


def pair_unconfirmed(pairs: DataFrame, rows: DataFrame, key: str, same: list[str]) -> DataFrame:
    """Listed pairs (a, b) whose rows do not agree on the given columns, or of which one is missing."""
    side = lambda s: rows.select(F.col(key).alias(s), F.struct(*same).alias(f"_{s}"))
    met = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")
    agree = F.coalesce(F.col("_a") == F.col("_b"), F.lit(False))
    return met.where(~agree).select(F.concat_ws(" = ", F.col("a").cast("string"), F.col("b").cast("string")).alias("detail"))


def missing_from_all(df: DataFrame, key: str, others: list[tuple[DataFrame, str]]) -> DataFrame:
    """Keys that none of the other relations has."""
    left = df.where(F.col(key).isNotNull()).select(F.col(key).alias("_k")).distinct()
    for other, column in others:
        left = left.join(other.select(F.col(column).alias("_o")).distinct(), F.col("_k") == F.col("_o"), "left_anti")
    return left.select(F.col("_k").cast("string").alias("detail"))


def listed_values(df: DataFrame, key: str, values: str, vocabulary: list[str]) -> DataFrame:
    """Distinct elements of a list column outside a vocabulary, with the number of rows that hold them."""
    each = df.select(key, F.explode(F.array_distinct(values)).alias("v")).where(~F.col("v").isin(vocabulary))
    return each.groupBy("v").agg(F.count("*").alias("n")).select(F.concat_ws(": ", "v", "n").alias("detail"))


def still_sentinel(df: DataFrame, key: str, column: str, sentinels: list) -> DataFrame:
    """Rows that still hold a value which stands for nothing."""
    return df.where(F.col(column).isin(sentinels)).select(F.col(key).cast("string").alias("detail"))


def unlayered(relations: DataFrame, name: str, layers: list[str]) -> DataFrame:
    """Relations outside the named layers."""
    layer = F.when(F.contains(F.col(name), F.lit(".")), F.split_part(F.col(name), F.lit("."), F.lit(1))).otherwise("")
    return relations.where(~layer.isin(layers)).select(F.col(name).alias("detail"))


def part_counts_differ(df: DataFrame, key: str, first: str, second: str, mark: str = "\f") -> DataFrame:
    """Rows whose two texts have different numbers of parts."""
    parts = lambda c: F.size(F.split(F.coalesce(F.col(c), F.lit("")), mark))
    return df.where(F.col(first).isNotNull() & F.col(second).isNotNull() & (parts(first) != parts(second))).select(F.col(key).cast("string").alias("detail"))


def round_trip_broken(df: DataFrame, key: str, marked: str, stored: str, marks: str) -> DataFrame:
    """Rows whose marked text is not the stored text once the marks are gone."""
    return df.where(~F.translate(F.col(marked), marks, "").eqNullSafe(F.col(stored))).select(F.col(key).cast("string").alias("detail"))


def blank(df: DataFrame, key: str, column: str) -> DataFrame:
    return df.where(F.coalesce(F.trim(F.col(column)), F.lit("")) == "").select(F.col(key).cast("string").alias("detail"))


def index_drift(rows: DataFrame, key: str, indexed: DataFrame, indexed_key: str) -> DataFrame:
    """Keys that only the table or only its index has."""
    a = rows.select(F.col(key).alias("k"), F.lit(1).alias("here"))
    b = indexed.select(F.col(indexed_key).alias("k"), F.lit(1).alias("there")).distinct()
    return a.join(b, "k", "full_outer").where("here is null or there is null").select(F.concat_ws(" ", F.when(F.col("here").isNull(), "not stored").otherwise("not indexed"), F.col("k").cast("string")).alias("detail"))
