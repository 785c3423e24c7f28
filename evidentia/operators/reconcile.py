"""Reconciliation of snapshots and sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_wins(rows: DataFrame, keys: list[str], when: str, ties: list[Column] | None = None) -> DataFrame:
    """One whole record per key, the newest; carried_forward marks those older than the newest snapshot of all.

    Ties in time go by `ties`, so the result is deterministic. The newest time is a one-row aggregate.
    """
    order = Window.partitionBy(*keys).orderBy(F.col(when).desc_nulls_last(), *(ties or []))
    newest = rows.agg(F.max(when).alias("_newest"))
    kept = rows.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")
    return kept.crossJoin(F.broadcast(newest)).withColumn("carried_forward", F.col(when) < F.col("_newest")).drop("_newest")


def gap_fill(primary: Column, secondary: Column, names: tuple[str, str]) -> tuple[Column, Column]:
    """The filled value, and which source it came from."""
    return F.coalesce(primary, secondary), F.when(primary.isNotNull(), names[0]).when(secondary.isNotNull(), names[1])


def sentinel_to_null(value: Column, sentinels: list) -> Column:
    return F.when(~value.isin(sentinels), value)


def require_columns(df: DataFrame, names: list[str]) -> None:
    """drop() and withColumnsRenamed() pass over unknown names in silence; this does not."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")


def without(df: DataFrame, *names: str) -> DataFrame:
    require_columns(df, list(names))
    return df.drop(*names)


def replaced(df: DataFrame, **columns: Column) -> DataFrame:
    require_columns(df, list(columns))
    return df.withColumns(columns)


def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Bulk rename; a name that is absent is passed over."""
    return df.withColumnsRenamed(names)


def renamed_strictly(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Bulk rename; a name that is absent raises."""
    require_columns(df, list(names))
    return df.withColumnsRenamed(names)


def nulled(df: DataFrame, listed: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Rows whose key is listed lose the values of some columns, and keep their place."""
    marked = df.join(listed.select(*keys).distinct().withColumn("_listed", F.lit(True)), keys, "left")
    return marked.select(*(F.when(F.col("_listed").isNull(), F.col(c)).alias(c) if c in columns else F.col(c) for c in df.columns))


def top_withheld(df: DataFrame, order: list[Column], limit: int) -> DataFrame:
    """The first rows with their place and how many the limit keeps back; a limit below one keeps all rows."""
    total = df.agg(F.count("*").alias("_total"))
    top = df.orderBy(*order).limit(limit) if limit > 0 else df
    placed = top.withColumn("place", F.row_number().over(Window.orderBy(*order)).cast("long"))  # after the limit: a few rows
    kept = limit if limit > 0 else 2**62
    return placed.crossJoin(F.broadcast(total)).withColumn("withheld", F.greatest(F.col("_total") - kept, F.lit(0))).drop("_total")


def enrich_one_to_one(base: DataFrame, joins: list[tuple[DataFrame, list[str]]]) -> DataFrame:
    """A chain of left joins that may not change the row count; duplicate keys in a lookup raise."""
    for lookup, keys in joins:
        one = lookup.groupBy(*keys).agg(F.count("*").alias("_n"), *(F.first(c).alias(c) for c in lookup.columns if c not in keys))
        checked = one.withColumn("_n", F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("lookup repeats a key: "), F.col(keys[0]).cast("string")))).otherwise(F.col("_n")))
        base = base.join(checked.where("_n = 1").drop("_n"), keys, "left")
    return base


def presence_matrix(sources: dict[str, DataFrame], key: str) -> DataFrame:
    """One row per key of any source: in_<source> flags and n_sources, from a single pass over the tagged union."""
    tagged = None
    for name, df in sources.items():
        part = df.select(F.col(key).alias(key), F.lit(name).alias("_source"))
        tagged = part if tagged is None else tagged.unionByName(part)
    return tagged_presence(tagged, key, "_source", list(sources))


def tagged_presence(tagged: DataFrame, key: str, tag: str, sources: list[str], *also: Column) -> DataFrame:
    """The same from rows that carry their source, in one scan and one shuffle of partial maxima."""
    flags = tagged.groupBy(key).agg(*(F.max(F.when(F.col(tag) == n, 1).otherwise(0)).alias(f"in_{n}") for n in sources), *also)
    return flags.withColumn("n_sources", sum((F.col(f"in_{n}") for n in sources), F.lit(0)))


def manifest_diff(local: DataFrame, listing: DataFrame, manifest: DataFrame) -> DataFrame:
    """(path, reason): `new`, `size differs`, `not in manifest`, `content differs`, `unchanged` or `orphan`.

    Inputs are (path, size, sha256), (path, size) and (path, sha256); an orphan is listed and known, but no longer local.
    """
    l, r, m = local.alias("l"), listing.alias("r"), manifest.alias("m")
    joined = l.join(r, F.col("l.path") == F.col("r.path"), "full_outer").withColumn("p", F.coalesce("l.path", "r.path")).join(m, F.col("p") == F.col("m.path"), "left")
    reason = (
        F.when(F.col("l.path").isNull(), F.when(F.col("m.path").isNotNull(), "orphan"))
        .when(F.col("r.path").isNull(), "new")
        .when(F.col("l.size") != F.col("r.size"), "size differs")
        .when(F.col("m.path").isNull(), "not in manifest")
        .when(F.col("l.sha256") != F.col("m.sha256"), "content differs")
        .otherwise("unchanged")
    )
    return joined.select(F.col("p").alias("path"), reason.alias("reason")).where("reason is not null")


def ranked_choice(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
