"""Operator 6: URL filters as an as-of join of captures with dated list entries, in DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The end of an interval that no later entry closes.
FOREVER = "9999-12-31 00:00:00"


def host_of(url: Column) -> Column:
    """Lower-case host; empty where there is none."""
    return F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//[^/?#]*(/[^?#]*)", 1)


def keys_of(url: Column) -> Column:
    """Everything a list may name for a URL: the host, its parent domains of two labels or more, and the host with each path prefix."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    last = F.greatest(F.size(labels) - 2, F.lit(0))
    domains = F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice(labels, i + 1, F.greatest(F.size(labels), F.lit(1))), "."))
    steps = F.filter(F.split(path_of(url), "/"), lambda s: s != "")
    numbers = F.when(F.size(steps) > 0, F.sequence(F.lit(1), F.size(steps))).otherwise(F.array().cast("array<int>"))
    prefixes = F.transform(numbers, lambda j: F.concat(host, F.lit("/"), F.array_join(F.slice(steps, 1, j), "/")))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.concat(domains, prefixes))


def intervals(entries: DataFrame) -> DataFrame:
    """Validity intervals [valid_from, valid_to) from dated entries (pattern, verdict, change, effective).

    An `add` holds until the pattern's next entry. Of entries at one instant the last counts, `remove` after `add` and
    verdicts in order of name; entries without a pattern or a date, and repeats, change nothing.
    """
    dated = entries.where("pattern is not null and effective is not null").select("pattern", "verdict", "change", "effective").distinct()
    order = Window.partitionBy("pattern").orderBy("effective", "change", "verdict")
    ends = dated.withColumn("valid_to", F.coalesce(F.lead("effective").over(order), F.lit(FOREVER).cast("timestamp")))
    return ends.where((F.col("change") == "add") & (F.col("effective") < F.col("valid_to"))).select("pattern", "verdict", F.col("effective").alias("valid_from"), "valid_to")


def evaluate(captures: DataFrame, entries: DataFrame, key: str = "page_id", url: str = "url", fetched: str = "fetched_at") -> DataFrame:
    """Every capture against the entries active when it was fetched: (key, n_active, decision, pattern).

    The longest active pattern decides, ties by name, then `allow` before others; without one the decision is `none`.
    Captures and intervals meet on pattern and month, so a host that holds a third of all captures is dealt over
    as many groups as there are months. A null URL or fetch time, or a URL without a host, meets nothing.
    Repeated rows keep their rows; other columns are not read; an empty table gives an empty result.
    """
    rows = captures.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(fetched).cast("timestamp").alias("at"), F.monotonically_increasing_id().alias("row"))
    month = F.year("at") * 12 + F.month("at")
    wanted = rows.select("row", "key", "at", F.explode_outer(keys_of(F.col("url"))).alias("pattern"), month.alias("month"))
    # without a pattern the row must still come out; a key of its own keeps such rows apart
    wanted = wanted.withColumn("pattern", F.coalesce("pattern", F.concat(F.lit(" "), F.col("row"))))
    span = captures.agg(F.min(F.col(fetched).cast("timestamp")).alias("low"), F.max(F.col(fetched).cast("timestamp")).alias("high")).first()
    valid = intervals(entries)
    first, last = F.greatest("valid_from", F.lit(span["low"]).cast("timestamp")), F.least("valid_to", F.lit(span["high"]).cast("timestamp"))
    number = lambda t: F.year(t) * 12 + F.month(t)
    active = valid.where(first <= last).withColumn("v_month", F.explode(F.sequence(number(first), number(last)))).withColumnRenamed("pattern", "v_pattern")
    met = (F.col("pattern") == F.col("v_pattern")) & (F.col("month") == F.col("v_month")) & (F.col("at") >= F.col("valid_from")) & (F.col("at") < F.col("valid_to"))
    joined = wanted.join(active, met, "left")
    rank = F.struct(F.length("v_pattern").alias("size"), F.col("v_pattern").alias("pattern"), (F.col("verdict") == "allow").alias("allow"), F.col("verdict").alias("verdict"))
    best = F.max(F.when(F.col("v_pattern").isNotNull(), rank))
    found = joined.groupBy("row", "key").agg(F.count("v_pattern").alias("n_active"), best.alias("best"))
    return found.select(F.col("key").alias(key), "n_active", F.coalesce("best.verdict", F.lit("none")).alias("decision"), F.col("best.pattern").alias("pattern"))
