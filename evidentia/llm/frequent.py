"""The commonest rows of a count table, in a bounded number, without a sort of all rows or a limit per task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def commonest(counts: DataFrame, limit: int, n: str = "n") -> DataFrame:
    """At most `limit` rows of the largest counts: all rows down to the last count class that still fits.

    Classes are sixteenths of a power of two, so at most about a thousand of them reach the driver, however many
    rows or tasks there are. `counts` is read twice and should be stored.
    """
    level = F.floor(F.log2(F.col(n)) * 16)
    sizes = counts.groupBy(level.alias("level")).agg(F.count("*").alias("rows")).collect()
    total, least = 0, None
    for row in sorted(sizes, key=lambda r: -r["level"]):
        total += row["rows"]
        if total > limit:
            break
        least = row["level"]
    return counts.where(level >= least) if least is not None else counts.limit(0)
