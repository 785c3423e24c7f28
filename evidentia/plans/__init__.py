"""Registered queries over the given tables, each with its DuckDB counterpart where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


from evidentia.plans import audit, captured, catalog, corpus, indexed, ingest, mart, models, navigation, pages, records, searching, streams, vocabularies  # noqa: E402  they use `table`

MODULES = [catalog, mart, corpus, searching, indexed, navigation, records, pages, captured, models, ingest, streams, vocabularies, audit]
