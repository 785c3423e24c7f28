"""Session settings the engine relies on, and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "evidentia", master: str | None = None, **extra: str) -> SparkSession:
    """A session with UTC, ANSI and adaptive execution on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    } | extra
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one only where that is unset and all tasks run in one process (local tests)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if sc._jsc.sc().getCheckpointDir().isDefined() else None
    if current is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.match(r"local(\[[^-]*\])?$", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="evidentia-"))
        current = sc.getCheckpointDir()
    return current


def cut(df: DataFrame) -> DataFrame:
    """Materialise a small intermediate in the shared folder and forget its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Materialise a wide intermediate as compressed Parquet in the shared folder."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
