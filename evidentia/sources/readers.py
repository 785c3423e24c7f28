"""Readers of catalog exports and the sinks the engine writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Leading bytes (hex) of known types, with the offset of a second mark where one is needed.
SIGNATURES = [
    ("pdf", "255044462D", None, None),
    ("png", "89504E470D0A1A0A", None, None),
    ("jpg", "FFD8FF", None, None),
    ("gif", "47494638", None, None),
    ("webp", "52494646", 9, "57454250"),
    ("vtt", "574542565454", None, None),
]
#: Declared types that say nothing, and the most bytes taken of each type.
GENERIC = ["", "application/octet-stream", "binary/octet-stream", "application/x-download"]
CAPS = {"pdf": 200_000_000, "png": 50_000_000, "jpg": 50_000_000, "gif": 50_000_000, "webp": 50_000_000, "vtt": 10_000_000, "html": 20_000_000, "text": 20_000_000}


def exploded_json(spark: SparkSession, path: str, key: str, schema: T.StructType | None = None) -> DataFrame:
    """An object that holds one array, as rows. Without a schema all of the file is read to infer it."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path).select(F.inline(key))


def array_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)


def snapshots(spark: SparkSession, paths: list[str], stamp: str = "LastRefreshDateUtc", data: str = "Data") -> DataFrame:
    """Snapshot dumps united by name; the header's time goes to every record. Files are listed, never globbed."""
    read = spark.read.option("multiLine", True).json(paths)
    return read.select(F.to_timestamp_ntz(F.col(stamp)).alias("snapshot_utc"), F.inline(data))


def strict_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines under a full schema; a line that breaks it fails, and so does a key that no line has any more."""
    keys = spark.read.text(path).select(F.explode(F.json_object_keys("value")).alias("key")).distinct()  # as many as the schema has
    seen = {r["key"] for r in keys.collect()}
    missing = [f.name for f in schema.fields if f.name not in seen]
    if missing:
        raise ValueError(f"keys vanished from {path}: {missing}")
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet relation, or its empty typed stand-in where the path is absent."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def work_list(spark: SparkSession, path: str) -> DataFrame:
    """(url, query) from `url<TAB>query` lines; blank and # lines are skipped and the query is optional."""
    lines = spark.read.text(path).where((F.trim("value") != "") & ~F.trim("value").startswith("#"))
    parts = F.split("value", "\t", 2)
    return lines.select(F.trim(F.get(parts, 0)).alias("url"), F.nullif(F.trim(F.get(parts, 1)), F.lit("")).alias("query"))


def write_jsonl(df: DataFrame, path: str, key: str, one_file: bool = False) -> None:
    """One compact object per row, sorted by key, nulls written too; part files follow the key's order.

    `one_file` is for exports that a single reader takes: one task then writes all rows. Spark's committer puts the
    finished files in place together.
    """
    rows = df.orderBy(key)
    (rows.coalesce(1) if one_file else rows).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def sniff(content: Column, declared: Column) -> Column:
    """Type by leading bytes, else by the declaration; a generic declaration counts only with a signature."""
    head = F.hex(F.substring(content, 1, 16))
    kind = F.when(F.lit(False), F.lit(""))
    for name, mark, at, second in SIGNATURES:
        test = head.startswith(mark)
        if second:
            test = test & (F.substring(head, 2 * at - 1, len(second)) == second)
        kind = kind.when(test, name)
    plain = F.lower(F.trim(F.split_part(F.coalesce(declared, F.lit("")), F.lit(";"), F.lit(1))))
    kind = kind.when(plain.isin("text/html", "application/xhtml+xml"), "html").when(plain == "text/plain", "text")
    return kind.otherwise(F.lit(None))


def skip_reason(kind: Column, length: Column) -> Column:
    caps = F.create_map(*(F.lit(x) for pair in CAPS.items() for x in pair))
    return F.when(kind.isNull(), "content-type").when(length > F.try_element_at(caps, kind), "too-large")


def blobs(files: DataFrame) -> DataFrame:
    """(content_sha, content, length): every distinct content once, from binaryFile rows."""
    return files.select(F.sha2("content", 256).alias("content_sha"), "content", "length").dropDuplicates(["content_sha"])


def manifest(spark: SparkSession, folder: str, exclude: str = r"(?:^|/)\.") -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.where(~F.col("path").rlike(exclude)).select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def verify(files: DataFrame, noted: DataFrame) -> DataFrame:
    """(path, verdict) of a pulled tree: `unchanged`, `content differs`, `missing` or `not in manifest`."""
    a, b = files.select("path", F.col("sha256").alias("_is")), noted.select("path", F.col("sha256").alias("_was"))
    verdict = F.when(F.col("_is").isNull(), "missing").when(F.col("_was").isNull(), "not in manifest").when(F.col("_is") != F.col("_was"), "content differs").otherwise("unchanged")
    return a.join(b, "path", "full_outer").select("path", verdict.alias("verdict"))


def external(spark: SparkSession, name: str, source: str, **options: str) -> DataFrame:
    """Register a relation of another system (`jdbc`, `parquet`, ...) as a view for ad hoc SQL; filters reach its scan."""
    df = spark.read.format(source).options(**options).load()
    df.createOrReplaceTempView(name)
    return df


def watermarks(frames: dict[str, DataFrame], observed: dict[str, str]) -> DataFrame:
    """(artefact, n_records, observed_at): one row per relation, null where a relation claims no time."""
    out = None
    for name, df in frames.items():
        at = F.date_format(F.max(observed[name]), "yyyy-MM-dd HH:mm:ss") if name in observed else F.lit(None).cast("string")
        part = df.agg(F.count("*").alias("n_records"), at.alias("observed_at")).select(F.lit(name).alias("artefact"), "n_records", "observed_at")
        out = part if out is None else out.unionByName(part)
    return out


def capture_list(rows: DataFrame, column: str, *keys: str) -> DataFrame:
    """A JSON array of arrays whose first row names the fields, as one map-free row per capture: (keys of its list, timestamp, original, mimetype, statuscode)."""
    parsed = rows.select(*keys, F.from_json(column, "array<array<string>>").alias("a"))
    each = parsed.select(*keys, F.get("a", 0).alias("head"), F.posexplode("a").alias("i", "v")).where("i > 0")
    at = lambda name: F.get("v", F.array_position("head", name).cast("int") - 1).alias(name)
    return each.select(*keys, at("timestamp"), at("original"), at("mimetype"), at("statuscode"))
