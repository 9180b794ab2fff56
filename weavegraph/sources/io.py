"""Sources and sinks (S1-S12). Paths may be any that Spark reads; absent optional inputs are empty tables, never errors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException


def scan_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One row per JSON line, by a given schema, so nothing is read twice; lines that don't parse are null rows and go."""
    rows = spark.read.schema(schema).json(path)
    return rows.dropna("all")


def scan_payload_tree(spark: SparkSession, root: str, pattern: str = "*.json") -> DataFrame:
    """Every JSON file under <root>/<family>/<class>/: family, class, bundle, path_id, payload (VARIANT); others that don't parse are left out."""
    files = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(root)
    path = F.col("_metadata.file_path")
    stem = F.regexp_extract(path, r"([^/]+)\.[A-Za-z0-9]+$", 1)
    rows = files.select(
        F.regexp_extract(path, r"([^/]+)/[^/]+/[^/]+$", 1).alias("family"),
        F.regexp_extract(path, r"([^/]+)/[^/]+$", 1).alias("class"),
        F.regexp_extract(stem, r"^(.+)_-?\d+$", 1).alias("bundle"),
        F.regexp_extract(stem, r"_(-?\d+)$", 1).try_cast("bigint").alias("path_id"),
        F.try_parse_json("value").alias("payload"),
    )
    return rows.filter("payload is not null")


def scan_class_family(spark: SparkSession, root: str, class_name: str, pattern: str = "*.json") -> DataFrame:
    """S3: one class's files only; the directory is chosen by path, so the others aren't listed."""
    return scan_payload_tree(spark, f"{root.rstrip('/')}/*/{class_name}", pattern)


def scan_single_json(spark: SparkSession, path: str, member: str, element: str) -> DataFrame:
    """The table in one big object's array; read by a narrow schema, to be written as Parquet once."""
    schema = T.StructType.fromDDL(f"`{member}` array<struct<{element}>>")
    return spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode(member).alias("r")).select("r.*")


def scan_file_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Path and length of every file; contents aren't read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")


def scan_optional(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> tuple[DataFrame, bool]:
    """The table and whether it is there; an absent one is empty with this schema."""
    try:
        return spark.read.schema(schema).format(fmt).load(path), True
    except AnalysisException as absent:
        if absent.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema), False


def scan_curated(df: DataFrame, key: str, required: list[str], column: str, targets: DataFrame, target: str) -> DataFrame:
    """A curated table, or an error if a key repeats, a required column is null, or a value of column dangles."""
    broken = {
        "repeated keys": df.groupBy(key).count().filter("count > 1"),
        "missing values": df.filter(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in required])),
        "dangling targets": df.join(targets.select(F.col(target).alias("t__")), F.col(column) == F.col("t__"), "left_anti"),
    }
    for what, rows in broken.items():
        if not rows.isEmpty():
            raise ValueError(f"curated table has {what}")
    return df


def sink_jsonl_sorted(df: DataFrame, path: str, key: list[str]) -> None:
    """JSON lines with sorted keys in the total order of key; the files' names follow the order."""
    df.orderBy(*key).select(F.to_json(F.struct(*sorted(df.columns))).alias("value")).write.text(path)


def sink_split(df: DataFrame, path: str, by: list[str], order: list[str]) -> None:
    """One folder per value of by, rows sorted inside their files. Rows are dealt by ranges of by and order together, so
    a value of many rows has several files, whose names follow the order, and no task has all of it."""
    df.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order).write.partitionBy(*by).parquet(path)


def projection_matches(shard: DataFrame, projection: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Rows by which a projection and its shard differ, either way."""
    want = shard.select(*[F.col(a).alias(b) for b, a in columns.items()])
    got = projection.select(*columns)
    return want.exceptAll(got).unionByName(got.exceptAll(want))


def content_manifest(df: DataFrame, by: list[str]) -> DataFrame:
    """Rows and an order-free hash of the contents per partition value: a sum of the rows' hashes, which any number of
    tasks can share and in which equal rows count each."""
    row = F.sha2(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}), 256)
    return df.groupBy(*by).agg(F.count("*").alias("n"), F.sum(F.conv(F.substring(row, 1, 15), 16, 10).cast("decimal(38,0)")).cast("string").alias("content"))


def file_manifest(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Path, length and sha256 of every file under root, in order of the paths."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256")).orderBy("path")


def media_rollup(df: DataFrame, first: str, second: str, size: str) -> DataFrame:
    """Count and bytes by class and by family, in one pass over grouping sets."""
    sets = df.groupingSets([[F.col(first)], [F.col(second)]], F.col(first), F.col(second))
    return sets.agg(F.count("*").alias("n"), F.sum(size).alias("bytes")).select(first, second, "n", "bytes")
