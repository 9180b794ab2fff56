"""The folder that driver and executors share, and tables written there between steps."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. A local session without one (tests) gets one of its own; a cluster must name it."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="weavegraph-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, *partition_by: str, **options: str) -> DataFrame:
    """Write df to the shared folder, with Parquet's options, and read it back: cuts lineage in a way that outlives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    writer = df.write.options(**options)
    writer = writer.partitionBy(*partition_by) if partition_by else writer
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(*tables: DataFrame) -> None:
    """Delete tables that stored() wrote and nothing reads any more; what lies elsewhere is left alone."""
    for df in tables:
        spark = df.sparkSession
        make = spark._jvm.org.apache.hadoop.fs.Path
        root = make(shared_folder(spark))
        files = root.getFileSystem(spark._jsc.hadoopConfiguration())
        home = files.makeQualified(root).toUri().getPath().rstrip("/") + "/"
        tops = set()
        for f in df.inputFiles():
            path = make(f).toUri().getPath()
            if path.startswith(home):
                tops.add(path[len(home) :].split("/")[0])
        for top in tops:
            files.delete(make(root, top), True)
