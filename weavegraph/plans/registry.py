"""How plans register their queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Tables:
    """The driver's tables by attribute: t.lineitem is its DataFrame."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def over_cores(df: DataFrame, each: int = 4) -> DataFrame:
    """df over all cores, `each` tasks a core: a small file is one task otherwise, however much work its rows make."""
    return df.repartition(each * df.sparkSession.sparkContext.defaultParallelism)


class Plans:
    """Queries and their SQL; used as a decorator with the SQL, or None where SQL has no like."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def __call__(self, sql: str | None = None):
        def add(f: Callable[[Tables], DataFrame]):
            def query(spark: SparkSession, sf_dir: str) -> DataFrame:
                return f(Tables(spark, sf_dir))

            query.__name__ = query.__qualname__ = f.__name__
            query.__doc__ = f.__doc__
            self.queries[f.__name__] = query
            if sql is not None:
                self.sql[f.__name__] = sql
            return f

        return add
