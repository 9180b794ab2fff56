"""Places in a total order without a window over everything (O1, O2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weavegraph.operators.resolve import top_k
from weavegraph.sources.shared import stored

#: monotonically_increasing_id() has the partition above so many bits and the row in it below.
ROW_BITS = 33


def numbered(df: DataFrame, order: list[Column], by: list[str] | None = None, place: str = "place") -> DataFrame:
    """O1, O2: df with every row's place, from 1, in the order; with `by`, its place among the rows of equal `by`.

    Spark deals the rows out by ranges of the whole order, so neither one first key nor one group is a task, and sorts each
    range; a row's place is that in its range and the rows of the ranges before, of which there is one count a range. Rows
    that the order can't tell apart have places next to each other, in order of a hash of the whole row; only equal rows
    can't be dealt to several ranges.
    """
    groups = [F.col(c).asc_nulls_first() for c in by or []]
    tie = F.xxhash64(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}))
    keys = [*groups, *order, tie]
    dealt = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    made = stored(dealt.withColumn("at__", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("at__", ROW_BITS)
    counts = made.groupBy(part.alias("part__")).agg(F.count("*").alias("n__"))
    before = F.coalesce(F.sum("n__").over(Window.orderBy("part__").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row per range
    rows = made.withColumn("part__", part).join(counts.select("part__", before.alias("before__")), "part__")
    rows = rows.withColumn(place, F.col("before__") + F.col("at__").bitwiseAND(F.lit((1 << ROW_BITS) - 1)) + 1)
    if by:
        first = rows.groupBy(*by).agg(F.min(place).alias("first__"))
        same = [F.col(f"r__.`{c}`").eqNullSafe(F.col(f"f__.`{c}`")) for c in by]
        rows = rows.alias("r__").join(first.alias("f__"), same).select("r__.*", "first__").withColumn(place, F.col(place) - F.col("first__") + 1)
    return rows.select(*df.columns, F.col(place).cast("bigint").alias(place))


def quota_sample(df: DataFrame, stratum: str, order: list[str], quota: int, stride: int) -> DataFrame:
    """The first `quota` rows of each stratum in order, and of all other rows, in order over all strata, every stride-th from
    the first on. order must tell rows apart. The rest's places come from numbered(), so no stratum is one task there."""
    keys = [F.col(c).asc_nulls_first() for c in order]
    must = top_k(df, [stratum], keys, quota)
    rest = numbered(df.join(must.select(*order), order, "left_anti"), keys, place="place__")
    return must.unionByName(rest.filter((F.col("place__") - 1) % stride == 0).drop("place__"))
