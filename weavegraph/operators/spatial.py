"""Placements, grids and bounds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def grid_size(width: str, height: str, cells_per_unit: int) -> Column:
    """Cells of a world extent given as half sizes: struct(w, h)."""
    return F.struct((F.col(width) * 2 * cells_per_unit).cast("int").alias("w"), (F.col(height) * 2 * cells_per_unit).cast("int").alias("h"))


def variants_of_mode(rows: DataFrame, point: list[str]) -> DataFrame:
    """Rows with variant, whether their point isn't the most frequent one (ties to the smallest). A point with a null is no
    point, and no variant either. The mode is one row."""
    whole = ~reduce(lambda a, b: a | b, [F.col(c).isNull() for c in point])
    counts = rows.filter(whole).groupBy(F.struct(*point).alias("p__")).agg(F.count("*").alias("n__"))
    mode = counts.agg(F.min(F.struct((-F.col("n__")).alias("n"), F.col("p__").alias("p"))).alias("m__"))
    out = rows.crossJoin(F.broadcast(mode)).withColumn("variant", F.coalesce(whole & (F.struct(*point) != F.col("m__.p")), F.lit(False)))
    return out.drop("m__")


def derived_world(parent: str, local: str, axes: list[str]) -> Column:
    """Parent position and local position added by axis; null if either lacks an axis."""
    return F.struct(*[(F.col(f"{parent}.{a}") + F.col(f"{local}.{a}")).alias(a) for a in axes])


def round_half_away(x: str | Column) -> Column:
    """Halves go away from zero."""
    c = F.col(x) if isinstance(x, str) else x
    return (F.signum(c) * F.floor(F.abs(c) + 0.5)).cast("int")


def crop_bounds(df: DataFrame, x: str, y: str, w: str, h: str, page_w: str, page_h: str) -> DataFrame:
    """Rounded crop with y counted from the top, and whether it lies on the page (judged after rounding)."""
    left, width, height = round_half_away(x), round_half_away(w), round_half_away(h)
    top = F.col(page_h).cast("int") - round_half_away(y) - height
    inside = (left >= 0) & (top >= 0) & (width > 0) & (height > 0) & (left + width <= F.col(page_w)) & (top + height <= F.col(page_h))
    return df.select("*", left.alias("crop_x"), top.alias("crop_y"), width.alias("crop_w"), height.alias("crop_h"), inside.alias("in_page"))


def decode_status(values: DataFrame, ids: DataFrame, group: str, value: str) -> DataFrame:
    """Per group how many distinct values are known ids: blocked if none, partial if some, decoded if all."""
    distinct = values.select(group, value).distinct()
    j = distinct.join(ids.select(F.col(value)).distinct().withColumn("k__", F.lit(True)), value, "left")
    n = j.groupBy(group).agg(F.count("*").alias("n_values"), F.count_if(F.coalesce("k__", F.lit(False))).alias("n_known"))
    return n.withColumn("status", F.when(F.col("n_known") == 0, "blocked").when(F.col("n_known") < F.col("n_values"), "partial").otherwise("decoded"))


def grid_extents(df: DataFrame, group: list[str], w: str, h: str) -> DataFrame:
    """Layers without size, the smallest and the largest by area (ties by width), and the greatest width and height."""
    some = (F.col(w) > 0) & (F.col(h) > 0)
    dims, area = F.concat_ws("x", F.col(w).cast("string"), F.col(h).cast("string")), F.struct(F.col(w) * F.col(h), F.col(w), F.col(h))
    return df.groupBy(*group).agg(
        F.count_if(~some).alias("zero_size"), F.min_by(F.when(some, dims), F.when(some, area)).alias("smallest"), F.max_by(F.when(some, dims), F.when(some, area)).alias("largest"), F.max(w).alias("max_w"), F.max(h).alias("max_h")
    )
