"""Drift and regression between metric snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drift(metrics: DataFrame, seeds: DataFrame) -> DataFrame:
    """Metrics that differ from their seeds (metric, seed); metrics without a seed aren't compared."""
    return metrics.join(seeds, "metric").filter(~F.col("value").eqNullSafe(F.col("seed"))).select("metric", "seed", "value")


def regression(now: DataFrame, before: DataFrame, directions: DataFrame) -> DataFrame:
    """Per metric first-run, drift (another snapshot), ok, regression or improved. directions: exact, lower or higher is better."""
    j = now.join(before.select("metric", F.col("value").alias("was"), F.col("snapshot_id").alias("was_id")), "metric", "left").join(directions, "metric", "left")
    better = F.when(F.col("direction") == "lower", F.col("value") < F.col("was")).when(F.col("direction") == "higher", F.col("value") > F.col("was")).otherwise(F.lit(False))
    verdict = F.when(F.col("was").isNull(), "first-run").when(F.col("snapshot_id") != F.col("was_id"), "drift").when(F.col("value") == F.col("was"), "ok").when(better, "improved").otherwise("regression")
    return j.select("metric", "value", "was", verdict.alias("verdict"))


def within_bounds(metrics: DataFrame, bounds: DataFrame) -> DataFrame:
    """D3: metrics against absolute bounds (metric, low, high, snapshot_id): another snapshot only warns."""
    j = bounds.join(metrics.select("metric", "value", F.col("snapshot_id").alias("at")), "metric", "left")
    inside = (F.col("value") >= F.col("low")) & (F.col("value") <= F.col("high"))
    verdict = F.when(F.col("value").isNull(), "missing").when(inside, "ok").when(F.col("at") == F.col("snapshot_id"), "broken").otherwise("warning")
    return j.select("metric", "value", verdict.alias("verdict"))


def snapshot_diff(old: DataFrame, new: DataFrame, keys: list[str], buckets: int = 65_536) -> DataFrame:
    """Keys that were added, removed or changed between two snapshots of one row per key, and fields: of a changed row
    each column that differs, as structs of field, was and now (texts; null is a value like others).

    Rows fall into buckets by a hash of their key, and a bucket's digest is its number of rows and the sum of their hashes.
    Only rows of buckets whose digests differ are joined, so what didn't change is summed up and goes no further. A column
    that one snapshot lacks is null there. Null keys are keys.
    """
    rest = [c for c in [*old.columns, *[c for c in new.columns if c not in old.columns]] if c not in keys]
    text = lambda df, c: F.col(f"`{c}`") if c in df.columns else F.lit(None).cast("string")

    def marked(df: DataFrame) -> DataFrame:
        row = lambda columns: F.to_json(F.struct(*[text(df, c).alias(c) for c in columns]), {"ignoreNullFields": "false"})
        key = row(keys)
        values = F.array(*[F.to_json(F.struct(text(df, c).alias("v")), {"ignoreNullFields": "false"}) for c in rest]) if rest else F.array().cast("array<string>")
        return df.select(*keys, key.alias("key__"), F.pmod(F.xxhash64(key), F.lit(buckets)).alias("bucket__"), F.xxhash64(key, row(rest) if rest else F.lit("")).alias("hash__"), values.alias("values__"))

    def digest(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("bucket__").agg(F.struct(F.count("*"), F.sum(F.col("hash__").cast("decimal(38,0)"))).alias(name))

    was, now = marked(old), marked(new)
    both = digest(was, "w__").join(digest(now, "n__"), "bucket__", "full")
    open_ = both.filter(~F.col("w__").eqNullSafe(F.col("n__"))).select("bucket__")  # a row per bucket at most
    side = lambda df, p: df.join(open_, "bucket__", "left_semi").select("key__", F.struct(*keys).alias(f"{p}keys"), F.col("values__").alias(f"{p}values"))
    j = side(was, "w").join(side(now, "n"), "key__", "full")
    pairs = F.zip_with("wvalues", "nvalues", lambda a, b: F.struct(a.alias("was"), b.alias("now")))
    plain = lambda v: F.get_json_object(v, "$.v")
    named = F.transform(F.filter(F.zip_with(F.array(*map(F.lit, rest)).cast("array<string>"), pairs, lambda n, p: F.struct(n.alias("field"), p.alias("p"))), lambda x: x["p"]["was"] != x["p"]["now"]), lambda x: F.struct(x["field"].alias("field"), plain(x["p"]["was"]).alias("was"), plain(x["p"]["now"]).alias("now")))
    change = F.when(F.col("wkeys").isNull(), "added").when(F.col("nkeys").isNull(), "removed").when(F.size("fields") > 0, "changed")
    out = j.withColumn("fields", F.when(F.col("wkeys").isNotNull() & F.col("nkeys").isNotNull(), named)).withColumn("change", change).filter("change is not null")
    return out.select(*[F.coalesce(f"wkeys.`{k}`", f"nkeys.`{k}`").alias(k) for k in keys], "change", "fields")
