"""Data contracts: checks that give findings (check_id, dataset, status, expected, measured), Q1-Q21. Nothing is collected."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weavegraph.functions.text import norm_name, numbers_equal


def finding(df: DataFrame, check: str, dataset: str, expected: Column, measured: Column, status: Column | None = None) -> DataFrame:
    """One finding of a one-row frame: PASS where expected and measured agree."""
    same = F.when(expected.eqNullSafe(measured), "PASS").otherwise("FAIL")
    return df.select(F.lit(check).alias("check_id"), F.lit(dataset).alias("dataset"), (same if status is None else status).alias("status"), expected.cast("bigint").alias("expected"), measured.cast("bigint").alias("measured"))


def none_of(rows: DataFrame, check: str, dataset: str) -> DataFrame:
    """Fails by the number of rows given."""
    return finding(rows.agg(F.count("*").alias("n")), check, dataset, F.lit(0), F.col("n"))


def suite(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def keys_differ(raw: str, keys: list[str], exact: bool = True) -> Column:
    """Q1, row by row: the JSON keys aren't those expected (or, if not exact, lack some), or it isn't JSON."""
    have, want = F.json_object_keys(raw), F.array(*map(F.lit, keys))
    bad = have.isNull() | (F.size(F.array_except(want, have)) > 0)
    return F.coalesce(bad | (F.size(F.array_except(have, want)) > 0) if exact else bad, F.lit(True))


def keys_differ_by(raw: str, by: str, keys: dict[str, list[str]]) -> Column:
    """Q2, row by row."""
    want, have = F.coalesce(*[F.when(F.col(by) == k, F.array(*map(F.lit, v))) for k, v in keys.items()]), F.json_object_keys(raw)
    return F.coalesce(want.isNull() | have.isNull() | (F.size(F.array_except(want, have)) > 0) | (F.size(F.array_except(have, want)) > 0), F.lit(True))


def outside(column: str, values: list[str], prefixes: tuple[str, ...] = ()) -> Column:
    """Q3, row by row: a value that is neither in the domain nor starts with a templated prefix; null is none."""
    inside = F.col(column).isin(*values)
    for p in prefixes:
        inside = inside | F.col(column).startswith(p)
    return F.coalesce(~inside, F.lit(False))


def ungrammatical(column: str, pattern: str) -> Column:
    """Q4, row by row; null doesn't match."""
    return ~F.coalesce(F.col(column).rlike(pattern), F.lit(False))


def not_constant(column: str, value) -> Column:
    """Q5, row by row."""
    return ~F.col(column).eqNullSafe(F.lit(value))


def not_implied(condition: Column, consequence: Column) -> Column:
    """Q11, row by row: the condition holds and the consequence doesn't."""
    return F.coalesce(condition, F.lit(False)) & ~F.coalesce(consequence, F.lit(False))


def not_equivalent(a: Column, b: Column) -> Column:
    """Q12, row by row: exactly one of the two holds."""
    return F.coalesce(a, F.lit(False)) != F.coalesce(b, F.lit(False))


def not_derived(column: str, recomputed: Column) -> Column:
    """Q13, row by row."""
    return ~F.col(column).eqNullSafe(recomputed)


def over_cap(array: str, most: int) -> Column:
    """Q14, row by row; null has no length."""
    return F.coalesce(F.size(array) > most, F.lit(False))


def contract_suite(df: DataFrame, dataset: str, rules: list[tuple[str, Column]]) -> DataFrame:
    """Q1-Q5, Q11-Q14 of one dataset together: a finding per rule (check_id, the column that is true of a bad row), measured
    by one aggregate over one scan. Q3 counts rows here, not values."""
    counts = df.agg(*[F.count_if(bad).alias(f"n{i}") for i, (_, bad) in enumerate(rules)])
    each = F.array(*[F.struct(F.lit(check).alias("check_id"), F.col(f"n{i}").alias("n")) for i, (check, _) in enumerate(rules)])
    n = F.col("r.n")
    return counts.select(F.explode(each).alias("r")).select("r.check_id", F.lit(dataset).alias("dataset"), F.when(n == 0, "PASS").otherwise("FAIL").alias("status"), F.lit(0).cast("bigint").alias("expected"), n.alias("measured"))


def key_set(df: DataFrame, raw: str, keys: list[str], dataset: str, exact: bool = True) -> DataFrame:
    """Q1: rows whose JSON keys aren't those expected (or, if not exact, lack some). Text that isn't JSON fails."""
    return none_of(df.filter(keys_differ(raw, keys, exact)), "key-set", dataset)


def key_set_by(df: DataFrame, raw: str, by: str, keys: dict[str, list[str]], dataset: str) -> DataFrame:
    """Q2: as Q1, with the keys that the row's discriminator asks for; an unknown discriminator fails."""
    return none_of(df.filter(keys_differ_by(raw, by, keys)), "key-set-by", dataset)


def domain(df: DataFrame, column: str, values: list[str], dataset: str, prefixes: tuple[str, ...] = ()) -> DataFrame:
    """Q3: distinct values outside the domain; values that start with a templated prefix are inside."""
    return none_of(df.select(column).distinct().filter(outside(column, values, prefixes)), "domain", dataset)


def grammar(df: DataFrame, column: str, pattern: str, dataset: str) -> DataFrame:
    """Q4: names that don't match the grammar."""
    return none_of(df.filter(ungrammatical(column, pattern)), "grammar", dataset)


def constant(df: DataFrame, column: str, value, dataset: str) -> DataFrame:
    """Q5: rows whose column isn't this value."""
    return none_of(df.filter(not_constant(column, value)), "constant", dataset)


def unique(df: DataFrame, keys: list[str], dataset: str) -> DataFrame:
    """Q6: keys with more than one row."""
    return none_of(df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1"), "unique", dataset)


def identical_repeats(df: DataFrame, keys: list[str], dataset: str) -> DataFrame:
    """Q6: repeated keys whose rows differ; nulls count as values."""
    rest = [c for c in df.columns if c not in keys]
    return none_of(df.groupBy(*keys).agg(F.countDistinct(F.struct(*rest)).alias("n")).filter("n > 1"), "identical-repeats", dataset)


def foreign_key(df: DataFrame, column: str, target: DataFrame, key: str, dataset: str) -> DataFrame:
    """Q7: values that the target lacks; null points nowhere and is no miss."""
    return none_of(df.filter(F.col(column).isNotNull()).join(target.select(F.col(key).alias("fk__")), F.col(column) == F.col("fk__"), "left_anti"), "foreign-key", dataset)


def closure(df: DataFrame, kind: str, column: str, targets: DataFrame, dataset: str, special: tuple[str, ...] = (), normalised: tuple[str, ...] = ()) -> DataFrame:
    """Q7: a finding per kind of target: values that the targets (kind, id) of the kind lack. Special kinds have no table and
    are closed by themselves; normalised kinds meet by normalised names. Null points nowhere; a kind without targets fails
    by all its values."""
    key = F.when(F.col(kind).isin(*normalised), norm_name(column)).otherwise(F.col(column)) if normalised else F.col(column)
    there = F.when(F.col("kind").isin(*normalised), norm_name("id")).otherwise(F.col("id")) if normalised else F.col("id")
    known = targets.select(F.col("kind").alias("k__"), there.alias("t__")).distinct().withColumn("known__", F.lit(True))
    asked = df.filter(F.col(column).isNotNull()).select(F.col(kind).alias("k__"), key.alias("t__")).groupBy("k__", "t__").agg(F.count("*").alias("n"))
    missing = F.sum(F.when(F.col("known__").isNull() & ~F.coalesce(F.col("k__").isin(*special), F.lit(False)), F.col("n")).otherwise(0))
    by = asked.join(known, ["k__", "t__"], "left").groupBy("k__").agg(missing.alias("n"))
    return by.select(F.lit("closure").alias("check_id"), F.concat(F.lit(f"{dataset}:"), F.coalesce("k__", F.lit("none"))).alias("dataset"), F.when(F.col("n") == 0, "PASS").otherwise("FAIL").alias("status"), F.lit(0).cast("bigint").alias("expected"), F.col("n").alias("measured"))


def reconcile(left: DataFrame, right: DataFrame, dataset: str) -> DataFrame:
    """Two one-row frames with column v must agree."""
    both = left.select(F.col("v").cast("bigint").alias("a")).crossJoin(F.broadcast(right.select(F.col("v").cast("bigint").alias("b"))))
    return finding(both, "reconcile", dataset, F.col("a"), F.col("b"))


def census_reconcile(census: DataFrame, errors: DataFrame, manifest: DataFrame, catalogue: DataFrame, cls: str, exported: list[str], carved: list[str]) -> DataFrame:
    """Objects counted per class (class, n) against what accounts for them, and each carved-out class against its catalogue rows.

    accounted: manifest rows, catalogue rows, errors (n), and the residual, which is the objects of classes neither
    exported nor carved out.
    """
    per = census.groupBy(cls).agg(F.sum("n").alias("n"))
    count = lambda df, v: df.agg(F.coalesce(v, F.lit(0)).cast("bigint").alias("v"))
    parts = [count(manifest, F.count("*")), count(catalogue, F.count("*")), count(errors, F.sum("n")), count(per.filter(~F.col(cls).isin(*exported, *carved)), F.sum("n"))]
    whole = reconcile(count(per, F.sum("n")), reduce(DataFrame.unionByName, parts).agg(F.sum("v").alias("v")), "objects")
    want, got = per.filter(F.col(cls).isin(*carved)).select(cls, "n"), catalogue.groupBy(cls).agg(F.count("*").alias("m")).filter(F.col(cls).isin(*carved))
    each = want.join(got, cls, "full").select(F.col(cls).alias("c"), F.coalesce("n", F.lit(0)).alias("a"), F.coalesce("m", F.lit(0)).alias("b"))
    status = F.when(F.col("a") == F.col("b"), "PASS").otherwise("FAIL")
    return whole.unionByName(each.select(F.lit("carve-out").alias("check_id"), F.col("c").alias("dataset"), status.alias("status"), F.col("a").cast("bigint").alias("expected"), F.col("b").cast("bigint").alias("measured")))


def same_rows(left: DataFrame, right: DataFrame, dataset: str, check: str = "same-rows") -> DataFrame:
    """Q9, Q10: rows of one side only, either way, repeats counted."""
    return none_of(left.exceptAll(right).unionByName(right.exceptAll(left)), check, dataset)


def implication(df: DataFrame, condition: Column, consequence: Column, dataset: str) -> DataFrame:
    """Q11: rows where the condition holds and the consequence doesn't."""
    return none_of(df.filter(not_implied(condition, consequence)), "implication", dataset)


def equivalence(df: DataFrame, a: Column, b: Column, dataset: str) -> DataFrame:
    """Q12: rows where exactly one of the two holds."""
    return none_of(df.filter(not_equivalent(a, b)), "equivalence", dataset)


def derived(df: DataFrame, column: str, recomputed: Column, dataset: str) -> DataFrame:
    """Q13: rows whose column isn't what it derives from."""
    return none_of(df.filter(not_derived(column, recomputed)), "derived", dataset)


def cap(df: DataFrame, array: str, most: int, dataset: str) -> DataFrame:
    """Q14: rows whose array is longer than the cap."""
    return none_of(df.filter(over_cap(array, most)), "cap", dataset)


def pins(metrics: DataFrame, pinned: DataFrame) -> DataFrame:
    """Q15: measured metrics against pins (metric, snapshot_id, expected): STALE where the snapshot is another one."""
    j = pinned.join(metrics.select("metric", F.col("snapshot_id").alias("at"), "value"), "metric", "left")
    status = F.when(F.col("value").isNull(), "FAIL").when(F.col("at") != F.col("snapshot_id"), "STALE").when(F.col("value") == F.col("expected"), "PASS").otherwise("MISMATCH")
    return j.select("metric", status.alias("status"), "expected", "value")


def units(metrics: DataFrame, vocabulary: DataFrame, dataset: str) -> DataFrame:
    """Q16: metrics whose unit is null or outside the vocabulary."""
    known = metrics.join(vocabulary.select("unit").distinct(), "unit", "left_semi")
    return none_of(metrics.select("metric", "unit").exceptAll(known.select("metric", "unit")), "units", dataset)


def unit_comparisons(pairs: DataFrame, metrics: DataFrame, transforms: DataFrame) -> DataFrame:
    """Q16: comparisons (left_metric, right_metric) of metrics (metric, unit, value): same or differs where the units agree or a
    transform (source, target, factor) is registered from the left's to the right's, unregistered where none is, and
    missing where a metric or its unit is. expected is the left value in the right's unit."""
    side = lambda p: metrics.select(F.col("metric").alias(f"{p}_metric"), F.col("unit").alias(f"{p}_unit"), F.col("value").alias(f"{p}_value"))
    j = pairs.join(side("left"), "left_metric", "left").join(side("right"), "right_metric", "left")
    known = transforms.groupBy(F.col("source").alias("left_unit"), F.col("target").alias("right_unit")).agg(F.min("factor").alias("factor"))
    factor = F.when(F.col("left_unit") == F.col("right_unit"), F.lit(1.0)).otherwise(F.col("factor"))
    j = j.join(known, ["left_unit", "right_unit"], "left").withColumn("expected", F.col("left_value") * factor)
    gone = F.col("left_unit").isNull() | F.col("right_unit").isNull()
    verdict = F.when(gone, "missing").when(F.col("expected").isNull(), "unregistered").when(F.col("expected") == F.col("right_value"), "same").otherwise("differs")
    return j.select("left_metric", "right_metric", "expected", "right_value", verdict.alias("verdict"))


def ledger_counts(rows: DataFrame, reason: str, expected: DataFrame) -> DataFrame:
    """Q17: reasons with their counts against the expected ones (reason, expected); unknown reasons fail."""
    got = rows.groupBy(F.col(reason).alias("reason")).agg(F.count("*").alias("measured"))
    j = got.join(expected, "reason", "full")
    status = F.when(F.col("expected").isNull(), "FAIL").when(F.coalesce("measured", F.lit(0)) == F.col("expected"), "PASS").otherwise("MISMATCH")
    return j.select("reason", F.coalesce("measured", F.lit(0)).alias("measured"), "expected", status.alias("status"))


def known_failures(results: DataFrame, registry: DataFrame) -> DataFrame:
    """Q18: registered failures become KNOWN; registered checks that pass are FIXED."""
    j = results.join(registry.select("check_id", "dataset").distinct().withColumn("known__", F.lit(True)), ["check_id", "dataset"], "left")
    status = F.when((F.col("status") == "FAIL") & F.col("known__"), "KNOWN").when((F.col("status") == "PASS") & F.col("known__"), "FIXED").otherwise(F.col("status"))
    return j.withColumn("verdict", status).drop("known__")


def citations(values: DataFrame, sources: DataFrame) -> DataFrame:
    """Q19: values (id, source, path, value) against the cited source values (source, path, cited): ok, differs or uncited."""
    j = values.join(sources, ["source", "path"], "left")
    return j.withColumn("audit", F.when(F.col("cited").isNull(), "uncited").when(numbers_equal("value", "cited"), "ok").otherwise("differs"))


def one_id_space(df: DataFrame, a: str, b: str, dataset: str) -> DataFrame:
    """Q20: rows that fill two id columns that nothing reconciles."""
    return none_of(df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()), "id-space", dataset)


def verbatim_ids(emitted: DataFrame, source: DataFrame, keys: list[str], column: str, dataset: str) -> DataFrame:
    """Q21: emitted ids that differ from the source's at the same place, or have no source."""
    j = emitted.join(source.select(*keys, F.col(column).alias("source__")), keys, "left")
    return none_of(j.filter(~F.col(column).eqNullSafe(F.col("source__"))), "verbatim-ids", dataset)
