"""Projections, filters and classifications (P1-P26) as column builders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_usable_id(df: DataFrame, fields: list[str]) -> list[Column]:
    """Id and id_field: the first field that is a whole number or a text that isn't blank. Booleans are no ids."""
    kinds = dict(df.dtypes)
    usable = {}
    for f in fields:
        if kinds[f] in ("tinyint", "smallint", "int", "bigint"):
            usable[f] = F.col(f).cast("string")
        elif kinds[f] == "string":
            usable[f] = F.when(F.trim(f) != "", F.trim(f))
    value = F.coalesce(*usable.values()) if usable else F.lit(None).cast("string")
    name = F.coalesce(*[F.when(v.isNotNull(), F.lit(f)) for f, v in usable.items()]) if usable else F.lit(None).cast("string")
    return [value.alias("id"), name.alias("id_field")]


def assign_kind(df: DataFrame, rules: list[tuple[str, str, str, str, str]], default: str) -> DataFrame:
    """Kind, method and inferred by the first rule (kind, method, column, equal|prefix|suffix|contains, value) that holds.

    Equality is exact, the hints are blind to case; all but the discriminator are inferred.
    """
    kind = method = None
    for k, m, column, how, value in rules:
        v, low = F.col(column), F.lower(column)
        holds = {"equal": v == value, "prefix": low.startswith(value.lower()), "suffix": low.endswith(value.lower()), "contains": low.contains(value.lower())}[how]
        kind = F.when(holds, k) if kind is None else kind.when(holds, k)
        method = F.when(holds, m) if method is None else method.when(holds, m)
    return df.withColumn("kind", kind.otherwise(default)).withColumn("method", method.otherwise("default")).withColumn("inferred", F.col("method") != "discriminator")


def classify_key(key: Column) -> Column:
    """P5: guid (32 hex digits), integer or address."""
    return F.when(key.rlike("^[0-9a-f]{32}$"), "guid").when(key.rlike("^[0-9]+$"), "integer").otherwise("address")


def first_true(conditions: dict[str, Column], otherwise: str | None = None) -> Column:
    """The name of the first condition that holds."""
    out = None
    for name, condition in conditions.items():
        out = F.when(condition, name) if out is None else out.when(condition, name)
    return out if otherwise is None else out.otherwise(otherwise)


def first_pattern(column: str, patterns: dict[str, str], scope: Column) -> Column:
    """The name of the first pattern found, within the scope; null elsewhere."""
    return first_true({k: scope & F.col(column).rlike(v) for k, v in patterns.items()})


def corroboration(found: Column, expected: Column) -> Column:
    """An id corroborates a join and never makes one."""
    return F.when(found.isNull(), "absent").when(found == expected, "match").otherwise("twin-mismatch")


def predicate_battery(df: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """Hits of every named test in one scan; tests without a hit keep their zero."""
    one = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in tests.items()])
    pairs = F.array(*[F.struct(F.lit(k).alias("pattern"), F.col(f"`{k}`").alias("hits")) for k in tests])
    return one.select(F.explode(pairs).alias("x")).select("x.pattern", "x.hits")


def predicate_hits(df: DataFrame, tests: dict[str, Column], keep: list[str]) -> DataFrame:
    """Keep and hits, the names of the tests that a row passes, in their order; rows without a hit have none. One scan."""
    names = F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(k)) for k, c in tests.items()])
    return df.select(*keep, F.array_compact(names).alias("hits"))


def closed_label(column: str, labels: dict[str, str]) -> Column:
    """The label of a value of a closed vocabulary; null has none, and a value outside is an error that names it."""
    known = F.coalesce(*[F.when(F.col(column) == k, F.lit(v)) for k, v in labels.items()])
    return F.when(F.col(column).isNull(), F.lit(None).cast("string")).when(known.isNotNull(), known).otherwise(F.raise_error(F.concat(F.lit(f"{column} has a value outside its vocabulary: "), F.col(column))))


def path_has(path: str, segments: list[str], separator: str = r"[.\[\]]+") -> Column:
    """Whether any segment of the path is among those given."""
    return F.arrays_overlap(F.split(path, separator), F.array(*map(F.lit, segments)))


def text_capable(term_id: Column, dev: Column) -> Column:
    """A localised string that can give text: it has a term, or else a text of its own."""
    return (F.coalesce(term_id, F.lit(0)) != 0) | (F.length(F.coalesce(dev, F.lit(""))) > 0)


def name_projection(df: DataFrame, name: str, part: str) -> tuple[DataFrame, DataFrame]:
    """P25: the rows whose name holds the part, and their distinct names with the number of rows."""
    rows = df.filter(F.contains(F.col(name), F.lit(part)))
    return rows, rows.groupBy(name).agg(F.count("*").alias("n"))


def verbatim(df: DataFrame, payload: str, fields: dict[str, str], keep: list[str]) -> DataFrame:
    """Payload fields (name to JSON path) as they are; missing ones stay null. A payload that isn't JSON gives nulls."""
    v = F.try_parse_json(payload)
    return df.select(*keep, *[F.try_variant_get(v, path, "string").alias(name) for name, path in fields.items()])
