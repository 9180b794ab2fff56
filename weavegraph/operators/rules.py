"""Rule datasets: prices, grades, costs, needs, carriers (A21-A25, A38-A40) and type ancestry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weavegraph.operators.graph import condition_counts
from weavegraph.operators.walk import opened
from weavegraph.sources.shared import stored


def differing_fields(df: DataFrame, base: DataFrame, on: list[str], fields: list[str]) -> DataFrame:
    """The fields in which a row differs from its base row, and how many."""
    b = base.select(*on, *[F.col(f).alias(f"b_{f}") for f in fields])
    j = df.join(b, on)
    differs = F.array_compact(F.array(*[F.when(~F.col(f).eqNullSafe(F.col(f"b_{f}")), F.lit(f)) for f in fields]))
    return j.withColumn("differs", F.array_join(differs, ",")).withColumn("n_differs", F.size(differs)).drop(*[f"b_{f}" for f in fields])


def price_ledger(parts: dict[str, DataFrame], expected: list[str], amount: str) -> DataFrame:
    """Sinks and sources in one ledger: rows and amount of every expected part, empty ones flagged."""
    out = None
    for name, df in parts.items():
        one = df.select(F.lit(name).alias("part"), F.col(amount).alias("amount"))
        out = one if out is None else out.unionByName(one)
    sums = out.groupBy("part").agg(F.count("*").alias("n"), F.sum("amount").alias("amount"))
    known = sums.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, expected))).alias("part"))
    return known.join(sums, "part", "left").fillna(0, ["n"]).withColumn("is_empty", F.col("n") == 0)


def cost_distribution(df: DataFrame, value: str, seed: DataFrame) -> DataFrame:
    """How often each value occurs, and whether the seed lacks it."""
    counts = df.groupBy(value).agg(F.count("*").alias("n"))
    return counts.join(seed.select(value).distinct().withColumn("s__", F.lit(True)), value, "left").withColumn("is_new", F.col("s__").isNull()).drop("s__")


def rates_by_attribute(df: DataFrame, entity: str, rates: str) -> DataFrame:
    """A map of rates per entity as rows (entity, attribute, rate)."""
    return df.select(entity, F.explode(rates).alias("attribute", "rate"))


def need_rates(blocks: DataFrame, keep: list[str], sources: dict[str, tuple[str, str]]) -> DataFrame:
    """Rates of typed blocks (class, data as VARIANT) as rows: keep, source, attribute, rate. A source is named by the class
    of its blocks and the path of an object of attribute to rate, or of a list of objects {attribute, rate}, in their data;
    other classes, members and rates that are no numbers give none. One scan."""

    def of(cls: str, at: str, name: str) -> Column:
        node = F.try_variant_get("data", at, "variant")
        pair = F.struct(F.lit(name).alias("source"), F.lit(None).cast("string").alias("attribute"), F.lit(None).cast("double").alias("rate"))
        members = F.transform(F.map_entries(F.try_variant_get(node, "$", "map<string,double>")), lambda e: F.struct(F.lit(name).alias("source"), e["key"].alias("attribute"), e["value"].alias("rate")))
        listed = F.transform(F.try_variant_get(node, "$", "array<variant>"), lambda x: F.struct(F.lit(name).alias("source"), F.try_variant_get(x, "$.attribute", "string").alias("attribute"), F.try_variant_get(x, "$.rate", "double").alias("rate")))
        return F.when(F.col("class") == cls, F.coalesce(members, listed, F.array(pair)))

    none = F.array().cast("array<struct<source:string,attribute:string,rate:double>>")
    every = F.concat(*[F.coalesce(of(cls, at, name), none) for name, (cls, at) in sources.items()])
    return blocks.select(*keep, F.explode(every).alias("r")).select(*keep, "r.*").filter("attribute is not null and rate is not null")


def terms_of_modules(df: DataFrame, keep: list[str], modules: str, labels: DataFrame) -> DataFrame:
    """Modules by ordinal with their labels and the number of modules; unknown ones keep a null label."""
    rows = df.select(*keep, F.size(modules).alias("n_modules"), F.posexplode(modules).alias("ordinal", "module"))
    return rows.join(labels, "module", "left")


def split_with_gaps(df: DataFrame, lookups: dict[str, DataFrame], on: str) -> DataFrame:
    """Rows with the lookups' values, and gaps, the names of those that have none."""
    out = df
    for name, table in lookups.items():
        out = out.join(table.select(on, F.col("value").alias(name)), on, "left")
    gaps = F.array_compact(F.array(*[F.when(F.col(n).isNull(), F.lit(n)) for n in lookups]))
    return out.withColumn("gaps", F.array_join(gaps, ","))


def absent_members(members: DataFrame, carriers: DataFrame, on: str) -> DataFrame:
    """Every member without a carrier, as a row that says so."""
    return members.join(carriers, on, "left_anti").withColumn("carrier", F.lit(None).cast("string")).withColumn("reason", F.lit("no carrier"))


def block_census(blocks: DataFrame, carrier: list[str], types: DataFrame, wanted: str) -> DataFrame:
    """Per class of typed blocks (class): member, whether the class is the wanted type or descends from it at once (P4),
    blocks, carriers, and the most blocks that one carrier has. types: type, base, interfaces."""
    members = ancestry_filter(types, wanted).select(F.col("type").alias("class")).distinct().withColumn("m__", F.lit(True))
    each = blocks.groupBy("class", *carrier).agg(F.count("*").alias("n"))
    by = each.groupBy("class").agg(F.sum("n").alias("blocks"), F.count("*").alias("carriers"), F.max("n").alias("most_in_one"))
    return by.join(members, "class", "left").withColumn("member", F.coalesce("m__", F.col("class") == wanted)).drop("m__")


def interaction_profile(rows: DataFrame, payload: str, key: str, fields: dict[str, str], modifiers: DataFrame, blocks: DataFrame, need: str, edges: DataFrame) -> DataFrame:
    """Per interaction: the fields as they stand in the payload (name to path, VARIANT), its modifier's kind and id where
    one resolved strictly (modifiers: key, status, kind, id), the classes of its typed blocks (blocks: key, block, class) by
    block key, those of them that a pattern calls needs, and its graph targets (edges: key, target), both distinct and
    sorted. An interaction's blocks and targets are few, and are gathered per interaction."""
    body = opened(rows, payload)
    out = rows.select(key, *[F.try_variant_get(body, at, "variant").alias(name) for name, at in fields.items()])
    m = modifiers.filter("status = 'resolved'").groupBy(key).agg(F.min(F.struct("kind", "id")).alias("modifier"))
    b = blocks.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("block", "class"))).alias("b__"))
    t = edges.groupBy(key).agg(F.array_sort(F.collect_set("target")).alias("targets"))
    classes = F.transform("b__", lambda x: x["class"])
    none = F.array().cast("array<string>")
    out = out.join(m, key, "left").join(b, key, "left").join(t, key, "left")
    out = out.withColumn("blocks", F.coalesce(classes, none)).withColumn("targets", F.coalesce(F.col("targets").cast("array<string>"), none)).drop("b__")
    return out.withColumn("needs", F.array_sort(F.array_distinct(F.filter("blocks", lambda c: c.rlike(need)))))


def profile(df: DataFrame, by: list[str], flags: dict[str, Column]) -> DataFrame:
    """Per key the number of rows and of those under each flag."""
    return condition_counts(df, by, flags)


def definition_gate(types: DataFrame, terminal: str, rounds: int = 32) -> DataFrame:
    """Each type (name, base) and what its chain of bases reaches: definition (the terminal), component (an end that is
    no type of the table) or unknown (a cycle, or more than 2**rounds steps). Chains are halved by pointer jumping, so a
    chain of n steps takes log2(n) joins; a type without base is its own end.
    """
    known = types.select("name", "base").distinct()
    chain = known.select("name", F.coalesce("base", "name").alias("at"))
    for _ in range(rounds):
        step = chain.select(F.col("name").alias("n__"), F.col("at").alias("next__"))
        jumped = chain.join(step, chain["at"] == step["n__"], "left").select("name", "at", F.coalesce("next__", "at").alias("next__"))
        jumped = stored(jumped, "chains")  # else the plan would double in each round
        moved = not jumped.filter("at <> next__").isEmpty()
        chain = jumped.select("name", F.col("next__").alias("at"))
        if not moved:
            break
    ends = known.filter("base is null").select(F.col("name").alias("e__"), F.lit(True).alias("closed__"))
    inner = known.select(F.col("name").alias("i__"), F.lit(True).alias("inner__"))
    j = chain.join(ends, F.col("at") == F.col("e__"), "left").join(inner, F.col("at") == F.col("i__"), "left")
    verdict = F.when(F.col("at") == terminal, "definition").when(F.col("closed__") | F.col("inner__").isNull(), "component").otherwise("unknown")
    return j.select("name", F.col("at").alias("reaches"), verdict.alias("verdict"))


def ancestry_filter(types: DataFrame, wanted: str) -> DataFrame:
    """Types whose base is the wanted one or that list it among their interfaces; spellings with namespace only."""
    return types.filter((F.col("base") == wanted) | F.coalesce(F.array_contains("interfaces", wanted), F.lit(False)))
