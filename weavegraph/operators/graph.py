"""Relation graph: edges, coverage matrix, ledgers, indexes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weavegraph.functions.text import norm_name
from weavegraph.operators.order import numbered
from weavegraph.operators.resolve import first_by_priority, one_each, top_k


def edge_dedup(refs: DataFrame, keys: list[str], location: list[str]) -> DataFrame:
    """A1: one edge per key, with the number of references and the smallest location; counted before the shuffle."""
    place = F.min(F.struct(*location))
    return refs.groupBy(*keys).agg(F.count("*").alias("ref_count"), place.alias("at")).select(*keys, "ref_count", *[F.col(f"at.{c}").alias(c) for c in location])


def pair_matrix(kinds: DataFrame, edges: DataFrame, unresolved: DataFrame) -> DataFrame:
    """A2: all ordered pairs of kinds, empty ones too. kinds (kind) is a closed list of a few rows, the only cross join here.

    edges: src_kind, src_id, dst_kind, method; unresolved: src_kind, dst_kind, n. Status is missing, partial or modeled.
    """
    pairs = kinds.select(F.col("kind").alias("src_kind")).crossJoin(kinds.select(F.col("kind").alias("dst_kind")))
    by_source = edges.groupBy("src_kind", "dst_kind", "src_id").agg(F.count("*").alias("n"), F.collect_set("method").alias("m"))  # methods are few
    methods = F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set("m")))), ",")
    measured = by_source.groupBy("src_kind", "dst_kind").agg(F.sum("n").alias("edges"), F.count("*").alias("sources"), methods.alias("methods"))
    open_ = unresolved.groupBy("src_kind", "dst_kind").agg(F.sum("n").alias("unresolved"))
    out = pairs.join(measured, ["src_kind", "dst_kind"], "left").join(open_, ["src_kind", "dst_kind"], "left").fillna(0, ["edges", "sources", "unresolved"]).fillna("", ["methods"])
    status = F.when((F.col("edges") > 0) & (F.col("unresolved") == 0), "modeled").when(F.col("edges") > 0, "partial").otherwise("missing")
    return out.withColumn("status", status)


def pair_profile(kinds: DataFrame, edges: DataFrame, unresolved: DataFrame, join_keys: list[tuple[str, str]], hard: list[str], top: int = 10) -> DataFrame:
    """A2: pair_matrix() with what carries each pair: top_fields, a map of its `top` fields with the most references, join_key,
    the name that the first of join_keys has whose pattern a method of the pair matches, and mechanism, hard if all its
    methods are, else inferred. edges have field and ref_count beside what pair_matrix() takes."""
    pair = ["src_kind", "dst_kind"]
    fields = edges.filter("field is not null").groupBy(*pair, "field").agg(F.sum(F.coalesce("ref_count", F.lit(1))).alias("refs"))
    few = top_k(fields, pair, [F.col("refs").desc(), F.col("field")], top).groupBy(*pair).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("field", "refs")))).alias("top_fields"))
    methods = edges.groupBy(*pair).agg(F.collect_set("method").alias("m__"))  # methods are few

    def has(pattern: str) -> Column:
        return F.exists("m__", lambda m: m.rlike(pattern))

    key = F.coalesce(*[F.when(has(pattern), F.lit(name)) for pattern, name in join_keys], F.lit("none"))
    mechanism = F.when(F.size("m__") == F.size(F.array_intersect("m__", F.array(*map(F.lit, hard)))), "hard").otherwise("inferred")
    out = pair_matrix(kinds, edges, unresolved).join(few, pair, "left").join(methods, pair, "left")
    return out.withColumn("join_key", key).withColumn("mechanism", mechanism).drop("m__")


def residue_attribution(residue: DataFrame, kinds: list[str], landing: str, leaf: str) -> DataFrame:
    """A3: charge a miss to the kind where it landed, else to the kind that its leaf name spells, else to none."""
    spelled = F.regexp_replace(F.lower(leaf), "[^a-z0-9]", "")
    named = F.coalesce(*[F.when(spelled == k.replace("-", ""), F.lit(k)) for k in kinds])
    basis = F.when(F.col(landing).isNotNull(), "landing").when(named.isNotNull(), "leaf").otherwise("tally")
    return residue.withColumn("charged_kind", F.coalesce(F.col(landing), named)).withColumn("basis", basis)


def registry_merge(rows: DataFrame, term_id: str, key: str, source: str, locale: str) -> DataFrame:
    """A5: one row per (id, key): its locales and smallest source; canonical is the smallest id of the key."""
    merged = rows.groupBy(term_id, key).agg(F.array_join(F.array_sort(F.collect_set(locale)), ",").alias("locales"), F.min(source).alias("source"))
    least = merged.groupBy(key).agg(F.min(term_id).alias("least__"))
    return merged.join(least, key).withColumn("canonical", F.col(term_id) == F.col("least__")).drop("least__")


def ledger(rows: DataFrame, keys: list[str], sample: str, cap: int = 5) -> DataFrame:
    """Problems with their counts and first few samples. Samples are cut to the cap before they are collected."""
    counts = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    few = top_k(rows.select(*keys, sample).distinct(), keys, [F.col(sample)], cap)
    samples = few.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list(sample)), ",").alias("samples"))
    return counts.join(samples, keys)


def catalog_report(rows: DataFrame, key: str, kind: str) -> DataFrame:
    """Totals of a key table in one aggregation: rows, distinct keys, nulls, keys with several rows, of these identical ones."""
    by = rows.groupBy(key).agg(F.count("*").alias("n"), F.countDistinct(kind).alias("kinds"))
    return by.agg(
        F.sum("n").alias("n_rows"),
        F.count_if(F.col(key).isNotNull()).alias("n_keys"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).alias("null_rows"),
        F.count_if(F.col("n") > 1).alias("repeated_keys"),
        F.count_if((F.col("n") > 1) & (F.col("kinds") == 1)).alias("repeated_identical"),
    )


def catalog_dependencies(rows: DataFrame, key: str, dependencies: str) -> DataFrame:
    """One row: edges (a key and each entry of its array of dependencies, repeats once), those whose target is a key, and
    distinct targets that aren't."""
    edges = rows.filter(F.col(key).isNotNull()).select(F.col(key).alias("k__"), F.explode(dependencies).alias("d__")).filter("d__ is not null").distinct()
    known = rows.select(F.col(key).alias("d__")).distinct().withColumn("known__", F.lit(True))
    by = edges.groupBy("d__").agg(F.count("*").alias("n")).join(known, "d__", "left")
    return by.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("edges"), F.coalesce(F.sum(F.when(F.col("known__"), F.col("n"))), F.lit(0)).alias("resolved"), F.count_if(F.col("known__").isNull()).alias("open_targets"))


def guid_index(rows: DataFrame, guid: str, address: str) -> DataFrame:
    """Per guid its rows, distinct addresses, the smallest of them, and the rows without an address; rows without guid aren't in it."""
    a = F.col(address)
    by = rows.filter(F.col(guid).isNotNull()).groupBy(guid, address).agg(F.count("*").alias("n"))
    return by.groupBy(guid).agg(F.sum("n").alias("entries"), F.count(a).alias("addresses"), F.min(a).alias("first_address"), F.coalesce(F.sum(F.when(a.isNull(), F.col("n"))), F.lit(0)).alias("null_addresses"))


def first_match_ladder(forms: DataFrame, tails: DataFrame, entity: str) -> DataFrame:
    """Forms (entity, form, form_rank) against tails (tail, family_rank, key), folded; the best family wins, then the best form, then the smallest key."""
    hits = forms.join(tails, F.lower("form") == F.lower("tail"))
    return first_by_priority(hits, [entity], [F.col("family_rank"), F.col("form_rank"), F.col("key")])


def resolve_names(names: DataFrame, targets: DataFrame, kind: str, name: str, target: str) -> DataFrame:
    """The target of the same kind and name (exact), else of the same normalised name (normalised, inferred), else none."""
    exact = targets.select(kind, F.col(target).alias(name), F.col(target).alias("exact__")).distinct()
    loose = targets.groupBy(kind, norm_name(target).alias("l__")).agg(F.min(target).alias("loose__"))
    joined = names.withColumn("l__", norm_name(name)).join(exact, [kind, name], "left").join(loose, [kind, "l__"], "left")
    how = F.when(F.col("exact__").isNotNull(), "exact").when(F.col("loose__").isNotNull(), "normalised").otherwise("none")
    return joined.withColumn("match", how).withColumn("target", F.coalesce("exact__", "loose__")).withColumn("inferred", F.col("match") == "normalised").drop("l__", "exact__", "loose__")


def closest_candidates(misses: DataFrame, targets: DataFrame, kind: str, name: str, target: str, k: int = 3, most_tokens: int = 8) -> DataFrame:
    """For names without a match, the k targets of their kind that share the most tokens (then the shorter, then the smaller).

    No token joins all its names with all its targets: a target is indexed under every set of its tokens, an index entry
    keeps the k best of its targets, and a name asks for every set of its own tokens. The k best by shared tokens are
    among those answers. Names or targets of more than most_tokens tokens would have too many sets; such pairs meet by
    single tokens instead, so nothing is left out.
    """
    tokens = lambda c: F.array_sort(F.array_distinct(F.filter(F.split(norm_name(c), "_"), lambda t: t != "")))
    left = misses.select(kind, name).distinct().withColumn("a__", tokens(name))
    right = targets.select(kind, target).distinct().withColumn("b__", tokens(target))
    sets = lambda c: F.expr(
        f"transform(sequence(1, cast(shiftleft(1, size({c})) - 1 as int)), m -> array_join(filter({c}, (t, i) -> (shiftright(m, i) & 1) = 1), '_'))"
    )
    best = [F.length(target), F.col(target)]
    few = lambda df, c: df.filter(F.size(c).between(1, most_tokens))
    index = top_k(few(right, "b__").select(kind, target, "b__", F.explode(sets("b__")).alias("set__")), [kind, "set__"], best, k)
    short = few(left, "a__").select(kind, name, "a__", F.explode(sets("a__")).alias("set__")).join(index, [kind, "set__"])
    one = lambda df, c: df.filter(F.size(c) > 0).withColumn("token__", F.explode(c))
    long_left, long_right = left.filter(F.size("a__") > most_tokens), right.filter(F.size("b__") > most_tokens)
    met = one(long_left, "a__").join(one(right, "b__"), [kind, "token__"]).unionByName(one(few(left, "a__"), "a__").join(one(long_right, "b__"), [kind, "token__"]))
    pairs = short.select(kind, name, target, "a__", "b__").unionByName(met.select(kind, name, target, "a__", "b__")).distinct()
    shared = pairs.select(kind, name, target, F.size(F.array_intersect("a__", "b__")).alias("overlap"))
    return top_k(shared, [kind, name], [F.col("overlap").desc(), *best], k, "rank")


def claim_overlay(claims: DataFrame, edges: DataFrame, keys: list[str]) -> DataFrame:
    """Claims against measured edges: confirms-hard if measured, adds-derived if both ends are known, else flags-missing."""
    joined = claims.join(edges.select(*keys).distinct().withColumn("m__", F.lit(True)), keys, "left")
    return joined.withColumn("effect", F.when(F.col("m__"), "confirms-hard").when(F.col("ends_known"), "adds-derived").otherwise("flags-missing")).drop("m__")


def resolved_claims(claims: DataFrame, targets: DataFrame, edges: DataFrame) -> DataFrame:
    """Claims between names (src_kind, src_name, dst_kind, dst_name) against measured edges (src_kind, src_id, dst_kind,
    dst_id): both ends go through resolve_names() against targets (kind, name, id; the smallest id of a name), and the
    overlay's effect follows. ends_known is whether both resolve, inferred whether either did so by its normalised name."""
    names, ids = targets.select("kind", "name").distinct(), targets.groupBy("kind", "name").agg(F.min("id").alias("id__"))

    def end(df: DataFrame, side: str) -> DataFrame:
        asked = df.select(F.col(f"{side}_kind").alias("kind"), F.col(f"{side}_name").alias("asked")).distinct()
        found = resolve_names(asked, names, "kind", "asked", "name").join(ids.withColumnRenamed("name", "target"), ["kind", "target"], "left")
        found = found.select(F.col("kind").alias(f"{side}_kind"), F.col("asked").alias(f"{side}_name"), F.col("id__").alias(f"{side}_id"), F.col("inferred").alias(f"{side}_inferred"))
        return df.join(found, [f"{side}_kind", f"{side}_name"], "left")

    both = end(end(claims, "src"), "dst")
    both = both.withColumn("ends_known", F.col("src_id").isNotNull() & F.col("dst_id").isNotNull()).withColumn("inferred", F.coalesce(F.col("src_inferred") | F.col("dst_inferred"), F.lit(False))).drop("src_inferred", "dst_inferred")
    return claim_overlay(both, edges, ["src_kind", "src_id", "dst_kind", "dst_id"])


def class_accounting(left: DataFrame, right: DataFrame, keys: list[str], reasons: DataFrame, by: str) -> DataFrame:
    """Rows of one side only, with the reason that their class has, or none (to be ledgered)."""
    flags = left.select(*keys, F.lit(True).alias("l__"), F.lit(False).alias("r__")).unionByName(right.select(*keys, F.lit(False).alias("l__"), F.lit(True).alias("r__")))
    both = flags.groupBy(*keys).agg(F.bool_or("l__").alias("l__"), F.bool_or("r__").alias("r__"))
    side = F.when(F.col("l__") & F.col("r__"), "both").when(F.col("l__"), "left").otherwise("right")
    return both.withColumn("side", side).drop("l__", "r__").join(reasons, by, "left")


def reverse_index(refs: DataFrame, key: str, usage: str, source: str) -> DataFrame:
    """A4: per key its usages, the smallest of them, and how many sources use it. Nothing is gathered per key."""
    by = refs.groupBy(key, source).agg(F.count("*").alias("n"), F.min(usage).alias("first"))
    return by.groupBy(key).agg(F.sum("n").alias("usages"), F.min("first").alias("first_usage"), F.count("*").alias("sources"))


def usage_list(refs: DataFrame, key: str, usage: list[str]) -> DataFrame:
    """A4: every distinct usage of a key with its place, from 1, among the key's usages in order: the sorted index as rows, so
    that a key may have any number of them."""
    return numbered(refs.select(key, *usage).distinct(), [F.col(c).asc_nulls_first() for c in usage], [key])


def join_report(refs: DataFrame, group: str, conditions: dict[str, Column], everything: str = "all") -> DataFrame:
    """Counts of named conditions per group and over all, in one pass."""
    sums = refs.rollup(group).agg(F.count("*").alias("refs"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in conditions.items()], F.grouping(group).alias("g__"))
    return sums.withColumn(group, F.when(F.col("g__") == 1, everything).otherwise(F.col(group))).drop("g__")


def id_space_sweep(ids: DataFrame, cls: str, number: str, reference: DataFrame, ref: str) -> DataFrame:
    """Per class its distinct ids, how many are in the reference set, and whether the two spaces agree, overlap or diverge."""
    own, known = ids.select(cls, number).distinct(), reference.select(F.col(ref).alias(number)).distinct().withColumn("k__", F.lit(True))
    by = own.join(known, number, "left").groupBy(cls).agg(F.count("*").alias("ids"), F.count("k__").alias("overlap"))
    return by.withColumn("verdict", F.when(F.col("overlap") == F.col("ids"), "agreed").when(F.col("overlap") > 0, "overlapping").otherwise("divergent"))


def surface_coverage(rows: DataFrame, cls: str, prefixes: list[str]) -> DataFrame:
    """Classes with their number of rows: mapped by the first prefix that fits, or a gap."""
    counts = rows.groupBy(F.col(cls).alias("class_name")).agg(F.count("*").alias("n"))
    rule = F.coalesce(*[F.when(F.col("class_name").startswith(p), F.lit(p)) for p in prefixes], F.lit(None).cast("string"))
    return counts.withColumn("rule", rule).withColumn("coverage", F.when(F.col("rule").isNotNull(), "mapped").otherwise("gap"))


#: Reasons of references that don't resolve; fixed values.
STALE_NAME, EMPTY_NAME, ABSENT = "stale-name", "empty-sub-name", "dlc-content-absent"


def join_by_name(refs: DataFrame, catalogue: DataFrame, sub_name: str, chain: str, name: str) -> DataFrame:
    """A reference is resolved iff its sub-name is one of the catalogue's. The first broken step of its chain (none if
    whole) is evidence for the reason only."""
    names = catalogue.select(F.col(name).alias(sub_name)).distinct().withColumn("n__", F.lit(True))
    named, whole = F.coalesce(F.col(sub_name), F.lit("")) != "", F.col(chain) == "none"
    out = refs.join(names, sub_name, "left").withColumn("resolved", F.coalesce("n__", F.lit(False)) & named).drop("n__")
    return out.withColumn("reason", F.when(F.col("resolved"), F.lit(None).cast("string")).when(~whole, ABSENT).when(named, STALE_NAME).otherwise(EMPTY_NAME))


def route_counts(joined: DataFrame, sub_name: str) -> DataFrame:
    """Of join_by_name(), references and distinct names by outcome."""
    by = joined.groupBy("resolved", "reason", sub_name).agg(F.count("*").alias("n"))
    return by.groupBy("resolved", "reason").agg(F.sum("n").alias("n"), F.count(F.nullif(F.col(sub_name), F.lit(""))).alias("names"))


def manifest_indexes(manifest: DataFrame, path: str, place: list[str], cls: str, definitions: list[str]) -> dict[str, DataFrame]:
    """A manifest as keyed frames, one row per key: by_path, by_place (class and path), and definitions, of the
    definition classes only; and class_counts."""
    by_place = one_each(manifest.select(*place, cls, path), place)
    return {
        "by_path": one_each(manifest.select(path, *place, cls), [path]),
        "by_place": by_place,
        "definitions": by_place.filter(F.col(cls).isin(*definitions)).drop(cls),
        "class_counts": manifest.groupBy(cls).agg(F.count("*").alias("n")),
    }


def status_distribution(rows: DataFrame, registry: DataFrame, on: str, status: str, by: str) -> DataFrame:
    """Rows per group by their registry status; those that the registry lacks are unregistered."""
    known = one_each(registry.select(on, F.col(status).cast("string").alias("status")), [on])
    return rows.select(on, by).join(known, on, "left").groupBy(by, F.coalesce("status", F.lit("unregistered")).alias("status")).agg(F.count("*").alias("n"))


def condition_counts(df: DataFrame, by: list[str], conditions: dict[str, Column]) -> DataFrame:
    """Counts of named conditions per group in one pass."""
    return df.groupBy(*by).agg(F.count("*").alias("n"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in conditions.items()])


def object_index(objects: DataFrame, group: list[str], order: list[str], address: str | None = None) -> DataFrame:
    """Per file the number of objects and the first by order; with an address, also how many objects share theirs with
    another of the file (sharing). Objects are counted per address first, so no file is gathered."""
    by = objects.groupBy(*group, *([address] if address else [])).agg(F.count("*").alias("n__"), F.min(F.struct(*order)).alias("first__"))
    shared = F.sum(F.when((F.col("n__") > 1) & F.col(address).isNotNull(), F.col("n__")).otherwise(0)).alias("sharing") if address else None
    out = by.groupBy(*group).agg(F.sum("n__").alias("objects"), F.min("first__").alias("first__"), *([shared] if address else []))
    return out.select(*group, "objects", *(["sharing"] if address else []), *[F.col(f"first__.{c}").alias(f"first_{c}") for c in order])


def run_state(ledgers: dict[str, DataFrame], broken: Column) -> DataFrame:
    """Open rows of each ledger and the state of the run: broken, completed-with-ledger or complete."""
    out = None
    for name, df in ledgers.items():
        one = df.agg(F.count("*").alias("open_rows"), F.coalesce(F.bool_or(broken), F.lit(False)).alias("broken")).withColumn("ledger", F.lit(name))
        out = one if out is None else out.unionByName(one)
    state = F.when(F.col("broken"), "broken").when(F.col("open_rows") > 0, "completed-with-ledger").otherwise("complete")
    return out.select("ledger", "open_rows", state.alias("state"))


def axis_counts(datasets: dict[str, DataFrame], axis: str) -> DataFrame:
    """Rows per dataset and axis value."""
    out = None
    for name, df in datasets.items():
        one = df.select(F.lit(name).alias("dataset"), F.col(axis).alias("axis"))
        out = one if out is None else out.unionByName(one)
    return out.groupBy("dataset", "axis").agg(F.count("*").alias("n"))
