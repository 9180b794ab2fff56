"""Reference resolution: equi-joins in ladders that keep every miss as a row with its reason."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weavegraph.functions.text import normalize_ref, strip_hash_suffix
from weavegraph.sources.shared import stored


def first_by_priority(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in a total order."""
    return top_k(df, keys, order, 1)


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str | None = None) -> DataFrame:
    """The first k rows of each key; Spark cuts each partition's rows to k before it shuffles them."""
    name = rank or "rank__"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col(name) <= k)
    return ranked if rank else ranked.drop(name)


def one_each(table: DataFrame, on: list[str]) -> DataFrame:
    """A lookup table with one row per key: of several the smallest. Spark joins it on the same partitioning."""
    rest = [c for c in table.columns if c not in on]
    if not rest:
        return table.select(*on).distinct()
    return table.groupBy(*on).agg(F.min(F.struct(*rest)).alias("one__")).select(*on, *[F.col(f"one__.`{c}`").alias(c) for c in rest])


def locate(refs: DataFrame, entities: DataFrame, on: list[str]) -> DataFrame:
    """The entity at each reference's place; a place without one stays, as missing."""
    return resolve_ladder(refs, [("missing", entities, on)], resolved="located")


def resolve_ladder(refs: DataFrame, steps: list[tuple[str, DataFrame, list[str]]], status: str = "status", resolved: str = "resolved", unique: bool = False) -> DataFrame:
    """Refs against lookup tables in order. A step is (reason if missing, table, join columns); each table adds
    its other columns. status is the reason of the first step that misses, or resolved; later steps aren't tried then.

    Of a table's rows with one key the smallest counts, so references are neither lost nor multiplied; unique says that no
    table has any, as quality.unique() can check, which saves their grouping. A null key is a miss.
    """
    out, found = refs, []
    for i, (_, table, on) in enumerate(steps):
        mark = f"hit_{i}__"
        out = out.join((table if unique else one_each(table, on)).withColumn(mark, F.lit(True)), on, "left")
        found.append(mark)
    case = reduce(lambda c, s: c.when(F.col(s[1]).isNull(), s[0][0]), list(zip(steps, found, strict=True))[1:], F.when(F.col(found[0]).isNull(), steps[0][0]))
    return out.withColumn(status, case.otherwise(resolved)).drop(*found)


def strict_lookup(refs: DataFrame, targets: DataFrame, on: list[str], target: str, cls: str | None = None, wanted: tuple[str, ...] | str = ()) -> DataFrame:
    """Resolved only if exactly one target has the key; of several the only one of a wanted class, else they are
    ambiguous; none is missing. wanted: the classes, or a column of refs that names one. Never a silent pick.

    Targets are counted per key, and per key and class, so no reference meets several rows.
    """
    one = targets.groupBy(*on).agg(F.min(target).alias(target), F.countDistinct(target).alias("homes__"))
    out = refs.join(one, on, "left")
    by_class = F.lit(None).cast(dict(targets.dtypes)[target])
    if cls is not None:
        only = F.when(F.countDistinct(target) == 1, F.min(target))
        if isinstance(wanted, str):
            mine = targets.groupBy(*on, F.col(cls).alias("cls__")).agg(only.alias("mine__"))
            out = out.withColumn("cls__", F.col(wanted)).join(mine, [*on, "cls__"], "left").drop("cls__")
        else:
            out = out.join(targets.filter(F.col(cls).isin(*wanted)).groupBy(*on).agg(only.alias("mine__")), on, "left")
        by_class = F.when(F.col("homes__") > 1, F.col("mine__"))
    status = F.when(F.col("homes__").isNull(), "missing").when(F.col("homes__") == 1, "resolved").when(by_class.isNotNull(), "resolved").otherwise("ambiguous")
    picked = F.when(F.col("homes__") == 1, F.col(target)).otherwise(by_class)
    return out.withColumn("status", status).withColumn(target, picked).drop("homes__", "mine__")


def coalesce_lookups(refs: DataFrame, tables: list[tuple[str, DataFrame]], on: list[str], value: str) -> DataFrame:
    """The first table that has the key gives the value; route names it, or none."""
    out = refs
    for i, (_, table) in enumerate(tables):
        out = out.join(one_each(table.select(*on, value), on).select(*on, F.col(value).alias(f"v{i}__")), on, "left")
    route = F.coalesce(*[F.when(F.col(f"v{i}__").isNotNull(), F.lit(n)) for i, (n, _) in enumerate(tables)], F.lit("none"))
    return out.withColumn(value, F.coalesce(*[F.col(f"v{i}__") for i in range(len(tables))])).withColumn("route", route).drop(*[f"v{i}__" for i in range(len(tables))])


def any_target_wins(candidates: DataFrame, keys: list[str], is_entity: str, is_scene: str, order: list[Column]) -> DataFrame:
    """Of all candidates of a reference any entity beats any scene; within these, the first in order. Others give none."""
    ranked = [F.col(is_entity).desc(), F.col(is_scene).desc(), *order]
    first = first_by_priority(candidates, keys, ranked)
    return first.withColumn("landing", F.when(F.col(is_entity), "entity").when(F.col(is_scene), "scene").otherwise("none"))


def guid_bridge(refs: DataFrame, entries: DataFrame, containers: DataFrame, entities: DataFrame, scenes: DataFrame) -> DataFrame:
    """All edges of each reference (refs, with a column guid): address, landing, bundle, path_id, kind, id.

    entries: guid, address, bundle (may be null); containers: bundle, address, path_id; entities: bundle, path_id, kind, id;
    scenes: bundle. At each address of a guid the containers of its own bundles count, or those of any bundle where these
    have none. The first entity among them, by bundle and path_id, is an edge. The first scene is one only where neither
    this address nor one before it, in order, had an entity. A reference without entries is a row with landing dangling,
    and one whose addresses lead nowhere a row with landing none.

    All of it is worked out once per guid, however many references share it.
    """
    entity, scene = F.struct("bundle", "path_id", "kind", "id"), F.struct("bundle", "path_id")
    known = entities.groupBy("bundle", "path_id").agg(F.min(F.struct("kind", "id")).alias("e__")).select("bundle", "path_id", "e__.kind", "e__.id")
    flagged = scenes.select("bundle").distinct().withColumn("scene__", F.lit(True))
    # Of a bundle's containers of one address the first counts where the bundle is asked for; all do where none is.
    placed = containers.select("bundle", "address", "path_id").distinct().join(known, ["bundle", "path_id"], "left").join(flagged, "bundle", "left")
    firsts = lambda df, by: df.groupBy(*by).agg(F.min(F.when(F.col("id").isNotNull(), entity)).alias("entity"), F.min(F.when(F.col("scene__"), scene)).alias("scene"))
    exact = placed.join(placed.groupBy("bundle", "address").agg(F.min("path_id").alias("path_id")), ["bundle", "address", "path_id"])
    asked = entries.select("guid", "address", "bundle").distinct()
    own = firsts(asked.filter("bundle is not null").join(exact, ["bundle", "address"]), ["guid", "address"]).withColumn("own__", F.lit(True))
    any_ = firsts(placed, ["address"]).select("address", F.col("entity").alias("any_entity"), F.col("scene").alias("any_scene"))
    at = asked.select("guid", "address").distinct().join(own, ["guid", "address"], "left").join(any_, "address", "left")
    pick = lambda mine, other: F.when(F.col("own__"), F.col(mine)).otherwise(F.col(other)).alias(mine)
    at = at.select("guid", "address", pick("entity", "any_entity"), pick("scene", "any_scene"))
    upto = Window.partitionBy("guid").orderBy("address")  # up to this address
    at = at.withColumn("had__", F.max(F.col("entity").isNotNull()).over(upto))
    landing = F.when(F.col("entity").isNotNull(), "entity").when(~F.col("had__") & F.col("scene").isNotNull(), "scene")
    edges = at.withColumn("landing", landing).filter("landing is not null")
    edges = edges.select("guid", "address", "landing", F.coalesce("entity.bundle", "scene.bundle").alias("bundle"), F.when(F.col("landing") == "entity", F.col("entity.path_id")).otherwise(F.col("scene.path_id")).alias("path_id"), "entity.kind", "entity.id")
    there = asked.select("guid").distinct().withColumn("there__", F.lit(True))
    out = refs.join(there, "guid", "left").join(edges, "guid", "left")
    return out.withColumn("landing", F.coalesce("landing", F.when(F.col("there__"), "none").otherwise("dangling"))).drop("there__")


def bridge_report(edges: DataFrame, keys: list[str]) -> DataFrame:
    """One row of counts over guid_bridge()'s rows; keys name a reference: refs, guids, refs with an address, with an
    entity, dangling guids, scene edges."""
    each = edges.groupBy("guid", *keys).agg(F.bool_or(F.col("landing") != "dangling").alias("placed"), F.bool_or(F.col("landing") == "entity").alias("hit"), F.count_if(F.col("landing") == "scene").alias("scenes"))
    by = each.groupBy("guid").agg(F.count("*").alias("n"), F.count_if("placed").alias("placed"), F.count_if("hit").alias("hit"), F.sum("scenes").alias("scenes"))
    return by.agg(F.sum("n").alias("refs"), F.count("*").alias("guids"), F.sum("placed").alias("resolved_to_address"), F.sum("hit").alias("resolved_to_entity"), F.count_if(F.col("placed") == 0).alias("dangling_guids"), F.sum("scenes").alias("scene_edges"))


def widen_for_residue(refs: DataFrame, narrow: DataFrame, wide: DataFrame, on: list[str], group: str) -> DataFrame:
    """A second pass over a wide index, cut to the groups that still have misses after the narrow one.

    Rows keep a column pass: 1, 2 or null. group is a column of refs and wide.
    """
    first = refs.join(narrow.select(*on).distinct().select(*on, F.lit(1).alias("p1")), on, "left")
    needed = first.filter("p1 is null").select(group).distinct()
    more = wide.join(needed, group, "left_semi").select(*on, F.lit(2).alias("p2")).distinct()
    return first.join(more, on, "left").withColumn("pass", F.coalesce("p1", "p2")).drop("p1", "p2")


def match_file_ref(refs: DataFrame, keys: DataFrame, ref: str, key: str) -> DataFrame:
    """The key that a reference's normalised name is (direct), else what stays of it without its hash (hash-suffix)."""
    named = refs.withColumn("d__", normalize_ref(ref)).withColumn("s__", strip_hash_suffix("d__"))
    known = keys.select(F.col(key).alias("k__")).distinct()
    out = named.join(known.select(F.col("k__").alias("d__"), F.col("k__").alias("direct__")), "d__", "left").join(known.select(F.col("k__").alias("s__"), F.col("k__").alias("suffix__")), "s__", "left")
    how = F.when(F.col("direct__").isNotNull(), "direct").when(F.col("suffix__").isNotNull(), "hash-suffix")
    return out.withColumn("match", how).withColumn("key", F.coalesce("direct__", "suffix__")).drop("d__", "s__", "direct__", "suffix__")


def key_dependencies(entries: DataFrame, files: DataFrame, file: str) -> DataFrame:
    """The two passes over a catalogue. entries: key, reference, dependency (texts, nulls allowed); files: the roster.

    First, references and dependencies in file form (ending in .bundle) meet the roster, directly or without their hash, which
    gives each key its files. Then dependencies in other form name keys, and stand for the files of these, one level deep.
    A row per key and what it leads to: key, target, via (file, hash-suffix, key, or for what leads nowhere dangling-file or
    dangling-key, whose target is the name itself).
    """
    form = lambda c: F.coalesce(F.lower(c).endswith(".bundle"), F.lit(False))
    named = entries.select("key", F.explode(F.array("reference", "dependency")).alias("name__"))
    first = match_file_ref(named.filter(form(F.col("name__"))).distinct().withColumnRenamed("key", "from__"), files, "name__", file)
    via = F.when(F.col("match") == "direct", "file").when(F.col("match") == "hash-suffix", "hash-suffix").otherwise("dangling-file")
    first = first.select(F.col("from__").alias("key"), F.coalesce("key", normalize_ref("name__")).alias("target"), via.alias("via")).distinct()
    held = first.filter(~F.col("via").startswith("dangling")).select(F.col("key").alias("name__"), "target").distinct()
    asked = entries.filter(F.col("dependency").isNotNull() & ~form(F.col("dependency"))).select("key", F.col("dependency").alias("name__")).distinct()
    second = asked.join(held, "name__", "left").select("key", F.coalesce("target", "name__").alias("target"), F.when(F.col("target").isNull(), "dangling-key").otherwise("key").alias("via"))
    return first.unionByName(second.distinct())


def reverse_lookup(refs: DataFrame, containers: DataFrame, on: list[str], address: str) -> DataFrame:
    """For each place the addresses that lead to it: how many, and the smallest; none is zero."""
    by = containers.groupBy(*on).agg(F.countDistinct(address).alias("addresses"), F.min(address).alias("first_address"))
    return refs.join(by, on, "left").fillna(0, ["addresses"])


def anti_missing(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Keys that one side has and the other lacks, both ways."""
    flags = left.select(*on, F.lit(True).alias("l__"), F.lit(False).alias("r__")).unionByName(right.select(*on, F.lit(False).alias("l__"), F.lit(True).alias("r__")))
    by = flags.groupBy(*on).agg(F.bool_or("l__").alias("l__"), F.bool_or("r__").alias("r__"))
    return by.filter(F.col("l__") != F.col("r__")).select(*on, F.when(F.col("l__"), "left").otherwise("right").alias("side"))


def two_hop_census(refs: DataFrame, objects: DataFrame, on: list[str], classes: DataFrame, class_on: list[str], source: str, cls: str, home: str) -> DataFrame:
    """References to objects to the objects' own classes: distinct sources per class, and its smallest home. What
    misses on the way is of the class unresolved."""
    j = resolve_ladder(refs, [("unresolved", objects, on), ("unresolved", classes, class_on)])
    name = F.when(F.col("status") == "resolved", F.col(cls)).otherwise("unresolved")
    by = j.groupBy(name.alias("class"), source).agg(F.count("*").alias("n"), F.min(home).alias("home"))
    return by.groupBy("class").agg(F.count("*").alias("sources"), F.sum("n").alias("refs"), F.min("home").alias("first_home"))


def presence_status(expected: DataFrame, present: DataFrame, on: list[str]) -> DataFrame:
    """Every expected row, and whether it is there."""
    there = present.select(*on).distinct().withColumn("p__", F.lit(True))
    return expected.join(there, on, "left").withColumn("presence", F.when(F.col("p__"), "present").otherwise("absent")).drop("p__")


def text_coincidence(rows: DataFrame, text: str, pivot: DataFrame, pivot_text: str) -> DataFrame:
    """Rows whose text is one of the pivot's. Texts meet by a hash, and then by themselves."""
    p = pivot.select(F.xxhash64(pivot_text).alias("h__"), F.col(pivot_text).alias("p__")).distinct()
    return rows.withColumn("h__", F.xxhash64(text)).join(p, "h__").filter(F.col(text) == F.col("p__")).drop("h__", "p__")


def inherit_pool(pools: DataFrame, twins: DataFrame, key: str, name: str, twin: str) -> DataFrame:
    """(key, name) that a twin has and its own pool lacks. pools: key, name; twins: key, twin.

    Both meet in one grouping, dealt to a fixed number of tasks: Spark would merge them to what is small when packed, and a
    task's pairs are many times as large in memory.
    """
    conf = pools.sparkSession
    tasks = max(int(conf.conf.get("spark.sql.shuffle.partitions")), 8 * conf.sparkContext.defaultParallelism)
    own = pools.select(key, name).distinct()
    theirs = twins.join(own.select(F.col(key).alias(twin), name), twin).select(key, name, F.lit(False).alias("own__"))
    held = own.filter(F.col(key).isNotNull() & F.col(name).isNotNull()).withColumn("own__", F.lit(True))  # a null is like none
    both = theirs.unionByName(held).repartition(tasks, key, name)
    return both.groupBy(key, name).agg(F.bool_or("own__").alias("own__")).filter(~F.col("own__")).select(key, name)


#: A box wider than the smallest cell doubled so often, or without finite ends, lies in one cell with everything of its key.
GRID_LEVELS, EVERYWHERE = 40, -1


def in_bounds(points: DataFrame, bounds: DataFrame, on: list[str], axes: list[str], first: str | None = None) -> DataFrame:
    """Points within any box of their key: |p - c| <= extent on each axis. bounds has c_<axis> and e_<axis>; with
    `first`, a column of bounds, the smallest of those of the boxes that a point is in comes with it. A point stays one row,
    however many boxes it is in; equal points each count. Nulls are in no box.

    A grid of several levels: cells are as wide as the median box, and twice as wide at each level up. A box lies at the
    level whose cells it fits in, so in two cells an axis at most; a point looks its one cell up at every level in use. No
    point meets boxes of its key that lie elsewhere.
    """
    c, e = {a: F.col(f"c_{a}").cast("double") for a in axes}, {a: F.col(f"e_{a}").cast("double") for a in axes}
    usual = bounds.agg(*[F.percentile_approx(e[a], 0.5).alias(a) for a in axes]).first()  # one row
    unit = {a: 2 * usual[a] if usual[a] and 0 < usual[a] < 1e300 else 1.0 for a in axes}
    width = F.greatest(*[2 * e[a] / unit[a] for a in axes]) if len(axes) > 1 else 2 * e[axes[0]] / unit[axes[0]]
    far = reduce(lambda x, y: x | y, [~(F.abs(c[a]) + e[a] < unit[a] * 2.0**50) for a in axes])
    level = F.when(far | (width > 2.0**GRID_LEVELS), EVERYWHERE).otherwise(F.greatest(F.ceil(F.log2(F.greatest(width, F.lit(1e-9)))), F.lit(0))).cast("int")
    whole = reduce(lambda x, y: x & y, [c[a].isNotNull() & (e[a] >= 0) for a in axes])

    def cell(x: Column, a: str) -> Column:
        """A coordinate's cell at the row's level; what lies beyond all boxes shares the last one."""
        size = F.pow(F.lit(2.0), F.col("level__")) * unit[a]
        return F.when(F.col("level__") == EVERYWHERE, 0).otherwise(F.floor(F.least(F.greatest(x / size, F.lit(-(2.0**52))), F.lit(2.0**52)))).cast("bigint")

    boxes = bounds.select(*on, *[f"c_{a}" for a in axes], *[f"e_{a}" for a in axes], *([F.col(first).alias("first__")] if first else [])).filter(whole).withColumn("level__", level)
    levels = [r[0] for r in boxes.select("level__").distinct().collect()]  # GRID_LEVELS + 2 at most
    for a in axes:
        boxes = boxes.withColumn(f"cell_{a}__", F.explode(F.sequence(cell(c[a] - e[a], a), cell(c[a] + e[a], a))))
    mine = stored(points.withColumn("point__", F.monotonically_increasing_id()), "points")
    spread = mine.select(*on, *axes, "point__").filter(reduce(lambda x, y: x & y, [F.col(a).isNotNull() for a in axes]))
    spread = spread.withColumn("level__", F.explode(F.array(*map(F.lit, levels)) if levels else F.array().cast("array<int>")))
    spread = spread.select("*", *[cell(F.col(a).cast("double"), a).alias(f"cell_{a}__") for a in axes])
    inside = reduce(lambda x, y: x & y, [F.abs(F.col(a) - F.col(f"c_{a}")) <= F.col(f"e_{a}") for a in axes])
    hits = spread.join(boxes, [*on, "level__", *[f"cell_{a}__" for a in axes]]).filter(inside)
    hits = hits.groupBy("point__").agg(*([F.min("first__").alias(first)] if first else [F.lit(1).alias("one__")]))
    return mine.join(hits, "point__").drop("point__", "one__")


def claimed(df: DataFrame, name_of: Callable[[Column], Column], priority: list[str], into: str) -> DataFrame:
    """Every row with the first of its names (name_of() of 0, 1, 2, ..) that no row before it, by priority, has. priority
    must tell rows apart; a row whose name is null has none.

    All rows claim their next name at once, a name goes to the first of those that claim or hold it, and the others claim
    again, until none is turned down: which gives what going through the rows one by one would.
    """
    t = stored(df.withColumn("row__", F.monotonically_increasing_id()).withColumn("try__", F.lit(0)), "names")
    while True:
        t = t.withColumn(into, name_of(F.col("try__")))
        holder = t.filter(F.col(into).isNotNull()).groupBy(into).agg(F.min(F.struct(*priority, "row__")).alias("holder__"))
        t = stored(t.join(holder, into, "left").withColumn("lost__", F.coalesce(F.col("holder__.row__") != F.col("row__"), F.lit(False))).drop("holder__"), "names")
        if t.filter("lost__").isEmpty():
            return t.drop("row__", "try__", "lost__")
        t = t.withColumn("try__", F.col("try__") + F.col("lost__").cast("int")).drop("lost__", into)


def _numbered(first: Column, second: Column) -> Callable[[Column], Column]:
    """first, then second, then <second>_2, _3 and so on."""
    return lambda n: F.when(n == 0, first).otherwise(F.concat(second, F.when(n > 1, F.concat(F.lit("_"), n.cast("string"))).otherwise("")))


def demote_collisions(df: DataFrame, key: str, ordinal: str, path_id: str) -> DataFrame:
    """Keys that several rows have get @r<ordinal>, and @p<path_id> where that isn't unique either. Where such a key is
    another row's already, the later one, by key, ordinal and path_id, gets @p<path_id> behind it, and then _2, _3 and so on."""
    several = F.count("*").over(Window.partitionBy(key)) > 1
    by_ordinal, by_path = F.concat(F.col(key), F.lit("@r"), F.col(ordinal).cast("string")), F.concat(F.lit("@p"), F.col(path_id).cast("string"))
    again = F.count("*").over(Window.partitionBy(key, ordinal)) > 1
    demoted = df.withColumn("demoted__", F.when(~several, F.col(key)).when(~again, by_ordinal).otherwise(F.concat(F.col(key), by_path)))
    return claimed(demoted, _numbered(F.col("demoted__"), F.concat("demoted__", by_path)), [key, ordinal, path_id], "unique_key").drop("demoted__")


def assign_unique_name(df: DataFrame, stem: str, order: str, priority: list[str] | None = None) -> DataFrame:
    """file_name, of which no two rows have the same: the stem, else <stem>_<order>, else <stem>_<order>_2, _3 and so on,
    the first that no row before it in the order of `priority` (by default stem and order) has. A null stem has no name."""
    first = F.col(stem).cast("string")
    return claimed(df, _numbered(first, F.concat(first, F.lit("_"), F.col(order).cast("string"))), priority or [stem, order], "file_name")


def modal_value(df: DataFrame, key: str, value: str) -> DataFrame:
    """Rows with the mode of their key (ties to the smaller value) and whether they deviate."""
    counts = df.groupBy(key, value).agg(F.count("*").alias("n__"))
    mode = first_by_priority(counts, [key], [F.col("n__").desc(), F.col(value)]).select(key, F.col(value).alias("mode"))
    return df.join(mode, key).withColumn("deviates", ~F.col(value).eqNullSafe(F.col("mode")))


def twin_disambiguate(df: DataFrame, keys: list[str], entity_id: str, payload_hash: str, axis: str) -> DataFrame:
    """Rows of one id: equal payloads merge (axes are their distinct axes, where more than one row merged); of different
    payloads the smallest hash keeps the id, others become id@<8 digits of their hash> and keep the id in original_id."""
    merged = df.groupBy(*keys, entity_id, payload_hash).agg(F.array_sort(F.collect_set(axis)).alias("all_axes"), F.count("*").alias("merged"))
    place = F.row_number().over(Window.partitionBy(*keys, entity_id).orderBy(payload_hash))
    twin = F.col("place__") > 1
    out = merged.withColumn("place__", place).withColumn("original_id", F.when(twin, F.col(entity_id)))
    out = out.withColumn(entity_id, F.when(twin, F.concat(F.col(entity_id), F.lit("@"), F.substring(payload_hash, 1, 8))).otherwise(F.col(entity_id)))
    return out.withColumn("axes", F.when(F.col("merged") > 1, F.col("all_axes"))).drop("place__", "all_axes")
