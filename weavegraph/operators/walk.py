"""Walks over nested payloads (N1-N15): a frontier that opens payloads level by level, and what is looked for on the way."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weavegraph.operators.resolve import strict_lookup
from weavegraph.sources.shared import stored

OBJECT, ARRAY = "OBJECT", "ARRAY"
HEX32 = "^[0-9a-f]{32}$"
#: Levels that one plan opens before what is still open is written; twice as many the next time, up to MOST_LEVELS.
LEVELS, MOST_LEVELS = 5, 10


def opened(df: DataFrame, payload: str) -> Column:
    """The payload as VARIANT: text is parsed; what isn't JSON, or nests deeper than the 1,000 levels that Spark parses, is null."""
    return F.try_parse_json(F.col(f"`{payload}`")) if dict(df.dtypes)[payload] == "string" else F.col(f"`{payload}`")


def broken_payloads(df: DataFrame, payload: str) -> DataFrame:
    """One row: payloads, those that are null, and those that aren't JSON or nest too deeply, in which no walk finds a node."""
    there = F.col(f"`{payload}`").isNotNull()
    return df.agg(F.count("*").alias("payloads"), F.count_if(~there).alias("nulls"), F.count_if(there & opened(df, payload).isNull()).alias("broken"))


def _is(node: Column, kind: str) -> Column:
    return F.schema_of_variant(node) == kind


def _whole(node: Column, at: str) -> Column:
    """Whether a member is a whole number of 64 bits; texts, fractions, true and false are none."""
    member = F.try_variant_get(node, at, "variant")
    return F.coalesce(F.try_variant_get(node, at, "bigint").isNotNull() & _is(member, "BIGINT"), F.lit(False))


def walk(df: DataFrame, payload: str, keep: list[str], hit: Column | None, values: dict[str, Column], blocked: tuple[str, ...] = (), again: bool = False, beside: bool = False, under: str = "") -> DataFrame:
    """The nodes that are hits, to any depth that Spark parses: keep, path, key, pos and the values.

    hit and values are columns over node__ (VARIANT), key__, pos__ and, if asked for, beside__, the asset of the reference
    that stands beside a key in its object (<key>Reference). An element of a list has the key of its list. A hit isn't
    opened, unless `again`; blocked keys aren't either, nor is what can't lead to a path that begins with `under`. Without a hit, the scalar nodes are found: what can't be opened
    and is no empty object or list.

    Every level is one variant_explode: found nodes ride along, open ones give their members. After LEVELS of them the rows
    are written; what is still open then goes on, so payloads of a few levels take one plan and no payload is parsed twice.
    """
    spark = df.sparkSession
    leaf = hit is None
    empty = F.lit(None).cast("string")
    found = F.struct(*[v.alias(n) for n, v in values.items()])
    columns = ["keep__", "path__", "key__", "pos__", "beside__", "node__"]

    def judged(rows: DataFrame, fresh: Column) -> DataFrame:
        """Fresh nodes as hits, which close, or as nodes that are still open; a row whose node is null is a find."""
        if leaf:
            return rows
        # Spark evaluates a column that is used twice once, as long as no filter on it moves below it: so there is none.
        rows = rows.withColumn("found__", F.when(fresh & F.coalesce(hit, F.lit(False)), found).otherwise(F.col("found__")))
        if not again:
            return rows.withColumn("node__", F.when(F.col("found__").isNull(), F.col("node__")))
        both = F.when(F.col("found__").isNotNull() & F.col("node__").isNotNull(), F.array(F.struct("found__", F.lit(None).cast("variant").alias("node__")), F.struct(F.lit(None).cast(found_type).alias("found__"), F.col("node__"))))
        rows = rows.withColumn("both__", F.explode(F.coalesce(both, F.array(F.struct("found__", "node__")))))
        return rows.select(*columns[:-1], F.col("both__.found__").alias("found__"), F.col("both__.node__").alias("node__"))

    keeps = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.struct(F.lit(1).alias("one__"))
    given = df.select(keeps.alias("keep__"), F.lit("").alias("path__"), empty.alias("key__"), F.lit(None).cast("int").alias("pos__"), empty.alias("beside__"), opened(df, payload).alias("node__"))
    found_type = given.select(found.alias("f")).schema["f"].dataType
    rows = judged(given.withColumn("found__", F.lit(None).cast(found_type)), F.col("node__").isNotNull())

    def step(rows: DataFrame) -> DataFrame:
        """One level down."""
        out = rows.lateralJoin(spark.tvf.variant_explode_outer(F.col("node__").outer()))
        child, named, done = F.col("pos").isNotNull(), F.col("key").isNotNull(), F.col("found__").isNotNull()
        # What has no member is a scalar, or empty: gone, but for scalars that are asked for.
        out = out.filter(child | done | F.col("node__").isNotNull() if leaf else child | done)
        if blocked:
            out = out.filter(~named | ~F.col("key").isin(*blocked))
        if leaf:
            kind = F.schema_of_variant("node__")
            scalar = ~done & ~child & ~kind.startswith(OBJECT) & ~kind.startswith(ARRAY)
            out = out.withColumn("found__", F.when(scalar, found).otherwise(F.col("found__")))
        quoted = F.when(~F.col("key").contains("'"), F.concat(F.lit("$['"), "key", F.lit("Reference'].m_AssetGUID"))).when(~F.col("key").contains('"'), F.concat(F.lit('$["'), "key", F.lit('Reference"].m_AssetGUID')))
        # Only pointers and lists of them ask for what stands beside their key.
        asks = named & (F.try_variant_get("value", "$.m_PathID", "bigint").isNotNull() | F.try_variant_get("value", "$[0]", "variant").isNotNull())
        asset = F.when(asks, F.try_variant_get("node__", quoted, "string")).when(~named, F.col("beside__"))
        path = F.when(~named, F.concat("path__", F.lit("["), F.col("pos").cast("string"), F.lit("]"))).when(F.col("path__") == "", F.col("key")).otherwise(F.concat("path__", F.lit("."), "key"))
        other = lambda new, old: F.when(child, new).otherwise(F.col(old))
        out = out.select(
            "keep__",
            other(path, "path__").alias("path__"),
            other(F.coalesce("key", "key__"), "key__").alias("key__"),
            other(F.when(~named, F.col("pos")), "pos__").alias("pos__"),
            (other(asset, "beside__") if beside else F.col("beside__")).alias("beside__"),
            F.col("value").alias("node__"),
            "found__",
        )
        if under:
            out = out.filter(F.startswith("path__", F.lit(under)) | F.startswith(F.lit(under), "path__"))
        return judged(out, F.col("node__").isNotNull())

    pieces, levels = [], LEVELS
    while True:
        for _ in range(levels):
            rows = step(rows)
        made = stored(rows.withColumn("open__", F.col("node__").isNotNull()), "walk")
        pieces.append(made.filter("found__ is not null"))
        rows = made.filter("open__").select(*columns, "found__")
        if made.filter("open__").select("open__").isEmpty():
            break
        levels = min(MOST_LEVELS, 2 * levels)
    whole = reduce(DataFrame.unionByName, pieces)
    whole = whole.filter(F.startswith("path__", F.lit(under))) if under else whole
    return whole.select(*[F.col(f"keep__.`{c}`").alias(c) for c in keep], F.col("path__").alias("path"), F.col("key__").alias("key"), F.col("pos__").alias("pos"), *[F.col(f"found__.`{n}`").alias(n) for n in values])


def leaves(df: DataFrame, payload: str, keep: list[str], blocked: tuple[str, ...] = (), under: str = "") -> DataFrame:
    """The scalar nodes: kind (VOID, BOOLEAN, STRING, BIGINT, DOUBLE) and value as text; a fraction is DOUBLE, and its text has
    no zeros at its end. With `under`, those whose path begins with it; nothing else is opened."""
    kind = F.schema_of_variant("node__")
    number = F.when(kind.rlike(r"^DECIMAL\(\d+,0\)$"), "BIGINT").when(kind.startswith("DECIMAL"), "DOUBLE").otherwise(kind)
    return walk(df, payload, keep, None, {"kind": number, "text": F.try_variant_get("node__", "$", "string")}, blocked, under=under)


POINTER = "OBJECT<m_FileID: BIGINT, m_PathID: BIGINT>"


def pointers(df: DataFrame, payload: str, keep: list[str], null_slots: bool = False, skipped: tuple[str, ...] = ("m_GameObject", "m_Script")) -> DataFrame:
    """Objects of exactly {m_FileID, m_PathID}: file_id, path_id, and paired, whether the key's own reference beside
    it (<key>Reference) has an asset. A pointer isn't opened. Those of (0, 0) point nowhere and are left out unless asked
    for, with those under a skipped key.
    """
    file_id, path_id = F.try_variant_get("node__", "$.m_FileID", "int"), F.try_variant_get("node__", "$.m_PathID", "bigint")
    # The schema of a node is only spelt where it has both members.
    hit = F.when(file_id.isNotNull() & path_id.isNotNull(), _is(F.col("node__"), POINTER))
    paired = F.coalesce(F.length(F.trim("beside__")) > 0, F.lit(False))
    found = walk(df, payload, keep, hit, {"file_id": file_id, "path_id": path_id, "paired": paired}, beside=True)
    return found if null_slots else found.filter(~F.coalesce(F.col("key").isin(*skipped), F.lit(False)) & ((F.col("file_id") != 0) | (F.col("path_id") != 0)))


def localised(df: DataFrame, payload: str, keep: list[str]) -> DataFrame:
    """Objects with _dev and _termID and at most three keys: term_id and dev text, empty if null; they aren't opened."""
    members = F.try_variant_get("node__", "$", "map<string,variant>")
    hit = F.when(_whole(F.col("node__"), "$._termID"), (F.size(members) <= 3) & F.map_contains_key(members, "_dev"))
    return walk(df, payload, keep, hit, {"term_id": F.try_variant_get("node__", "$._termID", "bigint"), "dev": F.coalesce(F.try_variant_get("node__", "$._dev", "string"), F.lit(""))})


def guid_refs(df: DataFrame, payload: str, keep: list[str], bare: bool = True) -> DataFrame:
    """Asset references by m_AssetGUID (guid, form dict, sub_name; not opened) and, if bare, also 32-hex texts that are
    members under keys that contain guid."""
    text = lambda at: F.when(_is(F.try_variant_get("node__", at, "variant"), "STRING"), F.try_variant_get("node__", at, "string"))
    guid, own = F.try_variant_get("node__", "$.m_AssetGUID", "string"), F.try_variant_get("node__", "$", "string")
    named = guid.rlike(HEX32) & text("$.m_AssetGUID").isNotNull()
    hit = F.coalesce(named, F.lit(False))
    if bare:
        under = F.col("pos__").isNull() & F.lower("key__").contains("guid") & (F.col("key__") != "m_AssetGUID")
        hit = hit | F.when(under, own.rlike(HEX32) & _is(F.col("node__"), "STRING"))
    form = F.when(guid.isNotNull(), "dict").otherwise("bare")
    return walk(df, payload, keep, hit, {"guid": F.coalesce(guid, own), "form": form, "sub_name": F.coalesce(text("$.m_SubObjectName"), F.lit(""))})


def pointer_residue(df: DataFrame, payload: str, keep: list[str], named: str = "icon") -> DataFrame:
    """Pointers whose key holds a word, in any case, that do point somewhere though the reference beside them is empty."""
    slots = pointers(df, payload, keep, null_slots=True)
    return slots.filter(F.lower("key").contains(named) & ~F.col("paired") & ((F.col("file_id") != 0) | (F.col("path_id") != 0)))


def residue_counters(slots: DataFrame, named: str = "icon") -> DataFrame:
    """One row of counts over all pointer slots: scanned, of null ones under such a key, residue, and of it same-file and external."""
    mine, null = F.lower("key").contains(named), (F.col("file_id") == 0) & (F.col("path_id") == 0)
    residue = mine & ~null & ~F.col("paired")
    return slots.agg(
        F.count("*").alias("scanned"),
        F.count_if(mine & null).alias("null_skipped"),
        F.count_if(residue).alias("residue"),
        F.count_if(residue & (F.col("file_id") == 0)).alias("same_file"),
        F.count_if(residue & (F.col("file_id") != 0)).alias("external"),
    )


def typed_blocks(df: DataFrame, payload: str, keep: list[str], at: str = "$.references") -> DataFrame:
    """One row per block of the references map: block key, class, data (VARIANT); version isn't one."""
    v = F.try_variant_get(opened(df, payload), at, "variant")
    blocks = df.select(*keep, v.alias("v__")).filter("v__ is not null")
    each = blocks.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("v__").outer())).filter("key is not null and key <> 'version'")
    return each.select(*keep, F.col("key").alias("block"), F.try_variant_get("value", "$.type.class", "string").alias("class"), F.try_variant_get("value", "$.data", "variant").alias("data"))


def block_pointers(df: DataFrame, payload: str, keep: list[str], at: str = "$.references") -> DataFrame:
    """The pointers inside each block's data: block, class, path within the data, file_id, path_id."""
    return pointers(typed_blocks(df, payload, keep, at), "data", [*keep, "block", "class"])


def unlock_edges(blocks: DataFrame, source: list[str], homes: DataFrame, objects: DataFrame, block_class: str, member: str, wanted: tuple[str, ...]) -> DataFrame:
    """Edges from the pointer at one member of the blocks of a class: source, block, file_id, path_id, status, kind, id.

    blocks: source, block, class, path, file_id, path_id (as block_pointers() gives them) and file, the source's own file.
    homes: file, file_id, home, the files that a file's number may stand for; 0 is the file itself. objects: home, path_id,
    kind, id and class. A pointer resolves strictly: to the only object there, or to the only one of a wanted class, else it
    is ambiguous; builtin where the home is null; missing without one. Equal edges of a source count once.
    """
    asked = blocks.filter((F.col("class") == block_class) & (F.col("path") == member)).select(*source, "block", "file", "file_id", "path_id")
    own = asked.filter("file_id = 0").withColumn("home", F.col("file"))
    away = asked.filter("file_id <> 0").join(homes.select("file", "file_id", "home", F.lit(True).alias("known__")), ["file", "file_id"], "left")
    every = away.unionByName(own.withColumn("known__", F.lit(True)))
    place = [*source, "block", "file_id", "path_id"]
    found = every.join(objects.select("home", "path_id", F.struct("kind", "id").alias("object__"), F.col("class").alias("object_class__")), ["home", "path_id"], "left")
    # Of a pointer's homes each may have the object: candidates per pointer, as strict_lookup() counts them.
    candidates = found.filter("object__ is not null").select(*place, "object__", "object_class__")
    settled = strict_lookup(asked.select(*place).distinct(), candidates, place, "object__", "object_class__", wanted)
    builtin = every.groupBy(*place).agg(F.bool_and(F.col("known__") & F.col("home").isNull()).alias("builtin__"))
    out = settled.join(builtin, place).withColumn("status", F.when((F.col("status") == "missing") & F.col("builtin__"), "builtin").otherwise(F.col("status")))
    return out.select(*place, "status", F.col("object__.kind").alias("kind"), F.col("object__.id").alias("id"))


def list_carriers(df: DataFrame, payload: str, keep: list[str]) -> DataFrame:
    """Which lists hold {id: N}, by the hex block key that N spells."""
    hit = F.when(F.col("pos__").isNotNull(), _whole(F.col("node__"), "$.id"))
    found = walk(df, payload, keep, hit, {"ref": F.try_variant_get("node__", "$.id", "bigint")}, again=True)
    carrier = F.regexp_replace("path", r"\[\d+\]$", "")
    return found.groupBy(*keep, F.lower(F.hex("ref")).alias("block")).agg(F.array_join(F.array_sort(F.collect_set(carrier)), ",").alias("carriers"))


def text_key_census(df: DataFrame, payload: str) -> DataFrame:
    """Localised structs per key: present, and able to give text."""
    return localised(df, payload, []).groupBy("key").agg(F.count("*").alias("present"), F.count_if((F.col("term_id") != 0) | (F.length("dev") > 0)).alias("capable"))


def normalize_field_path(path: str | Column) -> Column:
    """Leading dot gone, indexes empty."""
    c = F.col(path) if isinstance(path, str) else path
    return F.regexp_replace(F.regexp_replace(c, r"^\.", ""), r"\[\d+\]", "[]")


def pointer_get(payload: str, path: str, kind: str = "string") -> Column:
    """The value at a path such as a[3].b; null where there is none."""
    return F.try_variant_get(F.try_parse_json(payload), f"$.{path}", kind)


def unnest_cells(df: DataFrame, keys: str, names: str, cells: str) -> DataFrame:
    """Arrays of cells by position into (key, name, text)."""
    return df.select(F.col(keys).alias("key"), F.explode(F.arrays_zip(F.col(names).alias("name"), F.col(cells).alias("text"))).alias("c")).select("key", "c.name", "c.text")


def parse_entries(df: DataFrame, body: str, separator: str, keep: list[str]) -> DataFrame:
    """Separated Key=text entries; without an equals sign or a key they are malformed, and stay as rows that say so."""
    entry = df.select(*keep, F.explode(F.split(body, separator)).alias("entry"))
    key = F.trim(F.substring_index("entry", "=", 1))
    ok = F.contains("entry", F.lit("=")) & (key != "")
    return entry.select(*keep, F.when(ok, key).alias("key"), F.when(ok, F.regexp_replace("entry", r"(?s)^[^=]*=", "")).alias("text"), (~ok).alias("malformed"))


def explode_families(df: DataFrame, families: dict[str, str], keep: list[str]) -> DataFrame:
    """Several arrays of structs of equal fields into one table with record_family and ordinal."""
    parts = [df.select(*keep, F.lit(name).alias("record_family"), F.posexplode(column).alias("ordinal", "record")).select(*keep, "record_family", "ordinal", "record.*") for name, column in families.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _members(node: Column, at: str) -> Column:
    return F.coalesce(F.try_variant_get(node, at, "array<variant>"), F.array().cast("array<variant>"))


def _below(parents: Column, at: str) -> Column:
    """The records at a path of each parent (structs of ordinals and record)."""

    def of(parent: Column) -> Column:
        return F.transform(_members(parent["record"], at), lambda x, i: F.struct(F.concat(parent["ordinals"], F.array(i)).alias("ordinals"), x.alias("record")))

    return F.flatten(F.transform(parents, of))


def _decomposed(df: DataFrame, payload: str, keep: list[str], families: dict[str, tuple[str | None, str]]) -> DataFrame:
    """keep, and an array <family>__ for every family; parents come before their children in families."""
    out = df.select(*keep, opened(df, payload).alias("payload__"))
    for name, (parent, at) in families.items():
        top = F.transform(_members(F.col("payload__"), at), lambda x, i: F.struct(F.array(i).alias("ordinals"), x.alias("record")))
        out = out.withColumn(f"{name}__", top if parent is None else _below(F.col(f"{parent}__"), at))
    return out


def explode_records(df: DataFrame, payload: str, keep: list[str], families: dict[str, tuple[str | None, str]]) -> DataFrame:
    """Nested records of a payload in one pass: keep, record_family, ordinals and record (VARIANT), a row per record.

    families: name to (family that it lies in, or None for the payload itself, and the path of its array there), parents
    first. ordinals are the places, from 0, of a record's ancestors and its own, so with the family they are its key, and
    their first ones its parent's. An absent, null or other member than an array has no records; what isn't JSON has none.
    """
    wide = _decomposed(df, payload, keep, families)

    def named(name: str) -> Column:
        return F.transform(F.col(f"{name}__"), lambda r: F.struct(F.lit(name).alias("record_family"), r["ordinals"].alias("ordinals"), r["record"].alias("record")))

    every = F.concat(*map(named, families))
    # explode() would have Spark build all arrays once more, as a filter below, to leave out the empty ones.
    return wide.select(*keep, F.explode_outer(every).alias("r")).filter("r is not null").select(*keep, "r.record_family", "r.ordinals", "r.record")


def level_headers(df: DataFrame, payload: str, keep: list[str], families: dict[str, tuple[str | None, str]], fields: dict[str, str]) -> DataFrame:
    """A row per payload: keep, the fields (name to path, as text) and counts, a map of its records per family, zeros included."""
    wide = _decomposed(df, payload, keep, families)
    counts = F.create_map(*[x for name in families for x in (F.lit(name), F.coalesce(F.size(f"{name}__"), F.lit(0)))])
    return wide.select(*keep, *[F.try_variant_get("payload__", at, "string").alias(n) for n, at in fields.items()], counts.alias("counts"))


def grid_histogram(df: DataFrame, cells: str, keep: list[str]) -> DataFrame:
    """How often each value stands in an array of cells."""
    return df.select(*keep, F.explode(cells).alias("cell")).groupBy(*keep, "cell").agg(F.count("*").alias("n"))


def value_references(leaf_rows: DataFrame, known: DataFrame, path_pattern: str) -> DataFrame:
    """Text leaves under a path of this shape that equal a known id: inferred edges."""
    return leaf_rows.filter(F.col("path").rlike(path_pattern)).join(known, F.col("text") == F.col("known_id")).withColumn("inferred", F.lit(True))
