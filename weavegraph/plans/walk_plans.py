"""Walkers on nested payloads: events.props, and payloads made of orders, customers and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weavegraph.operators import rules as U
from weavegraph.operators import walk as K
from weavegraph.plans.registry import Plans, Tables, over_cores

plan = Plans()


def spread(t: Tables) -> DataFrame:
    """Orders over all cores: a small file is one task otherwise, and a payload is much more work than a row."""
    return t.orders.select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus").repartition(t.spark.sparkContext.defaultParallelism)


def payloads(t: Tables) -> DataFrame:
    """A nested payload per order: pointers, localised texts, asset references, typed blocks and lists."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    term = lambda i, d: F.struct(i.alias("_termID"), d.alias("_dev"))
    pointer = lambda f, p: F.struct(f.cast("int").alias("m_FileID"), p.cast("bigint").alias("m_PathID"))
    body = F.struct(
        F.struct(term(c % 3, F.when(k % 2 == 0, "").otherwise(F.col("o_orderpriority"))).alias("Name"), pointer(k % 2, c % 2).alias("Target"), F.col("o_orderstatus").alias("Status")).alias("main"),
        F.array(pointer(F.lit(0), F.lit(0)), pointer(F.lit(1), -c)).alias("links"),
        F.struct(F.md5(k.cast("string")).alias("m_AssetGUID"), F.lit("icon").alias("m_SubObjectName")).alias("icon"),
        F.md5(c.cast("string")).alias("ownerGuid"),
        F.array(F.struct((k % 20).alias("id")), F.struct((k % 20 + 1).alias("id"))).alias("blocks"),
        F.struct(F.struct(F.struct(F.lit("Block").alias("class")).alias("type"), F.struct(c.alias("n")).alias("data")).alias("a0"), F.lit(2).alias("version")).alias("references"),
    )
    return spread(t).select("o_orderkey", "o_custkey", F.to_json(body).alias("payload"))


@plan("select event_id, 'k' as path, json_extract_string(props, '$.k') as text from events where json_extract_string(props, '$.k') is not null")
def n1_walk_leaves(t: Tables) -> DataFrame:
    return K.leaves(t.events, "props", ["event_id"]).select("event_id", "path", "text")


@plan("select 'main.Target' as path, count(*) filter (o_orderkey % 2 <> 0 or o_custkey % 2 <> 0) as n, sum(o_custkey % 2) filter (o_orderkey % 2 <> 0 or o_custkey % 2 <> 0)::bigint as ids from orders union all select 'links[]', count(*), -sum(o_custkey)::bigint from orders")
def n2_walk_pointers(t: Tables) -> DataFrame:
    return K.pointers(payloads(t), "payload", ["o_orderkey"]).groupBy(K.normalize_field_path("path").alias("path")).agg(F.count("*").alias("n"), F.sum("path_id").alias("ids"))


@plan("select o_orderkey, o_custkey % 3 as term_id, case when o_orderkey % 2 = 0 then '' else o_orderpriority end as dev from orders")
def n3_walk_localised(t: Tables) -> DataFrame:
    return K.localised(payloads(t), "payload", ["o_orderkey"]).select("o_orderkey", "term_id", "dev")


@plan("select o_orderkey, 'dict' as form, md5(o_orderkey::varchar) as guid from orders union all select o_orderkey, 'bare', md5(o_custkey::varchar) from orders")
def n4_walk_guid_refs(t: Tables) -> DataFrame:
    return K.guid_refs(payloads(t), "payload", ["o_orderkey"]).select("o_orderkey", "form", "guid")


@plan("select count(*) as n, count(distinct md5(o_orderkey::varchar)) as guids from orders")
def n5_walk_guid_dicts(t: Tables) -> DataFrame:
    return K.guid_refs(payloads(t), "payload", ["o_orderkey"], bare=False).agg(F.count("*").alias("n"), F.countDistinct("guid").alias("guids"))


@plan("select 3 * count(*) as slots, count(*) + count(*) filter (o_orderkey % 2 = 0 and o_custkey % 2 = 0) as nulls from orders")
def n6_walk_pointer_slots(t: Tables) -> DataFrame:
    p = K.pointers(payloads(t), "payload", ["o_orderkey"], null_slots=True)
    return p.agg(F.count("*").alias("slots"), F.count_if((F.col("file_id") == 0) & (F.col("path_id") == 0)).alias("nulls"))


@plan("select o_orderkey, 'a0' as block, 'Block' as class, o_custkey as n from orders")
def n7_walk_typed_blocks(t: Tables) -> DataFrame:
    b = K.typed_blocks(payloads(t), "payload", ["o_orderkey"])
    return b.select("o_orderkey", "block", "class", F.try_variant_get("data", "$.n", "bigint").alias("n"))


@plan("select block, carriers, count(*) as n from (select printf('%x', o_orderkey % 20 + unnest([0, 1])) as block, 'blocks' as carriers from orders) group by 1, 2")
def n8_attach_list_carriers(t: Tables) -> DataFrame:
    return K.list_carriers(payloads(t), "payload", ["o_orderkey"]).groupBy("block", "carriers").agg(F.count("*").alias("n"))


@plan("select 'Name' as key, count(*) as present, count(*) filter (o_custkey % 3 <> 0 or o_orderkey % 2 <> 0) as capable from orders")
def n9_walk_text_keys(t: Tables) -> DataFrame:
    return K.text_key_census(payloads(t), "payload")


@plan("select o_orderkey, -o_custkey as second_link, o_orderstatus as status from orders")
def n10_n11_pointer_get(t: Tables) -> DataFrame:
    return payloads(t).select("o_orderkey", K.pointer_get("payload", "links[1].m_PathID", "bigint").alias("second_link"), K.pointer_get("payload", "main.Status").alias("status"))


@plan("select p_partkey as key, unnest(['name', 'brand', 'type']) as name, unnest([p_name, p_brand, p_type]) as text from part")
def n12_unnest_term_cells(t: Tables) -> DataFrame:
    d = t.part.select("p_partkey", F.array(*map(F.lit, ("name", "brand", "type"))).alias("names"), F.array("p_name", "p_brand", "p_type").alias("cells"))
    return K.unnest_cells(d, "p_partkey", "names", "cells")


@plan(
    """with e as (select p_partkey, unnest(string_split('Term/' || p_partkey || '=' || p_name || '=x[i2t]broken' || '[i2t]' || '=no key', '[i2t]')) as entry from part), x as (select *, contains(entry, '=') and trim(split_part(entry, '=', 1)) <> '' as ok from e)
    select p_partkey, case when ok then trim(split_part(entry, '=', 1)) end as key, case when ok then substr(entry, strpos(entry, '=') + 1) end as text, not ok as malformed from x"""
)
def n13_parse_delimited_entries(t: Tables) -> DataFrame:
    body = F.concat(F.lit("Term/"), F.col("p_partkey").cast("string"), F.lit("="), F.col("p_name"), F.lit("=x[i2t]broken[i2t]=no key"))
    return K.parse_entries(t.part.select("p_partkey", body.alias("body")), "body", r"\[i2t\]", ["p_partkey"])


@plan("select o_orderkey, 'items' as record_family, 0 as ordinal, o_custkey as id from orders union all select o_orderkey, 'staff', i::int, o_custkey + i from orders, range(0, 2) r(i)")
def n14_explode_scenarios(t: Tables) -> DataFrame:
    d = t.orders.select("o_orderkey", F.array(F.struct(F.col("o_custkey").alias("id"))).alias("items"), F.array(F.struct(F.col("o_custkey").alias("id")), F.struct((F.col("o_custkey") + 1).alias("id"))).alias("staff"))
    return K.explode_families(d, {"items": "items", "staff": "staff"}, ["o_orderkey"])


@plan("select label, x as cell, count(*) as n from (select label, unnest(list_transform(embedding, lambda e: (case when e > 0 then 1 else 0 end)::int)) as x from embeddings) group by 1, 2")
def n15_grid_histogram(t: Tables) -> DataFrame:
    d = t.embeddings.select("label", F.transform("embedding", lambda e: F.when(e > 0, 1).otherwise(0)).alias("cells"))
    return K.grid_histogram(d, "cells", ["label"])


@plan("select o_orderkey, o_orderstatus as text, true as inferred from orders where o_orderstatus in ('F', 'P')")
def j19_value_reference_probe(t: Tables) -> DataFrame:
    known = t.orders.filter("o_orderstatus <> 'O'").select(F.col("o_orderstatus").alias("known_id")).distinct()
    return K.value_references(K.leaves(payloads(t), "payload", ["o_orderkey"], under="main.Status"), known, r"^main\.Status$").select("o_orderkey", "text", "inferred")


def icon_payloads(t: Tables) -> DataFrame:
    """A payload per order with pointers beside references that are filled, empty or absent, some of them null."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    pointer = lambda f, p: F.struct(f.cast("int").alias("m_FileID"), p.cast("bigint").alias("m_PathID"))
    guid = F.when(k % 3 == 0, F.md5(k.cast("string"))).when(k % 3 == 1, F.lit(" "))
    body = F.struct(
        F.struct(pointer(k % 2, c % 5).alias("SmallIcon"), F.when(k % 3 < 2, F.struct(guid.alias("m_AssetGUID"))).alias("SmallIconReference")).alias("view"),
        F.array(F.struct(pointer(F.lit(2), c).alias("icon"))).alias("rows"),
        pointer(F.lit(0), c).alias("Target"),
    )
    return spread(t).select("o_orderkey", F.to_json(body).alias("payload"))


RESIDUE_SQL = """s as (select o_orderkey, 'view.SmallIcon' as path, o_orderkey % 2 as f, o_custkey % 5 as p, o_orderkey % 3 = 0 as paired, true as mine from orders union all select o_orderkey, 'rows[0].icon', 2, o_custkey, false, true from orders union all select o_orderkey, 'Target', 0, o_custkey, false, false from orders)"""


@plan(f"with {RESIDUE_SQL} select o_orderkey, path, f::int as file_id, p as path_id from s where mine and not paired and (f <> 0 or p <> 0)")
def a31_pointer_residue(t: Tables) -> DataFrame:
    return K.pointer_residue(icon_payloads(t), "payload", ["o_orderkey"]).select("o_orderkey", "path", "file_id", "path_id")


@plan(
    f"with {RESIDUE_SQL} select count(*) as scanned, count(*) filter (mine and f = 0 and p = 0) as null_skipped, count(*) filter (mine and not paired and (f <> 0 or p <> 0)) as residue, count(*) filter (mine and not paired and f = 0 and p <> 0) as same_file, count(*) filter (mine and not paired and f <> 0) as external from s"
)
def a31_residue_counters(t: Tables) -> DataFrame:
    return K.residue_counters(K.pointers(icon_payloads(t), "payload", ["o_orderkey"], null_slots=True))


def deep_payloads(t: Tables) -> DataFrame:
    """A payload per customer whose pointer lies under as many lists and objects as its key says, seven levels and more."""
    k = F.col("c_custkey")
    levels = (k % 6 + 4).cast("int")
    open_ = F.concat(F.repeat(F.lit('{"a":['), levels), F.lit('{"Leaf":{"m_FileID":1,"m_PathID":'), k.cast("string"), F.lit('},"m_Script":{"m_FileID":1,"m_PathID":7}}'), F.repeat(F.lit("]}"), levels))
    return t.customer.select("c_custkey", open_.alias("payload"))


@plan("select c_custkey, repeat('a[0].', (c_custkey % 6 + 4)::int) || 'Leaf' as path, 'Leaf' as key, c_custkey as path_id from customer")
def n2_deep_pointers(t: Tables) -> DataFrame:
    return K.pointers(deep_payloads(t), "payload", ["c_custkey"]).select("c_custkey", "path", "key", "path_id")


@plan("select 'Block' as class, count(*) as blocks, count(distinct o_orderkey) as carriers, count(*) filter (o_custkey % 2 = 0) as members from orders")
def a36_typed_block_census(t: Tables) -> DataFrame:
    b = K.typed_blocks(payloads(t), "payload", ["o_orderkey"])
    return b.groupBy("class").agg(F.count("*").alias("blocks"), F.countDistinct("o_orderkey").alias("carriers"), F.count_if(F.try_variant_get("data", "$.n", "bigint") % 2 == 0).alias("members"))


def block_payloads(t: Tables) -> DataFrame:
    """A payload per order with two typed blocks, one of which holds a pointer: to its own file, to files with a twin, to a builtin one, or to one that isn't known."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    pointer = F.struct((k % 5).cast("int").alias("m_FileID"), c.alias("m_PathID"))
    unlock = F.struct(F.struct(F.lit("Unlock").alias("class")).alias("type"), F.struct(pointer.alias("_course"), c.alias("n")).alias("data"))
    other = F.struct(F.struct(F.lit("Other").alias("class")).alias("type"), F.struct(F.array(pointer).alias("list")).alias("data"))
    body = F.struct(F.struct(unlock.alias("1f"), other.alias("20"), F.lit(2).alias("version")).alias("references"))
    return spread(t).select("o_orderkey", (k % 2).cast("string").alias("file"), F.to_json(body).alias("payload"))


@plan(
    """select o_orderkey, x.block, x.class, x.path, (o_orderkey % 5)::int as file_id, o_custkey as path_id from orders, (values ('1f', 'Unlock', '_course'), ('20', 'Other', 'list[0]')) x(block, class, path) where o_orderkey % 5 <> 0 or o_custkey <> 0"""
)
def n7_block_pointers(t: Tables) -> DataFrame:
    return K.block_pointers(block_payloads(t), "payload", ["o_orderkey"]).select("o_orderkey", "block", "class", "path", "file_id", "path_id")


UNLOCK_SQL = """with b as (select o_orderkey, (o_orderkey % 2)::varchar as file, (o_orderkey % 5)::int as f, o_custkey as p from orders where o_orderkey % 5 <> 0 or o_custkey <> 0),
homes as (select unnest(['0', '1']) as file, 1 as f, 'own' as home union all select unnest(['0', '1']), 2, 'twin' union all select unnest(['0', '1']), 2, 'own' union all select unnest(['0', '1']), 3, null),
objects as (select unnest(['own', 'twin']) as home, c_custkey as p, 'course' as kind, c_custkey::varchar as id, c_nationkey % 3 as n, c_acctbal > 0 as keep from customer),
o as (select home, p, kind, id || '@' || home as id, case when n = 0 then 'Course' when n = 1 and home = 'own' then 'Course' else 'Thing' end as class from objects where home = 'own' or keep union all
  select (c_custkey % 2)::varchar, c_custkey, 'room', c_custkey::varchar, 'Thing' from customer where c_custkey % 3 = 0),
hit as (select b.*, o.kind, o.id, o.class from b join homes using (file, f) join o on o.home = homes.home and o.p = b.p union all select b.*, o.kind, o.id, o.class from b join o on b.f = 0 and o.home = b.file and o.p = b.p),
n as (select o_orderkey, count(distinct id) as n, min((kind, id)) as one, count(distinct id) filter (class = 'Course') as m, min((kind, id)) filter (class = 'Course') as two from hit group by 1)
select o_orderkey, case when n is null and f = 3 then 'builtin' when n is null then 'missing' when n = 1 or m = 1 then 'resolved' else 'ambiguous' end as status, case when n = 1 then one[1] when m = 1 then two[1] end as kind, case when n = 1 then one[2] when m = 1 then two[2] end as id
from b left join n using (o_orderkey)"""


@plan(UNLOCK_SQL)
def a41_unlock_edges(t: Tables) -> DataFrame:
    blocks = K.block_pointers(block_payloads(t), "payload", ["o_orderkey", "file"])
    homes = t.spark.createDataFrame([(f, n, h) for f in "01" for n, h in ((1, "own"), (2, "twin"), (2, "own"), (3, None))], "file string, file_id int, home string")
    c = t.customer.withColumn("home", F.explode(F.array(F.lit("own"), F.lit("twin")))).filter("home = 'own' or c_acctbal > 0")
    course = (F.col("c_nationkey") % 3 == 0) | ((F.col("c_nationkey") % 3 == 1) & (F.col("home") == "own"))
    objects = c.select("home", F.col("c_custkey").alias("path_id"), F.lit("course").alias("kind"), F.concat(F.col("c_custkey").cast("string"), F.lit("@"), "home").alias("id"), F.when(course, "Course").otherwise("Thing").alias("class"))
    rooms = t.customer.filter("c_custkey % 3 = 0").select((F.col("c_custkey") % 2).cast("string").alias("home"), F.col("c_custkey").alias("path_id"), F.lit("room").alias("kind"), F.col("c_custkey").cast("string").alias("id"), F.lit("Thing").alias("class"))
    return K.unlock_edges(blocks, ["o_orderkey"], homes, objects.unionByName(rooms), "Unlock", "_course", ("Course",)).select("o_orderkey", "status", "kind", "id")


def scenario_payloads(t: Tables) -> DataFrame:
    """A scenario per customer: plots with layers and activation items, rooms with items, arrivals; some members absent."""
    k = F.col("c_custkey").cast("int")
    upto = lambda n, make: F.when(n > 0, F.transform(F.sequence(F.lit(1), n), make))
    item = lambda base: lambda i: F.struct((base + i).alias("id"))
    plot = lambda p: F.struct((k + p).alias("uid"), upto(k % 3, item(p * 10)).alias("Layers"), upto((k + p) % 2, item(p * 100)).alias("Activation"))
    room = lambda r: F.struct(r.alias("uid"), upto((k + r) % 4, lambda i: F.struct((r * 10 + i).alias("id"), upto(i % 2, item(r * 1000)).alias("Parts"))).alias("Items"))
    body = F.struct(F.col("c_name").alias("Name"), F.struct(upto(k % 3 + 1, plot).alias("Plots"), upto(k % 4, room).alias("Rooms"), upto(k % 2, item(k)).alias("Arrivals")).alias("Level"))
    return over_cores(t.customer.select("c_custkey", "c_name")).select("c_custkey", F.to_json(body).alias("payload"))


SCENARIO = {
    "plot": (None, "$.Level.Plots"),
    "layer": ("plot", "$.Layers"),
    "plot-activation": ("plot", "$.Activation"),
    "room": (None, "$.Level.Rooms"),
    "item": ("room", "$.Items"),
    "part": ("item", "$.Parts"),
    "arrival": (None, "$.Level.Arrivals"),
}
SCENARIO_SQL = """p as (select c_custkey as c, unnest(range(1, c_custkey % 3 + 2)) as p from customer), r as (select c_custkey as c, unnest(range(1, c_custkey % 4 + 1)) as r from customer),
i as (select *, unnest(range(1, (c + r) % 4 + 1)) as i from r), y as (select *, unnest(range(1, c % 3 + 1)) as y from p), v as (select *, unnest(range(1, (c + p) % 2 + 1)) as v from p), q as (select *, unnest(range(1, i % 2 + 1)) as q from i),
e as (select c, 'plot' as record_family, (p - 1)::varchar as ordinals, c + p as id from p union all select c, 'layer', (p - 1) || '.' || (y - 1), p * 10 + y from y union all select c, 'plot-activation', (p - 1) || '.' || (v - 1), p * 100 + v from v
union all select c, 'room', (r - 1)::varchar, r from r union all select c, 'item', (r - 1) || '.' || (i - 1), r * 10 + i from i union all select c, 'part', (r - 1) || '.' || (i - 1) || '.' || (q - 1), r * 1000 + q from q union all select c_custkey, 'arrival', '0', c_custkey + 1 from customer where c_custkey % 2 = 1)"""


@plan(f"with {SCENARIO_SQL} select c as c_custkey, record_family, ordinals, id from e")
def n14_nested_records(t: Tables) -> DataFrame:
    r = K.explode_records(scenario_payloads(t), "payload", ["c_custkey"], SCENARIO)
    return r.select("c_custkey", "record_family", F.array_join(F.col("ordinals").cast("array<string>"), ".").alias("ordinals"), F.coalesce(F.try_variant_get("record", "$.uid", "bigint"), F.try_variant_get("record", "$.id", "bigint")).alias("id"))


@plan(f"with {SCENARIO_SQL} select c_custkey, c_name as name, f.record_family, (select count(*) from e where e.c = c_custkey and e.record_family = f.record_family) as n from customer, (values ('plot'), ('layer'), ('plot-activation'), ('room'), ('item'), ('part'), ('arrival')) f(record_family)")
def n14_level_headers(t: Tables) -> DataFrame:
    h = K.level_headers(scenario_payloads(t), "payload", ["c_custkey"], SCENARIO, {"name": "$.Name"})
    # explode() would first ask below the shuffle, for all rows again, whether a map is empty; none is.
    return h.select("c_custkey", "name", F.explode_outer("counts").alias("record_family", "n")).select("c_custkey", "name", "record_family", F.col("n").cast("bigint").alias("n"))


@plan("select count(*) as payloads, count(*) filter (c_custkey % 7 = 0) as nulls, count(*) filter (c_custkey % 7 > 0 and (c_custkey % 5 = 0 or c_custkey % 11 = 0)) as broken from customer")
def n1_broken_payloads(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    deep = F.concat(F.repeat(F.lit('{"a":'), F.lit(3000)), F.lit("1"), F.repeat(F.lit("}"), F.lit(3000)))
    text = F.when(k % 7 == 0, F.lit(None)).when(k % 5 == 0, F.lit('{"a":')).when(k % 11 == 0, deep).otherwise(F.lit('{"a": [1]}'))
    return K.broken_payloads(t.customer.select(text.alias("payload")), "payload")


@plan(
    """select class, case when class = 'Unlock' then true else false end as member, n as blocks, n as carriers, 1::bigint as most_in_one from (select unnest(['Unlock', 'Other']) as class, count(*) as n from orders)"""
)
def a36_block_census(t: Tables) -> DataFrame:
    """Blocks of a class that descends from the wanted one, and of one that only names it without its namespace."""
    types = t.spark.createDataFrame([("Unlock", "N.Wanted", []), ("Other", "Wanted", ["M.Wanted"])], "type string, base string, interfaces array<string>")
    return U.block_census(K.typed_blocks(block_payloads(t), "payload", ["o_orderkey"]), ["o_orderkey"], types, "N.Wanted")


@plan(
    """with u as (select o_orderkey, count(*) filter (l_linenumber > 2) as n, string_agg(distinct l_suppkey::varchar, ',' order by l_suppkey::varchar) filter (l_linenumber > 2) as targets from orders left join lineitem on l_orderkey = o_orderkey group by 1)
    select o_orderkey, o_custkey as cool, case when o_orderkey % 3 = 0 and not (o_orderkey % 5 = 0 and o_custkey = 0) then 'mod' || o_custkey end as modifier, 'Unlock,Other' as blocks, 'Unlock' as needs, coalesce(targets, '') as targets from orders join u using (o_orderkey)"""
)
def a38_profile_in_full(t: Tables) -> DataFrame:
    p = block_payloads(t)
    pointers = K.block_pointers(p, "payload", ["o_orderkey"]).filter("class = 'Unlock'")
    modifiers = pointers.select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, "resolved").otherwise("missing").alias("status"), F.lit("config").alias("kind"), F.concat(F.lit("mod"), F.col("path_id").cast("string")).alias("id"))
    edges = t.lineitem.filter("l_linenumber > 2").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_suppkey").cast("string").alias("target"))
    blocks = K.typed_blocks(p, "payload", ["o_orderkey"])
    d = U.interaction_profile(p, "payload", "o_orderkey", {"cool": "$.references['1f'].data.n"}, modifiers, blocks, "^Un", edges)
    return d.select("o_orderkey", F.try_variant_get("cool", "$", "bigint").alias("cool"), F.col("modifier.id").alias("modifier"), F.array_join("blocks", ",").alias("blocks"), F.array_join("needs", ",").alias("needs"), F.array_join("targets", ",").alias("targets"))
