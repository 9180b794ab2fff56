"""Joins, windows and graph aggregations on orders and line items. Targets are restricted so that misses occur."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weavegraph.operators import graph as G
from weavegraph.operators import quality as Q
from weavegraph.operators import resolve as R
from weavegraph.plans.registry import Plans, Tables, over_cores

plan = Plans()
KNOWN_PARTS = "p_size <= 25"


def _parts(t: Tables) -> DataFrame:
    return t.part.filter(KNOWN_PARTS).select(F.col("p_partkey").alias("l_partkey"), "p_brand")


REFERENCE_EDGES = """with r as (select l_orderkey, l_partkey, l_suppkey, l_linenumber, p_partkey is not null as hit from lineitem left join part on p_partkey = l_partkey and p_size <= 25),
e as (select l_orderkey, l_partkey, count(*) as ref_count, hit from r group by 1, 2, 4)
select case when hit then 'resolved' else 'unknown part' end as status, count(*) as edges, sum(ref_count)::bigint as refs, count(distinct l_orderkey) as sources from e group by 1"""


@plan(REFERENCE_EDGES)
def reference_edges(t: Tables) -> DataFrame:
    """Flagship: line items as references to known parts, deduplicated into edges, counted by resolution."""
    r = R.resolve_ladder(t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"), [("unknown part", _parts(t), ["l_partkey"])], unique=True)
    e = G.edge_dedup(r, ["l_orderkey", "l_partkey", "status"], ["l_suppkey", "l_linenumber"])
    by_source = e.groupBy("status", "l_orderkey").agg(F.count("*").alias("edges"), F.sum("ref_count").alias("refs"))
    return by_source.groupBy("status").agg(F.sum("edges").alias("edges"), F.sum("refs").alias("refs"), F.count("*").alias("sources"))


@plan("select l_orderkey, l_linenumber, l_partkey, p_brand, case when p_partkey is null then 'missing' else 'located' end as status from lineitem left join part on p_partkey = l_partkey and p_size <= 25")
def j1_locate(t: Tables) -> DataFrame:
    return R.locate(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), _parts(t), ["l_partkey"])


@plan(
    """select case when o_orderkey is null then 'no order' when c_custkey is null then 'no customer' when n_nationkey is null then 'no nation' else 'resolved' end as status, count(*) as n
    from lineitem left join orders on o_orderkey = l_orderkey and o_orderkey % 7 > 0 left join customer on c_custkey = o_custkey and c_custkey % 5 > 0 left join nation on n_nationkey = c_nationkey and n_nationkey < 20 group by 1"""
)
def j2_resolve_pointer(t: Tables) -> DataFrame:
    steps = [
        ("no order", t.orders.filter("o_orderkey % 7 > 0").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("cust")), ["l_orderkey"]),
        ("no customer", t.customer.filter("c_custkey % 5 > 0").select(F.col("c_custkey").alias("cust"), F.col("c_nationkey").alias("nat")), ["cust"]),
        ("no nation", t.nation.filter("n_nationkey < 20").select(F.col("n_nationkey").alias("nat"), "n_name"), ["nat"]),
    ]
    return R.resolve_ladder(t.lineitem.select("l_orderkey"), steps, unique=True).groupBy("status").agg(F.count("*").alias("n"))


@plan(
    """with s as (select p_name, min(p_partkey) as p, count(distinct p_partkey) as homes from part where p_size <= 45 group by 1)
    select part.p_partkey, case when homes = 1 then p end as target_key, case when homes is null then 'missing' when homes > 1 then 'ambiguous' else 'resolved' end as status from part left join s using (p_name)"""
)
def j3_resolve_strict(t: Tables) -> DataFrame:
    targets = t.part.filter("p_size <= 45").select("p_name", F.col("p_partkey").alias("target_key"))
    return R.strict_lookup(t.part.select("p_partkey", "p_name"), targets, ["p_name"], "target_key").select("p_partkey", "target_key", "status")


@plan(
    """with c as (select l_orderkey, l_linenumber, l_suppkey, s_acctbal > 5000 as e, s_nationkey < 12 as sc, row_number() over (partition by l_orderkey order by (s_acctbal > 5000) desc, (s_nationkey < 12) desc, l_suppkey, l_linenumber) as rn
    from lineitem join supplier on s_suppkey = l_suppkey) select l_orderkey, l_suppkey, case when e then 'entity' when sc then 'scene' else 'none' end as landing from c where rn = 1"""
)
def j4_guid_bridge(t: Tables) -> DataFrame:
    s = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), (F.col("s_acctbal") > 5000).alias("e"), (F.col("s_nationkey") < 12).alias("sc"))
    c = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey").join(s, "l_suppkey")
    return R.any_target_wins(c, ["l_orderkey"], "e", "sc", [F.col("l_suppkey"), F.col("l_linenumber")]).select("l_orderkey", "l_suppkey", "landing")


BRIDGE_SQL = """refs as (select o_orderkey, (o_custkey % 40)::varchar as guid from orders),
entries as (select (p_partkey % 37)::varchar as guid, 'a' || p_size as address, case when p_partkey % 3 > 0 then 'b' || (p_partkey % 4) end as bundle from part),
containers as (select 'b' || (s_suppkey % 5) as bundle, 'a' || (s_suppkey % 45) as address, s_suppkey as path_id from supplier),
entities as (select bundle, path_id, 'part' as kind, path_id::varchar as id from containers where path_id % 3 = 0),
placed as (select c.*, e.kind, e.id, c.bundle in ('b1', 'b4') as scene from containers c left join entities e using (bundle, path_id)),
first as (select * from placed qualify row_number() over (partition by bundle, address order by path_id) = 1),
asked as (select distinct guid, address, bundle from entries),
own as (select a.guid, a.address, min({'b': f.bundle, 'p': f.path_id, 'k': f.kind, 'i': f.id}) filter (f.id is not null) as e, min({'b': f.bundle, 'p': f.path_id}) filter (f.scene) as s from asked a join first f using (bundle, address) group by 1, 2),
every as (select address, min({'b': bundle, 'p': path_id, 'k': kind, 'i': id}) filter (id is not null) as e, min({'b': bundle, 'p': path_id}) filter (scene) as s from placed group by 1),
here as (select g.guid, g.address, case when o.guid is not null then o.e else v.e end as e, case when o.guid is not null then o.s else v.s end as s from (select distinct guid, address from asked) g left join own o using (guid, address) left join every v on v.address = g.address),
upto as (select *, bool_or(e is not null) over (partition by guid order by address) as had from here),
edges as (select guid, address, case when e is not null then 'entity' else 'scene' end as landing, coalesce(e.b, s.b) as bundle, case when e is not null then e.p else s.p end as path_id, e.k as kind, e.i as id from upto where e is not null or (not had and s is not null)),
bridged as (select r.o_orderkey, r.guid, e.address, coalesce(e.landing, case when a.guid is null then 'dangling' else 'none' end) as landing, e.bundle, e.path_id, e.kind, e.id from refs r left join edges e using (guid) left join (select distinct guid from asked) a on a.guid = r.guid)"""


def bridge(t: Tables) -> DataFrame:
    refs = t.orders.select("o_orderkey", (F.col("o_custkey") % 40).cast("string").alias("guid"))
    p = F.col("p_partkey")
    entries = t.part.select((p % 37).cast("string").alias("guid"), F.concat(F.lit("a"), F.col("p_size").cast("string")).alias("address"), F.when(p % 3 > 0, F.concat(F.lit("b"), (p % 4).cast("string"))).alias("bundle"))
    s = F.col("s_suppkey")
    containers = t.supplier.select(F.concat(F.lit("b"), (s % 5).cast("string")).alias("bundle"), F.concat(F.lit("a"), (s % 45).cast("string")).alias("address"), s.alias("path_id"))
    entities = containers.filter("path_id % 3 = 0").select("bundle", "path_id", F.lit("part").alias("kind"), F.col("path_id").cast("string").alias("id"))
    return R.guid_bridge(refs, entries, containers, entities, containers.select("bundle").filter("bundle in ('b1', 'b4')"))


@plan(f"with {BRIDGE_SQL} select o_orderkey, address, landing, bundle, path_id, kind, id from bridged")
def j4_bridge_edges(t: Tables) -> DataFrame:
    return bridge(t).select("o_orderkey", "address", "landing", "bundle", "path_id", "kind", "id")


@plan(
    f"""with {BRIDGE_SQL}, r as (select guid, o_orderkey, bool_or(landing <> 'dangling') as placed, bool_or(landing = 'entity') as hit, count(*) filter (landing = 'scene') as scenes from bridged group by 1, 2)
    select count(*) as refs, count(distinct guid) as guids, count(*) filter (placed) as resolved_to_address, count(*) filter (hit) as resolved_to_entity, count(distinct guid) filter (not placed) as dangling_guids, sum(scenes)::bigint as scene_edges from r"""
)
def j4_bridge_report(t: Tables) -> DataFrame:
    return R.bridge_report(bridge(t), ["o_orderkey"])


@plan(
    """with n as (select p_brand, p_size, count(*) as n, min(p_partkey) as one, count(*) filter (p_type = first_type) as m, min(p_partkey) filter (p_type = first_type) as mine from part, (select min(p_type) as first_type from part) group by 1, 2)
    select p.p_partkey, case when n is null then 'missing' when n = 1 or (n > 1 and m = 1) then 'resolved' else 'ambiguous' end as status, case when n = 1 then one when m = 1 then mine end as target_key from part p left join n on n.p_brand = p.p_brand and n.p_size = p.p_size + 1"""
)
def j3_by_class(t: Tables) -> DataFrame:
    """References to the part of the same brand that is one larger; of several the only one of the first type."""
    wanted = t.part.agg(F.min("p_type").alias("wanted"))
    refs = t.part.select("p_partkey", "p_brand", (F.col("p_size") + 1).alias("p_size")).crossJoin(F.broadcast(wanted))
    targets = t.part.select("p_brand", "p_size", F.col("p_partkey").alias("target_key"), "p_type")
    return R.strict_lookup(refs, targets, ["p_brand", "p_size"], "target_key", "p_type", "wanted").select("p_partkey", "status", "target_key")


@plan(
    """select l_returnflag, count(*) filter (l_linenumber <> 1 and p_partkey is not null) as hits, count(*) filter (l_linenumber <> 1 and p_partkey is null) as misses, count(*) filter (l_linenumber = 1) as zeros
    from lineitem left join part on p_partkey = l_partkey and p_size <= 25 group by 1"""
)
def j5_term_join(t: Tables) -> DataFrame:
    j = R.resolve_ladder(t.lineitem.select("l_returnflag", "l_linenumber", "l_partkey"), [("miss", _parts(t), ["l_partkey"])], resolved="hit")
    live = F.col("l_linenumber") != 1
    return j.groupBy("l_returnflag").agg(F.count_if(live & (F.col("status") == "hit")).alias("hits"), F.count_if(live & (F.col("status") == "miss")).alias("misses"), F.count_if(~live).alias("zeros"))


@plan(
    """with f as (select p_partkey, unnest([{'form': p_name, 'r': 1}, {'form': p_brand, 'r': 2}, {'form': p_type, 'r': 3}]) as x from part), tails as (select distinct p_brand as tail, 1 as fr, p_brand as key from part where p_brand < 'Brand#30' union all select distinct p_type, 2, p_type from part),
    h as (select p_partkey, key, fr, x.r as r, row_number() over (partition by p_partkey order by fr, x.r, key) as rn from f join tails on lower(x.form) = lower(tail)) select p_partkey, key, fr as family_rank from h where rn = 1"""
)
def j6_first_match_ladder(t: Tables) -> DataFrame:
    forms = t.part.select("p_partkey", F.posexplode(F.array("p_name", "p_brand", "p_type")).alias("form_rank", "form"))
    brands = t.part.filter("p_brand < 'Brand#30'").select(F.col("p_brand").alias("tail"), F.lit(1).alias("family_rank"), F.col("p_brand").alias("key")).distinct()
    types = t.part.select(F.col("p_type").alias("tail"), F.lit(2).alias("family_rank"), F.col("p_type").alias("key")).distinct()
    return G.first_match_ladder(forms, brands.unionByName(types), "p_partkey").select("p_partkey", "key", "family_rank")


NAMES_SQL = r"""nm as (select distinct p_type as kind, case p_partkey % 4 when 0 then p_name when 1 then upper(p_name) when 2 then p_name || ' x' else p_name || ' ' || p_brand end as name from part), tg as (select distinct p_type as kind, p_name as target from part where p_size <= 20),
    l as (select kind, lower(regexp_replace(trim(target), '[\s-]+', '_', 'g')) as k, min(target) as loose from tg group by 1, 2),
    rs as (select nm.kind, nm.name, coalesce(tg.target, l.loose) as target, case when tg.target is not null then 'exact' when l.loose is not null then 'normalised' else 'none' end as match from nm left join tg on tg.kind = nm.kind and tg.target = nm.name left join l on l.kind = nm.kind and l.k = lower(regexp_replace(trim(nm.name), '[\s-]+', '_', 'g')))"""


def _names(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Names of parts in several spellings, and the names known of each kind."""
    k = F.col("p_partkey") % 4
    name = F.when(k == 0, F.col("p_name")).when(k == 1, F.upper("p_name")).when(k == 2, F.concat("p_name", F.lit(" x"))).otherwise(F.concat("p_name", F.lit(" "), "p_brand"))
    return t.part.select(F.col("p_type").alias("kind"), name.alias("name")).distinct(), t.part.filter("p_size <= 20").select(F.col("p_type").alias("kind"), F.col("p_name").alias("target"))


@plan(f"with {NAMES_SQL} select kind, name, target, match, match = 'normalised' as inferred from rs")
def j7_name_resolver(t: Tables) -> DataFrame:
    names, targets = _names(t)
    return G.resolve_names(names, targets, "kind", "name", "target").select("kind", "name", "target", "match", "inferred")


@plan(
    rf"""with {NAMES_SQL}, a as (select kind, name, unnest(list_distinct(string_split(lower(regexp_replace(trim(name), '[\s-]+', '_', 'g')), '_'))) as tok from rs where match = 'none'), b as (select kind, target, unnest(list_distinct(string_split(lower(regexp_replace(trim(target), '[\s-]+', '_', 'g')), '_'))) as tok from tg),
    s as (select kind, name, target, count(*)::int as overlap from a join b using (kind, tok) where tok <> '' group by 1, 2, 3), r as (select *, row_number() over (partition by kind, name order by overlap desc, length(target), target)::int as rank from s) select kind, name, target, overlap, rank from r where rank <= 3"""
)
def j7_token_candidates(t: Tables) -> DataFrame:
    names, targets = _names(t)
    misses = G.resolve_names(names, targets, "kind", "name", "target").filter("match = 'none'")
    return G.closest_candidates(misses, targets, "kind", "name", "target")


@plan(
    """with e as (select distinct l_orderkey, l_suppkey from lineitem where l_quantity > 10), c as (select distinct l_orderkey, l_suppkey, l_orderkey % 2 = 0 as ends_known from lineitem)
    select case when e.l_orderkey is not null then 'confirms-hard' when ends_known then 'adds-derived' else 'flags-missing' end as effect, count(*) as n from c left join e using (l_orderkey, l_suppkey) group by 1"""
)
def j8_claim_overlay(t: Tables) -> DataFrame:
    keys = ["l_orderkey", "l_suppkey"]
    claims = t.lineitem.select(*keys, (F.col("l_orderkey") % 2 == 0).alias("ends_known")).distinct()
    return G.claim_overlay(claims, t.lineitem.filter("l_quantity > 10"), keys).groupBy("effect").agg(F.count("*").alias("n"))


@plan(
    """with r as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag from lineitem), p1 as (select p_partkey from part where p_size <= 10), f as (select r.*, p1.p_partkey is not null as h1 from r left join p1 on p_partkey = l_partkey),
    need as (select distinct l_returnflag from f where not h1 and l_returnflag <> 'Z'), w as (select distinct p_partkey, flag from (select p_partkey, case when p_size % 2 = 0 then 'R' else 'N' end as flag from part where p_size <= 30) where flag in (select l_returnflag from need))
    select case when h1 then 1 when p_partkey is not null then 2 end as pass, count(*) as n from f left join w on p_partkey = l_partkey and flag = l_returnflag group by 1"""
)
def j9_placement_resolve(t: Tables) -> DataFrame:
    refs = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    by_flag = lambda cond: t.part.filter(cond).select(F.col("p_partkey").alias("l_partkey"), "p_size")
    flags = t.lineitem.select("l_returnflag").distinct()
    narrow = by_flag("p_size <= 10").crossJoin(F.broadcast(flags))  # three flags: a part is known under any
    wide = by_flag("p_size <= 30").select("l_partkey", F.when(F.col("p_size") % 2 == 0, "R").otherwise("N").alias("l_returnflag"))
    return R.widen_for_residue(refs, narrow, wide, ["l_partkey", "l_returnflag"], "l_returnflag").groupBy("pass").agg(F.count("*").alias("n"))


@plan(
    """with b as (select s_nationkey, min(s_acctbal) as lo, max(s_acctbal) as hi from supplier group by 1)
    select c_custkey from customer where exists (select 1 from b where s_nationkey = c_nationkey and abs(c_acctbal - (lo + hi) / 2) <= (hi - lo) / 2)"""
)
def j10_point_in_bounds(t: Tables) -> DataFrame:
    b = t.supplier.groupBy(F.col("s_nationkey").alias("c_nationkey")).agg(F.min("s_acctbal").alias("lo"), F.max("s_acctbal").alias("hi"))
    b = b.select("c_nationkey", ((F.col("lo") + F.col("hi")) / 2).alias("c_c_acctbal"), ((F.col("hi") - F.col("lo")) / 2).alias("e_c_acctbal"))
    return R.in_bounds(t.customer, b, ["c_nationkey"], ["c_acctbal"]).select("c_custkey")


BOUNDS_SQL = """p as (select vec_id, label % 2 as k, embedding[1]::double as x, embedding[2]::double as y, embedding[3]::double as z from embeddings),
b as (select vec_id as b, k, x as cx, y as cy, z as cz, case when vec_id % 33 = 0 then 5.0 else 0.02 * (vec_id % 5) end as ex, 0.05 as ey, 0.05 * (vec_id % 3) as ez from p where vec_id % 3 = 0)"""


@plan(f"with {BOUNDS_SQL} select p.vec_id, min(b.b) as first_bound from p join b on b.k = p.k and abs(p.x - b.cx) <= b.ex and abs(p.y - b.cy) <= b.ey and abs(p.z - b.cz) <= b.ez group by 1")
def j10_first_bound(t: Tables) -> DataFrame:
    """Points on three axes in boxes of sizes from none to very wide: each point's first box."""
    at = lambda i: F.get("embedding", F.lit(i)).cast("double")
    p = t.embeddings.select("vec_id", (F.col("label") % 2).alias("k"), at(0).alias("x"), at(1).alias("y"), at(2).alias("z"))
    i = F.col("vec_id")
    b = p.filter(i % 3 == 0).select(i.alias("first_bound"), "k", F.col("x").alias("c_x"), F.col("y").alias("c_y"), F.col("z").alias("c_z"), F.when(i % 33 == 0, 5.0).otherwise(0.02 * (i % 5)).alias("e_x"), F.lit(0.05).alias("e_y"), (0.05 * (i % 3)).alias("e_z"))
    return R.in_bounds(p, b, ["k"], ["x", "y", "z"], "first_bound").select("vec_id", "first_bound")


@plan(
    """select l_orderkey, l_linenumber, coalesce(a.v, b.v) as v, case when a.v is not null then 'small' when b.v is not null then 'large' else 'none' end as route from lineitem
    left join (select p_partkey, p_name as v from part where p_size < 10) a on a.p_partkey = l_partkey left join (select p_partkey, p_brand as v from part where p_size > 30) b on b.p_partkey = l_partkey"""
)
def j11_identity_layered_join(t: Tables) -> DataFrame:
    small = t.part.filter("p_size < 10").select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("v"))
    large = t.part.filter("p_size > 30").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("v"))
    return R.coalesce_lookups(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), [("small", small), ("large", large)], ["l_partkey"], "v").select("l_orderkey", "l_linenumber", "v", "route")


@plan("select c_custkey, c_nationkey, n_name as label from customer left join nation on n_nationkey = c_nationkey and n_nationkey < 15")
def j12_enum_label(t: Tables) -> DataFrame:
    n = t.nation.filter("n_nationkey < 15").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("label"))
    return R.coalesce_lookups(t.customer.select("c_custkey", "c_nationkey"), [("enum", n)], ["c_nationkey"], "label").drop("route")


@plan(
    r"""with k as (select distinct source as key from documents where source < 'src3'), r as (select doc_id, case when doc_id % 2 = 0 then source else source || '_' || md5(text) end as ref from documents)
    select doc_id, case when a.key is not null then 'direct' when b.key is not null then 'hash-suffix' end as match from r left join k a on a.key = ref left join k b on b.key = nullif(regexp_extract(ref, '^(.+)_[0-9a-f]{32}$', 1), '')"""
)
def j13_file_ref_match(t: Tables) -> DataFrame:
    refs = t.documents.select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("source")).otherwise(F.concat_ws("_", "source", F.md5("text"))).alias("ref"))
    return R.match_file_ref(refs, t.documents.filter("source < 'src3'"), "ref", "source").select("doc_id", "match")


@plan(
    """with own as (select distinct l_suppkey as s, l_partkey as p from lineitem), th as (select b.s, a.p from own a join (select distinct l_suppkey as s from lineitem) b on a.s = b.s - 1)
    select th.s as supp, count(*) as inherited, min(th.p) as first_name, max(th.p) as last_name from th left join own on own.s = th.s and own.p = th.p where own.s is null group by 1"""
)
def j14_inherit_pool(t: Tables) -> DataFrame:
    pools = t.lineitem.select(F.col("l_suppkey").alias("supp"), F.col("l_partkey").alias("name"))
    twins = pools.select("supp").distinct().withColumn("twin", F.col("supp") - 1)
    more = R.inherit_pool(pools, twins, "supp", "name", "twin")
    return more.groupBy("supp").agg(F.count("*").alias("inherited"), F.min("name").alias("first_name"), F.max("name").alias("last_name"))


@plan("select o_orderkey, o_custkey, coalesce(a, 0) as addresses, f as first_address from orders left join (select l_orderkey, count(distinct l_partkey) as a, min(l_partkey) as f from lineitem where l_returnflag = 'R' group by 1) on l_orderkey = o_orderkey")
def j15_reverse_lookup(t: Tables) -> DataFrame:
    containers = t.lineitem.filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey")
    return R.reverse_lookup(t.orders.select("o_orderkey", "o_custkey"), containers, ["o_orderkey"], "l_partkey")


@plan(
    """with e as (select o_custkey, arg_min(o_orderpriority, (o_orderkey)) as name, 'edge' as basis from orders where o_orderstatus = 'F' group by 1), a as (select c_custkey, c_mktsegment from customer where c_custkey not in (select o_custkey from e))
    select o_custkey as cust, name, basis from e union all select c_custkey, c_mktsegment, 'alias' from a"""
)
def j16_effective_name_edge(t: Tables) -> DataFrame:
    e = R.first_by_priority(t.orders.filter("o_orderstatus = 'F'"), ["o_custkey"], [F.col("o_orderkey")]).select(F.col("o_custkey").alias("cust"), F.col("o_orderpriority").alias("name"), F.lit("edge").alias("basis"))
    a = t.customer.select(F.col("c_custkey").alias("cust"), F.col("c_mktsegment").alias("name"), F.lit("alias").alias("basis")).join(e, "cust", "left_anti")
    return e.unionByName(a)


@plan("select doc_id from documents d where source <> 'src0' and exists (select 1 from documents e where e.source = 'src0' and e.text = d.text)")
def j17_text_coincidence(t: Tables) -> DataFrame:
    d = t.documents.select("doc_id", "text", "source")
    return R.text_coincidence(d.filter("source <> 'src0'"), "text", d.filter("source = 'src0'"), "text").select("doc_id")


@plan("with a as (select distinct o_custkey as k from orders where o_orderstatus = 'F'), b as (select c_custkey as k from customer where c_acctbal > 0) select coalesce(a.k, b.k) as k, case when b.k is null then 'left' else 'right' end as side from a full join b on a.k = b.k where a.k is null or b.k is null")
def j18_anti_missing(t: Tables) -> DataFrame:
    return R.anti_missing(t.orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k")), t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("k")), ["k"])


@plan(
    """select case when p_type is null or s_name is null then 'unresolved' else p_type end as class, count(distinct l_orderkey) as sources, count(*) as refs, min(s_name) as first_home from lineitem
    left join part on p_partkey = l_partkey and p_size <= 40 left join (select s_suppkey, s_name from supplier where s_nationkey < 20) on s_suppkey = l_suppkey group by 1"""
)
def j20_two_hop_class_census(t: Tables) -> DataFrame:
    objects = t.part.filter("p_size <= 40").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    homes = t.supplier.filter("s_nationkey < 20").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    return R.two_hop_census(t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey"), objects, ["l_partkey"], homes, ["l_suppkey"], "l_orderkey", "p_type", "s_name")


@plan("select r_name, case when n is null then 'absent' else 'present' end as presence from region left join (select distinct n_regionkey as n from nation where n_nationkey < 3) on n = r_regionkey")
def j21_presence_status(t: Tables) -> DataFrame:
    return R.presence_status(t.region, t.nation.filter("n_nationkey < 3").select(F.col("n_regionkey").alias("r_regionkey")), ["r_regionkey"]).select("r_name", "presence")


@plan(
    """with r as (select *, row_number() over (partition by l_orderkey, l_partkey order by l_suppkey, l_linenumber) as rn, count(*) over (partition by l_orderkey, l_partkey) as ref_count from lineitem)
    select l_orderkey, l_partkey, ref_count, l_suppkey, l_linenumber from r where rn = 1"""
)
def a1_edge_dedup(t: Tables) -> DataFrame:
    return G.edge_dedup(t.lineitem, ["l_orderkey", "l_partkey"], ["l_suppkey", "l_linenumber"])


EDGES_SQL = """e as (select 'order' as sk, l_orderkey as sid, 'part' as dk, 'fk' as m from lineitem where l_partkey % 3 > 0 union all select 'order', o_orderkey, 'customer', 'fk' from orders union all select 'customer', c_custkey, 'nation', 'fk' from customer union all select 'nation', n_nationkey, 'region', 'fk' from nation),
u as (select 'order' as sk, 'part' as dk, count(*) as n from lineitem where l_partkey % 3 = 0), k as (select unnest(['order', 'part', 'customer', 'nation', 'region']) as kind)"""


@plan(
    f"""with {EDGES_SQL} select a.kind as src_kind, b.kind as dst_kind, coalesce(edges, 0) as edges, coalesce(sources, 0) as sources, coalesce(methods, '') as methods, coalesce(u.n, 0) as unresolved,
    case when coalesce(edges, 0) > 0 and coalesce(u.n, 0) = 0 then 'modeled' when coalesce(edges, 0) > 0 then 'partial' else 'missing' end as status from k a cross join k b
    left join (select sk, dk, count(*) as edges, count(distinct sid) as sources, string_agg(distinct m, ',') as methods from e group by 1, 2) x on x.sk = a.kind and x.dk = b.kind left join u on u.sk = a.kind and u.dk = b.kind"""
)
def a2_pair_matrix(t: Tables) -> DataFrame:
    edge = lambda df, s, sid, d: df.select(F.lit(s).alias("src_kind"), F.col(sid).cast("bigint").alias("src_id"), F.lit(d).alias("dst_kind"), F.lit("fk").alias("method"))
    edges = edge(t.lineitem.filter("l_partkey % 3 > 0"), "order", "l_orderkey", "part").unionByName(edge(t.orders, "order", "o_orderkey", "customer"))
    edges = edges.unionByName(edge(t.customer, "customer", "c_custkey", "nation")).unionByName(edge(t.nation, "nation", "n_nationkey", "region"))
    open_ = t.lineitem.filter("l_partkey % 3 = 0").agg(F.count("*").alias("n")).select(F.lit("order").alias("src_kind"), F.lit("part").alias("dst_kind"), "n")
    kinds = t.region.limit(1).select(F.explode(F.array(*map(F.lit, ("order", "part", "customer", "nation", "region")))).alias("kind"))
    return G.pair_matrix(kinds, edges, open_)


@plan(
    """select basis, charged_kind, count(*) as n from (select case when p_size <= 5 then 'small' when lower(split_part(p_type, ' ', 1)) in ('promo', 'economy') then lower(split_part(p_type, ' ', 1)) end as charged_kind,
    case when p_size <= 5 then 'landing' when lower(split_part(p_type, ' ', 1)) in ('promo', 'economy') then 'leaf' else 'tally' end as basis from part) group by 1, 2"""
)
def a3_residue_attribution(t: Tables) -> DataFrame:
    r = t.part.select(F.when(F.col("p_size") <= 5, "small").alias("landing"), F.substring_index("p_type", " ", 1).alias("leaf"))
    return G.residue_attribution(r, ["promo", "economy"], "landing", "leaf").groupBy("basis", "charged_kind").agg(F.count("*").alias("n"))


@plan("select l_partkey, count(*) as usages, min(l_orderkey) as first_usage, count(distinct l_suppkey) as sources from lineitem group by 1")
def a4_reverse_index(t: Tables) -> DataFrame:
    return G.reverse_index(t.lineitem, "l_partkey", "l_orderkey", "l_suppkey")


@plan(
    """with m as (select doc_id % 50 as term_id, source as term_key, string_agg(distinct lang, ',' order by lang) as locales, min(lang || source) as source from documents group by 1, 2)
    select *, term_id = min(term_id) over (partition by term_key) as canonical from m"""
)
def a5_registry_merge(t: Tables) -> DataFrame:
    rows = t.documents.select((F.col("doc_id") % 50).alias("term_id"), F.col("source").alias("term_key"), F.concat("lang", "source").alias("asset"), "lang")
    return G.registry_merge(rows, "term_id", "term_key", "asset", "lang")


@plan("select sum(n)::bigint as n_rows, count(*) filter (k is not null) as n_keys, coalesce(sum(n) filter (k is null), 0)::bigint as null_rows, count(*) filter (n > 1) as repeated_keys, count(*) filter (n > 1 and kinds = 1) as repeated_identical from (select nullif(p_name, 'x') as k, count(*) as n, count(distinct p_brand) as kinds from part group by 1)")
def a18_catalog_report(t: Tables) -> DataFrame:
    return G.catalog_report(t.part, "p_name", "p_brand")


CENSUS_SQL = """m as (select * from part where p_type in ('ECONOMY', 'SMALL')), g as (select * from part where p_type in ('PROMO', 'LARGE') and p_size <= 49)"""


@plan(
    f"""with {CENSUS_SQL} select 'reconcile' as check_id, 'objects' as dataset, case when a = b then 'PASS' else 'FAIL' end as status, a as expected, b as measured from (select count(*) as a from part), (select (select count(*) from m) + (select count(*) from g) + (select count(*) from part where p_size = 50 and p_type = 'PROMO') + (select count(*) from part where p_type in ('MEDIUM', 'STANDARD')) as b)
    union all select 'carve-out', p_type, case when count(*) = count(*) filter (p_size <= 49) then 'PASS' else 'FAIL' end, count(*), count(*) filter (p_size <= 49) from part where p_type in ('PROMO', 'LARGE') group by 2"""
)
def a19_census_reconcile(t: Tables) -> DataFrame:
    """Parts by type as the census; the catalogue lacks large ones, of which those of one type are known as errors."""
    census = t.part.groupBy("p_type").agg(F.count("*").alias("n"))
    errors = t.part.filter("p_size = 50 and p_type = 'PROMO'").groupBy("p_type").agg(F.count("*").alias("n"))
    carved = t.part.filter("p_type in ('PROMO', 'LARGE') and p_size <= 49")
    return Q.census_reconcile(census, errors, t.part.filter("p_type in ('ECONOMY', 'SMALL')"), carved, "p_type", ["ECONOMY", "SMALL"], ["PROMO", "LARGE"])


@plan(
    """with p as (select l_returnflag, l_linestatus, l_suppkey, l_orderkey from lineitem), s as (select distinct l_returnflag, l_linestatus, l_suppkey, l_orderkey from p), r as (select *, row_number() over (partition by l_returnflag, l_linestatus, l_suppkey order by l_orderkey) as rn from s),
    c as (select l_returnflag, l_linestatus, l_suppkey, count(*) as n from p group by 1, 2, 3), f as (select l_returnflag, l_linestatus, l_suppkey, string_agg(l_orderkey::varchar, ',' order by l_orderkey) as samples from r where rn <= 5 group by 1, 2, 3) select * from c join f using (l_returnflag, l_linestatus, l_suppkey)"""
)
def a20_ledger_samples(t: Tables) -> DataFrame:
    return G.ledger(t.lineitem, ["l_returnflag", "l_linestatus", "l_suppkey"], "l_orderkey")


@plan(
    """select case when grouping(grp) = 1 then 'all' else grp end as grp, count(*) as refs, count(*) filter (p_partkey is not null) as resolved, count(*) filter (p_partkey is null) as residue from (select l_returnflag as grp, l_partkey from lineitem) left join part on p_partkey = l_partkey and p_size <= 25 group by grouping sets ((), (grp))"""
)
def a26_join_report(t: Tables) -> DataFrame:
    j = R.locate(t.lineitem.select(F.col("l_returnflag").alias("grp"), "l_partkey"), _parts(t), ["l_partkey"])
    return G.join_report(j, "grp", {"resolved": F.col("status") == "located", "residue": F.col("status") == "missing"}).select("grp", "refs", "resolved", "residue")


@plan("with x as (select p_brand, count(distinct p_partkey) as ids, count(distinct s_suppkey) as overlap from part left join supplier on s_suppkey = p_partkey group by 1) select *, case when ids = overlap then 'agreed' when overlap > 0 then 'overlapping' else 'divergent' end as verdict from x")
def a27_id_space_sweep(t: Tables) -> DataFrame:
    return G.id_space_sweep(t.part, "p_brand", "p_partkey", t.supplier, "s_suppkey")


@plan("select p_type as class_name, count(*) as n, case when starts_with(p_type, 'PROMO') then 'PROMO' when starts_with(p_type, 'ECO') then 'ECO' end as rule, case when starts_with(p_type, 'PROMO') or starts_with(p_type, 'ECO') then 'mapped' else 'gap' end as coverage from part group by 1")
def a28_surface_coverage(t: Tables) -> DataFrame:
    return G.surface_coverage(t.part, "p_type", ["PROMO", "ECO"])


@plan("select o_orderstatus, count(*) as n, count(*) filter (o_totalprice > 100000) as large, count(*) filter (o_orderpriority = '1-URGENT') as urgent from orders group by 1")
def a29_per_kind_cells(t: Tables) -> DataFrame:
    return G.condition_counts(t.orders, ["o_orderstatus"], {"large": F.col("o_totalprice") > 100000, "urgent": F.col("o_orderpriority") == "1-URGENT"})


@plan(
    """select case when p_partkey is not null then 'resolved' when s_suppkey is not null then 'supplier only' else 'open' end as route, count(*) as n, count(distinct l_partkey) as names from lineitem
    left join part on p_partkey = l_partkey and p_size <= 25 left join supplier on s_suppkey = l_suppkey and s_acctbal > 0 group by 1"""
)
def a30_route_counts(t: Tables) -> DataFrame:
    s = t.supplier.filter("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"), F.lit(True).alias("s"))
    j = t.lineitem.select("l_partkey", "l_suppkey").join(_parts(t), "l_partkey", "left").join(s, "l_suppkey", "left")
    route = F.when(F.col("p_brand").isNotNull(), "resolved").when(F.col("s"), "supplier only").otherwise("open")
    return j.groupBy(route.alias("route")).agg(F.count("*").alias("n"), F.countDistinct("l_partkey").alias("names"))


ICON_SQL = """r as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, case when l_linenumber = 7 then '' else p_name end as sub, case when s_suppkey is null then 'guid' else 'none' end as chain from lineitem join part on p_partkey = l_partkey left join supplier on s_suppkey = l_suppkey and s_acctbal > 0),
j as (select r.*, c.n is not null and sub <> '' as resolved from r left join (select distinct p_name as n from part where p_size <= 2) c on c.n = sub), k as (select *, case when resolved then null when chain <> 'none' then 'dlc-content-absent' when sub <> '' then 'stale-name' else 'empty-sub-name' end as reason from j)"""


def _icons(t: Tables) -> DataFrame:
    """Line items as references by the name of their part, with the state of their chain, against a catalogue of names."""
    names = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name")
    whole = t.supplier.filter("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"), F.lit("none").alias("chain"))
    refs = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").join(names, "l_partkey").join(whole, "l_suppkey", "left").fillna("guid", ["chain"])
    refs = refs.withColumn("sub", F.when(F.col("l_linenumber") == 7, "").otherwise(F.col("p_name")))
    return G.join_by_name(refs, t.part.filter("p_size <= 2"), "sub", "chain", "p_name")


@plan(f"with {ICON_SQL} select l_orderkey, l_linenumber, l_partkey, l_suppkey, resolved, reason from k")
def a30_icon_join(t: Tables) -> DataFrame:
    return _icons(t).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "resolved", "reason")


@plan(f"with {ICON_SQL} select resolved, reason, count(*) as n, count(distinct nullif(sub, '')) as names from k group by 1, 2")
def a30_icon_routes(t: Tables) -> DataFrame:
    return G.route_counts(_icons(t), "sub")


@plan(
    """with a as (select distinct l_orderkey, l_suppkey, l_returnflag from lineitem where l_quantity < 40), b as (select distinct l_orderkey, l_suppkey, l_returnflag from lineitem where l_quantity > 10)
    select case when a.l_orderkey is not null and b.l_orderkey is not null then 'both' when a.l_orderkey is not null then 'left' else 'right' end as side, case l_returnflag when 'A' then 'returned early' when 'R' then 'returned' end as reason, count(*) as n from a full join b using (l_orderkey, l_suppkey, l_returnflag) group by 1, 2"""
)
def a32_class_accounting(t: Tables) -> DataFrame:
    reasons = t.lineitem.select("l_returnflag").distinct().select("l_returnflag", F.when(F.col("l_returnflag") == "A", "returned early").when(F.col("l_returnflag") == "R", "returned").alias("reason"))
    keys = ["l_orderkey", "l_suppkey", "l_returnflag"]
    return G.class_accounting(t.lineitem.filter("l_quantity < 40"), t.lineitem.filter("l_quantity > 10"), keys, reasons, "l_returnflag").groupBy("side", "reason").agg(F.count("*").alias("n"))


@plan("with r as (select *, row_number() over (partition by l_orderkey order by l_suppkey, l_partkey) as rn, count(*) over (partition by l_orderkey) as objects from lineitem) select l_orderkey, objects, l_suppkey as first_l_suppkey, l_partkey as first_l_partkey from r where rn = 1")
def a33_object_index(t: Tables) -> DataFrame:
    return G.object_index(t.lineitem, ["l_orderkey"], ["l_suppkey", "l_partkey"])


@plan("select p_type, count(*) as n from part group by 1")
def a34_class_census(t: Tables) -> DataFrame:
    return _manifest(t)["class_counts"]


def _manifest(t: Tables) -> dict[str, DataFrame]:
    m = t.part.select(F.concat("p_type", F.lit("/"), "p_name", F.lit("_"), (F.col("p_size") % 10).cast("string")).alias("path"), "p_brand", (F.col("p_size") % 10).alias("path_id"), "p_type")
    return G.manifest_indexes(m, "path", ["p_brand", "path_id"], "p_type", ["PROMO", "LARGE"])


MANIFEST_SQL = "m as (select p_type || '/' || p_name || '_' || (p_size % 10) as path, p_brand, p_size % 10 as path_id, p_type from part)"


@plan(f"with {MANIFEST_SQL}, r as (select *, row_number() over (partition by path order by p_brand, path_id, p_type) as rn from m) select path, p_brand, path_id, p_type from r where rn = 1")
def a34_by_path(t: Tables) -> DataFrame:
    return _manifest(t)["by_path"]


@plan(f"with {MANIFEST_SQL}, r as (select *, row_number() over (partition by p_brand, path_id order by p_type, path) as rn from m) select p_brand, path_id, path from r where rn = 1 and p_type in ('PROMO', 'LARGE')")
def a34_definitions(t: Tables) -> DataFrame:
    return _manifest(t)["definitions"]


@plan("select lang, coalesce(quality::varchar, 'unregistered') as status, count(*) as n from documents left join (select doc_id, min(quality) as quality from labels group by 1) using (doc_id) group by 1, 2")
def a35_status_distribution(t: Tables) -> DataFrame:
    return G.status_distribution(t.documents, t.labels, "doc_id", "quality", "lang")


@plan("select c_mktsegment, count(*) as n, count(*) filter (c_acctbal < 0) as populated from customer group by 1")
def a37_carrier_probe(t: Tables) -> DataFrame:
    return G.condition_counts(t.customer, ["c_mktsegment"], {"populated": F.col("c_acctbal") < 0})


@plan("select 'orders' as ledger, count(*) as open_rows, case when bool_or(o_totalprice < 0) then 'broken' when count(*) > 0 then 'completed-with-ledger' else 'complete' end as state from orders where o_orderstatus = 'P' union all select 'none', 0, 'complete'")
def a43_run_state(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderstatus", "o_totalprice")
    return G.run_state({"orders": o.filter("o_orderstatus = 'P'"), "none": o.filter("o_orderstatus = 'never'")}, F.col("o_totalprice") < 0)


@plan("select 'documents' as dataset, lang as axis, count(*) as n from documents group by 2 union all select 'orders', o_orderstatus, count(*) from orders group by 2")
def a44_axis_counts(t: Tables) -> DataFrame:
    return G.axis_counts({"documents": t.documents.withColumnRenamed("lang", "axis"), "orders": t.orders.withColumnRenamed("o_orderstatus", "axis")}, "axis")


@plan("select * from (select l_orderkey, l_linenumber, l_partkey, row_number() over (partition by l_orderkey order by l_extendedprice desc, l_linenumber, l_partkey) as rank from lineitem) where rank <= 3")
def w2_topk_per_group(t: Tables) -> DataFrame:
    d = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return R.top_k(d, ["l_orderkey"], [F.col("l_extendedprice").desc(), F.col("l_linenumber"), F.col("l_partkey")], 3, "rank").drop("l_extendedprice").withColumn("rank", F.col("rank").cast("bigint"))


@plan(
    """with h as (select source, lang, n_chars % 10 as id, sha256(text) as hash, doc_id % 3 as axis from documents), m as (select source, id::varchar as id, hash, count(*) as merged, string_agg(distinct axis::varchar, ',' order by axis::varchar) as ax from h group by 1, 2, 3),
    r as (select *, row_number() over (partition by source, id order by hash) as rn from m) select source, case when rn > 1 then id || '@' || substr(hash, 1, 8) else id end as id, hash, case when rn > 1 then id end as original_id, merged, case when merged > 1 then ax end as axes from r"""
)
def w3_twin_disambiguate(t: Tables) -> DataFrame:
    h = t.documents.select("source", (F.col("n_chars") % 10).cast("string").alias("id"), F.sha2("text", 256).alias("hash"), (F.col("doc_id") % 3).cast("string").alias("axis"))
    return R.twin_disambiguate(h, ["source"], "id", "hash", "axis").select("source", "id", "hash", "original_id", "merged", F.array_join("axes", ",").alias("axes"))


@plan(
    """select p_partkey, case when count(*) over (partition by p_name) = 1 then p_name when count(*) over (partition by p_name, p_size) = 1 then p_name || '@r' || p_size else p_name || '@p' || p_partkey end as unique_key from part"""
)
def w4_demote_collisions(t: Tables) -> DataFrame:
    return R.demote_collisions(t.part, "p_name", "p_size", "p_partkey").select("p_partkey", "unique_key")


@plan("select p_partkey, case when row_number() over (partition by p_name order by p_partkey) = 1 then p_name else p_name || '_' || p_partkey end as file_name from part")
def w5_assign_unique_name(t: Tables) -> DataFrame:
    return R.assign_unique_name(t.part, "p_name", "p_partkey").select("p_partkey", "file_name")


@plan(
    """with x as (select p_partkey, p_brand, row_number() over (partition by p_brand order by p_partkey) as rn from part)
    select 'plain' as rows, p_partkey, case when rn = 1 then p_brand else p_brand || '_' || p_partkey end as file_name from x union all
    select 'planted', p_partkey, case when rn = 1 then p_brand || '_' || p_partkey else p_brand || '_' || p_partkey || '_' || (p_partkey + 1000000) end from x where p_partkey % 5 = 0 union all
    select 'again', p_partkey, p_brand || '_' || p_partkey || '_' || (p_partkey + 1000000) || case when rn = 1 then '' else '_2' end from x where p_partkey % 5 = 0"""
)
def w5_names_that_clash_again(t: Tables) -> DataFrame:
    """Stems that are names with a suffix already, twice over."""
    plain = t.part.select(F.lit("plain").alias("rows"), "p_partkey", F.col("p_brand").alias("stem"), F.col("p_partkey").alias("order"))
    named = F.concat("p_brand", F.lit("_"), F.col("p_partkey").cast("string"))
    more = t.part.filter("p_partkey % 5 = 0").withColumn("rows", F.explode(F.array(F.lit("planted"), F.lit("again")))).select("rows", "p_partkey", named.alias("stem"), (F.col("p_partkey") + 1_000_000).alias("order"))
    rows = plain.unionByName(more).withColumn("turn", F.when(F.col("rows") == "plain", 0).when(F.col("rows") == "planted", 1).otherwise(2))
    return R.assign_unique_name(rows, "stem", "order", ["turn", "order"]).select("rows", "p_partkey", "file_name")


@plan(
    """with c as (select o_custkey, o_orderpriority, count(*) as n, row_number() over (partition by o_custkey order by count(*) desc, o_orderpriority) as rn from orders group by 1, 2)
    select o.o_orderkey, c.o_orderpriority as mode, o.o_orderpriority <> c.o_orderpriority as deviates from orders o join c on c.o_custkey = o.o_custkey and rn = 1"""
)
def w6_modal_variant(t: Tables) -> DataFrame:
    return R.modal_value(t.orders, "o_custkey", "o_orderpriority").select("o_orderkey", "mode", "deviates")


@plan(
    """with c as (select l_orderkey, l_linenumber, l_partkey, round(l_quantity / 10) as size, count(*) over (partition by l_orderkey, round(l_quantity / 10)) as same, bool_or(l_returnflag = 'R') over (partition by l_orderkey, round(l_quantity / 10)) as home,
    row_number() over (partition by l_orderkey, round(l_quantity / 10) order by (l_returnflag = 'R') desc, l_linenumber, l_partkey) as rn from lineitem) select l_orderkey, size, l_linenumber, l_partkey, same > 1 and not home as ambiguous from c where rn = 1"""
)
def w7_duplicate_size_tiebreak(t: Tables) -> DataFrame:
    d = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.round(F.col("l_quantity") / 10).alias("size"), (F.col("l_returnflag") == "R").alias("home"))
    by = d.groupBy("l_orderkey", "size").agg(F.count("*").alias("same"), F.bool_or("home").alias("any_home"))
    one = R.first_by_priority(d, ["l_orderkey", "size"], [F.col("home").desc(), F.col("l_linenumber"), F.col("l_partkey")])
    return one.join(by, ["l_orderkey", "size"]).select("l_orderkey", "size", "l_linenumber", "l_partkey", ((F.col("same") > 1) & ~F.col("any_home")).alias("ambiguous"))


@plan("select l_orderkey, count(*) filter (q < p) as inversions from (select l_orderkey, l_quantity as q, lag(l_quantity) over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey) as p from lineitem) group by 1")
def w8_monotonic_check(t: Tables) -> DataFrame:
    from pyspark.sql import Window

    p = F.lag("l_quantity").over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey"))
    return t.lineitem.withColumn("p", p).groupBy("l_orderkey").agg(F.count_if(F.col("l_quantity") < F.col("p")).alias("inversions"))


@plan("select l_orderkey, l_linenumber, l_partkey, bool_or(l_returnflag = 'R') over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey rows unbounded preceding) as hit_before from lineitem")
def w9_running_any(t: Tables) -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey").rowsBetween(Window.unboundedPreceding, 0)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.max(F.col("l_returnflag") == "R").over(w).alias("hit_before"))


@plan("select doc_id, ordinal, md5(lines[ordinal + 1]) as line from (select doc_id, lines, unnest(range(0, len(lines)))::int as ordinal from (select doc_id, string_split(text, chr(10)) as lines from documents))")
def w10_ordinal_columns(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("ordinal", "line")).withColumn("line", F.md5("line"))


@plan(
    """with e as (select 'order' as sk, 'part' as dk, 'f' || l_linenumber as field, 1 + l_linenumber % 2 as n, case when l_partkey % 2 = 0 then 'ptr:same' else 'ptr:cross' end as m from lineitem where l_partkey % 3 > 0
      union all select 'order', 'customer', 'owner', 1, 'guid' from orders union all select 'customer', 'nation', null, null, case when c_custkey % 5 = 0 then 'name:nation' else 'guid' end from customer),
    f as (select *, row_number() over (partition by sk, dk order by refs desc, field) as rn from (select sk, dk, field, sum(coalesce(n, 1)) as refs from e where field is not null group by 1, 2, 3)),
    t as (select sk, dk, string_agg(field || '=' || refs, ',' order by field) as top from f where rn <= 3 group by 1, 2), k as (select unnest(['order', 'part', 'customer', 'nation']) as kind),
    c as (select sk, dk, count(*) as edges, bool_or(starts_with(m, 'ptr:')) as ptr, bool_or(m = 'guid') as guid, bool_or(starts_with(m, 'name:')) as named from e group by 1, 2)
    select a.kind as src_kind, b.kind as dst_kind, coalesce(edges, 0) as edges, case when coalesce(edges, 0) = 0 then 'missing' when a.kind = 'order' and b.kind = 'part' then 'partial' else 'modeled' end as status, coalesce(top, '') as top_fields,
    case when ptr then 'pointer' when guid then 'guid' when named then 'name' else 'none' end as join_key, case when edges > 0 and not named then 'hard' else 'inferred' end as mechanism from k a cross join k b left join c on c.sk = a.kind and c.dk = b.kind left join t on t.sk = a.kind and t.dk = b.kind"""
)
def a2_pair_profile(t: Tables) -> DataFrame:
    edge = lambda df, s, sid, d, field, n, m: df.select(F.lit(s).alias("src_kind"), F.col(sid).cast("bigint").alias("src_id"), F.lit(d).alias("dst_kind"), field.cast("string").alias("field"), n.cast("int").alias("ref_count"), m.alias("method"))
    line = F.col("l_linenumber")
    edges = edge(t.lineitem.filter("l_partkey % 3 > 0"), "order", "l_orderkey", "part", F.concat(F.lit("f"), line.cast("string")), 1 + line % 2, F.when(F.col("l_partkey") % 2 == 0, "ptr:same").otherwise("ptr:cross"))
    edges = edges.unionByName(edge(t.orders, "order", "o_orderkey", "customer", F.lit("owner"), F.lit(1), F.lit("guid")))
    edges = edges.unionByName(edge(t.customer, "customer", "c_custkey", "nation", F.lit(None), F.lit(None), F.when(F.col("c_custkey") % 5 == 0, "name:nation").otherwise("guid")))
    open_ = t.lineitem.filter("l_partkey % 3 = 0").agg(F.count("*").alias("n")).select(F.lit("order").alias("src_kind"), F.lit("part").alias("dst_kind"), "n")
    kinds = t.region.limit(1).select(F.explode(F.array(*map(F.lit, ("order", "part", "customer", "nation")))).alias("kind"))
    p = G.pair_profile(kinds, edges, open_, [("^ptr:", "pointer"), ("^guid$", "guid"), ("^name:", "name")], ["ptr:same", "ptr:cross", "guid"], 3)
    top = F.coalesce(F.array_join(F.array_sort(F.transform(F.map_entries("top_fields"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))), ","), F.lit(""))
    return p.select("src_kind", "dst_kind", "edges", "status", top.alias("top_fields"), "join_key", "mechanism")


@plan("select p_brand, p_name, p_size, row_number() over (partition by p_brand order by p_name, p_size) as place from (select distinct p_brand, p_name, p_size from part)")
def a4_usage_list(t: Tables) -> DataFrame:
    return G.usage_list(t.part, "p_brand", ["p_name", "p_size"])


@plan("with e as (select distinct p_partkey as k, unnest([p_partkey + p_size, p_partkey + p_size, p_size * 1000]) as d from part), x as (select d, count(*) as n, d in (select p_partkey from part) as known from e group by 1) select sum(n)::bigint as edges, coalesce(sum(n) filter (known), 0)::bigint as resolved, count(*) filter (not known) as open_targets from x")
def a18_dependencies(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", F.array(F.col("p_partkey") + F.col("p_size"), F.col("p_partkey") + F.col("p_size"), F.col("p_size").cast("bigint") * 1000).alias("needs"))
    return G.catalog_dependencies(rows, "p_partkey", "needs")


@plan("select md5((o_custkey % 50)::varchar) as guid, count(*) as entries, count(distinct case when o_orderkey % 4 > 0 then o_orderpriority end) as addresses, min(case when o_orderkey % 4 > 0 then o_orderpriority end) as first_address, count(*) filter (o_orderkey % 4 = 0) as null_addresses from orders where o_custkey % 50 > 0 group by 1")
def a18_guid_index(t: Tables) -> DataFrame:
    c = F.col("o_custkey") % 50
    rows = t.orders.select(F.when(c > 0, F.md5(c.cast("string"))).alias("guid"), F.when(F.col("o_orderkey") % 4 > 0, F.col("o_orderpriority")).alias("address"))
    return G.guid_index(rows, "guid", "address")


@plan("with n as (select l_orderkey, l_returnflag, count(*) as n, min(l_suppkey) as first from lineitem group by 1, 2) select l_orderkey, sum(n)::bigint as objects, coalesce(sum(n) filter (n > 1), 0)::bigint as sharing, min(first) as first_l_suppkey from n group by 1")
def a33_shared_addresses(t: Tables) -> DataFrame:
    return G.object_index(t.lineitem, ["l_orderkey"], ["l_suppkey"], "l_returnflag")


@plan(
    """with c as (select p_partkey as k, 'part' as sk, case when p_size % 3 = 0 then upper(p_name) when p_size % 3 = 1 then p_name else p_name || '?' end as sn, p_size % 3 as w, p_name, s_suppkey as d, s_name as dn from part join supplier on s_suppkey = p_partkey % 10 + 1),
    t as (select p_name, min(p_partkey) as id from part group by 1), x as (select c.*, t.id from c left join t on c.p_name = t.p_name and w < 2)
    select k, case when id is null then 'flags-missing' when id % 2 = 0 then 'confirms-hard' else 'adds-derived' end as effect, id is not null as ends_known, w = 0 and sn <> p_name as inferred from x"""
)
def j8_resolved_claims(t: Tables) -> DataFrame:
    """Claims from parts to suppliers by names, some in capitals, some unknown; edges are measured for even parts."""
    w = F.col("p_size") % 3
    part = over_cores(t.part.select("p_partkey", "p_name", "p_size"))  # ten edges a part are more than its file tells
    c = part.join(t.supplier, F.col("s_suppkey") == F.col("p_partkey") % 10 + 1)
    claims = c.select(F.col("p_partkey").alias("k"), F.lit("part").alias("src_kind"), F.when(w == 0, F.upper("p_name")).when(w == 1, F.col("p_name")).otherwise(F.concat("p_name", F.lit("?"))).alias("src_name"), F.lit("supplier").alias("dst_kind"), F.col("s_name").alias("dst_name"))
    targets = t.part.select(F.lit("part").alias("kind"), F.col("p_name").alias("name"), F.col("p_partkey").cast("bigint").alias("id")).unionByName(t.supplier.select(F.lit("supplier").alias("kind"), F.col("s_name").alias("name"), F.col("s_suppkey").cast("bigint").alias("id")))
    edges = part.filter("p_partkey % 2 = 0").select(F.lit("part").alias("src_kind"), F.col("p_partkey").cast("bigint").alias("src_id"), F.lit("supplier").alias("dst_kind")).crossJoin(F.broadcast(t.spark.range(1, 11).select(F.col("id").alias("dst_id"))))  # ten suppliers
    return G.resolved_claims(claims, targets, edges).select("k", "effect", "ends_known", "inferred")


@plan(
    """with e as (select 'k' || p_partkey as k, case when p_partkey % 3 = 0 then 'f' || (p_partkey % 9) when p_partkey % 3 = 1 then 'g' || (p_partkey % 4) end as f, p_partkey % 3 = 1 as hashed, case when p_partkey % 2 = 0 then 'k' || (p_partkey + 1) end as d from part),
    r as (select unnest(['f0', 'f3', 'g1', 'g2']) as f), a as (select distinct k, e.f as target, case when r.f is null then 'dangling-file' when hashed then 'hash-suffix' else 'file' end as via, e.f || case when hashed then '_' || repeat('a', 32) else '' end as name from e left join r using (f) where e.f is not null)
    select k as key, case when via = 'dangling-file' then name else target end as target, via from a union all select distinct e.k, coalesce(b.target, e.d), case when b.k is null then 'dangling-key' else 'key' end from e left join a b on b.k = e.d and b.via <> 'dangling-file' where e.d is not null"""
)
def j13_key_dependencies(t: Tables) -> DataFrame:
    """Keys with files, some with a hash, some not in the roster, and with other keys, whose files they then need."""
    p = F.col("p_partkey")
    text = lambda c: c.cast("string")
    reference = F.when(p % 3 == 0, F.concat(F.lit("x/f"), text(p % 9), F.lit(".bundle"))).when(p % 3 == 1, F.concat(F.lit("g"), text(p % 4), F.lit("_"), F.repeat(F.lit("a"), F.lit(32)), F.lit(".bundle")))
    entries = t.part.select(F.concat(F.lit("k"), text(p)).alias("key"), reference.alias("reference"), F.when(p % 2 == 0, F.concat(F.lit("k"), text(p + 1))).alias("dependency"))
    files = t.region.limit(1).select(F.explode(F.array(*map(F.lit, ("f0", "f3", "g1", "g2")))).alias("file"))
    return R.key_dependencies(entries, files, "file")
