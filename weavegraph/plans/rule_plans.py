"""Spatial and rule datasets, ancestry, canonical payloads, sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weavegraph.operators import identity as I
from weavegraph.operators import rules as U
from weavegraph.operators import spatial as S
from weavegraph.plans.registry import Plans, Tables
from weavegraph.sources import io

plan = Plans()


@plan(
    """with recursive ty as (select n_name as name, r_name as base from nation join region on r_regionkey = n_regionkey where n_nationkey % 7 > 0 union all select n_name, null from nation where n_nationkey % 7 = 0 union all select r_name, case when r_regionkey < 3 then 'root' else 'engine' end from region union all select 'root', null),
    w as (select name, name as here, base as nxt from ty union all select w.name, w.nxt, ty.base from w left join ty on ty.name = w.nxt where w.nxt is not null), e as (select name, here from w where nxt is null)
    select name, here as reaches, case when here = 'root' then 'definition' else 'component' end as verdict from e"""
)
def p3_definition_gate(t: Tables) -> DataFrame:
    nations = t.nation.join(t.region, F.col("r_regionkey") == F.col("n_regionkey")).select(F.col("n_name").alias("name"), F.when(F.col("n_nationkey") % 7 > 0, F.col("r_name")).alias("base"))
    regions = t.region.select(F.col("r_name").alias("name"), F.when(F.col("r_regionkey") < 3, "root").otherwise("engine").alias("base"))
    root = t.region.limit(1).select(F.lit("root").alias("name"), F.lit(None).cast("string").alias("base"))
    return U.definition_gate(nations.unionByName(regions).unionByName(root), "root")


@plan("select n_name as name from nation join region on r_regionkey = n_regionkey where r_name = 'ASIA' or n_nationkey % 5 = 0")
def p4_ancestry_filter(t: Tables) -> DataFrame:
    j = t.nation.join(t.region, F.col("r_regionkey") == F.col("n_regionkey"))
    types = j.select(F.col("n_name").alias("name"), F.col("r_name").alias("base"), F.when(F.col("n_nationkey") % 5 == 0, F.array(F.lit("ASIA"))).alias("interfaces"))
    return U.ancestry_filter(types, "ASIA").select("name")


@plan(
    """select l_orderkey, l_linenumber, l_partkey, case when o_custkey is null then 'guid' when c_nationkey is null then 'address' when n_name is null then 'container' else 'none' end as broken from lineitem left join orders on o_orderkey = l_orderkey and o_orderkey % 5 > 0 left join customer on c_custkey = o_custkey and c_acctbal > 0 left join nation on n_nationkey = c_nationkey and n_nationkey < 20"""
)
def p6_classify_chain(t: Tables) -> DataFrame:
    d = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey").join(t.orders.filter("o_orderkey % 5 > 0").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey", "left")
    d = d.join(t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey", "left").join(t.nation.filter("n_nationkey < 20").select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey", "left")
    return d.select("l_orderkey", "l_linenumber", "l_partkey", I.classify_chain(F.col("o_custkey"), F.col("c_nationkey"), F.col("n_name")).alias("broken"))


@plan("select p_partkey, case when p_brand = 'Brand#11' then 'internal-kernel' when p_size < 10 then 'english-only-literal' when not contains(p_name, 'e') then 'no-display-field' else 'residue' end as unjoined from part")
def p9_classify_unjoined(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", I.classify_unjoined(F.col("p_size") < 10, F.contains("p_name", F.lit("e")), F.col("p_brand") == "Brand#11").alias("unjoined"))


@plan("select l_orderkey, l_linenumber, l_partkey, case when l_returnflag = 'R' then 'removed' when p_name is not null then 'resolved-address' when l_linenumber = 1 then 'resolved-scene' when l_quantity > 40 then 'editor-only' else 'open' end as residue from lineitem left join part on p_partkey = l_partkey and p_size <= 25")
def p10_classify_residue(t: Tables) -> DataFrame:
    d = t.lineitem.join(t.part.filter("p_size <= 25").select(F.col("p_partkey").alias("l_partkey"), "p_name"), "l_partkey", "left")
    return d.select("l_orderkey", "l_linenumber", "l_partkey", I.classify_residue(F.col("l_returnflag") == "R", F.col("p_name"), F.col("l_linenumber") == 1, F.col("l_quantity") > 40).alias("residue"))


@plan("with v as (select distinct o_orderpriority as g, o_custkey as v from orders), n as (select g, count(*) as n_values, count(*) filter (c_custkey is not null) as n_known from v left join customer on c_custkey = v and c_custkey % 3 > 0 group by 1) select g, n_values, n_known, case when n_known = 0 then 'blocked' when n_known < n_values then 'partial' else 'decoded' end as status from n")
def p13_decode_status(t: Tables) -> DataFrame:
    v = t.orders.select(F.col("o_orderpriority").alias("g"), F.col("o_custkey").alias("v"))
    return S.decode_status(v, t.customer.filter("c_custkey % 3 > 0").select(F.col("c_custkey").alias("v")), "g", "v")


@plan("select p_partkey, (p_size * 2 * 4)::int as w, trunc(p_retailprice * 2 * 4)::int as h from part")
def p22_grid_projection(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", S.grid_size("p_size", "p_retailprice", 4).alias("g")).select("p_partkey", "g.w", "g.h")


@plan("select o_orderkey, case when c_nationkey is not null then c_nationkey + o_orderkey end as x, case when o_custkey % 2 = 0 then o_custkey + 1 end as y from orders left join customer on c_custkey = o_custkey and c_acctbal > 0")
def p23_derived_world(t: Tables) -> DataFrame:
    d = t.orders.join(t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey", "left")
    parent = F.struct(F.col("c_nationkey").cast("bigint").alias("x"), F.when(F.col("o_custkey") % 2 == 0, F.col("o_custkey")).alias("y"))
    d = d.select("o_orderkey", parent.alias("parent"), F.struct(F.col("o_orderkey").alias("x"), F.lit(1).cast("bigint").alias("y")).alias("local"))
    return d.select("o_orderkey", S.derived_world("parent", "local", ["x", "y"]).alias("p")).select("o_orderkey", "p.x", "p.y")


@plan(
    """with r as (select c_custkey, (sign(c_acctbal) * floor(abs(c_acctbal) / 100 + 0.5))::int as x, (c_nationkey + 0.5)::double as y0 from customer), s as (select c_custkey, x, floor(y0 + 0.5)::int as y from r), q as (select c_custkey, x as crop_x, 100 - y - 10 as crop_y, 10 as crop_w, 10 as crop_h from s)
    select *, crop_x >= 0 and crop_y >= 0 and crop_x + crop_w <= 100 and crop_y + crop_h <= 100 as in_page from q"""
)
def p24_crop_bounds(t: Tables) -> DataFrame:
    d = t.customer.select("c_custkey", (F.signum("c_acctbal") * F.abs("c_acctbal") / 100).alias("x"), (F.col("c_nationkey") + 0.5).alias("y"), F.lit(9.5).alias("w"), F.lit(10.4).alias("h"), F.lit(100).alias("pw"), F.lit(100).alias("ph"))
    return S.crop_bounds(d, "x", "y", "w", "h", "pw", "ph").select("c_custkey", "crop_x", "crop_y", "crop_w", "crop_h", "in_page")


@plan(
    """with g as (select p_brand, p_size % 7 as w, p_size % 5 as h from part), s as (select p_brand, w, h, w * h as a from g where w > 0 and h > 0), lo as (select p_brand, w || 'x' || h as smallest from (select *, row_number() over (partition by p_brand order by a, w, h) as rn from s) where rn = 1),
    hi as (select p_brand, w || 'x' || h as largest from (select *, row_number() over (partition by p_brand order by a desc, w desc, h desc) as rn from s) where rn = 1) select p_brand, count(*) filter (w = 0 or h = 0) as zero_size, any_value(smallest) as smallest, any_value(largest) as largest, max(w) as max_w, max(h) as max_h from g join lo using (p_brand) join hi using (p_brand) group by 1"""
)
def a42_grid_extents(t: Tables) -> DataFrame:
    return S.grid_extents(t.part.select("p_brand", (F.col("p_size") % 7).alias("w"), (F.col("p_size") % 5).alias("h")), ["p_brand"], "w", "h")


@plan(
    """with b as (select o_custkey, arg_min(o_orderstatus, o_orderkey) as s, arg_min(o_orderpriority, o_orderkey) as p from orders group by 1), d as (select o_orderkey, o_orderstatus is distinct from s as d1, o_orderpriority is distinct from p as d2 from orders join b using (o_custkey))
    select o_orderkey, case when d1 and d2 then 'o_orderstatus,o_orderpriority' when d1 then 'o_orderstatus' when d2 then 'o_orderpriority' else '' end as differs, (d1::int + d2::int) as n_differs from d"""
)
def a21_finance_diff(t: Tables) -> DataFrame:
    base = t.orders.groupBy("o_custkey").agg(F.min_by("o_orderstatus", "o_orderkey").alias("o_orderstatus"), F.min_by("o_orderpriority", "o_orderkey").alias("o_orderpriority"))
    return U.differing_fields(t.orders, base, ["o_custkey"], ["o_orderstatus", "o_orderpriority"]).select("o_orderkey", "differs", "n_differs")


@plan("with x as (select 'sink' as part, l_quantity as amount from lineitem where l_returnflag = 'R' union all select 'source', l_quantity from lineitem where l_returnflag = 'A'), s as (select part, count(*) as n, sum(amount) as amount from x group by 1) select k.part, coalesce(n, 0) as n, amount, coalesce(n, 0) = 0 as is_empty from (select unnest(['sink', 'source', 'loan']) as part) k left join s using (part)")
def a22_price_ledger(t: Tables) -> DataFrame:
    return U.price_ledger({"sink": t.lineitem.filter("l_returnflag = 'R'"), "source": t.lineitem.filter("l_returnflag = 'A'")}, ["sink", "source", "loan"], "l_quantity")


@plan("select l_discount, count(*) as n, l_discount not in (select distinct l_discount from lineitem where l_discount < 0.05) as is_new from lineitem group by 1")
def a23_cost_distribution(t: Tables) -> DataFrame:
    return U.cost_distribution(t.lineitem, "l_discount", t.lineitem.filter("l_discount < 0.05").select("l_discount"))


@plan("select l_orderkey, l_partkey, l_linenumber, l_suppkey, unnest(['discount', 'tax']) as attribute, unnest([l_discount, l_tax]) as rate from lineitem")
def a24_need_decay(t: Tables) -> DataFrame:
    d = t.lineitem.withColumn("rates", F.create_map(F.lit("discount"), "l_discount", F.lit("tax"), "l_tax")).withColumn("key", F.struct("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey"))
    return U.rates_by_attribute(d, "key", "rates").select("key.*", "attribute", "rate")


@plan("select p_partkey, 2 as n_modules, x.o::int as ordinal, x.m as module, case when x.m like 'PROMO%' then 'promo' end as label from (select p_partkey, unnest([{'o': 0, 'm': p_type}, {'o': 1, 'm': p_brand}]) as x from part)")
def a25_module_terms(t: Tables) -> DataFrame:
    labels = t.part.filter("p_type like 'PROMO%'").select(F.col("p_type").alias("module"), F.lit("promo").alias("label")).distinct()
    return U.terms_of_modules(t.part.withColumn("modules", F.array("p_type", "p_brand")), ["p_partkey"], "modules", labels).select("p_partkey", "n_modules", "ordinal", "module", "label")


@plan("select event_type, count(*) as n, count(*) filter (value > 50) as high, count(*) filter (regexp_matches(props, '[0-4]')) as low_key from events group by 1")
def a38_interaction_profile(t: Tables) -> DataFrame:
    return U.profile(t.events, ["event_type"], {"high": F.col("value") > 50, "low_key": F.col("props").rlike("[0-4]")})


@plan("select c_custkey, n_name as nation, s as supplier, case when n_name is null and s is null then 'nation,supplier' when n_name is null then 'nation' when s is null then 'supplier' else '' end as gaps from customer left join nation on n_nationkey = c_nationkey and n_nationkey < 20 left join (select s_nationkey, min(s_name) as s from supplier where s_acctbal > 0 group by 1) on s_nationkey = c_nationkey")
def a39_course_rows(t: Tables) -> DataFrame:
    n = t.nation.filter("n_nationkey < 20").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("value"))
    s = t.supplier.filter("s_acctbal > 0").groupBy(F.col("s_nationkey").alias("c_nationkey")).agg(F.min("s_name").alias("value"))
    return U.split_with_gaps(t.customer, {"nation": n, "supplier": s}, "c_nationkey").select("c_custkey", "nation", "supplier", "gaps")


@plan("select n_name, null::varchar as carrier, 'no carrier' as reason from nation where n_nationkey not in (select s_nationkey from supplier where s_acctbal > 5000)")
def a40_absent_carriers(t: Tables) -> DataFrame:
    carriers = t.supplier.filter("s_acctbal > 5000").select(F.col("s_nationkey").alias("n_nationkey"))
    return U.absent_members(t.nation, carriers, "n_nationkey").select("n_name", "carrier", "reason")


@plan("""select o_orderkey, sha256('{"a": ' || o_custkey || ', "b": {"x": "' || o_orderstatus || '", "y": [1, null]}}') as payload_hash from orders""")
def f12_payload_hash(t: Tables) -> DataFrame:
    payload = F.concat(F.lit('{"b":{"y":[1,null],"x":"'), "o_orderstatus", F.lit('"},"_own":1,"a":'), F.col("o_custkey").cast("string"), F.lit("}"))
    return I.payload_hash(t.orders.select("o_orderkey", payload.alias("payload")), "payload").select("o_orderkey", "payload_hash")


@plan("select lang, null as source, count(*) as n, sum(n_chars)::bigint as bytes from documents group by 1 union all select null, source, count(*), sum(n_chars)::bigint from documents group by 2")
def s12_media_rollup(t: Tables) -> DataFrame:
    return io.media_rollup(t.documents, "lang", "source", "n_chars")


@plan(
    """with e as (select distinct p_partkey % 60 as g, case when p_size % 10 > 0 then 'a' || p_size end as a from part where p_partkey % 60 <> 7), c as (select distinct 'a' || (s_suppkey * 2 % 40) as a from supplier),
    b as (select g, min(a) filter (a in (select a from c)) as held, min(a) as any_ from e group by 1) select o_orderkey, coalesce(held, any_) as address, case when b.g is null then 'guid' when any_ is null then 'address' when held is null then 'container' else 'none' end as chain from orders left join b on g = o_custkey % 60"""
)
def p6_chosen_address(t: Tables) -> DataFrame:
    entries = t.part.filter("p_partkey % 60 <> 7").select((F.col("p_partkey") % 60).alias("guid"), F.when(F.col("p_size") % 10 > 0, F.concat(F.lit("a"), F.col("p_size").cast("string"))).alias("address"))
    containers = t.supplier.select(F.concat(F.lit("a"), (F.col("s_suppkey") * 2 % 40).cast("string")).alias("address"))
    return I.chosen_address(t.orders.select("o_orderkey", (F.col("o_custkey") % 60).alias("g")), "g", entries, containers).select("o_orderkey", "address", "chain")


@plan(
    """with p as (select p_partkey, p_size % 5 as x, case when p_size % 11 > 0 then p_size % 3 end as y from part), m as (select x, y from p where y is not null group by 1, 2 order by count(*) desc, x, y limit 1)
    select p_partkey, coalesce(p.y is not null and (p.x <> m.x or p.y <> m.y), false) as variant from p, m"""
)
def p22_variants_of_mode(t: Tables) -> DataFrame:
    d = t.part.select("p_partkey", (F.col("p_size") % 5).alias("x"), F.when(F.col("p_size") % 11 > 0, F.col("p_size") % 3).alias("y"))
    return S.variants_of_mode(d, ["x", "y"]).select("p_partkey", "variant")


@plan(
    """with b as (select c_custkey as k, c_custkey % 3 as w from customer) select k as c_custkey, 'decay' as source, x.a as attribute, x.r * k as rate from b, (values ('food', 0.5), ('rest', 2.0)) x(a, r) where w = 0 union all
    select k, 'room', 'noise', k::double from b where w = 1 union all select k, 'item', 'light', k + 0.25 from b where w = 1"""
)
def a24_rates_of_blocks(t: Tables) -> DataFrame:
    """Three sources in blocks of two classes: an object of rates, a list of them, and members that aren't there."""
    k = F.col("c_custkey").cast("double")
    first = F.parse_json(F.to_json(F.struct(F.struct((k * 0.5).alias("food"), (k * 2).alias("rest")).alias("rates"))))
    second = F.parse_json(F.to_json(F.struct(F.array(F.struct(F.lit("noise").alias("attribute"), k.alias("rate")), F.struct(F.lit("none").alias("attribute"), F.lit(None).cast("double").alias("rate"))).alias("list"), F.struct((k + 0.25).alias("light")).alias("item"))))
    blocks = t.customer.select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, "Decay").when(F.col("c_custkey") % 3 == 1, "Room").otherwise("Other").alias("class"), F.when(F.col("c_custkey") % 3 == 0, first).otherwise(second).alias("data"))
    return U.need_rates(blocks, ["c_custkey"], {"decay": ("Decay", "$.rates"), "room": ("Room", "$.list"), "item": ("Room", "$.item"), "gone": ("Room", "$.gone")})
