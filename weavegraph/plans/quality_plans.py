"""Contracts, drift, sorts and samples over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weavegraph.operators import audit as A
from weavegraph.operators import drift as D
from weavegraph.operators import quality as Q
from weavegraph.operators.order import numbered, quota_sample
from weavegraph.operators.resolve import top_k
from weavegraph.plans.registry import Plans, Tables, over_cores
from weavegraph.sources.shared import stored

plan = Plans()


def _sql(check: str, dataset: str, count: str) -> str:
    return f"select '{check}' as check_id, '{dataset}' as dataset, case when n = 0 then 'PASS' else 'FAIL' end as status, 0::bigint as expected, n::bigint as measured from ({count}) q(n)"


@plan(_sql("key-set", "events", "select count(*) from events where json_keys(props) is distinct from ['k']"))
def q1_key_set(t: Tables) -> DataFrame:
    return Q.key_set(t.events, "props", ["k"], "events")


@plan(_sql("key-set-by", "events", "select count(*) from events where event_type <> 'click'"))
def q2_key_set_by(t: Tables) -> DataFrame:
    return Q.key_set_by(t.events, "props", "event_type", {"click": ["k"]}, "events")


@plan(_sql("domain", "orders", "select count(distinct o_orderpriority) from orders where o_orderpriority not in ('1-URGENT', '2-HIGH') and not starts_with(o_orderpriority, '4-')"))
def q3_domain(t: Tables) -> DataFrame:
    return Q.domain(t.orders, "o_orderpriority", ["1-URGENT", "2-HIGH"], "orders", ("4-",))


@plan(_sql("grammar", "pages", "select count(*) from pages where not regexp_matches(url, '^https://[a-z0-9.]+/[a-z]+')"))
def q4_grammar(t: Tables) -> DataFrame:
    return Q.grammar(t.pages, "url", "^https://[a-z0-9.]+/[a-z]+", "pages")


@plan(_sql("constant", "lineitem", "select count(*) from lineitem where l_linestatus is distinct from 'O'"))
def q5_constant(t: Tables) -> DataFrame:
    return Q.constant(t.lineitem, "l_linestatus", "O", "lineitem")


@plan(_sql("unique", "lineitem", "select count(*) from (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1)"))
def q6_unique(t: Tables) -> DataFrame:
    return Q.unique(t.lineitem, ["l_orderkey", "l_linenumber"], "lineitem")


@plan(_sql("identical-repeats", "documents", "select count(*) from (select source, n_chars from documents group by 1, 2 having count(distinct (text, lang)) > 1)"))
def q6_identical_repeats(t: Tables) -> DataFrame:
    return Q.identical_repeats(t.documents.select("source", "n_chars", "text", "lang"), ["source", "n_chars"], "documents")


@plan(_sql("foreign-key", "lineitem", "select count(*) from lineitem where l_partkey not in (select p_partkey from part where p_size < 45)"))
def q7_foreign_key(t: Tables) -> DataFrame:
    return Q.foreign_key(t.lineitem, "l_partkey", t.part.filter("p_size < 45"), "p_partkey", "lineitem")


@plan("select 'reconcile' as check_id, 'orders' as dataset, case when a = b then 'PASS' else 'FAIL' end as status, a as expected, b as measured from (select count(*) as a from orders), (select sum(n)::bigint as b from (select count(*) as n from orders group by o_orderstatus))")
def q8_reconcile(t: Tables) -> DataFrame:
    parts = t.orders.groupBy("o_orderstatus").agg(F.count("*").alias("n")).agg(F.sum("n").alias("v"))
    return Q.reconcile(t.orders.agg(F.count("*").alias("v")), parts, "orders")


@plan(_sql("same-rows", "lineitem", "select count(*) from ((select l_orderkey from lineitem where l_quantity > 48 except all select l_orderkey from lineitem where l_tax > 0.07) union all (select l_orderkey from lineitem where l_tax > 0.07 except all select l_orderkey from lineitem where l_quantity > 48))"))
def q9_same_rows(t: Tables) -> DataFrame:
    return Q.same_rows(t.lineitem.filter("l_quantity > 48").select("l_orderkey"), t.lineitem.filter("l_tax > 0.07").select("l_orderkey"), "lineitem")


@plan(_sql("replay", "orders", "select count(*) * 2 from (select o_custkey from orders group by 1) where o_custkey % 9 = 0"))
def q10_replay(t: Tables) -> DataFrame:
    """A written result against its computation from the table: a ninth of the rows was written wrong, and differs both ways."""
    counts = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"))
    written = stored(counts.withColumn("n", F.col("n") + (F.col("o_custkey") % 9 == 0).cast("int")), "replay")
    return Q.same_rows(written, counts, "orders", "replay")


@plan(_sql("implication", "lineitem", "select count(*) from lineitem where l_returnflag = 'R' and not l_quantity < 45"))
def q11_implication(t: Tables) -> DataFrame:
    return Q.implication(t.lineitem, F.col("l_returnflag") == "R", F.col("l_quantity") < 45, "lineitem")


@plan(_sql("equivalence", "orders", "select count(*) from orders where (o_orderpriority = '1-URGENT') <> (o_totalprice > 200000)"))
def q12_equivalence(t: Tables) -> DataFrame:
    return Q.equivalence(t.orders, F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") > 200000, "orders")


@plan(_sql("derived", "documents", "select count(*) from documents where n_chars is distinct from length(text)"))
def q13_derived(t: Tables) -> DataFrame:
    return Q.derived(t.documents, "n_chars", F.length("text").cast("bigint"), "documents")


@plan(_sql("cap", "embeddings", "select count(*) from embeddings where len(embedding) > 32"))
def q14_cap(t: Tables) -> DataFrame:
    return Q.cap(t.embeddings, "embedding", 32, "embeddings")


SUITE = {
    "key-set": "json_keys(props) is distinct from ['k']",
    "key-superset": "coalesce(not list_contains(json_keys(props), 'k'), true)",
    "key-set-by": "event_type <> 'click'",
    "domain": "event_type not in ('click', 'view') and not starts_with(event_type, 'p')",
    "grammar": "not regexp_matches(props, '^.\"k')",
    "constant": "event_type is distinct from 'view'",
    "implication": "event_type = 'click' and not user_id % 2 = 0",
    "equivalence": "(event_type = 'view') <> (user_id % 3 = 0)",
    "derived": "length(props) is distinct from 8",
    "cap": "len(string_split(props, '1')) > 1",
}


@plan(
    "select r.check_id, 'events' as dataset, case when r.n = 0 then 'PASS' else 'FAIL' end as status, 0::bigint as expected, r.n as measured from (select unnest(["
    + ", ".join(f"{{'check_id': '{name}', 'n': count(*) filter ({bad})}}" for name, bad in SUITE.items())
    + "]) as r from events)"
)
def q_contract_suite(t: Tables) -> DataFrame:
    """Ten row-level contracts of events in one scan."""
    e = F.col("event_type")
    rules = [
        ("key-set", Q.keys_differ("props", ["k"])),
        ("key-superset", Q.keys_differ("props", ["k"], exact=False)),
        ("key-set-by", Q.keys_differ_by("props", "event_type", {"click": ["k"]})),
        ("domain", Q.outside("event_type", ["click", "view"], ("p",))),
        ("grammar", Q.ungrammatical("props", '^."k')),
        ("constant", Q.not_constant("event_type", "view")),
        ("implication", Q.not_implied(e == "click", F.col("user_id") % 2 == 0)),
        ("equivalence", Q.not_equivalent(e == "view", F.col("user_id") % 3 == 0)),
        ("derived", Q.not_derived("chars", F.lit(8))),
        ("cap", Q.over_cap("parts", 1)),
    ]
    return Q.contract_suite(t.events.withColumns({"chars": F.length("props"), "parts": F.split("props", "1")}), "events", rules)


METRICS_SQL = "m as (select 'orders.' || o_orderstatus as metric, count(*)::double as value, 1::bigint as snapshot_id, 'rows' as unit from orders group by 1)"


def metrics(t: Tables) -> DataFrame:
    m = t.orders.groupBy(F.concat(F.lit("orders."), "o_orderstatus").alias("metric")).agg(F.count("*").cast("double").alias("value"))
    return m.withColumn("snapshot_id", F.lit(1).cast("bigint")).withColumn("unit", F.lit("rows"))


@plan(
    f"""with {METRICS_SQL}, p as (select metric, case when metric = 'orders.F' then 2 else 1 end as snapshot_id, case when metric = 'orders.O' then value + 1 else value end as expected from m)
    select p.metric, case when p.snapshot_id <> m.snapshot_id then 'STALE' when value = expected then 'PASS' else 'MISMATCH' end as status, expected, value from p join m using (metric)"""
)
def q15_pins(t: Tables) -> DataFrame:
    m = metrics(t)
    pinned = m.select("metric", F.when(F.col("metric") == "orders.F", 2).otherwise(1).alias("snapshot_id"), F.when(F.col("metric") == "orders.O", F.col("value") + 1).otherwise(F.col("value")).alias("expected"))
    return Q.pins(m, pinned)


@plan(_sql("units", "metrics", "select count(distinct o_orderstatus) from orders where o_orderstatus = 'F'"))
def q16_units(t: Tables) -> DataFrame:
    m = metrics(t).withColumn("unit", F.when(F.col("metric") == "orders.F", F.lit(None)).otherwise(F.col("unit")))
    return Q.units(m, metrics(t).select("unit"), "metrics")


@plan("with g as (select o_orderstatus as reason, count(*) as measured from orders group by 1), e as (select 'F' as reason, (select count(*) from orders where o_orderstatus = 'F') as expected union all select 'O', 1::bigint union all select 'Z', 0) select reason, coalesce(measured, 0) as measured, expected, case when expected is null then 'FAIL' when coalesce(measured, 0) = expected then 'PASS' else 'MISMATCH' end as status from g full join e using (reason)")
def q17_ledger_counts(t: Tables) -> DataFrame:
    n = t.orders.filter("o_orderstatus = 'F'").agg(F.count("*").alias("n"))
    expected = n.select(F.explode(F.array(F.struct(F.lit("F").alias("reason"), F.col("n").alias("expected")), F.struct(F.lit("O").alias("reason"), F.lit(1).cast("bigint").alias("expected")), F.struct(F.lit("Z").alias("reason"), F.lit(0).cast("bigint").alias("expected")))).alias("x"))
    return Q.ledger_counts(t.orders, "o_orderstatus", expected.select("x.*"))


@plan("select 'unique' as check_id, d as dataset, case when n = 0 then 'PASS' else 'FAIL' end as status, 0::bigint as expected, n as measured, case when n > 0 and d = 'lineitem' then 'KNOWN' when n = 0 and d = 'orders' then 'FIXED' when n = 0 then 'PASS' else 'FAIL' end as verdict from (select 'lineitem' as d, count(*) as n from (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1) union all select 'orders', count(*) from (select 1 from orders group by o_orderkey having count(*) > 1) union all select 'part', count(*) from (select 1 from part group by p_name having count(*) > 1))")
def q18_known_failures(t: Tables) -> DataFrame:
    results = Q.suite(Q.unique(t.lineitem, ["l_orderkey", "l_linenumber"], "lineitem"), Q.unique(t.orders, ["o_orderkey"], "orders"), Q.unique(t.part, ["p_name"], "part"))
    registry = results.filter("dataset in ('lineitem', 'orders')").select("check_id", "dataset")
    return Q.known_failures(results, registry)


@plan("select audit, count(*) as n from (select case when p_size > 40 then 'uncited' when p_size % 7 = 0 then 'differs' else 'ok' end as audit from part) group by 1")
def q19_citations(t: Tables) -> DataFrame:
    values = t.part.select(F.col("p_partkey").alias("id"), F.lit("part").alias("source"), F.col("p_partkey").cast("string").alias("path"), (F.col("p_retailprice") + F.when(F.col("p_size") % 7 == 0, 1).otherwise(0)).alias("value"))
    sources = t.part.filter("p_size <= 40").select(F.lit("part").alias("source"), F.col("p_partkey").cast("string").alias("path"), F.col("p_retailprice").alias("cited"))
    return Q.citations(values, sources).groupBy("audit").agg(F.count("*").alias("n"))


AUDIT_SQL = """o as (select o_orderkey as k, o_custkey as c, o_totalprice as p from orders),
v as (select 'o' || k as artifact, 'copied' as path, case when k % 11 = 0 then 'unreadable' when k % 5 = 0 then 'differs' else 'ok' end as verdict from o
  union all select 'o' || k, 'sums[0]', case when k % 11 = 0 then 'unreadable' when k % 7 = 0 then 'differs' else 'recomputed' end from o
  union all select 'o' || k, 'sums[1]', case when k % 11 = 0 or k % 13 = 0 then 'unreadable' else 'recomputed' end from o
  union all select 'o' || k, 'code.depth.n', 'code' from o union all select 'o' || k, 'code.m', 'code' from o
  union all select 'o' || k, 'free', 'uncited' from o where k % 3 = 0 union all select 'o' || k, 'none', 'null' from o)"""


@plan(f"with {AUDIT_SQL} select path, verdict, count(*) as n, count(distinct artifact) as artifacts from v group by 1, 2")
def q19_audit(t: Tables) -> DataFrame:
    """Outputs whose numbers are copied, derived, coded, null, or from nowhere; some wrong, some whose source is gone."""
    k, c, p = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice")
    artifact, source = F.concat(F.lit("o"), k.cast("string")).alias("artifact"), F.concat(F.lit("s"), k.cast("string"))
    body = F.struct(
        (p + F.when(k % 5 == 0, 1).otherwise(0)).alias("copied"),
        F.array((p * 2 - (c + 3) / 4.0) + F.when(k % 7 == 0, 1).otherwise(0), -p).alias("sums"),
        F.struct(F.struct(c.alias("n")).alias("depth"), k.alias("m")).alias("code"),
        F.when(k % 3 == 0, c).alias("free"),
    )
    orders = over_cores(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"))
    outputs = orders.select(artifact, F.regexp_replace(F.to_json(body), r"\}$", ',"none":null,"flag":true,"name":"7"}').alias("payload"))
    sources = orders.filter("o_orderkey % 11 <> 0").select(source.alias("source"), F.to_json(F.struct(F.struct(p.alias("price")).alias("in"), F.array(c, c).alias("keys"))).alias("payload"))
    copies = t.orders.select(artifact, F.lit("copied").alias("path"), source.alias("source"), F.lit("in.price").alias("source_path"))
    cited = lambda at: F.concat(F.lit("{"), source, F.lit(f"#{at}}}"))
    first = F.concat(cited("in.price"), F.lit(" * 2 - ("), cited("keys[1]"), F.lit(" + 3) / 4"))
    second = F.concat(F.lit("-"), cited("in.price"), F.when(k % 13 == 0, F.lit(" / (1 - 1)")).otherwise(F.lit("")))
    formulas = orders.select(artifact, F.lit("sums[0]").alias("path"), first.alias("formula")).unionByName(orders.select(artifact, F.lit("sums[1]").alias("path"), second.alias("formula")))
    labelled = t.orders.select(artifact, F.lit("code.").alias("prefix"))
    return A.audit(outputs, sources, copies, formulas, labelled).groupBy("path", "verdict").agg(F.count("*").alias("n"), F.countDistinct("artifact").alias("artifacts"))


@plan(_sql("id-space", "orders", "select count(*) from orders where o_custkey % 3 = 0 and o_orderkey % 2 = 0"))
def q20_one_id_space(t: Tables) -> DataFrame:
    d = t.orders.select(F.when(F.col("o_custkey") % 3 == 0, F.col("o_custkey")).alias("a"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey")).alias("b"))
    return Q.one_id_space(d, "a", "b", "orders")


@plan(_sql("verbatim-ids", "part", "select count(*) from part where p_size = 3 or p_size > 48"))
def q21_verbatim_ids(t: Tables) -> DataFrame:
    emitted = t.part.select("p_partkey", F.when(F.col("p_size") == 3, F.upper("p_name")).otherwise(F.col("p_name")).alias("p_name"))
    return Q.verbatim_ids(emitted, t.part.filter("p_size <= 48"), ["p_partkey"], "p_name", "part")


@plan(f"with {METRICS_SQL} select metric, value + 5 as seed, value from m where metric = 'orders.F'")
def d1_drift(t: Tables) -> DataFrame:
    m = metrics(t)
    return D.drift(m, m.select("metric", F.when(F.col("metric") == "orders.F", F.col("value") + 5).otherwise(F.col("value")).alias("seed")))


SNAP_SQL = "now as (select l_returnflag || l_linestatus as metric, count(*)::double as value from lineitem where l_quantity < 40 group by 1), was as (select l_returnflag || l_linestatus as metric, count(*)::double as was from lineitem where l_quantity < 40 and (l_returnflag <> 'A' or l_quantity < 30) and l_returnflag || l_linestatus <> 'NF' group by 1)"


@plan(f"with {SNAP_SQL} select metric, value, was, case when was is null then 'first-run' when value = was then 'ok' when starts_with(metric, 'A') then 'regression' else 'improved' end as verdict from now left join was using (metric)")
def d2_regression(t: Tables) -> DataFrame:
    count = lambda df: df.groupBy(F.concat("l_returnflag", "l_linestatus").alias("metric")).agg(F.count("*").cast("double").alias("value")).withColumn("snapshot_id", F.lit(1))
    now = count(t.lineitem.filter("l_quantity < 40"))
    before = count(t.lineitem.filter("l_quantity < 40 and (l_returnflag <> 'A' or l_quantity < 30)")).filter("metric <> 'NF'")
    return D.regression(now, before, now.select("metric", F.when(F.col("metric").startswith("A"), "lower").otherwise("exact").alias("direction")))


@plan(f"with {METRICS_SQL} select metric, value, case when metric = 'orders.P' then 'ok' when metric = 'orders.F' then 'broken' else 'warning' end as verdict from m")
def d3_within_bounds(t: Tables) -> DataFrame:
    m = metrics(t)
    low = F.when(F.col("metric") == "orders.P", F.col("value") - 1).otherwise(F.col("value") + 1)
    bounds = m.select("metric", low.alias("low"), (F.col("value") + 2).alias("high"), F.when(F.col("metric") == "orders.F", 1).otherwise(9).alias("snapshot_id"))
    return D.within_bounds(m, bounds)


@plan("select p_partkey, case when p_size > 45 then 'removed' when p_size < 3 then 'added' else 'changed' end as change from part where p_size > 45 or p_size < 3 or p_size = 10")
def d4_snapshot_diff(t: Tables) -> DataFrame:
    old = t.part.filter("p_size >= 3").select("p_partkey", "p_name", "p_retailprice")
    new = t.part.filter("p_size <= 45").select("p_partkey", "p_name", F.when(F.col("p_size") == 10, F.col("p_retailprice") + 1).otherwise(F.col("p_retailprice")).alias("p_retailprice"))
    return D.snapshot_diff(old, new, ["p_partkey"]).select("p_partkey", "change")


DIFF_SQL = """w as (select p_partkey as k, case when p_size % 4 = 0 then p_brand end as a, case when p_size % 4 <> 0 then p_brand end as b, p_size as n from part where p_size >= 3),
x as (select p_partkey as k, case when (p_size % 4 = 0) <> (p_size = 8) then p_brand end as a, case when (p_size % 4 <> 0) <> (p_size = 8) then p_brand end as b, case when p_size = 9 then null else p_size end as n from part where p_size <= 45),
j as (select coalesce(w.k, x.k) as k, w.k is null as added, x.k is null as removed, w.a as wa, x.a as xa, w.b as wb, x.b as xb, w.n::varchar as wn, x.n::varchar as xn from w full join x on w.k = x.k),
f as (select k, 'changed' as change, 'a' as field, wa as was, xa as now from j where not added and not removed and wa is distinct from xa union all select k, 'changed', 'b', wb, xb from j where not added and not removed and wb is distinct from xb union all
  select k, 'changed', 'n', wn, xn from j where not added and not removed and wn is distinct from xn union all select k, case when added then 'added' else 'removed' end, null, null, null from j where added or removed)"""


@plan(f"with {DIFF_SQL} select k as p_partkey, change, field, was, now from f")
def d4_changed_fields(t: Tables) -> DataFrame:
    """Values that move between columns beside nulls, a number that goes, and rows that come and go."""
    size, four = F.col("p_size"), F.col("p_size") % 4 == 0
    side = lambda df, first, n: df.select("p_partkey", F.when(first, F.col("p_brand")).alias("a"), F.when(~first, F.col("p_brand")).alias("b"), n.alias("n"))
    old, new = side(t.part.filter("p_size >= 3"), four, size), side(t.part.filter("p_size <= 45"), four != (size == 8), F.when(size != 9, size))
    return D.snapshot_diff(old, new, ["p_partkey"]).select("p_partkey", "change", F.explode_outer("fields").alias("f")).select("p_partkey", "change", "f.*")


@plan("select o_orderkey, row_number() over (order by o_orderpriority, o_totalprice desc, o_orderkey) as place from orders")
def o1_total_sort(t: Tables) -> DataFrame:
    """The place of every row in a total order, by ranges of the whole order."""
    order = [F.col("o_orderpriority"), F.col("o_totalprice").desc(), F.col("o_orderkey")]
    return numbered(t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice"), order).select("o_orderkey", "place")


@plan("select o_custkey, place, o_orderstatus from (select *, row_number() over (order by o_orderstatus, o_custkey) as place from orders)")
def o1_places_of_ties(t: Tables) -> DataFrame:
    """A first key of three values, and rows that the order can't tell apart: they have places next to each other."""
    return numbered(t.orders.select("o_orderstatus", "o_custkey"), [F.col("o_orderstatus"), F.col("o_custkey")])


@plan("select p_partkey, row_number() over (partition by p_brand order by k, n nulls first, s nulls first, p_partkey) as place from (select *, case when p_size % 3 = 0 then 0 when p_size % 3 = 1 then 1 else 2 end as k, case when p_size % 3 = 1 then p_size end as n, case when p_size % 3 = 2 then p_name end as s from part)")
def o2_nulls_first_mixed(t: Tables) -> DataFrame:
    d = t.part.withColumn("n", F.when(F.col("p_size") % 3 == 1, F.col("p_size"))).withColumn("s", F.when(F.col("p_size") % 3 == 2, F.col("p_name")))
    kind = F.when(F.col("n").isNotNull(), 1).when(F.col("s").isNotNull(), 2).otherwise(0)
    order = [kind, F.col("n").asc_nulls_first(), F.col("s").asc_nulls_first(), F.col("p_partkey")]
    return numbered(d.select("p_partkey", "p_brand", "n", "s"), order, ["p_brand"]).select("p_partkey", "place")


@plan("select o_custkey, count(*) filter (p > o_totalprice) as inversions from (select o_custkey, o_totalprice, lag(o_totalprice) over (partition by o_custkey order by o_orderkey) as p from orders) group by 1")
def o3_sort_check(t: Tables) -> DataFrame:
    p = F.lag("o_totalprice").over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    return t.orders.withColumn("p", p).groupBy("o_custkey").agg(F.count_if(F.col("p") > F.col("o_totalprice")).alias("inversions"))


@plan("select doc_id from documents order by md5(doc_id::varchar), doc_id limit 500")
def o4_deterministic_sample(t: Tables) -> DataFrame:
    """A sampling operator: 500 rows by the order of a hash."""
    return t.documents.select("doc_id").orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(500)


@plan("select p_brand, p_partkey from (select p_brand, p_partkey, row_number() over (partition by p_brand order by p_name, p_partkey) as rn from part) where rn <= 5 or rn % 10 = 0")
def o5_quota_sample(t: Tables) -> DataFrame:
    d = t.part.withColumn("rn", F.row_number().over(Window.partitionBy("p_brand").orderBy("p_name", "p_partkey")))
    return d.filter("rn <= 5 or rn % 10 = 0").select("p_brand", "p_partkey")


@plan("select p_brand, p_partkey, rank::int as rank from (select p_brand, p_partkey, row_number() over (partition by p_brand order by p_retailprice desc, p_partkey) as rank from part) where rank <= 10")
def w2_top10_by_price(t: Tables) -> DataFrame:
    return top_k(t.part.select("p_brand", "p_partkey", "p_retailprice"), ["p_brand"], [F.col("p_retailprice").desc(), F.col("p_partkey")], 10, "rank").select("p_brand", "p_partkey", "rank")


@plan(
    """with r as (select case o_orderkey % 4 when 0 then 'customer' when 1 then 'scene' when 2 then 'name' else 'ghost' end as kind, case when o_orderkey % 4 = 2 then (o_custkey % 2 = 0) else (o_custkey % 5 > 0) end as there from orders where o_orderkey % 9 > 0)
    select 'closure' as check_id, 'orders:' || kind as dataset, case when n = 0 then 'PASS' else 'FAIL' end as status, 0::bigint as expected, n as measured from (select kind, case when kind = 'scene' then 0 when kind = 'ghost' then count(*) else count(*) filter (not there) end as n from r group by 1)"""
)
def q7_closure(t: Tables) -> DataFrame:
    """References of four kinds: to a table, to one that is special, by names in other spellings, and to a kind without targets."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    kind = F.when(k % 4 == 0, "customer").when(k % 4 == 1, "scene").when(k % 4 == 2, "name").otherwise("ghost")
    refs = t.orders.select(kind.alias("kind"), F.when(k % 9 > 0, F.when(k % 4 == 2, F.concat(F.lit("Name-"), c.cast("string"))).otherwise(c.cast("string"))).alias("ref"))
    ids = t.orders.select("o_custkey").distinct()
    targets = ids.filter("o_custkey % 5 > 0").select(F.lit("customer").alias("kind"), F.col("o_custkey").cast("string").alias("id")).unionByName(ids.filter("o_custkey % 2 = 0").select(F.lit("name").alias("kind"), F.concat(F.lit("name_"), F.col("o_custkey").cast("string")).alias("id")))
    return Q.closure(refs, "kind", "ref", targets, "orders", ("scene",), ("name",))


@plan(
    """with m as (select s as metric, n::double as v from (select o_orderstatus as s, count(*) as n from orders group by 1))
    select metric || '.rows' as left_metric, metric || x.side as right_metric, case x.side when '.dozens' then v / 4 when '.rows' then v when '.none' then null else null end as expected, case x.side when '.dozens' then v / 4 + (metric = 'F')::int when '.rows' then v when '.none' then null else v end as right_value,
    case x.side when '.dozens' then case when metric = 'F' then 'differs' else 'same' end when '.rows' then 'same' when '.none' then 'missing' else 'unregistered' end as verdict from m, (values ('.dozens'), ('.rows'), ('.none'), ('.bytes')) x(side)"""
)
def q16_unit_comparisons(t: Tables) -> DataFrame:
    by = t.orders.groupBy("o_orderstatus").agg(F.count("*").cast("double").alias("v"))
    each = lambda name, unit, v: by.select(F.concat("o_orderstatus", F.lit(f".{name}")).alias("metric"), F.lit(unit).alias("unit"), v.alias("value"))
    m = each("rows", "rows", F.col("v")).unionByName(each("dozens", "fours", F.col("v") / 4 + (F.col("o_orderstatus") == "F").cast("int"))).unionByName(each("bytes", "bytes", F.col("v")))
    sides = F.explode(F.array(*map(F.lit, (".dozens", ".rows", ".none", ".bytes"))))
    pairs = by.select("o_orderstatus", sides.alias("side")).select(F.concat("o_orderstatus", F.lit(".rows")).alias("left_metric"), F.concat("o_orderstatus", "side").alias("right_metric"))
    transforms = by.limit(1).select(F.lit("rows").alias("source"), F.lit("fours").alias("target"), F.lit(0.25).alias("factor"))
    return Q.unit_comparisons(pairs, m, transforms)


@plan("with a as (select p_brand, p_partkey, p_name, row_number() over (partition by p_brand order by p_name, p_partkey) as rn from part), r as (select *, row_number() over (order by p_name, p_partkey) as place from a where rn > 3) select p_brand, p_partkey from a where rn <= 3 union all select p_brand, p_partkey from r where place % 7 = 1")
def o5_stride_over_the_rest(t: Tables) -> DataFrame:
    return quota_sample(t.part.select("p_brand", "p_name", "p_partkey"), "p_brand", ["p_name", "p_partkey"], 3, 7).select("p_brand", "p_partkey")
