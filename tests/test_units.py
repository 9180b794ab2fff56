"""Operators on small rows: nulls, ties, twins, empty tables, broken rows."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from weavegraph.functions import text as X
from weavegraph.operators import audit, drift, graph, identity, order, project, quality, resolve, rules, spatial, walk
from weavegraph.sources import json_elements


def values(spark, column, rows, ddl="v string"):
    return [r[0] for r in spark.createDataFrame([(r,) for r in rows], ddl).select(column).collect()]


@pytest.mark.parametrize(
    ("column", "given", "wanted"),  # the column is made once there is a session
    [
        (X.normalize_ref, ["a/b\\C.bundle", "{hash}.bundle", "{RSC}Name?x=1", "{}", None], ["c", "hash", "name", "", None]),
        (X.strip_hash_suffix, ["x_" + "a" * 32, "x_" + "a" * 31, "_" + "a" * 32], ["x", None, None]),
        (X.clean_text, ['<style="a"></style>{Kit}', " {a<b>}c ", "<a {x}>t"], ["", "c", "t"]),
        (X.id_tokens, ["Ab-12-x-ab_Cd", "", "7"], [["ab", "cd"], [], []]),
        (X.norm_name, ["  A b-C  ", "x--y"], ["a_b_c", "x_y"]),
        (X.is_cjk, ["漢", "한", "Straße", ""], [True, True, False, False]),
        (X.sanitize_component, ["a<b>. .", "...", "ok"], ["a_b_", "_unnamed", "ok"]),
        (X.address_basename, ["x/y.tar.gz", ".x", "a\\b"], ["y.tar", None, "b"]),
    ],
)
def test_text_functions(spark, column, given, wanted):
    assert values(spark, column("v"), given) == wanted


def test_parse_stem_and_forms(spark):
    assert [tuple(r) if r else None for r in values(spark, X.parse_stem("v"), ["a_1_-5.json", "a_7", "a.json"])] == [("a_1", -5), ("a", 7), None]
    got = values(spark, X.candidate_forms("v", ["Course_"], "_Long"), ["Course_Arts_Long", "x"])
    assert [[tuple(f) for f in g] for g in got] == [[("Arts", "family"), ("Art", "plural-fold")], [("x", "family"), ("xs", "plural-fold")]]
    assert values(spark, X.token_rewrite("v", [("Art", "Craft"), ("a.t", "Q")]), ["Art", "myARTs", "none"]) == [["Craft"], ["myCrafts"], []]


def test_numbers(spark):
    df = spark.createDataFrame([(1, 3), (1, 2), (5, 0), (1, 8)], "n int, d int")
    assert [r[0] for r in df.select(X.percent("n", "d")).collect()] == ["33.33%", "50.00%", "0.00%", "12.50%"]
    z = spark.createDataFrame([(0.0, -0.0), (math.nan, math.nan), (1.0, 1.0), (None, None)], "a double, b double")
    assert [r[0] for r in z.select(X.numbers_equal("a", "b")).collect()] == [False, True, True, True]
    assert values(spark, spatial.round_half_away("v"), [0.5, -0.5, 1.49, -2.5], "v double") == [1, -1, 1, -3]


def test_ladder_keeps_every_miss(spark):
    refs = spark.createDataFrame([(1, 10), (2, 20), (3, None), (4, 40)], "id int, a int")
    first = spark.createDataFrame([(10, 100), (20, 200)], "a int, b int")
    second = spark.createDataFrame([(100, "x")], "b int, c string")
    got = {r.id: (r.status, r.c) for r in resolve.resolve_ladder(refs, [("no a", first, ["a"]), ("no b", second, ["b"])]).collect()}
    assert got == {1: ("resolved", "x"), 2: ("no b", None), 3: ("no a", None), 4: ("no a", None)}
    two = spark.createDataFrame([(1, "p"), (1, "q"), (2, "r")], "k int, t string")
    strict = {r.k: (r.t, r.status) for r in resolve.strict_lookup(spark.createDataFrame([(1,), (2,), (3,)], "k int"), two, ["k"], "t").collect()}
    assert strict == {1: (None, "ambiguous"), 2: ("r", "resolved"), 3: (None, "missing")}


def test_twins_and_names(spark):
    rows = [("k", "a", "h2", "x"), ("k", "a", "h1", "x"), ("k", "a", "h1", "y"), ("k", "b", "h9", "x")]
    got = {(r.id, r.h): (r.original_id, r.axes) for r in resolve.twin_disambiguate(spark.createDataFrame(rows, "kind string, id string, h string, axis string"), ["kind"], "id", "h", "axis").collect()}
    assert got == {("a", "h1"): (None, ["x", "y"]), ("a@h2", "h2"): ("a", None), ("b", "h9"): (None, None)}
    d = spark.createDataFrame([("s", 1, 7), ("s", 1, 8), ("s", 2, 9), ("t", 1, 5)], "key string, o int, p int")
    assert {r.p: r.unique_key for r in resolve.demote_collisions(d, "key", "o", "p").collect()} == {7: "s@p7", 8: "s@p8", 9: "s@r2", 5: "t"}
    assert {r.p: r.file_name for r in resolve.assign_unique_name(d, "key", "p").collect()} == {7: "s", 8: "s_8", 9: "s_9", 5: "t"}
    assert {r.p: (r["mode"], r.deviates) for r in resolve.modal_value(d, "key", "o").collect()} == {7: (1, False), 8: (1, False), 9: (1, True), 5: (1, False)}


def test_results_hold_under_any_partitioning(spark):
    d = spark.range(500).select((F.col("id") % 7).alias("k"), (F.col("id") % 11).alias("v"), "id")
    runs = [sorted(map(tuple, graph.edge_dedup(d.repartition(n), ["k"], ["v", "id"]).collect())) for n in (1, 3, 16)]
    assert runs[0] == runs[1] == runs[2]
    runs = [sorted(map(tuple, resolve.top_k(d.repartition(n), ["k"], [F.col("v").desc(), F.col("id")], 2).collect())) for n in (1, 5)]
    assert runs[0] == runs[1] and len(runs[0]) == 14
    assert resolve.top_k(d.limit(0), ["k"], [F.col("v")], 3).count() == 0


def test_walker(spark):
    text = '{"a":[{"m_FileID":1,"m_PathID":-5},{"m_FileID":0,"m_PathID":0},{"m_FileID":1,"m_PathID":2,"x":1}],"t":{"_termID":0,"_dev":""},"big":{"deep":{"er":1}},"s":null}'
    df = spark.createDataFrame([(1, text), (2, "not json"), (3, None), (4, "[]")], "id int, p string")
    leaves = walk.leaves(df, "p", ["id"], blocked=("big",)).collect()
    assert {(r.path, r.kind, r.text) for r in leaves} >= {("a[0].m_PathID", "BIGINT", "-5"), ("t._termID", "BIGINT", "0"), ("s", "VOID", None)} and not any("big" in r.path for r in leaves)
    assert [(r.path, r.key, r.pos, r.file_id, r.path_id) for r in walk.pointers(df, "p", ["id"]).collect()] == [("a[0]", "a", 0, 1, -5)]
    assert len(walk.pointers(df, "p", ["id"], null_slots=True).collect()) == 2
    assert [(r.path, r.term_id, r.dev) for r in walk.localised(df, "p", ["id"]).collect()] == [("t", 0, "")]
    assert [r.capable for r in walk.text_key_census(df, "p").collect()] == [0]
    assert {r[0] for r in spark.createDataFrame([(".a[0].b[12]",)], "p string").select(walk.normalize_field_path("p")).collect()} == {"a[].b[]"}


def test_pointers_of_any_depth(spark):
    """Repeats stay, signed ids pass, script and object leaves and null targets don't, and no pointer is opened."""
    deep = '{"x":[' * 40 + '{"Leaf":{"m_FileID":0,"m_PathID":3001}}' + "]}" * 40
    text = (
        '{"Items":[{"DefaultItem":{"m_FileID":0,"m_PathID":3001}},{"DefaultItem":{"m_FileID":0,"m_PathID":3001}}],"m_Script":{"m_FileID":1,"m_PathID":-9000000000000000001},'
        '"m_GameObject":{"m_FileID":0,"m_PathID":5},"DeadRef":{"m_FileID":3,"m_PathID":7999},"Null":{"m_FileID":0,"m_PathID":0},"Refs":[{"m_FileID":2,"m_PathID":-7001}],'
        '"True":{"m_FileID":true,"m_PathID":1},"Text":{"m_FileID":"1","m_PathID":1},"Large":{"m_FileID":1,"m_PathID":9223372036854775808}}'
    )
    df = spark.createDataFrame([(1, text), (2, deep)], "id int, p string")
    got = sorted((r.id, r.key, r.file_id, r.path_id) for r in walk.pointers(df, "p", ["id"]).collect())
    assert got == [(1, "DeadRef", 3, 7999), (1, "DefaultItem", 0, 3001), (1, "DefaultItem", 0, 3001), (1, "Refs", 2, -7001), (2, "Leaf", 0, 3001)]
    slots = walk.pointers(df, "p", ["id"], null_slots=True)
    assert slots.count() == 8 and walk.pointers(df.limit(0), "p", ["id"]).count() == 0
    variant = df.select("id", F.parse_json("p").alias("p"))
    assert walk.pointers(variant, "p", ["id"]).count() == 5


def test_payloads_too_deep_are_broken_not_fatal(spark):
    """Hundreds of levels are walked; beyond what Spark parses a payload has no nodes, is counted, and ends no job."""
    nest = lambda n: '{"a":[' * n + '{"Leaf":{"m_FileID":0,"m_PathID":3001}}' + "]}" * n
    df = spark.createDataFrame([(1, nest(60)), (2, nest(50_000)), (3, nest(1)), (4, "{"), (5, None)], "id int, p string")
    assert sorted((r.id, r.path.count("a[0]")) for r in walk.pointers(df, "p", ["id"]).collect()) == [(1, 60), (3, 1)]
    assert tuple(walk.broken_payloads(df, "p").first()) == (5, 1, 2)


def test_walk_has_no_python(spark):
    df = spark.createDataFrame([(1, '{"a":{"m_FileID":1,"m_PathID":2}}')], "id int, p string")
    for found in (walk.pointers(df, "p", ["id"]), walk.leaves(df, "p", ["id"]), walk.guid_refs(df, "p", ["id"]), walk.localised(df, "p", ["id"])):
        assert "InArrow" not in found._jdf.queryExecution().toString() and "Python" not in found._jdf.queryExecution().toString()


def test_bare_and_named_guids(spark):
    g = "0123456789abcdef" * 2
    text = f'{{"myGuid":"{g}","list":{{"guids":["{g}"]}},"icon":{{"m_AssetGUID":"{g}","m_SubObjectName":"x"}},"no":{{"m_AssetGUID":"zz","inner":{{"GUID":"{g}"}}}},"guidNumber":12345678901234567890123456789012}}'
    df = spark.createDataFrame([(1, text)], "id int, p string")
    assert sorted((r.path, r.form, r.sub_name) for r in walk.guid_refs(df, "p", ["id"]).collect()) == [("icon", "dict", "x"), ("myGuid", "bare", ""), ("no.inner.GUID", "bare", "")]
    assert [r.path for r in walk.guid_refs(df, "p", ["id"], bare=False).collect()] == ["icon"]


def test_list_carriers_open_what_they_find(spark):
    df = spark.createDataFrame([(1, '{"x":[{"id":10,"y":[{"id":11}]},{"id":"10"}],"z":[{"id":11}]}')], "id int, p string")
    assert sorted((r.block, r.carriers) for r in walk.list_carriers(df, "p", ["id"]).collect()) == [("a", "x"), ("b", "x[0].y,z")]


def test_snapshot_diff_counts_nulls_and_joins_open_buckets(spark):
    schema = "k int, a string, b string"
    old = spark.createDataFrame([(1, "a", None), (2, "x", "y"), (3, None, None), (None, "n", "n")], schema)
    new = spark.createDataFrame([(1, None, "a"), (2, "x", "y"), (4, "z", None), (None, "n", "m")], schema)
    got = {(r.k, r.change): r.fields for r in drift.snapshot_diff(old, new, ["k"]).collect()}
    assert got.keys() == {(1, "changed"), (3, "removed"), (4, "added"), (None, "changed")}
    assert [tuple(f) for f in got[1, "changed"]] == [("a", "a", None), ("b", None, "a")] and [tuple(f) for f in got[None, "changed"]] == [("b", "n", "m")]
    assert drift.snapshot_diff(old, old, ["k"]).count() == 0 and drift.snapshot_diff(old.limit(0), new, ["k"]).count() == 4
    more = new.withColumn("c", F.lit(1))
    assert {tuple(f) for r in drift.snapshot_diff(new, more, ["k"]).collect() for f in r.fields} == {("c", None, "1")}


def test_names_are_unique(spark):
    df = spark.createDataFrame([("a", 1), ("a", 5), ("a_5", 2), (None, 3)], "stem string, n int")
    got = {(r.stem, r.n): r.file_name for r in resolve.assign_unique_name(df, "stem", "n").collect()}
    assert got == {("a", 1): "a", ("a", 5): "a_5", ("a_5", 2): "a_5_2", (None, 3): None}

    def one_by_one(rows):
        used, out = set(), {}
        for at, stem, n in sorted(rows):
            tries = [stem, f"{stem}_{n}"]
            i = 2
            while (name := tries.pop(0)) in used:
                if not tries:
                    tries.append(f"{stem}_{n}_{i}")
                    i += 1
            used.add(name)
            out[at] = name
        return out

    rng = random.Random(3)
    rows = [(i, "_".join(["a", *[str(rng.randint(1, 3)) for _ in range(rng.randint(0, 3))]]), rng.randint(1, 3)) for i in range(60)]
    got = resolve.assign_unique_name(spark.createDataFrame(rows, "at int, stem string, n int"), "stem", "n", ["at"]).collect()
    assert {r["at"]: r.file_name for r in got} == one_by_one(rows)


def test_demoted_keys_are_unique(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 11), ("a@r1", 5, 12), ("b", 3, 13), ("b", 3, 14), ("b@p13", 1, 15), (None, 1, 16)], "k string, r int, p int")
    got = {r.p: r.unique_key for r in resolve.demote_collisions(df, "k", "r", "p").collect()}
    assert got == {10: "a@r1", 11: "a@r2", 12: "a@r1@p12", 13: "b@p13", 14: "b@p14", 15: "b@p13@p15", 16: None}


def test_points_in_boxes_of_all_sizes(spark):
    rng = random.Random(4)
    points = [(i, i % 2, rng.uniform(-5, 5), rng.choice([None, rng.uniform(-5, 5), 1e300])) for i in range(300)]
    boxes = [(i, i % 2, rng.uniform(-5, 5), rng.uniform(-5, 5), rng.choice([0.0, 0.1, 0.5, 20.0, float("inf"), -1.0]), rng.choice([0.1, 3.0, 1e9])) for i in range(60)] + [(99, 0, None, 1.0, 1.0, 1.0)]
    p = spark.createDataFrame(points * 2, "id int, k int, x double, y double")
    b = spark.createDataFrame(boxes, "box int, k int, c_x double, c_y double, e_x double, e_y double")
    want = {}
    for i, k, x, y in points:
        hits = [j for j, l, cx, cy, ex, ey in boxes if k == l and y is not None and cx is not None and abs(x - cx) <= ex and abs(y - cy) <= ey]
        if hits:
            want[i] = min(hits)
    got = resolve.in_bounds(p, b, ["k"], ["x", "y"], "box").collect()
    assert sorted((r.id, r.box) for r in got) == sorted([*want.items()] * 2)
    assert resolve.in_bounds(p, b.limit(0), ["k"], ["x", "y"]).count() == 0 and resolve.in_bounds(p.limit(0), b, ["k"], ["x"]).count() == 0


def test_points_stay_in_their_cells(spark):
    """A hundred thousand boxes and points of one key: no point meets boxes far from it."""
    n = 100_000
    p = spark.range(n).select(F.lit(1).alias("k"), (F.col("id") * 7919 % n).cast("double").alias("x"))
    b = spark.range(n).select(F.lit(1).alias("k"), F.col("id").alias("box"), F.col("id").cast("double").alias("c_x"), F.lit(0.6).alias("e_x"))
    got = resolve.in_bounds(p, b, ["k"], ["x"], "box")
    assert got.count() == n and got.filter(F.col("box") != F.col("x")).count() == 0


def test_places_by_ranges(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), (F.col("id") * 37 % 11).alias("v"), F.when(F.col("id") % 5 > 0, F.col("id")).alias("n"))
    got = order.numbered(df, [F.col("v").desc(), F.col("n").asc_nulls_first()]).orderBy("place").collect()
    assert [r.place for r in got] == list(range(1, 1001)) and [(-r.v, r.n is not None, r.n or 0) for r in got] == sorted((-r.v, r.n is not None, r.n or 0) for r in got)
    got = order.numbered(df.unionByName(df.limit(7).withColumn("g", F.lit(None).cast("bigint"))), [F.col("n").desc_nulls_last()], ["g"]).collect()
    for g in (0, 1, 2, None):
        assert sorted(r.place for r in got if r.g == g) == list(range(1, 1 + sum(r.g == g for r in got)))
    assert order.numbered(df.limit(0), [F.col("v")]).count() == 0


def test_bridge_suppresses_later_scenes(spark):
    """Of one reference: a scene before the first entity is an edge, one at or after it isn't; own bundles come before any."""
    refs = spark.createDataFrame([("r1", "g1"), ("r2", "g2"), ("r3", "g3"), ("r4", "g4"), ("r5", "g1")], "ref string, guid string")
    entries = spark.createDataFrame([("g1", "a", None), ("g1", "b", "x"), ("g1", "c", None), ("g2", "b", "y"), ("g2", "b", "x"), ("g3", "zzz", "x")], "guid string, address string, bundle string")
    containers = spark.createDataFrame([("s", "a", 1), ("x", "b", 9), ("x", "b", 2), ("y", "b", 3), ("s", "c", 4), ("w", "b", 5)], "bundle string, address string, path_id bigint")
    entities = spark.createDataFrame([("x", 2, "k", "E2"), ("w", 5, "k", "E5")], "bundle string, path_id bigint, kind string, id string")
    got = resolve.guid_bridge(refs, entries, containers, entities, spark.createDataFrame([("s",), ("y",)], "bundle string"))
    assert {(r.ref, r.address, r.landing, r.bundle, r.path_id, r.id) for r in got.collect()} == {
        *((r, a, *rest) for r in ("r1", "r5") for a, *rest in (("a", "scene", "s", 1, None), ("b", "entity", "x", 2, "E2"))),
        ("r2", "b", "entity", "x", 2, "E2"),
        ("r3", None, "none", None, None, None),
        ("r4", None, "dangling", None, None, None),
    }
    assert tuple(resolve.bridge_report(got, ["ref"]).first()) == (5, 4, 4, 3, 1, 2)


def test_contract_suite_is_one_scan(spark, sf_dir):
    from weavegraph.plans import catalog

    plan = catalog.QUERIES["q_contract_suite"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") + plan.count("Scan parquet") - plan.count("FileScan parquet") == 1


def test_formulas(spark):
    rows = [("o", "a", "{s#x} * 2 - -(3 + {s#y[0]}) / 4"), ("o", "b", "{s#x} / ({s#x} - 4)"), ("o", "c", "{s#gone} + 1"), ("o", "d", "__import__('os')"), ("o", "e", "1 +"), ("o", "f", "(" * 3000 + "1" + ")" * 3000), ("o", "g", "7"), ("o", "h", None)]
    values = spark.createDataFrame([("s", "x", 4.0), ("s", "y[0]", 1.0)], "source string, path string, value double")
    got = {r.path: r.result for r in audit.evaluate(audit.expressions(spark.createDataFrame(rows, "artifact string, path string, formula string")), values).collect()}
    assert got == {"a": 9.0, "b": None, "c": None, "d": None, "e": None, "f": None, "g": 7.0, "h": None}


def test_elements_of_one_document(spark, tmp_path):
    doc = {"first": {"keys": [1, [2]]}, "keys": [{"a": 'x"]},{[\\', "n": i, "deep": [[i, {"b": "],"}], []]} for i in range(400)] + [None, "text, text", 5, []], "tail": "keys"}
    for name, text in (("plain", json.dumps(doc)), ("wide", json.dumps(doc, indent=3, ensure_ascii=False))):
        path = tmp_path / name
        path.write_text(text, encoding="utf-8")
        for size in (997, 1 << 20):
            got = json_elements.scan_json_elements(spark, str(path), "keys", size)
            assert [json.loads(r.value) for r in got.collect()] == doc["keys"]
        assert json_elements.scan_json_elements(spark, str(path), "absent").count() == json_elements.scan_json_elements(spark, str(path), "tail").count() == 0
    (tmp_path / "empty").write_text('{"keys": []}')
    assert json_elements.scan_json_elements(spark, str(tmp_path / "empty"), "keys").count() == 0


def test_closed_vocabulary(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "v string")
    assert [r[0] for r in df.select(project.closed_label("v", {"a": "A", "b": "B"})).collect()] == ["A", None, "B"]
    with pytest.raises(Exception, match="outside its vocabulary: b"):
        df.select(project.closed_label("v", {"a": "A"})).collect()


def test_hit_lists(spark):
    df = spark.createDataFrame([(1, "red"), (2, None), (3, "RED blue")], "id int, v string")
    tests = {"r": F.col("v").contains("red"), "b": F.col("v").contains("blue"), "any": F.lower("v").contains("red")}
    assert {r.id: r.hits for r in project.predicate_hits(df, tests, ["id"]).collect()} == {1: ["r", "any"], 2: [], 3: ["b", "any"]}


def test_strict_lookup_by_class(spark):
    targets = spark.createDataFrame([("one", 1, "x"), ("two", 2, "x"), ("two", 3, "y"), ("three", 4, "y"), ("three", 5, "y"), ("same", 6, "x"), ("same", 6, "y")], "k string, t int, c string")
    refs = spark.createDataFrame([("one", "y"), ("two", "y"), ("two", "z"), ("three", "y"), ("same", "x"), (None, "x"), ("gone", None)], "k string, w string")
    got = {(r.k, r.w): (r.status, r.t) for r in resolve.strict_lookup(refs, targets, ["k"], "t", "c", "w").collect()}
    assert got == {("one", "y"): ("resolved", 1), ("two", "y"): ("resolved", 3), ("two", "z"): ("ambiguous", None), ("three", "y"): ("ambiguous", None), ("same", "x"): ("resolved", 6), (None, "x"): ("missing", None), ("gone", None): ("missing", None)}


def test_shared_addresses(spark):
    df = spark.createDataFrame([("f", "a", 2), ("f", "a", 1), ("f", "b", 3), ("f", None, 4), ("f", None, 5), ("g", "a", 6)], "f string, a string, n int")
    assert {tuple(r) for r in graph.object_index(df, ["f"], ["n"], "a").collect()} == {("f", 5, 2, 1), ("g", 1, 0, 6)}
    assert graph.object_index(df.limit(0), ["f"], ["n"], "a").count() == 0


def test_quotas_and_stride(spark):
    df = spark.range(100).select((F.col("id") % 4).alias("s"), "id")
    got = {r.id for r in order.quota_sample(df, "s", ["id"], 2, 10).collect()}
    assert got == set(range(8)) | set(range(8, 100, 10))
    assert order.quota_sample(df.limit(0), "s", ["id"], 2, 10).count() == 0


def test_records_of_odd_payloads(spark):
    rows = [(1, '{"p":[{"q":[{"n":1},{"n":2}]},{"q":null},{"q":7},null,5]}'), (2, '{"p":{"q":[1]}}'), (3, None), (4, "broken"), (5, "[]")]
    df = spark.createDataFrame(rows, "id int, body string")
    tree = {"p": (None, "$.p"), "q": ("p", "$.q")}
    got = sorted((r.id, r.record_family, tuple(r.ordinals)) for r in walk.explode_records(df, "body", ["id"], tree).collect())
    assert got == [(1, "p", (i,)) for i in range(5)] + [(1, "q", (0, 0)), (1, "q", (0, 1))]
    heads = {r.id: r.counts for r in walk.level_headers(df, "body", ["id"], tree, {}).collect()}
    assert heads == {1: {"p": 5, "q": 2}, **{i: {"p": 0, "q": 0} for i in (2, 3, 4, 5)}}


def test_residue_of_pointers(spark):
    rows = ['{"Icon":{"m_FileID":1,"m_PathID":2},"IconReference":{"m_AssetGUID":"ab"}}', '{"Icon":{"m_FileID":1,"m_PathID":2},"IconReference":{"m_AssetGUID":" "}}', '{"bigICON":[{"m_FileID":0,"m_PathID":2}]}', '{"Icon":{"m_FileID":0,"m_PathID":0}}', '{"other":{"m_FileID":1,"m_PathID":2}}']
    df = spark.createDataFrame(list(enumerate(rows)), "id int, p string")
    assert sorted(r.id for r in walk.pointer_residue(df, "p", ["id"]).collect()) == [1, 2]
    assert tuple(walk.residue_counters(walk.pointers(df, "p", ["id"], null_slots=True)).first()) == (5, 1, 2, 1, 1)


def test_closest_candidates(spark):
    rng = random.Random(3)
    words = ["red", "blue", "ring", "bolt", "gear", "old", "new", "hot", "cold", "big"]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    names = sorted({(rng.choice("kl"), say(rng.randrange(1, 11))) for _ in range(60)})
    targets = sorted({(rng.choice("kl"), say(rng.randrange(1, 12))) for _ in range(80)})
    want = {}
    for kind, name in names:
        scored = sorted((-len(set(name.split()) & set(t.split())), len(t), t) for k, t in targets if k == kind and set(name.split()) & set(t.split()))
        want.update({(kind, name, i + 1): (t, -n) for i, (n, _, t) in enumerate(scored[:3])})
    for most in (2, 8):
        got = graph.closest_candidates(spark.createDataFrame(names, "kind string, name string"), spark.createDataFrame(targets, "kind string, target string"), "kind", "name", "target", most_tokens=most)
        assert {(r.kind, r.name, r["rank"]): (r.target, r.overlap) for r in got.collect()} == want


def test_repeats_with_nulls_and_manifests(spark):
    rows = spark.createDataFrame([("k", "a", None), ("k", None, "a")], "k string, x string, y string")
    assert one(quality.identical_repeats(rows, ["k"], "d")) == ("FAIL", 1)
    from weavegraph.sources import io

    of = lambda *v: io.content_manifest(spark.createDataFrame([("g", x) for x in v], "g string, x string"), ["g"]).first().content
    assert of("x", "x") != of("y", "y") and of("x", "y") == of("y", "x") and of("x") != of("x", "x")


def test_ladder_with_repeated_lookup_keys(spark):
    refs, table = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1, "b"), (1, "a")], "k int, v string")
    assert sorted((r.k, r.v, r.status) for r in resolve.resolve_ladder(refs, [("miss", table, ["k"])]).collect()) == [(1, "a", "resolved"), (2, None, "miss")]
    assert sorted((r.k, r.v, r.route) for r in resolve.coalesce_lookups(refs, [("t", table)], ["k"], "v").collect()) == [(1, "a", "t"), (2, None, "none")]


def test_census_with_a_gap(spark):
    make = lambda rows, ddl="c string, n int": spark.createDataFrame(rows, ddl)
    census, errors, manifest, catalogue = make([("e", 2), ("m", 3), ("x", 4)]), make([("e", 1)]), [("e",)], [("m",)] * 3
    run = lambda m, c: {r.dataset: r.status for r in quality.census_reconcile(census, errors, make(m, "c string"), make(c, "c string"), "c", ["e"], ["m"]).collect()}
    assert run(manifest, catalogue) == {"objects": "PASS", "m": "PASS"}
    assert run([], catalogue) == {"objects": "FAIL", "m": "PASS"} and run(manifest, catalogue[:2]) == {"objects": "FAIL", "m": "FAIL"}


def test_canonical_payload(spark):
    df = spark.createDataFrame([('{"b":1,"a":{"z":1,"y":[2,1]},"_x":3}',), ('{"a":{"y":[2,1],"z":1},"b":1}',), ("nope",), (None,)], "p string")
    got = [r.payload_hash for r in identity.payload_hash(df, "p").collect()]
    assert got[0] == got[1] and got[2] is None and got[3] is None


def test_ancestry_with_cycles(spark):
    types = spark.createDataFrame([("root", None), ("a", "root"), ("b", "a"), ("c", "outside"), ("x", "y"), ("y", "x"), ("self", "self")], "name string, base string")
    assert {r.name: r.verdict for r in rules.definition_gate(types, "root", 4).collect()} == {"root": "definition", "a": "definition", "b": "definition", "c": "component", "x": "unknown", "y": "unknown", "self": "unknown"}


def one(df):
    r = df.collect()
    assert len(r) == 1
    return r[0].status, r[0].measured


def test_checks_bite(spark):
    """A broken row more is one finding more."""
    good = spark.createDataFrame([(1, '{"a":1}', "x"), (2, '{"a":2}', "y")], "id int, raw string, kind string")
    bad = good.union(spark.createDataFrame([(2, '{"b":2}', None)], good.schema))
    ids = spark.createDataFrame([(1,), (2,)], "k int")
    checks = {
        "keys": lambda d: quality.key_set(d, "raw", ["a"], "d"),
        "keys by": lambda d: quality.key_set_by(d, "raw", "kind", {"x": ["a"], "y": ["a"]}, "d"),
        "grammar": lambda d: quality.grammar(d, "kind", "^[xy]$", "d"),
        "unique": lambda d: quality.unique(d, ["id"], "d"),
        "same": lambda d: quality.same_rows(d, good, "d"),
        "implication": lambda d: quality.implication(d, F.col("id") > 0, F.col("kind").isNotNull(), "d"),
        "equivalence": lambda d: quality.equivalence(d, F.col("id") > 0, F.col("kind").isNotNull(), "d"),
        "derived": lambda d: quality.derived(d, "kind", F.coalesce("kind", F.lit("z")), "d"),
        "constant": lambda d: quality.constant(d.withColumn("c", F.coalesce("kind", F.lit("q")) != "q"), "c", True, "d"),
        "verbatim": lambda d: quality.verbatim_ids(d.select("raw", "id"), good.select("raw", "id"), ["raw"], "id", "d"),
    }
    for name, check in checks.items():
        assert one(check(good)) == ("PASS", 0), name
        assert one(check(bad)) == ("FAIL", 1), name
    assert one(quality.foreign_key(good, "id", ids, "k", "d")) == ("PASS", 0)
    assert one(quality.foreign_key(good, "id", ids.filter("k = 1"), "k", "d")) == ("FAIL", 1)
    assert one(quality.domain(good, "kind", ["x"], "d", ("y",))) == ("PASS", 0) and one(quality.domain(good, "kind", ["x"], "d")) == ("FAIL", 1)


def test_regression_states(spark):
    make = lambda rows: spark.createDataFrame(rows, "metric string, value double, snapshot_id int")
    now = make([("new", 1.0, 1), ("same", 1.0, 1), ("worse", 2.0, 1), ("better", 1.0, 1), ("other", 1.0, 2), ("exact", 3.0, 1)])
    before = make([("same", 1.0, 1), ("worse", 1.0, 1), ("better", 2.0, 1), ("other", 9.0, 1), ("exact", 2.0, 1)])
    ways = spark.createDataFrame([("worse", "lower"), ("better", "lower"), ("exact", "exact")], "metric string, direction string")
    assert {r.metric: r.verdict for r in drift.regression(now, before, ways).collect()} == {"new": "first-run", "same": "ok", "worse": "regression", "better": "improved", "other": "drift", "exact": "regression"}
    old, new = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert {r.k: r.change for r in drift.snapshot_diff(old, new, ["k"]).collect()} == {1: "removed", 2: "changed", 3: "added"}


def test_bounds(spark):
    points = spark.createDataFrame([(1, 0.0), (1, 2.0), (2, 0.0), (1, None)], "k int, x double")
    boxes = spark.createDataFrame([(1, 0.0, 1.0), (1, 0.5, 1.0)], "k int, c_x double, e_x double")
    assert [tuple(r) for r in resolve.in_bounds(points, boxes, ["k"], ["x"]).collect()] == [(1, 0.0)]
