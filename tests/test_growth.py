"""Work that grows with the rows is dealt over the cores, and isn't done twice."""

import pytest
from pyspark.sql import functions as F

from weavegraph.operators import audit, resolve, walk
from weavegraph.plans import walk_plans
from weavegraph.plans.registry import Tables, over_cores


def test_scenarios_of_one_file_are_many_tasks(spark, sf_dir):
    assert walk_plans.scenario_payloads(Tables(spark, sf_dir)).rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism


def test_over_cores_keeps_every_row(spark):
    assert sorted(r.id for r in over_cores(spark.range(50).union(spark.range(50))).collect()) == sorted([*range(50), *range(50)])


def test_formulas_of_one_shape_are_parsed_once():
    audit._shape.cache_clear()
    got = [audit._nodes(f"{{s{i}#a}} * 2 - {{s{i}#b[{i}]}}") for i in range(50)]
    assert audit._shape.cache_info().misses == 1
    assert got[7] == [(0, None, 0, 0, "-", None, None, None), (1, 0, 1, 1, "cited", None, "s7", "b[7]"), (2, 0, 0, 1, "*", None, None, None), (3, 2, 1, 2, "number", 2.0, None, None), (4, 2, 0, 2, "cited", None, "s7", "a")]
    for bad in ("cited__0", "{s#a} + cited__1", "f(1)", "1 +", "True"):
        for _ in range(2):
            with pytest.raises(ValueError):
                audit._nodes(bad)


@pytest.mark.parametrize("under", ["main.Status", "main", "list[1]", "deep.a.b.c.d.e.f.g", "scalar.more"])
def test_leaves_under_a_path(spark, under):
    body = '{"main": {"Status": "F", "StatusToo": [1, {"x": null}], "Other": 2}, "list": [1, {"y": 2}, [3]], "deep": {"a": {"b": {"c": {"d": {"e": {"f": {"g": {"h": 1}}}}}}}}, "scalar": 5}'
    df = spark.createDataFrame([(1, body), (2, "7"), (3, None), (4, "broken")], "id int, payload string")
    key = lambda rows: sorted(map(str, rows))
    every = walk.leaves(df, "payload", ["id"])
    assert key(walk.leaves(df, "payload", ["id"], under=under).collect()) == key(every.filter(F.col("path").startswith(under)).collect())


@pytest.mark.parametrize("name", ["n14_level_headers", "n14_nested_records"])
def test_records_are_not_made_once_more_below_the_shuffle(spark, sf_dir, name):
    plan = walk_plans.plan.queries[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Repartition") :]
    assert "variant" not in below and "json" not in below.lower()


def test_inherited_names_meet_in_one_grouping(spark):
    pools = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (2, "a"), (2, "b"), (2, None), (3, "c"), (None, "d")], "k int, n string")
    twins = spark.createDataFrame([(1, 2), (1, 3), (2, 1), (3, 9), (4, None), (5, 1), (5, 1)], "k int, t int")
    more = resolve.inherit_pool(pools, twins, "k", "n", "t")
    assert sorted(map(tuple, more.collect()), key=str) == sorted([(1, "b"), (1, None), (1, "c"), (2, None), (5, "a"), (5, None)], key=str)
    assert "LeftAnti" not in more._jdf.queryExecution().optimizedPlan().toString()
