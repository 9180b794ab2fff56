import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from weavegraph.llm import catalog, negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, positives=5, wanted=5, share=80):
    best = {}
    for i, e, lab in rows:
        if i is not None and lab is not None and e and all(x is not None and np.isfinite(x) for x in e):
            got = (str(lab), [int(np.floor(256 * float(np.float32(x)))) for x in e])
            best[i] = min(best.get(i, got), got)
    out = set()
    for a, (lab, v) in best.items():
        if a % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other == lab) for i, (other, w) in best.items() if i != a and len(w) == len(v))
        for s, p, _ in [x for x in scored if x[2]][:positives]:
            fits = [(n, i) for n, i, same in scored if not same and -share * s <= -100 * n <= -100 * s][:wanted]
            out |= {(a, p, rank + 1, i, -s, -n) for rank, (n, i) in enumerate(fits)}
    return out


def mined(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    got = [tuple(r) for r in negatives.hard_negatives(df, is_anchor=F.col("vec_id") % 100 == 0, **options).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("length, size, block", [(6, 900, 100), (64, 1500, 400), (70, 400, 8192)])
def test_against_brute_force(spark, length, size, block):
    rng = np.random.default_rng(length)
    centres = rng.standard_normal((5, length))
    rows = [(i, (centres[i % 5] * 0.3 + rng.standard_normal(length) * 0.2).astype(np.float32).tolist(), int(rng.integers(0, 4))) for i in range(size)]
    assert mined(spark, rows, block_rows=block) == brute(rows)


def test_odd_rows_and_ties(spark):
    rng = np.random.default_rng(3)
    v = lambda: rng.integers(-2, 3, 3).astype(float).tolist()
    rows = [(i, v(), i % 2) for i in range(260)] + [(i, [1.0, 2.0, 1.0], 1) for i in range(260, 330)]  # many equal scores
    rows += [(None, v(), 1), (331, None, 1), (332, [], 0), (333, v(), None), (334, [1.0, None, 2.0], 1), (335, [1.0, float("nan"), 0.0], 1), (336, [float("inf"), 0.0, 0.0], 0)]
    rows += [(337, [0.0, 0.0, 0.0], 1), (338, [1.0, 1.0], 0), (400, [1.0, 1.0], 0), (401, [1.0, 0.5], 1), (402, [0.5, 1.0], 0), (5, v(), 1), (100, [0.0] * 3, 0)]
    assert mined(spark, rows, block_rows=64) == brute(rows)
    assert mined(spark, []) == set()
    assert mined(spark, [(1, [1.0], 1)]) == set()  # no anchor
    assert mined(spark, [(100, [1.0], 1), (1, [1.0], 1)]) == set()  # no other label


def test_clashing_and_extra_columns(spark):
    rows = [(i, [float(i % 7), 1.0], i % 3) for i in range(220)]
    df = spark.createDataFrame(rows, SCHEMA)
    odd = df.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), F.col("label").alias("block"), F.lit("x").alias("label"), F.lit(1).alias("part"), F.lit(2).alias("score"))
    got = negatives.hard_negatives(odd, is_anchor=F.col("id") % 100 == 0, vec_id="id", embedding="vector", label="block")
    assert {(r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in got.collect()} == brute(rows)


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.sql("create view embeddings as select * from '/root/testdata/sf0.01/embeddings.parquet'")
    want = con.sql(negatives.NEGATIVES_SQL)
    got = catalog.op12_hard_negatives(spark, "/root/testdata/sf0.01").select(*want.columns).collect()
    assert len(got) and sorted(map(tuple, got)) == sorted(want.fetchall())


def test_query_has_the_columns_of_its_sql(spark):
    con = duckdb.connect()
    con.sql("create view embeddings as select * from '/root/testdata/sf0.001/embeddings.parquet'")
    assert catalog.op12_hard_negatives(spark, "/root/testdata/sf0.001").columns == con.sql(negatives.NEGATIVES_SQL).columns


def test_intervals_hold_every_score():
    rng = np.random.default_rng(1)
    x, q = rng.integers(-300, 300, (500, 40)), rng.integers(-300, 300, 40)
    turns = negatives.rotations(40, 3)
    codes, asked = negatives.Codes(x, turns), negatives.Query(q, turns)
    exact, widths = x @ q, []

    def seen(low, high):
        assert ((low <= exact) & (exact <= high)).all()
        widths.append((high - low).mean())
        return np.ones(len(low), dtype=bool)

    negatives.interval_search(codes, asked, np.arange(500), seen)
    assert widths[0] > widths[1] > widths[2]


def test_codes_leave_few_rows():
    rng = np.random.default_rng(2)
    x = rng.integers(-60, 60, (20_000, 64))
    left = list(negatives.survivors(x, x[0], 5))
    assert left == sorted(left, reverse=True) and left[-1] < 1000 and left[-1] >= 5
