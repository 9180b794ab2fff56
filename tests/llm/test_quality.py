import numpy as np
import pytest
from pyspark.sql import functions as F

from weavegraph.llm import quality


@pytest.fixture(scope="module")
def tables(spark):
    return tuple(spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))


def test_held_out_grades(tables):
    docs, labels = tables
    rated = quality.graded(docs, quality.ratings(labels))
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = quality.fit(rated.filter(~held))
    got = quality.judge_quality(rated.filter(held), model, carry=["doc_id", "grade"], into="q").select("doc_id", F.col("grade").alias("truth"), "q.*").collect()
    truth, grade = np.array([r.truth for r in got]), np.array([r.grade for r in got])
    toxic, kept = np.array([r.p_toxic for r in got]), np.array([r.keep for r in got])
    assert (grade == truth).mean() > 0.92 and (toxic[truth == 2] > 0.5).mean() < 0.01
    assert kept[truth == 2].mean() > 0.97 and kept[truth == 0].mean() < 0.05 and kept[truth == 1].mean() < 0.15


def test_cumulative_link_recovers_order():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 6)) < 0.4
    score = x @ np.array([2.0, -2.0, 1.0, 0.0, 0.0, -1.0]) + rng.logistic(size=4000)
    grades = (score > -1).astype(int) + (score > 1)
    rows, columns = np.nonzero(x)
    w, cut = quality.cumulative_link(rows, columns, 6, grades)
    assert np.abs(w - [2, -2, 1, 0, 0, -1]).max() < 0.3 and abs(cut[0] + 1) < 0.3 and abs(cut[1] - 1) < 0.3


def test_features():
    docs, keys = quality.features([b"Abc abc", b"", b"ABC!! x", b"abc", "é!! \t y".encode()])
    sets = [set(keys[docs == i].tolist()) for i in range(5)]
    assert not sets[1] and sets[3] < sets[0] and len(sets[0] & sets[2]) >= 1 and sets[2] != sets[0]
    one, some = quality.features([b"abc q"], np.sort(keys[docs == 3]))
    assert set(one.tolist()) == {0} and len(some) < len(quality.features([b"abc q"])[0])


def test_edges(spark, tables):
    docs, labels = tables
    odd = spark.createDataFrame([(1, None), (1, None), (2, ""), (None, "idiot")], "doc_id bigint, text string").withColumn("score", F.lit("x"))
    got = quality.quality_report(odd, labels).collect()
    assert len(got) == 4 and all(abs(r.p_toxic + r.p_low + r.p_good - 1) < 1e-9 for r in got)
    assert quality.quality_report(odd.limit(0), labels).count() == 0
    assert quality.quality_report(odd, labels.limit(0)).count() == 4


def test_fit_is_the_maximum_of_the_penalised_likelihood():
    """No step away from what the fit gives is better, and the slopes there are nearly zero."""
    rng = np.random.default_rng(3)
    n, m, ridge = 400, 12, 0.5
    x = rng.random((n, m)) < 0.3
    z = x @ rng.standard_normal(m) + rng.logistic(size=n)
    grades = np.digitize(z, [-0.7, 0.9])
    rows, columns = np.nonzero(x)
    weights, cuts = quality.cumulative_link(rows, columns, m, grades, ridge=ridge, rounds=3000)

    def value(w, c):
        total = -ridge / 2 * float(w @ w)
        for i in range(n):
            s = float(x[i] @ w)
            upto = [0.0, *(1 / (1 + np.exp(s - t)) for t in c), 1.0]
            total += np.log(upto[grades[i] + 1] - upto[grades[i]])
        return total

    best = value(weights, cuts)
    assert cuts[0] < cuts[1]
    for j in range(m + 2):
        for step in (-0.05, 0.05):
            w, c = weights.copy(), cuts.copy()
            (w if j < m else c)[j if j < m else j - m] += step
            assert value(w, c) < best + 1e-6


def test_ties_long_texts_and_clashing_columns(spark):
    nothing = quality.Model(np.zeros(0, np.uint64), np.zeros(0), np.array([0.0, 40.0]))  # grades 0 and 1 are as likely
    rows = [(1, "a b", "x"), (1, "a b", "x"), (2, None, "y"), (3, "word " * 400_000, "z")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, score string")
    got = quality.judge_quality(table, nothing, carry=["doc_id", "score"], into="q").select("doc_id", F.col("score").alias("s"), "q.*").collect()
    assert [r.grade for r in got] == [0] * 4 and sorted(r.s for r in got) == ["x", "x", "y", "z"]
