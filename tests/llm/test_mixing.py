import re
from collections import defaultdict

import duckdb
import pytest

from weavegraph.llm import mixing


def targets(sizes):
    """sizes by source in order; the contract's shares, stopped at three times the size."""
    total, weight = sum(sizes), [i % 3 + 1 for i in range(len(sizes))]
    capped = set()
    while True:
        rest = total - sum(3 * sizes[i] for i in capped)
        w = sum(weight[i] for i in range(len(sizes)) if i not in capped)
        share = [3 * s if i in capped else rest * weight[i] / w for i, s in enumerate(sizes)]
        more = {i for i in range(len(sizes)) if i not in capped and share[i] > 3 * sizes[i]}
        if not more:
            return share
        capped |= more


def check(rows, slack=0.02):
    by = defaultdict(list)
    for r in rows:
        by[r.target, r.source_size].append(r)
        assert 0 <= r.taken <= 3 * r.size
    for (target, _), its in by.items():
        assert abs(sum(r.taken for r in its) - target) <= slack * target + 3, (target, sum(r.taken for r in its))


def test_word_count(spark):
    texts = [None, "", "  ", "a", " a\tb\n\x0bc\x0c ", "é ü x", "one two  three\r\n"]
    got = spark.createDataFrame([(t,) for t in texts], "text string").select(mixing.count_words("text").alias("n")).collect()
    assert [r.n for r in got] == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]


@pytest.mark.parametrize("slots", [1 << 16, 64])
def test_mix_small(spark, slots):
    rows = [(i, "w " * (i % 37), None if i % 11 == 0 else f"s{i % 5}", "x") for i in range(400)]
    rows += [(7, "w w w", "s1", "x")] * 2 + [(900, None, "s0", "y"), (None, "a b", None, "y"), (901, "", "empty", "z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, size string")
    got = mixing.mix_sources(docs, slots=slots).collect()
    assert len(got) == len(rows)
    check(got, 0.02 if slots > 64 else 0.2)
    sizes = defaultdict(int)
    for _, t, s, _ in rows:
        sizes[s] += len((t or "").split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = dict(zip([sizes[s] for s in order], targets([sizes[s] for s in order]), strict=True))
    assert all(abs(want[r.source_size] - r.target) < 1e-6 * (1 + r.target) for r in got)
    again = mixing.mix_sources(docs.repartition(7), slots=slots).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    kept = mixing.repeat_by_mix(docs, slots=slots)
    assert kept.columns == docs.columns and kept.count() > 0
    assert mixing.mix_sources(docs.limit(0)).count() == 0
    assert mixing.mix_sources(docs.filter("doc_id = 900")).collect()[0].taken == 0


def test_schedule_is_even(spark):
    sources = spark.createDataFrame([(1, 700.0), (2, 0.0), (3, 300.0)], "sid int, target double")
    got = mixing.source_schedule(sources, 1000, 1).orderBy("slot").collect()
    assert [r.slot for r in got] == list(range(1000)) and sum(r.sid == 1 for r in got) in range(698, 703)
    for n in range(10, 1001, 10):
        assert abs(sum(r.sid == 3 for r in got[:n]) - 0.3 * n) < 3
    for s in (1, 3):
        assert [r.rank for r in got if r.sid == s] == list(range(sum(r.sid == s for r in got)))


def test_against_sql(spark, sf_dir):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from read_parquet('{sf_dir}/documents.parquet')")
    want = con.sql(mixing.MIX_SQL).fetchall()
    got = mixing.mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()
    key = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted(((r.doc_id, r.taken, r.first_slot) for r in got), key=key) == sorted(((r[0], r[4], r[5]) for r in want), key=key)
    assert all((r.first_slot is None) == (r.taken == 0) for r in got if r.taken == 0 or r.taken >= r.size)
    check(got, 0.03)


def test_the_schedule_decides(spark, sf_dir, monkeypatch):
    """With other points the slots differ, so the result shows the schedule."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    slots = lambda: {(r.doc_id, r.first_slot) for r in mixing.mix_sources(docs).collect()}
    golden = slots()
    monkeypatch.setattr(mixing, "GOLDEN", 1)
    assert len(golden & slots()) < len(golden) / 2


def test_tiny_sources_beside_a_huge_one(spark):
    """No source misses its target, wherever it stands on the cumulative line."""
    rows = [(i, "w " * 997, "big") for i in range(900)]
    for k in range(40):
        rows += [(1000 + 50 * k + i, "w " * (5 + k), f"{'a' if k % 2 else 'x'}{k:02}") for i in range(1 + k)]
    got = mixing.mix_sources(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), slots=220).collect()
    sizes = {r.doc_id: r for r in got}
    for name in {s for _, _, s in rows}:
        its = [sizes[d] for d, _, s in rows if s == name]
        taken, target, block = sum(r.taken for r in its), its[0].target, max(1, its[0].source_size // 64)
        assert abs(taken - target) <= block + 1, (name, taken, target)


def test_any_stretch_of_the_mix_is_near_the_targets(spark, tmp_path):
    import random

    rng = random.Random(5)
    rows = [(i, "w " * rng.randrange(1, 60), rng.choice("aabbbbbbcd")) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    target = {}
    source = {d: s for d, _, s in rows}
    for r in mixing.mix_sources(docs, slots=2000).collect():
        target[source[r.doc_id]] = r.target
    mixing.repeat_by_mix(docs, slots=2000).write.parquet(str(tmp_path / "mix"))
    mix = [r for f in sorted((tmp_path / "mix").glob("part-*")) for r in spark.read.parquet(str(f)).collect()]
    words, whole = [(r.source, len(r.text.split())) for r in mix], sum(target.values())
    size, step = sum(n for _, n in words), len(words) // 12
    assert abs(size - whole) < 0.03 * whole
    for start in range(0, len(words) - step, step):
        part = words[start : start + step]
        for s in target:
            share = sum(n for x, n in part if x == s) / sum(n for _, n in part)
            assert abs(share - target[s] / whole) < 0.05, (start, s, share, target[s] / whole)


def test_repeated_ids_of_different_texts_keep_their_own_copies(spark):
    rows = [(1, "w " * 300, "a"), (1, "x", "b"), (2, "", "b"), (None, "y z", None), (None, "y z", None)]
    kept = mixing.repeat_by_mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    assert {r.text for r in kept} == {"w " * 300, "x", "y z"} and sum(r.text == "x" for r in kept) == 3


@pytest.mark.parametrize("mix", [mixing.repeat_by_mix, mixing.mix_sources])
def test_no_plan_of_the_mix_is_long(spark, monkeypatch, mix):
    """What is read more than once is written, not planned again: the driver's memory goes with the longest plan."""
    plans, write = [], mixing.stored
    exchanges = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange ")
    monkeypatch.setattr(mixing, "stored", lambda df, *a, **b: (plans.append(exchanges(df)), write(df, *a, **b))[1])
    docs = spark.createDataFrame([(i, "w " * (i % 37), f"s{i % 5}") for i in range(400)], "doc_id bigint, text string, source string")
    plans.append(exchanges(mix(docs)))
    assert max(plans) <= 14
