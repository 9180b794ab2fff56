import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from weavegraph.llm import decontaminate as d


def brute(texts, items, window=13):
    wanted = {}
    for i, t in items:
        w = d.words(t)
        for k in range(max(1, len(w) - window + 1)) if w and i is not None else ():
            wanted.setdefault(tuple(w[k : k + window]), set()).add(i)
    out = []
    for t in texts:
        w, hit, got = d.words(t), set(), set()
        for n in {len(k) for k in wanted}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in wanted:
                    hit.update(range(k, k + n))
                    got |= wanted[tuple(w[k : k + n])]
        out.append((len(w), len(hit), len(got), d.items_digest(list(got))))
    return out


def test_words():
    assert d.words("Ab-ÀC_9\tx") == ["ab".encode(), "Àc".encode(), b"9", b"x"]
    assert d.words(None) == d.words(" .\n") == []


def test_suffix_array_and_search_against_brute_force():
    rng = random.Random(3)
    for _ in range(30):
        s = [rng.randint(1, 4) for _ in range(rng.randint(1, 60))]
        index = d.FmIndex(np.array([*s, 1, 0]), 5)
        pats = [tuple(rng.randint(2, 4) for _ in range(3)) for _ in range(10)]
        live, low, high = index.search(np.array(pats))
        got = {i: sorted(index.locate(np.arange(a, b)).tolist()) for i, a, b in zip(live, low, high, strict=True)}
        for i, p in enumerate(pats):
            assert got.get(i, []) == [k for k in range(len(s) - 2) if tuple(s[k : k + 3]) == p]


@pytest.mark.parametrize("block", [200_000, 30])
def test_small_cases(spark, block):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(12)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, say(n)) for i, n in enumerate([20, 13, 14, 3, 1, 40])] + [(90, None), (91, "..."), (None, "w1 w2"), (7, "w1 w1 w1 w1"), (7, "w2 w2 w2 w2")]
    texts = [say(50) + " " + items[0][1].upper() + " " + say(30), items[5][1], None, "", "!!", items[1][1], items[1][1], say(3000), "zz zz zz", "W1, w1; w1. w1"]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id bigint, text string, spans string, n_hit int")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = d.decontamination_report(docs, bench, block_words=block).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in got] == brute(texts, items)
    assert [r.contaminated for r in got] == [h > 0 and 20 * h >= n for n, h, _, _ in brute(texts, items)]
    kept = d.remove_contaminated(docs, bench, block_words=block)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if not r.contaminated}
    assert d.decontamination_report(docs.limit(0), bench).count() == 0
    assert d.decontamination_report(docs, bench.limit(0)).filter("contaminated").count() == 0


def test_on_driver_table(spark, sf_dir):
    docs, bench = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = docs.orderBy("doc_id").collect()
    got = d.decontamination_report(docs, bench).orderBy("doc_id").collect()
    want = brute([r.text for r in rows], [(r.item_id, r.text) for r in bench.collect()])
    assert [(r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in got] == want
    assert any(r.contaminated for r in got)
    spans = d.find_contamination(docs, bench, carry=["doc_id"]).select(F.expr("aggregate(contamination.spans, 0L, (n, s) -> n + s.end - s.start) = contamination.n_hit").alias("same"))
    assert spans.filter("not same").count() == 0
