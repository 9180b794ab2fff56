import random

import pytest
from pyspark.sql import functions as F

from weavegraph.llm import line_dedup as d


def brute(rows, least):
    """rows: (doc_id, text) in order. The spans of lines that runs of at least `least` words with an earlier occurrence cover."""
    docs = [(t.split("\n") if t is not None else []) for _, t in rows]
    seen, out = {}, []
    for n, lines in enumerate(docs):
        for i in range(len(lines)):
            for length in range(1, len(lines) - i + 1):
                seen.setdefault(tuple(lines[i : i + length]), (n, i))
    for n, lines in enumerate(docs):
        gone, sources = set(), set()
        for i in range(len(lines)):
            longest = max((m for m in range(1, len(lines) - i + 1) if seen[tuple(lines[i : i + m])] < (n, i)), default=0)
            if sum(len(x.split()) for x in lines[i : i + longest]) >= least and longest:
                gone.update(range(i, i + longest))
                sources.add(rows[seen[tuple(lines[i : i + longest])][0]][0])
        spans = [i for i in range(len(lines) + 1) if (i in gone) != (i - 1 in gone)]
        out.append((rows[n][0], len(lines), len(gone), [tuple(spans[k : k + 2]) for k in range(0, len(spans), 2)], sorted(sources)))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    pool = [" ".join(f"w{rng.randrange(50)}" for _ in range(rng.randrange(0, 9))) for _ in range(14)]
    texts = [[rng.choice(pool) if rng.random() < 0.7 else f"own {rng.random()}" for _ in range(rng.randrange(1, 14))] for _ in range(70)]
    passage = [f"passage {i} " + "p " * 12 for i in range(6)]
    for t in texts[::5]:
        t[len(t) // 2 : len(t) // 2] = passage[rng.randrange(2) :]
    texts += [texts[3]] * 3 + [["x y"] * 40, ["x y"] * 20]
    return [(i, "\n".join(t)) for i, t in enumerate(texts)] + [(900, None), (901, ""), (902, "")]


@pytest.mark.parametrize("least", [1, 12, 50])
def test_against_brute_force(spark, rows, least):
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id bigint, text string, pos int, lines string").repartition(5)
    got = d.line_report(docs, least_words=least).orderBy("doc_id").collect()
    assert [(r.doc_id, r.n_lines, r.n_removed_lines, [(s.start, s.end) for s in r.removed], r.copied_from) for r in got] == brute(rows, least)


def test_texts_without_the_runs(spark, rows):
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id bigint, text string, spans int")
    got = {r.doc_id: r.text for r in d.without_repeated_runs(docs).collect()}
    for (i, t), (_, _, _, spans, _) in zip(rows, brute(rows, 50), strict=True):
        lines = None if t is None else t.split("\n")
        assert got[i] == (None if t is None else "\n".join(x for k, x in enumerate(lines) if not any(a <= k < b for a, b in spans)))


def test_edges(spark):
    long = "word " * 60
    docs = spark.createDataFrame([(None, long), (None, long), (4, long), (4, long), (5, "é\n" + long)], "doc_id bigint, text string")
    got = d.line_report(docs).orderBy("doc_id", "n_removed_lines").collect()
    assert [r.n_removed_lines for r in got] == [0, 1, 1, 1, 1] and got[4].n_removed_words == 60
    assert sorted(r.text for r in d.without_repeated_runs(docs).collect()) == ["", "", "", long, "é"]
    assert d.line_report(docs.limit(0)).count() == 0 and d.without_repeated_runs(docs.limit(0)).count() == 0
    assert d.without_repeated_runs(docs.withColumn("key", F.lit(1))).columns == ["doc_id", "text", "key"]


def test_line_hashes():
    texts = [b"", b"a b\n\na b", b"\n"]
    (e, ew), (x, xw), (n, nw) = d.line_hashes(texts)
    assert ew.tolist() == [0] and xw.tolist() == [2, 0, 2] and nw.tolist() == [0, 0]
    assert x[0] == x[2] != x[1] == e[0] == n[0] == n[1]


def test_very_long_texts(spark):
    """Tens of thousands of lines in one document, a copy of it, and one line over and over."""
    long = "\n".join(f"line {i} of many" for i in range(30_000))
    rows = [(1, long), (2, "first\n" + long), (3, "\n".join(["again and again"] * 20_000))]
    got = {r.doc_id: r for r in d.line_report(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [(s.start, s.end) for s in got[2].removed] == [(1, 30_001)] and not got[1].removed
    assert [(s.start, s.end) for s in got[3].removed] == [(1, 20_000)]
