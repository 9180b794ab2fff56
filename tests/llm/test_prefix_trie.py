import hashlib
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from weavegraph.llm import catalog, prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def brute(rows):
    lists = {}
    for c, turn, role, text in rows:
        if c is not None:
            pair = (role or "", text or "")
            digest = hashlib.md5(f"{len(pair[0])}:{pair[0]}{pair[1]}".encode()).digest()
            lists.setdefault(c, []).append((turn is not None, turn or 0, digest, pair))
    lists = {c: [x[3] for x in sorted(v)] for c, v in lists.items()}
    convs = {}
    for c, own in lists.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = int(np.fix(c / 100)) * 100
        convs[c] = tuple(lists.get(base, [])[:h] + own[h:])
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    children = {}
    for p in nodes:
        if p:
            children[p[:-1]] = children.get(p[:-1], 0) + 1
    leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for p, members in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(members) - 1) * (len(p[-1][1]) if p else 0)
    sha = lambda p: hashlib.sha256(",".join(map(str, sorted(c for c in nodes[p] if convs[c] == p))).encode()).hexdigest()
    return {(min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), children.get(p, 0), leaves[p], saved[p], sha(p)) for p, m in nodes.items()}


def reported(spark, rows):
    got = [tuple(r) for r in prefix_trie.trie_report(spark.createDataFrame(rows, SCHEMA)).select(*COLUMNS).collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.sql("create view conversations as select * from '/root/testdata/sf0.01/conversations.parquet'")
    want = con.sql(prefix_trie.TRIE_SQL)
    got = catalog.op13_conversation_trie(spark, "/root/testdata/sf0.01").select(*want.columns).collect()
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert len(got) and sorted(map(tuple, got), key=key) == sorted(want.fetchall(), key=key)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(-30, 330):
        few = 1 + int(rng.integers(0, 3))  # few different texts make deep shared prefixes
        rows += [(c, t, "user", f"t{rng.integers(0, few)}") for t in range(int(rng.integers(1, 14)))]
    assert reported(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [(0, 0, "user", "a"), (0, None, "system", None), (0, 1, None, "b"), (0, 1, None, "b"), (1, 0, "user", "a"), (1, 2, "x", ""), (2, 5, "user", "é" * 40_000), (7, 0, "u", "ser"), (7, 0, "us", "er")]
    rows += [(c, 0, "user", "only") for c in range(200, 260)]  # base absent for none, turns cut away for many
    rows += [(c, 0, "user", "alone") for c in range(501, 540)]  # their base is absent: turnless but for h = 0
    rows += [(None, 0, "user", "nobody"), (9_000_000_000, None, None, None)]
    assert reported(spark, rows) == brute(rows)
    assert reported(spark, []) == set()


def test_long_and_nested(spark):
    """A conversation of many turns, and others that are its beginnings: ends and cuts all along one edge."""
    rows = [(1000, t, "user", f"turn {t}") for t in range(300)]
    rows += [(c, t, "user", f"turn {t}") for c in range(1001, 1040) for t in range(7 * (c - 1000))]
    rows += [(c, t, "user", f"turn {t}" if t < c % 50 else f"else {c}") for c in range(1040, 1090) for t in range(60)]
    assert reported(spark, rows) == brute(rows)


def test_many_equal_conversations_and_extra_columns(spark):
    rows = [(c, t, "user", f"same {t}") for c in range(6000, 12_000) for t in range(3)]
    df = spark.createDataFrame(rows, SCHEMA)
    odd = df.select("*", F.lit("x").alias("seq"), F.lit(1).alias("node"), F.lit(2).alias("hashes"), F.lit(None).cast("string").alias("digest"))
    got = {tuple(r) for r in prefix_trie.trie_report(odd).select(*COLUMNS).collect()}
    assert got == brute(rows)


def test_every_sequence_is_located(spark):
    """Fat binary search finds the depth at which a sequence leaves the trie: the longest prefix it shares with any."""
    rng = np.random.default_rng(5)
    made = lambda n, base: [(base + c, t, "u", f"{rng.integers(0, 2)}") for c in range(n) for t in range(int(rng.integers(1, 40)))]
    known, asked = made(120, 0), made(150, 1000)
    lists = lambda rows: prefix_trie.turn_lists(spark.createDataFrame(rows, SCHEMA))
    trie = prefix_trie.build(lists(known))
    words = {}
    for c, _, _, text in known + asked:
        words[c] = words.get(c, "") + text
    prefixes = {words[c][:d] for c in {r[0] for r in known} for d in range(len(words[c]) + 1)}
    hashed = prefix_trie.prefix_hashes(lists(asked)).cache()
    depth = {r.seq: r.m for r in trie.locate(hashed.select("seq", "hashes").distinct()).collect()}
    for r in hashed.collect():
        want = max(d for d in range(len(words[r.conv_id]) + 1) if words[r.conv_id][:d] in prefixes)
        assert depth[r.seq] == want
    # Handles and entries are keys: each of one node.
    n = trie.nodes.count()
    assert n == trie.nodes.select("handle").distinct().count() == trie.nodes.select("first").distinct().count()


def test_fattest(spark):
    rows = [(a, b) for a in range(40) for b in range(a + 1, 41)]
    got = spark.createDataFrame(rows, "a int, b int").select("a", "b", prefix_trie.fattest("a", "b").alias("f")).collect()
    for a, b, f in got:
        assert f == max(range(a + 1, b + 1), key=lambda x: x & -x)
