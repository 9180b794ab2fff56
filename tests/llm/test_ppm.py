import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from weavegraph.llm import ppm


def brute_trie(texts):
    counts = [defaultdict(Counter) for _ in range(ppm.ORDER + 1)]
    for t in texts:
        s = [ppm.START] * ppm.ORDER + list(t) + [ppm.END]
        for i in range(ppm.ORDER, len(s)):
            for k in range(ppm.ORDER + 1):
                counts[k][tuple(s[i - k : i])][s[i]] += 1
    return counts


def brute_score(counts, t):
    s, total = [ppm.START] * ppm.ORDER + list(t) + [ppm.END], 0.0
    for i in range(ppm.ORDER, len(s)):
        excluded = set()
        for k in range(ppm.ORDER, -1, -1):
            seen = {x: n for x, n in counts[k].get(tuple(s[i - k : i]), {}).items() if x not in excluded}
            if not seen:
                continue
            whole = sum(seen.values())
            if s[i] in seen:
                total += math.log10((seen[s[i]] - 0.5) / whole)
                break
            total += math.log10(0.5 * len(seen) / whole)
            excluded |= set(seen)
        else:
            total -= math.log10(ppm.SYMBOLS - len(excluded))
    return total


def trie_of(texts):
    keys, counts = np.unique(ppm.grams(texts)[0], return_counts=True)
    levels = [(keys, counts)]
    for k in range(ppm.ORDER, 0, -1):
        short, inverse = np.unique(levels[-1][0] & np.uint64((1 << 8 * k) - 1), return_inverse=True)
        levels.append((short, np.bincount(inverse, weights=levels[-1][1]).astype(np.int64)))
    trie = ppm.Trie(levels[::-1])
    trie.prepare()
    return trie


def test_score_by_brute_force():
    rng = random.Random(2)
    say = lambda n: bytes(rng.choice(b"abcd e\xc3\xa9") for _ in range(n))
    texts = [say(rng.randrange(60)) for _ in range(30)] + [b""]
    counts, trie = brute_trie(texts), trie_of(texts)
    asked = [b"", b"zzz", *texts[:5], say(200), b"abc\x00\xff"]
    assert np.allclose(trie.score(asked), [brute_score(counts, t) for t in asked])


def test_probabilities_sum_to_one():
    trie = trie_of([b"abracadabra", b"abrak", b"cad"])
    for context in (b"abra", b"zzzz", b"xxab", bytes([ppm.START]) * 4):
        context = context.rjust(ppm.ORDER, b"b")
        packed = np.array([int.from_bytes(context + bytes([x]), "big") for x in range(256)], dtype=np.uint64)
        unseen = 10 ** trie.log10(packed)[ord("q")]  # the 257th symbol is as likely as any unseen one
        assert abs((10 ** trie.log10(packed)).sum() + unseen - 1) < 1e-9


def test_lookup():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**40, 5000).astype(np.uint64))
    find = ppm.Lookup(keys)
    assert (find(keys) == np.arange(len(keys))).all() and (find(keys + np.uint64(2**50)) == -1).all()


@pytest.mark.parametrize(("chunk_bytes", "buckets"), [(32 << 20, None), (3000, 5)])
def test_against_brute_force(spark, chunk_bytes, buckets):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(60)
    rows = [tuple(r) for r in docs.collect()] + [(5000, None), (5001, ""), (5002, "Zq zq\tzQ  unseenword"), (5002, "Zq zq\tzQ  unseenword"), (None, "a b")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    held = [d is not None and zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows]
    words = [re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode())) + ["end"] for _, t in rows]
    seen = Counter(w for its, h in zip(words, held, strict=True) for w in its if not h)
    n, v = sum(seen.values()), len(seen)
    plain = [b" ".join(its[:-1]) for its in words]
    counts = brute_trie([t for t, h in zip(plain, held, strict=True) if not h])
    want = sorted((str(d), h, len(its), sum(w in seen for w in its), n, sum(math.log10((seen[w] + 0.1) / (n + 0.1 * (v + 1))) for w in its), brute_score(counts, t)) for (d, _), t, h, its in zip(rows, plain, held, words, strict=True))
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in ppm.score_report(table, chunk_bytes=chunk_bytes, buckets=buckets).collect())
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert a[:5] == b[:5] and abs(a[5] - b[5]) < 1e-6 and abs(a[6] - b[6]) < 1e-6


def test_held_out_text_and_edges(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter("doc_id % 2 = 0")
    got = ppm.score_report(docs).filter("held_out").collect()
    assert sum(r.score for r in got) > sum(r.base_score for r in got)
    assert sum(r.score for r in got) < 0
    assert ppm.score_report(docs.limit(0)).count() == 0


def test_whole_model_on_a_larger_table(spark):
    """All grams count, above the 800,000 a level that once were the most."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter("doc_id % 4 = 0")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    plain = [b" ".join(re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))) for _, t in rows]
    held = [zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows]
    trie = trie_of([t for t, h in zip(plain, held, strict=True) if not h])
    want = dict(zip([d for d, _ in rows], trie.score(plain), strict=True))
    got = ppm.score_report(docs).collect()
    assert len(trie.levels[ppm.ORDER][0]) > 800_000 and len(got) == len(want)
    assert all(abs(r.score - want[r.doc_id]) < 1e-6 * abs(want[r.doc_id]) for r in got)


def test_ahead_on_a_thousand_documents(spark):
    got = ppm.score_report(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).filter("held_out").collect()
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_blocks_of_long_texts():
    rng = random.Random(4)
    texts = [bytes(rng.choice(b"abc ") for _ in range(n)) for n in (0, 1, 900, 3, 0, 250)]
    want, size = ppm.grams(texts)
    for most in (1, 7, 64, 1 << 20):
        blocks = list(ppm.gram_blocks(texts, most))
        assert (np.concatenate([b[0] for b in blocks]) == want).all()
        assert (np.concatenate([b[1] for b in blocks]) == np.repeat(np.arange(len(texts)), size)).all()


def test_other_columns_and_nothing_to_learn(spark):
    rows = [(6, "a b", 1, "x"), (6, "a b", 2, "y")]  # crc32("6") % 10 == 0, so both are held out
    assert zlib.crc32(b"6") % 10 == 0
    got = ppm.score_report(spark.createDataFrame(rows, "doc_id bigint, text string, chunk int, score string")).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in got] == [(3, 0, 0)] * 2
    assert all(abs(r.score + 4 * math.log10(257)) < 1e-9 and abs(r.base_score) < 1e-9 for r in got)
