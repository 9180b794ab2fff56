import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from weavegraph.llm import catalog, curve_packing

SCHEMA = "doc_id bigint, text string"


def tokens_of(texts, end_id=1):
    t = Tokenizer.from_file(catalog.tokenizer_path())
    return [[*t.encode(x or "", add_special_tokens=False).ids, end_id] for x in texts]


def held(rows, pieces, size):
    """Every id of every document in exactly one piece, with its crc; sequences gapless, whole but for powers of two."""
    want = sorted((-1 if i is None else i, tuple(ids)) for (i, _), ids in zip(rows, tokens_of([t for _, t in rows])))
    by_sequence = {}
    for p in pieces:
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    short = []
    for s, own in by_sequence.items():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == np.cumsum([0, *[p.length for p in own[:-1]]]).tolist() and all(p.length > 0 for p in own)
        n = sum(p.length for p in own)
        if n != size:
            assert n < size and n & (n - 1) == 0
            short.append(s)
    assert sum(1 << b for b in {sum(p.length for p in by_sequence[s]).bit_length() - 1 for s in short}) == sum(map(len, [ids for _, ids in want])) % size
    # In the stream's order documents follow each other whole; so they can be read off and compared.
    stream = [p for s in sorted(by_sequence) for p in by_sequence[s]]
    made, at = [], 0
    while at < len(stream):
        own, total = [stream[at]], stream[at].doc_tokens
        while sum(p.length for p in own) < total:
            at += 1
            own.append(stream[at])
        at += 1
        assert {(p.doc_id, p.doc_tokens) for p in own} == {(own[0].doc_id, total)} and [p.start for p in own] == np.cumsum([0, *[p.length for p in own[:-1]]]).tolist()
        made.append((-1 if own[0].doc_id is None else own[0].doc_id, [(p.start, p.length, p.ids_crc32) for p in own]))
    left = {}
    for i, ids in want:
        left.setdefault(i, []).append(ids)
    for i, own in made:
        n = sum(x[1] for x in own)
        match = next(x for x in left[i] if len(x) == n and all(zlib.crc32(np.array(x[a : a + m], "<u4").tobytes()) == crc for a, m, crc in own))
        left[i].remove(match)
    assert not any(left.values())


@pytest.mark.parametrize("options", [{"size": 64, "part_tokens": 500}, {"size": 2048, "part_tokens": 5000}, {"size": 48, "part_tokens": 100_000}])
def test_every_id_once(spark, options):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    pieces = curve_packing.packing_report(docs, tokenizer=catalog.tokenizer_path(), **options).collect()
    held([(r.doc_id, r.text) for r in docs.collect()], pieces, options["size"])


def test_odd_rows(spark):
    rows = [(None, "no id"), (None, None), (1, None), (2, ""), (3, "same text"), (3, "same text"), (3, "other"), (-4, "Ünïcode " * 9), (5, "x" * 300), (6, "word " * 9000)] + [(7, "often the same words")] * 400
    df = spark.createDataFrame(rows, SCHEMA).select("*", F.lit(1).alias("place"), F.lit("x").alias("part"), F.lit(None).cast("string").alias("ids"))
    pieces = curve_packing.packing_report(df, tokenizer=catalog.tokenizer_path(), size=128, part_tokens=700).collect()
    held(rows, pieces, 128)
    assert curve_packing.packing_report(spark.createDataFrame([], SCHEMA), tokenizer=catalog.tokenizer_path()).collect() == []


def test_one_place_is_dealt_to_several_parts(spark):
    rows = [(1, "all rows are one document")] * 3000
    sequences = curve_packing.pack_documents(spark.createDataFrame(rows, SCHEMA), tokenizer=catalog.tokenizer_path(), size=64, part_tokens=1000)
    held(rows, curve_packing.piece_digest(sequences).collect(), 64)


def test_neighbours_are_alike(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.collect()}
    pieces = curve_packing.packing_report(docs, tokenizer=catalog.tokenizer_path()).collect()
    order = [lang[p.doc_id] for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)) if p.start == 0]
    alike = np.mean([a == b for a, b in zip(order, order[1:])])
    chance = sum((order.count(x) / len(order)) ** 2 for x in set(order))
    assert alike > chance + 0.6 * (1 - chance)


@pytest.mark.parametrize("dims, bits", [(2, 3), (3, 2), (4, 2)])
def test_hilbert_curve(dims, bits):
    """Every cell once, and each next to the one before."""
    n = 1 << bits
    cells = np.stack(np.meshgrid(*[np.arange(n)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
    place = curve_packing.hilbert(cells, bits)
    assert sorted(place.tolist()) == list(range(n**dims))
    path = cells[np.argsort(place)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_tail():
    assert curve_packing.tail_bounds(4096, 2048).tolist() == [4096]
    assert curve_packing.tail_bounds(2048 + 13, 2048).tolist() == [2048, 2056, 2060, 2061]
