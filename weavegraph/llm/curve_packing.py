"""Packing along a space-filling curve: sequences of like documents, without padding.

A document's vector of hashed token counts is projected to DIMS random directions, and only the direction of what comes out
counts, so a document's length plays no part. Its cell in a grid over these directions has a place on the Hilbert curve,
and documents near each other on the curve are alike. The place comes from the document alone: it needs no statistics, and
new documents move no old ones.

Documents are tokenized once. Quantiles of the places cut the curve into parts of some part_tokens each, the parts' token
counts tell where each part begins in the stream of all ids, and a task lays its parts out in the order of the curve and cuts
them into sequences of `size` ids. What straddles two batches or parts is put together by its sequence. The stream's rest is
cut into powers of two, which need no padding, so there is none at all.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from weavegraph.llm.common import forget, slices, stored
from weavegraph.llm.shingles import mix
from weavegraph.llm.token_files import encoder, ended

DIMS = 4
#: Bits of a cell's number on each axis; behind the place on the curve come bits of a hash, which order a cell's documents.
AXIS_BITS = 10
TIE_BITS = 22
BUCKETS = 1 << 16
TOKENIZED = "doc_id bigint, place bigint, tie bigint, n_tokens bigint, ids binary"
PIECES = "array<struct<doc_id bigint, start bigint, length bigint, doc_tokens bigint, offset bigint>>"
FRAGMENT = f"sequence_id bigint, at bigint, n_tokens bigint, ids binary, pieces {PIECES}"
PIECE = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of cells (rows of unsigned numbers of so many bits): Skilling's transform (2004)."""
    x, dims = cells.astype(np.uint64).T.copy(), cells.shape[1]
    for level in range(bits - 1, 0, -1):
        q, below = np.uint64(1 << level), np.uint64((1 << level) - 1)
        for i in range(dims):
            high = (x[i] & q) > 0
            swap = np.where(high, np.uint64(0), (x[0] ^ x[i]) & below)
            x[0] ^= np.where(high, below, swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], dtype=np.uint64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> np.uint64(level)) & np.uint64(1) > 0, np.uint64((1 << level) - 1), np.uint64(0))
    x ^= turn
    out = np.zeros(x.shape[1], dtype=np.uint64)
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            out = (out << np.uint64(1)) | ((x[i] >> np.uint64(level)) & np.uint64(1))
    return out


@functools.lru_cache(maxsize=2)
def directions(vocabulary: int, seed: int = 13) -> np.ndarray:
    """A row per token: its share in each direction, by the bucket that its id is hashed to."""
    buckets = np.random.default_rng(seed).standard_normal((BUCKETS, DIMS)).astype(np.float32)
    return buckets[mix(np.arange(1, vocabulary + 1, dtype=np.uint64)) & np.uint64(BUCKETS - 1)]


def places(ids: np.ndarray, lengths: np.ndarray, vocabulary: int) -> np.ndarray:
    """The place on the curve of each document; ids hold one after the other, none empty."""
    first = np.cumsum(lengths) - lengths
    projected = np.add.reduceat(np.take(directions(vocabulary), ids, axis=0), first, axis=0).astype(np.float64)
    projected /= np.maximum(np.sqrt((projected**2).sum(axis=1, keepdims=True)), 1e-30)
    cells = np.clip(((projected + 1) * (1 << AXIS_BITS - 1)).astype(np.int64), 0, (1 << AXIS_BITS) - 1)
    return hilbert(cells, AXIS_BITS)


def tail_bounds(total: int, size: int) -> np.ndarray:
    """Where the sequences begin that hold what whole ones leave of total ids, and where they end: powers of two, largest first."""
    rest = total % size
    parts = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    return total - rest + np.cumsum([0, *parts])


def _tokenized(docs: DataFrame, tokenizer: str, end_id: int, doc_id: str, text: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, row = encoder(tokenizer), TaskContext.get().partitionId() << 33
        vocabulary = max(encode.tokenizer.get_vocab_size(), end_id + 1)
        kind = "<u2" if vocabulary <= 1 << 16 else "<u4"
        for batch in batches:
            for piece in slices(batch, 1, 1 << 20):
                ids, lengths = ended(*encode(piece.column(1).to_pylist()), end_id)
                keys = piece.column(0)
                hashed = mix(keys.fill_null(0).to_numpy(zero_copy_only=False).astype(np.uint64)) >> np.uint64(64 - TIE_BITS)
                place = (places(ids, lengths, vocabulary) << np.uint64(TIE_BITS)) | hashed
                tie = (mix(np.arange(row, row + len(keys), dtype=np.uint64)) >> np.uint64(1)).astype(np.int64)
                row += len(keys)
                width = np.dtype(kind).itemsize
                offsets = np.concatenate(([0], np.cumsum(lengths))) * width
                data = pa.Array.from_buffers(pa.large_binary(), len(keys), [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(ids.astype(kind).tobytes())])
                yield pa.RecordBatch.from_arrays([keys, pa.array(place.astype(np.int64)), pa.array(tie), pa.array(lengths), data.cast(pa.binary())], names=["doc_id", "place", "tie", "n_tokens", "ids"])

    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, TOKENIZED)


def _laid_out(doc_ids: np.ndarray, lengths: np.ndarray, ids: list, width: int, begin: int, total: int, size: int) -> pa.RecordBatch:
    """Fragments of sequences that documents make, whose ids stand in the stream from `begin` on."""
    ends = begin + np.cumsum(lengths)
    starts, end, whole = ends - lengths, int(ends[-1]), total - total % size
    tail = tail_bounds(total, size)
    bounds = np.concatenate((np.arange(begin // size * size, min(end, whole) + 1, size), tail[:-1]))
    at = np.unique(np.concatenate((starts, bounds[(bounds > begin) & (bounds < end)])))
    length = np.diff(at, append=end)
    doc = np.searchsorted(starts, at, side="right") - 1
    last = np.searchsorted(tail, at, side="right") - 1
    sequence = np.where(at < whole, at // size, whole // size + last)
    offset = at - np.where(at < whole, at // size * size, tail[np.maximum(last, 0)])
    first = np.flatnonzero(np.diff(sequence, prepend=-1))
    data, upto = b"".join(ids), np.append(at[first], end) - begin
    offsets = pa.array(np.append(first, len(at)).astype(np.int32))
    fields = {"doc_id": doc_ids.take(pa.array(doc)), "start": pa.array(at - starts[doc]), "length": pa.array(length), "doc_tokens": pa.array(lengths[doc]), "offset": pa.array(offset)}
    pieces = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(list(fields.values()), names=list(fields)))
    chunks = pa.array([data[a * width : b * width] for a, b in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(sequence[first]), pa.array(offset[first]), pa.array(np.diff(upto)), chunks, pieces], names=["sequence_id", "at", "n_tokens", "ids", "pieces"])


def pack_documents(docs: DataFrame, *, tokenizer: str, end_id: int = 1, size: int = 2048, doc_id: str = "doc_id", text: str = "text", part_tokens: int = 4 << 20, most_parts: int = 20_000) -> DataFrame:
    """Sequences of `size` ids along the curve, written to the shared folder: sequence_id, n_tokens, ids (little-endian
    numbers of two bytes, or four where the tokenizer has more than 65,536 ids) and pieces (doc_id, start in the document,
    length, doc_tokens, offset in the sequence), offsets gapless from 0. The last sequences are shorter: powers of two.

    Null and empty texts are documents of the end id alone; long ones run on over as many sequences as they need; rows
    without doc_id count like others; repeated rows each count, and however many stand at one place of the curve, they are
    dealt to several parts; other columns play no part; no documents, no sequences.
    """
    spark = docs.sparkSession
    tokens = stored(_tokenized(docs, tokenizer, end_id, doc_id, text), "tokens", compression="zstd")
    total = tokens.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    parts = int(max(1, min(most_parts, -(-total // part_tokens))))
    marks = tokens.agg(F.percentile_approx("place", [i / parts for i in range(1, parts)], 20 * parts)).first()[0] if parts > 1 else None
    bounds = np.array(marks or [], dtype=np.int64)

    @pandas_udf("int")
    def part_of(place: pd.Series, tie: pd.Series) -> pd.Series:
        # Places up to a bound are the part before it; a place that is several bounds has several parts.
        low, high = np.searchsorted(bounds, place.to_numpy(), side="left"), np.searchsorted(bounds, place.to_numpy(), side="right")
        return pd.Series((low + tie.to_numpy() % np.maximum(1, high - low)).astype(np.int32))

    held = tokens.groupBy(part_of("place", "tie").alias("part")).agg(F.sum("n_tokens").alias("n")).collect()  # a row per part
    sizes = np.zeros(parts, dtype=np.int64)
    for r in held:
        sizes[r.part] = r.n
    begins = np.cumsum(sizes) - sizes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, begin = -1, 0
        for batch in batches:
            for piece in slices(batch, 3, 4 << 20):
                at = 0
                part, lengths = piece.column(0).to_numpy(), piece.column(2).to_numpy()
                for cut in [*(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]:
                    if part[at] != now:
                        now, begin = part[at], int(begins[part[at]])
                    ids = piece.column(3).slice(at, cut - at).to_pylist()
                    width = len(ids[0]) // int(lengths[at])
                    yield _laid_out(piece.column(1).slice(at, cut - at), lengths[at:cut], ids, width, begin, total, size)
                    begin += int(lengths[at:cut].sum())
                    at = cut

    order = ["part", "place", "doc_id", "tie"]
    dealt = tokens.withColumn("part", part_of("place", "tie")).repartitionById(parts, F.col("part")).sortWithinPartitions(*order)
    fragments = stored(dealt.select("part", "doc_id", "n_tokens", "ids").mapInArrow(run, FRAGMENT), "fragments", compression="zstd")
    forget(tokens)
    whole = total - total % size
    full = F.when(F.col("sequence_id") < whole // size, size)
    for i, n in enumerate(np.diff(tail_bounds(total, size)).tolist()):
        full = full.when(F.col("sequence_id") == whole // size + i, n)
    put = F.sort_array(F.collect_list(F.struct("at", "n_tokens", "ids", "pieces")))  # of one sequence
    joined = fragments.filter(F.col("n_tokens") < full).groupBy("sequence_id").agg(put.alias("f"))
    joined = joined.select(
        "sequence_id",
        F.aggregate("f", F.lit(0).cast("bigint"), lambda s, x: s + x["n_tokens"]).alias("n_tokens"),
        F.aggregate("f", F.lit(b""), lambda s, x: F.concat(s, x["ids"])).alias("ids"),
        F.flatten(F.transform("f", lambda x: x["pieces"])).alias("pieces"),
    )
    return fragments.filter(F.col("n_tokens") == full).select("sequence_id", "n_tokens", "ids", "pieces").unionByName(joined)


def piece_digest(sequences: DataFrame) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32 (of the ids as four bytes each), doc_tokens, sequence_id, offset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, 2, 4 << 20):
                pieces, crcs = some.column(3), []
                flat = pieces.flatten()
                counts = np.diff(pieces.offsets.to_numpy())
                offset, length = flat.field("offset").to_numpy(), flat.field("length").to_numpy()
                i = 0
                for ids, n, many in zip(some.column(2).to_pylist(), some.column(1).to_pylist(), counts.tolist(), strict=True):
                    data = memoryview(np.frombuffer(ids, f"<u{len(ids) // n}").astype("<u4").tobytes())
                    crcs += [zlib.crc32(data[4 * a : 4 * (a + m)]) for a, m in zip(offset[i : i + many].tolist(), length[i : i + many].tolist(), strict=True)]
                    i += many
                again = pa.array(np.repeat(np.arange(len(counts)), counts))
                yield pa.RecordBatch.from_arrays(
                    [flat.field("doc_id"), flat.field("start"), flat.field("length"), pa.array(crcs, pa.int64()), flat.field("doc_tokens"), some.column(0).take(again), flat.field("offset")],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
                )

    return sequences.select("sequence_id", "n_tokens", "ids", "pieces").mapInArrow(run, PIECE)


def packing_report(docs: DataFrame, *, tokenizer: str, **options) -> DataFrame:
    """Pack all documents and read the sequences back, piece by piece."""
    return piece_digest(pack_documents(docs, tokenizer=tokenizer, **options))
