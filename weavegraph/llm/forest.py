"""Approximate nearest neighbours by inner product: a forest of sorted arrays of long hash strings.

Each tree hashes a vector to a string of BITS signs of random projections, the vector first given one more coordinate
that makes all norms equal, so that the angle orders as the inner product does. A tree is the array of its strings in
sorted order: strings with a common prefix stand together. A query descends in every tree to the longest prefix that it
shares with any string, and then ascends in all trees at once, one bit at a time, until the ranges of the shared prefix
hold enough rows of all trees together. How deep that is, is told by the strings of a bounded sample of the rows; the
ranges themselves are taken from all rows.

Every tree's array is cut into cells by the first bits of its strings, and a crowded cell into parts by a hash. A row goes
to one part of its cell in each tree, with its components as bytes; a query goes to the cells under its prefix. No query
meets what lies elsewhere, and a task holds a part and its queries. A part gives the rows of a query's range that may
still be among its best: it leaves out what is below a score that some 6k of all rows reach, judging by the sample, but
for its own best two. The best of these meet the original vectors for
their exact scores. Equal vectors are one class, of which the smallest ids are enough, so copies crowd no cell.

How far the ascent goes is told by the query's neighbourhood, as the sample has it: two vectors at an angle share a string's
first bits with a known probability, so there is a depth at which a row as near as the 2k-th is met in some tree with
probability SURE. Where neighbours are near, that is deep, and ranges are small. It never goes on beyond RATE times the
number of all rows to the power GROWTH, counted over all trees, which random directions need for an even recall.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weavegraph.llm.common import stored

BITS = 32
RATE, GROWTH = 4, 0.8
SURE = 0.97


class Hasher:
    """Strings of vectors of one length. most: the largest squared norm, by which the norms are made equal."""

    def __init__(self, length: int, trees: int, most: float, seed: int = 11):
        self.planes = np.random.default_rng(seed).standard_normal((length + 1, trees * BITS)).astype(np.float32)
        self.trees, self.most = trees, most

    def __call__(self, vectors: np.ndarray, queries: bool = False) -> np.ndarray:
        """Trees by vectors: the strings as numbers, the first sign highest. Queries have 0 as their last coordinate."""
        out = np.empty((self.trees, len(vectors)), dtype=np.uint32)
        for start in range(0, len(vectors), 2048):
            given = vectors[start : start + 2048]
            more = np.zeros(len(given)) if queries else np.sqrt(np.maximum(0.0, self.most - (given**2).sum(axis=1)))
            bits = np.column_stack((given, more)).astype(np.float32) @ self.planes > 0
            out[:, start : start + 2048] = np.packbits(bits.reshape(len(bits), self.trees, BITS), axis=2).view(">u4")[:, :, 0].T
        return out


def span(strings: np.ndarray, asked: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each asked string the first and last+1 place in a sorted array of those that share its first `length` bits."""
    mask = ((np.uint64(1) << (np.uint64(BITS) - length.astype(np.uint64))) - np.uint64(1)).astype(np.uint32)
    return np.searchsorted(strings, asked & ~mask, side="left"), np.searchsorted(strings, asked | mask, side="right")


class Sample:
    """Some rows of one length, by which cells are laid out and depths are told."""

    def __init__(self, vectors: np.ndarray, hasher: Hasher, n: int, k: int, effort: float, cell_rows: int):
        self.vectors, self.hasher, self.share = vectors, hasher, max(1, n) / max(1, len(vectors))
        self.strings = np.sort(hasher(vectors), axis=1)
        trees = hasher.trees
        self.least, self.k, self.effort = effort * RATE * n**GROWTH, k, effort
        # A cell should hold what a query asks of a tree, some times over.
        self.bits = int(max(0, min(20, np.floor(np.log2(max(1, n) / max(cell_rows, 4 * self.least / trees))))))
        self.cell_rows = cell_rows

    def near_enough(self, queries: np.ndarray) -> np.ndarray:
        """The longest prefix that some tree shares, with probability SURE, between a query and a row as near as its 2k-th; more
        effort counts as so many forests at once, of which each may miss it."""
        sizes = np.maximum(np.sqrt((queries**2).sum(axis=1) * self.hasher.most), 1e-300)
        cosine = np.clip(np.nan_to_num(self.reached_by(queries, 2 * self.k) / sizes, neginf=-1.0), -1.0, 1.0)
        same = np.clip(1 - np.arccos(cosine) / np.pi, 1e-9, 1 - 1e-9)  # that one bit agrees
        return np.clip(np.floor(np.log1p(-((1 - SURE) ** (self.effort / self.hasher.trees))) / np.log(same)), 0, BITS).astype(np.int64)

    def depth(self, asked: np.ndarray, queries: np.ndarray) -> np.ndarray:
        """How long a prefix each query's ranges share: as its neighbourhood needs, or, if that is longer, the longest at which
        all trees' ranges together hold `least` rows. asked: trees by queries."""
        out, left = np.zeros(asked.shape[1], dtype=np.int64), np.arange(asked.shape[1])
        for length in range(BITS, 0, -1):
            if not len(left):
                break
            held = np.zeros(len(left))
            for t in range(len(asked)):
                low, high = span(self.strings[t], asked[t, left], np.full(len(left), length))
                held += high - low
            enough = held * self.share >= self.least
            out[left[enough]] = length
            left = left[~enough]
        return np.maximum(out, self.near_enough(queries))

    def parts(self, tree: int, cell: np.ndarray) -> np.ndarray:
        """Into how many parts a tree's cells are cut."""
        if not self.bits:
            held = np.full(len(cell), self.strings.shape[1])
        else:
            shift = np.uint32(BITS - self.bits)
            low, high = span(self.strings[tree], cell.astype(np.uint32) << shift, np.full(len(cell), self.bits))
            held = high - low
        return np.maximum(1, np.ceil(held * self.share / self.cell_rows)).astype(np.int64)

    def cells(self, strings: np.ndarray) -> np.ndarray:
        return (strings >> np.uint32(BITS - self.bits)).astype(np.int64) if self.bits else np.zeros(strings.shape, dtype=np.int64)

    def reached_by(self, queries: np.ndarray, rows: int) -> np.ndarray:
        """The score that about so many of all rows reach; minus infinity where there are fewer."""
        k = int(np.ceil(rows / self.share))
        if len(self.vectors) <= k:
            return np.full(len(queries), -np.inf)
        out = np.empty(len(queries))
        for start in range(0, len(queries), 256):
            scores = queries[start : start + 256] @ self.vectors.T
            out[start : start + 256] = np.partition(scores, scores.shape[1] - k - 1, axis=1)[:, -k - 1]
        return out


def usable(embedding: str | Column) -> Column:
    """Vectors that take part: not null or empty, all components finite numbers, not all zero."""
    e = F.col(embedding) if isinstance(embedding, str) else embedding
    return e.isNotNull() & (F.size(e) > 0) & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(e, lambda x: x != 0)


def _matrices(batch: pa.RecordBatch, at: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and vectors of a batch, for each length of vectors in it; column `at` holds them."""
    column = batch.column(at)
    sizes = np.diff(column.offsets.to_numpy())
    for length in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == length)
        yield rows, column.take(pa.array(rows)).flatten().to_numpy().reshape(len(rows), length)


KEY = "length int, tree int, cell bigint, part int"
#: A row holds a batch's rows of one part: their classes, strings and so on as arrays of bytes.
INDEX = f"{KEY}, cls binary, string binary, scale binary, body binary"
ASKED = f"{KEY}, asks binary, string binary, depth binary, least binary, body binary"
_KEYS = ["length", "tree", "cell", "part"]


def _spread(rows: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row number as often as it has parts, and the parts' numbers."""
    again = np.repeat(np.arange(len(rows)), parts)
    return rows[again], np.arange(len(again)) - np.repeat(np.cumsum(parts) - parts, parts)


def nearest(
    vectors: DataFrame, *, is_query: Column, vec_id: str = "vec_id", embedding: str = "embedding", k: int = 20, trees: int = 64, effort: float = 1.0, cell_rows: int = 4096, sample_rows: int = 8192
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest found of each query row among all other rows, ties to smaller ids.

    is_query is over vec_id. Rows without id or usable vector take no part; rows of one id count once, by the smallest of
    their vectors; vectors of another length than a query's aren't compared with it; long vectors only make wider rows.
    Fewer than k others: all of them. Other columns play no part; an empty table gives an empty table. The sample that
    lays out the forest has about sample_rows rows of a length at most; every row is indexed.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("embedding"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable("embedding")).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    # Zeros of either sign are one; rows meet by a hash of their vector and then by itself.
    rows = stored(rows.select("vec_id", F.transform("embedding", lambda x: F.when(x == 0, 0.0).otherwise(x)).alias("embedding")).withColumn("asks", is_query), "vectors")
    few = rows.withColumn("place", F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))).filter(F.col("place") <= k + 1)
    classes = few.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))  # k + 1 at most
    asking = rows.filter("asks").select("embedding").distinct().withColumn("asked", F.lit(True))
    classes = stored(classes.join(asking, "embedding", "left").select(F.monotonically_increasing_id().alias("cls"), "embedding", "ids", F.coalesce("asked", F.lit(False)).alias("asked")), "classes")
    norm = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x)
    lengths = {r.length: (r.n, r.most) for r in classes.groupBy(F.size("embedding").alias("length")).agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("most")).collect()}  # a row per length
    rate = F.create_map(*[x for length, (n, _) in lengths.items() for x in (F.lit(length), F.lit(min(1.0, sample_rows / n)))]) if lengths else F.create_map(F.lit(0), F.lit(0.0))
    pick = (F.pmod(F.xxhash64("embedding"), F.lit(1 << 30)) + 0.5) / (1 << 30)
    sampled: dict[int, list] = {}
    for r in classes.filter(pick < rate[F.size("embedding")]).select("embedding").toLocalIterator():
        sampled.setdefault(len(r.embedding), []).append(r.embedding)
    sent = spark.sparkContext.broadcast({n: np.array(x) for n, x in sampled.items()})
    made: dict[int, Sample] = {}

    def sample(length: int) -> Sample:
        if length not in made:
            n, most = lengths[length]
            some = sent.value.get(length, np.zeros((0, length)))
            made[length] = Sample(some, Hasher(length, trees, most), n, k, effort, cell_rows)
        return made[length]

    def packed(length: int, tree: int, cell: np.ndarray, part: np.ndarray, columns: list[np.ndarray], ddl: str) -> pa.RecordBatch:
        """A row for each cell and part, with the columns' values of its rows."""
        order = np.lexsort((part, cell))
        cell, part = cell[order], part[order]
        first = np.flatnonzero(np.concatenate(([True], (cell[1:] != cell[:-1]) | (part[1:] != part[:-1])))) if len(cell) else np.zeros(0, np.int64)
        ends, n = np.append(first[1:], len(cell)).tolist(), len(first)
        blobs = [pa.array([c[order[a:b]].tobytes() for a, b in zip(first.tolist(), ends, strict=True)], pa.binary()) for c in columns]
        keys = [pa.array(np.full(n, length, np.int32)), pa.array(np.full(n, tree, np.int32)), pa.array(cell[first].astype(np.int64)), pa.array(part[first].astype(np.int32))]
        return pa.RecordBatch.from_arrays([*keys, *blobs], names=[c.split()[0] for c in ddl.split(", ")])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, matrix in _matrices(batch, 1):
                its, cls = sample(matrix.shape[1]), batch.column(0).to_numpy()[some]
                strings = its.hasher(matrix)
                scale = np.abs(matrix).max(axis=1) / 127
                small = np.rint(matrix / scale[:, None]).astype(np.int8)
                for t in range(trees):
                    cell = its.cells(strings[t])
                    part = (cls * 2654435761 >> 7) % its.parts(t, cell)
                    yield packed(matrix.shape[1], t, cell, part, [cls, strings[t], scale.astype(np.float32), small], INDEX)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, matrix in _matrices(batch, 1):
                its, cls = sample(matrix.shape[1]), batch.column(0).to_numpy()[some]
                strings = its.hasher(matrix, queries=True)
                depth, least, body = its.depth(strings, matrix), its.reached_by(matrix, 6 * k), matrix.astype(np.float32)
                # Components as bytes are off by half a step, so scores by about this much.
                least = least - 6 * np.abs(its.vectors).max(initial=0.0) / 254 * np.sqrt((matrix**2).sum(axis=1))
                for t in range(trees):
                    # All cells under a prefix that is shorter than a cell's.
                    open_ = np.maximum(0, its.bits - depth)
                    at, more = _spread(np.arange(len(some)), np.left_shift(1, open_))
                    cell = (its.cells(strings[t])[at] >> open_[at] << open_[at]) + more
                    again, part = _spread(np.arange(len(at)), its.parts(t, cell))
                    at, cell = at[again], cell[again]
                    yield packed(matrix.shape[1], t, cell, part, [cls[at], strings[t][at], depth[at], least[at].astype(np.float32), body[at]], ASKED)

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        asks, found, rough = [], [], []
        if left.num_rows and right.num_rows:
            values = lambda t, c, kind: np.frombuffer(b"".join(t.column(c).to_pylist()), kind)
            length, strings = left.column("length")[0].as_py(), values(left, "string", np.uint32)
            order = np.argsort(strings, kind="stable")
            strings, cls = strings[order], values(left, "cls", np.int64)[order]
            body = values(left, "body", np.int8).reshape(-1, length)[order].astype(np.float32) * values(left, "scale", np.float32)[order][:, None]
            queries = values(right, "body", np.float32).reshape(-1, length)
            low, high = span(strings, values(right, "string", np.uint32), values(right, "depth", np.int64))
            least, own = values(right, "least", np.float32), values(right, "asks", np.int64)
            for q in np.flatnonzero(high > low).tolist():
                scores = body[low[q] : high[q]] @ queries[q]
                good = np.flatnonzero(scores >= least[q])
                if len(good) < 2:
                    good = np.argsort(-scores, kind="stable")[:2]
                if len(good) > 2 * k + 12:
                    good = good[np.argpartition(-scores[good], 2 * k + 11)[: 2 * k + 12]]
                asks.append(np.full(len(good), own[q]))
                found.append(cls[low[q] + good])
                rough.append(scores[good])
        join = lambda parts, kind: pa.array(np.concatenate(parts) if parts else [], kind)
        return pa.table({"asks": join(asks, pa.int64()), "cls": join(found, pa.int64()), "rough": join(rough, pa.float32())})

    indexed = classes.select("cls", "embedding").mapInArrow(index, INDEX)
    asked = classes.filter("asked").select("cls", "embedding").mapInArrow(ask, ASKED)
    pairs = indexed.groupBy(*_KEYS).cogroup(asked.groupBy(*_KEYS)).applyInArrow(search, "asks bigint, cls bigint, rough float")
    pairs = pairs.groupBy("asks", "cls").agg(F.max("rough").alias("rough"))
    best = F.row_number().over(Window.partitionBy("asks").orderBy(F.col("rough").desc(), "cls"))
    pairs = stored(pairs.withColumn("place", best).filter(F.col("place") <= 2 * k + 12).select("asks", "cls"), "pairs")
    score = F.aggregate(F.zip_with("a", "b", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    exact = pairs.join(classes.select("cls", F.col("embedding").alias("a"), "ids"), "cls").join(classes.select(F.col("cls").alias("asks"), F.col("embedding").alias("b")), "asks").select("asks", "ids", score.alias("score"))
    queries = rows.filter("asks").select(F.col("vec_id").alias("query_id"), "embedding").join(classes.filter("asked").select(F.col("cls").alias("asks"), "embedding"), "embedding").select("query_id", "asks")
    whole = exact.join(queries, "asks").select("query_id", F.explode("ids").alias("vec_id"), "score").filter("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return whole.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
