"""Hard-negative mining: exact integer inner products behind rotated one-bit codes.

A row's components become whole numbers. Its vector is rotated and kept as signs, one bit a component, with its alignment
to them: the factor by which the signs come nearest to the vector. What then remains is rotated and coded again, LEVELS
times, and the length of the last remainder is kept. A query's rotated components become PLANES-bit numbers, so that its
product with a code is a weighted sum of popcounts. Sum of the levels, times their alignments, is the estimate; the query's
rounding and the remainder, by Cauchy and Schwarz, bound how far off it can be, for certain and not merely with a
probability. Level by level, rows whose interval can't reach go; what survives all levels is scored with whole numbers.

Rows lie in blocks of about block_rows by a hash of their ids, anchors in parts of as many, and every part meets every
block in a task of its own, which keeps the few best of each anchor; the best of these are the anchor's. A first pass
finds positives, a second, which knows the positives' scores, the negatives.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weavegraph.llm.common import stored

LEVELS = 6
PLANES = 8
#: Room for the rounding of doubles, as a share of the two vectors' lengths.
ROUNDING = 1e-9


@functools.lru_cache(maxsize=4)
def rotations(length: int, levels: int, seed: int = 7) -> np.ndarray:
    """levels orthogonal matrices; the same everywhere."""
    rng = np.random.default_rng(seed)
    return np.stack([np.linalg.qr(rng.standard_normal((length, length)))[0] for _ in range(levels)])


def bits(signs: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    padded = np.zeros((len(signs), -(-signs.shape[1] // 64) * 64), dtype=bool)
    padded[:, : signs.shape[1]] = signs
    return np.packbits(padded, axis=1, bitorder="little").view("<u8")


class Codes:
    """The codes of some vectors: words by level, alignments by level, and the lengths of the remainders after each."""

    def __init__(self, vectors: np.ndarray, turns: np.ndarray):
        left = vectors.astype(np.float64)
        self.words, self.alignment, self.left = [], [], []
        for turn in turns:
            left = left @ turn
            sign = left > 0
            factor = np.abs(left).mean(axis=1)  # <left, signs> over <signs, signs>
            left = left - np.where(sign, 1.0, -1.0) * factor[:, None]
            self.words.append(bits(sign))
            self.alignment.append(factor)
            self.left.append(np.sqrt((left**2).sum(axis=1)))
        self.size = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))


class Query:
    """One anchor's rotated components as PLANES-bit numbers, plane by plane, and how far these are off in all."""

    def __init__(self, vector: np.ndarray, turns: np.ndarray):
        now = vector.astype(np.float64)
        self.size, self.planes, self.low, self.step, self.total, self.off = float(np.sqrt((now**2).sum())), [], [], [], [], []
        for turn in turns:
            now = now @ turn
            low = float(now.min())
            step = (float(now.max()) - low) / ((1 << PLANES) - 1) or 1.0
            number = np.rint((now - low) / step).astype(np.int64)
            near = low + step * number
            self.planes.append(bits(((number >> np.arange(PLANES)[:, None]) & 1).astype(bool)))
            self.low.append(low)
            self.step.append(step)
            self.total.append(float(near.sum()))
            self.off.append(float(np.abs(now - near).sum()))

    def product(self, level: int, words: np.ndarray) -> np.ndarray:
        """The rounded query's product with the signs of one level: popcounts, plane by plane."""
        count = lambda w: np.bitwise_count(w).sum(axis=1, dtype=np.int64)
        up = self.low[level] * count(words)
        weighted = np.zeros(len(words), dtype=np.int64)
        for j, plane in enumerate(self.planes[level]):
            weighted += count(words & plane) << j
        return 2 * (up + self.step[level] * weighted) - self.total[level]


def interval_search(codes: Codes, query: Query, rows: np.ndarray, floor: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """Those of the rows whose interval, level by level, floor() lets through.

    floor(low, high) tells for each row left, from the ends of its interval, whether it may still count.
    """
    estimate, off = np.zeros(len(rows)), np.zeros(len(rows))
    for level in range(len(codes.words)):
        if not len(rows):
            break
        factor = codes.alignment[level][rows]
        estimate = estimate + factor * query.product(level, codes.words[level][rows])
        off = off + factor * query.off[level]
        half = off + query.size * (codes.left[level][rows] + ROUNDING * codes.size[rows])
        keep = floor(estimate - half, estimate + half)
        rows, estimate, off = rows[keep], estimate[keep], off[keep]
    return rows


def reaches(k: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Rows that may be among the k best: k others aren't certainly better."""

    def floor(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return high >= np.partition(low, len(low) - k)[len(low) - k] if len(low) > k else np.ones(len(low), dtype=bool)

    return floor


def within(k: int, most: np.ndarray, share: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Rows that may be, for any of the scores `most`, among the k best of those from share % of it up to itself."""

    def floor(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        keep = np.zeros(len(low), dtype=bool)
        for p in most.tolist():
            may = (low <= p) & (100 * high >= share * p)
            sure = low[(high <= p) & (100 * low >= share * p)]
            if len(sure) > k:
                may &= high >= np.partition(sure, len(sure) - k)[len(sure) - k]
            keep |= may
        return keep

    return floor


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k first by score, ties by smaller id."""
    return np.lexsort((ids, -scores))[:k]


def whole_numbers(embedding: str, scale: int = 256) -> Column:
    """floor(scale * x) of every component, x as a double."""
    return F.transform(embedding, lambda x: F.floor(F.lit(scale) * x.cast("double")))


def _matrix(column: pa.ChunkedArray, kind=np.int64) -> np.ndarray:
    flat = column.combine_chunks()
    return np.asarray(flat.flatten(), dtype=kind).reshape(len(flat), -1) if len(flat) else np.zeros((0, 1), dtype=kind)


def _in_blocks(rows: DataFrame, asked: DataFrame, blocks: int, parts: int, search: Callable[[pa.Table, pa.Table], pa.Table], result: str) -> DataFrame:
    """search(block's rows, part's anchors) on every block of rows with every part of the anchors, both of one length."""
    keys, upto = ["length", "block", "part"], lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda df, name, n: df.withColumn(name, F.pmod(F.xxhash64("id"), F.lit(n)).cast("int"))
    left = dealt(rows, "block", blocks).withColumn("part", upto(parts))
    right = dealt(asked, "part", parts).withColumn("block", upto(blocks))
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, result)


def hard_negatives(
    vectors: DataFrame,
    *,
    is_anchor: Column,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str | Column = "label",
    positives: int = 5,
    negatives: int = 5,
    share: int = 80,
    block_rows: int = 8192,
    levels: int = LEVELS,
) -> DataFrame:
    """anchor_id, positive_id, positive_rank, rank, negative_id, positive_score, negative_score.

    An anchor's positives are its best `positives` other rows of its label, and of each the first `negatives` rows of other
    labels with share % of the positive's score or more and no more than it are returned; all where there are fewer. Scores
    are integer inner products of floor(256 x); ties go to the smaller id. is_anchor and label may be columns over vectors.

    Rows without id, label or vector, with an empty vector, or with a component that is null, not finite or so large that
    scores may not fit a long (beyond 148,000 for 64 components) take no part; zero vectors do, at a score of 0. Rows of one id count once, by the smallest label and vector.
    Vectors of another length than an anchor's aren't compared with it. Repeated vectors are ties; other columns play no
    part; no anchors, no positives or an empty table give no rows.
    """
    e = F.col(f"`{embedding}`")
    largest = F.sqrt(F.lit(2.0**63) / (100 * F.size(e))) / 256 - 1
    usable = e.isNotNull() & (F.size(e) > 0) & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) <= largest))
    named = (F.col(f"`{label}`") if isinstance(label, str) else label).cast("string")
    rows = vectors.select(F.col(f"`{vec_id}`").cast("bigint").alias("id"), named.alias("label"), F.when(usable, whole_numbers(f"`{embedding}`")).alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("asks"))
    rows = rows.filter("id is not null and label is not null and vector is not null")
    rows = rows.groupBy("id").agg(F.min(F.struct("label", "vector", "asks")).alias("r")).select("id", "r.*", F.size("r.vector").alias("length"))
    rows = stored(rows, "whole")
    n, asking = rows.agg(F.count("*"), F.count_if("asks")).first()
    blocks, parts = max(1, -(-n // block_rows)), max(1, -(-asking // block_rows))
    rows_in, anchors = rows.drop("asks"), stored(rows.filter("asks").drop("asks"), "anchors")

    def search(thresholds: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            asked, found, of, score = [], [], [], []
            if left.num_rows and right.num_rows:
                ids, labels, matrix = left.column("id").to_numpy(), np.array(left.column("label").to_pylist(), dtype=object), _matrix(left.column("vector"))
                turns = rotations(matrix.shape[1], levels)
                codes = Codes(matrix, turns)
                names, number = np.unique(labels, return_inverse=True)
                place = {n: i for i, n in enumerate(names.tolist())}
                own, own_labels, queries = right.column("id").to_pylist(), right.column("label").to_pylist(), _matrix(right.column("vector"))
                scores_of = right.column("scores").to_pylist() if thresholds else [None] * len(own)
                for anchor, mine, vector, upto in zip(own, own_labels, queries, scores_of, strict=True):
                    same, query = number == place.get(mine, -1), Query(vector, turns)
                    if thresholds:
                        marks = np.unique(np.array(upto, dtype=np.int64))
                        rest = interval_search(codes, query, np.flatnonzero(~same), within(negatives, marks, share))
                        exact = matrix[rest] @ vector
                        for mark in marks.tolist():
                            fits = np.flatnonzero((100 * exact <= 100 * mark) & (100 * exact >= share * mark))
                            first = fits[best(ids[rest[fits]], exact[fits], negatives)]
                            asked += [anchor] * len(first)
                            of += [mark] * len(first)
                            found += ids[rest[first]].tolist()
                            score += exact[first].tolist()
                    else:
                        rest = interval_search(codes, query, np.flatnonzero(same & (ids != anchor)), reaches(positives))
                        exact = matrix[rest] @ vector
                        first = best(ids[rest], exact, positives)
                        asked += [anchor] * len(first)
                        found += ids[rest[first]].tolist()
                        score += exact[first].tolist()
            table = {"anchor_id": pa.array(asked, pa.int64()), "id": pa.array(found, pa.int64()), "score": pa.array(score, pa.int64())}
            return pa.table(table | {"upto": pa.array(of, pa.int64())} if thresholds else table)

        return run

    first = lambda df, by, k, name: df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(F.col("score").desc(), "id"))).filter(F.col(name) <= k)
    near = _in_blocks(rows_in, anchors, blocks, parts, search(False), "anchor_id bigint, id bigint, score bigint")
    near = stored(first(near, ["anchor_id"], positives, "positive_rank"), "positives")
    marks = near.groupBy("anchor_id").agg(F.collect_set("score").alias("scores"))  # as many as positives
    far = _in_blocks(rows_in, anchors.join(marks, F.col("id") == F.col("anchor_id")).drop("anchor_id"), blocks, parts, search(True), "anchor_id bigint, id bigint, score bigint, upto bigint")
    far = first(far, ["anchor_id", "upto"], negatives, "rank").select("anchor_id", F.col("upto").alias("positive_score"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    near = near.select("anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), "positive_rank")
    return near.join(far, ["anchor_id", "positive_score"]).select("anchor_id", "positive_id", "positive_rank", "rank", "negative_id", "positive_score", "negative_score")


def survivors(vectors: np.ndarray, query: np.ndarray, k: int, levels: int = LEVELS) -> Iterator[int]:
    """How many of the vectors each level leaves for the k best of a query: what the codes save."""
    turns = rotations(vectors.shape[1], levels)
    codes, asked = Codes(vectors, turns), Query(query, turns)
    for level in range(1, levels + 1):
        some = Codes.__new__(Codes)
        some.words, some.alignment, some.left, some.size = codes.words[:level], codes.alignment, codes.left, codes.size
        yield len(interval_search(some, asked, np.arange(len(vectors)), reaches(k)))


NEGATIVES_SQL = """
with r as (select vec_id as id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings where label is not null and embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.id as a, b.id as b, a.label = b.label as same, list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2]))::bigint as score from r a join r b on a.id % 100 = 0 and a.id <> b.id and len(a.v) = len(b.v)),
p as (select a, b, score from s where same qualify row_number() over (partition by a order by score desc, b) <= 5)
select p.a as anchor_id, p.b as positive_id, row_number() over (partition by p.a, p.b order by s.score desc, s.b)::int as rank, s.b as negative_id, p.score as positive_score, s.score as negative_score
from p join s on s.a = p.a and not s.same and 80 * p.score <= 100 * s.score and 100 * s.score <= 100 * p.score
qualify row_number() over (partition by p.a, p.b order by s.score desc, s.b) <= 5
"""
