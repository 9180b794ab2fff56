"""A quality classifier: ordinal cumulative-link regression on graded ratings.

Grades are 0 (toxic), 1 (of low quality) and 2 (good). Features are hashed text: the words of a document and their first bytes, the shapes of
its tokens (letters folded, other characters kept), and tokens that repeat the one before; shapes and repeats come with
the share of the tokens that they make up. All grades share one weight per feature; ordered thresholds cut the score:
P(grade <= k) = logistic(threshold_k - score). The expected grade ranks documents and P(grade = 2) selects them.

The fit is on at most about `most_rows` rated documents, picked by a hash of their ids (the documented bound). Spark
counts their features; features that tell grades apart (by the z-score of their log odds) are kept, at most
`most_features` (the documented bound of the model). Features go by their 64-bit hashes, so nothing else shares their weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weavegraph.llm.common import annotate, slices, stored, struct_array
from weavegraph.llm.shingles import mix, word_and_start_hashes, word_hashes

GRADES = 3
#: Bytes of a word's start.
START = 5
#: Shares of a document's tokens at which a shape or the repeats count once more.
LEVELS = (0.0, 0.02, 0.1, 0.3)
#: A word's characters: digits, letters, and every byte of a non-ASCII character; the rest becomes a space.
WORDS = bytes(c if 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: Shapes: small letters and non-ASCII become a, capitals A, digits 0, white space a space; the rest stays.
SHAPES = bytes(97 if 97 <= c <= 122 or c >= 128 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else 32 if c in (9, 10, 11, 12, 13) else c for c in range(256))


def _fold(text: bytes) -> bytes:
    """The shape of a text: runs of one letter class become one letter."""
    code = np.frombuffer(text.translate(SHAPES), dtype=np.uint8)
    if not len(code):
        return b""
    plain = (code == 97) | (code == 65) | (code == 48)
    same = np.concatenate(([False], code[1:] == code[:-1])) & plain
    folded = code[~same].tobytes()
    return folded.replace(b"Aa", b"a")  # a capital at the start is no mark of quality


def _levels(document: np.ndarray, feature: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature at each level that its share reaches)."""
    if not len(document):
        return document, feature
    pair = np.stack((document.astype(np.uint64), feature), axis=1)
    unique, counts = np.unique(pair, axis=0, return_counts=True)
    owner = unique[:, 0].astype(np.int64)
    share = counts / size[owner]
    docs, keys = [], []
    for k, level in enumerate(LEVELS):
        reached = share > level
        docs.append(owner[reached])
        keys.append(mix(unique[reached, 1] + np.uint64(k + 1)))
    return np.concatenate(docs), np.concatenate(keys)


def features(texts: list[bytes], words_wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of text number and feature; of the features of words only the wanted, if given."""
    hashes, starts, counts = word_and_start_hashes([t.translate(WORDS) for t in texts], START)
    owner = np.tile(np.repeat(np.arange(len(texts)), counts), 2)
    hashes = np.concatenate((hashes, starts ^ np.uint64(0xA5A5)))
    if words_wanted is not None:
        wanted = words_wanted[np.minimum(np.searchsorted(words_wanted, hashes), max(0, len(words_wanted) - 1))] == hashes if len(words_wanted) else np.zeros(len(hashes), bool)
        hashes, owner = hashes[wanted], owner[wanted]
    shapes, n_shapes = word_hashes([_fold(t) for t in texts])
    shape_owner = np.repeat(np.arange(len(texts)), n_shapes)
    tokens, n_tokens = word_hashes(texts)
    token_owner = np.repeat(np.arange(len(texts)), n_tokens)
    again = np.flatnonzero((tokens[1:] == tokens[:-1]) & (token_owner[1:] == token_owner[:-1])) if len(tokens) else np.zeros(0, np.int64)
    size = np.maximum(n_tokens, 1)
    sd, sk = _levels(shape_owner, shapes ^ np.uint64(0x5A5A), size)
    rd, rk = _levels(token_owner[again], np.full(len(again), 7, np.uint64), size)
    docs, keys = np.concatenate((owner, sd, rd)), np.concatenate((hashes, sk, rk))
    order = np.lexsort((keys, docs))
    docs, keys = docs[order], keys[order]
    first = np.concatenate(([True], (docs[1:] != docs[:-1]) | (keys[1:] != keys[:-1]))) if len(docs) else np.zeros(0, bool)
    return docs[first], keys[first]


class Model:
    """Sorted feature hashes, their weights, and the ordered thresholds."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray, thresholds: np.ndarray):
        self.keys, self.weights, self.thresholds = keys, weights, thresholds

    def scores(self, texts: list[bytes]) -> np.ndarray:
        docs, found = features(texts, self.keys)
        if not len(self.keys) or not len(docs):
            return np.zeros(len(texts))
        place = np.minimum(np.searchsorted(self.keys, found), len(self.keys) - 1)
        return np.bincount(docs, weights=np.where(self.keys[place] == found, self.weights[place], 0.0), minlength=len(texts))

    def up_to(self, scores: np.ndarray) -> np.ndarray:
        """P(grade <= k) for all grades but the highest."""
        return 1 / (1 + np.exp(-np.clip(self.thresholds[None, :] - scores[:, None], -40, 40)))


def cumulative_link(rows: np.ndarray, columns: np.ndarray, n_columns: int, grades: np.ndarray, ridge: float = 0.05, rounds: int = 500, step: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds that fit the grades of binary features (row, column), by Adam on the penalised likelihood."""
    n = len(grades)
    share = np.clip(np.array([(grades <= k).mean() for k in range(GRADES - 1)]), 1e-3, 1 - 1e-3)
    start = np.log(share / (1 - share))
    value = np.concatenate((np.zeros(n_columns), [start[0]], [np.log(max(1e-2, start[1] - start[0]))]))
    first, second = np.zeros_like(value), np.zeros_like(value)
    for t in range(1, rounds + 1):
        cut = np.array([value[-2], value[-2] + np.exp(value[-1])])
        score = np.bincount(rows, weights=value[columns], minlength=n)
        p = 1 / (1 + np.exp(-np.clip(cut[None, :] - score[:, None], -40, 40)))
        low = np.where(grades == 0, 0.0, p[np.arange(n), np.maximum(grades - 1, 0)])
        high = np.where(grades == GRADES - 1, 1.0, p[np.arange(n), np.minimum(grades, GRADES - 2)])
        chance = np.maximum(high - low, 1e-12)
        d_high, d_low = np.where(grades == GRADES - 1, 0.0, high * (1 - high)) / chance, np.where(grades == 0, 0.0, low * (1 - low)) / chance
        by_score = -(d_high - d_low)  # of the log-likelihood
        to_cut = np.array([d_high[grades == 0].sum() - d_low[grades == 1].sum(), d_high[grades == 1].sum() - d_low[grades == 2].sum()])
        slope = np.concatenate((np.bincount(columns, weights=by_score[rows], minlength=n_columns) - ridge * value[:n_columns], [to_cut.sum()], [to_cut[1] * np.exp(value[-1])]))
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        value = value + step * (1 - 0.9 * t / rounds) * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-9)
    return value[:n_columns], np.array([value[-2], value[-2] + np.exp(value[-1])])


def ratings(labels: DataFrame, most_rows: int = 20_000) -> DataFrame:
    """rated_id and grade: about most_rows of the ratings at most, picked by a hash; a document's lowest grade counts.

    Toxic documents are of grade 0, others of their quality; ratings that are null or neither 0 nor 1 teach nothing.
    """
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)
    rated = labels.select(F.col("doc_id").alias("rated_id"), grade.alias("grade")).filter("grade is not null").groupBy("rated_id").agg(F.min("grade").alias("grade"))
    pick = (F.pmod(F.xxhash64("rated_id"), F.lit(1 << 30)) + 0.5) / (1 << 30)
    return rated.filter(pick < min(1.0, most_rows / max(1, rated.count())))


def graded(docs: DataFrame, rated: DataFrame) -> DataFrame:
    """doc_id, text and grade of the rated documents that have a text. rated is bounded by ratings(), so it is broadcast and
    the texts stay where they are; the sample itself is written once."""
    joined = docs.select("doc_id", "text").join(F.broadcast(rated), F.col("doc_id") == F.col("rated_id"))
    return stored(joined.filter("text is not null").select("doc_id", "text", "grade"), "rated")


def fit(sample: DataFrame, *, most_features: int = 4096, least_z: float = 3.3, least_docs: int = 3) -> Model:
    """A model of the rated sample (text, grade)."""
    sample = sample.select("grade", "text")
    totals = np.zeros(GRADES)
    for r in sample.groupBy("grade").count().collect():
        totals[r["grade"]] = r["count"]

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, 4 << 20):
                grade = part.column(0).to_numpy()
                docs, keys = features(part.column(1).cast(pa.binary()).to_pylist())
                unique, inverse = np.unique(keys, return_inverse=True)
                counts = [np.bincount(inverse[grade[docs] == g], minlength=len(unique)).astype(np.int64) for g in range(GRADES)]
                yield pa.RecordBatch.from_arrays([pa.array(unique.view(np.int64)), *map(pa.array, counts)], names=["key", "n0", "n1", "n2"])

    counts = sample.mapInArrow(tally, "key bigint, n0 bigint, n1 bigint, n2 bigint").groupBy("key").agg(*(F.sum(c).alias(c) for c in ("n0", "n1", "n2")))

    def z(inside: F.Column, outside: F.Column, n_in: float, n_out: float) -> F.Column:
        cells = [inside + 0.5, F.lit(n_in) - inside + 0.5, outside + 0.5, F.lit(n_out) - outside + 0.5]
        odds = F.log(cells[0] / cells[1]) - F.log(cells[2] / cells[3])
        return F.abs(odds) / F.sqrt(1 / cells[0] + 1 / cells[1] + 1 / cells[2] + 1 / cells[3])

    toxic = z(F.col("n0"), F.col("n1") + F.col("n2"), totals[0], totals[1] + totals[2])
    low = z(F.col("n1"), F.col("n2"), totals[1], totals[2])
    told = counts.filter(F.col("n0") + F.col("n1") + F.col("n2") >= least_docs).withColumn("z", F.greatest(toxic, low)).filter(F.col("z") >= least_z)
    keys = np.sort(np.array([r.key for r in told.orderBy(F.col("z").desc(), "key").limit(most_features).select("key").collect()], dtype=np.int64).view(np.uint64))
    if not len(keys) or (totals > 0).sum() < 2:
        share = np.cumsum(totals + 1)[: GRADES - 1] / (totals.sum() + GRADES)
        return Model(np.zeros(0, np.uint64), np.zeros(0), np.log(share / (1 - share)))
    sent = sample.sparkSession.sparkContext.broadcast(keys)

    def design(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = sent.value
        for batch in batches:
            for part in slices(batch, 1, 4 << 20):
                docs, found = features(part.column(1).cast(pa.binary()).to_pylist(), keys)
                place = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
                good = keys[place] == found
                size = np.bincount(docs[good], minlength=part.num_rows)
                offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(offsets, pa.array(place[good].astype(np.int32)))], names=["grade", "columns"])

    table = sample.mapInArrow(design, "grade int, columns array<int>").toArrow().combine_chunks()
    column = table.column("columns").combine_chunks()
    columns = column.flatten().to_numpy()
    rows = np.repeat(np.arange(len(column)), np.diff(column.offsets.to_numpy()))
    weights, thresholds = cumulative_link(rows, columns, len(keys), table.column("grade").to_numpy())
    return Model(keys, weights, thresholds)


def judge_quality(docs: DataFrame, model: Model, *, carry: list[str], into: str = "quality", text: str = "text", least_tail: float = 0.5) -> DataFrame:
    """The carried columns and a struct: score, p_toxic, p_low, p_good, expected_grade, grade, keep (p_good >= least_tail).

    Null and empty texts have no features and the grades' base rates; very long ones are judged whole; repeated rows are each judged; an empty table
    stays empty; a tie between grades goes to the lower; columns that aren't carried play no part.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def judge():
        def call(texts: pa.Array) -> pa.Array:
            model = sent.value
            score = model.scores([t or b"" for t in texts.cast(pa.binary()).to_pylist()])
            p = model.up_to(score)
            each = np.stack((p[:, 0], p[:, 1] - p[:, 0], 1 - p[:, 1]), axis=1)
            return struct_array(
                {"score": score, "p_toxic": each[:, 0], "p_low": each[:, 1], "p_good": each[:, 2], "expected_grade": each[:, 1] + 2 * each[:, 2], "grade": each.argmax(axis=1).astype(np.int32), "keep": each[:, 2] >= least_tail}
            )

        return call

    return annotate(docs, text, carry, into, "score double, p_toxic double, p_low double, p_good double, expected_grade double, grade int, keep boolean", judge, 4 << 20)


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All documents under a model of the rated ones: doc_id and the fields of judge_quality()."""
    found = judge_quality(docs, fit(graded(docs, ratings(labels))), carry=["doc_id"], into="q")
    return found.select("doc_id", "q.*")
