"""Language identification by inferring each document's mixture of languages.

Training counts hashed character n-grams (1 to 3 characters inside words) per language. A document's words are draws
from a mixture: a word's likelihood under a language is the product over its n-grams, tempered by the n-grams' overlap.
Expectation-maximisation over the words estimates the languages' shares. The languages are added in order of their
shares under all of them, and the set with the best penalised likelihood (BIC) stays. Where the best single language
beats what any larger set could reach under its penalty, no further fit is made.

The model is a table of 2**17 n-gram buckets by language. It is fitted on at most about `per_language` documents of a
language, picked by a hash of their ids, for at most `most_languages` languages (the documented bounds), and it is all
that is broadcast.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weavegraph.llm.common import annotate, free_name

BUCKETS = 1 << 17
RESULT = "lang_pred string, score double, n_words bigint, languages array<struct<lang:string,share:double>>"


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed n-grams of all words of the texts, the word of each n-gram, and the text of each word.

    Words are runs of letters; n-grams are taken from the lower-cased word with a space at both ends.
    """
    chars, own, word_of_text = _characters(texts)
    one, two, three = _keys(chars)
    same2, same3 = own[:-1] == own[1:], own[:-2] == own[2:]
    inner = chars != 32
    grams = np.concatenate((one[inner], two[same2], three[same3]))
    words = np.concatenate((own[inner], own[:-1][same2], own[:-2][same3]))
    return grams, words, word_of_text


def _keys(chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the one, two and three characters from each place on."""
    mix = np.uint64(0x9E3779B97F4A7C15)
    one = (chars + np.uint64(1)) * mix
    two = (one[:-1] ^ (chars[1:] + np.uint64(7))) * mix
    three = (two[:-1] ^ (chars[2:] + np.uint64(13))) * mix
    return tuple((x >> np.uint64(47)).astype(np.int64) for x in (one, two, three))


def _characters(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words one behind the other, each with a space at both ends; the word of each character; the text of each word."""
    nothing = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    lowered = [t.lower() for t in texts]
    joined = "\x00".join(lowered)
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if not len(code):
        return nothing
    letter = _letters(code)
    # By lengths, as a text may hold the separator.
    text = np.repeat(np.arange(len(lowered)), np.fromiter((len(t) + 1 for t in lowered), dtype=np.int64, count=len(lowered)))[:-1]
    begins = letter & ~np.concatenate(([False], letter[:-1]))
    word_of_text = text[begins]
    n_words = len(word_of_text)
    if not n_words:
        return nothing
    word = np.cumsum(begins)[letter] - 1
    size = np.bincount(word, minlength=n_words) + 2
    chars = np.full(int(size.sum()), 32, dtype=np.uint64)
    own = np.repeat(np.arange(n_words), size)
    at = np.arange(len(word)) + 2 * word + 1
    chars[at] = code[letter]
    return chars, own, word_of_text


_letter_table = np.zeros(0, dtype=bool)


def _letters(code: np.ndarray) -> np.ndarray:
    """Which code points are letters; the table for the basic plane is made once."""
    global _letter_table
    if not len(_letter_table):
        _letter_table = np.fromiter((chr(c).isalpha() for c in range(0x10000)), dtype=bool, count=0x10000)
    if code.max() < 0x10000:
        return _letter_table[code]
    high = np.fromiter((chr(c).isalpha() for c in code[code >= 0x10000].tolist()), dtype=bool)
    out = _letter_table[np.minimum(code, 0xFFFF)]
    out[code >= 0x10000] = high
    return out


class Model:
    """languages, and the log-probability of each bucket under each (buckets by languages)."""

    def __init__(self, languages: list[str], counts: np.ndarray, smoothing: float = 0.5):
        self.languages = languages
        share = (counts + smoothing) / (counts.sum(axis=0) + smoothing * len(counts))
        self.log = np.log(share).astype(np.float32)
        # A third of all n-grams are single letters.
        self.letter = np.log(3 * (counts.sum(axis=1) + smoothing) / (counts.sum() + smoothing * len(counts))).astype(np.float32)

    def background(self, texts: list[str]) -> np.ndarray:
        """Log-likelihood of each word under no language: n-grams of letters in any order, or else any bucket."""
        chars, own, word_of_text = _characters(texts)
        letter = np.where(chars != 32, self.letter[_keys(chars)[0]], np.log(0.2))  # every fifth place, about, is a space
        same2, same3 = own[:-1] == own[1:], own[:-2] == own[2:]
        inner = chars != 32
        free = np.concatenate((letter[inner], (letter[:-1] + letter[1:])[same2], (letter[:-2] + letter[1:-1] + letter[2:])[same3])) - np.log(3)
        words = np.concatenate((own[inner], own[:-1][same2], own[:-2][same3]))
        return np.bincount(words, weights=np.logaddexp(free, -np.log(BUCKETS)) - np.log(2), minlength=len(word_of_text))

    def learned(self, texts: list[str | None], rounds: int = 12, temper: float = 1 / 3) -> np.ndarray:
        """For each text, the share of its words that all learned languages together explain beside the background."""
        texts = [t or "" for t in texts]
        out = np.zeros(len(texts))
        grams, words, text_of = ngrams(texts)
        if not len(text_of) or not self.languages:
            return out
        n = len(text_of)
        like = [np.bincount(words, weights=self.log[grams, j], minlength=n) for j in range(len(self.languages))]
        like = np.stack([*like, self.background(texts)], axis=1) * temper
        docs, first, inverse = np.unique(text_of, return_index=True, return_inverse=True)
        top = like.max(axis=1, keepdims=True)
        shares, _ = self._fit(np.exp(like - top), top[:, 0], inverse, first, np.bincount(inverse).astype(np.float64), np.ones((len(docs), like.shape[1]), dtype=bool), rounds)
        out[docs] = shares[:, :-1].sum(axis=1)
        return out

    def judge(self, texts: list[str | None], rounds: int = 12, temper: float = 1 / 3) -> list[tuple[str, float, int, list[tuple[str, float]]]]:
        """For each text: language or und, score, words, and the chosen languages with their shares."""
        out = [("und", 0.0, 0, []) for _ in texts]
        grams, words, text_of = ngrams([t or "" for t in texts])
        if not len(text_of) or not self.languages:
            return out
        k, n = len(self.languages), len(text_of)
        like = np.stack([np.bincount(words, weights=self.log[grams, j], minlength=n) for j in range(k)], axis=1) * temper
        docs, first, inverse = np.unique(text_of, return_index=True, return_inverse=True)
        size = np.bincount(inverse).astype(np.float64)
        single = np.add.reduceat(like, first, axis=0)
        top = like.max(axis=1, keepdims=True)
        near = np.exp(like - top)
        shares, full = self._fit(near, top[:, 0], inverse, first, size, np.ones((len(docs), k), dtype=bool), rounds)
        order = np.argsort(-shares, axis=1, kind="stable")
        best = single.argmax(axis=1)
        penalty = 0.5 * np.log(np.maximum(size, 2.0)) + 2.0
        chosen = np.zeros((len(docs), k), dtype=bool)
        chosen[np.arange(len(docs)), best] = True
        value, mixture = single.max(axis=1) - penalty, chosen.astype(np.float64)
        for m in range(2, k + 1):
            open_ = np.flatnonzero(full + 1e-6 * np.abs(full) + 0.5 - m * penalty > value)
            if not len(open_):
                break
            allowed = np.zeros((len(open_), k), dtype=bool)
            np.put_along_axis(allowed, order[open_, :m], True, axis=1)
            pick = np.isin(inverse, open_)
            renamed = np.searchsorted(open_, inverse[pick])
            starts = np.flatnonzero(np.concatenate(([True], renamed[1:] != renamed[:-1])))
            fitted, likelihood = self._fit(near[pick], top[pick, 0], renamed, starts, size[open_], allowed, rounds)
            better = likelihood - m * penalty[open_] > value[open_]
            value[open_[better]] = (likelihood - m * penalty[open_])[better]
            mixture[open_[better]] = fitted[better]
        lead = mixture.argmax(axis=1)
        alone = (mixture > 0).sum(axis=1) == 1
        sure = 1 / np.exp(np.minimum(single - single.max(axis=1, keepdims=True), 0)).sum(axis=1)
        score = np.where(alone, sure, mixture.max(axis=1))
        for i, d in enumerate(docs.tolist()):
            some = sorted(((self.languages[j], float(mixture[i, j])) for j in np.flatnonzero(mixture[i] > 0)), key=lambda x: (-x[1], x[0]))
            out[d] = (self.languages[int(lead[i])], float(min(1.0, score[i])), int(size[i]), some)
        return out

    @staticmethod
    def _fit(near, top, owner, first, size, allowed, rounds):
        """Shares of the allowed languages in each document, and the documents' log-likelihood."""
        shares = allowed / allowed.sum(axis=1, keepdims=True)
        for _ in range(rounds):
            weight = near * shares[owner]
            total = weight.sum(axis=1, keepdims=True)
            total[total == 0] = 1e-300
            shares = np.add.reduceat(weight / total, first, axis=0) / size[:, None]
        total = np.maximum((near * shares[owner]).sum(axis=1), 1e-300)
        return shares, np.add.reduceat(np.log(total) + top, first)


def fit(docs: DataFrame, *, text: str = "text", lang: str = "lang", pick: Column, per_language: int = 8000, most_languages: int = 256) -> Model:
    """A model from the labelled rows; pick is a number from 0 to 1 by which they are sampled, the same for each run.

    Rows without text or language teach nothing; without any, the model knows no language and all is und. Of more than
    most_languages values of lang the most frequent are learned (a megabyte of the model each), ties by code point.
    """
    rows = docs.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"), pick.alias("pick")).filter("lang is not null and text is not null")
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "lang").limit(most_languages).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0)))
    rate = F.create_map(*[x for name in languages for x in (F.lit(name), F.lit(min(1.0, per_language / sizes[name])))])
    sample = rows.filter(F.col("pick") < rate[F.col("lang")]).select("lang", "text")

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            names = np.array(batch.column(0).to_pylist(), dtype=object)
            texts = batch.column(1).to_pylist()
            for name in sorted(set(names)):
                mine = [texts[i] for i in np.flatnonzero(names == name)]
                for start in range(0, len(mine), 200):
                    grams = ngrams(mine[start : start + 200])[0]
                    total[name] = total.get(name, 0) + np.bincount(grams, minlength=BUCKETS)
        # Sixteen pieces of the table, so that adding them up is spread.
        for name, counts in total.items():
            pieces = counts.reshape(16, -1).astype("<i8")
            yield pa.RecordBatch.from_arrays([pa.array([name] * 16), pa.array(range(16), pa.int32()), pa.array([p.tobytes() for p in pieces], pa.binary())], names=["lang", "piece", "counts"])

    def add(batches):
        total: dict[tuple[str, int], np.ndarray] = {}
        for batch in batches:
            for name, piece, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                total[name, piece] = total.get((name, piece), 0) + np.frombuffer(counts, "<i8")
        if total:
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in total]), pa.array([k[1] for k in total], pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())], names=["lang", "piece", "counts"])

    schema = "lang string, piece int, counts binary"
    summed = sample.mapInArrow(count, schema).repartition("lang", "piece").mapInArrow(add, schema)
    table = np.zeros((BUCKETS, len(languages)))
    step = BUCKETS // 16
    for r in summed.toLocalIterator():
        table[r.piece * step : (r.piece + 1) * step, languages.index(r.lang)] += np.frombuffer(bytes(r.counts), "<i8")
    return Model(languages, table)


def identify(docs: DataFrame, model: Model, *, carry: list[str], into: str = "language", text: str = "text") -> DataFrame:
    """The carried columns and a struct: lang_pred, score (0 to 1), n_words, languages (the chosen set with shares).

    A text that is null, empty or without letters is und with score 0; very long ones are judged whole. The score is the leading language's share, or,
    where one language is chosen alone, its probability among all. Ties go to the language first in code-point order.
    Repeated rows are each judged; an empty table stays empty; columns that aren't carried play no part.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def judge():
        def call(texts: pa.Array) -> pa.Array:
            made = sent.value.judge(texts.to_pylist())
            return pa.array([{"lang_pred": a, "score": b, "n_words": n, "languages": [{"lang": x, "share": y} for x, y in c]} for a, b, n, c in made], pa.struct(_fields))

        return call

    _fields = [("lang_pred", pa.string()), ("score", pa.float64()), ("n_words", pa.int64()), ("languages", pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())])))]
    return annotate(docs, text, carry, into, RESULT, judge, 1 << 19)


def fold(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """crc32 of doc_id as text, modulo the number of folds; a null doc_id is in fold 1."""
    return F.coalesce(F.crc32(F.col(f"`{doc_id}`").cast("string")) % folds, F.lit(1))


def fit_on_training_fold(docs: DataFrame, **options) -> Model:
    """The model of the contract: from rows whose fold isn't 0."""
    pick = (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) + 0.5) / (1 << 30)
    return fit(docs.filter(fold() != 0), pick=pick, **options)


def language_report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    found = identify(docs, fit_on_training_fold(docs), carry=["doc_id"], into="l")
    return found.select("doc_id", (fold() == 0).alias("held_out"), F.col("l.lang_pred").alias("lang_pred"), F.col("l.score").alias("score"), F.col("l.languages").alias("languages"))


def keep_known_languages(docs: DataFrame, least_share: float = 0.5) -> DataFrame:
    """Documents in learned languages, one or several: those without letters, or with most words in none of them, go."""
    into = free_name(docs, "language")
    sent = docs.sparkSession.sparkContext.broadcast(fit_on_training_fold(docs))

    def judge():
        def call(texts: pa.Array) -> pa.Array:
            return pa.StructArray.from_arrays([pa.array(sent.value.learned(texts.to_pylist()))], names=["learned"])

        return call

    found = annotate(docs, "text", docs.columns, into, "learned double", judge, 1 << 19)
    return found.filter((F.col(f"{into}.learned") > 0) & (F.col(f"{into}.learned") >= least_share)).drop(into)
