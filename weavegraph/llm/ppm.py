"""Scoring text with prediction by partial matching over bytes, beside a word baseline.

What is scored is a text's words, A-Z lower-cased and one space apart, and its end: the same tokens as the baseline's.
The model is a trie of byte contexts of up to ORDER bytes. A byte is predicted in the longest known context; if it was
never seen there, an escape (method D: half a count of each distinct byte of the context) leads to the next shorter one, where
the bytes of the longer context are excluded, and so on down to all 256 bytes and the end of text. Contexts are nested,
so what a level has to exclude is known per context of the level above, and whole texts are scored as arrays.

The trie comes from all training texts and is whole. Documents are cut into chunks, and a chunk's distinct grams, with their
counts in training texts, are dealt to buckets by the last NEAR bytes of their contexts. So a bucket holds all chunks'
counts of its part of the trie, for all contexts of NEAR bytes and more, and answers for every gram of every chunk in one
task; contexts of fewer bytes are a table that bytes bound, which is broadcast. The answers go back to their chunks, where
whole texts are summed as arrays. A gram goes through the shuffle once per chunk, however often it occurs; sorted grams
and counts travel as compressed columns. Words for the baseline are dealt, counted and answered in the same way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from weavegraph.llm.common import slices, stored
from weavegraph.llm.langid import fold
from weavegraph.llm.shingles import FOLD, mix, word_hashes

ORDER = 6
#: Grams are dealt by so many bytes of their contexts, the last ones.
NEAR = 3
#: Bytes of text in a chunk, about.
CHUNK = 32 << 20
#: Bytes that no UTF-8 text has: before the text, and its end.
START, END = 0xFE, 0xFF
SYMBOLS = 257


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The (ORDER+1)-gram that ends at each byte and at the end of each text, and each text's number of them."""
    pad = bytes([START]) * ORDER
    code = np.frombuffer(pad + (bytes([END]) + pad).join(texts) + bytes([END]), dtype=np.uint8).astype(np.uint64)
    packed = np.zeros(len(code) - ORDER, dtype=np.uint64)
    for i in range(ORDER + 1):
        packed = (packed << np.uint64(8)) | code[i : len(code) - ORDER + i]
    keep = np.ones(len(packed), dtype=bool)
    size = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    ends = np.cumsum(size + ORDER) - ORDER
    for i in range(ORDER):  # those that end in the padding of the next text
        keep[ends[:-1] + i] = False
    return packed[keep], size


def normal(texts: pa.Array) -> list[bytes]:
    """The words of each text, A-Z lower-cased, with one space between them (null: empty)."""
    return [b" ".join(t.translate(FOLD).split()) if t else b"" for t in texts.cast(pa.binary()).to_pylist()]


class Lookup:
    """Places of keys in a sorted array, by an open hash table."""

    def __init__(self, keys: np.ndarray):
        self.shift = np.uint64(64 - max(4, int(len(keys) * 3).bit_length()))
        self.slots = np.full(1 << (64 - int(self.shift)), -1, dtype=np.int32)
        self.keys, self.mask = keys, len(self.slots) - 1
        left = np.arange(len(keys), dtype=np.int32)
        at = self._home(keys)
        while len(left):
            free = self.slots[at] < 0
            self.slots[at[free]] = left[free]
            lost = self.slots[at] != left
            left, at = left[lost], (at[lost] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key, or -1."""
        if not len(self.keys):
            return np.full(len(keys), -1, dtype=np.int64)
        at = self._home(keys)
        found = self.slots[at].astype(np.int64)
        bad = np.flatnonzero((found >= 0) & (self.keys[found] != keys))
        at = at[bad]
        while len(bad):
            at = (at + 1) & self.mask
            got = self.slots[at].astype(np.int64)
            found[bad] = got
            on = (got >= 0) & (self.keys[got] != keys[bad])
            bad, at = bad[on], at[on]
        return found


class Trie:
    """The model in memory. levels[k]: sorted grams of k context bytes and a symbol, and their counts."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray]]):
        self.levels = levels

    def prepare(self) -> None:
        """Totals, distinct symbols, and what each context excludes from the next shorter one."""
        self.find_gram, self.find_context, self.count, self.total, self.distinct, self.taken = [], [], [], [], [], []
        for k, (keys, counts) in enumerate(self.levels):
            context, first = np.unique(keys >> np.uint64(8), return_index=True)
            self.find_gram.append(Lookup(keys))
            self.find_context.append(Lookup(context))
            self.count.append(counts.astype(np.float64))
            some = len(keys) > 0
            self.total.append(np.add.reduceat(counts.astype(np.float64), first) if some else np.zeros(0))
            self.distinct.append(np.diff(np.append(first, len(keys))).astype(np.float64))
            if k and some:
                shorter = self.find_gram[k - 1](keys & np.uint64((1 << 8 * k) - 1))
                self.taken.append(np.add.reduceat(self.count[k - 1][shorter], first))
            else:
                self.taken.append(np.zeros(len(context)))

    def log10(self, packed: np.ndarray) -> np.ndarray:
        """log10 probability of the last symbol of each gram."""
        out, left = np.zeros(len(packed)), np.arange(len(packed))
        above = np.full(len(packed), -1, dtype=np.int64)  # the context of the level above, if known
        for k in range(ORDER, -1, -1):
            gram = packed[left] & np.uint64((1 << 8 * (k + 1)) - 1)
            place = self.find_gram[k](gram)
            context = self.find_context[k](gram >> np.uint64(8))
            known = context >= 0
            total, distinct = self.total[k][context] if len(self.total[k]) else np.zeros(len(left)), self.distinct[k][context] if len(self.distinct[k]) else np.zeros(len(left))
            if k < ORDER:
                excludes = above >= 0
                total = np.where(excludes, total - (self.taken[k + 1][above] if len(self.taken[k + 1]) else 0), total)
                distinct = np.where(excludes, distinct - (self.distinct[k + 1][above] if len(self.distinct[k + 1]) else 0), distinct)
            hit = place >= 0
            out[left[hit]] += np.log10((self.count[k][place[hit]] - 0.5) / total[hit])
            missed = known & ~hit & (distinct > 0)
            out[left[missed]] += np.log10(0.5 * distinct[missed] / total[missed])
            left, above = left[~hit], context[~hit]
        if len(left):
            out[left] -= np.log10(SYMBOLS - (self.distinct[0][0] if len(self.distinct[0]) else 0))
        return out

    def score(self, texts: list[bytes]) -> np.ndarray:
        """log10 probability of each whole text, its end included."""
        packed, size = grams(texts)
        return np.add.reduceat(self.log10(packed), np.cumsum(size) - size)


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts; sorted parts are merged rather than sorted anew."""
    key, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(n, first) if len(key) else n


def gram_blocks(texts: list[bytes], most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """grams() in blocks of at most `most` places, however long a text is: the grams, and the number of the text of each."""
    pad = bytes([START]) * ORDER
    code = np.frombuffer(pad + (bytes([END]) + pad).join(texts) + bytes([END]), dtype=np.uint8)
    size = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    begin = np.cumsum(size + ORDER) - size - ORDER  # of each text's places in code, less the padding before it
    for start in range(0, len(code) - ORDER, most):
        held = code[start : start + most + ORDER].astype(np.uint64)
        packed = np.zeros(len(held) - ORDER, dtype=np.uint64)
        for i in range(ORDER + 1):
            packed = (packed << np.uint64(8)) | held[i : len(held) - ORDER + i]
        place = np.arange(start, start + len(packed))
        text = np.searchsorted(begin, place, side="right") - 1
        keep = place - begin[text] < size[text]  # others end in the padding of the next text
        yield packed[keep], text[keep]


def squeezed(values: np.ndarray) -> bytes:
    """64-bit numbers as bytes, all first bytes before all second ones, and compressed."""
    return pa.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes(), codec="zstd", asbytes=True)


def unsqueezed(blob: bytes, n: int, kind: type) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(blob, decompressed_size=8 * n, codec="zstd"), dtype=np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def dealt(kind: int, keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The keys in order of their buckets, the buckets that have any, and where each begins (one more for the end).

    Grams go by the last NEAR bytes of their context, so all longer contexts of a gram are in its bucket; words by their hash.
    """
    its = mix((keys >> np.uint64(8)) & np.uint64((1 << 8 * NEAR) - 1)) if kind == GRAMS else keys
    bucket = ((its >> np.uint64(32)) % np.uint64(buckets)).astype(np.uint16)
    order = np.argsort(bucket, kind="stable")
    some, first = np.unique(bucket[order], return_index=True)
    return order, some.astype(np.int64), np.append(first, len(keys))


class Tally:
    """The distinct keys of some texts, with their counts in those to learn from."""

    def __init__(self) -> None:
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.held = 0

    def add(self, keys: np.ndarray, learn: np.ndarray) -> None:
        for its, weight in ((keys[learn], 1), (keys[~learn], 0)):
            if len(its):
                unique, counts = np.unique(its, return_counts=True)
                self.keys.append(unique)
                self.counts.append(counts * weight)
                self.held += len(unique)
        if self.held > 2_500_000:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted keys and their counts."""
        if len(self.keys) != 1:
            keys, counts = _summed(self.keys, self.counts) if self.keys else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            self.keys, self.counts, self.held = [keys], [counts], 0
        return self.keys[0], self.counts[0]


GRAMS, WORDS, LOW, TEXTS = range(4)
CUT = "chunk bigint, bucket int, n bigint, keys binary, counts binary, doc_ids array<bigint>, held_out array<boolean>, sizes array<bigint>, kind int"
ANSWER = "chunk bigint, kind int, bucket int, n bigint, keys binary, seen binary, total binary, rest binary, whole bigint"


def cut(docs: DataFrame, buckets: int, chunk_bytes: int) -> DataFrame:
    """The documents (doc_id, held_out, text) in chunks of about chunk_bytes, each with its distinct grams and words.

    Of kind TEXTS: a row for some documents, n of them to learn from, keys their compressed texts. GRAMS and WORDS: a row
    per chunk and bucket with n keys, sorted, and their counts. LOW: a row per chunk, the grams of two context bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk, held, tallies = TaskContext.get().partitionId() << 32, 0, (Tally(), Tally())

        def row(kind: int, bucket: int | None, n: int, keys: bytes, counts: bytes | None, of: tuple = (None, None, None)) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((chunk, bucket, n, keys, counts, *of, kind), fields, strict=True)], schema=fields)

        def asked() -> Iterator[pa.RecordBatch]:
            for kind, tally in enumerate(tallies):
                keys, counts = tally.merge()
                order, some, first = dealt(kind, keys, buckets)
                sorted_keys, sorted_counts = keys[order], counts[order]
                for b, i, j in zip(some.tolist(), first[:-1].tolist(), first[1:].tolist(), strict=True):
                    yield row(kind, b, j - i, squeezed(sorted_keys[i:j]), squeezed(sorted_counts[i:j]))
            keys, counts = tallies[GRAMS].merge()
            some = counts > 0
            if some.any():
                keys, counts = _summed([keys[some] & np.uint64((1 << 8 * NEAR) - 1)], [counts[some]])
                yield row(LOW, None, len(keys), squeezed(keys), squeezed(counts))

        for batch in batches:
            for part in slices(batch, 2, 1 << 20):
                texts, out = normal(part.column(2)), part.column(1).to_numpy(zero_copy_only=False).astype(bool)
                blob = b"".join(texts)
                held += len(blob) + len(texts)
                of = (part.column(0).to_pylist(), out.tolist(), [len(t) for t in texts])
                yield row(TEXTS, None, int((~out).sum()), pa.compress(blob, codec="zstd", asbytes=True), None, of)
                for packed, text in gram_blocks(texts):
                    tallies[GRAMS].add(packed, ~out[text])
                hashes, counts = word_hashes(texts)
                tallies[WORDS].add(hashes, np.repeat(~out, counts))
                if held > chunk_bytes:
                    yield from asked()
                    chunk, held, tallies = chunk + 1, 0, (Tally(), Tally())
        if held:
            yield from asked()

    fields = to_arrow_schema(T.StructType.fromDDL(CUT))
    return docs.select("doc_id", "held_out", "text").mapInArrow(run, CUT)


def low_levels(cut_rows: DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
    """The trie's levels of up to two context bytes: 257 * 65,536 grams at most, so they may go through the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = [], []
        for batch in batches:
            for n, k, c in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                keys.append(unsqueezed(k, n, np.uint64))
                counts.append(unsqueezed(c, n, np.int64))
            if len(keys) > 256:
                keys, counts = map(lambda x: [x], _summed(keys, counts))
        if keys:
            gram, n = _summed(keys, counts)
            yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(n)], names=["gram", "n"])

    rows = cut_rows.filter(F.col("kind") == LOW).select("n", "keys", "counts").mapInArrow(run, "gram bigint, n bigint")
    table = rows.groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    longest = _summed([table.column("gram").to_numpy().view(np.uint64)], [table.column("n").to_numpy()])
    return shorter_levels(longest, NEAR - 1, 0)


def shorter_levels(longest: tuple[np.ndarray, np.ndarray], order: int, least: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Levels least to order, out of the grams of `order` context bytes."""
    levels = [longest]
    for k in range(order, least, -1):
        keys, counts = levels[-1]
        levels.append(_summed([keys & np.uint64((1 << 8 * k) - 1)], [counts]))
    return levels[::-1]


def answers(cut_rows: DataFrame, low: list[tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """For each row of GRAMS and WORDS, what the model says of its keys; and, as chunk -1, a row per bucket of words: n distinct ones, whole all.

    A bucket's task merges the chunks' counts into its part of the trie, whole for all contexts of NEAR bytes and more;
    shorter contexts come with `low`. seen and total: count of a key, and of all that follow its context (grams); rest:
    the log10 probability of grams that were never seen, along their escapes.
    """
    sent = cut_rows.sparkSession.sparkContext.broadcast(low)

    def run(group: pa.Table) -> pa.Table:
        kind, bucket = group.column("kind")[0].as_py(), group.column("bucket")[0].as_py()
        size = group.column("n").to_pylist()
        ends = np.cumsum(size)
        keys = np.concatenate([unsqueezed(k, n, np.uint64) for k, n in zip(group.column("keys").to_pylist(), size, strict=True)])
        counts = np.concatenate([unsqueezed(c, n, np.int64) for c, n in zip(group.column("counts").to_pylist(), size, strict=True)])
        learnt = counts > 0
        model = _summed([keys[learnt]], [counts[learnt]])
        seen, total, rest = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64), np.zeros(0)
        if kind == WORDS:
            place = Lookup(model[0])(keys)
            seen[place >= 0] = model[1][place[place >= 0]]
        else:
            trie = Trie([*sent.value, *shorter_levels(model, ORDER, NEAR)])
            trie.prepare()
            place = trie.find_gram[ORDER](keys)
            known = place >= 0
            seen[known] = model[1][place[known]]
            total[known] = trie.total[ORDER][trie.find_context[ORDER](keys[known] >> np.uint64(8))]
            rest = trie.log10(keys[~known])
        before = np.concatenate(([0], np.cumsum(seen == 0)))
        rows = {"chunk": group.column("chunk").to_pylist(), "keys": group.column("keys").to_pylist(), "seen": [], "total": [], "rest": [], "whole": [None] * len(size)}
        for i, j in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
            rows["seen"].append(squeezed(seen[i:j]))
            rows["total"].append(squeezed(total[i:j]) if kind == GRAMS else None)
            rows["rest"].append(rest[before[i] : before[j]].tobytes() if kind == GRAMS else None)
        if kind == WORDS:
            for c, v in (("chunk", -1), ("keys", None), ("seen", None), ("total", None), ("rest", None), ("whole", int(model[1].sum()))):
                rows[c].append(v)
            size = [*size, len(model[0])]
        rows |= {"kind": [kind] * len(size), "bucket": [bucket] * len(size), "n": size}
        return pa.table([pa.array(rows[f.name], f.type) for f in fields], schema=fields)

    fields = to_arrow_schema(T.StructType.fromDDL(ANSWER))
    asked = cut_rows.filter(F.col("kind").isin(GRAMS, WORDS)).select("kind", "bucket", "chunk", "n", "keys", "counts")
    return asked.groupBy("kind", "bucket").applyInArrow(run, ANSWER)


SCORE = "doc_id bigint, held_out boolean, n_tokens bigint, known bigint, base double, score double"


def add_up(cut_rows: DataFrame, answered: DataFrame) -> DataFrame:
    """Each document's sums over the answers to its chunk, which come with their keys."""

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        all_texts = []
        for blob, sizes in zip(texts.column("keys").to_pylist(), texts.column("sizes").to_pylist(), strict=True):
            joined, upto = pa.decompress(blob, decompressed_size=sum(sizes), codec="zstd", asbytes=True), np.cumsum(sizes).tolist()
            all_texts.append([joined[b - n : b] for b, n in zip(upto, sizes, strict=True)])
        find, values = [], []
        for kind in (GRAMS, WORDS):
            its = answers.filter(pc.equal(answers.column("kind"), kind))

            def whole(column: str, like: type, its: pa.Table = its) -> np.ndarray:
                parts = [unsqueezed(x, n, like) for x, n in zip(its.column(column).to_pylist(), its.column("n").to_pylist(), strict=True)]
                return np.concatenate(parts) if parts else np.zeros(0, like)

            seen = whole("seen", np.int64)
            find.append(Lookup(whole("keys", np.uint64)))
            if kind == GRAMS:
                total = whole("total", np.int64)
                logs = np.log10((np.maximum(seen, 1) - 0.5) / np.maximum(total, 1))
                logs[seen == 0] = np.concatenate([np.frombuffer(x) for x in its.column("rest").to_pylist()])
                values.append(logs)
            else:
                values.append(seen)
        n_tokens, known, base, score = [], [], [], []
        for its in all_texts:
            hashes, counts = word_hashes(its)
            owner, c = np.repeat(np.arange(len(its)), counts), values[WORDS][find[WORDS](hashes)] if len(hashes) else np.zeros(0, np.int64)
            n_tokens.append(counts + 1)
            known.append(np.bincount(owner, weights=c > 0, minlength=len(its)).astype(np.int64))
            base.append(np.bincount(owner, weights=np.log10(c + 0.1), minlength=len(its)))
            sums = np.zeros(len(its))
            for packed, text in gram_blocks(its):
                sums += np.bincount(text, weights=values[GRAMS][find[GRAMS](packed)], minlength=len(its))
            score.append(sums)
        flat = lambda c: [x for its in texts.column(c).to_pylist() for x in its]
        columns = [flat("doc_ids"), flat("held_out"), *(np.concatenate(x) for x in (n_tokens, known, base, score))]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], schema=fields)

    fields = to_arrow_schema(T.StructType.fromDDL(SCORE))
    texts = cut_rows.filter(F.col("kind") == TEXTS).select("chunk", "keys", "doc_ids", "held_out", "sizes")
    its = answered.filter("chunk >= 0").select("chunk", "kind", "n", "keys", "seen", "total", "rest")
    return texts.groupBy("chunk").cogroup(its.groupBy("chunk")).applyInArrow(run, SCORE)


def score_documents(docs: DataFrame, *, chunk_bytes: int = CHUNK, buckets: int | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, score_per_token of every row of docs (doc_id, held_out, text).

    The model learns from all rows that aren't held out. score is the log10 probability of the text and its end under the
    trie, base_score that of its words and the end by smoothed counts. Null and empty texts have the end alone; texts of
    any length are scored whole, in blocks. Repeated rows each teach and are each scored, ties play no part; without rows
    to learn from every byte costs log10 257, and base_score follows its formula with counts of 0. Words meet by 64-bit
    hashes. Other columns play no part, whatever they are called. An empty table stays empty.
    """
    if buckets is None:
        # As many buckets as chunks, about, so that neither a bucket's rows nor a chunk's grow fast.
        held = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        buckets = int(min(50_000, max(64, (held >> 14) ** 0.5)))
    rows = stored(cut(docs, buckets, chunk_bytes), "ppm-cut", "kind")
    answered = stored(answers(rows, low_levels(rows)), "ppm-answers")
    n_train = rows.filter(F.col("kind") == TEXTS).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    words = answered.filter("chunk < 0").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("v"), F.coalesce(F.sum("whole"), F.lit(0)).alias("n")).first()
    train_tokens, distinct = words.n + n_train, words.v + (n_train > 0)
    log_all, end = float(np.log10(train_tokens + 0.1 * (distinct + 1))), float(np.log10(n_train + 0.1))
    return add_up(rows, answered).select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + int(n_train > 0)).alias("n_known"),
        F.lit(train_tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + end - F.col("n_tokens") * log_all).alias("base_score"),
        "score",
        (F.col("score") / F.col("n_tokens")).alias("score_per_token"),
    )


def score_report(docs: DataFrame, **options) -> DataFrame:
    """All documents, learned from those whose fold of ten isn't 0."""
    return score_documents(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), (fold("doc_id", 10) == 0).alias("held_out"), "text"), **options)
