"""Benchmark decontamination: an FM-index per training shard, searched for every benchmark window.

A shard is a slice of whole documents inside one task. Only words of the benchmark can take part in a match, so the
shard's index holds the stretches of benchmark words that are long enough for the shortest window; every other word
is a separator. That is an exact reduction: an occurrence lies inside one such stretch. The index is a wavelet matrix
over the Burrows-Wheeler transform with sampled suffix positions. All windows of equal length are searched backwards
together, occurrences are located by walking to a sampled position, and overlapping ones merge into removal spans.

The benchmark goes to the tasks in blocks of at most `block_words` words (a proven bound for what is broadcast). With
one block, the documents are read once and nothing is shuffled; with more, each block is a pass of its own and the
spans and items of the passes are merged per document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weavegraph.llm.common import annotate, free_name, stored, struct_array

#: Bytes of words: 0-9, a-z after lower-casing A-Z, and every byte of a non-ASCII character; others become spaces.
WORD_BYTES = bytes((c + 32 if 65 <= c <= 90 else c) if 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
RESULT = "n_words bigint, n_hit bigint, items array<bigint>, spans array<struct<start:bigint,end:bigint>>"


def words(text: str | bytes | None) -> list[bytes]:
    """The words of a text: A-Z lower-cased, split at ASCII characters other than letters and digits."""
    if text is None:
        return []
    raw = text if isinstance(text, bytes) else text.encode("utf-8", "surrogatepass")
    return raw.translate(WORD_BYTES).split()


class Windows:
    """The distinct windows of a block of items: their words, by length, and the items of each."""

    def __init__(self, items: list[tuple[int, list[bytes]]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        found: dict[tuple[int, ...], list[int]] = {}
        for item, its in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 2) for w in its]
            for i in range(max(1, len(ids) - window + 1)) if ids else ():
                found.setdefault(tuple(ids[i : i + window]), []).append(item)
        keys = sorted(found, key=lambda k: (len(k), k))
        self.items = [np.array(sorted(set(found[k])), dtype=np.int64) for k in keys]
        self.by_length: list[tuple[int, np.ndarray]] = []  # (first window's number, words)
        for length in sorted({len(k) for k in keys}):
            rows = [i for i, k in enumerate(keys) if len(k) == length]
            self.by_length.append((rows[0], np.array([keys[i] for i in rows], dtype=np.int64)))
        self.shortest = min((len(k) for k in keys), default=0)


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Prefix doubling; the last symbol is the smallest and occurs once."""
    n, rank, h = len(symbols), symbols.astype(np.int64), 1
    while True:
        key = rank * (max(n, int(rank.max()) + 1) + 1)
        key[: n - h] += rank[h:] + 1
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        if rank[order[-1]] == n - 1:
            return order
        h *= 2


class FmIndex:
    """Symbols 0 (end), 1 (separator) and words from 2, with rank by a wavelet matrix and every `step`-th position kept."""

    def __init__(self, symbols: np.ndarray, size: int, step: int = 8):
        order = suffix_array(symbols)
        self.bwt = symbols[order - 1]
        self.first = np.concatenate(([0], np.cumsum(np.bincount(symbols, minlength=size))))[:-1]
        self.levels: list[tuple[int, int, np.ndarray]] = []
        now = self.bwt
        for shift in range(max(1, int(size - 1).bit_length()) - 1, -1, -1):
            bit = (now >> shift) & 1
            ones = np.concatenate(([0], np.cumsum(bit, dtype=np.int32)))
            self.levels.append((shift, len(now) - int(ones[-1]), ones))
            now = np.concatenate((now[bit == 0], now[bit == 1]))
        self.start = self.descend(np.arange(size), np.zeros(size, dtype=np.int64))
        kept = order % step == 0
        self.kept, self.kept_rank, self.position = kept, np.cumsum(kept) - 1, order[kept]

    def descend(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        for shift, zeros, ones in self.levels:
            one = ones[row]
            row = np.where((symbol >> shift) & 1, zeros + one, row - one)
        return row

    def before(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Where the rows that start with symbol and then go on as the first `row` rows do end."""
        return self.first[symbol] + self.descend(symbol, row) - self.start[symbol]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of the patterns (rows of equal length) that occur, with their first and last+1 rows."""
        live = np.arange(len(patterns))
        low, high = np.zeros(len(live), dtype=np.int64), np.full(len(live), len(self.bwt), dtype=np.int64)
        for j in range(patterns.shape[1] - 1, -1, -1):
            symbol = patterns[live, j]
            low, high = self.before(symbol, low), self.before(symbol, high)
            some = low < high
            live, low, high = live[some], low[some], high[some]
        return live, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        found, steps = np.empty(len(rows), dtype=np.int64), 0
        left = np.arange(len(rows))
        while len(left):
            done = self.kept[rows]
            found[left[done]] = self.position[self.kept_rank[rows[done]]] + steps
            left, rows = left[~done], rows[~done]
            rows = self.before(self.bwt[rows], rows)
            steps += 1
        return found


def scan(texts: list[bytes | None], windows: Windows) -> dict[str, list]:
    """n_words, n_hit, items and spans of each text of a shard."""
    ids, lengths = [], []
    for t in texts:
        its = words(t)
        lengths.append(len(its))
        ids.append(np.fromiter(map(windows.vocabulary.get, its, [1] * len(its)), dtype=np.int64, count=len(its)))
        ids.append(np.ones(1, dtype=np.int64))
    n_hit, items, spans = [0] * len(texts), [[] for _ in texts], [[] for _ in texts]
    symbols = np.concatenate(ids) if ids else np.ones(0, dtype=np.int64)
    inside = np.concatenate(([False], symbols > 1, [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    begin, end = edges[::2], edges[1::2]
    long = end - begin >= max(1, windows.shortest)
    begin, end = begin[long], end[long]
    if not windows.by_length or not len(begin):
        return {"n_words": lengths, "n_hit": n_hit, "items": items, "spans": spans}
    change = np.zeros(len(symbols) + 1, dtype=np.int8)
    change[begin], change[end] = 1, -1
    taken = np.cumsum(change)[:-1].astype(bool)
    taken[end] = True  # the separator behind each stretch; each text ends with one
    place = np.flatnonzero(taken)
    index = FmIndex(np.concatenate((symbols[place], [0])), len(windows.vocabulary) + 2)
    bounds = np.cumsum(np.array(lengths) + 1)
    cover, pairs = np.zeros(len(symbols) + 1, dtype=np.int64), []
    for number, patterns in windows.by_length:
        live, low, high = index.search(patterns)
        if not len(live):
            continue
        count = high - low
        rows = np.repeat(low - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
        at = place[index.locate(rows)]
        np.add.at(cover, at, 1)
        np.add.at(cover, at + patterns.shape[1], -1)
        pairs.append(np.unique(np.stack((np.searchsorted(bounds, at, side="right"), np.repeat(live + number, count)), axis=1), axis=0))
    hit = np.concatenate(([False], np.cumsum(cover)[:-1] > 0, [False]))
    edges = np.flatnonzero(hit[1:] != hit[:-1])
    begin, end = edges[::2], edges[1::2]
    document = np.searchsorted(bounds, begin, side="right")
    offset = np.concatenate(([0], bounds[:-1]))
    for d, a, b in zip(document.tolist(), (begin - offset[document]).tolist(), (end - offset[document]).tolist(), strict=True):
        spans[d].append({"start": a, "end": b})
        n_hit[d] += b - a
    if pairs:
        for d, w in np.concatenate(pairs).tolist():
            items[d].append(windows.items[w])
    return {"n_words": lengths, "n_hit": n_hit, "items": [np.unique(np.concatenate(x)).tolist() if x else [] for x in items], "spans": spans}


def blocks(benchmark: DataFrame, item_id: str, text: str, most: int) -> Iterator[list[tuple[int, list[bytes]]]]:
    """The items with words, in blocks of at most `most` words (a longer item is a block of its own)."""
    block, held = [], 0
    for item, t in benchmark.select(F.col(f"`{item_id}`").cast("bigint"), F.col(f"`{text}`")).toLocalIterator():
        its = words(t)
        if item is None or not its:
            continue
        if held and held + len(its) > most:
            yield block
            block, held = [], 0
        block.append((item, its))
        held += len(its)
    if block:
        yield block


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, *, carry: list[str], into: str = "contamination", text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 13, block_words: int = 200_000, shard_bytes: int = 4 << 20
) -> DataFrame:
    """The carried columns and a struct: n_words, n_hit, items, spans (word positions, end exclusive, merged).

    Null or wordless texts: no words, no hits. Items that are null, or have no words, or no id, match nothing. Items of
    fewer than `window` words match as a whole. Repeated rows are each judged; an empty benchmark leaves all documents
    clean; an empty table gives an empty table. Columns that aren't carried play no part, whatever they are called.
    """
    spark = docs.sparkSession
    broadcasts: list = []

    def passed(df: DataFrame) -> DataFrame:
        """A pass written, so that its block can leave the executors."""
        made = stored(df, "decontaminate")
        broadcasts.pop().destroy()
        return made

    def one(df: DataFrame, keep: list[str], column: str, block: list) -> DataFrame:
        sent = spark.sparkContext.broadcast(Windows(block, window))
        broadcasts.append(sent)

        def judge():
            windows = sent.value

            def call(texts: pa.Array) -> pa.Array:
                made = scan(texts.cast(pa.binary()).to_pylist(), windows)
                return struct_array(
                    {
                        "n_words": pa.array(made["n_words"], pa.int64()),
                        "n_hit": pa.array(made["n_hit"], pa.int64()),
                        "items": pa.array(made["items"], pa.list_(pa.int64())),
                        "spans": pa.array(made["spans"], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    }
                )

            return call

        return annotate(df, text, keep, column, RESULT, judge, shard_bytes)

    it = blocks(benchmark, item_id, item_text, block_words)
    head, second = next(it, []), next(it, None)
    if second is None:
        return one(docs, carry, into, head)
    # More blocks: each a pass; equal texts have equal results, so passes meet by a hash of the text.
    key = free_name(docs, "text_key")
    keyed = docs.withColumn(key, F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")), 256))
    passes = [passed(one(keyed, [key], into, b).filter((F.size(f"{into}.items") > 0))) for b in (head, second, *it)]
    lengths = one(keyed, [*carry, key], into, [])
    found = reduce(DataFrame.unionByName, passes)
    its = found.select(key, F.explode(f"{into}.items").alias("item")).distinct().groupBy(key).agg(F.sort_array(F.collect_list("item")).alias("items"))
    spot = found.select(key, F.explode(f"{into}.spans").alias("s")).select(key, "s.start", "s.end").distinct()
    spans = spot.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    merge = F.expr(
        "aggregate(spans, cast(array() as array<struct<start:bigint,end:bigint>>), (done, s) -> case when size(done) > 0 and element_at(done, -1).end >= s.start"
        " then concat(slice(done, 1, size(done) - 1), array(named_struct('start', element_at(done, -1).start, 'end', greatest(element_at(done, -1).end, s.end)))) else concat(done, array(s)) end)"
    )
    column = free_name(docs, "merged")
    spans = spans.select(key, merge.alias("spans"))
    whole = its.join(spans, key).select(key, F.struct("items", "spans", F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.start)").alias("n_hit")).alias(column))
    none, some = F.col(into), F.col(column)
    return lengths.join(whole, key, "left").select(
        *[F.col(f"`{c}`") for c in carry],
        F.struct(
            none["n_words"].alias("n_words"),
            F.coalesce(some["n_hit"], F.lit(0).cast("bigint")).alias("n_hit"),
            F.coalesce(some["items"], none["items"]).alias("items"),
            F.coalesce(some["spans"], none["spans"]).alias("spans"),
        ).alias(into),
    )


def is_contaminated(n_hit, n_words):
    """The contamination rule: at least a twentieth of the words are hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def decontamination_report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256 (of the ids as sorted strings), contaminated, n_spans."""
    found = find_contamination(docs, benchmark, carry=["doc_id"], into="c", **options)
    joined = F.array_join(F.sort_array(F.transform("c.items", lambda x: x.cast("string"))), ",")
    return found.select(
        "doc_id",
        F.col("c.n_words").alias("n_words"),
        F.col("c.n_hit").alias("n_hit"),
        F.size("c.items").cast("bigint").alias("n_items"),
        F.sha2(joined, 256).alias("items_sha256"),
        is_contaminated(F.col("c.n_hit"), F.col("c.n_words")).alias("contaminated"),
        F.size("c.spans").alias("n_spans"),
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Documents that the rule doesn't call contaminated, with their own columns."""
    into = free_name(docs, "contamination")
    found = find_contamination(docs, benchmark, carry=docs.columns, into=into, **options)
    return found.filter(~is_contaminated(F.col(f"{into}.n_hit"), F.col(f"{into}.n_words"))).drop(into)


def items_digest(items: list[int]) -> str:
    """items_sha256 in Python, for tests."""
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()


#: DuckDB SQL for decontamination_report() over `documents` and `benchmark`.
CONTAMINATION_SQL = r"""
with d as (select doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w from documents),
b as (select item_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w from benchmark),
windows as (select distinct item_id, least(len(w), 13) as n, unnest(case when len(w) >= 13 then list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i : i + 12], ' ')) else [array_to_string(w, ' ')] end) as win from b where len(w) > 0),
sizes as (select distinct n from windows),
places as (select doc_id, n, unnest(range(1, len(w) - n + 2)) as i, w from d, sizes where len(w) >= n),
hits as (select doc_id, i, p.n, item_id from (select doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') as win from places) p join windows on windows.win = p.win and windows.n = p.n),
items as (select doc_id, count(distinct item_id) as n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as ids from hits group by 1),
spots as (select distinct doc_id, unnest(range(i, i + n)) as spot from hits),
covered as (select doc_id, count(*) as n_hit, count(*) filter (spot - 1 is distinct from before) as n_spans from (select doc_id, spot, lag(spot) over (partition by doc_id order by spot) as before from spots) group by 1)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(ids, '')) as items_sha256,
coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated, coalesce(n_spans, 0)::int as n_spans from d left join items using (doc_id) left join covered using (doc_id)
"""
