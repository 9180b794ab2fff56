"""Line dedup: repeated runs of lines, found by a suffix array over line ids; later copies are deleted.

All lines of all documents, in order of doc_id, form one sequence of line ids; a suffix ends with its document.

1. Prefix doubling: level k names every run of 2**k lines that occurs more than once by the place of its first
   occurrence; level k+1 comes from pairs of names of level k, by a join and a grouping. Suffixes whose run is unique
   leave, so each level is smaller than the last, and the doubling ends when no run of that length repeats. Names are
   first places rather than lexicographic ranks: intervals of the suffix array need equal names only, not their order.
2. LCP intervals, from the root down: an interval is the set of suffixes that share their first l lines. For k from the
   top level down, each interval is split by the name of the 2**k lines behind its first l. Members of a part other than
   its first go on to the interval of l + 2**k lines; the first stays, and goes along as a place to copy from. When k is
   through, l is the length of the longest run at that place that occurs before it.
3. Runs of at least `least_words` words that occur before are later copies. A document loses the union of its own.

A repeated run lies inside a stretch of repeated lines of its document, so stretches of fewer words leave at the start.
Groupings are minima and counts, taken before the shuffle; no list of places is ever gathered, however often a line occurs.
What a grouping finds is written before it meets the places, so Spark can split the places of a very frequent line.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weavegraph.llm.common import forget, free_name, slices, stored
from weavegraph.llm.shingles import mix, power_tables

#: A place is a document's number times 2**SHIFT plus the line's. Numbers are dense, so 2**37 documents of 2**26 lines have places.
SHIFT = 26
LINES = "doc_id bigint, text_key bigint, lines array<bigint>, words array<int>"


def line_hashes(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Hash and number of words of every line of each text; lines are what \\n separates, and equal only as bytes."""
    if not texts:
        return []
    joined = b"\n".join(texts) + b"\n"
    code = np.frombuffer(joined, dtype=np.uint8)
    end = np.flatnonzero(code == 10)
    begin = np.concatenate(([0], end[:-1] + 1))
    power, inverse = power_tables(len(code) + 1)
    running = np.zeros(len(code) + 1, dtype=np.uint64)
    np.cumsum((code.astype(np.uint64) + np.uint64(1)) * power[: len(code)], out=running[1:])
    hashes = mix((running[end] - running[begin]) * inverse[begin] + (end - begin).astype(np.uint64)).view(np.int64)
    inside = (code != 32) & ((code < 9) | (code > 13))
    starts = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
    words = np.diff(np.searchsorted(starts, end), prepend=0).astype(np.int32)
    cuts = np.searchsorted(end, np.cumsum([len(t) + 1 for t in texts]) - 1, side="right")
    return list(zip(np.split(hashes, cuts[:-1]), np.split(words, cuts[:-1]), strict=True))


def _text_keys(lines: list[np.ndarray]) -> list[int]:
    """A hash of each text out of those of its lines."""
    return [int(np.bitwise_xor.reduce(mix(h.view(np.uint64) + np.arange(1, len(h) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))).view(np.int64)) for h in lines]


def numbered_lines(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, text_key, lines, words, seq: the documents by ascending doc_id (null first), then text_key, numbered by seq."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, 4 << 20):
                texts = part.column(1).cast(pa.binary()).to_pylist()
                made = line_hashes([t or b"" for t in texts])
                keys = _text_keys([h for h, _ in made])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(keys, pa.int64()), pa.array([[] if t is None else h for t, (h, _) in zip(texts, made, strict=True)], pa.list_(pa.int64())), pa.array([[] if t is None else w for t, (_, w) in zip(texts, made, strict=True)], pa.list_(pa.int32()))],
                    names=["doc_id", "text_key", "lines", "words"],
                )

    narrow = stored(docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(run, LINES), "lines")
    ordered = narrow.repartitionByRange("doc_id", "text_key").sortWithinPartitions("doc_id", "text_key")
    row = F.monotonically_increasing_id()
    fits = F.size("lines") <= 1 << SHIFT
    ordered = ordered.withColumn("lines", F.when(fits, F.col("lines")).otherwise(F.raise_error(F.lit(f"a document has more than {1 << SHIFT} lines"))))
    ordered = stored(ordered.withColumn("part", F.shiftright(row, 33)).withColumn("row", row.bitwiseAND((1 << 33) - 1)), "numbered")
    forget(narrow)
    # A row for each partition: what comes before it.
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", before.alias("before"))
    return ordered.join(F.broadcast(parts), "part").select("doc_id", "text_key", "lines", "words", (F.col("before") + F.col("row")).alias("seq"))


def _grouped(rows: DataFrame, *keys: str) -> DataFrame:
    """The rows whose keys occur more than once: pos, and run, the first pos with those keys."""
    many = stored(rows.groupBy(*keys).agg(F.min("pos").alias("run"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "repeated")
    return rows.join(many, list(keys)).select("pos", "run")


def repeated_run_levels(numbered: DataFrame, least_words: int) -> list[DataFrame]:
    """Level k: pos and run of all runs of 2**k lines that repeat, inside stretches of at least least_words words."""
    lines = numbered.select("seq", F.posexplode(F.arrays_zip("lines", "words")).alias("line", "x")).select((F.shiftleft("seq", SHIFT) + F.col("line")).alias("pos"), F.col("x.lines").alias("hash"), F.col("x.words").alias("words"))
    lines = stored(lines, "line-rows")
    first = _grouped(lines.select("pos", "hash"), "hash").join(lines.select("pos", "words"), "pos")
    document = F.shiftright("pos", SHIFT)
    stretch = F.col("pos") - F.row_number().over(Window.partitionBy(document).orderBy("pos"))
    held = first.withColumn("stretch", stretch).withColumn("held", F.sum("words").over(Window.partitionBy(document, "stretch")))
    levels = [stored(held.filter(F.col("held") >= least_words).select("pos", "run"), "level")]
    forget(lines)
    while True:
        now, reach = levels[-1], 1 << (len(levels) - 1)
        behind = now.select((F.col("pos") - reach).alias("pos"), F.col("run").alias("next"))
        pairs = now.join(behind, "pos").select("pos", F.col("run").alias("head"), "next")
        level = stored(_grouped(pairs, "head", "next"), "level")
        if level.isEmpty():
            return levels
        levels.append(level)


def longest_earlier_runs(levels: list[DataFrame]) -> DataFrame:
    """pos, length and source: the longest run of lines at pos that occurs before it, and where it first does."""
    start = state = levels[0].select("pos", F.lit(0).cast("bigint").alias("length"), F.lit(-1).cast("bigint").alias("node"), F.lit(True).alias("asks"))
    for k in range(len(levels) - 1, -1, -1):
        names = levels[k].select((F.col("pos")).alias("at"), "run")
        named = state.join(names, F.col("pos") + F.col("length") == F.col("at"), "left").select("pos", "length", "node", "asks", "run")
        named = stored(named, "interval")
        parts = named.filter("run is not null").groupBy("length", "node", "run").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
        parts = stored(parts, "parts")
        joined = named.join(parts, ["length", "node", "run"], "left")
        moves = F.col("first").isNotNull()
        stays = F.struct("length", "node", "asks")
        longer = F.struct((F.col("length") + (1 << k)).alias("length"), F.col("first").alias("node"), F.lit(False).alias("asks"))
        later = F.struct((F.col("length") + (1 << k)).alias("length"), F.col("first").alias("node"), F.col("asks"))
        step = F.when(~moves, F.array(stays)).when(F.col("pos") == F.col("first"), F.array(stays, longer)).otherwise(F.array(later))
        fresh = stored(joined.select("pos", F.explode(step).alias("s")).select("pos", "s.length", "s.node", "s.asks"), "state")
        forget(named, parts, *([] if state is start else [state]))
        state = fresh
    return state.filter("asks and length > 0").select("pos", "length", F.col("node").alias("source"))


RESULT = "doc_id bigint, text_key bigint, seq bigint, n_lines bigint, n_words bigint, n_removed_lines bigint, n_removed_words bigint, removed array<struct<start:int,end:int>>, sources array<bigint>"


def find_repeated_runs(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", least_words: int = 50) -> DataFrame:
    """One row per document: doc_id, n_lines, n_words, n_removed_lines, n_removed_words, removed (spans of lines, end exclusive), sources.

    Removed are the lines of every run of at least least_words words that occurs earlier, in a document of smaller doc_id or
    further up in the same; sources are numbers (seq) of the documents that have them first. A run may overlap its
    earlier copy, so of one line many times in a row the first stays. Texts are judged whole, long ones in as many rows as
    they have lines (2**26 at most, or an error). Null texts have no lines, empty ones an empty line;
    null doc_ids come first; equal doc_ids and repeated rows follow each other, the first is kept; an empty table stays empty.
    """
    numbered = numbered_lines(docs, doc_id, text)
    runs = longest_earlier_runs(repeated_run_levels(numbered, least_words))
    # A document's runs are as many as its lines, at most.
    runs = runs.groupBy(F.shiftright("pos", SHIFT).alias("seq")).agg(F.collect_list(F.struct(F.col("pos").bitwiseAND((1 << SHIFT) - 1).cast("int").alias("line"), F.col("length").cast("int").alias("length"), F.shiftright("source", SHIFT).alias("source"))).alias("runs"))
    rows = numbered.select("doc_id", "text_key", "seq", "words").join(runs, "seq", "left").select("doc_id", "text_key", "seq", "words", "runs")

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for words, its in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                total, gone, sources = np.concatenate(([0], np.cumsum(words, dtype=np.int64))), np.zeros(len(words) + 2, dtype=np.int64), set()
                for r in its or ():
                    if total[r["line"] + r["length"]] - total[r["line"]] >= least_words:
                        gone[r["line"] + 1] += 1
                        gone[r["line"] + r["length"] + 1] -= 1
                        sources.add(r["source"])
                lost = np.cumsum(gone) > 0
                edges = np.flatnonzero(lost[1:] != lost[:-1]).tolist()
                spans = list(zip(edges[::2], edges[1::2], strict=True))
                values = (len(words), int(total[-1]), sum(b - a for a, b in spans), int(sum(total[b] - total[a] for a, b in spans)), [{"start": a, "end": b} for a, b in spans], sorted(sources))
                for column, value in zip(out, values, strict=True):
                    column.append(value)
            kinds = [pa.int64()] * 4 + [pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))], names=["doc_id", "text_key", "seq", "n_lines", "n_words", "n_removed_lines", "n_removed_words", "removed", "sources"])

    return rows.mapInArrow(settle, RESULT)


def line_report(docs: DataFrame, **options) -> DataFrame:
    """find_repeated_runs() with copied_from: the doc_ids of the documents that have the removed runs first."""
    found = stored(find_repeated_runs(docs, **options), "line-report")
    names = found.select(F.col("seq").alias("source"), F.col("doc_id").alias("source_id"))
    from_ = found.select("seq", F.explode("sources").alias("source")).join(names, "source").groupBy("seq").agg(F.sort_array(F.collect_set("source_id")).alias("copied_from"))
    whole = found.join(from_, "seq", "left")
    return whole.select("doc_id", "n_lines", "n_words", "n_removed_lines", "n_removed_words", "removed", F.coalesce("copied_from", F.array().cast("array<bigint>")).alias("copied_from"))


def without_repeated_runs(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", least_words: int = 50) -> DataFrame:
    """The documents with the removed lines gone from their texts; a text that loses all its lines is empty.

    Documents meet their spans by doc_id, hash of the text and, among equal rows, a running number.
    """
    found = find_repeated_runs(docs, doc_id=doc_id, text=text, least_words=least_words)
    key, number, spans = free_name(docs, "key"), free_name(docs, "number"), free_name(docs, "spans")
    name = F.struct(F.col("doc_id").alias("d"), F.col("text_key").alias("t"))
    marks = found.select(name.alias(key), F.row_number().over(Window.partitionBy("doc_id", "text_key").orderBy("seq")).alias(number), F.col("removed").alias(spans)).filter(F.size(spans) > 0)

    def text_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, at, 4 << 20):
                made = _text_keys([h for h, _ in line_hashes([t or b"" for t in part.column(at).cast(pa.binary()).to_pylist()])])
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(made, pa.int64())], names=names)

    names, at = [*docs.columns, key], len(docs.columns)
    given = docs.withColumn(key, F.col(f"`{text}`"))
    keyed = given.mapInArrow(text_key, docs.withColumn(key, F.lit(0).cast("bigint")).schema)
    keyed = keyed.withColumn(key, F.struct(F.col(f"`{doc_id}`").cast("bigint").alias("d"), F.col(key).alias("t")))
    keyed = keyed.withColumn(number, F.row_number().over(Window.partitionBy(key).orderBy(F.lit(1))))
    joined = keyed.join(marks.withColumnRenamed(key, "m_key").withColumnRenamed(number, "m_number"), keyed[key].eqNullSafe(F.col("m_key")) & (keyed[number] == F.col("m_number")), "left")
    lines = F.split(F.col(f"`{text}`"), "\n", -1)
    kept = F.array_join(F.filter(lines, lambda _, i: ~F.exists(F.col(spans), lambda s: (s["start"] <= i) & (i < s["end"]))), "\n")
    return joined.select(*[F.when(F.col(spans).isNull(), F.col(f"`{c}`")).otherwise(kept).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
