"""Mixing sources to target weights by a low-discrepancy source schedule, with DataFrame operations only.

The mix is a row of slots of equally many words. Slot i gets the point frac(i * golden ratio) (in 32-bit fixed point), which
the cumulative target shares map to a source; so every stretch of the schedule holds the sources nearly in proportion.
The documents of a source, shuffled by a hash of their ids, form one stream of words that is cut into blocks of equal
length: a slot's, or a part of it where a source would have fewer than `least_blocks` of these. The r-th slot of a source
takes the next blocks of its stream, which begins anew when it is through, so no block is taken more than `most_repeats`
times; where a source's target ends, so do its slots, and what the schedule leaves short of it (a few slots at most, as
its points are that even) is made up in slots behind the last. So a source of any size comes within half a block of its
target. repeat_by_mix() delivers whole documents in the order of the slots that take them.

Scale: running sums never run over a whole source. A source's documents fall into about the square root of their
number of hash ranges, sums run inside the ranges, and the ranges' totals are summed next; slots are ranked likewise.
What is read more than once (sources, schedule, streams) is written first, so no plan holds it twice: the driver plans
each step anew as its parts end, and its memory grows with the length of the plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weavegraph.llm.common import forget, free_name, stored

#: 2**32 divided by the golden ratio: the step of the schedule's points.
GOLDEN = 2654435769
WORD = r"[^\x20\x09-\x0D]+"


def count_words(text: str | Column) -> Column:
    """Number of words of the text (null: 0): each word and the white space around it becomes one letter; no matches are kept."""
    t = F.col(text) if isinstance(text, str) else text
    letters = F.regexp_replace(t, r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+", "x")
    return F.coalesce(F.when(t.rlike(r"[^\x20\x09-\x0D]"), F.length(letters)), F.lit(0)).cast("bigint")


def source_targets(sized: DataFrame, most_repeats: int = 3, weights: int = 3) -> DataFrame:
    """One row per source: sid (its place by code point, null last), n_docs, source_size, weight, target, total.

    Weights 1, 2, .. repeat in that order. Targets share the total by weight; one that would pass most_repeats times
    its source's size stops there and the excess is shared again by weight until none is above. The windows here run
    over one row per source, never over documents.
    """
    by = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    by = by.withColumn("sid", F.row_number().over(order)).withColumn("weight", (F.col("sid") - 1) % weights + 1)
    by = by.withColumn("cap", most_repeats * F.col("source_size")).withColumn("total", F.sum("source_size").over(Window.partitionBy()))
    ratio = Window.orderBy(F.col("cap") / F.col("weight"), "sid")
    by = by.withColumn("capped", F.coalesce(F.sum("cap").over(ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    by = by.withColumn("open_weight", F.sum("weight").over(ratio.rowsBetween(0, Window.unboundedFollowing)))
    by = by.withColumn("level", (F.col("total") - F.col("capped")).cast("double") / F.col("open_weight"))
    level = F.max(F.when(F.col("cap") > F.col("level") * F.col("weight"), F.col("level"))).over(Window.partitionBy())
    target = F.least(F.col("cap").cast("double"), F.coalesce(level * F.col("weight"), F.col("cap").cast("double")))
    return by.withColumn("target", target).select("sid", "source", "n_docs", "source_size", "weight", "target", "total")


def source_schedule(sources: DataFrame, total: int, block: int) -> DataFrame:
    """One row per slot: slot, sid, rank (from 0, within the source). sources has sid and target."""
    spark = sources.sparkSession
    n = -(-total // block) if total else 0
    sums = Window.orderBy("sid")
    share = F.sum("target").over(sums.rowsBetween(Window.unboundedPreceding, 0))
    whole = F.sum("target").over(sums.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    edge = F.floor(F.lit(2.0**32) * share / whole)
    spans = sources.filter("target > 0").withColumn("upto", edge).withColumn("since", F.coalesce(F.lag("upto").over(sums), F.lit(0)))
    # Slots meet sources by the cell of their point: an equi-join, as evenly spread as the points are.
    cells = spans.filter("upto > since").select("sid", "since", "upto", F.explode(F.sequence(F.shiftright("since", 20), F.shiftright(F.col("upto") - 1, 20))).alias("cell"))
    point = (F.col("id") % (1 << 31)) * F.lit(GOLDEN).cast("bigint") % (1 << 32)
    slots = spark.range(n).select(F.col("id").alias("slot"), point.alias("point")).withColumn("cell", F.shiftright("point", 20))
    placed = slots.join(cells, "cell").filter("point >= since and point < upto").select("slot", "sid")
    chunk = max(512, int(n**0.5))
    placed = placed.withColumn("chunk", F.floor(F.col("slot") / chunk))
    before = placed.groupBy("sid", "chunk").agg(F.count(F.lit(1)).alias("n"))
    prior = Window.partitionBy("sid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = before.select("sid", "chunk", F.coalesce(F.sum("n").over(prior), F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("sid", "chunk").orderBy("slot")) - 1
    return placed.withColumn("own", rank).join(before, ["sid", "chunk"]).select("slot", "sid", (F.col("own") + F.col("before")).alias("rank"))


def document_streams(sized: DataFrame, sources: DataFrame, seed: str) -> DataFrame:
    """Documents that have words, each with sid and the place of its first word in its source's shuffled stream."""
    ranged = sized.filter("size > 0").join(sources.select("sid", "source", "n_docs", "source_size", "target"), sized["source"].eqNullSafe(sources["source"])).drop("source")
    hashed = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    ranges = F.ceil(F.col("n_docs") / F.greatest(F.lit(512.0), F.sqrt("n_docs")))
    ranged = ranged.withColumn("hash", hashed).withColumn("range", F.floor(F.conv(F.substring("hash", 1, 8), 16, 10).cast("bigint") * ranges / F.lit(2.0**32)))
    inner = Window.partitionBy("sid", "range").orderBy("hash", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranged = ranged.withColumn("upto", F.sum("size").over(inner))
    sums = ranged.groupBy("sid", "range").agg(F.sum("size").alias("n"))
    prior = Window.partitionBy("sid").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("sid", "range", F.coalesce(F.sum("n").over(prior), F.lit(0)).alias("before"))
    return ranged.join(sums, ["sid", "range"]).select("doc_id", "size", "sid", "source_size", "target", (F.col("before") + F.col("upto") - F.col("size")).alias("start"))


def with_blocks(sources: DataFrame, slot_words: int, least_blocks: int) -> DataFrame:
    """Each source's blocks a slot takes (per_slot), words in a block, blocks in the stream (n_blocks), and blocks to take in all (takes)."""
    size, words = F.greatest("source_size", F.lit(1)), F.lit(slot_words)
    sources = sources.withColumn("per_slot", F.least(words, F.greatest(F.lit(1), F.call_function("div", least_blocks * words + size - 1, size))).cast("bigint"))
    sources = sources.withColumn("block", F.call_function("div", words, F.col("per_slot"))).withColumn("n_blocks", F.call_function("div", F.col("source_size") + F.col("block") - 1, F.col("block")))
    passes = F.floor(F.col("target") / size)
    rest = F.floor((F.col("target") - passes * F.col("source_size")) / F.col("block") + 0.5)
    return sources.withColumn("takes", (passes * F.col("n_blocks") + rest).cast("bigint"))


def whole_schedule(sources: DataFrame, total: int, slot_words: int) -> DataFrame:
    """source_schedule() as far as each source's target goes, and the slots that make up for what it lacks: slot, sid, rank.

    sources has takes and per_slot beside sid and target.
    """
    slots = stored(source_schedule(sources, total, slot_words), "mix-slots")
    needed = F.call_function("div", F.col("takes") + F.col("per_slot") - 1, F.col("per_slot"))
    held = slots.groupBy("sid").agg(F.count(F.lit(1)).alias("held"))
    wanted = sources.select("sid", needed.alias("needed"))
    lacking = wanted.join(held, "sid", "left").select("sid", "needed", F.coalesce("held", F.lit(0)).alias("held")).filter("needed > held")
    # A row for each source here.
    before = F.coalesce(F.sum(F.col("needed") - F.col("held")).over(Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    last = -(-total // slot_words) if total else 0
    more = lacking.withColumn("before", before).withColumn("rank", F.explode(F.sequence(F.col("held"), F.col("needed") - 1)))
    more = more.select((F.lit(last) + F.col("before") + F.col("rank") - F.col("held")).alias("slot"), "sid", "rank")
    schedule = stored(slots.join(wanted, "sid").filter("rank < needed").select("slot", "sid", "rank").unionByName(more), "mix-schedule")
    forget(slots)
    return schedule


def _plan(sized: DataFrame, slots: int, most_slot: int, most_repeats: int, least_blocks: int, seed: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sources with their blocks, the schedule, and the documents' places in their sources' streams."""
    total = sized.agg(F.sum("size")).first()[0] or 0
    words = max(1, min(most_slot, total // slots))
    sources = stored(with_blocks(source_targets(sized, most_repeats), words, least_blocks), "mix-sources")
    return sources, whole_schedule(sources, total, words), stored(document_streams(sized, sources, seed), "mix-streams")


def _sized(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    return stored(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").alias("source"), count_words(F.col(f"`{text}`")).alias("size")), "mix-sizes")


def _taken(sources: DataFrame, schedule: DataFrame, streams: DataFrame) -> DataFrame:
    """The documents' places with taken: slots joined to the blocks that they take, and blocks to the documents in them."""
    its = sources.select("sid", "block", "per_slot", "n_blocks", "takes")  # a row for each source; Spark broadcasts it where it is small
    first = F.col("rank") * F.col("per_slot")
    takes = schedule.join(its, "sid").filter(first < F.col("takes")).withColumn("take", F.explode(F.sequence(first, F.least(first + F.col("per_slot"), F.col("takes")) - 1)))
    times = takes.groupBy("sid", (F.col("take") % F.col("n_blocks")).alias("number")).agg(F.count(F.lit(1)).alias("times"))
    last, block = F.col("start") + F.col("size"), F.col("block")
    parts = streams.join(its.select("sid", "block"), "sid").withColumn("number", F.explode(F.sequence(F.call_function("div", F.col("start"), block), F.call_function("div", last - 1, block))))
    overlap = F.least(last, (F.col("number") + 1) * block) - F.greatest("start", F.col("number") * block)
    by = ["doc_id", "size", "source_size", "target", "sid", "start"]
    return parts.withColumn("overlap", overlap).join(times, ["sid", "number"], "left").groupBy(*by).agg(F.sum(F.col("overlap") * F.coalesce("times", F.lit(0))).alias("taken"))


def mix_sources(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", slots: int = 1 << 16, most_slot: int = 4096, most_repeats: int = 3, least_blocks: int = 64, seed: str = "mix-"
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target (its source's), taken (words the mix takes, repeats counted),
    and first_slot, the slot of the schedule that takes its first word first (null: none does).

    Null or empty texts have size 0 and nothing is taken of them; very long ones go over many blocks; a null source is a
    source of its own, the last; repeated rows each count, and ties in the shuffle go by doc_id and size; other columns
    play no part. An empty table gives an empty table. Slots have total/slots words, most_slot at most.
    """
    sized = _sized(docs, doc_id, text, source)
    sources, schedule, streams = _plan(sized, slots, most_slot, most_repeats, least_blocks, seed)
    taken = _taken(sources, schedule, streams).join(sources.select("sid", "block", "per_slot", "takes"), "sid")
    take = F.call_function("div", F.col("start"), F.col("block"))
    taken = taken.withColumn("rank", F.when(take < F.col("takes"), F.call_function("div", take, F.col("per_slot")))).join(schedule.withColumnRenamed("slot", "first_slot"), ["sid", "rank"], "left")
    taken = taken.select("doc_id", "size", "source_size", "target", "taken", "first_slot")
    none = sized.filter("size = 0").join(sources, sized["source"].eqNullSafe(sources["source"])).select("doc_id", "size", "source_size", "target", F.lit(0).cast("bigint").alias("taken"), F.lit(None).cast("bigint").alias("first_slot"))
    return taken.unionByName(none)


def repeat_by_mix(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", slots: int = 1 << 16, most_slot: int = 4096, most_repeats: int = 3, least_blocks: int = 64, seed: str = "mix-"
) -> DataFrame:
    """The mix itself: every document as often as it takes it, to the nearest whole number, in the order of the slots.

    A copy stands where the slot stands that takes the document's first word for that time. Rows are dealt by ranges of
    the slots and sorted inside them, so files that are written of them follow the order. Rows of one doc_id, source and
    size share their number of copies; those of size 0 go.
    """
    sized = _sized(docs, doc_id, text, source)
    sources, schedule, streams = _plan(sized, slots, most_slot, most_repeats, least_blocks, seed)
    whole = _taken(sources, schedule, streams).groupBy("doc_id", "sid", "size").agg(F.min("start").alias("start"), F.floor(F.sum("taken") / F.sum("size") + 0.5).cast("int").alias("copies"))
    its = sources.select("sid", "source", "block", "per_slot", "n_blocks")
    whole = whole.filter("copies > 0").join(its, "sid").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    take = F.col("copy") * F.col("n_blocks") + F.call_function("div", F.col("start"), F.col("block"))
    placed = whole.withColumn("rank", F.call_function("div", take, F.col("per_slot"))).join(schedule, ["sid", "rank"], "left")
    key, name, size, at = (free_name(docs, f"mix_{x}") for x in ("key", "source", "size", "slot"))
    # A copy that was rounded up has no slot; it goes behind the others.
    placed = placed.select(F.col("doc_id").alias(key), F.col("source").alias(name), F.col("size").alias(size), F.coalesce("slot", F.lit((1 << 62) - 1)).alias(at))
    placed = stored(placed, "mix-placed")
    forget(sized, sources, schedule, streams)
    given = docs.withColumn(f"{size}_", count_words(F.col(f"`{text}`")))
    same = given[f"`{doc_id}`"].eqNullSafe(placed[key]) & given[f"`{source}`"].eqNullSafe(placed[name]) & (given[f"{size}_"] == placed[size])
    rows = given.join(placed, same).select(*[given[f"`{c}`"] for c in docs.columns], at)
    tie = F.xxhash64(F.lit(seed), F.col(f"`{doc_id}`"))
    return rows.repartitionByRange(F.col(at), tie).sortWithinPartitions(F.col(at), tie).drop(at)


#: DuckDB SQL for mix_sources() over all of `documents`.
MIX_SQL = r"""
with sized as (select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size from documents),
k as (select sum(size)::bigint as total, greatest(1, least(4096, sum(size)::bigint // 65536)) as words from sized),
s0 as (select source, sum(size)::bigint as source_size, count(*) as n_docs from sized group by source),
s1 as (select *, row_number() over (order by source nulls last) as sid, sum(source_size) over ()::bigint as total from s0),
s2 as (select *, (sid - 1) % 3 + 1 as weight, 3 * source_size as cap from s1),
s3 as (select *, coalesce(sum(cap) over (order by cap / weight, sid rows between unbounded preceding and 1 preceding), 0)::bigint as capped,
  sum(weight) over (order by cap / weight, sid rows between current row and unbounded following) as open_weight from s2),
s4 as (select *, (total - capped)::double / open_weight as level from s3),
s5 as (select *, max(case when cap > level * weight then level end) over () as top from s4),
s6 as (select sid, source, n_docs, source_size, least(cap::double, coalesce(top * weight, cap::double)) as target, greatest(source_size, 1) as one from s5),
s7 as (select s6.*, words, least(words, greatest(1, (64 * words + one - 1) // one)) as per_slot from s6, k),
s8 as (select *, words // per_slot as block from s7),
s9 as (select *, (source_size + block - 1) // block as n_blocks, floor(target / one) as passes from s8),
sources as (select *, (passes * n_blocks + floor((target - passes * source_size) / block + 0.5))::bigint as takes from s9),
-- The schedule: points of the golden ratio through the cumulative targets, and the slots that make up for what they lack.
need as (select sid, (takes + per_slot - 1) // per_slot as needed from sources),
spans as (select sid, lag(upto, 1, 0) over (order by sid) as since, upto from (select sid, floor(4294967296.0::double * sum(target) over (order by sid rows between unbounded preceding and current row) / sum(target) over ())::bigint as upto from sources where target > 0)),
last as (select case when total > 0 then (total + words - 1) // words else 0 end as n from k),
points as (select i as slot, (i % 2147483648) * 2654435769 % 4294967296 as point from (select unnest(range(0, n)) as i from last)),
drawn as (select slot, sid, row_number() over (partition by sid order by slot) - 1 as rank from points join spans on point >= since and point < upto),
held as (select need.sid, needed, count(drawn.sid) as held from need left join drawn using (sid) group by 1, 2),
lacking as (select *, coalesce(sum(needed - held) over (order by sid rows between unbounded preceding and 1 preceding), 0)::bigint as before from held where needed > held),
slots as (select slot, sid, rank from drawn join need using (sid) where rank < needed
  union all select n + before + rank - held, sid, rank from (select *, unnest(range(held, needed)) as rank from lacking), last),
ranks as (select sid, per_slot, n_blocks, takes, rank from sources join slots using (sid)),
blocks as (select sid, n_blocks, unnest(range(rank * per_slot, least(rank * per_slot + per_slot, takes))) as take from ranks),
times as (select sid, take % n_blocks as number, count(*) as times from blocks group by all),
streams as (select doc_id, size, source_size, target, sid, block,
  (sum(size) over (partition by sid order by md5('mix-' || coalesce(doc_id::varchar, 'null')), doc_id, size rows between unbounded preceding and current row))::bigint - size as start
  from sized join sources on sized.source is not distinct from sources.source where size > 0),
parts as (select *, unnest(range(start // block, (start + size - 1) // block + 1)) as number from streams),
taken as (select doc_id, size, source_size, target, sid, start, block, sum((least(start + size, (number + 1) * block) - greatest(start, number * block)) * coalesce(times, 0))::bigint as taken
  from parts left join times using (sid, number) group by doc_id, size, source_size, target, sid, start, block)
select doc_id, size::bigint as size, taken.source_size, taken.target, taken, slot as first_slot
from taken join sources using (sid) left join slots on slots.sid = taken.sid and slots.rank = start // taken.block // per_slot and start // taken.block < takes
union all
select doc_id, size::bigint, source_size, target, 0::bigint, null from sized join sources on sized.source is not distinct from sources.source where size = 0
"""
