"""Z-fast trie over conversations: prefixes that several conversations share, found once.

A sequence of turns is known by the chained hashes of its prefixes, 16 bytes each, so a prefix of any length is one key.
The trie is compacted: a node stands where sequences part or end, and its edge, from its parent's depth (`top`) to its own,
carries the prefix hashes in between. Nodes are rows of a table under two keys: the prefix hash at the edge's handle, which
is the depth in (top, depth] that the highest power of two divides (the two-fattest), and that at the edge's first turn.

A sequence finds where it leaves the trie by fat binary search: it looks the two-fattest depth of what is still possible up
among the handles; a hit whose node it contains moves it there, another hit is the edge on which it leaves, a miss rules out
all that is deeper. That takes a join for every bit of the longest length, for all sequences at once. The edge's own hashes
then tell the depth.

Sequences go in by batches: all that aren't in yet are located, of those that leave at one point with the same next turn
one, by a hash, is inserted whole, edges are cut where anyone leaves them, and the others go on from there. A random choice
halves what waits below, so batches are few, and no group is ever gathered: which one it is, is a minimum.

What a node sums up over its subtree comes from pointer doubling over the parents: after k rounds a row has the sums of
its descendants up to 2**k - 1 levels down. Edges are expanded to a row per turn at the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weavegraph.llm.common import forget, stored

ROOT = hashlib.blake2b(b"", digest_size=16).digest()
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
SEQUENCE = "conv_id bigint, seq binary, hashes array<binary>, upto array<bigint>"
NODE = "node binary, depth int, top int, parent binary, handle binary, first binary, label array<binary>, rep binary"
#: A member list is hashed from strings of ids that agree but for their last so many bits.
CHUNK_BITS = 12


def turn_lists(conversations: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id and its turns in order: structs of turn, digest (16 bytes of role and text) and chars, the text's length.

    A null turn comes first, null roles and texts are empty, turns of one number are ordered by their digests and each
    counts; rows without conv_id aren't of any conversation. Texts stay where they are: only digests are gathered, so a
    conversation of a million turns is a row of some 40 MB.
    """
    r, t = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text))
    digest = F.unhex(F.md5(F.concat(F.length(r).cast("string"), F.lit(":"), r, t)))
    rows = conversations.select(F.col(f"`{conv_id}`").cast("bigint").alias("conv_id"), F.struct(F.col(f"`{turn}`").cast("bigint").alias("turn"), digest.alias("digest"), F.length(t).cast("bigint").alias("chars")).alias("t"))
    return rows.filter("conv_id is not null").groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def rebuilt(lists: DataFrame, every: int = 100, most: int = 5) -> DataFrame:
    """Each conversation with its first h turns replaced by those of conversation c - c % every; h is crc32(c) % (most + 1)."""
    base = lists.filter(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % (most + 1)).cast("int")
    both = lists.withColumn("base", F.col("conv_id") - F.col("conv_id") % every).withColumn("h", h).join(base, "base", "left")
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    head = F.slice("head", F.lit(1), F.col("h"))
    return both.select("conv_id", F.when(F.col("head").isNull(), own).otherwise(F.concat(head, own)).alias("turns"))


def prefix_hashes(lists: DataFrame) -> DataFrame:
    """Per conversation the hash of the whole, of every prefix from one turn on, and the characters up to each depth, 0 included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, hashes, sums = [], [], []
            for digests, chars in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                now, own, upto = ROOT, [], [0]
                for digest, n in zip(digests, chars, strict=True):
                    now = hashlib.blake2b(now + digest, digest_size=16).digest()
                    own.append(now)
                    upto.append(upto[-1] + n)
                ends.append(now)
                hashes.append(own)
                sums.append(upto)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ends, pa.binary()), pa.array(hashes, pa.list_(pa.binary())), pa.array(sums, pa.list_(pa.int64()))], names=["conv_id", "seq", "hashes", "upto"])

    return lists.select("conv_id", "turns.digest", "turns.chars").mapInArrow(run, SEQUENCE)


def fattest(low: str, high: str) -> Column:
    """The depth in (low, high] that the highest power of two divides."""
    places = f"(length(bin({low} ^ {high})) - 1)"
    return F.expr(f"shiftleft(shiftright({high}, {places}), {places})")


@dataclass
class Trie:
    """nodes: the compacted nodes below the root (NODE); sequences: the distinct sequences, with count, smallest
    conversation, prefix hashes and characters; members: conv_id and seq of every conversation. All are stored tables."""

    nodes: DataFrame
    sequences: DataFrame
    members: DataFrame

    def locate(self, hashed: DataFrame) -> DataFrame:
        """Where sequences (seq, hashes) leave the trie: the columns of exits()."""
        return exits(hashed.withColumn("a", F.lit(0)), self.nodes, _longest(hashed))


def _longest(hashed: DataFrame) -> int:
    return hashed.agg(F.coalesce(F.max(F.size("hashes")), F.lit(0))).first()[0]


def exits(waiting: DataFrame, nodes: DataFrame, longest: int) -> DataFrame:
    """seq and hashes with a, the depth of the deepest node that the sequence contains, m, how deep it agrees with the trie,
    and the node on whose edge it leaves (exit, null if none). waiting: seq, hashes, and a, a depth at which it is known to
    meet a node or the root. A sequence leaves at its end at the latest.
    """
    handles = nodes.select("handle", F.col("node").alias("n__"), F.col("depth").alias("e__"), F.col("top").alias("t__"))
    state = waiting.select("seq", "hashes", "a", F.size("hashes").alias("b"))
    for _ in range(longest.bit_length()):
        # Who is done looks its own end up, which spreads these rows, and disregards what it finds.
        state = state.withColumn("f", F.when(F.col("a") < F.col("b"), fattest("a", "b")))
        key = F.coalesce(F.get("hashes", F.col("f") - 1), F.col("seq"))
        state = state.withColumn("key", key).join(handles, F.col("key") == F.col("handle"), "left")
        hit, contained = F.col("f").isNotNull() & F.col("n__").isNotNull(), F.get("hashes", F.col("e__") - 1).eqNullSafe(F.col("n__"))
        a = F.when(hit & contained, F.col("e__")).when(hit, F.col("t__")).otherwise(F.col("a"))
        b = F.when(hit & ~contained, F.col("t__")).when(F.col("f").isNotNull() & ~hit, F.col("f") - 1).otherwise(F.col("b"))
        state = state.select("seq", "hashes", a.alias("a"), b.alias("b"))
    edges = nodes.select("first", F.col("node").alias("exit"), "label")
    out = state.withColumn("key", F.coalesce(F.get("hashes", F.col("a")), F.col("seq"))).join(edges, F.col("key") == F.col("first"), "left")
    inside = F.col("exit").isNotNull() & (F.col("a") < F.size("hashes"))
    agreed = F.size(F.filter(F.zip_with("label", F.slice("hashes", F.col("a") + 1, F.size("label")), lambda x, y: x.eqNullSafe(y)), lambda same: same))
    return out.select("seq", "hashes", "a", F.when(inside, F.col("exit")).alias("exit"), F.when(inside, F.col("a") + agreed).otherwise(F.col("a")).alias("m"))


def _with_handle(df: DataFrame) -> DataFrame:
    """The columns of NODE, the handle and the first turn's hash from the label."""
    return df.select("node", "depth", "top", "parent", F.get("label", fattest("top", "depth") - F.col("top") - 1).alias("handle"), F.get("label", F.lit(0)).alias("first"), "label", "rep")


def _cut(nodes: DataFrame, left: DataFrame) -> DataFrame:
    """Nodes with their edges cut wherever a sequence leaves them."""
    cuts = left.filter("exit is not null").groupBy("exit").agg(F.collect_set("m").alias("cuts"))  # an edge's depths at most
    bounds = F.concat(F.array("top"), F.coalesce(F.array_sort("cuts"), F.array().cast("array<int>")), F.array("depth"))
    steps = F.transform(F.slice(bounds, F.lit(1), F.size(bounds) - 1), lambda low, i: F.struct(low.alias("low"), F.get(bounds, i + 1).alias("high")))
    pieces = nodes.join(cuts, F.col("node") == F.col("exit"), "left").withColumn("p", F.explode(steps))
    low, high = F.col("p.low"), F.col("p.high")
    at = lambda depth: F.get("label", depth - F.col("top") - 1)
    parts = pieces.select(at(high).alias("node"), high.alias("depth"), low.alias("top"), F.when(low == F.col("top"), F.col("parent")).otherwise(at(low)).alias("parent"), F.slice("label", low - F.col("top") + 1, high - low).alias("label"), "rep")
    return _with_handle(parts)


def build(lists: DataFrame) -> Trie:
    """The trie of conversations (conv_id, turns as turn_lists() gives them). Equal ones are one sequence; those without
    turns end at the root; no conversations give empty tables."""
    spark = lists.sparkSession
    hashed = stored(prefix_hashes(lists), "prefixes")
    sequences = stored(hashed.groupBy("seq").agg(F.first("hashes").alias("hashes"), F.first("upto").alias("upto"), F.count("*").alias("n"), F.min("conv_id").alias("lo")), "sequences")
    members = stored(hashed.select("conv_id", "seq"), "members")
    forget(hashed)
    longest = _longest(sequences)
    nodes, waiting = stored(spark.createDataFrame([], NODE), "nodes"), stored(sequences.filter(F.size("hashes") > 0).select("seq", "hashes", F.lit(0).alias("a")), "waiting")
    while not waiting.isEmpty():
        left = stored(exits(waiting, nodes, longest), "exits")
        length = F.size("hashes")
        leaving = left.filter(F.col("m") < length)
        # Of those that go the same way on, one; the smallest hash is as good as a random choice.
        chosen = leaving.groupBy(F.get("hashes", F.col("m")).alias("first")).agg(F.min(F.struct(F.xxhash64("seq").alias("h"), "seq", "m", "hashes")).alias("r")).select("r.*")
        parent = F.when(F.col("m") == 0, F.lit(ROOT)).otherwise(F.get("hashes", F.col("m") - 1))
        leaves = _with_handle(chosen.select(F.col("seq").alias("node"), length.alias("depth"), F.col("m").alias("top"), parent.alias("parent"), F.slice("hashes", F.col("m") + 1, length - F.col("m")).alias("label"), F.col("seq").alias("rep")))
        grown = stored(_cut(nodes, left).unionByName(leaves), "nodes")
        more = stored(leaving.join(grown.select(F.col("node").alias("seq")), "seq", "left_anti").select("seq", "hashes", F.col("m").alias("a")), "waiting")
        forget(nodes, waiting, left)
        nodes, waiting = grown, more
    return Trie(nodes, sequences, members)


def member_digests(members: DataFrame) -> DataFrame:
    """seq and ends_sha256: SHA-256 of its conversations' ids in ascending order, comma-joined.

    Ids are joined in chunks where they are; a sequence's chunks stream through one task, in order, as the hash demands.
    """
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    chunks = members.groupBy("seq", F.shiftright("conv_id", CHUNK_BITS).alias("chunk")).agg(ids.alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        made = lambda: pa.RecordBatch.from_arrays([pa.array(seqs, pa.binary()), pa.array(shas, pa.string())], names=["seq", "ends_sha256"])
        for batch in batches:
            seqs, shas = [], []
            for seq, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if seq != now:
                    if digest is not None:
                        seqs.append(now)
                        shas.append(digest.hexdigest())
                    now, digest = seq, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield made()
        if digest is not None:
            seqs, shas = [now], [digest.hexdigest()]
            yield made()

    return chunks.repartition("seq").sortWithinPartitions("seq", "chunk").select("seq", "ids").mapInArrow(run, "seq binary, ends_sha256 string")


def subtree_sums(rows: DataFrame, sums: list[str], least: str) -> DataFrame:
    """rows (node, parent, sums, least) with every node's sums and least value over its whole subtree, by pointer doubling."""
    t = stored(rows.withColumn("anc", F.col("parent")), "sums")
    while not t.filter("anc is not null").isEmpty():
        below = t.filter("anc is not null").groupBy(F.col("anc").alias("node")).agg(*[F.sum(c).alias(f"{c}__") for c in sums], F.min(least).alias(f"{least}__"))
        jump = t.filter("anc is not null").select(F.col("node").alias("key"), F.col("anc").alias("anc2"))
        # Above the root there is nothing: those right below it, often most, look themselves up and disregard what they find.
        up = F.coalesce(F.col("anc") != F.lit(ROOT), F.lit(False))
        more = t.join(below, "node", "left").withColumn("key", F.when(up, F.col("anc")).otherwise(F.col("node"))).join(jump, "key", "left")
        added = {c: F.col(c) + F.coalesce(f"{c}__", F.lit(0)) for c in sums} | {least: F.least(least, f"{least}__"), "anc": F.when(up, F.col("anc2"))}
        grown = stored(more.withColumns(added).select(*t.columns), "sums")
        forget(t)
        t = grown
    return t.drop("anc")


def node_report(trie: Trie) -> DataFrame:
    """A row per distinct prefix, the root's included: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.

    saved_tokens: over the subtree, (members - 1) times the characters of each node's last text. With W the characters up
    to a depth, that is the members' W less the own for each, less the characters of the subtree's edges: sums, so edges
    needn't be opened for it. No conversation, no row.
    """
    spark = trie.nodes.sparkSession
    root = spark.range(1).select(F.lit(ROOT).alias("node"), F.lit(0).alias("depth"), F.lit(0).alias("top"), F.lit(None).cast("binary").alias("parent"), F.array(F.lit(0).cast("bigint")).alias("w"))
    texts = trie.sequences.select(F.col("seq").alias("rep"), "upto")
    edges = trie.nodes.join(texts, "rep").select("node", "depth", "top", "parent", F.slice("upto", F.col("top") + 1, F.col("depth") - F.col("top") + 1).alias("w"))
    children = edges.groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("children"))
    ends = trie.sequences.select(F.col("seq").alias("node"), "n", "lo", (F.col("n") * F.element_at("upto", -1)).alias("reached"))
    rows = edges.unionByName(root).join(children, "node", "left").join(ends, "node", "left").fillna(0, ["n", "reached", "children"])
    rows = rows.withColumn("leaves", F.when(F.col("children") == 0, 1).otherwise(0).cast("bigint")).withColumn("spelt", F.element_at("w", -1) - F.get("w", F.lit(0)))
    t = subtree_sums(rows, ["n", "reached", "leaves", "spelt"], "lo")
    # The root's children look themselves up, as above: its own smallest conversation is one row.
    above, first = t.select(F.col("node").alias("key"), F.col("lo").alias("above")), t.filter(F.col("parent").isNull()).select(F.col("lo").alias("root_lo"))
    low = F.coalesce(F.col("parent") != F.lit(ROOT), F.lit(False))
    t = t.withColumn("key", F.when(low, F.col("parent")).otherwise(F.col("node"))).join(above, "key", "left").crossJoin(F.broadcast(first))
    t = t.withColumn("above", F.when(low, F.col("above")).when(F.col("parent").isNotNull(), F.col("root_lo"))).join(member_digests(trie.members).withColumnRenamed("seq", "node"), "node", "left")
    depths = F.when(F.col("parent").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.col("top") + 1, F.col("depth")))
    d = t.filter("n > 0").withColumn("d", F.explode(depths))
    before, last = F.when(F.col("parent").isNull(), 0).otherwise(F.get("w", F.col("d") - F.col("top") - 1)), F.col("d") == F.col("depth")
    saved = F.col("reached") - F.col("n") * before - (F.col("spelt") - (before - F.get("w", F.lit(0))))
    return d.select(
        F.col("lo").alias("conv_id"),
        F.col("d").cast("bigint").alias("depth"),
        F.when(F.col("d") > F.col("top") + 1, F.col("lo")).otherwise(F.col("above")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(last, F.col("children")).otherwise(1).alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        saved.alias("saved_tokens"),
        F.when(last, F.coalesce("ends_sha256", F.lit(EMPTY_SHA))).otherwise(EMPTY_SHA).alias("ends_sha256"),
    )


def trie_report(conversations: DataFrame) -> DataFrame:
    """Rebuild the conversations, insert them, and report every prefix. Nulls, ties, long and turnless conversations, extra
    columns: as in turn_lists(), rebuilt(), build() and node_report()."""
    return node_report(build(rebuilt(turn_lists(conversations))))


TRIE_SQL = """
with crc_table as (select list(v order by i) as l from (select i, list_reduce(list_prepend(i::bigint, [0::bigint, 0, 0, 0, 0, 0, 0, 0]), lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end) as v from range(256) r(i))),
lists as (select conv_id, list({'d': md5(length(r)::varchar || ':' || r || t), 'n': length(t)} order by turn nulls first, md5(length(r)::varchar || ':' || r || t)) as turns
  from (select conv_id, turn, coalesce(role, '') as r, coalesce(text, '') as t from conversations where conv_id is not null) group by conv_id),
heads as (select conv_id, turns, (xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda x: ord(x)::bigint)), lambda c, b: xor(c >> 8, l[(xor(c, b) & 255) + 1])), 4294967295::bigint) % 6)::int as h from lists, crc_table),
convs as (select c.conv_id as c, coalesce(b.turns[1:c.h], []) || c.turns[c.h + 1:] as turns from heads c left join lists b on b.conv_id = c.conv_id - c.conv_id % 100),
steps as (select c, d::bigint as d, len(turns) as len, turns[1:d] as p, case when d > 0 then turns[1:d - 1] end as up, case when d > 0 then turns[d]['n'] else 0 end as n from (select *, unnest(range(0, len(turns) + 1)) as d from convs)),
nodes as (select p, any_value(up) as up, any_value(d) as depth, min(c) as conv_id, count(*) as n_convs, (count(*) - 1) * any_value(n) as saved,
  sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (len = d), '')) as ends_sha256 from steps group by p),
children as (select up as p, count(*) as n from nodes where up is not null group by 1),
whole as (select nodes.*, coalesce(children.n, 0) as n_children from nodes left join children using (p)),
below as (select p[1:d] as p, sum(saved)::bigint as saved_tokens, count(*) filter (n_children = 0) as n_leaves from (select *, unnest(range(0, depth + 1)) as d from whole) group by 1)
select w.conv_id, w.depth, u.conv_id as parent_conv_id, w.n_convs, w.n_children, b.n_leaves, b.saved_tokens, w.ends_sha256 from whole w join below b using (p) left join nodes u on u.p = w.up
"""
