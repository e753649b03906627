"""Operator 11, conversation prefix trie, by vertical bitmaps.

A node is a distinct sequence of first turns (role, text) and stands for the conversations that start with it.
Conversations are range-partitioned by id and cut into shards.  A shard indexes (position, turn) to a bitset of its conversations; a
depth-first walk intersects a node's bitset with the postings of the next position, which yields its children, and a child's popcount, its
smallest member and the list of members that end in it.  The tries of all shards are then merged: a node's key is the sum, over its turns, of two
64-bit hashes of (position, SHA-256 of the turn), so it is the same in every shard and needs no parent to be looked up.

Sums over subtrees need every node once: a node belongs to the shard of its smallest member, sends its values there, the shard
sums them over its own preorder, and the partial sums of a node's shards are added.

No task holds a whole conversation: positions come from a global rank, and a conversation is cut every ``SEGMENT`` turns.  Each later segment is a shard of
its own, whose root key is the sum of the hashes before it; what its subtree sums to is handed to the last node of the segment before.  The ids
that end in one node are listed in pieces of ``PIECE`` ids, and hashed as a stream in order.

Defined cases: rows without conv_id take no part; a null turn comes first; a null role or text is empty; rows of a conversation with the
same turn are ordered by role, then text, and equal rows are a turn each; other columns are ignored; an empty table has no nodes,
not even the root.  Ids below 0 take the remainder towards 0, as in SQL.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import input_partitions, stored, table

#: Turns of a segment, and conversations and rows from which a shard takes no more.
SEGMENT = 1024
SHARD_CONVS = 2048
SHARD_ROWS = 1 << 16
#: Ids of a piece of an end list.
PIECE = 256

_MASK = (1 << 64) - 1
_NODES = ("shard long, pre long, stop long, a long, b long, pa long, pb long, depth long, n long, conv long, n_bytes long, seg long, "
          "tails array<long>, ends array<struct<first:long,ids:string>>")


def ordered(conversations: DataFrame) -> DataFrame:
    """(conv_id, part, seq, digest, n_bytes): turns in order of seq, which are consecutive within a part; stored.

    The text is shuffled once.  Equal rows are dealt by their place in the input, so that they need not fall into one partition.
    """
    order = [F.col("conv_id").asc(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc(), F.col("salt").asc()]
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("salt"))
    framed = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    ranged = turns.repartitionByRange(input_partitions(conversations), *order).sortWithinPartitions(*order)
    return stored(ranged.select("conv_id", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("seq"),
                                F.substring(F.unhex(F.sha2(framed, 256)), 1, 16).alias("digest"),
                                F.octet_length("text").cast("long").alias("n_bytes")), "turns")


def borrowed() -> Column:
    """How many turns a conversation takes from the first one of its five."""
    return F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, digest, n_bytes, length): positions from 1; a row of position 0 for every conversation."""
    runs = turns.groupBy("conv_id", "part").agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("n"))
    each = Window.partitionBy("conv_id")
    before = F.coalesce(F.sum("n").over(each.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.withColumn("before", before).withColumn("own", F.sum("n").over(each))
    base = F.col("conv_id") - F.col("conv_id") % 5
    runs = runs.withColumn("base", base).withColumn("head", borrowed())
    heads = runs.filter((F.col("before") == 0) & (F.col("conv_id") % 5 == 0)).select(F.col("conv_id").alias("base"), F.col("own").alias("there"))
    runs = runs.join(heads, "base", "left").withColumn("taken", F.least("head", F.coalesce("there", F.lit(0))))
    runs = stored(runs.withColumn("length", F.col("taken") + F.greatest(F.col("own") - F.col("head"), F.lit(0))), "runs")

    ranked = turns.join(runs.drop("n"), ["conv_id", "part"]).withColumn("rank", F.col("before") + F.col("seq") - F.col("first"))
    own = ranked.filter("rank >= head").select("conv_id", (F.col("rank") - F.col("head") + F.col("taken") + 1).alias("pos"), "digest", "n_bytes", "length")
    convs = runs.filter("before = 0")
    start = ranked.filter((F.col("conv_id") % 5 == 0) & (F.col("rank") < 8)).select(F.col("conv_id").alias("base"), "rank", "digest", "n_bytes")
    lent = start.join(convs.select("base", "conv_id", "head", "length"), "base").filter("rank < head").select(
        "conv_id", (F.col("rank") + 1).alias("pos"), "digest", "n_bytes", "length")
    roots = convs.select("conv_id", F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("n_bytes"), "length")
    return own.unionByName(lent).unionByName(roots)


def _wrapped(total: Column) -> Column:
    """A sum of longs, as a decimal, modulo 2**64 as a long."""
    low = F.pmod(total, F.expr(f"{1 << 64}BD"))
    return F.when(low < F.expr(f"{1 << 63}BD"), low).otherwise(low - F.expr(f"{1 << 64}BD")).cast("long")


def segments(turns: DataFrame) -> DataFrame:
    """Hashed turns, and before every later segment of a conversation a row (``kind`` 0) with the sums of the hashes before it."""
    none = F.col("pos") == 0
    hashed = turns.select(
        "conv_id", F.expr(f"pos div {SEGMENT}").alias("seg"), F.lit(1).alias("kind"), "pos",
        F.when(none, 0).otherwise(F.xxhash64("digest", "pos")).alias("a"), F.when(none, 0).otherwise(F.xxhash64("pos", "digest", F.lit(7))).alias("b"),
        "n_bytes", "length")
    sums = (hashed.filter(F.col("length") >= SEGMENT).groupBy("conv_id", "seg")
            .agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in "ab"], F.max("length").alias("length")))
    before = Window.partitionBy("conv_id").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select("conv_id", "seg", F.lit(0).alias("kind"), (F.col("seg") * SEGMENT - 1).alias("pos"),
                          *[_wrapped(F.sum(c).over(before)).alias(c) for c in "ab"], F.lit(0).cast("long").alias("n_bytes"), "length").filter("seg > 0")
    return hashed.unionByName(carried)


class _Out:
    """Nodes of the shards of a task, as columns."""

    def __init__(self):
        self.columns = [[] for _ in _NODES.split(", ")]

    def __len__(self) -> int:
        return len(self.columns[0])

    def add(self, *row) -> None:
        for column, value in zip(self.columns, row, strict=True):
            column.append(value)

    def batch(self) -> pa.RecordBatch:
        types = [pa.int64()] * 12 + [pa.list_(pa.int64()), pa.list_(pa.struct([("first", pa.int64()), ("ids", pa.string())]))]
        names = [c.split(" ")[0] for c in _NODES.split(", ")]
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(self.columns, types, strict=True)], names=names)
        self.__init__()
        return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _members(bits: int) -> list[int]:
    out = []
    while bits:
        low = bits & -bits
        out.append(low.bit_length() - 1)
        bits ^= low
    return out


def walk(shard: int, convs: list[int], paths: list[list[tuple[int, int, int]]], lengths: list[int], root: tuple[int, int, int] | None, seg: int, out: _Out) -> None:
    """The trie of conversations, ascending by id, into ``out``: ``paths`` have (a, b, n_bytes) of every position.

    With ``root`` (key and depth of the last node before) the one conversation is a later segment, and the root isn't a node.
    """
    postings: dict[tuple[int, int, int], int] = {}
    ends: dict[int, int] = {}
    cut: dict[int, int] = {}
    for i, path in enumerate(paths):
        bit = 1 << i
        for p, (a, b, _) in enumerate(path):
            postings[p, a, b] = postings.get((p, a, b), 0) | bit
        last = ends if (root[2] if root else 0) + len(path) == lengths[i] else cut
        last[len(path)] = last.get(len(path), 0) | bit
    # Nodes in preorder: (bits, position, key, parent's key, n_bytes, parent's place).
    keys, parent, sizes, rows = [], [], [], []
    at = root or (0, 0, 0)
    stack = [((1 << len(convs)) - 1, 0, at[0], at[1], None, None, 0, -1)]
    while stack:
        bits, p, a, b, pa_, pb, n_bytes, above = stack.pop()
        here = len(rows)
        over = ends.get(p, 0) & bits
        stop = cut.get(p, 0) & bits
        ids = [convs[i] for i in _members(over)]
        rows.append((a, b, pa_, pb, at[2] + p, bits.bit_count(), convs[(bits & -bits).bit_length() - 1], n_bytes,
                     [convs[i] for i in _members(stop)],
                     [{"first": ids[k], "ids": ",".join(map(str, ids[k:k + PIECE]))} for k in range(0, len(ids), PIECE)]))
        parent.append(above)
        rest = bits & ~over & ~stop
        while rest:
            i = (rest & -rest).bit_length() - 1
            ha, hb, size = paths[i][p]
            child = bits & postings[p, ha, hb]
            rest &= ~child
            stack.append((child, p + 1, (a + ha) & _MASK, (b + hb) & _MASK, a, b, size, here))
    sizes = [1] * len(rows)
    for i in range(len(rows) - 1, 0, -1):
        sizes[parent[i]] += sizes[i]
    for i, (a, b, pa_, pb, depth, n, conv, n_bytes, tails, pieces) in enumerate(rows):
        if root and i == 0:
            continue
        out.add(shard, i, i + sizes[i], _signed(a), _signed(b), None if pa_ is None else _signed(pa_), None if pb is None else _signed(pb),
                depth, n, conv, n_bytes, seg, tails, pieces)


def tries(turns: DataFrame) -> DataFrame:
    """The nodes of every shard: ``pre`` and ``stop`` bound a node's subtree in the shard's preorder; stored."""
    names = ["conv_id", "seg", "kind", "pos", "a", "b", "n_bytes", "length"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        out, made, rows = _Out(), TaskContext.get().partitionId() << 32, 0
        convs: list[int] = []
        paths: list[list[tuple[int, int, int]]] = []
        lengths: list[int] = []
        segment: list[tuple] = []

        def close() -> None:
            nonlocal made, rows
            if convs:
                walk(made, convs, paths, lengths, None, 0, out)
                made, rows = made + 1, 0
                convs.clear(), paths.clear(), lengths.clear()

        def take() -> None:
            """The rows of a whole segment join the shard, or are one."""
            nonlocal made, rows
            conv, seg, _, pos, a, b, _, length = segment[0]
            path = [(r[4] & _MASK, r[5] & _MASK, r[6]) for r in segment[1:]]
            if seg:
                walk(made, [conv], [path], [length], (a & _MASK, b & _MASK, pos), seg, out)
                made += 1
                return
            convs.append(conv), paths.append(path), lengths.append(length)
            rows += len(path)
            if len(convs) >= SHARD_CONVS or rows >= SHARD_ROWS:
                close()

        for batch in batches:
            for row in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
                if segment and row[:2] != segment[0][:2]:
                    take()
                    segment = []
                    if len(out) >= 8192:
                        yield out.batch()
                segment.append(row)
        if segment:
            take()
        close()
        if len(out):
            yield out.batch()

    whole = segments(turns)
    sorted_rows = whole.repartitionByRange(input_partitions(turns), "conv_id", "seg").sortWithinPartitions("conv_id", "seg", "kind", "pos")
    return stored(sorted_rows.select(*names).mapInArrow(run, _NODES), "tries")


def end_digests(nodes: DataFrame) -> DataFrame:
    """(a, b, ends_sha256) of the nodes in which a conversation ends; ids are hashed as they come, in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            done = []
            for a, b, ids in zip(*(batch.column(n).to_pylist() for n in ("a", "b", "ids")), strict=True):
                if (a, b) != key:
                    if key:
                        done.append((*key, digest.hexdigest()))
                    key, digest = (a, b), hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            if done:
                yield _rows(done)
        if key:
            yield _rows([(*key, digest.hexdigest())])

    def _rows(done: list[tuple]) -> pa.RecordBatch:
        a, b, text = zip(*done, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(text, pa.string())], names=["a", "b", "ends_sha256"])

    pieces = nodes.select("a", "b", F.inline("ends"))
    return pieces.repartition("a", "b").sortWithinPartitions("a", "b", "first").select("a", "b", "ids").mapInArrow(run, "a long, b long, ends_sha256 string")


def subtree_sums(nodes: DataFrame, values: DataFrame) -> DataFrame:
    """(a, b, n_leaves, saved_tokens): the sums of ``values`` (shard, pre, conv_id, depth, leaf, saved) over every node's subtree."""
    later = (values.filter(F.col("depth") >= SEGMENT).groupBy("conv_id", F.expr(f"depth div {SEGMENT}").alias("seg"))
             .agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved")))
    tails = nodes.filter(F.size("tails") > 0).select("shard", "pre", "seg", F.explode("tails").alias("conv_id"))
    zero = F.lit(0).cast("long")
    both = tails.select("conv_id", "seg", "shard", "pre", zero.alias("leaf"), zero.alias("saved")).unionByName(
        later.select("conv_id", "seg", F.lit(None).cast("long").alias("shard"), F.lit(None).cast("long").alias("pre"), "leaf", "saved"))
    after = Window.partitionBy("conv_id").orderBy(F.desc("seg")).rangeBetween(Window.unboundedPreceding, -1)
    handed = both.select("shard", "pre", *[F.coalesce(F.sum(c).over(after), zero).alias(c) for c in ("leaf", "saved")]).filter("shard is not null")
    empty = F.lit(None).cast("long")
    every = nodes.select("shard", "pre", zero.alias("kind"), "stop", "a", "b", zero.alias("leaf"), zero.alias("saved"))
    for more in (values, handed):
        every = every.unionByName(more.select("shard", "pre", (zero + 1).alias("kind"), empty.alias("stop"), empty.alias("a"), empty.alias("b"), "leaf", "saved"))
    names = ["shard", "pre", "kind", "stop", "a", "b", "leaf", "saved"]

    def shard_sums(rows: list[np.ndarray]) -> pa.RecordBatch:
        _, pre, kind, stop, a, b, leaf, saved = rows
        own = kind == 0
        # Sums before each place of the preorder; a place's node comes before its values.
        places, start = pre[own], np.flatnonzero(own)
        until = np.append(start, len(pre))[np.searchsorted(places, stop[own])]
        sums = []
        for x in (leaf, saved):
            upto = np.concatenate([[0], np.cumsum(x)])
            sums.append(upto[until] - upto[start])
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (a[own], b[own], *sums)], names=["a", "b", "leaves", "tokens"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            rows = [batch.column(n).fill_null(0).to_numpy(zero_copy_only=False) for n in names]
            rows = rows if held is None else [np.concatenate(x) for x in zip(held, rows, strict=True)]
            edges = np.concatenate([[0], np.flatnonzero(np.diff(rows[0])) + 1])
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                yield shard_sums([x[lo:hi] for x in rows])
            held = [x[edges[-1]:] for x in rows]
        if held is not None and len(held[0]):
            yield shard_sums(held)

    sums = every.repartition("shard").sortWithinPartitions("shard", "pre", "kind").select(*names).mapInArrow(run, "a long, b long, leaves long, tokens long")
    return sums.groupBy("a", "b").agg(F.sum("leaves").alias("n_leaves"), F.sum("tokens").alias("saved_tokens"))


def trie(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node."""
    nodes = tries(rebuilt(ordered(conversations)))
    merged = stored(nodes.groupBy("a", "b").agg(
        F.sum("n").alias("n_convs"), F.min("conv").alias("conv_id"), F.max("depth").alias("depth"), F.max("pa").alias("pa"), F.max("pb").alias("pb"),
        F.max("n_bytes").alias("n_bytes"), F.min_by("shard", "conv").alias("shard"), F.min_by("pre", "conv").alias("pre")), "nodes")
    children = merged.filter(F.col("pa").isNotNull()).groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count(F.lit(1)).alias("n_children"))
    merged = stored(merged.join(children, ["a", "b"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "linked")
    values = merged.select("shard", "pre", "conv_id", "depth", (F.col("n_children") == 0).cast("long").alias("leaf"),
                           ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"))
    parents = merged.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    full = merged.join(subtree_sums(nodes, values), ["a", "b"]).join(end_digests(nodes), ["a", "b"], "left").join(parents, ["pa", "pb"], "left")
    return full.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                       F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def query(spark, sf_dir):
    return trie(table(spark, sf_dir, "conversations"))


ORACLE = """
WITH t AS (SELECT conv_id, {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS said,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS at
           FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, count(*) AS n, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten([
               [CAST(ascii(x) AS BIGINT), 0, 0, 0, 0, 0, 0, 0] FOR x IN string_split(CAST(conv_id AS VARCHAR), '')])),
               LAMBDA s, x : xor(xor(s, x) >> 1, 3988292384 * (xor(s, x) & 1)))) % 9 AS h
        FROM t GROUP BY conv_id),
c AS (SELECT o.conv_id, o.conv_id - o.conv_id % 5 AS base, o.h, least(o.h, coalesce(b.n, 0)) AS taken, o.n
      FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 5),
r AS (SELECT c.conv_id, t.at - c.h + c.taken AS pos, t.said FROM c JOIN t USING (conv_id) WHERE t.at > c.h
      UNION ALL SELECT c.conv_id, t.at, t.said FROM c JOIN t ON t.conv_id = c.base WHERE t.at <= c.taken),
m AS (SELECT conv_id, pos AS depth, list(said) OVER (PARTITION BY conv_id ORDER BY pos) AS path, strlen(said.text) AS size FROM r
      UNION ALL SELECT conv_id, 0, [], 0 FROM c),
e AS (SELECT conv_id, taken + greatest(n - h, 0) AS depth FROM c),
node AS (SELECT m.depth, m.path, min(m.conv_id) AS conv_id, count(*) AS n_convs, max(m.size) AS size,
                coalesce(string_agg(CAST(e.conv_id AS VARCHAR), ',' ORDER BY e.conv_id), '') AS ends
         FROM m LEFT JOIN e ON e.conv_id = m.conv_id AND e.depth = m.depth GROUP BY m.depth, m.path),
kids AS (SELECT depth - 1 AS depth, path[:depth - 1] AS path, count(*) AS n FROM node WHERE depth > 0 GROUP BY 1, 2),
full_node AS (SELECT node.*, coalesce(kids.n, 0) AS n_children FROM node LEFT JOIN kids ON kids.depth = node.depth AND kids.path = node.path),
below AS (SELECT a.depth, a.path, count(*) FILTER (d.n_children = 0) AS n_leaves, sum((d.n_convs - 1) * d.size) AS saved
          FROM full_node a JOIN full_node d ON d.depth >= a.depth AND d.path[:a.depth] = a.path GROUP BY 1, 2)
SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, b.n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens,
       sha256(f.ends) AS ends_sha256
FROM full_node f JOIN below b ON b.depth = f.depth AND b.path = f.path
LEFT JOIN node p ON p.depth = f.depth - 1 AND p.path = f.path[:f.depth - 1]
"""
