"""Operator 4, Jaccard join of documents on word n-grams, and the components of its links.

Documents with the same shingle set form a class; only class representatives (smallest doc_id) are joined.  Every
set is ordered rarest first, by the class of its shingle in a hashed table of counts over all documents and then by
hash.  Two sets that link share a shingle in the first ``n - ceil(t * n) + 1`` of both, so those are the postings.

1. Each posting list proposes its members' pairs with its smallest representative only; verified links give first
   components.  This joins groups of copies without pairing their members.
2. Posting lists whose members lie in several components are read again, in tiles: lists are cut into tiles of
   bounded size, rows are ordered by set size, and a pair of different components is compared while the sizes may
   still link (size band).  Bitmaps (parity of hashed shingles) bound the overlap from above: every differing bit
   is a shingle that only one side has; pairs that pass are held against wider ones.  What passes is verified and complete the components.

Verification intersects the two sorted shingle arrays.  A link within a component of step 1 can't change it and
isn't looked for (:mod:`ngram_links` finds them all).  A doc_id names one text: rows that repeat one
are copies.  No list is cut short: a list of any length is compared whole, over as many tasks as it has pairs of tiles.

Defined cases: a null or wordless text has an empty set and links with nothing; one with fewer than n words has its word
sequence as its only shingle; rows without doc_id keep a null component; an empty table
gives an empty result.  The n-grams are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .components import components
from .shared import chunks, files_for, input_partitions, rows_of, stored, table

#: Counters of the hashed table of shingle counts: its size is fixed, so it may be collected and sent to all tasks.
COUNTERS = 1 << 18
#: Bits of a document's bitmap.
BITS = 512
#: Pairs that a task verifies at least, if it comes to few: their whole shingle sets go along.
TASK_PAIRS = 256
#: Rows of a posting list that one tile holds.
TILE = 4096


def _sets(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = W.column_bytes(column)
    return W.shingles(W.words(W.LOWER[data], offsets), k)


def counters(docs: DataFrame, k: int) -> np.ndarray:
    """How many documents hold each hashed shingle class, as base-2 logarithms (one byte each)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in chunks(batches, "text"):
            _, h = _sets(batch.column("text"), k)
            total += np.bincount((h % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
        held = np.flatnonzero(total)
        for at in range(0, len(held), 10_000):
            part = held[at:at + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(total[part])], names=["counter", "n"])

    rows = docs.select("text").mapInArrow(run, "counter long, n long").groupBy("counter").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(COUNTERS, np.int64)
    out[rows.column("counter").to_numpy()] = rows.column("n").to_numpy()
    return np.log2(out + 1).astype(np.uint8)


def signatures(docs: DataFrame, k: int, share: tuple[int, int]) -> DataFrame:
    """(doc_id, n, f1, f2, prefix, bits): set size, fingerprint of the set, first shingles and bitmap."""
    array = T.ArrayType(T.LongType(), False)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), *(T.StructField(c, T.LongType(), False) for c in ("n", "f1", "f2")),
                           *(T.StructField(c, array, False) for c in ("prefix", "bits", "wide"))])
    levels = docs.sparkSession.sparkContext.broadcast(counters(docs, k))
    num, den = share

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = levels.value
        for batch in chunks(batches, "text"):
            m = batch.num_rows
            doc, h = _sets(batch.column("text"), k)
            n = np.bincount(doc, minlength=m)
            first = np.cumsum(n) - n
            order = np.lexsort((h, level[(h % np.uint64(COUNTERS)).astype(np.int64)], doc))
            place = np.arange(len(h)) - first[doc]
            length = np.where(n > 0, n - (-(-num * n // den)) + 1, 0)
            take = place < length[doc]
            ends = np.r_[0, np.cumsum(length)].astype(np.int32)
            prints = []
            for salt in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
                running = np.r_[np.uint64(0), np.cumsum(W.mixed(h ^ np.uint64(salt)), dtype=np.uint64)]
                prints.append((running[first + n] - running[first]).view(np.int64))
            odd = np.bincount(doc * BITS + (h >> np.uint64(40)).astype(np.int64) % BITS, minlength=m * BITS) & 1
            bitmaps = np.packbits(odd.astype(bool)).view(np.int64)
            sixty_four = np.arange(0, len(bitmaps) + 1, BITS // 64, dtype=np.int32)
            # Twice as many bits as shingles (a power of two), for the sizes that BITS can't tell apart.
            room = np.maximum(BITS, 1 << np.ceil(np.log2(np.maximum(2 * n, 1))).astype(np.int64))
            base = np.r_[0, np.cumsum(room)]
            odd = np.bincount(base[doc] + ((h >> np.uint64(20)).astype(np.int64) & (room[doc] - 1)), minlength=base[-1]) & 1
            wide = np.packbits(odd.astype(bool)).view(np.int64)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(n.astype(np.int64)), *(pa.array(p) for p in prints),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(h[order][take].view(np.int64))),
                pa.ListArray.from_arrays(pa.array(sixty_four), pa.array(bitmaps)),
                pa.ListArray.from_arrays(pa.array((base // 64).astype(np.int32)), pa.array(wide))], names=["doc_id", "n", "f1", "f2", "prefix", "bits", "wide"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def sets_of(docs: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """(rep, hashes): the sorted shingle sets, as 64-bit integers, of all documents in the stored ``pairs``."""
    ids = stored(pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct(), "ids",
                 rows=2 * pairs.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            doc, h = _sets(batch.column("text"), k)
            ends = np.r_[0, np.cumsum(np.bincount(doc, minlength=batch.num_rows))].tolist()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(
                [h[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())], names=["rep", "hashes"])

    return rows_of(docs.select("doc_id", "text"), ids, "doc_id").mapInArrow(run, "rep long, hashes binary")


def verified(pairs: DataFrame, docs: DataFrame, k: int, share: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) of the stored ``pairs`` whose documents link."""
    num, den = share
    sets = stored(sets_of(docs, pairs, k), "sets")
    one = sets.select(F.col("rep").alias("a"), F.col("hashes").alias("x"))
    two = sets.select(F.col("rep").alias("b"), F.col("hashes").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "x"):
            links = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                links.append(den * both >= num * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(links, pa.bool_()))

    met = pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").coalesce(files_for(pairs.count(), TASK_PAIRS))
    return met.mapInArrow(run, "a long, b long")


def passing(pairs: DataFrame, sizes: DataFrame, share: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) that may link by the sizes and wide bitmaps of ``sizes`` (rep, n, wide).

    Sizes in the band differ by less than a factor of two, so bitmaps differ by one doubling at most: the longer is folded.
    """
    num, den = share
    xor = lambda x, y: F.zip_with(x, y, lambda p, q: p.bitwiseXOR(q))
    half = lambda c: F.size(c) / 2
    folded = lambda c: xor(F.slice(c, F.lit(1), half(c).cast("int")), F.slice(c, half(c).cast("int") + 1, half(c).cast("int")))
    side = lambda c: sizes.select(F.col("rep").alias(c), F.col("n").alias(f"n{c}"), F.col("wide").alias(f"w{c}"))
    la, lb = F.size("wa"), F.size("wb")
    apart = F.when(la == lb, xor(F.col("wa"), F.col("wb"))).when(la > lb, xor(folded(F.col("wa")), F.col("wb"))).otherwise(
        xor(F.col("wa"), folded(F.col("wb"))))
    differing = F.aggregate(F.transform(apart, F.bit_count), F.lit(0), lambda t, x: t + x)
    total = F.col("na") + F.col("nb")
    most = F.least("na", "nb", F.floor((total - differing) / 2))
    sized = pairs.join(side("a"), "a").join(side("b"), "b").filter(den * F.least("na", "nb") >= num * F.greatest("na", "nb"))
    return sized.filter(den * most >= num * (total - most)).select("a", "b")


def may_link(n1: np.ndarray, n2: np.ndarray, differing: np.ndarray, share: tuple[int, int]) -> np.ndarray:
    """Whether sets of these sizes may link, given the number of bits in which their bitmaps differ."""
    most = np.minimum(np.minimum(n1, n2), (n1 + n2 - differing) // 2)
    return share[1] * most >= share[0] * (n1 + n2 - most)


def tiled_pairs(postings: DataFrame, share: tuple[int, int], rows: int | None = None) -> DataFrame:
    """Pairs (a, b) of ``postings`` (token, rep, n, component, bits) that share a token and may link, in tiles of ``rows`` (``TILE``)."""
    size = postings.groupBy("token").agg(F.ceil(F.count(F.lit(1)) / (rows or TILE)).cast("int").alias("tiles"))
    tile = F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int")
    cut = postings.join(size, "token").withColumn("tile", tile)
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    spread = cut.select("token", "rep", "n", "component", "bits", "tile", other)
    met = spread.select("token", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"),
                        "n", "rep", "component", "tile", "bits")
    met = met.repartition(input_partitions(postings), "token", "low", "high").sortWithinPartitions("token", "low", "high", "n")

    def compare(rows: pa.Table) -> pa.RecordBatch:
        token, low, high, n, rep, component, tile = (rows.column(c).to_numpy() for c in range(7))
        bits = rows.column("bits").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(n), BITS // 64)
        a, b = [], []
        alive, d = np.arange(len(n)), 0
        while True:
            d += 1
            alive = alive[alive + d < len(n)]
            far = alive + d
            # rows of one list stand by size: once the larger is out of the band, all that follow are
            inside = ((token[alive] == token[far]) & (low[alive] == low[far]) & (high[alive] == high[far])
                      & (share[0] * n[far] <= share[1] * n[alive]))
            alive = alive[inside]
            if not len(alive):
                break
            far = alive + d
            cross = (component[alive] != component[far]) & ((low[alive] == high[alive]) | (tile[alive] != tile[far]))
            i, j = alive[cross], far[cross]
            differing = np.bitwise_count(bits[i] ^ bits[j]).sum(1, dtype=np.int64)
            pass_ = may_link(n[i], n[j], differing, share)
            a.append(np.minimum(rep[i[pass_]], rep[j[pass_]]))
            b.append(np.maximum(rep[i[pass_]], rep[j[pass_]]))
        none = np.zeros(0, np.int64)
        both = np.unique(np.stack([np.concatenate([none, *a]), np.concatenate([none, *b])], 1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # rows of the last list seen, whose end may be still to come
        for batch in batches:
            held.append(batch)
            token, low, high = (batch.column(c).to_numpy() for c in range(3))
            last = (token == token[-1]) & (low == low[-1]) & (high == high[-1])
            if last.all():
                first = held[0]
                if len(held) == 1 or all(first.column(c)[first.num_rows - 1] == batch.column(c)[0] for c in range(3)):
                    continue
            start = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
            yield compare(pa.Table.from_batches([*held[:-1], batch.slice(0, start)]))
            held = [batch.slice(start)]
        if held:
            yield compare(pa.Table.from_batches(held))

    return met.mapInArrow(run, "a long, b long").distinct()


def join(docs: DataFrame, *, k: int = 5, share: tuple[int, int] = (80, 100)) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document; links need ``share`` (a fraction over 1/2) of the union."""
    if 2 * share[0] <= share[1]:
        raise ValueError("shares up to 1/2 are not supported: bitmaps are compared over one doubling of size")
    signed = stored(signatures(docs, k, share), "signatures")
    full = signed.filter((F.col("n") > 0) & F.col("doc_id").isNotNull())
    classes = stored(full.groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("rep")), "classes", rows=signed.count())
    members = stored(full.join(classes, ["f1", "f2", "n"]).filter(F.col("doc_id") == F.col("rep")).select(
        "rep", "n", "prefix", "bits", "wide"), "members", rows=classes.count())
    sizes = members.select("rep", "n", "wide")

    # A list has a row per class at most and a class is on dozens of lists, so no list holds more than a small share.
    lists = members.select("rep", "n", F.explode("prefix").alias("token")).repartition(input_partitions(docs), "token")
    shared = lists.groupBy("token").agg(F.count(F.lit(1)).alias("size"), F.min("rep").alias("leader")).filter("size > 1")
    postings = stored(lists.join(shared, "token").select("token", "rep", "n", "leader"), "postings")

    stars = postings.filter("rep != leader").select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct()
    near = stored(passing(stars, sizes, share), "near", rows=postings.count())
    first_links = stored(verified(near, docs, k, share), "links")
    first = stored(components(first_links).withColumnRenamed("node", "rep"), "first", rows=2 * first_links.count())

    split = postings.join(first, "rep", "left").select("token", "rep", "n", F.coalesce("component", "rep").alias("component"))
    open_lists = split.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo != hi").select("token")
    again = split.join(open_lists, "token", "left_semi").join(members.select("rep", "bits"), "rep")
    tiled = stored(tiled_pairs(again, share), "tiled")
    candidates = stored(passing(tiled, sizes, share), "candidates", rows=tiled.count())
    links = stored(verified(candidates, docs, k, share), "links")
    found = components(first_links.unionByName(links))

    reps = classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "f1", "f2", "n", F.coalesce("component", "rep").alias("component_id"))
    return signed.select("doc_id", "n", "f1", "f2").join(reps, ["f1", "f2", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def query(spark, sf_dir):
    return join(table(spark, sf_dir, "documents"), k=4, share=(85, 100))


ORACLE = r"""
WITH t AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)]) END) AS g FROM t),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
e AS (SELECT a.doc_id AS x, b.doc_id AS y FROM s a JOIN s b USING (g) JOIN n p ON p.doc_id = a.doc_id JOIN n q ON q.doc_id = b.doc_id
    WHERE 20 * p.n >= 17 * q.n AND 20 * q.n >= 17 * p.n
    GROUP BY 1, 2, p.n, q.n HAVING 100 * count(*) >= 85 * (p.n + q.n - count(*))),
r AS (WITH RECURSIVE c(x, y) AS (SELECT x, y FROM e UNION SELECT c.x, e.y FROM c JOIN e ON c.y = e.x) SELECT x, min(y) AS y FROM c GROUP BY 1)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(r.y, doc_id) AS component_id
FROM t LEFT JOIN n USING (doc_id) LEFT JOIN r ON r.x = doc_id
"""
