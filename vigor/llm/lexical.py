"""Operator 13, ranked lexical search, with buckets by norm.

A document is its impact vector: for every term that an item has, weight times saturated frequency.  The score of an
item is the inner product of its term counts with that vector.  Documents are ordered by the length of the vector, the longest first, and
runs of them are buckets.  For an item and a bucket:

1. Cauchy-Schwarz: length of the item times the greatest length in the bucket is below the item's k-th score: the bucket goes.
2. Coordinate bounds: the item's counts times the greatest impact of each term in the bucket are below it: the bucket goes.
3. Inside, the item's ``FOCUS`` terms with the greatest bounds are summed for each document from the bucket's postings.  What the other terms
   can add is at most the smaller of their coordinate bounds and the product of what is left of both lengths.  Documents that can't reach the
   k-th score go.
4. Survivors are scored again over all terms, in 64-bit integers.

Ties with the k-th score survive.  The first buckets of all (about ``SEEDS`` documents with the longest vectors) are searched first, and their k-th scores
are where every task starts from; they only prune, so results don't depend on them.

Items are the stated query set.  They are taken in blocks of about ``ITEM_BYTES`` of text, and a block (its terms, counts and k-th scores) is what
tasks are sent; documents are read once per block.  Documents are never sent anywhere but to their bucket, and never expanded into pairs with items.

Defined cases: a null text, or one without terms, has none: such a document isn't counted and such an item gets no rows; every row of items is an item of its
own, whatever its item_id, and every row of documents a document; equal scores rank by doc_id, null last; other columns are ignored; empty
tables give an empty result.  Two terms whose 64-bit hashes are equal count as one (a chance of about 2**-64 a pair).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words as W
from .shared import chunks, input_partitions, stored, table

#: Text of the items that tasks are sent at once.
ITEM_BYTES = 16 << 20
#: Documents and postings of a bucket.
BUCKET = 4096
BUCKET_ENTRIES = 1 << 20
#: Documents that give the first k-th scores, and terms of an item that are summed before the bound.
SEEDS = 8192
FOCUS = 32

_TERM = np.zeros(256, bool)
_TERM[ord("0"):ord("9") + 1] = _TERM[ord("a"):ord("z") + 1] = _TERM[ord("A"):ord("Z") + 1] = _TERM[0x80:] = True


def terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Term hashes of all texts of an Arrow column, and the n + 1 places in them at which texts begin."""
    data, offsets = W.column_bytes(column)
    data = W.LOWER[data]
    starts, ends = W.runs(data, offsets, _TERM)
    return W.hashes(data, starts, ends), np.searchsorted(starts, offsets)


@dataclass
class Items:
    """A block of items: (item, place in ``vocabulary``, count) in order of the first two."""

    ids: list
    vocabulary: np.ndarray
    item: np.ndarray
    term: np.ndarray
    count: np.ndarray
    first: np.ndarray = field(init=False)

    def __post_init__(self):
        self.first = np.searchsorted(self.item, np.arange(len(self.ids) + 1))


def counted(hashes: np.ndarray, first: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place in the sorted vocabulary, count) of the terms that are in it."""
    if not len(vocabulary) or not len(hashes):
        none = np.zeros(0, np.int64)
        return none, none, none
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    known = vocabulary[at] == hashes
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    pairs, counts = np.unique(text[known] * len(vocabulary) + at[known], return_counts=True)
    return pairs // len(vocabulary), pairs % len(vocabulary), counts


def item_block(ids: list, texts: list) -> Items:
    hashes, first = terms(pa.array(texts, pa.string()))
    vocabulary = np.unique(hashes)
    return Items(ids, vocabulary, *counted(hashes, first, vocabulary))


def postings(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document with a term: all its terms counted in n, those of the vocabulary listed (int32 bytes)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            hashes, first = terms(batch.column("text"))
            text, term, tf = counted(hashes, first, vocabulary)
            n = np.diff(first)
            edges = (np.searchsorted(text, np.arange(len(n) + 1)) * 4).tolist()
            term, tf = term.astype("<i4").tobytes(), tf.astype("<i4").tobytes()
            has = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(has)), pa.array(n[has]),
                 *(pa.array([x[edges[i]:edges[i + 1]] for i in has.tolist()], pa.binary()) for x in (term, tf))], names=["doc_id", "n", "terms", "tfs"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, terms binary, tfs binary")


def document_frequencies(counts: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term of the vocabulary: added up per task, so a row a term and task is shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for held in batch.column("terms").to_pylist():
                total[np.frombuffer(held, "<i4")] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["term", "df"])

    out = np.zeros(size, np.int64)
    for r in counts.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator():
        out[r["term"]] = r["df"]
    return out


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def length_factor(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """m of documents of n terms each."""
    if 75 * int(n.max(initial=0)) * n_docs < 2 ** 62:
        return 25 + 75 * n * n_docs // n_terms
    return np.array([25 + 75 * x * n_docs // n_terms for x in n.tolist()], np.int64)


def impacts(term: np.ndarray, tf: np.ndarray, m: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


class Bucket:
    """Some documents as rows (doc, term, impact), and the same by term."""

    def __init__(self, rows: list[tuple], size: int):
        self.doc_ids = [r[0] for r in rows]
        self.norms = np.array([r[1] for r in rows])
        held = [np.frombuffer(r[2], "<i4") for r in rows]
        self.first = np.concatenate([[0], np.cumsum([len(x) for x in held])])
        self.term = np.concatenate(held) if held else np.zeros(0, np.int32)
        self.impact = np.concatenate([np.frombuffer(r[3], "<i8") for r in rows]) if rows else np.zeros(0, np.int64)
        doc = np.repeat(np.arange(len(rows)), np.diff(self.first))
        order = np.argsort(self.term, kind="stable")
        self.by_term, self.by_doc, self.by_impact = self.term[order], doc[order], self.impact[order]
        self.start = np.searchsorted(self.by_term, np.arange(size + 1))
        self.top = np.zeros(size, np.int64)
        here = np.flatnonzero(np.diff(self.start))
        if len(here):
            self.top[here] = np.maximum.reduceat(self.by_impact, self.start[here])
        self.norm = float(self.norms.max(initial=0.0))

    def scores(self, term: np.ndarray, count: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Exact scores of some documents of the bucket."""
        out = np.zeros(len(docs), np.int64)
        if int(np.diff(self.start)[term].sum()) <= int(np.diff(self.first)[docs].sum()):
            whole = np.zeros(len(self.doc_ids), np.int64)
            for t, c in zip(term.tolist(), count.tolist(), strict=True):
                span = slice(self.start[t], self.start[t + 1])
                whole[self.by_doc[span]] += c * self.by_impact[span]  # a document is in a list once
            return whole[docs]
        query = np.zeros(len(self.top), np.int64)
        query[term] = count
        for i, d in enumerate(docs.tolist()):
            span = slice(self.first[d], self.first[d + 1])
            out[i] = query[self.term[span]] @ self.impact[span]
        return out


class Search:
    """The k best documents of every item among the buckets seen so far, in a task."""

    def __init__(self, items: Items, k: int, least: np.ndarray | None = None):
        self.items, self.k = items, k
        self.least = np.ones(len(items.ids), np.int64) if least is None else np.maximum(least, 1)
        self.best: list[list[tuple]] = [[] for _ in items.ids]
        self.length = np.sqrt(np.bincount(items.item, items.count.astype(float) ** 2, len(items.ids)))
        #: Pairs of item and document: all, of pruned buckets (by length, by coordinates), filtered inside, scored.
        self.seen = np.zeros(5, np.int64)

    def take(self, bucket: Bucket) -> None:
        items, n = self.items, len(bucket.doc_ids)
        reach = np.bincount(items.item, items.count * bucket.top[items.term].astype(float), len(items.ids))
        self.seen[0] += n * len(items.ids)
        going = np.flatnonzero(self.length * bucket.norm * (1 + 1e-9) >= self.least)
        self.seen[1] += n * (len(items.ids) - len(going))
        near = going[reach[going] * (1 + 1e-9) >= self.least[going]]
        self.seen[2] += n * (len(going) - len(near))
        for i in near.tolist():
            span = slice(items.first[i], items.first[i + 1])
            term, count = items.term[span], items.count[span]
            most = count * bucket.top[term]
            order = np.argsort(-most, kind="stable")
            focus, rest = order[:FOCUS], order[FOCUS:]
            part, square = np.zeros(n, np.int64), np.zeros(n)
            for t, c in zip(term[focus].tolist(), count[focus].tolist(), strict=True):
                held = slice(bucket.start[t], bucket.start[t + 1])
                part[bucket.by_doc[held]] += c * bucket.by_impact[held]
                square[bucket.by_doc[held]] += bucket.by_impact[held].astype(float) ** 2
            left = np.sqrt(np.maximum(bucket.norms ** 2 * (1 + 1e-9) - square, 0)) * math.sqrt(float((count[rest].astype(float) ** 2).sum()))
            docs = np.flatnonzero((part + np.minimum(left, float(most[rest].sum()))) * (1 + 1e-9) >= self.least[i])
            self.seen[3] += n - len(docs)
            self.seen[4] += len(docs)
            if len(docs):
                score = bucket.scores(term, count, docs)
                good = score >= self.least[i]
                self._keep(i, [(-s, d is None, d or 0) for s, d in zip(score[good].tolist(), [bucket.doc_ids[j] for j in docs[good].tolist()], strict=True)])

    def _keep(self, i: int, found: list[tuple]) -> None:
        self.best[i] = sorted(self.best[i] + found)[:self.k]
        if len(self.best[i]) == self.k:
            self.least[i] = max(self.least[i], -self.best[i][-1][0])

    def rows(self) -> pa.RecordBatch:
        rows = [(i, None if null else d, -s) for i, best in enumerate(self.best) for s, null, d in best]
        item, doc, score = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(doc, pa.int64()), pa.array(score, pa.int64())], names=["item", "doc_id", "score"])


def vectors(counts: DataFrame, weight: np.ndarray, n_docs: int, n_terms: int) -> DataFrame:
    """(doc_id, norm, terms, impacts) of the documents with a term of the vocabulary (int32 and int64 bytes)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = length_factor(batch.column("n").to_numpy(), n_docs, n_terms).tolist()
            norms, out = [], []
            for i, (held, tf) in enumerate(zip(batch.column("terms").to_pylist(), batch.column("tfs").to_pylist(), strict=True)):
                x = impacts(np.frombuffer(held, "<i4"), np.frombuffer(tf, "<i4").astype(np.int64), np.int64(m[i]), weight)
                norms.append(math.sqrt(float((x.astype(float) ** 2).sum())))
                out.append(x.astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(norms, pa.float64()), batch.column("terms"), pa.array(out, pa.binary())],
                                             names=["doc_id", "norm", "terms", "impacts"])

    return counts.filter(F.octet_length("terms") > 0).mapInArrow(run, "doc_id long, norm double, terms binary, impacts binary")


def buckets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[Bucket]:
    rows, entries = [], 0
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "norm", "terms", "impacts")), strict=True):
            rows.append(row)
            entries += len(row[2]) // 4
            if len(rows) >= BUCKET or entries >= BUCKET_ENTRIES:
                yield Bucket(rows, size)
                rows, entries = [], 0
    if rows:
        yield Bucket(rows, size)


def _found(docs: DataFrame, items: Items, k: int, least: np.ndarray | None = None) -> DataFrame:
    """(item, doc_id, score): the k best of each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(items, k, least)
        for bucket in buckets(batches, len(items.vocabulary)):
            search.take(bucket)
        yield search.rows()

    return docs.mapInArrow(run, "item long, doc_id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def search_block(docs: DataFrame, items: Items, k: int) -> DataFrame:
    """(item, rank, doc_id, score) for a block of items."""
    spark = docs.sparkSession
    counts = stored(postings(docs, items.vocabulary), "counts")
    size = counts.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("l")).first()
    weight = weights(document_frequencies(counts, len(items.vocabulary)), size["n"])
    longest = [F.desc("norm"), F.col("doc_id")]
    docs = stored(vectors(counts, weight, size["n"], size["l"] or 1).repartitionByRange(input_partitions(docs), *longest).sortWithinPartitions(*longest), "vectors")
    least = np.zeros(len(items.ids), np.int64)
    # The k-th score of any documents is one that the k-th of all can't be below.
    share = 1 - min(1.0, SEEDS / max(1, size["n"]))
    longer = docs.agg(F.percentile_approx("norm", share, 100_000)).first()[0]
    seeds = docs.filter(F.col("norm") >= F.lit(longer))
    for r in _ranked(_found(seeds, items, k), k).filter(F.col("rank") == k).select("item", "score").toLocalIterator():
        least[r["item"]] = r["score"]
    held = spark.createDataFrame([(i, x) for i, x in enumerate(items.ids)], "item long, item_id long")
    return _ranked(_found(docs, items, k, least), k).join(held, "item").select("item_id", "rank", "doc_id", "score")


def item_blocks(items: DataFrame) -> Iterator[Items]:
    """The items in blocks of about ``ITEM_BYTES``, dealt by hash; their number comes from the size of all."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").filter(F.col("text").isNotNull())
    total = items.agg(F.sum(F.octet_length("text").cast("long"))).first()[0]
    n = -(-(total or 0) // ITEM_BYTES)
    for block in range(n):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block).orderBy("item_id", "text").collect()
        made = item_block([r["item_id"] for r in rows], [r["text"] for r in rows])
        if len(made.vocabulary):
            yield made


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best of ``docs`` (doc_id, text) for each of ``items`` (item_id, text) with a score above 0."""
    out = docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in item_blocks(items):
        out = out.unionByName(search_block(docs, block, k))
    return out


def query(spark, sf_dir):
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
q AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark),
size AS (SELECT count(*) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM d WHERE len(w) > 0),
qt AS (SELECT item_id, t, count(*) AS c FROM (SELECT item_id, unnest(w) AS t FROM q) GROUP BY 1, 2),
tf AS (SELECT doc_id, n, t, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS t FROM d)
       WHERE t IN (SELECT t FROM qt) GROUP BY 1, 2, 3),
wt AS (SELECT t, CAST(floor(1000 * ln((2 * size.n + 2) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), size),
x AS (SELECT doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * tf.n * size.n) // size.l))) AS impact FROM tf JOIN wt USING (t), size),
s AS (SELECT item_id, doc_id, CAST(sum(c * impact) AS BIGINT) AS score FROM qt JOIN x USING (t) GROUP BY 1, 2)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10
"""
