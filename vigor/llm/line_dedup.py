"""Operator 9, reversible line dedup: sharded cuckoo filters over exact reference-count tables.

A line's key is the line stripped of ASCII white space and with A-Z lower-cased; keys shorter than ``min_chars`` code
points are left alone.  The exact side is the table of references, one row per key and document
(:func:`references`); counts per key come from it by a plain aggregate, partial before the shuffle, so a key that a
third of all documents hold is one row per task.  Inserting documents adds references, deleting them takes theirs
away (:class:`LineIndex`), and counts after both are what they would be had the documents never come; keys that come to
the threshold are inserted in their shard's stored filter, keys that fall below it deleted from it.

The keys that lose lines are put in cuckoo filters, one per shard of the key space.  A reference first asks its
shard's filter, in tasks that hold one filter and stream references past it (a shard's references are dealt to
several such tasks); only hits go on to the join with the exact table, which decides.

Defined cases: a null or empty text is one empty line; a null doc_id's lines are not counted and stay; rows that repeat a doc_id are one
document to the counts, and each loses its lines; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.sinks import file_system
from ..session import ensure_checkpoint_dir
from .shared import chunks, input_partitions, stored, table

MIN_CHARS = 40
MIN_DOCS = 5
#: Keys a shard's filter is made for; the number of shards follows the number of keys.
SHARD_KEYS = 50_000

_BLANK = b" \t\n\x0b\x0c\r"


def line_keys(text: bytes, min_chars: int) -> list[bytes | None]:
    """The 128-bit key of every line of ``text``, None for lines that are too short."""
    out = []
    for line in text.split(b"\n"):
        line = line.strip(_BLANK).lower()
        short = len(line) < min_chars or (not line.isascii() and len(line.decode()) < min_chars)
        out.append(None if short else xxhash.xxh3_128_digest(line))
    return out


def references(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(key, doc_id): every key of every document, once per row of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            keys, ids = [], []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                own = set(line_keys(text or b"", min_chars)) - {None}
                keys += own
                ids += [doc] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ids, pa.int64())], names=["key", "doc_id"])

    return docs.select("doc_id", "text").filter(F.col("doc_id").isNotNull()).mapInArrow(run, "key binary, doc_id long")


def reference_counts(refs: DataFrame) -> DataFrame:
    """(key, n_docs, last_doc): the exact table."""
    return refs.distinct().groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last_doc"))


# -- cuckoo filters ---------------------------------------------------------------------------------------------

class Cuckoo:
    """A cuckoo filter of 128-bit keys: four 16-bit fingerprints a bucket, two buckets a key."""

    SLOTS = 4

    def __init__(self, n_keys: int, slots: np.ndarray | None = None):
        size = 1 << max(3, int(np.ceil(np.log2(max(n_keys, 1) / (0.7 * self.SLOTS)))))
        self.slots = np.zeros((size, self.SLOTS), np.uint16) if slots is None else slots
        self.mask = np.uint64(len(self.slots) - 1)

    @classmethod
    def of(cls, raw: bytes) -> Cuckoo:
        return cls(0, np.frombuffer(raw, "<u2").reshape(-1, cls.SLOTS).copy())

    def raw(self) -> bytes:
        return self.slots.astype("<u2").tobytes()

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprint and first bucket of each key (rows of two 64-bit words)."""
        return (keys[:, 0] % np.uint64(65535) + np.uint64(1)).astype(np.uint16), keys[:, 1] & self.mask

    def _other(self, prints: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        return (bucket ^ (prints.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20))) & self.mask

    def contains(self, keys: np.ndarray) -> np.ndarray:
        prints, one = self._places(keys)
        two = self._other(prints, one)
        return ((self.slots[one] == prints[:, None]) | (self.slots[two] == prints[:, None])).any(1)

    def insert(self, keys: np.ndarray) -> None:
        """Add distinct keys; a filter that gets too full doubles by being made anew (ValueError tells the caller)."""
        prints, at = self._places(keys)
        rng = np.random.default_rng(7)
        first = True
        for _ in range(500):
            if not len(prints):
                return
            order = np.argsort(at, kind="stable")
            prints, at = prints[order], at[order]
            place = np.arange(len(at)) - np.searchsorted(at, at)  # of those that want the same bucket
            free = self.slots[at] == 0
            fits = place < free.sum(1)
            slot = np.argsort(~free[fits], axis=1, kind="stable")[np.arange(fits.sum()), place[fits]]
            self.slots[at[fits], slot] = prints[fits]
            prints, at = prints[~fits], at[~fits]
            if first:
                at, first = self._other(prints, at), False
                continue
            # A full bucket gives up one fingerprint a round, which moves to its other bucket.
            head = np.r_[True, at[1:] != at[:-1]] if len(at) else np.zeros(0, bool)
            out = rng.integers(0, self.SLOTS, head.sum())
            evicted = self.slots[at[head], out]
            self.slots[at[head], out] = prints[head]
            moved = self._other(evicted, at[head])
            prints, at = np.r_[prints[~head], evicted], np.r_[at[~head], moved]
        raise ValueError("the filter is too full")

    def delete(self, keys: np.ndarray) -> None:
        """Take one fingerprint of each key away (of keys that were inserted)."""
        for p, a, b in zip(*(x.tolist() for x in (lambda p, a: (p, a, self._other(p, a)))(*self._places(keys))), strict=True):
            for bucket in (a, b):
                hit = np.flatnonzero(self.slots[bucket] == p)
                if len(hit):
                    self.slots[bucket, hit[0]] = 0
                    break


def as_words(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)


def build(keys: np.ndarray) -> Cuckoo:
    room = len(keys)
    while True:
        try:
            made = Cuckoo(room)
            made.insert(keys)
            return made
        except ValueError:
            room *= 2


def _shard(n: int):
    return F.pmod(F.xxhash64("key"), F.lit(n)).cast("int")


def shard_filters(keys: DataFrame, shards: int) -> DataFrame:
    """(shard, filter): a cuckoo filter for each shard of ``keys`` that has any."""
    def run(key: tuple, group: pa.Table) -> pa.Table:
        made = build(as_words(group.column("key").to_pylist()))
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "filter": pa.array([made.raw()], pa.binary())})

    return keys.select("key", _shard(shards).alias("shard")).groupBy("shard").applyInArrow(run, "shard int, filter binary")


def maybe_held(refs: DataFrame, filters: DataFrame, shards: int) -> DataFrame:
    """The references whose shard's filter may hold their key.  A task holds one filter and streams references."""
    n = input_partitions(refs)
    lanes = -(-n // shards)
    rows = refs.select(_shard(shards).alias("shard"), F.pmod(F.xxhash64("doc_id"), F.lit(lanes)).cast("int").alias("lane"),
                       F.lit(1).alias("kind"), "key", "doc_id")
    heads = filters.select("shard", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane"), F.lit(0).alias("kind"),
                           F.col("filter").alias("key"), F.lit(None).cast("long").alias("doc_id"))
    met = rows.unionByName(heads).repartition(n, "shard", "lane").sortWithinPartitions("shard", "lane", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, shown = None, None
        for batch in batches:
            shard, lane, kind = (batch.column(c).to_numpy() for c in range(3))
            cut = np.flatnonzero(np.r_[True, (shard[1:] != shard[:-1]) | (lane[1:] != lane[:-1]) | (kind[1:] != kind[:-1])])
            for a, b in zip(cut, np.r_[cut[1:], len(shard)], strict=True):
                if kind[a] == 0:
                    held, shown = Cuckoo.of(batch.column("key")[int(a)].as_py()), (shard[a], lane[a])
                elif shown == (shard[a], lane[a]):
                    part = batch.slice(a, b - a)
                    hit = held.contains(as_words(part.column("key").to_pylist()))
                    yield part.select(["key", "doc_id"]).filter(pa.array(hit))

    return met.mapInArrow(run, "key binary, doc_id long")


# -- decisions --------------------------------------------------------------------------------------------------

def losses(refs: DataFrame, counts: DataFrame, min_docs: int = MIN_DOCS, rows: int | None = None) -> DataFrame:
    """(doc_id, keys): the keys whose lines each document loses.  ``rows``, if known, is the number of references."""
    frequent = stored(counts.filter(F.col("n_docs") >= min_docs), "frequent", rows=rows and rows // min_docs)
    shards = max(1, -(-frequent.count() // SHARD_KEYS))
    maybe = maybe_held(refs, shard_filters(frequent, shards), shards)
    lost = maybe.alias("r").join(frequent.alias("f"), F.col("r.key") == F.col("f.key")).filter(
        F.col("r.doc_id") < F.col("f.last_doc")).select("r.doc_id", "r.key")
    return lost.groupBy("doc_id").agg(F.collect_set("key").alias("keys"))


def strip(docs: DataFrame, lost: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, text, rest, n_lines, n_dropped): the texts without the lines of lost keys; ``rest`` has the other columns."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    rest = F.struct(*others) if others else F.lit(None).cast("int")
    joined = docs.select("doc_id", "text", rest.alias("rest")).join(
        lost.select(F.col("doc_id").alias("_doc"), F.col("keys").alias("_keys")).hint("shuffle_hash"),
        F.col("doc_id") == F.col("_doc"), "left").select("doc_id", "text", "rest", "_keys")
    schema = T.StructType([*joined.schema.fields[:3], T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            texts, before, dropped = [], [], []
            for text, keys in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("_keys").to_pylist(), strict=True):
                before.append((text or b"").count(b"\n") + 1)
                gone = 0
                if keys and text:
                    keys = set(keys)
                    lines = [x for x, k in zip(text.split(b"\n"), line_keys(text, min_chars), strict=True) if k not in keys]
                    gone = before[-1] - len(lines)
                    text = b"\n".join(lines)
                texts.append(text)
                dropped.append(gone)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.binary()).cast(pa.string()), batch.column("rest"),
                 pa.array(before, pa.int64()), pa.array(dropped, pa.int64())], names=schema.names)

    return joined.mapInArrow(run, schema)


def dedup(docs: DataFrame, *, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Line dedup of a whole table: every frequent key keeps its lines in the largest doc_id that holds it only.

    Returns what :func:`strip` does.
    """
    refs = stored(references(docs, min_chars), "references")
    return strip(docs, losses(refs, reference_counts(refs), min_docs, refs.count()), min_chars)


def cleaned(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with its columns as they were, but for ``text`` and its length ``n_chars``."""
    out = dedup(docs, **options)
    mine = {"doc_id": F.col("doc_id"), "text": F.col("text")}
    if "n_chars" in docs.columns:
        mine["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.select(*[mine.get(c, F.col("rest").getField(c)).alias(c) for c in docs.columns])


def _changed_filters(crossing: DataFrame, filters: DataFrame) -> DataFrame:
    """(shard, filter) of the shards of ``crossing`` (shard, key, up): keys that go down are deleted, those that come up inserted.

    The filter of a shard that got too full is null; it has to be built from its keys.
    """
    def run(key: tuple, keys: pa.Table, stored_filter: pa.Table) -> pa.Table:
        up = keys.column("up").to_numpy()
        moved = as_words(keys.column("key").to_pylist())
        try:
            if stored_filter.num_rows:
                made = Cuckoo.of(stored_filter.column("filter")[0].as_py())
                made.delete(moved[~up])
                made.insert(moved[up])
            else:
                made = build(moved[up])
            raw = made.raw()
        except ValueError:
            raw = None
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "filter": pa.array([raw], pa.binary())})

    touched = filters.join(crossing.select("shard").distinct(), "shard", "left_semi")
    return crossing.groupBy("shard").cogroup(touched.groupBy("shard")).applyInArrow(run, "shard int, filter binary")


class LineIndex:
    """References, exact counts and filters kept between runs: documents come and go, and decisions are as if only those still in had ever come.

    A change is a numbered batch of three tables.  ``refs`` holds its signed references; ``counts`` the keys it touched
    that are or were in ``min_docs`` documents, counted anew from the references of those keys only; ``filters`` the filters of
    the shards in which a key crossed that threshold, with it inserted or deleted.  The newest row of a key or shard
    holds.  A shard that overflows is built from its keys, and all are when there are more than ``shard_keys`` keys a shard.

    The filters are written last, and a batch without them doesn't count: a failed change leaves the index as it was,
    and the next one takes its number.  One change runs at a time.
    """

    _TABLES = {"refs": "key binary, doc_id long, sign int, batch int", "counts": "key binary, n_docs long, last_doc long, batch int",
               "filters": "shard int, filter binary, shards int, batch int"}

    def __init__(self, spark: SparkSession, path: str | None = None, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                 shard_keys: int = SHARD_KEYS):
        self.spark, self.min_chars, self.min_docs, self.shard_keys = spark, min_chars, min_docs, shard_keys
        self.path = path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/lines-{uuid.uuid4().hex[:12]}"

    def insert(self, docs: DataFrame) -> None:
        """Add documents.  An id that is in the index already, as after a retried insert, adds its keys once more; a deletion takes all."""
        self._change(references(docs, self.min_chars).distinct().withColumn("sign", F.lit(1)))

    def delete(self, doc_ids: DataFrame) -> None:
        """Take the documents of ``doc_ids`` (doc_id) out again."""
        gone = self._counted().join(doc_ids.select("doc_id").distinct(), "doc_id", "left_semi")
        self._change(gone.select("key", "doc_id", (-F.col("n")).cast("int").alias("sign")))

    def references(self) -> DataFrame:
        return self._counted().select("key", "doc_id")

    def losses(self) -> DataFrame:
        """(doc_id, keys): the keys whose lines each document loses, by the stored filters and counts."""
        frequent, shards = self._frequent(), self._shards()
        if not shards:
            return self.references().groupBy("doc_id").agg(F.collect_set("key").alias("keys")).limit(0)
        maybe = maybe_held(self.references(), self._filters(shards), shards)
        lost = maybe.join(frequent, "key").filter(F.col("doc_id") < F.col("last_doc"))
        return lost.groupBy("doc_id").agg(F.collect_set("key").alias("keys"))

    def _batch(self) -> int:
        """Number of the last whole batch, 0 if there is none."""
        fs, folder = file_system(self.spark, f"{self.path}/filters")
        names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
        whole = [n for n in names if fs.exists(file_system(self.spark, f"{self.path}/filters/{n}/_SUCCESS")[1])]
        return max((int(n.removeprefix("batch=")) for n in whole), default=0)

    def _read(self, name: str, upto: int | None = None) -> DataFrame:
        """The batches of a table up to ``upto`` (by default the last whole one)."""
        upto = self._batch() if upto is None else upto
        if not upto:
            return self.spark.createDataFrame([], self._TABLES[name])
        return self.spark.read.schema(self._TABLES[name]).parquet(f"{self.path}/{name}").filter(F.col("batch") <= upto)

    def _write(self, df: DataFrame, name: str, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/{name}/batch={batch}")

    def _counted(self) -> DataFrame:
        return self._read("refs").groupBy("key", "doc_id").agg(F.sum("sign").alias("n")).filter("n > 0")

    def _frequent(self, upto: int | None = None) -> DataFrame:
        """(key, last_doc) of the keys that are in ``min_docs`` documents."""
        newest = self._read("counts", upto).groupBy("key").agg(F.max_by(F.struct("n_docs", "last_doc"), "batch").alias("c"))
        return newest.filter(F.col("c.n_docs") >= self.min_docs).select("key", F.col("c.last_doc").alias("last_doc"))

    def _shards(self) -> int:
        row = self._read("filters").agg(F.max_by("shards", "batch")).first()
        return row[0] or 0

    def _filters(self, shards: int) -> DataFrame:
        rows = self._read("filters").filter(F.col("shards") == shards)
        return rows.groupBy("shard").agg(F.max_by("filter", "batch").alias("filter"))

    def _change(self, signed: DataFrame) -> None:
        batch = self._batch() + 1
        self._write(signed.select("key", "doc_id", "sign"), "refs", batch)
        touched = self._read("refs", batch).filter(F.col("batch") == batch).select("key").distinct()
        held = self._read("refs", batch).join(touched, "key", "left_semi").groupBy("key", "doc_id").agg(
            F.sum(F.when(F.col("batch") < batch, F.col("sign")).otherwise(0)).alias("was"), F.sum("sign").alias("now"))
        counts = held.groupBy("key").agg(F.count_if(F.col("was") > 0).alias("n_was"), F.count_if(F.col("now") > 0).alias("n_docs"),
                                         F.max(F.when(F.col("now") > 0, F.col("doc_id"))).alias("last_doc"))
        moved = stored(counts.filter(F.greatest("n_was", "n_docs") >= self.min_docs), "moved")
        self._write(moved.select("key", "n_docs", "last_doc"), "counts", batch)

        shards, keys = self._shards(), self._frequent(batch).select("key")
        need = -(-keys.count() // self.shard_keys)
        if need > shards:
            shards = need if not shards else 2 * need   # room to grow: all filters are built anew
            filters = shard_filters(keys, shards)
        elif shards:
            up, down = F.col("n_docs") >= self.min_docs, F.col("n_was") >= self.min_docs
            crossing = moved.filter(up != down).select(_shard(shards).alias("shard"), "key", up.alias("up"))
            changed = stored(_changed_filters(crossing, self._filters(shards)), "filters")
            full = changed.filter("filter IS NULL").select("shard")
            again = keys.join(full, _shard(shards) == F.col("shard"), "left_semi")
            filters = changed.filter("filter IS NOT NULL").unionByName(shard_filters(again, shards))
        else:
            filters = self.spark.createDataFrame([], "shard int, filter binary")
        self._write(filters.withColumn("shards", F.lit(shards)), "filters", batch)


def query(spark, sf_dir):
    out = dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


_KEY = r"translate(regexp_replace(l, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE = f"""
WITH lines AS (SELECT doc_id, i, l, {_KEY} AS k FROM (
    SELECT doc_id, unnest(ls) AS l, generate_subscripts(ls, 1) AS i
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
frequent AS (SELECT k, max(doc_id) AS last_doc FROM lines WHERE length(k) >= {MIN_CHARS} GROUP BY k
             HAVING count(DISTINCT doc_id) >= {MIN_DOCS})
SELECT doc_id, count(*) AS n_lines, count(f.k) FILTER (doc_id < last_doc) AS n_dropped,
       sha256(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (f.k IS NULL OR doc_id = last_doc), '')) AS kept_sha256
FROM lines LEFT JOIN frequent f USING (k) GROUP BY doc_id
"""
