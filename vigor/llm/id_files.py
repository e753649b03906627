"""Operator 6, token ids in packed files.

A file set is a table of blocks, written and read by Spark so that it can lie in any store.  Each block holds the
ids of a run of whole documents, every id in the fewest bits that the vocabulary needs, as one little-endian bit
stream; ``ends`` gives the position after each document's last id, so a document's ids are found by arithmetic and
unpacked alone.  Shards are ranges of doc_id, blocks and documents within them ascend: reading shards and blocks in order gives all
ids in ascending doc_id order.

Defined cases: a null or empty text has no ids but the end id; a null doc_id sorts first; rows with the same doc_id
are documents of their own, ordered by their text's hash; other columns of the input are ignored; an empty table
gives an empty file set.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import chunks, input_partitions, table

#: Ids a block holds before the next document starts a new one.  A longer document has a block of its own.
BLOCK_IDS = 1 << 17
#: Distinct words whose ids a task remembers.
KNOWN_WORDS = 1_000_000
#: Words that go to the library in one call, with an added token between them (which nothing merges with).
TOGETHER = 1000
#: Cutting at ASCII white space is safe: the pre-tokenizer never joins across it.  So is cutting after a leading run of
#: Latin letters that an ASCII character follows, which is not one.
_WORDS = re.compile(r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]++(?=[\x00-\x7f]|\Z)|[^ \t-\r]+")

BLOCKS = ("shard int, block int, first_doc long, last_doc long, doc_ids array<long>, ends array<long>, "
          "n_ids long, bits int, payload binary")


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


# -- the bit format -----------------------------------------------------------------------------------------------

def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids as a little-endian bit stream of ``bits`` bits each (1 to 25); padded with zero ids to whole bytes."""
    rows = -(-len(ids) // 8)
    eight = np.zeros((rows, 8), np.uint32)
    eight.reshape(-1)[:len(ids)] = ids
    out = np.zeros((rows, bits), np.uint8)
    for j in range(8):
        byte, shift = divmod(j * bits, 8)
        value = eight[:, j] << np.uint32(shift)
        for k in range(-(-(shift + bits) // 8)):
            out[:, byte + k] |= (value >> np.uint32(8 * k)).astype(np.uint8)
    return out.tobytes()


def unpack(payload: bytes, bits: int, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a packed stream; reads only the bytes that hold them."""
    if stop <= start:
        return np.zeros(0, np.uint32)
    low = start * bits // 8
    data = np.frombuffer(payload, np.uint8, min(len(payload), -(-stop * bits // 8)) - low, low)
    data = np.concatenate([data, np.zeros(4, np.uint8)])
    at = np.arange(start, stop, dtype=np.int64) * bits - 8 * low
    byte = at >> 3
    value = data[byte].astype(np.uint32)
    for k in range(1, -(-(bits + 7) // 8)):
        value |= data[byte + k].astype(np.uint32) << np.uint32(8 * k)
    return (value >> (at & 7).astype(np.uint32)) & np.uint32((1 << bits) - 1)


# -- writing ------------------------------------------------------------------------------------------------------

class Encoder:
    """The tokenizers library behind a memory of words: each distinct word of a task is encoded by it once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.bits = max(1, (self.tokenizer.get_vocab_size(with_added_tokens=True) - 1).bit_length())
        self.known: dict[str, bytes] = {}
        # Which tokens end a word, if the model marks them and words of letters are words to it.
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = None
        if suffix and [t for t, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str("ab c")] == ["ab", "c"]:
            self.ends = np.zeros(1 << self.bits, bool)
            self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
        added = self.tokenizer.get_added_tokens_decoder()
        plain = [i for i, t in added.items() if not (t.lstrip or t.rstrip or t.single_word or t.normalized)]
        self.border = (max(plain), added[max(plain)].content) if plain else None
        self.lowers = self.tokenizer.normalizer is not None and self.tokenizer.normalizer.normalize_str("A") == "a"
        self.added = [t.content for t in added.values()]

    def lower(self, text: str) -> str:
        """Lower-case A-Z, which the normalizer does anyway, unless that makes an added token out of ordinary text."""
        low = text.encode().lower().decode()
        return low if self.lowers and all(low.count(a) == text.count(a) for a in self.added) else text

    def learn(self, fresh: list[str]) -> None:
        """Encode new words by the library, many in one call.

        Words of letters go with spaces between them and are told apart by the token that ends each; others with an added
        token between them, and words that hold an added token go alone.
        """
        plain = [w for w in fresh if w.isalpha()] if self.ends is not None else []
        self.together(plain, " ", None)
        odd = [w for w in fresh if w not in self.known]
        alone = [w for w in odd if self.border is None or any(a in w for a in self.added)]
        for w, e in zip(alone, self.tokenizer.encode_batch_fast(alone, add_special_tokens=False), strict=True):
            self.known[w] = np.array(e.ids, "<u4").tobytes()
        if self.border:
            self.together([w for w in odd if w not in self.known], self.border[1], self.border[0])

    def together(self, words: list[str], between: str, border: int | None) -> None:
        rows = [words[i:i + TOGETHER] for i in range(0, len(words), TOGETHER)]
        found = self.tokenizer.encode_batch_fast([between.join(r) for r in rows], add_special_tokens=False)
        for row, e in zip(rows, found, strict=True):
            ids = np.array(e.ids, "<u4")
            skip = int(border is not None)
            ends = np.flatnonzero(self.ends[ids]) + 1 if border is None else np.r_[np.flatnonzero(ids == border), len(ids)]
            if len(ends) != len(row):
                continue  # some word isn't one word to this tokenizer: these are left to the other ways
            raw, at = ids.tobytes(), 0
            for w, end in zip(row, (4 * ends).tolist(), strict=True):
                self.known[w] = raw[at:end]
                at = end + 4 * skip

    def encode(self, texts: list[str | None], end: bytes) -> list[np.ndarray]:
        words = [_WORDS.findall(self.lower(t)) if t else [] for t in texts]
        seen = set().union(*words)
        fresh = [w for w in seen if w not in self.known]
        if len(self.known) + len(fresh) > KNOWN_WORDS:  # keep those of this batch, among which the frequent are
            self.known = {w: self.known[w] for w in seen if w in self.known}
        self.learn(fresh)
        get = self.known.__getitem__
        return [np.frombuffer(b"".join(map(get, w)) + end, "<u4") for w in words]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    import os
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    return Encoder(path)


def blocks(docs: DataFrame, path: str | None = None, end_id: int = 2, block_ids: int = BLOCK_IDS) -> DataFrame:
    """The file set of ``docs`` (doc_id, text) as a DataFrame of blocks, sorted by doc_id over shards."""
    path = path or default_path()
    order = [F.col("doc_id").asc_nulls_first(), F.col("_tie")]
    ordered = (docs.select("doc_id", "text", F.xxhash64("text").alias("_tie"))
               .repartitionByRange(input_partitions(docs), *order).sortWithinPartitions(*order))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard, block = encoder(path), TaskContext.get().partitionId(), 0
        end, held_docs, held, size = np.array([end_id], "<u4").tobytes(), [], [], 0

        def close():
            ends = np.cumsum([len(i) for i in held])
            ids = np.concatenate(held)
            known = [d for d in held_docs if d is not None]
            return pa.RecordBatch.from_arrays([
                pa.array([shard], pa.int32()), pa.array([block], pa.int32()),
                pa.array([min(known, default=None)], pa.int64()), pa.array([max(known, default=None)], pa.int64()),
                pa.array([held_docs], pa.list_(pa.int64())), pa.array([ends.tolist()], pa.list_(pa.int64())),
                pa.array([len(ids)], pa.int64()), pa.array([enc.bits], pa.int32()),
                pa.array([pack(ids, enc.bits)], pa.binary())], names=[c.split()[0] for c in BLOCKS.split(", ")])

        for batch in chunks(batches, "text"):
            for doc, ids in zip(batch.column("doc_id").to_pylist(), enc.encode(batch.column("text").to_pylist(), end), strict=True):
                if held and size + len(ids) > block_ids:
                    yield close()
                    block, held_docs, held, size = block + 1, [], [], 0
                held_docs.append(doc)
                held.append(ids)
                size += len(ids)
        if held:
            yield close()

    return ordered.mapInArrow(run, BLOCKS)


def write(docs: DataFrame, target: str, path: str | None = None, end_id: int = 2) -> None:
    blocks(docs, path, end_id).write.option("compression", "none").parquet(target)


# -- reading ------------------------------------------------------------------------------------------------------

RANGES = 64


def ranges(ids: list[int], most: int = RANGES) -> list[tuple[int, int]]:
    """Sorted ids in at most ``most`` ranges, cut where the gaps are widest."""
    gaps = sorted(range(1, len(ids)), key=lambda i: ids[i - 1] - ids[i])[:most - 1]
    cuts = [0, *sorted(gaps), len(ids)]
    return [(ids[a], ids[b - 1]) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if a < b]


def read(spark: SparkSession, target: str, doc_ids: list[int] | None = None) -> DataFrame:
    """(shard, block, place, doc_id, start_in_block, ids) of every document, or of a few by random access.

    ``ids`` is binary, 32-bit little-endian.  With ``doc_ids``, any number of them, blocks are pruned by their doc range and only the
    bytes of the documents asked for are unpacked: files by up to ``RANGES`` ranges that hold them, then blocks one by one.
    """
    files = spark.read.schema(BLOCKS).parquet(target)
    wanted = None if doc_ids is None else frozenset(doc_ids)
    if wanted is not None:
        listed = sorted(wanted)
        hit = reduce(lambda a, b: a | b, [(F.col("first_doc") <= high) & (F.col("last_doc") >= low) for low, high in ranges(listed)], F.lit(False))
        files = files.filter(hit).filter(F.exists(F.lit(listed) if listed else F.array().cast("array<bigint>"),
                                                  lambda d: d.between(F.col("first_doc"), F.col("last_doc"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = {c: batch.column(c)[r].as_py() for c in ("shard", "block", "doc_ids", "ends", "bits", "payload")}
                starts = [0, *row["ends"][:-1]]
                take = [i for i, d in enumerate(row["doc_ids"]) if wanted is None or d in wanted]
                ids = [unpack(row["payload"], row["bits"], starts[i], row["ends"][i]).astype("<u4").tobytes() for i in take]
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["shard"]] * len(take), pa.int32()), pa.array([row["block"]] * len(take), pa.int32()),
                    pa.array(take, pa.int32()), pa.array([row["doc_ids"][i] for i in take], pa.int64()),
                    pa.array([starts[i] for i in take], pa.int64()), pa.array(ids, pa.binary())],
                    names=["shard", "block", "place", "doc_id", "start_in_block", "ids"])

    return files.select("shard", "block", "doc_ids", "ends", "bits", "payload").mapInArrow(
        run, "shard int, block int, place int, doc_id long, start_in_block long, ids binary")


def block_starts(spark: SparkSession, target: str) -> DataFrame:
    """(shard, block, block_start): ids of all blocks before.  Shards are summed first, a row for each."""
    files = spark.read.schema(BLOCKS).parquet(target).select("shard", "block", "n_ids")
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    shards = files.groupBy("shard").agg(F.sum("n_ids").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(before(Window.partitionBy(F.lit(0)).orderBy("shard"))), F.lit(0)).alias("shard_start"))
    inside = F.coalesce(F.sum("n_ids").over(before(Window.partitionBy("shard").orderBy("block"))), F.lit(0))
    return files.withColumn("inside", inside).join(shards, "shard").select(
        "shard", "block", (F.col("shard_start") + F.col("inside")).alias("block_start"))


def query(spark, sf_dir):
    import uuid

    from ..session import ensure_checkpoint_dir
    target = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/id_files-{uuid.uuid4().hex[:12]}"
    write(table(spark, sf_dir, "documents"), target)
    crc = F.crc32("ids")
    docs = read(spark, target).select("shard", "block", "doc_id", "start_in_block",
                                      (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), crc.alias("ids_crc32"))
    return docs.join(block_starts(spark, target), ["shard", "block"]).select(
        "doc_id", (F.col("block_start") + F.col("start_in_block")).alias("start"), "n_tokens", "ids_crc32")
