"""Operator 3, substring dedup by line or paragraph hashing.

A text is cut into units: sentences (ending at ``.``, ``!`` or ``?`` before white space, and at line ends), lines, or
paragraphs (parted by one or more blank lines).  A unit's span is its bytes with
the separator that ends it, so a text is the concatenation of its units.  A unit is normalised (ends stripped, runs
of ASCII white space made one space, A-Z lower-cased) and digested to 128 bits.  Of all units with the same digest,
over all documents, the one that ranks first by (doc_id, offset) stays and the others go; spans are offsets into the
original bytes.

A document sends each of its digests once: what it repeats itself goes whoever ranks first.  The first holder of each digest
comes from a plain aggregate, partial before the shuffle, and only digests with several holders are joined back.  The
join carries no text, and its hot keys are split by AQE.

Defined cases: a null or empty text has no bytes; a unit that is empty after normalising is no unit and stays, and so is
one shorter than ``min_bytes``; a null doc_id takes no part and loses nothing; rows with the same doc_id rank by the hash of their text,
equal rows in any order, and one of them keeps its units; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import chunks, stored, table

_CUT = {"sentence": re.compile(rb"\n|(?<=[.!?])[ \t\x0b\x0c\r]+\n?"), "line": re.compile(rb"\n"),
        "paragraph": re.compile(rb"\n(?:[ \t\x0b\x0c\r]*\n)+")}

#: The query's cut and the bytes below which a unit says too little to be called a repeat.
UNIT = "sentence"
MIN_BYTES = 24


def units(text: bytes, unit: str = "line", min_bytes: int = 1) -> list[tuple[bytes, int, int]]:
    """(digest, start, end) of every unit of ``text`` that is not empty."""
    out, start = [], 0
    for end in [*(m.end() for m in _CUT[unit].finditer(text)), len(text)]:
        plain = b" ".join(text[start:end].split()).lower()
        if len(plain) >= max(min_bytes, 1):
            out.append((xxhash.xxh3_128_digest(plain), start, end))
        start = end
    return out


def numbered(docs: DataFrame) -> DataFrame:
    """(row, doc_id, tie, text), stored, so that both reads of the texts have the same rows."""
    return stored(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("text").alias("tie"), "text"), "numbered")


def holders(texts: DataFrame, unit: str, min_bytes: int) -> DataFrame:
    """(key, doc_id, tie, row): every digest of every document once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            keys, at = [], []
            for i, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                own = {k for k, _, _ in units(text or b"", unit, min_bytes)}
                keys += own
                at += [i] * len(own)
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), *(batch.column(c).take(at) for c in ("doc_id", "tie", "row"))],
                                             names=["key", "doc_id", "tie", "row"])

    return texts.filter(F.col("doc_id").isNotNull()).select("doc_id", "tie", "row", "text").mapInArrow(
        run, "key binary, doc_id long, tie long, row long")


def lost(held: DataFrame) -> DataFrame:
    """(row, keys): the digests that each document holds after their first holder."""
    firsts = held.groupBy("key").agg(F.min(F.struct("doc_id", "tie", "row")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    # Stored, because AQE splits hot keys only of a join whose sides come straight from their shuffles.
    firsts = stored(firsts.select("key", F.col("first.row").alias("first")), "firsts")
    return held.join(firsts, "key").filter("row != first").groupBy("row").agg(F.collect_list("key").alias("keys"))


def dedup(docs: DataFrame, *, unit: str = "line", min_bytes: int = 1) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, n_units, n_dropped, spans, kept) of every document.

    ``n_removed`` counts bytes and ``n_dropped`` units; adjoining spans are one; kept is the bytes that stay.
    """
    texts = numbered(docs)
    gone = lost(stored(holders(texts, unit, min_bytes), "holders"))
    joined = texts.join(gone.hint("shuffle_hash"), "row", "left").select("doc_id", "text", "keys")
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            rows = []
            for doc, text, keys in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(),
                                       batch.column("keys").to_pylist(), strict=True):
                text, seen, spans, dropped = text or b"", set(keys or ()), [], 0
                found = units(text, unit, min_bytes)
                for key, start, end in found if doc is not None else ():
                    if key not in seen:
                        seen.add(key)
                        continue
                    dropped += 1
                    if spans and spans[-1][1] == start:
                        start = spans.pop()[0]
                    spans.append((start, end))
                stay = zip([0, *(b for _, b in spans)], [*(a for a, _ in spans), len(text)], strict=True)
                rows.append((len(text), sum(b - a for a, b in spans), len(spans), len(found), dropped,
                             [{"start": a, "end": b} for a, b in spans], b"".join(text[a:b] for a, b in stay)))
            *numbers, spans, kept = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in numbers), pa.array(spans, spans_type), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "n_units", "n_dropped", "spans", "kept"])

    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, n_units long, n_dropped long, "
                                  "spans array<struct<start:long,end:long>>, kept binary")


def query(spark, sf_dir):
    out = dedup(table(spark, sf_dir, "documents"), unit=UNIT, min_bytes=MIN_BYTES)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "n_units", "n_dropped", "spans", F.sha2("kept", 256).alias("kept_sha256"))
