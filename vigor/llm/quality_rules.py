"""Operator 7, quality rules with adaptive thresholds.

Every document gets counts (:func:`measure`).  Five ratios of them are summarised per (lang, source) in quantile
sketches: counts of logarithmic bins, so that two sketches merge by adding, in any order, and a quantile is right to
``ACCURACY`` of its value.  A group's fence on a ratio lies ``WIDTH`` times its middle spread beyond its upper
quartile (for word length also below the lower one), but never nearer than the ratio's slack, so a group whose documents are
alike isn't cut at their noise.

A group of few documents, or one that is largely junk, can't set its own fence.  Sketches are merged over the language and over
all documents; a group's quartiles are cut to the fences of the level above, weighted with that level's quartiles
by the group's count, and its reach is at most that level's.  So a fence moves from the one above it by one reach
at most.  Thresholds are joined back and a document is kept if it passes the base rules and
every fence of its group.

Defined cases: a null or empty text has no words and fails; null lang and null source are groups of their own;
repeated rows count each; other columns are ignored (:func:`filter_documents` carries them); an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .shared import chunks, stored, table

ACCURACY = 0.01
WIDTH = 3.0
#: Ratio: the least distance of its fence from the quartile, and whether there is a lower fence too.
SLACK = {"symbol_ratio": (0.05, False), "dup_line_ratio": (0.60, False), "repeat_ratio": (0.30, False),
         "echo_ratio": (0.20, False), "word_length": (2.0, True)}

#: Documents that what is known of the level above counts for, in the quartiles of a group.
PRIOR = 20
#: Ratios that differ by language (scripts without blanks have long words): no level above the first group holds them.
OWN = ("word_length",)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_echoes")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_BLANK = b" \t\n\x0b\x0c\r"


def _repeated(w: W.Words, k: int = 8) -> np.ndarray:
    """Words of each document that lie in a k-word window found twice or more in it."""
    m = len(w.first) - 1
    h, fits = w.windows(k)
    at = np.flatnonzero(fits)
    if not len(at):
        return np.zeros(m, np.int64)
    doc = w.doc_of()
    key = h[at] ^ W.mixed(doc[at].astype(np.uint64) + np.uint64(1))
    order = np.argsort(key)
    key = key[order]
    same = np.zeros(len(at) + 1, bool)
    same[1:-1] = key[1:] == key[:-1]
    twice = at[order[same[1:] | same[:-1]]]
    covered = np.zeros(len(h) + k, np.int64)
    covered[twice] += 1
    covered[twice + k] -= 1
    return np.bincount(doc[np.cumsum(covered)[:len(h)] > 0], minlength=m)


def _echoes(w: W.Words) -> np.ndarray:
    """Words of each document that equal the word before."""
    doc = w.doc_of()
    return np.bincount(doc[1:][(w.hashes[1:] == w.hashes[:-1]) & (doc[1:] == doc[:-1])], minlength=len(w.first) - 1)


def counts(column: pa.Array) -> dict[str, np.ndarray]:
    """The counts of every text of an Arrow string column."""
    data, offsets = W.column_bytes(column)
    w = W.words(data, offsets)
    sums = lambda mask: np.diff(np.r_[0, np.cumsum(mask)][offsets])
    raw, lines, dups = data.tobytes(), [], []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        worded = [x for x in raw[a:b].split(b"\n") if x.strip(_BLANK)]
        lines.append(len(worded))
        dups.append(len(worded) - len(set(worded)))
    return {"n_words": w.per_doc, "word_chars": sums(~W.SPACE[data] & ((data & 0xC0) != 0x80)),
            "n_symbols": sums(_SYMBOL[data]), "n_lines": np.array(lines, np.int64),
            "n_dup_lines": np.array(dups, np.int64), "n_repeat_words": _repeated(w), "n_echoes": _echoes(w)}


def measure(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``docs`` and the counts of its text."""
    kept = [c for c in keep if c not in COUNTS]
    source = docs.select(*kept, *([] if "text" in kept else ["text"]))
    schema = T.StructType([source.schema[c] for c in kept] + [T.StructField(c, T.LongType()) for c in COUNTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            found = counts(batch.column("text"))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *(pa.array(found[c]) for c in COUNTS)],
                                             names=[*kept, *COUNTS])

    return source.mapInArrow(run, schema)


def _ratio(name: str) -> Column:
    part = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return {"symbol_ratio": part("n_symbols", "word_chars"), "dup_line_ratio": part("n_dup_lines", "n_lines"),
            "repeat_ratio": part("n_repeat_words", "n_words"), "echo_ratio": part("n_echoes", "n_words"),
            "word_length": part("word_chars", "n_words")}[name]


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def sketches(measured: DataFrame, groups: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """(groups, ratio, bin, n): mergeable quantile sketches of the documents that pass the base rules.

    Merge two by adding ``n``.  Bin 0 holds values under 1e-6; a value v > 0 lies in bin ceil(log(v) / log(gamma)).
    """
    step = math.log((1 + ACCURACY) / (1 - ACCURACY))
    low = math.floor(math.log(1e-6) / step)
    bins = [F.struct(F.lit(r).alias("ratio"), F.when(_ratio(r) < 1e-6, 0).otherwise(
        F.ceil(F.log(_ratio(r)) / step) - low).cast("int").alias("bin")) for r in SLACK]
    return (measured.filter(~base_failed()).select(*groups, F.inline(F.array(*bins)))
            .groupBy(*groups, "ratio", "bin").agg(F.count(F.lit(1)).alias("n")))


def _quartiles(merged: DataFrame, groups: tuple[str, ...]) -> DataFrame:
    """(groups, ratio, n, q1, q2, q3) of a sketch that has one row per group, ratio and bin."""
    gamma = (1 + ACCURACY) / (1 - ACCURACY)
    low = math.floor(math.log(1e-6) / math.log(gamma))
    over = Window.partitionBy(*groups, "ratio")
    value = F.when(F.col("bin") == 0, 0.0).otherwise(2 * F.pow(F.lit(gamma), F.col("bin") + low) / (gamma + 1))
    ranked = merged.withColumn("upto", F.sum("n").over(over.orderBy("bin"))).withColumn("all", F.sum("n").over(over))
    at = lambda q: F.min(F.when(F.col("upto") >= q * F.col("all"), value))
    return ranked.groupBy(*groups, "ratio").agg(F.max("all").alias("n"), at(0.25).alias("q1"), at(0.5).alias("q2"), at(0.75).alias("q3"))


def _fenced(level: DataFrame, above: DataFrame | None, groups: tuple[str, ...]) -> DataFrame:
    """(groups, ratio, a, b, reach): the quartiles of a level, held by those of the level above, and their reach.

    At the top the quartiles of ratios that languages share lie no further from the median than each other, so that junk
    moves them only from half of all documents on.  The top of an ``OWN`` ratio is its language as it is.
    """
    slack = F.create_map(*[F.lit(x) for r, (least, _) in SLACK.items() for x in (r, least)])[F.col("c.ratio")]
    own = F.col("c.ratio").isin(*OWN)
    top = (F.when(own, F.col("q1")).otherwise(F.greatest("q1", 2 * F.col("q2") - F.col("q3"))),
           F.when(own, F.col("q3")).otherwise(F.least("q3", 2 * F.col("q2") - F.col("q1"))))
    rows = level.alias("c")
    if above is None:
        a, b, most = *top, F.lit(math.inf)
    else:
        on = F.col("c.ratio") == F.col("p.ratio")
        for g in groups[:-1]:
            on &= F.col(f"c.{g}").eqNullSafe(F.col(f"p.{g}"))
        rows = rows.join(above.alias("p"), on, "left")
        least, most = F.col("p.a") - F.col("p.reach"), F.col("p.b") + F.col("p.reach")
        weight = F.col("c.n") / (F.col("c.n") + PRIOR)
        held = lambda mine, theirs: weight * F.greatest(least, F.least(most, mine)) + (1 - weight) * theirs
        alone = F.col("p.a").isNull()
        a = F.when(alone, top[0]).otherwise(held(F.col("q1"), F.col("p.a")))
        b = F.when(alone, top[1]).otherwise(held(F.col("q3"), F.col("p.b")))
        most = F.coalesce("p.reach", F.lit(math.inf))
    rows = rows.select(*[F.col(f"c.{g}") for g in groups], "c.ratio", a.alias("a"), b.alias("b"), most.alias("most"), slack.alias("slack"))
    return rows.select(*groups, "ratio", "a", "b",
                       F.least("most", F.greatest(WIDTH * (F.col("b") - F.col("a")), F.col("slack"))).alias("reach"))


def thresholds(sketch: DataFrame, groups: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """A row per group with ``<ratio>_low`` and ``<ratio>_high``.  A group's sketch has a bounded number of bins.

    ``sketch`` is read once for every level (all documents, each prefix of ``groups``); store it if it is costly.
    """
    levels = [sketch.groupBy(*groups[:k], "ratio", "bin").agg(F.sum("n").alias("n")) for k in range(len(groups) + 1)]
    held = None
    for k, merged in enumerate(levels):
        if k < min(1, len(groups)):
            merged = merged.filter(~F.col("ratio").isin(*OWN))
        held = _fenced(_quartiles(merged, groups[:k]), held, groups[:k])
    fences = []
    for r, (_, lower) in SLACK.items():
        mine = F.col("ratio") == r
        fences.append(F.max(F.when(mine, F.col("b") + F.col("reach"))).alias(f"{r}_high"))
        fences.append(F.max(F.when(mine, F.col("a") - F.col("reach") if lower else F.lit(-1.0))).alias(f"{r}_low"))
    return held.groupBy(*groups).agg(*fences)


def verdicts(measured: DataFrame, fences: DataFrame, groups: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """Add ``base_failed`` and ``kept``.  A group without fences has no document that passes the base rules."""
    m, f = measured.alias("m"), fences.alias("f")
    on = F.lit(True)
    for g in groups:
        on &= F.col(f"m.{g}").eqNullSafe(F.col(f"f.{g}"))
    passes = F.lit(True)
    for r in SLACK:
        passes &= F.coalesce(_ratio(r).between(F.col(f"{r}_low"), F.col(f"{r}_high")), F.lit(True))
    return m.join(f, on, "left").select(*[F.col(f"m.{c}") for c in measured.columns], base_failed().alias("base_failed"),
                                        (~base_failed() & passes).alias("kept"))


def filter_documents(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their columns as they were.  Texts are measured twice and never shuffled."""
    sketch = stored(sketches(measure(docs, ["lang", "source"])), "sketch")
    fences = stored(thresholds(sketch), "fences", rows=sketch.count() // len(SLACK))
    # The text crosses to Python and back once, beside the other columns.
    others = [c for c in docs.columns if c != "text"]
    carried = docs.select("text", "lang", "source", F.struct(*others).alias("row"))
    kept = verdicts(measure(carried, ["text", "lang", "source", "row"]), fences).filter("kept")
    return kept.select(*["text" if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])


def query(spark, sf_dir):
    measured = stored(measure(table(spark, sf_dir, "documents"), ["doc_id", "lang", "source"]), "measured")
    sketch = stored(sketches(measured), "sketch")
    fences = stored(thresholds(sketch), "fences", rows=sketch.count() // len(SLACK))
    return verdicts(measured, fences).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                             "n_repeat_words", "base_failed", "kept")
