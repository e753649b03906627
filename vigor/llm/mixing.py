"""Operator 2, mixing sources to target weights by capped water-filling.  DataFrame functions only.

Every source has a weight and a cap of ``max_epochs`` times its size.  The level ``lam`` gives source ``s`` the
target ``min(cap_s, weight_s * lam)``; sources whose share is above their cap are clamped, and what they cannot
take is reshared by weight over the others until none is above.  Each round is one aggregate of the table of
sources, of which one row reaches the driver.

A source's target over its size is its number of epochs: the whole part repeats every document, the fractional
part takes the documents whose seeded hash lies in the first buckets of the source.  The cut between buckets is
the one whose words come nearest the fraction, so a source misses its target by less than half a bucket (a
document, in a small source).

Defined cases: a null text has size 0; a null source is a source of its own, ranked last; a source without words
has target 0; rows that repeat a doc_id are documents of their own and draw alike; rows without doc_id are drawn by their text, and
equal ones apart; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import WORD, global_rank, stored

#: Hash buckets a source is cut into.  The cut is exact to a bucket; more buckets, finer cuts.
BUCKETS = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cyclic_weights(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Add ``weight``: the weights in turn over the sources by code point, null last."""
    ranked = global_rank(sources, [F.col("source").asc_nulls_last()], "_rank")
    choice = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    return ranked.withColumn("weight", choice).drop("_rank")


def water_fill(sources: DataFrame, budget: float, max_epochs: float) -> DataFrame:
    """Add ``target`` to (source, source_size, weight): weighted shares of ``budget``, none above its cap."""
    cap = F.col("source_size") * F.lit(float(max_epochs))
    level, clamped = 0.0, -1
    while True:
        above = F.col("weight") * F.lit(level) > cap
        row = sources.agg(
            F.sum(F.when(above, cap).otherwise(0.0)).alias("full"),
            F.sum(F.when(above, 0.0).otherwise(F.col("weight"))).alias("open"),
            F.count_if(above).alias("n")).first()
        if row["n"] == clamped or not row["open"]:
            break
        clamped, level = row["n"], max(level, (budget - row["full"]) / row["open"])
    if row["open"] == 0:  # every source is at its cap
        return sources.withColumn("target", cap)
    return sources.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)))


def mix(docs: DataFrame, *, max_epochs: float = 3.0, weights: tuple[int, ...] = (1, 2, 3), seed: int = 17,
        carry: bool = False) -> DataFrame:
    """Return (doc_id, source, size, source_size, target, copies, taken), a row per document.

    ``copies`` is how many times the mix takes the document, at most ``max_epochs`` rounded up to a whole number;
    ``taken`` is ``size * copies``.  With ``carry`` the row of the input comes along as the struct ``row``.
    """
    row = [F.struct("*").alias("row")] if carry else []
    rows = docs.select("doc_id", "source", *row, word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("_text"))
    # Rows without doc_id are told apart by their text and, equal ones, by a rank among them, so that they spread over buckets as others do.
    nameless = rows.filter(F.col("doc_id").isNull()).withColumn("_at", F.monotonically_increasing_id())
    nameless = global_rank(nameless, [F.col("_text"), F.col("_at")], "_rank", per=["_text"]).drop("_at")
    spread = rows.filter(F.col("doc_id").isNotNull()).withColumn("_rank", F.lit(0).cast("long")).unionByName(nameless)
    bucket = F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit(seed), "_text", "_rank")).otherwise(F.xxhash64(F.lit(seed), F.col("doc_id")))
    sized = stored(spread.withColumn("_bucket", F.pmod(bucket, F.lit(BUCKETS)).cast("int")).drop("_text", "_rank"), "sized")
    buckets = stored(sized.groupBy("source", "_bucket").agg(F.sum("size").alias("words")), "buckets", rows=sized.count())
    sizes = buckets.groupBy("source").agg(F.sum("words").alias("source_size"))
    sources = stored(cyclic_weights(sizes, weights), "sources")
    budget = sources.agg(F.sum("source_size")).first()[0] or 0
    filled = water_fill(sources, float(budget), max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    filled = filled.withColumn("whole", F.floor(epochs)).withColumn("part", epochs - F.col("whole"))
    plan = stored(filled.withColumn("want", F.col("part") * F.col("source_size")), "targets")

    # The cut of each source: the first buckets whose words come nearest what the fraction wants.
    runs = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    edges = buckets.withColumn("upto", F.sum("words").over(runs)).alias("b").join(
        plan.alias("p"), F.col("b.source").eqNullSafe(F.col("p.source")))
    cuts = edges.groupBy(F.col("p.source").alias("source")).agg(
        F.min(F.struct(F.abs(F.col("upto") - F.col("want")).alias("miss"), F.col("_bucket"))).alias("best"),
        F.first("want").alias("want"), F.first("whole").alias("whole"), F.first("target").alias("target"),
        F.first("source_size").alias("source_size"))
    cuts = cuts.select("source", "whole", "target", "source_size",
                       F.when(F.col("best.miss") < F.col("want"), F.col("best._bucket")).otherwise(-1).alias("cut"))
    copies = (F.col("whole") + F.when(F.col("_bucket") <= F.col("cut"), 1).otherwise(0)).cast("long")
    return sized.alias("d").join(stored(cuts, "cuts", rows=plan.count()).alias("c"), F.col("d.source").eqNullSafe(F.col("c.source"))).select(
        "d.doc_id", *(["d.row"] if carry else []), "d.source", "d.size", "c.source_size", "c.target",
        copies.alias("copies"), (F.col("d.size") * copies).alias("taken"))


def repeated(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as the mix takes it, with their columns as they were."""
    taken = mix(docs, carry=True, **options).filter("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")


def query(spark, sf_dir):
    from .shared import table
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
