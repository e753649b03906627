"""Ranks and order statistics of any number of rows, without one task that sees them all.

Rows are range-partitioned by the order and written once, numbered as they are
written; a partition's rows are shifted by the row counts of the partitions
before it, which are one row a partition and group.  Group and order together
should tell rows apart (aggregate equal rows first): rows that agree on both
fall into one partition.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, save


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared one."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/vigor-tables/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``df`` written once to the shared folder (or to ``path``) and read back: lineage cut, the same rows for every reader."""
    path = path or scratch(df.sparkSession, name)
    save(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _ranged(df: DataFrame, per: list[str], order: list[Column]) -> DataFrame:
    """Stored rows with ``__part`` and, ascending in the order within a part, ``__seq``."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*[F.col(k) for k in per], *order]
    rows = df.repartitionByRange(partitions, *keys).sortWithinPartitions(*keys)
    return staged(rows.withColumn("__part", F.spark_partition_id()).withColumn("__seq", F.monotonically_increasing_id()), "ranged")


def _same(names: list[str], left: str, right: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in names])


def ranked(df: DataFrame, order: list[Column], per: list[str] = (), name: str = "rank", total: str | None = None) -> DataFrame:
    """Add ``name``, the 0-based place in ``order`` (of the group ``per``), and with ``total`` the number of rows of the group.

    A group may span any number of partitions.
    """
    per = list(per)
    rows = _ranged(df, per, order)
    runs = rows.groupBy("__part", *per).agg(F.min("__seq").alias("__first"), F.count(F.lit(1)).alias("__n"))
    group = Window.partitionBy(*per) if per else Window.partitionBy(F.lit(0))
    before = F.coalesce(F.sum("__n").over(group.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.withColumn("__before", before).withColumn("__total", F.sum("__n").over(group))
    joined = rows.alias("r").join(runs.alias("g"), _same(["__part", *per], "r", "g"))
    place = F.col("g.__before") + F.col("r.__seq") - F.col("g.__first")
    return joined.select(*[F.col(f"r.`{c}`") for c in df.columns], place.alias(name), *([F.col("g.__total").alias(total)] if total else []))


def quantiles(df: DataFrame, columns: list[str], shares: list[float]) -> DataFrame:
    """(column, share, value): exact quantiles of numeric columns, linearly interpolated between ranks; NULLs don't count.

    Equal values are counted first (partly before the shuffle), so a hot value is
    one row.  The distinct values of all columns are range-partitioned; of
    them only the partitions that hold a wanted rank are read again.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    counted = df.select(F.inline(pairs)).filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    rows = _ranged(counted, ["column"], [F.col("value").asc()])
    column = Window.partitionBy("column")
    parts = rows.groupBy("__part", "column").agg(F.sum("n").alias("n"))
    parts = parts.select("__part", "column", "n", F.sum("n").over(column).alias("total"), F.coalesce(
        F.sum("n").over(column.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    at = F.col("share") * (F.col("total") - 1)
    wanted = parts.withColumn("share", F.explode(F.array(*[F.lit(float(s)) for s in shares]))).select(
        "*", F.explode(F.array_distinct(F.array(F.floor(at), F.ceil(at)))).alias("place"), (at - F.floor(at)).alias("over"))
    wanted = wanted.filter((F.col("place") >= F.col("before")) & (F.col("place") < F.col("before") + F.col("n")))
    wanted = wanted.select("__part", "column", "share", "over", (F.col("place") - F.col("before")).alias("inside"), "place")
    there = rows.join(wanted.select("__part", "column").distinct(), ["__part", "column"], "left_semi")
    upto = Window.partitionBy("__part", "column").orderBy("value")
    there = there.withColumn("last", F.sum("n").over(upto))
    hit = there.join(wanted, ["__part", "column"]).filter((F.col("inside") < F.col("last")) & (F.col("inside") >= F.col("last") - F.col("n")))
    low, high = F.min_by("value", "place"), F.max_by("value", "place")
    return hit.groupBy("column", "share", "over").agg(low.alias("low"), high.alias("high")).select(
        "column", "share", (F.col("low") * (1 - F.col("over")) + F.col("high") * F.col("over")).alias("value"))
