"""Helpers shared by the training-data operators: stored intermediates, ranks, Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: The word class of every operator here: runs of bytes that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text a task works on at once; bounds the size of numpy intermediates, not what is read.
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows that a stored file holds at least, where a bound on all rows is known.
FILE_ROWS = 5000


def files_for(rows: int, each: int | None = None) -> int:
    """Files that ``rows`` rows fill, ``each`` (``FILE_ROWS``) a file."""
    return max(1, -(-rows // (each or FILE_ROWS)))


def stored(df: DataFrame, name: str, codec: str | None = None, rows: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back (cuts the lineage, survives lost executors).

    ``rows``, if known, is about how many rows it has at most: few rows go to few files, whatever the shuffle partitions.
    """
    spark = df.sparkSession
    df = df if rows is None else df.coalesce(files_for(rows))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def input_partitions(df: DataFrame) -> int:
    """The session's shuffle partition count, which the caller sizes to the data."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def global_rank(df: DataFrame, order: list[Column], name: str, per: list[str] | None = None, total: str | None = None) -> DataFrame:
    """Add ``name``: the 0-based rank in the total order ``order``, without bringing all rows to one task.

    Rows are range-partitioned and stored (so the split is fixed), numbered inside each partition, and shifted by
    the row counts of the partitions before: one row per partition, whatever the input.  With ``per`` (leading
    columns of the order) the rank restarts with every group; a group may span any number of partitions.  ``total``
    names a column for the rows of the group.
    """
    ranged = df.repartitionByRange(input_partitions(df), *order).withColumn("_part", F.spark_partition_id())
    ranged = stored(ranged, "ranked")
    per = per or []
    inside = Window.partitionBy("_part", *per).orderBy(*order)
    counts = ranged.groupBy("_part", *per).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*per) if per else Window.partitionBy(F.lit(0))
    shift = counts.withColumn("_before", F.coalesce(
        F.sum("_n").over(before.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("_total", F.sum("_n").over(before))
    left = ranged.withColumn("_inside", F.row_number().over(inside) - 1).alias("l")
    right = shift.drop("_n").alias("r")
    on = F.col("l._part") == F.col("r._part")
    for c in per:
        on &= F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    return left.join(right, on).select(*[F.col(f"l.{c}") for c in df.columns],
                                       (F.col("_inside") + F.col("_before")).alias(name),
                                       *([F.col("_total").alias(total)] if total else []))


def chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices of at most about ``limit`` bytes of ``column`` (one row at least)."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).to_pylist()
        start, total = 0, 0
        for i, n in enumerate(sizes):
            n = n or 0
            if i > start and total + n > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if start < len(sizes):
            yield batch.slice(start)


#: Ids that a broadcast may hold (8 bytes each).
BROADCAST_IDS = 1_000_000


def rows_of(df: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """Rows of ``df`` whose ``column`` is in the stored one-column ``ids``: counted first, and sent to all tasks if few."""
    return df.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, column, "left_semi")
