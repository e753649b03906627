"""Join helpers (JN-*): key-cast joins, existence joins, stored stages.

No join here carries a broadcast hint: Spark broadcasts a side from its
measured bytes (statically or, under AQE, from finished shuffle files), and
splits a skewed partition of the joins that stay shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import save


def materialise(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as parquet to ``path`` (a shared folder) and read it back.

    One computation, lineage cut at the table, and columnar re-reads with
    pruning/pushdown for every consumer -- the Spark form of a CTAS table.
    With ``partition_by`` (e.g. ``season``) a filter on that column reads
    only the matching folders (partition pruning).
    """
    save(df, path, "overwrite", partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(path)   # schema known: no footer-inference job


def join_on_cast_keys(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                      type_: str = "bigint", how: str = "inner") -> DataFrame:
    """Equi-join after safe-casting both keys (JN-2); keys are cast once, in a projection."""
    l = left.withColumn("__k", F.col(left_key).try_cast(type_))
    r = right.withColumn("__k", F.col(right_key).try_cast(type_)).drop(*[c for c in right.columns if c in left.columns])
    return l.join(r, "__k", how).drop("__k")


def exists_in(df: DataFrame, other: DataFrame, on) -> DataFrame:
    """Rows of ``df`` with a match in ``other`` (JN-9): a left-semi join, no fan-out."""
    return df.join(other, on, "left_semi")
