"""Registered sources (SRC-2, SRC-7): load a named table as a DataFrame."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

SUPPLIED_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(base_dir: str, name: str) -> str:
    return os.path.join(base_dir, f"{name}.parquet")


def load(spark: SparkSession, base_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Read ``<base_dir>/<name>.parquet``.

    Passing ``columns`` prunes at the scan (the plan shows a narrow
    ``ReadSchema``); Catalyst would also prune later projections on its own.
    The scan's splits are used as they come: no shuffle is added.
    """
    df = spark.read.parquet(table_path(base_dir, name))
    return df.select(*columns) if columns else df
