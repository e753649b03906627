"""Sinks and materialisation (SNK-1 ... SNK-7).

The relational core of each sink is a pure function of DataFrames
(``upsert``, ``scd2_snapshot``) so it can be checked against SQL; the
``*_table`` helpers persist it.  Parquet has no transactions, so a table is a
folder of immutable versions ``<path>/v=<n>``: a write goes to a fresh
version and readers pick the newest complete one (a ``_SUCCESS`` marker).
Reading the current version and writing the next one never touch the same
files, and a failed job leaves the previous version intact.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import save, shuffles_freed


class DuplicateKeyError(ValueError):
    pass


class VersionTakenError(RuntimeError):
    pass


# ------------------------------------------------------------------ key checks

def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once (also DQ-2)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def assert_unique(df: DataFrame, keys: list[str]) -> None:
    """Raise when ``keys`` repeat (a MERGE would fail on such a source, T18)."""
    with shuffles_freed(df.sparkSession):
        repeats = duplicate_keys(df, keys).limit(1).count()
    if repeats:
        raise DuplicateKeyError(f"source repeats key {keys}")


# ------------------------------------------------------------------ SNK-4 / SNK-5

def upsert(target: DataFrame | None, source: DataFrame, keys: list[str], check_unique: bool = True) -> DataFrame:
    """MERGE ... WHEN MATCHED UPDATE SET * WHEN NOT MATCHED INSERT * as a relation.

    Result = target rows whose key is absent from the source, plus every
    source row.  Rows that vanished from the source stay (T19).  A missing
    target means first load (T20).  One anti join on the keys + a union.
    """
    if check_unique:
        assert_unique(source, keys)
    if target is None:
        return source
    kept = target.join(source.select(*keys), keys, "left_anti")
    return kept.unionByName(source.select(*target.columns) if set(target.columns) == set(source.columns) else source,
                            allowMissingColumns=True)


def with_load_timestamp(df: DataFrame, name: str = "updated_at") -> DataFrame:
    """``current_timestamp() AS updated_at`` (SNK-7)."""
    return df.withColumn(name, F.current_timestamp())


# ------------------------------------------------------------------ SNK-6

SCD_COLUMNS = ["valid_from", "valid_to", "scd_id"]


def scd2_snapshot(history: DataFrame | None, current: DataFrame, key: str, check_cols: list[str],
                  as_of) -> DataFrame:
    """Type-2 history, ``check`` strategy (SNK-6).

    * key new in ``current``  -> open a version (valid_from = as_of, valid_to NULL)
    * any check column differs (NULL-safe) -> close the open version, open a new one
    * unchanged               -> keep the open version as is
    * key gone from ``current`` -> the open version stays open (no hard delete)
    ``scd_id = md5(key || '|' || as_of)``.  One full outer join of the open
    versions with the current rows on the key; closed versions pass through.
    """
    ts = F.lit(as_of).cast("timestamp_ntz")   # run time as wall-clock: independent of the session zone
    cols = current.columns

    def opened(df):
        return df.select(*cols, ts.alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to"),
                         F.md5(F.concat_ws("|", F.col(key).cast("string"), ts.cast("string"))).alias("scd_id"))

    if history is None:
        return opened(current)
    closed_before = history.filter(F.col("valid_to").isNotNull())
    open_rows = history.filter(F.col("valid_to").isNull())
    cur = current.select(*[F.col(c).alias(f"__c_{c}") for c in cols])
    j = open_rows.join(cur, open_rows[key] == cur[f"__c_{key}"], "full")
    in_hist = F.col(key).isNotNull()
    in_cur = F.col(f"__c_{key}").isNotNull()
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__c_{c}")) for c in check_cols])
    changed = in_hist & in_cur & ~same
    hist_cols = cols + SCD_COLUMNS
    # open versions that stay open (unchanged or vanished) or get closed (changed)
    kept = j.filter(in_hist).select(*[F.col(c) for c in cols], "valid_from",
                                    F.when(changed, ts).otherwise(F.col("valid_to")).alias("valid_to"), "scd_id")
    new_versions = opened(j.filter(in_cur & (~in_hist | changed)).select(*[F.col(f"__c_{c}").alias(c) for c in cols]))
    return closed_before.select(*hist_cols).unionByName(kept).unionByName(new_versions)


# ------------------------------------------------------------------ versioned tables (SNK-1/2/4/6)

def file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def remove(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def _numbered(spark: SparkSession, path: str, prefix: str) -> set[int]:
    fs, p = file_system(spark, path)
    names = [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []
    return {int(n[len(prefix):]) for n in names if n.startswith(prefix)}


def table_versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions of a table folder, oldest first."""
    fs, _ = file_system(spark, path)
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    made = _numbered(spark, path, "v=") - _numbered(spark, path, "_abandoned=")
    return sorted(n for n in made if fs.exists(done(f"{path}/v={n}/_SUCCESS")))


def next_version(spark: SparkSession, path: str) -> int:
    """One past the newest complete or abandoned version."""
    return max([*table_versions(spark, path), *_numbered(spark, path, "_abandoned=")], default=0) + 1


def _mark(spark: SparkSession, path: str, name: str) -> None:
    fs, marker = file_system(spark, f"{path}/{name}")
    fs.create(marker, False).close()


def abandon(spark: SparkSession, path: str, version: int) -> None:
    """Give up a version whose writer failed, so that the next one can be written."""
    _mark(spark, path, f"_abandoned={version}")


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest complete version, or None if the table does not exist yet (SRC-7)."""
    vs = table_versions(spark, path)
    return spark.read.parquet(f"{path}/v={vs[-1]}") if vs else None


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, version: int | None = None,
                gate: Callable[[str], None] | None = None) -> str:
    """Full refresh with schema replacement (SNK-1, SNK-2): write the next version.

    ``gate`` is called with the folder of the written rows before readers can
    see them; if it raises, the version is abandoned and they keep the one before.

    ``version`` is the one to make (default: the next).  Its ``_claim`` marker
    is created exclusively: of two writers of one version the second gets
    ``VersionTakenError`` and has to merge again on what the first wrote.  A
    write that fails abandons its version; after a driver's death call
    :func:`abandon`.
    """
    spark = df.sparkSession
    version = version or next_version(spark, path)
    try:
        _mark(spark, path, f"_claim={version}")
    except Py4JJavaError as e:
        raise VersionTakenError(f"{path}: version {version} was claimed by another job") from e
    target = f"{path}/v={version}"
    options = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"} if gate else {}
    try:
        save(df, target, partition_by=partition_by, **options)
        if gate:
            gate(target)
            _mark(spark, path, f"v={version}/_SUCCESS")
    except Exception:
        abandon(spark, path, version)
        raise
    return target


def create_if_absent(df: DataFrame, path: str) -> str | None:
    """``CREATE TABLE IF NOT EXISTS ... AS`` (SRC-1): write only when no version exists."""
    return None if table_versions(df.sparkSession, path) else write_table(df, path)


def upsert_table(source: DataFrame, path: str, keys: list[str], partition_by: list[str] | None = None) -> str:
    """Incremental model with a unique key (SNK-4/5): merge into the current version."""
    version = next_version(source.sparkSession, path)
    current = read_table(source.sparkSession, path)
    return write_table(upsert(current, source, keys), path, partition_by, version)


def snapshot_table(current: DataFrame, path: str, key: str, check_cols: list[str], as_of) -> str:
    """Run one snapshot step against the stored history (SNK-6)."""
    version = next_version(current.sparkSession, path)
    history = read_table(current.sparkSession, path)
    return write_table(scd2_snapshot(history, current, key, check_cols, as_of), path, version=version)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """``CREATE OR REPLACE TEMP VIEW`` (SNK-3)."""
    df.createOrReplaceTempView(name)
    return df


def copy_upper(df: DataFrame) -> DataFrame:
    """Column names upper-cased for a table-to-table copy (SRC-6)."""
    return df.toDF(*[c.upper() for c in df.columns])
