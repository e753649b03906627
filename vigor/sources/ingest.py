"""Ingest jobs (SRC-1, SRC-3, SRC-5, SRC-6).

* CSV scan with a header and an explicit schema (or inference).
* Sheet-style type narrowing: every column arrives as text; blank -> NULL;
  a column becomes BIGINT if every value is an integral number, DOUBLE if
  every value is a number, else stays STRING.  The decision for *all*
  columns is ONE aggregate pass (three counts per column), then one
  projection of casts -- no per-column jobs, no driver-side pandas.
* Incremental ingest: incoming rows not yet loaded = left-anti join on keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.sinks import write_table

# The text columns of the raw stats export that go through narrowing.
STATS_TEXT_COLUMNS = ["GAME_ID", "PLAYER_ID", "START_POSITION", "MIN", "PTS", "FGM", "FGA", "FG_PCT", "FG3M",
                      "FG3A", "FG3_PCT", "FTM", "FTA", "FT_PCT", "OREB", "DREB", "REB", "AST", "STL", "BLK", "TO",
                      "PF", "PLUS_MINUS", "COMMENT"]


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None, infer: bool = False) -> DataFrame:
    """CSV with a header row; explicit schema unless ``infer`` (SRC-1)."""
    r = spark.read.option("header", True)
    if schema is not None:
        return r.schema(schema).csv(path)
    return r.option("inferSchema", infer).csv(path)


#: Types that a text column may take, the first that all its values fit.
INFERRED = ("bigint", "double", "date", "timestamp")


#: Rows looked at first, only to rule types out.
LOOKED_AT = 2_000


def inferred_types(df: DataFrame) -> dict[str, str]:
    """The type that all values of each text column fit (string if none, or without values).

    A type that one value doesn't fit is out, so a look at a few rows leaves few to test; what is left is tested on all rows, the first
    type of each column at a time, and a column goes on only if a value of another row doesn't fit.  A row a pass reaches the driver.
    """
    likely = [F.count(_likely(F.col("v"), t)).alias(t) for t in INFERRED]
    looked = _per_column(df.limit(LOOKED_AT), {c: F.col(f"`{c}`") for c in df.columns}, [F.count("v").alias("n"), *likely])
    left = {r["column_name"]: [t for t in INFERRED if r[t] == r["n"]] for r in looked.collect()}
    types: dict[str, str] = {}
    while open_ := {c: [*left[c][:1]] for c in df.columns if c not in types}:
        for c, fits in _fitting(df, open_).items():
            if not open_[c] or not fits["n"]:
                types[c] = "string"
            elif fits[open_[c][0]] == fits["n"]:
                types[c] = open_[c][0]
            else:
                left[c] = left[c][1:]
    return types


def _likely(v: Column, t: str) -> Column:
    """The value as type ``t``.  One that doesn't begin like a number or a date isn't parsed; a failed parse costs far more than a look at the first character."""
    return F.when(v.rlike(r"^\s*[-+.0-9]"), v.try_cast(t))


def _fitting(df: DataFrame, types: dict[str, list[str]]) -> dict[str, dict[str, int]]:
    """Per column the number of values (``n``) and of those that fit each of its types; columns without types aren't read."""
    names = [(c, t) for c, ts in types.items() if ts for t in ("n", *ts)]
    found = [{}]
    if names:
        found = df.agg(*[F.count(F.col(f"`{c}`") if t == "n" else _likely(F.col(f"`{c}`"), t)).alias(f"v{i}") for i, (c, t) in enumerate(names)]).collect()
    out: dict[str, dict[str, int]] = {c: {"n": 0} for c in types}
    for i, (c, t) in enumerate(names):
        out[c][t] = found[0][f"v{i}"]
    return out


def _per_column(df: DataFrame, values: dict[str, Column], aggregates: list[Column]) -> DataFrame:
    """(column_name, aggregates) over the values ``v`` of each column: one pass over rows of (column, value), added up before the shuffle.

    Aggregates beside each other would be one expression a column and type, whose code takes longer to compile than to run
    where rows are few; for many rows they are the faster way.
    """
    pairs = F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), v.alias("v")) for c, v in values.items()]))
    found = df.select(pairs).groupBy("column_name").agg(*aggregates)
    names = df.sparkSession.createDataFrame([(c,) for c in values], "column_name string")
    return names.join(found, "column_name", "left").na.fill(0)


def read_csv_inferred(spark: SparkSession, path: str, staged: str, corrupt: str = "_corrupt_record") -> tuple[DataFrame, DataFrame]:
    """(rows, broken lines) of all CSV files of a folder, each with a header (SRC-1).

    A line with too few or too many fields is no row: it is kept aside as
    text and has no say in the types, which are those that all rows of all files
    fit.  Lines are parsed once, into the folder ``staged``, which both results read.
    """
    names = spark.read.option("header", True).csv(path).columns
    schema = StructType([StructField(c, StringType()) for c in [*names, corrupt]])
    reader = spark.read.schema(schema).option("header", True).option("columnNameOfCorruptRecord", corrupt)
    reader.csv(path).write.parquet(staged)
    lines = spark.read.schema(schema).parquet(staged)
    rows = lines.filter(F.col(corrupt).isNull()).drop(corrupt)
    types = inferred_types(rows)
    return (rows.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) for c in names]),
            lines.filter(F.col(corrupt).isNotNull()).select(corrupt))


def _blank_to_null(c: str):
    """Blank text and the text NaN are missing values."""
    text = F.trim(F.col(f"`{c}`"))
    return F.when((text != "") & (F.lower(text) != "nan"), text)


def narrowing_decisions(df: DataFrame) -> DataFrame:
    """(column_name, n_values, n_numeric, n_fractional, decided_type), one aggregate pass."""
    texts = df.select(*[_blank_to_null(c).alias(f"v{i}") for i, c in enumerate(df.columns)])
    # only what begins like a number, an infinity or a NaN is parsed, see _likely
    numbers = texts.select("*", *[F.when(F.col(f"v{i}").rlike(r"^[\s\p{Cntrl}]*[-+.0-9iInN]"), F.col(f"v{i}").try_cast("double")).alias(f"d{i}")
                                  for i in range(len(df.columns))])
    row = numbers.agg(*[F.struct(F.lit(c).alias("column_name"), F.count(f"v{i}").alias("n_values"), F.count(f"d{i}").alias("n_numeric"),
                                 F.count_if(F.col(f"d{i}") != F.round(f"d{i}")).alias("n_fractional")).alias(f"c{i}") for i, c in enumerate(df.columns)])
    out = row.select(F.inline(F.array(*[f"c{i}" for i in range(len(df.columns))])))
    decided = (F.when(F.col("n_numeric") < F.col("n_values"), "string")
                .when(F.col("n_fractional") == 0, "bigint").otherwise("double"))
    return out.withColumn("decided_type", decided)


def narrow_types(df: DataFrame) -> DataFrame:
    """Apply the decisions: blank -> NULL, then cast each column to its decided type.

    The decisions are one row per *column* (bounded by the schema width), so
    bringing them to the driver to build the projection is metadata, not data.
    """
    types = {r.column_name: r.decided_type for r in narrowing_decisions(df).collect()}
    made = {"string": lambda v: v, "double": lambda v: v.cast("double"),
            "bigint": lambda v: F.coalesce(v.try_cast("bigint"), F.round(v.cast("double")).cast("bigint"))}  # 1.0, 1e2
    return df.select(*[made[types[c]](_blank_to_null(c)).alias(c) for c in df.columns])


def skip_if_empty(df: DataFrame) -> DataFrame | None:
    """An empty source is skipped (returns None) rather than overwriting a table."""
    return None if df.limit(1).count() == 0 else df


def ingest_sheets(sheets: dict[str, DataFrame], base: str) -> list[str]:
    """Load sheet tables (all text) with narrowed types, each a full refresh under ``base``; empty ones are skipped.

    Returns the names of those loaded.
    """
    loaded = []
    for name, sheet in sheets.items():
        rows = skip_if_empty(sheet)
        if rows is not None:
            write_table(narrow_types(rows), f"{base}/{name}")
            loaded.append(name)
    return loaded


def row_changes(incoming: DataFrame, loaded: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows with ``change``: inserted, changed or equal; and keys that vanished, other columns NULL (SRC-5).

    One full join on the keys (NULLs are equal) with a hash of the other
    columns: of the loaded side only keys and hash are shuffled.  Keys must be unique on both sides.
    """
    rest = [c for c in incoming.columns if c not in keys]
    row_hash = F.xxhash64(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0")) for c in rest])
    left = incoming.withColumn("__hash", row_hash).alias("i")
    right = loaded.select(*keys, row_hash.alias("__hash")).alias("l")
    on = reduce(lambda a, b: a & b, [F.col(f"i.{k}").eqNullSafe(F.col(f"l.{k}")) for k in keys])
    change = (F.when(F.col("l.__hash").isNull(), "inserted").when(F.col("i.__hash").isNull(), "vanished")
               .when(F.col("i.__hash") == F.col("l.__hash"), "equal").otherwise("changed"))
    return left.join(right, on, "full").select(
        *[F.coalesce(f"i.{c}", f"l.{c}").alias(c) if c in keys else F.col(f"i.{c}") for c in incoming.columns], change.alias("change"))


def new_rows(incoming: DataFrame, loaded: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows whose key is not loaded yet (SRC-5): a left-anti join."""
    return incoming.join(loaded.select(*keys), keys, "left_anti")
