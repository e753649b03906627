"""Relational operators (WIN-*, AGG-*, SET-*, SRT-*).

Scale notes shared by all of them:

* "Keep one row per key" and "latest row per key" are ``row_number() = 1``,
  whose group limit runs map-side: a key that holds a third of all rows is
  collapsed to one row per input partition before the shuffle.
* Trailing day-range windows are computed on per-(entity, day) partial
  aggregates, whose size per entity is bounded by the number of days, then
  joined back to the rows.  An entity with billions of rows still yields one
  small window partition.
* Group-mean imputation aggregates per segment and joins the means back
  (null-safe), instead of an ``avg() over (partition by segment)`` window
  that would send a whole segment to one task.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import col_, round_half_up
from .ranks import quantiles, ranked

# --------------------------------------------------------------------------- WIN-1/2


def dedup_keep_one(df: DataFrame, keys: list[str], order: list[str] | None = None, largest: bool = False) -> DataFrame:
    """One row per ``keys`` (WIN-1, WIN-2).

    The survivor is the first row in ascending order of ``order`` (default:
    every non-key column, in schema order, NULLs first), which is a total
    order, so the result is deterministic.  ``largest`` keeps the last row of
    that order instead.

    Plan: ``row_number() = 1``.  Spark keeps the first row of a key in each map
    task (``WindowGroupLimit``) before the shuffle, so a key holding a third of
    all rows is one row per task when it is shuffled.
    """
    order = order or [c for c in df.columns if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    by = [F.col(f"`{c}`").desc() if largest else F.col(f"`{c}`").asc() for c in order + rest]
    if not by:
        return df.dropDuplicates(keys)
    first = F.row_number().over(Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*by))
    return df.withColumn("__rn", first).filter(F.col("__rn") == 1).drop("__rn")


def latest_per_group(df: DataFrame, keys: list[str], order_desc: list[str]) -> DataFrame:
    """The row with the greatest ``order_desc`` tuple per ``keys`` (WIN-3).

    Ties on the order columns are broken by the remaining columns, so the pick
    is total.  Same plan as :func:`dedup_keep_one`.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_desc]
    return dedup_keep_one(df, keys, order_desc + rest, largest=True)


def top_n_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows per group (WIN-10).  A limit that *is* the feature."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")


# --------------------------------------------------------------------------- WIN-4/5


def impute_group_mean(df: DataFrame, segment: list[str], columns: dict[str, str],
                      source: dict[str, Column] | None = None, few: bool = False) -> DataFrame:
    """``coalesce(x, avg(raw_x) over (partition by segment))`` for each column (WIN-4, WIN-5).

    ``columns`` maps output name -> column holding the value to keep when not
    NULL; ``source`` optionally maps output name -> the column that is averaged
    (default: the same column).  NULL segment values form one group (T30).
    The means are a ``groupBy`` (one row per segment) joined back null-safely.
    The input is read twice, the first time only its segment and measure
    columns; nothing is persisted and no job is started here.  ``few`` says that
    segments are bounded by what they are (ages, positions), not by the rows: their means are broadcast.  Without it
    Spark knows the number of segments only when all rows have been shuffled by them, into as few tasks as there are segments.
    """
    source = source or {}
    tmp = df.select("*", *[source.get(out, F.col(keep)).cast("double").alias(f"__src_{out}")
                            for out, keep in columns.items()])
    avg_cols = {out: f"__src_{out}" for out in columns}
    means = tmp.groupBy(*segment).agg(*[F.avg(n).alias(f"__mean_{o}") for o, n in avg_cols.items()])
    means = means.select(*[F.col(s).alias(f"__seg_{s}") for s in segment],
                         *[F.col(f"__mean_{o}") for o in columns])
    cond = reduce(lambda a, b: a & b, [tmp[s].eqNullSafe(means[f"__seg_{s}"]) for s in segment])
    joined = tmp.join(F.broadcast(means) if few else means, cond, "left")
    for out, keep in columns.items():
        joined = joined.withColumn(out, F.coalesce(F.col(keep), F.col(f"__mean_{out}")))
    drop = [f"__seg_{s}" for s in segment] + [f"__mean_{o}" for o in columns] + list(avg_cols.values())
    return joined.drop(*drop)


# --------------------------------------------------------------------------- WIN-6


def with_global_max(df: DataFrame, column: str, alias: str, of: DataFrame | None = None) -> DataFrame:
    """``max(c) over ()`` beside every row (WIN-6) as scalar aggregate + broadcast.

    An empty ``over()`` plans ``Exchange SinglePartition``: every row goes
    through one task.  A one-row aggregate broadcast to all tasks does not.
    ``of`` names a narrower frame with the same maximum, where ``df`` is a wide
    join that need not be built twice.
    """
    one = (df if of is None else of).agg(F.max(column).alias(alias))
    return df.crossJoin(F.broadcast(one))


# --------------------------------------------------------------------------- WIN-7/8/9


def rolling_day_stats(df: DataFrame, entity: str, day_col: str, specs: list[tuple],
                      windows: tuple[int, ...] = (7, 28), keep: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """Trailing day-range statistics per entity (WIN-7, WIN-8, WIN-9).

    Each output is ``agg(x) over (partition by entity order by day
    range between N preceding and current row)`` -- N+1 calendar days, same
    day peers included.  ``specs`` is a list of ``(kind, value_column, name)``
    with kind in ``avg`` (rounded half-up to 2 decimals), ``max``, ``sum``;
    ``name`` may contain ``{n}`` for the window length.

    Plan: rows -> partial aggregate per (entity, day) -> range windows over
    the daily rows (one small partition per entity) -> join back on
    (entity, day).  The daily pass reads the entity, day and value columns
    only.  Sums are exact decimals, so results do not depend on the
    partitioning.  ``keep(frame, name)`` may store the daily statistics before they are joined.
    """
    day = F.col(day_col)
    aggs = []
    for kind, value, _ in specs:
        v = col_(value)
        key = _spec_key(kind, value)
        if kind == "avg":
            aggs += [F.sum(v.cast("decimal(20,8)")).alias(f"__s_{key}"), F.count(v).alias(f"__c_{key}")]
        elif kind == "max":
            aggs.append(F.max(v).alias(f"__m_{key}"))
        elif kind == "sum":
            aggs.append(F.sum(v.cast("decimal(28,10)")).alias(f"__t_{key}"))
        else:
            raise ValueError(kind)
    daily = df.groupBy(entity, day.alias("__day")).agg(*_dedup_aggs(aggs))
    cols = []
    for n in windows:
        w = Window.partitionBy(entity).orderBy("__day").rangeBetween(-n, 0)
        for kind, value, name in specs:
            key = _spec_key(kind, value)
            out = name.format(n=n)
            if kind == "avg":
                s = F.sum(f"__s_{key}").over(w)
                c = F.sum(f"__c_{key}").over(w)
                cols.append(F.when(c > 0, F.round(s / c, 2)).cast("double").alias(out))
            elif kind == "max":
                cols.append(F.max(f"__m_{key}").over(w).alias(out))
            else:
                cols.append(F.sum(f"__t_{key}").over(w).cast("double").alias(out))
    stats = daily.select(F.col(entity).alias("__entity"), F.col("__day").alias("__on"), *cols)
    out_names = [c for c in stats.columns if c not in ("__entity", "__on")]
    stats = keep(stats, "day_stats") if keep else stats
    base = df.drop(*[c for c in out_names if c in df.columns]).withColumn("__day", day)
    # Null-safe, as window partitions are: rows without entity are one entity, rows without day are each other's peers.
    on = base[entity].eqNullSafe(stats["__entity"]) & base["__day"].eqNullSafe(stats["__on"])
    return base.join(stats, on, "left").drop("__day", "__entity", "__on")


def _spec_key(kind: str, value) -> str:
    return f"{kind}_{value if isinstance(value, str) else abs(hash(str(value)))}"


def _dedup_aggs(aggs):
    seen, out = set(), []
    for a in aggs:
        k = str(a)
        if k not in seen:
            seen.add(k)
            out.append(a)
    return out


# --------------------------------------------------------------------------- AGG-*


def group_mean(df: DataFrame, keys: list[str], columns: list[str], scale: int | None = None) -> DataFrame:
    """Mean of many columns per group (AGG-8, AGG-9 when ``scale`` is set)."""
    def m(c):
        a = F.avg(c)
        return (round_half_up(a, scale) if scale is not None else a).alias(c)
    return df.groupBy(*keys).agg(*[m(c) for c in columns])


def mode_per_group(df: DataFrame, keys: list[str], column: str, alias: str | None = None) -> DataFrame:
    """Most frequent non-NULL value per group; ties -> smallest value (AGG-6, T27).

    Two partial aggregates: counts per (key, value), then ``min(struct(-count,
    value))`` per key.  No group is ever collected into one task.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count(F.lit(1)).alias("__n"))
    best = counts.groupBy(*keys).agg(F.min(F.struct((-F.col("__n")).alias("n"), F.col(column).alias("v"))).alias("__b"))
    return best.select(*keys, F.col("__b.v").alias(alias or column))


def modes_per_group(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Mode of several columns per group, one row per key, a NULL key included (AGG-7)."""
    def joined(a: DataFrame, b: DataFrame) -> DataFrame:
        right = b.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in b.columns if c not in keys])
        on = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
        rest = [c for c in a.columns + b.columns if c not in keys]
        return a.join(right, on, "full").select(*[F.coalesce(k, f"__r_{k}").alias(k) for k in keys], *rest)
    return reduce(joined, [mode_per_group(df, keys, c) for c in columns])


def value_counts(df: DataFrame, column: str, alias: str = "n") -> DataFrame:
    """Frequency table sorted by value (AGG-10)."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(alias)).orderBy(column)


def members(df: DataFrame, keys: list[str], member: str) -> DataFrame:
    """Distinct non-NULL members per group as rows (keys, member_no, member, n_members), member_no from 1 in sorted order (AGG-11).

    The numbers are a distributed rank: a group of any size is split over tasks.
    """
    distinct = df.filter(F.col(member).isNotNull()).select(*keys, member).distinct()
    return ranked(distinct, [F.col(member).asc()], keys, "member_no", "n_members").withColumn("member_no", F.col("member_no") + 1) \
        .select(*keys, "member_no", member, "n_members")


def member_texts(df: DataFrame, keys: list[str], member: str, separator: str = ", ", most: int | None = None, run: int = 1000) -> DataFrame:
    """(keys, members, n_members): the sorted members of a group as one text (AGG-11).

    Every group has its text, however many members it has: runs of ``run`` numbered members are joined first, each in a task of its own,
    then a group's runs, so that a task holds the text and a row a run of it, not a row a member.  With ``most``, larger
    groups have their number and no text; :func:`members` has their rows.
    """
    def joined(column: str) -> Column:
        return F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("__at", F.col(column).alias("m")))), lambda x: x["m"]), separator)

    rows = members(df, keys, member)
    wanted = rows if most is None else rows.filter(F.col("n_members") <= most)
    runs = wanted.withColumn("__run", F.floor((F.col("member_no") - 1) / run)).withColumn("__at", F.col("member_no"))
    runs = runs.groupBy(*keys, "__run", "n_members").agg(joined(member).alias("__text")).withColumn("__at", F.col("__run"))
    out = runs.groupBy(*keys).agg(joined("__text").alias("members"), F.max("n_members").alias("n_members"))
    if most is None:
        return out
    larger = rows.filter(F.col("n_members") > most).groupBy(*keys).agg(F.max("n_members").alias("n_members"))
    return out.unionByName(larger.select(*keys, F.lit(None).cast("string").alias("members"), "n_members"))


def describe_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, std, min, exact 25/50/75 %, max per column (AGG-12), one row per column, as pandas has them.

    Quartiles are order statistics of the range-partitioned values
    (:func:`ranks.quantiles`), all columns in one pass; no buffer holds a column.
    """
    row = df.agg(*[F.struct(F.lit(c).alias("column"), F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
                            F.min(x).alias("min"), F.max(x).alias("max")).alias(c) for c, x in ((c, F.col(c).cast("double")) for c in columns)])
    plain = row.select(F.inline(F.array(*[F.col(c) for c in columns])))
    q = quantiles(df, columns, [0.25, 0.5, 0.75]).groupBy("column").agg(
        *[F.max(F.when(F.col("share") == s, F.col("value"))).alias(n) for s, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))])
    return plain.join(q, "column", "left").select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NULL count per column (AGG-13): one aggregate, unpivoted to (column, n_null)."""
    columns = columns or df.columns
    row = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(columns)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("n_null")) for i, c in enumerate(columns)])
    return row.select(F.explode(pairs).alias("p")).select("p.column", "p.n_null")


def column_catalogue(df: DataFrame) -> DataFrame:
    """name, type, non-NULL count per column (AGG-14)."""
    row = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(df.columns)])
    types = dict(df.dtypes)
    pairs = F.array(*[F.struct(F.lit(i).cast("int").alias("position"), F.lit(c).alias("column"), F.lit(types[c]).alias("type"),
                               F.col(f"n{i}").alias("non_null")) for i, c in enumerate(df.columns)])
    return row.select(F.explode(pairs).alias("p")).select("p.position", "p.column", "p.type", "p.non_null")


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """negatives, positives and ``neg/pos`` (AGG-15)."""
    return df.agg(F.count_if(F.col(label) == 0).alias("negatives"),
                  F.count_if(F.col(label) == 1).alias("positives")) \
             .withColumn("pos_weight", F.try_divide(F.col("negatives").cast("double"), F.col("positives")))


def row_count_audit(tables: dict[str, DataFrame], order_desc: bool = True) -> DataFrame:
    """``SELECT 'name', COUNT(*) ... UNION ALL ...`` sorted by count (AGG-5, SET-1, SRT-1)."""
    parts = [df.agg(F.count(F.lit(1)).alias("nb_lignes")).select(F.lit(name).alias("table_name"), "nb_lignes")
             for name, df in tables.items()]
    out = reduce(lambda a, b: a.unionByName(b), parts)
    return out.orderBy(F.col("nb_lignes").desc(), "table_name") if order_desc else out


def preview(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """First rows in a stated order (SRT-2): ``orderBy(...).limit(n)``, a top-k."""
    return df.orderBy(*order).limit(n)


def summary_stats(df: DataFrame, entity: str, value: str, flag_threshold: float) -> DataFrame:
    """count, distinct entities, rounded avg/min/max, conditional count (AGG-3)."""
    v = F.col(value)
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.countDistinct(entity).alias("n_entities"),
                  round_half_up(F.avg(v), 2).alias("avg_value"),
                  round_half_up(F.min(v), 2).alias("min_value"),
                  round_half_up(F.max(v), 2).alias("max_value"),
                  F.count_if(v > flag_threshold).alias("n_above"))
