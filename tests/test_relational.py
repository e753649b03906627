"""Relational operators: determinism, NULL groups, day-range windows vs brute force."""

import datetime as dt
import random

from pyspark.sql import functions as F
from pyspark.sql import Window

from vigor.operators import relational as R


def test_dedup_is_total_and_deterministic(spark):
    rows = [(1, "b", None), (1, "a", 2.0), (1, "a", 1.0), (2, None, 5.0), (2, "z", 1.0)]
    df = spark.createDataFrame(rows, "k long, s string, x double")
    got = sorted(tuple(r) for r in R.dedup_keep_one(df.repartition(3), ["k"]).collect())
    assert got == [(1, "a", 1.0), (2, None, 5.0)]   # NULLs first, then ascending


def test_latest_per_group_ties_by_session(spark):
    rows = [(1, 10, dt.date(2024, 1, 1), "s1"), (1, 10, dt.date(2024, 1, 3), "s2"), (1, 10, dt.date(2024, 1, 3), "s3"),
            (2, 10, dt.date(2024, 1, 2), "s4")]
    df = spark.createDataFrame(rows, "p long, m long, d date, s string")
    got = sorted(tuple(r) for r in R.latest_per_group(df, ["p", "m"], ["d", "s"]).collect())
    assert got == [(1, 10, dt.date(2024, 1, 3), "s3"), (2, 10, dt.date(2024, 1, 2), "s4")]


def test_impute_null_segment_is_one_group(spark):
    rows = [(1, None, 10.0), (2, None, None), (3, 20, 4.0), (4, 20, None), (5, 21, None)]
    df = spark.createDataFrame(rows, "id long, age long, h double")
    got = dict((r.id, r.h2) for r in R.impute_group_mean(df, ["age"], {"h2": "h"}).collect())
    assert got == {1: 10.0, 2: 10.0, 3: 4.0, 4: 4.0, 5: None}


def test_mode_ties_pick_smallest(spark):
    rows = [(1, "b"), (1, "a"), (1, "b"), (1, "a"), (2, "x"), (2, None), (2, None)]
    df = spark.createDataFrame(rows, "k long, v string")
    assert sorted(tuple(r) for r in R.mode_per_group(df, ["k"], "v").collect()) == [(1, "a"), (2, "x")]


def test_global_max_plans_no_single_partition(spark):
    df = spark.range(1000).withColumn("x", F.col("id") * 2)
    out = R.with_global_max(df, "x", "mx")
    plan = out._jdf.queryExecution().executedPlan().toString()
    # only the partial maxima (one row per partition) meet in one task; rows never do
    assert "Window" not in plan and "BroadcastNestedLoopJoin" in plan
    assert out.agg(F.min("mx"), F.max("mx")).first() == (1998, 1998)


def _dates_fixture(spark):
    # sessions on 22, 23, 24, 28 Feb and 1 Mar 2024, two on one day; a second player
    rows = [(1, dt.date(2024, 2, 22), 10.0, 2.0), (1, dt.date(2024, 2, 23), 20.0, 1.0), (1, dt.date(2024, 2, 24), 30.0, None),
            (1, dt.date(2024, 2, 28), 40.0, 3.0), (1, dt.date(2024, 3, 1), 50.0, 1.0), (1, dt.date(2024, 3, 1), 60.0, 2.0),
            (2, dt.date(2024, 1, 1), 5.0, 1.0), (2, dt.date(2024, 3, 1), 7.0, 1.0)]
    return spark.createDataFrame(rows, "p long, d date, x double, y double").withColumn("day", F.unix_date("d"))


def test_rolling_day_range_month_boundary_and_peers(spark):
    df = _dates_fixture(spark)
    specs = [("avg", "x", "avg_{n}d"), ("max", "x", "max_{n}d"), ("sum", "y", "sum_{n}d")]
    out = {(r.p, r.d, r.x): r for r in R.rolling_day_stats(df, "p", "day", specs, (7, 28)).collect()}
    r = out[(1, dt.date(2024, 3, 1), 50.0)]
    # 7 preceding days of 1 March (2024 is a leap year) reach back to 23 Feb: 20, 30, 40, 50, 60
    assert r.avg_7d == 40.0 and r.max_7d == 60.0 and r.sum_7d == 7.0
    assert r.avg_28d == 35.0 and r.sum_28d == 9.0
    assert out[(2, dt.date(2024, 3, 1), 7.0)].avg_28d == 7.0   # 1 Jan is 60 days back


def test_rolling_matches_plain_window_on_random_data(spark):
    rnd = random.Random(7)
    rows = [(rnd.randint(0, 5), dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randint(0, 90)), float(rnd.randint(0, 100)))
            for _ in range(400)]
    df = spark.createDataFrame(rows, "p long, d date, x double").withColumn("day", F.unix_date("d")) \
              .withColumn("rid", F.monotonically_increasing_id())
    mine = R.rolling_day_stats(df, "p", "day", [("avg", "x", "a{n}"), ("max", "x", "m{n}"), ("sum", "x", "s{n}")], (7, 28))
    w = lambda n: Window.partitionBy("p").orderBy("day").rangeBetween(-n, 0)
    ref = df.select("rid", *[F.round(F.avg("x").over(w(n)), 2).alias(f"a{n}") for n in (7, 28)],
                    *[F.max("x").over(w(n)).alias(f"m{n}") for n in (7, 28)],
                    *[F.sum("x").over(w(n)).alias(f"s{n}") for n in (7, 28)])
    a = sorted(tuple(r) for r in mine.select("rid", "a7", "a28", "m7", "m28", "s7", "s28").collect())
    b = sorted(tuple(r) for r in ref.select("rid", "a7", "a28", "m7", "m28", "s7", "s28").collect())
    assert a == b


def test_null_counts_and_catalogue(spark):
    df = spark.createDataFrame([(1, None), (None, "a"), (3, None)], "a long, b string")
    assert sorted(tuple(r) for r in R.null_counts(df).collect()) == [("a", 1), ("b", 2)]
    assert [tuple(r) for r in R.column_catalogue(df).orderBy("position").collect()] == [(0, "a", "bigint", 2), (1, "b", "string", 1)]


def test_describe_exact_matches_pandas(spark):
    import pandas as pd
    vals = [1.0, 2.0, 4.0, 8.0, 16.0]
    d = R.describe_columns(spark.createDataFrame([(v,) for v in vals], "x double"), ["x"]).first()
    s = pd.Series(vals).describe()
    assert (d["count"], d["mean"], d["min"], d["p25"], d["p50"], d["p75"], d["max"]) == \
        (s["count"], s["mean"], s["min"], s["25%"], s["50%"], s["75%"], s["max"])
    assert abs(d["std"] - s["std"]) < 1e-12


def test_rolling_statistics_take_null_entities_and_days(spark, duck):
    rnd = random.Random(2)
    rows = [(rnd.choice([None, 1, 2]), rnd.choice([None, *range(40)]), rnd.choice([None, 1.0, 2.5, 9.0]), i) for i in range(300)]
    df = spark.createDataFrame(rows, "p long, day long, x double, id long")
    got = {r.id: (r.a, r.m, r.s) for r in R.rolling_day_stats(df, "p", "day", [("avg", "x", "a"), ("max", "x", "m"), ("sum", "x", "s")], (7,)).collect()}
    duck.execute("CREATE OR REPLACE TABLE rolling (p BIGINT, day BIGINT, x DOUBLE, id BIGINT)")
    duck.executemany("INSERT INTO rolling VALUES (?, ?, ?, ?)", rows)
    want = duck.execute("SELECT id, CAST(ROUND(CAST(AVG(x) OVER w AS DECIMAL(20,8)), 2) AS DOUBLE), MAX(x) OVER w, SUM(x) OVER w FROM rolling "
                        "WINDOW w AS (PARTITION BY p ORDER BY day NULLS FIRST RANGE BETWEEN 7 PRECEDING AND CURRENT ROW)").fetchall()
    assert got == {i: (a, m, s) for i, a, m, s in want}
