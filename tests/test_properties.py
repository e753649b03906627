"""Property tests (hypothesis): upsert idempotence, rolling monotonicity, band monotonicity."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vigor.functions import exprs as X
from vigor.operators import relational as R
from vigor.operators import sinks as S

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

rows_st = st.lists(st.tuples(st.integers(0, 20), st.integers(0, 5)), min_size=1, max_size=30)


@SETTINGS
@given(target=rows_st, source=rows_st)
def test_upsert_idempotent_and_source_wins(spark, target, source):
    src = {k: v for k, v in source}                      # unique source keys
    t = spark.createDataFrame(target, "k long, v long")
    s = spark.createDataFrame(list(src.items()), "k long, v long")
    once = S.upsert(t, s, ["k"], check_unique=True)
    twice = S.upsert(once, s, ["k"], check_unique=True)
    a = sorted(tuple(r) for r in once.collect())
    assert a == sorted(tuple(r) for r in twice.collect())
    got = {}
    for k, v in a:
        got.setdefault(k, set()).add(v)
    for k, v in src.items():
        assert got[k] == {v}                              # every source key present once, with the source value


@SETTINGS
@given(data=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 60), st.integers(0, 50)), min_size=1, max_size=60))
def test_rolling_sum_28d_dominates_7d_for_non_negative_load(spark, data):
    rows = [(p, dt.date(2024, 1, 1) + dt.timedelta(days=d), float(x)) for p, d, x in data]
    df = spark.createDataFrame(rows, "p long, d date, x double").withColumn("day", F.unix_date("d"))
    out = R.rolling_day_stats(df, "p", "day", [("sum", "x", "s{n}"), ("max", "x", "m{n}")], (7, 28))
    for r in out.collect():
        assert r.s28 >= r.s7 >= r.x and r.m28 >= r.m7 >= r.x


@SETTINGS
@given(scores=st.lists(st.floats(-10, 120, allow_nan=False), min_size=2, max_size=40))
def test_fatigue_band_is_monotone_in_score(spark, scores):
    order = ["Fraîcheur optimale", "Fatigue légère", "Fatigue modérée", "Fatigue élevée / Risque",
             "Danger blessure / baisse performance"]
    df = spark.createDataFrame([(s,) for s in scores], "s double")
    got = sorted((r.s, order.index(r.b)) for r in df.select("s", X.fatigue_band("s").alias("b")).collect())
    ranks = [b for _, b in got]
    assert ranks == sorted(ranks)


@SETTINGS
@given(probs=st.lists(st.floats(0, 1, allow_nan=False), min_size=1, max_size=40))
def test_alert_iff_reduction(spark, probs):
    df = spark.createDataFrame([(p,) for p in probs], "p double")
    for r in df.select(X.alert_flag("p").alias("a"), X.intensity_reduction("p").alias("r")).collect():
        assert (r.a == 1) == (r.r > 0)
