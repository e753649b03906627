"""Plan assertions: pushdown, pruning, no single-partition exchange, no Python UDFs."""

from vigor.plans.registry import Ctx
from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pipeline_plans_stay_in_the_jvm(spark):
    c = Ctx(spark, SF_SMALL)
    for df in (c.stg_sessions, c.fatigue, c.mart_pc, c.mart_game):
        p = _plan(df)
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
        assert "SinglePartition" not in p


def test_scan_is_pruned(spark):
    from vigor.sources.catalog import load
    df = load(spark, SF_SMALL, "events", ["user_id", "value"]).filter("value > 10")
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<user_id:bigint,value:double>" in p
    assert "PushedFilters: [IsNotNull(value), GreaterThan(value,10.0)]" in p


def test_small_dimension_is_broadcast(spark):
    from vigor.plans import pipelines as P
    c = Ctx(spark, SF_SMALL)
    assert "BroadcastHashJoin" in _plan(P.int_fatigue_index(c.stg_sessions, c.stg_stats, c.stg_players))


def test_rolling_stats_join_is_not_a_window_over_raw_rows(spark):
    """Day-range windows run over per-(player, day) aggregates, never over raw rows."""
    from pyspark.sql import functions as F
    from vigor.operators import relational as R
    from vigor.sources.catalog import load
    ev = load(spark, SF_SMALL, "events", ["user_id", "ts", "value"]).withColumn("day", F.unix_date(F.to_date("ts")))
    df = R.rolling_day_stats(ev, "user_id", "day", [("avg", "value", "a{n}")], (7,))
    text = _plan(df)
    window_at = text.index("Window [")
    assert "HashAggregate(keys=[user_id" in text[window_at:]
    assert "SinglePartition" not in _plan(df)


def test_keep_one_is_limited_before_the_shuffle(spark):
    from vigor.operators import relational as R
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS v", "cast(id AS string) AS s")
    text = _plan(R.dedup_keep_one(df, ["k"]))
    assert "SortAggregate" not in text and text.count("WindowGroupLimit") == 2
    below = text[text.index("Exchange"):]
    assert "Partial" in below and "WindowGroupLimit" in below


def test_sessions_are_not_shuffled_by_age_and_position(spark, no_broadcast):
    """Segments are few: their means go to the rows, whatever the size of the tables."""
    from vigor.plans import pipelines as P
    c = Ctx(spark, SF_SMALL)
    raw, players = c.sessions, c.dim_players
    with no_broadcast():
        lines = _plan(P.stg_training_sessions(raw, players)).splitlines()
    assert not [x for x in lines if "Exchange hashpartitioning(coalesce(__age" in x]
    assert any("BroadcastHashJoin [coalesce(__age" in x for x in lines)
