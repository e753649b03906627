"""Upsert and SCD2 properties, versioned tables, quality rules and tags."""

import pytest
from pyspark.sql import functions as F

from vigor.operators import quality as Q
from vigor.operators import sinks as S


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_semantics_and_idempotence(spark):
    target = spark.createDataFrame([(1, "old"), (2, "old"), (9, "gone-from-source")], "k long, v string")
    source = spark.createDataFrame([(1, "new"), (3, "new")], "k long, v string")
    once = S.upsert(target, source, ["k"])
    assert _rows(once) == [(1, "new"), (2, "old"), (3, "new"), (9, "gone-from-source")]
    assert _rows(S.upsert(once, source, ["k"])) == _rows(once)
    assert _rows(S.upsert(None, source, ["k"])) == _rows(source)          # first load creates the table


def test_upsert_rejects_duplicate_source_keys(spark):
    src = spark.createDataFrame([(1, "a"), (1, "b")], "k long, v string")
    with pytest.raises(S.DuplicateKeyError):
        S.upsert(None, src, ["k"])


def test_scd2_runs(spark):
    cols = ["pos", "h"]
    v1 = spark.createDataFrame([(1, "G", 180.0), (2, "F", 200.0), (3, None, 190.0), (4, "C", 210.0)], "k long, pos string, h double")
    h1 = S.scd2_snapshot(None, v1, "k", cols, "2024-01-01 00:00:00")
    # unchanged source: nothing new
    assert _rows(S.scd2_snapshot(h1, v1, "k", cols, "2024-01-02 00:00:00")) == _rows(h1)
    # changed (2), NULL -> value (3), vanished (4), new (5)
    v2 = spark.createDataFrame([(1, "G", 180.0), (2, "F", 201.0), (3, "G", 190.0), (5, "F", 199.0)], "k long, pos string, h double")
    h2 = S.scd2_snapshot(h1, v2, "k", cols, "2024-01-02 00:00:00").cache()
    open_rows = h2.filter(F.col("valid_to").isNull())
    assert open_rows.groupBy("k").count().filter("count > 1").count() == 0      # one open version per key
    assert sorted(r.k for r in open_rows.collect()) == [1, 2, 3, 4, 5]          # vanished key 4 stays open
    closed = h2.filter(F.col("valid_to").isNotNull()).collect()
    assert sorted(r.k for r in closed) == [2, 3]
    assert h2.count() == 7 and h2.select("scd_id").distinct().count() == 7


def test_versioned_table_roundtrip(spark, tmp_path):
    path = str(tmp_path / "t")
    assert S.read_table(spark, path) is None
    df = spark.createDataFrame([(1, "a")], "k long, v string")
    S.upsert_table(df, path, ["k"])
    S.upsert_table(spark.createDataFrame([(1, "b"), (2, "c")], "k long, v string"), path, ["k"])
    assert S.table_versions(spark, path) == [1, 2]
    assert _rows(S.read_table(spark, path)) == [(1, "b"), (2, "c")]
    assert S.create_if_absent(df, path) is None


def test_rule_violations_null_fails(spark):
    df = spark.createDataFrame([(1, 0.5), (2, 1.5), (None, None)], "id long, p double")
    rules = [Q.Rule("p_range", "p IS NOT NULL AND p BETWEEN 0 AND 1"), Q.not_null("id")]
    got = sorted(tuple(r) for r in Q.rule_violations(df, "t", rules).collect())
    assert got == [("t", "not_null_id", 1), ("t", "p_range", 2)]
    with pytest.raises(Q.QualityError) as e:
        Q.stop_if_broken(got)
    assert e.value.violations == got


def test_unique_violations(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (3,), (3,)], "k long")
    assert Q.unique_violations(df, "t", ["k"]).first().failing_rows == 2


def test_pii_projection_by_tags(spark):
    df = spark.createDataFrame([(1, "Ann", 180.0, "Guard")], "id long, name string, h double, pos string")
    tagged = Q.with_tags(df, {"name": {"pii": "true", "sensitivity": "medium"}, "h": {"pii": "true", "sensitivity": "low"}})
    assert Q.tagged_columns(tagged, "pii") == ["name", "h"]
    dropped = Q.protect_pii(tagged, mode="drop")
    assert dropped.columns == ["id", "pos"]
    hashed = Q.protect_pii(tagged, mode="hash", max_sensitivity="low").first()
    assert hashed.h == 180.0 and len(hashed.name) == 64


def test_stream_upsert_available_now(spark, tmp_path):
    from vigor.plans import pipelines as P
    from vigor.sources import adapter
    from vigor.streaming import run_available_now
    from conftest import SF_SMALL
    landing = str(tmp_path / "landing")
    games = adapter.raw_table(spark, SF_SMALL, "team_games_dataset")
    games.write.parquet(landing)
    stream = spark.readStream.schema(games.schema).parquet(landing)
    path = str(tmp_path / "games")
    run_available_now(stream, path, ["game_id"], str(tmp_path / "ckpt"),
                      transform=lambda b: P.dim_calendar(P.stg_games(b, adapter.raw_table(spark, SF_SMALL, "team_boxscores"))))
    got = S.read_table(spark, path)
    want = P.dim_calendar(P.stg_games(games, adapter.raw_table(spark, SF_SMALL, "team_boxscores")))
    assert _rows(got) == _rows(want)
