"""Hot keys (a third of all rows on one key), shuffle joins, table versions, ingest narrowing."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from vigor.operators import ml as M
from vigor.operators import quality as Q
from vigor.operators import relational as R
from vigor.sources import ingest as I


def _hot(spark, n=3000):
    # key 0 holds a third of the rows; values repeat so that ties occur
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        (F.col("id") % 17).cast("string").alias("s"),
        (F.col("id") % 5).cast("double").alias("x"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 90).cast("int")).alias("d"))


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _first_by_window(df, keys, order):
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def test_dedup_agrees_with_row_number_on_hot_key(spark):
    df = _hot(spark).repartition(6)
    got = R.dedup_keep_one(df, ["k"])
    rest = [F.col(c).asc_nulls_first() for c in df.columns if c != "k"]
    assert _rows(got) == _rows(_first_by_window(df, ["k"], rest))
    hot = [r for r in got.collect() if r.k == 0]
    assert len(hot) == 1 and (hot[0].s, hot[0].x) == ("0", 0.0)


def test_dedup_starts_no_job_and_caches_nothing(spark):
    plan = R.dedup_keep_one(_hot(spark), ["k"])._jdf.queryExecution().toString()
    assert "InMemoryRelation" not in plan


def test_rolling_stats_hot_entity_both_join_paths(spark, no_broadcast):
    df = _hot(spark).withColumn("day", F.unix_date("d"))
    specs = [("avg", "x", "a{n}"), ("max", "x", "m{n}"), ("sum", "x", "s{n}")]
    a = R.rolling_day_stats(df, "k", "day", specs, (7, 28))
    hinted = _rows(a)
    with no_broadcast():
        assert _rows(R.rolling_day_stats(df, "k", "day", specs, (7, 28))) == hinted and len(hinted) == 3000


def test_impute_shuffle_join_is_null_safe(spark, no_broadcast):
    rows = [(1, None, 10.0), (2, None, None), (3, 20, 4.0), (4, 20, None)]
    df = spark.createDataFrame(rows, "id long, age long, h double")
    with no_broadcast():
        got = dict((r.id, r.h2) for r in R.impute_group_mean(df, ["age"], {"h2": "h"}).collect())
    assert got == {1: 10.0, 2: 10.0, 3: 4.0, 4: 4.0}


def test_sheet_narrowing_types(spark):
    rows = [("1", "1.5", "a", "", "12"), ("2", "2", "3", " ", "x"), (" 3 ", None, None, None, None)]
    df = spark.createDataFrame(rows, "ints string, decs string, mixed string, blank string, junk string")
    dec = {r.column_name: r.decided_type for r in I.narrowing_decisions(df).collect()}
    assert dec == {"ints": "bigint", "decs": "double", "mixed": "string", "blank": "bigint", "junk": "string"}
    out = I.narrow_types(df)
    assert dict(out.dtypes) == {"ints": "bigint", "decs": "double", "mixed": "string", "blank": "bigint", "junk": "string"}
    assert [r.ints for r in out.collect()] == [1, 2, 3]


def test_csv_scan_infer_and_schema(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 2.5), (2, None, 3.0)], "id long, s string, x double")
    p = str(tmp_path / "csv")
    df.write.option("header", True).csv(p)
    inferred = I.read_csv(spark, p, infer=True)
    assert dict(inferred.dtypes) == {"id": "int", "s": "string", "x": "double"}
    typed = I.read_csv(spark, p, schema=df.schema)
    assert _rows(typed) == _rows(df)


def test_incremental_ingest_anti_join(spark):
    incoming = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, v string")
    loaded = spark.createDataFrame([(1, "a"), (3, "old")], "k long, v string")
    assert _rows(I.new_rows(incoming, loaded, ["k"])) == [(2, "b")]


def test_latest_per_group_agrees_with_row_number_on_hot_key(spark):
    df = _hot(spark).repartition(5)
    got = R.latest_per_group(df, ["k"], ["d", "s"])
    rest = [c for c in df.columns if c not in ("k", "d", "s")]
    assert _rows(got) == _rows(_first_by_window(df, ["k"], [F.col(c).desc_nulls_last() for c in ["d", "s", *rest]]))
    hot = [r for r in got.collect() if r.k == 0][0]
    assert hot.d == max(r.d for r in df.filter("k = 0").collect())


def test_narrow_types_takes_every_number_text(spark):
    df = spark.createDataFrame([("1.0", "1e2", "NaN", "x", "1.5"), ("2.0", " 3 ", "4", "NaN", ""), ("", None, None, "2", "2")],
                               "a string, b string, c string, d string, e string")
    out = I.narrow_types(df)
    assert [t for _, t in out.dtypes] == ["bigint", "bigint", "bigint", "string", "double"]
    assert [tuple(r) for r in out.collect()] == [(1, 100, None, "x", 1.5), (2, 3, 4, None, None), (None, None, None, "2", 2.0)]


def test_modes_keep_one_row_for_a_null_key(spark):
    df = spark.createDataFrame([(None, "a", 1), (None, "a", 2), ("k", "b", None)], "g string, x string, y long")
    got = sorted((r.g or "", r.x, r.y) for r in R.modes_per_group(df, ["g"], ["x", "y"]).collect())
    assert got == [("", "a", 1), ("k", "b", None)]


def test_unique_leaves_null_keys_to_not_null(spark):
    df = spark.createDataFrame([(None,), (None,), (3,)], "k long")
    assert Q.unique_violations(df, "t", ["k"]).first().failing_rows == 0


def test_enforce_names_every_broken_rule(spark):
    df = spark.createDataFrame([(1,)], "k long")
    rules = [Q.check(f"never_{i}", "k > 1") for i in range(30)]
    with pytest.raises(ValueError) as e:
        Q.stop_if_broken([tuple(r) for r in Q.rule_violations(df, "t", rules).collect()])
    assert all(f"t.never_{i}=1" in str(e.value) for i in range(30))


def test_more_groups_than_labels_fail(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(4)], "c long, x double")
    with pytest.raises(Exception, match="more groups than the 3 labels"):
        M.name_clusters(df, "c", "x").collect()


def test_every_order_has_a_box_score(spark):
    from conftest import SF_SMALL

    from vigor.sources import adapter, catalog
    assert adapter.raw_table(spark, SF_SMALL, "team_boxscores").count() == catalog.load(spark, SF_SMALL, "orders").count()
    sessions = adapter.raw_table(spark, SF_SMALL, "team_training_sessions")
    assert sessions.count() == catalog.load(spark, SF_SMALL, "lineitem").count() == sessions.select("SESSION_ID").distinct().count()


@pytest.mark.parametrize("make", [
    lambda df: R.dedup_keep_one(df, ["k"]),
    lambda df: R.impute_group_mean(df, ["k"], {"x2": "x"}),
    lambda df: R.with_global_max(df, "x", "m"),
    lambda df: R.rolling_day_stats(df.withColumn("day", F.unix_date("d")), "k", "day", [("avg", "x", "a{n}")], (7,)),
])
def test_operators_start_no_job_and_cache_nothing(spark, make):
    df = _hot(spark)
    group = f"lazy-{id(make)}"
    spark.sparkContext.setJobGroup(group, "plan only")
    plan = make(df)._jdf.queryExecution().optimizedPlan().toString()
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert "InMemoryRelation" not in plan and not jobs


def test_changed_input_is_a_new_run(spark, tmp_path):
    from vigor.plans.registry import Ctx
    path = tmp_path / "orders.parquet"
    spark.range(3).write.parquet(str(path))
    before = Ctx(spark, str(tmp_path)).run_key
    assert Ctx(spark, str(tmp_path)).run_key == before
    spark.range(4).write.mode("append").parquet(str(path))
    assert Ctx(spark, str(tmp_path)).run_key != before


def test_two_writers_of_one_version(spark, tmp_path):
    from vigor.operators import sinks as S
    path = str(tmp_path / "t")
    df = spark.range(3)
    S.write_table(df, path)
    version = S.next_version(spark, path)
    S.write_table(df.limit(1), path, version=version)
    with pytest.raises(S.VersionTakenError):
        S.write_table(df, path, version=version)
    assert S.read_table(spark, path).count() == 1
    failing = df.select(F.raise_error(F.lit("broken")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        S.write_table(failing, path)
    assert S.read_table(spark, path).count() == 1         # a failed write leaves the table as it was
    S.upsert_table(df, path, ["id"])
    assert S.read_table(spark, path).count() == 3
