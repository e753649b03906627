"""Scalar functions on hand-written edge rows (semantic traps T3, T4, T8-T16, T32)."""

import datetime as dt

from pyspark.sql import functions as F

from vigor.functions import exprs as X


def one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr.alias("v")).collect()]


def test_minutes_decimal_formats(spark):
    got = one(spark, X.minutes_decimal("m"), [("34:12",), ("34:12:00",), ("34",), ("",), ("abc",), (None,), ("0:30",)],
              "m string")
    assert got == [34.2, 34.2, 34.0, None, None, None, 0.5]


def test_month_name_dates_french_english_serial(spark):
    rows = [("janv. 5, 2022",), ("févr. 28, 2024",), ("mars 1, 2024",), ("avr. 9, 2021",), ("mai 3, 2023",),
            ("juin 30, 2022",), ("juil. 4, 2021",), ("août 15, 2020",), ("sept. 2, 2022",), ("oct. 5, 2021",),
            ("nov. 11, 2023",), ("déc. 25, 2020",), ("Jan 05, 2022",), ("Oct 5, 2021",), ("44474",), ("junk",), (None,)]
    got = one(spark, X.parse_game_date("d"), rows, "d string")
    assert got[:12] == [dt.date(2022, 1, 5), dt.date(2024, 2, 28), dt.date(2024, 3, 1), dt.date(2021, 4, 9),
                        dt.date(2023, 5, 3), dt.date(2022, 6, 30), dt.date(2021, 7, 4), dt.date(2020, 8, 15),
                        dt.date(2022, 9, 2), dt.date(2021, 10, 5), dt.date(2023, 11, 11), dt.date(2020, 12, 25)]
    assert got[12:] == [dt.date(2022, 1, 5), dt.date(2021, 10, 5), dt.date(2021, 10, 5), None, None]


def test_season_bucket_open_ends_and_null(spark):
    rows = [(dt.date(2020, 7, 31),), (dt.date(2020, 8, 1),), (dt.date(2023, 8, 1),), (dt.date(1999, 1, 1),), (None,)]
    got = one(spark, X.season_bucket("d"), rows, "d date")
    assert got == ["2019-2020", "2020-2021", "2023-2024", "2019-2020", "2023-2024"]


def test_least_is_null_strict(spark):
    got = one(spark, X.least_strict(F.lit(1.0), F.col("x")), [(None,), (0.5,), (3.0,)], "x double")
    assert got == [None, 0.5, 1.0]


def test_recovery_score_zero_divisor_is_null(spark):
    got = one(spark, X.recovery_score("d", "r"), [(1, 0.0), (0, 24.0), (2, 31.5)], "d long, r double").__iter__()
    assert list(got) == [None, 0.0, 1.52]


def test_recovery_needed_rounds_half_away(spark):
    # 31.5 h needed, 24 h available -> 7.5 -> 8 (BigQuery rounding cast), never negative
    got = one(spark, X.recovery_needed_hours("r", "d"), [(31.5, 1), (10.0, 1), (None, 1)], "r double, d long")
    assert got == [8, 0, 0]


def test_fatigue_band_uses_unrounded_score(spark):
    got = one(spark, X.fatigue_band("s"), [(30.004,), (30.0,), (50.0,), (65.01,), (80.0,), (80.01,), (None,)], "s double")
    assert got == ["Fatigue légère", "Fraîcheur optimale", "Fatigue légère", "Fatigue élevée / Risque",
                   "Fatigue élevée / Risque", "Danger blessure / baisse performance", "Danger blessure / baisse performance"]


def test_ordinal_level(spark):
    got = one(spark, X.ordinal_level_norm("l"), [("Low",), ("Medium",), ("High",), (None,), ("x",)], "l string")
    assert got == [1 / 3, 2 / 3, 1.0, 1.0, 1.0]


def test_performance_score_null_propagates(spark):
    df = spark.createDataFrame([(10, 5, 3, 1, 1, 2, 3), (10, None, 3, 1, 1, 2, 3)], "p long, r long, a long, s long, b long, t long, f long")
    got = [r[0] for r in df.select(X.performance_score("p", "r", "a", "s", "b", "t", "f")).collect()]
    assert got == [15, None]


def test_per_minute_zero_minutes(spark):
    got = one(spark, X.per_minute("s", "m"), [(15, 0.0), (15, 30.0), (10, 3.0)], "s long, m double")
    assert got == [None, 0.5, 3.33]


def test_round_half_up_on_ties(spark):
    got = one(spark, X.round_half_up("x", 2), [(2.675,), (0.125,), (1.005,), (-2.675,)], "x double")
    assert got == [2.68, 0.13, 1.01, -2.68]


def test_residual_capped_at_100(spark):
    got = one(spark, X.residual_before_match("fi", "n", "d"), [(90.0, 100, 1), (50.0, 12, 1), (50.0, 0, 0)],
              "fi double, n long, d long")
    assert got == [100.0, 25.0, None]


def test_reduction_bands_and_alert(spark):
    df = spark.createDataFrame([(0.19,), (0.2,), (0.5,), (0.69,), (0.7,), (None,)], "p double")
    got = [tuple(r) for r in df.select(X.intensity_reduction("p"), X.alert_flag("p")).collect()]
    assert got == [(0, 0), (15, 1), (50, 1), (50, 1), (80, 1), (0, None)]


def test_opponent_literal_split(spark):
    df = spark.createDataFrame([("HOM vs. LAL",), ("HOM @ BOS",), ("HOM - X",)], "m string")
    got = [tuple(r) for r in df.select(X.opponent("m"), X.home_away("m")).collect()]
    assert got == [("LAL", "Domicile"), ("BOS", "Exterieur"), (None, None)]


def test_blank_handling(spark):
    df = spark.createDataFrame([("",), (" ",), (None,), ("DNP",), (" F ",)], "c string")
    got = [tuple(r) for r in df.select(X.is_blank("c"), X.blank_to_default("c", "Bench")).collect()]
    assert got == [(True, "Bench"), (True, "Bench"), (True, "Bench"), (False, "DNP"), (False, "F")]
