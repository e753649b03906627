"""Differential tests: registered Spark queries vs their DuckDB oracles at sf0.001."""

import math

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from vigor.plans.registry import all_oracles, all_queries

SUBSET = ["src_3_sheet_type_narrowing", "snk_6_scd2_snapshot", "prj_2_safe_cast", "jn_9_existence_join",
          "agg_12_describe", "agg_11_member_rows", "src_5_row_changes", "src_6_copy_raw_tables", "snk_4_upsert_single_key", "snk_7_load_timestamp",
          "pl_11_players_snapshot", "pl_16_quality_gate", "pl_16_gate_stops_bad_rows", "ml_1_label_encoding", "ml_12_elbow_invariants", "win_2_dedup_composite_key", "win_7_trailing_avg", "win_9_trailing_sum",
          "fn_3_first_successful_parser", "fn_4_clock_to_minutes", "pl_4_stg_training_sessions",
          "pl_7_int_fatigue_index", "pl_9_mart_game", "pl_10_mart_physical_condition", "dq_4_check_rules",
          "ml_10_classification_report", "ml_14_cluster_profile_tables", "pl_14_top_by_profile", "pl_14_player_stats", "gov_1_pii_tag_projection"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    if hasattr(v, "isoformat"):
        s = v.isoformat()
        return s[:10] if s.endswith("T00:00:00") else s.replace("T", " ")
    return str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple("" if x is None else x for x in t))


#: Scores of fitted models: they have invariants with SQL of their own (ml_*_invariants, pl_14_report_invariants).
FITTED = {"ml_6_boosted_trees", "ml_7_random_forest", "ml_8_positive_probability", "ml_11_kmeans_restarts", "ml_12_elbow_curve",
          "ml_15_injury_scoring_table", "ml_16_player_cluster_table", "pl_12_injury_prevention", "pl_12_model_thresholds",
          "pl_13_player_profiling", "pl_14_exploration_report", "pl_14_forest_thresholds"}


def test_every_query_has_an_oracle_or_is_a_fitted_model():
    assert set(all_queries()) - set(all_oracles()) == FITTED


@pytest.mark.parametrize("name", SUBSET)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    cur = duck.execute(E.oracle_sql()[name])
    drows, dcols = cur.fetchall(), [d[0] for d in cur.description]
    srows = df.collect()
    assert sorted(df.columns) == sorted(dcols)
    assert _canon(df.columns, srows) == _canon(dcols, drows)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "fi_avg_7d" in df.columns
