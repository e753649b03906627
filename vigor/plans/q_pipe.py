"""Registered queries: quality rules, tags, end-to-end pipelines."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators import relational as R
from ..operators import sinks as S
from . import pipelines as P
from .oracle import pipeline_sql, stage_ctes
from .q_core import _SNAP_SQL, merged, players_history
from .registry import q

_MARTS = ["mart_player", "mart_physical_condition", "mart_game"]


def _marts(c):
    return {"mart_player": c.mart_player, "mart_physical_condition": c.mart_pc, "mart_game": c.mart_game}


def _rule_sql(table: str, rules) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{table}' AS table_name, '{r.name}' AS rule, COUNT(*) - COUNT(CASE WHEN {r.passes.replace('`', '')} THEN 1 END) AS failing_rows FROM {table}"
        for r in rules)


def _not_null_rules():
    return {t: [Q.not_null(c_) for c_ in Q.MODEL_TESTS[t]["not_null"]] for t in _MARTS}


@q("dq_1_not_null_tests", stage_ctes(*_MARTS) + "\nUNION ALL\n".join(_rule_sql(t, r) for t, r in _not_null_rules().items()))
def _(c):
    m = _marts(c)
    return reduce(lambda a, b: a.unionByName(b), [Q.rule_violations(m[t], t, r) for t, r in _not_null_rules().items()])


_UNIQUE = {"mart_game": ["game_id"], "mart_physical_condition": ["session_id"], "int_fatigue_index": ["session_id"],
           "stg_training_sessions": ["session_id"]}


@q("dq_2_unique_tests", stage_ctes(*_UNIQUE) + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, 'unique_{'_'.join(k)}' AS rule, COUNT(*) AS failing_rows FROM "
    f"(SELECT {', '.join(k)} FROM {t} GROUP BY {', '.join(k)} HAVING COUNT(*) > 1)" for t, k in _UNIQUE.items()))
def _(c):
    frames = {"mart_game": c.mart_game, "mart_physical_condition": c.mart_pc, "int_fatigue_index": c.fatigue,
              "stg_training_sessions": c.stg_sessions}
    return reduce(lambda a, b: a.unionByName(b), [Q.unique_violations(frames[t], t, k) for t, k in _UNIQUE.items()])


# Accepted categorical values.
_ACCEPTED = {"fatigue_level": ["Low", "Medium", "High"], "injury_risk_level": ["Low", "Medium", "High"]}


@q("dq_3_accepted_values", stage_ctes("stg_training_sessions") + _rule_sql(
    "stg_training_sessions", [Q.accepted_values(k, v) for k, v in _ACCEPTED.items()]))
def _(c):
    return Q.rule_violations(c.stg_sessions, "stg_training_sessions", [Q.accepted_values(k, v) for k, v in _ACCEPTED.items()])


@q("dq_4_check_rules", stage_ctes(*_MARTS) + "\nUNION ALL\n".join(_rule_sql(t, Q.MART_RULES[t]) for t in _MARTS))
def _(c):
    m = _marts(c)
    return reduce(lambda a, b: a.unionByName(b), [Q.rule_violations(m[t], t, Q.MART_RULES[t]) for t in _MARTS])


@q("gov_1_pii_tag_projection", stage_ctes("dim_players") + """
SELECT player_id, sha256(CAST(player_name AS VARCHAR)) AS player_name, first_name, last_name,
       sha256(CAST(birthdate AS VARCHAR)) AS birthdate, sha256(CAST(age AS VARCHAR)) AS age,
       height_cm, weight_kg, position, school, country, season_exp
FROM dim_players""")
def _(c):
    tagged = Q.with_tags(c.dim_players, Q.PII_TAGS)
    return Q.protect_pii(tagged, mode="hash", max_sensitivity="low")


@q("gov_1_ml_feature_selection", stage_ctes("mart_physical_condition") + """
SELECT session_id, fi_last_training, injury_risk, fi_avg_7d, training_load_7d, fi_avg_28d FROM mart_physical_condition""")
def _(c):
    tagged = Q.with_tags(c.mart_pc, Q.ML_TAGS)
    return Q.select_tagged(tagged, "ml_feature", keep=["session_id"])


# ------------------------------------------------------------------ pipelines


@q("pl_1_stg_players", pipeline_sql("stg_players"))
def _(c):
    return c.stg_players


@q("pl_2_stg_player_stats", pipeline_sql("stg_player_stats"))
def _(c):
    return c.stg_stats


@q("pl_3_stg_games", pipeline_sql("stg_games"))
def _(c):
    return c.stg_games


@q("pl_4_stg_training_sessions", pipeline_sql("stg_training_sessions"))
def _(c):
    return c.stg_sessions


@q("pl_5_dim_players", pipeline_sql("dim_players"))
def _(c):
    return c.dim_players


@q("pl_6_dim_calendar", pipeline_sql("dim_calendar"))
def _(c):
    return c.dim_calendar


@q("pl_7_int_fatigue_index", pipeline_sql("int_fatigue_index"))
def _(c):
    return c.fatigue


def _stale(df, measure, *keys):
    """An earlier state of a mart: a quarter of its rows missing, others with another ``measure``."""
    turn = F.pmod(F.xxhash64(*keys), F.lit(8))
    return df.filter(turn > 1).withColumn(measure, F.when(turn == 2, F.col(measure) + 1).otherwise(F.col(measure)))


@q("pl_8_mart_player", pipeline_sql("mart_player"))
def _(c):
    keys = ["game_id", "player_id"]
    return merged(c, "mart_player", _stale(c.mart_player, "points", *keys), c.mart_player, keys, ["season"])


@q("pl_9_mart_game", pipeline_sql("mart_game"))
def _(c):
    return merged(c, "mart_game", _stale(c.mart_game, "total_points", "game_id"), c.mart_game, ["game_id"], ["game_block"])


@q("pl_10_mart_physical_condition", pipeline_sql("mart_physical_condition"))
def _(c):
    return merged(c, "mart_physical_condition", _stale(c.mart_pc, "points", "session_id"), c.mart_pc, ["session_id"], ["season"])


@q("pl_11_players_snapshot", _SNAP_SQL)
def _(c):
    return players_history(c)


_AUDIT = ["stg_players", "stg_player_stats", "stg_games", "stg_training_sessions", "dim_players", "dim_calendar",
          "int_fatigue_index", "mart_player", "mart_game", "mart_physical_condition"]


@q("pl_15_row_count_audit", stage_ctes(*_AUDIT) + "\nUNION ALL\n".join(
    f"SELECT '{n}' AS table_name, COUNT(*) AS nb_lignes FROM {n}" for n in _AUDIT) + "\nORDER BY nb_lignes DESC")
def _(c):
    frames = {"stg_players": c.stg_players, "stg_player_stats": c.stg_stats, "stg_games": c.stg_games,
              "stg_training_sessions": c.stg_sessions, "dim_players": c.dim_players, "dim_calendar": c.dim_calendar,
              "int_fatigue_index": c.fatigue, "mart_player": c.mart_player, "mart_game": c.mart_game,
              "mart_physical_condition": c.mart_pc}
    return R.row_count_audit(frames)


def _quality_sql():
    parts = []
    for t in ["int_fatigue_index", "mart_game", "mart_player", "mart_physical_condition"]:
        rules = list(Q.MART_RULES.get(t, [])) + [Q.not_null(c_) for c_ in Q.MODEL_TESTS[t].get("not_null", [])]
        parts.append(_rule_sql(t, rules))
        k = Q.MODEL_TESTS[t].get("unique")
        if k:
            parts.append(f"SELECT '{t}' AS table_name, 'unique_{'_'.join(k)}' AS rule, COUNT(*) AS failing_rows FROM "
                         f"(SELECT {', '.join(k)} FROM {t} GROUP BY {', '.join(k)} HAVING COUNT(*) > 1)")
    return stage_ctes("int_fatigue_index", *_MARTS) + "\nUNION ALL\n".join(parts)


@q("pl_16_quality_gate", _quality_sql())
def _(c):
    """The rules of every model, checked by the job that writes it."""
    frames = {"int_fatigue_index": c.fatigue, "mart_game": c.mart_game, "mart_player": c.mart_player, "mart_physical_condition": c.mart_pc}
    rows = []
    for name, df in frames.items():
        rules, unique = Q.model_rules(name)
        rows += Q.gated_write(df, c.scratch(name), name, rules, unique, enforce=False)
    return c.spark.createDataFrame(rows, "table_name string, rule string, failing_rows long")   # a row a rule


@q("pl_16_gate_stops_bad_rows", stage_ctes("mart_game") + "SELECT * FROM mart_game WHERE " + " AND ".join(
    f"COALESCE({r.passes.replace('`', '')}, FALSE)" for r in Q.model_rules("mart_game")[0]))
def _(c):
    """The sound games are loaded; a load of all games is refused if any breaks a rule, and readers keep the sound ones."""
    path, (rules, unique) = c.scratch("gated_game"), Q.model_rules("mart_game")
    sound = reduce(lambda a, b: a & b, [F.coalesce(F.expr(r.passes), F.lit(False)) for r in rules])
    Q.gated_write(c.mart_game.filter(sound), path, "mart_game", rules, unique)
    try:
        Q.gated_write(c.mart_game, path, "mart_game", rules, unique)
    except Q.QualityError as e:
        if not e.violations:
            raise
    return S.read_table(c.spark, path)
