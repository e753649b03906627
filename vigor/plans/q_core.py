"""Registered queries: sources/sinks, projections, predicates, joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import joins as J
from ..operators import merge as G
from ..operators import relational as R
from ..operators import sinks as S
from ..sources import adapter
from ..sources import ingest as I
from . import pipelines as P
from .oracle import pipeline_sql, stage_ctes
from .registry import q, raw_sql

# ------------------------------------------------------------------ sources / sinks

# A CSV scan reads an empty field back as NULL.
_PLAYERS_RAW = raw_sql("SELECT * REPLACE (NULLIF(POSITION, '') AS POSITION) FROM team_players_personal_info",
                       "team_players_personal_info")


@q("src_1_csv_scan", _PLAYERS_RAW)
def _(c):
    """Write the raw player table as CSV with a header, scan it back with its schema."""
    path = c.scratch("csv_players")
    c.players.write.option("header", True).csv(path)
    return I.read_csv(c.spark, path, schema=c.players.schema)


_RAW_TABLES = tuple(adapter.RAW_TABLES)


def _raw_counts(value: str) -> str:
    return raw_sql("\nUNION ALL\n".join(f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows, {value} FROM {t}" for t in _RAW_TABLES))


@q("src_1_csv_inferred", _raw_counts("CAST(1 AS BIGINT) AS n_broken"))
def _(c):
    """All raw tables from CSV files, types inferred, a broken line kept aside, tables created where absent."""
    parts = []
    for name in _RAW_TABLES:
        raw, csv, table = c.raw(name), c.scratch(f"csv_{name}"), c.scratch(f"raw_{name}")
        raw.write.option("header", True).csv(csv)
        header = ",".join(raw.columns)
        c.spark.createDataFrame([(f"{header}\nbroken{',x' * len(raw.columns)}",)], "value string").coalesce(1).write.mode("append").text(csv)
        rows, broken = I.read_csv_inferred(c.spark, csv, c.scratch(f"lines_{name}"))
        S.create_if_absent(rows, table)
        S.create_if_absent(rows.limit(0), table)      # exists: nothing happens
        parts.append(S.read_table(c.spark, table).agg(F.count(F.lit(1)).alias("n_rows")).crossJoin(broken.agg(F.count(F.lit(1)).alias("n_broken")))
                     .select(F.lit(name).alias("table_name"), "n_rows", "n_broken"))
    return reduce(lambda a, b: a.unionByName(b), parts)


@q("src_2_registered_source", raw_sql("SELECT * FROM team_games_dataset", "team_games_dataset"))
def _(c):
    return c.games


@q("src_3_sheet_type_narrowing", raw_sql("""
SELECT column_name, n_values, n_numeric, n_fractional,
       CASE WHEN n_numeric < n_values THEN 'string' WHEN n_fractional = 0 THEN 'bigint' ELSE 'double' END AS decided_type
FROM (
""" + "\nUNION ALL\n".join(
    f"""SELECT '{col}' AS column_name, COUNT(NULLIF(trim({q_}), '')) AS n_values,
       COUNT(TRY_CAST(NULLIF(trim({q_}), '') AS DOUBLE)) AS n_numeric,
       COUNT(CASE WHEN TRY_CAST(NULLIF(trim({q_}), '') AS DOUBLE) <> round(TRY_CAST(NULLIF(trim({q_}), '') AS DOUBLE)) THEN 1 END) AS n_fractional
FROM team_players_stats""" for col, q_ in [(c_, f'"{c_}"') for c_ in I.STATS_TEXT_COLUMNS]) + ") t", "team_players_stats"))
def _(c):
    return I.narrowing_decisions(c.stats.select(*I.STATS_TEXT_COLUMNS))


@q("src_5_incremental_ingest", raw_sql("""
SELECT n.* FROM team_training_sessions n
WHERE NOT EXISTS (SELECT 1 FROM team_training_sessions e
                  WHERE e.SESSION_DATE < '2024-01-01' AND e.SESSION_ID = n.SESSION_ID)""", "team_training_sessions"))
def _(c):
    loaded = c.sessions.filter(F.col("SESSION_DATE") < "2024-01-01")
    return I.new_rows(c.sessions, loaded, ["SESSION_ID"])


_NARROWED = {"PTS": "bigint", "FG_PCT": "double", "FT_PCT": "double", "MIN": "string", "COMMENT": "string", "START_POSITION": "string"}
_SQL_TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}


@q("src_3_narrowed_rows", raw_sql("SELECT CAST(CAST(TRIM(GAME_ID) AS DOUBLE) AS BIGINT) AS GAME_ID, " + ", ".join(
    f"CAST({'CAST(' if t == 'bigint' else ''}CASE WHEN LOWER(TRIM(v.{c_})) NOT IN ('', 'nan') THEN TRIM(v.{c_}) END{' AS DOUBLE)' if t == 'bigint' else ''} AS {_SQL_TYPES[t]}) AS {c_}"
    for c_, t in _NARROWED.items()) + " FROM team_players_stats v", "team_players_stats"))
def _(c):
    return I.narrow_types(c.stats.select("GAME_ID", *_NARROWED))


@q("src_3_sheet_ingest", raw_sql("\nUNION ALL\n".join(f"SELECT '{t}' AS table_name, COUNT(*) AS nb_lignes FROM {t}" for t in _RAW_TABLES)))
def _(c):
    """Every raw table as a text sheet, and an empty one, which is skipped."""
    base = c.scratch("sheets")
    sheets = {t: c.raw(t).select(*[F.col(f"`{x}`").cast("string").alias(x) for x in c.raw(t).columns]) for t in _RAW_TABLES}
    loaded = I.ingest_sheets({**sheets, "empty_sheet": c.players.limit(0)}, base)
    return R.row_count_audit({t: S.read_table(c.spark, f"{base}/{t}") for t in loaded}, order_desc=False)


@q("src_5_row_changes", stage_ctes("stg_training_sessions") + """,
loaded AS (SELECT * REPLACE (CASE WHEN duration_min % 3 = 0 THEN NULL ELSE heart_rate END AS heart_rate) FROM stg_training_sessions
           WHERE session_date < DATE '2024-01-01'),
incoming AS (SELECT * FROM stg_training_sessions WHERE player_id % 10 <> 3)
SELECT COALESCE(i.session_id, l.session_id) AS session_id, i.heart_rate,
       CASE WHEN l.session_id IS NULL THEN 'inserted' WHEN i.session_id IS NULL THEN 'vanished'
            WHEN i.heart_rate IS NOT DISTINCT FROM l.heart_rate THEN 'equal' ELSE 'changed' END AS change
FROM incoming i FULL JOIN loaded l ON l.session_id = i.session_id""")
def _(c):
    """Incoming sessions against those loaded before: new ones, ones with another heart rate, equal ones, and ones of players gone."""
    s = c.stg_sessions
    loaded = s.filter(F.col("session_date") < "2024-01-01").withColumn("heart_rate", F.when(F.col("duration_min") % 3 == 0, None).otherwise(F.col("heart_rate")))
    return I.row_changes(s.filter(F.col("player_id") % 10 != 3), loaded, ["session_id"]).select("session_id", "heart_rate", "change")


@q("src_6_copy_upper_case", stage_ctes("dim_calendar") + """
SELECT game_id AS GAME_ID, game_date AS GAME_DATE, season AS SEASON, annee AS ANNEE, mois AS MOIS, jour AS JOUR,
       place AS PLACE, opponent AS OPPONENT FROM dim_calendar""")
def _(c):
    path = c.scratch("copy_calendar")
    S.write_table(S.copy_upper(c.dim_calendar), path)
    return S.read_table(c.spark, path)


@q("src_6_copy_raw_tables", _raw_counts("CAST(0 AS BIGINT) AS n_lower"))
def _(c):
    """All raw tables copied with upper-cased names, overwriting an earlier copy."""
    parts = []
    for name in _RAW_TABLES:
        path = c.scratch(f"copy_{name}")
        S.write_table(S.copy_upper(c.raw(name).limit(0)), path)
        S.write_table(S.copy_upper(c.raw(name)), path)
        copy = S.read_table(c.spark, path)
        parts.append(copy.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(sum(x != x.upper() for x in copy.columns)).cast("long").alias("n_lower")))
    return reduce(lambda a, b: a.unionByName(b), parts)


@q("src_7_read_mart", stage_ctes("mart_game") + "SELECT * FROM mart_game")
def _(c):
    path = c.scratch("mart_game")
    S.write_table(c.mart_game, path)
    return S.read_table(c.spark, path)


@q("snk_1_full_refresh_table", stage_ctes("dim_players") + "SELECT * FROM dim_players")
def _(c):
    path = c.scratch("dim_players")
    S.write_table(c.dim_players.limit(0), path)          # an older, empty version
    S.write_table(c.dim_players, path)                    # full refresh replaces it
    return S.read_table(c.spark, path)


@q("snk_2_overwrite_new_schema", stage_ctes("dim_calendar") + "SELECT game_id, season, place FROM dim_calendar")
def _(c):
    path = c.scratch("calendar_schema")
    S.write_table(c.dim_calendar, path)
    S.write_table(c.dim_calendar.select("game_id", "season", "place"), path)  # schema replaced
    return S.read_table(c.spark, path)


@q("snk_3_view", stage_ctes("stg_games") + "SELECT * FROM stg_games")
def _(c):
    S.register_view(c.stg_games, "stg_games_view")
    return c.spark.table("stg_games_view")


_UPSERT_GAME_SQL = stage_ctes("mart_game") + """,
o_target AS (
  SELECT * REPLACE (total_points + 1000 AS total_points) FROM mart_game WHERE game_id % 3 <> 0
  UNION ALL
  SELECT * REPLACE (-game_id AS game_id) FROM mart_game WHERE game_id % 7 = 0
)
SELECT * FROM o_target t WHERE NOT EXISTS (SELECT 1 FROM mart_game s WHERE s.game_id = t.game_id)
UNION ALL SELECT * FROM mart_game"""


#: Game ids of a partition of the stored game mart, which has no season: some tens of MB of rows.
GAME_BLOCK = 250_000


def merged(c, name, stale, now, keys, partition_by):
    """``now`` merged into a stored table of ``stale``, as the table reads afterwards (without its load times)."""
    path = c.scratch(name)
    with_block = lambda df: df.withColumn("game_block", F.expr(f"game_id div {GAME_BLOCK}")) if "game_block" in partition_by else df
    stale, now = with_block(stale), with_block(now)
    G.merge_table(stale, path, keys, partition_by, stamp="updated_at")
    G.merge_table(now, path, keys, partition_by, stamp="updated_at")
    return G.stored_table(c.spark, path, now.schema).drop("game_block")


def stale_games(mg):
    """Earlier state of the game mart: stale values, a missing third, keys gone since."""
    old = mg.filter(F.col("game_id") % 3 != 0).withColumn("total_points", F.col("total_points") + 1000)
    gone = mg.filter(F.col("game_id") % 7 == 0).withColumn("game_id", -F.col("game_id"))
    return old.unionByName(gone)


@q("snk_4_upsert_single_key", _UPSERT_GAME_SQL)
def _(c):
    return merged(c, "mart_game", stale_games(c.mart_game), c.mart_game, ["game_id"], ["game_block"])


_UPSERT_PLAYER_SQL = stage_ctes("mart_player") + """,
o_target AS (
  SELECT * REPLACE (points + 100 AS points) FROM mart_player WHERE (game_id + player_id) % 4 <> 0
)
SELECT * FROM o_target t WHERE NOT EXISTS (SELECT 1 FROM mart_player s WHERE s.game_id = t.game_id AND s.player_id = t.player_id)
UNION ALL SELECT * FROM mart_player"""


@q("snk_5_upsert_composite_key", _UPSERT_PLAYER_SQL)
def _(c):
    mp = c.mart_player
    target = mp.filter((F.col("game_id") + F.col("player_id")) % 4 != 0).withColumn("points", F.col("points") + 100)
    return merged(c, "mart_player", target, mp, ["game_id", "player_id"], ["season"])


def players_first_run(dim):
    """Dimension as seen by an earlier snapshot run: some players absent, some changed."""
    v1 = dim.filter(F.col("player_id") % 5 != 1)
    return v1.withColumn("weight_kg", F.when(F.col("player_id") % 4 == 0, F.col("weight_kg") + 2).otherwise(F.col("weight_kg"))) \
             .withColumn("position", F.when(F.col("player_id") % 6 == 0, F.lit(None)).otherwise(F.col("position")))


def players_history(c):
    """The dimension's history after two runs over a stored table."""
    path, cols = c.scratch("players_snapshot"), ["position", "height_cm", "weight_kg", "age"]
    G.merge_snapshot(players_first_run(c.dim_players), path, "player_id", cols, SNAP_T1)
    G.merge_snapshot(c.dim_players, path, "player_id", cols, SNAP_T2)
    return G.read_history(c.spark, path, c.dim_players)


SNAP_T1, SNAP_T2 = "2024-01-01 06:00:00", "2024-01-02 06:00:00"
_SNAP_COLS = "player_id, player_name, first_name, last_name, birthdate, age, height_cm, weight_kg, position, school, country, season_exp"
_SNAP_SQL = stage_ctes("dim_players") + f""",
o_v1 AS (
  SELECT * REPLACE (CASE WHEN player_id % 4 = 0 THEN weight_kg + 2 ELSE weight_kg END AS weight_kg,
                    CASE WHEN player_id % 6 = 0 THEN NULL ELSE position END AS position)
  FROM dim_players WHERE player_id % 5 <> 1
),
o_run1 AS (
  SELECT {_SNAP_COLS}, TIMESTAMP '{SNAP_T1}' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to,
         md5(concat_ws('|', CAST(player_id AS VARCHAR), '{SNAP_T1}')) AS scd_id FROM o_v1
),
o_changed AS (
  SELECT h.player_id FROM o_run1 h JOIN dim_players c ON c.player_id = h.player_id
  WHERE NOT (h.position IS NOT DISTINCT FROM c.position AND h.height_cm IS NOT DISTINCT FROM c.height_cm
             AND h.weight_kg IS NOT DISTINCT FROM c.weight_kg AND h.age IS NOT DISTINCT FROM c.age)
)
SELECT {_SNAP_COLS}, valid_from,
       CASE WHEN player_id IN (SELECT player_id FROM o_changed) THEN TIMESTAMP '{SNAP_T2}' ELSE valid_to END AS valid_to, scd_id
FROM o_run1
UNION ALL
SELECT {_SNAP_COLS}, TIMESTAMP '{SNAP_T2}', CAST(NULL AS TIMESTAMP),
       md5(concat_ws('|', CAST(player_id AS VARCHAR), '{SNAP_T2}'))
FROM dim_players c
WHERE c.player_id IN (SELECT player_id FROM o_changed) OR c.player_id NOT IN (SELECT player_id FROM o_run1)"""


@q("snk_6_scd2_snapshot", _SNAP_SQL)
def _(c):
    return players_history(c)


_STORED = {"int_fatigue_index": ["session_id"], "mart_player": ["game_id", "player_id"], "mart_game": ["game_id"], "mart_physical_condition": ["session_id"]}


@q("snk_7_load_timestamp", stage_ctes(*_STORED) + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows, COUNT(*) AS n_loaded FROM {t}" for t in _STORED))
def _(c):
    """Rows and load times of the four stored models (the times differ from run to run)."""
    frames = {"int_fatigue_index": c.fatigue, "mart_player": c.mart_player, "mart_game": c.mart_game, "mart_physical_condition": c.mart_pc}
    parts = []
    for name, df in frames.items():
        path = c.scratch(name)
        df = df.withColumn("load_block", F.pmod(F.xxhash64(*_STORED[name]), F.lit(4)))
        G.merge_table(df, path, _STORED[name], ["load_block"], stamp="updated_at")
        stored = S.with_load_timestamp(df.limit(0))
        parts.append(G.stored_table(c.spark, path, stored.schema).agg(F.count(F.lit(1)).alias("n_rows"), F.count("updated_at").alias("n_loaded"))
                     .select(F.lit(name).alias("table_name"), "n_rows", "n_loaded"))
    return reduce(lambda a, b: a.unionByName(b), parts)


# ------------------------------------------------------------------ projections

@q("prj_1_rename_projection", raw_sql("""
SELECT GAME_ID AS game_id, MATCHUP AS matchup, WL AS win_loss, W AS win, L AS loss, W_PCT AS win_pct,
       MIN AS total_minutes, FGM AS total_field_goal_made, FGA AS total_field_goal_attempt, REB AS total_rebounds,
       AST AS total_assists, TOV AS total_turnover, PF AS total_player_fault
FROM team_games_dataset""", "team_games_dataset"))
def _(c):
    m = {"GAME_ID": "game_id", "MATCHUP": "matchup", "WL": "win_loss", "W": "win", "L": "loss", "W_PCT": "win_pct",
         "MIN": "total_minutes", "FGM": "total_field_goal_made", "FGA": "total_field_goal_attempt",
         "REB": "total_rebounds", "AST": "total_assists", "TOV": "total_turnover", "PF": "total_player_fault"}
    return c.games.select(*[F.col(k).alias(v) for k, v in m.items()])


@q("prj_2_safe_cast", raw_sql("""
SELECT TRY_CAST(GAME_ID AS BIGINT) AS game_id, TRY_CAST(PLAYER_ID AS BIGINT) AS player_id,
       TRY_CAST(PTS AS BIGINT) AS points, TRY_CAST(AST AS BIGINT) AS assists, TRY_CAST(MIN AS DOUBLE) AS min_number,
       TRY_CAST(FG_PCT AS DOUBLE) AS fg_pct, TRY_CAST(PLUS_MINUS AS DOUBLE) AS plus_minus
FROM team_players_stats""", "team_players_stats"))
def _(c):
    s = c.stats
    return s.select(X.safe_cast("GAME_ID", "bigint").alias("game_id"), X.safe_cast("PLAYER_ID", "bigint").alias("player_id"),
                    X.safe_cast("PTS", "bigint").alias("points"), X.safe_cast("AST", "bigint").alias("assists"),
                    X.safe_cast("MIN", "double").alias("min_number"), X.safe_cast("FG_PCT", "double").alias("fg_pct"),
                    X.safe_cast("PLUS_MINUS", "double").alias("plus_minus"))


@q("prj_3_strict_cast", raw_sql("""
SELECT CAST(GAME_ID AS BIGINT) AS game_id, CAST(FGM AS BIGINT) AS fgm, CAST(FT_PCT AS DOUBLE) AS ft_pct
FROM team_players_stats""", "team_players_stats"))
def _(c):
    return c.stats.select(X.strict_cast("GAME_ID", "bigint").alias("game_id"), X.strict_cast("FGM", "bigint").alias("fgm"),
                          X.strict_cast("FT_PCT", "double").alias("ft_pct"))


@q("prj_4_timestamp_text_to_date", raw_sql("""
SELECT SESSION_ID AS session_id, CAST(TRY_CAST(SESSION_DATE AS TIMESTAMP) AS DATE) AS session_date
FROM team_training_sessions""", "team_training_sessions"))
def _(c):
    return c.sessions.select(F.col("SESSION_ID").alias("session_id"), X.timestamp_text_to_date("SESSION_DATE").alias("session_date"))


@q("prj_5_blank_to_default", raw_sql("""
SELECT START_POSITION AS raw_value,
       CASE WHEN trim(START_POSITION) = '' OR START_POSITION IS NULL THEN 'Bench' ELSE trim(START_POSITION) END AS start_position
FROM team_players_stats""", "team_players_stats"))
def _(c):
    return c.stats.select(F.col("START_POSITION").alias("raw_value"), X.blank_to_default("START_POSITION", "Bench").alias("start_position"))


@q("prj_6_null_default", raw_sql("""
SELECT SESSION_ID AS session_id, COALESCE(FATIGUE_LEVEL, 'Low') AS fatigue_level,
       COALESCE(TRY_CAST(INJURY_RISK AS BIGINT), 0) AS injury_risk, COALESCE(INJURY_RISK_LEVEL, 'Low') AS injury_risk_level
FROM team_training_sessions""", "team_training_sessions"))
def _(c):
    s = c.sessions
    return s.select(F.col("SESSION_ID").alias("session_id"), F.coalesce("FATIGUE_LEVEL", F.lit("Low")).alias("fatigue_level"),
                    F.coalesce(X.safe_cast("INJURY_RISK", "bigint"), F.lit(0).cast("bigint")).alias("injury_risk"),
                    F.coalesce("INJURY_RISK_LEVEL", F.lit("Low")).alias("injury_risk_level"))


@q("prj_7_blank_to_null", raw_sql("""
SELECT PLAYER_ID AS player_id, NULLIF(POSITION, '') AS position FROM team_players_personal_info""",
                                  "team_players_personal_info"))
def _(c):
    return c.players.select(F.col("PLAYER_ID").alias("player_id"), X.blank_to_null("POSITION").alias("position"))


@q("prj_8_rule_based_imputation", stage_ctes("stg_players") + """
SELECT p.player_id, p.height_cm, p.position FROM stg_players p""")
def _(c):
    return c.stg_players.select("player_id", "height_cm", "position")


_FEATURE_COLS = ["session_id", "fi_before_match", "fi_avg_7d", "fi_max_7d", "training_load_7d", "fi_avg_28d",
                 "training_load_28d", "focus_level", "minutes_played", "position", "injury_risk"]


@q("prj_9_feature_subset", stage_ctes("mart_physical_condition") +
   f"SELECT {', '.join(_FEATURE_COLS)} FROM mart_physical_condition")
def _(c):
    return c.mart_pc.select(*_FEATURE_COLS)


@q("prj_10_output_types", stage_ctes("mart_player") + """
SELECT CAST(player_id AS VARCHAR) AS player_id, game_id, CAST(performance_score_match AS INTEGER) AS profil,
       CAST(ROUND(CAST(minutes_played / 48.0 AS DECIMAL(20,8)), 4) AS DOUBLE) AS share_of_game
FROM mart_player""")
def _(c):
    mp = c.mart_player
    return mp.select(F.col("player_id").cast("string").alias("player_id"), "game_id",
                     F.col("performance_score_match").cast("int").alias("profil"),
                     X.round_half_up(F.col("minutes_played") / F.lit(48.0), 4).alias("share_of_game"))


# ------------------------------------------------------------------ predicates

@q("flt_1_not_null_filters", raw_sql("""
SELECT * FROM team_training_sessions
WHERE PLAYER_ID IS NOT NULL AND SESSION_ID IS NOT NULL AND DAYS_BEFORE_MATCH IS NOT NULL
  AND RECOVERY_TIME_HOURS IS NOT NULL AND DURATION_MIN IS NOT NULL""", "team_training_sessions"))
def _(c):
    return c.sessions.dropna(subset=["PLAYER_ID", "SESSION_ID", "DAYS_BEFORE_MATCH", "RECOVERY_TIME_HOURS", "DURATION_MIN"])


@q("flt_2_drop_not_selected", raw_sql("""
SELECT * FROM team_players_stats WHERE COALESCE(trim(COMMENT), '') = ''""", "team_players_stats"))
def _(c):
    return c.stats.filter(X.is_blank("COMMENT"))


@q("flt_3_minimum_minutes", stage_ctes("stg_player_stats") + "SELECT * FROM stg_player_stats WHERE minutes_played >= 5")
def _(c):
    return c.stg_stats.filter(F.col("minutes_played") >= 5)


@q("flt_4_season_equality", stage_ctes("mart_physical_condition") +
   "SELECT * FROM mart_physical_condition WHERE season = '2023-2024'")
def _(c):
    return c.mart_pc.filter(F.col("season") == "2023-2024")


_DROPNA = ["fi_before_match", "fi_avg_7d", "fi_max_7d", "training_load_7d", "fi_avg_28d", "training_load_28d",
           "focus_level", "minutes_played", "position", "injury_risk"]


@q("flt_5_drop_incomplete_rows", stage_ctes("mart_physical_condition") +
   "SELECT * FROM mart_physical_condition WHERE " + " AND ".join(f"{c_} IS NOT NULL" for c_ in _DROPNA))
def _(c):
    return c.mart_pc.na.drop(subset=_DROPNA)


@q("flt_6_fill_zero", stage_ctes("mart_physical_condition") + """
SELECT session_id, COALESCE(focus_level, 0) AS focus_level, COALESCE(fi_avg_7d, 0) AS fi_avg_7d,
       COALESCE(plus_minus, 0) AS plus_minus FROM mart_physical_condition""")
def _(c):
    return c.mart_pc.select("session_id", "focus_level", "fi_avg_7d", "plus_minus").na.fill(0.0)


@q("flt_7_set_membership", stage_ctes("stg_training_sessions") +
   "SELECT * FROM stg_training_sessions WHERE fatigue_level IN ('Low', 'Medium')")
def _(c):
    return c.stg_sessions.filter(F.col("fatigue_level").isin("Low", "Medium"))


@q("flt_8_numeric_threshold", stage_ctes("mart_player") + "SELECT * FROM mart_player WHERE minutes_played > 15")
def _(c):
    return c.mart_player.filter(F.col("minutes_played") > 15)


@q("flt_9_pattern_predicate", raw_sql("""
SELECT GAME_ID AS game_id, MATCHUP LIKE '%vs.%' AS is_home, MATCHUP LIKE '%@%' AS is_away
FROM team_games_dataset""", "team_games_dataset"))
def _(c):
    return c.games.select(F.col("GAME_ID").alias("game_id"), F.col("MATCHUP").contains("vs.").alias("is_home"),
                          F.col("MATCHUP").like("%@%").alias("is_away"))


# ------------------------------------------------------------------ joins

@q("jn_1_inner_equi_join", raw_sql("""
SELECT s.GAME_ID AS game_id, s.WL AS win_loss, d.PLUS_MINUS AS plus_minus
FROM team_games_dataset s JOIN team_boxscores d ON d.GAME_ID = s.GAME_ID""", "team_games_dataset", "team_boxscores"))
def _(c):
    d = c.boxscores.select(F.col("GAME_ID").alias("__g"), F.col("PLUS_MINUS").alias("plus_minus"))
    return c.games.join(d, F.col("GAME_ID") == F.col("__g")).select(F.col("GAME_ID").alias("game_id"),
                                                                     F.col("WL").alias("win_loss"), "plus_minus")


@q("jn_2_join_on_cast_keys", raw_sql("""
SELECT t.GAME_ID AS stat_game, t.PLAYER_ID AS player, g.WL AS win_loss
FROM team_players_stats t JOIN team_games_dataset g ON TRY_CAST(t.GAME_ID AS BIGINT) = TRY_CAST(g.GAME_ID AS BIGINT)""",
                                   "team_players_stats", "team_games_dataset"))
def _(c):
    s = c.stats.select(F.col("GAME_ID").alias("stat_game"), F.col("PLAYER_ID").alias("player"))
    g = c.games.select(F.col("GAME_ID").alias("gid"), F.col("WL").alias("win_loss"))
    return J.join_on_cast_keys(s, g, "stat_game", "gid").select("stat_game", "player", "win_loss")


_JN34 = """
SELECT d.SESSION_ID AS session_id, TRY_CAST(d.PLAYER_ID AS BIGINT) AS player_id, pi.age, pi.position
FROM team_training_sessions d LEFT JOIN dim_players pi ON pi.player_id = TRY_CAST(d.PLAYER_ID AS BIGINT)"""


def _sessions_players(c, how_filter: bool):
    pi = c.dim_players.select(F.col("player_id").alias("__pid"), "age", "position")
    d = c.sessions.select(F.col("SESSION_ID").alias("session_id"), X.safe_cast("PLAYER_ID", "bigint").alias("player_id"))
    j = d.join(pi, d["player_id"] == pi["__pid"], "left").drop("__pid")
    return j.filter(F.col("age").isNotNull()) if how_filter else j


@q("jn_3_left_join_then_filter", stage_ctes("dim_players") + ", x AS (" + _JN34 + ") SELECT * FROM x WHERE age IS NOT NULL")
def _(c):
    return _sessions_players(c, True)


@q("jn_4_left_outer_join", stage_ctes("dim_players") + _JN34)
def _(c):
    return _sessions_players(c, False)


@q("jn_5_using_join_one_key", stage_ctes("stg_player_stats", "dim_calendar") + """
SELECT line.game_id, line.player_id, match.season, match.place, line.points
FROM dim_calendar match, stg_player_stats line WHERE line.game_id = match.game_id""")
def _(c):
    return c.stg_stats.join(c.dim_calendar, "game_id").select("game_id", "player_id", "season", "place", "points")


@q("jn_6_using_join_composite_key", stage_ctes("int_fatigue_index") + """
SELECT player_id, session_id, f.fatigue_index_score, s.fi_before_match
FROM int_fatigue_index f JOIN int_fatigue_index s USING (player_id, session_id)""")
def _(c):
    f = c.fatigue.select("player_id", "session_id", "fatigue_index_score")
    s = c.fatigue.select("player_id", "session_id", "fi_before_match")
    return f.join(s, ["player_id", "session_id"])


@q("jn_7_composite_join_renamed_keys", stage_ctes("stg_training_sessions", "stg_player_stats") + """
SELECT session.session_id, line.player_id, line.game_id, line.minutes_played
FROM stg_player_stats line, stg_training_sessions session
WHERE (line.player_id, line.game_id) = (session.player_id, session.next_match_id)""")
def _(c):
    t = c.stg_stats.select(F.col("player_id").alias("__p"), "game_id", "minutes_played")
    s = c.stg_sessions.select("session_id", "player_id", "next_match_id")
    return s.join(t, (F.col("player_id") == F.col("__p")) & (F.col("next_match_id") == F.col("game_id"))) \
            .select("session_id", "player_id", "game_id", "minutes_played")


@q("jn_8_three_key_join", stage_ctes("int_fatigue_index", "stg_training_sessions") + """
SELECT session_id, player_id, session_date, fatigue_index_score, duration_min
FROM int_fatigue_index NATURAL JOIN (SELECT session_id, player_id, session_date, duration_min FROM stg_training_sessions)""")
def _(c):
    index = c.fatigue.select("player_id", "session_id", "session_date", "fatigue_index_score")
    return c.stg_sessions.select("session_id", "player_id", "session_date", "duration_min") \
            .join(index, ["player_id", "session_id", "session_date"]) \
            .select("session_id", "player_id", "session_date", "fatigue_index_score", "duration_min")


@q("jn_9_existence_join", raw_sql("""
SELECT * FROM team_games_dataset g WHERE EXISTS (SELECT 1 FROM team_boxscores b WHERE b.GAME_ID = g.GAME_ID)""",
                                  "team_games_dataset", "team_boxscores"))
def _(c):
    return J.exists_in(c.games, c.boxscores.select("GAME_ID"), "GAME_ID")


@q("jn_10_join_to_aggregate", stage_ctes("int_fatigue_index", "stg_games") + """
SELECT stg.game_id, f.season, CAST(ROUND(CAST(f.fi_team AS DECIMAL(20,8)), 2) AS DOUBLE) AS fi_before_match_team
FROM stg_games stg JOIN (SELECT next_match_id, season, AVG(fi_before_match) AS fi_team FROM int_fatigue_index
                         GROUP BY next_match_id, season) f ON f.next_match_id = stg.game_id""")
def _(c):
    ft = P.team_fatigue(c.fatigue)
    return c.stg_games.select("game_id").join(ft, F.col("game_id") == F.col("next_match_id")) \
            .select("game_id", "season", X.round_half_up("fi_team", 2).alias("fi_before_match_team"))


@q("jn_11_join_latest_per_group", stage_ctes("stg_training_sessions", "stg_player_stats") + """,
lt AS (SELECT * FROM stg_training_sessions
       QUALIFY row_number() OVER (PARTITION BY player_id, next_match_id ORDER BY session_date DESC, session_id DESC) = 1)
SELECT tps.game_id, tps.player_id, lt.session_id, lt.strength_score AS strength_score_last_training
FROM stg_player_stats tps JOIN lt ON tps.player_id = lt.player_id AND tps.game_id = lt.next_match_id""")
def _(c):
    lt = P.last_training(c.stg_sessions).select("player_id", F.col("next_match_id").alias("game_id"), "session_id",
                                                F.col("strength_score").alias("strength_score_last_training"))
    return c.stg_stats.select("game_id", "player_id").join(lt, ["player_id", "game_id"]) \
            .select("game_id", "player_id", "session_id", "strength_score_last_training")


@q("jn_12_small_dimension_join", stage_ctes("stg_training_sessions", "dim_players") + """
SELECT s.session_id, p.player_name, p.height_cm FROM stg_training_sessions s JOIN dim_players p ON p.player_id = s.player_id""")
def _(c):
    dim = c.dim_players.select("player_id", "player_name", "height_cm")
    return c.stg_sessions.select("session_id", "player_id").join(dim, "player_id").select("session_id", "player_name", "height_cm")


@q("jn_13_merge_on_name_key", stage_ctes("mart_player") + """,
m AS (SELECT player_name, start_position FROM (
        SELECT player_name, start_position, COUNT(*) AS n FROM mart_player WHERE start_position IS NOT NULL
        GROUP BY player_name, start_position)
      QUALIFY row_number() OVER (PARTITION BY player_name ORDER BY n DESC, start_position) = 1),
a AS (SELECT player_name, AVG(points) AS points FROM mart_player GROUP BY player_name)
SELECT m.player_name, m.start_position, CAST(ROUND(CAST(a.points AS DECIMAL(20,8)), 2) AS DOUBLE) AS points
FROM m JOIN a ON a.player_name = m.player_name""")
def _(c):
    m = R.mode_per_group(c.mart_player, ["player_name"], "start_position")
    a = R.group_mean(c.mart_player, ["player_name"], ["points"], scale=2)
    return m.join(a, "player_name")


@q("jn_14_dictionary_lookup", stage_ctes("mart_player") + """,
lut AS (SELECT start_position,
               CASE row_number() OVER (ORDER BY AVG(performance_score_match) DESC NULLS LAST, start_position)
                    WHEN 1 THEN 'Stars' WHEN 2 THEN 'Lieutenants' WHEN 3 THEN 'Rotation' WHEN 4 THEN 'Others' END AS profil_label
        FROM mart_player GROUP BY start_position)
SELECT m.start_position, m.game_id, m.player_id, m.performance_score_match, lut.profil_label
FROM mart_player m LEFT JOIN lut USING (start_position)""")
def _(c):
    """Value -> label through a k-row ranked lookup table; the four positions take four labels."""
    from ..operators import ml as M
    rows = c.mart_player.select("game_id", "player_id", "start_position", "performance_score_match")
    return M.name_clusters(rows, "start_position", "performance_score_match", labels=[*M.PROFILE_LABELS, "Others"])
