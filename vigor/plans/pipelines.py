"""End-to-end pipelines PL-1 ... PL-11 (staging -> fatigue index -> marts).

Each function takes DataFrames and returns a lazy DataFrame; nothing is
collected.  Column names are lower-case snake case.  No join carries a hint but that to
the means of ages and positions: Spark plans it from the keys and the measured size of its sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import relational as R
from ..operators.joins import exists_in, join_on_cast_keys

# ---------------------------------------------------------------- PL-1 stg_players

PLAYER_COLUMNS = ["player_id", "player_name", "first_name", "last_name", "birthdate", "age",
                  "height_cm", "weight_kg", "position", "school", "country", "season_exp"]


def stg_players(raw: DataFrame) -> DataFrame:
    """Filter -> impute by age -> infer position -> one row per player (T6 order)."""
    df = raw.filter(F.col("PLAYER_ID").isNotNull() & F.col("BIRTHDATE").isNotNull() & F.col("AGE").isNotNull())
    df = df.select(
        X.safe_cast("PLAYER_ID", "bigint").alias("player_id"),
        F.col("PLAYER_NAME").alias("player_name"),
        F.col("FIRST_NAME").alias("first_name"),
        F.col("LAST_NAME").alias("last_name"),
        X.timestamp_text_to_date("BIRTHDATE").alias("birthdate"),
        F.col("AGE").alias("age"),
        X.safe_cast("HEIGHT_CM", "double").alias("__height"),
        X.safe_cast("WEIGHT_KG", "double").alias("__weight"),
        F.col("POSITION").alias("__position"),
        F.col("SCHOOL").alias("school"),
        F.col("COUNTRY").alias("country"),
        X.safe_cast("SEASON_EXP", "bigint").alias("season_exp"),
    )
    df = R.impute_group_mean(df, ["age"], {"height_cm": "__height", "weight_kg": "__weight"}, few=True)
    df = df.withColumn("position", X.position_from_height("__position", "height_cm"))
    return R.dedup_keep_one(df.select(*PLAYER_COLUMNS), ["player_id"])


# ---------------------------------------------------------------- PL-5 dim_players

def dim_players(stg: DataFrame) -> DataFrame:
    """Player dimension: the staging projection, one row per player (PL-5)."""
    return R.dedup_keep_one(stg.filter(F.col("player_id").isNotNull()).select(*PLAYER_COLUMNS), ["player_id"])


# ---------------------------------------------------------------- PL-2 stg_player_stats

# raw column -> (output name, type)
STATS_COLUMNS = [
    ("PTS", "points", "bigint"), ("FGM", "field_goal_made", "bigint"), ("FGA", "field_goal_attempt", "bigint"),
    ("FG_PCT", "fg_pct", "double"), ("FG3M", "field_goal_3pts_made", "bigint"),
    ("FG3A", "field_goal_3pts_attempt", "bigint"), ("FG3_PCT", "fg3_pct", "double"),
    ("FTM", "free_throws_made", "bigint"), ("FTA", "free_throws_attempt", "bigint"), ("FT_PCT", "ft_pct", "double"),
    ("OREB", "offensive_rebounds", "bigint"), ("DREB", "defensive_rebounds", "bigint"),
    ("REB", "total_rebounds", "bigint"), ("AST", "assists", "bigint"), ("STL", "steals", "bigint"),
    ("BLK", "blocks", "bigint"), ("TO", "turnover", "bigint"), ("PF", "player_fault", "bigint"),
    ("PLUS_MINUS", "plus_minus", "double"),
]


def stg_player_stats(raw: DataFrame) -> DataFrame:
    """Drop non-selected players, type every stat, one row per (player, game) (PL-2)."""
    df = raw.filter(X.is_blank("COMMENT"))
    df = df.select(
        X.safe_cast("GAME_ID", "bigint").alias("game_id"),
        X.safe_cast("PLAYER_ID", "bigint").alias("player_id"),
        X.blank_to_default("START_POSITION", "Bench").alias("start_position"),
        X.minutes_decimal("MIN").alias("minutes_played"),
        *[X.safe_cast(F.col(f"`{src}`"), t).alias(out) for src, out, t in STATS_COLUMNS],
    )
    return R.dedup_keep_one(df.filter(F.col("player_id").isNotNull()), ["player_id", "game_id"])


# ---------------------------------------------------------------- PL-3 stg_games

GAME_TOTALS = [
    ("FGM", "total_field_goal_made"), ("FGA", "total_field_goal_attempt"), ("FG_PCT", "fg_pct"),
    ("FG3M", "total_field_goal_3pts_made"), ("FG3A", "total_field_goal_3pts_attempt"), ("FG3_PCT", "fg3_pct"),
    ("FTM", "total_free_throws_made"), ("FTA", "total_free_throws_attempt"), ("FT_PCT", "ft_pct"),
    ("OREB", "total_offensive_rebounds"), ("DREB", "total_defensive_rebounds"), ("REB", "total_rebounds"),
    ("AST", "total_assists"), ("STL", "total_steals"), ("BLK", "total_blocks"), ("TOV", "total_turnover"),
    ("PF", "total_player_fault"),
]
GAME_COLUMNS = ["game_id", "game_date", "matchup", "win_loss", "win", "loss", "win_pct", "total_minutes",
                "total_points"] + [o for _, o in GAME_TOTALS] + ["ecart"]


def stg_games(games: DataFrame, boxscores: DataFrame) -> DataFrame:
    """Games joined with box scores on safe-cast keys, dates parsed (PL-3, JN-1/2, FN-1..3)."""
    box = boxscores.select(F.col("GAME_ID").alias("__bid"), F.col("PLUS_MINUS").alias("__pm"))
    j = join_on_cast_keys(games, box, "GAME_ID", "__bid")
    return j.select(
        X.safe_cast("GAME_ID", "bigint").alias("game_id"),
        X.parse_game_date("GAME_DATE").alias("game_date"),
        F.col("MATCHUP").alias("matchup"),
        F.col("WL").alias("win_loss"), F.col("W").alias("win"), F.col("L").alias("loss"),
        F.col("W_PCT").alias("win_pct"), F.col("MIN").alias("total_minutes"),
        X.safe_cast("PTS", "bigint").alias("total_points"),
        *[F.col(s).alias(o) for s, o in GAME_TOTALS],
        X.safe_cast("__pm", "bigint").alias("ecart"),
    )


# ---------------------------------------------------------------- PL-6 dim_calendar

CALENDAR_COLUMNS = ["game_id", "game_date", "season", "annee", "mois", "jour", "place", "opponent"]


def dim_calendar(stg: DataFrame, season_bounds=None) -> DataFrame:
    parts = X.date_parts("game_date")
    return stg.filter(F.col("game_id").isNotNull()).select(
        "game_id", "game_date", X.season_bucket("game_date", season_bounds).alias("season"),
        parts["annee"].alias("annee"), parts["mois"].alias("mois"), parts["jour"].alias("jour"),
        X.home_away("matchup").alias("place"), X.opponent("matchup").alias("opponent"))


# ---------------------------------------------------------------- PL-4 stg_training_sessions

SESSION_COLUMNS = ["season", "session_id", "player_id", "next_match_id", "session_date", "duration_min",
                   "heart_rate", "strength_score", "shooting_accuracy_pct", "passing_accuracy_pct", "focus_level",
                   "weekly_training_hours", "load_intensity_score", "fatigue_level", "injury_risk",
                   "injury_risk_level", "recovery_time_hours", "performance_score", "days_before_match"]
IMPUTED_SESSION_MEASURES = {
    "heart_rate": "HEART_RATE", "strength_score": "STRENGTH_SCORE",
    "shooting_accuracy_pct": "Shooting_Accuracy_%", "load_intensity_score": "LOAD_INTENSITY_SCORE",
    "performance_score": "PERFORMANCE_SCORE",
}


def stg_training_sessions(raw: DataFrame, players: DataFrame, season_bounds=None) -> DataFrame:
    """Sessions enriched with the player's age/position, filtered, imputed by (age, position) (PL-4)."""
    pi = players.select(F.col("player_id").alias("__pid"), F.col("age").alias("__age"), F.col("position").alias("__pos"))
    d = raw.withColumn("__player", X.safe_cast("PLAYER_ID", "bigint"))
    j = d.join(pi, d["__player"] == pi["__pid"], "left")  # JN-4; the filter below makes it inner (JN-3)
    j = j.filter(F.col("PLAYER_ID").isNotNull() & F.col("__age").isNotNull() & F.col("SESSION_ID").isNotNull()
                 & F.col("DAYS_BEFORE_MATCH").isNotNull() & F.col("RECOVERY_TIME_HOURS").isNotNull()
                 & F.col("DURATION_MIN").isNotNull())
    typed = {out: X.safe_cast(F.col(f"`{src}`"), "double") for out, src in IMPUTED_SESSION_MEASURES.items()}
    j = j.select("*", *[c.alias(f"__typed_{o}") for o, c in typed.items()])
    j = R.impute_group_mean(j, ["__age", "__pos"], {o: f"__typed_{o}" for o in typed},
                            source={o: F.col(f"`{src}`") for o, src in IMPUTED_SESSION_MEASURES.items()}, few=True)
    session_date = X.timestamp_text_to_date("SESSION_DATE")
    out = j.select(
        X.season_bucket(session_date, season_bounds).alias("season"),
        F.col("SESSION_ID").alias("session_id"),
        F.col("__player").alias("player_id"),
        X.safe_cast("NEXT_MATCH_ID", "bigint").alias("next_match_id"),
        session_date.alias("session_date"),
        X.safe_cast("DURATION_MIN", "double").alias("duration_min"),
        "heart_rate", "strength_score", "shooting_accuracy_pct",
        X.safe_cast(F.col("`Passing_Accuracy_%`"), "double").alias("passing_accuracy_pct"),
        X.safe_cast("FOCUS_LEVEL", "double").alias("focus_level"),
        X.safe_cast("WEEKLY_TRAINING_HOURS", "double").alias("weekly_training_hours"),
        "load_intensity_score",
        F.coalesce(F.col("FATIGUE_LEVEL"), F.lit("Low")).alias("fatigue_level"),
        F.coalesce(X.safe_cast("INJURY_RISK", "bigint"), F.lit(0).cast("bigint")).alias("injury_risk"),
        F.coalesce(F.col("INJURY_RISK_LEVEL"), F.lit("Low")).alias("injury_risk_level"),
        X.safe_cast("RECOVERY_TIME_HOURS", "double").alias("recovery_time_hours"),
        "performance_score",
        X.safe_cast("DAYS_BEFORE_MATCH", "bigint").alias("days_before_match"),
    )
    return out.select(*SESSION_COLUMNS)


# ---------------------------------------------------------------- PL-7 int_fatigue_index

FATIGUE_COLUMNS = ["season", "session_date", "session_id", "player_id", "next_match_id", "recovery_score",
                   "fatigue_index_score", "fi_interpretation", "recovery_needed_hours", "fi_before_match"]


def int_fatigue_index(sessions: DataFrame, stats: DataFrame, players: DataFrame,
                      min_minutes: float = 5.0) -> DataFrame:
    """Fatigue index per (player, session) (PL-7).

    sessions JOIN players JOIN stats of the *next* match, minutes >= 5 (FLT-3);
    the team-wide maximum duration is taken over that joined set (T7) and
    broadcast as a one-row aggregate (WIN-6).  The reference joins its own
    derived set back twice; with unique sessions that is one projection (T17).
    """
    spi = players.select("player_id", F.col("age").alias("__age"))
    tps = (stats.filter(F.col("minutes_played") >= min_minutes)
           .select(F.col("player_id").alias("__tp"), F.col("game_id").alias("__tg")))
    next_match = (F.col("player_id") == F.col("__tp")) & (F.col("next_match_id") == F.col("__tg"))
    j = sessions.join(spi, "player_id").join(tps, next_match)
    # the same rows' maximum, from keys and durations only
    played = (sessions.select("player_id", "next_match_id", "duration_min")
              .join(spi.select("player_id"), "player_id", "left_semi").join(tps, next_match, "left_semi"))
    j = R.with_global_max(j, "duration_min", "__max_duration", of=played)
    hr = X.heart_rate_norm("heart_rate", "__age")
    fat = X.ordinal_level_norm("fatigue_level")
    rec = X.recovery_score("days_before_match", "recovery_time_hours")
    load = F.col("load_intensity_score") / F.lit(10.0)
    weekly = F.try_divide(F.col("weekly_training_hours"), (F.col("__max_duration") / F.lit(60.0)) * F.lit(7.0))
    j = j.select("*", rec.alias("recovery_score"),
                 X.fatigue_index(hr, fat, load, weekly, rec).alias("__fi_raw"))
    need = X.recovery_needed_hours("recovery_time_hours", "days_before_match")
    fi = X.round_half_up("__fi_raw", 2)
    return j.select(
        "season", "session_date", "session_id", "player_id", "next_match_id", "recovery_score",
        fi.alias("fatigue_index_score"),
        X.fatigue_band("__fi_raw").alias("fi_interpretation"),
        need.alias("recovery_needed_hours"),
        X.residual_before_match(fi, need, "days_before_match").alias("fi_before_match"),
    )


# ---------------------------------------------------------------- PL-8 mart_player

MART_PLAYER_COLUMNS = ["game_id", "player_id", "season", "player_name", "age", "height_cm", "weight_kg", "position",
                       "strength_score_last_training", "place", "start_position", "minutes_played", "points",
                       "fg_pct", "fg3_pct", "ft_pct", "total_rebounds", "assists", "steals", "blocks", "turnover",
                       "player_fault", "performance_score_match", "performance_score_match_min", "plus_minus"]


def last_training(sessions: DataFrame) -> DataFrame:
    """Latest session per (player, next match), ties by session id (WIN-3)."""
    lt = sessions.select("player_id", "next_match_id", "session_date", "session_id", "strength_score")
    return R.latest_per_group(lt, ["player_id", "next_match_id"], ["session_date", "session_id"])


def mart_player(stats: DataFrame, calendar: DataFrame, players: DataFrame, sessions: DataFrame) -> DataFrame:
    """Per (game, player): match stats, player bio, strength at the last training (PL-8)."""
    cm = calendar.select("game_id", "season", "place")
    pi = players.select("player_id", "player_name", "age", "height_cm", "weight_kg", "position")
    lt = last_training(sessions).select("player_id", F.col("next_match_id").alias("game_id"),
                                        F.col("strength_score").alias("strength_score_last_training"))
    # players last: their names and sizes needn't be shuffled with the statistics
    j = stats.join(cm, "game_id").join(lt, ["player_id", "game_id"]).join(pi, "player_id")
    score = X.performance_score("points", "total_rebounds", "assists", "steals", "blocks", "turnover", "player_fault")
    j = j.withColumn("performance_score_match", score) \
         .withColumn("performance_score_match_min", X.per_minute("performance_score_match", "minutes_played"))
    return j.select(*MART_PLAYER_COLUMNS)


# ---------------------------------------------------------------- PL-9 mart_game

MART_GAME_COLUMNS = ["game_id", "fi_before_match_team", "win_loss", "total_points", "ecart", "total_minutes",
                     "total_field_goal_made", "total_field_goal_attempt", "fg_pct", "total_field_goal_3pts_made",
                     "total_field_goal_3pts_attempt", "fg3_pct", "total_free_throws_made",
                     "total_free_throws_attempt", "ft_pct", "total_offensive_rebounds", "total_defensive_rebounds",
                     "total_rebounds", "total_assists", "total_steals", "total_blocks", "total_turnover",
                     "total_player_fault", "win", "loss", "win_pct"]


def team_fatigue(fatigue: DataFrame) -> DataFrame:
    """Mean residual fatigue per (next match, season) (AGG-1)."""
    return fatigue.groupBy("next_match_id", "season").agg(F.avg("fi_before_match").alias("fi_team"))


def mart_game(games: DataFrame, calendar: DataFrame, fatigue: DataFrame) -> DataFrame:
    """Per game: team totals + mean residual fatigue of the players (PL-9).

    The calendar contributes no column: an existence (semi) join (T21).  A
    match whose sessions span two seasons has two team-fatigue rows; the
    model keeps one per game by the total order of its columns (T5), with
    the fatigue value first.  Because the game rows and the fatigue rows
    multiply as a cross product per game, that pick factorises: the smallest
    rounded team fatigue per game (NULL first), then one game row per game.
    So the fatigue is reduced to one row per game *before* the join, and no
    wide joined row is ever de-duplicated.
    """
    fi = X.round_half_up("fi_team", 2)
    ft = (team_fatigue(fatigue)
          .groupBy(F.col("next_match_id").alias("game_id"))
          .agg(F.when(F.count_if(fi.isNull()) > 0, F.lit(None)).otherwise(F.min(fi)).cast("double")
               .alias("fi_before_match_team")))
    g = R.dedup_keep_one(exists_in(games, calendar.select("game_id"), "game_id")
                         .select(*[c for c in MART_GAME_COLUMNS if c != "fi_before_match_team"]), ["game_id"])
    return g.join(ft, "game_id").select(*MART_GAME_COLUMNS)


# ---------------------------------------------------------------- PL-10 mart_physical_condition

MART_PC_COLUMNS = ["season", "player_id", "session_id", "next_match_id", "player_name", "fi_last_training",
                   "rs_last_training", "recovery_needed_last_training", "fi_before_match", "focus_level",
                   "strength_score", "shooting_accuracy_pct", "passing_accuracy_pct", "performance_score",
                   "load_intensity_score", "injury_risk", "fi_avg_7d", "fi_max_7d", "training_load_7d",
                   "fi_avg_28d", "fi_max_28d", "training_load_28d", "place", "position", "start_position",
                   "minutes_played", "points", "fg_pct", "fg3_pct", "total_rebounds", "assists", "steals", "blocks",
                   "turnover", "player_fault", "performance_score_match", "performance_score_match_min", "plus_minus"]

ROLLING_SPECS = [("avg", "fatigue_index_score", "fi_avg_{n}d"),
                 ("max", "fatigue_index_score", "fi_max_{n}d"),
                 ("sum", "__load", "training_load_{n}d")]


def fatigue_rolling(fatigue: DataFrame, sessions: DataFrame, windows=(7, 28), keep=None) -> DataFrame:
    """fatigue JOIN sessions USING (session_id) + trailing 7/28-day stats per player (WIN-7/8/9).

    The joined rows are read twice, for the daily statistics and to take them; ``keep(frame, name)`` may store them first.
    """
    sts = sessions.select("session_id", "focus_level", "strength_score", "shooting_accuracy_pct",
                          "passing_accuracy_pct", "performance_score", "load_intensity_score", "injury_risk",
                          (F.col("duration_min") * F.col("load_intensity_score")).alias("__load"))
    base = fatigue.join(sts, "session_id").withColumn("__dayn", X.day_number("session_date"))
    base = keep(base, "fatigue_sessions") if keep else base
    return R.rolling_day_stats(base, "player_id", "__dayn", ROLLING_SPECS, windows, keep).drop("__load")


def mart_physical_condition(fatigue: DataFrame, sessions: DataFrame, mart_player_df: DataFrame, keep=None) -> DataFrame:
    """Per session: last-training fatigue, 7/28-day load, next-match performance (PL-10).

    ``season`` comes from the match (mart_player), not from the session.
    ``keep(frame, name)`` may store the rows between its joins: in one query the shuffles of all of them are there at once.
    """
    fs = fatigue_rolling(fatigue.drop("season", "fi_interpretation"), sessions, keep=keep).drop("session_date", "__dayn")
    fs = keep(fs, "fatigue_rolling") if keep else fs
    mp = mart_player_df.select(F.col("game_id").alias("__mg"), F.col("player_id").alias("__mp"), "season",
                               "player_name", "place", "position", "start_position", "minutes_played", "points",
                               "fg_pct", "fg3_pct", "total_rebounds", "assists", "steals", "blocks", "turnover",
                               "player_fault", "performance_score_match", "performance_score_match_min", "plus_minus")
    j = fs.join(mp, (F.col("next_match_id") == F.col("__mg")) & (F.col("player_id") == F.col("__mp")))
    j = (j.withColumnRenamed("fatigue_index_score", "fi_last_training")
          .withColumnRenamed("recovery_score", "rs_last_training")
          .withColumnRenamed("recovery_needed_hours", "recovery_needed_last_training"))
    return j.select(*MART_PC_COLUMNS)
