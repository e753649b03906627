"""Raw-shape adapters: supplied star-schema tables -> the five raw input shapes.

The pipelines consume five raw tables (player info, player game stats, games,
box scores, training sessions).  The supplied test data is a TPC-H-like star
schema, so each raw table is *derived* from one supplied table by one SQL text
that is valid both in Spark SQL and in DuckDB.  Spark runs it over the parquet
DataFrames (``spark.sql(text, orders=df)``), the DuckDB oracle inlines the same
text as a CTE, so both sides start from identical inputs and every derived row
grows with the supplied tables (no sampling, no caps).

Raw columns are kept as strings wherever the pipelines must exercise safe
casts, blank handling and multi-format parsing.  Modulo expressions below only
*shape values* (which rows get a NULL, a blank, a French or English date...);
nothing is filtered away by them.  Measures are integers or half steps, so
floating sums of them are exact in any order.  Dates are shifted by 24 years so that the
1995-2001 test dates fall into the 2019-2024 season buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .catalog import load

# Fixed month tokens of the game-date text (French abbreviations as they
# appear in the raw exports, then English ones); must match the parser in
# vigor.functions.exprs.
FRENCH_MONTHS = ["janv.", "févr.", "mars", "avr.", "mai", "juin",
                 "juil.", "août", "sept.", "oct.", "nov.", "déc."]
ENGLISH_MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun",
                  "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def _month_case(col: str, tokens: list[str]) -> str:
    whens = " ".join(f"WHEN {i + 1} THEN '{t}'" for i, t in enumerate(tokens))
    return f"CASE month({col}) {whens} END"


def _date_text(col: str, tokens: list[str]) -> str:
    return (f"concat({_month_case(col, tokens)}, ' ', CAST(day({col}) AS STRING), ', ', "
            f"CAST(year({col}) AS STRING))")


RAW_PLAYERS_SQL = """
SELECT
  CASE WHEN s_suppkey % 10 = 9 THEN s_suppkey ELSE s_suppkey + 1 END AS PLAYER_ID,
  s_name AS PLAYER_NAME,
  concat('First', CAST(s_suppkey AS STRING)) AS FIRST_NAME,
  concat('Last', CAST(s_suppkey AS STRING)) AS LAST_NAME,
  CASE WHEN s_suppkey % 23 = 22 THEN NULL
       ELSE concat(CAST(1985 + s_suppkey % 15 AS STRING), '-0', CAST(1 + s_suppkey % 9 AS STRING), '-15 08:30:00')
  END AS BIRTHDATE,
  CASE WHEN s_suppkey % 29 = 28 THEN NULL ELSE 20 + s_suppkey % 12 END AS AGE,
  CASE WHEN s_suppkey % 7 = 3 THEN NULL ELSE CAST(170 + s_suppkey % 41 AS DOUBLE) END AS HEIGHT_CM,
  CASE WHEN s_suppkey % 6 = 4 THEN NULL ELSE CAST(141 + 2 * (s_suppkey % 30) AS DOUBLE) / 2 END AS WEIGHT_KG,
  CASE WHEN s_suppkey % 5 = 2 THEN ''
       WHEN s_suppkey % 11 = 5 THEN NULL
       WHEN s_suppkey % 3 = 0 THEN 'Center'
       WHEN s_suppkey % 3 = 1 THEN 'Guard'
       ELSE 'Forward' END AS POSITION,
  concat('School ', CAST(s_suppkey % 9 AS STRING)) AS SCHOOL,
  concat('Country ', CAST(s_nationkey AS STRING)) AS COUNTRY,
  CASE WHEN s_suppkey % 13 = 12 THEN 'n/a' ELSE CAST(s_suppkey % 12 AS STRING) END AS SEASON_EXP
FROM {supplier}
"""

RAW_GAMES_SQL = f"""
SELECT
  o_orderkey + 1 AS GAME_ID,
  CASE WHEN o_orderkey % 97 = 13 THEN 'TBD'
       WHEN o_orderkey % 4 = 2 THEN CAST(43600 + o_orderkey % 1700 AS STRING)
       WHEN o_orderkey % 4 = 1 THEN {_date_text('gd', ENGLISH_MONTHS)}
       ELSE {_date_text('gd', FRENCH_MONTHS)} END AS GAME_DATE,
  CASE WHEN o_orderkey % 53 = 7 THEN concat('HOM - T', CAST(o_custkey % 29 AS STRING))
       WHEN o_orderkey % 2 = 0 THEN concat('HOM vs. T', CAST(o_custkey % 29 AS STRING))
       ELSE concat('HOM @ T', CAST(o_custkey % 29 AS STRING)) END AS MATCHUP,
  CASE WHEN o_orderstatus = 'F' THEN 'W' ELSE 'L' END AS WL,
  CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS W,
  CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS L,
  CAST(o_orderkey % 101 AS DOUBLE) / 100 AS W_PCT,
  CAST(240 AS DOUBLE) AS MIN,
  CASE WHEN o_orderkey % 89 = 3 THEN 'forfeit'
       ELSE CAST(CAST(floor(o_totalprice / 4000) AS BIGINT) AS STRING) END AS PTS,
  20 + o_orderkey % 25 AS FGM,
  60 + o_orderkey % 30 AS FGA,
  CAST(20 + o_orderkey % 25 AS DOUBLE) / 90 AS FG_PCT,
  5 + o_orderkey % 11 AS FG3M,
  20 + o_orderkey % 13 AS FG3A,
  CAST(5 + o_orderkey % 11 AS DOUBLE) / 40 AS FG3_PCT,
  10 + o_orderkey % 9 AS FTM,
  15 + o_orderkey % 12 AS FTA,
  CAST(10 + o_orderkey % 9 AS DOUBLE) / 30 AS FT_PCT,
  o_custkey % 15 AS OREB,
  25 + o_custkey % 14 AS DREB,
  25 + o_custkey % 14 + o_custkey % 15 AS REB,
  15 + o_custkey % 16 AS AST,
  o_custkey % 11 AS STL,
  o_custkey % 8 AS BLK,
  8 + o_orderkey % 10 AS TOV,
  12 + o_orderkey % 12 AS PF
FROM (SELECT *, CAST(o_orderdate + INTERVAL 24 YEAR AS DATE) AS gd FROM {{orders}}) o
"""

RAW_BOXSCORES_SQL = """
SELECT o_orderkey + 1 AS GAME_ID,
       CAST(o_orderkey % 41 - 20 AS STRING) AS PLUS_MINUS
FROM {orders}
"""

RAW_STATS_SQL = """
SELECT
  CAST(l_orderkey + 1 AS STRING) AS GAME_ID,
  CASE WHEN l_partkey % 53 = 11 THEN NULL ELSE CAST(l_suppkey + 1 AS STRING) END AS PLAYER_ID,
  CASE l_linenumber WHEN 1 THEN 'F' WHEN 2 THEN 'C' WHEN 3 THEN ' G ' WHEN 4 THEN '' WHEN 5 THEN 'F'
       ELSE NULL END AS START_POSITION,
  CASE WHEN l_partkey % 97 = 5 THEN 'abc'
       WHEN l_linenumber = 3 THEN CAST(CAST(floor(l_quantity) AS BIGINT) - 1 AS STRING)
       WHEN l_partkey % 89 = 7 THEN concat(CAST(CAST(floor(l_quantity) AS BIGINT) - 1 AS STRING), ':',
                                          lpad(CAST(l_partkey % 60 AS STRING), 2, '0'), ':00')
       ELSE concat(CAST(CAST(floor(l_quantity) AS BIGINT) - 1 AS STRING), ':',
                   lpad(CAST(l_partkey % 60 AS STRING), 2, '0')) END AS MIN,
  CAST(CAST(floor(l_extendedprice / 3000) AS BIGINT) AS STRING) AS PTS,
  CAST(l_partkey % 12 AS STRING) AS FGM,
  CAST(12 + l_partkey % 9 AS STRING) AS FGA,
  CAST(round(l_discount * 5, 2) AS STRING) AS FG_PCT,
  CAST(l_partkey % 5 AS STRING) AS FG3M,
  CAST(5 + l_partkey % 4 AS STRING) AS FG3A,
  CAST(round(l_tax * 4, 2) AS STRING) AS FG3_PCT,
  CAST(l_orderkey % 7 AS STRING) AS FTM,
  CAST(7 + l_orderkey % 3 AS STRING) AS FTA,
  CAST(0.75 AS STRING) AS FT_PCT,
  CAST(l_partkey % 4 AS STRING) AS OREB,
  CAST(l_partkey % 9 AS STRING) AS DREB,
  CAST(l_partkey % 4 + l_partkey % 9 AS STRING) AS REB,
  CASE WHEN l_partkey % 83 = 2 THEN NULL ELSE CAST(l_suppkey % 9 AS STRING) END AS AST,
  CAST(l_partkey % 4 AS STRING) AS STL,
  CAST(l_orderkey % 3 AS STRING) AS BLK,
  CAST(l_linenumber % 5 AS STRING) AS {to_col},
  CAST(l_partkey % 6 AS STRING) AS PF,
  CAST(l_partkey % 31 - 15 AS STRING) AS PLUS_MINUS,
  CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'DNP'
       WHEN l_linenumber = 5 THEN NULL
       WHEN l_linenumber = 6 THEN ' '
       ELSE '' END AS COMMENT
FROM {lineitem}
"""

# One training session per lineitem row, named by its order, supplier, line, part and day.
RAW_SESSIONS_SQL = """
SELECT
  concat('S', CAST(l_orderkey AS STRING), '-', CAST(l_suppkey AS STRING), '-', CAST(l_linenumber AS STRING), '-', CAST(l_partkey AS STRING),
         '-', CAST(CAST(l_shipdate AS DATE) AS STRING)) AS SESSION_ID,
  CASE WHEN l_partkey % 61 = 17 THEN NULL ELSE CAST(l_suppkey + 1 AS STRING) END AS PLAYER_ID,
  CAST(l_orderkey + 1 AS STRING) AS NEXT_MATCH_ID,
  CAST(CAST(l_shipdate + INTERVAL 24 YEAR AS TIMESTAMP) AS STRING) AS SESSION_DATE,
  CASE WHEN l_partkey % 71 = 3 THEN NULL ELSE 30 + 2 * l_quantity END AS DURATION_MIN,
  CASE WHEN l_partkey % 9 = 4 THEN NULL ELSE CAST(120 + l_partkey % 60 AS DOUBLE) END AS HEART_RATE,
  CASE WHEN l_partkey % 11 = 2 THEN NULL ELSE CAST(40 + l_partkey % 55 AS DOUBLE) END AS STRENGTH_SCORE,
  CASE WHEN l_partkey % 13 = 6 THEN NULL ELSE CAST(30 + l_partkey % 61 AS DOUBLE) END AS {shoot_col},
  CASE WHEN l_partkey % 17 = 8 THEN NULL ELSE CAST(50 + l_partkey % 45 AS DOUBLE) END AS {pass_col},
  CASE WHEN l_partkey % 19 = 1 THEN NULL ELSE CAST(1 + l_partkey % 10 AS DOUBLE) END AS FOCUS_LEVEL,
  CASE WHEN l_partkey % 47 = 4 THEN NULL ELSE CAST(4 + l_partkey % 12 AS DOUBLE) END AS WEEKLY_TRAINING_HOURS,
  CASE WHEN l_partkey % 8 = 5 THEN NULL ELSE CAST(floor(l_quantity * 2 / 5) AS DOUBLE) / 2 END AS LOAD_INTENSITY_SCORE,
  CASE WHEN l_partkey % 10 = 7 THEN NULL ELSE CAST(45 + l_partkey % 50 AS DOUBLE) END AS PERFORMANCE_SCORE,
  CASE l_partkey % 6 WHEN 0 THEN 'Low' WHEN 1 THEN 'Medium' WHEN 2 THEN 'High' WHEN 3 THEN NULL
       WHEN 4 THEN 'Low' ELSE 'Unknown' END AS FATIGUE_LEVEL,
  CASE WHEN l_partkey % 43 = 1 THEN NULL
       WHEN (l_partkey + l_linenumber) % 8 = 0 OR l_quantity > 46 THEN 1 ELSE 0 END AS INJURY_RISK,
  CASE WHEN l_partkey % 37 = 3 THEN NULL
       WHEN (l_partkey + l_linenumber) % 8 = 0 THEN 'High' ELSE 'Low' END AS INJURY_RISK_LEVEL,
  CASE WHEN l_partkey % 67 = 5 THEN NULL ELSE 12 + l_quantity END AS RECOVERY_TIME_HOURS,
  CASE WHEN l_partkey % 73 = 9 THEN NULL ELSE l_linenumber END AS DAYS_BEFORE_MATCH
FROM {lineitem}
"""

# name -> (sql text, supplied tables it reads)
RAW_TABLES = {
    "team_players_personal_info": (RAW_PLAYERS_SQL, ("supplier",)),
    "team_games_dataset": (RAW_GAMES_SQL, ("orders",)),
    "team_boxscores": (RAW_BOXSCORES_SQL, ("orders",)),
    "team_players_stats": (RAW_STATS_SQL, ("lineitem",)),
    "team_training_sessions": (RAW_SESSIONS_SQL, ("lineitem",)),
}

# Awkward raw identifiers, quoted per engine.
_SPARK_IDS = {"to_col": "`TO`", "shoot_col": "`Shooting_Accuracy_%`", "pass_col": "`Passing_Accuracy_%`"}
_DUCK_IDS = {"to_col": '"TO"', "shoot_col": '"Shooting_Accuracy_%"', "pass_col": '"Passing_Accuracy_%"'}


def raw_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """The raw table ``name`` derived by Spark from the supplied parquet files."""
    text, sources = RAW_TABLES[name]
    frames = {s: load(spark, base_dir, s) for s in sources}
    return spark.sql(text.format(**{**_SPARK_IDS, **{s: "{" + s + "}" for s in sources}}), **frames)


def raw_tables(spark: SparkSession, base_dir: str) -> dict[str, DataFrame]:
    return {n: raw_table(spark, base_dir, n) for n in RAW_TABLES}


def duckdb_cte(name: str) -> str:
    """``name AS (...)`` for a DuckDB WITH clause over the supplied views."""
    text, sources = RAW_TABLES[name]
    return f"{name} AS ({text.format(**_DUCK_IDS, **{s: s for s in sources})})"


def duckdb_ctes(names=tuple(RAW_TABLES)) -> str:
    return ",\n".join(duckdb_cte(n) for n in names)
