"""Registered queries: machine-learning operators and pipelines PL-12 ... PL-14."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import ml as M
from ..operators import sinks as S
from ..operators.ranks import staged
from . import ml_jobs as MJ
from .oracle import stage_ctes
from .pipelines import MART_PC_COLUMNS
from .registry import q


def _r(x: str, n: int) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(20,8)), {n}) AS DOUBLE)"


@q("ml_1_label_encoding", stage_ctes("dim_players") + """
SELECT player_id, position, CAST(dense_rank() OVER (ORDER BY position) - 1 AS INTEGER) AS position_code FROM dim_players""")
def _(c):
    return M.label_encode(c.dim_players.select("player_id", "position"), "position", "position_code")


_PF = MJ.PROFILE_FEATURES
_PROFILE_SQL = stage_ctes("mart_player") + """,
prof AS (
  SELECT season, player_id, player_name, """ + ", ".join(f"COALESCE(AVG({f}), 0) AS {f}" for f in _PF) + """
  FROM mart_player WHERE minutes_played >= 5 AND season = '2023-2024' GROUP BY season, player_id, player_name)
"""


@q("ml_2_standardize", _PROFILE_SQL + "SELECT player_id, " + ", ".join(
    f"{_r(f'CASE WHEN STDDEV_POP({f}) OVER () > 0 THEN ({f} - AVG({f}) OVER ()) / STDDEV_POP({f}) OVER () ELSE 0.0 END', 8)} AS {f}_z"
    for f in _PF) + " FROM prof")
def _(c):
    prof = MJ.player_profiles(c.mart_player).na.fill(0.0, subset=_PF)
    z = M.standardize(prof, _PF, suffix="_z")
    return z.select("player_id", *[X.round_half_up(f + "_z", 8).alias(f + "_z") for f in _PF])


@q("ml_3_reproducible_split", stage_ctes("stg_training_sessions") + """
SELECT session_id, injury_risk, CAST('0x' || substr(md5('42|' || session_id), 1, 8) AS BIGINT) % 10000 < 2000 AS is_test
FROM stg_training_sessions""")
def _(c):
    return M.hash_split(c.stg_sessions.select("session_id", "injury_risk"), ["session_id"], 0.2, 42)


@q("ml_4_positive_class_weight", stage_ctes("stg_training_sessions") + """
SELECT session_id, injury_risk,
       CASE WHEN injury_risk = 1 THEN COALESCE((SELECT COUNT(CASE WHEN injury_risk = 0 THEN 1 END) /
              NULLIF(COUNT(CASE WHEN injury_risk = 1 THEN 1 END), 0) FROM stg_training_sessions), 1.0) ELSE 1.0 END AS weight
FROM stg_training_sessions""")
def _(c):
    s = c.stg_sessions.select("session_id", "injury_risk")
    return M.with_pos_weight(s, "injury_risk", s)


@q("ml_5_balanced_class_weight", stage_ctes("stg_training_sessions") + """
SELECT s.injury_risk, s.session_id, w.weight FROM stg_training_sessions s JOIN (
  SELECT injury_risk, (SELECT COUNT(*) FROM stg_training_sessions) /
         ((SELECT COUNT(DISTINCT injury_risk) FROM stg_training_sessions) * COUNT(*)) AS weight
  FROM stg_training_sessions GROUP BY injury_risk) w ON w.injury_risk = s.injury_risk""")
def _(c):
    s = c.stg_sessions.select("session_id", "injury_risk")
    return M.with_balanced_weight(s, "injury_risk")


_MODELS: dict = {}


def _model(c, kind: str):
    """One fitted model per (run, kind), shared by the queries that use it."""
    key = (*c.run_key, kind)
    if key not in _MODELS:
        if kind == "gbt":
            _MODELS[key] = MJ.fit_injury_model(_injury_rows(c))
        else:
            _MODELS[key] = MJ.fit_profile_model(MJ.scaled_profiles(c.mart_player))
    return _MODELS[key]


def _injury_rows(c):
    """What the injury model learns and scores, stored once per run."""
    return c.table("ml_injury_rows", lambda: MJ.injury_split(c.mart_pc).select("session_id", MJ.INJURY_LABEL, "is_test", *MJ.model_columns()))


def _injury_train_test(c):
    df = _injury_rows(c)
    return df.filter(~F.col("is_test")), df.filter(F.col("is_test"))


@q("ml_6_boosted_trees")
def _(c):
    _, test = _injury_train_test(c)
    return M.positive_probability(_model(c, "gbt"), test, MJ.model_columns(), "injury_probability") \
            .select("session_id", "injury_risk", "injury_probability")


@q("ml_7_random_forest")
def _(c):
    return _forest_scores(c).select("session_id", "injury_risk", "injury_probability")


def _forest_scores(c):
    """The exploration's forest: its own features, the raw acute:chronic ratio, balanced classes; test rows scored, once per run."""
    features = MJ.EXPLORATION_INJURY_FEATURES
    key = (*c.run_key, "forest")
    if key not in _MODELS:
        rows = MJ.injury_split(c.mart_pc, epsilon=0.0, features=features)
        _MODELS[key] = M.forest_probability(rows, MJ.model_columns(features), "injury_risk", "session_id", out="injury_probability")
    return _MODELS[key]


@q("pl_12_model_thresholds")
def _(c):
    """Precision and recall of the fitted boosted trees on the test rows, per threshold."""
    _, test = _injury_train_test(c)
    scored = M.positive_probability(_model(c, "gbt"), test, MJ.model_columns(), "p")
    return M.threshold_sweep(scored, "injury_risk", "p")


@q("pl_14_forest_thresholds")
def _(c):
    return M.threshold_sweep(_forest_scores(c), "injury_risk", "injury_probability")


@q("ml_8_positive_probability")
def _(c):
    return MJ.injury_scoring(c.mart_pc, model=_model(c, "gbt")).select("session_id", "injury_probability")


_SCORE_SQL = stage_ctes("int_fatigue_index", "stg_training_sessions") + """,
sc AS (SELECT s.injury_risk AS label, LEAST(GREATEST(f.fi_before_match / 100.0, 0.0), 1.0) AS score
       FROM int_fatigue_index f JOIN stg_training_sessions s USING (session_id)),
cm AS (SELECT t.threshold,
         COUNT(CASE WHEN score >= t.threshold AND label = 1 THEN 1 END) AS tp,
         COUNT(CASE WHEN score >= t.threshold AND label <> 1 THEN 1 END) AS fp,
         COUNT(CASE WHEN score < t.threshold AND label = 1 THEN 1 END) AS fn,
         COUNT(CASE WHEN score < t.threshold AND label <> 1 THEN 1 END) AS tn
       FROM sc CROSS JOIN (VALUES (0.2), (0.3), (0.4), (0.5)) t(threshold) GROUP BY t.threshold)
"""


def _scores(c):
    s = c.stg_sessions.select("session_id", F.col("injury_risk").alias("label"))
    f = c.fatigue.select("session_id", F.least(F.greatest(F.col("fi_before_match") / F.lit(100.0), F.lit(0.0)),
                                               F.lit(1.0)).alias("score"))
    return f.join(s, "session_id")


def _z(a, b):
    return f"COALESCE(CAST({a} AS DOUBLE) / NULLIF({b}, 0), 0.0)"


@q("ml_9_threshold_sweep", _SCORE_SQL + f"""
SELECT CAST(threshold AS DOUBLE) AS threshold, tp, fp, fn, tn, {_r(_z('tp + tn', 'tp + fp + fn + tn'), 6)} AS accuracy,
       {_r(_z('tp', 'tp + fp'), 6)} AS precision, {_r(_z('tp', 'tp + fn'), 6)} AS recall FROM cm ORDER BY threshold""")
def _(c):
    return M.threshold_sweep(_scores(c), "label", "score")


@q("ml_10_classification_report", _SCORE_SQL + f""",
r AS (SELECT *, {_z('tp', 'tp + fp')} AS p1, {_z('tp', 'tp + fn')} AS r1, {_z('tn', 'tn + fn')} AS p0, {_z('tn', 'tn + fp')} AS r0,
             tp + fn AS s1, tn + fp AS s0, tp + fp + fn + tn AS n FROM cm WHERE threshold = 0.5),
f AS (SELECT *, {_z('2 * p1 * r1', 'p1 + r1')} AS f1_1, {_z('2 * p0 * r0', 'p0 + r0')} AS f1_0 FROM r)
SELECT '0' AS class, {_r('p0', 6)} AS precision, {_r('r0', 6)} AS recall, {_r('f1_0', 6)} AS f1, CAST(s0 AS DOUBLE) AS support FROM f
UNION ALL SELECT '1', {_r('p1', 6)}, {_r('r1', 6)}, {_r('f1_1', 6)}, CAST(s1 AS DOUBLE) FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, {_r(_z('tp + tn', 'n'), 6)}, CAST(n AS DOUBLE) FROM f
UNION ALL SELECT 'macro avg', {_r('(p0 + p1) / 2', 6)}, {_r('(r0 + r1) / 2', 6)}, {_r('(f1_0 + f1_1) / 2', 6)}, CAST(n AS DOUBLE) FROM f
UNION ALL SELECT 'weighted avg', {_r(_z('p0 * s0 + p1 * s1', 'n'), 6)}, {_r(_z('r0 * s0 + r1 * s1', 'n'), 6)},
                 {_r(_z('f1_0 * s0 + f1_1 * s1', 'n'), 6)}, CAST(n AS DOUBLE) FROM f""")
def _(c):
    return M.classification_report(_scores(c), "label", "score", 0.5)


@q("ml_11_kmeans_restarts")
def _(c):
    return MJ.player_clusters(c.mart_player, model=_model(c, "kmeans")).select("player_id", "profil")


def _elbow(c):
    """The curve of this run, fitted once: k_max rows."""
    key = (*c.run_key, "elbow")
    if key not in _MODELS:
        curve = MJ.exploration_report(c.mart_pc)["elbow"]()
        _MODELS[key] = ([tuple(r) for r in curve.collect()], curve.schema)
    return c.spark.createDataFrame(*_MODELS[key])


@q("ml_12_elbow_curve")
def _(c):
    """Inertia for k = 1..10 on the exploration grain (one row per session), one seeded run per k."""
    return _elbow(c)


_GIVEN_CLUSTER = "CASE start_position WHEN 'Bench' THEN 0 WHEN 'F' THEN 1 ELSE 2 END"


def _given_clusters(df):
    """Cluster ids taken from a column, to check the naming/profile operators exactly."""
    return df.withColumn("profil", F.when(F.col("start_position") == "Bench", 0)
                         .when(F.col("start_position") == "F", 1).otherwise(2))


@q("ml_13_cluster_naming", stage_ctes("mart_player") + f""",
g AS (SELECT game_id, player_id, {_GIVEN_CLUSTER} AS profil, performance_score_match FROM mart_player),
lut AS (SELECT profil, CASE row_number() OVER (ORDER BY AVG(performance_score_match) DESC NULLS LAST, profil)
                   WHEN 1 THEN 'Stars' WHEN 2 THEN 'Lieutenants' WHEN 3 THEN 'Rotation' END AS profil_label
        FROM g GROUP BY profil)
SELECT g.profil, g.game_id, g.player_id, g.performance_score_match, lut.profil_label FROM g LEFT JOIN lut USING (profil)""")
def _(c):
    g = _given_clusters(c.mart_player).select("game_id", "player_id", "profil", "performance_score_match")
    return M.name_clusters(g, "profil", "performance_score_match")


_SESSIONS_SQL = stage_ctes("mart_physical_condition") + f""",
g AS (SELECT *, {_GIVEN_CLUSTER} AS profil FROM mart_physical_condition
      WHERE season = '2023-2024' AND """ + " AND ".join(f"{f} IS NOT NULL" for f in _PF) + ")"


def _mode_sql(column: str) -> str:
    return (f"(SELECT player_name, {column} FROM (SELECT player_name, {column}, COUNT(*) AS n FROM g "
            f"WHERE {column} IS NOT NULL GROUP BY ALL) "
            f"QUALIFY row_number() OVER (PARTITION BY player_name ORDER BY n DESC, {column}) = 1)")


def _means_sql(columns, key="player_name") -> str:
    return f"(SELECT {key}, " + ", ".join(f"{_r(f'AVG({f})', 2)} AS {f}" for f in columns) + f" FROM g GROUP BY {key})"


_PROFILE_TABLE_SQL = _SESSIONS_SQL + f""",
prof AS (SELECT player_name, profil, position, start_position, performance_score_match, performance_score_match_min, minutes_played
FROM {_mode_sql('profil')} JOIN {_mode_sql('position')} USING (player_name) JOIN {_mode_sql('start_position')} USING (player_name)
JOIN {_means_sql(['performance_score_match', 'performance_score_match_min', 'minutes_played'])} USING (player_name))
"""


def _report(c, table):
    """A table of the report over clusters taken from a column."""
    return MJ.exploration_report(c.mart_pc, clustered=_given_clusters(MJ.complete_sessions(c.mart_pc)))[table]()


@q("ml_14_cluster_profile_tables", _PROFILE_TABLE_SQL + "SELECT * FROM prof")
def _(c):
    return _report(c, "modal_profile")


@q("pl_14_cluster_means", _SESSIONS_SQL + f"SELECT * FROM {_means_sql(_PF, 'profil')}")
def _(c):
    return _report(c, "cluster_means")


@q("pl_14_players_per_cluster", _SESSIONS_SQL + f"""
SELECT profil, COUNT(*) AS n_players FROM {_mode_sql('profil')} GROUP BY profil ORDER BY profil""")
def _(c):
    return _report(c, "players_per_cluster")


@q("pl_14_player_stats", _SESSIONS_SQL + f"""
SELECT * FROM {_mode_sql('profil')} JOIN {_means_sql(MJ.PLAYER_STATS)} USING (player_name)""")
def _(c):
    return _report(c, "player_stats")


@q("pl_14_regulars", _PROFILE_TABLE_SQL + """
SELECT * FROM prof WHERE minutes_played > 15 ORDER BY performance_score_match_min DESC NULLS LAST, player_name""")
def _(c):
    return _report(c, "regulars")


@q("pl_14_top_by_profile", _PROFILE_TABLE_SQL + """
SELECT * FROM prof WHERE profil IN (0, 1)
QUALIFY row_number() OVER (PARTITION BY profil ORDER BY performance_score_match_min DESC NULLS LAST, player_name) <= 5""")
def _(c):
    return _report(c, "top_by_profile")


@q("pl_14_describe", stage_ctes("mart_physical_condition") + "\nUNION ALL\n".join(f"""
SELECT '{f}' AS column, COUNT({f}) AS count, {_r(f'AVG({f})', 8)} AS mean, {_r(f'STDDEV_SAMP({f})', 8)} AS std,
       CAST(MIN({f}) AS DOUBLE) AS min, {_r(f'quantile_cont({f}, 0.25)', 8)} AS p25, {_r(f'quantile_cont({f}, 0.5)', 8)} AS p50,
       {_r(f'quantile_cont({f}, 0.75)', 8)} AS p75, CAST(MAX({f}) AS DOUBLE) AS max FROM mart_physical_condition""" for f in _PF))
def _(c):
    d = _report(c, "describe")
    return d.select("column", "count", *[X.round_half_up(x, 8).alias(x) for x in ("mean", "std")], "min",
                    *[X.round_half_up(x, 8).alias(x) for x in ("p25", "p50", "p75")], "max")


@q("pl_14_null_counts", stage_ctes("mart_physical_condition") + "\nUNION ALL\n".join(
    f"SELECT '{f}' AS column, COUNT(*) - COUNT({f}) AS n_null FROM mart_physical_condition" for f in MART_PC_COLUMNS))
def _(c):
    return _report(c, "null_counts")


@q("ml_15_injury_scoring_table")
def _(c):
    return MJ.injury_scoring(c.mart_pc, model=_model(c, "gbt"))


@q("ml_16_player_cluster_table")
def _(c):
    return MJ.player_clusters(c.mart_player, model=_model(c, "kmeans"))


@q("pl_12_injury_prevention")
def _(c):
    path = c.scratch("ml_injury_predictions")
    S.write_table(MJ.injury_scoring(c.mart_pc, model=_model(c, "gbt")), path)     # truncate + replace
    return S.read_table(c.spark, path)


@q("pl_13_player_profiling")
def _(c):
    path = c.scratch("ml_player_clusters")
    S.write_table(MJ.player_clusters(c.mart_player, model=_model(c, "kmeans")), path)
    return S.read_table(c.spark, path)


@q("pl_14_exploration_report")
def _(c):
    return MJ.exploration_report(c.mart_pc)["top_by_profile"]()


# ------------------------------------------------------------------ what must hold of fitted models, whatever they learn


def _holds(*rules: str) -> str:
    return "\nUNION ALL\n".join(f"SELECT '{r}' AS rule, CAST(0 AS BIGINT) AS failing_rows" for r in rules)


def _failing(rules: dict):
    """(rule, failing_rows) of frames of the rows that break each rule."""
    parts = [bad.agg(F.count(F.lit(1)).alias("failing_rows")).select(F.lit(rule).alias("rule"), "failing_rows") for rule, bad in rules.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def _other_keys(a, b, keys):
    """Keys of one frame that the other lacks or has more often."""
    count = lambda df: df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return count(a).exceptAll(count(b)).unionByName(count(b).exceptAll(count(a)))


def _no_probability(df, column):
    return df.filter(F.col(column).isNull() | F.isnan(column) | ~F.col(column).between(0, 1))


@q("ml_6_tree_invariants", _holds("a score for every test row", "scores are probabilities", "scores differ", "positives score higher"))
def _(c):
    _, test = _injury_train_test(c)
    columns = ["session_id", "injury_risk", "is_test", "p"]
    every = staged(M.positive_probability(_model(c, "gbt"), _injury_rows(c), MJ.model_columns(), "p").select(*columns), "tree_scores")   # once for all rules
    scored = every.filter("is_test")
    ends = scored.agg(F.min("p").alias("least"), F.max("p").alias("most"))
    train = every.filter("not is_test").agg(
        F.avg(F.when(F.col("injury_risk") == 1, F.col("p"))).alias("one"), F.avg(F.when(F.col("injury_risk") == 0, F.col("p"))).alias("zero"))
    return _failing({"a score for every test row": _other_keys(test, scored, ["session_id"]), "scores are probabilities": _no_probability(scored, "p"),
                     "scores differ": ends.filter("least >= most"), "positives score higher": train.filter("one <= zero")})


@q("ml_7_forest_invariants", _holds("a score for every test row", "scores are probabilities", "scores differ"))
def _(c):
    test = MJ.injury_split(c.mart_pc, epsilon=0.0, features=MJ.EXPLORATION_INJURY_FEATURES).filter("is_test")
    scored = _forest_scores(c)
    return _failing({"a score for every test row": _other_keys(test, scored, ["session_id"]), "scores are probabilities": _no_probability(scored, "injury_probability"),
                     "scores differ": scored.agg(F.min("injury_probability").alias("a"), F.max("injury_probability").alias("b")).filter("a >= b")})


@q("ml_15_scoring_invariants", _holds("a score for every session", "the probability to 4 places", "alert at 0.20 and above", "reduction follows its band", "stored as scored"))
def _(c):
    features = MJ.injury_features(c.mart_pc)
    plain = M.positive_probability(_model(c, "gbt"), features, MJ.model_columns(), "p").select(F.col("session_id").alias("s"), "p")
    table = MJ.injury_scoring(c.mart_pc, model=_model(c, "gbt"))
    both = table.join(plain, table["session_id"] == plain["s"])
    band = F.when(F.col("p") >= 0.7, 80).when(F.col("p") >= 0.5, 50).when(F.col("p") >= 0.2, 15).otherwise(0)
    path = c.scratch("ml_injury_predictions")
    S.write_table(table, path)
    return _failing({"a score for every session": _other_keys(features, table, ["session_id"]),
                     "the probability to 4 places":
                         both.filter(F.abs(F.col("injury_probability") - F.col("p")) > 0.00005001),
                     "alert at 0.20 and above": both.filter((F.col("injury_alert") == 1) != (F.col("p") >= 0.2)),
                     "reduction follows its band": both.filter(~F.col("training_intensity_reduction").eqNullSafe(band)),
                     "stored as scored": _other_keys(S.read_table(c.spark, path), table, table.columns)})


@q("ml_11_cluster_invariants", _holds("a cluster for every player", "clusters are 0, 1 and 2", "every player is nearest its centre", "labels follow the mean score", "stored as clustered"))
def _(c):
    model, z = _model(c, "kmeans"), MJ.scaled_profiles(c.mart_player)
    columns = [f + "_z" for f in _PF]
    placed = M.assign_clusters(model, z, columns)
    away = [sum((F.col(x) - F.lit(float(v))) ** 2 for x, v in zip(columns, centre, strict=True)) for centre in model.clusterCenters()]
    own = F.element_at(F.array(*away), F.col("profil") + 1)
    table = MJ.player_clusters(c.mart_player, model=model)
    means = table.groupBy("profil_label").agg(F.avg("performance_score_match").alias("m"))
    place = F.array_position(F.array(*[F.lit(x) for x in M.PROFILE_LABELS]), F.col("profil_label"))
    ranked = means.select("m", place.alias("place"))
    later = ranked.alias("a").join(ranked.alias("b"), F.expr("b.place = a.place + 1 and b.m > a.m"))   # a row a label
    path = c.scratch("ml_player_clusters")
    S.write_table(table, path)
    return _failing({"a cluster for every player": _other_keys(z, placed, ["player_id"]), "clusters are 0, 1 and 2": placed.filter(~F.col("profil").isin(0, 1, 2)),
                     "every player is nearest its centre": placed.filter(own > F.least(*away) + 1e-9), "labels follow the mean score": later,
                     "stored as clustered": _other_keys(S.read_table(c.spark, path), table, table.columns)})


@q("ml_12_elbow_invariants", _holds("a cost for k of 1 to 10", "costs are not negative", "one cluster costs the sum of squares", "ten clusters cost less than one"))
def _(c):
    curve, z = _elbow(c), MJ.scaled_sessions(c.mart_pc)
    whole = z.agg(reduce(lambda a, b: a + b, [F.var_pop(f + "_z") * F.count(f + "_z") for f in _PF]).alias("squares"))
    ks = c.spark.range(1, 11).select(F.col("id").cast("int").alias("k"))
    ends = curve.agg(F.max(F.when(F.col("k") == 1, F.col("wcss"))).alias("one"), F.max(F.when(F.col("k") == 10, F.col("wcss"))).alias("ten"))
    return _failing({"a cost for k of 1 to 10": _other_keys(ks, curve, ["k"]), "costs are not negative": curve.filter("wcss < 0"),
                     "one cluster costs the sum of squares": curve.filter("k = 1").crossJoin(whole).filter("abs(wcss - squares) > 1e-6 * squares"),
                     "ten clusters cost less than one": ends.filter("ten >= one")})


@q("pl_14_report_invariants", _holds("counts add up", "recall does not rise", "at most five a cluster", "only named clusters"))
def _(c):
    sweep = M.threshold_sweep(_forest_scores(c), "injury_risk", "injury_probability")
    rows = MJ.injury_split(c.mart_pc, epsilon=0.0, features=MJ.EXPLORATION_INJURY_FEATURES).filter("is_test").agg(F.count(F.lit(1)).alias("rows"))
    best = MJ.exploration_report(c.mart_pc)["top_by_profile"]()
    return _failing({"counts add up": sweep.crossJoin(rows).filter("tp + fp + fn + tn != rows"),
                     "recall does not rise": sweep.alias("a").join(sweep.alias("b"), F.expr("a.threshold < b.threshold and a.recall < b.recall")),
                     "at most five a cluster": best.groupBy("profil").agg(F.count(F.lit(1)).alias("n")).filter("n > 5"),
                     "only named clusters": best.filter(~F.col("profil").isin(0, 1))})
