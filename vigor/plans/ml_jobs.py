"""ML pipelines PL-12 (injury scoring), PL-13 (player profiling), PL-14 (exploration)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import ml as M
from ..operators import relational as R

# Model inputs of the production injury model, of the profiling
# model and of the exploration's injury models, the report's player statistics,
# target season and alert threshold.
INJURY_FEATURES = ["fi_before_match", "fi_avg_7d", "fi_max_7d", "training_load_7d", "fi_avg_28d",
                   "training_load_28d", "focus_level", "minutes_played", "position"]
INJURY_LABEL = "injury_risk"
PROFILE_FEATURES = ["points", "assists", "total_rebounds", "steals", "blocks", "turnover", "player_fault", "plus_minus"]
EXPLORATION_INJURY_FEATURES = ["position", "fi_last_training", "fi_before_match", "acwr", "fi_max_7d", "training_load_7d",
                               "training_load_28d", "recovery_needed_last_training", "rs_last_training", "focus_level",
                               "minutes_played"]
PLAYER_STATS = ["plus_minus", "points", "total_rebounds", "assists", "blocks", "steals", "minutes_played",
                "performance_score_match_min"]
TARGET_SEASON = "2023-2024"
ALERT_THRESHOLD = 0.20


def injury_features(mart_pc: DataFrame, season: str = TARGET_SEASON, epsilon: float = 1e-9,
                    features: list[str] = INJURY_FEATURES) -> DataFrame:
    """Season filter, complete rows only, encoded position, acute:chronic ratio (FLT-4/5, ML-1, FN-21).

    ``epsilon`` 0 gives the raw ratio, NULL for a zero chronic load; such a
    row is incomplete where ``features`` name the ratio.
    """
    df = mart_pc.filter(F.col("season") == season) \
                .withColumn("acwr", X.acute_chronic_ratio("fi_avg_7d", "fi_avg_28d", epsilon))
    return M.label_encode(df.na.drop(subset=features + [INJURY_LABEL]), "position", "position_code")


def model_columns(features: list[str] = INJURY_FEATURES) -> list[str]:
    columns = [c if c != "position" else "position_code" for c in features]
    return columns if "acwr" in columns else columns + ["acwr"]


def injury_split(mart_pc: DataFrame, season: str = TARGET_SEASON, test_fraction: float = 0.2,
                 seed: int = 42, epsilon: float = 1e-9, features: list[str] = INJURY_FEATURES) -> DataFrame:
    return M.hash_split(injury_features(mart_pc, season, epsilon, features), ["session_id"], test_fraction, seed)


def fit_injury_model(split: DataFrame, seed: int = 42, **gbt_params):
    """Boosted trees on the training part, positives weighted by neg/pos (ML-4, ML-6)."""
    train = split.filter(~F.col("is_test"))
    train = M.with_pos_weight(train, INJURY_LABEL, train)
    return M.fit_gbt(train, model_columns(), INJURY_LABEL, weight="weight", seed=seed, **gbt_params)


def injury_scoring(mart_pc: DataFrame, season: str = TARGET_SEASON, test_fraction: float = 0.2,
                   seed: int = 42, model=None, **gbt_params) -> DataFrame:
    """PL-12 / ML-15: fit on the hashed 80 %, score every row, alert + intensity band."""
    feats = model_columns()
    df = injury_split(mart_pc, season, test_fraction, seed)
    model = model or fit_injury_model(df, seed, **gbt_params)
    scored = M.positive_probability(model, df, feats, "p")
    p = X.round_half_up("p", 4)
    return scored.select(F.col("player_id").cast("string").alias("player_id"), "session_id", "season",
                         p.alias("injury_probability"),
                         X.alert_flag("p", ALERT_THRESHOLD).alias("injury_alert"),
                         X.intensity_reduction("p").alias("training_intensity_reduction"))


def player_profiles(mart_player: DataFrame, season: str = TARGET_SEASON, min_minutes: float = 5.0) -> DataFrame:
    """Per (season, player): modal labels by MAX, mean stats, 3 rounded means (AGG-2)."""
    df = mart_player.filter((F.col("minutes_played") >= min_minutes) & (F.col("season") == season))
    return df.groupBy("season", "player_id", "player_name").agg(
        F.max("position").alias("position"), F.max("start_position").alias("start_position"),
        *[F.avg(c).alias(c) for c in PROFILE_FEATURES],
        X.round_half_up(F.avg("performance_score_match"), 2).alias("performance_score_match"),
        X.round_half_up(F.avg("performance_score_match_min"), 2).alias("performance_score_match_min"),
        X.round_half_up(F.avg("minutes_played"), 2).alias("minutes_played"))


def scaled_profiles(mart_player: DataFrame, season: str = TARGET_SEASON) -> DataFrame:
    prof = player_profiles(mart_player, season).na.fill(0.0, subset=PROFILE_FEATURES)
    return M.standardize(prof, PROFILE_FEATURES, suffix="_z")


def fit_profile_model(z: DataFrame, k: int = 3, n_init: int = 10, seed: int = 42):
    return M.kmeans_best_of(z, [c + "_z" for c in PROFILE_FEATURES], k=k, n_init=n_init, seed=seed)


def player_clusters(mart_player: DataFrame, season: str = TARGET_SEASON, k: int = 3, n_init: int = 10,
                    seed: int = 42, model=None) -> DataFrame:
    """PL-13 / ML-16: profile -> fill 0 -> z-score -> best-of-10 k-means -> ranked names."""
    z = scaled_profiles(mart_player, season)
    zcols = [c + "_z" for c in PROFILE_FEATURES]
    model = model or fit_profile_model(z, k, n_init, seed)
    clustered = M.assign_clusters(model, z, zcols, "profil").drop(*zcols)
    named = M.name_clusters(clustered, "profil", "performance_score_match")
    return named.select("season", F.col("player_id").cast("string").alias("player_id"), "player_name", "position",
                        "start_position", "profil", "profil_label", "performance_score_match",
                        "performance_score_match_min", "minutes_played")


# ------------------------------------------------------------------ PL-14 exploration

def cluster_profile_table(clustered: DataFrame, features: list[str]) -> DataFrame:
    """Rounded mean of the features per profile label (AGG-9)."""
    return R.group_mean(clustered, ["profil_label"], features, scale=2)


def complete_sessions(mart_pc: DataFrame, season: str = TARGET_SEASON,
                      features: list[str] = PROFILE_FEATURES) -> DataFrame:
    """Exploration grain: one row per session of the season, complete in ``features`` (T34)."""
    return mart_pc.filter(F.col("season") == season).na.drop(subset=features)


def scaled_sessions(mart_pc: DataFrame, season: str = TARGET_SEASON,
                    features: list[str] = PROFILE_FEATURES) -> DataFrame:
    return M.standardize(complete_sessions(mart_pc, season, features), features, suffix="_z")


def session_clusters(mart_pc: DataFrame, season: str = TARGET_SEASON, features: list[str] = PROFILE_FEATURES,
                     k: int = 3, n_init: int = 1, seed: int = 42) -> DataFrame:
    """Sessions with the cluster (``profil``) of one seeded k-means run over the scaled features."""
    z = scaled_sessions(mart_pc, season, features)
    zcols = [c + "_z" for c in features]
    model = M.kmeans_best_of(z, zcols, k=k, n_init=n_init, seed=seed)
    return M.assign_clusters(model, z, zcols, "profil").drop(*zcols)


def cluster_means(rows: DataFrame, features: list[str] = PROFILE_FEATURES) -> DataFrame:
    """Rounded mean of the features per cluster (AGG-8)."""
    return R.group_mean(rows, ["profil"], features, scale=2)


def players_per_cluster(rows: DataFrame) -> DataFrame:
    """Number of players by modal cluster (AGG-6, AGG-10)."""
    return R.value_counts(R.mode_per_group(rows, ["player_name"], "profil"), "profil", "n_players")


def player_stats(rows: DataFrame) -> DataFrame:
    """Modal cluster and mean match statistics per player (ML-14)."""
    return R.mode_per_group(rows, ["player_name"], "profil") \
            .join(R.group_mean(rows, ["player_name"], PLAYER_STATS, scale=2), "player_name")


def modal_profile(rows: DataFrame) -> DataFrame:
    """Per player: modal cluster, modal position and start position, mean performance (ML-14)."""
    modes = R.modes_per_group(rows, ["player_name"], ["position", "start_position"])
    perf = R.group_mean(rows, ["player_name"], ["performance_score_match", "performance_score_match_min",
                                                "minutes_played"], scale=2)
    return R.mode_per_group(rows, ["player_name"], "profil").join(modes, "player_name").join(perf, "player_name")


def regulars(profiles: DataFrame, min_minutes: float = 15.0) -> DataFrame:
    """Players above a mean of ``min_minutes``, best performance per minute first (FLT-8, SRT-1)."""
    return profiles.filter(F.col("minutes_played") > min_minutes) \
                   .orderBy(F.col("performance_score_match_min").desc_nulls_last(), "player_name")


def top_by_profile(profiles: DataFrame, n: int = 5, clusters: tuple[int, ...] = (0, 1)) -> DataFrame:
    """The n best players per minute of each named cluster (FLT-7, WIN-10)."""
    return R.top_n_per_group(profiles.filter(F.col("profil").isin(*clusters)), ["profil"],
                             [F.col("performance_score_match_min").desc_nulls_last(), F.col("player_name")], n)


def exploration_report(mart_pc: DataFrame, season: str = TARGET_SEASON, features: list[str] = PROFILE_FEATURES,
                       k: int = 3, seed: int = 42, clustered: DataFrame | None = None) -> dict[str, Callable[[], DataFrame]]:
    """PL-14: the tables of the profiling report by name, each built when it is called, all over one clustering.

    ``clustered`` are sessions with a cluster (``profil``) where there is one already.
    """
    fitted: list[DataFrame] = [] if clustered is None else [clustered]

    def rows() -> DataFrame:
        if not fitted:
            fitted.append(session_clusters(mart_pc, season, features, k, seed=seed))
        return fitted[0]

    return {"describe": lambda: R.describe_columns(mart_pc, features), "null_counts": lambda: R.null_counts(mart_pc),
            "elbow": lambda: M.elbow(scaled_sessions(mart_pc, season, features), [c + "_z" for c in features], n_init=1),
            "cluster_means": lambda: cluster_means(rows(), features), "players_per_cluster": lambda: players_per_cluster(rows()),
            "player_stats": lambda: player_stats(rows()), "modal_profile": lambda: modal_profile(rows()),
            "regulars": lambda: regulars(modal_profile(rows())), "top_by_profile": lambda: top_by_profile(modal_profile(rows()))}
