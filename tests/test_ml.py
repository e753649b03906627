"""ML operators: exact pieces and invariants."""

from pyspark.sql import functions as F

from vigor.operators import ml as M


def test_label_encode_sorted(spark):
    df = spark.createDataFrame([("Guard",), ("Center",), ("Forward",), ("Guard",)], "p string")
    got = sorted(set(tuple(r) for r in M.label_encode(df, "p", "code").collect()))
    assert got == [("Center", 0), ("Forward", 1), ("Guard", 2)]


def test_standardize_population_sigma(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, b double")
    got = [(round(r.a, 12), r.b) for r in M.standardize(df, ["a", "b"]).orderBy("a").collect()]
    s = (2 / 3) ** 0.5
    assert got == [(round(-1 / s, 12), 0.0), (0.0, 0.0), (round(1 / s, 12), 0.0)]


def test_hash_split_is_stable(spark):
    df = spark.range(2000).withColumn("key", F.col("id").cast("string"))
    a = M.hash_split(df, ["key"]).filter("is_test").select("id").collect()
    b = M.hash_split(df.repartition(7), ["key"]).filter("is_test").select("id").collect()
    assert sorted(a) == sorted(b) and 300 < len(a) < 500


def test_threshold_sweep_zero_denominators(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.15), (1, 0.9)], "y int, s double")
    rows = {r.threshold: r for r in M.threshold_sweep(df, "y", "s").collect()}
    assert rows[0.2].precision == 1.0 and rows[0.2].recall == 1.0 and rows[0.2].accuracy == 1.0
    df0 = spark.createDataFrame([(0, 0.1)], "y int, s double")
    r0 = M.threshold_sweep(df0, "y", "s").first()
    assert (r0.precision, r0.recall) == (0.0, 0.0)


def test_elbow_k1_and_monotone(spark):
    rows = [(float(x), float(y)) for x, y in [(0, 0), (0, 1), (1, 0), (10, 10), (10, 11), (11, 10), (20, 0), (21, 0), (20, 1)]]
    df = spark.createDataFrame(rows, "x double, y double")
    e = [r.wcss for r in M.elbow(df, ["x", "y"], k_max=4, n_init=2).orderBy("k").collect()]
    xs, ys = [r[0] for r in rows], [r[1] for r in rows]
    k1 = sum((v - sum(xs) / 9) ** 2 for v in xs) + sum((v - sum(ys) / 9) ** 2 for v in ys)
    assert abs(e[0] - k1) < 1e-9
    assert all(a >= b - 1e-9 for a, b in zip(e, e[1:]))


def test_kmeans_same_seed_same_clusters(spark):
    rows = [(float(i % 3) * 10 + (i % 5) * 0.1, float(i % 3)) for i in range(60)]
    df = spark.createDataFrame(rows, "x double, y double")
    m1 = M.kmeans_best_of(df, ["x", "y"], k=3, n_init=2)
    m2 = M.kmeans_best_of(df, ["x", "y"], k=3, n_init=2)
    # same seed -> same clustering up to label permutation (restarts whose costs tie within the
    # last bits may be picked in either order, which only renames the clusters)
    def partition(model):
        groups = {}
        for i, r in enumerate(M.assign_clusters(model, df, ["x", "y"]).collect()):
            groups.setdefault(r.profil, set()).add(i)
        return sorted(sorted(g) for g in groups.values())
    assert partition(m1) == partition(m2)
    assert abs(m1.summary.trainingCost - m2.summary.trainingCost) < 1e-9


def test_name_clusters_by_rank(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 3.0), (1, 10.0), (2, 5.0), (3, 0.0)], "c int, perf double")
    labels = [*M.PROFILE_LABELS, "Others"]      # every group needs a label; a missing one fails (test_skew_and_ingest)
    got = dict((r.c, r.profil_label) for r in M.name_clusters(df, "c", "perf", labels).collect())
    assert got == {1: "Stars", 2: "Lieutenants", 0: "Rotation", 3: "Others"}


def test_injury_scoring_invariants(spark):
    """Every eligible session scored once, probabilities in [0, 1], alert <=> reduction > 0.

    A 5-tree model keeps the test fast; the pipeline default stays 200 trees.
    """
    from conftest import SF_SMALL
    from vigor.plans import ml_jobs as MJ
    from vigor.plans.registry import Ctx
    c = Ctx(spark, SF_SMALL)
    out = MJ.injury_scoring(c.mart_pc, maxIter=5).cache()
    eligible = MJ.injury_features(c.mart_pc)
    assert out.count() == eligible.count() == out.select("session_id").distinct().count()
    bad = out.filter((F.col("injury_probability") < 0) | (F.col("injury_probability") > 1)
                     | ((F.col("injury_alert") == 1) != (F.col("training_intensity_reduction") > 0)))
    assert bad.count() == 0
    assert dict(out.dtypes)["player_id"] == "string"


def test_player_clusters_labels_follow_rank(spark):
    from conftest import SF_SMALL
    from vigor.plans import ml_jobs as MJ
    from vigor.plans.registry import Ctx
    c = Ctx(spark, SF_SMALL)
    out = MJ.player_clusters(c.mart_player, n_init=2)
    means = {r.profil_label: r.m for r in out.groupBy("profil_label").agg(F.avg("performance_score_match").alias("m")).collect()}
    order = [lbl for lbl in M.PROFILE_LABELS if lbl in means]
    assert [means[lbl] for lbl in order] == sorted(means.values(), reverse=True)


def test_exploration_features_use_the_raw_ratio(spark):
    from vigor.plans import ml_jobs as MJ
    names = sorted(set(MJ.INJURY_FEATURES + MJ.EXPLORATION_INJURY_FEATURES + ["session_id", "season", "injury_risk"]) - {"acwr"})
    base = {n: 2.0 for n in names} | {"session_id": "a", "season": MJ.TARGET_SEASON, "position": "G", "injury_risk": 1}
    rows = [base, base | {"session_id": "b", "fi_avg_28d": 0.0}, base | {"session_id": "c", "focus_level": None},
            base | {"session_id": "d", "season": "2022-2023"}]
    types = {"session_id": "string", "season": "string", "position": "string", "injury_risk": "int"}
    df = spark.createDataFrame([tuple(r[n] for n in names) for r in rows],
                               ", ".join(f"{n} {types.get(n, 'double')}" for n in names))
    out = MJ.injury_features(df, epsilon=0.0, features=MJ.EXPLORATION_INJURY_FEATURES)
    assert [(r.session_id, r.acwr) for r in out.collect()] == [("a", 1.0)]
    columns = MJ.model_columns(MJ.EXPLORATION_INJURY_FEATURES)
    assert len(columns) == 11 and set(columns) <= set(out.columns)


def test_fits_have_no_more_partitions_than_rows_or_cores_ask_for(spark):
    """A small cached frame has few partitions, whatever the number of shuffle partitions."""
    class Estimator:
        def fit(self, data):
            return data.rdd.getNumPartitions(), data.count()

    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        df = spark.range(6000).select((F.col("id") % 900).alias("g"), F.col("id").cast("double").alias("x")).groupBy("g").agg(F.sum("x").alias("x"))
        assert M._fit(Estimator(), df.withColumn("y", F.lit(1)), ["x"], "y", None) == (1, 900)
        kept = M._kept(M.assemble(df, ["x"]).select("features"), "few")
        assert (kept.rdd.getNumPartitions(), kept.count()) == (1, 900)
        kept.unpersist()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert [M.fit_partitions(n, 12) for n in (0, 1, 5001, 500_000, 30_000_000)] == [1, 1, 2, 12, 30]
