"""Machine-learning operators (ML-1 ... ML-16) on ``pyspark.ml``.

Frames are never collected: features stay in Spark, only model metadata
(label lists, centres, k-row aggregates) reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..session import save, shuffles_freed
from . import forest
from .ranks import ranked, scratch, staged
from .sinks import remove

# ------------------------------------------------------------------ ML-1


def label_encode(df: DataFrame, column: str, output: str | None = None) -> DataFrame:
    """Index of the value in sorted distinct order, 0-based (ML-1, sklearn LabelEncoder); NULL comes after all values.

    The codes are a distributed rank of the distinct values, joined back: no
    value reaches the driver, and Spark broadcasts the codes only if they are small.
    """
    output = output or column
    codes = ranked(df.select(F.col(column).alias("__value")).distinct(), [F.col("__value").asc_nulls_last()], name="__code")
    joined = df.join(codes, F.col(column).eqNullSafe(F.col("__value")), "left").withColumn("__code", F.col("__code").cast("int"))
    return joined.drop("__value", *([column] if output == column else [])).withColumnRenamed("__code", output)


# ------------------------------------------------------------------ ML-2


def standardize(df: DataFrame, columns: list[str], suffix: str = "") -> DataFrame:
    """z-score with the population sigma; sigma 0 -> 0 (ML-2, sklearn StandardScaler).

    One aggregate row of (mean, stddev_pop) per column, broadcast to the rows.
    """
    stats = df.agg(*[F.avg(c).alias(f"__m_{i}") for i, c in enumerate(columns)],
                   *[F.stddev_pop(c).alias(f"__s_{i}") for i, c in enumerate(columns)])
    j = df.crossJoin(F.broadcast(stats))
    for i, c in enumerate(columns):
        z = F.when(F.col(f"__s_{i}") > 0, (F.col(c) - F.col(f"__m_{i}")) / F.col(f"__s_{i}")).otherwise(F.lit(0.0))
        j = j.withColumn(c + suffix, z)
    return j.drop(*[f"__m_{i}" for i in range(len(columns))], *[f"__s_{i}" for i in range(len(columns))])


# ------------------------------------------------------------------ ML-3


def hash_split(df: DataFrame, key_cols: list[str], test_fraction: float = 0.2, seed: int = 42,
               flag: str = "is_test") -> DataFrame:
    """Reproducible train/test flag from the MD5 of the row key and seed (ML-3).

    Unlike ``randomSplit`` the assignment does not depend on partitioning or
    on re-computation after an executor loss.
    """
    key = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key_cols])
    bucket = F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("long") % 10000
    return df.withColumn(flag, bucket < F.lit(int(round(test_fraction * 10000))))


# ------------------------------------------------------------------ ML-4 / ML-5


def positive_weight(df: DataFrame, label: str) -> DataFrame:
    """One row: negatives / positives (ML-4 ``scale_pos_weight``)."""
    return df.agg(F.try_divide(F.count_if(F.col(label) == 0).cast("double"), F.count_if(F.col(label) == 1))
                  .alias("pos_weight"))


def with_pos_weight(df: DataFrame, label: str, weight_from: DataFrame, out: str = "weight") -> DataFrame:
    """weight = neg/pos for positives, 1 for negatives (ML-4)."""
    w = F.broadcast(positive_weight(weight_from, label))
    return df.crossJoin(w).withColumn(out, F.when(F.col(label) == 1, F.coalesce(F.col("pos_weight"), F.lit(1.0)))
                                      .otherwise(F.lit(1.0))).drop("pos_weight")


def with_balanced_weight(df: DataFrame, label: str, weight_from: DataFrame | None = None,
                         out: str = "weight") -> DataFrame:
    """weight = n / (n_classes * n_class) (ML-5, ``class_weight='balanced'``)."""
    src = weight_from if weight_from is not None else df
    per = src.groupBy(label).agg(F.count(F.lit(1)).alias("__nc"))
    tot = src.agg(F.count(F.lit(1)).alias("__n"), F.countDistinct(label).alias("__k"))
    w = per.crossJoin(tot).select(label, (F.col("__n") / (F.col("__k") * F.col("__nc"))).alias(out))
    return df.join(w, label, "left")


# ------------------------------------------------------------------ ML-6 / ML-7 / ML-8

# Boosted-tree hyper-parameters of the injury model.
GBT_PARAMS = {"maxIter": 200, "maxDepth": 5, "stepSize": 0.05, "subsamplingRate": 0.8,
              "featureSubsetStrategy": "0.8", "seed": 42}
# Five levels are walked again faster than node ids are kept between them (same trees); the lineage of the
# rounds' predictions is cut in the shared folder every so many rounds.
GBT_RUN = {"cacheNodeIds": False, "checkpointInterval": 10}


def assemble(df: DataFrame, features: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol=out, handleInvalid="keep").transform(df)


def fit_gbt(train: DataFrame, features: list[str], label: str, weight: str | None = None, **params):
    p = {**GBT_PARAMS, **GBT_RUN, **params}
    gbt = GBTClassifier(featuresCol="features", labelCol=label, **p)
    if weight:
        gbt = gbt.setWeightCol(weight)
    return _fit(gbt, train, features, label, weight)


#: Rows of a fit's partition: fewer aren't worth a task, more don't fit one; between them there is a partition a core.
FIT_ROWS = (5_000, 1_000_000)


def fit_partitions(rows: int, cores: int) -> int:
    """Partitions of a fit over so many rows: a round of it is a few jobs, whose tasks cost more than their rows if they are many."""
    least, most = FIT_ROWS
    return max(1, min(-(-rows // least), cores), -(-rows // most))


def _kept(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """The rows of a fit, computed once and kept for its rounds in partitions of like size.

    AQE doesn't coalesce the partitions of a cached frame: without this there are
    ``spark.sql.shuffle.partitions`` of them, however few the rows.
    """
    rows = staged(df, name, path)
    return rows.repartition(fit_partitions(rows.count(), df.sparkSession.sparkContext.defaultParallelism)).persist()


@contextmanager
def _during_fit(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """The rows of a fit, which go after it, the stored ones too."""
    path = scratch(df.sparkSession, name)
    kept = _kept(df, name, path)
    try:
        yield kept
    finally:
        kept.unpersist()
        remove(df.sparkSession, path)


def _fit(estimator, train: DataFrame, features: list[str], label: str, weight: str | None):
    """Fit on the model's columns only."""
    data = assemble(train, features).withColumn(label, F.col(label).cast("double"))
    with _during_fit(data.select("features", label, *([weight] if weight else [])), "train") as data:
        return estimator.fit(data)


#: Bytes of rows that the trees grown at the same time send to their tasks.
FOREST_BYTES = 16 << 30


def forest_probability(df: DataFrame, features: list[str], label: str, key: str, flag: str = "is_test", out: str = "probability_1",
                       num_trees: int = 200, max_depth: int = 30, max_bins: int = 32, seed: int = 42, local_rows: int = forest.LOCAL_ROWS) -> DataFrame:
    """Rows with ``flag`` and P(class 1) by a random forest with balanced classes over the rows without it (ML-7, ML-5).

    sklearn's unbounded depth is made explicit.  Returned are ``key``, ``label``, the features and ``out``, stored: there is no model to keep.
    """
    rows = df.select(key, label, flag, *[F.col(f).cast("double").alias(f) for f in features], F.monotonically_increasing_id().alias("__row"))
    spark, folder, sums = df.sparkSession, scratch(df.sparkSession, "forest"), scratch(df.sparkSession, "forest_sums")
    rows = staged(rows, "forest", folder)
    try:
        train = rows.filter(~F.col(flag))
        with shuffles_freed(spark):
            counts = with_balanced_weight(train, label).groupBy(label).agg(F.first("weight"), F.count(F.lit(1))).collect()
            n_test = rows.filter(flag).count()
        classes = {r[0]: r[1:] for r in counts}
        if not classes or not set(classes) <= {0, 1}:
            raise ValueError(f"classes to learn are {sorted(map(str, classes))}, not 0 and 1")
        weights = tuple(classes.get(c, (0.0, 0))[0] for c in (0, 1))
        bounds = forest.edges(train, features, max_bins)
        seen = rows.select(F.col("__row").alias("row"), F.xxhash64(F.lit(seed), F.col(key)).alias("hash"),
                           F.when(F.col(flag), -1).otherwise(F.col(label)).cast("int").alias("label"),
                           *[F.col(f).alias(f"x{i}") for i, f in enumerate(features)])
        roots = forest.roots(seed, num_trees)
        n_train = sum(n for _, n in classes.values())
        tops = forest.tops(seen, bounds, n_train, weights, roots, max_depth, max_bins, local_rows)
        at_once = max(1, FOREST_BYTES // forest.tree_bytes(len(features), n_train, n_test))
        for first in range(0, num_trees, at_once):
            shares = forest.shares(seen, bounds, tops, weights, roots, max_depth, range(first, min(first + at_once, num_trees)))
            save(shares.groupBy("row").agg(F.sum("share").alias("share")), sums, "append")
        mean = spark.read.schema("row long, share long").parquet(sums).groupBy("row").agg((F.sum("share") / F.lit(float(num_trees * forest.UNIT))).alias(out))
        scored = rows.filter(flag).join(mean.withColumnRenamed("row", "__row"), "__row", "left")
        return staged(scored.select(key, label, *features, out), "forest_scores")
    finally:
        remove(spark, folder)
        remove(spark, sums)


def positive_probability(model, df: DataFrame, features: list[str], out: str = "probability_1") -> DataFrame:
    """P(class 1) for every row (ML-8)."""
    scored = model.transform(assemble(df, features))
    return scored.withColumn(out, vector_to_array("probability")[1]) \
                 .drop("features", "rawPrediction", "probability", "prediction")


# ------------------------------------------------------------------ ML-9 / ML-10

DEFAULT_THRESHOLDS = (0.2, 0.3, 0.4, 0.5)


def confusion_by_threshold(df: DataFrame, label: str, score: str, thresholds=DEFAULT_THRESHOLDS) -> DataFrame:
    """TP/FP/FN/TN per threshold in ONE aggregate pass (4 counts per threshold), unpivoted.

    No row is replicated per threshold: the thresholds are literals inside
    the aggregate, so the work is one scan regardless of how many are swept.
    """
    y = F.col(label) == 1
    s = F.col(score)
    aggs = []
    for i, t in enumerate(thresholds):
        pred = s >= F.lit(float(t))
        aggs += [F.count_if(pred & y).alias(f"tp{i}"), F.count_if(pred & ~y).alias(f"fp{i}"),
                 F.count_if(~pred & y).alias(f"fn{i}"), F.count_if(~pred & ~y).alias(f"tn{i}")]
    row = df.agg(*aggs)
    items = F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.col(f"tp{i}").alias("tp"), F.col(f"fp{i}").alias("fp"),
                               F.col(f"fn{i}").alias("fn"), F.col(f"tn{i}").alias("tn")) for i, t in enumerate(thresholds)])
    return row.select(F.explode(items).alias("c")).select("c.*")


def _ratio(a, b):
    return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))


def threshold_sweep(df: DataFrame, label: str, score: str, thresholds=DEFAULT_THRESHOLDS) -> DataFrame:
    """accuracy, precision, recall per threshold; zero denominators -> 0 (ML-9)."""
    c = confusion_by_threshold(df, label, score, thresholds)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    return c.select("threshold", "tp", "fp", "fn", "tn",
                    X.round_half_up(_ratio(tp + tn, tp + fp + fn + tn), 6).alias("accuracy"),
                    X.round_half_up(_ratio(tp, tp + fp), 6).alias("precision"),
                    X.round_half_up(_ratio(tp, tp + fn), 6).alias("recall")).orderBy("threshold")


def classification_report(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """Per-class precision/recall/F1/support + accuracy, macro and weighted avg (ML-10)."""
    c = confusion_by_threshold(df, label, score, (threshold,))
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    # class 1 is positive as is; class 0 swaps the roles
    p1, r1 = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    p0, r0 = _ratio(tn, tn + fn), _ratio(tn, tn + fp)
    f1 = lambda p, r: _ratio(2 * p * r, p + r)
    s1, s0 = tp + fn, tn + fp
    rows = F.array(
        F.struct(F.lit("0").alias("class"), p0.alias("precision"), r0.alias("recall"), f1(p0, r0).alias("f1"),
                 s0.cast("double").alias("support")),
        F.struct(F.lit("1").alias("class"), p1.alias("precision"), r1.alias("recall"), f1(p1, r1).alias("f1"),
                 s1.cast("double").alias("support")),
        F.struct(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), _ratio(tp + tn, n).alias("f1"),
                 n.cast("double").alias("support")),
        F.struct(F.lit("macro avg").alias("class"), ((p0 + p1) / 2).alias("precision"), ((r0 + r1) / 2).alias("recall"),
                 ((f1(p0, r0) + f1(p1, r1)) / 2).alias("f1"), n.cast("double").alias("support")),
        F.struct(F.lit("weighted avg").alias("class"), _ratio(p0 * s0 + p1 * s1, n).alias("precision"),
                 _ratio(r0 * s0 + r1 * s1, n).alias("recall"),
                 _ratio(f1(p0, r0) * s0 + f1(p1, r1) * s1, n).alias("f1"), n.cast("double").alias("support")),
    )
    out = c.select(F.explode(rows).alias("r")).select("r.*")
    return out.select("class", *[X.round_half_up(x, 6).alias(x) for x in ("precision", "recall", "f1")], "support")


# ------------------------------------------------------------------ ML-11 / ML-12


def kmeans_best_of(df: DataFrame, features: list[str], k: int = 3, n_init: int = 10, seed: int = 42,
                   max_iter: int = 300):
    """k-means, best of ``n_init`` seeded restarts by training cost (ML-11)."""
    with _during_fit(assemble(df, features).select("features"), "clustered") as data:
        return _best_run(data, k, n_init, seed, max_iter)


def _run(data: DataFrame, k: int, seed: int, max_iter: int = 300):
    return KMeans(k=k, seed=seed, maxIter=max_iter, initMode="k-means||", tol=1e-6, solver="block").fit(data)


def _fits(data: DataFrame, runs: list[tuple[int, int]], max_iter: int = 300, at_once: int = 8) -> list:
    """The models of (k, seed) runs over one cached frame, several at a time: their many small jobs fill each other's gaps."""
    data.count()   # cached once, not by every run
    with ThreadPoolExecutor(at_once) as pool:
        fit = inheritable_thread_target(data.sparkSession)(_run)
        return [f.result() for f in [pool.submit(fit, data, k, seed, max_iter) for k, seed in runs]]


def _best_run(data: DataFrame, k: int, n_init: int, seed: int, max_iter: int = 300):
    """The run of least cost, of equal ones the first."""
    return min(_fits(data, [(k, seed + i) for i in range(n_init)], max_iter), key=lambda m: m.summary.trainingCost)


def assign_clusters(model, df: DataFrame, features: list[str], out: str = "profil") -> DataFrame:
    return model.transform(assemble(df, features)).withColumn(out, F.col("prediction").cast("int")) \
                .drop("features", "prediction")


def inertia_k1(df: DataFrame, features: list[str]) -> DataFrame:
    """Within-cluster sum of squares for k = 1 (one aggregate; Spark KMeans needs k >= 2)."""
    # sum((x - mean)^2) = sum(x^2) - n * mean^2, per column
    aggs = []
    for c in features:
        aggs.append((F.sum(F.col(c) * F.col(c)) - F.count(c) * F.avg(c) * F.avg(c)).alias(c))
    row = df.agg(*aggs)
    return row.select(F.lit(1).alias("k"), reduce(lambda a, b: a + b, [F.col(c) for c in features]).alias("wcss"))


def elbow(df: DataFrame, features: list[str], k_max: int = 10, seed: int = 42, n_init: int = 10) -> DataFrame:
    """Inertia for k = 1..k_max (ML-12) as a DataFrame (k, wcss)."""
    with _during_fit(assemble(df, features).select("features"), "elbow") as data:      # once for all k
        runs = [(k, seed + i) for k in range(2, k_max + 1) for i in range(n_init)]
        costs = [float(m.summary.trainingCost) for m in _fits(data, runs)]
        rows = [(k, min(costs[i:i + n_init])) for i, (k, s) in enumerate(runs) if s == seed]
    rest = df.sparkSession.createDataFrame(rows, "k int, wcss double")  # k_max - 1 model costs
    return inertia_k1(df, features).unionByName(rest).orderBy("k")


# ------------------------------------------------------------------ ML-13 / ML-14

# Profile names by rank of mean performance, best first.
PROFILE_LABELS = ["Stars", "Lieutenants", "Rotation"]


def name_clusters(df: DataFrame, cluster: str, measure: str, labels=PROFILE_LABELS,
                  out: str = "profil_label") -> DataFrame:
    """Label clusters by descending mean ``measure`` (ML-13, AGG-17, WIN-11, JN-14).

    Needs a label for every group; more groups than labels fail the query.
    The per-cluster means are a k-row aggregate; ranking them with an
    unpartitioned window touches k rows only.
    """
    from pyspark.sql import Window
    means = df.groupBy(cluster).agg(F.avg(measure).alias("__mean"))
    ranked = means.withColumn("__rank", F.row_number().over(Window.orderBy(F.col("__mean").desc_nulls_last(),
                                                                           F.col(cluster))))
    names = F.array(*[F.lit(x) for x in labels])
    lut = ranked.select(cluster, F.when(F.col("__rank") <= len(labels), F.element_at(names, F.col("__rank"))).otherwise(
        F.raise_error(F.lit(f"more groups than the {len(labels)} labels"))).alias(out))
    return df.join(lut, cluster, "left")
