"""The random forest over rows that never meet in one place, against plain recursion."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigor.operators import forest
from vigor.operators import ml as M
from vigor.session import ensure_checkpoint_dir


def _rows(spark, n=3000):
    x = lambda i: F.pmod(F.xxhash64(F.lit(i), "id"), F.lit(997)) / 997.0
    df = spark.range(n).select(F.concat(F.lit("s"), "id").alias("key"), x(1).alias("a"), x(2).alias("b"), F.floor(x(3) * 4).cast("double").alias("c"),
                               x(4).alias("noise"), (F.col("id") % 5 == 0).alias("is_test"))
    return df.withColumn("y", ((F.col("a") > 0.7) | (F.col("noise") > 0.9)).cast("int"))


def _scores(df, **params):
    return {r.key: r.p for r in M.forest_probability(df, ["a", "b", "c"], "y", "key", out="p", **{"num_trees": 5, **params}).collect()}


def _plain(bins, label, times, scored, key, depth, weights, max_depth):
    """Share of class 1 in the scored row's leaf, by recursion over one row's path."""
    while True:
        w = [weights[y] * t for y, t in zip(label, times, strict=True)]
        ones = sum(v for v, y in zip(w, label, strict=True) if y)
        best, gini = None, lambda part: sum(sum(v for v, y in part if y == k) ** 2 for k in (0, 1)) / sum(v for v, _ in part)
        if depth < max_depth:
            whole = list(zip(w, label, strict=True))
            for f in forest._tried(np.array([key], np.uint64), bins.shape[1])[0]:
                for cut in sorted(set(bins[:, f]))[:-1]:
                    gain = gini([x for x, b in zip(whole, bins[:, f], strict=True) if b <= cut]) + gini([x for x, b in zip(whole, bins[:, f], strict=True) if b > cut]) - gini(whole)
                    if gain > 1e-9 * sum(w) and (best is None or gain > best[0] + 1e-9):
                        best = gain, f, cut
        if best is None:
            return ones / sum(w)
        side = scored[best[1]] > best[2]
        stay = (bins[:, best[1]] > best[2]) == side
        bins, label, times = bins[stay], label[stay], times[stay]
        key, depth = int(forest._children(np.array([key], np.uint64), np.array([side]))[0]), depth + 1


@pytest.mark.parametrize("max_depth", [0, 1, 3, 30])
def test_branch_equals_plain_recursion(max_depth):
    rng = np.random.default_rng(1)
    bins, scored = rng.integers(0, 6, (120, 5)).astype(np.uint8), rng.integers(0, 6, (40, 5)).astype(np.uint8)
    label, times = (bins[:, 0] + rng.integers(0, 4, 120) > 5).astype(np.int64), rng.integers(1, 4, 120)
    args = (7, 0, (0.7, 2.5), max_depth)
    found = forest._grow(bins, label, times, scored, *args)
    assert found == pytest.approx([_plain(bins, label, times, x, *args) for x in scored])


def test_scores_do_not_depend_on_where_branches_grow(spark):
    """Nodes split by counts over all partitions, and other partitions, give the same scores bit by bit."""
    df = _rows(spark)
    whole = _scores(df)
    assert len(whole) == 600 and all(0 <= p <= 1 for p in whole.values())
    assert _scores(df, local_rows=100) == whole == _scores(df.repartition(7), local_rows=0)
    assert _scores(df, local_rows=100, max_depth=3) == _scores(df, max_depth=3) != whole
    assert _scores(df, seed=43) != whole


def test_scores_do_not_depend_on_trees_at_once(spark, monkeypatch):
    """Few trees at a time: the rows that a shuffle holds are bounded, the scores are the same."""
    df, sent, shares = _rows(spark), [], forest.shares
    whole = _scores(df, num_trees=7)
    monkeypatch.setattr(forest, "shares", lambda *a: (sent.append(a[-1]), shares(*a))[1])
    monkeypatch.setattr(M, "FOREST_BYTES", 3 * forest.tree_bytes(3, 2400, 600))
    assert _scores(df, num_trees=7) == whole
    assert sent == [range(0, 3), range(3, 6), range(6, 7)]
    folder = f"{ensure_checkpoint_dir(spark)}/vigor-tables".removeprefix("file:")
    assert not [d for d in os.listdir(folder) if d.startswith(("forest-", "forest_sums-"))]


def test_forest_learns_and_balances(spark):
    df = _rows(spark)
    p = _scores(df, num_trees=20)
    means = [np.mean([p[r.key] for r in df.filter(f"is_test and {when}").collect()]) for when in ("a > 0.7", "a <= 0.7")]
    assert means[0] > 0.9 and means[1] < 0.3
    # a tree that isn't split says the balanced share of its draws
    assert np.mean(list(_scores(df, max_depth=0, num_trees=50).values())) == pytest.approx(0.5, abs=0.02)


def test_forest_defined_cases(spark):
    df = _rows(spark, 200)
    assert set(_scores(df.filter("is_test or y = 1")).values()) == {1.0}
    assert _scores(df.filter("not is_test")) == {}
    with pytest.raises(ValueError, match="classes"):
        _scores(df.filter("is_test"))
    with pytest.raises(ValueError, match="classes"):
        _scores(df.withColumn("y", F.col("y") + 1))
