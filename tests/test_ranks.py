"""Distributed ranks, quantiles, members and label codes against plain Python, with hot groups and values."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigor.operators import ml as M
from vigor.operators import ranks
from vigor.operators import relational as R


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_ranked_groups_span_partitions(spark):
    rnd = random.Random(1)
    rows = list({(rnd.choice(["hot"] * 6 + ["a", "b", None]), rnd.randint(0, 5000)) for _ in range(6000)})
    df = spark.createDataFrame(rows, "g string, v long").repartition(7)
    out = ranks.ranked(df, [F.col("v").asc()], ["g"], "at", "size")
    want = []
    for g in {r[0] for r in rows}:
        vs = sorted(v for x, v in rows if x == g)
        want += [(g, v, i, len(vs)) for i, v in enumerate(vs)]
    assert _rows(out) == sorted(want, key=repr)
    assert _rows(ranks.ranked(df.select("v").distinct(), [F.col("v").desc()])) == sorted(
        ((v, i) for i, v in enumerate(sorted({v for _, v in rows}, reverse=True))), key=repr)
    assert ranks.ranked(df.limit(0), [F.col("v")], ["g"]).count() == 0


@pytest.mark.parametrize("n", [1, 2, 5, 4000])
def test_quantiles_are_exact(spark, n):
    rnd = random.Random(n)
    rows = [(rnd.choice([3.0, 3.0, rnd.random(), float(rnd.randint(0, 9))]), rnd.randint(-5, 5), None if i % 3 else i) for i in range(n)]
    df = spark.createDataFrame(rows, "x double, y long, z long").withColumn("none", F.lit(None).cast("double")).repartition(5)
    shares = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = {(r["column"], r["share"]): r["value"] for r in ranks.quantiles(df, ["x", "y", "z", "none"], shares).collect()}
    want = {(c, s): float(np.quantile([r[i] for r in rows if r[i] is not None], s)) for i, c in enumerate("xyz") for s in shares}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in got)


def test_describe_without_values(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None)], "a double, b double")
    got = {r["column"]: r for r in R.describe_columns(df, ["a", "b"]).collect()}
    assert (got["a"]["p25"], got["a"]["p50"], got["a"]["p75"]) == (1.5, 2.0, 2.5)
    assert got["b"]["count"] == 0 and got["b"]["p50"] is None


def test_members_of_a_hot_group(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("g"), F.format_string("m%06d", "id").alias("m"))
    df = df.unionByName(df.limit(100)).unionByName(spark.createDataFrame([(None, "x"), ("only null", None)], "g string, m string"))
    out = R.members(df, ["g"], "m")
    hot = out.filter("g = 'hot'").orderBy("member_no").collect()
    assert [r.m for r in hot] == [f"m{i:06d}" for i in range(0, 30_000, 3)] and [r.member_no for r in hot] == list(range(1, 10_001))
    texts = {r.g: r for r in R.member_texts(df, ["g"], "m", most=2000).collect()}
    assert texts["hot"].members is None and texts["hot"].n_members == 10_000 and "only null" not in texts
    assert texts[None].members == "x" and texts["1"].members.split(", ") == sorted(texts["1"].members.split(", "))


def test_member_texts_are_whole(spark):
    """A group of any number of members has its text, in order, also where a run of members ends; names may repeat the separator."""
    hot = [f"m{i:06d}, jr" if i % 7 else f"m{i:06d}" for i in range(12_001)]
    rows = [("hot", m) for m in hot] + [("1", "b"), ("1", "a"), ("1", "b"), (None, ""), (None, "x"), ("only null", None)]
    df = spark.createDataFrame(rows, "g string, m string").repartition(5)
    want = {("hot", ", ".join(hot), 12_001), ("1", "a, b", 2), (None, ", x", 2)}
    assert {tuple(r) for r in R.member_texts(df, ["g"], "m").select("g", "members", "n_members").collect()} == want
    assert {tuple(r) for r in R.member_texts(df, ["g"], "m", run=3).select("g", "members", "n_members").collect()} == want


def test_label_codes(spark):
    rows = [(i, v) for i, v in enumerate(["b", "a", None, "c", "a", "é", "Z", None])]
    df = spark.createDataFrame(rows, "i long, v string").repartition(3)
    codes = {v: n for n, v in enumerate(["Z", "a", "b", "c", "é", None])}
    assert _rows(M.label_encode(df, "v", "code")) == sorted(((i, v, codes[v]) for i, v in rows), key=repr)
    assert _rows(M.label_encode(df, "v")) == sorted(((i, codes[v]) for i, v in rows), key=repr)
