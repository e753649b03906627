"""What stays on disk while a run goes on: shuffle files end with their query, interim rows with their model."""

import os
import time

from pyspark.sql import functions as F

from conftest import SF_SMALL
from vigor.operators import joins as J
from vigor.operators import ranks
from vigor.operators import sinks as S
from vigor.plans.registry import Ctx, Steps
from vigor.session import FREE_SHUFFLES, ensure_checkpoint_dir


def _shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    folders = [d.getPath() for d in manager.localDirs()]
    return {f for d in folders for _, _, files in os.walk(d) for f in files if f.startswith("shuffle_")}


def _gone(spark, before):
    for _ in range(50):
        if not _shuffle_files(spark) - before:
            return True
        time.sleep(0.2)
    return False


def test_stored_stages_leave_no_shuffle_files(spark, no_broadcast, tmp_path):
    df = spark.range(2000).select("id", (F.col("id") % 7).alias("k"))
    with no_broadcast():
        joined = df.join(df.groupBy("k").agg(F.count("*").alias("n")), "k")
        before, was = _shuffle_files(spark), spark.conf.get(FREE_SHUFFLES)
        assert joined.count() == 2000 and _shuffle_files(spark) - before     # others' queries keep theirs
        before = _shuffle_files(spark)
        J.materialise(joined, str(tmp_path / "m"), ["k"])
        ranks.staged(joined, "x")
        S.write_table(joined, str(tmp_path / "t"))
        S.assert_unique(joined, ["id"])
    assert _gone(spark, before) and spark.conf.get(FREE_SHUFFLES) == was
    assert spark.read.parquet(str(tmp_path / "m")).count() == S.read_table(spark, str(tmp_path / "t")).count() == 2000


def test_mart_leaves_no_interim_rows(spark, no_broadcast):
    folder = f"{ensure_checkpoint_dir(spark)}/vigor-tables".removeprefix("file:")
    names = lambda: {d.rsplit("-", 1)[0] for d in os.listdir(folder)}
    c = Ctx(spark, SF_SMALL)
    kept, keep = [], Steps.keep

    class Watched(Steps):
        def keep(self, df, name):
            kept.append(name)
            return keep(self, df, name)

    from vigor.plans import pipelines as P
    steps = Watched(c)
    inputs = c.fatigue, c.stg_sessions, c.mart_player
    there = names()
    with no_broadcast():
        mart = P.mart_physical_condition(*inputs, steps.keep)
        rows = {tuple(r) for r in mart.collect()}
    assert kept == ["fatigue_sessions", "day_stats", "fatigue_rolling"]
    assert names() - there == {"fatigue_rolling"}        # the steps before it aren't read any more
    steps.drop()
    assert names() == there
    assert rows == {tuple(r) for r in P.mart_physical_condition(*inputs).collect()} and rows
