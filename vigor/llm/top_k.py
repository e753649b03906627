"""Operator 10, exact top-k search by blocks.

Vectors become integers, and runs of them in vec_id order become blocks with the least and greatest value of every
term (component).  A query's bound on a block is the sum over terms of its product with whichever of the two is
better, which no vector of the block can exceed.  A task holds some queries and some blocks; every query takes
the blocks from the highest bound down and scores them through their forward index (the vectors themselves) until the next bound falls below
its k-th score so far.  Scores that equal the bound are still read, so that ties go to the smaller vec_id.

Queries are cut into tiles and blocks into lots; every tile meets every lot in one task, so both sides may grow and
no task holds more than a tile and a lot.

Defined cases: vectors that are null, empty or hold null or non-finite components take no part; a shorter vector counts as
padded with zeros; rows without vec_id take no part; repeated rows are candidates each (a query's own row is any row with its vec_id);
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import global_rank, stored, table

BLOCK = 512
#: Blocks of a lot and queries of a tile: what one task holds at once.
LOT = 32
TILE = 1024


def as_integers(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, v): components floor(scale * x) of the vectors that take part."""
    v = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    sound = (F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))))
    return vectors.select("vec_id", "embedding").filter(sound).select("vec_id", v.alias("v"))


def packed(ranked: DataFrame, size: int) -> DataFrame:
    """(lot, ids, vectors, width): each run of ``size`` ranked vectors as two little-endian 64-bit arrays."""
    def run(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by("rank")
        ids, rows = group.column("vec_id").to_numpy(), group.column("v").combine_chunks()
        lengths = np.diff(rows.offsets.to_numpy())
        flat = rows.flatten().to_numpy(zero_copy_only=False).astype("<i8")
        width = int(lengths.max())
        dense = np.zeros((len(ids), width), "<i8")
        dense[np.repeat(np.arange(len(ids)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
        return pa.table({"part": [key[0].as_py()], "vec_ids": pa.array([ids.astype("<i8").tobytes()], pa.binary()),
                         "vectors": pa.array([dense.tobytes()], pa.binary()), "width": pa.array([width], pa.int32())})

    return (ranked.withColumn("part", F.floor(F.col("rank") / size)).groupBy("part")
            .applyInArrow(run, "part long, vec_ids binary, vectors binary, width int"))


def _load(vec_ids: bytes, vectors: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(vec_ids, "<i8")
    return ids, np.frombuffer(vectors, "<i8").reshape(len(ids), width)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of ``a`` and ``b`` (which may differ in width)."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if width and float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * width < 2.0 ** 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)  # every partial sum is exact
    return a @ b.T


class Lot:
    """Some blocks of vectors, with the least and greatest value of each term."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, block: int):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.edges = np.r_[np.arange(0, len(ids), block), len(ids)]
        self.low = np.minimum.reduceat(self.vectors, self.edges[:-1])
        self.high = np.maximum.reduceat(self.vectors, self.edges[:-1])

    def search(self, ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The k best of the lot for each query as (query_id, vec_id, score) rows."""
        least = np.iinfo(np.int64).min
        width = queries.shape[1]
        fit = lambda x: np.pad(x, ((0, 0), (0, max(0, width - x.shape[1]))))[:, :width]
        bounds = products(np.maximum(queries, 0), fit(self.high)) + products(np.minimum(queries, 0), fit(self.low))
        order = np.argsort(-bounds, axis=1, kind="stable")
        best = np.full((len(ids), k), least)
        best_id = np.full((len(ids), k), np.iinfo(np.int64).max)
        active = np.arange(len(ids))
        for turn in range(bounds.shape[1]):
            block = order[active, turn]
            going = (bounds[active, block] >= best[active, -1]) | (best_id[active, -1] == np.iinfo(np.int64).max)
            active, block = active[going], block[going]
            if not len(active):
                break
            for b in np.unique(block):
                rows = active[block == b]
                span = slice(self.edges[b], self.edges[b + 1])
                score = products(queries[rows], self.vectors[span])
                vec = np.broadcast_to(self.ids[span], score.shape).copy()
                own = vec == ids[rows][:, None]
                score[own], vec[own] = least, np.iinfo(np.int64).max
                score, vec = np.hstack([best[rows], score]), np.hstack([best_id[rows], vec])
                top = np.lexsort((vec, -score.astype(np.float64) if np.abs(score[score != least]).max(initial=0) < 2 ** 53
                                  else np.array([[-int(s) for s in r] for r in score], object)), axis=1)[:, :k]
                best[rows], best_id[rows] = np.take_along_axis(score, top, 1), np.take_along_axis(vec, top, 1)
        found = best_id != np.iinfo(np.int64).max
        return np.broadcast_to(ids[:, None], best.shape)[found], best_id[found], best[found]


def search(queries: DataFrame, vectors: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of ``vectors`` for each of ``queries`` (both (vec_id, v))."""
    order = [F.col("vec_id").asc(), F.col("v").asc()]
    lots = stored(packed(global_rank(vectors, order, "rank"), BLOCK * LOT), "lots")
    tiles = stored(packed(global_rank(queries, order, "rank"), TILE), "tiles")
    n_lots = lots.count()
    # A task's rows: its lot first, then tiles as they come.  A lot meets its tiles in as many tasks as there are cores to fill.
    spread = max(1, vectors.sparkSession.sparkContext.defaultParallelism // max(1, n_lots))
    fans = F.explode(F.sequence(F.lit(0), F.lit(spread - 1)))
    left = lots.select("part", fans.alias("fan"), F.lit(0).alias("kind"), "vec_ids", "vectors", "width")
    right = tiles.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(n_lots - 1, 0)).cast("long"))).alias("lot"), "*").select(
        F.col("lot").alias("part"), F.pmod(F.col("part"), F.lit(spread)).cast("int").alias("fan"), F.lit(1).alias("kind"),
        "vec_ids", "vectors", "width")
    met = (left.unionByName(right).repartition(max(1, n_lots * spread), "part", "fan")
           .sortWithinPartitions("part", "fan", "kind"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lot, held = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                part, fan, kind, vec_ids, vecs, width = (batch.column(c)[row].as_py() for c in range(6))
                ids, dense = _load(vec_ids, vecs, width)
                if kind == 0:
                    lot, held = Lot(ids, dense, BLOCK), (part, fan)
                elif held == (part, fan):
                    q, v, s = lot.search(ids, dense, k)
                    yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(v), pa.array(s)], names=["query_id", "vec_id", "score"])

    found = met.mapInArrow(run, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir):
    vectors = stored(as_integers(table(spark, sf_dir, "embeddings")), "integers")
    return search(vectors.filter(F.col("vec_id") % 50 == 0), vectors)


ORACLE = """
WITH v AS (SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
e AS (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM v),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
      FROM e q JOIN e c ON q.i = c.i WHERE q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id GROUP BY 1, 2)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""
