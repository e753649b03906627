"""Query registry: one entry per operator ID of the inventory.

Each entry is ``(build(spark, sf_dir) -> DataFrame, oracle_sql | None)``.
The oracle is DuckDB SQL over the supplied tables (registered as views);
``None`` marks operators whose result is not exactly reproducible in SQL
(model fitting, load timestamps), which get a rows-only check.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..operators.sinks import file_system, remove
from ..session import ensure_checkpoint_dir
from ..sources import adapter
from . import pipelines as P

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}
_RUN_TABLES: dict[tuple, tuple] = {}


def q(key: str, oracle: str | None = None):
    def deco(fn):
        if key in REGISTRY:
            raise KeyError(f"duplicate query {key}")
        REGISTRY[key] = (lambda spark, sf_dir: fn(Ctx(spark, sf_dir)), oracle)
        return fn
    return deco


class Ctx:
    """Lazily built raw tables and pipeline stages for one (session, folder)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return adapter.raw_table(self.spark, self.sf_dir, name)

    def scratch(self, name: str) -> str:
        """A fresh folder under the shared checkpoint directory (never machine-local on a cluster)."""
        base = ensure_checkpoint_dir(self.spark).rstrip("/")
        return f"{base}/vigor-tables/{name}-{uuid.uuid4().hex[:12]}"

    @cached_property
    def run_key(self) -> tuple:
        """Application, folder, and name, length and modification time of each input file."""
        fs, root = file_system(self.spark, self.sf_dir)
        files, listing = [], fs.listFiles(root, True)
        while listing.hasNext():
            f = listing.next()
            files.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
        return self.spark.sparkContext.applicationId, self.sf_dir, tuple(sorted(files))

    @cached_property
    def players(self): return self.raw("team_players_personal_info")

    @cached_property
    def games(self): return self.raw("team_games_dataset")

    @cached_property
    def boxscores(self): return self.raw("team_boxscores")

    @cached_property
    def stats(self): return self.raw("team_players_stats")

    @cached_property
    def sessions(self): return self.raw("team_training_sessions")

    @cached_property
    def stg_players(self): return self.table("stg_players", lambda: P.stg_players(self.players))

    def table(self, name: str, build, partition_by: list[str] | None = None) -> DataFrame:
        """A model the pipeline stores as a table (staging shared by several models, dims, fatigue, marts).

        Built and written once per run -- one Spark application over one state
        of the input folder -- then re-read by every later consumer, as a
        scheduled daily run builds each model once.  Changed input files are a
        new run.  ``build`` is only called on the first use.
        """
        from ..operators.joins import materialise
        key = (*self.run_key, name)
        hit = _RUN_TABLES.get(key)
        if hit is None:
            path = self.scratch(name)
            df = materialise(build(), path, partition_by)
            _RUN_TABLES[key] = hit = (path, df.schema)
        return self.spark.read.schema(hit[1]).parquet(hit[0])

    @cached_property
    def dim_players(self): return self.table("dim_players", lambda: P.dim_players(self.stg_players))

    @cached_property
    def stg_stats(self):
        # read by the fatigue index and the player mart: materialised once per run
        return self.table("stg_player_stats", lambda: P.stg_player_stats(self.stats))

    @cached_property
    def stg_games(self): return P.stg_games(self.games, self.boxscores)

    @cached_property
    def dim_calendar(self): return self.table("dim_calendar", lambda: P.dim_calendar(self.stg_games))

    @cached_property
    def stg_sessions(self):
        # read by three models (fatigue index, player mart, condition mart): materialised once per run
        return self.table("stg_training_sessions", lambda: P.stg_training_sessions(self.sessions, self.dim_players))

    @cached_property
    def fatigue(self):
        return self.table("int_fatigue_index",
                          lambda: P.int_fatigue_index(self.stg_sessions, self.stg_stats, self.stg_players))

    @cached_property
    def mart_player(self):
        return self.table("mart_player", lambda: P.mart_player(self.stg_stats, self.dim_calendar, self.dim_players,
                                                               self.stg_sessions), partition_by=["season"])

    @cached_property
    def mart_game(self): return self.table("mart_game", lambda: P.mart_game(self.stg_games, self.dim_calendar, self.fatigue))

    @cached_property
    def mart_pc(self):
        steps = Steps(self)
        mart = self.table("mart_physical_condition",
                          lambda: P.mart_physical_condition(self.fatigue, self.stg_sessions, self.mart_player, steps.keep),
                          partition_by=["season"])
        steps.drop()
        return mart


class Steps:
    """Stored rows between the steps of one model: nobody else reads them, so they go with the model's last step.

    Steps are a chain: the frame kept under a name in ``USED_BY`` is made of the ones listed there, which aren't read again.
    """

    USED_BY = {"fatigue_rolling": ["fatigue_sessions", "day_stats"]}

    def __init__(self, ctx: Ctx):
        self.ctx, self.paths = ctx, {}

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        from ..operators.joins import materialise
        path = self.ctx.scratch(name)
        kept = materialise(df, path)
        self.drop(self.USED_BY.get(name, []))
        self.paths[name] = path
        return kept

    def drop(self, names: list[str] | None = None) -> None:
        for name in list(self.paths) if names is None else names:
            remove(self.ctx.spark, self.paths.pop(name))


def raw_sql(select: str, *names: str) -> str:
    """Oracle over raw adapter tables only."""
    return "WITH " + adapter.duckdb_ctes(names or tuple(adapter.RAW_TABLES)) + "\n" + select


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_modules()
    return {k: v[0] for k, v in REGISTRY.items()}


def all_oracles() -> dict[str, str]:
    _load_modules()
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}


def _load_modules():
    from . import q_agg, q_core, q_ml, q_pipe  # noqa: F401  (registration side effect)
