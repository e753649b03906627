"""Streaming bridge.

The reference runs a daily batch; it has no stream, watermark or stateful
operator.  The one bridge kept here lets the same idempotent upsert (SNK-4/5)
consume an incremental file stream: ``readStream`` over the landing folder,
``Trigger.AvailableNow`` for the daily run, and ``foreachBatch`` applying the
upsert to the versioned table.  Re-running a batch after a failure re-applies
the same keys, so the result is the same (upsert is idempotent).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.sinks import upsert_table


def upsert_each_batch(path: str, keys: list[str], transform=None):
    """A ``foreachBatch`` function: optional transform, then upsert into ``path``."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        df = transform(batch) if transform else batch
        if df.limit(1).count():
            upsert_table(df, path, keys)
    return apply


def run_available_now(stream: DataFrame, path: str, keys: list[str], checkpoint: str, transform=None):
    """Process everything available in the stream once (the daily run) and stop."""
    q = (stream.writeStream.foreachBatch(upsert_each_batch(path, keys, transform))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q
