"""The rollups as streams.

Readers of the store add up partial rows, so a stream need not wait until an arrival bucket is final: each micro-batch is
rolled up by itself and stored at once. No watermark means that no event is too late, and there is no state to keep. Readers
that want final rows only ask the store how far the arrivals of all its streams are final.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from dataclasses import replace
from datetime import timedelta

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluice.operators.rollup import keyed, rollup_all
from sluice.schema import GRAINS, PERIODS
from sluice.session import shuffled_for
from sluice.sinks import store, versions
from sluice.streaming.delivery import start


def writer_name(checkpoint: str) -> str:
    """A name for the stream of a checkpoint."""
    return f"stream-{zlib.crc32(checkpoint.encode()):08x}"


def told(now: versions.Version, writer: str, newest: int | None, lateness: timedelta | None) -> versions.Version:
    """The version with the frontier of a writer whose newest arrival, in microseconds, is known: later batches bring
    arrivals that are at most ``lateness`` older."""
    if newest is None or lateness is None:
        return now
    least = newest - lateness // timedelta(microseconds=1)
    return replace(now, frontier={**now.frontier, writer: max(least, now.frontier.get(writer, least))})


def rollups_to_store(
    events: DataFrame,
    path: str,
    checkpoint: str,
    periods: Sequence[str] = tuple(PERIODS),
    grains: Sequence[str] = tuple(GRAINS),
    writer: str | None = None,
    every: str | None = None,
    lateness: timedelta | None = None,
) -> StreamingQuery:
    """Stores the partial rollup rows of every micro-batch of events, exactly once.

    All periods come from one pass over a batch. ``writer`` names the stream in the store and must be its own; by default
    it follows from the checkpoint. A batch that is delivered again is left out if it was stored. ``lateness`` says how much
    older than the newest one arrivals of later batches can be; it lets the store tell which rows are final.
    """
    name = writer or writer_name(checkpoint)

    def deliver(batch: DataFrame, batch_id: int) -> None:
        if store.is_done(versions.load(batch.sparkSession, path), name, batch_id):
            return
        if "bad_record" in batch.columns:  # records that cannot be read have no place; ``fan_out`` keeps them
            batch = batch.where("bad_record is null")
        n = batch.count()
        if not n:  # nothing to write or to observe
            versions.commit(batch.sparkSession, path, lambda now: store.added_to(now, name, batch_id, {}))
            return
        seen = Observation()
        observed = batch.observe(seen, F.max(F.unix_micros("ingest_time")).alias("newest"))
        with shuffled_for(batch.sparkSession, n * len(grains) * len(periods)):
            added = {store.ROLLUPS: store.write_items(keyed(rollup_all(observed, grains, periods)), path, name, str(batch_id))}

        def change(now: versions.Version) -> versions.Version | None:
            after = store.added_to(now, name, batch_id, added)
            return after and told(after, name, seen.get["newest"], lateness)

        versions.commit(batch.sparkSession, path, change)

    return start(events.writeStream.foreachBatch(deliver), checkpoint, every)
