"""Incremental channels: at-least-once pages into a table that takes each record once, over all its history."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loomstone.sources.sinks import append_new


def insert_only(stream: DataFrame, table: str, checkpoint: str, unit: str = "record_id", normalise: Callable[[DataFrame], DataFrame] | None = None, order: tuple[str, ...] = ()) -> StreamingQuery:
    """Starts a run over what is available: records with new ids are appended, known ones discarded and never updated.

    The test is against the keyed table and not against bounded state, so no id is ever forgotten; a batch opens only what
    it may touch of the table. Null ids are skipped. A batch that is run again after a failure finds its own rows and adds
    none twice. `order` names the columns that tell which of equal ids was delivered first; they are not stored.
    """

    def write(batch: DataFrame, _: int) -> None:
        append_new(normalise(batch) if normalise else batch, table, unit, *order, forget=True)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def bounded_dedupe(stream: DataFrame, unit: str, event_time: str, delay: str) -> DataFrame:
    """Less exact, with bounded state: ids older than the delay may come again."""
    return stream.withColumn(event_time, F.col(event_time).cast("timestamp")).withWatermark(event_time, delay).dropDuplicatesWithinWatermark([unit])


def high_water(records: DataFrame, channel: str = "channel", time: str = "timestamp") -> DataFrame:
    """The newest time per channel, from which its next window starts."""
    return records.groupBy(channel).agg(F.max(time).alias("high_water"))
