"""Each unit's last attempt, kept up to date by a stream instead of grouping all attempts in every run.

The state is Spark's own: a grouping in update mode, in RocksDB, holds each unit's last attempt and how many there were, and
brings out of every micro-batch just the units that the batch touched. These take the place of their former rows in a
versioned table, whose buckets without any of them are not read or written. The last attempt counts by its order, whatever
the batch it comes in, so late files change nothing that they should not; a later failure takes the place of an earlier
success. A batch that is run again after a failure puts the same rows in the same places.

No unit is ever forgotten, as any may be tried again: state grows with units and not with attempts.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loomstone.operators.state import latest_attempts
from loomstone.sources.versions import VersionedTable

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def _state_in(spark: SparkSession, provider: str):
    """A query keeps the provider it is started with; the session gets its own back."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, provider)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def keep_latest(stream: DataFrame, table: str, checkpoint: str, unit: str, order: list[str], *columns: str, buckets: int = 64) -> StreamingQuery:
    """Starts a run over what is available; the table holds (unit, attempts, *columns) of each unit's last attempt by `order`."""
    spark = stream.sparkSession
    latest = latest_attempts(stream, unit, F.struct(*order), *columns)

    def write(batch: DataFrame, _: int) -> None:
        VersionedTable(spark, table).upsert(batch, unit, buckets)

    with _state_in(spark, ROCKSDB):
        return latest.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
