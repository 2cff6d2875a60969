"""Progress from the output itself: a unit's last attempt is its state. No sidecar is needed for batch work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Statuses after which a unit is not tried again; a record without a status counts as done.
TERMINAL = ("success", "empty_methods", "empty_output")


def latest_attempts(records: DataFrame, unit: str, order: str | Column, *columns: str) -> DataFrame:
    """One row per unit with the columns of its last attempt, even if an earlier one was better."""
    order = F.col(order) if isinstance(order, str) else order
    last = F.max_by(F.struct(*columns), order).alias("last")
    return records.groupBy(unit).agg(last, F.count("*").alias("attempts")).select(unit, "attempts", *[F.col(f"last.{c}").alias(c) for c in columns])


def done(status: Column, terminal: tuple[str, ...] = TERMINAL) -> Column:
    return status.isNull() | status.isin(*terminal)


def status_tally(records: DataFrame, status: str = "status") -> DataFrame:
    return records.groupBy(F.coalesce(F.nullif(F.col(status), F.lit("")), F.lit("unlabelled")).alias("status")).agg(F.count("*").alias("n"))


def unprocessed(units: DataFrame, latest: DataFrame, unit: str, is_done: Column | None = None) -> DataFrame:
    """Units without a finished last attempt; ids are compared as strings. Order them by their own ordinal."""
    finished = latest.where(done(F.col("status")) if is_done is None else is_done).select(F.col(unit).cast("string").alias("__unit"))
    return units.join(finished, units[unit].cast("string") == F.col("__unit"), "left_anti")


def stale(latest: DataFrame, units: DataFrame, unit: str) -> DataFrame:
    """Recorded units that are no longer in the universe."""
    known = units.select(F.col(unit).cast("string").alias("__unit"))
    return latest.join(known, latest[unit].cast("string") == F.col("__unit"), "left_anti")


def next_batch(units: DataFrame, order: str, limit: int) -> DataFrame:
    """The first units in order; a limit of zero or less takes all."""
    ordered = units.orderBy(order)
    return ordered.limit(limit) if limit > 0 else ordered


def records_without_state(records: DataFrame, processed: DataFrame) -> DataFrame:
    """One row, disagree: whether there are records though no progress is recorded, as after a lost state file."""
    some = lambda df, held: df.limit(1).select(F.lit(held).alias("held"))
    seen = some(records, True).unionByName(some(processed, False))
    return seen.agg((F.coalesce(F.bool_or("held"), F.lit(False)) & F.coalesce(F.bool_and("held"), F.lit(False))).alias("disagree"))
