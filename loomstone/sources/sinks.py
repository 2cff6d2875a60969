"""Writers: idempotent appends, full refreshes, files that are replaced as a whole, and a channel's state."""

from __future__ import annotations

import csv
import json
import os
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from loomstone.sources.keyed import BUCKET, KeyedTable
from loomstone.sources.store import children
from loomstone.sources.versions import VersionedTable, is_versioned


def append_new(records: DataFrame, path: str, unit: str, *order: str, forget: bool = False) -> None:
    """Appends records whose id the keyed table at the path does not hold; the first delivered of equal ids in a batch counts.

    First is told by the columns of `order` (a page and place, say), else by the rows' place in their partitions; with
    `forget` those columns are not stored.
    """
    KeyedTable.at(records.sparkSession, path, unit).append_new(records, *order, forget=forget)


def append_attempts(records: DataFrame, path: str) -> None:
    """Appends every attempt; the last of a unit counts when it is read."""
    records.write.mode("append").parquet(path)


def refresh(df: DataFrame, path: str) -> None:
    """A derived table, replaced as one step: readers see the old one or the new one, also after a failed write."""
    VersionedTable(df.sparkSession, path).replace(df)


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """A table of this engine, however it is kept: versioned, keyed, or plain files; None if there is none."""
    if is_versioned(spark, path):
        return VersionedTable(spark, path).read()
    return spark.read.parquet(path).drop(BUCKET) if any(not x.startswith(("_", ".")) for x in children(spark, path)) else None


def replace_csv(df: DataFrame, path: str) -> int:
    """A small export on the driver's disk, renamed into place; rows are streamed and null is blank."""
    temporary, n = Path(f"{path}.tmp"), 0
    try:
        with temporary.open("w", encoding="utf-8", newline="") as f:
            out = csv.writer(f)
            out.writerow(df.columns)
            for row in df.toLocalIterator():
                out.writerow(["" if x is None else x for x in row])
                n += 1
        os.replace(temporary, path)
    finally:
        temporary.unlink(missing_ok=True)
    return n


class ChannelState:
    """A channel's progress as a JSON document, replaced as a whole; an unreadable one is kept aside."""

    def __init__(self, path: str, attempts: int = 5):
        self.path, self.attempts = Path(path), attempts
        self.values: dict = {"processed_ids": [], "last_page_done": 0, "next_url": None, "window_since": None, "is_complete": False, "rate_limit_reset": None, "records_written": 0}
        if self.path.exists():
            try:
                self.values |= json.loads(self.path.read_text(encoding="utf-8"))
            except ValueError:
                self.path.rename(self.path.with_suffix(f".corrupt_{int(time.time())}.json"))

    def save(self, **values: object) -> None:
        self.values |= values
        temporary = self.path.with_suffix(".tmp")
        for k in range(self.attempts):
            try:
                temporary.write_text(json.dumps(self.values), encoding="utf-8")
                os.replace(temporary, self.path)
                return
            except OSError:
                if k == self.attempts - 1:
                    raise
                time.sleep(0.1 * (k + 1))

    def must_wait(self, now: float | None = None) -> bool:
        return bool(self.values["rate_limit_reset"]) and (time.time() if now is None else now) < self.values["rate_limit_reset"]
