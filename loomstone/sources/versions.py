"""Derived tables that change as one step: immutable files, one document per version, and a pointer to the present one.

A version is a list of files by part of the table. Writing one makes new files under a name of their own, then the version's
document, then moves the pointer, which the store replaces in one step. A reader follows the pointer once and reads files that
nothing changes: it sees the table before or after, never between. A writer that dies leaves files that no version names, or a
whole version that the pointer has not reached: whoever comes next moves the pointer there first. Two writers of the same
version cannot both create its document: the second of two replacements makes the next version, and of two upserts the second
fails, changes nothing, and has to start from the newest version.

A table may have one part, which replace() writes anew, or a part for each bucket of an id's hash, of which upsert() writes
only those that hold ids of the new rows. The last KEPT versions stay readable; vacuum(), called after each change, deletes
older documents and the files that none of those left names.

Edge cases: an empty table keeps its columns; null ids are one id; of equal ids in the rows of an upsert any one counts, so
they should be distinct; a table that was never written reads as None.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loomstone.sources import store

#: Versions that stay readable, and the column that tells a row's part while it is written.
KEPT, PART = 3, "version_part"


class WriteConflict(RuntimeError):
    """Another writer made the same version first."""


@dataclass(frozen=True)
class VersionedTable:
    spark: SparkSession
    path: str

    def _at(self, name: str) -> str:
        return f"{self.path.rstrip('/')}/{name}"

    # ------------------------------------------------------------ reading

    def version(self) -> int:
        """The present version, 0 before the first."""
        return (store.read_document(self.spark, self._at("_current.json")) or {"version": 0})["version"]

    def _document(self, version: int) -> dict:
        told = store.read_document(self.spark, self._at(f"_versions/{version}.json"))
        if told is None:
            raise ValueError(f"{self.path} has no version {version}; the last {KEPT} stay")
        return told

    def _files(self, told: dict, parts: list[str] | None = None) -> list[str]:
        return [self._at(f) for p in (told["parts"] if parts is None else parts) for f in told["parts"].get(p, [])]

    def _frame(self, told: dict, files: list[str]) -> DataFrame:
        schema = StructType.fromJson(told["schema"])
        return self.spark.read.schema(schema).parquet(*files) if files else self.spark.createDataFrame([], schema)

    def read(self, version: int | None = None) -> DataFrame | None:
        """The table as it stands now, or at a version that is still kept."""
        n = self.version() if version is None else version
        if n == 0:
            return None
        told = self._document(n)
        return self._frame(told, self._files(told))

    # ------------------------------------------------------------ writing

    def replace(self, df: DataFrame) -> int:
        """The whole table from df; the new version's number."""
        parts = self._written(df)
        return self._publish({"schema": df.schema.jsonValue(), "buckets": None, "unit": None, "parts": parts})

    def upsert(self, rows: DataFrame, unit: str, buckets: int = 64) -> int:
        """Rows take the place of those with their ids, or are added; the new version's number.

        Driver: at most one number per bucket. The table's own number of buckets holds after the first time.
        """
        n = self.version()
        told = self._document(n) if n else {"schema": rows.schema.jsonValue(), "buckets": buckets, "unit": unit, "parts": {}}
        if told["unit"] != unit:
            raise ValueError(f"{self.path} is not kept by {unit}")
        columns = StructType.fromJson(told["schema"]).names
        bucket = F.pmod(F.xxhash64(F.col(unit).cast("string")), F.lit(told["buckets"])).cast("int")
        new = store.held(rows.select(*columns).withColumn(PART, bucket), "upsert")
        touched = sorted(r[0] for r in new.select(PART).distinct().collect())
        if not touched:
            return n
        old = self._frame(told, self._files(told, [str(p) for p in touched]))
        ids = new.select(F.col(unit).alias("__unit"))
        left = old.join(ids, old[unit].eqNullSafe(F.col("__unit")), "left_anti").withColumn(PART, bucket)
        parts = self._written(left.unionByName(new))
        return self._publish(told | {"parts": told["parts"] | parts}, base=n)

    def _written(self, df: DataFrame) -> dict[str, list[str]]:
        """New files of the rows by their part; rows that name none are all of one, and are written where they are."""
        folder = f"_data/{uuid.uuid4().hex}"
        if PART in df.columns:
            df.hint("rebalance", PART).write.partitionBy(PART).parquet(self._at(folder))
        else:
            df.write.parquet(self._at(f"{folder}/{PART}=0"))
        found: dict[str, list[str]] = {}
        for name in store.children(self.spark, self._at(folder)):
            if name.startswith(f"{PART}="):
                part = name.split("=", 1)[1]
                found[part] = [f"{folder}/{name}/{f}" for f in store.children(self.spark, self._at(f"{folder}/{name}")) if f.startswith("part-")]
        return found

    def _publish(self, told: dict, base: int | None = None) -> int:
        """Makes the version after `base`, which the rows were read from, or after whatever is the newest."""
        n = (self.version() if base is None else base) + 1
        while not store.create_document(self.spark, self._at(f"_versions/{n}.json"), told):
            self.recover()
            if base is not None:
                raise WriteConflict(f"version {n} of {self.path} is there already")
            n += 1
        store.write_document(self.spark, self._at("_current.json"), {"version": n})
        self.vacuum()
        return n

    def vacuum(self) -> list[str]:
        """Deletes what no kept version names; the names of the folders that went."""
        n = self.version()
        for name in store.children(self.spark, self._at("_versions")):
            if int(name.split(".")[0]) <= n - KEPT:
                store.delete(self.spark, self._at(f"_versions/{name}"))
        named = {f.split("/")[1] for name in store.children(self.spark, self._at("_versions")) for f in _files_of(store.read_document(self.spark, self._at(f"_versions/{name}")))}
        gone = [x for x in store.children(self.spark, self._at("_data")) if x not in named]
        for x in gone:
            store.delete(self.spark, self._at(f"_data/{x}"))
        return gone

    def recover(self) -> bool:
        """Moves the pointer to a version that is whole but never became the present one, as after a writer's death; whether it moved."""
        n = self.version()
        if not store.exists(self.spark, self._at(f"_versions/{n + 1}.json")):
            return False
        store.write_document(self.spark, self._at("_current.json"), {"version": n + 1})
        return True


def _files_of(told: dict | None) -> list[str]:
    return [f for files in (told or {"parts": {}})["parts"].values() for f in files]


def is_versioned(spark: SparkSession, path: str) -> bool:
    return store.exists(spark, f"{path.rstrip('/')}/_current.json")

