"""A table that takes each id once over its whole history, and of which a batch reads only the part it can touch.

Rows lie in buckets of the id's hash, one folder each, sorted by id within a file. Beside them each bucket has a Bloom filter,
in blocks of a fixed number of bits: an id has its block and a few bits in it. A batch asks the filters of its own buckets
first. Ids that no filter knows are new for certain; of the others only the buckets are opened, and within them only the row
groups between the least and the greatest such id, which the sorted files tell apart. So a batch of new ids opens no file of
the table, and a batch of known ones opens those of its buckets, whatever the table's age.

Filters are written before the rows they stand for. After a failure between both, a filter knows ids that the table lacks,
which costs a look and loses nothing; the batch, run again, finds its own rows and adds the others. One writer at a time.
The numbers of buckets and blocks are fixed when the table is made; more ids than `ids_expected()` make filters less sharp,
never wrong. compact() puts each bucket's files together again and its filters too.

Edge cases: rows whose id is null are not taken; of equal ids in a batch the first delivered counts; ids are compared as
text; extra columns are kept, whatever their names but the bucket's; an empty batch changes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstone.sources import store
from loomstone.sources.store import held

BUCKET = "key_bucket"
#: Bits of a block (those of one of Spark's bitmaps), bits that an id sets in it, and bits per id that keep wrong hits under a percent.
BITS, PROBES, BITS_PER_ID = 32768, 7, 10


def _qualified(path: str, name: str) -> str:
    return f"{path.rstrip('/')}/{name}"


def first_delivered(records: DataFrame, unit: str, *order: str) -> DataFrame:
    """One row for each id that is not null: the first by the columns of `order`, else by the rows' places in their partitions."""
    place, held = "__place", "__unit"
    named = records.where(F.col(unit).isNotNull()).withColumn(place, F.struct(*(order or (F.monotonically_increasing_id(),))))
    whole = F.struct(*[F.col(f"`{c}`") for c in records.columns])
    return named.groupBy(F.col(unit).cast("string").alias(held)).agg(F.min_by(whole, place).alias("first")).select(*[F.col("first")[c].alias(c) for c in records.columns])


@dataclass(frozen=True)
class KeyedTable:
    """The table at a path. Where it is not there yet, `buckets` and `blocks` (per bucket) make it; else its own hold."""

    spark: SparkSession
    path: str
    unit: str
    buckets: int = 64
    blocks: int = 4

    @classmethod
    def at(cls, spark: SparkSession, path: str, unit: str, buckets: int = 64, blocks: int = 4) -> KeyedTable:
        told = store.read_document(spark, _qualified(path, "_keyed.json"))
        if told is None:
            if store.children(spark, path):
                raise ValueError(f"{path} holds files but is no keyed table; append its rows to a new one")
            store.write_document(spark, _qualified(path, "_keyed.json"), {"unit": unit, "buckets": buckets, "blocks": blocks})
            return cls(spark, path, unit, buckets, blocks)
        if told["unit"] != unit:
            raise ValueError(f"{path} is keyed by {told['unit']}, not by {unit}")
        return cls(spark, path, unit, told["buckets"], told["blocks"])

    def ids_expected(self) -> int:
        """Ids up to which the filters are sharp."""
        return self.buckets * self.blocks * BITS // BITS_PER_ID

    # ------------------------------------------------------------ places of an id

    def _hash(self, salt: int) -> Column:
        return F.xxhash64(F.col(self.unit).cast("string"), F.lit(salt))

    def bucket(self) -> Column:
        return F.pmod(self._hash(0), F.lit(self.buckets)).cast("int")

    def _block(self) -> Column:
        return F.pmod(self._hash(1), F.lit(self.blocks)).cast("int")

    def _bit(self, k: Column) -> Column:
        """The k-th bit of an id in its block, by two hashes."""
        step = F.pmod(self._hash(3), F.lit(BITS // 2)) * 2 + 1
        return F.pmod(F.pmod(self._hash(2), F.lit(BITS)) + k * step, F.lit(BITS)).cast("int")

    # ------------------------------------------------------------ filters

    def _filters_of(self, rows: DataFrame) -> DataFrame:
        """(key_bucket, block, bits) of the ids of rows that carry their bucket."""
        bits = rows.select(BUCKET, self._block().alias("block"), F.explode(F.transform(F.sequence(F.lit(0), F.lit(PROBES - 1)), lambda k: self._bit(k))).alias("bit"))
        return bits.groupBy(BUCKET, "block").agg(F.expr("bitmap_construct_agg(bit)").alias("bits"))

    def _read(self, folder: str, buckets: list[int]) -> DataFrame | None:
        """What a folder holds of the buckets; no other bucket's files are listed."""
        found = [p for b in buckets if store.exists(self.spark, p := f"{folder}/{BUCKET}={b}")]
        return self.spark.read.option("basePath", folder).parquet(*found) if found else None

    def _perhaps_known(self, rows: DataFrame, buckets: list[int]) -> DataFrame | None:
        """The rows, with their bucket, whose bits are all set in the filters of their bucket."""
        filters = self._read(_qualified(self.path, "_filters"), buckets)
        if filters is None:
            return None
        filters = filters.groupBy(BUCKET, "block").agg(F.expr("bitmap_or_agg(bits)").alias("bits"))
        asked = rows.withColumn("block", self._block()).join(filters, [BUCKET, "block"])

        def is_set(k: Column) -> Column:
            bit = self._bit(k)
            byte = F.conv(F.hex(F.substring(F.col("bits"), F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
            return F.getbit(byte, F.pmod(bit, F.lit(8))) == 1

        return asked.where(F.forall(F.sequence(F.lit(0), F.lit(PROBES - 1)), is_set)).drop("block", "bits")

    # ------------------------------------------------------------ reading and writing

    def read(self) -> DataFrame | None:
        """All rows, without their bucket; None before the first."""
        return self.spark.read.parquet(self.path).drop(BUCKET) if any(x.startswith(f"{BUCKET}=") for x in store.children(self.spark, self.path)) else None

    def to_open(self, rows: DataFrame) -> DataFrame | None:
        """What has to be read of the table to tell which of the rows, carrying their bucket, it holds; None if nothing.

        Driver: at most one number per bucket, and two ids.
        """
        asked = sorted(r[0] for r in rows.select(BUCKET).distinct().collect())
        perhaps = self._perhaps_known(rows, asked)
        if perhaps is None:
            return None
        hit, low, high = perhaps.agg(F.collect_set(BUCKET), F.min(self.unit), F.max(self.unit)).first()
        held = self._read(self.path, sorted(hit)) if hit else None
        if held is None:
            return None
        own = F.col(self.unit)
        return held.where(own.between(F.lit(low), F.lit(high))) if dict(held.dtypes)[self.unit] == dict(rows.dtypes)[self.unit] else held

    def append_new(self, records: DataFrame, *order: str, forget: bool = False) -> None:
        """Adds the records whose id the table does not hold; the first delivered of equal ids counts. `forget` drops `order`."""
        if BUCKET in records.columns:
            raise ValueError(f"{BUCKET} is the name of the table's own column")
        rows = first_delivered(records, self.unit, *order).drop(*order if forget else ())
        rows = held(rows.withColumn(BUCKET, self.bucket()), "batch")
        known = self.to_open(rows)
        if known is not None:
            ids = known.select(F.col(BUCKET).alias("__bucket"), F.col(self.unit).cast("string").alias("__unit"))
            rows = held(rows.join(ids, (F.col(BUCKET) == F.col("__bucket")) & (F.col(self.unit).cast("string") == F.col("__unit")), "left_anti"), "new")
        if rows.isEmpty():
            return
        self._put(self._filters_of(rows), _qualified(self.path, "_filters"))
        self._put(rows, self.path, self.unit)

    @staticmethod
    def _put(rows: DataFrame, folder: str, *within: str) -> None:
        # one file per bucket as long as that is not too large a task
        rows.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, *within).write.partitionBy(BUCKET).mode("append").parquet(folder)

    def compact(self, folder: str) -> KeyedTable:
        """The same rows in a new table at another path, each bucket's files together and sorted, with filters of its own."""
        new = KeyedTable.at(self.spark, folder, self.unit, self.buckets, self.blocks)
        rows = self.read()
        if rows is not None:
            rows = rows.withColumn(BUCKET, self.bucket())
            self._put(self._filters_of(rows), _qualified(folder, "_filters"))
            self._put(rows, folder, self.unit)
        return new
