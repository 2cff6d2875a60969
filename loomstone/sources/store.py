"""What a store that Spark writes can do besides tables: small documents that are replaced as a whole, and the shared folder."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there."""
    where, store = _at(spark, path)
    return store.exists(where)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none if it is not there."""
    where, store = _at(spark, path)
    return sorted(x.getPath().getName() for x in store.listStatus(where)) if store.exists(where) else []


def delete(spark: SparkSession, path: str) -> None:
    where, store = _at(spark, path)
    store.delete(where, True)


def read_document(spark: SparkSession, path: str) -> dict | None:
    """The JSON document at a path, None if there is none."""
    where, store = _at(spark, path)
    if not store.exists(where):
        return None
    stream = store.open(where)
    try:
        return json.loads(bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8"))
    finally:
        stream.close()


def create_document(spark: SparkSession, path: str, document: dict) -> bool:
    """Writes a document that must not be there yet; whether it was this call that made it."""
    where, store = _at(spark, path)
    if store.exists(where):
        return False
    beside, _ = _at(spark, f"{where.getParent()}/.{where.getName()}-{uuid.uuid4().hex}")
    _put(store, beside, document)
    try:
        _context(spark, where, store).rename(store.makeQualified(beside), store.makeQualified(where), spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Exception:
        store.delete(beside, False)
        if store.exists(where):
            return False
        raise
    return True


def _put(store, where, document: dict) -> None:
    out = store.create(where, True)
    out.write(bytearray(json.dumps(document, sort_keys=True).encode("utf-8")))
    out.close()


def _context(spark: SparkSession, where, store):
    uri = where.toUri() if where.toUri().getScheme() else store.getUri()
    return spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(uri, spark._jsc.hadoopConfiguration())


def write_document(spark: SparkSession, path: str, document: dict) -> None:
    """Replaces the document: written beside under a name of its own and renamed over the old one, which is one step of the store."""
    jvm = spark._jvm
    where, store = _at(spark, path)
    beside, _ = _at(spark, f"{where.getParent()}/.{where.getName()}-{uuid.uuid4().hex}")
    _put(store, beside, document)
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    _context(spark, where, store).rename(store.makeQualified(beside), store.makeQualified(where), over)


def shared_root(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir, else the warehouse, which is shared too."""
    return (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def held(df: DataFrame, label: str) -> DataFrame:
    """df written once to the folder that driver and executors share, and read from there by all that follows."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def land_each(rows: DataFrame, folder: str, *by: str) -> None:
    """Writes a text file for each row (by, value) to the folder <by>=<its value>/... of its own, of plain letters and digits.

    In a store of local paths Spark's writer starts several processes a file, to set permissions, so tasks write by themselves
    there; a file is moved into place whole, and a task that runs again replaces it by the same.
    """
    where, fs = _at(rows.sparkSession, folder)
    uri = fs.makeQualified(where).toUri()
    if uri.getScheme() != "file":
        return rows.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy(*by).text(folder)
    base = uri.getPath()

    def land(part: Iterator[Row]) -> None:
        for row in part:
            place = os.path.join(base, *[f"{c}={row[c]}" for c in by])
            os.makedirs(place, exist_ok=True)
            beside = f"{place}/.{uuid.uuid4().hex}"
            with open(beside, "wb") as out:
                out.write(f"{row['value']}\n".encode())
            os.replace(beside, f"{place}/part-0.txt")

    rows.foreachPartition(land)
