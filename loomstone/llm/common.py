"""What the operators of this package share: shared storage, bounded batches, checked broadcasts."""

from __future__ import annotations

import hashlib
import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that one step of an Arrow operator works on at a time; whole texts, never parts of them.
CHUNK_BYTES = 4 << 20

#: Rows and bytes that may be sent to every executor; beyond them an operator takes its other way.
BROADCAST_ROWS = 1 << 20
BROADCAST_BYTES = 48 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; a local one only where driver and executors are one process."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="loomstone-"))
    return context._jsc.sc().getCheckpointDir().get().rstrip("/")


def staged(df: DataFrame, label: str, compression: str = "zstd") -> DataFrame:
    """df written to the shared folder and read again: lineage ends here, and sizes are known to the planner.

    A task lost later rereads files that all executors share, so nothing before this point runs twice.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checked(side: DataFrame, *lists: str) -> DataFrame:
    """A staged join side, marked for broadcast if its counted rows and list elements are under the bounds above.

    Beyond them it is returned unmarked, and the join is shuffled.
    """
    elements = sum((F.coalesce(F.size(c), F.lit(0)) for c in lists), F.lit(0))
    rows, inside = side.agg(F.count("*"), F.coalesce(F.sum(elements), F.lit(0))).first()
    return F.broadcast(side) if rows <= BROADCAST_ROWS and rows * 16 * len(side.columns) + inside * 8 <= BROADCAST_BYTES else side


def shipped(spark: SparkSession, name: str, content: bytes) -> str:
    """A small file, written to the shared folder and fetched by each executor, where SparkFiles.get() of the result is its own copy.

    The result tells the content too, as Spark keeps the first file of a name.
    """
    name = f"{hashlib.blake2b(content, digest_size=12).hexdigest()}-{name}"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/shipped/{name}")
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(path):
        out = store.create(path, True)
        for a in range(0, max(1, len(content)), 1 << 20):
            out.write(bytearray(content[a : a + (1 << 20)]))
        out.close()
    spark.sparkContext.addFile(store.makeQualified(path).toString())
    return name


def fresh(columns: Iterable[str], *names: str) -> list[str]:
    """The names, each followed by as many underscores as it takes to differ from all the columns, whatever their case."""
    taken, found = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def row_key(text: str = "text") -> list[Column]:
    """What tells a row of documents: its id and a hash of its text. Rows that are equal in both are one document.

    In the order of documents null ids come first, and rows of one id go by the hash.
    """
    return [F.col("doc_id").cast("long"), F.xxhash64(F.col(text).cast("string"))]


def chunks(batches: Iterator[pa.RecordBatch], column: int = 1, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Row slices of the batches whose texts hold about `limit` bytes; a longer text is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
        group = np.cumsum(sizes) // limit
        cuts = np.flatnonzero(np.diff(group)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            yield batch.slice(a, b - a)


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each row; null counts as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def lists(values: np.ndarray, lengths: np.ndarray) -> pa.ListArray:
    """A list column from its flat values and the length of each list."""
    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def docs_of(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
