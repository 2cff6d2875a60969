"""Readers of landed files. Schemas are given, never inferred, so that only the columns asked for are parsed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstone import schemas
from loomstone.operators import structural, universe
from loomstone.sources.store import children, exists


def parsed(lines: DataFrame, schema: str, keep: list[str] | None = None, corrupt: bool = False, value: str = "value") -> DataFrame:
    """Records of JSON lines; blank lines are skipped, unparseable ones dropped, or kept with their text in _corrupt."""
    whole = F.from_json(value, f"{schema}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    df = lines.where(F.trim(value) != "").select(whole.alias("r")).select("r.*")
    df = df if corrupt else df.where("_corrupt IS NULL").drop("_corrupt")
    return df.select(*keep, *(["_corrupt"] if corrupt else [])) if keep else df


def read_records(spark: SparkSession, path: str, schema: str, keep: list[str] | None = None, corrupt: bool = False) -> DataFrame:
    """The records of a landed file, as parsed(); a missing path gives an empty table."""
    if not exists(spark, path):
        empty = spark.createDataFrame([], f"{schema}, _corrupt string" if corrupt else schema)
        return empty.select(*keep, *(["_corrupt"] if corrupt else [])) if keep else empty
    return parsed(spark.read.text(path), schema, keep, corrupt)


def corrupt_by_file(lines: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """(file, lines, corrupt, cut_off) of landed JSON lines: cut_off if a file's one unparseable line is its last.

    A writer that died can have cut off only the last line of a file; any other is damage. Lines are told apart by file,
    block and place in it, so that the last is found without any file being read in one piece: one pre-aggregated row per file.
    """
    bad = F.from_json(value, f"{schema}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})["_corrupt"].isNotNull() & (F.trim(value) != "")
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    each = lines.select(F.col("_metadata.file_path").alias("file"), place.alias("place"), F.coalesce(bad, F.lit(False)).alias("bad"))
    per = each.groupBy("file").agg(F.count("*").alias("lines"), F.count_if("bad").alias("corrupt"), F.max_by("bad", "place").alias("last"))
    return per.select("file", "lines", "corrupt", (F.col("last") & (F.col("corrupt") == 1)).alias("cut_off"))


def read_landed(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """The records with _corrupt, and what corrupt_by_file() tells; a cut-off last line counts as not written and is in neither.

    Its unit is done again; damaged lines stay, to be reported.
    """
    lines = spark.read.text(path)
    told = corrupt_by_file(lines, schema)
    whole = F.from_json("value", f"{schema}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    rows = lines.where(F.trim("value") != "").select(F.col("_metadata.file_path").alias("__file"), whole.alias("r")).select("__file", "r.*")
    cut = told.where("cut_off").select(F.col("file").alias("__cut"))
    kept = rows.where("_corrupt IS NULL").drop("__file")
    damaged = rows.where("_corrupt IS NOT NULL").join(cut, F.col("__file") == F.col("__cut"), "left_anti").drop("__file")
    return kept.unionByName(damaged), told.select("file", F.when(F.col("cut_off"), 0).otherwise(F.col("corrupt")).alias("corrupt"), "cut_off")


def with_sequence(df: DataFrame) -> DataFrame:
    """Adds ingest_seq, which follows file, block and row; records of one file keep their order."""
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())
    return df.select("*", place.alias("ingest_seq"))


RUNS = "sha string, timestamp bigint, exit_ok boolean, timed_out boolean, checked_out boolean, n_removed int"


def list_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """(sha, name, path, length, in_temp) of the metrics files of all snapshots: <sha>/<name>.csv, or <sha>/temp/<name>.csv.

    Only the listing is read, not the files.
    """
    return _placed(spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").load(folder).select("path", "length"), F.col("path"))


def _placed(found: DataFrame, path: Column) -> DataFrame:
    """found with sha, name and in_temp, as the path tells them; other files go."""
    whole = F.get(F.regexp_extract_all(path, F.lit(r"/([^/]+)(/temp)?/([^/]+)\.csv$"), F.lit(0)), F.lit(0))
    at = lambda k: F.regexp_extract(whole, r"^/([^/]+)(/temp)?/([^/]+)\.csv$", k)
    more = [c for c in found.columns if c not in ("path", "length")]
    return found.select(at(1).alias("sha"), at(3).alias("name"), "path", "length", (at(2) != "").alias("in_temp"), *more).where("sha <> ''")


#: What opening a file costs, in bytes read meanwhile; Spark's own 4 MB give each task a few dozen small files at most.
OPEN_COST = 256 << 10


def small_files(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """Lines of the files below a folder whose names fit, many small files to a task; the caller's session stays as it is."""
    own = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    own.conf.set("spark.sql.files.openCostInBytes", str(OPEN_COST))
    return own.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(folder)


def read_structure(spark: SparkSession, folder: str) -> DataFrame:
    """A record per snapshot of runs.jsonl in the folder, from the files that its runs left; see structural.ingested().

    Files are listed once and opened once, those of both names together.
    """
    found, rows = structural.metric_files(small_files(spark, folder, "{class,method}.csv"))
    path = F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B")))
    return structural.ingested(_placed(found.withColumnRenamed("file", "path"), path), rows, read_records(spark, f"{folder}/runs.jsonl", RUNS))


def read_json_document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_universe(spark: SparkSession, path: str) -> DataFrame:
    return read_json_document(spark, path, schemas.UNIVERSE)


def read_grid(spark: SparkSession, path: str) -> DataFrame:
    return read_json_document(spark, path, schemas.GRID)


def read_release_grid(spark: SparkSession, path: str) -> DataFrame:
    """(pos, tag, snapshot_sha, version) of a release manifest in any of its forms; see universe.release_grid()."""
    if not exists(spark, path):
        raise FileNotFoundError(f"no release manifest at {path}")
    rows = universe.release_grid(spark.read.text(path, wholetext=True).first()[0], path)
    return spark.createDataFrame(rows, "pos int, tag string, snapshot_sha string, version string")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Commits with their changed Java files; see structural.ledger()."""
    return structural.ledger(spark.read.text(path))


def read_java_commits(spark: SparkSession, path: str) -> DataFrame:
    """The landed listing of Java-touching commits; see universe.java_commits()."""
    return universe.java_commits(spark.read.text(path))


def read_refactorings(spark: SparkSession, base: str) -> DataFrame | None:
    """Refactorings of base.jsonl, else of the one document base.json with its list of commits, else None."""
    if exists(spark, f"{base}.jsonl"):
        return read_records(spark, f"{base}.jsonl", schemas.REFACTORINGS)
    if not exists(spark, f"{base}.json"):
        return None
    whole = read_json_document(spark, f"{base}.json", f"commits array<struct<repository:string,sha1:string,timestamp:bigint,refactorings:array<{schemas.REFACTORING}>>>")
    return whole.select(F.inline("commits"))


def read_channel_state(spark: SparkSession, path: str) -> DataFrame:
    """The sidecar's one row, or none if it is missing or unreadable."""
    if not exists(spark, path):
        return spark.createDataFrame([], schemas.CHANNEL_STATE)
    return read_json_document(spark, path, schemas.CHANNEL_STATE).where("repo IS NOT NULL OR channel IS NOT NULL")


def sidecars(documents: DataFrame, value: str = "value") -> DataFrame:
    """(name, state) of whole JSON documents with the file names they were read from; state is null where unreadable."""
    state = F.from_json(value, schemas.CHANNEL_STATE)
    named = F.regexp_extract("file_name", r"([^/]*?)(?:\.json)?$", 1)
    readable = state["repo"].isNotNull() | state["channel"].isNotNull() | state["is_complete"].isNotNull()
    return documents.select(named.alias("name"), F.when(readable, state).alias("state"))


def read_sidecars(spark: SparkSession, folder: str) -> DataFrame:
    """sidecars() of all *.json files in a folder, read as one table; none if it is not there."""
    if not any(x.endswith(".json") for x in children(spark, folder)):
        return spark.createDataFrame([], f"name string, state struct<{schemas.CHANNEL_STATE}>")
    found = spark.read.text(f"{folder}/*.json", wholetext=True)
    return sidecars(found.select("value", F.col("_metadata.file_name").alias("file_name")))


def csv_rows(spark: SparkSession, folder: str) -> DataFrame:
    """(name, rows) of all CSV files in a folder without their headers, counted in one pass; quoted line breaks are no rows."""
    if not any(x.endswith(".csv") for x in children(spark, folder)):
        return spark.createDataFrame([], "name string, rows bigint")
    lines = spark.read.schema("first string").option("multiLine", True).option("escape", '"').csv(f"{folder}/*.csv")
    per = lines.groupBy(F.regexp_extract("_metadata.file_name", r"([^/]*?)\.csv$", 1).alias("name")).agg(F.count("*").alias("n"))
    return per.select("name", F.greatest(F.lit(0), F.col("n") - 1).alias("rows"))


def read_delimited(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, all columns as text; a byte order mark is no part of the first name."""
    df = spark.read.option("header", True).csv(path)
    return df.toDF(*[c.lstrip("﻿") for c in df.columns])


def row_count(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path).agg(F.count("*").alias("rows"))


def read_commit_messages(spark: SparkSession, path: str) -> DataFrame:
    """Records parted by \\x1e with fields parted by \\x1f: sha, seconds, author, address, text; shorter ones go."""
    lines = spark.read.option("lineSep", "\x1e").text(path)
    return commit_messages(lines)


def commit_messages(lines: DataFrame) -> DataFrame:
    f = F.split(F.col("value"), "\x1f", 5)
    strip = lambda c: F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    return lines.where(F.size(f) >= 5).select(
        strip(f[0]).alias("record_id"), F.lit("git.commit").alias("channel"), f[1].try_cast("bigint").alias("timestamp"), f[2].alias("author"), strip(f[4]).alias("text"),
        F.array().cast("array<string>").alias("labels"), F.lit(None).cast("string").alias("file_path"), F.lit(None).cast("bigint").alias("parent_id"), F.lit(None).cast("string").alias("parent_channel"), f[3].alias("author_email"),
    )


def tool_output(raw: Column) -> Column:
    """Refactorings of a tool's JSON: the first commit's if it lists commits, else those at the top, else none."""
    shape = f"commits array<struct<refactorings:array<{schemas.REFACTORING}>>>, refactorings array<{schemas.REFACTORING}>"
    j = F.from_json(raw, shape)
    none = F.array().cast(f"array<{schemas.REFACTORING}>")
    return F.when(F.size(j["commits"]) > 0, F.coalesce(F.get(j["commits"], F.lit(0))["refactorings"], none)).otherwise(F.coalesce(j["refactorings"], none))
