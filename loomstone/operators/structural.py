"""Structural metrics of snapshots: landed class and method rows, nested, with an explicit status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstone.schemas import LEDGER
from loomstone.sources.store import held

# Paths that are not production code.
NON_PRODUCTION = (
    r"(?:^|/)src/(?:test|tests|testinputs|it)/",
    r"(?:^|/)(?:test|tests)/",
    r"(?:Test|Tests|IT)\.java$",
    r"(?:^|/)src/xdocs-examples/",
)


def is_production(path: Column, patterns: tuple[str, ...] = NON_PRODUCTION) -> Column:
    slashed = F.replace(path, F.lit("\\"), F.lit("/"))
    found = F.lit(False)
    for p in patterns:
        found = found | slashed.rlike(p)
    return ~(found | slashed.rlike(r"(?:^|/)\.git/"))


def nest_methods(classes: DataFrame, methods: DataFrame, *by: str) -> DataFrame:
    """Each class row with its methods as an array, empty without any.

    The key is the class name alone, so classes of one name in two files both get all its methods; methods of no class
    are in no row. `by` holds further keys, such as the snapshot.
    """
    keys = [*by, "class"]
    packed = methods.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*[c for c in methods.columns if c not in keys]))).alias("methods"))
    empty = F.array().cast(packed.schema["methods"].dataType)
    return classes.join(packed, keys, "left").withColumn("methods", F.coalesce("methods", empty))


def status(exit_ok: Column, timed_out: Column, class_file: Column, n_classes: Column, n_methods: Column, checked_out: Column | None = None) -> Column:
    """A failed run is told before its files are looked at."""
    said = F.when(timed_out, "timeout").when(~exit_ok, "crash").when(~class_file, "missing_output").when(n_classes == 0, "empty_output").when(n_methods == 0, "empty_methods").otherwise("success")
    return said if checked_out is None else F.when(~checked_out, "checkout_failed").otherwise(said)


def located(found: DataFrame, *by: str, names: tuple[str, ...] = ("class", "method")) -> DataFrame:
    """Per snapshot, where each metrics file is: <name>_path and <name>_source, of rows (by, name, path, length, in_temp).

    Each file is looked for by itself: the tool's own folder first, then the repository's root. An empty file counts as
    absent; one with a header only does not. If found has n_rows, the file's is in <name>_rows.
    """
    there = F.col("length") > 0
    more = ["n_rows"] if "n_rows" in found.columns else []
    best = {n: F.min(F.when(there & (F.col("name") == n), F.struct((~F.col("in_temp")).alias("fallback"), "path", *more))) for n in names}
    per = found.groupBy(*by).agg(*[c.alias(n) for n, c in best.items()])
    source = lambda n: F.when(F.col(n).isNull(), "absent").when(F.col(f"{n}.fallback"), "repo_root").otherwise("temp")
    return per.select(*by, *[c for n in names for c in (F.col(f"{n}.path").alias(f"{n}_path"), source(n).alias(f"{n}_source"), *[F.col(f"{n}.n_rows").alias(f"{n}_rows") for _ in more])])


#: Columns of a metrics file, at most.
WIDEST = 96


def _lines(text: DataFrame, value: str) -> DataFrame:
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("length"), place.alias("place"), F.col(value).alias("line"))


def _kept(text: DataFrame, value: str) -> DataFrame:
    """Lines of CSV files, kept once: many small files are opened once, whatever is asked of them, and all see one numbering."""
    return held(_lines(text, value), "metric-lines")


def _rows(kept: DataFrame) -> DataFrame:
    def fields(line: str) -> Column:
        parsed = F.from_csv(line, ", ".join(f"c{k} string" for k in range(WIDEST)))
        return F.array(*[parsed[f"c{k}"] for k in range(WIDEST)])

    each = kept.where(F.trim("line") != "").select("file", "place", "line")
    header = each.groupBy("file").agg(F.min_by("line", "place").alias("header"), F.min("place").alias("first"))
    names = F.filter(F.transform(fields("header"), lambda x: F.ltrim(x, F.lit("\ufeff"))), lambda x: x.isNotNull())
    rows = each.join(header.withColumn("header", names), "file").where("place > first")
    return rows.select("file", F.map_from_arrays("header", F.slice(fields("line"), F.lit(1), F.size("header"))).alias("metrics"))


def metric_rows(lines: DataFrame, value: str = "value") -> DataFrame:
    """(file, metrics) of the rows of CSV files given as lines, each as a map by its own file's header.

    Files of tools of several versions may differ in their columns. A byte order mark is no part of the first name; fields
    that a row lacks are null; blank lines are no rows.
    """
    return _rows(_kept(lines, value))


def _counts(lines: DataFrame) -> DataFrame:
    rows = F.greatest(F.lit(0), F.count_if(F.trim("line") != "") - 1)
    return held(lines.groupBy("file", "length").agg(rows.alias("n_rows")), "metric-counts")


def metric_counts(lines: DataFrame, value: str = "value") -> DataFrame:
    """(file, length, n_rows) of CSV files given as lines, of one reading of all their lines.

    Rows are the lines that are not blank but for the header, so nothing is parsed, kept or joined to count them. Files of no
    bytes have no lines and are not among them.
    """
    return _counts(_lines(lines, value))


def metric_files(lines: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """metric_counts() and metric_rows() of one reading."""
    kept = _kept(lines, value)
    return _counts(kept), _rows(kept)


def _run_files(files: DataFrame, runs: DataFrame) -> DataFrame:
    """runs with located() files; read tells whether they count."""
    ended = F.coalesce("exit_ok", F.lit(False)) & ~F.coalesce("timed_out", F.lit(False)) & F.coalesce("checked_out", F.lit(True))
    return runs.join(located(files, "sha"), "sha", "left").withColumns({"read": ended & F.col("class_path").isNotNull(), "class_source": F.coalesce("class_source", F.lit("absent")), "method_source": F.coalesce("method_source", F.lit("absent"))})


def _record(known: DataFrame, *more: Column) -> DataFrame:
    n_classes, n_methods = (F.when(F.col("read"), F.coalesce(c, F.lit(0))).otherwise(0) for c in ("class_rows", "method_rows"))
    said = status(F.coalesce("exit_ok", F.lit(False)), F.coalesce("timed_out", F.lit(False)), F.col("class_path").isNotNull(), n_classes, n_methods, F.coalesce("checked_out", F.lit(True)))
    return known.select("sha", "timestamp", said.alias("status"), n_classes.alias("n_classes"), n_methods.alias("n_methods"), F.col("class_source").alias("csv_source"), "method_source", "n_removed", *more)


def counted(files: DataFrame, runs: DataFrame) -> DataFrame:
    """One record per snapshot of a tool's runs: status, counts, and where its files were found.

    files: (sha, name, path, length, in_temp, n_rows) of metric_counts(); those of the located files count. runs: (sha,
    timestamp, exit_ok, timed_out, checked_out, n_removed). Of a run that failed nothing counts, whatever files it left; without
    a class file methods are not read.
    """
    return _record(_run_files(files, runs))


def ingested(files: DataFrame, rows: DataFrame, runs: DataFrame) -> DataFrame:
    """counted() records with a report: their classes with their methods, of the metric_rows() of the files."""
    known = _run_files(files, runs)

    def of(name: str) -> DataFrame:
        paths = known.where("read").select("sha", F.col(f"{name}_path").alias("file")).distinct()
        return rows.join(paths, "file").select("sha", F.col("metrics")["class"].alias("class"), "metrics")

    nested = nest_methods(of("class"), of("method").select("sha", "class", F.to_json("metrics").alias("method")), "sha")
    report = nested.groupBy("sha").agg(F.array_sort(F.collect_list(F.struct("class", F.to_json("metrics").alias("metrics"), F.transform("methods", lambda m: m["method"]).alias("methods")))).alias("report"))
    own = F.coalesce(F.when(F.col("read"), F.col("report")), F.array().cast(report.schema["report"].dataType))
    return _record(known.join(report, "sha", "left"), own.alias("report"))


def java_only(modifications: Column) -> Column:
    """The changes of files whose name ends with .java, by case; those without any path go."""
    path = lambda m: F.coalesce(F.nullif(m["file"], F.lit("")), F.nullif(m["old_file"], F.lit("")))
    return F.filter(modifications, lambda m: F.coalesce(path(m).endswith(".java"), F.lit(False)))


def ledger(landed: DataFrame, value: str = "value") -> DataFrame:
    """Commits with their changed Java files, from landed JSON lines; a line that is no JSON goes."""
    parsed = landed.select(F.from_json(value, LEDGER).alias("j")).where("j.sha IS NOT NULL").select("j.*")
    return parsed.withColumn("modifications", F.coalesce(java_only(F.col("modifications")), F.array().cast(parsed.schema["modifications"].dataType)))
