"""What has been mined: one row per artifact, null where nothing can be said, which is not zero."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Statuses that count as measured, and as measured but empty.
OK, EMPTY = ("success",), ("empty_output", "empty_methods")
COLUMNS = ("stage", "artifact", "present", "records", "units", "ok", "empty", "failed", "duplicates", "statuses", "note")


def artifact_coverage(lines: DataFrame, stage: str, artifact: str, unit: str | None, order: str = "ingest_seq", status: str | None = "status") -> DataFrame:
    """One row about non-blank lines with the columns unit, order, status and _corrupt (all but order optional).

    The last attempt of a unit counts; lines without an id are units of their own; without a unit column every line is.
    Statuses are told only if any line has one; a unit whose last line has none is unlabelled, and failed.
    """
    has = lambda c: c is not None and c in lines.columns
    corrupt = F.col("_corrupt").isNotNull() if "_corrupt" in lines.columns else F.lit(False)
    said = F.col(status) if has(status) else F.lit(None).cast("string")
    uid = F.col(unit).cast("string") if has(unit) else F.col(order).cast("string")
    plain = lines.select(corrupt.alias("bad"), F.when(~corrupt, said).alias("status"), F.when(~corrupt, uid).alias("uid"), F.col(order).alias("o"))
    # one sum per unit; lines without an id and corrupt ones meet under a null unit
    per = plain.groupBy("uid").agg(F.count("*").alias("records"), F.count_if("bad").alias("malformed"), F.max_by("status", "o").alias("last"), F.count("status").alias("with_status"))
    named = F.col("uid").isNotNull()
    label = F.when(named, F.coalesce(F.nullif("last", F.lit("")), F.lit("unlabelled")))
    counted = per.agg(
        F.coalesce(F.sum("records"), F.lit(0)).alias("records"), F.coalesce(F.sum("malformed"), F.lit(0)).alias("malformed"),
        (F.count_if(named) + F.coalesce(F.sum(F.when(~named, F.col("records") - F.col("malformed"))), F.lit(0))).alias("units"),
        F.coalesce(F.sum("with_status") > 0, F.lit(False)).alias("told"),
        F.count_if(label.isin(*OK)).alias("ok"), F.count_if(label.isin(*EMPTY)).alias("empty"), F.coalesce(F.sum(F.when(~named, F.col("records") - F.col("malformed"))), F.lit(0)).alias("anonymous"),
    )
    tally = per.select(label.alias("label")).where("label IS NOT NULL").groupBy("label").agg(F.count("*").alias("n"))
    joined = tally.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("label", "n"))), lambda x: F.concat_ws("=", x["label"], x["n"].cast("string"))), ";").alias("statuses"))
    told = lambda c: F.when(F.col("told"), c)
    duplicates = F.greatest(F.lit(0), F.col("records") - F.col("units") - F.col("malformed"))
    note = F.concat_ws(", ", *[F.when(c > 0, F.concat(c.cast("string"), F.lit(text))) for c, text in ((duplicates, " retried"), (F.col("malformed"), " unparseable"), (F.col("anonymous") if has(unit) else F.lit(0), f" without {unit}"))])
    both = counted.withColumn("k", F.lit(1)).join(joined.withColumn("k", F.lit(1)), "k")
    return both.select(
        F.lit(stage).alias("stage"), F.lit(artifact).alias("artifact"), F.lit(True).alias("present"), "records", "units", told(F.col("ok")).alias("ok"), told(F.col("empty")).alias("empty"),
        told(F.col("units") - F.col("ok") - F.col("empty")).alias("failed"), duplicates.alias("duplicates"), told(F.col("statuses")).alias("statuses"), note.alias("note"),
    )


def absent(spark, stage: str, artifact: str) -> DataFrame:
    """The row of an artifact that nobody has mined."""
    return spark.range(1).select(F.lit(stage).alias("stage"), F.lit(artifact).alias("artifact"), F.lit(False).alias("present"), *[F.lit(None).cast("bigint").alias(c) for c in ("records", "units", "ok", "empty", "failed", "duplicates")], F.lit(None).cast("string").alias("statuses"), F.lit("not mined yet").alias("note"))


# What a channel's note says of its state.
NO_STATE, COMPLETE, INCOMPLETE, THROUGH_PAGE, WINDOW_FROM, PAUSED = "no state file", "complete", "INCOMPLETE — re-run to continue", "through page ", "window from ", "paused on API quota"


def channel_note(inner: Column, has_state: Column, complete: Column, page: Column, window: Column, quota: Column) -> Column:
    """Whether a channel's collection was finished, and if not, how far it came."""
    going = F.concat_ws(
        "; ", F.lit(INCOMPLETE), F.when(page > 0, F.concat(F.lit(THROUGH_PAGE), page.cast("string"))),
        F.when(window != "", F.concat(F.lit(WINDOW_FROM), F.substring(window, 1, 10))), F.when(quota.isNotNull() & (quota != 0), PAUSED),
    )
    state = F.when(~has_state, NO_STATE).when(complete, COMPLETE).otherwise(going)
    return F.concat_ws("; ", F.nullif(inner, F.lit("")), state)


def with_channel_notes(rows: DataFrame, sidecars: DataFrame) -> DataFrame:
    """A report's channel rows with what their sidecars tell, see files.sidecars(); a channel that is not there has nothing to tell."""
    known = sidecars.select(F.col("name").alias("artifact"), "state", F.lit(True).alias("__told"))
    told = rows.join(known, "artifact", "left")
    s = F.col("state")
    page, window = F.coalesce(s["last_page_done"], F.lit(0)), F.coalesce(s["window_since"], F.lit(""))
    note = channel_note(F.col("note"), s.isNotNull(), F.coalesce(s["is_complete"], F.lit(False)), page, window, s["rate_limit_reset"])
    return told.withColumn("note", F.when(F.col("present") | s.isNotNull(), note).otherwise(F.col("note"))).select(*rows.columns)


def csv_coverage(spark: SparkSession, stage: str, names: list[str], counted: DataFrame) -> DataFrame:
    """One row for each exported CSV of the names, of counted (name, rows); one that is not there is absent."""
    wanted = spark.createDataFrame([(n,) for n in names], "artifact string").join(counted.select(F.col("name").alias("artifact"), "rows"), "artifact", "left")
    there, none = F.col("rows").isNotNull(), F.lit(None).cast("bigint")
    return wanted.select(
        F.lit(stage).alias("stage"), "artifact", there.alias("present"), F.col("rows").alias("records"), F.col("rows").alias("units"), *[none.alias(c) for c in ("ok", "empty", "failed")],
        F.when(there, F.lit(0).cast("bigint")).alias("duplicates"), F.lit(None).cast("string").alias("statuses"), F.when(there, "").otherwise("not mined yet").alias("note"),
    )


def totals(rows: DataFrame) -> DataFrame:
    """One row over a report: failed units, units of what is present, and what is missing."""
    missing = F.array_sort(F.collect_list(F.when(~F.col("present"), F.col("artifact"))))
    return rows.agg(F.coalesce(F.sum("failed"), F.lit(0)).alias("failed"), F.coalesce(F.sum(F.when(F.col("present"), F.col("units"))), F.lit(0)).alias("units"), missing.alias("missing"))


def exported(rows: DataFrame) -> DataFrame:
    """The report's columns as text, null as blank."""
    return rows.select(*[F.coalesce(F.col(c).cast("int").cast("string") if c == "present" else F.col(c).cast("string"), F.lit("")).alias(c) for c in COLUMNS])


#: What a console shows of a report.
SHOWN = ("artifact", "records", "units", "ok", "empty", "failed", "note")


def rendered(rows: DataFrame) -> list[str]:
    """The report as lines for a console: columns as wide as what they hold, then the totals."""
    told = exported(rows).select("present", *SHOWN).collect()
    cells = [list(SHOWN)] + [list(r[1:]) for r in told]
    wide = [max(map(len, column)) for column in zip(*cells, strict=True)]
    lines = ["  ".join(x.ljust(w) for x, w in zip(row, wide, strict=True)).rstrip() for row in cells]
    sums = totals(rows).first()
    lines.append(f"in all: {sums['units']} units, {sums['failed']} of them to be tried again")
    missing = [r["artifact"] for r in told if r["present"] != "1"]
    return lines + ([f"still to mine: {', '.join(missing)}"] if missing else [])
