"""Raw first-parent diffs to files with added and removed lines, and to pieces of text for a model."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstone.functions.text import strip
from loomstone.schemas import FILE_DIFF

HEADER = "diff --git "


def diff_path(line: Column) -> Column:
    """What follows the first " b/" of a header line, else the rest of the header."""
    after = F.get(F.split(line, " b/", 2), F.lit(1))
    return strip(F.coalesce(after, F.substring(line, len(HEADER) + 1, 1 << 30)))


def files_of(raw: Column, keep_marked: bool = False) -> Column:
    """The files of a raw diff by churn, largest first, equal ones in order of appearance.

    A line that starts with "--- " or "+++ " is a header line wherever it stands, so a removed line of "-- x" is lost;
    keep_marked keeps such lines inside a hunk. Text before the first header is no file.

    The text is cut at its headers inside the row, by higher-order functions, so no diff leaves its task.
    """
    def of_sign(lines: Column, sign: str) -> Column:
        """The file's lines of a sign, without it; lines[0] is the rest of the header."""
        hunk = F.array_position(F.transform(lines, lambda x: x.rlike("^@@ .*? @@")), True)  # from 1, 0 if there is none
        inside = lambda i: (hunk > 0) & (i >= hunk) if keep_marked else F.lit(False)
        own = F.filter(lines, lambda x, i: (i > 0) & x.startswith(sign) & (~x.startswith(f"{3 * sign} ") | inside(i)))
        return F.transform(own, lambda x: F.substring(x, 2, 1 << 30))

    def entry(lines: Column, place: Column) -> Column:
        return F.struct(place.alias("place"), diff_path(F.concat(F.lit(HEADER), lines[0])).alias("file"), of_sign(lines, "+").alias("added"), of_sign(lines, "-").alias("removed"))

    def sized(f: Column) -> Column:
        n_added, n_removed = F.size(f["added"]), F.size(f["removed"])
        return F.struct((-(n_added + n_removed)).alias("churn"), f["place"].alias("place"), F.struct(f["file"].alias("file"), f["added"].alias("added"), f["removed"].alias("removed"), n_added.alias("n_added"), n_removed.alias("n_removed")).alias("f"))

    bodies = F.slice(F.split(raw, f"(?dm)^{HEADER}", -1), 2, 1 << 30)
    listed = F.transform(F.transform(bodies, lambda x: F.split(x, "\n", -1)), entry)
    ranked = F.sort_array(F.transform(listed, sized))
    return F.transform(ranked, lambda x: x["f"])


def split_files(diffs: DataFrame, unit: str = "sha1", raw: str = "raw", keep_marked: bool = False) -> DataFrame:
    """(unit, files) of every row with a file, as files_of(); two rows of one unit stay apart."""
    # asked of the text, as a filter on the files would make them twice
    return diffs.where(F.col(raw).rlike(f"(?dm)^{HEADER}")).select(unit, files_of(F.col(raw), keep_marked).alias("files"))


def capped(files: DataFrame, most: int | None) -> DataFrame:
    """The first `most` files with n_files, n_files_total and truncated; none or zero keeps all."""
    total = F.size("files")
    kept = F.slice("files", 1, most) if most and most > 0 else F.col("files")
    return files.withColumns({"n_files_total": total, "files": kept}).withColumns({"n_files": F.size("files"), "truncated": F.size("files") < F.col("n_files_total")})


def diff_status(crashed: Column, n_files: Column) -> Column:
    return F.when(crashed, "crash").when(n_files > 0, "success").otherwise("empty_diff")


def commit_diffs(landed: DataFrame, most: int | None = None) -> DataFrame:
    """Records of commits with their files, of landed (repository, sha1, timestamp, message, parent_shas, raw, crashed)."""
    none = F.array().cast(f"array<{FILE_DIFF}>")
    split = capped(landed.withColumn("files", F.coalesce(files_of(F.col("raw")), none)), most)
    failed = F.coalesce(F.col("crashed"), F.lit(False))
    told = {c: x for c, x in parents(F.coalesce("parent_shas", F.array().cast("array<string>"))).items()}
    return split.withColumns({**told, "status": diff_status(failed, F.col("n_files_total"))}).select(
        "repository", "sha1", "timestamp", "message", "files", "n_files", "n_files_total", "truncated", "is_merge", "n_parents", "status"
    )


def parents(shas: Column) -> dict[str, Column]:
    return {"n_parents": F.size(shas), "is_merge": F.size(shas) > 1}


def not_blank(text: Column) -> Column:
    """Whether strip() leaves anything, told by the first character that it would leave."""
    return text.rlike(r"(?U)\S")


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), where a lambda of a higher-order function would compute the value at each of its uses."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def render_pieces(message: Column, files: Column, most: int | None = None) -> Column:
    """The message, then a piece per file with its removed and its added lines.

    Blank lines go, and with them files that changed nothing else. most caps all pieces; none or zero keeps them all.
    """

    def block(name: str, lines: Column) -> Column:
        joined = F.array_join(F.filter(lines, not_blank), "\n")  # empty only without lines
        return once(joined, lambda x: F.when(x != "", F.concat(F.lit(f"\n<{name}>"), x, F.lit(f"</{name}>"))))

    def piece(f: Column) -> Column:
        changed = F.concat_ws("", block("REMOVED", f["removed"]), block("ADDED", f["added"]))
        return once(changed, lambda x: F.when(x != "", F.concat(F.lit("<FILE>"), f["file"], F.lit("</FILE>"), x)))

    first = F.concat(F.lit("<COMMIT_MESSAGE>"), F.coalesce(message, F.lit("")), F.lit("</COMMIT_MESSAGE>"))
    rest = F.array_compact(F.transform(F.coalesce(files, F.array().cast("array<struct<file:string,added:array<string>,removed:array<string>,n_added:int,n_removed:int>>")), piece))
    pieces = F.concat(F.array(first), rest)
    return F.slice(pieces, 1, most) if most and most > 0 else pieces
