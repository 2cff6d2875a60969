"""Commit sets: lineage, ancestors, pinned universes, release grids and tags."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstone.functions.text import version
from loomstone.operators.history import ancestors  # noqa: F401  a question about commit sets too


def lineage(lines: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """(sha, parent_shas, timestamp, *keep) of lines sha|parents|seconds; lines of any other number of fields go."""
    parts = F.split(F.col(value), r"\|", -1)
    shas = F.filter(F.split(F.trim(F.get(parts, F.lit(1))), " +"), lambda x: x != "")
    return lines.where(F.size(parts) == 3).select(F.trim(F.get(parts, F.lit(0))).alias("sha"), shas.alias("parent_shas"), F.trim(F.get(parts, F.lit(2))).alias("timestamp"), *keep)


def java_commits(lines: DataFrame, value: str = "value") -> DataFrame:
    """(sha, timestamp) of lines sha|seconds, the landed listing of commits that touch Java files; lines of other forms go."""
    parts = F.split(F.trim(F.col(value)), r"\|", -1)
    return lines.where(F.size(parts) == 2).select(F.trim(parts[0]).alias("sha"), F.trim(parts[1]).try_cast("bigint").alias("timestamp"))


def listing(commits: DataFrame, members: DataFrame | None = None, newest_first: bool = True) -> DataFrame:
    """commits with pos, oldest first, of the members alone if given; the landed ordinal `seq` tells the order, not the dates.

    newest_first: how the lineage was landed. pos tells places only; it has gaps where commits are left out.
    """
    kept = commits if members is None else commits.join(members.select("sha").distinct(), "sha", "left_semi")
    return kept.withColumn("pos", -F.col("seq") if newest_first else F.col("seq")).orderBy("pos")


def absent_commits(shas: DataFrame, lineage_: DataFrame) -> DataFrame:
    """Those of the shas that are no commit of the lineage."""
    return shas.select("sha").where(F.coalesce(F.col("sha"), F.lit("")) != "").distinct().join(lineage_, "sha", "left_anti")


def commit_kinds(commits: DataFrame) -> DataFrame:
    """One row: commits, roots and merges."""
    n = F.size("parent_shas")
    return commits.agg(F.count("*").alias("commits"), F.count_if(n == 0).alias("roots"), F.count_if(n >= 2).alias("merges"))


def check_manifest(manifest: dict, repo: str) -> dict:
    """A universe manifest that names this repository, a head, and further heads as text; else ValueError with all faults."""
    near = manifest.get("near_mainline_shas", [])
    faults = [
        *([f"the manifest is of {manifest.get('repo')!r}, not {repo!r}"] if manifest.get("repo") != repo else []),
        *(["head_sha is missing"] if not manifest.get("head_sha") else []),
        *(["near_mainline_shas is no list of text"] if not isinstance(near, list) or not all(isinstance(x, str) for x in near) else []),
    ]
    if faults:
        raise ValueError("; ".join(faults))
    return {"head_sha": manifest["head_sha"], "near_mainline_shas": near, "head_commits": manifest.get("head_commits")}


def grid_entries(manifest: DataFrame, *by: str) -> DataFrame:
    """(*by, pos, tag, snapshot_sha) of release manifests; `sha` is an older name of snapshot_sha."""
    e = manifest.select(*by, F.posexplode("entries").alias("pos", "e"))
    return e.select(*by, "pos", F.col("e.tag").alias("tag"), F.coalesce(F.nullif("e.snapshot_sha", F.lit("")), F.nullif("e.sha", F.lit(""))).alias("snapshot_sha")).where("snapshot_sha IS NOT NULL")


def release_grid(text: str, name: str = "the manifest") -> list[tuple[int, str | None, str | None, str | None]]:
    """(pos, tag, snapshot_sha, version) rows of one manifest, all its faults told as ValueError.

    Entries hold tags and commits; the older forms, a list or {"versions": [...]}, hold version numbers only, to be found
    among the tags by match_versions().
    """
    try:
        found = json.loads(text)
    except ValueError as e:
        raise ValueError(f"{name} is not valid JSON: {e}") from e
    if isinstance(found, dict) and "entries" in found:
        rows = [(k, e.get("tag"), e.get("snapshot_sha") or e.get("sha"), e.get("version")) for k, e in enumerate(found["entries"] or [])]
        faults = [f"entry {k} lacks a tag or a commit" for k, tag, sha, _ in rows if not tag or not sha]
        if faults or not rows:
            raise ValueError(f"{name}: {'; '.join(faults) or 'no entries'}")
        return rows
    versions = found if isinstance(found, list) else found.get("versions") if isinstance(found, dict) else None
    if not isinstance(versions, list):
        raise ValueError(f"{name} has an unknown form")
    return [(k, None, None, str(v)) for k, v in enumerate(versions)]


def first_tags(entries: DataFrame, sha: str = "snapshot_sha") -> DataFrame:
    """(sha, tag): the first tag of each commit."""
    return entries.groupBy(sha).agg(F.min_by("tag", "pos").alias("tag"))


def in_order(grid: DataFrame, listing: DataFrame) -> DataFrame:
    """The grid's commits in the listing's order; a commit outside it is an error."""
    shas = grid.select(F.col("snapshot_sha").alias("sha")).distinct()
    lost = [r[0] for r in shas.join(listing, "sha", "left_anti").limit(5).collect()]
    if lost:
        raise ValueError(f"snapshots outside the history: {', '.join(lost)}")
    return listing.join(shas, "sha", "left_semi").orderBy("pos")


def tag_map(tags: DataFrame) -> DataFrame:
    """(version, tag, sha): the last tag of each normalised version wins."""
    normal = tags.withColumn("version", version(F.col("tag"))).where("version <> ''")
    last = F.max_by(F.struct("tag", "sha"), "pos").alias("t")
    return normal.groupBy("version").agg(last).select("version", "t.tag", "t.sha")


def peeled_tags(lines: DataFrame, value: str = "value") -> DataFrame:
    """(pos, tag, sha) of lines "tag object peeled"; the peeled commit counts if there is one."""
    p = F.split(F.col(value), " ")
    return lines.select("pos", F.get(p, F.lit(0)).alias("tag"), F.coalesce(F.nullif(F.get(p, F.lit(2)), F.lit("")), F.get(p, F.lit(1))).alias("sha"))


def candidates(v: Column) -> Column:
    """The forms under which a version may be tagged, best first."""
    return F.array(v, F.concat(v, F.lit(".0")), F.replace(v, F.lit(".0"), F.lit("")))


def match_versions(versions: DataFrame, tags: DataFrame) -> DataFrame:
    """(version, tag, sha): the first candidate form that has a tag."""
    tried = versions.select(F.col("version").alias("wanted"), F.posexplode(candidates(F.col("version"))).alias("k", "version"))
    hit = tried.join(tag_map(tags), "version")
    return hit.groupBy("wanted").agg(F.min_by(F.struct("tag", "sha"), "k").alias("t")).select(F.col("wanted").alias("version"), "t.tag", "t.sha")


def reachable_against_manifest(reached: DataFrame, manifests: DataFrame) -> DataFrame:
    """(repo, reachable, head_commits, agrees): commits reached from each head, and how many the manifest tells; null agrees with all."""
    counted = reached.groupBy("repo").agg(F.count_distinct("sha").alias("reachable"))
    both = manifests.select("repo", "head_commits").join(counted, "repo", "left").withColumn("reachable", F.coalesce("reachable", F.lit(0).cast("bigint")))
    return both.select("repo", "reachable", "head_commits", F.coalesce(F.nullif("head_commits", F.lit(0)) == F.col("reachable"), F.lit(True)).alias("agrees"))


def cochanges(files: DataFrame, commit: str, file: str, each: int = 1 << 18) -> DataFrame:
    """(a, b, n): in how many commits two files changed together, a before b.

    Commits, and then pairs, are dealt to so many tasks that one has about `each` of the counted rows: their number grows with
    the table, and not their memory. Pairs are counted where they meet, as those of one task of commits hardly repeat.
    """
    own = files.select(F.col(commit).alias("commit"), F.col(file).alias("file"))
    tasks = 1 + own.count() // each
    changed = own.repartition(tasks, "commit").distinct()
    pairs = changed.withColumnRenamed("file", "a").join(changed.withColumnRenamed("file", "b"), "commit").where("a < b")
    return pairs.select("a", "b").repartition(2 * tasks, "a", "b").groupBy("a", "b").agg(F.count("*").alias("n"))
