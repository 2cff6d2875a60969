"""Discourse to commits: five routes of evidence, one edge table.

The second pass joins comments to the kept edges of the first. What several branches read, the commits of pull requests
and the edges of the first pass, is written once to the shared folder, so no branch computes it again. An edge's target must
be in the universe; candidates that name a commit absent from it are counted before anything is made distinct.

Comments have by far the most edges, as each takes all of its parent's. What a parent hands on is therefore filtered, flagged
and made distinct before comments meet it, and no exchange follows: comments and parents are shuffled, their edges are not.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstone.functions.text import API, CLOSES, MENTIONS, percent, references, truthy
from loomstone.operators.events import Observed
from loomstone.sources.store import held

# Channel and route names.
CH_PR, CH_ISSUE, CH_REVIEW, CH_COMMENT = "github.pr", "github.issue", "github.pr_review", "github.comment"
MERGE_COMMIT, ISSUE_PR, MESSAGE, PARENT_PR, PARENT_NUMBER = "merge_commit_sha", "issue_pr_merge", "commit_message", "parent_pr_merge", "parent_number"
EXACT = (MERGE_COMMIT, PARENT_PR)
CHANNELS = (CH_PR, CH_ISSUE, CH_REVIEW, CH_COMMENT)
KEY = ["source_channel", "source_id", "target_sha", "route"]
EDGE = ["source_channel", "source_id", "resolved_via", "target_sha", "route", "ref_kind"]


class LinkInputError(ValueError):
    """The inputs cannot be linked: nothing mined, or no commit universe."""


@dataclass(frozen=True)
class Tables:
    """What linking reads. Membership tables are None where their stage has not run, which is not the same as empty."""

    lineage: DataFrame
    prs: DataFrame
    issues: DataFrame
    reviews: DataFrame
    comments: DataFrame
    commits: DataFrame
    ledger: DataFrame | None = None
    refm: DataFrame | None = None
    structure: DataFrame | None = None
    merged: DataFrame | None = None  # pr_commits(prs), if it is already at hand

    @property
    def pr_shas(self) -> DataFrame:
        return pr_commits(self.prs) if self.merged is None else self.merged

    def prepared(self, seen: Observed | None = None) -> Tables:
        """With the commits of pull requests at hand; lines read and numbers merged are counted on the way."""
        if seen is None:
            return replace(self, merged=held(self.pr_shas, "merged"))
        lines = replace(self, prs=seen.watch(self.prs, pull_lines=F.count("*")))
        return replace(self, merged=held(seen.watch(lines.pr_shas, merged_pulls=F.count("*")), "merged"))


@dataclass(frozen=True)
class EdgeRoute:
    """A way to find edges: pass 1 reads tables, pass 2 also reads the edges of pass 1.

    whole, if there is one, gives what deduped() makes of a pass-2 route's kept edges, by a shorter way.
    """

    name: str
    pass_number: int
    find: Callable[..., DataFrame]
    whole: Callable[..., DataFrame] | None = None


def check_inputs(tables: Tables) -> None:
    if "sha" not in tables.lineage.columns:
        raise LinkInputError("the lineage is of an old format; run its stage again")
    if tables.lineage.isEmpty():
        raise LinkInputError("the commit universe is empty; run the lineage stage first")
    if tables.prs.isEmpty() and tables.issues.isEmpty() and tables.commits.isEmpty():
        raise LinkInputError("no channel records to link; mine a channel first")


def pr_commits(prs: DataFrame) -> DataFrame:
    """(pr, sha) of merged pull requests. Of repeated numbers the last merged record counts, by ingest_seq if there."""
    merged = prs.where(truthy(F.col("record_id")) & truthy(F.col("merged_at")) & truthy(F.col("merge_commit_sha")))
    order = F.col("ingest_seq") if "ingest_seq" in prs.columns else F.struct("merged_at", "merge_commit_sha")
    return merged.groupBy(F.col("record_id").alias("pr")).agg(F.max_by("merge_commit_sha", order).alias("sha"))


def named_numbers(records: DataFrame, owner: str) -> DataFrame:
    """(owner, number, ref_kind): what the text of each record with an id names, each once."""
    kept = records.where(truthy(F.col("record_id"))).select(F.col("record_id").alias(owner), F.explode(references(F.col("text"))).alias("r"))
    return kept.select(owner, "r.number", "r.ref_kind").distinct()


def channel_of(numbers: DataFrame, issues: DataFrame, prs: DataFrame, column: str = "number") -> DataFrame:
    """Adds source_channel: issue first, else pull request; rows of numbers that nobody mined go."""
    known = issues.select(F.col("record_id").alias(column), F.lit(0).alias("rank")).unionByName(prs.select(F.col("record_id").alias(column), F.lit(1).alias("rank")))
    ranked = known.where(truthy(F.col(column))).groupBy(column).agg(F.min("rank").alias("rank"))
    return numbers.join(ranked, column).withColumn("source_channel", F.when(F.col("rank") == 0, CH_ISSUE).otherwise(CH_PR)).drop("rank")


def _edges(df: DataFrame, channel: str | Column, source: str, via: str, route: str, kind: str | Column) -> DataFrame:
    return df.select(*_edge_columns(channel, source, via, route, kind))


def _edge_columns(channel: str | Column, source: str, via: str, route: str, kind: str | Column) -> list[Column]:
    as_column = lambda x: F.lit(x) if isinstance(x, str) else x
    return [as_column(channel).alias("source_channel"), F.col(source).alias("source_id"), F.col(via).alias("resolved_via"), F.col("sha").alias("target_sha"), F.lit(route).alias("route"), as_column(kind).alias("ref_kind")]


def by_merge_commit(t: Tables) -> DataFrame:
    return _edges(t.pr_shas, CH_PR, "pr", "pr", MERGE_COMMIT, API)


def by_issue_in_pr(t: Tables) -> DataFrame:
    named = channel_of(named_numbers(t.prs, "pr"), t.issues, t.prs).join(t.pr_shas, "pr")
    return _edges(named, F.col("source_channel"), "number", "number", ISSUE_PR, F.col("ref_kind"))


def by_commit_message(t: Tables) -> DataFrame:
    named = channel_of(named_numbers(t.commits, "sha").withColumn("sha", F.col("sha").cast("string")), t.issues, t.prs)
    return _edges(named, F.col("source_channel"), "number", "number", MESSAGE, F.col("ref_kind"))


def by_review_parent(t: Tables) -> DataFrame:
    own = t.reviews.where(truthy(F.col("parent_id")) & truthy(F.col("record_id"))).select("record_id", F.col("parent_id").alias("pr"))
    return _edges(own.join(t.pr_shas, "pr"), CH_REVIEW, "record_id", "pr", PARENT_PR, API)


def by_comment_parent(t: Tables, first: DataFrame) -> DataFrame:
    """Each comment takes every distinct edge kind of its parent number, those found by reviews among them."""
    own = t.comments.where(truthy(F.col("parent_id")) & truthy(F.col("record_id"))).select("record_id", F.col("parent_id").alias("number"))
    # one row for each commit and kind: what a comment inherits does not tell the routes apart
    inherited = first.select(F.col("resolved_via").alias("number"), F.col("target_sha").alias("sha"), "ref_kind").distinct()
    return _edges(own.join(inherited, "number"), CH_COMMENT, "record_id", "number", PARENT_NUMBER, F.col("ref_kind"))


def comment_edges(t: Tables, first: DataFrame, also: tuple[str, ...] = (), seen: Observed | None = None) -> DataFrame:
    """deduped() of by_comment_parent(), without an exchange of edges; `also` are columns of the target commit.

    A comment of one parent has each of its commits once, as its parent has. Those that records give several parents are made
    distinct afterwards. Targets are those of the first pass, so none is absent.
    """
    own = t.comments.where(truthy(F.col("parent_id")) & truthy(F.col("record_id"))).select("record_id", F.col("parent_id").alias("number"))
    per = own.groupBy("record_id").agg(F.min("number").alias("number"), F.max("number").alias("last"), F.count("*").alias("times"))
    one = per.where("number = last").drop("last")
    several = own.join(per.where("number < last").select("record_id"), "record_id", "left_semi").withColumn("times", F.lit(1).cast("bigint"))
    kinds = [] if seen is None else [F.count_distinct("ref_kind").alias("kinds")]
    best = F.min(F.struct(rank(F.col("ref_kind")).alias("rank"), "ref_kind")).alias("best")
    handed = first.groupBy(F.col("resolved_via").alias("number"), F.col("target_sha").alias("sha")).agg(best, *kinds, *[F.max(c).alias(c) for c in also])

    def met(comments: DataFrame) -> DataFrame:
        found = comments.join(handed, "number")
        if seen is not None:
            found = seen.watch(found, candidates=F.sum(F.col("times") * F.col("kinds")))
        found = found.withColumn("ref_kind", F.col("best.ref_kind"))
        return found.select(*_edge_columns(CH_COMMENT, "record_id", "number", PARENT_NUMBER, F.col("ref_kind")), *also)

    return met(one).unionByName(deduped(met(several), also))


ROUTES = (
    EdgeRoute("pull request -> merge commit", 1, by_merge_commit), EdgeRoute("issue -> pull request -> merge commit", 1, by_issue_in_pr),
    EdgeRoute("commit message -> number", 1, by_commit_message), EdgeRoute("review comment -> parent pull request", 1, by_review_parent),
    EdgeRoute("comment -> parent", 2, by_comment_parent, comment_edges),
)


def in_universe(candidates: DataFrame, lineage: DataFrame, seen: Observed | None = None) -> DataFrame:
    """Candidates whose target is a known commit; the others are counted on the way, as dropped_absent."""
    known = lineage.select(F.col("sha").alias("target_sha")).distinct()
    if seen is None:
        return candidates.join(known, "target_sha", "left_semi").select(*EDGE)
    told = candidates.join(known.withColumn("known", F.lit(True)), "target_sha", "left")
    told = seen.watch(told, candidates=F.count("*"), dropped_absent=F.count_if(F.col("known").isNull() & truthy(F.col("target_sha"))))
    return told.where("known").select(*EDGE)


def first_pass_candidates(t: Tables, routes: tuple[EdgeRoute, ...] = ROUTES) -> DataFrame:
    found = [r.find(t) for r in routes if r.pass_number == 1]
    union = found[0]
    for more in found[1:]:
        union = union.unionByName(more)
    return union


def collect(t: Tables, routes: tuple[EdgeRoute, ...] = ROUTES, seen: Observed | None = None) -> DataFrame:
    """All found edges, the second pass's after those of the first, not yet distinct."""
    t = t.prepared(seen)
    first = held(in_universe(first_pass_candidates(t, routes), t.lineage, seen), "first-pass")
    union = first
    for r in (r for r in routes if r.pass_number == 2):
        union = union.unionByName(in_universe(r.find(t, first), t.lineage, seen))
    return union


def rank(kind: Column) -> Column:
    return F.when(kind == API, 0).when(kind == CLOSES, 1).when(kind == MENTIONS, 2).otherwise(9)


def deduped(edges: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """One row per (channel, record, commit, route) with its strongest kind; `also` are columns of the target commit."""
    best = F.min(F.struct(rank(F.col("ref_kind")).alias("rank"), "ref_kind", "resolved_via"))
    found = edges.groupBy(*KEY).agg(best.alias("best"), *[F.max(c).alias(c) for c in also])
    return found.select("source_channel", "source_id", F.col("best.resolved_via").alias("resolved_via"), "target_sha", "route", F.col("best.ref_kind").alias("ref_kind"), *also)


def with_exact(edges: DataFrame) -> DataFrame:
    return edges.withColumn("exact", F.col("route").isin(*EXACT).cast("int"))


def with_membership(edges: DataFrame, **tables: DataFrame | None) -> DataFrame:
    """Adds in_<name> for each table of shas: 1 or 0, or null where the table is None."""
    for name, table in tables.items():
        if table is None:
            edges = edges.withColumn(f"in_{name}", F.lit(None).cast("int"))
            continue
        field = "sha1" if "sha1" in table.columns else "sha"
        shas = table.where(truthy(F.col(field))).select(F.col(field).alias("target_sha")).distinct().withColumn(f"in_{name}", F.lit(1))
        edges = edges.join(shas, "target_sha", "left").withColumn(f"in_{name}", F.coalesce(F.col(f"in_{name}"), F.lit(0)))
    return edges


def distinct_edges(t: Tables, routes: tuple[EdgeRoute, ...] = ROUTES, seen: Observed | None = None, **membership: DataFrame | None) -> DataFrame:
    """deduped(collect()), with membership flags if asked for, where edges of the second pass need no exchange."""
    t, flags = t.prepared(seen), tuple(f"in_{name}" for name in membership)
    # flags are looked up by target, as the universe is: one exchange serves all
    first = held(with_membership(in_universe(first_pass_candidates(t, routes), t.lineage, seen), **membership), "first-pass")
    union = deduped(first, flags)
    for r in (r for r in routes if r.pass_number == 2):
        if r.whole is None:
            more = with_membership(deduped(in_universe(r.find(t, first), t.lineage, seen)), **membership)
        else:
            more = r.whole(t, first, flags, seen)
        union = union.unionByName(more)
    return union


def edge_table(t: Tables, seen: Observed | None = None) -> DataFrame:
    """The whole edge table, in no order, or an error that tells which input is missing.

    With `seen`, candidates, those dropped as absent, and pull requests read and merged are counted as the table is written.
    """
    check_inputs(t)
    edges = with_exact(distinct_edges(t, seen=seen, ledger=t.ledger, refm=t.refm, ck=t.structure))
    return edges.select(*EDGE, "exact", "in_ledger", "in_refm", "in_ck")


def link(t: Tables, seen: Observed | None = None) -> DataFrame:
    """edge_table() in its fixed order, for exports; ordering moves every edge once."""
    return edge_table(t, seen).orderBy("source_channel", "source_id", "target_sha", "route")


def dropped_absent(t: Tables) -> DataFrame:
    """One row: candidates that name a commit absent from the universe, each attempt counted.

    Comments are candidates for commits of kept edges alone, so those absent are all of the first pass.
    """
    known = t.lineage.select(F.col("sha").alias("target_sha")).distinct()
    tried = first_pass_candidates(t.prepared()).select("target_sha").where(truthy(F.col("target_sha")))
    return tried.join(known, "target_sha", "left_anti").agg(F.count("*").alias("dropped_absent"))


def channel_summary(edges: DataFrame, t: Tables) -> DataFrame:
    """Per channel: mined lines, records that reach a commit, edges by kind. For percentages and the note see summary_rows()."""
    mined = None
    for channel, table in ((CH_PR, t.prs), (CH_ISSUE, t.issues), (CH_REVIEW, t.reviews), (CH_COMMENT, t.comments)):
        one = table.agg(F.count("*").alias("mined")).select(F.lit(channel).alias("channel"), "mined")
        mined = one if mined is None else mined.unionByName(one)
    flags = [c for c in ("in_ledger", "in_refm", "in_ck") if c in edges.columns]
    per = edges.groupBy(F.col("source_channel").alias("channel")).agg(
        F.count_distinct("source_id").alias("reached"), F.count("*").alias("edges"), F.sum(F.col("route").isin(*EXACT).cast("bigint")).alias("edges_exact"),
        F.count_if(F.col("ref_kind") == CLOSES).alias("edges_closes"), F.count_if(F.col("ref_kind") == MENTIONS).alias("edges_mentions"),
        *[F.sum(F.col(f).cast("bigint")).alias(f"edges_{f}") for f in flags],
    )
    filled = mined.join(per, "channel", "left")
    return filled.select(
        "channel", "mined", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("reached",)], F.greatest(F.lit(0), F.col("mined") - F.coalesce("reached", F.lit(0))).alias("unreached"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("edges", "edges_exact", "edges_closes", "edges_mentions")], *[f"edges_{f}" for f in flags],
    )


def never_merged(prs: DataFrame) -> DataFrame:
    """One row: pull request lines less distinct merged numbers."""
    both = prs.agg(F.count("*").alias("n")).unionByName(pr_commits(prs).agg((-F.count("*")).alias("n")))
    return both.agg(F.sum("n").alias("never_merged"))


SUMMARY = (
    "channel string, mined bigint, reached bigint, unreached bigint, pct_reached double, edges bigint, edges_exact bigint, edges_closes bigint, edges_mentions bigint, "
    "edges_in_ledger bigint, edges_in_refm bigint, edges_in_ck bigint, note string"
)


def summary_rows(edges: DataFrame, t: Tables, lost: int | None = None) -> list[dict]:
    """The summary's four rows with percentages and the note, as exported; `lost` are pull requests never merged, if counted."""
    rows = [r.asDict() for r in channel_summary(edges, t).collect()]
    lost = never_merged(t.prs).first()[0] if lost is None else lost
    for r in rows:
        r["pct_reached"] = percent(r["reached"], r["mined"])
        r["note"] = f"{lost:,} never merged" if r["channel"] == CH_PR and r["mined"] else ""
    return sorted(rows, key=lambda r: CHANNELS.index(r["channel"]))


def summary(edges: DataFrame, t: Tables, lost: int | None = None) -> DataFrame:
    """summary_rows() as a table."""
    names = [c.split()[0] for c in SUMMARY.split(", ")]
    return edges.sparkSession.createDataFrame([tuple(r.get(c) for c in names) for r in summary_rows(edges, t, lost)], SUMMARY)


def evidence_files(edges: DataFrame, ledger: DataFrame) -> DataFrame:
    """Each edge with the files that its commit changed."""
    changed = ledger.select(F.col("sha").alias("target_sha"), F.explode("modifications").alias("m"))
    return edges.join(changed, "target_sha").select(*EDGE, F.col("m.file").alias("file"), F.col("m.lines_added").alias("lines_added"), F.col("m.lines_deleted").alias("lines_deleted"))
