"""From a validated plan to the commands that carry it out, over landed files and the engine's own tables.

Landed, under `landing`: lineage.txt (sha|parents|seconds), ledger.jsonl, refm.jsonl, diff.jsonl, ck.jsonl or ck/ with runs.jsonl
and the metrics files of each snapshot, messages.txt, tags.txt (tag object peeled), raw/<channel>.jsonl with the items of a
hosting service, and state/<channel>.json with how far its collection came. Tables, under `output`: one folder per stage or
channel, and run_events with what every run counted.
A stage that walks commits takes the next batch of those that its scope holds and that are not done, oldest first.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstone import schemas
from loomstone.operators import coverage, diffs, history, linkage, state, universe
from loomstone.operators.events import Observed, event_rows
from loomstone.plans.stages import SAMPLE, UNIVERSE, Command, RunPlan
from loomstone.sources import files, sinks
from loomstone.sources.hosting import ENDPOINTS

#: Per walking stage: the column that names its commit, and its landed records.
UNITS = {"ledger": "sha", "refm": "sha1", "diff": "sha1", "ck": "sha"}
LANDED_DIFF = "repository string, sha1 string, timestamp bigint, message string, parent_shas array<string>, raw string, crashed boolean"
#: What a walking stage's landed lines hold.
LANDED = {"ledger": schemas.LEDGER, "refm": schemas.REFACTORINGS, "diff": LANDED_DIFF, "ck": schemas.STRUCTURE}
#: Per channel: its table's schema and the name by which edges know it.
RECORDS = {"commits": schemas.COMMITS, "issues": schemas.ISSUES, "prs": schemas.PULLS, "pr_reviews": schemas.REVIEWS, "comments": schemas.COMMENTS}


@dataclass(frozen=True)
class Workspace:
    """Where one repository's landed files and tables are."""

    spark: SparkSession
    landing: str
    output: str
    say: Callable[[str], None] = print
    run: str = field(default_factory=lambda: uuid.uuid4().hex)

    def note(self, plan: RunPlan, counts: dict[str, int], note: str = "") -> None:
        """Adds counts to the events of all runs."""
        sinks.append_attempts(event_rows(self.spark, self.run, plan.repo, plan.stage, counts, note).coalesce(1), f"{self.output}/run_events")

    def table(self, name: str, schema: str | None = None) -> DataFrame | None:
        """A stage's table; where it has not run, an empty one of the schema, or None, which is not the same."""
        found = sinks.read_table(self.spark, f"{self.output}/{name}")
        return self.spark.createDataFrame([], schema) if found is None and schema else found

    def landed(self, stage: str) -> DataFrame:
        path = f"{self.landing}/{stage}.jsonl"
        if stage == "ledger" and files.exists(self.spark, path):
            return files.read_ledger(self.spark, path)
        if stage == "refm":
            found = files.read_refactorings(self.spark, f"{self.landing}/{stage}")
            return self.spark.createDataFrame([], schemas.REFACTORINGS) if found is None else found
        if stage == "ck" and files.exists(self.spark, f"{self.landing}/ck/runs.jsonl"):
            return files.read_structure(self.spark, f"{self.landing}/ck")
        return files.read_records(self.spark, path, LANDED[stage])

    def damage(self, stage: str) -> dict[str, int]:
        """Unparseable lines of a stage's landed file: cut off at its end, as by a dying writer, or damaged; none if it has no such file."""
        path = f"{self.landing}/{stage}.jsonl"
        if not files.exists(self.spark, path):
            return {}
        told = files.corrupt_by_file(self.spark.read.text(path), LANDED[stage])
        found = told.agg(F.count_if("cut_off").alias("cut_off"), F.coalesce(F.sum(F.when(F.col("cut_off"), 0).otherwise(F.col("corrupt"))), F.lit(0)).alias("damaged")).first()
        return {"cut_off": found["cut_off"], "damaged": found["damaged"]}


def scope(w: Workspace, plan: RunPlan) -> DataFrame:
    """The commits that a walk covers, with pos, oldest first: all, or what the universe's heads reach.

    A head or snapshot that the lineage lacks is an error; a count of the head's commits that differs from the manifest's is told.
    """
    lineage = w.table("meta", f"{schemas.LINEAGE}, seq bigint")
    if UNIVERSE not in plan.paths:
        return universe.listing(lineage)
    told = universe.check_manifest(json.loads(plan.paths[UNIVERSE].read_text(encoding="utf-8")), plan.repo)
    heads = w.spark.createDataFrame([(x,) for x in [told["head_sha"], *told["near_mainline_shas"]]], "sha string")
    absent = sorted(r[0] for r in universe.absent_commits(heads, lineage).collect())  # of the manifest's own few
    if absent:
        raise ValueError(f"the lineage lacks {len(absent)} commits of the manifest, such as {absent[0]}")
    if told["head_commits"]:
        reached = universe.ancestors(lineage, heads.where(F.col("sha") == told["head_sha"])).withColumn("repo", F.lit(plan.repo))
        manifest = w.spark.createDataFrame([(plan.repo, told["head_commits"])], "repo string, head_commits int")
        found = universe.reachable_against_manifest(reached, manifest).first()
        w.note(plan, {"reachable": found["reachable"], "head_commits": found["head_commits"]})
        if not found["agrees"]:
            w.say(f"{plan.repo}: the manifest tells {found['head_commits']} commits of its head, the lineage has {found['reachable']}; the walk keeps to the head")
    return universe.listing(lineage, universe.ancestors(lineage, heads))


def snapshots(w: Workspace, plan: RunPlan, unit: str) -> DataFrame:
    """The commits of a release manifest; where it holds versions only, those of the landed tags (tags.txt) that match them."""
    grid = files.read_release_grid(w.spark, str(plan.paths[SAMPLE]))
    direct = grid.where("snapshot_sha IS NOT NULL").select(F.col("snapshot_sha").alias(unit))
    versions = grid.where("snapshot_sha IS NULL AND version IS NOT NULL").select("version")
    if versions.isEmpty():
        return direct.distinct()
    if not files.exists(w.spark, f"{w.landing}/tags.txt"):
        raise ValueError(f"{plan.paths[SAMPLE]} holds versions only, and there are no landed tags to find them by")
    tags = universe.peeled_tags(w.spark.read.text(f"{w.landing}/tags.txt").withColumn("pos", F.monotonically_increasing_id()))
    matched = universe.match_versions(versions, tags)
    wanted, found = versions.distinct().count(), matched.count()
    w.note(plan, {"versions": wanted, "versions_matched": found})
    if found < wanted:
        w.say(f"{plan.repo}: {wanted - found} of {wanted} versions have no tag")
    return direct.unionByName(matched.select(F.col("sha").alias(unit))).distinct()


def mine_lineage(w: Workspace, plan: RunPlan) -> bool:
    """Replaces the lineage; commits that were landed before a child of theirs, newest first, are counted and told."""
    lines = w.spark.read.text(f"{w.landing}/lineage.txt").withColumn("seq", F.monotonically_increasing_id())
    seen = Observed()
    sinks.refresh(seen.watch(universe.lineage(lines, keep=("seq",)), commits=F.count("*"), roots=F.count_if(F.size("parent_shas") == 0), merges=F.count_if(F.size("parent_shas") >= 2)), f"{w.output}/meta")
    lineage = w.table("meta")
    wrong = history.out_of_order(lineage.withColumn("pos", -F.col("seq"))).count()
    if wrong:
        w.say(f"{plan.repo}: {wrong} commits are landed after a parent of theirs; take their order from generations()")
    w.note(plan, seen.values() | {"out_of_order": wrong})
    return True


def mine_commits(w: Workspace, plan: RunPlan) -> bool:
    """The next batch of a walking stage; every attempt is kept, and its last one counts. Records of other commits are told."""
    unit, path = UNITS[plan.stage], f"{w.output}/{plan.stage}"
    units = scope(w, plan).select(F.col("sha").alias(unit), "pos")
    everything = units
    if SAMPLE in plan.paths:
        units = units.join(snapshots(w, plan, unit), unit, "left_semi")
    held, counts = w.table(plan.stage), {}
    if held is not None:
        told = held if "status" in held.columns else held.withColumn("status", F.lit(None).cast("string"))
        latest = state.latest_attempts(told, unit, "ingest_seq", "status")
        counts["stale"] = state.stale(latest, everything, unit).count()
        if counts["stale"]:
            w.say(f"{plan.repo}: {counts['stale']} commits recorded by {plan.stage} are no longer in the universe; what joins on it leaves them out")
        units = state.unprocessed(units, latest, unit)
    lines = w.damage(plan.stage)
    if lines.get("damaged"):
        w.say(f"{plan.repo}: {lines['damaged']} landed lines of {plan.stage} cannot be read; their commits are tried again")
    batch = state.next_batch(units, "pos", plan.limit)
    records = w.landed(plan.stage).join(batch.select(unit), unit, "left_semi")
    if plan.stage == "diff":
        records = diffs.commit_diffs(records)
    seen = Observed()
    failed = F.count_if(~state.done(F.col("status"))) if "status" in records.columns else F.count_if(F.lit(False))
    sinks.append_attempts(seen.watch(records.withColumn("ingest_seq", F.lit(time.time_ns())), records=F.count("*"), failed=failed), path)
    w.note(plan, counts | lines | seen.values())
    return True


def mine_channel(w: Workspace, plan: RunPlan, channel: str) -> bool:
    """Adds the landed records that the channel's table lacks; records without any state of progress are told."""
    if channel == "commits":
        found = files.read_commit_messages(w.spark, f"{w.landing}/messages.txt")
    else:
        found = ENDPOINTS[channel].normalise(w.spark.read.text(f"{w.landing}/raw/{channel}.jsonl").withColumnRenamed("value", "raw"))
    held = w.table(channel)
    if held is not None and channel != "commits":
        progress = files.read_sidecars(w.spark, f"{w.landing}/state").where((F.col("name") == channel) & F.col("state").isNotNull())
        disagree = state.records_without_state(held, progress).first()["disagree"]
        w.note(plan, {"without_state": int(disagree)}, channel)
        if disagree:
            w.say(f"{plan.repo}: {channel} holds records, but no progress is told; a state file may be lost")
    before = 0 if held is None else held.count()
    sinks.append_new(found, f"{w.output}/{channel}", "record_id")
    after = w.table(channel)
    w.note(plan, {"new": (0 if after is None else after.count()) - before}, channel)
    return True


def link(w: Workspace, plan: RunPlan) -> bool:
    """Replaces the edge table and its summary of channels, with shares and notes, also as linkage_summary.csv."""
    records = {c: w.table(c, schema) for c, schema in RECORDS.items()}
    t = linkage.Tables(
        lineage=w.table("meta", schemas.LINEAGE), prs=records["prs"], issues=records["issues"], reviews=records["pr_reviews"], comments=records["comments"], commits=records["commits"],
        ledger=w.table("ledger"), refm=w.table("refm"), structure=w.table("ck"),
    )
    seen = Observed()
    sinks.refresh(linkage.edge_table(t, seen), f"{w.output}/link")
    counts = seen.values()
    lost = counts["pull_lines"] - counts["merged_pulls"]
    w.note(plan, counts | {"never_merged": lost})
    if counts["dropped_absent"]:
        w.say(f"{plan.repo}: {counts['dropped_absent']} candidates name commits that the lineage lacks")
    sinks.refresh(linkage.summary(w.table("link"), t, lost), f"{w.output}/linkage_summary")
    sinks.replace_csv(w.table("linkage_summary"), f"{w.output}/linkage_summary.csv")
    return True


def coverage_rows(w: Workspace) -> DataFrame:
    """One row per artifact: tables, what the channels' sidecars tell of them, and exported CSVs."""
    rows = None
    for name, unit in {"meta": "sha", **UNITS, **dict.fromkeys(RECORDS, "record_id"), "link": None}.items():
        held = w.table(name)
        one = coverage.absent(w.spark, name, name) if held is None else coverage.artifact_coverage(held if "ingest_seq" in held.columns else held.withColumn("ingest_seq", F.monotonically_increasing_id()), name, name, unit)
        if name in ENDPOINTS:
            one = coverage.with_channel_notes(one, files.read_sidecars(w.spark, f"{w.landing}/state"))
        rows = one if rows is None else rows.unionByName(one)
    return rows.unionByName(coverage.csv_coverage(w.spark, "link", ["linkage_summary"], files.csv_rows(w.spark, w.output).where("name <> 'report'")))


def report(w: Workspace, plan: RunPlan) -> bool:
    """One row per artifact, said and exported as report.csv beside the tables."""
    rows = coverage_rows(w)
    rows = w.spark.createDataFrame(rows.collect(), rows.schema)  # one row per artifact, in the order of the stages
    for line in coverage.rendered(rows):
        w.say(line)
    sinks.replace_csv(coverage.exported(rows), f"{w.output}/report.csv")
    return True


def logged(w: Workspace, plan: RunPlan, name: str, work: Callable[[], bool], needs_health: bool = False) -> Command:
    """A command that leaves its outcome and seconds among the events, also when it fails."""

    def run() -> bool:
        began, ok = time.time(), False
        try:
            ok = work()
            return ok
        finally:
            w.note(plan, {"ok": int(ok), "milliseconds": int(1000 * (time.time() - began))}, name)

    return Command(name, run, needs_health)


def commands(plan: RunPlan, w: Workspace, say: Callable[[str], None] = print) -> list[Command]:
    """What the validated plan does; a channel stage gives a command for each channel."""
    w = replace(w, say=say)
    if plan.stage == "meta":
        return [logged(w, plan, "meta", lambda: mine_lineage(w, plan))]
    if plan.stage in UNITS:
        return [logged(w, plan, plan.stage, lambda: mine_commits(w, plan))]
    if plan.stage == "channel":
        return [logged(w, plan, f"channel {c}", lambda c=c: mine_channel(w, plan, c)) for c in plan.wanted_channels]
    if plan.stage == "link":
        return [logged(w, plan, "link", lambda: link(w, plan))]
    if plan.stage == "report":
        return [logged(w, plan, "report", lambda: report(w, plan), needs_health=True)]
    raise ValueError(f"no commands for stage {plan.stage!r}")
