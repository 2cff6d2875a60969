from __future__ import annotations

import collections
import random

import pytest
from pyspark.sql import functions as F

from loomstone.functions.text import strip
from loomstone.operators import coverage, diffs, events, heuristics, linkage, state, structural, universe

PR = "record_id long, merged_at long, merge_commit_sha string, text string, ingest_seq long"


def tables(spark, **given):
    make = lambda rows, schema: spark.createDataFrame(rows, schema)
    plain = {
        "lineage": make([("s1",), ("s2",), ("s3",)], "sha string"),
        "prs": make([(1, 5, "s1", "Fixes #10, see #1 and #2", 0), (2, None, "s2", "closes #10", 1), (3, 5, "gone", "#10", 2), (4, 5, "s3", "#11 #10", 3), (0, 5, "s1", "#10", 4)], PR),
        "issues": make([(10,), (1,)], "record_id long"),
        "reviews": make([(100, 1), (101, 2), (102, 3), (103, 0), (None, 1)], "record_id long, parent_id long"),
        "comments": make([(200, 10), (201, 77), (202, None), (203, 1)], "record_id long, parent_id long"),
        "commits": make([("s2", "resolve #4 and #12"), ("s9", "#10")], "record_id string, text string"),
    }
    return linkage.Tables(**(plain | given))


def edges(df):
    return {(r["source_channel"], r["source_id"], r["target_sha"], r["route"]): r["ref_kind"] for r in df.collect()}


def test_links_by_hand(spark):
    found = edges(linkage.deduped(linkage.collect(tables(spark))))
    assert found == {
        ("github.pr", 1, "s1", "merge_commit_sha"): "api", ("github.pr", 4, "s3", "merge_commit_sha"): "api",
        ("github.issue", 10, "s1", "issue_pr_merge"): "closes", ("github.issue", 1, "s1", "issue_pr_merge"): "mentions", ("github.pr", 2, "s1", "issue_pr_merge"): "mentions",
        ("github.issue", 10, "s3", "issue_pr_merge"): "mentions", ("github.pr", 4, "s2", "commit_message"): "closes", ("github.pr_review", 100, "s1", "parent_pr_merge"): "api",
        ("github.comment", 200, "s1", "parent_number"): "closes", ("github.comment", 200, "s3", "parent_number"): "mentions", ("github.comment", 203, "s1", "parent_number"): "api",
    }


def test_order_of_routes_changes_nothing(spark):
    t = tables(spark)
    assert edges(linkage.deduped(linkage.collect(t))) == edges(linkage.deduped(linkage.collect(t, tuple(reversed(linkage.ROUTES)))))


def test_absent_targets_are_counted_before_dedupe(spark):
    # pull request 3 itself, issue 10 through it, review 102 and the message of s9
    assert linkage.dropped_absent(tables(spark)).first()[0] == 4


def test_edges_of_comments_are_not_exchanged(spark):
    """The whole edge table equals the plain one, also for comments with several parents, and only small sides are shuffled."""
    number = "cast(id % 40 AS bigint)"
    prs = spark.range(400).selectExpr("id AS record_id", "5L AS merged_at", "concat('s', id) AS merge_commit_sha", f"concat('Fixes #', {number}, ' see #', {number} + 1) AS text", "id AS ingest_seq")
    comments = spark.range(3000).selectExpr("id AS record_id", "id % 40 AS parent_id").unionByName(spark.range(0, 3000, 7).selectExpr("id AS record_id", "(id + 1 + id % 2) % 40 AS parent_id")).unionByName(spark.range(50).selectExpr("id AS record_id", "id % 40 AS parent_id"))
    lineage = prs.where("record_id % 9 <> 0").selectExpr("merge_commit_sha AS sha")
    t = tables(spark, prs=prs, comments=comments, lineage=lineage, ledger=lineage.limit(100).localCheckpoint(), refm=lineage.where("sha LIKE '%1'").selectExpr("sha AS sha1"))
    plain = linkage.with_membership(linkage.with_exact(linkage.deduped(linkage.collect(t))), ledger=t.ledger, refm=t.refm, ck=None)
    seen, old = events.Observed(), events.Observed()
    found = linkage.edge_table(t, seen)
    rows = [tuple(r) for r in found.collect()]
    assert sorted(rows) == sorted(tuple(r) for r in plain.select(*found.columns).collect()) and len(rows) > 50_000
    linkage.collect(t, seen=old).write.format("noop").mode("overwrite").save()
    assert seen.values() == old.values() and old.values()["dropped_absent"] == linkage.dropped_absent(t).first()[0] > 0

    def exchanged(df):
        """Most rows that an exchange of the plan wrote."""
        df.collect()
        todo, most = [df._jdf.queryExecution().executedPlan()], 0
        while todo:
            p = todo.pop()
            name = p.getClass().getSimpleName()
            if name == "AdaptiveSparkPlanExec":
                todo.append(p.executedPlan())
            elif name.endswith("QueryStageExec"):
                todo.append(p.plan())
            elif name == "ShuffleExchangeExec":
                most = max(most, p.metrics().apply("shuffleRecordsWritten").value())
            todo += [p.children().apply(i) for i in range(p.children().size())]
        return most

    assert exchanged(plain) > 50_000 and exchanged(linkage.edge_table(t)) < 25_000
    assert [tuple(r) for r in linkage.link(t).collect()] == sorted(rows, key=lambda r: (r[0], r[1], r[3], r[4]))


def test_flags_tell_absent_tables_from_empty_ones(spark):
    t = tables(spark, ledger=spark.createDataFrame([("s1",)], "sha string"), refm=spark.createDataFrame([], "sha1 string"))
    rows = linkage.link(t).collect()
    assert {(r["target_sha"], r["in_ledger"]) for r in rows} == {("s1", 1), ("s2", 0), ("s3", 0)}
    assert all(r["in_refm"] == 0 and r["in_ck"] is None for r in rows)


def test_last_merged_record_of_a_number_counts(spark):
    prs = spark.createDataFrame([(1, 5, "s1", None, 0), (1, 5, "s2", None, 1), (1, None, "s3", None, 2)], PR)
    assert [tuple(r) for r in linkage.pr_commits(prs).collect()] == [(1, "s2")]


def test_summary(spark):
    t = tables(spark)
    rows = {r["channel"]: r for r in linkage.summary_rows(linkage.deduped(linkage.collect(t)), t)}
    assert rows["github.pr"]["mined"] == 5 and rows["github.pr"]["reached"] == 3 and rows["github.pr"]["note"] == "2 never merged"
    assert rows["github.comment"]["reached"] == 2 and rows["github.comment"]["pct_reached"] == 50.0
    assert all(r["reached"] <= r["mined"] and r["edges"] >= r["reached"] for r in rows.values())


def test_link_inputs(spark):
    none = spark.createDataFrame([], "sha string")
    with pytest.raises(linkage.LinkInputError, match="empty"):
        linkage.check_inputs(tables(spark, lineage=none))


def test_last_attempt_may_be_worse(spark):
    df = spark.createDataFrame([("a", "success", 0), ("a", "crash", 1), ("b", "crash", 0), ("b", "success", 1), ("c", None, 0)], "u string, status string, ingest_seq long")
    last = state.latest_attempts(df, "u", "ingest_seq", "status")
    assert {r["u"]: r["status"] for r in last.collect()} == {"a": "crash", "b": "success", "c": None}
    units = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2), ("d", 3)], "u string, pos int")
    assert [r["u"] for r in state.next_batch(state.unprocessed(units, last, "u"), "pos", 0).collect()] == ["a", "d"]
    assert [r["u"] for r in state.next_batch(state.unprocessed(units, last, "u"), "pos", 1).collect()] == ["a"]
    assert [r["u"] for r in state.stale(last, units.where("u <> 'b'"), "u").collect()] == ["b"]


def test_coverage(spark):
    df = spark.createDataFrame([("a", "crash", 0, None), ("a", "success", 1, None), ("b", None, 2, None), (None, "success", 3, None), (None, None, 4, "{bad"), ("c", "empty_output", 5, None)], "u string, status string, ingest_seq long, _corrupt string")
    r = coverage.artifact_coverage(df, "ck", "x", "u").first()
    assert (r["records"], r["units"], r["ok"], r["empty"], r["failed"], r["duplicates"]) == (6, 4, 1, 1, 2, 1)
    assert r["statuses"] == "empty_output=1;success=1;unlabelled=1" and r["note"] == "1 retried, 1 unparseable, 1 without u"
    plain = coverage.artifact_coverage(df.drop("status", "_corrupt"), "meta", "y", None).first()
    assert plain["units"] == 6 and plain["ok"] is None
    assert coverage.exported(coverage.absent(spark, "diff", "z")).first()["ok"] == ""


DIFF = """noise
diff --git a/x.java b/x.java
--- a/x.java
+++ b/x.java
@@ -1,2 +1,2 @@
-old
--- lost sql comment
+new
+++ lost
+
diff --git a/dir b/y.java b/dir b/y.java
@@ -1 +1 @@
+one
\\ No newline at end of file
diff --git "a/n\\303\\251.java" "b/n\\303\\251.java"
Binary files differ
diff --git a/z.java b/z.java
+z"""


def split_by_hand(raw):
    files, now = [], None
    for line in raw.split("\n"):
        if line.startswith("diff --git "):
            head, sep, rest = line.partition(" b/")
            now = [rest.strip() if sep else line[11:].strip(), [], []]
            files.append(now)
        elif now is not None and not line.startswith(("--- ", "+++ ")) and not (line.startswith("@@ ") and " @@" in line[2:]):
            if line[:1] in "+-" and line:
                now[1 if line[0] == "+" else 2].append(line[1:])
    return sorted(([f, a, r] for f, a, r in files), key=lambda x: -len(x[1]) - len(x[2]))


def test_diffs(spark):
    rng = random.Random(3)
    lines = ["diff --git a/p b/p", "diff --git a/q b/q b/r", "@@ -1 +1 @@", "+a", "-b", "--- c", "+++ d", " e", "", "+", "-"]
    raws = [DIFF, "", *["\n".join(rng.choices(lines, k=12)) for _ in range(60)]]
    df = spark.createDataFrame(list(enumerate(raws)), "sha1 int, raw string")
    found = {r["sha1"]: [[f["file"], f["added"], f["removed"]] for f in r["files"]] for r in diffs.split_files(df).collect()}
    for k, raw in enumerate(raws):
        assert found.get(k, []) == split_by_hand(raw), raw
    marked = diffs.split_files(df.where("sha1 = 0"), keep_marked=True).first()["files"]
    assert marked[0]["removed"] == ["old", "-- lost sql comment"] and marked[0]["added"] == ["new", "++ lost", ""]
    top = diffs.capped(diffs.split_files(df.where("sha1 = 0")), 2).first()
    assert (top["n_files"], top["n_files_total"], top["truncated"]) == (2, 4, True)


def test_pieces(spark):
    files = [("a", ["x", " "], ["y"], 2, 1), ("b", [" "], ["\t"], 1, 1), ("c", [], ["z"], 0, 1)]
    df = spark.createDataFrame([("msg", files), (None, None)], "message string, files array<struct<file:string,added:array<string>,removed:array<string>,n_added:int,n_removed:int>>")
    rows = df.select(diffs.render_pieces(F.col("message"), F.col("files")).alias("p"), diffs.render_pieces(F.col("message"), F.col("files"), 2).alias("two")).collect()
    want = ["<COMMIT_MESSAGE>msg</COMMIT_MESSAGE>", "<FILE>a</FILE>\n<REMOVED>y</REMOVED>\n<ADDED>x</ADDED>", "<FILE>c</FILE>\n<REMOVED>z</REMOVED>"]
    assert rows[0]["p"] == want and rows[0]["two"] == want[:2] and rows[1]["p"] == ["<COMMIT_MESSAGE></COMMIT_MESSAGE>"]


def test_files_are_made_once(spark, tmp_path):
    """A filter on the files would make them twice; what it asks of the text keeps the same rows."""
    raw = [(0, None), (1, ""), (2, "no header"), (3, "diff --git a/x b/x\n@@ -1 +1 @@\n-a\n+b"), (4, "lead\ndiff --git "), (5, "x diff --git a/x b/x")]
    split = diffs.split_files(spark.createDataFrame(raw, "sha1 int, raw string"), "sha1")
    assert {r["sha1"]: [f["file"] for f in r["files"]] for r in split.collect()} == {3: ["x"], 4: [""]}
    assert split._jdf.queryExecution().optimizedPlan().toString().count("split(raw") == 1
    blank = spark.createDataFrame([(x,) for x in ("", " \t", "\u00a0\u2003\x85", " a ", "\u200b", "\n\n", "\nb")], "x string")
    assert blank.where(diffs.not_blank(F.col("x")) != (strip(F.col("x")) != "")).count() == 0


def test_weights_move_no_refactorings(spark):
    rules = spark.createDataFrame([("Move Class", 0.8, "High")], "refactoring_type string, score double, category string")
    rows = spark.createDataFrame([("Move Class", "r"), ("Other", "r"), (None, "r")], "refactoring_type string, repository string")
    found = heuristics.with_weights(rows, rules)
    assert {r["refactoring_type"]: (r["complexity_score"], r["impact_category"]) for r in found.collect()} == {"Move Class": (0.8, "High"), "Other": (0.1, "Unclassified"), None: (0.1, "Unclassified")}
    assert "hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()


def test_cochanges(spark):
    changed = [(c, f) for c in range(40) for f in {c % 5, c % 7, c % 3}] * 2
    want = collections.Counter((a, b) for c in range(40) for a in {c % 5, c % 7, c % 3} for b in {c % 5, c % 7, c % 3} if a < b)
    found = universe.cochanges(spark.createDataFrame(changed, "c int, f int"), "c", "f", each=20)
    assert {(r["a"], r["b"]): r["n"] for r in found.collect()} == dict(want)
    assert found.rdd.getNumPartitions() == 2 * (1 + len(changed) // 20)  # more rows, more tasks


def test_structure(spark):
    classes = spark.createDataFrame([("f1", "A"), ("f2", "A"), ("f3", "B")], "file string, class string")
    methods = spark.createDataFrame([("A", "m1"), ("A", "m2"), ("Gone", "m3")], "class string, method string")
    nested = {(r["file"], r["class"]): [m["method"] for m in r["methods"]] for r in structural.nest_methods(classes, methods).collect()}
    assert nested == {("f1", "A"): ["m1", "m2"], ("f2", "A"): ["m1", "m2"], ("f3", "B"): []}
    paths = ["src/test/A.java", "src/main/ATest.java", "src/main/A.java", "a/tests/B.java", "contest/C.java", "x/.git/D.java", "src/xdocs-examples/E.java"]
    kept = [r[0] for r in spark.createDataFrame([(p,) for p in paths], "p string").where(structural.is_production(F.col("p"))).collect()]
    assert kept == ["src/main/A.java", "contest/C.java"]


def test_universe(spark):
    lines = spark.createDataFrame([("a||1",), ("b|a|2",), ("c|a  b|3",), ("broken|x",)], "value string")
    commits = universe.lineage(lines)
    assert {r["sha"]: r["parent_shas"] for r in commits.collect()} == {"a": [], "b": ["a"], "c": ["a", "b"]}
    assert tuple(universe.commit_kinds(commits).first()) == (3, 1, 1)
    heads = spark.createDataFrame([("b",), ("none",)], "sha string")
    assert {r[0] for r in universe.ancestors(commits, heads).collect()} == {"a", "b"}
    by = universe.ancestors(commits.withColumn("repo", F.lit("r")), heads.withColumn("repo", F.lit("r")), "repo")
    assert {tuple(r) for r in by.collect()} == {("r", "a"), ("r", "b")}
    with pytest.raises(ValueError, match="head_sha"):
        universe.check_manifest({"repo": "r"}, "r")
    tags = spark.createDataFrame([(0, "v1.0", "x"), (1, "rel_2_1", "y"), (2, "v2.1", "z")], "pos int, tag string, sha string")
    wanted = spark.createDataFrame([("1.0",), ("2.1.0",), ("9",)], "version string")
    assert {r["version"]: r["sha"] for r in universe.match_versions(wanted, tags).collect()} == {"1.0": "x", "2.1.0": "z"}


def test_deep_history(spark):
    n = 5000
    commits = spark.range(n).selectExpr("concat('c', id) AS sha", "CASE WHEN id = 0 THEN array() WHEN id % 9 = 8 THEN array(concat('c', id - 1), concat('c', id - 7)) ELSE array(concat('c', id - 1)) END AS parent_shas")
    heads = spark.createDataFrame([(f"c{n - 1}",)], "sha string")
    assert universe.ancestors(commits, heads).count() == n


VIOLATION = "sha string, file_path string, begin_line int, end_line int, pmd_complexity_score double"
REFACTORING = "commit_sha string, refactoring_type string, left_side_path string, right_side_path string, start_line_ref_left int, end_line_ref_left int, start_line_ref_right int, end_line_ref_right int"


@pytest.mark.parametrize(
    ("before", "after", "want"),
    [((10, 20, 20.0), None, "Fixed"), (None, (10, 20, 20.0), "Introduction"), ((12, 15, 20.0), (12, 15, 10.0), "Ameliorated"), ((10, 20, 20.0), (10, 20, 20.0), "Persistent"), ((21, 25, 20.0), None, "None")],
)
def test_proximity(spark, before, after, want):
    refactoring = spark.createDataFrame([("c2", "Extract Method", "Old.java", "New.java", 10, 20, 10, 20)], REFACTORING)
    found = [(sha, path, *smell) for sha, path, smell in (("c1", "Old.java", before), ("c2", "New.java", after)) if smell]
    lineage = spark.createDataFrame([("c2", ["c1"])], "sha string, parent_shas array<string>")
    r = heuristics.proximity(refactoring, spark.createDataFrame(found, VIOLATION), lineage).first()
    assert r["causality_type"] == want and r["score_AST_Proximity"] == (0.0 if want == "None" else 1.0) and r["refactoring_type"] == "Extract Method"


def test_gap(spark):
    ten = spark.createDataFrame([(f"c{k}",) for k in range(10)], "sha1 string")
    five = spark.createDataFrame([(f"c{k}",) for k in range(5)], "sha string")
    assert heuristics.coverage_gap(ten, five) == 0.5
    with pytest.raises(heuristics.CoverageError, match="CRITICAL"):
        heuristics.coverage_gap(ten, five.limit(2))
    with pytest.raises(ValueError, match="between"):
        heuristics.coverage_gap(ten, five, 1.5)
    row = spark.range(1).select(heuristics.is_impure(F.lit(1), F.lit(20)), heuristics.is_impure(F.lit(1), F.lit(21)), heuristics.density(F.lit(1), F.lit(0))).first()
    assert tuple(row) == (False, True, 0.0)
