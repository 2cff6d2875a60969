from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from loomstone.functions import text as T
from loomstone.operators import diffs, structural, universe
from loomstone.plans import build, stages
from loomstone.sources import files


def run(w, tmp_path, stage, **flags):
    plan = stages.validate(stages.RunPlan("r", stage, **flags), tmp_path)
    said = []
    code, results = stages.run_all(build.commands(plan, w, said.append))
    return code, results, said


def test_stages_run_their_operators(spark, tmp_path):
    landing, output = tmp_path / "in", tmp_path / "out"
    (landing / "raw").mkdir(parents=True)
    output.mkdir()
    (landing / "lineage.txt").write_text("c|b|3\nb|a|2\na||1\nbroken\n")
    change = lambda name: {"file": name, "old_file": name, "lines_added": 1, "lines_deleted": 0, "change_type": "MODIFY", "changed_methods": []}
    (landing / "ledger.jsonl").write_text("".join(json.dumps({"sha": s, "timestamp": 1, "author_name": "n", "author_email": "e", "modifications": [change("A.java"), change("b.py")]}) + "\n" for s in "abcx"))
    item = lambda n, **more: json.dumps({"number": n, "id": n, "title": "t", "body": "", "created_at": "2024-01-01T00:00:00Z", "user": {"login": "u"}, "labels": []} | more)
    (landing / "raw" / "issues.jsonl").write_text(item(7) + "\n" + item(8, pull_request=None) + "\n")
    (landing / "raw" / "prs.jsonl").write_text(item(9, body="Fixes #7", merged_at="2024-01-02T00:00:00Z", merge_commit_sha="b") + "\n")
    (tmp_path / "u.json").write_text(json.dumps({"repo": "r", "head_sha": "b"}))
    w = build.Workspace(spark, str(landing), str(output))
    assert run(w, tmp_path, "meta")[0] == 0
    # two at a time, oldest first; x is no commit of the lineage
    for want in ({"a", "b"}, {"a", "b", "c"}, {"a", "b", "c"}):
        assert run(w, tmp_path, "ledger", full=True, batch=2)[0] == 0
        assert {r["sha"] for r in w.table("ledger").collect()} == want and w.table("ledger").count() == len(want)
    assert {len(r["modifications"]) for r in w.table("ledger").collect()} == {1}
    plan = stages.validate(stages.RunPlan("r", "ledger", universe="u.json"), tmp_path)
    assert [r["sha"] for r in build.scope(w, plan).collect()] == ["a", "b"]
    code, results, _ = run(w, tmp_path, "channel", platform="github", channels="issues,prs")
    assert code == 0 and list(results) == ["channel issues", "channel prs"] and [r[0] for r in w.table("issues").select("record_id").collect()] == [7]
    assert run(w, tmp_path, "link")[0] == 0
    assert {(r["source_channel"], r["target_sha"], r["in_ledger"], r["in_refm"]) for r in w.table("link").collect()} == {("github.pr", "b", 1, None), ("github.issue", "b", 1, None)}
    code, _, said = run(w, tmp_path, "report")
    assert code == 0 and any(x.startswith("ledger") for x in said) and said[-1] == "still to mine: refm, diff, ck, commits, pr_reviews, comments" and any(x.startswith("linkage_summary") for x in said)
    assert (output / "report.csv").read_text().startswith("stage,artifact")


def test_plans_are_described():
    plan = stages.RunPlan("r", "channel", platform="github", channels="issues, prs", batch=0)
    assert stages.described(plan) == ["repository: r", "stage: channel", "channels: github -> issues, prs", "batch: unlimited"]
    assert stages.described(stages.RunPlan("r", "link")) == ["repository: r", "stage: link"]


@pytest.mark.parametrize("text, want", [
    ('{"entries": [{"tag": "v1", "snapshot_sha": "a", "sha": "z"}, {"tag": "v2", "sha": "b"}]}', [(0, "v1", "a", None), (1, "v2", "b", None)]),
    ('["1.0", 2]', [(0, None, None, "1.0"), (1, None, None, "2")]), ('{"versions": ["3"]}', [(0, None, None, "3")]),
    ('{"entries": []}', "no entries"), ('{"entries": [{"tag": "v1"}, {"sha": "b"}]}', "entry 0.*entry 1"), ("{", "not valid JSON"), ('{"x": 1}', "unknown form"), ("7", "unknown form"),
])
def test_release_grids(text, want):
    if isinstance(want, str):
        with pytest.raises(ValueError, match=want):
            universe.release_grid(text)
    else:
        assert universe.release_grid(text) == want


def test_refactorings_as_lines_else_as_one_document(spark, tmp_path):
    assert files.read_refactorings(spark, str(tmp_path / "refm")) is None
    (tmp_path / "refm.json").write_text(json.dumps({"commits": [{"sha1": "whole", "refactorings": []}]}, indent=1))
    assert [r["sha1"] for r in files.read_refactorings(spark, str(tmp_path / "refm")).collect()] == ["whole"]
    (tmp_path / "refm.jsonl").write_text('{"sha1": "a", "refactorings": []}\n\n{"sha1": "b", "refactorings": []}\n')
    assert [r["sha1"] for r in files.read_refactorings(spark, str(tmp_path / "refm")).collect()] == ["a", "b"]
    (tmp_path / "grid.json").write_text('{"entries": [{"tag": "v", "sha": "a"}]}')
    assert [tuple(r) for r in files.read_release_grid(spark, str(tmp_path / "grid.json")).collect()] == [(0, "v", "a", None)]
    with pytest.raises(FileNotFoundError):
        files.read_release_grid(spark, str(tmp_path / "none.json"))


def test_metrics_files_are_found_apart(spark):
    rows = [("a", "class", "t/class", 5, True), ("a", "method", "t/method", 0, True), ("a", "method", "r/method", 3, False), ("b", "class", "t/class", 0, True)]
    found = structural.located(spark.createDataFrame(rows, "sha string, name string, path string, length long, in_temp boolean"), "sha")
    assert {tuple(r) for r in found.collect()} == {("a", "t/class", "temp", "r/method", "repo_root"), ("b", None, "absent", None, "absent")}


def test_commit_diffs_and_labels(spark):
    rows = [("r", "a", 1, "m", ["p", "q"], "diff --git a/x b/x\n+1", None), ("r", "b", 1, None, None, "", False), ("r", "c", 1, None, [], None, True)]
    found = {r["sha1"]: (r["n_files"], r["is_merge"], r["n_parents"], r["status"]) for r in diffs.commit_diffs(spark.createDataFrame(rows, build.LANDED_DIFF)).collect()}
    assert found == {"a": (1, True, 2, "success"), "b": (0, False, 0, "empty_diff"), "c": (0, False, 0, "crash")}
    raw = [('{"labels":[{"name":"x"},"y",{"name":""},null,0]}',), ('{"labels":[]}',), ("{}",)]
    assert [r[0] for r in spark.createDataFrame(raw, "raw string").select(T.label_names_of(F.col("raw"))).collect()] == [["x", "y"], [], []]
