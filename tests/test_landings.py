"""What stages land, read and tell: metrics files, cut-off lines, sidecars, events of runs."""

from __future__ import annotations

import json

import pytest

from loomstone import schemas
from loomstone.operators import events, linkage, structural
from loomstone.plans import build, stages
from loomstone.sources import files, sinks, store


def run(w, tmp_path, stage, **flags):
    plan = stages.validate(stages.RunPlan("r", stage, **flags), tmp_path)
    said = []
    code, _ = stages.run_all(build.commands(plan, w, said.append))
    return code, said


@pytest.fixture
def place(tmp_path):
    landing = tmp_path / "in"
    for folder in ("raw", "state", "ck"):
        (landing / folder).mkdir(parents=True)
    (landing / "lineage.txt").write_text("c|b|3\nb|a|2\na||1\n")
    item = lambda n, **more: json.dumps({"number": n, "id": n, "title": "t", "body": "", "created_at": "2024-01-01T00:00:00Z"} | more)
    (landing / "raw" / "issues.jsonl").write_text(item(7) + "\n")
    (landing / "raw" / "prs.jsonl").write_text("".join(item(n, body=b, merged_at=m, merge_commit_sha=s) + "\n" for n, b, m, s in ((9, "Fixes #7", "2024-01-02T00:00:00Z", "b"), (10, "Fixes #7", "2024-01-02T00:00:00Z", "gone"), (11, "", None, None))))
    return landing


def counts(w, stage, note=""):
    return {r["event"]: r["value"] for r in w.table("run_events").where(f"stage = '{stage}' AND note = '{note}'").orderBy("at").collect()}


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode("utf-8"))


def test_metrics_files_of_every_case(spark, tmp_path):
    top = tmp_path / "ck"
    rows = lambda *lines: "\n".join(lines) + "\n"
    write(top / "ok" / "temp" / "class.csv", rows("﻿file,class,wmc", 'A.java,"a.A",1', "B.java,b.B,2"))
    write(top / "ok" / "method.csv", rows("class,method,loc", 'a.A,"m(int,int)",3', "a.A,n(),4", "gone.G,x(),1"))
    write(top / "ok" / "temp" / "method.csv", "")  # empty: counts as absent, so the one at the root is taken
    write(top / "older" / "class.csv", rows("class,file", "a.A,A.java"))
    write(top / "older" / "method.csv", rows("file,class,method", "A.java,a.A,m()"))
    write(top / "header" / "temp" / "class.csv", rows("file,class,wmc"))
    write(top / "bare" / "temp" / "class.csv", rows("file,class,wmc", "A.java,a.A,1", ""))
    write(top / "none" / "temp" / "class.csv", "")
    for sha in ("crashed", "slow", "lost"):
        write(top / sha / "temp" / "class.csv", rows("file,class,wmc", "A.java,a.A,1"))
    told = [("ok", True, False, True), ("older", True, False, True), ("header", True, False, True), ("bare", True, None, None), ("none", True, False, True), ("absent", True, False, True), ("crashed", False, False, True), ("slow", False, True, True), ("lost", None, None, False)]
    (top / "runs.jsonl").write_text("".join(json.dumps({"sha": s, "timestamp": 1, "exit_ok": e, "timed_out": t, "checked_out": c, "n_removed": 0}) + "\n" for s, e, t, c in told))
    found = {r["sha"]: r for r in files.read_structure(spark, str(top)).collect()}
    assert {s: (r["status"], r["n_classes"], r["n_methods"], r["csv_source"], r["method_source"]) for s, r in found.items()} == {
        "ok": ("success", 2, 3, "temp", "repo_root"), "older": ("success", 1, 1, "repo_root", "repo_root"), "header": ("empty_output", 0, 0, "temp", "absent"), "bare": ("empty_methods", 1, 0, "temp", "absent"),
        "none": ("missing_output", 0, 0, "absent", "absent"), "absent": ("missing_output", 0, 0, "absent", "absent"), "crashed": ("crash", 0, 0, "temp", "absent"), "slow": ("timeout", 0, 0, "temp", "absent"), "lost": ("checkout_failed", 0, 0, "temp", "absent"),
    }
    first = found["ok"]["report"][0]
    assert json.loads(first["metrics"]) == {"file": "A.java", "class": "a.A", "wmc": "1"} and [json.loads(m)["method"] for m in first["methods"]] == ["m(int,int)", "n()"]
    listing = files.list_metrics(spark, str(top))
    assert "content" not in listing._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]  # no file is read for its listing
    assert listing.where("in_temp").count() == 6  # files of no bytes count as absent and are not listed


def test_metrics_files_are_opened_once(spark, tmp_path):
    write(tmp_path / "a.csv", "class,loc\nA,1\nB\n")
    rows = structural.metric_rows(spark.read.text(str(tmp_path)))
    assert "Format: Text" not in rows._jdf.queryExecution().executedPlan().toString()
    assert sorted(str(r["metrics"]) for r in rows.collect()) == ["{'class': 'A', 'loc': '1'}", "{'class': 'B', 'loc': None}"]


def test_counts_of_metrics_files_need_no_parsing(spark, tmp_path):
    write(tmp_path / "ck" / "a" / "temp" / "class.csv", "\ufefffile,class\n\nA.java,A\nB.java,B")
    write(tmp_path / "ck" / "a" / "temp" / "method.csv", "\n  \nfile,class,method\nA.java,A,m()\n\n")
    write(tmp_path / "ck" / "b+c d" / "class.csv", "\n\n")  # blank lines alone: there, without rows
    write(tmp_path / "ck" / "e" / "temp" / "class.csv", "")
    # a is run twice: the crash has no counts and no report, and its rows do not count twice
    told = [("a", False), ("a", True), ("b+c d", True), ("e", True)]
    (tmp_path / "ck" / "runs.jsonl").write_text("".join(json.dumps({"sha": s, "timestamp": i, "exit_ok": ok, "timed_out": False}) + "\n" for i, (s, ok) in enumerate(told)))
    found = files.read_structure(spark, str(tmp_path / "ck"))
    rows = [(r["status"], r["n_classes"], r["n_methods"], r["csv_source"], r["method_source"], len(r["report"])) for r in found.orderBy("timestamp").collect()]
    assert rows == [("crash", 0, 0, "temp", "temp", 0), ("success", 2, 1, "temp", "temp", 2), ("empty_output", 0, 0, "repo_root", "absent", 0), ("missing_output", 0, 0, "absent", "absent", 0)]
    plan = found.drop("report")._jdf.queryExecution().optimizedPlan().toString()
    assert "from_csv" not in plan and "metric-lines" not in plan and plan.count("Join") == 1


def test_small_files_share_tasks(spark, tmp_path):
    for k in range(300):
        write(tmp_path / "in" / f"{k}.txt", f"{k}\n")
    lines = files.small_files(spark, str(tmp_path / "in"), "*.txt")
    assert lines.count() == 300 and lines.rdd.getNumPartitions() <= 5  # dozens of files each otherwise
    assert spark.conf.get("spark.sql.files.openCostInBytes") != str(files.OPEN_COST)


def test_each_row_lands_as_a_file(spark, tmp_path):
    rows = spark.createDataFrame([("temp", "c1", "x\ny"), ("root", "c2", "\ufeffä"), ("temp", "c3", "")], "place string, sha string, value string")
    for _ in range(2):  # a task that runs again leaves the same
        store.land_each(rows, f"file://{tmp_path}/out", "place", "sha")
    found = {str(p.relative_to(tmp_path / "out")): p.read_bytes().decode() for p in (tmp_path / "out").rglob("*") if p.is_file()}
    assert found == {"place=temp/sha=c1/part-0.txt": "x\ny\n", "place=root/sha=c2/part-0.txt": "\ufeffä\n", "place=temp/sha=c3/part-0.txt": "\n"}


def test_structure_stage_takes_landed_metrics(spark, tmp_path, place):
    write(place / "ck" / "a" / "temp" / "class.csv", "file,class\nA.java,A\n")
    write(place / "ck" / "a" / "temp" / "method.csv", "file,class,method\nA.java,A,m()\n")
    (place / "ck" / "runs.jsonl").write_text("".join(json.dumps({"sha": s, "timestamp": 1, "exit_ok": s != "b", "timed_out": False}) + "\n" for s in "abc"))
    (tmp_path / "grid.json").write_text(json.dumps({"entries": [{"tag": "v1", "snapshot_sha": "a"}, {"tag": "v2", "snapshot_sha": "b"}]}))
    w = build.Workspace(spark, str(place), str(tmp_path / "out"))
    assert run(w, tmp_path, "meta")[0] == 0 and run(w, tmp_path, "ck", sample="grid.json")[0] == 0
    assert {(r["sha"], r["status"]) for r in w.table("ck").collect()} == {("a", "success"), ("b", "crash")}
    assert counts(w, "ck") == {"records": 2, "failed": 1} and counts(w, "ck", "ck")["ok"] == 1
    # the failed one is tried again, and told by the old form of the manifest through the tags
    (tmp_path / "old.json").write_text('["2.0", "9.9"]')
    with pytest.raises(ValueError, match="no landed tags"):
        run(w, tmp_path, "ck", sample="old.json")
    assert counts(w, "ck", "ck")["ok"] == 0  # the last outcome
    (place / "tags.txt").write_text("v1.0 a\nrel_2_0 t b\n")
    code, said = run(w, tmp_path, "ck", sample="old.json")
    assert code == 0 and any("1 of 2 versions have no tag" in x for x in said)
    assert sorted(r["sha"] for r in w.table("ck").collect()) == ["a", "b", "b"]


@pytest.mark.parametrize("split", [None, 40])
def test_only_a_last_line_can_be_cut_off(spark, tmp_path, split):
    good = lambda *shas: "".join(f'{{"sha": "{s}", "parent_shas": []}}\n' for s in shas)
    for name, text in {
        "whole": good("a", "b"), "cut": good("c", "d") + '{"sha": "x', "damaged": good("e") + '{"sha": "y\n' + good("f"), "both": '{"sha": broken\n' + good("g") + '{"sha": "z',
        "blank": good("h") + '{"sha": "w\n\n', "only": '{"sha": "v', "ended": good("i") + '{"sha": "u\n',
    }.items():
        write(tmp_path / "in" / f"{name}.jsonl", text)
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        records, told = files.read_landed(spark, str(tmp_path / "in" / "*.jsonl"), schemas.LINEAGE)
        assert records.rdd.getNumPartitions() > 1
        by_name = {r["file"].rsplit("/", 1)[1].split(".")[0]: (r["corrupt"], r["cut_off"]) for r in told.collect()}
        assert by_name == {"whole": (0, False), "cut": (0, True), "damaged": (1, False), "both": (2, False), "blank": (1, False), "only": (0, True), "ended": (0, True)}
        rows = records.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(r["sha"] for r in rows if r["_corrupt"] is None) == list("abcdefghi")
    assert sorted(r["_corrupt"] for r in rows if r["_corrupt"] is not None) == ['{"sha": "w', '{"sha": "y', '{"sha": "z', '{"sha": broken']


def test_linking_counts_what_it_writes(spark, tmp_path, place):
    w = build.Workspace(spark, str(place), str(tmp_path / "out"))
    run(w, tmp_path, "meta")
    run(w, tmp_path, "channel", platform="github", channels="issues,prs")
    code, said = run(w, tmp_path, "link")
    assert code == 0 and any("name commits that the lineage lacks" in x for x in said)
    got = counts(w, "link")
    t = linkage.Tables(lineage=w.table("meta"), prs=w.table("prs"), issues=w.table("issues"), reviews=w.table("pr_reviews", schemas.REVIEWS), comments=w.table("comments", schemas.COMMENTS), commits=w.table("commits", schemas.COMMITS))
    assert got["dropped_absent"] == linkage.dropped_absent(t).first()[0] == 2 and got["never_merged"] == linkage.never_merged(t.prs).first()[0] == 1
    summary = {r["channel"]: r for r in w.table("linkage_summary").collect()}
    assert (summary["github.pr"]["pct_reached"], summary["github.pr"]["note"]) == (33.3, "1 never merged") and summary["github.comment"]["pct_reached"] is None
    assert (tmp_path / "out" / "linkage_summary.csv").read_text().splitlines()[0].startswith("channel,mined,reached,unreached,pct_reached")
    assert {r["event"] for r in events.last_counts(w.table("run_events")).where("stage = 'link'").collect()} >= {"ok", "milliseconds", "candidates"}


def test_walks_tell_what_does_not_fit(spark, tmp_path, place):
    (place / "ledger.jsonl").write_text("".join(json.dumps({"sha": s, "timestamp": 1, "modifications": []}) + "\n" for s in "abc"))
    w = build.Workspace(spark, str(place), str(tmp_path / "out"))
    (place / "lineage.txt").write_text("b|a|2\nc|b|3\na||1\n")  # c before its parent, seen from the oldest
    code, said = run(w, tmp_path, "meta")
    assert code == 0 and any("1 commits are landed after a parent" in x for x in said)
    assert counts(w, "meta") == {"commits": 3, "roots": 1, "merges": 0, "out_of_order": 1}
    assert run(w, tmp_path, "ledger", full=True)[1] == [] and counts(w, "ledger")["damaged"] == 0
    with (place / "ledger.jsonl").open("a") as f:
        f.write('{"sha": "c", "modi\n{"sha": "d"')
    assert run(w, tmp_path, "ledger", full=True)[1] == ["r: 2 landed lines of ledger cannot be read; their commits are tried again"]
    assert counts(w, "ledger")["damaged"] == 2 and counts(w, "ledger")["cut_off"] == 0
    (tmp_path / "u.json").write_text(json.dumps({"repo": "r", "head_sha": "b", "head_commits": 5}))
    code, said = run(w, tmp_path, "ledger", universe="u.json")
    assert code == 0 and any("tells 5 commits of its head, the lineage has 2" in x for x in said) and any("1 commits recorded by ledger are no longer" in x for x in said)
    assert counts(w, "ledger")["stale"] == 1 and counts(w, "ledger")["reachable"] == 2
    (tmp_path / "u.json").write_text(json.dumps({"repo": "r", "head_sha": "b", "near_mainline_shas": ["nope"]}))
    with pytest.raises(ValueError, match="lacks 1 commits of the manifest, such as nope"):
        run(w, tmp_path, "ledger", universe="u.json")


def test_reports_tell_of_channels_and_exports(spark, tmp_path, place):
    w = build.Workspace(spark, str(place), str(tmp_path / "out"))
    run(w, tmp_path, "meta")
    run(w, tmp_path, "channel", platform="github", channels="issues,prs")
    (place / "state" / "issues.json").write_text(json.dumps({"repo": "r", "channel": "issues", "is_complete": False, "last_page_done": 3, "rate_limit_reset": 99}))
    (place / "state" / "prs.json").write_text("{broken")
    assert run(w, tmp_path, "channel", platform="github", channels="issues,prs")[1] == ["r: prs holds records, but no progress is told; a state file may be lost"]
    assert counts(w, "channel", "prs")["new"] == 0 and w.table("prs").count() == 3
    run(w, tmp_path, "link")
    code, said = run(w, tmp_path, "report")
    rows = {r["artifact"]: r for r in build.coverage_rows(w).collect()}
    assert code == 0 and rows["issues"]["note"] == "INCOMPLETE — re-run to continue; through page 3; paused on API quota" and rows["prs"]["note"] == "no state file"
    assert rows["comments"]["note"] == "not mined yet" and rows["linkage_summary"]["records"] == 4 and any("through page 3" in x for x in said)


def test_csv_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n1,"two\nlines"\n2,b\n')
    (tmp_path / "b.csv").write_text("x,y,z\n")
    assert {tuple(r) for r in files.csv_rows(spark, str(tmp_path)).collect()} == {("a", 2), ("b", 0)}
    assert files.csv_rows(spark, str(tmp_path / "none")).count() == 0 and files.read_sidecars(spark, str(tmp_path / "none")).count() == 0
    assert sinks.read_table(spark, str(tmp_path / "none")) is None
