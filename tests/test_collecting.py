"""Collecting many channels in rounds: nothing lost or doubled, runs go on, quotas and refusals stop no other unit."""

from __future__ import annotations

import pytest

from loomstone.sources import collecting
from loomstone.sources.versions import VersionedTable

UNITS = "repo string, channel string"


def service(spark, tmp_path, *units):
    found = collecting.Collection(spark, str(tmp_path / "c"), "recorded_pages:many")
    found.add(spark.createDataFrame(list(units), UNITS))
    return found


def states(found):
    return {r["unit"]: (r["page"], r["complete"], r["reset"], r["fault"]) for r in found.states().collect()}


def test_rounds_go_on_from_the_states(spark, tmp_path):
    found = service(spark, tmp_path, ("r1", "prs"), ("r5", "prs"), ("r2", "issues"))
    told = found.take(2, now=0)
    assert told == {"units": 3, "complete": 1, "waiting": 0, "refused": 0, "items": 3 + 6 + 6}
    assert states(found) == {"r1/prs": (1, True, None, None), "r5/prs": (2, False, None, None), "r2/issues": (2, False, None, None)}
    # another run, from the tables alone; a unit that is added again keeps its state
    again = service(spark, tmp_path, ("r5", "prs"), ("r3", "prs"))
    left = again.run(2, now=0)
    assert left["open"] == left["refused"] == 0 and all(s[1] for s in states(again).values())
    pulls = again.records("prs")
    assert sorted((r["repo"], r["record_id"]) for r in pulls.collect()) == sorted((f"r{n}", k) for n in (1, 3, 5) for k in range(3 * n))
    # the window's overlap repeats items of the newest time and doubles none
    issues = again.records("issues")
    assert sorted(r["record_id"] for r in issues.collect()) == list(range(6)) and "page" not in issues.columns
    assert {r["unit"]: r["items"] for r in again.states().collect()}["r2/issues"] > 6
    assert again.run(2, now=0)["rounds"] == 0


def test_quota_and_refusal_stop_no_other(spark, tmp_path):
    found = service(spark, tmp_path, ("quota", "prs"), ("gone", "prs"), ("r2", "prs"))
    assert found.take(10, now=0) == {"units": 3, "complete": 1, "waiting": 1, "refused": 1, "items": 9}
    assert states(found) == {"quota/prs": (1, False, 1000, None), "gone/prs": (0, False, None, "404"), "r2/prs": (2, True, None, None)}
    assert {r["unit"] for r in found.open_units(999).collect()} == {"gone/prs"} and {r["unit"] for r in found.open_units(1000).collect()} == {"gone/prs", "quota/prs"}
    assert found.run(5, now=0) == {"rounds": 0, "items": 0, "open": 2, "refused": 1}
    assert len({(r["repo"], r["record_id"]) for r in found.records("prs").collect()}) == 3 + 6


def test_a_round_that_fails_is_done_again(spark, tmp_path, monkeypatch):
    found = service(spark, tmp_path, ("r4", "prs"), ("r3", "prs"))
    true = VersionedTable.upsert

    def dies(self, rows, *more):
        raise OSError("after the items, before the states")

    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "upsert", dies)
        with pytest.raises(OSError):
            found.take(2, now=0)
    assert found.records("prs").count() == 12 and all(s[0] == 0 for s in states(found).values()) and true is VersionedTable.upsert
    assert found.run(2, rounds=1, now=0)["rounds"] == 1 and found.records("prs").count() == 12
    assert found.run(3, now=0)["open"] == 0 and found.records("prs").count() == 21


def test_rounds_of_a_long_channel_are_few(spark, tmp_path):
    found = service(spark, tmp_path, ("r40", "prs"))
    told = found.run(1, now=0)
    assert told["rounds"] <= 6 and told["open"] == 0 and states(found)["r40/prs"][:2] == (40, True) and found.records("prs").count() == 120


def test_no_units(spark, tmp_path):
    found = service(spark, tmp_path)
    assert found.states().count() == 0 and found.run(3) == {"rounds": 0, "items": 0, "open": 0, "refused": 0} and found.records("prs") is None


def test_landed_pages(tmp_path):
    for n, lines in ((1, ['{"id": 1, "created_at": "2024-01-01"}', ""]), (2, ['{"id": 2, "created_at": "2024-01-02"}'])):
        (tmp_path / "prs" / f"page={n}").mkdir(parents=True)
        (tmp_path / "prs" / f"page={n}" / "part-0").write_text("\n".join(lines))
        (tmp_path / "prs" / f"page={n}" / "_SUCCESS").write_text("")
    fetch = collecting.landed_pages(str(tmp_path), "prs")
    assert fetch(None, {}) == ([{"id": 1, "created_at": "2024-01-01"}], "2") and fetch("2", {}) == ([{"id": 2, "created_at": "2024-01-02"}], None)
    assert fetch(None, {"since": "2024-01-02"}) == ([], "2") and collecting.landed_pages(f"file://{tmp_path}", "issues")(None, {}) == ([], None)
