from __future__ import annotations

import csv
import json
import urllib.error

import pytest

from loomstone import schemas
from loomstone.plans import stages
from loomstone.sources import files, hosting, sinks
from loomstone.streaming import channels


def test_records(spark, tmp_path):
    path = tmp_path / "x.jsonl"
    path.write_text('{"sha": "a", "parent_shas": ["b"]}\n\n{"sha": broken\n{"sha": "c"')
    assert [r["sha"] for r in files.read_records(spark, str(path), schemas.LINEAGE).collect()] == ["a"]
    assert files.read_records(spark, str(path), schemas.LINEAGE, corrupt=True).where("_corrupt IS NOT NULL").count() == 2
    assert files.read_records(spark, str(tmp_path / "none"), schemas.LINEAGE, keep=["sha"]).columns == ["sha"]


def test_delimited(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_bytes(b"\xef\xbb\xbfclass,wmc\nA,1\nB,\n")
    assert files.read_delimited(spark, str(path)).columns == ["class", "wmc"] and files.row_count(spark, str(path)).first()[0] == 2


def test_channels(spark):
    raw = [
        {"number": 1, "title": " t", "body": None, "pull_request": None}, {"number": 2, "title": "t", "body": "b ", "labels": [{"name": "x"}, {"name": ""}], "created_at": "2024-01-01T00:00:00Z", "closed_at": None},
        {"number": None, "title": "no id"},
    ]
    df = spark.createDataFrame([(json.dumps(x),) for x in raw], "raw string")
    found = [r.asDict() for r in hosting.issues(df).collect()]
    assert [(r["record_id"], r["text"], r["labels"], r["timestamp"]) for r in found] == [(2, "t\n\nb", ["x"], 1704067200)]
    review = spark.createDataFrame([(json.dumps({"id": 5, "body": "b", "path": "A.java", "line": 0, "original_line": 9, "pull_request_url": "https://h/pulls/7", "commit_id": "s"}),)], "raw string")
    assert tuple(hosting.reviews(review).select("record_id", "parent_id", "diff_line", "commit_sha").first()) == (5, 7, 9, "s")


def test_next_link():
    assert hosting.next_link('<https://a?page=1>; rel="prev", <https://a?page=3>; rel="next"') == "https://a?page=3"
    assert hosting.next_link(None) is None


def test_paged_source(spark):
    spark.dataSource.register(hosting.PagedSource)
    df = spark.read.format("paged").option("fetch", "recorded_pages:fetch").option("channel", "comments").load()
    assert sorted((json.loads(r["raw"])["id"], r["page"]) for r in df.collect()) == [(1, 1), (2, 1), (2, 2), (3, 2), (3, 3)]


def test_stream_takes_each_record_once_and_never_updates(spark, tmp_path):
    spark.dataSource.register(hosting.PagedSource)
    for _ in range(2):
        stream = spark.readStream.format("paged").option("fetch", "recorded_pages:fetch").option("channel", "comments").option("pages", "2").load()
        query = stream.writeStream.foreachBatch(lambda b, _: sinks.append_new(hosting.comments(b.select("raw")), str(tmp_path / "t"), "record_id")).option("checkpointLocation", str(tmp_path / f"c{_}")).start()
        query.processAllAvailable()
        query.stop()
    rows = {r["record_id"]: r["text"] for r in spark.read.parquet(str(tmp_path / "t")).collect()}
    assert sorted(rows) == [1, 2, 3] and rows[2] == "b"


def test_insert_only_from_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (None, "c")], "record_id long, text string").write.parquet(str(tmp_path / "in" / "x"))
    stream = spark.readStream.schema("record_id long, text string").parquet(str(tmp_path / "in" / "*"))
    channels.insert_only(stream, str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    assert sorted(r["record_id"] for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [1, 2]


def test_refresh_and_export(spark, tmp_path):
    sinks.refresh(spark.range(3), str(tmp_path / "t"))
    sinks.refresh(spark.range(5), str(tmp_path / "t"))
    assert sinks.read_table(spark, str(tmp_path / "t")).count() == 5
    sinks.replace_csv(spark.sql("SELECT 1 AS a, cast(NULL AS int) AS b"), str(tmp_path / "x.csv"))
    assert list(csv.reader((tmp_path / "x.csv").open())) == [["a", "b"], ["1", ""]]


def test_channel_state(tmp_path):
    path = tmp_path / "s.json"
    path.write_text("{broken")
    state = sinks.ChannelState(str(path))
    assert list(tmp_path.glob("s.corrupt_*.json"))
    state.save(rate_limit_reset=100)
    again = sinks.ChannelState(str(path))
    assert again.must_wait(99) and not again.must_wait(101)


def test_walk_restarts_in_a_window():
    page = [{"created_at": f"2024-01-01T00:{k // 60:02d}:{k % 60:02d}Z"} for k in range(hosting.PAGE_SIZE)]
    asked = []

    def fetch(cursor, params):
        asked.append(params.get("since"))
        return (page, None) if len(asked) == 1 else ([], None)

    last = [now for _, now in hosting.walk(fetch, {}, {}, True)][-1]
    assert last["complete"] and asked == [None, page[-1]["created_at"]]


class Answer:
    def __init__(self, items, **headers):
        self.items, self.headers = items, {k.replace("_", "-"): v for k, v in headers.items()}

    def __enter__(self):
        return self

    def __exit__(self, *_):
        return None

    def read(self, *_):
        return json.dumps(self.items).encode()


def recorded(*answers):
    """An opener that gives or raises the answers in order, and the fetch over it with its pauses."""
    left, pauses = list(answers), []

    def open_(request, timeout):
        answer = left.pop(0)
        if isinstance(answer, Exception):
            raise answer
        return answer

    return hosting.HttpFetch("https://h/x", open_=open_, sleep=pauses.append), pauses


def failed(code, **headers):
    return urllib.error.HTTPError("https://h/x", code, "", {k.replace("_", "-"): v for k, v in headers.items()}, None)


def test_retries_and_quota():
    fetch, pauses = recorded(failed(502), ConnectionResetError(), failed(429, retry_after="7"), Answer([{"id": 1}], link='<https://h/x?page=2>; rel="next"', x_ratelimit_remaining="2", x_ratelimit_reset="99"))
    assert fetch(None, {}) == ([{"id": 1}], "https://h/x?page=2") and pauses == [2, 4, 7]
    with pytest.raises(hosting.QuotaReached) as e:
        fetch("https://h/x?page=2", {})
    assert e.value.reset == 99
    fetch, _ = recorded(failed(403, x_ratelimit_remaining="0", x_ratelimit_reset="5"))
    with pytest.raises(hosting.QuotaReached):
        fetch(None, {})
    for answers in ([failed(404)], [failed(401)], [failed(500)] * 4):
        fetch, pauses = recorded(*answers)
        with pytest.raises(hosting.AccessError):
            fetch(None, {})


@pytest.mark.parametrize(
    ("reply", "cause", "wait"),
    [
        (hosting.Reply(200, items=[]), "answer", None), (hosting.Reply(403, {"x-ratelimit-remaining": "0", "x-ratelimit-reset": "9"}), "quota", None), (hosting.Reply(429, {"x-ratelimit-remaining": "0"}), "throttled", 20),
        (hosting.Reply(403, {"x-ratelimit-remaining": "7", "x-ratelimit-reset": "9"}), "throttled", 20), (hosting.Reply(429, {"retry-after": "1.5"}), "throttled", 1.5), (hosting.Reply(404), "refused", None),
        (hosting.Reply(503, {"retry-after": "60"}), "broken", 8), (hosting.Reply(None, fault="reset"), "broken", 8), (hosting.Reply(301), "refused", None),
    ],
)
def test_causes(reply, cause, wait):
    assert reply.cause == cause and (wait is None or reply.wait(2) == wait)


def test_unreadable_answers_are_tried_again():
    class Cut(Answer):
        def read(self, *_):
            return b"[{"

    fetch, pauses = recorded(Cut(None), Answer({"id": 1}))
    assert fetch(None, {}) == ([{"id": 1}], None) and pauses == [2]


def test_channel_runs_go_on_where_they_stopped(tmp_path):
    next_ = '<https://h/x?page=2>; rel="next"'
    state, seen = sinks.ChannelState(str(tmp_path / "s.json")), []
    write = lambda items, page: seen.extend((page, x["id"]) for x in items) or len(items)
    fetch, _ = recorded(Answer([{"id": 1}], link=next_, x_ratelimit_remaining="1", x_ratelimit_reset="1000"))
    assert not hosting.run_channel(fetch, hosting.ENDPOINTS["prs"], state, write, now=10)
    state = sinks.ChannelState(str(tmp_path / "s.json"))
    assert state.values["rate_limit_reset"] == 1000 and state.values["next_url"] == "https://h/x?page=2"
    assert not hosting.run_channel(recorded()[0], hosting.ENDPOINTS["prs"], state, write, now=10)  # too early: nothing is asked
    fetch, _ = recorded(Answer([{"id": 2}]))
    assert hosting.run_channel(fetch, hosting.ENDPOINTS["prs"], state, write, now=2000) and seen == [(1, 1), (2, 2)]
    assert sinks.ChannelState(str(tmp_path / "s.json")).values["records_written"] == 2 and state.values["is_complete"]


def test_windows_go_on_after_a_short_page():
    pages = {None: [{"id": 1, "created_at": "2020-01-01T00:00:00Z"}], "2020-01-01T00:00:00Z": [{"id": 1, "created_at": "2020-01-01T00:00:00Z"}, {"id": 2, "created_at": "2020-02-01T00:00:00Z"}], "2020-02-01T00:00:00Z": [{"id": 2, "created_at": "2020-02-01T00:00:00Z"}]}
    seen = [now for _, now in hosting.walk(lambda cursor, params: (pages[params.get("since")], None), {}, {}, True)]
    assert [now["since"] for now in seen] == ["2020-01-01T00:00:00Z", "2020-02-01T00:00:00Z", "2020-02-01T00:00:00Z"] and seen[-1]["complete"]


def test_first_delivered_counts(spark, tmp_path):
    rows = [(1, "a", 0), (2, "b", 1), (2, "edited", 2), (None, "c", 3), (1, "again", 4)]
    df = spark.createDataFrame(rows, "record_id long, text string, place int").repartition(4)
    sinks.append_new(df, str(tmp_path / "t"), "record_id", "place")
    sinks.append_new(spark.createDataFrame([(2, "later", 9), (3, "d", 10)], df.schema), str(tmp_path / "t"), "record_id", "place")
    assert {r["record_id"]: r["text"] for r in spark.read.parquet(str(tmp_path / "t")).collect()} == {1: "a", 2: "b", 3: "d"}


def test_exclusive_flags():
    P = stages.RunPlan
    for bad in (P("r", "ledger", version="v", universe="u"), P("r", "ck", version="v", sample="s"), P("r", "ledger", universe="u", full=True)):
        with pytest.raises(stages.PlanError) as e:
            stages.validate(bad)
        assert any("exclude each other" in x for x in e.value.faults)
    assert stages.validate(P("r", "ledger", version="v", full=True)).scope == "full"


def test_plans(tmp_path):
    P = stages.RunPlan
    with pytest.raises(stages.PlanError) as e:
        stages.validate(P("r", "link", batch=50, version="1", universe="u"))
    assert len(e.value.faults) == 4
    with pytest.raises(stages.PlanError, match="walks commits"):
        stages.validate(P("r", "ledger"))
    with pytest.raises(stages.PlanError, match="--full"):
        stages.validate(P("r", "channel", platform="github", channels="all", full=True))
    with pytest.raises(stages.PlanError, match="no such file"):
        stages.validate(P("r", "ck", sample="none.json"))
    (tmp_path / "u.json").write_text("{}")
    plan = stages.validate(P("r", "ledger", universe="u.json"), tmp_path)
    assert plan.paths["universe"] == tmp_path / "u.json" and plan.limit == 50 and plan.scope == "explicit"
    assert stages.validate(P("r", "channel", platform="github", channels=" Issues , prs,")).wanted_channels == ("issues", "prs")
    assert P("r", "channel", platform="github", channels="all").wanted_channels == stages.CHANNELS["github"]
    assert P("r", "ledger", version="1").scope == "full"


def test_runner():
    C = stages.Command
    ran = []
    code, results = stages.run_all([C("a", lambda: False), C("b", lambda: ran.append("b") or True), C("sum", lambda: ran.append("sum") or True, True)])
    assert code == 1 and ran == ["b"] and results == {"a": False, "b": True, "sum": False}
    said = []
    assert stages.chained({"up": lambda x: x + 1, "later": None}, ["up", "later", "none"], said.append)(1) == 2 and len(said) == 2
    with pytest.raises(ValueError, match="no strategy"):
        stages.chained({}, ["x"], said.append)
