"""Channels of a code hosting service: raw JSON items to unified records, and a paginated source.

The source is a Python data source, for batch and for streams: format("paged") reads pages by a cursor. A page is
committed only after its rows were written; offsets are {page, next, since}. Fetching is a function given by name, so
tests run on recorded pages and nothing here opens a connection by itself.
"""

from __future__ import annotations

import http.client
import importlib
import json
import re
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

from loomstone.functions.text import epoch, label_names_of, title_and_body, url_number
from loomstone.sources.sinks import ChannelState

# Fields of a raw item that records use, and limits of the service.
RAW = (
    "id bigint, number bigint, state string, title string, body string, created_at string, closed_at string, merged_at string, merge_commit_sha string, path string, line int, original_line int, "
    "commit_id string, original_commit_id string, pull_request_url string, issue_url string, user struct<login:string>"
)
PAGE_SIZE, RETRIES, QUOTA_FLOOR = 100, 4, 2


#: Where an item was delivered; records keep both, and their repository, if the raw items have them.
DELIVERED = ("page", "place")


def _record(raw: DataFrame, number: bool, channel: str) -> DataFrame:
    """Parsed items with the fields that all channels share."""
    j = raw.select("raw", F.from_json("raw", RAW).alias("j"), *_delivered(raw))
    text = title_and_body(F.col("j.title"), F.col("j.body")) if number else F.regexp_replace(F.coalesce("j.body", F.lit("")), r"(?U)^\s+|\s+$", "")
    labels = label_names_of(F.col("raw")) if number else F.array().cast("array<string>")
    return j.select("*", F.col("j.number" if number else "j.id").alias("record_id"), F.lit(channel).alias("channel"), epoch(F.col("j.created_at")).alias("timestamp"), F.col("j.user.login").alias("author"), text.alias("text"), labels.alias("labels"))


def _delivered(raw: DataFrame) -> list[str]:
    return [c for c in (*DELIVERED, "repo") if c in raw.columns]


_SHARED = ["record_id", "channel", "timestamp", "author", "text", "labels"]
_NO_FILE = "cast(NULL AS string) AS file_path"
_NO_PARENT = ["cast(NULL AS bigint) AS parent_id", "cast(NULL AS string) AS parent_channel"]


def issues(raw: DataFrame) -> DataFrame:
    """Closed items that are no pull requests: the key decides, even with a null value."""
    own = ~F.coalesce(F.array_contains(F.json_object_keys("raw"), "pull_request"), F.lit(False))
    r = _record(raw.where(own), True, "github.issue").where("record_id IS NOT NULL")
    return r.select(*_SHARED, *map(F.expr, [_NO_FILE, *_NO_PARENT]), epoch(F.col("j.closed_at")).alias("closed_at"), *_delivered(raw))


def pulls(raw: DataFrame) -> DataFrame:
    r = _record(raw, True, "github.pr").where("record_id IS NOT NULL")
    return r.select(*_SHARED, *map(F.expr, [_NO_FILE, *_NO_PARENT]), epoch(F.col("j.closed_at")).alias("closed_at"), epoch(F.col("j.merged_at")).alias("merged_at"), F.col("j.merge_commit_sha").alias("merge_commit_sha"), *_delivered(raw))


def reviews(raw: DataFrame) -> DataFrame:
    r = _record(raw, False, "github.pr_review").where("record_id IS NOT NULL")
    line = F.coalesce(F.nullif("j.line", F.lit(0)), F.col("j.original_line"))
    sha = F.coalesce(F.nullif("j.commit_id", F.lit("")), F.col("j.original_commit_id"))
    return r.select(*_SHARED, F.col("j.path").alias("file_path"), url_number(F.col("j.pull_request_url")).alias("parent_id"), F.lit("github.pr").alias("parent_channel"), line.alias("diff_line"), sha.alias("commit_sha"), *_delivered(raw))


def comments(raw: DataFrame) -> DataFrame:
    r = _record(raw, False, "github.comment").where("record_id IS NOT NULL")
    return r.select(*_SHARED, F.expr(_NO_FILE), url_number(F.col("j.issue_url")).alias("parent_id"), F.lit("github.issue_or_pr").alias("parent_channel"), *_delivered(raw))


@dataclass(frozen=True)
class Endpoint:
    """What a channel asks of the service."""

    channel: str
    path: str
    normalise: Callable[[DataFrame], DataFrame]
    since: bool = False
    params: dict[str, str] = field(default_factory=dict)


ENDPOINTS = {
    "issues": Endpoint("issues", "issues", issues, True, {"state": "closed", "sort": "created", "direction": "asc"}),
    "prs": Endpoint("prs", "pulls", pulls, False, {"state": "closed", "sort": "created", "direction": "asc"}),
    "pr_reviews": Endpoint("pr_reviews", "pulls/comments", reviews, True, {"sort": "created", "direction": "asc"}),
    "comments": Endpoint("comments", "issues/comments", comments, True, {"sort": "created", "direction": "asc"}),
}


def next_link(header: str | None) -> str | None:
    """The address of the first part of a Link header whose attributes say rel="next"."""
    for part in (header or "").split(","):
        m = re.match(r'\s*<([^>]*)>(.*)', part)
        if m and 'rel="next"' in m[2]:
            return m[1]
    return None


class QuotaReached(RuntimeError):
    """The service wants no more requests before `reset`, in epoch seconds."""

    def __init__(self, reset: int):
        super().__init__(f"quota is used up until {reset}")
        self.reset = reset


class AccessError(RuntimeError):
    """The service does not give what was asked for, and asking again would not help."""


#: Statuses that mean "too fast", and seconds to wait after each failed attempt by its cause.
THROTTLING = (403, 429)
WAITS = {"throttled": (5, 10, 20, 40), "broken": (2, 4, 8, 16)}


@dataclass(frozen=True)
class Reply:
    """What a request brought: a status (None without any), lower-case headers, the body's items if it could be read."""

    status: int | None
    headers: dict[str, str] = field(default_factory=dict)
    items: list[dict] | None = None
    fault: str = ""

    def number(self, header: str) -> int | None:
        said = self.headers.get(header, "")
        return int(said) if said.isdigit() else None

    @property
    def cause(self) -> str:
        """answer, quota, throttled, broken (worth another attempt), or refused."""
        if self.items is not None:
            return "answer"
        if self.status in THROTTLING:
            spent = self.number("x-ratelimit-remaining") == 0 and self.number("x-ratelimit-reset") is not None
            return "quota" if spent else "throttled"
        return "refused" if self.status is not None and 300 <= self.status < 500 else "broken"

    def wait(self, attempt: int) -> float:
        """Seconds until the next attempt; the service's own wish goes first when it throttles."""
        wish = self.headers.get("retry-after") if self.cause == "throttled" else None
        return float(wish) if wish else float(WAITS[self.cause][attempt])


class HttpFetch:
    """Pages over HTTP: (cursor, params) to (items, next cursor).

    A page is handed over before its quota headers count: the call after one that left QUOTA_FLOOR or fewer requests
    raises QuotaReached. Throttling, server and transport errors are tried RETRIES times, with the pauses of WAITS.
    """

    def __init__(self, address: str, headers: dict[str, str] | None = None, open_: Callable = urllib.request.urlopen, sleep: Callable[[float], None] = time.sleep, timeout: float = 60):
        self.address, self.headers, self.open, self.sleep, self.timeout = address, headers or {}, open_, sleep, timeout
        self.reset: int | None = None

    def __call__(self, cursor: str | None, params: dict[str, str]) -> tuple[list[dict], str | None]:
        if self.reset:
            raise QuotaReached(self.reset)
        reply = self._answered(cursor or f"{self.address}?{urllib.parse.urlencode({'per_page': PAGE_SIZE} | params)}")
        left = reply.number("x-ratelimit-remaining")
        if left is not None and left <= QUOTA_FLOOR:
            self.reset = reply.number("x-ratelimit-reset")
        return reply.items or [], next_link(reply.headers.get("link"))

    def _answered(self, url: str) -> Reply:
        """The first reply that is an answer; else an error that tells the cause."""
        reply = self._ask(url)
        for attempt in range(RETRIES):
            if reply.cause == "answer":
                return reply
            if reply.cause == "quota":
                raise QuotaReached(reply.number("x-ratelimit-reset") or 0)
            if reply.cause == "refused":
                break
            self.sleep(reply.wait(attempt))
            if attempt < RETRIES - 1:
                reply = self._ask(url)
        raise AccessError(f"{url}: {reply.cause}, {reply.fault or reply.status}")

    def _ask(self, url: str) -> Reply:
        """One request, and whatever came of it."""
        try:
            with self.open(urllib.request.Request(url, headers=self.headers), timeout=self.timeout) as answer:
                found = json.load(answer)
                return Reply(200, _lower(answer.headers), found if isinstance(found, list) else [found])
        except urllib.error.HTTPError as e:
            return Reply(e.code, _lower(e.headers or {}), fault=str(e))
        except (OSError, http.client.HTTPException, ValueError) as e:
            return Reply(None, fault=repr(e))


def _lower(headers) -> dict[str, str]:
    return {name.lower(): value for name, value in headers.items()}


def run_channel(fetch: Fetch, endpoint: Endpoint, state: ChannelState, write: Callable[[list[dict], int], int], pages: int = 0, now: float | None = None) -> bool:
    """Takes pages from where the state stands, writes each and then records it; whether the channel is complete.

    A used-up quota ends the run and is recorded with its reset time, before which the next run takes nothing.
    """
    if state.must_wait(now):
        return False
    held = state.values
    offset = {"page": held["last_page_done"], "next": held["next_url"], "since": held["window_since"], "newest": held.get("newest"), "complete": bool(held["is_complete"])}
    try:
        for items, at in walk(fetch, endpoint.params, offset, endpoint.since, pages):
            written = write(items, at["page"])
            state.save(last_page_done=at["page"], next_url=at["next"], window_since=at["since"], newest=at["newest"], is_complete=at["complete"], rate_limit_reset=None, records_written=state.values["records_written"] + written)
    except QuotaReached as e:
        state.save(rate_limit_reset=e.reset)
        return False
    return bool(state.values["is_complete"])


Fetch = Callable[[str | None, dict[str, str]], tuple[list[dict], str | None]]


def walk(fetch: Fetch, params: dict[str, str], offset: dict, since: bool, pages: int = 0) -> Iterator[tuple[list[dict], dict]]:
    """(items, offset after them) of each page from an offset on.

    At the end of a walk that may be windowed, a new window starts at the newest creation time seen, however short its last
    page was; it ends when a window brings nothing newer. Overlaps repeat items and lose none.
    """
    now, done = dict({"page": 0, "next": None, "since": None, "newest": None, "complete": False} | offset), 0
    while not now["complete"] and (pages <= 0 or done < pages):
        items, cursor = fetch(now["next"], params | ({"since": now["since"]} if now["since"] and not now["next"] else {}))
        newest = max([x.get("created_at") or "" for x in items] + [now["newest"] or ""]) or None
        now = now | {"page": now["page"] + 1, "next": cursor, "newest": newest}
        if not cursor:
            newer = since and newest and (now["since"] or "") < newest
            now |= {"since": newest if newer else now["since"], "complete": not newer}
        done += 1
        yield items, now


def _fetcher(options: dict) -> Fetch:
    module, _, name = options["fetch"].partition(":")
    return getattr(importlib.import_module(module), name)


def _rows(items: list[dict], page: int) -> list[tuple[str, int, int]]:
    return [(json.dumps(x), page, k) for k, x in enumerate(items)]


class PagedSource(DataSource):
    """format("paged"): raw items as JSON text, with the page and the place in it. Options: fetch (module:function), channel, pages per batch."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "raw string, page int, place int"

    def reader(self, schema) -> DataSourceReader:
        return _BatchReader(dict(self.options))

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:  # noqa: N802
        return _StreamReader(dict(self.options))


class _BatchReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(self.options["channel"])]

    def read(self, partition: InputPartition):
        endpoint = ENDPOINTS[partition.value]
        for items, now in walk(_fetcher(self.options), endpoint.params, {}, endpoint.since, int(self.options.get("pages", 0))):
            yield from _rows(items, now["page"])


class _StreamReader(SimpleDataSourceStreamReader):
    def __init__(self, options: dict):
        self.options = options

    def initialOffset(self) -> dict:  # noqa: N802
        return {"page": 0, "next": None, "since": None, "newest": None, "complete": False}

    def read(self, start: dict):
        endpoint, rows, end = ENDPOINTS[self.options["channel"]], [], start
        for items, end in walk(_fetcher(self.options), endpoint.params, start, endpoint.since, int(self.options.get("pages", 1))):  # noqa: B007
            rows += _rows(items, end["page"])
        return iter(rows), end

    def readBetweenOffsets(self, start: dict, end: dict):  # noqa: N802
        endpoint, rows = ENDPOINTS[self.options["channel"]], []
        for items, now in walk(_fetcher(self.options), endpoint.params, start, endpoint.since, end["page"] - start["page"]):
            rows += _rows(items, now["page"])
        return iter(rows)

    def commit(self, end: dict) -> None:
        """Nothing: the checkpoint holds the offset."""
