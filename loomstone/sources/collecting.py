"""Collecting the channels of many repositories at once: a table of states in, pages and a table of states out.

A unit is a repository's channel. Where each stands is a row: page, cursor, window, newest creation time, whether it is
complete, and until when its quota is used up. A round deals the open units to tasks; each task takes up to `pages` pages of
each of its units from where that stands and hands over items with page and place, and the unit's new state. Items are
written once and added to keyed tables before the states move on, so a round that fails is done again and adds nothing twice:
pages are at least once, records exactly once.

Within a unit pages follow each other, as each tells the next; units run side by side. A unit whose quota is used up, or that
the service refuses, keeps the pages it got, and stops no other.

Edge cases: a unit without a state starts at the first page; one that is complete, or whose quota is not back, is not asked;
items without an id are not taken; an empty table of units is a round without requests.
"""

from __future__ import annotations

import importlib
import json
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstone.sources import sinks, store
from loomstone.sources.hosting import DELIVERED, ENDPOINTS, AccessError, Fetch, QuotaReached, walk
from loomstone.sources.versions import VersionedTable

#: A unit's state, as kept.
STATE = "unit string, repo string, channel string, page int, next string, since string, newest string, complete boolean, reset bigint, items bigint, fault string"
#: Pages of a unit in one of run()'s later rounds, at most.
MOST = 1 << 14
_DELIVERY = f"kind string, raw string, place int, {STATE}"
_STATE_NAMES = [c.split()[0] for c in STATE.split(", ")]


def fetcher(name: str) -> Callable[[str, str], Fetch]:
    """What gives the fetch of a repository's channel, by module:function."""
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def unit_of(repo: str, channel: str) -> str:
    return f"{repo}/{channel}"


def round_of(states: DataFrame, fetch: str, pages: int) -> DataFrame:
    """Items and new states of one round over open units, as rows of kind item and state."""

    def collect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = fetcher(fetch)
        for batch in batches:
            for row in batch.to_dict("records"):
                now = {k: None if v is None or v != v else v for k, v in row.items()}  # NaN is pandas' null
                now |= {"page": int(now["page"] or 0), "complete": bool(now["complete"]), "items": int(now["items"] or 0), "reset": None, "fault": None}
                endpoint = ENDPOINTS[now["channel"]]
                offset = {k: now[k] for k in ("page", "next", "since", "newest", "complete")}
                try:
                    for items, at in walk(of(now["repo"], now["channel"]), endpoint.params, offset, endpoint.since, pages):
                        now |= at | {"items": now["items"] + len(items)}
                        if items:
                            yield _rows([now | {"kind": "item", "raw": json.dumps(x), "place": k} for k, x in enumerate(items)])
                except QuotaReached as e:
                    now["reset"] = e.reset
                except AccessError as e:
                    now["fault"] = str(e)
                yield _rows([now | {"kind": "state", "raw": None, "place": None}])

    return states.mapInPandas(collect, _DELIVERY)


def _rows(rows: list[dict]) -> pd.DataFrame:
    names = [c.split()[0] for c in _DELIVERY.split(", ")]
    return pd.DataFrame({c: pd.Series([r[c] for r in rows], dtype=object) for c in names}).astype({"place": "Int32", "page": "Int32", "reset": "Int64", "items": "Int64", "complete": "boolean"})


class Collection:
    """The channels of many repositories under one folder: states, and a keyed table of records for each channel."""

    def __init__(self, spark: SparkSession, path: str, fetch: str):
        self.spark, self.path, self.fetch = spark, path.rstrip("/"), fetch
        self.kept = VersionedTable(spark, f"{self.path}/states")

    def states(self) -> DataFrame:
        found = self.kept.read()
        return self.spark.createDataFrame([], STATE) if found is None else found

    def add(self, units: DataFrame) -> None:
        """Makes units (repo, channel) known; those that have a state keep it."""
        named = units.select(F.concat_ws("/", "repo", "channel").alias("unit"), "repo", "channel").distinct().join(self.states().select("unit"), "unit", "left_anti")
        start = [F.lit(v).cast(t).alias(c) for c, t, v in (("page", "int", 0), ("next", "string", None), ("since", "string", None), ("newest", "string", None), ("complete", "boolean", False), ("reset", "bigint", None), ("items", "bigint", 0), ("fault", "string", None))]
        self.kept.upsert(named.select("unit", "repo", "channel", *start), "unit")

    def open_units(self, now: float | None = None) -> DataFrame:
        """States that a round would go on from: neither complete nor waiting for their quota."""
        moment = int(time.time() if now is None else now)
        return self.states().where(~F.col("complete") & (F.coalesce("reset", F.lit(0)) <= moment))

    def take(self, pages: int, now: float | None = None, tasks: int | None = None) -> dict[str, int]:
        """One round of up to `pages` pages for each open unit; how many units went on, items came, and units stopped early."""
        units = store.held(self.open_units(now), "units")
        # units differ in length by far: each is a task of its own as far as there are tasks
        dealt = units.repartition(tasks or max(1, min(units.count(), int(self.spark.conf.get("spark.sql.shuffle.partitions")))), "unit")
        got = store.held(round_of(dealt, self.fetch, pages), "round")
        items = got.where("kind = 'item'")
        for channel in sorted(r[0] for r in items.select("channel").distinct().collect()):  # as many as there are endpoints
            own = items.where(F.col("channel") == channel).select("repo", "raw", *DELIVERED)
            records = self._records(own, channel)
            sinks.append_new(records, f"{self.path}/{channel}", "key", *DELIVERED, forget=True)
        states = got.where("kind = 'state'").select(*_STATE_NAMES)
        told = states.agg(F.count("*").alias("units"), F.count_if("complete").alias("complete"), F.count_if(F.col("reset").isNotNull()).alias("waiting"), F.count_if(F.col("fault").isNotNull()).alias("refused")).first().asDict()
        self.kept.upsert(states, "unit")
        return told | {"items": items.count()}

    @staticmethod
    def _records(items: DataFrame, channel: str) -> DataFrame:
        """Unified records with their repository and a key over both."""
        found = ENDPOINTS[channel].normalise(items)
        return found.withColumn("key", F.concat_ws("#", "repo", F.col("record_id").cast("string")))

    def run(self, pages: int, rounds: int = 0, now: float | None = None) -> dict[str, int]:
        """Rounds until no unit is open, or `rounds` of them; what all of them took, and what is left.

        The first round takes up to `pages` pages of each unit, every further one twice as many as the one before, up to
        MOST, so the rounds of a long channel are few. A round that fails is lost: as much as was there before it, at most.
        """
        total, done = {"rounds": 0, "items": 0}, 0
        while (not rounds or done < rounds) and not self.open_units(now).where("fault IS NULL").isEmpty():
            told = self.take(max(pages, min(pages << done, MOST)), now)
            done += 1
            total = {"rounds": done, "items": total["items"] + told["items"]}
        left = self.states().agg(F.count_if(~F.col("complete")).alias("open"), F.count_if(F.col("fault").isNotNull()).alias("refused")).first()
        return total | {"open": left["open"], "refused": left["refused"]}

    def records(self, channel: str) -> DataFrame | None:
        return sinks.read_table(self.spark, f"{self.path}/{channel}")


def landed_pages(repo: str, channel: str) -> Fetch:
    """The fetch of pages that were landed before: <repo>/<channel>/page=<n>/ with one JSON item a line, n from 1.

    repo is the address of a folder that all executors reach. Where an endpoint asks for a window, older items are left out.
    """
    from pyarrow import fs

    at, root = fs.FileSystem.from_uri(repo) if "://" in repo or repo.startswith("file:") else (fs.LocalFileSystem(), repo)

    def files_of(page: int) -> list[str]:
        found = at.get_file_info(fs.FileSelector(f"{root}/{channel}/page={page}", allow_not_found=True))
        return sorted(x.path for x in found if x.is_file and not x.base_name.startswith(("_", ".")))

    def fetch(cursor: str | None, params: dict[str, str]) -> tuple[list[dict], str | None]:
        page = int(cursor or 1)
        lines = [x for path in files_of(page) for x in at.open_input_stream(path).read().decode("utf-8").splitlines()]
        items = [x for x in map(json.loads, filter(None, lines)) if (x.get("created_at") or "") >= params.get("since", "")]
        return items, str(page + 1) if files_of(page + 1) else None

    return fetch
