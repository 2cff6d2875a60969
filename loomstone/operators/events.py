"""What a run saw: counts taken while tables are written, and a table of the events of all runs."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: One row per event: a stage's name and outcome, or a count that it took.
EVENTS = "run string, repo string, stage string, event string, value bigint, note string, at timestamp"


@dataclass
class Observed:
    """Counts that come with the writing of tables, so that nothing is computed twice for them.

    A stage that Spark runs again, as after the loss of an executor, may count its rows again; rows themselves are exact.
    """

    seen: list[Observation] = field(default_factory=list)

    def watch(self, df: DataFrame, **counts: Column) -> DataFrame:
        """df, whose rows are counted when it is next written; counts of one name add up."""
        one = Observation(f"seen-{uuid.uuid4().hex}")
        self.seen.append(one)
        return df.observe(one, *[c.cast("bigint").alias(name) for name, c in counts.items()])

    def values(self) -> dict[str, int]:
        """The counts, after all that is watched has been written."""
        found: dict[str, int] = {}
        for one in self.seen:
            for name, n in one.get.items():
                found[name] = found.get(name, 0) + (n or 0)
        return found


def event_rows(spark: SparkSession, run: str, repo: str, stage: str, counts: dict[str, int], note: str = "") -> DataFrame:
    """Rows of EVENTS for the counts of one stage's run."""
    rows = [(run, repo, stage, name, int(n), note) for name, n in counts.items()]
    return spark.createDataFrame(rows, "run string, repo string, stage string, event string, value bigint, note string").withColumn("at", F.current_timestamp())


def last_counts(events: DataFrame) -> DataFrame:
    """(repo, stage, event, value): what the last run of each stage counted."""
    return events.groupBy("repo", "stage", "event").agg(F.max_by("value", "at").alias("value"))
