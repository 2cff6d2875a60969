"""Refactorings through an ordered chain of strategies into one derived table.

A strategy takes the rows so far and the evidence (landed tables and seeds) and gives the next rows. Before any runs, commits
without findings are held against a threshold; what comes out replaces the table as one step and is counted on the way.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstone.operators import heuristics
from loomstone.operators.events import Observed
from loomstone.plans.stages import chained
from loomstone.sources import sinks

RULES = "refactoring_type string, score double, category string"


@dataclass(frozen=True)
class Evidence:
    """What strategies may look at: landed refactorings and findings, the lineage, and the seeds."""

    refactorings: DataFrame
    violations: DataFrame
    lineage: DataFrame
    seeds: dict

    @property
    def rules(self) -> DataFrame:
        """The seeds' weights of refactorings: {"complexity_rules": {type: [score, category]}}; a list, as short as the seeds are."""
        rows = [(kind, float(score), category) for kind, (score, category) in (self.seeds.get("complexity_rules") or {}).items()]
        return self.refactorings.sparkSession.createDataFrame(rows, RULES)


Strategy = Callable[[DataFrame, Evidence], DataFrame]
#: Known strategies by name; None is declared and not there yet.
STRATEGIES: dict[str, Strategy | None] = {
    "weights": lambda rows, e: heuristics.with_weights(rows, e.rules),
    "escalation": lambda rows, e: heuristics.escalated(rows),
    "proximity": lambda rows, e: heuristics.proximity(rows, heuristics.flatten_violations(e.violations), e.lineage),
    "ownership": None,
}


def seeds_of(text: str) -> dict:
    """Seeds as JSON; ValueError tells what is wrong with them."""
    try:
        found = json.loads(text)
    except ValueError as e:
        raise ValueError(f"the seeds are not valid JSON: {e}") from e
    rules = found.get("complexity_rules", {}) if isinstance(found, dict) else None
    if not isinstance(rules, dict) or not all(isinstance(v, list) and len(v) == 2 for v in rules.values()):
        raise ValueError("the seeds hold no complexity_rules of [score, category]")
    return found


def analyse(evidence: Evidence, names: Iterable[str], path: str, threshold: float = 0.5, warn: Callable[[str], None] = print, strategies: dict[str, Strategy | None] | None = None) -> dict[str, int]:
    """Runs the named strategies in order and replaces the table at the path; how many rows it holds.

    Unknown and missing strategies are told and left out; none at all, and no rows, are errors that leave the table as it was.
    """
    known = STRATEGIES if strategies is None else strategies
    bound = {name: None if f is None else partial(_applied, name, f, evidence) for name, f in known.items()}
    chain = chained(bound, names, warn)
    heuristics.coverage_gap(evidence.refactorings, evidence.violations, threshold)
    rows = chain(heuristics.flatten_refactorings(evidence.refactorings))
    if rows.isEmpty():
        raise RuntimeError("the strategies left no rows")
    seen = Observed()
    sinks.refresh(seen.watch(rows, rows=F.count("*")), path)
    return seen.values()


def _applied(name: str, strategy: Strategy, evidence: Evidence, rows: DataFrame) -> DataFrame:
    found = strategy(rows, evidence)
    if found is None:
        raise RuntimeError(f"strategy {name} gave no table")
    return found


def result(spark: SparkSession, path: str) -> DataFrame | None:
    return sinks.read_table(spark, path)
