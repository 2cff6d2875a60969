"""Chains of strategies over landed evidence, into a table that changes as one step or not at all."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from loomstone import schemas
from loomstone.operators import heuristics
from loomstone.plans import analysis


@pytest.fixture
def evidence(spark):
    at = lambda path, a, b: [(path, a, b)]
    refactorings = spark.createDataFrame([("r", "c2", 1, [("Rename Method", "public m", at("Old.java", 10, 20), at("New.java", 10, 20)), ("Extract Method", "x", at("Old.java", 90, 95), [])])], schemas.REFACTORINGS)
    violations = spark.createDataFrame([("c1", "success", [("Old.java", [("R", 1, 12, 13, "d", 20.0)])]), ("c2", "success", [("New.java", [])])], schemas.VIOLATIONS)
    lineage = spark.createDataFrame([("c2", ["c1"])], "sha string, parent_shas array<string>")
    return analysis.Evidence(refactorings, violations, lineage, analysis.seeds_of('{"complexity_rules": {"Extract Method": [0.5, "Medium"]}}'))


def test_strategies_in_order(spark, tmp_path, evidence):
    said, path = [], str(tmp_path / "t")
    told = analysis.analyse(evidence, ["weights", "escalation", "ownership", "none", "proximity"], path, warn=said.append)
    assert told == {"rows": 2} and said == ["no strategy ownership", "no strategy none"]
    found = {r["refactoring_type"]: (r["complexity_score"], r["impact_category"], r["causality_type"], r["score_AST_Proximity"]) for r in analysis.result(spark, path).collect()}
    assert found == {"Rename Method": (1.0, "High_API_Escalated", "Fixed", 1.0), "Extract Method": (0.5, "Medium", "None", 0.0)}
    # the seeds reach whoever asks, and the order is that of the names
    strategies = {"a": lambda rows, e: rows.withColumn("a", F.lit(len(e.seeds["complexity_rules"]))), "b": lambda rows, e: rows.withColumn("b", F.col("a") + 1)}
    analysis.analyse(evidence, ["a", "b"], path, strategies=strategies)
    assert {tuple(r) for r in analysis.result(spark, path).select("a", "b").collect()} == {(1, 2)}


def test_what_goes_wrong_leaves_the_table(spark, tmp_path, evidence):
    path = str(tmp_path / "t")
    analysis.analyse(evidence, ["weights"], path)
    before = analysis.result(spark, path).collect()
    with pytest.raises(ValueError, match="no strategy"):
        analysis.analyse(evidence, [], path)
    with pytest.raises(RuntimeError, match="gave no table"):
        analysis.analyse(evidence, ["x"], path, strategies={"x": lambda rows, e: None})
    with pytest.raises(RuntimeError, match="no rows"):
        analysis.analyse(evidence, ["x"], path, strategies={"x": lambda rows, e: rows.limit(0)})
    with pytest.raises(ValueError, match="between 0 and 1"):
        analysis.analyse(evidence, ["weights"], path, threshold=1.5)
    none = analysis.Evidence(evidence.refactorings, evidence.violations.limit(0), evidence.lineage, {})
    with pytest.raises(heuristics.CoverageError):
        analysis.analyse(none, ["weights"], path)
    assert sorted(map(str, analysis.result(spark, path).collect())) == sorted(map(str, before))


@pytest.mark.parametrize("text", ["{", "[]", '{"complexity_rules": {"a": 1}}'])
def test_seeds(text):
    with pytest.raises(ValueError, match="seeds"):
        analysis.seeds_of(text)
