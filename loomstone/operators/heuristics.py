"""Refactorings against static-analysis findings: flattening, weights, ranges of lines, and what changed.

Choices where tests of behaviour leave them open: ranges match if they overlap (both ends inclusive); several smells in
a range count by their sum; a smell that stays and whose score rises is Persistent; the impurity threshold is 20 lines
per operation; density is a ratio; the category of an unknown type is "Unclassified".
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstone.operators.intervals import overlap_join
from loomstone.sources.store import held

UNKNOWN_SCORE, UNKNOWN_CATEGORY, CHURN_PER_OPERATION = 0.1, "Unclassified", 20


class CoverageError(RuntimeError):
    """Too many commits have no counterpart."""


def flatten_refactorings(records: DataFrame) -> DataFrame:
    """One row per refactoring with its first location on either side; a missing side is null and the row stays."""
    r = records.select("repository", F.col("sha1").alias("commit_sha"), F.explode("refactorings").alias("r"))
    left, right = F.get("r.leftSideLocations", F.lit(0)), F.get("r.rightSideLocations", F.lit(0))
    return r.select(
        "repository", "commit_sha", F.col("r.type").alias("refactoring_type"), F.col("r.description").alias("description"),
        left["filePath"].alias("left_side_path"), right["filePath"].alias("right_side_path"), F.coalesce(right["filePath"], left["filePath"]).alias("file_path"),
        left["startLine"].alias("start_line_ref_left"), left["endLine"].alias("end_line_ref_left"), right["startLine"].alias("start_line_ref_right"), right["endLine"].alias("end_line_ref_right"),
    )


def flatten_violations(records: DataFrame) -> DataFrame:
    f = records.select("sha", F.explode("violations").alias("f")).select("sha", F.col("f.filename").alias("file_path"), F.explode("f.violations").alias("v"))
    return f.select("sha", "file_path", F.col("v.rule").alias("rule_name"), F.col("v.beginline").alias("begin_line"), F.col("v.endline").alias("end_line"), F.col("v.description").alias("description"), F.col("v.metric_value").alias("pmd_complexity_score"))


def with_weights(refactorings: DataFrame, rules: DataFrame) -> DataFrame:
    """Adds complexity_score and impact_category from rules (refactoring_type, score, category).

    Rules are a row per type, as seeds hold them, and are broadcast: few types are no key to exchange refactorings by.
    """
    known = rules.select("refactoring_type", F.col("score").alias("__score"), F.col("category").alias("__category"))
    joined = refactorings.join(F.broadcast(known), "refactoring_type", "left")
    return joined.withColumns({"complexity_score": F.coalesce("__score", F.lit(UNKNOWN_SCORE)), "impact_category": F.coalesce("__category", F.lit(UNKNOWN_CATEGORY))}).drop("__score", "__category")


def escalated(refactorings: DataFrame) -> DataFrame:
    """A renamed public method weighs most."""
    public = (F.col("refactoring_type") == "Rename Method") & F.coalesce(F.col("description"), F.lit("")).rlike(r"\bpublic\b")
    return refactorings.withColumns(
        {
            "complexity_score": F.when(public, 1.0).otherwise(F.col("complexity_score")),
            "impact_category": F.when(public, "High_API_Escalated").otherwise(F.col("impact_category")),
            "is_escalated": public,
            "escalation_reason": F.when(public, "public_api_rename"),
        }
    )


def proximity(refactorings: DataFrame, violations: DataFrame, lineage: DataFrame) -> DataFrame:
    """Each refactoring with smells in its lines before and after, and what became of them.

    Before is the first parent with the left path, after the commit with the right path, so renames are followed. Ranges
    meet by bins of lines, see intervals. The numbered rows are written once, so that all who join them see one numbering.
    """
    rows = held(refactorings.withColumn("__row", F.monotonically_increasing_id()), "refactorings")
    parents = lineage.select(F.col("sha").alias("commit_sha"), F.get("parent_shas", F.lit(0)).alias("__parent"))
    rows = rows.join(parents, "commit_sha", "left")

    def side(sha: str, path: str, begin: str, end: str, name: str) -> DataFrame:
        own = rows.select("__row", F.col(sha).alias("__sha"), F.col(path).alias("__path"), F.col(begin).alias("__a"), F.col(end).alias("__b"))
        v = violations.select(F.col("sha").alias("__vsha"), F.col("file_path").alias("__vpath"), F.col("begin_line").alias("__c"), F.col("end_line").alias("__d"), F.col("pmd_complexity_score").alias("__s"))
        hit = overlap_join(own, v, [("__sha", "__vsha"), ("__path", "__vpath")], ("__a", "__b"), ("__c", "__d"))
        return hit.groupBy("__row").agg(F.lit(True).alias(f"{name}_smell"), F.coalesce(F.sum("__s"), F.lit(0.0)).alias(f"{name}_score"))

    both = rows.join(side("__parent", "left_side_path", "start_line_ref_left", "end_line_ref_left", "left"), "__row", "left").join(side("commit_sha", "right_side_path", "start_line_ref_right", "end_line_ref_right", "right"), "__row", "left")
    both = both.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("left_smell", "right_smell")})
    both = both.withColumns({"previous_pmd_score": F.coalesce("left_score", F.lit(0.0)), "current_pmd_score": F.coalesce("right_score", F.lit(0.0))}).drop("left_score", "right_score")
    return both.withColumns({"causality_type": causality(), "score_AST_Proximity": (F.col("left_smell") | F.col("right_smell")).cast("double")}).drop("__row", "__parent")


def causality() -> Column:
    left, right = F.col("left_smell"), F.col("right_smell")
    return F.when(left & ~right, "Fixed").when(~left & right, "Introduction").when(left & right & (F.col("current_pmd_score") < F.col("previous_pmd_score")), "Ameliorated").when(left & right, "Persistent").otherwise("None")


def coverage_gap(refactorings: DataFrame, violations: DataFrame, threshold: float = 0.5) -> float:
    """The share of refactored commits without violations rows; over the threshold it is an error, from there down a warning."""
    if not 0 <= threshold <= 1:
        raise ValueError("the threshold is a share between 0 and 1")
    total, missing = gap_counts(refactorings, violations).first()
    gap = missing / total if total else 0.0
    if gap > threshold:
        raise CoverageError(f"CRITICAL: {gap:.1%} of refactored commits have no findings")
    if gap:
        warnings.warn(f"Data Mismatch Detected: {gap:.1%} of refactored commits have no findings", stacklevel=2)
    return gap


def gap_counts(refactorings: DataFrame, violations: DataFrame) -> DataFrame:
    """One row: refactored commits, and those without violations."""
    known = violations.select(F.col("sha").alias("sha1")).distinct().withColumn("known", F.lit(True))
    return refactorings.select("sha1").distinct().join(known, "sha1", "left").agg(F.count("*").alias("total"), F.count_if(F.col("known").isNull()).alias("missing"))


def hotspots(scores: DataFrame, n: int, score: str = "score", tie: str = "file") -> DataFrame:
    return scores.orderBy(F.desc(score), tie).limit(n)


def metric_value(description: Column, pattern: str = r"(?:complexity|metric value|length) of (\d+(?:\.\d+)?)") -> Column:
    """The number that a finding's description states, null if none."""
    return F.regexp_extract(description, pattern, 1).try_cast("double")


def average_complexity(findings: DataFrame, description: str = "description") -> DataFrame:
    return findings.agg(F.coalesce(F.avg(metric_value(F.col(description))), F.lit(0.0)).alias("average_complexity"))


def density(part: Column, total: Column) -> Column:
    return F.coalesce(F.try_divide(part, total), F.lit(0.0))


def is_impure(operations: Column, churn: Column) -> Column:
    return churn > operations * CHURN_PER_OPERATION


def purity_score(commits: DataFrame) -> DataFrame:
    """Percent of commits (operations, churn) that are pure; 0 of none."""
    return commits.agg(F.coalesce(F.avg(F.when(is_impure(F.col("operations"), F.col("churn")), 0.0).otherwise(100.0)), F.lit(0.0)).alias("purity_score"))
