"""Generations and reachability against walks in plain Python, and how many rounds they take."""

from __future__ import annotations

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from loomstone.operators import history, universe

SCHEMA = "sha string, parent_shas array<string>"


def depth_by_hand(commits):
    known, depth = dict(commits), {}
    for sha in known:
        stack = [sha]
        while stack:
            c = stack[-1]
            todo = [p for p in known[c] or () if p in known and p not in depth]
            if todo:
                stack += todo
            else:
                depth[c] = max([1 + depth[p] for p in known[c] or () if p in known], default=0)
                stack.pop()
    return depth


def reached_by_hand(commits, heads):
    known, seen = dict(commits), set()
    todo = [h for h in heads if h in known]
    while todo:
        c = todo.pop()
        if c not in seen:
            seen.add(c)
            todo += [p for p in known[c] or () if p in known]
    return seen


def random_history(rng, n, far):
    return [(f"c{k}", [f"c{k - 1 - rng.randrange(min(k, far))}" for _ in range(rng.choice([1, 1, 1, 2, 3]))] if k and rng.random() > 0.03 else rng.choice([[], None, ["gone"]])) for k in range(n)]


@pytest.mark.parametrize(("seed", "far"), [(2, 30), (3, 120)])
def test_random_histories(spark, seed, far):
    rng = random.Random(seed)
    commits = random_history(rng, 120, far)
    df = spark.createDataFrame(commits, SCHEMA)
    patience = {"patience": 5} if seed == 2 else {}
    found = {r["sha"]: r["generation"] for r in history.generations(df, **patience).collect()}
    assert found == depth_by_hand(commits)
    heads = [f"c{rng.randrange(120)}" for _ in range(3)] + ["none", None]
    got = history.ancestors(df, spark.createDataFrame([(h,) for h in heads], "sha string"), **patience).collect()
    assert {r[0] for r in got} == reached_by_hand(commits, heads) and len(got) == len({r[0] for r in got})


def test_a_long_chain_takes_few_rounds(spark):
    n = 100_000
    chain = spark.range(n).selectExpr("concat('c', id) AS sha", "CASE WHEN id = 0 THEN array() ELSE array(concat('c', id - 1)) END AS parent_shas")
    rounds = history.Rounds()
    found = history.generations(chain, rounds=rounds)
    assert found.where("generation = cast(substr(sha, 2) AS bigint)").count() == n and rounds.count <= math.log2(n) + 3
    short = chain.where("cast(substr(sha, 2) AS bigint) < 3000")
    got = history.ancestors(short, spark.createDataFrame([("c1500",)], "sha string"), rounds=rounds)
    assert got.count() == 1501 and rounds.count <= math.log2(3000) + 3


def test_branches_that_part_and_meet_take_few_rounds(spark):
    """Every ninth commit merges a branch that left seven before it, and every fiftieth one that overlaps the last merge."""
    n = 1200
    rows = [(f"c{k}", [f"c{k - 1}"] * (k > 0) + [f"c{k - 7}"] * (k % 9 == 8) + [f"c{k - 12}"] * (k % 50 == 49)) for k in range(n)]
    rounds = history.Rounds()
    found = history.generations(spark.createDataFrame(rows, SCHEMA), rounds=rounds)
    assert {r["sha"]: r["generation"] for r in found.collect()} == {f"c{k}": k for k in range(n)} and rounds.count <= 25
    heads = spark.createDataFrame([(f"c{n - 1}",)], "sha string")
    assert history.ancestors(spark.createDataFrame(rows, SCHEMA), heads, rounds=rounds).count() == n and rounds.count <= 25


@pytest.mark.parametrize("dead", [0, 40])
def test_what_a_long_ladder_reaches_takes_few_rounds(spark, dead):
    """Merges that cross all along the main line, and branches that nobody merged, which a way may end in."""
    n = 700
    rows = [(f"c{k:04d}", [f"c{p:04d}" for p in (k - 1, k - 4 * (k % 2 == 0), k - 7 * (k % 3 == 0), k - 11 * (k % 5 == 0)) if 0 <= p < k]) for k in range(n)]
    rows += [(f"d{k}", [f"c{(k * 17) % n:04d}"]) for k in range(dead)]  # tips that sort after all others
    rounds = history.Rounds()
    got = history.ancestors(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(f"c{n - 1:04d}",)], "sha string"), rounds=rounds)
    assert {r[0] for r in got.collect()} == {f"c{k:04d}" for k in range(n)} and rounds.count <= 20


def test_groups_and_odd_rows(spark):
    rows = [("r", "a", []), ("r", "b", ["a", "a", None]), ("r", "b", ["a"]), ("r", None, ["a"]), ("q", "a", ["b"]), ("q", "z", ["a"]), (None, "a", ["a2"])]
    df = spark.createDataFrame(rows, f"repo string, {SCHEMA}")
    assert sorted((r["repo"] or "", r["sha"], r["generation"]) for r in history.generations(df, "repo").collect()) == [("", "a", 0), ("q", "a", 0), ("q", "z", 1), ("r", "a", 0), ("r", "b", 1)]
    heads = spark.createDataFrame([("r", "a"), ("q", "z"), ("q", "b")], "repo string, sha string")
    assert {tuple(r) for r in universe.ancestors(df, heads, "repo").collect()} == {("r", "a"), ("q", "z"), ("q", "a")}
    assert {tuple(r) for r in history.ancestors(df, heads, "repo", patience=1).collect()} == {("r", "a"), ("q", "z"), ("q", "a")}
    none = spark.createDataFrame([], SCHEMA)
    assert history.generations(none).count() == 0 and history.ancestors(none, heads).count() == 0


@pytest.mark.parametrize("rows", [[("a", ["b"]), ("b", ["a"])], [("a", ["a"])], [("r", []), ("a", ["b", "c", "r"]), ("b", ["c", "a"]), ("c", ["a", "b"])]])
def test_cycles_are_told(spark, rows):
    with pytest.raises(ValueError, match="cycle"):
        history.generations(spark.createDataFrame(rows, SCHEMA)).collect()


def test_orders(spark):
    df = spark.createDataFrame([("b", ["a"], 0), ("a", [], 1), ("c", ["b"], 2)], f"{SCHEMA}, pos int")
    assert [tuple(r) for r in history.out_of_order(df).collect()] == [("b", "a")]
    deep = history.generations(df).orderBy("generation", "sha")
    assert [r["sha"] for r in deep.collect()] == ["a", "b", "c"] and deep.select(F.max("generation")).first()[0] == 2


def test_own_values_do_not_meet_in_one_task(spark, monkeypatch):
    """A join by source takes rows that have one: all others would come to one of its tasks, a row for each commit."""
    plans, held = [], history.held

    def seen(df, label):
        if label == "history":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString().split("\n"))
        return held(df, label)

    monkeypatch.setattr(history, "held", seen)
    commits = [(f"c{k}", [f"c{k // 2}"] + ([f"c{k - 1}"] if k % 7 == 0 else []) if k else []) for k in range(16)]
    found = history.generations(spark.createDataFrame(commits, SCHEMA))
    assert {r["sha"]: r["generation"] for r in found.collect()} == depth_by_hand(commits)
    above = [plan[k - 1] for plan in plans for k, line in enumerate(plan) if re.search(r"Relation \[id#\d+,source#\d+,w#\d+L\]", line)]
    assert above and all("isnotnull(source#" in x for x in above)
