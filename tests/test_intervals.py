"""Overlap joins by bins against brute force, and how much they look at under one hot key."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomstone.operators import intervals

LEFT, RIGHT = "i long, k string, a int, b int", "j long, g string, c int, d int"


@pytest.mark.parametrize("seed", range(3))
def test_pairs_are_those_of_brute_force(spark, seed):
    rng = random.Random(seed)

    def ranges(n):
        rows = []
        for i in range(n):
            a = rng.choice([rng.randrange(-50, 200), rng.randrange(40_000), 31, 32, 255, 256, None])
            b = None if rng.random() < 0.05 or a is None else a + rng.choice([0, 1, 31, 32, 33, 255, 256, 2047, 20_000, 200_000, -3])
            rows.append((i, rng.choice(["x", "y", None]), a, b))
        return rows

    left, right = ranges(120), ranges(150)
    want = sorted((i, j) for i, k, a, b in left for j, g, c, d in right if None not in (k, g, a, b, c, d) and k == g and a <= d and c <= b)
    found = intervals.overlap_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), [("k", "g")], ("a", "b"), ("c", "d"))
    assert sorted((r["i"], r["j"]) for r in found.collect()) == want and found.columns == ["i", "k", "a", "b", "j", "g", "c", "d"]


def test_a_file_with_very_many_findings(spark):
    """One key, 100,000 ranges on either side: what is looked at stays near what is found, and no task holds most of it."""
    n = 100_000
    left = spark.range(n, numPartitions=8).selectExpr("id AS i", "'x' AS k", "cast(id * 7 AS int) AS a", "cast(id * 7 + id % 40 AS int) AS b")
    right = spark.range(n, numPartitions=8).selectExpr("id AS j", "'x' AS g", "cast(id * 5 AS int) AS c", "cast(id * 5 + id % 20 + CASE WHEN id % 10000 = 0 THEN 3000 ELSE 0 END AS int) AS d")
    near = intervals.candidates(left, right, [("k", "g")], ("a", "b"), ("c", "d"))
    looked = near.count()
    i, j = np.arange(n), np.arange(n)
    start, end = np.sort(5 * j), np.sort(5 * j + j % 20 + np.where(j % 10000 == 0, 3000, 0))
    true = int((np.searchsorted(start, 7 * i + i % 40, side="right") - np.searchsorted(end, 7 * i, side="left")).sum())
    assert intervals.overlap_join(left, right, [("k", "g")], ("a", "b"), ("c", "d")).count() == true
    assert looked < 4 * true < n * n / 1000
    bins = left.select(F.explode(intervals._listed(F.col("a"), F.col("b"), ("same", "lower"), "higher")).alias("x")).where("x.meets <> 'higher'").groupBy("x.level", "x.bin", "x.meets").count()
    assert bins.agg(F.max("count")).first()[0] < 100


def test_keys_of_few_ranges_are_not_listed(spark):
    """Many keys of four ranges beside one of very many: the former are joined plainly, the latter by its bins, and all pairs are there."""
    few = spark.range(4000).selectExpr("id AS i", "concat('k', id div 4) AS k", "cast(id % 7 AS int) AS a", "cast(id % 7 + id % 3 AS int) AS b")
    hot = spark.range(2000).selectExpr("id + 4000 AS i", "'hot' AS k", "cast(id * 9 AS int) AS a", "cast(id * 9 + id % 20 AS int) AS b")
    for left, listed in ((few, False), (few.unionByName(hot), True)):
        right = left.toDF("j", "g", "c", "d")
        found = intervals.overlap_join(left, right, [("k", "g")], ("a", "b"), ("c", "d"))
        plain = left.join(right, (F.col("k") == F.col("g")) & (F.col("a") <= F.col("d")) & (F.col("c") <= F.col("b")))
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.collect())) and found.groupBy(left["k"]).count().count() > 900
        assert [r[0] for r in intervals.many_ranged(left, right, [("k", "g")]).collect()] == ["hot"] * listed
        assert ("Generate" in found._jdf.queryExecution().optimizedPlan().toString()) == listed


def test_listings_are_bounded(spark):
    rows = spark.range(20).selectExpr("cast(pow(2, id) AS int) AS a", "cast(pow(2, id) + pow(3, id) AS bigint) AS b")
    listed = rows.select(F.size(intervals._listed(F.col("a"), F.col("b"), ("same", "lower"), "higher")).alias("n"))
    assert listed.agg(F.max("n")).first()[0] <= 2 * 2 + 2 * (intervals.LEVELS - 1)


def test_empty_sides(spark):
    left, right = spark.createDataFrame([], LEFT), spark.createDataFrame([(1, "x", 1, 2)], RIGHT)
    assert intervals.overlap_join(left, right, [("k", "g")], ("a", "b"), ("c", "d")).count() == 0
