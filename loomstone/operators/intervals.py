"""Joins of ranges that overlap, over bins of lines.

Bins are of LEVELS widths, each STEP times the one before; the last level is one bin for all. A range has the least level
whose width holds it, so it lies in at most two bins there. Two ranges meet at the higher of their two levels: each range is
listed at its own level for ranges of the same and of lower ones, and at every higher level only for ranges that have it as
their own. In the two or fewer bins that a pair shares at that level it counts in the first. So ranges meet whose places are
near, whatever the number of rows under one key; a range is listed a bounded number of times; and a pair comes out once.

A key with a third of all rows is dealt by its bins; a bin that is still large is many ranges at one place, where the pairs
are the result, and adaptive execution splits it.

Bins are for keys of many ranges alone: where a plain join of a key would try no more than FEW pairs for each of its rows,
which is what listing it would cost, it is joined plainly. Keys beyond that are counted first and written to the shared folder.

Edge cases: ends are inclusive; rows with a null key or end overlap nothing; a range whose end lies before its start overlaps
what holds both, as overlaps() says; repeated rows give repeated pairs; empty sides give an empty result.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstone.sources.store import held

WIDTH, STEP, LEVELS, FEW = 32, 8, 5, 16
_TOP = LEVELS - 1


def overlaps(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Whether a..b and c..d have a place in common, both ends included."""
    return (a <= d) & (c <= b)


def _listed(start: Column, end: Column, own: tuple[str, str], above: str) -> Column:
    """array<struct<level, bin, meets, first>>: where a range is listed, for which meetings, and its first bin there.

    At the lowest level a range meets only those of the same, as none is lower.
    """
    low, high = F.least(start, end).cast("bigint"), F.greatest(start, end).cast("bigint")
    level = F.lit(_TOP)
    for k in reversed(range(_TOP)):
        level = F.when(high - low < WIDTH * STEP**k, k).otherwise(level)

    def at(place: Column, m: Column) -> Column:
        return F.when(m == _TOP, F.lit(0).cast("bigint")).otherwise(F.floor(place / (WIDTH * F.pow(F.lit(STEP), m))))

    def of_level(m: Column) -> Column:
        first = at(low, m)
        meets = F.when(m > level, F.array(F.lit(above))).when(m == 0, F.array(F.lit(own[0]))).otherwise(F.array(*map(F.lit, own)))
        listed = F.transform(F.sequence(first, at(high, m)), lambda b: F.transform(meets, lambda t: F.struct(m.alias("level"), b.alias("bin"), t.alias("meets"), first.alias("first"))))
        return F.flatten(listed)

    return F.flatten(F.transform(F.sequence(level, F.lit(_TOP)), of_level))


def candidates(left: DataFrame, right: DataFrame, keys: list[tuple[str, str]], left_range: tuple[str, str], right_range: tuple[str, str]) -> DataFrame:
    """Pairs of rows with equal keys that share a bin, each pair once; __l and __r say where."""
    a, b, c, d = (side[x] for side, ends in ((left, left_range), (right, right_range)) for x in ends)
    known = lambda side, columns: side.where(F.concat(*[F.lit("")] + [F.when(side[x].isNotNull(), F.lit("")) for x in columns]).isNotNull())
    mine = known(left, [*(k for k, _ in keys), *left_range]).select("*", F.explode(_listed(a, b, ("same", "lower"), "higher")).alias("__l"))
    theirs = known(right, [*(k for _, k in keys), *right_range]).select("*", F.explode(_listed(c, d, ("same", "higher"), "lower")).alias("__r"))
    condition = (F.col("__l.level") == F.col("__r.level")) & (F.col("__l.bin") == F.col("__r.bin")) & (F.col("__l.meets") == F.col("__r.meets"))
    for k, other in keys:
        condition = condition & (left[k] == right[other])
    return mine.join(theirs, condition & (F.col("__l.bin") == F.greatest("__l.first", "__r.first")))


def many_ranged(left: DataFrame, right: DataFrame, keys: list[tuple[str, str]]) -> DataFrame:
    """Keys, as __key0 and on, under which a plain join would try more than FEW pairs a row."""
    names = [f"__key{i}" for i in range(len(keys))]
    mine = left.groupBy(*[F.col(k).alias(n) for (k, _), n in zip(keys, names, strict=True)]).agg(F.count("*").alias("__mine"))
    theirs = right.groupBy(*[F.col(k).alias(n) for (_, k), n in zip(keys, names, strict=True)]).agg(F.count("*").alias("__theirs"))
    many = F.col("__mine").cast("double") * F.col("__theirs") > FEW * (F.col("__mine") + F.col("__theirs"))
    return mine.where(f"__mine > {FEW}").join(theirs.where(f"__theirs > {FEW}"), names).where(many).select(*names)


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str | tuple[str, str]], left_range: tuple[str, str], right_range: tuple[str, str]) -> DataFrame:
    """All columns of both sides for each pair of rows with equal keys and overlapping ranges."""
    named = [(k, k) if isinstance(k, str) else k for k in keys]
    both = [*[left[c] for c in left.columns], *[right[c] for c in right.columns]]
    true = overlaps(left[left_range[0]], left[left_range[1]], right[right_range[0]], right[right_range[1]])
    equal = lambda one, other: reduce(and_, [a == b for a, b in zip(one, other, strict=True)])
    mine, theirs = [left[k] for k, _ in named], [right[k] for _, k in named]
    hot = held(many_ranged(left, right, named), "many-ranged")
    if hot.isEmpty():
        return left.join(right, equal(mine, theirs) & true).select(*both)
    hots = [hot[c] for c in hot.columns]
    plain = left.join(hot, equal(mine, hots), "left_anti").join(right, equal(mine, theirs) & true).select(*both)
    near = candidates(left.join(hot, equal(mine, hots), "left_semi"), right.join(hot, equal(theirs, hots), "left_semi"), named, left_range, right_range)
    return plain.union(near.where(true).select(*both))
