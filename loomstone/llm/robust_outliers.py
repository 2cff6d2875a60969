"""Quality rules: robust multivariate outliers by minimum-covariance-determinant estimates, in DataFrame functions only.

Every text gives counts (words, characters in words, symbols, repeated lines, words in repeated three-word windows). Hard
limits fail some texts outright. The others become vectors of transformed statistics. For each language and source the
location and scatter of the h = COVERAGE share of vectors with the smallest determinant are approached from the
coordinatewise medians and deviations by concentration steps: distances under the present estimate, the h share with the
smallest, its mean and covariance. A group goes on as long as a step lowers its log determinant by more than TOLERANCE, and
ends with the lower of its last two estimates; all groups must have ended after STEPS steps, or the run fails. The start is
robust, so one start is enough for what is far from the bulk. A vector is rejected if its squared Mahalanobis distance under
the final estimate, scaled to be consistent for normal vectors, is over the chi-squared quantile of 1 - TAIL.

Each step is two sums per group that are pre-aggregated before their shuffle: a histogram of the distances, from which
the h-th smallest follows on a grid of GRID steps per doubling, and the moments. The grid is fine, as on a coarse one (32 and
256 were tried) groups swing between two subsets and never settle to TOLERANCE. A source that holds a third of all rows is
tens of thousands of partial sums at most. Texts are read once; the steps run over the stored vectors of groups that have not
ended. Groups under LEAST documents
are judged by the estimate of their language over all sources, made in the same steps.

Edge cases: null counts as empty and fails the base; null languages and sources are groups; equal vectors, whose scatter
is singular, are held apart from zero by least standard deviations; rows repeat freely; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomstone.llm.common import checked, docs_of, staged

#: Share of vectors that an estimate rests on, steps per doubling of the histograms, least group.
COVERAGE, GRID, LEAST = 0.75, 2048, 60
#: Fall of a log determinant up to which a group has ended, and steps after which it must have.
TOLERANCE, STEPS = 1e-3, 60
#: Share of normal vectors that are taken for outliers.
TAIL = 1e-6

_SPACE = r"[\\x20\\x09-\\x0D]"
#: The coordinates: name, SQL over the counts, and the least standard deviation that an estimate may have in it.
COORDINATES = (
    ("length", "ln(1 + n_words)", 0.25),
    ("word_size", "word_chars / greatest(n_words, 1)", 0.25),
    ("symbols", "ln(1 + 100 * n_symbols / greatest(word_chars, 1))", 0.15),
    ("repeats", "sqrt(n_repeat_words / greatest(n_words, 1))", 0.1),
    ("lines", "ln(1 + n_dup_lines)", 0.25),
)
DIMS = [c for c, _, _ in COORDINATES]


def chi2_cdf(x: float, k: int) -> float:
    """Of chi-squared with k degrees of freedom, by the series of the lower incomplete gamma function."""
    a, z = k / 2, x / 2
    term = total = 1 / a
    n = 0
    while term > 1e-16 * total:
        n += 1
        term *= z / (a + n)
        total += term
    return total * math.exp(a * math.log(z) - z - math.lgamma(a))


def chi2_quantile(p: float, k: int) -> float:
    low, high = 1e-9, 1e3
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_cdf(middle, k) < p else (low, middle)
    return low


def consistency(k: int = len(COORDINATES), share: float = COVERAGE) -> float:
    """What the covariance of the innermost share of a normal sample is short of."""
    return share / chi2_cdf(chi2_quantile(share, k), k + 2)


def cutoff(tail: float = TAIL) -> float:
    """Squared distance from which a vector is an outlier."""
    return chi2_quantile(1 - tail, len(COORDINATES))


def counts(docs: DataFrame) -> DataFrame:
    """The base counts of each whole text, and its language and source."""
    plain = docs.selectExpr("cast(doc_id AS long) AS doc_id", "coalesce(cast(lang AS string), '') AS lang", "coalesce(cast(source AS string), '') AS source", "coalesce(cast(text AS string), '') AS text")
    parts = plain.selectExpr("doc_id", "lang", "source", "text", f"filter(split(text, '{_SPACE}+'), w -> w != '') AS words", f"filter(split(text, '\\n', -1), l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]') AS lines")
    # windows as (hash, place) in order, so that equal ones lie side by side
    windows = "sort_array(transform(slice(arrays_zip(words, slice(words, 2, greatest(size(words) - 1, 0)), slice(words, 3, greatest(size(words) - 2, 0))), 1, greatest(size(words) - 2, 0)), (w, i) -> struct(xxhash64(w.words, w.`1`, w.`2`) AS h, i AS i)))"
    sized = parts.selectExpr(
        "doc_id", "lang", "source", "cast(size(words) AS long) AS n_words", "cast(length(array_join(words, '')) AS long) AS word_chars",
        "cast(length(regexp_replace(text, '[^#*$%&|<>]+', '')) AS long) AS n_symbols", "cast(size(lines) - size(array_distinct(lines)) AS long) AS n_dup_lines", f"{windows} AS windows",
    )
    same = sized.selectExpr(
        "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "zip_with(windows, concat(slice(windows, 2, greatest(size(windows) - 1, 0)), array(named_struct('h', cast(NULL AS bigint), 'i', cast(NULL AS int)))), (x, y) -> if(x.h = y.h, array(x.i, y.i), NULL)) AS twins",
    )
    places = same.withColumn("places", F.expr("sort_array(array_distinct(flatten(filter(twins, t -> t IS NOT NULL))))")).drop("twins")
    covered = "aggregate(zip_with(places, slice(places, 2, greatest(size(places) - 1, 0)), (x, y) -> coalesce(least(3, y - x), 3)), 0L, (s, x) -> s + x)"
    full = places.withColumn("n_repeat_words", F.expr(covered)).drop("places")
    return full.withColumn("base_failed", F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words"))


def _share_point(values: DataFrame, value: Column, share: float, name: str, *by: str) -> DataFrame:
    """For each group the least value at or under which `share` of its values lie, from a histogram of whole numbers."""
    bins = values.groupBy(*by, value.alias("bin")).agg(F.count("*").alias("n"))
    group = Window.partitionBy(*by)
    upto = bins.withColumn("upto", F.sum("n").over(group.orderBy("bin"))).withColumn("all", F.sum("n").over(group))
    return upto.where(F.col("upto") >= share * F.col("all")).groupBy(*by).agg(F.min("bin").alias(name))


def _factor(scatter: DataFrame) -> DataFrame:
    """Adds the entries l_i_j of the Cholesky factor of the covariance c_i_j, a column at a time."""
    p = len(DIMS)
    for j in range(p):
        inner = sum((F.col(f"l_{j}_{k}") ** 2 for k in range(j)), F.lit(0.0))
        scatter = scatter.withColumn(f"l_{j}_{j}", F.sqrt(F.greatest(F.col(f"c_{j}_{j}") - inner, F.lit(1e-12))))
        for i in range(j + 1, p):
            inner = sum((F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}") for k in range(j)), F.lit(0.0))
            scatter = scatter.withColumn(f"l_{i}_{j}", (F.col(f"c_{i}_{j}") - inner) / F.col(f"l_{j}_{j}"))
    return scatter.select("lang", "grp", "size", *[f"m_{i}" for i in range(p)], *[f"l_{i}_{j}" for i in range(p) for j in range(i + 1)])


def _with_distance(vectors: DataFrame, estimate: DataFrame) -> DataFrame:
    """Adds the squared Mahalanobis distance d2 under the estimate of the row's group, by forward substitution."""
    joined, p = vectors.join(checked(estimate), ["lang", "grp"]), len(DIMS)
    for i in range(p):
        inner = sum((F.col(f"l_{i}_{k}") * F.col(f"z_{k}") for k in range(i)), F.lit(0.0))
        joined = joined.withColumn(f"z_{i}", (F.col(DIMS[i]) - F.col(f"m_{i}") - inner) / F.col(f"l_{i}_{i}"))
    d2 = sum((F.col(f"z_{i}") ** 2 for i in range(1, p)), F.col("z_0") ** 2)
    return joined.withColumn("d2", d2)


def estimates(vectors: DataFrame) -> DataFrame:
    """(lang, grp, size, m_i, l_i_j): location and Cholesky factor of the scatter of each group of the vectors."""
    p = len(DIMS)
    long = vectors.select("lang", "grp", F.posexplode(F.array(*DIMS)).alias("dim", "x"))
    medians = staged(_share_point(long, F.round(F.col("x") * 1000).cast("long"), 0.5, "median", "lang", "grp", "dim"), "medians")
    away = long.join(checked(medians), ["lang", "grp", "dim"])
    spread = _share_point(away, F.abs(F.round(F.col("x") * 1000).cast("long") - F.col("median")), 0.5, "mad", "lang", "grp", "dim")
    start = medians.join(spread, ["lang", "grp", "dim"]).groupBy("lang", "grp").pivot("dim", list(range(p))).agg(F.first("median").alias("median"), F.first("mad").alias("mad"))
    floors = [f for _, _, f in COORDINATES]
    sizes = vectors.groupBy("lang", "grp").agg(F.count("*").alias("size"))
    diagonal = {i: (F.greatest(1.4826 * F.col(f"{i}_mad") / 1000, F.lit(floors[i])) ** 2) for i in range(p)}
    start = start.join(sizes, ["lang", "grp"]).select("lang", "grp", "size", *[(F.col(f"{i}_median") / 1000).alias(f"m_{i}") for i in range(p)], *[(diagonal[i] if i == j else F.lit(0.0)).alias(f"c_{i}_{j}") for i in range(p) for j in range(i + 1)])
    active, ended = staged(_factor(start), "estimate"), []
    log_det = sum((F.log(f"l_{i}_{i}") for i in range(p)), F.lit(0.0)) * 2
    for step in range(STEPS):
        away = _with_distance(vectors, active).withColumn("bin", F.floor(F.log2(F.col("d2") + 1e-9) * GRID))
        limits = staged(_share_point(away, F.col("bin"), COVERAGE, "limit", "lang", "grp"), "limits")
        inner = away.join(checked(limits), ["lang", "grp"]).where("bin <= limit")
        # moments about the present location, so that no large squares cancel
        offset = [F.col(DIMS[i]) - F.col(f"m_{i}") for i in range(p)]
        sums = inner.groupBy("lang", "grp").agg(
            F.count("*").alias("h"), F.first("size").alias("size"), *[F.first(f"m_{i}").alias(f"old_{i}") for i in range(p)],
            *[F.sum(offset[i]).alias(f"s_{i}") for i in range(p)], *[F.sum(offset[i] * offset[j]).alias(f"s_{i}_{j}") for i in range(p) for j in range(i + 1)],
        )

        def covariance(i: int, j: int) -> Column:
            plain = F.col(f"s_{i}_{j}") / F.col("h") - F.col(f"s_{i}") * F.col(f"s_{j}") / F.col("h") ** 2
            return F.round(F.greatest(plain, F.lit(floors[i] ** 2)) if i == j else plain, 9).alias(f"c_{i}_{j}")

        moved = sums.select("lang", "grp", "size", *[F.round(F.col(f"old_{i}") + F.col(f"s_{i}") / F.col("h"), 9).alias(f"m_{i}") for i in range(p)], *[covariance(i, j) for i in range(p) for j in range(i + 1)])
        before, moved = active, staged(_factor(moved), "estimate")
        both = before.select("lang", "grp", log_det.alias("before")).join(moved.select("lang", "grp", log_det.alias("after")), ["lang", "grp"])
        # the start is no subset's estimate: what the first step makes of it is not compared with it
        fall = F.lit(math.inf) if step == 0 else F.col("before") - F.col("after")
        told = staged(both.select("lang", "grp", (fall <= TOLERANCE).alias("ends"), (fall > 0).alias("lower")), "fall")
        of = lambda rows, condition, told=told: rows.join(told.where(condition).select("lang", "grp"), ["lang", "grp"], "left_semi")
        ended += [of(moved, "ends AND lower"), of(before, "ends AND NOT lower")]
        active = staged(of(moved, "NOT ends"), "active")
        if active.isEmpty():
            break
    else:
        raise RuntimeError(f"some groups still moved after {STEPS} steps")
    estimate = ended[0]
    for more in ended[1:]:
        estimate = estimate.unionByName(more)
    estimate = staged(estimate, "estimates")
    scale = math.sqrt(consistency())
    return estimate.select("lang", "grp", "size", *[f"m_{i}" for i in range(p)], *[(F.col(f"l_{i}_{j}") * scale).alias(f"l_{i}_{j}") for i in range(p) for j in range(i + 1)])


def judged(docs: DataFrame, tail: float = TAIL, least: int = LEAST) -> DataFrame:
    """(doc_id, counts, base_failed, kept, distance) of each row; distance is null where the base failed."""
    held = staged(counts(docs), "counts").withColumns({c: F.expr(sql) for c, sql, _ in COORDINATES})
    passed = held.where("NOT base_failed").select("lang", F.explode(F.array(F.concat(F.lit("="), "source"), F.lit("*"))).alias("grp"), *DIMS)
    # both levels at once: a row counts for its source and for its language
    estimate = estimates(passed)
    known = checked(staged(estimate.where((F.col("size") >= least) & (F.col("grp") != "*")).select("lang", "grp", F.lit(True).alias("own")), "own"))
    named = held.withColumn("grp", F.concat(F.lit("="), "source")).join(known, ["lang", "grp"], "left")
    named = named.withColumn("grp", F.when(F.col("own"), F.col("grp")).otherwise(F.lit("*")))
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    # a language whose every text fails the base has no estimate, and needs none
    far = _with_distance(named.where("NOT base_failed"), estimate).select(*base, (F.col("d2") <= cutoff(tail)).alias("kept"), F.round("d2", 6).alias("distance"))
    return far.unionByName(held.where("base_failed").select(*base, F.lit(False).alias("kept"), F.lit(None).cast("double").alias("distance")))


def op1(spark, sf_dir: str) -> DataFrame:
    return judged(docs_of(spark, sf_dir))
