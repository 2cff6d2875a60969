"""Source divergence audit: how far the word use of each source of a language lies from that of the others, and by which terms.

Every kept term becomes a wide vector, an array of its counts with one place for each source of its language. Terms of equal
vectors are one vector with a multiplicity, so rare terms, which are most of a vocabulary, are few rows. Higher-order functions
turn counts into smoothed shares and each place of a vector into its contributions to all others; these are summed on the map
side, so a shuffle carries at most one row per pair of sources from each task.

Texts are read once. Tasks count occurrences and documents of each term, language and source over bounded stretches of their
input and send one row for each; these rows are dealt by language and term, which serves both groupings that follow. A source
that holds a third of all rows is as many rows as a stretch has distinct terms. The report of single terms takes ranks up to
`top`, a limit that Spark applies within tasks before rows of a group meet. All arithmetic is in whole numbers: shares through
decimals, contributions in longs (ANSI mode raises where a long would not do).

One row of arrays per language (sources, their totals) is sent to all tasks if its counted elements are under the bounds of
`checked`, and joined by a shuffle otherwise. Pairs of sources are the result itself, so the work on a vector is the square of
the language's sources, never of its documents.

Edge cases: null text, language and source read as ''; a group without terms has totals of zero and smoothed shares like any
other; a language that keeps no term has pairs of value 0 and no term rows; a language with one source has no pairs; repeated
rows are as many documents; ties rank by item; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomstone.llm.common import checked, chunks, docs_of, staged, texts_of

#: Documents of a language that a kept term is in, at least, and ranks of the report of terms.
DOCUMENTS, TOP = 3, 200
#: What shares are multiplied by.
SCALE = 1_000_000_000

#: What a task counts before it sends: bytes of texts, and distinct terms.
STRETCH, ENTRIES = 64 << 20, 1 << 19

#: Bytes to themselves, but A-Z to lower case and what parts terms to a space; letters beyond ASCII are bytes from 128 on.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def _share(count: str, total: str) -> str:
    """The smoothed share of a count, scaled; exact for any long."""
    return f"1 + (cast({SCALE} AS decimal(10, 0)) * cast({count} + 1 AS decimal(19, 0))) div cast({total} AS decimal(19, 0))"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of lang, source, text to rows of lang, source, term, n (occurrences) and d (documents)."""
    times: dict[tuple, Counter] = defaultdict(Counter)
    within: dict[tuple, Counter] = defaultdict(Counter)
    taken = 0

    def sent() -> Iterator[pa.RecordBatch]:
        for (lang, source), counter in times.items():
            terms, own = list(counter), within[lang, source]
            columns = [pa.array([lang] * len(terms)), pa.array([source] * len(terms)), pa.array(terms, pa.binary()).cast(pa.string()), pa.array(counter.values(), pa.int64()), pa.array([own[t] for t in terms], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "d"])
        times.clear()
        within.clear()

    for chunk in chunks(batches, 2):
        for lang, source, text in zip(chunk.column(0).to_pylist(), chunk.column(1).to_pylist(), texts_of(chunk.column(2)), strict=True):
            terms = text.translate(_LETTERS).split(b" ")
            times[lang, source].update(terms)
            within[lang, source].update(set(terms))
            taken += len(text)
        if taken > STRETCH or sum(map(len, times.values())) > ENTRIES:
            yield from sent()
            taken = 0
    yield from sent()


def term_counts(docs: DataFrame, documents: int = DOCUMENTS) -> DataFrame:
    """(lang, term, total, at): the kept terms of each language and their counts in each source that has them."""
    plain = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counted = plain.mapInArrow(_counted, "lang string, source string, term string, n long, d long").where("term <> ''")
    # one exchange: what lies by language and term lies by language, term and source too
    sums = counted.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    terms = sums.groupBy("lang", "term").agg(F.sum("d").alias("documents"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("at"))
    return terms.where(F.col("documents") >= documents).select("lang", "term", "total", "at")


def languages(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(lang, sources, totals, total, v) of each language: its sources in order, their kept occurrences, its kept terms."""
    groups = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    sums = terms.select("lang", F.inline("at")).groupBy("lang", "source").agg(F.sum("n").alias("n"))
    rows = groups.join(sums, ["lang", "source"], "left").groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("source", F.coalesce("n", F.lit(0)).alias("n")))).alias("rows"))
    sizes = terms.groupBy("lang").agg(F.count("*").alias("v"))
    return rows.join(sizes, "lang", "left").select(
        "lang", F.col("rows.source").alias("sources"), F.col("rows.n").alias("totals"), F.expr("aggregate(rows.n, 0L, (s, n) -> s + n)").alias("total"), F.coalesce("v", F.lit(0)).alias("v")
    )


def pairs(terms: DataFrame, langs: DataFrame) -> DataFrame:
    """(lang, source, item, value) for each two sources of a language."""
    wide = terms.join(langs.select("lang", "sources"), "lang").selectExpr("lang", "sources", "map_from_entries(at) AS held")
    wide = wide.selectExpr("lang", "transform(sources, s -> coalesce(try_element_at(held, s), 0L)) AS counts")
    vectors = wide.groupBy("lang", "counts").agg(F.count("*").alias("m")).join(langs.select("lang", "totals", "v"), "lang")
    shares = vectors.selectExpr("lang", "m", f"transform(counts, (c, i) -> {_share('c', 'totals[i] + v')}) AS shares")
    one = shares.selectExpr("lang", "m", "shares", "posexplode(shares) AS (i, p)")
    both = one.selectExpr("lang", "m", "i", "posexplode(transform(shares, q -> ((p - q) * (p - q)) div q)) AS (j, f)")
    sums = both.groupBy("lang", "i", "j").agg(F.sum(F.col("m") * F.col("f")).alias("f"))
    places = langs.selectExpr("lang", "sources", "posexplode(sources) AS (i, source)").selectExpr("lang", "i", "source", "posexplode(sources) AS (j, item)").where("i <> j")
    return places.join(sums, ["lang", "i", "j"], "left").select("lang", "source", "item", F.coalesce("f", F.lit(0)).alias("value"))


def marking_terms(terms: DataFrame, langs: DataFrame) -> DataFrame:
    """(lang, source, item, value) of each term that a source has and uses more than its language does."""
    each = terms.selectExpr("lang", "term AS item", "total AS n_lang", "inline(at)").join(langs, "lang")
    shares = each.selectExpr("lang", "source", "item", f"{_share('n', 'totals[array_position(sources, source) - 1] + v')} AS p", f"{_share('n_lang', 'total + v')} AS q")
    return shares.where("p > q").selectExpr("lang", "source", "item", "((p - q) * (p - q)) div q AS value")


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    rank: Column = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", rank.alias("rank"))


def audit(docs: DataFrame, documents: int = DOCUMENTS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): all pairs of sources, and the marking terms of each up to `top`."""
    terms = staged(term_counts(docs, documents), "terms")
    langs = checked(staged(languages(docs, terms), "languages"), "sources", "totals")
    return _ranked(pairs(terms, langs), "pair").unionByName(_ranked(marking_terms(terms, langs), "term").where(F.col("rank") <= top))


def op13(spark, sf_dir: str) -> DataFrame:
    return audit(docs_of(spark, sf_dir))


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
w AS (SELECT k, lang, source, unnest(ws) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS c FROM w GROUP BY lang, term HAVING count(DISTINCT k) >= 3),
vs AS (SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
own AS (SELECT lang, source, term, count(*) AS c FROM w SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
totals AS (SELECT lang, source, sum(c) AS n FROM own GROUP BY lang, source),
grid AS (
  SELECT g.lang, g.source, k.term, coalesce(o.c, 0) AS c,
    cast(1 + (1000000000::HUGEINT * (coalesce(o.c, 0) + 1)) // (coalesce(t.n, 0) + vs.v) AS BIGINT) AS p,
    cast(1 + (1000000000::HUGEINT * (k.c + 1)) // (vs.n + vs.v) AS BIGINT) AS q
  FROM g JOIN kept k ON k.lang = g.lang JOIN vs ON vs.lang = g.lang
  LEFT JOIN own o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term
  LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p)::HUGEINT * (a.p - b.p) // b.p) AS value
  FROM grid a JOIN grid b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
rows AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, cast(coalesce(p.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, cast((p - q)::HUGEINT * (p - q) // q AS BIGINT) FROM grid WHERE c > 0 AND p > q)
SELECT * FROM (
  SELECT lang, source, part, item, value, cast(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM rows)
WHERE part = 'pair' OR rank <= 200
"""
