"""Filter interaction audit: what each of five filters removes, repeats or alone catches, in every order they can be applied in.

Documents are an RDD of (route, row) pairs. Rows are routed by the xxhash of their text; a partition keeps, for each
fingerprint, a chain of the full texts that have it, each with the least id met so far, and emits the rows whose id is not the
least as copies. Each row then is a mask of the filters it fails. combineByKey merges masks into one vector of counts per
language, of a fixed length (a place per mask and labels), and all 120 orders are read off that vector, so no order looks at
the documents again.

A group of copies may hold any share of the rows: every task first builds the chains of its own input, where all but the
least of equal texts are known to be copies already, so that only one row per distinct text and task is routed by its
text. The others, and rows without an id, travel without it, spread by their own numbers. Chains of a task's input are sent
on when their texts exceed `HELD` bytes; partitions are as many as hold about that much of all texts, which are counted first.
Labels are met by id after masks of equal rows were counted. A lost task is made again from its input or its shuffle.

Edge cases: null text and language read as ''; rows of the least id of a text are no copies, however often they repeat;
rows without an id are no copies, make no other row one and have no labels; several labels of an id count if any is 1; other
columns are not read; an empty table has no parts and gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import permutations

import xxhash
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstone.llm.common import docs_of

#: The filters, in the order of the bits of a mask: few words, repeated words, capitals, symbols, copies.
FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
#: Bytes of texts that the chains of a task's input hold, and that the chains of a partition should.
HELD = 32 << 20

_CAPITALS = bytes(range(65, 91))
_SYMBOL = re.compile(rb"[#$%&*|]")

#: (text or None, id, part, {mask: rows}); None for what needs no chain
Row = tuple[bytes | None, int | None, str, dict[int, int]]


def failures(text: bytes, length: int) -> int:
    """The mask of the filters, but the last, that a text of so many code points fails."""
    words = text.split()  # of bytes: at the six white space characters of ASCII
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    return (len(words) < 200) | (100 * len(set(words)) < 50 * len(words)) << 1 | (100 * capitals > 3 * length) << 2 | (_SYMBOL.search(text) is not None) << 3


class Chains:
    """Full texts by fingerprint, each with its least id and the masks of the rows that have it."""

    def __init__(self) -> None:
        self.by_print: dict[int, list[list]] = {}
        self.bytes = 0

    def meet(self, fingerprint: int, text: bytes, doc_id: int, part: str, masks: dict[int, int]) -> Iterator[tuple[int, str, dict[int, int]]]:
        """Takes a row in and emits (id, part, masks) of the rows that turn out to be copies."""
        chain = self.by_print.setdefault(fingerprint, [])
        entry = next((e for e in chain if e[0] == text), None)
        if entry is None:
            chain.append([text, doc_id, {part: Counter(masks)}])
            self.bytes += len(text)
        elif doc_id > entry[1]:
            yield doc_id, part, masks
        elif doc_id == entry[1]:
            entry[2].setdefault(part, Counter()).update(masks)
        else:
            yield from ((entry[1], p, m) for p, m in entry[2].items())
            entry[1:] = [doc_id, {part: Counter(masks)}]

    def least(self) -> Iterator[tuple[int, bytes, int, str, dict[int, int]]]:
        for fingerprint, chain in self.by_print.items():
            for text, doc_id, parts in chain:
                yield from ((fingerprint, text, doc_id, p, dict(m)) for p, m in parts.items())

    def clear(self) -> None:
        self.by_print.clear()
        self.bytes = 0


def _copied(masks: dict[int, int]) -> dict[int, int]:
    return {m | COPY: n for m, n in masks.items()}


def _spread(doc_id: int | None, place: int) -> int:
    return xxhash.xxh64_intdigest(str((doc_id, place)))


def _of_input(rows: Iterator[tuple], held: int) -> Iterator[tuple[int, Row]]:
    """(route, row) of a task's documents: copies within the task without their texts, one row of each other text with it."""
    chains = Chains()

    def sent() -> Iterator[tuple[int, Row]]:
        for fingerprint, text, doc_id, part, masks in chains.least():
            yield fingerprint, (text, doc_id, part, masks)
        chains.clear()

    for place, (doc_id, part, text) in enumerate(rows):
        raw = text.encode()
        masks = {failures(raw, len(text)): 1}
        if doc_id is None:
            yield _spread(None, place), (None, None, part, masks)
            continue
        for copy, its_part, its_masks in chains.meet(xxhash.xxh64_intdigest(raw), raw, doc_id, part, masks):
            yield _spread(copy, place), (None, copy, its_part, _copied(its_masks))
        if chains.bytes > held:
            yield from sent()
    yield from sent()


def _of_route(rows: Iterator[tuple[int, Row]]) -> Iterator[tuple[int | None, str, int, int]]:
    """(doc_id, part, mask, rows) from the rows of a partition; a copy as soon as it is known."""
    chains = Chains()
    for fingerprint, (text, doc_id, part, masks) in rows:
        if text is None:
            yield from ((doc_id, part, m, n) for m, n in masks.items())
        else:
            for copy, its_part, its_masks in chains.meet(fingerprint, text, doc_id, part, masks):
                yield from ((copy, its_part, m, n) for m, n in _copied(its_masks).items())
    for _, _, doc_id, part, masks in chains.least():
        yield from ((doc_id, part, m, n) for m, n in masks.items())


def masks(docs: DataFrame, held: int = HELD) -> DataFrame:
    """(doc_id, part, mask, n): how many rows of an id and language fail just the filters of the mask."""
    spark = docs.sparkSession
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "text")])
    size = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // held))
    routed: RDD = plain.rdd.mapPartitions(lambda rows: _of_input(rows, held)).partitionBy(n, lambda fingerprint: fingerprint)
    found = spark.createDataFrame(routed.mapPartitions(_of_route), "doc_id long, part string, mask int, n long", verifySchema=False)
    return found.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))


def copies(docs: DataFrame) -> DataFrame:
    """(doc_id) of the documents whose text is that of a smaller id."""
    return masks(docs).where(F.col("mask").bitwiseAND(COPY) != 0).select("doc_id").distinct()


def _added(vector: list[int], row: tuple[int, int, int]) -> list[int]:
    mask, labels, n = row
    vector[mask * 4 + labels] += n
    return vector


def _orders(part: str, vector: list[int]) -> Iterator[tuple]:
    """The report of one part from its vector: places are mask * 4 + 2 * (quality is 1) + (toxic is 1)."""
    marked = [(m, vector[4 * m : 4 * m + 4]) for m in range(1 << len(FILTERS))]
    rows, removed_by = [], Counter()
    for order in permutations(FILTERS):
        before = 0
        for step, name in enumerate(order, 1):
            bit = 1 << FILTERS.index(name)
            here = [v for m, v in marked if m & bit and not m & before]
            removed = sum(map(sum, here))
            rows.append((
                part, "".join(order), step, sum(sum(v) for m, v in marked if not m & (before | bit)), removed, sum(sum(v) for m, v in marked if m & bit and m & before),
                sum(marked[bit][1]), sum(v[2] + v[3] for v in here), sum(v[1] + v[3] for v in here), name,
            ))
            removed_by[name] += removed
            before |= bit
    yield from ((*row[:-1], removed_by[row[-1]]) for row in rows)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step; see the module."""
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.when(F.col("quality") == 1, 2).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    marked = masks(docs).join(known, "doc_id", "left").select("part", "mask", (F.coalesce("good", F.lit(0)) + F.coalesce("toxic", F.lit(0))).alias("labels"), "n")
    size = 4 << len(FILTERS)
    vectors = marked.rdd.map(lambda r: (r[0], (r[1], r[2], r[3]))).combineByKey(lambda row: _added([0] * size, row), _added, lambda a, b: [x + y for x, y in zip(a, b, strict=True)])
    schema = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"
    return docs.sparkSession.createDataFrame(vectors.flatMap(lambda kv: _orders(*kv)), schema, verifySchema=False)


def op12(spark, sf_dir: str) -> DataFrame:
    return audit(docs_of(spark, sf_dir), docs_of(spark, sf_dir, "labels"))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, coalesce(min(doc_id) OVER (PARTITION BY t) < doc_id, false) AS copy FROM d),
f AS (
  SELECT doc_id, part, unnest([len(ws) < 200, 100 * len(list_distinct(ws)) < 50 * len(ws), 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 3 * length(t), regexp_matches(t, '[#$%&*|]'), copy]) AS fails,
    unnest([1, 2, 4, 8, 16]) AS bit, row_number() OVER () AS k FROM w),
m AS (SELECT k, any_value(doc_id) AS doc_id, any_value(part) AS part, sum(if(fails, bit, 0)) AS mask FROM f GROUP BY k),
l AS (SELECT doc_id, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, mask::INT AS mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM m LEFT JOIN l USING (doc_id) GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (SELECT filter_order, s AS step, bits[s] AS bit, coalesce(list_sum(bits[1 : s - 1]), 0)::INT AS before FROM orders, range(1, 6) r(s)),
found AS (
  SELECT part, filter_order, step, bit, sum(if(mask & (bit | before) = 0, n, 0)) AS kept, sum(if(mask & bit <> 0 AND mask & before = 0, n, 0)) AS removed,
    sum(if(mask & bit <> 0 AND mask & before <> 0, n, 0)) AS redundant, sum(if(mask = bit, n, 0)) AS unique_fails,
    sum(if(mask & bit <> 0 AND mask & before = 0, good, 0)) AS good_lost, sum(if(mask & bit <> 0 AND mask & before = 0, toxic, 0)) AS toxic_lost
  FROM c, steps GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
  good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM found
"""
