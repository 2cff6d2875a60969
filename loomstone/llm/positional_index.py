"""Benchmark decontamination by a distributed positional inverted index.

Documents are tokenised into segments of bounded size, as search engines do: each segment is a self-contained index of
some whole documents (its term list, the offset of each term's postings, and the sorted token positions). Segments are
rows of one table in the shared folder, so the index needs no shuffle, no task sees more than one segment at a time and
a hot term only ever fills a bounded list. Queries are windows of consecutive item words. In each segment a window whose
terms all occur starts from the postings of its rarest term; the others, in order of rarity, intersect it with their
offset-adjusted lists (binary search in the sorted postings). What is left is exact phrases. A proximity match is weaker:
all words of the window in one document, each within SLOP words of its place as seen from some occurrence of the longest
(the earliest of equals). The longest is looked for first and the others in order of their length.

Benchmarks are sent to the executors in blocks of BLOCK_WINDOWS windows, each a pass over the stored index whose hits are
stored before the next block is read, so a large benchmark never has to fit at once.

Edge cases: null or wordless texts give n_words 0 and no hits; an item shorter than a window is one window, a wordless or
null item none; items with a null id are ignored; rows with the same item_id are one item; repeated documents are judged
row by row; empty tables give empty or hitless results; other columns are never read, whatever their names.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstone.llm.common import CHUNK_BYTES, checked, chunks, docs_of, fresh, row_key, staged, texts_of

#: Words of a window, words that a proximity match may be off, and windows sent to the executors at once.
WINDOW, SLOP, BLOCK_WINDOWS = 10, 4, 200_000

#: Positions left free between two documents of a segment, so that no phrase or proximity match crosses them.
_GAP = WINDOW + 2 * SLOP + 2

_FOLD = bytes(c + 32 if 65 <= c <= 90 else 32 if c < 48 or 58 <= c < 97 or 123 <= c < 128 else c for c in range(256))
#: Postings that the windows of a step may start from together; one window's are bounded by the segment.
STARTS = 1 << 20

SEGMENT = "segment string, doc_ids binary, null_ids binary, hashes binary, n_words binary, terms binary, ends binary, postings binary"
HITS = "doc_id long, h long, n_words long, n_hit long, item_ids array<string>, near_ids array<string>, spans array<struct<item_id:string,start:int,end:int>>"


def words_of(text: bytes) -> list[bytes]:
    """Words of [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ after lower-casing A-Z; UTF-8 bytes over 0x7F are kept as they are."""
    return text.translate(_FOLD).split()


class Segment:
    """An inverted index of a few whole documents: postings[ends[t-1]:ends[t]] are term t's positions, ascending."""

    def __init__(self, n_words: np.ndarray, terms: dict[bytes, int], ends: np.ndarray, postings: np.ndarray):
        self.n_words, self.terms, self.ends, self.postings = n_words, terms, ends, postings
        self.starts = np.concatenate([[0], np.cumsum(n_words + _GAP)])

    @staticmethod
    def build(texts: list[bytes]) -> Segment:
        tokens: list[bytes] = []
        n_words = np.zeros(len(texts), dtype=np.int64)
        for k, text in enumerate(texts):
            words = words_of(text)
            n_words[k] = len(words)
            tokens += words
        ids: dict[bytes, int] = defaultdict(count().__next__)
        term = np.fromiter(map(ids.__getitem__, tokens), dtype=np.int64, count=len(tokens))
        at = np.arange(len(tokens), dtype=np.int64) + np.repeat(np.arange(len(texts), dtype=np.int64) * _GAP, n_words)
        return Segment(n_words, dict(ids), np.cumsum(np.bincount(term, minlength=len(ids))), np.sort(term << 32 | at) & 0xFFFFFFFF)

    def pack(self) -> list[bytes]:
        return [self.n_words.astype("<i8").tobytes(), b" ".join(self.terms), self.ends.astype("<i8").tobytes(), np.diff(self.postings, prepend=0).astype("<i4").tobytes()]

    @staticmethod
    def unpack(n_words: bytes, terms: bytes, ends: bytes, postings: bytes) -> Segment:
        return Segment(np.frombuffer(n_words, "<i8"), {t: k for k, t in enumerate(terms.split())}, np.frombuffer(ends, "<i8"), np.cumsum(np.frombuffer(postings, "<i4"), dtype=np.int64))


class Windows:
    """Distinct windows of the items, as rows of term numbers padded by -1, with the items that hold each."""

    def __init__(self, items: list[tuple[str, bytes]], width: int = WINDOW):
        found: dict[tuple[bytes, ...], set[str]] = defaultdict(set)
        for item_id, text in items:
            words = words_of(text)
            for i in range(max(1, len(words) - width + 1) if words else 0):
                found[tuple(words[i : i + width])].add(item_id)
        self.terms = {t: k for k, t in enumerate(dict.fromkeys(t for w in found for t in w))}
        self.rows = np.full((len(found), width), -1, dtype=np.int64)
        for k, window in enumerate(found):
            self.rows[k, : len(window)] = [self.terms[t] for t in window]
        self.items = [sorted(x) for x in found.values()]
        self.lengths = (self.rows >= 0).sum(axis=1)
        #: Places of the words from the longest on, for proximity; of a window of fewer words the last one is repeated.
        longest = [sorted(range(len(w)), key=lambda i: (-len(w[i]), i)) for w in found]
        self.anchors = np.array([x + x[-1:] * (width - len(x)) for x in longest], dtype=np.int64).reshape(-1, width)

    def search(self, segment: Segment, proximity: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, start) of each exact phrase as two arrays, and the (window, document) pairs of proximity matches, if wanted."""
        none = np.empty(0, dtype=np.int64)
        if not len(self.rows) or not len(segment.postings):
            return none, none, np.empty((0, 2), dtype=np.int64)
        local = np.array([segment.terms.get(t, -1) for t in self.terms], dtype=np.int64)
        rows = np.where(self.rows >= 0, local[self.rows], -2)
        begins = np.concatenate([[0], segment.ends[:-1]])
        df = segment.ends - begins
        keyed = np.repeat(np.arange(len(df), dtype=np.int64), df) << 32 | segment.postings

        def occurrences(term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """For each row's term its postings: the row, repeated, and the position."""
            row = np.repeat(np.arange(len(term)), df[term])
            first = np.cumsum(df[term]) - df[term]
            return row, segment.postings[begins[term][row] + np.arange(len(row)) - first[row]]

        near_of = np.flatnonzero((rows != -1).all(axis=1)) if proximity else none
        anchors, terms = self.anchors[near_of], np.take_along_axis(rows, self.anchors, axis=1)[near_of]
        near_found = [np.empty((0, 2), dtype=np.int64)]
        for part in _parts(df[terms[:, 0]]):
            w, at = occurrences(terms[part, 0])
            w = part[w]
            doc = np.searchsorted(segment.starts, at, side="right") - 1
            for k in range(1, self.rows.shape[1]):
                place = at + anchors[w, k] - anchors[w, 0]
                low = np.maximum(place - SLOP, segment.starts[doc])
                i = np.minimum(np.searchsorted(keyed, terms[w, k] << 32 | low), len(keyed) - 1)
                high = np.minimum(place + SLOP, segment.starts[doc + 1] - 1)
                keep = (keyed[i] >> 32 == terms[w, k]) & (keyed[i] & 0xFFFFFFFF >= low) & (keyed[i] & 0xFFFFFFFF <= high)
                w, at, doc = w[keep], at[keep], doc[keep]
            near_found.append(np.unique(np.stack([near_of[w], doc], axis=1), axis=0))
        near = np.concatenate(near_found)

        alive = np.flatnonzero((rows != -1).all(axis=1))
        rows, lengths = rows[alive], self.lengths[alive]
        order = np.argsort(np.where(rows >= 0, df[rows], np.iinfo(np.int64).max), axis=1, kind="stable")
        found = [(none, none)]
        for part in _parts(df[rows[np.arange(len(rows)), order[:, 0]]]):
            w, at = occurrences(rows[part, order[part, 0]])
            w = part[w]
            start = at - order[w, 0]
            w, start = w[start >= 0], start[start >= 0]
            for k in range(1, rows.shape[1]):
                place, absent = order[w, k], k >= lengths[w]
                wanted = rows[w, place] << 32 | (start + place)
                i = np.minimum(np.searchsorted(keyed, wanted), len(keyed) - 1)
                keep = absent | (keyed[i] == wanted)
                w, start = w[keep], start[keep]
            found.append((alive[w], start))
        return *(np.concatenate(x) for x in zip(*found, strict=True)), near


def _parts(sizes: np.ndarray, most: int | None = None) -> list[np.ndarray]:
    """Numbers of rows in runs whose sizes add up to about `most`."""
    if not len(sizes):
        return []
    upto = np.cumsum(sizes) // (most or STARTS)
    return np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(upto)) + 1)


def _hits(windows: Windows, segment: Segment, proximity: bool = True) -> list[tuple[int, list[str], list[str], list[dict]]]:
    """For each document of the segment: words hit, items with exact phrases, items near, spans."""
    w, start, near = windows.search(segment, proximity)
    covered = np.zeros(int(segment.starts[-1]) + WINDOW + 1, dtype=np.int64)
    np.add.at(covered, start, 1)
    np.add.at(covered, start + windows.lengths[w], -1)
    hit = np.concatenate([[0], np.cumsum(np.cumsum(covered) > 0)])
    doc = np.searchsorted(segment.starts, start, side="right") - 1
    exact_of, near_of, spans_of = defaultdict(set), defaultdict(set), defaultdict(set)
    for k, d, s in zip(w.tolist(), doc.tolist(), (start - segment.starts[doc]).tolist(), strict=True):
        exact_of[d].update(windows.items[k])
        spans_of[d].update((i, s, s + int(windows.lengths[k])) for i in windows.items[k])
    for k, d in near.tolist():
        near_of[d].update(windows.items[k])
    n_hit = hit[segment.starts[1:]] - hit[segment.starts[:-1]]
    return [(int(n), sorted(exact_of.get(d, ())), sorted(near_of.get(d, ())), [{"item_id": i, "start": a, "end": b} for i, a, b in sorted(spans_of.get(d, ()))]) for d, n in enumerate(n_hit.tolist())]


def blocks_of(benchmark: DataFrame, width: int = WINDOW, limit: int = BLOCK_WINDOWS) -> Iterator[Windows]:
    """The benchmark as blocks of windows; rows come to the driver a partition at a time and no more than a block is held."""
    items, held = [], 0
    for row in benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string")).where("item_id IS NOT NULL").toLocalIterator():
        text = (row[1] or "").encode()
        items.append((row[0], text))
        held += max(1, len(text) // 6)
        if held >= limit:
            yield Windows(items, width)
            items, held = [], 0
    if items:
        yield Windows(items, width)


def build_index(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The stored index of documents (doc_id, text): one row per segment."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, 2, limit=chunk_bytes):
            segment = Segment.build(texts_of(chunk.column(2)))
            ids, hashes = chunk.column(0), np.asarray(chunk.column(1)).astype("<i8").tobytes()
            packed = [uuid.uuid4().hex.encode(), np.asarray(ids.fill_null(0)).astype("<i8").tobytes(), np.asarray(ids.is_null()).astype("u1").tobytes(), hashes, *segment.pack()]
            yield pa.RecordBatch.from_arrays([pa.array([x.decode()]) if k == 0 else pa.array([x], pa.binary()) for k, x in enumerate(packed)], ["segment", "doc_ids", "null_ids", "hashes", "n_words", "terms", "ends", "postings"])

    doc, h = row_key()
    return staged(docs.select(doc.alias("doc_id"), h.alias("h"), F.col("text").cast("string")).mapInArrow(index, SEGMENT), "postings")


def search(index: DataFrame, benchmark: DataFrame, limit: int = BLOCK_WINDOWS, proximity: bool = True) -> DataFrame:
    """One row per indexed document, by its row_key(): its words, words hit, items with exact and with proximity matches, spans in words.

    n_hit counts a word once, however many windows cover it. With several blocks of windows, each is a pass whose rows
    are merged by the document's place in the index; spans decide the union there.
    """
    blocks = blocks_of(benchmark, limit=limit)
    first, second = next(blocks, None), next(blocks, None)
    if second is None:
        return _search_block(index, first or Windows([]), proximity).drop("place")
    merged = staged(_search_block(index, first, proximity), "hits").unionByName(staged(_search_block(index, second, proximity), "hits"))
    del first, second
    for windows in blocks:  # one in hand at a time: its hits are stored before the next is read
        merged = merged.unionByName(staged(_search_block(index, windows, proximity), "hits"))
    covered = "size(array_distinct(flatten(transform(spans, s -> sequence(s.start, s.end - 1)))))"
    return (
        merged.groupBy("place", "doc_id", "h", "n_words")
        .agg(*[F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in ("item_ids", "near_ids", "spans")])
        .select("doc_id", "h", "n_words", F.expr(f"cast({covered} AS long)").alias("n_hit"), "item_ids", "near_ids", "spans")
    )


def _search_block(index: DataFrame, windows: Windows, proximity: bool) -> DataFrame:
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                segment = Segment.unpack(row["n_words"], row["terms"], row["ends"], row["postings"])
                ids = np.ma.masked_array(np.frombuffer(row["doc_ids"], "<i8"), np.frombuffer(row["null_ids"], "u1").astype(bool)).tolist()
                found = _hits(windows, segment, proximity)
                columns = [ids, np.frombuffer(row["hashes"], "<i8").tolist(), segment.n_words.tolist(), *map(list, zip(*found, strict=True)), [f"{row['segment']}:{k}" for k in range(len(ids))]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _HIT_TYPES, strict=True)], _HIT_NAMES)

    return index.mapInArrow(look, f"{HITS}, place string")


_HIT_NAMES = ["doc_id", "h", "n_words", "n_hit", "item_ids", "near_ids", "spans", "place"]
_HIT_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.struct([("item_id", pa.string()), ("start", pa.int32()), ("end", pa.int32())])), pa.string()]


def decontaminate(docs: DataFrame, benchmark: DataFrame, limit: int = BLOCK_WINDOWS) -> DataFrame:
    """docs without the rows that hold a window of the benchmark; all columns are kept as they are.

    The stored index is searched, and rows with exact phrases go by their row_key(); no text is shuffled to drop a row.
    """
    doc, h = fresh(docs.columns, "__doc", "__hash")
    hit = search(build_index(docs), benchmark, limit, proximity=False).where("n_hit > 0").select(F.col("doc_id").alias(doc), F.col("h").alias(h))
    own = row_key()
    return docs.join(checked(staged(hit.distinct(), "contaminated")), own[0].eqNullSafe(F.col(doc)) & (own[1] == F.col(h)), "left_anti")


def op10(spark, sf_dir: str) -> DataFrame:
    """Every document against the whole benchmark: exact phrases, and items with proximity matches."""
    found = search(build_index(docs_of(spark, sf_dir)), docs_of(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("item_ids"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.size("near_ids").cast("long").alias("n_near"),
        F.sha2(F.array_join(F.array_sort("near_ids"), ","), 256).alias("near_sha256"),
    )


#: DuckDB: every ten-word window of every text against the windows of the items; for proximity, all words around the longest one's.
ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
w AS (
  SELECT DISTINCT cast(item_id AS VARCHAR) AS item_id, ws[i : i + 9] AS win FROM (
    SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0 AND item_id IS NOT NULL)),
pos AS (SELECT doc_id, ws, unnest(ws) AS term, unnest(range(1, len(ws) + 1)) AS i FROM d),
hits AS (
  SELECT p.doc_id, p.i, len(w.win) AS n, w.item_id FROM pos p JOIN w ON p.term = w.win[1]
  WHERE p.ws[p.i : p.i + len(w.win) - 1] = w.win),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id),
a AS (
  SELECT item_id, win, list_sort(list_transform(range(1, len(win) + 1), lambda i: {'n': -strlen(win[i]), 'i': i}))[1].i AS o FROM w),
close AS (
  SELECT DISTINCT p.doc_id, a.item_id FROM pos p JOIN a ON p.term = a.win[a.o]
  WHERE len(list_filter(range(1, len(a.win) + 1), lambda k: list_contains(p.ws[greatest(1, p.i - a.o + k - 4) : p.i - a.o + k + 4], a.win[k]))) = len(a.win)),
near AS (SELECT doc_id, count(*) AS n_near, string_agg(item_id, ',' ORDER BY item_id) AS near_ids FROM close GROUP BY doc_id)
SELECT d.doc_id, cast(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0) AS n_near, sha256(coalesce(near_ids, '')) AS near_sha256
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN near USING (doc_id)
"""
