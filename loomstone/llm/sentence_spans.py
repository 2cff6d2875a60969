"""Substring deduplication by sliding sentence spans.

At every sentence a run starts: the shortest of at least RUN consecutive sentences with at least MIN_WORDS words (a text
of a single sentence with that many words is one run). With every=True, as op6 has it, the shortest such run that ends at
each sentence is one too, so that a repeated passage goes up to its last sentence whatever follows it, and so is every
sentence of more than ALONE words by itself. Each run's hash (64 bits, and 32 more against collisions) is
counted over the whole corpus with its first place, in a sum that is pre-aggregated before its shuffle. Every sentence
that a repeated run covers anywhere but in its first place is removed, with the white space after it. First is the
smallest (doc_id, hash of the text, sentence).

A run that a third of all documents share is one row of the table of repeated runs, and a join whose hot side the
planner can split; nothing gathers the places of a run.

Edge cases: null texts stay null and empty ones empty; texts without a run are kept as they are; rows with the same
doc_id and text are one document, so their runs are no repetition of each other, and rows of one doc_id with other texts
are others, in the order of the text's hash; null ids come first; an empty table gives an empty result; other columns are
kept by deduplicated(), whatever their names, and not read by removals().
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstone.llm.common import chunks, docs_of, fresh, row_key, staged, texts_of

RUN, MIN_WORDS = 2, 20
#: A sentence of more words than this is a run of its own in any text.
ALONE = 50

_BREAK = re.compile(rb"(?<=[.!?])\s+|\n\s*")
_RUNS = "doc_id long, t long, h long, c int, at int, n int"


def sentences_of(text: bytes) -> list[bytes]:
    """The text cut after each . ! or ? before white space and after each line, the white space staying at the end."""
    ends = [m.end() for m in _BREAK.finditer(text)]
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    return [text[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def runs_of(text: bytes, run: int = RUN, min_words: int = MIN_WORDS, every: bool = False) -> list[tuple[int, int, int, int]]:
    """(64-bit hash, 32-bit hash, first sentence, sentences) of each run."""
    parts = [s.strip() for s in sentences_of(text)]
    n = len(parts)
    words = np.concatenate([[0], np.cumsum([s.count(b" ") + 1 if s else 0 for s in parts])])
    if words[-1] < min_words:
        return []
    ends = np.maximum(np.searchsorted(words, words[:-1] + min_words), np.arange(n) + min(run, n))
    spans = {(i, e): None for i, e in enumerate(ends.tolist()) if e <= n and parts[i]}
    if every:
        starts = np.minimum(np.searchsorted(words, words[1:] - min_words, "right") - 1, np.arange(1, n + 1) - min(run, n))
        spans |= {(i, k + 1): None for k, i in enumerate(starts.tolist()) if i >= 0 and parts[k]}
        spans |= {(k, k + 1): None for k in np.flatnonzero(np.diff(words) > ALONE).tolist()}
    return [
        (xxhash.xxh3_64_intdigest(joined) - (1 << 63), xxhash.xxh32_intdigest(joined) - (1 << 31), i, e - i)
        for i, e in spans
        for joined in (b"\n".join(parts[i:e]),)
    ]


def removals(docs: DataFrame, run: int = RUN, min_words: int = MIN_WORDS, every: bool = False) -> DataFrame:
    """(doc_id, t, places): of each document with repeated sentences, by its row_key(), the (first sentence, sentences) of what goes."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, 2):
            found = [runs_of(t, run, min_words, every) for t in texts_of(chunk.column(2))]
            flat = np.array([x for f in found for x in f], dtype=np.int64).reshape(-1, 4)
            of = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
            yield pa.RecordBatch.from_arrays([chunk.column(0).take(of), chunk.column(1).take(of), pa.array(flat[:, 0]), *(pa.array(flat[:, k].astype(np.int32)) for k in (1, 2, 3))], ["doc_id", "t", "h", "c", "at", "n"])

    doc, t = row_key()
    places = staged(docs.select(doc.alias("doc_id"), t.alias("t"), F.col("text").cast("string")).mapInArrow(emit, _RUNS), "runs")
    repeated = places.groupBy("h", "c").agg(F.min(F.struct("doc_id", "t", "at")).alias("first"), F.count("*").alias("copies")).where("copies > 1")
    repeated = staged(repeated.select("h", "c", F.col("first.doc_id").alias("first_id"), F.col("first.t").alias("first_t"), F.col("first.at").alias("first_at")), "repeated")
    later = places.join(repeated, ["h", "c"]).where("NOT (doc_id <=> first_id AND t = first_t AND at = first_at)").select("doc_id", "t", "at", "n").distinct()
    return later.groupBy("doc_id", "t").agg(F.collect_list(F.struct("at", "n")).alias("places"))


def deduplicated(docs: DataFrame, run: int = RUN, min_words: int = MIN_WORDS, every: bool = False) -> DataFrame:
    """docs with what is repeated cut out of `text`, and counts of sentences and of sentences cut.

    The counts are the last columns, fresh(docs.columns, "__sentences", "__removed").
    """
    n_sentences, n_removed, doc, t, cuts = fresh(docs.columns, "__sentences", "__removed", "__doc", "__hash", "__places")
    gone = staged(removals(docs, run, min_words, every).toDF(doc, t, cuts), "removals")
    own = row_key()
    joined = docs.join(gone, own[0].eqNullSafe(F.col(doc)) & (own[1] == F.col(t)), "left")
    kept = [c for c in docs.columns]
    at = kept.index("text")
    schema = f"{', '.join(f'`{f.name}` {'string' if f.name == 'text' else f.dataType.simpleString()}' for f in docs.schema)}, {n_sentences} long, {n_removed} long"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, at):
            texts, counts, removed = [], [], []
            for text, places in zip(chunk.column(at).cast(pa.binary()).to_pylist(), chunk.column(len(kept)).to_pylist(), strict=True):
                parts = sentences_of(text or b"")
                go = {i for p in places or () for i in range(p["at"], p["at"] + p["n"])}
                texts.append(text if not go else b"".join(s for i, s in enumerate(parts) if i not in go).rstrip())
                counts.append(sum(1 for s in parts if s.strip()))
                removed.append(sum(1 for i in go if parts[i].strip()))
            columns = [chunk.column(k) for k in range(len(kept))]
            columns[at] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array(removed, pa.int64())], [*kept, n_sentences, n_removed])

    return joined.select(*[F.col(f"`{c}`") for c in kept], cuts).mapInArrow(cut, schema)


def op6(spark, sf_dir: str) -> DataFrame:
    """Every document with its remaining text, its sentences and how many of them went."""
    found = deduplicated(docs_of(spark, sf_dir).select("doc_id", "text"), every=True)
    return found.select("doc_id", "text", F.col("__sentences").alias("n_sentences"), F.col("__removed").alias("n_removed"))
