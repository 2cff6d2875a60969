"""BPE encoding and decoding through a minimal acyclic transducer.

The most frequent words of the corpus are compiled, with their ids as outputs, into an automaton that shares prefixes
and suffixes. Each arc adds a number; the sum along a word's path is the word's place in one table of ids. The automaton
is a file of flat arrays that every Python worker maps into memory and walks for a batch of words at once, a byte a
step. Words outside it are merged exactly, many at a time, so the lexicon's size changes speed and never ids.

Text rules, those of the vocabulary file: special tokens are cut out first; then NFC, white space, lower case by single
characters, and words by the file's pattern, none of which crosses white space. Ids are joined to text by single spaces
between tokens, as a file without a decoder asks for.

Edge cases: null counts as empty, with no ids and an empty decoded text; a word of any length is merged in n log n; rows
repeat freely; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstone.llm.common import chunks, docs_of, shipped, texts_of

#: Words compiled into the automaton, and chunks of text that a worker remembers at once.
LEXICON, REMEMBERED = 1 << 16, 1 << 19
#: Bytes up to which words are merged side by side; longer ones are merged alone.
SIDE_BY_SIDE = 32

_RARE_SPACE = re.compile("[\x1c-\x1f]")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shifted = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(shifted)) for b in range(256)]


class Vocabulary:
    """What the tokenizer file fixes: initial ids of bytes, merges by rank, pieces and special tokens."""

    def __init__(self, path: str):
        spec = json.loads(Path(path).read_text(encoding="utf-8"))
        vocab, letters = dict(spec["model"]["vocab"]), byte_letters()
        end = spec["model"]["end_of_word_suffix"] or ""
        self.inner = np.array([vocab[c] for c in letters], dtype=np.int64)
        self.last = np.array([vocab[c + end] for c in letters], dtype=np.int64)
        pairs = [(m if isinstance(m, list) else m.split(" ")) for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.results = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)[order]
        self.rank_of = {(int(k) >> 32, int(k) & 0xFFFFFFFF): (int(r), int(t)) for k, r, t in zip(self.keys, self.ranks, self.results, strict=True)}
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = re.compile("|".join(map(re.escape, sorted(self.specials, key=len, reverse=True)))) if self.specials else None
        self.pattern = regex.compile(next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"))
        self.pieces = [b""] * (max([*vocab.values(), *self.specials.values()]) + 1)
        for piece, i in [*vocab.items(), *self.specials.items()]:
            self.pieces[i] = piece.encode()

    def words(self, chunk: str) -> list[str]:
        """The words of a text without special tokens."""
        if not chunk.isascii():
            chunk = unicodedata.normalize("NFC", chunk).replace("Σ", "σ")  # a final sigma has no rule of its own here
        chunk = chunk.lower()
        # letters alone are one word, and letters before one mark are two; the old letters are those of any table
        if chunk.isalpha() and max(chunk) < "\u0250":
            return [chunk]
        if chunk[-1:] in (".", ",", "!", "?", ";", ":") and chunk[:-1].isalpha() and max(chunk) < "\u0250":
            return [chunk[:-1], chunk[-1]]
        return self.pattern.findall(chunk)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and how many each has. Pairs merge by rank, from the left."""
        counts = np.zeros(len(words), dtype=np.int64)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for low, high in ((1, 4), (5, 8), (9, 12), (13, 20), (21, SIDE_BY_SIDE)):
            who = np.flatnonzero((lengths >= low) & (lengths <= high))
            for a in range(0, len(who), 1 << 15):
                at = who[a : a + (1 << 15)]
                ids, left = self._side_by_side([words[k] for k in at.tolist()], lengths[at], high)
                counts[at] = left
                parts.append((at, ids))
        alone = np.flatnonzero(lengths > SIDE_BY_SIDE).tolist()
        merged = [self._alone(words[k]) for k in alone]
        counts[alone] = [len(x) for x in merged]
        starts = np.cumsum(counts) - counts
        flat = np.empty(int(counts.sum()), dtype=np.int64)
        for at, ids in parts:
            inside = np.arange(ids.shape[1]) < counts[at][:, None]
            flat[(starts[at][:, None] + np.arange(ids.shape[1]))[inside]] = ids[inside]
        for k, ids in zip(alone, merged, strict=True):
            flat[starts[k] : starts[k] + len(ids)] = ids
        return flat, counts

    def _side_by_side(self, words: list[bytes], lengths: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), dtype=np.uint8).reshape(-1, width)
        ids = self.inner[raw]
        ids[np.arange(len(words)), lengths - 1] = self.last[raw[np.arange(len(words)), lengths - 1]]
        lengths = lengths.copy()
        never = np.iinfo(np.int64).max
        rank = np.full((len(words), width), never, dtype=np.int64)
        to = np.zeros((len(words), width), dtype=np.int64)

        def rate(row: np.ndarray, col: np.ndarray) -> None:
            """Looks the pairs at (row, col) up again; past a word's end there is none."""
            fits = (col >= 0) & (col + 1 < lengths[row])
            rank[row[(col >= 0) & ~fits], col[(col >= 0) & ~fits]] = never
            row, col = row[fits], col[fits]
            key = ids[row, col] << 32 | ids[row, col + 1]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = self.keys[at] == key
            rank[row, col] = np.where(known, self.ranks[at], never)
            to[row, col] = self.results[at]

        rate(*(x.ravel() for x in np.meshgrid(np.arange(len(words)), np.arange(width), indexing="ij")))
        live = np.arange(len(words))
        steps = np.arange(width)
        while len(live):
            best = rank[live].argmin(axis=1)
            more = rank[live, best] != never
            live, best = live[more], best[more]
            if not len(live):
                break
            new = to[live, best]
            source = np.minimum(steps + (steps > best[:, None]), width - 1)
            for table in (ids, rank, to):
                table[live] = np.take_along_axis(table[live], source, axis=1)
            ids[live, best] = new
            lengths[live] -= 1
            rank[live, lengths[live]] = never
            rate(live, best)
            rate(live, best - 1)
        return ids, lengths

    def _alone(self, word: bytes) -> list[int]:
        """One word by a heap of pairs over a linked list."""
        ids = [*self.inner[np.frombuffer(word[:-1], np.uint8)].tolist(), int(self.last[word[-1]])]
        after, before = [*range(1, len(ids)), -1], [-1, *range(len(ids) - 1)]
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] >= 0 and (found := self.rank_of.get((ids[i], ids[after[i]]))):
                heapq.heappush(heap, (found[0], i, ids[i], ids[after[i]]))

        for i in range(len(ids)):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            if ids[i] != a or after[i] < 0 or ids[after[i]] != b:
                continue
            j = after[i]
            ids[i], ids[j], after[i] = self.rank_of[a, b][1], -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            offer(i)
            offer(before[i])
        return [i for i in ids if i >= 0]

    def decode(self, ids: np.ndarray) -> bytes:
        """The pieces of the ids with a space between any two; special tokens stay."""
        return b" ".join(map(self.pieces.__getitem__, ids.tolist()))


class Transducer:
    """A minimal acyclic automaton over bytes; arcs carry numbers whose sum is the place of the word in the table of ids."""

    def __init__(self, path: str):
        head = np.fromfile(path, dtype="<i8", count=4)
        n_arcs, n_states, n_words, n_ids = map(int, head)
        at = 32

        def column(kind: str, n: int) -> np.ndarray:
            nonlocal at
            found = np.memmap(path, dtype=kind, mode="r", offset=at, shape=(n,)) if n else np.empty(0, dtype=kind)
            at += n * np.dtype(kind).itemsize
            return found

        self.arcs, self.targets, self.adds = column("<i8", n_arcs), column("<i4", n_arcs), column("<i4", n_arcs)
        self.final, self.ends, self.ids = column("<i4", n_states), column("<i4", n_words + 1), column("<i4", n_ids)
        # plain views: indexing a memmap makes another one each time
        self.arcs, self.targets, self.adds, self.final, self.ends, self.ids = map(np.asarray, (self.arcs, self.targets, self.adds, self.final, self.ends, self.ids))

    @staticmethod
    def packed(words: list[bytes], ids: np.ndarray, counts: np.ndarray) -> bytes:
        """The content of the file. Words are distinct and in byte order. States are registered from the back, as sorted input allows."""
        register: dict[tuple, int] = {}
        below: list[int] = []  # words from a state on
        states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []

        def settle(state: list) -> int:
            key = (state[0], tuple(state[1]))
            if key not in register:
                register[key] = len(states)
                states.append(key)
                below.append(int(key[0]) + sum(below[t] for _, t in key[1]))
            return register[key]

        path_states: list[list] = [[False, []]]
        previous = b""
        for word in words:
            shared = next((i for i, (a, b) in enumerate(zip(word, previous, strict=False)) if a != b), min(len(word), len(previous)))
            for i in range(len(previous), shared, -1):
                path_states[i - 1][1].append((previous[i - 1], settle(path_states.pop())))
            path_states += [[False, []] for _ in word[shared:]]
            path_states[-1][0] = True
            previous = word
        for i in range(len(previous), 0, -1):
            path_states[i - 1][1].append((previous[i - 1], settle(path_states.pop())))
        root = settle(path_states[0])
        number = [0 if s == root else s + 1 for s in range(len(states))]  # the root is state 0
        arcs, targets, adds, final = [], [], [], [0] * (len(states) + 1)
        for s, (ends_here, out) in enumerate(states):
            final[number[s]] = int(ends_here)
            passed = int(ends_here)
            for byte, t in out:
                arcs.append(number[s] << 8 | byte)
                targets.append(number[t])
                adds.append(passed)
                passed += below[t]
        order = np.argsort(np.array(arcs, dtype=np.int64))
        columns = ((targets, order), (adds, order), (final, slice(None)), (np.concatenate([[0], np.cumsum(counts)]), slice(None)), (ids, slice(None)))
        head = np.array([len(arcs), len(final), len(words), len(ids)], "<i8").tobytes() + np.array(arcs, "<i8")[order].tobytes()
        return head + b"".join(np.asarray(values, dtype="<i4")[by].tobytes() for values, by in columns)

    def places(self, words: list[bytes]) -> np.ndarray:
        """The place of each word in the table of ids, or -1; all words take a step together."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        found = np.full(len(words), -1, dtype=np.int64)
        if not len(self.arcs) or not len(words):
            return found
        raw = np.frombuffer(b"".join(words), dtype=np.uint8)
        begin = np.cumsum(lengths) - lengths
        live, state, total = np.arange(len(words)), np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        step = 0
        while len(live):
            ended = lengths[live] == step
            done = ended & (self.final[state] == 1)
            found[live[done]] = total[done]
            live, state, total = live[~ended], state[~ended], total[~ended]
            key = state << 8 | raw[begin[live] + step]
            at = np.minimum(np.searchsorted(self.arcs, key), len(self.arcs) - 1)
            known = self.arcs[at] == key
            live, state, total = live[known], self.targets[at[known]].astype(np.int64), total[known] + self.adds[at[known]]
            step += 1
        return found


class Encoder:
    """Encodes texts through the transducer, merging what it lacks, and remembers a bounded number of chunks."""

    def __init__(self, vocabulary: Vocabulary, transducer: Transducer | None):
        self.vocabulary, self.transducer = vocabulary, transducer
        self.known: dict[str, bytes] = {}

    def ids_of_words(self, words: list[bytes]) -> list[bytes]:
        """Little-endian ids of each word."""
        places = self.transducer.places(words) if self.transducer else np.full(len(words), -1)
        found: list[bytes] = [b""] * len(words)
        seen = np.flatnonzero(places >= 0)
        if len(seen):
            held, at = memoryview(self.transducer.ids).cast("B"), places[seen]
            for k, a, b in zip(seen.tolist(), (4 * self.transducer.ends[at]).tolist(), (4 * self.transducer.ends[at + 1]).tolist(), strict=True):
                found[k] = bytes(held[a:b])
        unseen = np.flatnonzero(places < 0).tolist()
        ids, counts = self.vocabulary.merge([words[k] for k in unseen])
        raw, ends = ids.astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
        for k, a, b in zip(unseen, [0, *ends], ends, strict=False):
            found[k] = raw[a:b]
        return found

    def learn(self, new: list[str]) -> None:
        split = list(map(self.vocabulary.words, new))
        words = list({w: None for s in split for w in s})
        ids = dict(zip(words, self.ids_of_words([w.encode() for w in words]), strict=True))
        for chunk, parts in zip(new, split, strict=True):
            self.known[chunk] = ids[parts[0]] if len(parts) == 1 else b"".join([ids[w] for w in parts])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = list(map(self._chunks, texts))
        distinct = set().union(*split)
        if len(self.known) + len(distinct) > REMEMBERED:
            self.known.clear()
        if self.vocabulary.special:
            self.known |= {s: np.array([i], "<u4").tobytes() for s, i in self.vocabulary.specials.items()}
        self.learn(list(distinct - self.known.keys()))
        return [b"".join(map(self.known.__getitem__, s)) for s in split]

    def _chunks(self, text: str) -> list[str]:
        """Pieces between white space, special tokens apart; no word crosses them."""
        if self.vocabulary.special and "<|" in text:
            found, at = [], 0
            for m in self.vocabulary.special.finditer(text):
                found += [*self._plain(text[at : m.start()]), m.group()]
                at = m.end()
            return [*found, *self._plain(text[at:])]
        return self._plain(text)

    @staticmethod
    def _plain(text: str) -> list[str]:
        return [text] if _RARE_SPACE.search(text) else text.split()  # these four are white space to str.split() alone


def frequent_words(docs: DataFrame, vocabulary_name: str, limit: int = LEXICON) -> list[str]:
    """The `limit` most frequent words over all texts, ties in word order; counts are summed before they move."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(vocabulary_name)
        totals: Counter[str] = Counter()
        for chunk in chunks(batches, 0):
            for text in texts_of(chunk.column(0)):
                totals.update(text.decode().split())
            if len(totals) > REMEMBERED:
                yield _counted(vocabulary, totals)
                totals.clear()
        if totals:
            yield _counted(vocabulary, totals)

    counts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "word string, n long")
    top = counts.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(limit)
    return sorted(r[0] for r in top.select("word").toLocalIterator())


def _counted(vocabulary: Vocabulary, totals: Counter) -> pa.RecordBatch:
    words: Counter[str] = Counter()
    for chunk, n in totals.items():
        for word in vocabulary.words(chunk):
            words[word] += n
    return pa.RecordBatch.from_arrays([pa.array(words.keys(), pa.string()), pa.array(words.values(), pa.int64())], ["word", "n"])


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@lru_cache(maxsize=2)
def _vocabulary(name: str) -> Vocabulary:
    """A worker's vocabulary, kept while the worker lives."""
    return Vocabulary(SparkFiles.get(name))


@lru_cache(maxsize=1)
def _encoder(vocabulary_name: str, name: str) -> Encoder:
    """A worker's encoder, kept with what it remembers for the tasks that follow."""
    return Encoder(_vocabulary(vocabulary_name), Transducer(SparkFiles.get(name)))


def encode(docs: DataFrame, vocabulary_path: str | None = None, lexicon: int = LEXICON, with_ids: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]) of each row; the decoded text is made from the ids."""
    spark, path = docs.sparkSession, vocabulary_path or default_vocabulary()
    vocabulary_name = shipped(spark, Path(path).name, Path(path).read_bytes())
    words = sorted(w.encode() for w in frequent_words(docs, vocabulary_name, lexicon))
    ids, counts = Vocabulary(path).merge(words)
    name = shipped(spark, "lexicon.transducer", Transducer.packed(words, ids, counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary_name, name)
        for chunk in chunks(batches):
            coded = encoder.encode([t.decode() for t in texts_of(chunk.column(1))])
            values = [np.frombuffer(c, dtype="<u4") for c in coded]
            columns = [
                chunk.column(0), pa.array([len(v) for v in values], pa.int64()), pa.array([hashlib.sha256(c).hexdigest() for c in coded], pa.string()),
                pa.array([hashlib.sha256(encoder.vocabulary.decode(v)).hexdigest() for v in values], pa.string()),
            ]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(coded), dtype="<i4"))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def op2(spark, sf_dir: str) -> DataFrame:
    return encode(docs_of(spark, sf_dir), with_ids=False)
