"""Encoding and decoding with a vocabulary of scored pieces that merge, by backtracking.

Merging joins, again and again, the two neighbours whose joined text is the piece of the best score, leftmost of equals. A
sequence of pieces is what merging gives for a text exactly if each two neighbours are what merging gives for their own text:
neighbours develop alone until something merges across their border, and the first merge across a border needs nothing but
the two pieces beside it. So a text is encoded without merging it: an Aho-Corasick automaton over the reversed pieces finds
the longest piece from each place in one pass; from the left, the longest piece that goes with the one before it is taken,
then shorter ones; where none goes, the place is marked in a bitfield as failed and the piece before it is taken back. Each
prefix has one encoding, so a failed place is failed for good and the work is linear in the text. Whether two pieces go
together is found by merging their texts, once per worker.

Texts are cut first where no piece can lie across: between two characters that stand side by side in no piece, as at white
space or in scripts whose pieces are single letters; characters that are in no piece become bytes. A worker remembers the ids
of short parts up to a bound of bytes. The vocabulary is read in the
driver, checked for what is built here (merging, fallback to bytes, no rewriting of the text, a leading space), reduced to the
pieces that merging can give at all, and shipped as one file.

Edge cases: null counts as empty; an empty text is the end id alone and decodes to an empty text; a text of any length
without white space is encoded in linear time; rows repeat freely; an empty table gives an empty result; other columns are not
read. The visible mark that stands for a space in pieces decodes to a space, so texts that contain it do not come back as they
were; all others do.
"""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstone.llm.common import chunks, docs_of, lists, shipped, texts_of

#: Bytes that a worker's remembered parts take, as counted by `Encoder.cost`, and characters of the longest one.
REMEMBERED, LONGEST = 64 << 20, 64
#: Pairs of pieces that a worker remembers, and characters that are looked at together for places to cut.
PAIRS, BLOCK = 1 << 20, 1 << 20

#: What a space is written as in pieces.
MARK = "▁"
#: Fixed values of the model file: kinds of pieces, and the field numbers read here.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE, SCORE, KIND = 1, 2, 3
MODEL_TYPE, MERGING, BYTE_FALLBACK, UNKNOWN_SURFACE, END_ID = 3, 2, 35, 44, 42
RULES, LEADING_SPACE, FEWER_SPACES, ESCAPED = 2, 3, 4, 5


def fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protobuf message: integers, or the bytes of all else."""
    at = 0

    def integer() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = integer()
        number, kind = key >> 3, key & 7
        if kind == 0:
            yield number, integer()
            continue
        size = integer() if kind == 2 else 8 if kind == 1 else 4
        yield number, message[at : at + size]
        at += size


def read_model(content: bytes) -> dict:
    """What the file fixes: pieces with their ranks (equal scores, equal ranks) and kinds, the end id, the unknown id's surface."""
    pieces, trainer, normalizer = [], {}, {}
    for number, value in fields(content):
        if number == PIECES:
            got = dict(fields(value))
            pieces.append((got[PIECE].decode(), struct.unpack("<f", got.get(SCORE, bytes(4)))[0], got.get(KIND, NORMAL)))
        elif number == TRAINER:
            trainer = dict(fields(value))
        elif number == NORMALIZER:
            normalizer = dict(fields(value))
    as_built = trainer.get(MODEL_TYPE) == MERGING and trainer.get(BYTE_FALLBACK) == 1 and {k for _, _, k in pieces} <= {NORMAL, UNKNOWN, CONTROL, BYTE}
    plain = not normalizer.get(RULES) and normalizer.get(LEADING_SPACE, 1) == 1 and normalizer.get(FEWER_SPACES, 1) == 0 and normalizer.get(ESCAPED, 1) == 1
    if not as_built or not plain:
        raise ValueError("a model of merged pieces with bytes for the unknown, a leading space and no other rewriting is needed")
    order = {s: r for r, s in enumerate(sorted({s for _, s, _ in pieces}, reverse=True))}
    end = trainer.get(END_ID, 2)
    return {"pieces": [p for p, _, _ in pieces], "ranks": [order[s] for _, s, _ in pieces], "kinds": [k for _, _, k in pieces], "end": end, "surface": trainer.get(UNKNOWN_SURFACE, b" \xe2\x81\x87 ").decode()}


def merged(text: str, ranks: dict[str, int]) -> list[str]:
    """The pieces of a short text by merging: the best joined neighbours first, leftmost of equals."""
    parts = list(text)
    while len(parts) > 1:
        found = [(r, i) for i in range(len(parts) - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
        if not found:
            break
        _, i = min(found)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts


def compiled(content: bytes) -> dict:
    """The model as workers read it: besides what read_model() gives, the ids of pieces that merging can give."""
    model = read_model(content)
    ranks = {p: r for p, r, k in zip(model["pieces"], model["ranks"], model["kinds"], strict=True) if k == NORMAL}
    model["given"] = [i for i, (p, k) in enumerate(zip(model["pieces"], model["kinds"], strict=True)) if k == NORMAL and merged(p, ranks) == [p]]
    return model


class Pieces:
    """Encodes by backtracking and decodes."""

    def __init__(self, model: dict):
        pieces, kinds = model["pieces"], model["kinds"]
        self.end = model["end"]
        self.ranks = {p: r for p, r, k in zip(pieces, model["ranks"], kinds, strict=True) if k == NORMAL}
        self.byte_ids = {int(p[1:-1], 16): i for i, (p, k) in enumerate(zip(pieces, kinds, strict=True)) if k == BYTE}
        letters = set().union(*self.ranks) if self.ranks else set()
        # tokens: the pieces that merging gives, and letters of pieces that are no piece themselves
        self.ids = {pieces[i]: [i] for i in model["given"]}
        self.ids |= {c: self.of_bytes(c) for c in letters - self.ids.keys()}
        self.texts = list(self.ids)
        number = {t: k for k, t in enumerate(self.texts)}
        self.lengths = list(map(len, self.texts))
        self.shorter = [next((number[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in number), -1) for t in self.texts]
        self.matcher = ahocorasick.Automaton()
        for k, t in enumerate(self.texts):
            self.matcher.add_word(t[::-1], k)
        if self.texts:
            self.matcher.make_automaton()
        # numbers of the letters of pieces, 0 for all others, and which two stand side by side in a piece
        self.letter = np.zeros(0x110000, dtype=np.int32)
        self.letter[[ord(c) for c in sorted(letters)]] = np.arange(1, len(letters) + 1)
        self.side_by_side = np.zeros((len(letters) + 1, len(letters) + 1), dtype=bool)
        for p in self.ranks:
            row = self.letter[[ord(c) for c in p]]
            self.side_by_side[row[:-1], row[1:]] = True
        self.goes: dict[int, bool] = {}  # by both numbers in one
        surface = {BYTE: lambda p: bytes([int(p[1:-1], 16)]), NORMAL: lambda p: p.replace(MARK, " ").encode(), CONTROL: lambda p: b"", UNKNOWN: lambda p: model["surface"].encode()}
        self.surfaces = [surface[k](p) for p, k in zip(pieces, kinds, strict=True)]
        self.kinds, self.controls = kinds, {i for i, k in enumerate(kinds) if k == CONTROL}
        self.marked = [k == NORMAL and p.startswith(MARK) for p, k in zip(pieces, kinds, strict=True)]

    def of_bytes(self, letter: str) -> list[int]:
        return [self.byte_ids[b] for b in letter.encode()]

    def go_together(self, a: int, b: int) -> bool:
        """Whether merging leaves the two tokens' common text as just these two."""
        if len(self.goes) >= PAIRS:
            self.goes.clear()
        known = self.goes[a << 32 | b] = merged(self.texts[a] + self.texts[b], self.ranks) == [self.texts[a], self.texts[b]]
        return known

    def backtracked(self, text: str) -> list[int]:
        """The tokens of a text of known letters."""
        n, lengths, goes = len(text), self.lengths, self.goes
        longest = [-1] * (n + 1)
        for last, token in self.matcher.iter(text[::-1]):
            before = longest[n - 1 - last]
            if before < 0 or lengths[token] > lengths[before]:
                longest[n - 1 - last] = token
        failed = bytearray((n >> 3) + 1)
        path: list[int] = []
        at, token, last = 0, longest[0], -1
        while at < n:
            end = at + lengths[token]
            if not failed[end >> 3] >> (end & 7) & 1 and (last < 0 or (known if (known := goes.get(last << 32 | token)) is not None else self.go_together(last, token))):
                path.append(token)
                at, last, token = end, token, longest[end]
            elif self.shorter[token] >= 0:
                token = self.shorter[token]
            else:
                failed[at >> 3] |= 1 << (at & 7)
                token = path.pop()
                last = path[-1] if path else -1
                at -= lengths[token]
        return path

    def parts(self, text: str) -> Iterator[list[str]]:
        """The text cut where no piece lies across, the parts that end in a block of BLOCK characters at a time."""
        begin = 0
        for a in range(0, len(text), BLOCK):
            rows = self.letter[np.frombuffer(text[a : a + BLOCK + 1].encode("utf-32-le"), dtype="<u4")]
            cuts = (np.flatnonzero(~self.side_by_side[rows[:-1], rows[1:]]) + (a + 1)).tolist()
            if cuts:
                yield list(map(text.__getitem__, map(slice, [begin, *cuts], cuts)))
                begin = cuts[-1]
        if begin < len(text):
            yield [text[begin:]]

    def ids_of(self, part: str) -> list[int]:
        """Ids of a part; one that holds a letter of no piece is that letter."""
        if part in self.ids:
            return self.ids[part]
        if not self.letter[ord(part[0])]:
            return self.of_bytes(part)
        return [i for token in self.backtracked(part) for i in self.ids[self.texts[token]]]

    def decode(self, ids: list[int]) -> bytes:
        """The text of the ids: a leading space goes, and bytes that are no text become replacement characters one by one."""
        while ids and ids[-1] in self.controls:
            ids = ids[:-1]
        whole = b"".join(map(self.surfaces.__getitem__, ids))
        try:
            whole.decode()
            apart = self.controls.isdisjoint(ids)  # bytes on both sides of one are no letter
        except UnicodeDecodeError:
            apart = False
        if not apart:
            whole = self._repaired(ids)
        first = next((i for i in ids if self.kinds[i] != CONTROL), None)
        return whole[1:] if first is not None and self.marked[first] else whole

    def _repaired(self, ids: list[int]) -> bytes:
        found, run = [], b""
        for i in [*ids, None]:
            if i is not None and self.kinds[i] == BYTE:
                run += self.surfaces[i]
                continue
            at = 0
            while at < len(run):
                size = next((n for n in range(1, 5) if _is_letter(run[at : at + n])), 0)
                found.append(run[at : at + size] if size else "�".encode())
                at += size or 1
            run = b""
            if i is not None:
                found.append(self.surfaces[i])
        return b"".join(found)


def _is_letter(raw: bytes) -> bool:
    try:
        return len(raw.decode()) == 1
    except UnicodeDecodeError:
        return False


class Encoder:
    """Encodes whole texts and remembers the parts it met, up to a bound of bytes."""

    def __init__(self, pieces: Pieces, limit: int = REMEMBERED):
        self.pieces, self.limit, self.held = pieces, limit, 0
        self.known: dict[str, bytes] = {}
        self.end = np.array([pieces.end], "<u4").tobytes()

    @staticmethod
    def cost(part: str, ids: bytes) -> int:
        """Bytes that a remembered part takes: both objects and its place in the table."""
        return 4 * len(part) + len(ids) + 200

    def _learnt(self, parts: list[str]) -> dict[str, bytes]:
        """Ids of all the parts; those of short ones are remembered."""
        if self.held > self.limit:
            self.known.clear()
            self.held = 0
        found = {}
        for part in set(parts):
            ids = self.known.get(part)
            if ids is None:
                ids = np.array(self.pieces.ids_of(part), "<u4").tobytes()
                if len(part) <= LONGEST and self.held <= self.limit:
                    self.held += self.cost(part, ids)
                    self.known[part] = ids
            found[part] = ids
        return found

    def encode(self, text: str) -> bytes:
        """Little-endian ids of a text, the end id last."""
        if not text:
            return self.end
        return b"".join([*map(self._of_parts, self.pieces.parts(MARK + text.replace(" ", MARK))), self.end])

    def _of_parts(self, parts: list[str]) -> bytes:
        try:
            return b"".join(map(self.known.__getitem__, parts))
        except KeyError:
            return b"".join(map(self._learnt(parts).__getitem__, parts))


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _shipped_model(df: DataFrame, path: str | None) -> str:
    return shipped(df.sparkSession, "pieces.json", json.dumps(compiled(Path(path or default_model()).read_bytes())).encode())


@lru_cache(maxsize=2)
def _encoder(name: str) -> Encoder:
    """A worker's encoder, kept with what it remembers for the tasks that follow."""
    return Encoder(Pieces(json.loads(Path(SparkFiles.get(name)).read_bytes())))


def encode(docs: DataFrame, model_path: str | None = None, with_ids: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]) of each row; the decoded text is made from the ids."""
    name = _shipped_model(docs, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(name)
        decimal = [b"%d" % i for i in range(len(encoder.pieces.surfaces))]
        for chunk in chunks(batches):
            values = [np.frombuffer(encoder.encode(t.decode()), dtype="<u4") for t in texts_of(chunk.column(1))]
            plain = [v.tolist() for v in values]
            columns = [
                chunk.column(0), pa.array(list(map(len, plain)), pa.int64()), pa.array([hashlib.sha256(b" ".join(map(decimal.__getitem__, v))).hexdigest() for v in plain], pa.string()),
                pa.array([hashlib.sha256(encoder.pieces.decode(v)).hexdigest() for v in plain], pa.string()),
            ]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(lists(np.concatenate(values).astype("<i4"), np.array(list(map(len, plain)))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def decode(tokens: DataFrame, model_path: str | None = None) -> DataFrame:
    """(doc_id, text) of rows of doc_id and ids; null ids give an empty text."""
    name = _shipped_model(tokens, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _encoder(name).pieces
        for batch in batches:
            texts = [pieces.decode(v or []).decode() for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return tokens.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")).mapInArrow(run, "doc_id long, text string")


def op11(spark, sf_dir: str) -> DataFrame:
    return encode(docs_of(spark, sf_dir), with_ids=False)
