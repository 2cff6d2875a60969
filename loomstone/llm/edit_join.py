"""Line deduplication by a segment-partition edit join.

A line goes if an equal line comes before it, or if a line within THRESHOLD edits of it (in code points, for lines of at
least MIN_CHARS) first occurs before it does. Before means a smaller (doc_id, line number); first occurrences are those
of the whole corpus, whether or not they go themselves, so the result depends on no order of work.

Equal lines are counted by hash with a pre-aggregated sum. For near lines every distinct line is cut into THRESHOLD + 1
even segments: lines within THRESHOLD edits share one of them, moved by a bounded shift. The inverted index of segments
is keyed by (line length, segment number, segment); each line probes the indexes of its own and of the THRESHOLD lengths
below with only the substrings that the multi-match-aware windows leave. Index and probe entries meet by key as packed
arrays, of which only filled buckets move. There a 32-bit parity signature of the characters (an edit changes at most two
bits) tells which lines have any partner under a key at all. These lines get their texts and first places, and meet again
by key. There a line is compared with those before it until one is found within THRESHOLD edits, by banded bit-parallel
edit distance over blocks of pairs: a line needs a single witness, and what is emitted is at most one row per line and key.

Hot keys (a template with very many variants): entries of a key that are many in one batch do not go to the key's bucket
but on to the second meeting, all of them and untested, and a marker lets the key's other entries follow. In the second
meeting a key with more than BLOCK lines is dealt by blocks of lines to pairs of blocks, so no task holds more than two
blocks of a key. What stays quadratic is the comparison of signatures within one key, about a nanosecond a pair, and only
as long as a line has no witness.

Edge cases: null texts stay null; lines without a word are never touched and never count; empty tables give empty
results; rows with the same doc_id and text are one document, and rows of one doc_id with other texts are others, in the
order of the text's hash; null ids come first; other columns are kept by deduplicated(), whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstone.llm.common import CHUNK_BYTES, checked, chunks, docs_of, fresh, row_key, staged, texts_of

#: Edits that near lines may be apart, and code points from which lines are compared for nearness.
THRESHOLD, MIN_CHARS = 2, 24
#: Index and probe entries aimed at in a bucket, entries of one key in a batch from which the key is hot, lines of a block of a hot key.
BUCKET, HOT, BLOCK = 400_000, 64, 4096
#: Roles of entries: probing only, indexed, passed on untested, telling that the key is hot.
_PROBE, _INDEX, _PASS, _MARKER = range(4)

_ENTRY = np.dtype([("key", "<u8"), ("id", "<i8"), ("sign", "<u4"), ("role", "u1")])
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mixed(x: np.ndarray) -> np.ndarray:
    """A finishing permutation of 64-bit values."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def segment(length: np.ndarray, i: int, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, length) of segment i of lines of these lengths: even, the longer ones last."""
    size, longer = length // (threshold + 1), length % (threshold + 1)
    from_longer = np.maximum(i - (threshold + 1 - longer), 0)
    return i * size + from_longer, size + (i >= threshold + 1 - longer)


class Lines:
    """Distinct lines as one array of code points with prefix hashes, so that any substring hashes in constant time."""

    def __init__(self, lines: list[bytes]):
        self.ids = np.array([xxhash.xxh64_intdigest(x, 42) for x in lines], dtype=np.uint64).view(np.int64)
        points = np.frombuffer(b"\n".join(lines).decode().encode("utf-32-le"), dtype="<u4")
        cuts = np.flatnonzero(points == 10)
        self.begin = np.concatenate([[0], cuts + 1]) if lines else np.empty(0, np.int64)
        self.length = np.concatenate([cuts, [len(points)]])[: len(lines)] - self.begin
        value = mixed(points.astype(np.uint64) + np.uint64(1))
        power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(points), _BASE)]), dtype=np.uint64)
        self.back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(points), _INVERSE)]), dtype=np.uint64)
        self.prefix = np.concatenate([[np.uint64(0)], np.cumsum(value * power[:-1], dtype=np.uint64)])
        bits = np.uint32(1) << (value & np.uint64(31)).astype(np.uint32)
        bits[cuts] = 0
        self.sign = np.bitwise_xor.reduceat(bits, self.begin) if len(points) else np.empty(0, np.uint32)
        self.points, self.cuts = points, cuts

    def pairs(self) -> np.ndarray:
        """64-bit parity signatures of neighbouring characters; an edit changes at most four bits."""
        if not len(self.points):
            return np.empty(0, np.uint64)
        pair = mixed(self.points.astype(np.uint64) << np.uint64(32) | np.append(self.points[1:], 10).astype(np.uint64))
        bits = np.uint64(1) << (pair & np.uint64(63))
        bits[self.cuts] = 0  # a line's last character has a pair with the line's end
        return np.bitwise_xor.reduceat(bits, self.begin)

    def key(self, at: np.ndarray, start: np.ndarray, size: np.ndarray, length: np.ndarray, i: int) -> np.ndarray:
        a = self.begin[at] + start
        return mixed((self.prefix[a + size] - self.prefix[a]) * self.back[a] + mixed(length.astype(np.uint64) * np.uint64(8) + np.uint64(i)))


def entries_of(lines: list[bytes], threshold: int = THRESHOLD, min_chars: int = MIN_CHARS) -> np.ndarray:
    """Index entries (role 1, which also probe their own length in place) and further probes (role 0)."""
    held = Lines(lines)
    at = np.flatnonzero(held.length >= max(min_chars, threshold + 1))
    n, found = held.length[at], []

    def add(who: np.ndarray, key: np.ndarray, role: int) -> None:
        rows = np.empty(len(who), dtype=_ENTRY)
        rows["key"], rows["id"], rows["sign"], rows["role"] = key, held.ids[who], held.sign[who], role
        found.append(rows)

    for i in range(threshold + 1):
        start, size = segment(n, i, threshold)
        add(at, held.key(at, start, size, n, i), 1)
        for shorter in range(threshold + 1):
            length = n - shorter
            start, size = segment(length, i, threshold)
            for move in range(max(-i, shorter - (threshold - i)), min(i, shorter + threshold - i) + 1):
                if shorter or move:
                    fits = (length >= max(min_chars, threshold + 1)) & (start + move >= 0) & (start + move + size <= n)
                    add(at[fits], held.key(at[fits], (start + move)[fits], size[fits], length[fits], i), 0)
    return np.concatenate(found)


def packed(entries: np.ndarray, buckets: int, salt: int, hot: int = HOT) -> tuple[np.ndarray, list[bytes]]:
    """The filled buckets of a batch's entries; those of a key with more than `hot` entries go elsewhere, by the salt."""
    entries = entries[np.argsort(entries["key"], kind="stable")]
    _, first, size = np.unique(entries["key"], return_index=True, return_counts=True)
    many = np.repeat(size > hot, size)
    markers = entries[first[size > hot]]
    markers["role"] = _MARKER
    entries["role"][many] = _PASS
    bucket = np.where(many, salt, entries["key"] % np.uint64(buckets)).astype(np.int64)
    entries, bucket = np.concatenate([entries, markers]), np.concatenate([bucket, (markers["key"] % np.uint64(buckets)).astype(np.int64)])
    order = np.argsort(bucket, kind="stable")
    filled, starts = np.unique(bucket[order], return_index=True)
    return filled, [x.tobytes() for x in np.split(entries[order], starts[1:])] if len(filled) else []


def members(entries: np.ndarray, threshold: int = THRESHOLD, most: int = BLOCK) -> np.ndarray:
    """(key, id) of the entries with a partner: another line with a near signature, one of the two indexed.

    Entries passed on stay untested, and so does all that is under a hot key or one with more than `most` entries.
    """
    passed, entries = entries[entries["role"] == _PASS], entries[entries["role"] != _PASS]
    entries = entries[np.argsort(entries["key"], kind="stable")]
    starts = np.flatnonzero(np.concatenate([[True], entries["key"][1:] != entries["key"][:-1]])) if len(entries) else np.empty(0, np.int64)
    sizes = np.diff(np.append(starts, len(entries)))
    size_of = np.repeat(sizes, sizes)
    partner = size_of > most
    partner |= np.repeat(np.maximum.reduceat(entries["role"] == _MARKER, starts), sizes) if len(entries) else partner
    found = [passed[["key", "id"]], entries[partner & (entries["role"] != _MARKER)][["key", "id"]]]
    entries = entries[~partner & (size_of > 1)]
    key, ids, sign, indexed = (np.ascontiguousarray(entries[c]) for c in ("key", "id", "sign", "role"))
    indexed, partner = indexed == _INDEX, np.zeros(len(entries), dtype=bool)
    for step in range(1, int(sizes[sizes <= most].max(initial=1))):  # each entry against the one that many places on
        at = np.flatnonzero(key[step:] == key[:-step])
        if not len(at):
            break
        at = at[(np.bitwise_count(sign[at] ^ sign[at + step]) <= 2 * threshold) & (ids[at] != ids[at + step]) & (indexed[at] | indexed[at + step])]
        partner[at] = partner[at + step] = True
    return np.concatenate([*found, entries[partner][["key", "id"]]])


def repeated(lines: list[str], groups: np.ndarray, threshold: int = THRESHOLD, most: int = 1 << 20) -> np.ndarray:
    """Which of the lines are within threshold edits of one before them in their group; groups are runs of equal numbers.

    Candidates are gathered until there are `most` of them, and then tried, the likeliest of each line first.
    """
    gone = np.zeros(len(lines), dtype=bool)
    held_lines = Lines([x.encode() for x in lines])
    sign, pairs = held_lines.sign, held_lines.pairs()
    length = np.fromiter(map(len, lines), dtype=np.int64, count=len(lines))
    held: list[np.ndarray] = []
    waiting = 0

    def settle() -> None:
        x, y, apart = np.concatenate(held, axis=1) if held else np.empty((3, 0), np.int64)
        held.clear()
        order = np.lexsort((y, apart, x))
        x, y = x[order], y[order]
        rank = np.arange(len(x)) - np.searchsorted(x, x)
        low, high = 0, 1
        while (now := (rank >= low) & (rank < high) & ~gone[x]).any() or (rank >= high).any() and not gone[x[rank >= high]].all():
            good = within([lines[i] for i in x[now].tolist()], [lines[j] for j in y[now].tolist()], threshold)
            gone[x[now][good]] = True
            low, high = high, high * 4

    starts = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]])) if len(groups) else np.empty(0, np.int64)
    for start, end in zip(starts.tolist(), np.append(starts[1:], len(lines)).tolist(), strict=True):
        for a in range(start, end, 256):
            b = min(a + 256, end)
            apart = np.bitwise_count(sign[a:b, None] ^ sign[None, start:b])
            near = (apart <= 2 * threshold) & (np.abs(length[a:b, None] - length[None, start:b]) <= threshold) & (np.arange(start, b) < np.arange(a, b)[:, None])
            i, j = np.nonzero(near)
            both = np.bitwise_count(pairs[a + i] ^ pairs[start + j]) <= 4 * threshold
            i, j = i[both], j[both]
            held.append(np.stack([a + i, start + j, apart[i, j]]).astype(np.int64))
            waiting += len(i)
            if waiting >= most:
                settle()
                waiting = 0
    settle()
    return gone


def within(left: list[str], right: list[str], threshold: int = THRESHOLD) -> np.ndarray:
    """Whether each pair is within threshold edits; a band of 2 * threshold + 1 diagonals as bits, all pairs at once.

    Bit k of the vectors is row j - threshold + k of column j. The band moves down a row with each column, so the
    vertical differences are those of the last column moved by a bit. The lowest diagonal is tracked until it leaves the
    pattern, then the last row.
    """
    m = np.array([len(x) for x in left], dtype=np.int64)
    n = np.array([len(x) for x in right], dtype=np.int64)
    good = np.zeros(len(left), dtype=bool)
    todo = np.flatnonzero(np.abs(m - n) <= threshold)
    width = 2 * threshold + 1
    one, full = np.uint64(1), np.uint64((1 << width) - 1)
    todo = todo[np.argsort(np.maximum(m[todo], n[todo]), kind="stable")]
    cells = np.cumsum(np.maximum(m[todo], n[todo]) + 2 * width + 2) // (1 << 20)  # pairs of like length, a bounded block at a time
    for who in np.split(todo, np.flatnonzero(np.diff(cells)) + 1) if len(todo) else ():
        rows, cols = m[who], n[who]
        tall, wide = int(rows.max()), int(cols.max())
        p = np.zeros((len(who), tall + 2 * width + 2), dtype=np.uint32)
        t = np.full((len(who), wide), 0xFFFFFFFF, dtype=np.uint32)
        for table, lines, sizes, begin in ((p, left, rows, threshold), (t, right, cols, 0)):
            points = np.frombuffer("".join([lines[w] for w in who.tolist()]).encode("utf-32-le"), dtype="<u4") + 1
            table[np.repeat(np.arange(len(who)), sizes), begin + np.arange(len(points)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = points
        vp = np.full(len(who), full & ~np.uint64((1 << threshold) - 1) if threshold else full, dtype=np.uint64)
        vp &= full
        vn = np.zeros(len(who), dtype=np.uint64)
        score = np.minimum(rows, threshold)
        for j in range(wide):
            match = np.zeros(len(who), dtype=np.uint64)
            for k in range(width):
                match |= (p[:, j + k] == t[:, j]).astype(np.uint64) << np.uint64(k)
            d0 = (((match & vp) + vp) ^ vp) | match | vn
            hp = vn | ~(d0 | vp)
            hn = d0 & vp
            live = j < cols
            diagonal = live & (j + threshold < rows)
            score += diagonal & ((d0 >> np.uint64(width - 1) & one) == 0)
            flat = live & ~diagonal
            last = np.clip(rows - 1 - j + threshold, 0, width - 1).astype(np.uint64)
            score += flat & ((hp >> last & one) == 1)
            score -= flat & ((hn >> last & one) == 1)
            vp = (hn | ~((d0 >> one) | hp)) & full
            vn = (d0 >> one) & hp & full
        good[who] = score <= threshold
    return good


def _occurrences(docs: DataFrame) -> DataFrame:
    """(doc_id, h, at, id, id2) of each line that has a word; id is the 64-bit hash that Lines computes too."""
    doc, h = row_key()
    lines = docs.select(doc.alias("doc_id"), h.alias("h"), F.posexplode(F.split(F.col("text").cast("string"), "\n", -1)).alias("at", "line"))
    return lines.where(F.col("line").rlike(r"[^\x20\x09-\x0D]")).select("doc_id", "h", "at", F.xxhash64("line").alias("id"), F.hash("line").alias("id2"))


def near_lines(docs: DataFrame, first: DataFrame, threshold: int = THRESHOLD, min_chars: int = MIN_CHARS, lines: int | None = None, hot: int = HOT, block: int = BLOCK) -> DataFrame:
    """Ids of the distinct lines that have a line within threshold edits before them.

    first: (id, first) with the first place of each line; lines tells how many there are about, for the buckets.
    """
    texts = docs.select(F.lit(0).alias("k"), F.col("text").cast("string").alias("text"))
    buckets = max(16, (lines or 0) * (threshold + 1) * 4 // BUCKET)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, limit=CHUNK_BYTES // 2):
            distinct = {x for t in texts_of(chunk.column(1)) for x in t.split(b"\n") if len(x) >= min_chars}
            entries = entries_of(sorted(distinct), threshold, min_chars)
            filled, blobs = packed(entries, buckets, buckets + int(entries["id"][0]) % buckets if len(entries) else 0, hot)
            yield pa.RecordBatch.from_arrays([pa.array(filled, pa.int64()), pa.array(blobs, pa.binary())], ["bucket", "entries"])

    def meet(table: pa.Table) -> pa.Table:
        found = members(np.frombuffer(b"".join(table.column("entries").to_pylist()), dtype=_ENTRY), threshold, block)
        return pa.table({"key": pa.array(found["key"].view(np.int64)), "id": pa.array(found["id"])})

    shared = staged(texts.mapInArrow(emit, "bucket long, entries binary").groupBy("bucket").applyInArrow(meet, "key long, id long").distinct(), "members")
    wanted = staged(shared.select("id").distinct(), "wanted")
    line = docs.select(F.explode(F.split(F.col("text").cast("string"), "\n", -1)).alias("line")).select(F.xxhash64("line").alias("id"), "line")
    known = line.join(checked(wanted), "id", "left_semi").groupBy("id").agg(F.min("line").alias("line"))
    known = staged(known.join(first.join(checked(wanted), "id", "left_semi"), "id"), "lines")
    parts = staged(shared.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > block).select("key", F.ceil(F.col("n") / block).cast("int").alias("parts")), "hot-keys")
    own = F.coalesce("parts", F.lit(1))
    dealt = shared.join(checked(parts), "key", "left").select("key", "id", F.pmod(F.xxhash64("id"), own).cast("int").alias("own"), F.explode(F.sequence(F.lit(0), own - 1)).alias("other"))
    dealt = dealt.select("key", "id", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")).join(known, "id")
    held = staged(dealt.select(F.xxhash64("key", "i", "j").alias("meeting"), "id", "line", "first.*"), "meetings")
    rows, size = held.agg(F.count("*"), F.coalesce(F.sum(F.length("line")), F.lit(0))).first()
    meetings = max(16, rows // 50_000, size // (16 << 20))

    def verify(table: pa.Table) -> pa.Table:
        key, ids, doc, h, at = (np.asarray(table.column(c).combine_chunks().fill_null(0)) for c in ("meeting", "id", "doc_id", "h", "at"))
        order = np.lexsort((at, h, doc, ~np.asarray(table.column("doc_id").is_null()), key))
        gone = repeated(table.column("line").take(pa.array(order)).to_pylist(), key[order], threshold)
        return pa.table({"id": pa.array(np.unique(ids[order][gone]))})

    by = F.pmod(F.col("meeting"), F.lit(meetings)).alias("bucket")
    return held.select(by, "*").groupBy("bucket").applyInArrow(verify, "id long").distinct()


def removals(docs: DataFrame, threshold: int = THRESHOLD, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, h, lines): of each document that loses lines, by its row_key(), their numbers from 0."""
    places = staged(_occurrences(docs), "places")
    first = staged(places.groupBy("id", "id2").agg(F.min(F.struct("doc_id", "h", "at")).alias("first"), F.count("*").alias("copies")), "first")
    near = staged(near_lines(docs, first.groupBy("id").agg(F.min("first").alias("first")), threshold, min_chars, places.count()), "near")
    again = first.join(checked(near).withColumn("near", F.lit(True)), "id", "left").where("copies > 1 OR near")
    again = staged(again.select("id", "id2", F.col("first.doc_id").alias("first_id"), F.col("first.h").alias("first_h"), F.col("first.at").alias("first_at"), "near"), "again")
    gone = places.join(again, ["id", "id2"]).where("near OR NOT (doc_id <=> first_id AND h = first_h AND at = first_at)")
    return gone.groupBy("doc_id", "h").agg(F.collect_set("at").alias("lines"))


def deduplicated(docs: DataFrame, threshold: int = THRESHOLD, min_chars: int = MIN_CHARS) -> DataFrame:
    """docs with its repeated and near-repeated lines cut out of `text`, and counts of lines with a word and of lines cut.

    The counts are the last columns, fresh(docs.columns, "__lines", "__removed").
    """
    n_lines, n_removed, doc, h, cut = fresh(docs.columns, "__lines", "__removed", "__doc", "__hash", "__cut")
    gone = staged(removals(docs, threshold, min_chars).toDF(doc, h, cut), "gone")
    own = row_key()
    joined = docs.join(checked(gone, cut), own[0].eqNullSafe(F.col(doc)) & (own[1] == F.col(h)), "left")
    split = r"split(cast(text AS string), '\n', -1)"
    # an array of one list, so that the text is split once and not for each line that stays
    rest = F.expr(rf"transform(array({split}), ls -> array_join(transform(array_except(sequence(0, size(ls) - 1), `{cut}`), i -> ls[i]), '\n'))[0]")
    text = F.when(F.col(cut).isNull(), F.col("text").cast("string")).otherwise(rest)
    count = F.expr(rf"cast(coalesce(size(filter({split}, l -> l rlike '[^\\x20\\x09-\\x0D]')), 0) AS long)")
    return joined.select(*[text.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns], count.alias(n_lines), F.coalesce(F.size(cut), F.lit(0)).cast("long").alias(n_removed))


def op9(spark, sf_dir: str) -> DataFrame:
    """Every document with the text of its remaining lines, its lines with a word and how many of them went."""
    found = deduplicated(docs_of(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "text", F.col("__lines").alias("n_lines"), F.col("__removed").alias("n_removed"))
