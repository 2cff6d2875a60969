"""SimHash near-duplicates, linked exactly through vantage-point trees.

Every text gets a fingerprint of 64 bits for each of its `width` words. Distinct fingerprints are then partitioned by
Hamming distance: a tree of vantage points, built from a bounded sample, sends each fingerprint to one owner shard (within
a vantage point's radius or outside), and as a query to every other shard whose side of a radius lies within the threshold
of it, by the triangle inequality. No pair is lost, since of two linked fingerprints each reaches the other's owner shard;
so a query is sent only to shards after its own. A shard that owns too many gets a tree of its own below, and one that too
many queries visit is dealt to several tasks, so a task holds a bounded number of fingerprints however many there are.
Within a shard a smaller vantage-point tree prunes the same way, and only leaves that a query's ball reaches are compared,
as blocks of XOR and bit counts. A shard emits a spanning forest of its links and never the pairs themselves. Components
follow by large-star and small-star steps.

op7 links 64 bits of four-word shingles, repeats included, at 4 differing bits. That finds copies with few changes. The
stage of the corpus pipeline takes near-duplicates of a similarity of 0.8 or more over sets of five-word shingles
(SIMILAR): 256 bits, whose share of differing bits tells the angle between two sets closely enough, at the distance under
which nearly all pairs with a Jaccard similarity of 0.8 lie; and sizes within 0.8 of each other, which such pairs have for
certain. Sizes deal the fingerprints into bands first, of which only neighbours meet.

Growth: with 64 nearly random bits and 4 of them differing, a query meets about 1.7 children at each split, so work grows
as about n ** 1.75. A ball of 48 in 256 bits reaches both sides of nearly every radius; work then grows as the square of a
band's size, at about 2 ns a pair.

Edge cases: null or wordless texts have fingerprint zero and link like others; texts under `shingle` words are one
shingle; each row is judged by its own text, also rows of one doc_id and rows without an id; component_id is the smallest
doc_id of the rows of a component, null if none has one; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstone.llm.common import checked, chunks, docs_of, fresh, row_key, staged, texts_of
from loomstone.llm.components import components

#: Words of a shingle, differing bits of a link, and the seed of the shingles' hash.
SHINGLE, THRESHOLD, SEED = 4, 4, 42
#: Fingerprints that build the upper tree, fingerprints aimed at in a shard, and in a leaf of a shard's tree.
SAMPLE, SHARD, LEAF = 16_384, 30_000, 512
#: Near-duplicates of a similarity of 0.8 or more: five-word shingles as sets, 256 bits, differing bits, ratio of the sizes.
SIMILAR = {"shingle": 5, "threshold": 48, "width": 4, "ratio": 0.8}


def hashes_of(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """XXH64 of each shingle of the words [^\\x20\\x09-\\x0D]+, lower-cased in A-Z and joined by spaces; repeats count."""
    words = text.lower().split()  # bytes: only A-Z change, and only these six characters are white space
    if not words:
        return np.empty(0, dtype=np.uint64)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], dtype=np.uint64)
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    digest, seed = xxhash.xxh64_intdigest, SEED
    return np.array([digest(joined[a : b - 1], seed) for a, b in zip([0, *ends], ends[shingle - 1 :], strict=False)], dtype=np.uint64)


def spread(hashes: np.ndarray, width: int) -> np.ndarray:
    """(n, width) hashes from one each: the first as it is, the others by a finishing permutation of it and their number."""
    out = np.empty((len(hashes), width), dtype=np.uint64)
    out[:, 0] = hashes
    for k in range(1, width):
        x = hashes + np.uint64(k * 0x9E3779B97F4A7C15 % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        out[:, k] = x ^ (x >> np.uint64(31))
    return out


def fingerprint(hashes: np.ndarray, width: int = 1) -> np.ndarray:
    """The words of a fingerprint; a bit is set if it is set in more than half of the hashes."""
    ones = np.zeros(64 * width, dtype=np.int64)
    for a in range(0, len(hashes), 1 << 14):
        block = spread(hashes[a : a + (1 << 14)], width)
        ones += np.unpackbits(block.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, width: int = 1, distinct: bool = False) -> DataFrame:
    """(doc_id, h, size, f0, f1, ...) of every row: its row_key(), its shingles (distinct or all), its fingerprint's words as longs."""
    names = [f"f{k}" for k in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, 2):
            found, sizes = np.zeros((chunk.num_rows, width), dtype=np.uint64), np.zeros(chunk.num_rows, dtype=np.int64)
            for k, text in enumerate(texts_of(chunk.column(2))):
                hashes = hashes_of(text, shingle)
                hashes = np.unique(hashes) if distinct else hashes
                found[k], sizes[k] = fingerprint(hashes, width), len(hashes)
            yield pa.RecordBatch.from_arrays([chunk.column(0), chunk.column(1), pa.array(sizes), *(pa.array(x) for x in found.view(np.int64).T)], ["doc_id", "h", "size", *names])

    doc, h = row_key()
    return docs.select(doc.alias("doc_id"), h.alias("h"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, h long, size long, " + ", ".join(f"{x} long" for x in names))


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of fingerprints whose words are the last axis."""
    out = np.bitwise_count(a[..., 0] ^ b[..., 0]).astype(np.int16)
    for k in range(1, a.shape[-1]):
        out += np.bitwise_count(a[..., k] ^ b[..., k])
    return out


def near(a: np.ndarray, b: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of the pairs of a block against another within the threshold; half of the words leave few to look at further."""
    half = (a.shape[1] + 1) // 2
    i, j = np.nonzero(apart(a[:, None, :half], b[None, :, :half]) <= threshold)
    if half < a.shape[1]:
        good = apart(a[i], b[j]) <= threshold
        i, j = i[good], j[good]
    return i, j


class VantageTree:
    """Nested splits of (n, width) fingerprints by the distance to a vantage point: child 0 within the radius, child 1 outside."""

    def __init__(self, points: np.ndarray, leaf: int, depth: int = 40):
        self.leaves, self.width = 0, points.shape[1]
        self.root = self._split(np.asarray(points, dtype=np.uint64), leaf, depth, np.random.default_rng(7))

    def _split(self, points: np.ndarray, leaf: int, depth: int, rng: np.random.Generator):
        if len(points) > leaf and depth:
            tried = rng.choice(points, size=min(8, len(points)), replace=False)
            among = rng.choice(points, size=min(256, len(points)), replace=False)
            vantage = tried[int(np.argmax([apart(among, v).std() for v in tried]))]
            distance = apart(points, vantage)
            radius = int(np.median(distance))
            inside = distance <= radius
            if inside.all():
                inside = distance < radius
                radius -= 1
            if inside.any() and not inside.all():
                return vantage, radius, self._split(points[inside], leaf, depth - 1, rng), self._split(points[~inside], leaf, depth - 1, rng)
        self.leaves += 1
        return self.leaves - 1

    def grow(self, levels: dict[int, int]) -> None:
        """Leaves become trees of so many levels over vantage points drawn at random, about which half of all points lie."""
        rng = np.random.default_rng(self.leaves)

        def below(leaf: int, more: int):
            if more:
                vantage = rng.integers(0, 1 << 64, self.width, dtype=np.uint64)
                return vantage, 32 * self.width - 1, below(leaf, more - 1), below(-1, more - 1)
            if leaf >= 0:
                return leaf
            self.leaves += 1
            return self.leaves - 1

        def walk(node):
            if isinstance(node, int):
                return below(node, levels.get(node, 0))
            return node[0], node[1], walk(node[2]), walk(node[3])

        self.root = walk(self.root)

    def owners(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each point."""
        return self._visit(points, -1)[1]

    def reached(self, points: np.ndarray, threshold: int = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
        """(index of the point, leaf) for each leaf that the ball around a point may reach."""
        return self._visit(points, threshold)

    def _visit(self, points: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
        found, stack = [], [(self.root, np.arange(len(points)))]
        while stack:
            node, at = stack.pop()
            if not len(at):
                continue
            if isinstance(node, int):
                found.append((at, np.full(len(at), node)))
                continue
            vantage, radius, inner, outer = node
            distance = apart(points[at], vantage).astype(np.int64)
            if threshold < 0:
                stack += [(inner, at[distance <= radius]), (outer, at[distance > radius])]
            else:
                stack += [(inner, at[distance - threshold <= radius]), (outer, at[distance + threshold > radius])]
        at, leaf = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.empty(0, np.int64), np.empty(0, np.int64))
        if threshold < 0:
            order = np.argsort(at)
            at, leaf = at[order], leaf[order]
        return at, leaf


class Forest:
    """Union-find over n points that remembers only the edges that joined two trees."""

    def __init__(self, n: int):
        self.parent = np.arange(n)
        self.edges: list[tuple[int, int]] = []

    def roots(self) -> np.ndarray:
        while True:
            up = self.parent[self.parent]
            if (up == self.parent).all():
                return self.parent
            self.parent = up

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.roots()
        differ = root[a] != root[b]
        for x, y in np.unique(np.stack([root[a[differ]], root[b[differ]]], axis=1), axis=0).tolist():
            while self.parent[x] != x:
                x = int(self.parent[x])
            while self.parent[y] != y:
                y = int(self.parent[y])
            if x != y:
                self.parent[max(x, y)] = min(x, y)
                self.edges.append((x, y))


def forest_of(owned: np.ndarray, queries: np.ndarray, threshold: int = THRESHOLD, leaf: int = LEAF, sizes: np.ndarray | None = None, ratio: float = 0.0, inside: bool = True) -> list[tuple[int, int]]:
    """A spanning forest (as positions in owned followed by queries) of all links that have an owned end.

    sizes: of both in this order, of which linked ones are within the ratio. Without inside, links of two owned ones are left out.
    """
    points = np.concatenate([owned, queries])
    forest = Forest(len(points))
    if not len(owned):
        return []
    tree = VantageTree(owned, leaf)
    home = tree.owners(owned)
    order = np.argsort(home, kind="stable")
    ends = np.searchsorted(home[order], np.arange(tree.leaves + 1))
    asking = np.arange(0 if inside else len(owned), len(points))
    at, to = tree.reached(points[asking], threshold)
    at = asking[at[by := np.argsort(to, kind="stable")]]
    cuts = np.searchsorted(to[by], np.arange(tree.leaves + 1))
    for k in range(tree.leaves):
        members, visitors = order[ends[k] : ends[k + 1]], at[cuts[k] : cuts[k + 1]]
        for a in range(0, len(visitors), 2048):
            for b in range(0, len(members), 512):
                q, p = visitors[a : a + 2048], members[b : b + 512]
                i, j = near(points[q], points[p], threshold)
                linked = q[i] > p[j]  # a pair of owned ones is met from both sides
                if sizes is not None:
                    x, y = sizes[q[i]], sizes[p[j]]
                    linked &= np.minimum(x, y) >= ratio * np.maximum(x, y)
                if linked.any():
                    forest.join(q[i[linked]], p[j[linked]])
    return forest.edges


def links(nodes: DataFrame, threshold: int = THRESHOLD, ratio: float = 0.0, sample: int = SAMPLE, shard: int = SHARD) -> DataFrame:
    """A spanning forest (u, v) of the links between the distinct fingerprints (node, size, f0, ...), named by their nodes."""
    names = [c for c in nodes.columns if c not in ("node", "size")]
    width = len(names)
    # sizes whose ratio is within the bound lie in the same band or in neighbours; a little wider, against rounding
    band = F.floor(F.log(F.greatest("size", F.lit(1))) / float(-np.log(ratio) * 1.000001)) if ratio else F.lit(0)
    nodes = nodes.select("node", "size", band.cast("long").alias("band"), *names)
    n = nodes.groupBy("band").count().agg(F.max("count")).first()[0] or 0
    picked = nodes.select(*names).orderBy(F.xxhash64(*names)).limit(sample).toPandas()[names].to_numpy().astype(np.int64).view(np.uint64).reshape(-1, width)
    tree = VantageTree(picked[np.lexsort(picked.T)], max(16, len(picked) * shard // max(n, 1)))

    def points_of(batch: pa.RecordBatch | pa.Table) -> np.ndarray:
        return np.stack([np.asarray(batch.column(c)).astype(np.int64) for c in names], axis=1).view(np.uint64)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("band"), pa.array(tree.owners(points_of(batch)))], ["band", "leaf"])

    for _ in range(8):  # until no shard owns much more than it should
        held = nodes.mapInArrow(own, "band long, leaf long").groupBy("band", "leaf").count().groupBy("leaf").agg(F.max("count").alias("n")).where(F.col("n") > 2 * shard)
        over = {r[0]: int(r[1]) for r in held.toLocalIterator()}
        if not over:
            break
        tree.grow({leaf: (size // shard).bit_length() for leaf, size in over.items()})

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points, bands = points_of(batch), np.asarray(batch.column("band"))
            home = tree.owners(points)
            at, to = tree.reached(points, threshold)
            in_own = to >= home[at]
            who = np.concatenate([at[in_own], at] if ratio else [at[in_own]])
            leaf = np.concatenate([to[in_own], to] if ratio else [to[in_own]])
            next_band = np.arange(len(who)) >= in_own.sum()
            columns = [pa.array(bands[who] + next_band), pa.array(leaf), pa.array(~next_band & (leaf == home[who])), *(batch.column(c).take(pa.array(who)) for c in ("node", "size", *names))]
            yield pa.RecordBatch.from_arrays(columns, ["band", "leaf", "own", "node", "size", *names])

    fields = ", ".join(f"{c} long" for c in ("node", "size", *names))
    routed = staged(nodes.mapInArrow(route, f"band long, leaf long, own boolean, {fields}"), "routed")
    # queries of a shard in parts that a task can hold; shards without fingerprints of their own need none
    sizes = routed.groupBy("band", "leaf").agg(F.count_if("own").alias("owned"), F.count_if(~F.col("own")).alias("asking")).where("owned > 0")
    sizes = staged(sizes.select("band", "leaf", F.greatest(F.lit(1), F.ceil(F.col("asking") / (8 * shard))).cast("int").alias("parts")), "shards")
    dealt = routed.join(checked(sizes), ["band", "leaf"])
    part = F.when(F.col("own"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(F.pmod(F.xxhash64("node"), "parts").cast("int")))
    dealt = dealt.withColumn("part", F.explode(part))

    def pair(table: pa.Table) -> pa.Table:
        own = np.asarray(table.column("own"))
        order = np.lexsort((np.asarray(table.column("node")), ~own))
        own, points, node, size = own[order], points_of(table)[order], np.asarray(table.column("node"))[order], np.asarray(table.column("size"))[order]
        first = not table.num_rows or table.column("part")[0].as_py() == 0
        edges = forest_of(points[own], points[~own], threshold, sizes=size if ratio else None, ratio=ratio, inside=first)
        edges = np.array(edges, dtype=np.int64).reshape(-1, 2)
        return pa.table({"u": pa.array(node[edges[:, 0]]), "v": pa.array(node[edges[:, 1]])})

    return dealt.groupBy("band", "leaf", "part").applyInArrow(pair, "u long, v long")


def _rooted(docs: DataFrame, shingle: int, threshold: int, width: int, ratio: float) -> DataFrame:
    """(doc_id, h, node, root) of every row: the names of its fingerprint and of the least one that links lead to."""
    prints = fingerprints(docs, shingle, width, distinct=bool(ratio))
    names = [f"f{k}" for k in range(width)]
    keys = [*names, "size"] if ratio else names
    node = F.xxhash64(*keys) if len(keys) > 1 else F.col("f0")
    prints = staged(prints.withColumn("node", node), "fingerprints")
    size = F.col("size") if ratio else F.lit(0).cast("long").alias("size")
    nodes = staged(prints.select("node", size, *names).distinct(), "nodes")
    roots = staged(components(links(nodes, threshold, ratio)).select("node", "root"), "roots")
    return staged(prints.select("doc_id", "h", "node").join(roots, "node", "left").select("doc_id", "h", "node", F.coalesce("root", "node").alias("root")), "rooted")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, threshold: int = THRESHOLD, width: int = 1, ratio: float = 0.0) -> DataFrame:
    """(doc_id, fp, component_id) of every row; fp is its fingerprint, or a hash of one of several words; component_id is
    the smallest doc_id that links lead to."""
    rooted = _rooted(docs, shingle, threshold, width, ratio)
    least = staged(rooted.groupBy("root").agg(F.min("doc_id").alias("component_id")), "named")
    return rooted.join(least, "root").select("doc_id", F.col("node").alias("fp"), "component_id")


def deduplicated(docs: DataFrame, shingle: int = SHINGLE, threshold: int = THRESHOLD, width: int = 1, ratio: float = 0.0) -> DataFrame:
    """docs with one row of each component: that of the smallest doc_id, then of the smallest hash of its text.

    Rows without an id come last, so one of them stays if its whole component has no id. All columns are kept as they are.
    """
    doc, h, copies = fresh(docs.columns, "__doc", "__hash", "__copies")
    rooted = _rooted(docs, shingle, threshold, width, ratio)
    kept = rooted.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "h")).alias("kept")).select("kept.doc_id", "kept.h")
    many = rooted.groupBy("doc_id", "h").agg(F.count("*").alias(copies)).where(F.col(copies) > 1)
    kept = staged(kept.toDF(doc, h).join(many, F.col(doc).eqNullSafe(F.col("doc_id")) & (F.col(h) == F.col("h")), "left").select(doc, h, copies), "kept")
    own = row_key()
    same = own[0].eqNullSafe(F.col(doc)) & (own[1] == F.col(h))
    stays = docs.join(kept.select(doc, h), same, "left_semi")
    repeated = kept.where(F.col(copies).isNotNull()).select(doc, h)
    if repeated.isEmpty():
        return stays
    # rows that are equal in id and text: the first of each
    once = stays.join(repeated, same, "left_anti")
    rest = stays.join(repeated, same).dropDuplicates([doc, h]).select(*[F.col(f"`{c}`") for c in docs.columns])
    return once.unionByName(rest)


def op7(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(docs_of(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
