"""Quality classifier: an interpolated modified Kneser-Ney character model of trusted text.

Trusted are documents labelled of good quality and not toxic. Their character n-grams up to ORDER are counted per
language, summed within each batch before they are shuffled; lower orders count distinct left neighbours. Discounts are
those of Chen and Goodman, from the counts of counts. Probabilities come from joins of the count tables that are sharded
by (language, context) and (language, suffix), so no step needs the whole model in one place. What remains is, for each
n-gram, its log probability, and for each context its back-off weight.

A document is scored with the longest n-gram that the model has at each character, and backed off where it has none. It
needs the model of its language only. Documents are read in blocks; a block asks once for each of its distinct n-grams,
packed by bucket of n-grams. What all blocks ask for is made distinct and meets the sharded tables, a level of orders at
a time. The answers go back packed, in the order of the asking, and meet the block's texts, which travel compressed. No
step holds the model, and none depends on its size.

Documents fall into two halves by a hash of their ids. Each half is scored by the model of the other half's trusted text,
so that no document is judged by its own n-grams and trusted perplexities are those of unseen text.

A document is rejected if its perplexity is over the QUANTILE of those of the trusted documents of its language, or if
that of its worst WINDOW characters in a row, anywhere in the text, is over the QUANTILE of theirs: a few strange words
in ordinary prose vanish in the mean. Words that are strange only by how often they come are told by a third measure: how
unlikely it is, by the model's own chances, that so many words of a text begin with the same characters; it has its quantile
too. The quantiles are taken exactly over all trusted documents on a grid of GRID steps per unit of the measures' logarithms.

Characters: every run of white space is one space, except that a run with a line break is one break; ASCII counts as it
is, others fall into 3,968 classes by a hash. Each text begins after ORDER - 1 marks.

Edge cases: null and empty texts have no perplexity and are kept, as are documents of a language without trusted text;
null languages are one language; rows of one doc_id are judged each by its own text, and trusted together; rows without
an id are in a half by their text and never trusted; null labels count as not good; empty tables give empty results;
other columns are kept by accepted(), whatever their names, and not read by classify().
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomstone.llm.common import checked, chunks, docs_of, fresh, row_key, staged, texts_of

#: Characters of an n-gram, the quantile of trusted perplexities that is still good, steps of log perplexity per unit.
#: There are three tests, of the mean, the worst window and the most repeated beginning, so about 4 % of trusted text fail one.
ORDER, QUANTILE, GRID = 5, 0.985, 1000
#: Characters of a window; a strange word is about as long.
WINDOW = 8
#: Chance of a word beginning, at least: what the model hardly knows is not strange for being met twice.
LEAST_CHANCE = 1e-4
#: Text bytes of a block that asks for its n-grams at once, and characters of the input to a bucket of n-grams.
BLOCK, ASKED = 32 << 20, 4 << 20
#: Characters turned into n-grams together; a longer text is a step of its own.
STEP = 1 << 18
_BITS, _MARK = 12, 1
_CLASSES = (1 << _BITS) - 128
_BREAKS, _SPACES = re.compile(r"\s*\n\s*"), re.compile(r"[^\S\n]+")


def grams(texts: list[str], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each character, text after text, and how many each text has.

    Characters are numbers under 4096; the last one of an n-gram is in the lowest bits.
    """
    if len(texts) > 1 and sum(map(len, texts)) > STEP:  # in steps, as the arrays between are several times the result
        ends = np.cumsum([len(t) for t in texts]) // STEP
        cuts = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), len(texts)]
        if len(cuts) > 2:
            codes, sizes = zip(*(grams(texts[a:b], order) for a, b in zip(cuts, cuts[1:], strict=False)), strict=True)
            return np.concatenate(codes), np.concatenate(sizes)
    # no text holds a surrogate, so one before each tells where it begins, and white space runs do not cross it
    plain = _SPACES.sub(" ", _BREAKS.sub("\n", "\ud800".join(["", *texts])))
    points = np.frombuffer(plain.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    begins = np.flatnonzero(points == 0xD800)
    sizes = np.diff(np.append(begins, len(points))) - 1
    points = np.where(points < 128, points, 128 + (points * 2654435761 >> 7) % _CLASSES)
    points[begins] = _MARK
    text = np.repeat(np.arange(len(texts)), sizes + 1)
    padded = np.full(len(points) + len(texts) * (order - 2) + order, _MARK, dtype=np.int64)
    place = np.arange(len(points)) + (text + 1) * (order - 2) if order > 1 else np.arange(len(points))
    padded[place] = points
    at = np.delete(place, begins)
    code = np.zeros(len(at), dtype=np.int64)
    for i in range(order - 1, -1, -1):
        code = code << _BITS | padded[at - i]
    return code, sizes


def suffix(column, order: int):
    """The n-gram of this order without its first character."""
    return column.bitwiseAND((1 << _BITS * (order - 1)) - 1)


def counted(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, gram, n) over all texts of docs (text, lang)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, 0):
            for lang, texts in _by_language(chunk.column(1), chunk.column(0)).items():
                gram, n = np.unique(grams(texts, order)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])

    plain = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    return plain.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def estimate(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """The model (lang, size, gram, logp, back): log probability of each n-gram, log back-off weight as a context.

    logp is null where an entry is a context only (the marks before a text), back where it is no context.
    """
    tables = {order: staged(counted(docs, order), f"counts-{order}")}
    for k in range(order - 1, 0, -1):
        tables[k] = staged(tables[k + 1].groupBy("lang", suffix(F.col("gram"), k + 1).alias("gram")).agg(F.count("*").alias("n")), f"counts-{k}")
    lower, made = None, []
    for k in range(1, order + 1):
        t = tables[k].withColumn("context", F.shiftright("gram", _BITS))
        of = t.groupBy("lang").agg(*[F.count_if(F.col("n") == i).cast("double").alias(f"n{i}") for i in (1, 2, 3, 4)])
        y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))

        def discount(i: int, y=y):
            plain = i - (i + 1) * y * F.try_divide(F.col(f"n{i + 1}"), F.col(f"n{i}"))
            return F.least(F.lit(float(i)), F.greatest(F.lit(0.0), F.coalesce(plain, F.lit(0.5)))).alias(f"d{i}")

        discounts = checked(staged(of.select("lang", *[discount(i) for i in (1, 2, 3)]), "discounts"))
        taken = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        t = t.join(discounts, "lang").withColumn("taken", taken)
        contexts = staged(t.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.sum("taken").alias("free")), f"contexts-{k}")
        t = t.join(contexts, ["lang", "context"])
        if lower is None:
            below = F.lit(1.0 / (1 << _BITS))
        else:
            t = t.join(lower.select("lang", F.col("gram").alias("tail"), F.col("p").alias("below")), (t["lang"] == lower["lang"]) & (suffix(F.col("gram"), k) == F.col("tail"))).drop(lower["lang"])
            below = F.col("below")
        p = (F.col("n") - F.col("taken") + F.col("free") * below) / F.col("total")
        lower = staged(t.select("lang", "gram", p.alias("p")), f"probabilities-{k}")
        made.append(lower.select("lang", F.lit(k).alias("size"), "gram", F.log("p").alias("logp"), F.lit(None).cast("double").alias("back")))
        made.append(contexts.select("lang", F.lit(k - 1).alias("size"), F.col("context").alias("gram"), F.lit(None).cast("double"), F.log(F.greatest(F.col("free"), F.lit(1e-9)) / F.col("total"))))
    both = made[0]
    for more in made[1:]:
        both = both.unionByName(more.toDF("lang", "size", "gram", "logp", "back"))
    return staged(both.groupBy("lang", "size", "gram").agg(F.max("logp").alias("logp"), F.max("back").alias("back")), "model")


def _by_language(langs: pa.Array, texts: pa.Array) -> dict[str, list[str]]:
    """The texts of each language, in order."""
    held: dict[str, list[str]] = {}
    for lang, text in zip(langs.to_pylist(), texts_of(texts), strict=True):
        held.setdefault(lang or "", []).append(text.decode())
    return held


def worst_and_mean(logp: np.ndarray, sizes: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Perplexity and worst window of each text, from the log probabilities of all their characters in a row; NaN if empty."""
    upto = np.concatenate([[0.0], np.cumsum(logp)])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    with np.errstate(invalid="ignore"):
        mean = np.exp(-(upto[ends] - upto[starts]) / sizes)
    wide = np.full(len(logp) + 1, np.inf)  # by the first character of a window; the last place is nobody's
    n = max(0, len(logp) - window + 1)
    wide[:n] = (upto[window:] - upto[:-window])[:n] / window
    left = np.repeat(ends, sizes) - np.arange(len(logp))
    wide[:-1][left < window] = np.inf
    worst = mean.copy()
    long = np.flatnonzero(sizes >= window)
    if len(long):
        cuts = np.stack([starts[long], ends[long]], axis=1).ravel()
        worst[long] = np.exp(-np.minimum.reduceat(wide, cuts)[::2])
    return mean, worst


def bursts(code: np.ndarray, logp: np.ndarray, sizes: np.ndarray, order: int = ORDER) -> np.ndarray:
    """How strange the most repeated word beginning of each text is: 1 where none is repeated more often than the model has it.

    A beginning is the first `order` characters of a longer word. The model gives the chance of each where it stands; of n words
    about n times their mean chance should begin so. The value is 1 plus the negative log of the Poisson probability of the
    number that do. code and logp are those of all characters in a row, the n-gram that ends at each and its log probability.
    """
    found, total = np.ones(len(sizes)), len(code)
    if not total:
        return found
    char = code & (1 << _BITS) - 1
    space = (char == 32) | (char == 10)
    strange_letter = ~((char >= 128) | (char >= 65) & (char <= 90) | (char >= 97) & (char <= 122))
    ends = np.cumsum(sizes)
    text = np.repeat(np.arange(len(sizes)), sizes)
    first = np.concatenate([[True], space[:-1] | (text[1:] != text[:-1])]) & ~space
    words = np.bincount(text[first], minlength=len(sizes))
    others = np.concatenate([[0], np.cumsum(strange_letter)])
    at = np.flatnonzero(first)
    at = at[at + order < ends[text[at]]]
    at = at[others[at + order + 1] == others[at]]
    if not len(at):
        return found
    upto = np.concatenate([[0.0], np.cumsum(logp)])
    chance = np.exp(upto[at + order] - upto[at])
    by = np.lexsort((code[at + order - 1], text[at]))
    key, owner = code[at + order - 1][by], text[at][by]
    starts = np.flatnonzero(np.concatenate([[True], (np.diff(key) != 0) | (np.diff(owner) != 0)]))
    n = np.diff(np.append(starts, len(by)))
    due = words[owner[starts]] * np.maximum(np.add.reduceat(chance[by], starts) / n, LEAST_CHANCE)
    faculty = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, n.max() + 1)))])
    strange = np.where(n > due, due - n * np.log(due) + faculty[n], 0.0)
    np.maximum.at(found, owner[starts], 1 + np.maximum(strange, 0.0))
    return found


def _buckets_of(gram: np.ndarray, buckets: int) -> np.ndarray:
    """By all but the last two characters, so that sorted n-grams of a bucket are close to each other."""
    return (((gram >> 2 * _BITS).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(buckets)).astype(np.int32)


def _packed(gram: np.ndarray) -> bytes:
    """Sorted n-grams as compressed planes of the bytes of their differences."""
    return zlib.compress(np.diff(gram, prepend=0).astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes(), 6)


def _unpacked(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(blob), dtype=np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<i8").ravel())


def _blocks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[int, pa.RecordBatch | None]]:
    """(block, rows) of a task's input, and (block, None) where a block ends. The same rows make the same blocks."""
    block, size = TaskContext.get().partitionId() << 32, 0
    for chunk in chunks(batches, 2, 2 << 20):
        yield block, chunk
        size += chunk.column(2).nbytes
        if size >= limit:
            yield block, None
            block, size = block + 1, 0
    yield block, None


def perplexities(docs: DataFrame, model: DataFrame, order: int = ORDER, block: int = BLOCK) -> DataFrame:
    """docs (doc_id, h, lang, text) as (doc_id, h, lang, ppl, worst, burst); docs must read the same again, as files do.

    ppl is exp of the mean negative log probability of a character, worst the greatest of those of WINDOW characters in a row,
    burst tells of the most repeated word beginning, see bursts().
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), F.col("text").cast("string"), F.col("h"))
    chars = docs.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    buckets = max(64, chars // ASKED)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        for number, chunk in _blocks(batches, block):
            if chunk is not None:
                for lang, texts in _by_language(chunk.column(1), chunk.column(2)).items():
                    known = held.setdefault(lang, [])
                    known.append(pd.unique(grams(texts, order)[0]))
                    if len(known) == 8:
                        held[lang] = [pd.unique(np.concatenate(known))]
                continue
            for lang, parts in sorted(held.items()):
                gram = np.unique(np.concatenate(parts))
                bucket = _buckets_of(gram, buckets)
                by = np.argsort(bucket, kind="stable")
                some, starts = np.unique(bucket[by], return_index=True)
                blobs = [_packed(x) for x in np.split(gram[by], starts[1:])] if len(some) else []
                yield pa.RecordBatch.from_arrays([pa.array([number] * len(some), pa.int64()), pa.array([lang] * len(some), pa.string()), pa.array(some), pa.array(blobs, pa.binary())], ["block", "lang", "bucket", "grams"])
            held.clear()

    asks = staged(docs.mapInArrow(ask, "block long, lang string, bucket int, grams binary").join(checked(staged(model.select("lang").distinct(), "languages")), "lang", "left_semi"), "asks")

    def needed(table: pa.Table) -> pa.Table:
        named, blobs = table.column("lang").to_pylist(), table.column("grams").to_pylist()
        own = {x: np.unique(np.concatenate([_unpacked(g) for y, g in zip(named, blobs, strict=True) if y == x])) for x in sorted(set(named))}
        lang = pa.array([x for x, gram in own.items() for _ in range(len(gram))], pa.string())
        return pa.table({"bucket": pa.array([table.column("bucket")[0].as_py()] * len(lang), pa.int32()), "lang": lang, "gram": pa.array(np.concatenate(list(own.values())))})

    left = asks.groupBy("bucket").applyInArrow(needed, "bucket int, lang string, gram long").withColumn("over", F.lit(0.0))
    found = []
    for k in range(order, 0, -1):
        entries = model.where(f"size = {k} AND logp IS NOT NULL").select("lang", F.col("gram").alias("tail"), "logp")
        tried = staged(left.withColumn("tail", suffix(F.col("gram"), k + 1)).join(entries, ["lang", "tail"], "left"), f"tried-{k}")
        found.append(tried.where("logp IS NOT NULL").select("bucket", "lang", "gram", (F.col("over") + F.col("logp")).alias("logp")))
        contexts = model.where(f"size = {k - 1} AND back IS NOT NULL").select("lang", F.col("gram").alias("context"), "back")
        missed = tried.where("logp IS NULL").withColumn("context", F.shiftright("tail", _BITS)).join(contexts if k > 1 else checked(contexts), ["lang", "context"], "left")
        left = missed.select("bucket", "lang", "gram", (F.col("over") + F.coalesce("back", F.lit(0.0))).alias("over"))
    scored = left.select("bucket", "lang", "gram", (F.col("over") - _BITS * float(np.log(2))).alias("logp"))
    for more in found:
        scored = scored.unionByName(more)

    def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
        lang, gram, logp = np.array(known.column("lang").to_pylist(), dtype=object), known.column("gram").to_numpy(), known.column("logp").to_numpy().astype("<f4")
        held = {}
        for x in sorted(set(lang)):
            by = np.flatnonzero(lang == x)
            by = by[np.argsort(gram[by])]
            held[x] = gram[by], logp[by]
        out = []
        for x, blob in zip(asked.column("lang").to_pylist(), asked.column("grams").to_pylist(), strict=True):
            out.append(held[x][1][np.searchsorted(held[x][0], _unpacked(blob))].tobytes())
        return pa.table({"block": asked.column("block"), "lang": asked.column("lang"), "grams": asked.column("grams"), "logps": pa.array(out, pa.binary())})

    answers = asks.groupBy("bucket").cogroup(scored.groupBy("bucket")).applyInArrow(answer, "block long, lang string, grams binary, logps binary")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6))
        for number, chunk in _blocks(batches, block):
            if chunk is not None:
                out = pa.BufferOutputStream()
                with pa.ipc.new_stream(out, chunk.schema, options=options) as writer:
                    writer.write_batch(chunk)
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([out.getvalue().to_pybytes()], pa.binary())], ["block", "rows"])

    def meet(rows: pa.Table, known: pa.Table) -> pa.Table:
        told: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        for lang, blob, logp in zip(*(known.column(c).to_pylist() for c in ("lang", "grams", "logps")), strict=True):
            told.setdefault(lang, []).append((_unpacked(blob), np.frombuffer(logp, dtype="<f4")))
        logps = {}
        for lang, parts in told.items():
            gram, logp = (np.concatenate(x) for x in zip(*parts, strict=True))
            by = np.argsort(gram)
            logps[lang] = gram[by], logp[by].astype(float)
        del told
        found = []
        for blob in rows.column("rows").to_pylist():
            for part in pa.ipc.open_stream(blob):
                values, langs = np.full((3, part.num_rows), np.nan), np.array([x or "" for x in part.column(1).to_pylist()], dtype=object)
                for lang, texts in _by_language(part.column(1), part.column(2)).items():
                    code, sizes = grams(texts, order)
                    if lang not in logps or not len(code):
                        continue
                    place, own = pd.factorize(code)
                    gram, logp = logps[lang]
                    at = np.minimum(np.searchsorted(gram, own), len(gram) - 1)
                    if (gram[at] != own).any():
                        raise RuntimeError("the documents of a block are not those that it asked for")
                    own_logp = logp[at][place]
                    values[:, langs == lang] = *worst_and_mean(own_logp, sizes), np.where(sizes > 0, bursts(code, own_logp, sizes, order), np.nan)
                scores = [pa.array(x, from_pandas=True) for x in values]
                found.append(pa.RecordBatch.from_arrays([part.column(0), part.column(3), part.column(1), *scores], ["doc_id", "h", "lang", "ppl", "worst", "burst"]))
        return pa.Table.from_batches(found, pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("lang", pa.string()), ("ppl", pa.float64()), ("worst", pa.float64()), ("burst", pa.float64())]))

    packed = docs.mapInArrow(pack, "block long, rows binary")
    return packed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(meet, "doc_id long, h long, lang string, ppl double, worst double, burst double")


def trusted(labels: DataFrame) -> DataFrame:
    """Ids of documents whose labels all say good quality and none toxic."""
    said = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(F.coalesce("quality", F.lit(0))).alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t"))
    return said.where("q = 1 AND t = 0").select("doc_id")


def _judged(docs: DataFrame, labels: DataFrame, order: int, quantile: float) -> DataFrame:
    """classify() with h, the hash of each row's text."""
    doc, h = row_key()
    docs = docs.select(doc.alias("doc_id"), h.alias("h"), F.col("text").cast("string"), F.col("lang").cast("string"))
    good = checked(staged(trusted(labels), "trusted"))
    fold = F.abs(F.xxhash64(F.coalesce("doc_id", "h")) % 2)
    key = lambda half: F.concat(half.cast("string"), F.lit(":"), F.coalesce("lang", F.lit("")))
    model = estimate(docs.join(good, "doc_id", "left_semi").withColumn("lang", key(1 - fold)), order)
    scores = staged(perplexities(docs.withColumn("lang", key(fold)), model, order), "perplexities")
    scores = scores.withColumn("lang", F.substring("lang", 3, 1 << 30))
    both = "stack(3, 'ppl', ppl, 'worst', worst, 'burst', burst) AS (of, value)"
    bins = scores.join(good, "doc_id", "left_semi").where("ppl IS NOT NULL").selectExpr("lang", both).groupBy("lang", "of", F.ceil(F.log("value") * GRID).alias("bin")).agg(F.count("*").alias("n"))
    by_lang = Window.partitionBy("lang", "of")
    upto = bins.withColumn("upto", F.sum("n").over(by_lang.orderBy("bin"))).withColumn("all", F.sum("n").over(by_lang))
    limit = lambda of: F.exp(F.min(F.when(F.col("of") == of, F.col("bin"))) / GRID)
    limits = upto.where(F.col("upto") >= quantile * F.col("all")).groupBy("lang").agg(limit("ppl").alias("threshold"), limit("worst").alias("worst_threshold"), limit("burst").alias("burst_threshold"))
    found = scores.join(checked(staged(limits, "limits")), "lang", "left")
    kept = (F.col("ppl") <= F.col("threshold")) & (F.col("worst") <= F.col("worst_threshold")) & (F.col("burst") <= F.col("burst_threshold"))
    return found.select("doc_id", "h", F.col("ppl").alias("perplexity"), "threshold", F.col("worst").alias("worst_window"), "worst_threshold", "burst", "burst_threshold", F.coalesce(kept, F.lit(True)).alias("kept"))


def classify(docs: DataFrame, labels: DataFrame, order: int = ORDER, quantile: float = QUANTILE) -> DataFrame:
    """(doc_id, perplexity, threshold, worst_window, worst_threshold, burst, burst_threshold, kept) of each row of docs (doc_id, text, lang)."""
    return _judged(docs, labels, order, quantile).drop("h")


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without the rejected rows; rows that are equal in id and text go together if one of them is rejected."""
    doc, h = fresh(docs.columns, "__doc", "__hash")
    gone = staged(_judged(docs, labels, ORDER, QUANTILE).where("NOT kept").select(F.col("doc_id").alias(doc), F.col("h").alias(h)).distinct(), "rejected")
    own = row_key()
    return docs.join(checked(gone), own[0].eqNullSafe(F.col(doc)) & (own[1] == F.col(h)), "left_anti")


def op3(spark, sf_dir: str) -> DataFrame:
    return classify(docs_of(spark, sf_dir), docs_of(spark, sf_dir, "labels"))
