"""Operators 11 to 13: against the library, brute force, and their edge cases."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter
from itertools import permutations
from pathlib import Path

import pytest

from loomstone.llm import filter_audit, piece_backtracking, source_divergence
from loomstone.llm.common import docs_of

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
EDGES = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", "", "a", 4), (None, "one two", "en", None, 7), (4, "word", "en", "a", 4), (4, "word", "en", "a", 4), (5, "x" * 300_000, "en", "a", 300_000), (6, "é b. c d.\n" * 40, "fr", "b", 400)]


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# ---------------------------------------------------------------- 11


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=piece_backtracking.default_model())


@pytest.fixture(scope="module")
def pieces():
    return piece_backtracking.Pieces(piece_backtracking.compiled(Path(piece_backtracking.default_model()).read_bytes()))


def test_pieces_are_those_of_the_library(spark, library):
    rng = random.Random(11)
    letters = [*"abcdeeettthhinos  \n\t  ▁▁ABC'\"<>0x\r", *"éßЖ中字🙂\x00\x1c 　ก", "</s>", "<s>", "<unk>", "<0x41>", "the", " ing", "tion", "    "]
    texts = ["".join(rng.choices(letters, k=rng.randrange(60))) for _ in range(2000)] + [None, "", " ", "▁", "\n", "x" * 50_000, " " * 777, "ab" * 3000, *[r["text"] for r in docs_of(spark, SF).collect()]]
    docs = spark.createDataFrame([(k, t, k) for k, t in enumerate(texts)], "doc_id long, text string, ids long")
    found = piece_backtracking.encode(docs)
    for r in found.collect():
        want = library.encode(texts[r["doc_id"]] or "", add_eos=True)
        assert r["ids"] == want and r["n_tokens"] == len(want)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(want).encode()).hexdigest()
    back = {r["doc_id"]: r["text"] for r in piece_backtracking.decode(found).collect()}
    assert all(back[k] == (t or "").replace("▁", " ") for k, t in enumerate(texts))


def test_any_ids_decode_as_in_the_library(pieces, library):
    rng = random.Random(12)
    for _ in range(5000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(3, 259), rng.randrange(3), 28705]) for _ in range(rng.randrange(9))]
        assert pieces.decode(ids).decode() == library.decode(ids), ids


def test_neighbours_decide_the_whole(pieces):
    """A sequence is the merging of its text exactly if each two neighbours are the merging of theirs."""
    rng = random.Random(13)
    for _ in range(500):
        text = piece_backtracking.MARK + "".join(rng.choices("aeinrst", k=rng.randrange(1, 25)))
        whole = piece_backtracking.merged(text, pieces.ranks)
        assert [pieces.texts[t] for t in pieces.backtracked(text)] == whole
    assert any(len(set(text)) for text in pieces.texts) and pieces.backtracked("") == []


def model_of(pieces, **trainer):
    """The bytes of a small model: normal pieces by score, after the unknown, the end and the bytes."""
    import struct

    def number(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    def text(field, raw):
        return number(field << 3 | 2) + number(len(raw)) + raw

    rows = [("<unk>", 0.0, 2), ("</s>", 0.0, 3), *[(f"<0x{b:02X}>", 0.0, 6) for b in range(256)], *[(p, -float(k), 1) for k, p in enumerate(pieces)]]
    entries = [text(1, p.encode()) + number(2 << 3 | 5) + struct.pack("<f", s) + number(3 << 3) + number(k) for p, s, k in rows]
    fixed = {3: 2, 35: 1, 42: 1} | trainer
    return b"".join(text(1, e) for e in entries) + text(2, b"".join(number(f << 3) + number(v) for f, v in fixed.items())) + text(3, number(3 << 3) + number(1) + number(4 << 3) + number(0))


def test_backtracking_takes_pieces_back():
    """The longest piece is wrong here, twice: merging makes b-c first, so a-b never forms."""
    content = model_of(["bc", "ab", "abc▁", "d▁e", "a", "b", "c", "d", "e", "▁"])
    small = piece_backtracking.Pieces(piece_backtracking.compiled(content))
    rng = random.Random(14)
    for text in ["abc", "aabcb", "ababc", *("".join(rng.choices("abcde▁", k=rng.randrange(1, 30))) for _ in range(500))]:
        assert [small.texts[t] for t in small.backtracked(text)] == piece_backtracking.merged(text, small.ranks), text
        parts = [p for block in small.parts(text) for p in block]
        assert "".join(parts) == text and [i for p in parts for i in small.ids_of(p)] == [i for t in small.backtracked(text) for i in small.ids[small.texts[t]]]
    assert small.texts[small.backtracked("abc")[0]] == "a" and "abc▁" not in small.texts
    # where a piece has a mark inside, texts are not cut there
    assert list(small.parts("d▁e▁b")) == [["d▁e", "▁"], ["b"]] and list(small.parts("")) == []
    encoder = piece_backtracking.Encoder(small, limit=2000)
    for text in ("d e d", "x\ny e"):
        assert small.decode(piece_backtracking.np.frombuffer(encoder.encode(text), "<u4").tolist()).decode() == text


def test_cuts_do_not_depend_on_blocks(pieces, monkeypatch):
    text = "▁some▁text\n中文字。▁" * 40
    flat = lambda: [p for block in pieces.parts(text) for p in block]
    whole = flat()
    for size in (1, 2, 7):
        monkeypatch.setattr(piece_backtracking, "BLOCK", size)
        assert flat() == whole and "".join(whole) == text


def test_remembered_parts_are_bounded(pieces):
    encoder = piece_backtracking.Encoder(pieces, limit=3000)
    full = piece_backtracking.Encoder(pieces)
    for k in range(300):
        text = f"word{k} other{k % 7} " + "z" * 90
        assert encoder.encode(text) == full.encode(text)
        assert sum(encoder.cost(p, v) for p, v in encoder.known.items()) == encoder.held <= 3000 + 600
    assert not any(len(p) > piece_backtracking.LONGEST for p in full.known)


def test_models_of_another_kind_are_refused():
    with pytest.raises(ValueError, match="merged pieces"):
        piece_backtracking.read_model(model_of(["a"], **{}).replace(b"\x18\x02\x98\x02\x01", b"\x18\x01\x98\x02\x01"))


def test_pieces_empty(empty):
    assert piece_backtracking.encode(empty).count() == 0 and piece_backtracking.decode(piece_backtracking.encode(empty)).count() == 0


# ---------------------------------------------------------------- 12


def audit_by_hand(docs, labels):
    least, marks = {}, {}
    for d, text, *_ in docs:
        if d is not None:
            least[text or ""] = min(d, least.get(text or "", d))
    for d, q, t in labels:
        good, toxic = marks.get(d, (False, False))
        marks[d] = (good or q == 1, toxic or t == 1)
    rows = []
    for d, text, lang, *_ in docs:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = "".join(
            n for n, bad in zip("ABCDE", (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), bool(re.search(r"[#$%&*|]", t)), d is not None and least[t] < d), strict=True) if bad
        )
        rows.append((lang or "", fails, *(marks.get(d, (False, False)) if d is not None else (False, False))))
    found = {}
    for part in {r[0] for r in rows}:
        own, total = [r for r in rows if r[0] == part], Counter()
        for order in map("".join, permutations("ABCDE")):
            for k, f in enumerate(order):
                here = [r for r in own if f in r[1] and not set(order[:k]) & set(r[1])]
                total[f] += len(here)
                found[part, order, k + 1] = [
                    sum(not set(order[: k + 1]) & set(r[1]) for r in own), len(here), sum(f in r[1] and bool(set(order[:k]) & set(r[1])) for r in own),
                    sum(r[1] == f for r in own), sum(r[2] for r in here), sum(r[3] for r in here),
                ]
        for (p, order, k), v in found.items():
            if p == part:
                v.append(total[order[k - 1]])
    return {k: tuple(v) for k, v in found.items()}


def audited(df):
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")) for r in df.collect()}


def test_filter_audit(spark, monkeypatch):
    rng = random.Random(15)
    pool = [" ".join(rng.choices(["a", "b", "Cc", "d#", "é", *map(str, range(300))], k=rng.choice([3, 150, 260, 500]))) for _ in range(25)] + ["", "AAAA", None, "x\x85y　z" * 250]
    docs = [(rng.choice([None, *range(60)]), rng.choice(pool), rng.choice(["en", "fr", None, ""]), "s", 1) for _ in range(400)] + EDGES
    labels = [(rng.choice([None, *range(70)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(90)]
    df, marks = spark.createDataFrame(docs, DOCS).repartition(7), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    want = audit_by_hand(docs, labels)
    assert audited(filter_audit.audit(df, marks)) == want
    assert audited(filter_audit.audit(df.coalesce(1), marks)) == want
    small = filter_audit.masks
    monkeypatch.setattr(filter_audit, "masks", lambda d: small(d, held=500))  # chains are sent on many times
    assert audited(filter_audit.audit(df, marks)) == want
    least = {}
    for d, t, *_ in docs:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    assert {r[0] for r in filter_audit.copies(df).collect()} == {d for d, t, *_ in docs if d is not None and least[t or ""] < d}


def test_chains_tell_texts_of_one_fingerprint_apart():
    chains, out = filter_audit.Chains(), []
    for text, d in ((b"a", 5), (b"b", 3), (b"a", 2), (b"b", 9), (b"a", 2), (b"a", 7)):
        out += [x[0] for x in chains.meet(1, text, d, "en", {0: 1})]
    assert sorted(out) == [5, 7, 9] and sorted((t, d, m) for _, t, d, _, m in chains.least()) == [(b"a", 2, {0: 2}), (b"b", 3, {0: 1})]


def test_a_hot_group_of_copies_is_routed_once_per_task(spark):
    df = spark.range(20_000, numPartitions=5).selectExpr("id AS doc_id", "'the same text' AS text", "'en' AS lang", "'s' AS source", "13L AS n_chars")
    routed = df.select("doc_id", "lang", "text").rdd.mapPartitions(lambda rows: filter_audit._of_input(rows, filter_audit.HELD))
    assert routed.filter(lambda x: x[1][0] is not None).count() == 5
    assert filter_audit.copies(df).count() == 19_999


def test_filter_audit_edges(spark, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(empty, none).count() == 0
    more = spark.createDataFrame([(1, "a b", "en", 1, 2, 3)], "doc_id long, text string, lang string, mask int, n long, part int")
    assert filter_audit.audit(more, none.selectExpr("*", "1 AS mask")).count() == 600


# ---------------------------------------------------------------- 13


def divergence_by_hand(docs, documents=3, top=200):
    per, seen, groups = {}, {}, set()
    for _, text, lang, source, *_ in docs:
        g = (lang or "", source or "")
        groups.add(g)
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        per.setdefault(g, Counter()).update(terms)
        seen.setdefault(g[0], Counter()).update(set(terms))
    rows = set()
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in seen[lang].items() if n >= documents]
        own = {s: Counter({t: per[lang, s][t] for t in kept}) for la, s in groups if la == lang}
        whole = sum(own.values(), Counter())
        p = lambda c: {t: 1 + 1_000_000_000 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept}
        shares, q = {s: p(c) for s, c in own.items()}, p(whole)
        for s, mine in shares.items():
            pairs = [(o, sum((mine[t] - other[t]) ** 2 // other[t] for t in kept)) for o, other in shares.items() if o != s]
            terms = [(t, (mine[t] - q[t]) ** 2 // q[t]) for t in kept if own[s][t] and mine[t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                for k, (item, value) in enumerate(sorted(found, key=lambda x: (-x[1], x[0].encode())), 1):
                    if part == "pair" or k <= top:
                        rows.add((lang, s, part, item, value, k))
    return rows


@pytest.mark.parametrize("top", [3, 200])
def test_source_divergence(spark, top):
    rng = random.Random(16)
    words = ["a", "B", "b", "É", "é", "zz", "中", "x1y", "=", "=q", "İ", *[f"t{chr(97 + k)}" for k in range(20)]]
    docs = [(k, rng.choice([None, "", " ".join(rng.choices(words, k=rng.randrange(40)))]), rng.choice(["en", "fr", None, ""]), rng.choice(["s", "t", "u", None, "", "é"]), 0) for k in range(150)] + EDGES
    docs += [(900, "only here", "lone", "one", 1), (901, "few", "bare", "x", 1), (902, "more", "bare", "y", 1)]
    df = spark.createDataFrame(docs, DOCS).selectExpr("*", "1 AS term", "2 AS total", "3 AS at", "4 AS word")
    found = source_divergence.audit(df, top=top).collect()
    assert {(r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in found} == divergence_by_hand(docs, top=top)
    assert len(found) == len({(r["lang"], r["source"], r["part"], r["item"]) for r in found})


def test_source_divergence_of_a_hot_source(spark):
    """A source with most rows, and counts so large that their products do not fit in 64 bits."""
    row = spark.sql("SELECT explode(sequence(1, 3)) AS k").selectExpr("cast(k AS long) AS doc_id", "repeat('many ', 4000) || 'rare' AS text", "'en' AS lang", "'hot' AS source", "1L AS n_chars")
    docs = row.unionByName(row.selectExpr("doc_id + 9 AS doc_id", "'rare many' AS text", "lang", "'s' AS source", "n_chars"))
    rows = [tuple(r) for r in docs.collect()]
    assert {tuple(r) for r in source_divergence.audit(docs).select("lang", "source", "part", "item", "value", "rank").collect()} == divergence_by_hand(rows)
    big = spark.range(1).selectExpr(f"{source_divergence._share('4000000000000000000', '5000000000000000000')} AS p").first()[0]
    assert big == 1 + 1_000_000_000 * (4 * 10**18 + 1) // (5 * 10**18)


def test_source_divergence_empty(empty):
    assert source_divergence.audit(empty).count() == 0
