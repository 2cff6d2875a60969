"""Personal data by patterns and by a linear-chain CRF over word shapes.

Four kinds have exact patterns: email, ip, card and phone. The CRF, trained in this process from the small labelled
table below, adds spans that patterns miss: secrets such as access keys, telephone numbers without a plus, spelt-out
addresses. A pattern's span is never changed, and a CRF span that touches one is dropped.

A sequence of the CRF is a whole text, so what announces a secret may stand on the line before it. Texts become arrays of
code points; tokens, their shapes and their scores are computed for those of a chunk of texts at once. A score is the sum
of a few table entries: weights of neighbouring shapes are added up for each pair of shapes beforehand, and cues, which are
rare, only where they are. A token that no path through other labels around it can pay for is decided already (undecided()
tells why that is exact); between such tokens stay short segments, padded into batches for Viterbi. The result is the best
path of each whole text. Patterns are searched in the lines that hold a digit or an at sign: each of them needs one, and none
matches across a line break.

A span of the CRF counts only if it holds a digit or an at sign, spelt out or not: a secret of letters alone is not found.

Edge cases: null counts as empty, without spans; texts of any length are whole, in time linear in their length; rows repeat
freely; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstone.llm.common import chunks, docs_of, texts_of
from loomstone.llm.crf import Crf

KINDS = ("email", "ip", "card", "phone", "secret")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_TRIGGER = re.compile("[0-9@]")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: The labelled table. ~ stands for a word, # for a digit, ` for a number sign, ^ for a capital or digit, % for a hexadecimal digit.
LABELLED = (
    ("~ ~ ~, ~ ~.", ""), ("~ ~ ~ ~ ~ ~ ~ ~.", ""), ("~, ~ ~; ~ (~) ~ - ~: ~!", ""), ("~``` ~$$$ ~&&& ~*** ~%%%.", ""), ("~!! ~!! ~!! ~.!!", ""),
    ("~ | ~ | ~ | ~\n~ | ~", ""), ("~ ## ~ ~ ### ~, ####.", ""), ("~ #.# ~ ##% ~ #,###.## ~", ""), ("~ ####-##-## ~ ##:## ~", ""), ("~ https://~.~.~/~/###?~=~ ~", ""),
    ("(c) #### ~ ~. ~ #.#.# ~", ""), ("~ (##) ~ [#] ~ ~'s ~", ""), ("~ ~ at ~ ~ dot ~ ~", ""), ("~ token ~ key ~ the password ~ ~.", ""), ("~ = ~; ~ = ##", ""),
    ("~ ##th ~ #x# ~ B# ~ a# ~", ""), ("license ~ v# ~ MIT ~", ""), ("~ \"~ ~\" ~ '~' ~", ""), ("~ phone ~ email ~ call ~ ~", ""), ("~ #/# ~ ##-## ~ ~", ""),
    ("~ {~##@~#.~.~} ~ ~", "email"), ("~.##{##@~#.~.~} ~.", "email"), ("~ {~.~@~.~} ~", "email"), ("email: {~@~.~} ~", "email"), ("~ {~ (at) ~ (dot) ~} ~", "email"), ("~ {~ [at] ~ [dot] ~}, ~", "email"),
    ("~ {###.##.##.###} ~ ~", "ip"), ("~ {#.###.##.#}, ~", "ip"), ("~ {##.#.###.##}&&& ~", "ip"), ("~ ~ {###.###.###.###}!! ~", "ip"),
    ("~ {################} ~ ~", "card"), ("~ {#### #### #### ####} ~", "card"), ("~ {####-####-####-####}. ~", "card"), ("~ {################}$$$ ~", "card"), ("~ card {#### ###### #####} ~", "card"),
    ("~ {+# (###) ###-####} ~", "phone"), ("~ {+# (###) ###-####}%%% ~", "phone"), ("~ {(###) ###-####} ~ ~", "phone"), ("tel: {###-###-####} ~", "phone"), ("phone {### ### ####}, ~", "phone"), ("~ {+## ## ########} ~", "phone"), ("call {###.###.####} ~", "phone"), ("Tel. {0### #######} ~", "phone"),
    ('~ token = "{%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%}" ~', "secret"), ('api_key = "{%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%}" ~', "secret"), ("~ {AKIA^^^^^^^^^^^^^^^^} ~", "secret"), ("~ {AKIA^^^^^^^^^^^^^^^^}$$$ ~", "secret"),
    ("secret: {%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%} ~", "secret"), ("~ password={%%%%%%%%%%%%}; ~", "secret"), ("~ token={%%%%%%%%%%%%%%%%%%%%%%%%} ~", "secret"), ("~ a={%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%} ~", "secret"),
    ('~!! TOKEN = "{^^^^^^^^^^^^^^^^^^^^^^^^^^^^^^^^^^^^^^^^}"!! ~!!', "secret"), ('~ KEY="{^^^^^^^^^^^^^^^^^^^^^^^^^^^^^^^^}" ~', "secret"),
)
#: Sentences made from each row of the table, and words that are features of their own.
COPIES, CUES = 12, ("token", "key", "secret", "password", "email", "mail", "tel", "phone", "call", "card", "at", "dot")

_WIDE = 3  # tokens to either side whose shapes are features
_SHAPES = 160
_PAD = 4  # as far as features see
_CLASS = np.full(129, 5, dtype=np.int8)  # 0 space, 1 lower, 2 upper, 3 digit, 4 other letters, 5 symbol
_CLASS[[32, 9, 10, 11, 12, 13]] = 0
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128] = 1, 2, 3, 4
_HEX = np.zeros(129, dtype=bool)
_HEX[[*range(48, 58), *range(97, 103)]] = True


def patterns(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base spans, leftmost and apart within a kind; failing matches are dropped."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append((0, start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    found += addresses(text)
    for m in _CARD.finditer(text):
        if 13 <= m.end() - m.start() and 13 <= len(digits := re.sub("[^0-9]", "", m.group())) <= 19 and luhn(digits):
            found.append((2, *m.span()))
    if "+" in text:
        found += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= sum(c in "0123456789" for c in m.group()) <= 15]
    return found


def addresses(text: str) -> list[tuple[int, int, int]]:
    """Matches of [0-9]+(\\.[0-9]+){3}: the parts of each whole dotted run in fours, so that no run is read twice."""
    found = []
    for m in _DOTTED.finditer(text):
        if m.end() - m.start() < 7:
            continue
        parts, at = m.group().split("."), m.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(x := p.lstrip("0")) <= 3 and int(x or "0") <= 255 for p in four):
                found.append((1, at, end))
            at = end + 1
    return found


def luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def tokens_of(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """start, end, shape, whether glued to the token before, and cue number of each token of an array of code points.

    A token is a run of letters and digits or one symbol. Shapes tell letters by case and length, digits by length,
    mixtures by what they mix and length, and symbols by themselves.
    """
    small = np.minimum(points, 128).astype(np.int64)
    kind = _CLASS[small]
    word = (kind >= 1) & (kind <= 4)
    start_at = (kind != 0) & ~(word & np.concatenate([[False], word[:-1]]))
    start = np.flatnonzero(start_at)
    if not len(start):
        return start, start, start, np.empty(0, bool), start
    is_word = word[start]
    stop = np.concatenate([np.flatnonzero(word & ~np.concatenate([word[1:], [False]])) + 1])
    end = start + 1
    end[is_word] = stop

    def counted(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return total[end] - total[start]

    size = end - start
    digits, upper, hexes = counted(kind == 3), counted(kind == 2), counted(_HEX[small])
    bucket = np.searchsorted(np.array([1, 2, 3, 6, 15]), size)
    case = np.where(upper == 0, 0, np.where(upper == size, 1, np.where((upper == 1) & (kind[start] == 2), 2, 3)))
    letters = case * 6 + bucket
    number = 24 + np.searchsorted(np.array([1, 2, 3, 4, 6, 8, 12, 19]), size)
    mix = 33 + np.where(hexes == size, 0, np.where(upper + digits == size, 1, 2)) * 5 + np.searchsorted(np.array([4, 11, 15, 31]), size)
    symbol = 48 + np.where(small[start] == 128, 0, small[start] - 32)
    shape = np.where(~is_word, symbol, np.where(digits == 0, letters, np.where(digits == size, number, mix)))
    glued = np.concatenate([[False], start[1:] == end[:-1]])
    low = np.where(kind == 2, points + 32, points).astype(np.int64)
    spelt = np.cumsum(low * low * 31 + low * 7)
    spelt = np.concatenate([[0], spelt])
    sums = spelt[end] - spelt[start]
    cue = np.zeros(len(start), dtype=np.int64)
    for k, word_ in enumerate(CUES, 1):
        p = np.array([ord(c) for c in word_], dtype=np.int64)
        cue[(size == len(p)) & (sums == int((p * p * 31 + p * 7).sum()))] = k
    return start, end, shape.astype(np.int64) + 1, glued, cue


def slots_of(shape: np.ndarray, glued: np.ndarray, cue: np.ndarray) -> np.ndarray:
    """Feature numbers (tokens, slots): shapes around with their distance, glue to both sides with the shape, cues before."""
    n = len(shape)
    slots, base = [], 1

    def shifted(x: np.ndarray, by: int) -> np.ndarray:
        out = np.zeros(n, dtype=np.int64)
        if by < 0:
            out[-by:] = x[:by]
        elif by > 0:
            out[:-by] = x[by:]
        else:
            out[:] = x
        return out

    for by in range(-_WIDE, _WIDE + 1):
        slots.append(base + shifted(shape, by))
        base += _SHAPES
    after = shifted(glued.astype(np.int64), 1)
    slots.append(base + shape * 4 + glued * 2 + after)
    base += 4 * _SHAPES
    for by in range(-4, 1):
        slots.append(base + shifted(cue, by))
        base += len(CUES) + 1
    return np.stack(slots, axis=1)


N_FEATURES = 1 + (2 * _WIDE + 1) * _SHAPES + 4 * _SHAPES + 5 * (len(CUES) + 1)


def labelled_texts(seed: int, copies: int = COPIES) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Texts made from the table with their (kind, start, end) spans."""
    rng = np.random.default_rng(seed)
    syllables = ("th", "er", "an", "re", "on", "in", "es", "der", "sch", "eau", "ción", "é", "ment", "la", "ou", "ß", "ba", "ko", "mi", "za")

    def word() -> str:
        made = "".join(rng.choice(syllables, size=rng.integers(1, 5)))
        return made.capitalize() if (case := rng.random()) < 0.15 else made.upper() if case < 0.25 else made

    made = []
    for row, kind in LABELLED:
        for _ in range(copies):
            text, spans, begin = "", [], 0
            for c in row:
                if c == "{":
                    begin = len(text)
                elif c == "}":
                    spans.append((KINDS.index(kind), begin, len(text)))
                elif c == "`":
                    text += "#"
                elif c == "#":
                    text += str(rng.integers(0, 10))
                elif c == "%" and kind == "secret":
                    text += "0123456789abcdef"[rng.integers(0, 16)]
                else:
                    text += word() if c == "~" else "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"[rng.integers(0, 36)] if c == "^" else c
            lead = " ".join(word() for _ in range(rng.integers(0, 5)))
            lead += " " if lead else ""
            made.append((lead + text, [(k, a + len(lead), b + len(lead)) for k, a, b in spans]))
    return made


@cache
def model(seed: int = 5) -> Crf:
    """The CRF, trained once in a process."""
    rows = []
    for text, spans in labelled_texts(seed):
        start, end, *rest = tokens_of(np.frombuffer(text.encode("utf-32-le"), dtype="<u4"))
        label = np.zeros(len(start), dtype=np.int64)
        for kind, a, b in spans:
            label[(start < b) & (end > a)] = kind + 1
        rows.append((slots_of(*rest), label))
    time = max(len(label) for _, label in rows)
    features = np.zeros((len(rows), time, rows[0][0].shape[1]), dtype=np.int64)
    labels = np.zeros((len(rows), time), dtype=np.int64)
    for k, (slots, label) in enumerate(rows):
        features[k, : len(label)], labels[k, : len(label)] = slots, label
    return Crf(N_FEATURES, len(KINDS) + 1).train(features, labels, np.array([len(label) for _, label in rows]), rounds=120)


def undecided(crf: Crf, score: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Tokens that may have another label than 0 in a best path; all others have 0 for certain.

    Setting a whole run of other labels to 0 changes the path's score by no more than the sum of each token's best lead
    over 0, the best inner transition for each but one, and entering and leaving. So a token is decided if no stretch of
    tokens around it has a sum that could make up for that; the best stretch comes from running sums and their minima.
    """
    stay = crf.move[0, 0]
    inner = crf.move[1:, 1:].max() - stay
    enter = max(crf.move[0, 1:].max() - stay, crf.first[1:].max() - crf.first[0])
    leave = max(crf.move[1:, 0].max() - stay, 0.0)
    lead = (score[:, 1:].max(axis=1) - score[:, 0]).astype(np.float64) + inner
    place = np.arange(len(lead)) + np.cumsum(first)
    spread = np.full(int(place[-1]) + 2, -1e6)
    spread[place] = lead
    before = np.concatenate([[0.0], np.cumsum(spread)])
    ending = before[1:] - np.minimum.accumulate(before[:-1])
    starting = np.maximum.accumulate(before[::-1])[::-1][1:] - before[:-1]
    return (ending + starting - spread)[place] > inner - enter - leave - 1e-4


def decode(crf: Crf, score: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Best labels of consecutive token sequences; first marks where each begins."""
    open_ = np.flatnonzero(undecided(crf, score, first))
    labels = np.zeros(len(score), dtype=np.int64)
    if not len(open_):
        return labels
    cuts = np.flatnonzero((np.diff(open_) != 1) | first[open_[1:]]) + 1
    begin = open_[np.concatenate([[0], cuts])]
    size = open_[np.concatenate([cuts - 1, [len(open_) - 1]])] - begin + 1
    order = np.argsort(size, kind="stable")
    ranked, a = size[order], 0
    while a < len(order):  # segments of about one length together, so that little is padding
        many = max(1, (1 << 20) // int(ranked[a]))
        b = min(int(np.searchsorted(ranked, ranked[a] * 3 // 2 + 1, side="right")), a + many)
        w, longest = order[a:b], int(ranked[b - 1])
        at = np.minimum(begin[w][:, None] + np.arange(longest), len(score) - 1)
        enter = np.where(first[begin[w]][:, None], crf.first, crf.move[0])
        past = begin[w] + size[w]
        closed = (past < len(score)) & ~first[np.minimum(past, len(score) - 1)]
        best = crf.viterbi(score[at], size[w], enter, closed[:, None] * crf.move[:, 0])
        inside = np.arange(longest) < size[w][:, None]
        labels[at[inside]] = best[inside]
        a = b
    return labels


class Scorer:
    """Label scores of tokens from sums of weights that are added up beforehand."""

    def __init__(self, crf: Crf):
        weights, n = crf.emit.astype(np.float32), _SHAPES
        at = [weights[1 + k * n : 1 + (k + 1) * n] for k in range(2 * _WIDE + 1)]
        base = 1 + (2 * _WIDE + 1) * n
        cues = weights[base + 4 * n :].reshape(5, len(CUES) + 1, -1)
        self.pairs = [(2 * k - _WIDE, (at[2 * k][:, None] + at[2 * k + 1][None, :]).reshape(n * n, -1)) for k in range(_WIDE)]
        self.last = at[-1]
        self.own = weights[base : base + 4 * n] + cues[:, 0].sum(axis=0)
        self.cues = cues - cues[:, :1]

    def scores(self, shape: np.ndarray, glued: np.ndarray, cue: np.ndarray) -> np.ndarray:
        """Of tokens with _PAD empty places before and after each sequence."""
        n = len(shape)
        wide = np.zeros(n + 2 * _PAD, dtype=np.int64)
        wide[_PAD : _PAD + n] = shape
        both = wide[:-1] * _SHAPES + wide[1:]
        after = np.concatenate([glued[1:], [0]])
        found = np.take(self.own, shape * 4 + glued * 2 + after, axis=0)
        for by, table in self.pairs:
            found += np.take(table, both[_PAD + by : _PAD + by + n], axis=0)
        found += np.take(self.last, wide[_PAD + _WIDE : _PAD + _WIDE + n], axis=0)
        there = np.flatnonzero(cue)
        for k, table in enumerate(self.cues):  # a cue so many tokens before
            to = there + len(self.cues) - 1 - k
            found[to[to < n]] += table[cue[there[to < n]]]
        return found


@cache
def _scorer(seed: int = 5) -> Scorer:
    return Scorer(model(seed))


def crf_spans(texts: list[str], crf: Crf, scorer: Scorer | None = None) -> list[list[tuple[int, int, int]]]:
    """(kind, start, end) that the CRF finds in each text; a span holds a digit or an at sign, a card's digits their checksum."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    lengths = np.array([len(t) + 1 for t in texts])
    points = np.frombuffer("\n".join(texts).encode("utf-32-le"), dtype="<u4")
    start, end, shape, glued, cue = tokens_of(points)
    if not len(start):
        return found
    begins = np.cumsum(lengths) - lengths
    owner = np.searchsorted(begins, start, side="right") - 1
    first = np.concatenate([[True], owner[1:] != owner[:-1]])
    place = np.arange(len(start)) + _PAD * np.cumsum(first)  # empty places between texts, so that none sees another's tokens
    spread = np.zeros((3, int(place[-1]) + 1 + _PAD), dtype=np.int64)
    spread[:, place] = shape, glued, cue
    scores = (scorer or Scorer(crf)).scores(*spread)
    labels = decode(crf, scores[place], first)
    hit = np.flatnonzero(labels)
    if not len(hit):
        return found
    cuts = np.flatnonzero((np.diff(hit) != 1) | (labels[hit[1:]] != labels[hit[:-1]]) | first[hit[1:]]) + 1
    for run in np.split(hit, cuts):
        k = int(owner[run[0]])
        a, b = int(start[run[0]] - begins[k]), int(end[run[-1]] - begins[k])
        piece = texts[k][a:b]
        if labels[run[0]] == 3 and not (13 <= len(digits := re.sub("[^0-9]", "", piece)) <= 19 and luhn(digits)):
            # a card number that fails its checksum is none, but may be several side by side
            found[k] += [(2, a + m.start(), a + m.end()) for m in re.finditer("[0-9]+", piece) if 13 <= len(m.group()) <= 19 and luhn(m.group())]
            continue
        if any(c.isdigit() for c in piece) or "@" in piece or "(at)" in piece or "[at]" in piece:
            found[k].append((int(labels[run[0]]) - 1, a, b))
    return found


def lines_of(text: str) -> Iterator[tuple[int, str]]:
    """(start, line) of each line that a pattern may match in."""
    m = _TRIGGER.search(text)
    while m:
        start, end = text.rfind("\n", 0, m.start()) + 1, text.find("\n", m.end())
        end = len(text) if end < 0 else end
        yield start, text[start:end]
        m = _TRIGGER.search(text, end)


def spans_of(texts: list[str], crf: Crf, scorer: Scorer | None = None) -> list[tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]]:
    """Base spans and added spans of each text."""
    found = []
    for text, extra in zip(texts, crf_spans(texts, crf, scorer), strict=True):
        base = [(kind, start + a, start + b) for start, line in lines_of(text) for kind, a, b in patterns(line)]
        taken = sorted((a, b) for _, a, b in base)
        ends = list(accumulate((b for _, b in taken), max))
        added = []
        for kind, a, b in extra:
            i = bisect_left(taken, (b,))  # spans that begin before b; one of them touches if it ends after a
            if not i or ends[i - 1] <= a:
                added.append((kind, a, b))
        found.append((base, added))
    return found


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone of the base, base_sha256, spans, n_added, n_spans) of each row.

    n_added counts the spans of the CRF, n_spans those of all kinds and both ways.
    """
    crf, scorer = model(), _scorer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            rows = spans_of([t.decode() for t in texts_of(chunk.column(1))], crf, scorer)
            counts = [[sum(k == kind for k, _, _ in base) for base, _ in rows] for kind in range(4)]
            digests = pa.array([hashlib.sha256(_written(base).encode()).hexdigest() for base, _ in rows], pa.string())
            written = pa.array([_written(base + extra) for base, extra in rows], pa.string())
            more = [[len(extra) for _, extra in rows], [len(base) + len(extra) for base, extra in rows]]
            yield pa.RecordBatch.from_arrays([chunk.column(0), *(pa.array(c, pa.int64()) for c in counts), digests, written, *(pa.array(c, pa.int64()) for c in more)], _NAMES)

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long, n_spans long"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


_NAMES = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added", "n_spans"]


def op5(spark, sf_dir: str) -> DataFrame:
    return personal_data(docs_of(spark, sf_dir))
