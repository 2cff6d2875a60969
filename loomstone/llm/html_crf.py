"""Main text of web pages: a linear-chain CRF over DOM leaf blocks.

A page is read tag by tag into leaf blocks, runs of inline content between block tags, each with its ancestors' tags and
with what their class and id names speak of. The CRF scores the blocks by these, by text features (words, share of linked
characters, sentence marks) and by their neighbours through its transitions. It is
trained in this process on labelled pages that the generator below writes from many layouts; pages are decoded by Viterbi
in padded numpy batches.

Broken markup is normal: a paragraph ends where a block begins, unknown ends are ignored, a tag cut off by the end of the
page is dropped, a quote that never closes is a character, script and style end at their own end tag only.

Edge cases: null or empty html gives empty text; rows repeat freely; pages of any length and depth are whole, read in time
linear in their length, with no block or feature dropped; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstone.llm.common import chunks, docs_of, texts_of
from loomstone.llm.crf import Crf

BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html iframe legend li main menu nav noscript ol option p pre section select summary table tbody td textarea tfoot th thead title tr ul video".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SKIPPED = frozenset("head title script style noscript template svg iframe textarea select button option video".split())
_NAME, _STOP = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)"), re.compile(r"[>\"']")
_NAMED = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_ENDS = {k: re.compile(rf"</{k}[^>]*(?:>|\Z)", re.I) for k in ("script", "style")}

#: What class and id names speak of: prefixes of their parts.
TOPICS = {
    "content": "content article post entry story body text main hentry prose".split(),
    "nav": "nav menu breadcrumb toc pager pagination tabs skip".split(),
    "ad": "ad ads advert advertisement adsense sponsor sponsored promo banner dfp".split(),
    "comment": "comment comments reply replies respond discussion disqus thread reader".split(),
    "footer": "footer foot copyright legal colophon imprint".split(),
    "header": "header masthead top branding logo site hero".split(),
    "side": "sidebar side aside related recommend recommended widget share social popular trending more rail tags".split(),
    "notice": "cookie cookies consent notice alert popup modal overlay newsletter subscribe gdpr paywall warning toast".split(),
    "form": "form search login signup register contact input".split(),
    "meta": "meta byline author date time caption credit".split(),
}
_HEADINGS = frozenset(f"h{k}" for k in range(1, 7))
_TOPIC_OF = {word: t for t, words in TOPICS.items() for word in words}
#: Block tags and skipped ones that a head may hold; any other ends it, as its own end tag and a body's start are optional.
_IN_HEAD = frozenset("title script style noscript template".split())
_TAGS = ("article", "main", "section", "aside", "nav", "header", "footer", "form", "ul", "ol", "table", "figure", "blockquote", "div", "dialog", "details", "menu", "fieldset")
_OWN = ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "td", "th", "div", "blockquote", "pre", "figcaption", "dd", "dt", "section", "article", "footer", "header", "nav", "label", "body", "summary", "legend", "main", "aside", "form")
#: Feature numbers, dealt out in the order of this list; 0 is padding.
FEATURES = {
    name: k
    for k, name in enumerate(
        [f"in:{t}" for t in _TAGS] + [f"own:{t}" for t in (*_OWN, "?")] + [f"topic:{t}" for t in TOPICS] + [f"own-topic:{t}" for t in TOPICS]
        + [f"words:{b}" for b in range(7)] + [f"links:{b}" for b in range(4)] + [f"marks:{b}" for b in range(3)]
        + ["stop", "copyright", "first", "page-article", "page-main", "in-page-article", "in-page-main", "no-body-tag", "bias"]
        + [f"inside:{t}:{o}" for t in ("article", "main", "content") for o in ("aside", "nav", "header", "footer", "form", "ul", "ad", "comment", "side", "notice", "meta", "plain")], 1,
    )
}


class Block:
    __slots__ = ("linked", "own", "tags", "text", "topics", "own_topics")

    def __init__(self, text: str, linked: int, inner: Open):
        self.text, self.linked = text, linked
        self.own, self.own_topics, self.tags, self.topics = inner.tag, inner.own_topics, inner.tags, inner.topics


class Open:
    """An open tag, with the tags and topics of all that is open there; sets are shared with the tag around it."""

    __slots__ = ("own_topics", "skipped", "tag", "tags", "topics")

    def __init__(self, tag: str, own_topics: frozenset[str], around: Open | None):
        self.tag, self.own_topics = tag, own_topics
        self.tags = around.tags if around and tag in around.tags else (around.tags | {tag} if around else frozenset({tag}))
        self.topics = around.topics if around and own_topics <= around.topics else (around.topics | own_topics if around else own_topics)
        self.skipped = tag in SKIPPED or bool(around and around.skipped)


_NOWHERE = Open("?", frozenset(), None)
_NOWHERE.tags = frozenset()


def topics_of(attributes: str) -> frozenset[str]:
    if "=" not in attributes:
        return frozenset()
    found = set()
    for m in _NAMED.finditer(attributes):
        for part in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", m[2] or m[3] or m[4] or "").lower()):
            if part in _TOPIC_OF:
                found.add(_TOPIC_OF[part])
    return frozenset(found)


def blocks_of(page: str) -> list[Block]:
    """The leaf blocks in page order."""
    blocks: list[Block] = []
    stack = [_NOWHERE]
    opened: Counter[str] = Counter()
    parts: list[str] = []
    linked, in_link, at = 0, 0, 0
    last = {q: page.rfind(q) for q in "\"'"}

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html_lib.unescape("".join(parts)).split())
            if text and not stack[-1].skipped:
                blocks.append(Block(text, linked, stack[-1]))
            parts.clear()
        linked = 0

    def pop() -> None:
        opened[stack.pop().tag] -= 1

    begin = 0  # of text that no tag has ended yet
    while True:
        at = page.find("<", at)
        at = len(page) if at < 0 else at
        m = _NAME.match(page, at)
        if at < len(page) and not m and page[at + 1 : at + 2] not in ("!", "?"):
            at += 1  # a plain less-than sign
            continue
        if stack[-1].tag == "head" and begin < at and not page[begin:at].isspace():
            pop()  # a head holds no text: it has ended before
        if begin < at and not stack[-1].skipped:
            parts.append(page[begin:at])
            linked += at - begin if in_link else 0
        if at == len(page):
            break
        if not m:
            comment = page.startswith("<!--", at)
            end = page.find("-->", at + 4) if comment else page.find(">", at + 2)
            at = begin = len(page) if end < 0 else end + (3 if comment else 1)
            continue
        stop = m.end()
        while (n := _STOP.search(page, stop)) and n.group() != ">":
            stop = page.find(n.group(), n.end()) + 1 if last[n.group()] >= n.end() else n.end()
        attributes, at = page[m.end() : n.start() if n else len(page)], n.end() if n else len(page)
        begin = at
        tag, closing = m[2].lower(), bool(m[1])
        if tag in _ENDS and not closing:
            end = _ENDS[tag].search(page, at)
            at = begin = end.end() if end else len(page)
            continue
        if tag not in BLOCK and tag not in SKIPPED:
            if tag == "br":
                parts.append(" ")
            elif tag == "a":
                in_link = 0 if closing else 1
            continue
        flush()
        in_link = 0
        if closing:
            if opened[tag]:
                while stack[-1].tag != tag:
                    pop()
                pop()
        elif tag not in VOID and not attributes.endswith("/"):
            closes = {"li": ("li",), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr", "td", "th"), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "body": ("head",)}.get(tag, ())
            if stack[-1].tag == "head" and tag not in _IN_HEAD:
                pop()  # nor does it hold this tag
            while stack[-1].tag in ("p", *closes) or tag in _HEADINGS and stack[-1].tag in _HEADINGS:
                pop()
            stack.append(Open(tag, topics_of(attributes), stack[-1]))
            opened[tag] += 1
    flush()
    return blocks


def features_of(blocks: list[Block]) -> list[list[int]]:
    """Feature numbers of each block."""
    out = []
    has_article = any("article" in b.tags for b in blocks)
    has_main = any("main" in b.tags for b in blocks)
    no_part = not (has_article or has_main)
    for k, b in enumerate(blocks):
        words = b.text.count(" ") + 1
        share = b.linked / max(1, len(b.text))
        marks = sum(b.text.count(c) for c in ".!?,;:")
        names = [f"in:{t}" for t in _TAGS if t in b.tags]
        names.append(f"own:{b.own}" if f"own:{b.own}" in FEATURES else "own:?")
        names += [f"topic:{t}" for t in b.topics]
        names += [f"own-topic:{t}" for t in b.own_topics]
        names.append(f"words:{min(6, words.bit_length() - 1)}")
        names.append(f"links:{0 if share == 0 else 1 if share < 0.3 else 2 if share < 0.8 else 3}")
        names.append(f"marks:{min(2, marks)}")
        names.append("bias")
        if b.text[-1] in ".!?":
            names.append("stop")
        if "©" in b.text or "(c)" in b.text:
            names.append("copyright")
        if k == 0:
            names.append("first")
        if no_part:
            names.append("no-body-tag")
        for t in ("article", "main"):
            inside = t in b.tags
            if has_article if t == "article" else has_main:
                names.append(f"page-{t}")
                if inside:
                    names.append(f"in-page-{t}")
        for t, inside in (("article", "article" in b.tags), ("main", "main" in b.tags), ("content", "content" in b.topics)):
            if inside:
                rest = [o for o in ("aside", "nav", "header", "footer", "form", "ul") if o in b.tags] + [o for o in ("ad", "comment", "side", "notice", "meta") if o in b.topics]
                names += [f"inside:{t}:{o}" for o in rest or ("plain",)]
        out.append(sorted({FEATURES[n] for n in names}))
    return out


def padded(features: list[list[int]]) -> np.ndarray:
    """(blocks, slots) as wide as the longest, padded by 0."""
    sizes = np.fromiter(map(len, features), dtype=np.int64, count=len(features))
    out = np.zeros((len(features), int(sizes.max(initial=1))), dtype=np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = [x for f in features for x in f]
    return out


def labelled_pages(seed: int, n: int = 260) -> Iterator[tuple[str, list[str], int]]:
    """Pages in many layouts with the texts of the blocks that are their article, and how many blocks come before it."""
    rng = np.random.default_rng(seed)
    syllables = "th er an re on in es der sch eau ment la ou ba ko mi za ti lo ne".split()

    def words(low: int, high: int) -> str:
        return " ".join("".join(rng.choice(syllables, size=rng.integers(1, 4))) for _ in range(rng.integers(low, high)))

    def sentence(low: int = 3, high: int = 25) -> str:
        return words(low, high).capitalize() + str(rng.choice(list("....!?,")))

    def pick(*options: str) -> str:
        return str(rng.choice(options))

    def links(n_: int) -> str:
        return "".join(f'<li><a href="/{words(1, 2)}">{words(1, 3)}</a></li>' for _ in range(n_))

    def junk_paragraphs() -> str:
        return "".join(f"<p>{sentence(2, 40)}</p>" for _ in range(rng.integers(1, 4)))

    def chrome(kind: str) -> str:
        """A part of a page that is no article."""
        if kind == "nav":
            return pick(f"<nav><ul>{links(5)}</ul></nav>", f'<div class="menu"><ul>{links(4)}</ul></div>', f'<ul id="nav">{links(6)}</ul>', f'<div class="breadcrumbs"><a href="/">{words(1, 2)}</a> » <a href="/x">{words(1, 2)}</a></div>')
        if kind == "header":
            return pick(f"<header><h1>{words(1, 4)}</h1><p>{sentence(2, 8)}</p></header>", f'<div id="header"><div class="logo">{words(1, 3)}</div></div>', f'<header><a href="/">{words(1, 3)}</a></header>', f'<div class="site-header"><h2>{words(1, 4)}</h2><p>{sentence(2, 9)}</p></div>')
        if kind == "ad":
            return pick(f'<div class="ad">{sentence(2, 20)}</div>', f'<div class="ads-banner"><p>{sentence(3, 25)}</p></div>', f'<aside class="sponsored"><p>{sentence(3, 20)}</p></aside>', f'<div class="advert"><a href="/buy">{sentence(3, 12)}</a></div>', f'<section class="promo">{sentence(3, 15)}</section>')
        if kind == "side":
            return pick(f'<aside><h3>{words(1, 4)}</h3>{junk_paragraphs()}</aside>', f'<div class="sidebar"><h3>{words(1, 3)}</h3><ul>{links(4)}</ul>{junk_paragraphs()}</div>', f'<div id="related"><h4>{words(1, 3)}</h4><ul>{links(3)}</ul></div>', f'<div class="widget"><p>{sentence(3, 30)}</p></div>', f'<div class="share">{words(1, 3)} | {words(1, 2)}</div>')
        if kind == "notice":
            return pick(f'<div class="cookie-notice"><p>{sentence(4, 25)}</p><button>{words(1, 2)}</button></div>', f'<div role="alert" class="notice">{sentence(3, 20)}</div>', f'<div id="consent">{sentence(5, 25)}</div>', f'<div class="newsletter"><h3>{words(2, 5)}</h3><p>{sentence(3, 15)}</p></div>', f"<dialog><p>{sentence(3, 20)}</p></dialog>")
        if kind == "form":
            return pick(f'<form><label>{words(1, 4)}</label><input type="text"><p>{sentence(2, 12)}</p><button>{words(1, 2)}</button></form>', f'<form class="search"><input name="q"><p>{words(1, 5)}</p></form>', f'<div class="login"><form><p>{sentence(2, 9)}</p></form></div>')
        if kind == "comments":
            many = "".join(pick(f'<div class="comment"><b>{words(1, 2)}</b><p>{sentence(2, 40)}</p></div>', f'<li class="comment"><p>{sentence(2, 40)}</p></li>') for _ in range(rng.integers(1, 5)))
            return pick(f'<section id="comments"><h2>{words(1, 3)}</h2>{many}</section>', f'<div class="comments"><h3>{words(1, 3)}</h3>{many}</div>', f'<ol class="comment-list">{many}</ol>', f'<div class="discussion"><article class="comment"><p>{sentence(3, 40)}</p></article><article class="reply"><p>{sentence(3, 30)}</p></article></div>')
        return pick(f"<footer>&copy; {words(1, 3)} &middot; {sentence(3, 14)}</footer>", f'<div id="footer"><p>© {words(2, 6)}</p><ul>{links(3)}</ul></div>', f"<footer><p>{sentence(3, 30)}</p><nav>{links(2)}</nav></footer>", f'<div class="copyright">(c) {words(2, 9)}</div>')

    for _ in range(n):
        title, kept, inner = sentence(1, 10), [], ""
        end = pick("</p>", "</p>", "</p>", "")
        if rng.random() < 0.8:
            inner += pick(f"<h1>{title}</h1>", f"<h1>{title}</h1>", f"<header><h1>{title}</h1></header>", f'<h2 class="title">{title}</h2>')
            kept.append(title)
            if rng.random() < 0.25:
                inner += pick(f'<div class="byline">{words(1, 3)}</div>', f'<p class="meta">{words(1, 3)} | {words(1, 2)}</p>')
        for k in range(rng.integers(1, 12)):
            text, draw = " ".join(sentence(1, 25) for _ in range(rng.integers(1, 6))), rng.random()
            if rng.random() < 0.1:
                text = " | ".join(words(1, 3) for _ in range(rng.integers(1, 9)))
            if k == 0 and rng.random() < 0.4:
                text = pick(title, title + " " + text)
                inner += pick(f"<p><b>{text}<br>", f"<p>{text}</p>")
            elif draw < 0.7:
                half = text.rpartition(" ")
                inner += pick(f"<p>{text}{end}", f"<p>{half[0]} <a href='/{words(1, 2)}'>{half[2]}</a>{end}", f"<p>{half[0]} <em>{half[2]}</em>{end}", f"<div>{text}</div>")
            elif draw < 0.78:
                text = words(1, 6).capitalize()
                inner += pick(f"<h2>{text}</h2>", f"<h3>{text}</h3>")
            elif draw < 0.86:
                inner += f"<blockquote><p>{text}</p></blockquote>"
            elif draw < 0.94:
                items = [sentence(2, 14) for _ in range(rng.integers(2, 5))]
                inner += "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
                kept += items
                continue
            else:
                inner += f"<pre>{text}</pre>"
            kept.append(text)
            if rng.random() < 0.12:
                inner += chrome(pick("ad", "side", "notice", "form"))
        if rng.random() < 0.15:
            inner += chrome("comments")
        if rng.random() < 0.1:
            inner += chrome("side")
        body = pick(f"<article>{inner}</article>", f"<article>{inner}</article>", f"<main>{inner}</main>", f"<main><article>{inner}</article></main>", f'<div id="content">{inner}</div>', f'<div class="post">{inner}</div>', f'<div class="entry-content">{inner}</div>', f'<section class="story">{inner}</section>', f'<div class="article-body">{inner}</div>', f"<div>{inner}</div>")
        echo = pick(f'<div class="ad">{title}</div>', f'<div class="promo"><p>{title}</p></div>', f'<div class="menu"><p>{title}</p></div>') if rng.random() < 0.3 else ""
        before = echo + "".join(chrome(k) for k in ("header", "nav", "notice", "ad", "form", "side") if rng.random() < 0.5)
        after = "".join(chrome(k) for k in ("comments", "side", "ad", "form", "nav", "footer", "notice") if rng.random() < 0.45)
        page = f"<!DOCTYPE html><html><head><title>{title}</title><script>var x='<p>{words(1, 3)}</p>';</script></head><body>{before}{body}{after}</body></html>"
        yield (page[: page.index("</article>")] if rng.random() < 0.1 and "</article>" in page[len(before) :] and body.startswith("<article") and "comment" not in inner else page), kept, len(blocks_of(f"<body>{before}"))


def labels_of(blocks: list[Block], kept: list[str], before: int) -> np.ndarray:
    """1 for the blocks that are the article's, matched in order after those before it."""
    label, at = np.zeros(len(blocks), dtype=np.int64), 0
    for k, b in enumerate(blocks):
        if k >= before and at < len(kept) and b.text == kept[at]:
            label[k], at = 1, at + 1
    return label


@cache
def model(seed: int = 3) -> Crf:
    """The CRF, trained once in a process."""
    rows = []
    for page, kept, before in labelled_pages(seed):
        blocks = blocks_of(page)
        rows.append((padded(features_of(blocks)), labels_of(blocks, kept, before)))
    time, slots = max(len(label) for _, label in rows), max(f.shape[1] for f, _ in rows)
    features, labels = np.zeros((len(rows), time, slots), dtype=np.int64), np.zeros((len(rows), time), dtype=np.int64)
    for k, (f, label) in enumerate(rows):
        features[k, : len(f), : f.shape[1]], labels[k, : len(f)] = f, label
    return Crf(len(FEATURES) + 1, 2).train(features, labels, np.array([len(label) for _, label in rows]), rounds=140, penalty=2e-5)


def main_texts(pages: list[str], crf: Crf) -> list[str]:
    """The article of each page, its blocks joined by newlines."""
    parsed = [blocks_of(p) for p in pages]
    sizes = np.array([len(b) for b in parsed], dtype=np.int64)
    out = [""] * len(pages)
    order = [k for k in np.argsort(sizes, kind="stable").tolist() if sizes[k]]
    for a in range(0, len(order), 256):
        who = order[a : a + 256]
        time = int(sizes[who[-1]])
        step = max(1, (1 << 16) // time)
        for b in range(0, len(who), step):
            some = who[b : b + step]
            scores = np.zeros((len(some), time, crf.emit.shape[1]))
            for i, k in enumerate(some):
                features = features_of(parsed[k])
                for c in range(0, len(features), 1 << 14):
                    scores[i, c : c + (1 << 14)][: len(features) - c] = crf.scores(padded(features[c : c + (1 << 14)]))
            labels = crf.viterbi(scores, sizes[some])
            for i, k in enumerate(some):
                out[k] = "\n".join(x.text for x, keep in zip(parsed[k], labels[i].tolist(), strict=False) if keep)
    return out


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of each row."""
    crf = model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, 2):
            texts = main_texts([t.decode() for t in texts_of(chunk.column(2))], crf)
            yield pa.RecordBatch.from_arrays([chunk.column(0), chunk.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    plain = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return plain.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op4(spark, sf_dir: str) -> DataFrame:
    return extract(docs_of(spark, sf_dir, "pages"))
