from __future__ import annotations

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomstone.functions import text as T


def refs_of(spark, texts):
    df = spark.createDataFrame([(k, x) for k, x in enumerate(texts)], "k int, text string")
    return [{r["number"]: r["ref_kind"] for r in row[1]} for row in df.select("k", T.references(F.col("text"))).orderBy("k").collect()]


def expected(text):
    found = dict.fromkeys(map(int, re.findall(r"(?<![\w/])#(\d+)\b", text or "")), "mentions")
    found |= dict.fromkeys(map(int, re.findall(r"\b(?:close[sd]?|fix(?:e[sd])?|resolve[sd]?)\b[\s:]*#(\d+)", text or "", re.I)), "closes")
    return {k: v for k, v in found.items() if k < 2**63}


CASES = ["Fixes#13", "Fixes #16abc", "foo#14 pull/#15", "#1#2", "fixing #22", "Fixes #12 and #12", "closes #99999999999999999999", "fix\u00a0#5", "é#17 (#3)(#4)", None, "", "Closed: #7, resolves:#8"]


def test_references_follow_the_rules(spark):
    assert refs_of(spark, CASES) == [expected(c) for c in CASES]
    assert refs_of(spark, ["Fixes #16abc"]) == [{16: "closes"}]


def test_references_agree_on_random_texts(spark):
    texts: list[str] = []

    @settings(max_examples=150, database=None, deadline=None)
    @given(st.lists(st.sampled_from(["#", "1", "23", " ", "fix", "Fixes", "closes", ":", "é", "/", "a", "\n", "\u00a0", "(", "resolved"]), max_size=12))
    def collect(parts):
        texts.append("".join(parts))

    collect()
    assert refs_of(spark, texts) == [expected(t) for t in texts]


def one(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize(("text", "want"), [("2024-01-02T03:04:05Z", 1704164645), ("2024-01-02 03:04:05", None), ("2024-13-01T00:00:00Z", None), ("", None), (None, None)])
def test_epoch(spark, text, want):
    assert one(spark, T.epoch(F.lit(text).cast("string"))) == want


@pytest.mark.parametrize(("url", "want"), [("https://h/issues/12", 12), ("https://h/issues/12//", 12), ("https://h/12?x", None), ("h/99999999999999999999", None), (None, None)])
def test_url_number(spark, url, want):
    assert one(spark, T.url_number(F.lit(url).cast("string"))) == want


@pytest.mark.parametrize(("text", "want"), [("  x\t\n", "x"), ("\u00a0\u2003x y\u3000", "x y"), ("", "")])
def test_strip(spark, text, want):
    assert one(spark, T.strip(F.lit(text))) == want == text.strip()


def test_names(spark):
    assert one(spark, T.slug(F.lit("git@github.com:o/r.git"))) == "o/r"
    assert one(spark, T.safe_folder(F.lit("https://github.com/o/my repo!.git"))) == "myrepo"
    assert one(spark, T.version(F.lit("rel_10_2_1"))) == "10.2.1"
    assert one(spark, T.source_path(F.lit("C:\\x\\src\\a\\lib\\B.java"))) == "src/a/lib/B.java"
    assert one(spark, T.repo_relative(F.lit("/w/r/a.java"), "/w/r")) == "a.java"
    assert one(spark, T.tail(F.lit(" abcdef\n"), 3)) == "... [truncated] def"
    assert one(spark, T.tail(F.lit(" abc \n"), 3)) == "abc" and one(spark, T.tail(F.lit(None).cast("string"))) == ""
    assert one(spark, T.is_remote(F.lit("https://h/x"))) and not one(spark, T.is_remote(F.lit("x y")))
    known = ["https://h", "http://h/x y", "https://h/a b", "http://h/", "ssh://git@h:2/x", "ftp://h/x", "https:///x", "https://h h/x", "git@h:o/r", "git@h:", "git@:x", "git@h/x", "git@a b:x", "h/x", "", "https://h/x\n", "git@h:a\tb"]
    for url in known:
        assert one(spark, T.is_remote(F.lit(url))) == (url in ("https://h", "http://h/", "ssh://git@h:2/x", "git@h:o/r")), url
    assert one(spark, T.is_remote(F.lit(None).cast("string"))) is None
    with pytest.raises(Exception, match="dash"):
        one(spark, T.is_remote(F.lit("--upload-pack=x")))


def test_fingerprint_and_percent(spark):
    near = F.array(F.lit("b"), F.lit("a"))
    assert one(spark, T.fingerprint(F.lit("h"), near)) == T.fingerprint_of("h", ["b", "a"])
    assert one(spark, T.fingerprint(F.lit("h"), F.array().cast("array<string>"))) == T.fingerprint_of("h", [])
    assert T.percent(1, 3) == 33.3 and T.percent(0, 0) is None
