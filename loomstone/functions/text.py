"""Scalar functions as Column expressions; no Python runs per row.

Patterns carry (?U), since the semantics to match treat letters, digits and white space as Unicode does.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

# Reference patterns and kinds.
BARE = r"(?U)(?<![\w/])#(\d+)\b"
CLOSING = r"(?iU)\b(?:close[sd]?|fix(?:e[sd])?|resolve[sd]?)\b[\s:]*#(\d+)"
CLOSES, MENTIONS, API = "closes", "mentions", "api"

# Timestamps, URL forms, the mark of a shortened output.
TRUNCATED = "... [truncated] "
ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"
SLUG = r"github\.com[:/]+([^/\s]+)/([^/\s]+?)(?:\.git)?/?$"
SCHEMES, GIT_USER = ("http", "https", "ssh"), "git@"


def strip(text: Column) -> Column:
    """Without white space at both ends, all of Unicode's and not only spaces."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def numbers(text: Column, pattern: str) -> Column:
    """Distinct numbers that the pattern's first group names; those beyond 64 bits name nothing."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(1))
    return F.array_distinct(F.filter(F.transform(found, lambda x: x.try_cast("bigint")), lambda x: x.isNotNull()))


def references(text: Column) -> Column:
    """array<struct<number, ref_kind>>: each number that the text names once, closing stronger than mentioning."""
    closes, bare = numbers(text, CLOSING), numbers(text, BARE)

    def of_kind(found: Column, kind: str) -> Column:
        return F.transform(found, lambda n: F.struct(n.alias("number"), F.lit(kind).alias("ref_kind")))

    return F.concat(of_kind(closes, CLOSES), of_kind(F.array_except(bare, closes), MENTIONS))


def epoch(text: Column) -> Column:
    """Seconds since 1970 of exactly YYYY-MM-DDTHH:MM:SSZ, else null."""
    whole = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"), text)
    return F.unix_timestamp(F.try_to_timestamp(whole, F.lit(ISO)))


def iso(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), ISO)


def url_number(url: Column) -> Column:
    """The number that a URL's last segment is, slashes at its end aside; null if it is none."""
    last = F.regexp_extract(F.regexp_replace(url, "/+$", ""), r"([^/]*)$", 1)
    return F.when(last.rlike(r"^\d+$"), last.try_cast("bigint"))


def label_names(labels: Column) -> Column:
    """Names of array<struct<name>>; empty and null ones go."""
    return F.filter(F.transform(labels, lambda x: x["name"]), lambda x: x.isNotNull() & (x != ""))


def label_names_of(raw: Column, field: str = "$.labels") -> Column:
    """Names of a raw item's labels, objects or plain values; false ones (null, empty, 0, false) go."""
    labels = F.from_json(F.get_json_object(raw, field), "array<string>")
    name = lambda x: F.when(x.startswith("{"), F.get_json_object(x, "$.name")).otherwise(x)
    return F.coalesce(F.filter(F.transform(labels, name), lambda x: x.isNotNull() & ~x.isin("", "0", "false")), F.array().cast("array<string>"))


def version(tag: Column) -> Column:
    """The first a.b or a.b.c of a tag whose underscores count as dots; empty if none."""
    return F.regexp_extract(F.replace(tag, F.lit("_"), F.lit(".")), r"(\d+\.\d+(?:\.\d+)?)", 1)


def slug(url: Column) -> Column:
    """owner/repository of a remote's address, null if it has none."""
    return F.when(url.rlike(SLUG), F.concat_ws("/", F.regexp_extract(url, SLUG, 1), F.regexp_extract(url, SLUG, 2)))


def safe_folder(url: Column) -> Column:
    """The last segment without .git, in letters, digits, _ and - only."""
    last = F.regexp_extract(F.regexp_replace(url, "/+$", ""), r"([^/]*)$", 1)
    return F.regexp_replace(F.regexp_replace(last, r"\.git$", ""), r"[^a-zA-Z0-9_\-]", "")


def is_remote(url: Column) -> Column:
    """Whether this is a remote's address: a known scheme and a host, or the git user's host and a path, without blanks.

    One that starts with a dash raises.
    """
    scheme, git = F.substring_index(url, "://", 1), url.startswith(GIT_USER)
    rest = F.when(git, F.substring(url, len(GIT_USER) + 1, 1 << 30)).otherwise(F.substring(url, F.length(scheme) + 4, F.lit(1 << 30)))
    host = F.when(git, F.substring_index(rest, ":", 1)).otherwise(F.substring_index(rest, "/", 1))
    path = F.substring(rest, F.length(host) + 2, F.lit(1 << 30))
    whole = (host != "") & ~host.rlike(r"(?U)\s") & (F.translate(path, " \t\r\n", "") == path)
    told = F.when(git, whole & (path != "")).otherwise(url.contains("://") & scheme.isin(*SCHEMES) & whole)
    return F.when(url.startswith("-"), F.raise_error(F.lit("an address may not start with a dash"))).otherwise(told)


def tail(text: Column, n: int = 500) -> Column:
    """The text without white space at its ends, empty for null; of a longer one the last n characters, told by TRUNCATED."""
    bare = strip(F.coalesce(text, F.lit("")))
    return F.when(F.length(bare) > n, F.concat(F.lit(TRUNCATED), F.right(bare, F.lit(n)))).otherwise(bare)


def normal_path(new: Column, old: Column) -> Column:
    """The new path, else the old one, with forward slashes."""
    return F.replace(F.coalesce(F.nullif(new, F.lit("")), F.nullif(old, F.lit(""))), F.lit("\\"), F.lit("/"))


def old_path(old: Column, change: Column) -> Column:
    """The old path of a rename, else null."""
    return F.when(change == "RENAME", F.replace(old, F.lit("\\"), F.lit("/")))


def repo_relative(path: Column, root: str) -> Column:
    """The path under the root, or as it is."""
    slashed = F.replace(path, F.lit("\\"), F.lit("/"))
    return F.when(slashed.startswith(root.rstrip("/") + "/"), F.substring(slashed, len(root.rstrip("/")) + 2, 1 << 30)).otherwise(slashed)


def source_path(path: Column) -> Column:
    """With forward slashes, cut before the first src/, source/ or lib/."""
    return F.regexp_replace(F.replace(path, F.lit("\\"), F.lit("/")), r"^.*?(src|source|lib)/", "$1/")


def title_and_body(title: Column, body: Column) -> Column:
    return strip(F.concat(F.coalesce(title, F.lit("")), F.lit("\n\n"), F.coalesce(body, F.lit(""))))


def truthy(column: Column) -> Column:
    """Neither null nor zero nor empty."""
    return column.isNotNull() & (column.cast("string") != "") & (column.cast("string") != "0")


def percent(part: int, whole: int) -> float | None:
    """Of the exact binary value, to one decimal, half to even; None of nothing. For summaries of a few rows."""
    return round(part / whole * 100, 1) if whole else None


def fingerprint(head: Column, near: Column) -> Column:
    """Sixteen hex digits that tell a commit set by its head and its sorted further heads."""
    return F.substring(F.sha2(F.array_join(F.concat(F.array(head), F.array_sort(near)), "|"), 256), 1, 16)


def fingerprint_of(head: str, near: list[str]) -> str:
    return hashlib.sha256("|".join([head, *sorted(near)]).encode()).hexdigest()[:16]
