"""URL filter over a sorted digest array.

Rules are host suffixes with a path prefix. Their 64-bit xxhash keys are one sorted array in a file that each Python
worker maps into memory; a URL's candidate keys (each parent domain with each path prefix that some rule's length
allows) are probed by one vectorised binary search a batch, and a hit counts only if the stored full string is equal.
The longest rule that fits decides. A URL without a rule, or without a host, takes the default verdict.

Edge cases: null, empty or schemeless URLs have empty host and path, no rule and the default verdict; repeated rows are
judged alike; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstone.llm.common import shipped

#: The rules of the production filter: (rule, verdict).
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))

_LOWER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "page_id long, host string, path string, rule string, verdict string"


class DigestArray:
    """Sorted xxhash64 keys with their full strings: columns of keys, of offsets, of a verdict byte, and the strings' bytes in one file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            n, longest = np.frombuffer(f.read(16), dtype="<u8")
        n = int(n)
        self.longest = int(longest)
        self.keys = np.memmap(path, dtype="<u8", mode="r", offset=16, shape=(n,)) if n else np.empty(0, "<u8")
        self.ends = np.memmap(path, dtype="<u8", mode="r", offset=16 + 8 * n, shape=(n + 1,))
        self.verdicts = np.memmap(path, dtype="u1", mode="r", offset=24 + 16 * n, shape=(n,)) if n else np.empty(0, "u1")
        self.bytes = np.memmap(path, dtype="u1", mode="r", offset=24 + 17 * n) if os.path.getsize(path) > 24 + 17 * n else np.empty(0, "u1")

    @staticmethod
    def packed(strings: Iterable[str], digest=lambda b: xxhash.xxh64_intdigest(b), verdicts: dict[str, int] | None = None) -> bytes:
        """The content of the file; strings without a verdict have 0."""
        encoded = sorted({s.encode() for s in strings}, key=lambda b: (digest(b), b))
        head = np.array([len(encoded), max(map(len, encoded), default=0)], "<u8")
        keys, ends = np.array([digest(b) for b in encoded], "<u8"), np.cumsum([0, *map(len, encoded)]).astype("<u8")
        told = bytes((verdicts or {}).get(b.decode(), 0) for b in encoded)
        return b"".join([head.tobytes(), keys.tobytes(), ends.tobytes(), told, *encoded])

    def find(self, probes: list[bytes], digest=lambda b: xxhash.xxh64_intdigest(b)) -> np.ndarray:
        """For each probe the index of its string, or -1. Equal keys lie side by side; each of them is compared."""
        wanted = np.fromiter(map(digest, probes), dtype=np.uint64, count=len(probes))
        at = np.searchsorted(self.keys, wanted)
        found = np.full(len(probes), -1, dtype=np.int64)
        hit = np.flatnonzero(at < len(self.keys))
        hit = hit[self.keys[at[hit]] == wanted[hit]]
        for k in hit.tolist():
            i = int(at[k])
            while i < len(self.keys) and self.keys[i] == wanted[k]:
                if self.bytes[int(self.ends[i]) : int(self.ends[i + 1])].tobytes() == probes[k]:
                    found[k] = i
                    break
                i += 1
        return found


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host: after the first :// up to / ? # or end, A-Z lower-cased; path: then up to ? # or end."""
    _, sep, rest = (url or "").partition("://")
    if not sep:
        return "", ""
    host = re.match(r"[^/?#]*", rest).group()
    return host.translate(_LOWER), re.match(r"[^?#]*", rest[len(host) :]).group()


def _domains(host: str, most: int) -> Iterator[str]:
    """The host and its parent domains, longest first; those of more than `most` characters are left out."""
    if len(host) > most:
        _, _, host = host[len(host) - most - 1 :].partition(".")
    while host:
        yield host
        _, _, host = host.partition(".")


def url_verdicts(pages: DataFrame, rules: Iterable[tuple[str, str]] = RULES, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: host, path, the longest rule that fits or null, and the verdict."""
    spark = pages.sparkSession
    verdicts = dict(rules)
    names = sorted(set(verdicts.values()))  # what tasks carry besides the file: these few, and the lengths of paths
    name = shipped(spark, "rules.digests", DigestArray.packed(verdicts, verdicts={r: names.index(v) for r, v in verdicts.items()}))
    lengths = sorted({len(r) - r.index("/") for r in verdicts}, reverse=True)
    del verdicts

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests = DigestArray(SparkFiles.get(name))
        for batch in batches:
            urls = batch.column(1).to_pylist()
            parts = [host_and_path(u) for u in urls]
            probes, owner = [], []
            for row, (host, path) in enumerate(parts):
                for domain in _domains(host, digests.longest):
                    for n in lengths:
                        if len(path) >= n:
                            probes.append((domain + path[:n]).encode())
                            owner.append(row)
            rule: list[str | None] = [None] * len(urls)
            verdict = [default] * len(urls)
            found = digests.find(probes)
            for k in np.flatnonzero(found >= 0).tolist():
                text, row = probes[k].decode(), owner[k]
                if rule[row] is None or len(text) > len(rule[row]):
                    rule[row], verdict[row] = text, names[digests.verdicts[found[k]]]
            columns = [batch.column(0), pa.array([h for h, _ in parts], pa.string()), pa.array([p for _, p in parts], pa.string()), pa.array(rule, pa.string()), pa.array(verdict, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "host", "path", "rule", "verdict"])

    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url")).mapInArrow(judge, SCHEMA)


#: DuckDB: every rule's fit is a suffix test on dotted hosts and a prefix test on the path.
ORACLE_SQL = r"""
WITH split AS (
  SELECT page_id, CASE WHEN url IS NULL OR position('://' IN url) = 0 THEN NULL ELSE substr(url, position('://' IN url) + 3) END AS rest FROM pages),
parts AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*'), '') AS path
  FROM split),
rules AS (
  SELECT * FROM (VALUES ('net', '/', 'net/', 'block'), ('example.net', '/en/', 'example.net/en/', 'allow'),
    ('example.com', '/de/', 'example.com/de/', 'block'), ('org', '/fr/', 'org/fr/', 'allow')) AS t(domain, prefix, rule, verdict)),
fits AS (
  SELECT p.page_id, p.host, p.path, max_by(r.rule, length(r.rule)) AS rule, max_by(r.verdict, length(r.rule)) AS verdict
  FROM parts p LEFT JOIN rules r ON (p.host = r.domain OR ends_with(p.host, '.' || r.domain)) AND starts_with(p.path, r.prefix)
  GROUP BY p.page_id, p.host, p.path)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits
"""
