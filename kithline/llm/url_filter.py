"""Operator 2: URL filters by a sort-merge range join.

A host is written from its last label to its first, each closed by a dot ("org.example.blog."), so the
hosts of a rule are one interval of that order, and the intervals of rules nest. URLs are cut into
ranges of the order of (host, path, id) - a busy host is cut too -, a rule is sent to each range that
its interval meets, and one sweep over a sorted range keeps the rules' hosts that hold the present one on
a stack. Of the rules on the stack whose path begins the URL's path, the longest (host and path
together, then the longer host) gives the verdict; without any, it is `default`.

The ranges' borders are read off a hashed share of the keys, about 16 for each range and so 65,536 in
all at most; they only say where a row is worked on. A group has about RANGE rows, however many URLs
there are: beyond MOST_RANGES * RANGE of them the rows of a range are dealt to several groups by hash,
each with the range's rules.

Defined cases: host and path of a null URL, or one without "://", are empty (no rule fits them unless
its host is empty); equal rules with both verdicts block; repeated rows are judged alike; further
columns are not carried.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow

RANGE, MOST_RANGES = 20_000, 4_096
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_END = "\U0010ffff"


def with_host_and_path(df: DataFrame, url: str = "url") -> DataFrame:
    """df with host (A-Z lower-cased) and path of url."""
    rest = F.when(F.instr(url, "://") > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return df.withColumns({"host": F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER), "path": F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)})


def _reversed(host: str):
    return F.concat(F.concat_ws(".", F.reverse(F.split(host, r"\."))), F.lit("."))


def _sweep(urls: pd.DataFrame, rules: pd.DataFrame) -> pd.DataFrame:
    """Rule and verdict of each URL of one range."""
    hosts: dict[str, dict[str, tuple[str, str]]] = {}
    for key, path, name, verdict in zip(rules["key"], rules["path"], rules["rule"], rules["verdict"], strict=True):
        hosts.setdefault(key, {}).setdefault(path, (name, verdict))
        if verdict == "block":
            hosts[key][path] = (name, verdict)
    starts = [(key, by_path, sorted({len(p) for p in by_path}, reverse=True)) for key, by_path in sorted(hosts.items())]
    urls = urls.sort_values(["key", "path"], kind="stable")
    stack: list[tuple] = []
    at, found, last = 0, [], None
    for key, path in zip(urls["key"], urls["path"], strict=True):
        if (key, path) == last:
            found.append(found[-1])
            continue
        last = key, path
        while at < len(starts) and starts[at][0] <= key:
            while stack and not starts[at][0].startswith(stack[-1][0]):
                stack.pop()
            stack.append(starts[at])
            at += 1
        while stack and not key.startswith(stack[-1][0]):
            stack.pop()
        best, size = None, -1
        for host, by_path, lengths in reversed(stack):
            for n in lengths:
                if n <= len(path) and (rule := by_path.get(path[:n])):
                    if len(host) + n > size:
                        best, size = rule, len(host) + n
                    break
        found.append(best)
    return urls.assign(rule=[f and f[0] for f in found], verdict=[f and f[1] for f in found])


def judge_urls(df: DataFrame, rules: DataFrame, default: str = "allow", key: str = "page_id", url: str = "url") -> DataFrame:
    """key, host, path, rule ("host" + "path", null if none fits) and verdict of every row. rules: host, path, verdict."""
    rows = with_host_and_path(df.select(F.col(key).alias("id"), F.col(url).alias("url"))).select("id", "host", "path", _reversed("host").alias("key"))
    rows = rows.withColumn("place", F.concat_ws("\x00", "key", "path", F.xxhash64("id").cast("string")))
    n = rows.count()
    n_ranges = max(1, min(MOST_RANGES, -(-n // RANGE)))
    deal = -(-n // (n_ranges * RANGE))
    part = min(1.0, 16 * n_ranges / max(n, 1))
    some = rows.where(F.pmod(F.xxhash64("place"), F.lit(1 << 30)) < int(part * (1 << 30)) + 1).select("place")
    keys = sorted(r.place for r in some.collect())
    borders = sorted({keys[i * len(keys) // n_ranges] for i in range(1, n_ranges)}) if keys else []

    def to_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            place = b.column(4).to_pylist()
            yield arrow(["range", "id", "host", "path", "key"], [pa.array([bisect_right(borders, x) * deal + hash_ % deal for x, hash_ in zip(place, b.column(5).to_pylist(), strict=True)], pa.int32()), *b.columns[:4]])

    def to_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, path, name, verdict in zip(*(c.to_pylist() for c in b.columns), strict=True):
                met = range(bisect_right(borders, k) * deal, (bisect_right(borders, k + _END) + 1) * deal)
                yield arrow(["range", "key", "path", "rule", "verdict"], [pa.array(met, pa.int32()), *(pa.array([x] * len(met), pa.string()) for x in (k, path, name, verdict))])

    kind = rows.schema["id"].dataType.simpleString()
    dealt = rows.withColumn("deal", F.xxhash64("place")).mapInArrow(to_range, f"range int, id {kind}, host string, path string, key string")
    host = F.translate(F.coalesce(F.col("host").cast("string"), F.lit("")), UPPER, LOWER)
    asked = rules.select(host.alias("host"), F.coalesce("path", F.lit("")).alias("path"), F.col("verdict").cast("string").alias("verdict")).distinct()
    asked = asked.select(_reversed("host").alias("key"), "path", F.concat("host", "path").alias("rule"), "verdict")
    asked = asked.mapInArrow(to_ranges, "range int, key string, path string, rule string, verdict string")

    def merge(_, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _sweep(left, right)[["id", "host", "path", "rule", "verdict"]]

    out = dealt.groupBy("range").cogroup(asked.groupBy("range")).applyInPandas(merge, f"id {kind}, host string, path string, rule string, verdict string")
    return out.select(F.col("id").alias(key), "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
