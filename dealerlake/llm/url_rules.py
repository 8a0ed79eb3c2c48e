"""URL filters: a sort-merge range join of reversed-host keys, swept with a stack of the rules in force."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows per range, and keys drawn per range to find the ranges' borders.
ROWS_PER_RANGE = 200_000
KEYS_PER_RANGE = 40
#: Keys drawn in all, at most, whatever the size of the table: that many come to the driver, and are sent to every task as borders.
DRAWN = 50_000

_DOT, _END = "\x01", "\x00"


def host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/ ? #``, A-Z lower-cased; empty for null and without ``://``."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """What follows the host up to ``? #``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _key(host: Column) -> Column:
    """Labels of the host from the last, each closed; so a host's key begins the keys of its subdomains."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), _DOT), F.lit(_DOT))


def _ranges(borders: list[tuple[bytes, int]]):
    """URL rows (page, key, host, path, salt) gain the number of their range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [k.encode() for k in batch.column("key").to_pylist()]
            salts = batch.column("salt").to_pylist()
            number = pa.array([bisect_right(borders, pair) for pair in zip(keys, salts)], pa.int32())
            yield pa.RecordBatch.from_arrays([number, *batch.columns], names=["range", *batch.schema.names])

    return run


def _rule_ranges(borders: list[tuple[bytes, int]]):
    """A rule for every range that its interval meets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, number = [], []
            for i, key in enumerate(batch.column("key").to_pylist()):
                low = key.encode()
                high = low[:-1] + bytes([low[-1] + 1])
                first, last = bisect_right(borders, (low, -1)), bisect_right(borders, (high, -1))
                at += [i] * (last - first + 1)
                number += range(first, last + 1)
            taken = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(number, pa.int32()), *taken.columns], names=["range", *batch.schema.names])

    return run


class _Level:
    """The rules of one host that is in force: paths in order, each with the longest other path that begins it."""

    def __init__(self, key: str, host: str):
        self.key, self.host = key, host
        self.paths: list[str] = []
        self.rules: list[tuple[str, str]] = []
        self.outer: list[int] = []

    def add(self, path: str, rule: str, verdict: str) -> None:
        if self.paths and self.paths[-1] == path:
            return  # the first of equal rules stands
        stack = len(self.paths) - 1
        while stack >= 0 and not path.startswith(self.paths[stack]):
            stack = self.outer[stack]
        self.paths.append(path), self.rules.append((rule, verdict)), self.outer.append(stack)

    def longest(self, path: str) -> int:
        at = bisect_right(self.paths, path) - 1
        while at >= 0 and not path.startswith(self.paths[at]):
            at = self.outer[at]
        return at

    def covers(self, host: str) -> bool:
        return host == self.host or host.endswith("." + self.host)


def _sweep(default: str):
    """Rows in the order of (range, key, rules first, path): rules open and close levels, URLs are judged by the open ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, stack = None, []
        for batch in batches:
            page, hosts, paths, rules, verdicts = [], [], [], [], []
            names = ("range", "key", "is_url", "page_id", "host", "path", "rule", "verdict")
            for number, key, is_url, page_id, host, path, rule, verdict in zip(*(batch.column(n).to_pylist() for n in names)):
                if number != here:
                    here, stack = number, []
                while stack and not key.startswith(stack[-1].key):
                    stack.pop()
                if not is_url:
                    if not stack or stack[-1].key != key:
                        stack.append(_Level(key, host))
                    stack[-1].add(path, rule, verdict)
                    continue
                best, found = (-1, -1), (None, default)
                for level in stack:
                    at = level.longest(path)
                    if at >= 0 and level.covers(host):
                        size = (len(level.host) + len(level.paths[at]), len(level.host))
                        if size > best:
                            best, found = size, level.rules[at]
                page.append(page_id), hosts.append(host), paths.append(path), rules.append(found[0]), verdicts.append(found[1])
            yield pa.record_batch(
                [pa.array(page, pa.int64()), pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(rules, pa.string()), pa.array(verdicts, pa.string())],
                names=["page_id", "host", "path", "rule", "verdict"],
            )

    return run


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """One row per row of ``pages`` (page_id, url): page_id, host, path, rule, verdict.

    ``rules`` (host, path, verdict) may be of any number. A rule fits a URL of its host or a subdomain whose path
    starts with the rule's; the longest (host and path, of equal ones the longer host) decides. ``rule`` is its host and
    path. Without a fitting rule it is null and the verdict is ``default``.

    Both sides get keys in which a host's labels stand in reverse, so the URLs of a rule's host and
    its subdomains are one interval. Keys are cut into ranges at borders drawn from the URLs, a bounded number in
    all; equal keys are told apart by a salt, so a busy host is many ranges. A rule goes to
    each range that its interval meets. Each range is then swept in order: the stack holds the hosts
    that enclose the current key, with their paths. Neither side is gathered or broadcast.

    Null URLs and those without ``://`` have an empty host and path, which no rule fits. Rules with a null or
    empty host, one with control characters, or a null path are left out; of several for one host and path the one whose verdict
    sorts first stands. Rows that repeat an id are judged each. Empty tables give an empty one, or defaults only.
    """
    spark = pages.sparkSession
    urls = pages.select(F.col("page_id").cast("long").alias("page_id"), host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    urls = urls.select(_key(F.col("host")).alias("key"), "page_id", "host", "path", F.pmod(F.xxhash64("page_id", "path"), F.lit(1 << 31)).alias("salt"))
    usable = F.col("host").rlike(r"^[^\x00-\x1f]+$") & F.col("path").isNotNull()
    kept = rules.where(usable).select(
        _key(F.lower("host")).alias("key"), F.lower("host").alias("host"), "path", F.concat(F.lower("host"), "path").alias("rule"), "verdict"
    )
    count = pages.count()
    wanted = max(count // ROWS_PER_RANGE, int(spark.conf.get("spark.sql.shuffle.partitions")))
    borders: list[tuple[bytes, int]] = []
    if wanted > 1 and count:
        share = min(1.0, min(wanted * KEYS_PER_RANGE, DRAWN) / count)
        drawn = urls.where(F.pmod(F.xxhash64("page_id", "path", F.lit(1)), F.lit(1 << 40)) < int(share * (1 << 40)) + 1).select("key", "salt")
        keys = sorted((r["key"].encode(), r["salt"]) for r in drawn.limit(4 * DRAWN).collect())
        if keys:
            # With fewer keys than ranges, ranges are longer: they are sorted and swept as streams.
            cuts = min(wanted, len(keys))
            borders = [keys[int(i)] for i in np.linspace(0, len(keys), cuts + 1)[1:-1]]
    columns = ["range", "key", "is_url", "page_id", "host", "path", "rule", "verdict"]
    placed_urls = urls.mapInArrow(_ranges(borders), "range int, key string, page_id long, host string, path string, salt long").select(
        "range", "key", F.lit(True).alias("is_url"), "page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict")
    )
    placed_rules = kept.mapInArrow(_rule_ranges(borders), "range int, key string, host string, path string, rule string, verdict string").select(
        "range", "key", F.lit(False).alias("is_url"), F.lit(None).cast("long").alias("page_id"), "host", "path", "rule", "verdict"
    )
    return (
        placed_urls.union(placed_rules)
        .select(*columns)
        .repartition(max(1, wanted), "range")
        .sortWithinPartitions("range", "key", "is_url", "path", "verdict")
        .mapInArrow(_sweep(default), "page_id long, host string, path string, rule string, verdict string")
    )
