"""Operator 12: allow and block rules for urls, by a trie over host labels and path segments.

A rule is a host and a path.  It fits its host and all subdomains, if the url's path starts
with the rule's path.  The trie's first part branches on the labels of the host from the last
to the first; a node where rules end has a second trie that branches on the path's segments,
whose last segment may be part of the url's.  Of the rules that fit, the longest (characters
of host and path) decides; of two equally long ones that with the longer host; of one host and
path in both lists the block entry.  An url that no rule fits gets the method's default.

The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z in
lower case (port and user stay part of it); the path goes on up to ``?``, ``#`` or the end.

The trie is broadcast if the rules' count and text are within ``BROADCAST_RULES`` and
``BROADCAST_BYTES``, which is measured first.  A larger table of rules is joined instead: each
host's parent domains meet the lengths of the rules' paths there, then the url's path cut to
these lengths meets the rules.  Both ways return the same rows.

Defined results: a null url, or one without ``://``, has an empty host and path, which no rule
fits.  Rules with a null or empty host fit nothing, a null path is the empty path, and an action
other than allow and block is an error.  Repeated rows are judged each on its own.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import per_worker

BROADCAST_RULES, BROADCAST_BYTES = 500_000, 32 << 20
MADE = ("host", "path", "rule", "verdict")


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    after = F.when(at > 0, url.substr(at + F.lit(3), F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(after, "^[^/?#]*", 0)
    path = F.regexp_extract(after.substr(F.length(host) + F.lit(1), F.length(after)), "^[^?#]*", 0)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, letters, letters.lower()), F.lit("")), F.coalesce(path, F.lit(""))


class _Paths:
    """Rules of one host: whole segments lead on, ``ends`` holds the (maybe partial) last ones."""

    __slots__ = ("down", "ends", "sizes")

    def __init__(self):
        self.down: dict[str, _Paths] = {}
        self.ends: dict[str, tuple[str, str]] = {}
        self.sizes: list[int] = []


class Trie:
    """Rules by reversed host labels, then path segments."""

    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        self.root: dict = {}
        for host, path, action in rules:
            node = self.root
            for label in reversed(host.split(".")):
                node = node.setdefault(label, {})
            at = node.setdefault(None, _Paths())          # no label is None
            *whole, last = path.split("/")
            for s in whole:
                at = at.down.setdefault(s, _Paths())
            if at.ends.get(last, ("", ""))[1] != "block":
                at.ends[last] = (host + path, action)
                at.sizes = sorted({len(e) for e in at.ends}, reverse=True)

    @staticmethod
    def _longest(at: _Paths, segments: list[str]) -> tuple[str, str] | None:
        best = None
        for s in segments:
            for n in at.sizes:
                if n <= len(s) and (found := at.ends.get(s[:n])):
                    best = found                          # deeper ones are longer
                    break
            at = at.down.get(s)
            if at is None:
                break
        return best

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, action) of the longest rule that fits."""
        node, best, segments = self.root, None, None
        for label in reversed(host.split(".")):
            node = node.get(label)
            if node is None:
                break
            if None in node:
                segments = segments or path.split("/")
                found = self._longest(node[None], segments)
                if found and (best is None or len(found[0]) >= len(best[0])):
                    best = found                          # a later host is longer
        return best


def _clean(rules: DataFrame) -> DataFrame:
    odd = ~F.coalesce(F.col("action").isin("allow", "block"), F.lit(False))
    action = F.when(odd, F.raise_error(F.concat(F.lit("not an action: "), F.coalesce("action", F.lit("null"))))).otherwise(F.col("action"))
    one = rules.select("host", F.coalesce("path", F.lit("")).alias("path"), action.alias("action")).where("host <> ''")
    return one.groupBy("host", "path").agg(F.max("action").alias("action"))        # block is the larger word


def _by_trie(urls: DataFrame, rules: list, default: str) -> DataFrame:
    data = urls.sparkSession.sparkContext.broadcast(json.dumps(rules).encode())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = per_worker("url-rules", data.value, lambda d: Trie(json.loads(d)))
        for b in batches:
            got = [trie.find(h, p) or (None, default) for h, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            columns = [*b.columns, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*b.schema.names, "rule", "verdict"])

    return urls.mapInArrow(run, urls.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit("")}).schema)


def _by_joins(urls: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    lengths = rules.groupBy(F.col("host").alias("parent")).agg(F.collect_set(F.length("path")).alias("_sizes"))
    labels = F.split("host", "[.]", -1)
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    hosts = urls.select("host").distinct().select("host", F.explode(parents).alias("parent")).join(lengths, "parent")
    pairs = urls.select("host", "path").distinct().join(hosts, "host")
    cut = pairs.select("host", "path", "parent", F.explode(F.filter("_sizes", lambda n: n <= F.length("path"))).alias("_size"))
    fits = cut.withColumn("_cut", F.expr("substr(path, 1, _size)")).join(
        rules.select(F.col("host").alias("parent"), F.col("path").alias("_cut"), "action"), ["parent", "_cut"])
    order = F.struct(F.length("parent") + F.length("_cut"), F.length("parent"))
    found = fits.groupBy("host", "path").agg(F.max_by(F.struct(F.concat("parent", "_cut").alias("rule"), "action"), order).alias("_best"))
    named = found.select(F.col("host").alias("_host"), F.col("path").alias("_path"), "_best")
    joined = urls.join(named, (F.col("host") == F.col("_host")) & (F.col("path") == F.col("_path")), "left")
    return joined.withColumns({"rule": F.col("_best.rule"), "verdict": F.coalesce("_best.action", F.lit(default))}).drop("_host", "_path", "_best")


def judge(pages: DataFrame, rules: DataFrame, keep: list[str], url: str = "url", default: str = "allow") -> DataFrame:
    """The ``keep`` columns of ``pages``, then host, path, rule (host and path of the one that
    decides, or null) and verdict of each url.  ``rules``: host, path, action.  ``keep`` may not
    hold the names of the made columns."""
    clash = sorted(set(keep) & set(MADE))
    if clash:
        raise ValueError(f"columns {clash} are made here and must not be among the kept ones")
    host, path = host_and_path(F.col(url))
    urls = pages.select(host.alias("host"), path.alias("path"), *keep)
    clean = _clean(rules)
    # A sum over the first rows: no more than the bound is counted or read.
    n, size = clean.limit(BROADCAST_RULES + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("host") + F.octet_length("path")), F.lit(0))).first()
    if n <= BROADCAST_RULES and size <= BROADCAST_BYTES:
        out = _by_trie(urls, [tuple(r) for r in clean.select("host", "path", "action").collect()], default)
    else:
        out = _by_joins(urls, clean, default)
    return out.select(*keep, *MADE)
