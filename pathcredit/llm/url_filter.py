"""URL filter: host and path rules first, else gradient-boosted trees on lexical features.

Features of a URL: its length, its host's and path's, path depth, digit ratio,
character entropy, numbers of parameters, labels, hyphens and dots, longest
label, fragment, and statistics of its host's last one and two labels: how
many URLs share them and what share of those a rule blocks. The suffix
statistics are counted over all URLs, in hashed buckets of a fixed number, so
they stay small whatever the hosts. The trees learn from URLs that a rule
labels, of which a bounded sample is read (``UrlParams.sample``); a URL of the
sample has its suffixes' statistics without those of its own fold of hosts, so
that its label, or its host's, isn't among what it is learnt from.

Defined results: a null URL, or one without ``://``, has an empty host and
path, fits no rule and is judged by the trees like any other. If the rules
label no URL, or all alike, the trees answer that label (allow if there is
none). Of rules that fit, the longest (host and path together) wins, then
the one with the longer host. Repeated rows are judged each. Other columns
are not read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathcredit.llm.common import batches, smallest

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MOST_RULES = 500
JUDGED = pa.schema([("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("rule", pa.string()), ("verdict", pa.string()), ("score", pa.float64())])
JUDGED_SQL = "page_id long, host string, path string, rule string, verdict string, score double"


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    text: str  # host and path, like example.com/en/

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


#: The rules of the registered query.
RULES = (Rule("allow", "com/"), Rule("block", "example.com/en/"), Rule("allow", "www.example.com/en/"), Rule("block", "net/es/"), Rule("block", "net/fr/"))


@dataclass(frozen=True)
class UrlParams:
    sample: int = 20_000  # labelled URLs the trees learn from, at most
    buckets: int = 1024  # of hashed suffixes
    folds: int = 5  # of hosts
    trees: int = 40
    depth: int = 3
    rate: float = 0.3
    bins: int = 32


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL column."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, UPPER.lower()), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def fitting(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """Text and verdict of the winning rule, null without one."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"over {MOST_RULES} rules make too large an expression")
    text = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), len(r.host))):  # the longest is asked first
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        text, verdict = F.when(fits, r.text).otherwise(text), F.when(fits, r.verdict).otherwise(verdict)
    return text, verdict


def suffixes(host: str, buckets: int) -> tuple[int, int]:
    labels = host.split(".")
    return zlib.crc32(labels[-1].encode()) % buckets, zlib.crc32(".".join(labels[-2:]).encode()) % buckets


def lexical(url: str, host: str, path: str) -> list[float]:
    n = max(1, len(url))
    query = url.partition("?")[2].partition("#")[0]
    labels = host.split(".")
    return [float(len(url)), float(len(host)), float(len(path)), float(sum(1 for x in path.split("/") if x)), sum(map(str.isdigit, url)) / n,
            -sum(c / n * math.log2(c / n) for c in Counter(url).values()), float(len([x for x in query.split("&") if x])), float(len(labels)),
            float(host.count("-")), float(path.count(".")), float(max(map(len, labels))), float("#" in url)]


class Suffixes:
    """Smoothed statistics of hashed suffixes, from counts (urls, labelled, blocked) by bucket for one and two labels."""

    def __init__(self, one: np.ndarray, two: np.ndarray):
        self.buckets = len(one)
        self.tables = [self.table(x) for x in (one, two)]

    @staticmethod
    def table(counts: np.ndarray) -> np.ndarray:
        n, known, blocked = counts.T
        prior = (blocked.sum() + 0.5) / (known.sum() + 1)
        return np.stack([np.log1p(n), (blocked + 10 * prior) / (known + 10)], 1)

    def of(self, host: str) -> list[float]:
        return [float(x) for t, b in zip(self.tables, suffixes(host, self.buckets)) for x in t[b]]


class Trees:
    """Boosted regression trees of fixed depth on binned features, logistic loss."""

    def __init__(self, p: UrlParams):
        self.p, self.trees, self.start = p, [], 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        p = self.p
        share = np.clip(y.mean() if len(y) else 0.0, 1e-3, 1 - 1e-3)
        self.start = float(np.log(share / (1 - share)))
        if not len(y) or y.min() == y.max():
            return self
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, p.bins + 1)[1:-1])) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], 1)
        z = np.full(len(y), self.start)
        for _ in range(p.trees):
            q = 1 / (1 + np.exp(-z))
            grad, hess = y - q, q * (1 - q)
            node = np.zeros(len(y), np.int64)
            levels = []
            for depth in range(p.depth):
                splits = [self.split(binned, grad, hess, node, k, edges) for k in range(1 << depth)]
                feature, bin_, cut = (np.array(v) for v in zip(*splits))
                levels.append((feature, cut))
                node = 2 * node + (binned[np.arange(len(y)), feature[node]] > bin_[node])
            g, h = (np.bincount(node, v, 1 << p.depth) for v in (grad, hess))
            leaf = p.rate * g / (h + 1.0)
            self.trees.append((levels, leaf))
            z = z + leaf[node]
        return self

    def split(self, binned, grad, hess, node, k, edges) -> tuple[int, int, float]:
        """Feature, bin and value of the best cut of one node; a cut that sends all rows left if none gains."""
        inside = node == k
        best = (1e-6, 0, self.p.bins + 1, math.inf)
        g_all, h_all = grad[inside].sum(), hess[inside].sum()
        for f, e in enumerate(edges):
            if len(e):
                g = np.cumsum(np.bincount(binned[inside, f], grad[inside], len(e) + 1))[:-1]
                h = np.cumsum(np.bincount(binned[inside, f], hess[inside], len(e) + 1))[:-1]
                gain = g**2 / (h + 1) + (g_all - g) ** 2 / (h_all - h + 1) - g_all**2 / (h_all + 1)
                at = int(np.argmax(gain))
                if gain[at] > best[0]:
                    best = float(gain[at]), f, at, float(e[at])
        return best[1:]

    def predict(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for levels, leaf in self.trees:
            node = np.zeros(len(x), np.int64)
            for feature, cut in levels:
                node = 2 * node + (x[rows, feature[node]] > cut[node])
            z = z + leaf[node]
        return 1 / (1 + np.exp(-z))


def with_rules(pages: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """page_id, url, host, path, rule and verdict (null without a rule)."""
    host, path = parts(F.col("url"))
    split = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url")).select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = fitting(F.col("host"), F.col("path"), rules)
    return split.select("*", rule.alias("rule"), verdict.alias("verdict"))


def learn(ruled: DataFrame, p: UrlParams = UrlParams()) -> tuple[Suffixes, Trees]:
    """Suffix statistics of all URLs, and trees from the distinct labelled URLs of smallest hash, each once: a rule
    labels all copies of a URL alike."""
    last = F.element_at(F.split("host", "[.]"), -1)
    two = F.when(F.contains(F.col("host"), F.lit(".")), F.concat(F.element_at(F.split("host", "[.]"), -2), F.lit("."), last)).otherwise(last)
    fold = F.crc32(F.concat(F.lit("fold "), "host").cast("binary")) % p.folds
    counts = []
    for name in (last, two):
        rows = ruled.groupBy((F.crc32(name.cast("binary")) % p.buckets).alias("bucket"), fold.alias("fold")).agg(
            F.count("*").alias("n"), F.count("verdict").alias("known"), F.count(F.when(F.col("verdict") == "block", 1)).alias("blocked")).collect()
        held = np.zeros((p.folds, p.buckets, 3), np.int64)
        for r in rows:
            held[r["fold"], r["bucket"]] = r["n"], r["known"], r["blocked"]
        counts.append(held)
    found = Suffixes(*(c.sum(0) for c in counts))
    without = [Suffixes(*(c.sum(0) - c[k] for c in counts)) for k in range(p.folds)]
    labelled = ruled.filter("verdict is not null").select("url", "host", "path", "verdict")
    n = labelled.agg(F.approx_count_distinct("url", 0.02).alias("n")).first()["n"]
    sample = smallest(labelled.distinct(), "url", n, p.sample).collect()  # the bound on the hash comes before the shuffle
    own = lambda host: without[zlib.crc32(f"fold {host}".encode()) % p.folds]
    x = np.array([lexical(r["url"], r["host"], r["path"]) + own(r["host"]).of(r["host"]) for r in sample]).reshape(len(sample), len(lexical("", "", "")) + 4)
    return found, Trees(p).fit(x, np.array([float(r["verdict"] == "block") for r in sample]))


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, params: UrlParams = UrlParams()) -> DataFrame:
    """page_id, host, path, rule, verdict and the trees' score (null where a rule decides) of every row."""
    ruled = with_rules(pages, rules)
    found, trees = learn(ruled, params)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            page, url, host, path, rule, verdict = (c.to_pylist() for c in batch.columns)
            open_ = [i for i, v in enumerate(verdict) if v is None]
            score: list = [None] * len(page)
            if open_:
                x = np.array([lexical(url[i] or "", host[i], path[i]) + found.of(host[i]) for i in open_])
                for i, s in zip(open_, trees.predict(x).tolist()):
                    score[i], verdict[i] = s, "block" if s >= 0.5 else "allow"
            yield from batches(zip(page, host, path, rule, verdict, score), JUDGED, 1 << 20)

    return ruled.mapInArrow(run, JUDGED_SQL)
