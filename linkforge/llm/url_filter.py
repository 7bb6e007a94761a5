"""URL filter with a Bloom filter cascade.

Level 0 encodes the listed keys. Every key of the corpus's complete key universe that level 0
accepts by mistake is encoded in level 1, every listed key that level 1 accepts by mistake in
level 2, and so on until a level makes no mistake: then membership is exact for the whole
universe, and a page is judged by probing a few small bit arrays, without a join.

The universe: each url gives a key for every suffix of its host with as many labels as some rule has
and every prefix of its path whose length some rule has. Only false positives and listed keys are ever
gathered; with the level-0 rate set to (listed / universe), their number is that of the list.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise, small_batches

#: Above this many bytes of rules and levels the filter isn't shipped to tasks; ``build`` raises.
MOST_BYTES = 256 << 20
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def key(self) -> str:
        return self.host + self.path


class Bloom:
    def __init__(self, keys: list[str], rate: float, salt: int):
        n = max(1, len(keys))
        self.m = max(64, math.ceil(-n * math.log(rate) / math.log(2) ** 2))
        self.k, self.salt = max(1, round(self.m / n * math.log(2))), salt
        self.bits = np.zeros((self.m + 7) // 8, np.uint8)
        for x in keys:
            for p in self._at(x):
                self.bits[p >> 3] |= 1 << (p & 7)

    def _at(self, key: str):
        h = xxhash.xxh3_128_intdigest(key.encode(), self.salt)
        a, b = h & (1 << 64) - 1, h >> 64 | 1
        return ((a + i * b) % self.m for i in range(self.k))

    def __contains__(self, key: str) -> bool:
        return all(self.bits[p >> 3] >> (p & 7) & 1 for p in self._at(key))


class Cascade:
    """Exact for every key of the universe it was built over."""

    def __init__(self):
        self.levels: list[Bloom] = []

    def __contains__(self, key: str) -> bool:
        for i, level in enumerate(self.levels):
            if key not in level:
                return i % 2 == 1
        return len(self.levels) % 2 == 1

    @property
    def nbytes(self) -> int:
        return sum(x.bits.nbytes for x in self.levels)


def parts_of(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or a url without ``://``."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, UPPER.lower()), F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


class Shapes:
    """What keys can be rules: numbers of host labels and lengths of paths that some rule has. The
    keys of a url are bounded by the rules, however long its host is."""

    def __init__(self, rules: list[Rule]):
        self.labels = sorted({r.host.count(".") + 1 for r in rules}, reverse=True)
        self.paths = sorted({len(r.path) for r in rules})
        self.longest = max((len(r.host) for r in rules), default=0)

    def keys(self, host: str, path: str) -> list[str]:
        """Host suffixes joined with path prefixes, longest together first."""
        if not host:
            return []
        # one more character than the longest rule tells where its first label starts
        end = host[-self.longest - 1 :]
        labels = end.split(".")
        if len(end) < len(host) and end[0] != ".":
            labels = labels[1:]  # cut off in the middle
        hosts = [".".join(labels[-n:]) for n in self.labels if n <= len(labels)]
        found = [(h, path[:n]) for h in hosts for n in self.paths if n <= len(path)]
        return [h + p for h, p in sorted(found, key=lambda k: (-len(k[0]) - len(k[1]), -len(k[0])))]


def build(pages: DataFrame, rules: list[Rule], url_col: str) -> tuple[Cascade, dict[str, int]]:
    """The cascade over all keys of ``pages``, and the number of keys at each level. Rules are a
    parameter held by the driver; what else reaches it is level 0's false positives alone. Where
    those are more than a bounded multiple of the rules, level 0 is built again at a lower rate."""
    listed = sorted({r.key for r in rules})
    shapes = Shapes(rules)
    cascade, sizes = Cascade(), {"listed": len(listed)}
    if not listed:
        return cascade, sizes
    if sum(map(len, listed)) > MOST_BYTES:
        raise ValueError("the rules are too large to ship to tasks")
    spark = pages.sparkSession
    universe = pages.agg(F.approx_count_distinct(F.col(url_col))).first()[0] * max(1, len(shapes.labels) * len(shapes.paths))
    rate = min(0.5, max(1e-9, len(listed) / max(1, universe) / math.sqrt(2)))
    host, path = parts_of(F.col(url_col))
    urls, known = pages.select(host.alias("host"), path.alias("path")), spark.sparkContext.broadcast(frozenset(listed))
    while True:
        first = Bloom(listed, rate, 0)
        wrong = materialise(urls.mapInArrow(_accepted(spark.sparkContext.broadcast(first), known, shapes), "key string").distinct(), "bloom-wrong")
        n = wrong.count()
        if n <= 64 * len(listed) + 100_000:
            break
        discard(wrong)
        rate /= 4 * n / (64 * len(listed) + 100_000)
    inside, outside = listed, sorted(r["key"] for r in wrong.toLocalIterator())
    discard(wrong)
    cascade.levels.append(first)
    sizes["level 0 false positives"] = n
    while outside:
        level = Bloom(outside, 0.5, len(cascade.levels))
        cascade.levels.append(level)
        inside, outside = outside, [k for k in inside if k in level]
    return cascade, sizes


def _accepted(shared, known, shapes: Shapes):
    def run(batches):
        level, real = shared.value, known.value
        seen: dict[str, bool] = {}
        for b in batches:
            out = set()
            for h, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for k in shapes.keys(h, p):
                    hit = seen.get(k)
                    if hit is None:
                        if len(seen) > 200_000:
                            seen.clear()
                        hit = seen[k] = k in level and k not in real
                    if hit:
                        out.add(k)
            yield pa.record_batch({"key": pa.array(sorted(out), pa.string())})

    return run


def url_filter(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    The longest rule (host and path together) whose host is the url's or a parent domain of it
    and whose path starts the url's path decides; without one, rule is null and the verdict
    ``default``. Null urls and those without ``://`` have empty host and path and no rule. Other
    columns are not read. No rules: everything gets the default. An empty table gives no rows.
    """
    cascade, _ = build(pages, rules, url_col)
    shapes, verdicts = Shapes(rules), {r.key: r.verdict for r in rules}
    state = pages.sparkSession.sparkContext.broadcast((cascade, verdicts))

    def judge(batches):
        levels, verdict = state.value
        seen: dict[str, bool] = {}
        for b in batches:
            rule, out = [], []
            for h, p in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                hit = None
                for key in shapes.keys(h, p):
                    there = seen.get(key)
                    if there is None:
                        if len(seen) > 200_000:
                            seen.clear()
                        there = seen[key] = key in levels
                    if there:
                        hit = key
                        break
                rule.append(hit)
                out.append(verdict[hit] if hit else default)
            yield pa.record_batch([*b.columns, *(pa.array(x, pa.string()) for x in (rule, out))], names=["page_id", "host", "path", "rule", "verdict"])

    small_batches(pages.sparkSession)
    host, path = parts_of(F.col(url_col))
    urls = pages.select(F.col(id_col).cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    return urls.mapInArrow(judge, "page_id long, host string, path string, rule string, verdict string")
