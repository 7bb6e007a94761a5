"""Best-fit packing of token sequences: a configuration linear program over the whole length
histogram, solved by multiplicative weights with knapsack dynamic-programming pricing, rounded,
solved again for what rounding leaves, and the last residue packed best-fit decreasing.

The driver only ever sees the histogram (at most ``capacity`` rows) and a list of
configurations; documents are tokenised once, where they are read, and each piece finds its
place from its rank among the pieces of its length.
"""

from __future__ import annotations

import base64
import bisect
import json
import re
import zlib
from collections import defaultdict
from functools import cache, cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import id_text, materialise, releasing

CAPACITY = 2048
#: Rounds of multiplicative weights, and solutions of the program (the first of all pieces, the next of what
#: rounding left).
ROUNDS, PASSES = 100, 3
#: Exponent of the weights, largest step as a share of a length's pieces, extra price of long pieces, and how far
#: below the best price a configuration may be.
ETA, STEP, LONGER, SLACK = 0.02, 0.5, 0.1, 0.02
Config = dict[int, int]
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, ord long"


class ByteTokenizer:
    """Ids of a ``tokenizers`` byte-level BPE file. Where the same vocabulary is given as ranks
    (``.tiktoken``), the faster merge loop over those ranks yields the same ids; texts that hold
    a special token's string, or that it refuses, go to ``tokenizers`` itself."""

    def __init__(self, name: str = "byte_bpe_50k"):
        import public_tokenizers as P
        import tiktoken

        self.path = P.path(f"{name}.json")
        with open(self.path, encoding="utf-8") as f:
            special = [t["content"] for t in json.load(f)["added_tokens"]]
        with open(P.path(f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding(name, pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")

    @cached_property
    def exact(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def encode(self, text: str):
        if not self.special.search(text):
            try:
                return self.fast.encode_to_numpy(text, disallowed_special=())
            except ValueError:
                pass
            except BaseException as e:
                if type(e).__name__ != "PanicException":  # of the extension; it is no Exception
                    raise
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)


@cache
def tokenizer(name: str = "byte_bpe_50k") -> ByteTokenizer:
    """One for each Python worker, whatever number of tasks it runs."""
    return ByteTokenizer(name)


def _cutter(capacity: int, end_id: int):
    def cut(batches):
        tok, part = tokenizer(), TaskContext.get().partitionId()
        seen: dict[int, int] = defaultdict(int)
        for b in batches:
            rows = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids = np.append(tok.encode(t.as_py() or ""), end_id).astype("<u4")
                cuts = [0, *range((len(ids) - 1) % capacity + 1, len(ids) + 1, capacity)]
                for k, (s, e) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    rows.append((i, k, s, e - s, zlib.crc32(ids[s:e]), part, seen[e - s]))
                    seen[e - s] += 1
            if rows:
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[x.split()[0] for x in PIECES.split(", ")])

    return cut


def prices(weight: np.ndarray, capacity: int) -> np.ndarray:
    """Knapsack dynamic program, exactly: for each room from 0 to ``capacity`` the largest total
    weight of pieces that fit (a length may repeat). ``weight`` is by length, 0 where there is none."""
    best = np.zeros(capacity + 1)
    for c in range(1, capacity + 1):
        best[c] = max(best[c - 1], (best[c - 1 :: -1] + weight[1 : c + 1]).max())
    return best


def solve(need: np.ndarray, capacity: int, rounds: int = ROUNDS) -> list[tuple[Config, float]]:
    """Configurations and their fractional numbers for the linear program min sum x_c subject to
    sum a_cL x_c = n_L over every length L of the histogram ``need``, by multiplicative weights.

    A length's price is its size (dearer the longer it is, so that short pieces last) times
    exp(-eta * covered share). Each round prices all fillings by one knapsack program, then takes
    the best configuration around each length, where that is within ``SLACK`` of the best of all,
    and moves along it by up to ``STEP`` of what its lengths need."""
    size, cover, used = np.arange(capacity + 1.0), np.zeros(capacity + 1), defaultdict(float)
    share = np.where(need > 0, 1 / np.maximum(need, 1), 0)
    for _ in range(rounds):
        short = (need > 0) & (cover < need - 1e-9)
        if not short.any():
            break
        weight = np.where(short, size * (1 + LONGER * size / capacity) * np.exp(-ETA * cover * share), 0)
        best = prices(weight, capacity)
        value = np.where(short, weight + best[::-1], -1)
        room = np.where(short, np.minimum(np.maximum(need * STEP, 1.0), need - cover), 0)
        offer = np.where(room > 1e-9, weight, -np.inf)
        for first in np.argsort(-value, kind="stable").tolist():
            if value[first] < (1 - SLACK) * best[capacity]:
                break
            # no more is lost than one token's worth
            while room[first] > 1e-9 and (config := _around(first, best, offer, room, value[first] - 1)):
                x = min(room[k] / n for k, n in config.items())
                for k, n in config.items():
                    room[k] -= x * n
                    cover[k] += x * n
                    if room[k] <= 1e-9:
                        offer[k] = -np.inf
                used[tuple(sorted(config.items()))] += x
    return sorted(used.items(), key=lambda c: (-_load(c[0]), -c[1], c[0]))


def _around(first: int, best: np.ndarray, offer: np.ndarray, room: np.ndarray, least: float) -> Config | None:
    """A configuration with a piece of length ``first`` and a weight of at least ``least``, traced
    through the knapsack program ``best`` along lengths that have room left."""
    config, left, got, hidden, k = defaultdict(int), len(best) - 1, 0.0, [], first
    while True:
        config[k] += 1
        got, left = got + offer[k] if offer[k] > -np.inf else got, left - k
        if config[k] + 1 > room[k]:
            hidden.append((k, offer[k]))
            offer[k] = -np.inf
        if left <= 0:
            break
        v = best[left - 1 :: -1] + offer[1 : left + 1]
        j = int(v.argmax())
        if got + v[j] < least:
            break
        k = j + 1
    for k, w in hidden:
        offer[k] = w
    return config if got >= least else None


def _load(config) -> int:
    return sum(k * n for k, n in config)


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Best-fit decreasing where equal lengths and equal sequences move together: its work
    depends on the histogram, not on the number of pieces."""
    groups: dict[int, list] = defaultdict(list)  # room -> [(configuration, number)]
    rooms: list[int] = []

    def put(room: int, config: dict, n: int):
        if not groups[room]:
            bisect.insort(rooms, room)
        groups[room].append((config, n))

    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            k = bisect.bisect_left(rooms, length)
            if k < len(rooms):
                room = rooms[k]
                config, m = groups[room].pop()
                if not groups[room]:
                    rooms.pop(k)
            else:
                room, config, m = capacity, {}, n
            each = room // length
            full = min(m, n // each)
            if full:
                put(room - each * length, config | {length: config.get(length, 0) + each}, full)
            rest = 0
            if full < m:
                rest = min(n - full * each, each - 1) if n - full * each < each else 0
                if rest:
                    put(room - rest * length, config | {length: config.get(length, 0) + rest}, 1)
                if room < capacity and m - full - bool(rest):
                    put(room, config, m - full - bool(rest))
            n -= full * each + rest
    return [x for room in rooms for x in groups[room]]


def plan(counts: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS, passes: int = PASSES) -> tuple[list[tuple[dict[int, int], int]], int]:
    """(configuration, number of sequences), covering the histogram exactly, and how many entries of
    that list, from its start, come from the linear program.

    The program over all lengths is solved; its configurations, the fullest first, are rounded up
    as far as their pieces last, if they are at least as full as the solution is on average. What
    that leaves is solved again, ``passes`` times in all, and the last residue packed best-fit."""
    left = np.zeros(capacity + 1)
    for k, v in counts.items():
        left[int(k)] = int(v)
    out: dict[tuple, int] = defaultdict(int)
    for _ in range(passes):
        found = solve(left, capacity, rounds)
        if not found:
            break
        average = sum(x * _load(c) for c, x in found) / sum(x for _, x in found)
        for config, x in found:
            if _load(config) >= average - 1e-9 and (n := int(min(np.ceil(x - 1e-9), *(left[k] // m for k, m in config)))):
                out[config] += n
                for k, m in config:
                    left[k] -= n * m
    rest = best_fit({int(k): int(left[k]) for k in np.flatnonzero(left)}, capacity)
    return [(dict(c), n) for c, n in out.items()] + rest, len(out)


def slots(packed: list[tuple[dict[int, int], int]]) -> pd.DataFrame:
    """For each length the intervals of ranks that a group of equal sequences takes."""
    rows, base, seen = [], 0, defaultdict(int)
    for config, n in packed:
        offset = 0
        for length in sorted(config, reverse=True):
            rows.append((length, seen[length], config[length], base, offset))
            seen[length] += n * config[length]
            offset += length * config[length]
        base += n
    return pd.DataFrame(rows, columns=["length", "rank", "each", "base", "offset"]).sort_values(["length", "rank"])


def _placer(table: pd.DataFrame):
    by = {int(k): v.drop(columns="length").to_numpy(np.int64) for k, v in table.groupby("length")}

    def place(batches):
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            seq, off = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for x in np.unique(length):
                on, t = length == x, by[int(x)]
                t = t[np.searchsorted(t[:, 0], rank[on], side="right") - 1]
                r = rank[on] - t[:, 0]
                seq[on], off[on] = t[:, 2] + r // t[:, 1], t[:, 3] + r % t[:, 1] * x
            cols = [b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.record_batch([*cols, pa.array(seq), pa.array(off)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return place


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = 0, rounds: int = ROUNDS) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its token ids and ``end_id``; null or empty texts are that one id. Documents of
    more than ``capacity`` ids are cut so that only the first piece may be shorter. Each input row
    is packed, repeated rows and null ids too. Other columns are not read; an empty table gives
    an empty result. Sequences are gapless from offset 0.
    """
    pieces = materialise(
        id_text(docs, id_col, text_col)
        .mapInArrow(releasing(_cutter(capacity, end_id)), PIECES), "pieces")
    by_part = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    # a rank is the place among the pieces of a length: those of earlier partitions, then its own
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = by_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    counts = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = slots(plan(counts, capacity, rounds)[0])
    ranked = pieces.join(base, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("ord")).alias("rank"))
    return ranked.mapInArrow(_placer(table), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
