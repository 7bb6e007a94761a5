"""Set similarities as expressions; edit similarities (longest common subsequence, bit-parallel)
as a JVM function, which the plain Python functions here define."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import java


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays taken as sets; 0 if either is empty."""
    both, either = F.size(F.array_intersect(a, b)).cast("double"), F.size(F.array_union(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), both / either).otherwise(F.lit(0.0))


def jaccard_of(shared: Column, a: Column, b: Column) -> Column:
    """From the number of shared elements and the sizes of two sets; 0 if either is empty."""
    return F.when((a > 0) & (b > 0), shared.cast("double") / (a + b - shared)).otherwise(F.lit(0.0))


def overlap_of(shared: Column, a: Column, b: Column) -> Column:
    """Shared elements over the smaller set, from the same; 0 if either is empty."""
    return F.when((a > 0) & (b > 0), shared.cast("double") / F.least(a, b)).otherwise(F.lit(0.0))


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence; one big-integer step per character of ``b``."""
    if a == b:
        return len(a)
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & where.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return (row ^ full).bit_count()


def ratio(a: str, b: str) -> float:
    """Share of characters in a longest common subsequence; 1 for two blanks."""
    n = len(a) + len(b)
    return 2 * lcs(a, b) / n if n else 1.0


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    """Best ratio among the shared tokens and the shared tokens with either side's own."""
    x, y = set(a.split()), set(b.split())
    shared, left, right = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    if not x or not y:
        return 0.0
    if shared and (not left or not right):
        return 1.0
    gap = 1 if shared else 0
    one, two = len(shared) + gap + len(left), len(shared) + gap + len(right)
    best = 1 - (len(left) + len(right) - 2 * lcs(left, right)) / (one + two) if one + two else 0.0
    if shared:
        best = max(best, 1 - (gap + len(left)) / (len(shared) + one), 1 - (gap + len(right)) / (len(shared) + two))
    return best


def ratios(a: Column, b: Column, whole: bool = True) -> Column:
    """(fuzz, sort, whole): ratio, token_sort_ratio and, if asked for, token_set_ratio (else null) of clean strings
    (tokens joined by blanks); 0 if either is blank. Computed once a pair, whatever reads it."""
    return _compared(a, b, F.lit(2 if whole else 1), False)


def compared(a: Column, b: Column, level: Column, least_overlap: float = 0.0, least_sort: float = 0.0) -> Column:
    """``ratios`` (level 2 with and 1 without token_set_ratio, 0 without any: null) and, of both strings' tokens taken as
    sets, the number that is shared, the sizes, and the numbers of tokens: shared, left, right, lefts, rights. Level 3 is 2,
    but null where both the overlap and token_sort_ratio are too small; what is told by less is not computed then."""
    return _compared(a, b, level, True, least_overlap, least_sort)


def _compared(a: Column, b: Column, level: Column, counts: bool, *least: float) -> Column:
    fields = [T.StructField(c, T.DoubleType()) for c in ("fuzz", "sort", "whole")]
    fields += [T.StructField(c, T.IntegerType()) for c in ("shared", "left", "right", "lefts", "rights")] if counts else []
    return java.call("Ratios", T.StructType(fields), (counts, *(least or (0.0, 0.0))), a, b, level)
