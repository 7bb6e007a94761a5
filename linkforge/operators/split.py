"""Deterministic splits and samples by a hash of the id."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


# Fixed formula, needed for equal splits: 64 bits of BLAKE2b, big-endian, of "seed:id" and "sample:id".
def _u64(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "big")


def is_validation(entity_id: str, seed: int = 2026, fraction: float = 0.2) -> bool:
    return _u64(f"{seed}:{entity_id}") < int(fraction * 2**64)


def validation_member(c: Column, seed: int = 2026, fraction: float = 0.2) -> Column:
    """64-bit BLAKE2b of ``seed:id`` below ``fraction`` of its range (Spark has no BLAKE2b)."""

    @F.pandas_udf("boolean")
    def member(ids: pd.Series) -> pd.Series:
        return ids.map(lambda i: is_validation(i, seed, fraction), na_action="ignore")

    return member(c)


def sample_member(c: Column, modulus: int) -> Column:
    """One id in ``modulus``: 64-bit BLAKE2b of ``sample:id`` divisible by it."""
    if modulus <= 1:
        return F.lit(True)

    @F.pandas_udf("boolean")
    def member(ids: pd.Series) -> pd.Series:
        return ids.map(lambda i: _u64(f"sample:{i}") % modulus == 0, na_action="ignore")

    return member(c)


def md5_u32(c: Column) -> Column:
    return F.conv(F.substring(F.md5(c.cast("binary")), 1, 8), 16, 10).cast("long")


def validation_member_md5(c: Column, seed: int = 2026, fraction: float = 0.2) -> Column:
    """The same split with built-in functions only."""
    return md5_u32(F.concat(F.lit(f"{seed}:"), c)) < int(fraction * 2**32)


def sample_member_md5(c: Column, modulus: int) -> Column:
    return md5_u32(F.concat(F.lit("sample:"), c)) % modulus == 0


def select_source1(df, partition="train", seed=2026, modulus=1, split="validation", id_col="entity_id", native=False):
    """Source 1 rows of a split (validation, development or all; test data have no split), then
    one in ``modulus``."""
    member, sample = (validation_member_md5, sample_member_md5) if native else (validation_member, sample_member)
    if partition == "train" and split != "all":
        inside = member(F.col(id_col), seed)
        df = df.where(inside if split == "validation" else ~inside)
    return df.where(sample(F.col(id_col), modulus)) if modulus > 1 else df
