"""Long strings in few bytes while they are shuffled."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import types as T

from . import java


def packed(c: Column) -> Column:
    return java.call("Packed", T.BinaryType(), (True,), c)


def unpacked(c: Column) -> Column:
    return java.call("Packed", T.StringType(), (False,), c)
