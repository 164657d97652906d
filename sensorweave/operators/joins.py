"""Joins that treat a null recording key as a recording of its own."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """``left`` with the other columns of ``right`` where all ``keys`` agree,
    nulls being equal to nulls."""
    if not keys:
        raise ValueError("no keys")
    renamed = {k: f"_sw_right_{i}" for i, k in enumerate(keys)}
    side = right.withColumnsRenamed(renamed)
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(r)) for k, r in renamed.items()])
    joined = left.join(side, same, how)
    return joined if how in ("left_anti", "left_semi") else joined.drop(*renamed.values())
