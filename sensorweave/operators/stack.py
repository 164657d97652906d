"""Stacking recordings and matching a target layout."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def stack_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; a column missing from a frame is null there.
    No de-duplication (UNION ALL)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def align_to_schema(df: DataFrame, target: StructType | Iterable[str]) -> DataFrame:
    """Project ``df`` onto a target layout: target order, missing columns
    null (typed when the target schema is given), extra columns dropped."""
    if isinstance(target, StructType):
        fields = [(f.name, f.dataType) for f in target.fields]
    else:
        fields = [(n, None) for n in target]
    have = set(df.columns)
    cols = []
    for n, dtype in fields:
        if n in have:
            c = F.col(n) if dtype is None else F.col(n).cast(dtype)
        else:
            c = F.lit(None) if dtype is None else F.lit(None).cast(dtype)
        cols.append(c.alias(n))
    return df.select(*cols)
