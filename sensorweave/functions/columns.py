"""Column-name rules: name predicates and canonical order.

These act on the schema (driver-side lists of names), never on data.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def names_containing(df: DataFrame, token: str, exclude: Iterable[str] = ()) -> list[str]:
    exclude = set(exclude)
    return [c for c in df.columns if token in c and c not in exclude]


def order_columns(df: DataFrame, first: Iterable[str]) -> DataFrame:
    """Put ``first`` (those present) before the remaining columns."""
    first = [c for c in first if c in df.columns]
    return df.select(*first, *[c for c in df.columns if c not in first])
