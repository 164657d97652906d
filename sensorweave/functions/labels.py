"""Activity-code -> surface label maps with an explicit default policy."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

IDENTITY = "identity"   # unmapped codes keep their own text
NULL = "null"           # unmapped codes become null
ERROR = "error"         # an unmapped code fails the job, naming the code
# any other string: unmapped codes become that literal (e.g. "other")


def map_literal(mapping: Mapping) -> Column:
    """A map literal; the mapping is a small fixed table, evaluated JVM-side."""
    items = []
    for key, value in mapping.items():
        k = F.lit(key).cast("long") if isinstance(key, int) else F.lit(key)
        items += [k, F.lit(value)]
    return F.create_map(*items)


def expand_lists(groups: Mapping[str, list]) -> dict:
    """``{label: [code, ...]}`` -> ``{code: label}`` (first label wins)."""
    out: dict = {}
    for label, codes in groups.items():
        for code in codes:
            out.setdefault(code, label)
    return out


def map_label(code: Column, mapping: Mapping, default: str = NULL) -> Column:
    """Look ``code`` up in ``mapping``; unmapped codes follow ``default``.

    Integer-keyed maps compare numerically: the text ``1.0`` is the code 1;
    text that is not a whole number counts as unmapped. A missing code is not
    an error under ``ERROR``.
    """
    keys = list(mapping)
    if keys and all(isinstance(k, int) for k in keys):
        number = code.cast("string").try_cast("double")
        key = F.coalesce(code.cast("string").try_cast("long"), F.when(number == F.floor(number), number.try_cast("long")))
        m = map_literal({int(k): v for k, v in mapping.items()})
    else:
        key = code.cast("string")
        m = map_literal({str(k): v for k, v in mapping.items()})
    found = F.try_element_at(m, key)
    if default == NULL:
        return found
    if default == IDENTITY:
        return F.coalesce(found, code.cast("string"))
    if default == ERROR:
        unknown = F.raise_error(F.concat(F.lit("no label for code "), code.cast("string"))).cast("string")
        return F.when(found.isNotNull() | code.isNull(), found).otherwise(unknown)
    return F.coalesce(found, F.lit(default))
