"""Optional predicates: a missing parameter means "no filter".

Each builder returns a Column predicate or ``None``; :func:`all_of` ANDs the
present ones.  Predicates compare against literals, so Catalyst can push them
into the parquet scan when the column comes straight from a table.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _present(v) -> bool:
    return v is not None and v != "" and v != []


def between(column, start=None, end=None) -> Column | None:
    """Inclusive range test; passes everything unless *both* bounds are given.

    A null data value fails (null is not true)."""
    if not (_present(start) and _present(end)):
        return None
    return _col(column).between(start, end)


def split_list(value) -> list[str]:
    """A comma list parameter ("a,b,c") or a Python sequence -> list of items."""
    if value is None:
        return []
    if isinstance(value, str):
        return [x for x in value.split(",") if x != ""]
    return [str(x) for x in value]


def in_list(column, values) -> Column | None:
    """Scalar column is one of the parameter's comma items."""
    items = split_list(values)
    if not items:
        return None
    return _col(column).cast("string").isin(items)


def overlaps(column, values) -> Column | None:
    """Comma-list or array column shares at least one item with the parameter."""
    items = split_list(values)
    if not items:
        return None
    c = _col(column)
    return F.arrays_overlap(c, F.array(*[F.lit(x) for x in items]))


def equal(column, value) -> Column | None:
    if not _present(value):
        return None
    return _col(column) == F.lit(value)


def all_of(predicates: Iterable[Column | None]) -> Column | None:
    present = [p for p in predicates if p is not None]
    if not present:
        return None
    out = present[0]
    for p in present[1:]:
        out = out & p
    return out


def apply(df, predicates: Sequence[Column | None]):
    cond = all_of(predicates)
    return df if cond is None else df.filter(cond)
