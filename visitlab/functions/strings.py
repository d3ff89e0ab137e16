"""String column expressions over the text encodings of the data model.

"k=v|k=v" records and comma lists are the reference's poor man's structs and
arrays; these helpers read and write them with built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_empty(c) -> Column:
    c = _col(c)
    return c.isNull() | (c == "")


def is_not_empty(c) -> Column:
    return ~is_empty(c)


def trim_comma(c) -> Column:
    """Drop one leading and one trailing comma."""
    return F.regexp_replace(_col(c), r"^,|,$", "")


def get_field(c, field: str, delimiter: str = "|") -> Column:
    """Value of ``field`` in a ``k=v<delim>k=v`` string; null if absent or empty."""
    d = "\\" + delimiter
    pattern = f"(?:^|{d}){field}=([^={d}]*)(?:{d}|$)"
    return F.nullif(F.regexp_extract(_col(c), pattern, 1), F.lit(""))


def set_field(c, field: str, value, delimiter: str = "|") -> Column:
    """Replace the value of ``field`` in a ``k=v<delim>k=v`` string; null empties it."""
    v = F.lit(value) if not isinstance(value, Column) else value
    v = F.coalesce(v.cast("string"), F.lit(""))
    parts = F.split(_col(c), "\\" + delimiter)
    replaced = F.transform(
        parts, lambda x: F.when(F.split(x, "=")[0] == field, F.concat(F.lit(field + "="), v))
        .otherwise(x))
    return F.array_join(replaced, delimiter)


def concat_sep(a, b, sep: str) -> Column:
    """``a + sep + b``; a null part is skipped."""
    return F.concat_ws(sep, _col(a).cast("string"), _col(b).cast("string"))


def remove_prefix(c) -> Column:
    """Strip a ``<digits>_`` salt prefix."""
    return F.regexp_replace(_col(c), r"^[0-9]+_", "")


def add_prefix(c, salt) -> Column:
    """``<salt>_<value>``."""
    return F.concat_ws("_", _col(salt).cast("string"), _col(c).cast("string"))


def comma_items(c) -> Column:
    """Comma list -> array of non-empty items (null list -> empty array)."""
    return F.filter(F.split(F.coalesce(_col(c), F.lit("")), ","), lambda x: x != "")
