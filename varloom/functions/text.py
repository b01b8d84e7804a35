"""Column helpers for missing-value tokens, INFO lookup and guarded casts."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cell contents that mean "missing".
MISSING_TOKENS = ("", ".")

# A decimal literal, or nan/inf. Spark alone would also accept '12d' and ' 1 '.
_DECIMAL = r"^[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|(?i:nan|inf|infinity))\z"
_INTEGER = r"^[+-]?[0-9]+\z"


def missing_to_null(value: Column) -> Column:
    """A whole cell of ``.`` or nothing is null; ``-`` is kept as a value."""
    return F.when(~value.isin(*MISSING_TOKENS), value)


def to_number(value: Column, dtype: str) -> Column:
    """Cast text to ``dtype``; anything that is not one plain number is null."""
    pattern = _DECIMAL if dtype in ("float", "double") else _INTEGER
    return F.when(value.rlike(pattern), value.try_cast(dtype))


def info_entries(info: Column) -> Column:
    """An INFO string with a separator before its first entry too, for ``entry_value``."""
    return F.concat(F.lit(";"), info)


def entry_value(entries: Column, tag: str) -> Column:
    """Text of the first ``tag=`` entry; empty if there is none."""
    return F.regexp_extract(entries, f";{re.escape(tag)}=([^;]*)", 1)


def info_value(info: Column, tag: str) -> Column:
    """Value of the first ``tag=`` entry of a ``;``-separated INFO string."""
    return missing_to_null(entry_value(info_entries(info), tag))
