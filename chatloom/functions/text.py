"""Whitespace handling with the semantics of ``str.strip()``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters for which str.isspace() holds.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def py_strip(text: Column) -> Column:
    """Strip all Unicode whitespace; ``F.trim`` alone strips U+0020 only."""
    return F.trim(text, F.lit(PY_WHITESPACE))


def is_blank(text: Column) -> Column:
    return py_strip(text) == ""
