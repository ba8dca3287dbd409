"""Access to dynamically typed JSON values held in VARIANT columns.

SQL NULL means that a key is absent; a JSON ``null`` is a VARIANT value of its own. The difference
decides whether a fallback key is looked at.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Appended as a second array element while parsing. Spark's parser stops after the first complete
# value, so text behind a record would pass unseen; it cannot when this element has to come next.
_END_MARK = "end-of-record-7d1c"

DUPLICATE_KEYS_CONF = "spark.sql.variant.allowDuplicateKeys"


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def parse_strict(text: Column) -> Column:
    """VARIANT of the one JSON value in ``text``; NULL if malformed or followed by anything."""
    wrapped = F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{_END_MARK}"]')))
    return _once(
        wrapped,
        lambda w: F.when(
            F.try_variant_get(w, "$[1]", "string") == _END_MARK,
            F.try_variant_get(w, "$[0]", "variant"),
        ),
    )


def field(value: Column, *keys: str) -> Column:
    """First key that is present, whatever it holds; SQL NULL if all are absent."""
    found = [F.try_variant_get(value, f"$.{key}", "variant") for key in keys]
    return reduce(lambda left, right: F.coalesce(left, right), found)


def is_string(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value) == "STRING", F.lit(False))


def is_object(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith("OBJECT<"), F.lit(False))


def string_or_null(value: Column) -> Column:
    """The text of a JSON string; NULL for every other type, numbers included."""
    return _once(value, lambda v: F.when(is_string(v), F.try_variant_get(v, "$", "string")))


def list_or_null(value: Column) -> Column:
    """``ARRAY<VARIANT>`` of a JSON array; NULL for every other type."""
    return F.try_variant_get(value, "$", "array<variant>")


def py_text(value: Column, absent: str) -> Column:
    """What ``str()`` shows for a JSON scalar; ``absent`` where the key does not exist."""

    def shown(v: Column) -> Column:
        text = F.try_variant_get(v, "$", "string")
        return (
            F.when(v.isNull(), F.lit(absent))
            .when(F.is_variant_null(v), F.lit("None"))
            .when(F.schema_of_variant(v) == "BOOLEAN", F.initcap(text))
            .otherwise(text)
        )

    return _once(value, shown)
