"""Exact copies: which rows have an earlier row with the same key.

Only (index, key hash) pairs are shuffled. The records follow in one anti-join against the removed
indexes, which Spark turns into a broadcast at run time when few rows are removed.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from chatloom.operators.skew import HOT_ROWS, hot_limit, lookup
from chatloom.scratch import materialize_and_measure

EXACT_REASON = "exact_duplicate"  # fixed value


def conversation_key(conversations: Column) -> Column:
    """Key of a normalized conversation."""
    return F.sha2(F.to_json(conversations), 256)


def record_key(value: Column, raw: Column) -> Column:
    """Key of a raw record: equal for objects that differ in key order or JSON spelling only.

    ``to_json`` of a VARIANT sorts the keys, but prints 1 and 1.0 alike. Records with any number
    that is not a plain integer, or with mixed arrays (whose schema hides it), go through the JSON
    module; for all others the Python side gets NULL and does nothing.
    """
    kinds = F.schema_of_variant(value)
    # Stripping the quoted field names keeps a key named DECIMAL from matching.
    types = F.regexp_replace(kinds, r"`[^`]*`:|[^<>:, `]+: ", "")
    uncertain = types.rlike("DECIMAL|DOUBLE|FLOAT|VARIANT")
    spelled = _canonical_json(F.when(uncertain, raw))
    return F.sha2(F.coalesce(F.concat(F.lit("#"), spelled), F.to_json(value)), 256)


@F.pandas_udf(StringType())
def _canonical_json(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield batch.map(
            # Escaped to ASCII, as half of a surrogate pair could not travel back otherwise.
            lambda text: json.dumps(json.loads(text), sort_keys=True, separators=(",", ":")),
            na_action="ignore",
        )


def exact_copies(
    keyed: DataFrame, index: str, key: str = "key", *, hot_rows: int = HOT_ROWS
) -> tuple[DataFrame, int]:
    """Rows that have an earlier row with the same key, plus its ``retained`` index; their number.

    The groups are pre-aggregated before the shuffle, and a key with very many copies is joined
    back over many tasks. ``keyed`` is read twice.
    """
    copies = F.col("_copies")
    groups, seen = materialize_and_measure(
        keyed.groupBy(key)
        .agg(F.min(index).alias("retained"), F.count(F.lit(1)).alias("_copies"))
        .where(copies > 1),
        "copy-groups",
        groups=F.count(F.lit(1)),
        rows=F.sum(copies),
        largest=F.max(copies),
    )
    n_copies = (seen["rows"] or 0) - seen["groups"]
    hot = []
    if n_copies:
        # Rows without copies are left out of the total, so the limit is on the safe side.
        limit = hot_limit(seen["rows"], hot_rows)
        if seen["largest"] > limit:
            hot = [row[0] for row in groups.where(copies > limit).select(key).collect()]
    joined = lookup(keyed, groups.drop("_copies"), key, F.col(index), hot)
    return joined.where(F.col(index) > F.col("retained")), n_copies


def drop_rows(df: DataFrame, removed: DataFrame, index: str) -> DataFrame:
    return df.join(removed.select(index), index, "left_anti")


def exact_log(copies: DataFrame, records: DataFrame, index: str) -> DataFrame:
    """Removal log of the copies with the removed record, from ``index, record`` rows, which may be
    more than those of the copies."""
    logged = copies.select(index, "retained").join(records.select(index, "record"), index)
    return logged.select(
        F.col(index).alias("duplicate_source_index"),
        F.col("retained").alias("retained_source_index"),
        F.lit(EXACT_REASON).alias("reason"),
        F.lit(1.0).alias("similarity"),
        "record",
    )
