"""Embedding columns: checks, conditional normalization, caller-supplied vectors."""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Tolerance within which norms count as 1 (absolute plus relative part).
NORM_TOLERANCE = 1e-3 + 1e-5

COUNTS = ("n_rows", "min_dimension", "max_dimension", "zero_vectors", "bad_vectors")

# How far rounding to float32 can move a unit norm.
FLOAT_ERROR = 2e-7


def squared_norm(vector: Column) -> Column:
    return F.aggregate(
        vector, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")
    )


def norm(vector: Column) -> Column:
    return F.sqrt(squared_norm(vector))


@dataclass(frozen=True)
class VectorProfile:
    n_rows: int
    min_dimension: int
    max_dimension: int
    zero_vectors: int
    bad_vectors: int
    min_norm: float
    max_norm: float

    @property
    def dimension(self) -> int:
        return self.max_dimension

    @property
    def off_unit(self) -> bool:
        """Whether any norm is too far from 1 to use the vectors as they are."""
        return max(abs(self.min_norm - 1.0), abs(self.max_norm - 1.0)) > NORM_TOLERANCE

    def after_normalization(self) -> "VectorProfile":
        """The profile of what :func:`normalize` returns: float32 unit vectors if any was off."""
        if not self.off_unit:
            return self
        return replace(self, min_norm=1.0 - FLOAT_ERROR, max_norm=1.0 + FLOAT_ERROR)


def profile_columns(vector: str = "embedding") -> dict[str, Column]:
    """Aggregates of one pass by name; ``bad_vectors`` are NULL, NaN or infinite."""
    length = norm(F.col(vector))
    usable = length.isNotNull() & ~F.isnan(length) & (length < float("inf"))
    return {
        "n_rows": F.count(F.lit(1)),
        "min_dimension": F.min(F.size(vector)),
        "max_dimension": F.max(F.size(vector)),
        "zero_vectors": F.count_if(length == 0),
        "bad_vectors": F.count_if(~F.coalesce(usable, F.lit(False))),
        "min_norm": F.min(F.when(usable, length)),
        "max_norm": F.max(F.when(usable, length)),
    }


def profile_from(measured: dict[str, Any]) -> VectorProfile:
    """From the values of :func:`profile_columns`; of no rows, an empty profile."""
    filled = {name: measured.get(name) or 0 for name in COUNTS}
    for name in ("min_norm", "max_norm"):
        filled[name] = 1.0 if measured.get(name) is None else measured[name]
    return VectorProfile(**filled)


def profile_vectors(vectors: DataFrame, vector: str = "embedding") -> VectorProfile:
    columns = [column.alias(name) for name, column in profile_columns(vector).items()]
    return profile_from(vectors.agg(*columns).first().asDict())


def require_vectors(profile: VectorProfile) -> None:
    if profile.min_dimension != profile.max_dimension:
        raise ValueError("the vectors differ in length")
    if profile.bad_vectors:
        raise ValueError("some vectors are NULL or hold NaN or infinite values")
    if profile.zero_vectors:
        raise ValueError("some vectors are zero")


def normalize(
    vectors: DataFrame, profile: VectorProfile, vector: str = "embedding", mode: str = "auto"
) -> DataFrame:
    """Divide all vectors by their norms, with ``auto`` only if any norm is off."""
    if mode not in ("auto", "always"):
        raise ValueError("vectors are normalized in mode auto or always")
    if mode == "auto" and not profile.off_unit:
        return vectors
    scaled = F.transform(vector, lambda x: (x / F.col("_norm")).cast("float"))
    return (
        vectors.withColumn("_norm", norm(F.col(vector))).withColumn(vector, scaled).drop("_norm")
    )


def attach_vectors(
    records: DataFrame, vectors: DataFrame, key: str, n_records: int | None = None
) -> DataFrame:
    """Join caller-supplied vectors to records.

    Vectors by position among the unique records must be as many as these; by another key, those
    of the records are chosen. A record whose key has no vector gets NULL, which the checks of the
    vectors report.
    """
    if key != "row_index":
        return records.join(vectors, key, "left")
    n_records = records.count() if n_records is None else n_records
    n_vectors = vectors.count()
    if n_records != n_vectors:
        raise ValueError(
            f"{n_vectors} != {n_records}: as many vectors are needed as there are unique records"
        )
    return records.join(vectors, key, "left")
