"""Whole-frame projections and previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cast_all_double(rows: DataFrame) -> DataFrame:
    """Every column as a double in one projection; what is not a number becomes null."""
    return rows.select(*[F.col(f"`{name}`").try_cast("double").alias(name) for name in rows.columns])


def label_from_count(panel: DataFrame, count: str = "count", label: str = "label") -> DataFrame:
    """Replace the count by a double label."""
    kept = [F.col(name) for name in panel.columns if name != count]
    return panel.select(*kept, F.col(count).cast("double").alias(label))


def preview(rows: DataFrame, order: Sequence[str | Column], size: int = 10) -> DataFrame:
    """The first rows in a stated order (a top-k, not a full sort)."""
    return rows.orderBy(*order).limit(size)
