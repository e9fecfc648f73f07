"""Weather readings as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripweave.fixed_values import (
    CLEAR_CLASS, OTHER_WEATHER_CODE, WEATHER_CLASS_CODES, WEATHER_CLASS_PATTERNS,
)


def celsius(fahrenheit: Column) -> Column:
    return (fahrenheit - 32) * 5.0 / 9.0


def weather_class(summary: Column, clear_label: str = CLEAR_CLASS) -> Column:
    """Class of a free-text weather summary.

    One CASE: no summary counts as clear, then the first matching pattern decides, and text
    that matches nothing is its own class.
    """
    rule = F.when(summary.isNull(), F.lit(clear_label))
    for pattern, label in WEATHER_CLASS_PATTERNS:
        rule = rule.when(
            summary.rlike(pattern), F.lit(clear_label if label == CLEAR_CLASS else label),
        )
    return rule.otherwise(summary)


def weather_code(label: Column) -> Column:
    """Numeric code of a weather class; null stays null."""
    rule = F.when(label.isNull(), F.lit(None).cast("double"))
    for name, code in WEATHER_CLASS_CODES.items():
        rule = rule.when(label == name, F.lit(float(code)))
    return rule.otherwise(F.lit(float(OTHER_WEATHER_CODE)))
