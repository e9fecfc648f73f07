"""Replacement of known wrong codes."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def remap_code(code: Column, replacements: Mapping[str, str], removed: Collection[str]) -> Column:
    """Replace codes, then null those that stand for nothing; other codes pass unchanged."""
    # A code replaced by a removed one is removed too, so settle that here rather than per row.
    outcome = {old: None if new in removed else new for old, new in replacements.items()}
    outcome |= {old: None for old in removed if old not in outcome}
    if not outcome:
        return code
    result = None
    for old, new in outcome.items():
        hit, value = code == F.lit(old), F.lit(new).cast("string")
        result = F.when(hit, value) if result is None else result.when(hit, value)
    return result.otherwise(code)
