"""Text to typed values. Text that does not parse becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A whole number with an optional fraction, whose fraction is cut off.
_NUMBER_WITH_FRACTION = r"^([+-]?\d+)\.\d*$"


def parse_double(text: Column) -> Column:
    return text.try_cast("double")


def parse_int(text: Column) -> Column:
    """Whole number; a fraction is cut off. The pattern runs only where the plain cast fails."""
    whole_part = F.regexp_extract(text, _NUMBER_WITH_FRACTION, 1)
    return F.coalesce(text.try_cast("int"), whole_part.try_cast("int"))


def parse_time(text: Column, pattern: str, length: int | None = None) -> Column:
    """Timestamp in the session zone, from the first ``length`` characters if given."""
    head = text if length is None else F.substring(text, 1, length)
    return F.try_to_timestamp(head, F.lit(pattern))
