"""Training and test rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.fixed_values import TRAIN_SHARE

_PARTS = 10_000


def hash_split(
    rows: DataFrame, *key: str, train_share: float = TRAIN_SHARE, seed: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """Split by a hash of the key columns (all columns if none are named).

    A row lands on the same side in every run, on any partitioning and after any lost
    executor, and a filter on a stored table can repeat the choice.
    """
    part = F.pmod(F.xxhash64(F.lit(seed), *(key or rows.columns)), F.lit(_PARTS))
    return split_where(rows, part < int(round(train_share * _PARTS)))


def split_where(rows: DataFrame, is_train: Column) -> tuple[DataFrame, DataFrame]:
    """Split by any repeatable predicate that is never null."""
    return rows.where(is_train), rows.where(~is_train)


def random_split(
    rows: DataFrame, train_share: float = TRAIN_SHARE, seed: int = 0,
) -> tuple[DataFrame, DataFrame]:
    train, test = rows.randomSplit([train_share, 1 - train_share], seed)
    return train, test
