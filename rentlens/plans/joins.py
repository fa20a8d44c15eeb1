"""Null-safe key joins. Spark broadcasts a side by its own size check, at run time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_safe_condition(left: DataFrame, right: DataFrame, keys: list[str],
                        right_keys: list[str] | None = None) -> Column:
    """``left.k <=> right.k`` for every key (NULL matches NULL)."""
    right_keys = right_keys or keys
    conds = [left[lk].eqNullSafe(right[rk]) for lk, rk in zip(keys, right_keys)]
    return reduce(lambda a, b: a & b, conds)


def semi_nullsafe(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``df`` whose key tuple occurs in ``other``; NULLs match.

    Null-safe equality is an equi-join: adaptive execution broadcasts the
    selection when its measured size allows, else both sides shuffle on the keys.
    """
    o = other.select(*[F.col(k).alias(f"__sel_{k}") for k in keys]).distinct()
    cond = null_safe_condition(df, o, keys, [f"__sel_{k}" for k in keys])
    return df.join(o, cond, "left_semi")


def anti_nullsafe(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``df`` whose key tuple does not occur in ``other``; NULLs match."""
    o = other.select(*[F.col(k).alias(f"__exc_{k}") for k in keys]).distinct()
    cond = null_safe_condition(df, o, keys, [f"__exc_{k}" for k in keys])
    return df.join(o, cond, "left_anti")
