"""Area classification (P12, P13) and the area dimension lookup.

The 31-entry dimension is a fixed literal, so the default lookup is a
literal map inside the projection: no join, no shuffle, no broadcast. A
user-supplied dimension frame is joined instead, broadcast only after its
size is checked.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import AREA_NAMES, CITY_NAMES, DEFAULT_AREA


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def area_dimension(spark: SparkSession) -> DataFrame:
    """The area dimension as a frame ``(area_key, area_name)``."""
    return spark.createDataFrame(list(AREA_NAMES.items()), "area_key string, area_name string")


def _area_map() -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(AREA_NAMES.items())])


def _city(loc: Column) -> Column | None:
    low = F.lower(loc)
    out = None
    for needle, name in CITY_NAMES:
        cond = low.contains(needle)
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out


def _strip_all(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def dash_key(col) -> Column:
    """Normalised key of P12: text between the 1st and 2nd '-', trimmed,
    lower-cased, spaces removed. NULL when there is no dash."""
    part = F.get(F.split(_c(col), "-"), 1)
    return F.replace(F.lower(_strip_all(part)), F.lit(" "), F.lit(""))


def paren_key(col) -> Column:
    """Normalised key of P13: text after the 1st '(' up to the next, trimmed,
    lower-cased, ')' and spaces removed. NULL when there is no '('."""
    part = F.get(F.split(_c(col), r"\("), 1)
    return F.replace(F.replace(F.lower(_strip_all(part)), F.lit(")"), F.lit("")), F.lit(" "), F.lit(""))


def area_from_dash(col) -> Column:
    """City test first, then the dash key looked up; miss -> Boston.

    A location without a dash yields NULL (the row is rejected upstream).
    """
    loc = _c(col)
    key = dash_key(loc)
    looked = F.coalesce(F.try_element_at(_area_map(), key), F.when(key.isNotNull(), F.lit(DEFAULT_AREA)))
    return _city(loc).otherwise(looked)


def area_from_paren(col) -> Column:
    """City test first, then the parenthesis key; miss or no '(' -> Boston."""
    loc = _c(col)
    key = paren_key(loc)
    looked = F.coalesce(F.try_element_at(_area_map(), key), F.lit(DEFAULT_AREA))
    return _city(loc).otherwise(looked)


def join_area(df: DataFrame, key_col: str, dim_df: DataFrame, default: str = DEFAULT_AREA,
              out_col: str = "area", key: str = "area_key", name: str = "area_name") -> DataFrame:
    """Left join on a dimension frame with a default for misses.

    The dimension is broadcast only when its row count is under the bound.
    """
    dim = dim_df.select(F.col(key).alias("__k"), F.col(name).alias("__n"))
    j = df.join(dim, df[key_col] == dim["__k"], "left")
    return j.withColumn(out_col, F.coalesce(F.col("__n"), F.lit(default))).drop("__k", "__n")
