"""Dashboard filters and predicates.

Literal member lists become plain predicates, so they stay inside the scan's
whole-stage codegen and reach the Parquet reader as pushed filters. Member
sets given as DataFrames become null-safe semi/anti joins.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.joins import anti_nullsafe, semi_nullsafe


def _lit_date(v):
    if isinstance(v, str):
        return F.lit(dt.date.fromisoformat(v))
    return F.lit(v)


def in_list(df: DataFrame, col: str, values, as_date: bool = False) -> DataFrame:
    """Keep rows whose value is one of ``values`` (NULL never matches)."""
    c = F.col(col).cast("date") if as_date else F.col(col)
    vals = [_lit_date(v) for v in values] if as_date else list(values)
    return df.filter(c.isin(*vals))


def area_filter(df: DataFrame, areas=None, col: str = "area") -> DataFrame:
    """shared categorical filter; ``None`` = all members = no filter."""
    if areas is None:
        return df
    return df.filter(F.col(col).isin(*list(areas)))


def range_filter(df: DataFrame, col: str, lo=None, hi=None) -> DataFrame:
    """Inclusive range; NULL is dropped whenever a bound is given."""
    c = F.col(col)
    if lo is not None and hi is not None:
        return df.filter(c.between(lo, hi))
    if lo is not None:
        return df.filter(c >= lo)
    if hi is not None:
        return df.filter(c <= hi)
    return df


def ranges_filter(df: DataFrame, ranges: dict) -> DataFrame:
    """Several F3 ranges at once."""
    for col, (lo, hi) in ranges.items():
        df = range_filter(df, col, lo, hi)
    return df


def _tuple_match(keys: list[str], member) -> Column:
    return reduce(lambda a, b: a & b,
                  [F.col(k).eqNullSafe(F.lit(v)) for k, v in zip(keys, member)])


def exclude_members(df: DataFrame, keys: list[str], members) -> DataFrame:
    """Drop rows whose key tuple equals an excluded member, null-safe.

    ``members`` is a list of tuples (a predicate, no join) or a DataFrame with
    the key columns (a null-safe anti join).
    """
    if members is None:
        return df
    if isinstance(members, DataFrame):
        return anti_nullsafe(df, members, keys)
    members = list(members)
    if not members:
        return df
    hit = reduce(lambda a, b: a | b, [_tuple_match(keys, m) for m in members])
    return df.filter(~hit)


def apply_selection(df: DataFrame, selection, keys: list[str]) -> DataFrame:
    """Keep rows whose key tuple was selected; NULLs match.

    ``None`` (nothing selected, or an enumerate-all filter) returns ``df``.
    A list of tuples becomes a predicate; a DataFrame becomes a null-safe
    left-semi join, which AQE turns into a broadcast join once the selected
    side is known to be small.
    """
    if selection is None:
        return df
    if isinstance(selection, DataFrame):
        return semi_nullsafe(df, selection, keys)
    members = list(selection)
    if not members:
        return df.limit(0)
    hit = reduce(lambda a, b: a | b, [_tuple_match(keys, m) for m in members])
    return df.filter(hit)


def measure_filter(long_df: DataFrame, measures, col: str = "measure") -> DataFrame:
    """keep chosen measures of a long (unpivoted) frame."""
    return long_df.filter(F.col(col).isin(*list(measures)))


def filter_domain(df: DataFrame, categorical=("area",),
                  quantitative=("price", "n_beds", "n_baths")) -> DataFrame:
    """the values a filter card offers.

    One row per distinct member of each categorical field, plus one row per
    quantitative field with its min and max. Output columns:
    ``field, member, lo, hi``.
    """
    parts = []
    for c in categorical:
        parts.append(
            df.select(F.lit(c).alias("field"), F.col(c).cast("string").alias("member"))
            .distinct()
            .select("field", "member", F.lit(None).cast("double").alias("lo"),
                    F.lit(None).cast("double").alias("hi")))
    if quantitative:
        aggs = []
        for c in quantitative:
            aggs += [F.min(c).cast("double").alias(f"lo_{c}"), F.max(c).cast("double").alias(f"hi_{c}")]
        stats = df.agg(*aggs)
        stack = ", ".join(f"'{c}', lo_{c}, hi_{c}" for c in quantitative)
        parts.append(stats.selectExpr(f"stack({len(quantitative)}, {stack}) AS (field, lo, hi)")
                     .select("field", F.lit(None).cast("string").alias("member"), "lo", "hi"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def level_members(df: DataFrame, cols: list[str]) -> DataFrame:
    """The member combinations of several levels that occur."""
    return df.select(*cols).distinct()


# Most combinations that ``level_cross_join`` lists.
MOST_COMBINATIONS = 50_000_000


def level_cross_join(df: DataFrame, cols: list[str], most: int = MOST_COMBINATIONS) -> DataFrame:
    """Every combination of the levels' members (NULL is a member), whether it occurs or not.

    Combinations are numbered as a number with one digit a level: a range over
    the product of the levels' sizes is taken apart by ``div`` and ``%``, and
    each digit is looked up in its level's numbered member list. So no product
    of tables is planned, and the rows are dealt evenly. The sizes are counted
    first (one row); a product above ``most`` is refused. With an empty table
    there is no combination.
    """
    spark = df.sparkSession
    sizes = df.agg(*[(F.count_distinct(c) + F.coalesce(F.max(F.col(c).isNull().cast("int")), F.lit(0))).alias(f"n{i}")
                     for i, c in enumerate(cols)]).first()
    product = reduce(lambda a, b: a * b, sizes)
    if product > most:
        raise ValueError(f"{product} combinations of {', '.join(cols)}; the most is {most}")
    out, step = spark.range(product), 1
    for i, c in enumerate(cols):
        # A member list is no longer than the product, which has its bound.
        members = df.select(F.col(c).alias(f"m{i}")).distinct().select(
            f"m{i}", (F.row_number().over(Window.orderBy(F.col(f"m{i}").asc_nulls_first())) - 1).cast("long").alias(f"d{i}"))
        out = out.withColumn(f"d{i}", F.expr(f"id div {step} % {sizes[i] or 1}"))
        out = out.join(members, f"d{i}")
        step *= sizes[i]
    return out.select(*[F.col(f"m{i}").alias(c) for i, c in enumerate(cols)])
