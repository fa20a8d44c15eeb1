"""All sheets of the dashboard in one pass (A1-A6), and their additive states.

The sheets share the area filter and read the same few columns, so one scan
feeds all of them: a row is expanded into one row a sheet (its group columns and
measures, if it passes the sheet's own filter), and one partial aggregate in
front of one shuffle holds every sheet's groups.

A1-A5 are kept as counts and sums (``sheet_states``), which can be added up and
taken back: with a ``sign`` column, rows count for +1 or are taken back with -1.
That is what the stream of changes adds to (``streaming.sheets_stream``). A6 has
minima and maxima, so it is not among them.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.derive import attr, date_part, number_of_beds
from ..schema import PRICE_BY_BEDS_RANGE, PRICE_TREND_MAX, TABLE_RANGES
from .filters import area_filter
from .sheets import TABLE_KEYS

# Sheet to its group columns.
ADDITIVE = {
    "availability_histogram": ["avail_month"],
    "listings_available": ["area"],
    "listings_over_time": ["upd_year", "upd_quarter", "upd_month", "upd_day"],
    "price_by_beds": ["number_of_beds"],
    "price_trend": ["upd_month", "upd_day"],
}
SHEETS = {**ADDITIVE, "listing_table": TABLE_KEYS}
KEYS = ["area", "number_of_beds", "avail_month", "avail_day", "upd_year", "upd_quarter", "upd_month", "upd_day",
        "id", "location", "amenities"]
STATE = ["n_rows", "n", "price_sum"]


def _keyed(df: DataFrame, keep) -> DataFrame:
    avail, upd = "available_date", "last_updated"
    return df.select(
        "id", "area", "location", "amenities", "price", "n_beds", "n_baths", avail, upd, *keep,
        number_of_beds().alias("number_of_beds"), date_part(avail, "month").alias("avail_month"),
        date_part(avail, "day").alias("avail_day"),
        *[date_part(upd, p).alias(f"upd_{p}") for p in ("year", "quarter", "month", "day")])


def _rules(days, exclude) -> dict[str, tuple[Column, str, bool]]:
    """Of each sheet: which rows pass, the column it counts, and whether it sums that column."""
    days = [dt.date.fromisoformat(d) if isinstance(d, str) else d for d in days]
    left_out = reduce(lambda a, b: a | b, [F.col("upd_day").eqNullSafe(F.lit(d)) & F.col("upd_month").eqNullSafe(F.lit(m))
                                           for d, m in exclude], F.lit(False))
    ranges = [F.col(c).between(lo, hi) for c, (lo, hi) in TABLE_RANGES.items()]
    return {
        "availability_histogram": (F.lit(True), "available_date", False),
        "listings_available": (F.col("available_date").cast("date").isin(*days), "price", False),
        "listings_over_time": (F.lit(True), "last_updated", False),
        "price_by_beds": (F.col("price").between(*PRICE_BY_BEDS_RANGE), "price", True),
        "price_trend": ((F.col("price") <= PRICE_TREND_MAX) & ~left_out, "price", True),
        "listing_table": (reduce(lambda a, b: a & b, ranges), "price", True),
    }


def _used(sheets) -> list[str]:
    """The group columns that some of the sheets have."""
    return [k for k in KEYS if any(k in SHEETS[s] for s in sheets)]


def _all_keys(sheets) -> list[Column]:
    """``KEYS``, those that no sheet has as NULL."""
    kinds = {"number_of_beds": "double", "id": "long", "area": "string", "location": "string", "amenities": "string"}
    used = _used(sheets)
    return [F.col(k) if k in used else F.lit(None).cast(kinds.get(k, "int")).alias(k) for k in KEYS]


def _expanded(df: DataFrame, sheets: list[str], days, areas, exclude, sign: str | None) -> DataFrame:
    """One row for each row and sheet it passes: ``sheet``, the group columns, and the measures ``one, counted, price``.

    With the listing table among the sheets also its ``n_beds, n_baths``.
    """
    rules, used = _rules(days, exclude), _used(sheets)
    beds = [c for c in ("n_beds", "n_baths") if "listing_table" in sheets]
    rows = _keyed(area_filter(df, areas), [sign] if sign else [])
    one = F.col(sign).cast("long") if sign else F.lit(1).cast("long")

    def of_sheet(s: str) -> Column:
        passes, counted, summed = rules[s]
        keys = [(F.col(k) if k in SHEETS[s] else F.lit(None).cast(rows.schema[k].dataType)).alias(k) for k in used]
        table = s == "listing_table"
        return F.struct(
            F.coalesce(passes, F.lit(False)).alias("passes"), *keys, one.alias("one"),
            F.when(F.col(counted).isNotNull(), one).otherwise(F.lit(0).cast("long")).alias("counted"),
            (F.col("price").cast("long") if summed else F.lit(None).cast("long")).alias("price"),
            *[(F.col(c) if table else F.lit(None).cast("double")).alias(c) for c in beds]).alias(s)

    wide = rows.select(*[of_sheet(s) for s in sheets])
    return wide.unpivot([], sheets, "sheet", "v").filter("v.passes").select("sheet", "v.*")


def sheet_states(df: DataFrame, days, areas=None, sheets=tuple(ADDITIVE), exclude=((None, None),),
                 sign: str | None = None) -> DataFrame:
    """Additive states of A1-A5: ``sheet``, the group columns ``KEYS``, ``n_rows, n, price_sum``.

    ``sign`` names a column of +1 and -1; groups whose rows cancel out stay in.
    """
    rows = _expanded(df, list(sheets), days, areas, exclude, sign)
    out = rows.groupBy("sheet", *_used(sheets)).agg(
        F.sum("one").alias("n_rows"), F.sum("counted").alias("n"), F.sum(F.col("one") * F.col("price")).alias("price_sum"))
    return out.select("sheet", *_all_keys(sheets), *STATE)


def fold_states(states: DataFrame) -> DataFrame:
    """States added up by group, without the groups that have no rows left."""
    return (states.groupBy("sheet", *KEYS).agg(*[F.sum(c).alias(c) for c in STATE]).filter("n_rows > 0"))


def sheets_of_states(states: DataFrame) -> DataFrame:
    """``sheet, KEYS, n, avg_price`` of added-up states."""
    return states.select("sheet", *KEYS, "n", (F.col("price_sum") / F.nullif(F.col("n"), F.lit(0))).alias("avg_price"))


def dashboard_overview(df: DataFrame, days, areas=None, sheets=tuple(SHEETS), exclude=((None, None),)) -> DataFrame:
    """A1-A6 from one scan: ``sheet``, ``KEYS`` and the sheets' measures.

    ``n`` is the sheet's count, ``avg_price`` the average of A4 and A5;
    ``sum_*`` and ``attr_*`` are the listing table's. What a sheet does not
    have is NULL.
    """
    rows = _expanded(df, list(sheets), days, areas, exclude, None)
    table, cols = F.col("sheet") == "listing_table", ("n_beds", "n_baths", "price")
    has = [c for c in cols if c in rows.columns] if "listing_table" in sheets else []
    out = rows.groupBy("sheet", *_used(sheets)).agg(
        F.sum("counted").alias("n"), F.sum("price").alias("sum_price"),
        *[F.sum(c).alias(f"sum_{c}") for c in has if c != "price"], *[attr(c).alias(f"attr_{c}") for c in has])
    kinds = {"sum_price": "long", "sum_n_beds": "double", "sum_n_baths": "double"}
    of_table = [F.when(table, F.col(m)).alias(m) if has else F.lit(None).cast(kinds.get(m, "string")).alias(m)
                for m in (f"{p}_{c}" for p in ("sum", "attr") for c in cols)]
    return out.select(
        "sheet", *_all_keys(sheets), F.when(~table, F.col("n")).alias("n"),
        F.when(~table, F.col("sum_price") / F.nullif(F.col("n"), F.lit(0))).alias("avg_price"), *of_table)
