"""Derived dashboard fields as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import DRILL_FIELDS, DRILL_TARGET, PRICE_BIN_PEG, PRICE_BIN_SIZE


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def attr(col) -> Column:
    """The single value of a group, NULL when it has none, else ``*``.

    Built from min/max so it is a partial (map-side) aggregate. Numbers are
    rendered with Spark's string cast (2895, 1.5).
    """
    c = _c(col)
    lo, hi = F.min(c), F.max(c)
    return (F.when(lo.isNull(), F.lit(None).cast("string"))
            .when(lo == hi, lo.cast("string"))
            .otherwise(F.lit("*")))


def number_of_beds(col="n_beds") -> Column:
    """The ``Number of Beds`` dimension is a copy of ``n_beds``."""
    return _c(col)


def price_bin(col="price", size: int = PRICE_BIN_SIZE, peg: int = PRICE_BIN_PEG) -> Column:
    """Lower edge of the fixed-width bin holding the value."""
    c = _c(col)
    return (F.floor((c - F.lit(peg)) / F.lit(size)) * F.lit(size) + F.lit(peg)).cast("bigint")


def date_part(col, part: str) -> Column:
    """YEAR/QUARTER/MONTH/WEEK(ISO)/DAY of a date as int; DAYTRUNC as date."""
    c = _c(col)
    part = part.lower()
    if part == "year":
        return F.year(c)
    if part == "quarter":
        return F.quarter(c)
    if part == "month":
        return F.month(c)
    if part == "week":
        return F.weekofyear(c)
    if part == "day":
        return F.dayofmonth(c)
    if part == "daytrunc":
        return F.date_trunc("day", c).cast("date")
    raise ValueError(f"unknown date part {part!r}")


def detail_label(price="price", n_beds="n_beds", n_baths="n_baths", location="location",
                 last_updated="last_updated", utilities="utilities", amenities="amenities") -> Column:
    """P25: the listing detail card as lines of text (NULL parts render empty)."""
    s = lambda c: F.coalesce(_c(c).cast("string"), F.lit(""))
    return F.concat(
        F.lit("\nPrice: "), s(price), F.lit(" $\nBeds: "), s(n_beds),
        F.lit("\nBaths: "), s(n_baths), F.lit("\nLocation: "), s(location),
        F.lit("\nLast Updated: "), s(last_updated), F.lit("\n\n"), s(utilities),
        F.lit("\n"), s(amenities))


def agent_label(name="agent_name", phone="agent_phone", email="agent_email",
                fees="agent_fees") -> Column:
    """P25: the agent card."""
    s = lambda c: F.coalesce(_c(c).cast("string"), F.lit(""))
    return F.concat(s(name), F.lit("\n"), s(phone), F.lit("\n"), s(email),
                    F.lit("\nAgent Fees: "), s(fees))


def drill_url(fields=DRILL_FIELDS, target: str = DRILL_TARGET) -> Column:
    """Link to the target sheet with URL-escaped key=value pairs.

    NULL values are included as an empty value. Escaping is form style
    (space becomes ``+``).
    """
    parts = []
    for i, f in enumerate(fields):
        val = F.coalesce(F.url_encode(_c(f).cast("string")), F.lit(""))
        parts += [F.lit(("?" if i == 0 else "&") + f + "="), val]
    return F.concat(F.lit(target), *parts)
