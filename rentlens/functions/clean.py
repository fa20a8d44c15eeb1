"""Cleaning rules as Column expressions.

Everything here is a built-in expression (regexp_replace, try_cast,
try_to_timestamp, variant_get), so cleaning runs inside whole-stage codegen
with no Python in the row path. ANSI mode is on: only ``try_*`` casts and
``get`` are used on dirty text.
"""

from __future__ import annotations

import datetime as dt
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import (
    AIR_CONDITIONING_LABEL, AMENITIES_PREFIX, DISH_WASHER_LABEL, ELECTRICITY_NO, ELECTRICITY_YES,
    HEAT_NO, HEAT_YES, HOT_WATER_NO, HOT_WATER_YES, LAUNDRY_LABEL, PARKING_LABEL, UTILITIES_PREFIX,
)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- text ------------------------------------------------------------------

def strip_text(col) -> Column:
    """Strip surrounding whitespace including newlines and tabs."""
    return F.regexp_replace(_c(col), r"(?U)^\s+|\s+$", "")


def null_if_blank(col) -> Column:
    """P19: '' and NULL alike (as NULL)."""
    c = _c(col)
    return F.when(c == "", F.lit(None).cast("string")).otherwise(c)


def href_payload(col) -> Column:
    """Text after the first ':' up to the next one (``mailto:a@b`` -> ``a@b``)."""
    return F.get(F.split(_c(col), ":"), 1)


def first_number(col) -> Column:
    """H6: first run of digits as int; NULL when there is none."""
    s = F.regexp_extract(_c(col), r"(\d+)", 1)
    return F.when(s == "", F.lit(None).cast("int")).otherwise(s.try_cast("int"))


# --- numbers ---------------------------------------------------------------

def clean_price_api(col) -> Column:
    """Drop '$' and ',' then parse an int; anything else (``1500.00``) is NULL."""
    return F.regexp_replace(_c(col), r"[$,]", "").try_cast("int")


def clean_price_html(col) -> Column:
    """Drop every non-digit then parse (``$2,895.00`` -> 289500); '' is NULL."""
    s = F.regexp_replace(_c(col), r"[^0-9]", "")
    return F.when(s == "", F.lit(None).cast("int")).otherwise(s.try_cast("int"))


def clean_price_tolerant(col) -> Column:
    """Notebook rule, plain int parse; unparsable -> NULL (counted as a warning)."""
    return strip_text(_c(col).cast("string")).try_cast("int")


def clean_count_raw_default(col) -> Column:
    """P5: NULL, '0' or '' -> 1.0; else keep [0-9.] and parse ('Studio' -> NULL)."""
    c = _c(col)
    parsed = F.regexp_replace(c, r"[^0-9.]", "").try_cast("double")
    return F.when(c.isNull() | c.isin("0", ""), F.lit(1.0)).otherwise(parsed)


def clean_count_stripped_default(col) -> Column:
    """Keep [0-9.] first, then '0'/'' -> 1.0 ('Studio' -> 1.0, '1-2' -> 12.0)."""
    s = F.regexp_replace(strip_text(col), r"[^0-9.]", "")
    return F.when(s.isNull() | s.isin("0", ""), F.lit(1.0)).otherwise(s.try_cast("double"))


# --- dates -----------------------------------------------------------------

# Free-form dates. Shapes, in order: ISO date (optional time and zone, via
# Spark's own timestamp cast); a/b/yyyy or a/b/yy, month first unless the
# first number cannot be a month; yyyy/m/d; month name, day, year; m/d
# without a year. Numbers are pulled out with one regex per shape and the
# date is built through the string-to-date cast, which yields NULL for
# impossible dates instead of throwing.
_SLASH = r"^(\d{1,2})[/-](\d{1,2})(?:[/-](\d{4}|\d{2}))?$"
_YMD = r"^(\d{4})/(\d{1,2})/(\d{1,2})$"
_COMPACT = r"^(\d{4})(\d{2})(\d{2})$"
_NAMED = r"^([A-Za-z]+)\.? (\d{1,2})(?:,? (\d{4}))?$"
_DAY_NAMED = r"^(\d{1,2}) ([A-Za-z]+)\.?,?(?: (\d{4}))?$"
_WEEKDAY = r"(?i)^(?:mon|tue|tues|wed|thu|thur|thurs|fri|sat|sun)(?:day|sday|nesday|rsday|urday)?,? +"
# A time of day behind a date, and the offset behind an ISO date and time.
_TIME = r"^(.*\d) (\d{1,2}):(\d{2})(?::(\d{2}))? ?([AaPp][Mm])?$"
_OFFSET = r"^(.*\d:\d{2}(?:[:.]\d{1,9}){0,2}) ?(?:Z|[+-]\d{2}:?\d{2})$"
# Month names.
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october",
          "november", "december"]


def _ymd(y: Column, m: Column, d: Column) -> Column:
    # A NULL part makes the text NULL; each part is read once.
    txt = F.concat(F.lpad(y.cast("string"), 4, "0"), F.lit("-"), F.lpad(m.cast("string"), 2, "0"), F.lit("-"),
                   F.lpad(d.cast("string"), 2, "0"))
    return txt.try_cast("date").cast("timestamp_ntz")


def _month_number(name: Column) -> Column:
    """1 to 12 for a month's full name, three letters, or ``sept``; else NULL."""
    numbers = {"sept": 9} | {n: i for i, m in enumerate(MONTHS, 1) for n in (m, m[:3])}
    return F.try_element_at(F.create_map(*[F.lit(x) for x in chain.from_iterable(numbers.items())]), F.lower(name))


def parse_datetime_flexible(col, as_of: dt.date | None = None, stripped: bool = False) -> Column:
    """Free-form date text -> timestamp (NULL when no shape matches).

    Two-digit years fall in the 100-year window around ``as_of`` (a year 50
    or more ahead goes back a century). ``m/d`` without a year takes the
    year of ``as_of`` (default: today), the way a free-form parser fills
    missing fields from the current date. ``stripped=True`` when ``col`` is
    already stripped.

    The written wall clock is kept: an offset is cut, not applied. Month names
    count in full, as their first three letters, or as ``Sept``. A weekday in
    front is skipped, and a time of day (also with AM or PM) is kept.

    The text is bound once by a lambda variable, since every shape test reads it
    and Spark does not share subexpressions across conditional branches.
    """
    s = _c(col) if stripped else strip_text(col)
    year = (as_of or dt.date.today()).year
    parts = F.transform(F.array(s), _split_date_text)
    any_shape = F.get(F.transform(parts, lambda p: F.coalesce(
        p["iso"], _date_of_shape(p["text"], year) + F.make_dt_interval(secs=p["clock"].cast("decimal(18,6)")))), 0)
    return F.when(s.isNotNull(), F.coalesce(_iso_timestamp(s), any_shape))


def _iso_timestamp(t: Column) -> Column:
    """Text that begins with an ISO date, without its offset; NULL for any other."""
    return F.when(t.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), F.regexp_replace(t, _OFFSET, "$1").try_cast("timestamp_ntz"))


def _split_date_text(s: Column) -> Column:
    """ISO timestamp if it is one, else the date's text and the seconds of its time of day."""
    def split(t):
        hour, half = F.regexp_extract(t, _TIME, 2).try_cast("int"), F.lower(F.regexp_extract(t, _TIME, 5))
        hour = (F.when(half == "", F.when(hour < 24, hour)).when(~hour.between(1, 12), None)
                .otherwise(hour % 12 + F.when(half == "pm", 12).otherwise(0)))
        minute = F.regexp_extract(t, _TIME, 3).try_cast("int")
        second = F.coalesce(F.regexp_extract(t, _TIME, 4).try_cast("int"), F.lit(0))
        seconds = F.when((minute < 60) & (second < 60), hour * 3600 + minute * 60 + second)
        timed = t.rlike(_TIME)
        return F.struct(_iso_timestamp(t).alias("iso"), F.when(timed, F.regexp_extract(t, _TIME, 1)).otherwise(t).alias("text"),
                        F.when(timed, seconds).otherwise(0).alias("clock"))

    return F.get(F.transform(F.array(F.regexp_replace(s, _WEEKDAY, "")), split), 0)


def _date_of_shape(s: Column, year: int, named_months: bool = True) -> Column:
    """Date written in one of the shapes above, at midnight."""
    def slash(parts):
        a, b, ytxt = F.get(parts, 0).try_cast("int"), F.get(parts, 1).try_cast("int"), F.get(parts, 2)
        near = ytxt.try_cast("int") + (year // 100 * 100)
        y = (F.when(ytxt.isNull(), F.lit(year)).when(F.length(ytxt) == 4, ytxt.try_cast("int"))
             .otherwise(F.when(near - year >= 50, near - 100).otherwise(near)))
        return F.when(a <= 12, _ymd(y, a, b)).otherwise(_ymd(y, b, a))

    # The numbers are parted once.
    slashed = F.when(s.rlike(_SLASH), F.get(F.transform(F.array(F.split(s, "[/-]")), slash), 0))

    def numbered(shape):
        return F.when(s.rlike(shape), _ymd(*[F.regexp_extract(s, shape, i) for i in (1, 2, 3)]))

    def named(shape, month_at, day_at):
        y = F.regexp_extract(s, shape, 3)
        return F.when(s.rlike(shape), _ymd(F.when(y == "", F.lit(str(year))).otherwise(y),
                                           _month_number(F.regexp_extract(s, shape, month_at)),
                                           F.regexp_extract(s, shape, day_at)))

    shapes = [slashed, numbered(_YMD), numbered(_COMPACT)]
    return F.coalesce(*shapes, *([named(_NAMED, 1, 2), named(_DAY_NAMED, 2, 1)] if named_months else []))


def to_date_trunc(col) -> Column:
    """Timestamp -> date."""
    return _c(col).cast("date")


def available_digits(col) -> Column:
    """P9, first step: keep [0-9/] of the stripped text."""
    return F.regexp_replace(strip_text(col), r"[^0-9/]", "")


def clean_available_html(col, as_of: dt.date, digits: bool = False) -> Column:
    """Keep [0-9/]; empty -> ``as_of``; else the flexible parse.

    ``digits=True`` when ``col`` already holds ``available_digits`` (computed
    once in an earlier projection; the parse reads it many times).
    """
    s = _c(col) if digits else available_digits(col)
    # Digits and slashes only: no month names, no times, no ISO dates.
    parsed = F.get(F.transform(F.array(s), lambda t: _date_of_shape(t, as_of.year, named_months=False)), 0)
    return F.when(s.isNull() | (s == ""), F.lit(as_of).cast("timestamp_ntz")).otherwise(parsed)


def parse_iso_date(col) -> Column:
    """P10: strict yyyy-MM-dd; NULL or '' -> NULL."""
    return F.try_to_timestamp(_c(col), F.lit("yyyy-MM-dd")).cast("date")


# --- JSON (variant) flags --------------------------------------------------

_NUMERIC_OR_BOOL = r"^(BOOLEAN|BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL)"


def vtype(item, path: str) -> Column:
    """JSON type name of ``path`` (``VOID`` for JSON null, NULL when missing)."""
    return F.schema_of_variant(F.variant_get(_c(item), path, "variant"))


def vstr(item, path: str) -> Column:
    """String value of ``path``; numbers and booleans rendered as text."""
    return F.try_variant_get(_c(item), path, "string")


def flag_equals_true(item, path: str) -> Column:
    """``value == True`` with JSON typing: boolean true or a number equal to 1."""
    num = F.try_variant_get(_c(item), path, "double")
    return F.coalesce((num == 1.0) & vtype(item, path).rlike(_NUMERIC_OR_BOOL), F.lit(False))


def flag_equals_string(item, path: str, value: str) -> Column:
    """``value == "1"``: only a JSON string with that exact text."""
    return F.coalesce((vstr(item, path) == value) & (vtype(item, path) == "STRING"), F.lit(False))


def fee_flag(item, path: str = "$.fee") -> Column:
    """P16: 'No' when the fee equals 0 (0, 0.0, false); 'Yes' otherwise (NULL, "0")."""
    num = F.try_variant_get(_c(item), path, "double")
    is_zero = F.coalesce((num == 0.0) & vtype(item, path).rlike(_NUMERIC_OR_BOOL), F.lit(False))
    return F.when(is_zero, F.lit("No")).otherwise(F.lit("Yes"))


def utilities_text(heat: Column, hot_water: Column, electricity: Column) -> Column:
    """Utilities sentence from three boolean conditions (fixed wording)."""
    pick = lambda cond, yes, no: F.when(cond, F.lit(yes)).otherwise(F.lit(no))
    return F.concat(F.lit(UTILITIES_PREFIX), pick(heat, HEAT_YES, HEAT_NO),
                    pick(hot_water, HOT_WATER_YES, HOT_WATER_NO),
                    pick(electricity, ELECTRICITY_YES, ELECTRICITY_NO))


def amenities_text(parking: Column, dish_washer: Column, laundry: Column, air_conditioning: Column,
                   prefix: str = AMENITIES_PREFIX) -> Column:
    """Amenities sentence; blank or NULL text reads 'No'."""
    txt = lambda c: F.coalesce(null_if_blank(c), F.lit("No"))
    return F.concat(
        F.lit(prefix), F.lit(PARKING_LABEL), txt(parking), F.lit(", "),
        F.lit(DISH_WASHER_LABEL), F.when(dish_washer, F.lit("Yes")).otherwise(F.lit("No")), F.lit(", "),
        F.lit(LAUNDRY_LABEL), txt(laundry), F.lit(", "),
        F.lit(AIR_CONDITIONING_LABEL), txt(air_conditioning), F.lit("."))


def coalesce_location(street_address: Column, sub_area: Column) -> Column:
    """The street address when non-empty, else the sub-area name."""
    return F.coalesce(null_if_blank(street_address), sub_area)
