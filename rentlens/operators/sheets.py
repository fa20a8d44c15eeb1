"""Dashboard sheets as DataFrame functions.

Each sheet is filter -> group -> aggregate over the listings table. All
aggregates are algebraic (count/sum/avg/min/max), so Spark runs them as a
partial aggregate before the shuffle and a final one after it: only one row
per group and map task crosses the network, whatever the skew of a key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.derive import agent_label, attr, date_part, detail_label, number_of_beds, price_bin
from ..schema import PREVIEW_ROWS, PRICE_BY_BEDS_RANGE, PRICE_TREND_MAX, TABLE_RANGES
from .filters import apply_selection, area_filter, exclude_members, in_list, range_filter, ranges_filter

# Keys of the listing-table selection (the 8-tuple pushed to the detail sheets).
SELECTION_KEYS = ["amenities", "area", "avail_month", "avail_day", "id",
                  "upd_month", "upd_day", "location"]


def with_date_keys(df: DataFrame, avail: str = "available_date", upd: str = "last_updated") -> DataFrame:
    """Month/day of the available and updated dates, as the sheets use them."""
    return df.withColumns({
        "avail_month": date_part(avail, "month"), "avail_day": date_part(avail, "day"),
        "upd_month": date_part(upd, "month"), "upd_day": date_part(upd, "day"),
    })


def availability_histogram(df: DataFrame, grain: str = "month", areas=None,
                           col: str = "available_date") -> DataFrame:
    """A1: listings by MONTH (or ISO WEEK) of availability; years add up."""
    df = area_filter(df, areas)
    return (df.groupBy(date_part(col, grain).alias(f"avail_{grain}"))
            .agg(F.count(col).alias("n_available")))


def listings_available(df: DataFrame, days, areas=None, col: str = "available_date") -> DataFrame:
    """A2: COUNT(price) per area for listings available on the given days."""
    df = area_filter(in_list(df, col, days, as_date=True), areas)
    return df.groupBy("area").agg(F.count("price").alias("n_listings"))


def listings_over_time(df: DataFrame, areas=None, rollup: bool = False,
                       col: str = "last_updated") -> DataFrame:
    """A3: COUNT(last_updated) per year/quarter/month/day of the update date.

    Only combinations that occur are returned; the NULL bucket stays with a
    count of 0. ``rollup=True`` adds the drill-up subtotals and a
    ``grouping_level`` bitmask (year is the high bit) to tell them apart.
    """
    df = area_filter(df, areas).select(
        date_part(col, "year").alias("upd_year"), date_part(col, "quarter").alias("upd_quarter"),
        date_part(col, "month").alias("upd_month"), date_part(col, "day").alias("upd_day"),
        F.col(col))
    keys = ["upd_year", "upd_quarter", "upd_month", "upd_day"]
    if not rollup:
        return df.groupBy(*keys).agg(F.count(col).alias("n_listings"))
    return (df.rollup(*keys)
            .agg(F.count(col).alias("n_listings"), F.grouping_id().cast("int").alias("grouping_level")))


def price_by_beds(df: DataFrame, lo=PRICE_BY_BEDS_RANGE[0], hi=PRICE_BY_BEDS_RANGE[1],
                  areas=None, area_selection=None) -> DataFrame:
    """A4 (flagship): AVG(price) per number of beds.

    F4 price range, F8 area picked on the treemap (``area_selection``: list
    of areas or a DataFrame with an ``area`` column; ``None`` = all) and the
    shared F2 area filter.
    """
    df = range_filter(df, "price", lo, hi)
    if area_selection is not None:
        sel = area_selection if isinstance(area_selection, DataFrame) else [(a,) for a in area_selection]
        df = apply_selection(df, sel, ["area"])
    df = area_filter(df, areas)
    return (df.groupBy(number_of_beds().alias("number_of_beds"))
            .agg(F.avg("price").alias("avg_price"), F.count("price").alias("n_listings")))


def price_trend(df: DataFrame, hi=PRICE_TREND_MAX, exclude=((None, None),), areas=None,
                col: str = "last_updated") -> DataFrame:
    """A5: AVG(price) per MONTH x DAY of the update date.

    F5 ``price <= hi``; F6 drops the excluded (day, month) members, null-safe
    (the stored exclusion is (NULL, NULL), i.e. listings never updated).
    """
    df = range_filter(df, "price", None, hi)
    df = df.withColumns({"upd_day": date_part(col, "day"), "upd_month": date_part(col, "month")})
    df = area_filter(exclude_members(df, ["upd_day", "upd_month"], exclude), areas)
    return df.groupBy("upd_month", "upd_day").agg(F.avg("price").alias("avg_price"))


def price_change_mom(df: DataFrame, by: str = "area", hi=PRICE_TREND_MAX, areas=None,
                     col: str = "last_updated") -> DataFrame:
    """Average price per (group, year, month) and its change from the previous month.

    The window runs on the aggregate (groups x months rows), never on the
    raw listings, so a hot group costs one short partition.
    """
    df = area_filter(range_filter(df, "price", None, hi), areas).filter(F.col(col).isNotNull())
    monthly = (df.groupBy(by, date_part(col, "year").alias("upd_year"),
                          date_part(col, "month").alias("upd_month"))
               .agg(F.avg("price").alias("avg_price"), F.count("price").alias("n_listings")))
    w = Window.partitionBy(by).orderBy("upd_year", "upd_month")
    # The month before, not just the last month with listings.
    month = F.col("upd_year") * 12 + F.col("upd_month")
    prev = F.when(month - F.lag(month).over(w) == 1, F.lag("avg_price").over(w))
    return (monthly.withColumn("prev_avg_price", prev)
            .withColumn("change", F.col("avg_price") - F.col("prev_avg_price"))
            .withColumn("change_ratio", F.col("change") / F.col("prev_avg_price")))


def listing_table_rows(df: DataFrame, ranges=None, areas=None) -> DataFrame:
    """A6, row stage: F3 ranges (baths 0-11.5, beds 1-11, price 0-50000), F2
    areas, and the month/day keys."""
    ranges = TABLE_RANGES if ranges is None else ranges
    return with_date_keys(area_filter(ranges_filter(df, ranges), areas))


TABLE_KEYS = ["id", "area", "location", "avail_month", "avail_day", "amenities", "upd_month", "upd_day"]


def listing_table_agg(rows: DataFrame) -> DataFrame:
    """A6, aggregate stage: SUM and ATTR of beds, baths and price per listing key."""
    return (rows.groupBy(*TABLE_KEYS)
            .agg(F.sum("n_beds").alias("sum_n_beds"), F.sum("n_baths").alias("sum_n_baths"),
                 F.sum("price").cast("bigint").alias("sum_price"),
                 attr("n_beds").alias("attr_n_beds"), attr("n_baths").alias("attr_n_baths"),
                 attr("price").alias("attr_price")))


def listing_table(df: DataFrame, ranges=None, areas=None) -> DataFrame:
    """One row per listing key (id, area, location, month/day available,
    amenities, month/day updated) with SUM and ATTR of beds, baths and price."""
    return listing_table_agg(listing_table_rows(df, ranges, areas))


def listing_detail(df: DataFrame, selection=None, areas=None) -> DataFrame:
    """Detail card of the selected listings (F7 selection, F2 areas).

    Grouped by utilities, location and the update day; ATTR of amenities,
    price, beds and baths; ``label`` is the rendered card (P25).
    """
    df = area_filter(apply_selection(with_date_keys(df), selection, SELECTION_KEYS), areas)
    g = (df.groupBy("utilities", "location", date_part("last_updated", "daytrunc").alias("upd_date"))
         .agg(attr("amenities").alias("attr_amenities"), attr("price").alias("attr_price"),
              attr("n_beds").alias("attr_n_beds"), attr("n_baths").alias("attr_n_baths")))
    return g.withColumn("label", detail_label("attr_price", "attr_n_beds", "attr_n_baths", "location",
                                              "upd_date", "utilities", "attr_amenities"))


def agent_detail(df: DataFrame, selection=None, areas=None) -> DataFrame:
    """Distinct agent of the selected listings, with its rendered card."""
    df = area_filter(apply_selection(with_date_keys(df), selection, SELECTION_KEYS), areas)
    return (df.select("agent_name", "agent_phone", "agent_email", "agent_fees").distinct()
            .withColumn("label", agent_label()))


def default_rollup(df: DataFrame) -> DataFrame:
    """A10: table-level default aggregates: SUM of numbers, COUNT of strings."""
    return df.agg(
        F.sum("id").cast("bigint").alias("sum_id"), F.sum("price").cast("bigint").alias("sum_price"),
        F.sum("n_beds").alias("sum_n_beds"), F.sum("n_baths").alias("sum_n_baths"),
        *[F.count(c).alias(f"cnt_{c}") for c in
          ("location", "area", "utilities", "amenities", "agent_name", "agent_email",
           "agent_phone", "agent_fees")])


def default_years(df: DataFrame, col: str = "last_updated") -> DataFrame:
    """A10: a date at its default level (YEAR) — the distinct years and their rows."""
    return df.groupBy(date_part(col, "year").alias("year")).agg(F.count(F.lit(1)).alias("n_rows"))


def row_count(df: DataFrame) -> DataFrame:
    """A11 as a frame (one row), so it composes with other plans."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def manual_key(col: str, order) -> list:
    """O1's sort key: the place in an explicit member list (NULL allowed in it), others last, then the member."""
    order = list(order)
    key = F.lit(len(order))
    for i, m in reversed(list(enumerate(order))):
        key = F.when(F.col(col).eqNullSafe(F.lit(m)), F.lit(i)).otherwise(key)
    return [key, F.col(col).asc_nulls_first()]


def manual_sort(df: DataFrame, col: str, order) -> DataFrame:
    """O1: sort by an explicit member list."""
    return df.orderBy(*manual_key(col, order))


def preview(df: DataFrame, order=("id",), n: int = PREVIEW_ROWS) -> DataFrame:
    """O2/O3: dimension sort and the 10000-row preview (TakeOrderedAndProject)."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in order]).limit(n)


def nth_smallest_key(keys: DataFrame, key: str, n: int) -> tuple:
    """``(T, c)``: the ``n``-th smallest distinct non-NULL ``key`` and how many
    distinct keys are <= T (``c < n`` means there are fewer than ``n``).

    A plain ``distinct().orderBy().limit(n)`` merges ``n`` keys from every
    partition in one task. Here sketches (partial aggregates) pick a bound
    holding about ``2n`` distinct keys, the exact top ``n`` runs on the keys
    under it, and the bound widens if the sketch fell short, so the result
    is exact and no task sees more than a few ``n`` keys.
    """
    ids = keys.select(key).filter(F.col(key).isNotNull())
    nd = ids.agg(F.approx_count_distinct(key, 0.02).alias("nd")).first()["nd"] or 0
    frac = 2.0 * n / nd if nd else 1.0
    while frac < 1.0:
        bound = ids.agg(F.percentile_approx(key, F.lit(frac), F.lit(10000)).alias("b")).first()["b"]
        cand = ids.filter(F.col(key) <= F.lit(bound)).distinct()
        top = cand.orderBy(key).limit(n).agg(F.max(key).alias("t"), F.count(F.lit(1)).alias("c")).first()
        if top["c"] >= n:
            return top["t"], top["c"]
        frac *= 4
    top = ids.distinct().orderBy(key).limit(n).agg(F.max(key).alias("t"), F.count(F.lit(1)).alias("c")).first()
    return top["t"], top["c"]


def preview_grouped(rows: DataFrame, sheet, key: str = "id", n: int = PREVIEW_ROWS) -> DataFrame:
    """O3 pushed below an aggregate: ``preview(sheet(rows), [key], n)``.

    ``sheet`` must be a pure group-by with ``key`` among its group keys, and
    ``rows`` the rows it groups (after every row filter). Every group among
    the first ``n`` by ``key`` then has a key no greater than the ``n``-th
    smallest distinct key ``T``, found from the key column alone
    (``nth_smallest_key``); only rows with ``key <= T`` (or a NULL key, which
    sorts first) reach the aggregate's shuffle.
    """
    t, c = nth_smallest_key(rows, key, n)
    if c is not None and c >= n:
        rows = rows.filter(F.col(key).isNull() | (F.col(key) <= F.lit(t)))
    return preview(sheet(rows), [key], n)


def unpivot_measures(df: DataFrame, ids, measures=("sum_n_beds", "sum_n_baths", "sum_price"),
                     names=None) -> DataFrame:
    """Wide measures to (measure, value) rows; NULL values are kept."""
    names = list(names or measures)
    cols = [F.col(m).cast("double").alias(n) for m, n in zip(measures, names)]
    wide = df.select(*ids, *cols)
    return wide.unpivot(list(ids), names, "measure", "value")


def price_bins(df: DataFrame, size=None, peg=None) -> DataFrame:
    """P23 used as a dimension: listings per price bin."""
    kw = {}
    if size is not None:
        kw["size"] = size
    if peg is not None:
        kw["peg"] = peg
    return (df.groupBy(price_bin("price", **kw).alias("price_bin"))
            .agg(F.count("price").alias("n_listings"), F.min("price").alias("min_price"),
                 F.max("price").alias("max_price")))
