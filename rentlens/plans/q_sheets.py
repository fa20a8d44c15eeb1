"""Dashboard sheet queries over the listings stand-in, with oracle SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.derive import date_part, detail_label, drill_url
from ..operators import dashboard as dash
from ..operators import filters as flt
from ..operators import sheets as sh
from ..operators.tables import upsert_by_key
from .registry import register
from .standins import silver_listings, with_listings

# Days of the "available today" sheet (a parameter; the stored sheet froze
# three days of its own capture, these lie inside the test data's range).
AVAILABLE_DAYS = ["1996-08-03", "1996-08-04", "1996-08-05"]
SELECTED_AREAS = ["ASIA", "EUROPE"]
MONTH_ORDER = [None, 4, 5, 6, 7, 8]

# SQL fragments shared by several oracle queries.
_MD = """CAST(month(available_date) AS INTEGER) AS avail_month,
 CAST(dayofmonth(available_date) AS INTEGER) AS avail_day,
 CAST(month(last_updated) AS INTEGER) AS upd_month,
 CAST(dayofmonth(last_updated) AS INTEGER) AS upd_day"""


def _attr_sql(x: str) -> str:
    return (f"CASE WHEN min({x}) IS NULL THEN NULL WHEN min({x}) = max({x}) "
            f"THEN CAST(min({x}) AS VARCHAR) ELSE '*' END")


_DETAIL_LABEL_SQL = """concat(chr(10), 'Price: ', coalesce(attr_price, ''), ' $', chr(10), 'Beds: ',
 coalesce(attr_n_beds, ''), chr(10), 'Baths: ', coalesce(attr_n_baths, ''), chr(10), 'Location: ',
 coalesce(location, ''), chr(10), 'Last Updated: ', coalesce(CAST(upd_date AS VARCHAR), ''), chr(10), chr(10),
 coalesce(utilities, ''), chr(10), coalesce(attr_amenities, ''))"""


def _top_price_selection(listings):
    """The marks a user picks: the most expensive listing of each area."""
    keyed = sh.with_date_keys(listings)
    top = listings.groupBy("area").agg(F.max("price").alias("price"))
    return keyed.join(top, ["area", "price"]).select(*sh.SELECTION_KEYS)


_SEL_SQL = f"""keyed AS (SELECT *, {_MD} FROM listings),
sel AS (SELECT k.* FROM keyed k JOIN (SELECT area, max(price) AS price FROM listings GROUP BY area) t
        ON k.area = t.area AND k.price = t.price),
picked AS (SELECT * FROM keyed k WHERE EXISTS (SELECT 1 FROM sel s WHERE
   s.amenities IS NOT DISTINCT FROM k.amenities AND s.area IS NOT DISTINCT FROM k.area
   AND s.avail_month IS NOT DISTINCT FROM k.avail_month AND s.avail_day IS NOT DISTINCT FROM k.avail_day
   AND s.id IS NOT DISTINCT FROM k.id AND s.upd_month IS NOT DISTINCT FROM k.upd_month
   AND s.upd_day IS NOT DISTINCT FROM k.upd_day AND s.location IS NOT DISTINCT FROM k.location))"""


@register("price_by_beds", with_listings("""
SELECT n_beds AS number_of_beds, avg(price) AS avg_price, count(price) AS n_listings
FROM listings WHERE price BETWEEN 300 AND 50000 GROUP BY n_beds"""))
def q_price_by_beds(spark, sf_dir):
    return sh.price_by_beds(silver_listings(spark, sf_dir))


@register("price_by_beds_selected", with_listings(f"""
SELECT n_beds AS number_of_beds, avg(price) AS avg_price, count(price) AS n_listings
FROM listings WHERE price BETWEEN 300 AND 50000 AND area IN ({", ".join(f"'{a}'" for a in SELECTED_AREAS)})
GROUP BY n_beds"""))
def q_price_by_beds_selected(spark, sf_dir):
    return sh.price_by_beds(silver_listings(spark, sf_dir), area_selection=SELECTED_AREAS)


@register("availability_histogram", with_listings("""
SELECT CAST(month(available_date) AS INTEGER) AS avail_month, count(available_date) AS n_available
FROM listings GROUP BY 1"""))
def q_availability_histogram(spark, sf_dir):
    return sh.availability_histogram(silver_listings(spark, sf_dir))


@register("availability_by_week", with_listings("""
SELECT CAST(weekofyear(available_date) AS INTEGER) AS avail_week, count(available_date) AS n_available
FROM listings GROUP BY 1"""))
def q_availability_by_week(spark, sf_dir):
    return sh.availability_histogram(silver_listings(spark, sf_dir), grain="week")


@register("listings_available", with_listings(f"""
SELECT area, count(price) AS n_listings FROM listings
WHERE CAST(available_date AS DATE) IN ({", ".join(f"DATE '{d}'" for d in AVAILABLE_DAYS)})
GROUP BY area"""))
def q_listings_available(spark, sf_dir):
    return sh.listings_available(silver_listings(spark, sf_dir), AVAILABLE_DAYS)


@register("listings_over_time", with_listings("""
SELECT CAST(year(last_updated) AS INTEGER) AS upd_year, CAST(quarter(last_updated) AS INTEGER) AS upd_quarter,
 CAST(month(last_updated) AS INTEGER) AS upd_month, CAST(dayofmonth(last_updated) AS INTEGER) AS upd_day,
 count(last_updated) AS n_listings
FROM listings GROUP BY 1, 2, 3, 4"""))
def q_listings_over_time(spark, sf_dir):
    return sh.listings_over_time(silver_listings(spark, sf_dir))


@register("listings_rollup", with_listings("""
SELECT upd_year, upd_quarter, upd_month, upd_day, count(last_updated) AS n_listings,
 CAST(grouping(upd_year, upd_quarter, upd_month, upd_day) AS INTEGER) AS grouping_level
FROM (SELECT last_updated, CAST(year(last_updated) AS INTEGER) AS upd_year,
  CAST(quarter(last_updated) AS INTEGER) AS upd_quarter, CAST(month(last_updated) AS INTEGER) AS upd_month,
  CAST(dayofmonth(last_updated) AS INTEGER) AS upd_day FROM listings) t
GROUP BY ROLLUP (upd_year, upd_quarter, upd_month, upd_day)"""))
def q_listings_rollup(spark, sf_dir):
    return sh.listings_over_time(silver_listings(spark, sf_dir), rollup=True)


@register("price_trend", with_listings("""
SELECT CAST(month(last_updated) AS INTEGER) AS upd_month, CAST(dayofmonth(last_updated) AS INTEGER) AS upd_day,
 avg(price) AS avg_price
FROM listings WHERE price <= 50000 AND NOT (last_updated IS NULL)
GROUP BY 1, 2"""))
def q_price_trend(spark, sf_dir):
    return sh.price_trend(silver_listings(spark, sf_dir))


@register("price_change_mom", with_listings("""
SELECT area, upd_year, upd_month, avg_price, n_listings, prev_avg_price,
 avg_price - prev_avg_price AS change, (avg_price - prev_avg_price) / prev_avg_price AS change_ratio
FROM (SELECT *, CASE WHEN upd_year * 12 + upd_month - lag(upd_year * 12 + upd_month)
    OVER (PARTITION BY area ORDER BY upd_year, upd_month) = 1
    THEN lag(avg_price) OVER (PARTITION BY area ORDER BY upd_year, upd_month) END AS prev_avg_price
  FROM (SELECT area, CAST(year(last_updated) AS INTEGER) AS upd_year, CAST(month(last_updated) AS INTEGER) AS upd_month,
     avg(price) AS avg_price, count(price) AS n_listings
   FROM listings WHERE price <= 50000 AND last_updated IS NOT NULL GROUP BY 1, 2, 3) m) w"""))
def q_price_change_mom(spark, sf_dir):
    return sh.price_change_mom(silver_listings(spark, sf_dir))


_TABLE_SQL = f"""SELECT id, area, location, avail_month, avail_day, amenities, upd_month, upd_day,
 sum(n_beds) AS sum_n_beds, sum(n_baths) AS sum_n_baths, CAST(sum(price) AS BIGINT) AS sum_price,
 {_attr_sql('n_beds')} AS attr_n_beds, {_attr_sql('n_baths')} AS attr_n_baths,
 {_attr_sql('price')} AS attr_price
FROM (SELECT *, {_MD} FROM listings
  WHERE n_baths BETWEEN 0 AND 11.5 AND n_beds BETWEEN 1 AND 11 AND price BETWEEN 0 AND 50000) t
GROUP BY id, area, location, avail_month, avail_day, amenities, upd_month, upd_day"""


@register("listing_table", with_listings(_TABLE_SQL))
def q_listing_table(spark, sf_dir):
    return sh.listing_table(silver_listings(spark, sf_dir))


@register("listing_table_after_upsert", with_listings(f"""
, src AS (SELECT * REPLACE (price + 1 AS price) FROM listings
          WHERE id IN (SELECT max(id) FROM listings GROUP BY location)),
mixed AS (SELECT s.* FROM listings t JOIN src s ON t.location = s.location
  UNION ALL SELECT * REPLACE (price + 3 AS price) FROM src WHERE id % 2 = 0)
{_TABLE_SQL.replace("FROM listings", "FROM mixed")}"""))
def q_listing_table_after_upsert(spark, sf_dir):
    """A6 where groups hold several rows: an upsert copied ids, and some prices differ ('*')."""
    listings = silver_listings(spark, sf_dir)
    src = (listings.groupBy("location").agg(F.max_by(F.struct(*listings.columns), F.col("id")).alias("r"))
           .select("r.*").withColumn("price", F.col("price") + 1))
    merged = upsert_by_key(listings.withColumn("ingest_seq", F.lit(0)), src.withColumn("ingest_seq", F.lit(1)),
                           key="location", order="ingest_seq").drop("ingest_seq")
    other = src.filter("id % 2 = 0").withColumn("price", F.col("price") + 3)
    return sh.listing_table(merged.unionByName(other))


def _sheet_sql(sheet: str, keys: dict[str, str], measures: dict[str, str], where: str = "") -> str:
    """One sheet with all the overview's columns."""
    types = {"area": "VARCHAR", "number_of_beds": "DOUBLE", "id": "BIGINT", "location": "VARCHAR", "amenities": "VARCHAR"}
    cols = [f"{keys.get(k, 'NULL')}::{types.get(k, 'INTEGER')} AS {k}" for k in dash.KEYS]
    kinds = {"n": "BIGINT", "avg_price": "DOUBLE", "sum_n_beds": "DOUBLE", "sum_n_baths": "DOUBLE", "sum_price": "BIGINT",
             "attr_n_beds": "VARCHAR", "attr_n_baths": "VARCHAR", "attr_price": "VARCHAR"}
    cols += [f"({measures.get(m, 'NULL')})::{t} AS {m}" for m, t in kinds.items()]
    return f"SELECT '{sheet}' AS sheet, {', '.join(cols)} FROM listings {where} GROUP BY {', '.join(keys.values())}"


_UPD = {f"upd_{p}": f"{f}(last_updated)" for p, f in
        (("year", "year"), ("quarter", "quarter"), ("month", "month"), ("day", "dayofmonth"))}
_MONTH_DAY = {k: _UPD[k] for k in ("upd_month", "upd_day")}
_DAYS_SQL = ", ".join(f"DATE '{d}'" for d in AVAILABLE_DAYS)
ADDITIVE_SQL = " UNION ALL ".join([
    _sheet_sql("availability_histogram", {"avail_month": "month(available_date)"}, {"n": "count(available_date)"}),
    _sheet_sql("listings_available", {"area": "area"}, {"n": "count(price)"},
               f"WHERE CAST(available_date AS DATE) IN ({_DAYS_SQL})"),
    _sheet_sql("listings_over_time", _UPD, {"n": "count(last_updated)"}),
    _sheet_sql("price_by_beds", {"number_of_beds": "n_beds"}, {"n": "count(price)", "avg_price": "avg(price)"},
               "WHERE price BETWEEN 300 AND 50000"),
    _sheet_sql("price_trend", _MONTH_DAY, {"n": "count(price)", "avg_price": "avg(price)"},
               "WHERE price <= 50000 AND NOT (last_updated IS NULL)")])
_TABLE_SHEET_SQL = _sheet_sql(
    "listing_table", {**{k: k for k in ("id", "area", "location", "amenities")}, **_MONTH_DAY,
                      "avail_month": "month(available_date)", "avail_day": "dayofmonth(available_date)"},
    {**{f"sum_{c}": f"sum({c})" for c in ("n_beds", "n_baths", "price")},
     **{f"attr_{c}": _attr_sql(c) for c in ("n_beds", "n_baths", "price")}},
    "WHERE n_baths BETWEEN 0 AND 11.5 AND n_beds BETWEEN 1 AND 11 AND price BETWEEN 0 AND 50000")


@register("dashboard_overview", with_listings(f"{ADDITIVE_SQL} UNION ALL {_TABLE_SHEET_SQL}"))
def q_dashboard_overview(spark, sf_dir):
    """A1-A6 out of one scan and one aggregate."""
    return dash.dashboard_overview(silver_listings(spark, sf_dir), AVAILABLE_DAYS)


@register("dashboard_overview_areas", with_listings(ADDITIVE_SQL.replace("FROM listings", "FROM picked")).replace(
    ")\nSELECT", "), picked AS (SELECT * FROM listings WHERE area IN ('ASIA', 'EUROPE'))\nSELECT", 1))
def q_dashboard_overview_areas(spark, sf_dir):
    """A1-A5 under the shared area filter, which reaches the scan as a partition filter."""
    return dash.dashboard_overview(silver_listings(spark, sf_dir), AVAILABLE_DAYS, areas=SELECTED_AREAS,
                                   sheets=list(dash.ADDITIVE))


@register("price_by_beds_areas", with_listings("""
SELECT n_beds AS number_of_beds, avg(price) AS avg_price, count(price) AS n_listings FROM listings
WHERE price BETWEEN 300 AND 50000 AND area IN ('ASIA', 'EUROPE') GROUP BY 1"""))
def q_price_by_beds_areas(spark, sf_dir):
    """the area quick filter on a sheet."""
    return sh.price_by_beds(silver_listings(spark, sf_dir), areas=["ASIA", "EUROPE"])


@register("listing_measures_long", with_listings(f"""
SELECT id, 'n_beds' AS measure, CAST(sum_n_beds AS DOUBLE) AS value FROM ({_TABLE_SQL}) a
UNION ALL SELECT id, 'price', CAST(sum_price AS DOUBLE) FROM ({_TABLE_SQL}) c"""))
def q_listing_measures_long(spark, sf_dir):
    table = sh.listing_table(silver_listings(spark, sf_dir))
    long = sh.unpivot_measures(table, ["id"], ["sum_n_beds", "sum_n_baths", "sum_price"],
                               ["n_beds", "n_baths", "price"])
    return flt.measure_filter(long, ["n_beds", "price"])


@register("listing_detail", with_listings(f""", {_SEL_SQL}
SELECT utilities, location, CAST(date_trunc('day', last_updated) AS DATE) AS upd_date,
 {_attr_sql('amenities')} AS attr_amenities, {_attr_sql('price')} AS attr_price,
 {_attr_sql('n_beds')} AS attr_n_beds, {_attr_sql('n_baths')} AS attr_n_baths
FROM picked GROUP BY 1, 2, 3""").replace("SELECT utilities, location, CAST", "SELECT *, " + _DETAIL_LABEL_SQL
   + " AS label FROM (SELECT utilities, location, CAST", 1) + ") d")
def q_listing_detail(spark, sf_dir):
    listings = silver_listings(spark, sf_dir)
    return sh.listing_detail(listings, _top_price_selection(listings))


@register("agent_detail", with_listings(f""", {_SEL_SQL}
SELECT *, concat(coalesce(agent_name, ''), chr(10), coalesce(agent_phone, ''), chr(10),
 coalesce(agent_email, ''), chr(10), 'Agent Fees: ', coalesce(agent_fees, '')) AS label
FROM (SELECT DISTINCT agent_name, agent_phone, agent_email, agent_fees FROM picked) a"""))
def q_agent_detail(spark, sf_dir):
    listings = silver_listings(spark, sf_dir)
    return sh.agent_detail(listings, _top_price_selection(listings))


@register("detail_labels", with_listings("""
SELECT id, concat(chr(10), 'Price: ', coalesce(CAST(price AS VARCHAR), ''), ' $', chr(10), 'Beds: ',
 coalesce(CAST(n_beds AS VARCHAR), ''), chr(10), 'Baths: ', coalesce(CAST(n_baths AS VARCHAR), ''),
 chr(10), 'Location: ', coalesce(location, ''), chr(10), 'Last Updated: ',
 coalesce(CAST(last_updated AS VARCHAR), ''), chr(10), chr(10), coalesce(utilities, ''), chr(10),
 coalesce(amenities, '')) AS label
FROM listings"""))
def q_detail_labels(spark, sf_dir):
    return silver_listings(spark, sf_dir).select("id", detail_label().alias("label"))


@register("exclude_null_months", with_listings("""
SELECT id, CAST(month(last_updated) AS INTEGER) AS upd_month, CAST(dayofmonth(last_updated) AS INTEGER) AS upd_day
FROM listings l WHERE NOT EXISTS (SELECT 1 FROM (SELECT NULL::INTEGER AS d, NULL::INTEGER AS m) x
  WHERE x.d IS NOT DISTINCT FROM CAST(dayofmonth(l.last_updated) AS INTEGER)
    AND x.m IS NOT DISTINCT FROM CAST(month(l.last_updated) AS INTEGER))"""))
def q_exclude_null_months(spark, sf_dir):
    df = silver_listings(spark, sf_dir).select(
        "id", date_part("last_updated", "month").alias("upd_month"),
        date_part("last_updated", "day").alias("upd_day"))
    schema = T.StructType([T.StructField("upd_day", T.IntegerType()), T.StructField("upd_month", T.IntegerType())])
    # A literal member list: its size is known, so broadcasting it is safe.
    members = F.broadcast(spark.createDataFrame([(None, None)], schema))
    return flt.exclude_members(df, ["upd_day", "upd_month"], members)


@register("level_members", with_listings("""
SELECT DISTINCT CAST(dayofmonth(last_updated) AS INTEGER) AS upd_day, CAST(month(last_updated) AS INTEGER) AS upd_month
FROM listings"""))
def q_level_members(spark, sf_dir):
    df = silver_listings(spark, sf_dir).select(
        date_part("last_updated", "day").alias("upd_day"), date_part("last_updated", "month").alias("upd_month"))
    return flt.level_members(df, ["upd_day", "upd_month"])


@register("level_cross_join", with_listings("""
SELECT d AS upd_day, m AS upd_month, area FROM
 (SELECT DISTINCT CAST(dayofmonth(last_updated) AS INTEGER) AS d FROM listings) a,
 (SELECT DISTINCT CAST(month(last_updated) AS INTEGER) AS m FROM listings) b, (SELECT DISTINCT area FROM listings) c"""))
def q_level_cross_join(spark, sf_dir):
    """All combinations of update day, update month and area."""
    df = silver_listings(spark, sf_dir).select(
        date_part("last_updated", "day").alias("upd_day"), date_part("last_updated", "month").alias("upd_month"), "area")
    return flt.level_cross_join(df, ["upd_day", "upd_month", "area"])


@register("filter_domain", with_listings("""
SELECT DISTINCT 'area' AS field, area AS member, CAST(NULL AS DOUBLE) AS lo, CAST(NULL AS DOUBLE) AS hi FROM listings
UNION ALL SELECT 'price', NULL, CAST(min(price) AS DOUBLE), CAST(max(price) AS DOUBLE) FROM listings
UNION ALL SELECT 'n_beds', NULL, min(n_beds), max(n_beds) FROM listings
UNION ALL SELECT 'n_baths', NULL, min(n_baths), max(n_baths) FROM listings"""))
def q_filter_domain(spark, sf_dir):
    return flt.filter_domain(silver_listings(spark, sf_dir))


@register("default_rollup", with_listings("""
SELECT CAST(sum(id) AS BIGINT) AS sum_id, CAST(sum(price) AS BIGINT) AS sum_price, sum(n_beds) AS sum_n_beds,
 sum(n_baths) AS sum_n_baths, count(location) AS cnt_location, count(area) AS cnt_area,
 count(utilities) AS cnt_utilities, count(amenities) AS cnt_amenities, count(agent_name) AS cnt_agent_name,
 count(agent_email) AS cnt_agent_email, count(agent_phone) AS cnt_agent_phone, count(agent_fees) AS cnt_agent_fees
FROM listings"""))
def q_default_rollup(spark, sf_dir):
    return sh.default_rollup(silver_listings(spark, sf_dir))


@register("default_years", with_listings("""
SELECT CAST(year(last_updated) AS INTEGER) AS year, count(*) AS n_rows FROM listings GROUP BY 1"""))
def q_default_years(spark, sf_dir):
    return sh.default_years(silver_listings(spark, sf_dir))


@register("row_limit", with_listings(f"""
SELECT * FROM ({_TABLE_SQL}) t ORDER BY id NULLS FIRST LIMIT 10000"""))
def q_row_limit(spark, sf_dir):
    rows = sh.listing_table_rows(silver_listings(spark, sf_dir))
    return sh.preview_grouped(rows, sh.listing_table_agg, key="id")


@register("months_manual_sort", with_listings("""
SELECT *, CAST(row_number() OVER (ORDER BY CASE WHEN upd_month IS NULL THEN 0 WHEN upd_month BETWEEN 4 AND 8 THEN upd_month - 3
  ELSE 6 END, upd_month) AS INTEGER) AS position
FROM (SELECT CAST(month(last_updated) AS INTEGER) AS upd_month, count(last_updated) AS n_listings FROM listings GROUP BY 1) m"""))
def q_months_manual_sort(spark, sf_dir):
    """O1, with each member's place: the window runs over one row per month."""
    m = (silver_listings(spark, sf_dir)
         .groupBy(date_part("last_updated", "month").alias("upd_month"))
         .agg(F.count("last_updated").alias("n_listings")))
    place = F.row_number().over(Window.orderBy(*sh.manual_key("upd_month", MONTH_ORDER)))
    return sh.manual_sort(m.withColumn("position", place), "upd_month", MONTH_ORDER)


@register("price_by_beds_all", with_listings("""
SELECT n_beds AS number_of_beds, avg(price) AS avg_price, count(price) AS n_listings FROM listings
WHERE price BETWEEN 300 AND 50000 GROUP BY 1"""))
def q_price_by_beds_all(spark, sf_dir):
    """an enumerate-all selection keeps every member."""
    return sh.price_by_beds(flt.apply_selection(silver_listings(spark, sf_dir), None, sh.SELECTION_KEYS))


@register("price_bins", with_listings("""
SELECT CAST(floor((price - 0) / 88755) * 88755 + 0 AS BIGINT) AS price_bin, count(price) AS n_listings,
 min(price) AS min_price, max(price) AS max_price
FROM listings GROUP BY 1"""))
def q_price_bins(spark, sf_dir):
    return sh.price_bins(silver_listings(spark, sf_dir), size=88755)


@register("price_bins_fine", with_listings("""
SELECT CAST(floor((price - 100) / 2500) * 2500 + 100 AS BIGINT) AS price_bin, count(price) AS n_listings,
 min(price) AS min_price, max(price) AS max_price
FROM listings GROUP BY 1"""))
def q_price_bins_fine(spark, sf_dir):
    return sh.price_bins(silver_listings(spark, sf_dir), size=2500, peg=100)


@register("date_parts", with_listings("""
SELECT id, CAST(year(available_date) AS INTEGER) AS avail_year, CAST(quarter(available_date) AS INTEGER) AS avail_quarter,
 CAST(month(available_date) AS INTEGER) AS avail_month, CAST(weekofyear(available_date) AS INTEGER) AS avail_week,
 CAST(dayofmonth(available_date) AS INTEGER) AS avail_day,
 CAST(date_trunc('day', last_updated) AS DATE) AS upd_date
FROM listings"""))
def q_date_parts(spark, sf_dir):
    c = "available_date"
    return silver_listings(spark, sf_dir).select(
        "id", date_part(c, "year").alias("avail_year"), date_part(c, "quarter").alias("avail_quarter"),
        date_part(c, "month").alias("avail_month"), date_part(c, "week").alias("avail_week"),
        date_part(c, "day").alias("avail_day"), date_part("last_updated", "daytrunc").alias("upd_date"))


def _enc(x: str) -> str:
    return f"coalesce(replace(url_encode(CAST({x} AS VARCHAR)), '%20', '+'), '')"


@register("drill_url", with_listings(f"""
SELECT id, concat('Search?agent_email=', {_enc('agent_email')}, '&agent_name=', {_enc('agent_name')},
 '&agent_phone=', {_enc('agent_phone')}, '&amenities=', {_enc('amenities')},
 '&last_updated=', {_enc('last_updated')}, '&utilities=', {_enc('utilities')}) AS url
FROM listings"""))
def q_drill_url(spark, sf_dir):
    return silver_listings(spark, sf_dir).select("id", drill_url().alias("url"))
