"""Cleaning, area classification and JSON ingest queries, with oracle SQL.

Raw text is generated from the test tables; every oracle reads the source
columns directly, so it checks our parsing rather than repeating it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import clean as C
from ..functions.area import area_dimension, area_from_dash, area_from_paren, dash_key, join_area
from ..sources import json_payloads as J
from ..schema import JSON_ROUTE_TOKEN
from ..sources.files import read_table
from .registry import register
from .standins import (AS_OF, RAW_JSON_EXPECTED_SQL, area_name_at, area_values_sql, captured_json_payloads,
                       with_listings)

AS_OF_DATE = dt.date.fromisoformat(AS_OF)
_CITIES = "('Brookline', 'Cambridge', 'Somerville')"


def _price(o):
    return F.floor(o.o_totalprice / 8).cast("int")


@register("clean_prices", """
SELECT o_orderkey AS id,
 CASE WHEN o_orderkey % 4 IN (0, 1) THEN CAST(floor(o_totalprice / 8) AS INT) END AS price_api,
 CASE o_orderkey % 3 WHEN 0 THEN CAST(floor(o_totalprice / 8) AS INT)
   WHEN 1 THEN CAST(floor(o_totalprice / 8) AS INT) * 100 END AS price_html,
 CASE WHEN o_orderkey % 2 = 0 THEN CAST(floor(o_totalprice / 8) AS INT) END AS price_tolerant
FROM orders""")
def q_clean_prices(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    k, p = o.o_orderkey, _price(o)
    api = (F.when(k % 4 == 0, F.concat(F.lit("$"), F.format_number(p, 0)))
           .when(k % 4 == 1, F.format_number(p, 0))
           .when(k % 4 == 2, F.concat(p.cast("string"), F.lit(".00"))))
    html = (F.when(k % 3 == 0, F.concat(F.lit("$"), F.format_number(p, 0), F.lit("/mo")))
            .when(k % 3 == 1, F.concat(F.lit("$"), F.format_number(p, 2)))
            .otherwise(F.lit(" \n")))
    tol = F.when(k % 2 == 0, p.cast("string")).otherwise(F.concat(F.lit("$"), p.cast("string")))
    return o.select(k.alias("id"), C.clean_price_api(api).alias("price_api"),
                    C.clean_price_html(html).alias("price_html"),
                    C.clean_price_tolerant(tol).alias("price_tolerant"))


@register("clean_counts", """
SELECT p_partkey AS id,
 CASE p_partkey % 6 WHEN 0 THEN p_size / 2.0 WHEN 3 THEN NULL
   WHEN 4 THEN CAST(concat(CAST(p_size AS VARCHAR), CAST(p_size + 1 AS VARCHAR)) AS DOUBLE) ELSE 1.0 END
   AS beds_raw_default,
 CASE p_partkey % 6 WHEN 0 THEN p_size / 2.0
   WHEN 4 THEN CAST(concat(CAST(p_size AS VARCHAR), CAST(p_size + 1 AS VARCHAR)) AS DOUBLE) ELSE 1.0 END
   AS beds_stripped_default
FROM part""")
def q_clean_counts(spark, sf_dir):
    p = read_table(spark, sf_dir, "part")
    k, s = p.p_partkey, p.p_size
    raw = (F.when(k % 6 == 0, F.concat((s / 2.0).cast("string"), F.lit(" Beds")))
           .when(k % 6 == 1, F.lit("0"))
           .when(k % 6 == 2, F.lit(""))
           .when(k % 6 == 3, F.lit("Studio"))
           .when(k % 6 == 4, F.concat(s.cast("string"), F.lit("-"), (s + 1).cast("string"))))
    return p.select(k.alias("id"), C.clean_count_raw_default(raw).alias("beds_raw_default"),
                    C.clean_count_stripped_default(raw).alias("beds_stripped_default"))


@register("parse_dates", f"""
SELECT o_orderkey AS id,
 CASE WHEN o_orderkey % 7 = 6 THEN make_date(2024, month(o_orderdate), dayofmonth(o_orderdate))
   ELSE CAST(o_orderdate AS DATE) END AS parsed,
 CAST(o_orderdate AS DATE) AS iso,
 CASE WHEN o_orderkey % 10 = 9 THEN DATE '{AS_OF}' ELSE CAST(o_orderdate AS DATE) END AS avail_html
FROM orders""")
def q_parse_dates(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    k, d = o.o_orderkey, F.to_date(o.o_orderdate)
    sel = k % 7
    raw = (F.when(sel == 0, F.date_format(d, "yyyy-MM-dd HH:mm:ss"))
           .when(sel == 1, F.date_format(d, "MM/dd/yyyy"))
           .when((sel == 2) & (F.dayofmonth(d) > 12), F.date_format(d, "dd/MM/yyyy"))
           .when(sel == 2, F.date_format(d, "M/d/yyyy"))
           .when(sel == 3, F.date_format(d, "M/d/yy"))
           .when(sel == 4, F.date_format(d, "MMM d, yyyy"))
           .when(sel == 5, F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
           .otherwise(F.date_format(d, "M/d")))
    html = F.when(k % 10 == 9, F.lit("Now")).otherwise(
        F.concat(F.lit("\n  Available "), F.date_format(d, "MM/dd/yyyy"), F.lit("  ")))
    # Raw text first, in its own projection; the parsers read it many times.
    texts = o.select(k.alias("id"), C.strip_text(raw).alias("raw"), C.available_digits(html).alias("html"),
                     F.date_format(d, "yyyy-MM-dd").alias("iso_text"))
    return texts.select(
        "id",
        C.to_date_trunc(C.parse_datetime_flexible("raw", AS_OF_DATE, stripped=True)).alias("parsed"),
        C.parse_iso_date("iso_text").alias("iso"),
        C.to_date_trunc(C.clean_available_html("html", AS_OF_DATE, digits=True)).alias("avail_html"))


def _dash_locations(c):
    k, dim = c.c_custkey, area_name_at(c.c_custkey)
    return (F.when(k % 6 == 0, F.concat(F.lit("Boston - "), dim))
            .when(k % 6 == 1, F.concat(F.lit("BOSTON - "), F.upper(dim), F.lit("/KENMORE")))
            .when(k % 6 == 2, c.c_name)
            .when(k % 6 == 3, F.concat(c.c_mktsegment, F.lit(" -   "), F.lower(dim), F.lit("  - x")))
            .when(k % 6 == 4, F.concat(F.lit("Cambridge - "), c.c_mktsegment))
            .otherwise(F.concat(c.c_mktsegment, F.lit("-"), F.replace(dim, F.lit(" "), F.lit("")))))


_DASH_LOC_SQL = """CASE c_custkey % 6 WHEN 0 THEN concat('Boston - ', dim.name)
   WHEN 1 THEN concat('BOSTON - ', upper(dim.name), '/KENMORE') WHEN 2 THEN c_name
   WHEN 3 THEN concat(c_mktsegment, ' -   ', lower(dim.name), '  - x')
   WHEN 4 THEN concat('Cambridge - ', c_mktsegment)
   ELSE concat(c_mktsegment, '-', replace(dim.name, ' ', '')) END"""


@register("area_from_dash", f"""
SELECT c_custkey AS id, {_DASH_LOC_SQL} AS location,
 CASE c_custkey % 6 WHEN 1 THEN CASE WHEN dim.name IN {_CITIES} THEN dim.name ELSE 'Boston' END
   WHEN 2 THEN NULL WHEN 4 THEN 'Cambridge' ELSE dim.name END AS area
FROM customer JOIN {area_values_sql()} ON dim.k = c_custkey % 31""")
def q_area_from_dash(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    loc = _dash_locations(c)
    return c.select(c.c_custkey.alias("id"), loc.alias("location"), area_from_dash(loc).alias("area"))


@register("area_lookup_join", f"""
SELECT c_custkey AS id, coalesce(d2.name, 'Boston') AS area
FROM (SELECT c_custkey, replace(lower(trim(split_part({_DASH_LOC_SQL}, '-', 2))), ' ', '') AS area_key
      FROM customer JOIN {area_values_sql()} ON dim.k = c_custkey % 31) t
LEFT JOIN (SELECT lower(replace(name, ' ', '')) AS key, name FROM {area_values_sql('d0')}) d2
  ON d2.key = t.area_key""")
def q_area_lookup_join(spark, sf_dir):
    """J1 with the dimension as a frame: normalised key, left join, default."""
    c = read_table(spark, sf_dir, "customer")
    keyed = c.select(c.c_custkey.alias("id"), dash_key(_dash_locations(c)).alias("area_key"))
    return join_area(keyed, "area_key", area_dimension(spark)).select("id", "area")


@register("area_from_paren", f"""
SELECT c_custkey AS id,
 CASE c_custkey % 6 WHEN 0 THEN concat(c_name, ' (', dim.name, ')')
   WHEN 1 THEN concat(c_name, ' (', dim.name, ') Unit ', CAST(c_custkey % 50 AS VARCHAR))
   WHEN 2 THEN c_name WHEN 3 THEN concat('1 Cambridge St (', dim.name, ')')
   WHEN 4 THEN concat(c_mktsegment, ' ( ', upper(dim.name), ' )')
   ELSE concat(c_name, ' (', dim.name, ') (', c_mktsegment, ')') END AS location,
 CASE c_custkey % 6 WHEN 1 THEN CASE WHEN dim.name IN {_CITIES} THEN dim.name ELSE 'Boston' END
   WHEN 2 THEN 'Boston' WHEN 3 THEN CASE WHEN dim.name = 'Brookline' THEN 'Brookline' ELSE 'Cambridge' END
   ELSE dim.name END AS area
FROM customer JOIN {area_values_sql()} ON dim.k = c_custkey % 31""")
def q_area_from_paren(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    k, dim = c.c_custkey, area_name_at(c.c_custkey)
    loc = (F.when(k % 6 == 0, F.concat(c.c_name, F.lit(" ("), dim, F.lit(")")))
           .when(k % 6 == 1, F.concat(c.c_name, F.lit(" ("), dim, F.lit(") Unit "), (k % 50).cast("string")))
           .when(k % 6 == 2, c.c_name)
           .when(k % 6 == 3, F.concat(F.lit("1 Cambridge St ("), dim, F.lit(")")))
           .when(k % 6 == 4, F.concat(c.c_mktsegment, F.lit(" ( "), F.upper(dim), F.lit(" )")))
           .otherwise(F.concat(c.c_name, F.lit(" ("), dim, F.lit(") ("), c.c_mktsegment, F.lit(")"))))
    return c.select(k.alias("id"), loc.alias("location"), area_from_paren(loc).alias("area"))


def _json_clean(spark, sf_dir, keep=("ext_id",)):
    items = J.read_json_payloads(captured_json_payloads(spark, sf_dir), keep=["payload_id"])
    items = items.withColumn("ext_id", F.try_variant_get("item", "$.listing_id", "bigint"))
    return J.clean_json_listings(items, as_of=AS_OF_DATE, keep=list(keep))


def _json_clean_with_position(spark, sf_dir):
    """Clean JSON rows that keep their payload and position (insertion order)."""
    return _json_clean(spark, sf_dir, keep=("ext_id", "payload_id", "pos"))


@register("json_listings", with_listings(RAW_JSON_EXPECTED_SQL))
def q_json_listings(spark, sf_dir):
    clean, _ = J.split_rejects(_json_clean(spark, sf_dir))
    return clean


@register("json_rejects", with_listings("""
SELECT id AS ext_id, concat_ws('; ', CASE WHEN last_updated IS NULL THEN 'unparsable last_updated' END,
  CASE WHEN id % 97 = 0 THEN 'unparsable price' END,
  CASE WHEN id % 89 = 0 THEN 'no street_address in building_address' END) AS _reject_reason
FROM listings WHERE last_updated IS NULL OR id % 97 = 0 OR id % 89 = 0"""))
def q_json_rejects(spark, sf_dir):
    _, bad = J.split_rejects(_json_clean(spark, sf_dir))
    return bad.select("ext_id", "_reject_reason")


@register("json_flags", with_listings("""
SELECT id AS ext_id, utilities, amenities, agent_fees FROM listings"""))
def q_json_flags(spark, sf_dir):
    return _json_clean(spark, sf_dir).select("ext_id", "utilities", "amenities", "agent_fees")


@register("payload_rejects", """
SELECT CAST(-1 - n_nationkey AS BIGINT) AS payload_id, CASE n_nationkey % 3 WHEN 0 THEN 'malformed body'
  WHEN 1 THEN 'no data list' ELSE 'empty body' END AS _reject_reason FROM nation""")
def q_payload_rejects(spark, sf_dir):
    """Payloads that hold no readable list of listings."""
    return J.payload_rejects(captured_json_payloads(spark, sf_dir), keep=["payload_id"])


@register("event_props", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS prop_k FROM events""")
def q_event_props(spark, sf_dir):
    e = read_table(spark, sf_dir, "events")
    return e.select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("prop_k"))


@register("route_sources", """
SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 'json' ELSE 'html' END AS branch FROM pages""")
def q_route_sources(spark, sf_dir):
    """Every fourth page's URL is moved to the JSON source's host."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", F.when(
        F.col("page_id") % 4 == 0, F.regexp_replace("url", "://[^/]*", f"://www.{JSON_ROUTE_TOKEN}.example"))
        .otherwise(F.col("url")).alias("url"))
    js, html = J.route_by_source(pages)
    return (js.select("page_id", F.lit("json").alias("branch"))
            .unionByName(html.select("page_id", F.lit("html").alias("branch"))))
