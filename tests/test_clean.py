"""Golden values for the cleaning rules (FIXTURES.md §2), worked out by hand."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rentlens.functions import area as A
from rentlens.functions import clean as C
from rentlens.functions.derive import attr, price_bin

AS_OF = dt.date(2024, 6, 30)


def one_col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {dtype}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("x"))).collect()]


def test_price_api(spark):
    assert one_col(spark, ["$2,895", "1500.00", None, "2,100"], C.clean_price_api) == [2895, None, None, 2100]


def test_price_html(spark):
    assert one_col(spark, ["$2,895/mo", "$2,895.00", ""], C.clean_price_html) == [2895, 289500, None]


def test_count_raw_default(spark):
    got = one_col(spark, ["2 Beds", "0", "", None, "Studio"], C.clean_count_raw_default)
    assert got == [2.0, 1.0, 1.0, 1.0, None]


def test_count_stripped_default(spark):
    got = one_col(spark, ["1.5 Beds", "Studio", "0", "1-2", " 3 "], C.clean_count_stripped_default)
    assert got == [1.5, 1.0, 1.0, 12.0, 3.0]


def test_flexible_dates(spark):
    vals = ["13/01/2023", "08/06/2023", "8/6/23", "Aug 6, 2023", "2023-08-06T10:00:00Z", "9/1",
            "2023-08-06 10:11:12", "1/2/96", "not a date"]
    got = one_col(spark, vals, lambda c: C.parse_datetime_flexible(c, AS_OF).cast("date"))
    assert got == [dt.date(2023, 1, 13), dt.date(2023, 8, 6), dt.date(2023, 8, 6), dt.date(2023, 8, 6),
                   dt.date(2023, 8, 6), dt.date(2024, 9, 1), dt.date(2023, 8, 6), dt.date(1996, 1, 2), None]


def test_available_html(spark):
    got = one_col(spark, ["Available 09/01/2023", "Now", " \n"], lambda c: C.clean_available_html(c, AS_OF).cast("date"))
    assert got == [dt.date(2023, 9, 1), AS_OF, AS_OF]


def test_iso_strict(spark):
    assert one_col(spark, ["2023-08-06", "", None, "08/06/2023"], C.parse_iso_date) == [dt.date(2023, 8, 6), None, None, None]


def test_strip_and_href(spark):
    assert one_col(spark, ["\n\t Agent 7 \n"], C.strip_text) == ["Agent 7"]
    assert one_col(spark, ["mailto:a@b.c", "tel:617:5", "nocolon"], C.href_payload) == ["a@b.c", "617", None]


def test_first_number(spark):
    assert one_col(spark, ["Page 12 of 30", "none", None], C.first_number) == [12, None, None]


def test_area_from_dash(spark):
    got = one_col(spark, ["Boston - Back Bay", "BOSTON - FENWAY/KENMORE", "Brookline - X", "Boston",
                          "Cambridge-Porter", "Boston - South  End"], A.area_from_dash)
    assert got == ["Back Bay", "Boston", "Brookline", None, "Cambridge", "South End"]


def test_area_from_paren(spark):
    got = one_col(spark, ["12 Main St (Back Bay)", "5 Elm (Allston) Unit 3", "5 Elm", "1 Cambridge St",
                          "1 Cambridge St (Brookline)"], A.area_from_paren)
    assert got == ["Back Bay", "Boston", "Boston", "Cambridge", "Brookline"]


def test_area_dimension_exhaustive(spark):
    from rentlens.schema import AREA_NAMES

    names = list(AREA_NAMES.values())
    got = one_col(spark, [f"X - {n}" for n in names], A.area_from_dash)
    assert got == names
    assert len(names) == 31


def test_join_area_default(spark):
    df = spark.createDataFrame([(1, "backbay"), (2, "mattapan"), (3, None)], "id int, k string")
    out = A.join_area(df, "k", A.area_dimension(spark)).orderBy("id").select("area").collect()
    assert [r[0] for r in out] == ["Back Bay", "Boston", "Boston"]


def _payload(items):
    import json
    return json.dumps({"data": items})


def test_json_flags_are_type_aware(spark):
    from rentlens.sources import json_payloads as J

    items = [
        {"heat": True, "hot_water": "1", "electricity": True, "fee": 0},
        {"heat": False, "hot_water": 1, "electricity": False, "fee": False},
        {"heat": 1, "hot_water": "0", "electricity": 1.0, "fee": "0"},
        {"heat": "true", "hot_water": None, "electricity": None, "fee": None},
        {"fee": 1},
    ]
    df = spark.createDataFrame([(_payload(items),)], "body string")
    it = J.read_json_payloads(df)
    out = it.orderBy("pos").select(
        C.utilities_text(C.flag_equals_true("item", "$.heat"), C.flag_equals_string("item", "$.hot_water", "1"),
                         C.flag_equals_true("item", "$.electricity")).alias("u"),
        C.fee_flag("item", "$.fee").alias("f")).collect()
    assert out[0]["u"] == "Utilities paid for: Heat - Yes, Hot Water - Yes, Electricity - Yes, "
    assert out[1]["u"] == "Utilities paid for: Heat - No, Hot Water - No, Electricity - No."
    assert out[2]["u"] == "Utilities paid for: Heat - Yes, Hot Water - No, Electricity - Yes, "
    assert out[3]["u"] == "Utilities paid for: Heat - No, Hot Water - No, Electricity - No."
    assert [r["f"] for r in out] == ["No", "No", "Yes", "Yes", "Yes"]


def test_json_listing_row_and_rejects(spark):
    from rentlens.sources import json_payloads as J

    good = {"date_modified": "2023-08-06", "price": "$2,895", "bed_room": "0", "baths": "1 Bath",
            "date_available": "09/01/2023", "building_address": {"street_address": ""},
            "sub_area_name": "BOSTON - FENWAY/KENMORE", "agent_full_name": "A", "agent_email": "a@b",
            "agent_phone": "1", "fee": 0, "heat": False, "hot_water": "0", "electricity": False,
            "parking": "", "dish_washer": False, "laundry_location": None, "air_conditioning": None}
    bad = dict(good, price="1500.00", sub_area_name="Boston")
    df = spark.createDataFrame([(_payload([good, bad]),), ("",), ("{}",)], "body string")
    rows = J.clean_json_listings(J.read_json_payloads(df, keep=[]), as_of=AS_OF).collect()
    assert len(rows) == 2
    ok, rej = J.split_rejects(J.clean_json_listings(J.read_json_payloads(df), as_of=AS_OF))
    r = ok.collect()[0]
    assert (r.price, r.n_beds, r.n_baths, r.area, r.location) == (2895, 1.0, 1.0, "Boston", "BOSTON - FENWAY/KENMORE")
    assert r.available_date == dt.date(2023, 9, 1) and r.last_updated == dt.date(2023, 8, 6)
    assert r.amenities == "Amenities provided: Parking - No, Dish Washer - No, Laundry - No, Air Conditioning - No."
    assert r.agent_fees == "No"
    reason = rej.collect()[0]["_reject_reason"]
    assert "price" in reason and "area" in reason
    with pytest.raises(ValueError):
        J.split_rejects(J.clean_json_listings(J.read_json_payloads(df), as_of=AS_OF), mode="failfast")


def test_price_bin_and_attr(spark):
    assert one_col(spark, [2895, 88755, -1], lambda c: price_bin(c), "int") == [0, 88755, -88755]
    df = spark.createDataFrame([(1, 2.0), (1, 2.0), (2, 1.0), (2, 1.5), (3, None)], "g int, v double")
    got = {r["g"]: r["a"] for r in df.groupBy("g").agg(attr("v").alias("a")).collect()}
    assert got == {1: "2.0", 2: "*", 3: None}


def test_rename_by_tagmap_and_empty(spark):
    from rentlens.schema import JSON_TAGS, LISTINGS
    from rentlens.sources import json_payloads as J
    from rentlens.sources.files import empty_listings, rows_to_frame

    cols = ", ".join(f"{k} string" for k in dict.fromkeys(JSON_TAGS.values()))
    raw = spark.createDataFrame([tuple(f"v_{k}" for k in dict.fromkeys(JSON_TAGS.values()))], cols)
    out = J.rename_by_tagmap(raw).first().asDict()
    assert list(out) == list(JSON_TAGS) and out["last_updated"] == "v_date_modified"
    assert empty_listings(spark).schema == LISTINGS and empty_listings(spark).count() == 0
    assert rows_to_frame(spark, [tuple([None] * 14)]).count() == 1


def test_observe_rejects(spark):
    from rentlens.sources import json_payloads as J

    items = [{"price": "$1,000", "date_modified": "2023-01-02", "date_available": "2023-02-01",
              "sub_area_name": "Boston - Allston"},
             {"price": "1500.00", "date_modified": "2023-01-02", "date_available": "2023-02-01",
              "sub_area_name": "Boston - Allston"}]
    df = spark.createDataFrame([(_payload(items),)], "body string")
    observed, obs = J.observe_rejects(J.clean_json_listings(J.read_json_payloads(df), as_of=AS_OF))
    observed.write.format("noop").mode("overwrite").save()
    m = obs.get
    assert (m["rows"], m["rejected"], m["null_price"]) == (2, 1, 1)


def test_file_readers(spark, tmp_path):
    from rentlens.schema import LISTINGS, PAGES
    from rentlens.sources import html_pages as H
    from rentlens.sources import json_payloads as J
    from rentlens.sources.files import empty_listings, scan_listings

    d = tmp_path / "payloads"
    d.mkdir()
    (d / "a.json").write_text(_payload([{"price": "$5"}, {"price": "$6"}]))
    (d / "b.json").write_text("")
    bodies = J.read_payload_files(spark, str(d))
    assert bodies.count() == 1  # an empty capture has no body row (and no listings)
    items = J.read_json_payloads(bodies, keep=["payload_path"])
    assert sorted(r.p for r in items.select(C.clean_price_api(C.vstr("item", "$.price")).alias("p")).collect()) == [5, 6]

    t = str(tmp_path / "listings")
    empty_listings(spark).write.parquet(t)
    assert scan_listings(spark, t).schema == LISTINGS
    pg = str(tmp_path / "pages")
    spark.createDataFrame([("s", 1, "u", "<p>x</p>")], PAGES).write.parquet(pg)
    assert H.read_pages(spark, pg).first().page_num == 1


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

MONTH_NAMES = ["January", "February", "March", "April", "May", "June", "July", "August", "September",
               "October", "November", "December"]


def _shapes(d: dt.date):
    yield d.isoformat(), d
    yield f"{d.isoformat()} 13:45:00", d
    yield f"{d.month:02d}/{d.day:02d}/{d.year}", d
    yield f"{d.month}/{d.day}/{d.year}", d
    if 1975 <= d.year <= 2073:  # inside the two-digit window around 2024
        yield f"{d.month}/{d.day}/{d.year % 100:02d}", d
    if d.day > 12:
        yield f"{d.day}/{d.month}/{d.year}", d
    yield f"{MONTH_NAMES[d.month - 1][:3]} {d.day}, {d.year}", d
    yield f"{MONTH_NAMES[d.month - 1]} {d.day}, {d.year}", d
    yield f"{d.year}/{d.month}/{d.day}", d
    if not (d.month == 2 and d.day == 29):
        yield f"{d.month}/{d.day}", dt.date(AS_OF.year, d.month, d.day)


@settings(max_examples=20, deadline=None)
@given(st.dates(min_value=dt.date(1950, 1, 1), max_value=dt.date(2060, 12, 31)))
def test_flexible_date_shapes_roundtrip(spark, d):
    cases = list(_shapes(d))
    got = one_col(spark, [c for c, _ in cases], lambda c: C.parse_datetime_flexible(c, AS_OF).cast("date"))
    assert got == [want for _, want in cases], cases


def test_date_shapes_wall_clock_and_month_names(spark):
    import datetime as dt

    at = dt.datetime
    cases = {
        "2023-08-06T23:00:00-05:00": at(2023, 8, 6, 23), "2023-08-06T23:00:00Z": at(2023, 8, 6, 23),
        "2023-08-06 10:20:30.5+0530": at(2023, 8, 6, 10, 20, 30, 500000), "Marble 5, 2023": None, "March 5, 2023": at(2023, 3, 5),
        "Sept. 5, 2023": at(2023, 9, 5), "08/06/2023 10:00 AM": at(2023, 8, 6, 10), "08/06/2023 12:30 pm": at(2023, 8, 6, 12, 30),
        "8/6/2023 13:00 PM": None, "6 Aug 2023": at(2023, 8, 6), "Aug 6": at(2024, 8, 6), "8-6-2023": at(2023, 8, 6),
        "20230806": at(2023, 8, 6), "Sunday, Aug 6, 2023": at(2023, 8, 6), "Wed 2023-08-06": at(2023, 8, 6),
        "2023-08-06": at(2023, 8, 6), "13/01/2023": at(2023, 1, 13), "2/30/2023": None, "": None, "soon": None}
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    got = {r.t: r.d for r in df.select("t", C.parse_datetime_flexible("t", dt.date(2024, 6, 30)).alias("d")).collect()}
    assert got == cases
