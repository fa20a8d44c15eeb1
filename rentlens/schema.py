"""Canonical listings schema and the fixed values the cleaning rules depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Canonical clean table (14 columns) ------------------------------------
LISTINGS = T.StructType([
    T.StructField("id", T.LongType(), True),
    T.StructField("last_updated", T.DateType(), True),
    T.StructField("price", T.IntegerType(), True),
    T.StructField("n_beds", T.DoubleType(), True),
    T.StructField("n_baths", T.DoubleType(), True),
    T.StructField("available_date", T.DateType(), True),
    T.StructField("location", T.StringType(), True),
    T.StructField("area", T.StringType(), True),
    T.StructField("utilities", T.StringType(), True),
    T.StructField("amenities", T.StringType(), True),
    T.StructField("agent_name", T.StringType(), True),
    T.StructField("agent_email", T.StringType(), True),
    T.StructField("agent_phone", T.StringType(), True),
    T.StructField("agent_fees", T.StringType(), True),
])
LISTING_COLUMNS = [f.name for f in LISTINGS.fields]
# The 12-column layout used by the notebook variants (no id, no area).
NOTEBOOK_COLUMNS = [c for c in LISTING_COLUMNS if c not in ("id", "area")]

# Raw page rows captured from the HTML sources.
PAGES = T.StructType([
    T.StructField("source_id", T.StringType(), True),
    T.StructField("page_num", T.IntegerType(), True),
    T.StructField("url", T.StringType(), True),
    T.StructField("html", T.StringType(), True),
])

# ---------------------------------------------------------------------------
# These must equal the source system's values for identical
# results. Kept together, in their natural order, as plain text.
# ---------------------------------------------------------------------------

# Destination field -> key in the JSON listing payload.
JSON_TAGS = {
    "last_updated": "date_modified",
    "price": "price",
    "n_beds": "bed_room",
    "n_baths": "baths",
    "avbl_date": "date_available",
    "building_address": "building_address",
    "area": "sub_area_name",
    "agent_name": "agent_full_name",
    "agent_email": "agent_email",
    "agent_phone": "agent_phone",
    "agent_fees": "fee",
    "heat": "heat",
    "hot_water": "hot_water",
    "electricity": "electricity",
    "parking": "parking",
    "dish_washer": "dish_washer",
    "laundry_location": "laundry_location",
    "air_conditioning": "air_conditioning",
}

# Area dimension: normalised key -> display name (31 entries).
AREA_NAMES = {
    "allston": "Allston",
    "backbay": "Back Bay",
    "bayvillage": "Bay Village",
    "beaconhill": "Beacon Hill",
    "brighton": "Brighton",
    "charlestown": "Charlestown",
    "chinatown": "Chinatown",
    "dorchester": "Dorchester",
    "eastboston": "East Boston",
    "fenway": "Fenway",
    "financialdistrict": "Financial District",
    "forthill": "Fort Hill",
    "hydepark": "Hyde Park",
    "jamaicaplain": "Jamaica Plain",
    "kenmore": "Kenmore",
    "leatherdistrict": "Leather District",
    "midtown": "Midtown",
    "missionhill": "Mission Hill",
    "northend": "North End",
    "roslindale": "Roslindale",
    "roxbury": "Roxbury",
    "seaportdistrict": "Seaport District",
    "southboston": "South Boston",
    "southend": "South End",
    "theatredistrict": "Theatre District",
    "waterfront": "Waterfront",
    "westend": "West End",
    "westroxbury": "West Roxbury",
    "brookline": "Brookline",
    "cambridge": "Cambridge",
    "somerville": "Somerville",
}
# Cities tested first, case-blind substring, in this order.
CITY_NAMES = [("brookline", "Brookline"), ("cambridge", "Cambridge"), ("somerville", "Somerville")]
DEFAULT_AREA = "Boston"

# URL substring that routes a source to the JSON branch; others are HTML.
JSON_ROUTE_TOKEN = "bostonpads"

# Sentence templates of the derived text columns.
UTILITIES_PREFIX = "Utilities paid for: "
AMENITIES_PREFIX = "Amenities provided: "
HEAT_YES, HEAT_NO = "Heat - Yes, ", "Heat - No, "
HOT_WATER_YES, HOT_WATER_NO = "Hot Water - Yes, ", "Hot Water - No, "
ELECTRICITY_YES, ELECTRICITY_NO = "Electricity - Yes, ", "Electricity - No."
PARKING_LABEL, DISH_WASHER_LABEL = "Parking - ", "Dish Washer - "
LAUNDRY_LABEL, AIR_CONDITIONING_LABEL = "Laundry - ", "Air Conditioning - "

# HTML card layout (class names).
HTML_CONTAINER = "search_results_area"
HTML_CARD = "property_item"
HTML_PROPS = "item_props"
HTML_PROP_CELL = "column"
HTML_CONTACTS = "contacts"
HTML_TITLE = "item_title"
HTML_COUNTER = "counter"

# Older HTML layout: box class and field -> (tag, exact class string).
OLD_LAYOUT_BOX = ("div", "col-sm-6 col-xs-12")
OLD_LAYOUT_FIELDS = {
    "last_updated": ("div", "lastUpdated"),
    "price": ("div", "rentPrice"),
    "n_beds": ("div", "fa-fw fas fa-bed"),
    "n_baths": ("div", "fa-fw fas fa-bath"),
    "avbl_date": ("div", "listingAvailable"),
    "location": ("div", "listingLocation col-xs-12", "a"),
    "utilities": ("span", "listingHHW"),
    "amenities": ("div", "listingAmenities"),
}

# Dashboard parameters.
PRICE_BIN_SIZE = 88755
PRICE_BIN_PEG = 0
TABLE_RANGES = {"n_baths": (0.0, 11.5), "n_beds": (1.0, 11.0), "price": (0, 50000)}
PRICE_BY_BEDS_RANGE = (300, 50000)
PRICE_TREND_MAX = 50000
PREVIEW_ROWS = 10000
DRILL_TARGET = "Search"
DRILL_FIELDS = ["agent_email", "agent_name", "agent_phone", "amenities", "last_updated", "utilities"]
