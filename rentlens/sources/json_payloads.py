"""JSON listing payloads.

A payload is one captured API body: an object whose ``data`` array holds the
listings. Bodies are parsed to VARIANT, which keeps the JSON type of every
value (boolean vs number vs string), so the type-sensitive flag rules match
the source exactly. Parsing and exploding are narrow operations: one payload
row becomes its listings in the same task, no shuffle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean as C
from ..functions.area import area_from_dash
from ..schema import JSON_ROUTE_TOKEN, JSON_TAGS


def route_by_source(df: DataFrame, url_col: str = "url", token: str = JSON_ROUTE_TOKEN):
    """Split sources into the JSON branch (URL contains ``token``) and the HTML branch."""
    is_json = F.coalesce(F.col(url_col).contains(token), F.lit(False))
    return df.filter(is_json), df.filter(~is_json)


def read_payload_files(spark: SparkSession, path: str) -> DataFrame:
    """Captured bodies stored one file per response: ``(payload_path, body)``."""
    return (spark.read.option("wholetext", "true").text(path)
            .select(F.input_file_name().alias("payload_path"), F.col("value").alias("body")))


def read_json_payloads(df: DataFrame, body_col: str = "body", keep=()) -> DataFrame:
    """R2: one row per element of ``data``: ``(*keep, pos, item)``.

    The body is read by a schema that stops at the elements, so its size is not
    bound by the size a single VARIANT may have. A body that is malformed or
    has no ``data`` list yields no rows here and one row of ``payload_rejects``.
    """
    items = F.from_json(F.col(body_col), "data array<variant>")["data"]
    return df.select(*keep, F.posexplode(items).alias("pos", "item")).filter(F.col("item").isNotNull())


def payload_rejects(df: DataFrame, body_col: str = "body", keep=()) -> DataFrame:
    """Payloads without a readable ``data`` list: ``(*keep, _reject_reason)``."""
    body, corrupt = F.col(body_col), "_corrupt_record"
    parsed = F.from_json(body, f"data array<variant>, {corrupt} string", {"columnNameOfCorruptRecord": corrupt})
    reason = (F.when(body.isNull() | (F.trim(body) == ""), "empty body")
              .when(parsed[corrupt].isNotNull(), "malformed body").when(parsed["data"].isNull(), "no data list"))
    return df.select(*keep, reason.alias("_reject_reason")).filter(F.col("_reject_reason").isNotNull())


def rename_by_tagmap(df: DataFrame, tags: dict = JSON_TAGS, struct_col: str | None = None, keep=()) -> DataFrame:
    """Destination names from source keys (for struct/columnar inputs)."""
    src = (lambda k: F.col(f"{struct_col}.{k}")) if struct_col else F.col
    return df.select(*keep, *[src(k).alias(dst) for dst, k in tags.items()])


def _path(field: str) -> str:
    return f"$.{JSON_TAGS[field]}"


# Text fields read from a payload element once, before the rules use them.
_TEXT_FIELDS = ["last_updated", "price", "n_beds", "n_baths", "avbl_date", "area", "parking",
                "laundry_location", "air_conditioning", "agent_name", "agent_email", "agent_phone"]


def json_raw_columns(item: Column) -> dict[str, Column]:
    """Stage 1: the element's text fields and type-aware flags, each read once."""
    raw = {f"__{f}": C.vstr(item, _path(f)) for f in _TEXT_FIELDS}
    for f in ("last_updated", "avbl_date"):
        raw[f"__{f}"] = C.strip_text(raw[f"__{f}"])
    raw["__street"] = C.vstr(item, _path("building_address") + ".street_address")
    # An address object must hold a street address (it may be empty or null).
    raw["__no_street"] = (F.try_variant_get(item, _path("building_address"), "variant").isNotNull()
                          & (C.vtype(item, _path("building_address")).startswith("OBJECT"))
                          & C.vtype(item, _path("building_address") + ".street_address").isNull())
    raw["__heat"] = C.flag_equals_true(item, _path("heat"))
    raw["__hot_water"] = C.flag_equals_string(item, _path("hot_water"), "1")
    raw["__electricity"] = C.flag_equals_true(item, _path("electricity"))
    raw["__dish_washer"] = C.flag_equals_true(item, _path("dish_washer"))
    raw["__agent_fees"] = C.fee_flag(item, _path("agent_fees"))
    return raw


def json_listing_columns(as_of: dt.date | None = None) -> dict[str, Column]:
    """Stage 2: the clean listing columns from the stage-1 columns."""
    r = lambda f: F.col(f"__{f}")
    return {
        "last_updated": C.parse_datetime_flexible(r("last_updated"), as_of, stripped=True).cast("date"),
        "price": C.clean_price_api(r("price")),
        "n_beds": C.clean_count_raw_default(r("n_beds")),
        "n_baths": C.clean_count_raw_default(r("n_baths")),
        "available_date": C.parse_datetime_flexible(r("avbl_date"), as_of, stripped=True).cast("date"),
        "location": C.coalesce_location(r("street"), r("area")),
        "area": area_from_dash(r("area")),
        "utilities": C.utilities_text(r("heat"), r("hot_water"), r("electricity")),
        "amenities": C.amenities_text(r("parking"), r("dish_washer"), r("laundry_location"),
                                      r("air_conditioning")),
        "agent_name": r("agent_name"),
        "agent_email": r("agent_email"),
        "agent_phone": r("agent_phone"),
        "agent_fees": r("agent_fees"),
    }


REQUIRED = {
    "last_updated": "unparsable last_updated",
    "price": "unparsable price",
    "n_beds": "unparsable n_beds",
    "n_baths": "unparsable n_baths",
    "available_date": "unparsable available_date",
    "area": "no area in sub_area_name",
}


def reject_reason(required: dict = REQUIRED) -> Column:
    """``_reject_reason``: the failed checks joined by '; ', NULL when clean."""
    parts = [F.when(F.col(c).isNull(), F.lit(msg)) for c, msg in required.items()]
    r = F.concat_ws("; ", *parts)
    return F.when(r == "", F.lit(None).cast("string")).otherwise(r)


def clean_json_listings(items: DataFrame, item_col: str = "item", as_of: dt.date | None = None,
                        keep=()) -> DataFrame:
    """P-rules over payload elements; adds ``_reject_reason`` (NULL = clean row)."""
    raw = items.select(*keep, *[c.alias(n) for n, c in json_raw_columns(F.col(item_col)).items()])
    out = raw.select(*keep, *[c.alias(n) for n, c in json_listing_columns(as_of).items()], "__no_street")
    street = F.when(F.col("__no_street"), F.lit("no street_address in building_address"))
    both = F.concat_ws("; ", reject_reason(), street)
    return out.withColumn("_reject_reason", F.when(both != "", both)).drop("__no_street")


def split_rejects(df: DataFrame, mode: str = "quarantine"):
    """Clean rows and quarantined rows. ``mode='failfast'`` raises on the first reject.

    Both are filters of one lazy frame. Where both are needed, ``write_split``
    writes the frame once and reads each part from its own folder.
    """
    bad = df.filter(F.col("_reject_reason").isNotNull())
    if mode == "failfast":
        first = bad.limit(1).collect()
        if first:
            raise ValueError(f"rejected row: {first[0]['_reject_reason']}")
    return df.filter(F.col("_reject_reason").isNull()).drop("_reject_reason"), bad


def write_split(df: DataFrame, path: str):
    """Clean rows and quarantined rows, written once under ``path`` by a rejected flag."""
    df.withColumn("_rejected", F.col("_reject_reason").isNotNull()).write.partitionBy("_rejected").parquet(path)
    back = df.sparkSession.read.schema(df.schema.add("_rejected", "boolean")).parquet(path)
    return (back.filter(~F.col("_rejected")).drop("_rejected", "_reject_reason"),
            back.filter(F.col("_rejected")).drop("_rejected"))


def observe_rejects(df: DataFrame, name: str = "rejects"):
    """P4 warnings without an extra job: ``(df, observation)`` where the
    observation holds ``rows``, ``rejected`` and per-rule counts once an action
    on ``df`` has run (``observation.get``)."""
    from pyspark.sql import Observation

    obs = Observation(name)
    exprs = [F.count(F.lit(1)).alias("rows"),
             F.count(F.col("_reject_reason")).alias("rejected")]
    exprs += [F.count(F.when(F.col(c).isNull(), 1)).alias(f"null_{c}") for c in REQUIRED]
    return df.observe(obs, *exprs), obs
