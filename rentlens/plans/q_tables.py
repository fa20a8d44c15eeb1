"""Table maintenance queries (W1-W8, U1, J5, N3, P21, A11, R7-R10), with oracle SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import tables as W
from ..operators.bucket_tables import BucketTable, create_buckets, read_buckets, upsert_buckets
from ..operators.filters import apply_selection
from ..schema import JSON_TAGS, LISTING_COLUMNS
from ..session import scratch_path
from ..sources import html_pages as H
from ..sources import json_payloads as J
from ..sources.files import empty_listings, read_back, read_table, rows_to_frame
from .q_clean import AS_OF_DATE, _json_clean
from .q_html import _kept_cards
from .registry import register
from .standins import RAW_HTML_CARDS_SQL, RAW_JSON_EXPECTED_SQL, silver_listings, with_listings

_CLEAN13 = [c for c in LISTING_COLUMNS if c != "id"]


@register("upsert_by_key", with_listings("""
SELECT CASE WHEN id % 15 = 0 THEN NULL ELSE id END AS key, id,
 CASE WHEN id % 6 = 1 THEN price + 2 ELSE price END AS price, location
FROM listings"""))
def q_upsert_by_key(spark, sf_dir):
    """Target: ids not divisible by 3. Source: the other ids (inserts; every
    15th with a NULL key), and two later updates of every id = 1 mod 6."""
    base = silver_listings(spark, sf_dir).select(F.col("id").alias("key"), "id", "price", "location")
    k = F.col("id")
    target = base.filter(k % 3 != 0).withColumn("ingest_seq", F.lit(0))
    inserts = (base.filter(k % 3 == 0)
               .withColumn("key", F.when(k % 15 == 0, F.lit(None).cast("long")).otherwise(F.col("key")))
               .withColumn("ingest_seq", F.lit(1)))
    upd1 = base.filter(k % 6 == 1).withColumn("price", F.col("price") + 1).withColumn("ingest_seq", F.lit(2))
    upd2 = base.filter(k % 6 == 1).withColumn("price", F.col("price") + 2).withColumn("ingest_seq", F.lit(3))
    source = W.union_sources(inserts, upd1, upd2)
    return W.upsert_by_key(target, source, key="key", order="ingest_seq").drop("ingest_seq")


@register("upsert_by_location", with_listings("""
, src AS (SELECT * REPLACE (price + 1 AS price) FROM listings
          WHERE id IN (SELECT max(id) FROM listings GROUP BY location))
SELECT s.* FROM listings t JOIN src s ON t.location = s.location
UNION ALL
SELECT * REPLACE (concat('NEW - ', location) AS location) FROM listings
WHERE id = (SELECT min(id) FROM listings)"""))
def q_upsert_by_location(spark, sf_dir):
    """Duplicate target keys: every row of a location takes the new values."""
    L = silver_listings(spark, sf_dir)
    target = L.withColumn("ingest_seq", F.lit(0))
    per_loc = (L.groupBy("location").agg(F.max_by(F.struct(*L.columns), F.col("id")).alias("r"))
               .select("r.*").withColumn("price", F.col("price") + 1))
    first = L.agg(F.min_by(F.struct(*L.columns), F.col("id")).alias("r")).select("r.*")
    unseen = first.withColumn("location", F.concat(F.lit("NEW - "), F.col("location")))
    source = W.union_sources(per_loc, unseen).withColumn("ingest_seq", F.lit(1))
    return W.upsert_by_key(target, source, key="location", order="ingest_seq").drop("ingest_seq")


@register("append_with_id", with_listings("""
SELECT id, area, id AS row_id FROM listings WHERE id % 2 = 0
UNION ALL
SELECT id, area, (SELECT max(id) FROM listings WHERE id % 2 = 0) + row_number() OVER (ORDER BY area, id) AS row_id
FROM listings WHERE id % 2 = 1"""))
def q_append_with_id(spark, sf_dir):
    """W1 + W2: a new batch gets ids continuing the table's, in insertion order."""
    L = silver_listings(spark, sf_dir).select("id", "area")
    table = L.filter(F.col("id") % 2 == 0).withColumn("row_id", F.col("id"))
    batch = L.filter(F.col("id") % 2 == 1)
    new = W.assign_id(batch, ["area", "id"], start_after=table, col="row_id")
    return W.union_sources(table, new.select("id", "area", "row_id"))


def _both_sources(spark, sf_dir):
    js, _ = J.split_rejects(_json_clean(spark, sf_dir))
    kept, _ = _kept_cards(spark, sf_dir)
    html, _ = J.split_rejects(H.clean_cards(kept, AS_OF_DATE))
    return js, html


_UNION_SQL = with_listings(f""", {RAW_HTML_CARDS_SQL}, js AS ({RAW_JSON_EXPECTED_SQL})
SELECT 'json' AS origin, {", ".join(_CLEAN13)} FROM js
UNION ALL SELECT 'html' AS origin, {", ".join(_CLEAN13)} FROM cards""")


@register("union_sources", _UNION_SQL)
def q_union_sources(spark, sf_dir):
    """U1 + P21: both cleaned sources aligned to the listings schema."""
    js, html = _both_sources(spark, sf_dir)
    parts = [W.align_schema(js, extra=[F.lit("json").alias("origin")]),
             W.align_schema(html, extra=[F.lit("html").alias("origin")])]
    return W.union_sources(*parts).select("origin", *_CLEAN13)


@register("accumulate", with_listings(f""", {RAW_HTML_CARDS_SQL}, js AS ({RAW_JSON_EXPECTED_SQL})
SELECT (SELECT count(*) FROM js) + (SELECT count(*) FROM cards) AS n_rows"""))
def q_accumulate(spark, sf_dir):
    """W5 + A11: batches (the JSON payloads and each HTML source) in one union, one count."""
    js, html = _both_sources(spark, sf_dir)
    batches = [js] + [html.filter(F.col("source_id") == s) for s in ("src0", "src1", "src2")]
    _, count = W.accumulate_batches(batches)
    return count


@register("table_roundtrip", """
SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice, true AS has_sid FROM part""")
def q_table_roundtrip(spark, sf_dir):
    """Write, declare, read back and query a table."""
    path = scratch_path(spark, "part_table")
    part = W.add_surrogate_id(read_table(spark, sf_dir, "part"), "sid")
    W.overwrite_table(part, path)
    name = f"part_{uuid.uuid4().hex[:8]}"
    W.ensure_table(spark, name, path, schema=part.schema, database="rentlens_scratch",
                   database_location=scratch_path(spark, "catalog"))
    out = read_back(spark, path)
    assert spark.table(f"rentlens_scratch.{name}").columns == out.columns == part.columns
    W.register_view(out, f"{name}_view")
    result = spark.sql(f"""SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice,
                           sid IS NOT NULL AS has_sid FROM {name}_view""")
    # The frame is resolved: the names it was made by can go.
    spark.catalog.dropTempView(f"{name}_view")
    spark.sql(f"DROP TABLE rentlens_scratch.{name}")
    return result


@register("surrogate_ids", """
SELECT count(*) AS n_rows, count(*) AS n_ids, CAST(0 AS BIGINT) AS n_falling FROM part""")
def q_surrogate_ids(spark, sf_dir):
    """Ids are unique and rise with the rows of a partition."""
    part = W.add_surrogate_id(read_table(spark, sf_dir, "part"), "sid").withColumn("p", F.spark_partition_id())
    falling = F.col("sid") <= F.lag("sid").over(Window.partitionBy("p").orderBy("p_partkey"))
    return part.withColumn("falling", falling).agg(
        F.count("*").alias("n_rows"), F.count_distinct("sid").alias("n_ids"), F.count_if("falling").alias("n_falling"))


@register("upsert_null_order", with_listings("""
SELECT id, CASE WHEN id % 3 = 1 THEN price + 7 ELSE price END AS price FROM listings WHERE id % 3 <> 2
UNION ALL SELECT id, price + 1 FROM listings WHERE id % 3 = 2"""))
def q_upsert_null_order(spark, sf_dir):
    """N3 with NULL orders: a NULL loses to any value, and a key of NULLs still counts."""
    base = silver_listings(spark, sf_dir).select("id", "price", "last_updated")
    target = base.filter("id % 3 <> 2").withColumn("seq", F.lit(0))
    none = F.lit(None).cast("int")
    inserts = base.filter("id % 3 = 2").withColumn("price", F.col("price") + 1).withColumn("seq", none)
    stale = base.filter("id % 3 = 1").withColumn("price", F.col("price") + 99).withColumn("seq", none)
    wins = base.filter("id % 3 = 1").withColumn("price", F.col("price") + 7).withColumn("seq", F.lit(-5))
    source = W.union_sources(inserts, stale, wins)
    return W.upsert_by_key(target, source, key="id", order="seq").select("id", "price")


@register("upsert_versions", with_listings("""
, old AS (SELECT * FROM listings WHERE id % 2 = 0),
new AS (SELECT location, max(price) + 5 AS price FROM listings GROUP BY location
  UNION ALL SELECT concat('NEW - ', r_name), CAST(r_regionkey AS INTEGER) FROM region)
SELECT o.id, o.location, n.price FROM old o JOIN new n ON o.location = n.location
UNION ALL
SELECT (SELECT max(id) FROM old) + row_number() OVER (ORDER BY location) AS id, location, price
FROM new WHERE location NOT IN (SELECT location FROM old)"""))
def q_upsert_versions(spark, sf_dir):
    """W3 as a table: a first version, a merge with inserts that get ids, and a replay that changes nothing."""
    L = silver_listings(spark, sf_dir).select("id", "location", "price")
    table = scratch_path(spark, "versions")
    W.commit_version(L.filter("id % 2 = 0"), table)
    unseen = read_table(spark, sf_dir, "region").select(
        F.concat(F.lit("NEW - "), "r_name").alias("location"), F.col("r_regionkey").cast("int").alias("price"))
    source = (L.groupBy("location").agg((F.max("price") + 5).alias("price")).unionByName(unseen)
              .withColumn("ingest_seq", F.lit(1)))
    for _ in range(2):
        W.upsert_table(source, table, batch_id=1)
    return W.read_version(spark, table)


@register("local_members", with_listings("""
SELECT area, count(*) AS n_rows FROM listings WHERE area IN ('ASIA', 'EUROPE') AND n_beds = 2 GROUP BY area"""))
def q_local_members(spark, sf_dir):
    """R8 + R9: listings added to the empty table, and a selection given as local rows."""
    L = W.union_sources(empty_listings(spark), silver_listings(spark, sf_dir))
    schema = T.StructType([T.StructField("area", T.StringType()), T.StructField("n_beds", T.DoubleType())])
    picked = rows_to_frame(spark, [("ASIA", 2.0), ("EUROPE", 2.0), (None, 1e9)], schema)
    return apply_selection(L, picked, ["area", "n_beds"]).groupBy("area").agg(F.count(F.lit(1)).alias("n_rows"))


_TAGGED = {dst: dst if dst in LISTING_COLUMNS else None for dst in JSON_TAGS}


@register("rename_by_tagmap", with_listings(
    "SELECT id, " + ", ".join(f"CAST({c or 'NULL'} AS VARCHAR) AS {dst}" for dst, c in _TAGGED.items()) + " FROM listings"))
def q_rename_by_tagmap(spark, sf_dir):
    """Columns under the payload's key names become the table's names."""
    L = silver_listings(spark, sf_dir)
    item = F.struct(*[(F.col(c) if c else F.lit(None)).cast("string").alias(JSON_TAGS[dst]) for dst, c in _TAGGED.items()])
    keyed = L.select("id", item.alias("item"))
    return J.rename_by_tagmap(keyed, struct_col="item", keep=["id"])


@register("upsert_buckets", with_listings("""
SELECT id, area, CASE WHEN id % 100 = 7 AND id % 200 <> 7 THEN price + 9 WHEN id % 100 = 7 THEN price + 5 ELSE price END AS price
FROM listings
UNION ALL SELECT -id, area, price FROM listings WHERE id % 100 = 7"""))
def q_upsert_buckets(spark, sf_dir):
    """W3 in key buckets: updates of 1 % of the ids, as many new ids, a late older batch, and a replay."""
    L = silver_listings(spark, sf_dir).select("id", "area", "price", F.lit(0).alias("ingest_seq"))
    table = BucketTable(scratch_path(spark, "bucket-table"), L.schema, "id", "ingest_seq", buckets=32)
    create_buckets(L, table)
    some = L.filter("id % 100 = 7")
    updates = some.withColumns({"price": F.col("price") + 9, "ingest_seq": F.lit(2)})
    newest = some.filter("id % 200 = 7").withColumns({"price": F.col("price") + 5, "ingest_seq": F.lit(3)})
    late = some.withColumns({"price": F.col("price") + 1, "ingest_seq": F.lit(1)})
    new = some.withColumn("id", -F.col("id"))
    for batch_id, batch in enumerate((newest, W.union_sources(updates, new), late, late)):
        upsert_buckets(batch, table, min(batch_id, 2))
    return read_buckets(spark, table).drop("ingest_seq")


@register("append_rerun", """
SELECT p_partkey, p_name, count(*) AS n_copies FROM (SELECT * FROM part UNION ALL SELECT * FROM part) t
GROUP BY p_partkey, p_name""")
def q_append_rerun(spark, sf_dir):
    """One append per run and no dedupe, so a second run duplicates every row."""
    path = scratch_path(spark, "part_append")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    for _ in range(2):
        W.append_listings(part, path)
    back = read_back(spark, path)
    return back.groupBy("p_partkey", "p_name").agg(F.count(F.lit(1)).alias("n_copies"))


_INGEST_SQL = with_listings(f""", {RAW_HTML_CARDS_SQL}, js AS ({RAW_JSON_EXPECTED_SQL}),
all_rows AS (SELECT 0 AS r, '' AS s, ext_id // 500 AS pg, ext_id AS ps, {", ".join(_CLEAN13)} FROM js
  UNION ALL SELECT 1, source_id, page_num, pos, {", ".join(_CLEAN13)} FROM cards)
SELECT row_number() OVER (ORDER BY r, s, pg, ps) AS id, {", ".join(_CLEAN13)} FROM all_rows""")


@register("ingest_run", _INGEST_SQL)
def q_ingest_run(spark, sf_dir):
    """One run of both branches into a new listings table, read back."""
    from ..sources.files import scan_listings
    from .q_clean import _json_clean_with_position

    js, _ = J.split_rejects(_json_clean_with_position(spark, sf_dir))
    kept, _ = _kept_cards(spark, sf_dir)
    path = scratch_path(spark, "listings-table")
    html, _ = J.split_rejects(H.clean_cards(kept, AS_OF_DATE))
    W.append_run(spark, path, json_rows=js, html_rows=html)
    return scan_listings(spark, path)
