"""Streaming queries (T1-T4) over ``events`` split into daily files, with batch oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import dashboard as dash
from ..operators.bucket_tables import BucketTable
from ..operators.tables import commit_version, read_version
from ..session import scratch_path
from ..sources import json_payloads as J
from ..sources.files import read_table
from ..streaming import listings_stream as S
from ..streaming.crawl_stream import read_page_cutoff, stream_page_cutoff
from ..streaming.sheets_stream import read_sheets, stream_sheets
from .q_clean import AS_OF_DATE
from .q_html import PAGE_CUTOFF_SQL
from .q_sheets import ADDITIVE_SQL, AVAILABLE_DAYS
from .registry import register
from .standins import RAW_JSON_EXPECTED_SQL, captured_html_pages, captured_json_path, silver_listings, with_listings

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
    T.StructField("day", T.DateType()),
])


_EVENT_FILES: dict[tuple[str, str, int], str] = {}


def _event_files(spark, sf_dir, copies: int = 1) -> str:
    """``events`` written as one folder per day (``copies`` times, to replay),
    once per application; a stream only reads them."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), copies)
    if key in _EVENT_FILES:
        return _EVENT_FILES[key]
    d = scratch_path(spark, "events-in")
    ev = read_table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    ev = ev.withColumn("day", F.to_date("ts"))
    for _ in range(copies):
        ev.hint("rebalance", "day").write.mode("append").partitionBy("day").parquet(d)
    _EVENT_FILES[key] = d
    return d


def _clean_events(sdf):
    return sdf.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_type",
                      F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("prop_k"))


@register("stream_ingest", """
SELECT event_id, ts, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS prop_k FROM events""")
def q_stream_ingest(spark, sf_dir):
    """Files -> cleaning -> parquet sink, exactly once per file."""
    src = _event_files(spark, sf_dir)
    out = scratch_path(spark, "events-clean")
    S.stream_ingest(spark, src, out, EVENT_SCHEMA, transform=_clean_events, max_files_per_trigger=10)
    return spark.read.parquet(out)


@register("stream_listings", with_listings(RAW_JSON_EXPECTED_SQL))
def q_stream_listings(spark, sf_dir):
    """T1 on payload files: bodies -> cleaning rules -> clean rows appended, over several micro-batches."""
    schema = T.StructType([T.StructField("payload_id", T.LongType()), T.StructField("body", T.StringType())])

    def clean(sdf):
        items = J.read_json_payloads(sdf, keep=["payload_id"])
        items = items.withColumn("ext_id", F.try_variant_get("item", "$.listing_id", "bigint"))
        return J.split_rejects(J.clean_json_listings(items, as_of=AS_OF_DATE, keep=["ext_id"]))[0]

    out = scratch_path(spark, "listings-clean")
    S.stream_ingest(spark, captured_json_path(spark, sf_dir), out, schema, transform=clean, max_files_per_trigger=3)
    return spark.read.parquet(out)


@register("stream_rejects", with_listings("""
SELECT id AS ext_id, concat_ws('; ', CASE WHEN last_updated IS NULL THEN 'unparsable last_updated' END,
  CASE WHEN id % 97 = 0 THEN 'unparsable price' END,
  CASE WHEN id % 89 = 0 THEN 'no street_address in building_address' END) AS _reject_reason
FROM listings WHERE last_updated IS NULL OR id % 97 = 0 OR id % 89 = 0"""))
def q_stream_rejects(spark, sf_dir):
    """T1 with a quarantine, run twice: the rejected rows of the payload stream, beside the clean ones."""
    schema = T.StructType([T.StructField("payload_id", T.LongType()), T.StructField("body", T.StringType())])

    def clean(batch):
        items = J.read_json_payloads(batch, keep=["payload_id"])
        items = items.withColumn("ext_id", F.try_variant_get("item", "$.listing_id", "bigint"))
        return J.clean_json_listings(items, as_of=AS_OF_DATE, keep=["ext_id"])

    out, src = scratch_path(spark, "listings-quarantine"), captured_json_path(spark, sf_dir)
    for _ in range(2):  # a new checkpoint: every batch is replayed
        S.stream_quarantine(spark, src, out, schema, clean, max_files_per_trigger=3)
    return S.read_rejects(spark, out).select("ext_id", "_reject_reason")


_MOVED_SQL = with_listings(f""", now AS (SELECT * REPLACE (
  CASE WHEN id % 7 = 0 THEN n_beds + 1 ELSE n_beds END AS n_beds,
  CASE WHEN id % 7 = 0 THEN price + 50 WHEN id % 11 = 0 THEN NULL ELSE price END AS price,
  CASE WHEN id % 14 = 0 THEN 'ASIA' ELSE area END AS area,
  CASE WHEN id % 21 = 0 THEN NULL ELSE last_updated END AS last_updated) FROM listings)
SELECT sheet, {", ".join(dash.KEYS)}, n, avg_price FROM ({ADDITIVE_SQL.replace("FROM listings", "FROM now")}) s""")


@register("stream_sheets", _MOVED_SQL)
def q_stream_sheets(spark, sf_dir):
    """T3 into A1-A5: listings, then changes that move rows between groups, then older rows that change nothing."""
    L = silver_listings(spark, sf_dir)
    by = lambda n: F.col("id") % n == 0
    moved = L.filter(by(7) | by(11)).withColumns({
        "n_beds": F.when(by(7), F.col("n_beds") + 1).otherwise(F.col("n_beds")),
        "price": F.when(by(7), F.col("price") + 50).otherwise(F.lit(None).cast("int")),
        "area": F.when(by(14), "ASIA").otherwise(F.col("area")),
        "last_updated": F.when(~by(21), F.col("last_updated"))})
    schema = T.StructType([*L.schema.fields, T.StructField("ingest_seq", T.IntegerType())])
    table = BucketTable(scratch_path(spark, "sheet-listings"), schema, "id", "ingest_seq", buckets=16)
    sheets, src, ckpt = scratch_path(spark, "sheets"), scratch_path(spark, "changes-in"), scratch_path(spark, "ckpt-sheets")
    # Newest first for some; the first capture of the others before their change.
    lots = [(moved.filter("id % 2 = 0"), 2), (L, 1), (moved.filter("id % 2 = 1"), 2), (L.filter("id % 3 = 0"), 0)]
    for rows, seq in lots:
        rows.withColumn("ingest_seq", F.lit(seq)).write.mode("append").parquet(src)
        stream_sheets(S.read_stream_files(spark, src, schema), table, sheets, AVAILABLE_DAYS, checkpoint=ckpt)
    return read_sheets(spark, sheets)


@register("stream_page_cutoff", PAGE_CUTOFF_SQL)
def q_stream_page_cutoff(spark, sf_dir):
    """R6/N1 over two runs of one stream; every third page of a source comes with the second."""
    pages = captured_html_pages(spark, sf_dir).select("source_id", "page_num", "html")
    src, out = scratch_path(spark, "pages-lots"), scratch_path(spark, "crawl-stands")
    ckpt = scratch_path(spark, "ckpt-crawl")
    for lot in ("page_num % 3 != 0", "page_num % 3 = 0"):
        pages.filter(lot).write.mode("append").parquet(src)
        stream_page_cutoff(S.read_stream_files(spark, src, pages.schema, max_files_per_trigger=20), out, ckpt)
    return read_page_cutoff(spark, out).select("source_id", "last_page")


def _in_two_runs(spark, sf_dir, first, second, start):
    """Event files arrive in two lots; one stream (one checkpoint) runs after each."""
    ev = read_table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    ev = ev.withColumn("day", F.to_date("ts"))
    src, ckpt = scratch_path(spark, "events-lots"), scratch_path(spark, "ckpt-lots")
    for lot in (first, second):
        ev.filter(lot).hint("rebalance", "day").write.mode("append").partitionBy("day").parquet(src)
        start(S.read_stream_files(spark, src, EVENT_SCHEMA), ckpt)


@register("stream_dedupe", """
SELECT event_id, ts, event_type FROM events""")
def q_stream_dedupe(spark, sf_dir):
    """Every day file arrives again in a later micro-batch; repeats are dropped by state or as late."""
    out = scratch_path(spark, "events-dedupe")

    def start(sdf, ckpt):
        d = S.stream_dedupe(sdf, "event_id", "ts", "2 days").select(
            "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_type")
        q = (d.writeStream.format("parquet").outputMode("append").option("checkpointLocation", ckpt)
             .option("path", out).trigger(availableNow=True).start())
        q.awaitTermination()

    _in_two_runs(spark, sf_dir, F.lit(True), F.lit(True), start)
    return spark.read.parquet(out)


@register("stream_late_counts", """
SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, event_type, count(*) AS n_events
FROM events WHERE event_id % 10 <> 0 OR CAST(date_trunc('day', ts) AS TIMESTAMP) + INTERVAL 1 DAY
  > (SELECT max(ts) FROM events WHERE event_id % 10 <> 0) - INTERVAL 1 DAY
GROUP BY ALL""")
def q_stream_late_counts(spark, sf_dir):
    """T4 over two micro-batches: every tenth event comes late; those behind the watermark are dropped."""
    table = scratch_path(spark, "late-counts")

    def start(sdf, ckpt):
        agg = S.daily_counts(sdf, "ts", by=["event_type"], delay="1 day")
        S.stream_counts_to_table(agg, table, ["window_start", "event_type"], checkpoint=ckpt)

    _in_two_runs(spark, sf_dir, F.col("event_id") % 10 != 0, F.col("event_id") % 10 == 0, start)
    return S.read_upserted(spark, table, ["window_start", "event_type"], "batch_seq").select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n_events")


@register("stream_upsert_table", """
WITH latest AS (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
n AS (SELECT user_id, greatest(1, count(*) FILTER (WHERE event_id % 2 = 0)) AS c FROM events GROUP BY user_id)
SELECT user_id, event_id, value FROM latest JOIN n USING (user_id), generate_series(1, c) g(i)""")
def q_stream_upsert_table(spark, sf_dir):
    """T3 into an existing table with duplicate keys: all rows of a user take the newest event's values."""
    seq = F.struct(F.col("ts").cast("timestamp_ntz").alias("t"), F.col("event_id").alias("e")).alias("seq")
    table = scratch_path(spark, "users-table")
    old = read_table(spark, sf_dir, "events").filter("event_id % 2 = 0")
    commit_version(old.select("user_id", "event_id", "value", seq), table)
    sdf = S.read_stream_files(spark, _event_files(spark, sf_dir), EVENT_SCHEMA, max_files_per_trigger=12)
    S.stream_upsert_table(sdf.select("user_id", "event_id", "value", seq), table, "user_id", "seq")
    return read_version(spark, table).drop("seq")


@register("stream_upsert", """
SELECT user_id, event_id, ts, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def q_stream_upsert(spark, sf_dir):
    """Latest event per user kept by merging each micro-batch (several batches)."""
    src = _event_files(spark, sf_dir)
    table = scratch_path(spark, "users-latest")
    sdf = (S.read_stream_files(spark, src, EVENT_SCHEMA, max_files_per_trigger=10)
           .select("user_id", "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_type", "value",
                   F.struct(F.col("ts").cast("timestamp_ntz").alias("t"), F.col("event_id").alias("e")).alias("seq")))
    S.stream_upsert(sdf, table, key="user_id", order="seq")
    return S.read_upserted(spark, table, "user_id", "seq").drop("seq")


@register("stream_daily_counts", """
SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, event_type, count(*) AS n_events
FROM events GROUP BY ALL""")
def q_stream_daily_counts(spark, sf_dir):
    """T4: daily tumbling counts by event type in update mode, merged per batch."""
    src = _event_files(spark, sf_dir)
    table = scratch_path(spark, "daily-counts")
    sdf = S.read_stream_files(spark, src, EVENT_SCHEMA)
    agg = S.daily_counts(sdf, "ts", by=["event_type"], delay="1 day")
    S.stream_counts_to_table(agg, table, ["window_start", "event_type"])
    return S.read_upserted(spark, table, ["window_start", "event_type"], "batch_seq").select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n_events")
