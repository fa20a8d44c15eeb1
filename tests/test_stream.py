"""Streaming operators: merge-on-read upsert, replay safety, dedupe, window counts."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rentlens.streaming import listings_stream as S

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.IntegerType()),
                       T.StructField("seq", T.LongType())])


def _write(spark, d, rows, name):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{d}/{name}")


def _table(spark, d):
    return sorted(((r.k, r.v, r.seq) for r in S.read_upserted(spark, d, "k", "seq").collect()),
                  key=lambda t: (t[0] is None, t[0] or "", t[2]))


def test_upsert_out_of_order_and_replay(spark, tmp_path):
    src, table, ckpt = str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "ck")
    # The newer row for "a" arrives in the first file, the older one later.
    _write(spark, src, [("a", 2, 20), ("b", 1, 10), (None, 7, 5)], "f1")
    _write(spark, src, [("a", 1, 10), ("c", 3, 30), (None, 8, 6)], "f2")
    sdf = S.read_stream_files(spark, f"{src}/*", SCHEMA, max_files_per_trigger=1)
    S.stream_upsert(sdf, table, "k", "seq", checkpoint=ckpt)
    want = [("a", 2, 20), ("b", 1, 10), ("c", 3, 30), (None, 7, 5), (None, 8, 6)]
    assert _table(spark, table) == want
    # Same checkpoint, nothing new: the table does not change.
    S.stream_upsert(S.read_stream_files(spark, f"{src}/*", SCHEMA), table, "k", "seq", checkpoint=ckpt)
    assert _table(spark, table) == want
    # A new file is picked up exactly once.
    _write(spark, src, [("b", 9, 90)], "f3")
    S.stream_upsert(S.read_stream_files(spark, f"{src}/*", SCHEMA), table, "k", "seq", checkpoint=ckpt)
    assert _table(spark, table)[1] == ("b", 9, 90)
    out = str(tmp_path / "compact")
    assert S.compact_upserted(spark, table, "k", "seq", out).count() == 5


EV = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampType()),
                   T.StructField("kind", T.StringType())])


def test_dedupe_and_daily_counts(spark, tmp_path):
    src = str(tmp_path / "ev")
    t0 = dt.datetime(2024, 1, 1, 10, 0)
    rows = [(i, t0 + dt.timedelta(hours=6 * i), "view" if i % 2 else "click") for i in range(12)]
    df = spark.createDataFrame(rows, EV)
    df.write.mode("append").parquet(src)
    df.write.mode("append").parquet(src)  # a replayed capture: every event twice
    out = str(tmp_path / "dd")
    d = S.stream_dedupe(S.read_stream_files(spark, src, EV), "id", "ts", "2 days")
    q = (d.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", str(tmp_path / "ck1")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(12))

    table = str(tmp_path / "counts")
    agg = S.daily_counts(S.read_stream_files(spark, src, EV), "ts", by=["kind"], delay="1 day")
    S.stream_counts_to_table(agg, table, ["window_start", "kind"], checkpoint=str(tmp_path / "ck2"))
    got = {(r.window_start.date(), r.kind): r.n_events
           for r in S.read_upserted(spark, table, ["window_start", "kind"], "batch_seq").collect()}
    want = {}
    for _, ts, kind in rows:
        want[(ts.date(), kind)] = want.get((ts.date(), kind), 0) + 2
    assert got == want
