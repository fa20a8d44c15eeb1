"""Structured Streaming: ingest, dedupe, upsert, daily counts.

Every stream reads files with a declared schema, keeps its checkpoint in
the shared checkpoint folder, and writes through a replay-safe sink: the
file sink (exactly once per file) or ``foreachBatch`` writing a delta
folder named by the batch id (a replayed batch rewrites the same folder).
Tables kept by upsert are merged on read, so a batch costs its own size.
State (dedupe keys, open windows) lives in the RocksDB state store set in
the session defaults, off the JVM heap.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.bucket_tables import BucketTable, upsert_buckets
from ..operators.tables import upsert_table
from ..operators.windows import latest_per_key
from ..session import scratch_path


def read_stream_files(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                      max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def stream_ingest(spark: SparkSession, in_dir: str, out_dir: str, schema: T.StructType,
                  transform=None, checkpoint: str | None = None, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None) -> None:
    """New files -> ``transform`` (the batch cleaning functions) -> append.

    Runs until every file present at start is processed (``availableNow``);
    the checkpoint makes each file count exactly once across restarts.
    """
    sdf = read_stream_files(spark, in_dir, schema, fmt, max_files_per_trigger)
    if transform is not None:
        sdf = transform(sdf)
    q = (sdf.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint or scratch_path(spark, "ckpt-ingest"))
         .option("path", out_dir).trigger(availableNow=True).start())
    q.awaitTermination()


def stream_quarantine(spark: SparkSession, in_dir: str, out_dir: str, schema: T.StructType, transform,
                      checkpoint: str | None = None, fmt: str = "parquet", max_files_per_trigger: int | None = None) -> None:
    """T1 with both outcomes kept: new files -> ``transform`` -> clean rows and rejects.

    ``transform`` adds ``_reject_reason`` (NULL: a clean row). A micro-batch is
    evaluated once and written once, apart by outcome, to a folder named by
    the batch id; a replayed batch rewrites its folder, so neither outcome is
    lost or doubled. Read with ``read_clean`` and ``read_rejects``.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        marked = transform(batch).withColumn("_rejected", F.col("_reject_reason").isNotNull())
        marked.write.mode("overwrite").partitionBy("_rejected").parquet(delta_path(out_dir, batch_id))

    q = (read_stream_files(spark, in_dir, schema, fmt, max_files_per_trigger).writeStream.foreachBatch(write)
         .option("checkpointLocation", checkpoint or scratch_path(spark, "ckpt-quarantine"))
         .trigger(availableNow=True).start())
    q.awaitTermination()


def read_clean(spark: SparkSession, out_dir: str) -> DataFrame:
    """Clean rows of a quarantined ingest (only their folders are scanned)."""
    return spark.read.parquet(out_dir).filter("_rejected = 'false'").drop("batch", "_rejected", "_reject_reason")


def read_rejects(spark: SparkSession, out_dir: str) -> DataFrame:
    """Rejected rows of a quarantined ingest, with their ``_reject_reason``."""
    return spark.read.parquet(out_dir).filter("_rejected = 'true'").drop("batch", "_rejected")


def stream_dedupe(sdf: DataFrame, key, ts: str, delay: str) -> DataFrame:
    """Drop repeats of ``key`` seen within the watermark delay."""
    keys = [key] if isinstance(key, str) else list(key)
    return sdf.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def delta_path(table_dir: str, batch_id: int) -> str:
    return f"{table_dir.rstrip('/')}/batch={batch_id:09d}"


def stream_upsert(sdf: DataFrame, table_dir: str, key, order: str, checkpoint: str | None = None) -> None:
    """Merge-on-read upsert of every micro-batch.

    A batch writes only its own latest row per key (and its NULL-key rows,
    which never match) to a delta folder named by the batch id: the write
    costs the batch, not the table, and a replayed batch rewrites the same
    folder. ``read_upserted`` merges the deltas (greatest ``order`` wins, so
    batch order does not matter); ``compact_upserted`` folds them into one.
    """
    spark = sdf.sparkSession
    keys = [key] if isinstance(key, str) else list(key)

    def write_delta(batch: DataFrame, batch_id: int) -> None:
        # One pass over the batch: rows without a key are kept apart by a key of their own.
        no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        apart = batch.withColumn("__apart", F.when(no_key, F.monotonically_increasing_id()))
        delta = latest_per_key(apart, [*keys, "__apart"], order).drop("__apart")
        delta.write.mode("overwrite").parquet(delta_path(table_dir, batch_id))

    q = (sdf.writeStream.foreachBatch(write_delta)
         .option("checkpointLocation", checkpoint or scratch_path(spark, "ckpt-upsert"))
         .trigger(availableNow=True).start())
    q.awaitTermination()


def stream_upsert_table(sdf: DataFrame, table_dir: str, key: str, order: str, checkpoint: str | None = None) -> None:
    """T3 on a versioned table: every micro-batch is merged into it (``upsert_table``).

    Rows are replaced only by newer ones, so the order of the batches does not
    matter, and a replayed batch is known by its id. Each batch rewrites the
    table; ``stream_upsert_buckets`` and ``stream_upsert`` are the ones to take where that costs too much.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        upsert_table(batch, table_dir, key, order, id_col=None, batch_id=batch_id, only_newer=True)

    q = (sdf.writeStream.foreachBatch(merge)
         .option("checkpointLocation", checkpoint or scratch_path(sdf.sparkSession, "ckpt-upsert-table"))
         .trigger(availableNow=True).start())
    q.awaitTermination()


def stream_upsert_buckets(sdf: DataFrame, table: BucketTable, checkpoint: str | None = None) -> None:
    """T3 on a table in key buckets: a micro-batch rewrites only the folders its keys lie in."""
    q = (sdf.writeStream.foreachBatch(lambda batch, batch_id: upsert_buckets(batch, table, batch_id) and None)
         .option("checkpointLocation", checkpoint or scratch_path(sdf.sparkSession, "ckpt-buckets"))
         .trigger(availableNow=True).start())
    q.awaitTermination()


def read_upserted(spark: SparkSession, table_dir: str, key, order: str,
                  schema: T.StructType | None = None) -> DataFrame:
    """The upserted table: greatest ``order`` per key over all deltas; NULL-key rows kept.

    One partial aggregate (``max_by``) on read; the ``batch`` folder column
    is dropped.
    """
    keys = [key] if isinstance(key, str) else list(key)
    r = spark.read
    if schema is not None:
        r = r.schema(T.StructType(list(schema.fields) + [T.StructField("batch", T.IntegerType())]))
    d = r.parquet(table_dir).drop("batch")
    has_key = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return latest_per_key(d.filter(has_key), keys, order).unionByName(d.filter(~has_key))


def compact_upserted(spark: SparkSession, table_dir: str, key, order: str, out_dir: str) -> DataFrame:
    """Fold all deltas into one table at ``out_dir`` (a new folder, never the one read).

    The old folder can be dropped once no reader holds it; the stream goes on
    in ``out_dir`` with its checkpoint, whose batch ids continue.
    """
    merged = read_upserted(spark, table_dir, key, order)
    merged.write.mode("overwrite").parquet(out_dir)
    return spark.read.parquet(out_dir)


def daily_counts(sdf: DataFrame, ts: str, by=(), delay: str = "1 day", size: str = "1 day") -> DataFrame:
    """T4: tumbling-window counts; rows later than the watermark are dropped."""
    w = F.window(F.col(ts), size)
    return (sdf.withWatermark(ts, delay).groupBy(w.alias("window"), *by)
            .agg(F.count(F.lit(1)).alias("n_events"))
            .select(F.col("window.start").alias("window_start"), *by, "n_events"))


def stream_counts_to_table(agg: DataFrame, table_dir: str, keys: list[str],
                           checkpoint: str | None = None) -> None:
    """Run a windowed aggregate in update mode; each batch writes the windows
    it updated (with their full new counts) as a delta folder. The table is
    ``read_upserted(..., keys, order='batch_seq')``: the newest count of
    every window wins."""
    spark = agg.sparkSession

    def write_delta(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_seq", F.lit(batch_id).cast("long"))
         .write.mode("overwrite").parquet(delta_path(table_dir, batch_id)))

    q = (agg.writeStream.outputMode("update").foreachBatch(write_delta)
         .option("checkpointLocation", checkpoint or scratch_path(spark, "ckpt-counts"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
