"""W3/J5 on a table in key buckets: an upsert rewrites only the folders its keys lie in.

A bucket table is a Parquet folder partitioned by a hash of the key. A batch
touches the buckets of its keys; their rows are merged, written beside the
table first (``_pending``, which readers do not see) and then put in the place
of those folders by dynamic partition overwrite. The other folders are neither
read nor written, so an upsert costs the buckets it touches.

Replays and lost jobs: a batch is known by its id. Once its merged rows are
written whole, a replay does not merge again (the table may hold the batch
already) but puts the same rows in place again, which changes nothing. A job
that dies while folders are replaced is mended by running the batch again. One
writer at a time: batches of a table come one after the other, as a stream's do.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.files import delete_folder, is_written, list_names
from .tables import upsert_by_key

BUCKET = "key_bucket"
# Rows of a batch that one task sorts by key. A scan's size limit counts
# compressed bytes, so its tasks may hold far more.
TASK_ROWS = 50_000


@dataclass(frozen=True)
class BucketTable:
    """Where a table lies, its columns, its key, and how many folders it has."""
    path: str
    schema: T.StructType
    key: str
    order: str
    buckets: int = 64
    stored: T.StructType = field(init=False, repr=False)

    def __post_init__(self):
        if BUCKET in self.schema.fieldNames():
            raise ValueError(f"a column of a bucket table cannot be called {BUCKET}")
        object.__setattr__(self, "stored", T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())]))

    def bucket(self) -> Column:
        """The folder of a key (rows without a key share one)."""
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def pending(self, batch_id) -> str:
        return f"{self.path}/_pending/batch={batch_id}"


def _put(df: DataFrame, path: str, dynamic: bool) -> None:
    # A bucket is one file, unless it is large; the hint splits what is large or skewed.
    w = df.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET)
    w.option("partitionOverwriteMode", "dynamic" if dynamic else "static").parquet(path)


def create_buckets(df: DataFrame, table: BucketTable) -> None:
    """The table's first rows."""
    _put(df.select(*table.schema.fieldNames()).withColumn(BUCKET, table.bucket()), table.path, dynamic=False)


def _bucket_names(spark: SparkSession, path: str) -> list[str]:
    return [n for n in list_names(spark, path) if n.startswith(f"{BUCKET}=")]


def read_buckets(spark: SparkSession, table: BucketTable, buckets: list[int] | None = None) -> DataFrame:
    """The table's rows, or those of some buckets (a partition filter)."""
    if not _bucket_names(spark, table.path):
        return spark.createDataFrame([], table.schema)
    df = spark.read.schema(table.stored).parquet(table.path)
    if buckets is not None:
        df = df.filter(F.col(BUCKET).isin(buckets))
    return df.drop(BUCKET)


def _dealt(source: DataFrame) -> DataFrame:
    """``source`` over enough tasks for ``TASK_ROWS`` rows or so each; by its rows, so that a frequent key is spread."""
    n = -(-source.count() // TASK_ROWS)
    if n <= source.rdd.getNumPartitions():
        return source
    return source.repartition(n, F.xxhash64(*source.columns))


def merge_pending(source: DataFrame, table: BucketTable, batch_id, only_newer: bool = True) -> list[int]:
    """Merge a batch with the buckets it touches, into the batch's pending folder; returns those buckets.

    Does nothing if the pending folder is written already. The buckets are at
    most ``table.buckets`` numbers.
    """
    spark, pending = source.sparkSession, table.pending(batch_id)
    if not is_written(spark, pending):
        source = _dealt(source).checkpoint()  # read three times
        touched = [r[0] for r in source.select(table.bucket()).distinct().collect()]
        target = read_buckets(spark, table, touched)
        merged = upsert_by_key(target, source, table.key, table.order, only_newer)
        _put(merged.withColumn(BUCKET, table.bucket()), pending, dynamic=False)
    return sorted(int(n.partition("=")[2]) for n in _bucket_names(spark, pending))


def read_pending(spark: SparkSession, table: BucketTable, batch_id) -> DataFrame:
    """A batch's merged rows: what its buckets hold once it is applied."""
    return spark.read.schema(table.stored).parquet(table.pending(batch_id)).drop(BUCKET)


def apply_pending(spark: SparkSession, table: BucketTable, batch_id, touched: list[int]) -> None:
    """Put a batch's merged rows in the place of its buckets; earlier batches' pending folders go."""
    if touched:
        _put(spark.read.schema(table.stored).parquet(table.pending(batch_id)), table.path, dynamic=True)
    for name in list_names(spark, f"{table.path}/_pending"):
        if name != f"batch={batch_id}":
            delete_folder(spark, f"{table.path}/_pending/{name}")


def upsert_buckets(source: DataFrame, table: BucketTable, batch_id=None, only_newer: bool = True) -> list[int]:
    """``upsert_by_key`` of a batch into the table. Returns the buckets rewritten.

    Rows are replaced only by newer ones unless ``only_newer`` is False. Give a
    ``batch_id`` where a batch can be replayed.
    """
    spark = source.sparkSession
    batch_id = uuid.uuid4().hex[:12] if batch_id is None else batch_id
    touched = merge_pending(source, table, batch_id, only_newer)
    apply_pending(spark, table, batch_id, touched)
    return touched
