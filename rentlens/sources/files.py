"""Table scans, empty frames, local rows and read-back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schema import LISTINGS


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin ``df`` over the cluster's cores when its scan is not split enough.

    A file with one row group is read by one task, and every narrow stage
    after it runs on one core. When the input has fewer partitions than the
    default parallelism it is spread evenly; on a large input (many files
    and row groups) this is a no-op and adds no shuffle. Worth it only before
    heavy per-row work (the Python HTML parse); cheap stages are faster
    without the extra exchange.
    """
    n = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < n:
        return df.repartition(n)
    return df


def read_table(spark: SparkSession, sf_dir: str, name: str, spread_rows: bool = False) -> DataFrame:
    """Parquet scan of one test table; column pruning and filters reach the scan.

    ``spread_rows`` spreads an under-split scan over the cores (``spread``).
    """
    df = spark.read.parquet(table_path(sf_dir, name))
    return spread(df) if spread_rows else df


def scan_listings(spark: SparkSession, path: str) -> DataFrame:
    """Full scan of a written listings table with its declared schema."""
    return spark.read.schema(LISTINGS).parquet(path)


def empty_listings(spark: SparkSession, schema: T.StructType = LISTINGS) -> DataFrame:
    """Zero-row frame with the declared schema."""
    return spark.createDataFrame([], schema)


def rows_to_frame(spark: SparkSession, rows, schema: T.StructType = LISTINGS) -> DataFrame:
    """Small local rows (tests, literals) to a frame with a declared schema.

    Bulk data never takes this path; it is produced on executors.
    """
    return spark.createDataFrame(rows, schema)


def read_back(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Load a written table."""
    return spark.read.format(fmt).load(path)


# --- folders, by Spark's own file system classes (any store Spark reads) -----

def _hadoop_path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    fs, p = _hadoop_path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` has been committed."""
    return "_SUCCESS" in list_names(spark, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop_path(spark, path)
    fs.delete(p, True)


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless there is one (then False): of several writers one succeeds."""
    from py4j.protocol import Py4JJavaError

    fs, p = _hadoop_path(spark, path)
    try:
        out = fs.create(p, False)
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" not in e.java_exception.getClass().getName():
            raise
        return False
    out.write(bytearray(text.encode()))
    out.close()
    return True
