"""SparkSession construction and checkpoint-directory handling."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Session defaults that every query in the package relies on:
#  - UTC session zone so date parts match the SQL oracle,
#  - AQE with partition coalescing and skew-join splitting,
#  - Arrow for the one Python stage (HTML extraction),
#  - few rows in a batch of a Parquet scan, since bodies and pages are large
#    and a batch is held unpacked,
#  - few bytes in a batch handed to Python: a worker holds two, and its memory
#    stays at the largest it held,
#  - few bytes in a shuffle's partition: they count compressed, and listings
#    take ten times that and more in a task that sorts or gathers them,
#  - no web UI (no extra port).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "1m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.columnarReaderBatchSize": "256",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "rentlens", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults.

    ``master`` is only set when given: on a cluster the launcher decides it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    # The catalog's warehouse folder is the session owner's setting; for a
    # local session that leaves it unset, use a scratch folder rather than
    # the current working directory.
    if (master or "").startswith("local") and "spark.sql.warehouse.dir" not in conf:
        conf["spark.sql.warehouse.dir"] = tempfile.mkdtemp(prefix="rentlens-warehouse-",
                                                           dir=os.environ.get("TMPDIR", "/tmp"))
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names this folder; it is only filled in here when it is unset
    and Spark runs in local mode (tests), where a scratch folder is the only
    folder every task can see.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="rentlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf_dir)
    # Spark nests a per-application sub-folder under the given folder.
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for derived tables."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``rentlens`` importable in executor Python workers.

    The Python stages (HTML extraction, foreachBatch) pickle functions by
    reference, so executors need the package: it is zipped once per driver
    process and added with ``addPyFile`` (what ``--py-files`` does).
    """
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    fd, zpath = tempfile.mkstemp(prefix="rentlens-pkg-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    _SHIPPED.add(app)
