"""Table writes and maintenance.

Tables are Parquet folders. Writes never replace the folder being read: the
upsert writes a new version folder, and ``overwrite_table`` refuses a target
its input reads from.
"""

from __future__ import annotations

import json
import re
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import LISTINGS
from ..sources.files import create_file
from .windows import latest_per_key


# --- W1, W4, W6, W7, W8 ----------------------------------------------------

def append_listings(df: DataFrame, path: str, partition_by=None) -> None:
    """One append per run (no dedupe: a rerun duplicates rows)."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def overwrite_table(df: DataFrame, path: str, partition_by=None) -> None:
    """Replace the table contents. Refuses to overwrite a folder ``df`` reads."""
    norm = re.sub("^file:/*", "/", path).rstrip("/")
    if any(f == norm or f.startswith(norm + "/") or norm.startswith(f + "/") for f in _input_roots(df)):
        raise ValueError(f"refusing to overwrite {path}: the frame reads from it; write a new version")
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def _input_roots(df: DataFrame) -> list[str]:
    """Root folders of the file scans in the frame's plan (no listing of files)."""
    out = []
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.nodeName() != "LogicalRelation" and not leaf.getClass().getSimpleName() == "LogicalRelation":
            continue
        relation = leaf.relation()
        if relation.getClass().getSimpleName() == "HadoopFsRelation":
            roots = relation.location().rootPaths()
            out += [re.sub("^file:/*", "/", roots.apply(k).toString()) for k in range(roots.size())]
    return out


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Name a frame for SQL."""
    df.createOrReplaceTempView(name)
    return df


def ensure_table(spark: SparkSession, name: str, path: str, schema: T.StructType = LISTINGS,
                 database: str | None = None, database_location: str | None = None, replace: bool = False) -> bool:
    """Create the database and a Parquet table at ``path`` if absent.

    ``replace`` declares the table anew (its files at the old place stay).

    ``database_location`` places a new database in a shared folder (without
    it the catalog's warehouse folder is used). Returns whether the table
    existed before.
    """
    full = f"{database}.{name}" if database else name
    if database:
        where = f" LOCATION '{database_location}'" if database_location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")
    existed = spark.catalog.tableExists(full)
    if existed and replace:
        spark.sql(f"DROP TABLE {full}")
    if not existed or replace:
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {full} ({cols}) USING parquet LOCATION '{path}'")
    return existed


def add_surrogate_id(df: DataFrame, col: str = "id") -> DataFrame:
    """Unique, increasing, not consecutive."""
    return df.withColumn(col, F.monotonically_increasing_id())


# --- W2: ordered consecutive ids --------------------------------------------

def assign_id(df: DataFrame, order_by: list[str], start_after=0, col: str = "id",
              num_partitions: int | None = None) -> DataFrame:
    """Ids ``start_after + 1, +2, ...`` in ``order_by`` order.

    ``start_after`` is a number or a frame whose ``col`` holds the current
    ids (ids continue from its max). The input is checkpointed first, since
    range partitioning reads it twice (sample, then rows); the sorted
    partitions are checkpointed too, so a recomputation cannot reorder them.
    Per-partition row counts, summed up over one row per partition, give each
    partition its offset, joined back on the partition: the plan's size does
    not depend on the number of partitions.
    """
    spark = df.sparkSession
    if isinstance(start_after, DataFrame):
        mx = start_after.agg(F.max(col).alias("m")).first()["m"]
        base = int(mx) if mx is not None else 0
    else:
        base = int(start_after)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (df.checkpoint().repartitionByRange(n, *order_by).sortWithinPartitions(*order_by)
               .withColumn("__mid", F.monotonically_increasing_id()))
    ordered = ordered.checkpoint(eager=True)
    ordered = ordered.withColumn("__pid", F.shiftright("__mid", 33))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ordered.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
               .select("__pid", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off")))
    idx = F.col("__mid") - F.shiftleft("__pid", 33)
    return (ordered.join(offsets, "__pid").withColumn(col, F.lit(base) + F.col("__off") + idx + 1)
            .drop("__mid", "__pid", "__off"))


# --- U1, P21, W5 -------------------------------------------------------------

def align_schema(df: DataFrame, schema: T.StructType = LISTINGS, extra=()) -> DataFrame:
    """Add missing columns as NULL and cast to the declared types."""
    cols = []
    for f in schema.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols, *extra)


def union_sources(*frames: DataFrame) -> DataFrame:
    """Bag union by column name; missing columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def accumulate_batches(frames) -> tuple[DataFrame, DataFrame]:
    """One union of all batches and its row count (one job, not per row)."""
    u = union_sources(*frames)
    return u, u.agg(F.count(F.lit(1)).alias("n_rows"))


# --- W3/J5/N3: upsert ----------------------------------------------------------

def upsert_by_key(target: DataFrame, source: DataFrame, key: str = "location", order: str = "ingest_seq",
                  only_newer: bool = False) -> DataFrame:
    """MERGE ... WHEN MATCHED UPDATE * WHEN NOT MATCHED INSERT *, applied row by row.

    - Per key only the last source row (greatest ``order``) survives.
    - Matched target rows (all duplicates of the key) take its values.
    - Unmatched latest rows are inserted; target rows without a match stay.
    - Source rows with a NULL key never match: each one is inserted.
    - ``only_newer``: a matched target row is replaced only when the source
      row's ``order`` is greater (out-of-order micro-batches).

    Result columns are the target's; ``order`` is kept when the target has it.

    Plan: ``max_by`` per key (partial aggregate), target LEFT JOIN latest on
    the key (AQE splits a skewed target key; a single FULL OUTER JOIN would
    do it in one join but cannot be skew-split), and latest LEFT ANTI the
    target's distinct keys (partial aggregate) for the inserts.
    """
    cols = target.columns
    src = source.select(*[c for c in source.columns if c in cols or c == order])
    keyed = src.filter(F.col(key).isNotNull())
    latest = latest_per_key(keyed, key, order)
    new_vals = latest.select(*[F.col(c).alias(f"__new_{c}") for c in latest.columns])
    j = target.join(new_vals, target[key] == new_vals[f"__new_{key}"], "left")
    matched = F.col(f"__new_{key}").isNotNull()
    if only_newer and order in cols:
        new, old = F.col(f"__new_{order}"), F.col(order)
        matched = matched & new.isNotNull() & (old.isNull() | (new > old))
    updated = j.select(*[F.when(matched, F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c)
                         if f"__new_{c}" in j.columns else F.col(c) for c in cols])
    inserts = latest.join(target.select(key).distinct(), key, "left_anti")
    null_keyed = src.filter(F.col(key).isNull())
    out = updated.unionByName(inserts.select(*[c for c in cols if c in inserts.columns]),
                              allowMissingColumns=True)
    return out.unionByName(null_keyed.select(*[c for c in cols if c in null_keyed.columns]),
                           allowMissingColumns=True).select(*cols)


# --- W3 as a table: versions and commits -----------------------------------------
# A versioned table is a folder of data versions and a folder of commits, one
# small file each, named by the version. Readers take the version of the last
# commit, so a reader never sees a half-written version and an upsert never
# touches the files read. A commit file is created only if there is none of its
# name: of two writers that began from one version, the second one fails.

# Merges begun anew when other writers commit meanwhile.
COMMIT_TRIES = 10
_COMMIT = "version long, folder string, batch_id long"


class CommitConflict(RuntimeError):
    """Another writer has committed since the version that was read."""


def _commits(spark: SparkSession, table_dir: str) -> DataFrame | None:
    try:
        return spark.read.schema(_COMMIT).json(f"{table_dir}/commits")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def last_version(spark: SparkSession, table_dir: str) -> tuple[int, str | None]:
    """Number and folder of the last commit (0 and None before the first)."""
    log = _commits(spark, table_dir)
    row = log.agg(F.max(F.struct("version", "folder")).alias("last")).first()["last"] if log is not None else None
    return (row["version"], row["folder"]) if row else (0, None)


def commit_version(df: DataFrame, table_dir: str, batch_id: int | None = None, base: int | None = None) -> str:
    """Write ``df`` as the version after ``base`` (default: after the last) and point readers to it.

    Raises ``CommitConflict`` if that version exists by then; its rows are then
    not in ``df``, so the caller has to merge anew.
    """
    spark = df.sparkSession
    version = (last_version(spark, table_dir)[0] if base is None else base) + 1
    folder = f"v{version:09d}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(f"{table_dir}/{folder}")
    commit = json.dumps({"version": version, "folder": folder, "batch_id": batch_id})
    if not create_file(spark, f"{table_dir}/commits/{version:09d}.json", commit):
        raise CommitConflict(f"version {version} of {table_dir} is taken")
    return folder


def read_version(spark: SparkSession, table_dir: str) -> DataFrame:
    """The table's last committed version."""
    return spark.read.parquet(f"{table_dir}/{last_version(spark, table_dir)[1]}")


def upsert_table(source: DataFrame, table_dir: str, key: str = "location", order: str = "ingest_seq",
                 id_col: str | None = "id", batch_id: int | None = None, only_newer: bool = False) -> bool:
    """W3 on a versioned table: merge ``source`` into a new version and commit it.

    The source is checkpointed, so it is evaluated once. Inserted rows
    without an id get ids continuing the table's. A ``batch_id`` that is
    already committed is skipped (returns False), so a replayed micro-batch
    changes nothing. Where another writer commits first, the merge is done again
    on that writer's version.
    """
    spark, source = source.sparkSession, source.checkpoint()
    for _ in range(COMMIT_TRIES):
        base, folder = last_version(spark, table_dir)
        if batch_id is not None and _commits(spark, table_dir).filter(F.col("batch_id") == batch_id).limit(1).count():
            return False
        target = spark.read.parquet(f"{table_dir}/{folder}")
        merged = upsert_by_key(target, source, key, order, only_newer)
        if id_col and id_col in target.columns and id_col not in source.columns:
            has = merged.filter(F.col(id_col).isNotNull())
            new = merged.filter(F.col(id_col).isNull()).drop(id_col)
            new = assign_id(new, [key, order] if order in merged.columns else [key], start_after=target, col=id_col)
            merged = has.unionByName(new.withColumn(id_col, F.col(id_col).cast(target.schema[id_col].dataType)))
        try:
            commit_version(merged.select(*target.columns), table_dir, batch_id, base)
            return True
        except CommitConflict:
            continue
    raise CommitConflict(f"{COMMIT_TRIES} tries to commit to {table_dir} met other writers")


# --- one ingest run: both branches -> ids -> one append ------------------------

def append_run(spark: SparkSession, table_path: str, json_rows: DataFrame | None = None,
               html_rows: DataFrame | None = None) -> None:
    """One ingest run into the listings table (W2 + W1 + U1 + P21).

    ``json_rows`` carry ``payload_id`` and ``pos``; ``html_rows`` carry
    ``source_id``, ``page_num`` and ``pos``. Rows get ids continuing the
    table's largest, in insertion order: the JSON source first, then the
    HTML sources, each by payload/page and position; then one append.
    """
    parts = []
    if json_rows is not None:
        parts.append(align_schema(json_rows, extra=[
            F.lit(0).alias("__branch"), F.lit("").alias("__source"),
            F.col("payload_id").cast("long").alias("__page"), F.col("pos").cast("long").alias("__pos")]))
    if html_rows is not None:
        parts.append(align_schema(html_rows, extra=[
            F.lit(1).alias("__branch"), F.col("source_id").alias("__source"),
            F.col("page_num").cast("long").alias("__page"), F.col("pos").cast("long").alias("__pos")]))
    if not parts:
        return
    batch = union_sources(*parts).drop("id")
    try:
        existing = spark.read.schema(LISTINGS).parquet(table_path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        existing = 0  # no table yet: ids start at 1
    with_ids = assign_id(batch, ["__branch", "__source", "__page", "__pos"], start_after=existing, col="id")
    append_listings(align_schema(with_ids), table_path)
