"""Ordered, stateful rules as skew-safe Spark plans.

A window partitioned by a low-cardinality key (one source, one location)
sends the whole key to one task. These operators bound that: carry-forward
works in blocks plus a small per-block window; latest-per-key is a
``max_by`` aggregate, which combines map-side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows of one ordered partition handled by one first-level window task.
CARRY_BLOCK = 4096


def carry_forward(df: DataFrame, cols: list[str], partition_by: list[str], order_by: list[str],
                  block: Column | None = None) -> DataFrame:
    """Replace NULLs by the last non-NULL earlier value of the partition.

    ``block`` is an expression that is non-decreasing in the order and
    bounds how many rows share a value (default: the first order column
    divided by ``CARRY_BLOCK``). Level 1 carries inside each
    (partition, block); level 2 carries each block's last value across
    blocks on a frame with one row per block; the two are combined.
    """
    block = F.floor(F.col(order_by[0]) / CARRY_BLOCK) if block is None else block
    d = df.withColumn("__blk", block)
    w1 = (Window.partitionBy(*partition_by, "__blk").orderBy(*order_by)
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # Last non-NULL value of every block, ordered by the full order key: a
    # partial aggregate of the rows themselves, beside the windowed frame.
    order_key = F.struct(*[F.col(o) for o in order_by])
    blk = d.groupBy(*partition_by, "__blk").agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order_key)).alias(f"__blast_{c}") for c in cols])
    w2 = (Window.partitionBy(*partition_by).orderBy("__blk")
          .rowsBetween(Window.unboundedPreceding, -1))
    carry_in = blk.select(*partition_by, "__blk",
                          *[F.last(f"__blast_{c}", ignorenulls=True).over(w2).alias(f"__in_{c}") for c in cols])
    d = d.withColumns({f"__loc_{c}": F.last(c, ignorenulls=True).over(w1) for c in cols})
    j = d.join(carry_in, [*partition_by, "__blk"], "left")
    out = j.withColumns({c: F.coalesce(F.col(f"__loc_{c}"), F.col(f"__in_{c}")) for c in cols})
    return out.drop("__blk", *[f"__{p}_{c}" for p in ("loc", "in") for c in cols])


def latest_per_key(df: DataFrame, key, order: str) -> DataFrame:
    """The row with the greatest ``order`` per ``key`` (last write wins).

    ``key`` is a column name or a list of names. ``max_by`` over a struct of
    all columns is a partial aggregate: each map task keeps one row per key,
    so a key with a third of all rows still ships one row per task. A NULL
    ``order`` comes before any value (a key whose orders are all NULL keeps
    one of its rows); equal orders are decided by a hash of the row.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rank = F.struct(F.col(order).isNotNull(), F.col(order), F.xxhash64(*df.columns))
    latest = df.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), rank).alias("__row"))
    return latest.select("__row.*")
