"""T3 into A1-A5: sheets kept up to date by a stream of listing changes.

Every micro-batch is merged into the current listings (a bucket table), and the
sheets' additive states take the difference: the rows its buckets held before
are taken back, the rows they hold now are added. So an update moves a listing
from one group to another, and an older row that arrives late moves nothing.
The difference is a few rows a group, written to a folder named by the batch;
readers add up all folders.

Order of the writes in a batch: merged rows beside the table, the difference,
then the table. A replayed batch finds the first two and repeats the last, so
nothing is counted twice wherever the earlier run stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.bucket_tables import BucketTable, apply_pending, merge_pending, read_buckets, read_pending
from ..operators.dashboard import ADDITIVE, fold_states, sheet_states, sheets_of_states
from ..session import scratch_path
from ..sources.files import is_written


def fold_batch(batch: DataFrame, batch_id: int, table: BucketTable, sheets_dir: str, days, areas=None,
               sheets=tuple(ADDITIVE)) -> None:
    """Merge one micro-batch into the listings and write the sheets' difference."""
    spark = batch.sparkSession
    touched = merge_pending(batch, table, batch_id)
    if not touched:
        return
    folder = f"{sheets_dir}/batch={batch_id:09d}"
    if not is_written(spark, folder):
        before = read_buckets(spark, table, touched).withColumn("sign", F.lit(-1))
        after = read_pending(spark, table, batch_id).withColumn("sign", F.lit(1))
        states = sheet_states(after.unionByName(before), days, areas, sheets, sign="sign")
        changed = states.filter("n_rows != 0 OR n != 0 OR coalesce(price_sum, 0) != 0")
        changed.write.mode("overwrite").parquet(folder)
    apply_pending(spark, table, batch_id, touched)


def stream_sheets(sdf: DataFrame, table: BucketTable, sheets_dir: str, days, areas=None, sheets=tuple(ADDITIVE),
                  checkpoint: str | None = None) -> None:
    """Fold every micro-batch present at the start into the listings and the sheets."""
    def fold(batch: DataFrame, batch_id: int) -> None:
        fold_batch(batch, batch_id, table, sheets_dir, days, areas, sheets)

    q = (sdf.writeStream.foreachBatch(fold)
         .option("checkpointLocation", checkpoint or scratch_path(sdf.sparkSession, "ckpt-sheets"))
         .trigger(availableNow=True).start())
    q.awaitTermination()


def read_sheets(spark: SparkSession, sheets_dir: str) -> DataFrame:
    """The sheets as they stand: ``sheet``, the group columns, ``n`` and ``avg_price``."""
    return sheets_of_states(fold_states(spark.read.parquet(sheets_dir)))
