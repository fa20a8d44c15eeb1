"""Captured inputs are written so that readers hold few large texts at a time."""

import datetime as dt
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from rentlens.plans import standins


def test_bodies_lie_in_small_row_groups(spark, tmp_path):
    def build(spark, sf_dir):
        return spark.range(2000).select(F.col("id").alias("payload_id"), F.repeat(F.lit("x"), 100).alias("body"))

    standins._captured(spark, str(tmp_path), "json", build)
    path = standins.captured_json_path(spark, str(tmp_path)).removeprefix("file:")
    files = [pq.ParquetFile(f).metadata for f in Path(path).glob("*.parquet")]
    assert sum(m.num_rows for m in files) == 2000
    assert max(m.row_group(i).num_rows for m in files for i in range(m.num_row_groups)) <= 64


@pytest.fixture
def tables(tmp_path):
    n = 6000
    made = {
        "region": {"r_regionkey": [0], "r_name": ["ASIA"]},
        "nation": {"n_nationkey": [0], "n_name": ["INDIA"], "n_regionkey": [0]},
        "customer": {"c_custkey": [0], "c_nationkey": [0], "c_mktsegment": ["FURNITURE"]},
        "orders": {"o_orderkey": range(n), "o_custkey": [0] * n, "o_orderstatus": ["O"] * n, "o_totalprice": [8000.0] * n,
                   "o_orderdate": [dt.datetime(1998, 2, 6)] * n, "o_orderpriority": ["5-LOW"] * n},
    }
    for name, cols in made.items():
        pq.write_table(pa.table({c: list(v) for c, v in cols.items()}), tmp_path / f"{name}.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("build", [standins.raw_json_payloads, standins.raw_html_pages])
def test_a_task_gathers_few_listings(spark, tables, monkeypatch, build):
    monkeypatch.setattr(standins, "GATHER_ROWS", 100, raising=False)
    made = build(spark, tables)
    parts = made.groupBy(F.spark_partition_id()).count().collect()
    whole = made.count()
    assert whole == sum(r["count"] for r in parts) and whole >= 12
    assert len(parts) >= min(8, whole // 2)


def test_python_takes_in_few_bytes_of_pages(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.nbytes]}, schema=pa.schema([("n", pa.int64())]))

    old = {k: spark.conf.get(k) for k in entry._SIZES} if hasattr(entry, "_SIZES") else {}
    entry._prepare(spark)
    pages = spark.range(0, 300, 1, 1).select(F.repeat(F.lit("x"), 50_000).alias("html"))
    most = pages.mapInArrow(sizes, "n long").agg(F.max("n")).first()[0]
    for k, v in old.items():
        spark.conf.set(k, v)
    assert most < 2 << 20
