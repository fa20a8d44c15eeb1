"""Key buckets, conflict-safe commits, the sheet stream, the quarantine."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rentlens.operators import bucket_tables as B
from rentlens.operators import dashboard as D
from rentlens.operators import filters as flt
from rentlens.operators import tables as W
from rentlens.plans.q_sheets import AVAILABLE_DAYS
from rentlens.plans.standins import silver_listings
from rentlens.streaming import listings_stream as S
from rentlens.streaming import sheets_stream as SS
from tests.conftest import SF_SMALL

ROW = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType()), T.StructField("seq", T.IntegerType())])


def files(path):
    return {os.path.join(os.path.relpath(d, path), f) for d, _, names in os.walk(path) if "_pending" not in d
            for f in names if f.endswith(".parquet")}


def rows(spark, table):
    return sorted(((r.k, r.v, r.seq) for r in B.read_buckets(spark, table).collect()), key=str)


def test_upsert_rewrites_only_the_folders_it_touches(spark, tmp_path):
    table = B.BucketTable(str(tmp_path / "t"), ROW, "k", "seq", buckets=16)
    B.create_buckets(spark.createDataFrame([(i, "old", 0) for i in range(400)], ROW), table)
    before = files(table.path)
    batch = spark.createDataFrame([(3, "new", 1), (3, "newer", 2), (9000, "in", 1), (4, "late", -1)], ROW)
    touched = B.upsert_buckets(batch, table, 1)
    changed = {f.split("/")[0] for f in files(table.path) ^ before}
    assert changed == {f"{B.BUCKET}={b}" for b in touched} and len(touched) <= 3
    want = sorted([(i, "old", 0) for i in range(400) if i != 3] + [(3, "newer", 2), (9000, "in", 1)], key=str)
    assert rows(spark, table) == want
    # A replay finds its merged rows and changes nothing, nor does one after folders went missing.
    B.upsert_buckets(batch, table, 1)
    assert rows(spark, table) == want
    B.delete_folder(spark, f"{table.path}/{B.BUCKET}={touched[0]}")
    B.upsert_buckets(batch, table, 1)
    assert rows(spark, table) == want
    assert B.upsert_buckets(batch.limit(0), table, 2) == [] and rows(spark, table) == want


def test_null_keys_repeats_and_a_table_begun_by_an_upsert(spark, tmp_path):
    table = B.BucketTable(str(tmp_path / "t"), ROW, "k", "seq", buckets=4)
    assert rows(spark, table) == []
    B.upsert_buckets(spark.createDataFrame([(None, "a", 1), (None, "a", 1), (1, "x", None)], ROW), table, 0)
    B.upsert_buckets(spark.createDataFrame([(None, "b", 1), (1, "y", 1)], ROW), table, 1)
    assert rows(spark, table) == sorted([(None, "a", 1), (None, "a", 1), (None, "b", 1), (1, "y", 1)], key=str)
    with pytest.raises(ValueError):
        B.BucketTable("x", T.StructType([T.StructField(B.BUCKET, T.LongType())]), "k", "seq")


def test_two_writers_from_one_version(spark, tmp_path):
    path = str(tmp_path / "t")
    rows_of = lambda *ids: spark.createDataFrame([(i, "a") for i in ids], "id long, location string")
    W.commit_version(rows_of(1), path)
    base, _ = W.last_version(spark, path)
    W.commit_version(rows_of(1, 2), path, base=base)
    with pytest.raises(W.CommitConflict):
        W.commit_version(rows_of(1, 3), path, base=base)
    assert sorted(r.id for r in W.read_version(spark, path).collect()) == [1, 2]


def test_upsert_merges_anew_after_a_conflict(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    kind = "location string, price int, ingest_seq int"
    W.commit_version(spark.createDataFrame([("a", 1, 0)], kind), path)
    commit, raced = W.commit_version, []

    def slow(df, table_dir, batch_id=None, base=None):
        if not raced:  # another writer commits between the read and the commit
            raced.append(1)
            commit(spark.createDataFrame([("a", 1, 0), ("b", 2, 0)], kind), table_dir)
        return commit(df, table_dir, batch_id, base)

    monkeypatch.setattr(W, "commit_version", slow)
    assert W.upsert_table(spark.createDataFrame([("a", 9, 1)], kind), path, id_col=None, batch_id=5)
    assert sorted(map(tuple, W.read_version(spark, path).collect())) == [("a", 9, 1), ("b", 2, 0)]
    assert not W.upsert_table(spark.createDataFrame([("a", 0, 2)], kind), path, id_col=None, batch_id=5)


def test_sheets_equal_a_recomputation_after_every_batch(spark, tmp_path, monkeypatch):
    L = silver_listings(spark, SF_SMALL).filter("id % 5 < 2")
    schema = T.StructType([*L.schema.fields, T.StructField("ingest_seq", T.IntegerType())])
    table = B.BucketTable(str(tmp_path / "t"), schema, "id", "ingest_seq", buckets=4)
    sheets = str(tmp_path / "s")
    moved = L.filter("id % 3 = 0").withColumns({"n_beds": F.col("n_beds") + 2, "area": F.lit("ASIA"), "price": F.lit(None).cast("int")})
    batches = [(L.filter("id % 2 = 0"), 1), (moved, 3), (L, 2), (L.limit(0), 9), (moved.withColumn("price", F.lit(700)), 4)]

    def check():
        got = sorted(map(str, SS.read_sheets(spark, sheets).collect()))
        now = D.sheets_of_states(D.sheet_states(B.read_buckets(spark, table), AVAILABLE_DAYS))
        assert got == sorted(map(str, now.collect())) and got

    for i, (batch, seq) in enumerate(batches):
        batch = batch.withColumn("ingest_seq", F.lit(seq))
        if i in (1, 2):  # the job dies once before and once after the difference is written
            name = ("sheet_states", "apply_pending")[i - 1]
            with monkeypatch.context() as m, pytest.raises(RuntimeError):
                m.setattr(SS, name, lambda *a, **k: (_ for _ in ()).throw(RuntimeError()))
                SS.fold_batch(batch, i, table, sheets, AVAILABLE_DAYS)
        SS.fold_batch(batch, i, table, sheets, AVAILABLE_DAYS)
        check()
        SS.fold_batch(batch, i, table, sheets, AVAILABLE_DAYS)
        check()


def test_quarantine_keeps_both_outcomes_over_a_replay(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i in range(3):
        spark.createDataFrame([(i, "x", 1), (i, None, 2)], ROW).coalesce(1).write.mode("append").parquet(src)
    mark = lambda df: df.withColumn("_reject_reason", F.when(F.col("v").isNull(), "no v"))
    for _ in range(2):
        S.stream_quarantine(spark, src, out, ROW, mark, checkpoint=str(tmp_path / f"ck{_}"), max_files_per_trigger=1)
        assert sorted(map(tuple, S.read_clean(spark, out).collect())) == [(i, "x", 1) for i in range(3)]
        assert [r._reject_reason for r in S.read_rejects(spark, out).collect()] == ["no v"] * 3


def test_level_cross_join(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, None), (2, "a", None)], "x int, y string, z int")
    got = sorted(map(tuple, flt.level_cross_join(df, ["x", "y", "z"]).collect()), key=str)
    assert got == sorted([(x, y, None) for x in (1, 2) for y in ("a", None)], key=str)
    assert flt.level_cross_join(df.limit(0), ["x", "y"]).count() == 0
    with pytest.raises(ValueError):
        flt.level_cross_join(df, ["x", "y"], most=3)


def test_a_large_batch_is_dealt_over_tasks_by_its_rows(spark, monkeypatch):
    monkeypatch.setattr(B, "TASK_ROWS", 100, raising=False)
    rows = spark.range(0, 2000, 1, 2).select((F.col("id") % 2).alias("key"), F.col("id").alias("seq"))
    dealt = B._dealt(rows)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 2000 and max(sizes) <= 200
    few = spark.range(0, 100, 1, 2)
    assert B._dealt(few) is few
