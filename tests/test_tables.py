"""Upsert, ordered ids, filters and reshape properties."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rentlens.functions.derive import price_bin
from rentlens.operators import filters as flt
from rentlens.operators import sheets as sh
from rentlens.operators import tables as W

SCHEMA = "location string, price int, ingest_seq int"


def _key(t):
    return tuple((x is not None, x if x is not None else 0) for x in t)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=_key)


def row_by_row_merge(target, source):
    """Reference semantics: MERGE applied one source row at a time, in order."""
    t = [list(r) for r in target]
    for loc, price, seq in sorted(source, key=lambda r: r[2]):
        hit = [r for r in t if loc is not None and r[0] == loc]
        if hit:
            for r in hit:
                r[1], r[2] = price, seq
        else:
            t.append([loc, price, seq])
    return sorted((tuple(r) for r in t), key=_key)


CASES = [
    ([("a", 1, 0), ("a", 2, 0), ("b", 3, 0), (None, 9, 0)],
     [("a", 10, 1), ("a", 11, 2), ("c", 5, 1), (None, 7, 1), (None, 8, 2), ("c", 6, 3)]),
    ([], [("x", 1, 1), ("x", 2, 2)]),
    ([("a", 1, 0)], []),
]


@pytest.mark.parametrize("target,source", CASES)
def test_upsert_matches_row_by_row(spark, target, source):
    t = spark.createDataFrame(target, SCHEMA)
    s = spark.createDataFrame(source, SCHEMA)
    got = rows(W.upsert_by_key(t, s, "location", "ingest_seq"), "location", "price", "ingest_seq")
    assert got == row_by_row_merge(target, source)


def test_upsert_idempotent(spark):
    t = spark.createDataFrame(CASES[0][0][:3], SCHEMA)
    s = spark.createDataFrame([r for r in CASES[0][1] if r[0] is not None], SCHEMA)
    once = W.upsert_by_key(t, s, "location", "ingest_seq")
    twice = W.upsert_by_key(once, s, "location", "ingest_seq")
    assert rows(once, "*") == rows(twice, "*")


def test_upsert_only_newer(spark):
    t = spark.createDataFrame([("a", 5, 9)], SCHEMA)
    s = spark.createDataFrame([("a", 1, 3), ("b", 2, 1)], SCHEMA)
    got = rows(W.upsert_by_key(t, s, "location", "ingest_seq", only_newer=True), "*")
    assert got == [("a", 5, 9), ("b", 2, 1)]


def test_assign_id_consecutive(spark):
    existing = spark.createDataFrame([(10,), (42,)], "id long")
    batch = spark.range(0, 5000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("src"))
    out = W.assign_id(batch, ["src", "k"], start_after=existing, num_partitions=5)
    got = [r.id for r in out.orderBy("src", "k").collect()]
    assert got == list(range(43, 43 + 5000))


def test_overwrite_refuses_own_input(spark, tmp_path):
    p = str(tmp_path / "t")
    spark.range(3).write.parquet(p)
    df = spark.read.parquet(p)
    with pytest.raises(ValueError):
        W.overwrite_table(df, p)


def test_align_and_union(spark):
    a = spark.createDataFrame([(1, "x")], "price int, location string")
    b = spark.createDataFrame([("y", 2.5)], "location string, n_beds double")
    u = W.union_sources(W.align_schema(a), W.align_schema(b))
    assert len(u.columns) == 14 and u.count() == 2
    _, cnt = W.accumulate_batches([a, a, a])
    assert cnt.first()["n_rows"] == 3


def test_unpivot_pivot_identity(spark):
    df = spark.createDataFrame([(1, 1.0, None, 10), (2, 2.5, 1.5, None)], "id int, a double, b double, c int")
    long = sh.unpivot_measures(df, ["id"], ["a", "b", "c"])
    assert long.count() == 6  # NULL values are kept
    back = long.groupBy("id").pivot("measure", ["a", "b", "c"]).agg(F.first("value"))
    assert rows(back, "id", "a", "b", "c") == [(1, 1.0, None, 10.0), (2, 2.5, 1.5, None)]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(-10**6, 10**6), min_size=1, max_size=30),
       st.integers(1, 10**5), st.integers(-1000, 1000))
def test_price_bin_edges(spark, prices, size, peg):
    df = spark.createDataFrame([(p,) for p in prices], "price long")
    for p, e in df.select("price", price_bin("price", size, peg).alias("e")).collect():
        assert e <= p < e + size and (e - peg) % size == 0


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50)), min_size=0, max_size=30),
       st.integers(-60, 60), st.integers(-60, 60))
def test_range_filter_subset(spark, vals, lo, hi):
    df = spark.createDataFrame([(v,) for v in vals], "price int")
    got = [r[0] for r in flt.range_filter(df, "price", lo, hi).collect()]
    assert sorted(got) == sorted(v for v in vals if v is not None and lo <= v <= hi)


def test_selection_and_exclusion_null_safe(spark):
    df = spark.createDataFrame([(1, None, 5), (2, 3, None), (3, None, None)], "id int, d int, m int")
    sel = spark.createDataFrame([(None, 5), (None, None)], "d int, m int")
    assert rows(flt.apply_selection(df, sel, ["d", "m"]), "id") == [(1,), (3,)]
    assert rows(flt.exclude_members(df, ["d", "m"], [(None, None)]), "id") == [(1,), (2,)]
    assert rows(flt.exclude_members(df, ["d", "m"], sel), "id") == [(2,)]
    assert flt.apply_selection(df, None, ["d"]).count() == 3


def test_manual_sort_and_preview(spark):
    df = spark.createDataFrame([(m,) for m in [7, None, 4, 12, 5]], "m int")
    assert [r.m for r in sh.manual_sort(df, "m", [None, 4, 5, 6, 7, 8]).collect()] == [None, 4, 5, 7, 12]
    assert [r.m for r in sh.preview(df, ["m"], 2).collect()] == [None, 4]


@pytest.mark.parametrize("n", [1, 7, 30, 500])
def test_preview_grouped_equals_preview(spark, n):
    data = [(i % 50 if i % 11 else None, i % 3, float(i)) for i in range(400)]
    df = spark.createDataFrame(data, "id int, g int, v double")

    def agg(r):
        return r.groupBy("id", "g").agg(F.sum("v").alias("s"))

    plain = [r.id for r in sh.preview(agg(df), ["id"], n).collect()]
    pushed = [r.id for r in sh.preview_grouped(df, agg, "id", n).collect()]
    assert sorted(plain, key=lambda x: (x is not None, x or 0)) == \
        sorted(pushed, key=lambda x: (x is not None, x or 0))


@pytest.mark.parametrize("n", [1, 5, 40, 199, 200, 1000])
def test_nth_smallest_key_exact(spark, n):
    import random

    rnd = random.Random(n)
    vals = [rnd.choice([rnd.randint(0, 10**6), 7, 7, 7, None]) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in vals], "k long")
    t, c = sh.nth_smallest_key(df, "k", n)
    distinct = sorted({v for v in vals if v is not None})
    if len(distinct) >= n:
        assert (t, c) == (distinct[n - 1], n)
    else:
        assert c == len(distinct)


def test_append_run_continues_ids(spark, tmp_path):
    path = str(tmp_path / "listings")
    js = spark.createDataFrame([(0, 1, 100), (0, 0, 200)], "payload_id long, pos int, price int")
    html = spark.createDataFrame([("s1", 2, 0, 7), ("s0", 1, 1, 9), ("s0", 1, 0, 8)],
                                 "source_id string, page_num int, pos int, price int")
    W.append_run(spark, path, json_rows=js, html_rows=html)
    W.append_run(spark, path, html_rows=html)
    got = sorted((r.id, r.price) for r in spark.read.parquet(path).collect())
    assert got == [(1, 200), (2, 100), (3, 8), (4, 9), (5, 7), (6, 8), (7, 9), (8, 7)]


def test_latest_per_key_with_null_orders_and_ties(spark):
    from rentlens.operators.windows import latest_per_key

    rows = [("a", None, 1), ("a", None, 1), ("b", 5, 2), ("b", None, 3), ("c", 7, 4), ("c", 7, 5)]
    df = spark.createDataFrame(rows, "k string, seq int, v int")
    got = {r.k: r.v for r in latest_per_key(df, "k", "seq").collect()}
    assert got["a"] == 1 and got["b"] == 2 and got["c"] in (4, 5)
    assert got == {r.k: r.v for r in latest_per_key(df.orderBy(df.v.desc()), "k", "seq").collect()}


def test_append_run_raises_when_the_table_cannot_be_read(spark, tmp_path):
    import pytest

    path = tmp_path / "t"
    html = spark.createDataFrame([("s1", 1, 0, 7)], "source_id string, page_num int, pos int, price int")
    W.append_run(spark, str(path), html_rows=html)
    (path / "part-bad.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        W.append_run(spark, str(path), html_rows=html)


def test_ids_plan_does_not_grow_with_partitions(spark):
    df = spark.range(1000).withColumnRenamed("id", "v")
    plans = [len(W.assign_id(df, ["v"], num_partitions=n)._jdf.queryExecution().analyzed().toString()) for n in (4, 64)]
    assert abs(plans[0] - plans[1]) < 200
    got = W.assign_id(df, ["v"], start_after=10, num_partitions=7).collect()
    assert all(r.id == r.v + 11 for r in got)


def test_overwrite_refuses_folders_it_reads(spark, tmp_path):
    import pytest

    path = str(tmp_path / "x")
    W.overwrite_table(spark.range(3), path)
    back = spark.read.parquet(path)
    with pytest.raises(ValueError):
        W.overwrite_table(back.filter("id > 1"), path)
    W.overwrite_table(back, str(tmp_path / "y"))
    assert spark.read.parquet(str(tmp_path / "y")).count() == 3


def rows_sorted(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)
