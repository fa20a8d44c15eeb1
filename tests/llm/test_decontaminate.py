"""Benchmark windows against brute force."""

import hashlib
import re

import pytest

from rentlens.llm import decontaminate as D
from rentlens.llm.queries import QUERIES
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return WORD.findall((t or "").translate(LOWER))


def plain(text, items, window=13):
    w, hit, met = words(text), set(), set()
    for item, t in items:
        iw = words(t)
        n = min(window, len(iw))
        wins = {tuple(iw[i:i + n]) for i in range(len(iw) - n + 1)} if n else set()
        for i in range(len(w) - n + 1) if n else ():
            if tuple(w[i:i + n]) in wins:
                hit.update(range(i, i + n))
                met.add("" if item is None else str(item))
    return len(w), len(hit), sorted(met)


def corpus(prose):
    items = [(1, prose(40)), (2, prose(13)), (3, "Ünique ONE"), (4, "the"), (5, ""), (6, None), (None, prose(20)), (10, prose(14))]
    items += [(7, items[0][1]), (8, "the of " * 10)]
    a, b = items[0][1].split(), items[7][1].split()
    docs = [(1, prose(30) + " " + " ".join(a[5:30]).upper() + ", " + prose(200)), (2, " ".join(a[3:15])), (3, None), (4, ""),
            (5, "ünique-one"), (6, "the of " * 40), (7, prose(50)), (8, items[6][1] + " " + items[1][1]), (1, " ".join(a)),
            (9, " ".join(b[:13]) + " x " + " ".join(b[1:])), (None, items[1][1]), (12, "x " * 3000 + items[1][1])]
    return items, docs


@pytest.mark.parametrize("block_bytes", [D.BLOCK_BYTES, 400])
def test_hits_equal_brute_force(spark, prose, block_bytes):
    items, docs = corpus(prose)
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, n int")
    df = spark.createDataFrame([(i, t, "x", k) for k, (i, t) in enumerate(docs)], "doc_id long, text string, _items string, _k int")
    got = D.decontaminate(df, bench, ["doc_id", "_k"], block_bytes=block_bytes).collect()
    assert len(got) == len(docs)
    for r in got:
        n, hit, met = plain(docs[r._k][1], items)
        assert r.doc_id == docs[r._k][0]
        assert (r._n_words, sum(s.end - s.start for s in r._spans), list(r._items)) == (n, hit, met), docs[r._k]


def test_query(spark):
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = QUERIES["op6_decontaminate"](spark, SF_SMALL).collect()
    assert len(rows) == len(texts) and any(r.contaminated for r in rows)
    for r in rows:
        n, hit, met = plain(texts[r.doc_id], items)
        sha = hashlib.sha256(",".join(met).encode()).hexdigest()
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == (n, hit, len(met), sha)
        assert r.contaminated == (hit > 0 and 20 * hit >= n)


def scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation")


def test_a_large_benchmark_reads_the_documents_no_more_often(spark, prose, tmp_path):
    """The join road's plan does not grow with the benchmark, and it collects no windows."""
    docs = spark.createDataFrame([(i, prose(60)) for i in range(20)], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    seen = []
    for n in (5, 200):
        bench = spark.createDataFrame([(i, prose(40)) for i in range(n)], "item_id long, text string")
        seen.append(scans(D.decontaminate(docs, bench, ["doc_id"], block_bytes=0)))
    assert seen[0] == seen[1]


def test_bit_map_holds_every_shingle(spark, prose, monkeypatch):
    monkeypatch.setattr(D, "BITS", 1 << 10)
    w = D.Words(prose(400))
    known = D.bit_map(spark.createDataFrame([(s.decode(),) for s in w.shingles(5)[::2]], "s string"))
    assert len(known) == 128
    assert {s for s in w.shingles(5)[::2]} <= {s for _, s in D.met(w, 5, known)}


@pytest.mark.parametrize("block_bytes", [D.BLOCK_BYTES, 0])
def test_columns_of_any_name(spark, prose, block_bytes):
    text = prose(30)
    docs = spark.createDataFrame([(1, text, 5, "s", "i", "k", 0, "c")],
                                 "doc_id long, text string, _n_words int, _spans string, _items string, key string, n int, c0 string")
    bench = spark.createDataFrame([(1, text, 9)], "item_id long, text string, w int")
    r = D.decontaminate(docs, bench, docs.columns, block_bytes=block_bytes)
    assert r.columns == [*docs.columns, "__n_words", "__spans", "__items"] == [*docs.columns, *D.result_names(docs.columns)]
    got = r.first()
    assert (got["_n_words"], got["_spans"], got["key"], got["c0"]) == (5, "s", "k", "c")
    assert (got["__n_words"], [tuple(x) for x in got["__spans"]], got["__items"]) == (30, [(0, 30)], ["1"])


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert [(r._n_words, list(r._spans), r._items) for r in D.decontaminate(docs, bench, ["doc_id"], block_bytes=-1).collect()] == [
        (2, [], [])]
    assert [(r._n_words, list(r._spans)) for r in D.decontaminate(docs, bench, ["doc_id"]).collect()] == [(2, [])]
    one = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert D.decontaminate(docs.limit(0), one, ["doc_id"]).count() == 0
