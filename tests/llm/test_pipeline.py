"""Each pipeline stage against a plain version of it on the stage's own input."""

import numpy as np
import public_tokenizers
import pytest

import __spark_entry__
import corpus_pipeline as P
from rentlens.llm import toxicity as X
from rentlens.llm.suffix_dedup import without_words
from tests.conftest import SF_SMALL
from tests.llm.test_decontaminate import plain as plain_hits
from tests.llm.test_packing import check, ids_of
from tests.llm.test_simhash_dedup import plain_fp, roots
from tests.llm.test_suffix_dedup import brute as brute_spans

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output of every stage."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = {}
    for name, stage in P.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, SF_SMALL).write.parquet(path)
        after = spark.read.parquet(path)
        out[name] = (docs, after)
        docs = after
    return out


def test_order_and_columns(stages):
    assert [n for n, _ in P.STAGES] == ["toxicity", "simhash", "suffix", "decontamination", "packing"]
    for name, (before, after) in stages.items():
        if name != "packing":
            assert after.columns == before.columns and after.count() > 0


def test_toxicity_keeps_rows_below_the_limit(spark, stages):
    before, after = map(rows_of, stages["toxicity"])
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    sample = X.training_rows(stages["toxicity"][0], labels)
    weights, bias = X.train(**sample)
    keep = set()
    for d, r in before.items():
        m = X.window_means(X.word_scores(X.clean_bytes(r.text), weights))
        if 1 / (1 + np.exp(-((m.max() if len(m) else 0) + bias))) < P.TOXIC_FROM:
            keep.add(d)
    assert set(after) == keep and all(after[d] == before[d] for d in keep)


def test_simhash_keeps_the_first_of_each_component(stages):
    before, after = map(rows_of, stages["simhash"])
    fp = {d: plain_fp(r.text) for d, r in before.items()}
    root = roots(set(fp.values()), lambda a, b: (a ^ b).bit_count() <= 2)
    first = {}
    for d in sorted(before):
        first.setdefault(root[fp[d]], d)
    assert set(after) == set(first.values()) and all(after[d] == before[d] for d in after)
    assert len(after) < len(before)


def test_suffix_cuts_what_an_earlier_document_holds(stages):
    before, after = map(rows_of, stages["suffix"])
    cuts = {}
    for d, s, e, _, dup in brute_spans([(d, r.text) for d, r in before.items()]):
        if dup:
            cuts.setdefault(d, []).append((s, e))
    want = {d: without_words(r.text, cuts[d]) if d in cuts else r.text for d, r in before.items()}
    assert {d: r.text for d, r in after.items()} == {d: t for d, t in want.items() if d not in cuts or t}
    assert cuts and all(r.n_chars == len(r.text) for r in after.values())


def test_decontamination_drops_contaminated_documents(spark, stages):
    before, after = map(rows_of, stages["decontamination"])
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    keep = set()
    for d, r in before.items():
        n, hit, _ = plain_hits(r.text, items)
        if not (hit and 20 * hit >= n):
            keep.add(d)
    assert set(after) == keep and len(after) < len(before) and all(after[d] == before[d] for d in after)


def test_packing_and_run_agree(spark, stages):
    before, after = stages["packing"]
    docs = {d: ids_of(r.text) for d, r in rows_of(before).items()}
    check(after.collect(), docs, 2048)
    whole = __spark_entry__.queries()["pipeline"](spark, SF_SMALL)
    assert whole.columns == after.columns
    check(whole.collect(), docs, 2048)
    assert public_tokenizers.path("word_bpe_49k.json")


def test_stages_take_odd_rows(spark):
    text = "some plain words here " * 30
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, text, None, "s", 5), (3, text, "en", "s", 5),
            (3, text, "en", "s", 5), (4, "other words", "en", None, None)]
    for rows in (rows, []):
        docs = spark.createDataFrame(rows, DOC)
        for name, stage in P.STAGES:
            out = stage(spark, docs, SF_SMALL).cache()
            if rows:
                assert out.count() > 0
            if name != "packing":
                assert out.columns == docs.columns
                docs = out
    extra = spark.createDataFrame([(5, "x y z", 1, "k", "t", 2, 3)],
                                  "doc_id long, text string, score int, fp string, _text string, key int, root long")
    clashing = spark.createDataFrame([(5, "x y z", 1, "a", "b", 2.0, "c", "d", 3)],
                                     "doc_id long, text string, _n_words int, _spans string, _items string, __score double, "
                                     "__whole_text string, `a.b` string, t int")
    for docs in (extra, clashing):
        for _, stage in P.STAGES[:4]:
            assert stage(spark, docs, SF_SMALL).collect() == docs.collect()


def test_stages_take_in_few_bytes_at_once(spark, monkeypatch):
    import pyarrow as pa

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.nbytes]}, schema=pa.schema([("n", pa.int64())]))

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    own = spark.conf.get(name)
    spark.conf.set(name, "64m")
    docs = spark.range(0, 300, 1, 1).selectExpr("id AS doc_id", "repeat('x', 50000) AS text")
    P.STAGES[1][1](spark, docs, "")
    most = docs.select("text").mapInArrow(sizes, "n long").groupBy().max("n").first()[0]
    spark.conf.set(name, own)
    assert most < 5 << 20
