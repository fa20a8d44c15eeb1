"""Toxicity: features, held-out accuracy, misspellings, odd inputs."""

import numpy as np
import pytest

from rentlens.llm import toxicity as X
from rentlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_features_are_ngrams_within_words():
    buf = X.clean_bytes("Stupid a bc über 12345678")
    n = buf.count(b" ") - 1
    assert n == 5
    seen = sum(np.bincount(w, minlength=n) for w, _ in X.features(buf))
    assert seen.tolist() == X._feature_counts(buf).tolist()
    alone = [sorted(np.concatenate([f for _, f in X.features(X.clean_bytes(w))]).tolist()) for w in ("stupid", "a", "über")]
    pairs = [(w, f) for ws, fs in X.features(buf) for w, f in zip(ws, fs)]
    for i, want in zip((0, 1, 3), alone):
        assert sorted(f for w, f in pairs if w == i) == want


def test_long_texts_in_parts_score_as_whole(monkeypatch):
    w = np.random.default_rng(0).normal(size=1 << X.BUCKET_BITS).astype(np.float32)
    buf = X.clean_bytes("some words and others " * 300)
    whole = X.word_scores(buf, w)
    monkeypatch.setattr(X, "PIECE", 64)
    assert np.allclose(X.word_scores(buf, w), whole) and len(whole) == 1200
    assert X.window_starts(0).tolist() == [] and X.window_starts(1).tolist() == [0]
    for n in range(1, 30):
        assert {i for s in X.window_starts(n) for i in range(s, min(n, s + X.WINDOW))} == set(range(n))


def test_misspellings_share_ngrams(prose):
    bad = ["blasted", "dreadful", "rotten"]
    rng = prose.rng
    clean = [prose(60) for _ in range(150)]
    toxic = []
    for _ in range(80):
        w = prose(60).split()
        for _ in range(3):
            w.insert(rng.randrange(60), rng.choice(bad))
        toxic.append(" ".join(w))
    weights, bias = X.train(clean + toxic, [0] * 150 + [1] * 80, pool=[prose(60) for _ in range(40)], share=0.3)
    word = lambda w: X.word_scores(X.clean_bytes(w), weights)[0]
    assert min(map(word, ("blasteed", "dreadfull", "rottten"))) > max(map(word, ("w17", "qqzzxx", "the")))
    score = lambda t: X.window_means(X.word_scores(X.clean_bytes(t), weights)).max() + bias
    assert np.mean([score(prose(60)) < 0 for _ in range(50)]) > 0.9
    assert score(prose(30) + " Rotten dreadful") > 0


def test_held_out_rows_of_the_query(spark):
    rows = {r.doc_id: r for r in QUERIES["op7_toxicity"](spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    held = [(rows[r.doc_id], r.toxic) for r in labels if rows[r.doc_id].held_out]
    assert len(held) > 50 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())
    # A few dozen toxic texts to learn from, in four languages.
    assert np.mean([r.predicted == t for r, t in held]) > 0.9
    assert np.mean([r.score for r, t in held if t]) > np.mean([r.score for r, t in held if not t]) + 0.3


@pytest.mark.parametrize("texts,toxic,want", [([], [], 0.0), (["a", "b"], [0, 0], 0.0), (["a"], [1], 1.0)])
def test_without_both_kinds_the_score_is_the_share(spark, texts, toxic, want):
    docs = spark.createDataFrame([(1, None, "s"), (1, "", "s"), (None, "some text", "s"), (1, None, "s")],
                                 "doc_id long, text string, _text string")
    out = X.score_documents(docs, X.train(texts, toxic), ["doc_id"]).collect()
    assert len(out) == 4 and all(abs(r.score - want) < 1e-5 for r in out)
    empty = docs.limit(0)
    labels = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int")
    assert X.training_rows(empty, labels)["texts"] == []
    assert X.score_documents(empty, X.train([], []), ["doc_id"]).count() == 0


@pytest.mark.parametrize("long_kind", [0, 1])
def test_a_kind_of_long_texts_only_is_learned_from(spark, prose, long_kind):
    def text(kind, n):
        w = prose(n).split()
        if kind:
            for i in range(0, n, 12):
                w[i] = prose.rng.choice(["blasted", "dreadful", "rotten"])
        return " ".join(w)

    words = lambda kind: 4000 if kind == long_kind else 60
    rows = [(i, text(i % 2, words(i % 2)), i % 2) for i in range(160)]
    assert all((len(t) > X.POOL_CHARS) == (k == long_kind) for _, t, k in rows)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, k) for i, _, k in rows], "doc_id long, toxic int")
    sample = X.training_rows(docs, labels)
    assert set(sample["toxic"]) == {0, 1} and len(sample["pool"]) == sample["toxic"].count(0)
    known = {w for _, t, _ in rows for w in t.split()}
    assert all(len(t) <= X.MAX_CHARS + X.PASSAGE and set(t.split()) <= known for t in sample["texts"])
    assert all((s < 1) == (k == long_kind) for s, k in zip(sample["seen"], sample["toxic"]))
    model = X.train(**sample)
    score = lambda t: X.window_means(X.word_scores(X.clean_bytes(t), model[0])).max() + model[1]
    assert np.mean([(score(t) > 0) == k for _, t, k in rows]) > 0.9


def test_sample_is_refilled_when_labelled_ids_have_no_text(spark):
    labels = spark.range(0, 40_000).selectExpr("id AS doc_id", "CAST(id % 2 AS int) AS toxic")
    docs = spark.range(0, 40_000, 97).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    want = {f"text {r.doc_id}" for r in docs.filter(X.id_crc("doc_id") % 4 != 2).collect()}
    assert set(X.training_rows(docs, labels)["texts"]) == want


def test_one_kind_missing_gives_the_share_of_the_labels():
    for texts, toxic in ((["bad words"], [1]), (["fine words"], [0]), (["bad", "..."], [1, 0]), ([], [])):
        weights, bias = X.train(texts, toxic, share=0.12)
        assert not weights.any() and abs(1 / (1 + np.exp(-bias)) - 0.12) < 1e-9


def plain_features(text):
    """Buckets of each word's n-grams and of the word itself, in loops over Python integers."""
    words = "".join(c.lower() if "A" <= c <= "Z" else c if ord(c) > 127 or c.isalnum() else " " for c in text or "").split()
    out = []
    for word in words:
        raw = word.encode()
        found = []
        for n in X.NGRAMS:
            edged = b" " + raw + b" "
            for i in range(len(edged) - n + 1):
                h = 0
                for c in edged[i:i + n]:
                    h = (h * 0x9E3779B1 + c) % 2**32
                g = (h ^ n) * 0x85EBCA6B % 2**32
                found.append(((g ^ (g >> 15)) * 0x9E3779B1 % 2**32) >> (32 - X.BUCKET_BITS))
        whole = sum((c + 1) * pow(X._P, j, 2**64) for j, c in enumerate(raw)) * int(X._MIX) % 2**64
        out.append([*found, whole >> (64 - X.BUCKET_BITS)])
    return out


def plain_score(text, weights, bias):
    means = [sum(weights[f] for f in fs) / len(fs) for fs in plain_features(text)]
    windows = [means[i:i + X.WINDOW] for i in range(max(1, len(means) - X.WINDOW + 1))]
    z = (max(sum(w) / len(w) for w in windows) if means else 0.0) + bias
    return 1 / (1 + np.exp(-z))


def test_scores_equal_a_plain_scorer(spark):
    weights = np.random.default_rng(3).normal(size=1 << X.BUCKET_BITS).astype(np.float32)
    texts = [None, "", " .,! ", "a", "One", "one Two, three--four 5x", "Größe über alles ÄÖ", "日本語 テキスト", "x" * 300, "the the the"]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(20).collect()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.score for r in X.score_documents(docs, (weights, -0.4), ["doc_id"]).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert abs(got[i] - plain_score(t, weights.tolist(), -0.4)) < 1e-6, t


def test_a_training_step_goes_down_the_loss():
    """One step of embeddings, softmax and bias against central differences of a plainly written loss."""
    texts, y, weight = ["you rotten egg", "a fine day out here", "rotten", "fine"], [1, 0, 1, 0], [0.3, 0.1, 0.2, 0.4]
    feats = [plain_features(t) for t in texts]
    used = sorted({f for fs in feats for w in fs for f in w})
    rng = np.random.default_rng(5)
    emb = np.zeros((1 << X.BUCKET_BITS, X.DIM), np.float32)
    emb[used] = rng.normal(0, 0.5, (len(used), X.DIM))
    soft, bias = rng.normal(0, 0.5, (X.DIM, 2)).astype(np.float32), np.array([0.1, -0.7], np.float32)
    sharp = min(X.SHARPEST, X.SHARPEN)

    def z(fs, e, s, b):
        words = [sum(e[f] for f in w) / len(w) for w in fs]
        spans = [words[i:i + X.WINDOW] for i in range(max(1, len(words) - X.WINDOW + 1))]
        return [float((sum(w) / len(w)) @ (s[:, 1] - s[:, 0]) + b[1] - b[0]) for w in spans]

    start = [emb[used].astype(float), soft.astype(float), bias.astype(float)]
    at = {f: i for i, f in enumerate(used)}
    index = [[[at[f] for f in w] for w in fs] for fs in feats]
    shares = []
    for fs in index:
        e = np.exp(sharp * np.array(z(fs, *start)))
        shares.append(e / e.sum())

    def loss(params):
        return sum(wt * sh * (np.log1p(np.exp(v)) - label * v)
                   for fs, label, wt, share in zip(index, y, weight, shares) for sh, v in zip(share, z(fs, *params)))

    params = (emb.copy(), soft.copy(), bias.copy())
    X._fit(params, [np.zeros_like(p) for p in params], texts, np.array(y, float), np.array(weight), range(1, 2), 10)
    after = [params[0][used], params[1], params[2]]
    for k, rate in enumerate(X.RATES):
        grad = np.zeros_like(start[k])
        for i in np.ndindex(grad.shape):
            up, down = ([p.copy() for p in start] for _ in range(2))
            up[k][i] += 1e-5
            down[k][i] -= 1e-5
            grad[i] = (loss(up) - loss(down)) / 2e-5
        assert np.allclose((start[k] - after[k]) / rate, grad / np.linalg.norm(grad), atol=2e-3)
    untouched = np.delete(params[0], used, axis=0)
    assert not untouched.any()
