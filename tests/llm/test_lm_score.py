"""LM scoring against plain sums over all segmentations."""

import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from rentlens.llm import lm_score as L
from rentlens.llm.subword_lattice import Lattice, read_pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [None, "", "the cat THE", "größe été x", "the the of\tthe\nend", "zq" * 200, "the 日本 \x00", "of course", "unseen wordzz",
         "Of the cat " * 40]


def segmentations(text, pieces):
    """Sum and expected piece counts over all ways to cut ``text``."""
    if not text:
        return 1.0, Counter()
    total, counts = 0.0, Counter()
    for n in range(1, len(text) + 1):
        p = pieces.get(text[:n])
        if p:
            rest, c = segmentations(text[n:], pieces)
            total += p * rest
            counts[text[:n]] += p * rest
            for k, v in c.items():
                counts[k] += p * v
    return total, counts


def test_marginals_and_expected_counts_sum_all_segmentations():
    pieces = {b" ": .1, b" a": .1, b"a": .1, b"b": .2, b"ab": .05, b" ab": .05, b"bab": .1, b"aba": .1, b"\xc3": .1, b"\xa9": .1}
    lat = Lattice(pieces)
    words = [b"a", b"ab", b"abab", b"bababa", b"\xc3\xa9a", b"ab", b"aabbaabb"]
    want = [segmentations(b" " + w, pieces) for w in words]
    assert np.allclose(lat.log_marginals(words), [math.log(p) for p, _ in want])
    got = lat.expected_counts(words)
    for i, s in enumerate(lat.pieces):
        assert got[i] == pytest.approx(sum(c[s] / p for p, c in want))
    long = [w * 40 for w in (b"ab", b"bab")]
    assert np.allclose([lat._scalar(w)[0][-1] for w in words], lat.log_marginals(words))
    assert np.isfinite(lat.log_marginals(long)).all() and np.isfinite(lat.expected_counts(long)).all()
    assert lat.expected_counts(long).sum() > 0 and len(lat.log_marginals([])) == 0


def test_long_pieces_count():
    """Words whose pieces have up to 25 bytes, against a sum over all segmentations."""
    pieces = read_pieces(PATH)
    words = [w.encode() for w in ("университет", "становништво", "административный", "население", "использовать",
                                  "responsibility", "characteristics", "administration", "representations", "==========", "日本語")]

    def whole(text):
        total = [1.0] + [0.0] * len(text)
        for end in range(1, len(text) + 1):
            total[end] = sum(total[at] * pieces.get(text[at:end], 0.0) for at in range(end))
        return math.log(total[-1])

    assert max(map(len, pieces)) > 20
    assert np.allclose(Lattice(pieces).log_marginals(words), [whole(b" " + w) for w in words], rtol=0, atol=1e-9)


def test_vocabulary_reads_every_byte():
    pieces = read_pieces(PATH)
    assert all(bytes([b]) in pieces for b in range(256)) and sum(pieces.values()) == pytest.approx(1)
    assert pieces[b" the"] > pieces[b" then"]


def tokens(t):
    import re
    low = (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), ""]


@pytest.mark.parametrize("hot", [150_000, 0])
def test_scores(spark, hot):
    rows = [(i, t) for i, t in enumerate(TEXTS * 3)] + [(None, "the null"), (3, "größe été x")]
    held = {d: zlib.crc32(str(d).encode() if d is not None else b"") % 7 == 2 for d, _ in rows}
    assert any(held.values())
    c = Counter(w for d, t in rows if not held[d] for w in tokens(t))
    n, v, n1 = c.total(), len(c), sum(k == 1 for k in c.values())
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, word string").repartition(3)
    out = L.score_texts(df, PATH, hot_words=hot).collect()
    assert len(out) == len(rows)
    # The plain model: piece counts over the distinct training words, once.
    prior = read_pieces(PATH)
    start = Lattice(prior)
    p = start.expected_counts([w.encode() for w in c if w]) + L.PRIOR_WEIGHT * np.array([prior[s] for s in start.pieces])
    lat = Lattice(dict(zip(start.pieces, p / p.sum())))
    novel = max(n1, 1) / (n + 1)

    def q(w):
        sub = novel * math.exp(lat.log_marginals([w.encode()])[0]) if w else 0.0
        return math.log10((1 - novel) * c[w] / n + sub) if sub or c[w] else -math.inf

    want = []
    for d, t in rows:
        w = tokens(t)
        base = sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)
        want.append((str(d), held[d], len(w), sum(c[x] > 0 for x in w), n, round(base, 6)))
    got = [(str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out]
    assert sorted(got) == sorted(want)
    short = {i for i, t in enumerate(TEXTS * 3) if t is None or len(t) < 200}
    for r in out:
        if r.doc_id in short:
            t = (TEXTS * 3)[r.doc_id]
            assert r.score == pytest.approx(sum(q(x) for x in tokens(t)), rel=1e-9)
        assert r.score < 0 and math.isfinite(r.score)


def test_no_training_rows_and_empty(spark):
    df = spark.createDataFrame([(i, "a b") for i in range(40) if zlib.crc32(str(i).encode()) % 7 == 2], "doc_id long, text string")
    out = L.score_texts(df, PATH).collect()
    assert out and all(r.held_out and r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in out)
    assert L.score_texts(df.limit(0), PATH).count() == 0
