"""Periodic runs against a scan of all periods and places."""

import hashlib
import random
import time
import zlib

import numpy as np

from rentlens.llm import queries as Q
from rentlens.llm.periodic_runs import collapse, find_runs, frequent_segments, periodic_runs
from tests.conftest import SF_SMALL


def brute(words):
    out = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            s, e = i, j + q
            if j > i and e - s >= max(6, 4 * q) and not any(
                    all(words[k] == words[k + p] for k in range(s, e - p)) for p in range(1, q)):
                out.append((s, e - s, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def random_words(rng, most):
    n, k = rng.randint(0, most), rng.randint(1, 4)
    words = [b"%d" % rng.randrange(k) for _ in range(n)]
    for _ in range(rng.randint(0, 3)):
        if n > 10:
            a, p = rng.randrange(n), rng.randint(1, 8)
            for i in range(a, min(n, a + rng.randint(1, 40))):
                words[i] = words[a + (i - a) % p]
    return words


def test_random_words():
    rng = random.Random(3)
    found = 0
    for _ in range(5000):
        words = random_words(rng, 60)
        got = find_runs(words)
        assert got == brute(words), words
        assert collapse(words, got) == [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in got)]
        found += len(got)
    assert found > 1000


def test_segments_are_stable():
    # b splits; in what is left of it x occurs three times only, and then y.
    words = [1, 2, 1, 2, 1, 2, 1, 0, 3, 1, 1, 1, 3, 1, 3, 1, 1]
    at, seg = frequent_segments(np.array(words) - 1)
    for s in set(seg.tolist()):
        inside = at[seg == s]
        assert (np.diff(inside) == 1).all() and len(inside) >= 6
        assert np.unique(np.array(words)[inside], return_counts=True)[1].min() >= 4


def test_long_texts_take_time_in_proportion():
    def seconds(n):
        began = time.process_time()
        assert find_runs([b"a"] * n + [b"b"] + [b"a", b"c"] * n) == [(0, n, 1), (n + 1, 2 * n, 2)]
        return time.process_time() - began

    seconds(2000)
    assert seconds(80_000) < 12 * max(seconds(20_000), 0.05)


def test_nulls_empty_repeats_and_clashing_names(spark):
    rows = [(1, None, 1, "x"), (2, "", 1, "x"), (3, "a b a b a b a b c", 2, "x"), (3, "a b a b a b a b c", 2, "x"),
            (None, "\t".join(["é"] * 9) + "\x85 é", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, __whole_text string")
    got = sorted(periodic_runs(docs, ("doc_id", "n_words", "__whole_text")).collect(), key=lambda r: str(r.doc_id))
    assert [(r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got] == [
        (0, [], ""), (0, [], ""), (9, [(0, 8, 2)], "a b c"), (9, [(0, 8, 2)], "a b c"), (10, [(0, 8, 1)], "é é\x85 é")]
    assert periodic_runs(docs.limit(0)).count() == 0


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = Q.QUERIES["op13_periodic_runs"](spark, SF_SMALL).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    planted = 0
    for r in got:
        words = docs[r.doc_id].encode().split()
        h, n = zlib.crc32(str(r.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g, own = h // 10, list(words)
            a, planted = g % n, planted + 1
            p = 1 + (n - a) // (3 + g % 8)
            for i in range(a, n):
                words[i] = own[a + (i - a) % p]
        runs = brute(words) if n < 1500 else find_runs(words)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        drop = {i for s, m, q in runs for i in range(s + q, s + m)}
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == sha("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode())
        assert r.collapsed_sha256 == sha(b" ".join(w for i, w in enumerate(words) if i not in drop))
    assert planted
