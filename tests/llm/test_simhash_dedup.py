"""SimHash fingerprints and components against brute force."""

import random

import pytest
import xxhash

from rentlens.llm import simhash_dedup as S
from rentlens.llm.components import connected_components

DOC = "doc_id long, text string, fp string, root int"


def plain_fp(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    sh = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def roots(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    nodes = sorted(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {n: find(n) for n in nodes}


def test_fingerprint(prose):
    texts = [None, "", " \t", "one", "Two WORDS", "a b c", prose(500), "x " * 5000, "É é ß"]
    assert [S.fingerprint(t) for t in texts] == [plain_fp(t) for t in texts]


def test_every_pair_within_the_radius_meets_in_a_table():
    for radius in (1, 2):
        masks = S.covering_masks(radius)
        for a in range(64):
            for b in range(a, 64) if radius == 2 else [a]:
                diff = (1 << a) | (1 << b)
                assert any((m & ((1 << 64) - 1)) & diff == 0 for m in masks)


@pytest.mark.parametrize("pairwise", [64, 1])
@pytest.mark.parametrize("radius", [1, 2])
def test_links_connect_what_brute_force_connects(spark, pairwise, radius):
    rng = random.Random(3)
    fps = {rng.getrandbits(64) for _ in range(40)}
    for base in list(fps)[:12]:
        for _ in range(14):
            x = base
            for _ in range(rng.randint(1, 4)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    fps |= {0, 1, 3, 1 << 63}
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    links = S.near_links(df, radius, pairwise)
    for r in links.collect():
        assert ((r.a ^ r.b) & ((1 << 64) - 1)).bit_count() <= radius
    got = {r.node: r.root for r in connected_components(links).collect()}
    want = roots(signed, lambda a, b: ((a ^ b) & ((1 << 64) - 1)).bit_count() <= radius)
    assert {n: got.get(n, n) for n in signed} == want


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 200)] + [(5, 5), (400, 399), (399, 400)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[100 + i] == 100 for i in range(200)) and got[400] == 399
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_documents(spark, prose):
    one = prose(400)
    rows = [(5, one), (3, one), (9, one + " tail"), (7, prose(300)), (8, None), (2, ""), (None, " "), (3, one), (None, prose(50))]
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], DOC)
    fps = {t: plain_fp(t) for _, t in rows}
    group = roots(set(fps.values()), lambda a, b: (a ^ b).bit_count() <= 2)
    ids = {}
    for d, t in rows:
        if d is not None:
            ids[group[fps[t]]] = min(d, ids.get(group[fps[t]], d))
    out = S.simhash_components(df, ["doc_id"]).collect()
    got = [(r.doc_id, r.fp & ((1 << 64) - 1), r.component_id) for r in out]
    assert sorted(got, key=str) == sorted([(d, fps[t], ids.get(group[fps[t]])) for d, t in rows], key=str)
    kept = S.keep_one_per_component(df).collect()
    assert len(kept) == len({group[f] for f in fps.values()})
    assert {r.doc_id for r in kept if r.doc_id is not None} == set(ids.values())
    assert S.keep_one_per_component(df.limit(0)).columns == df.columns
