"""Prefix trie against plain Python and SQL."""

import hashlib
import random
import zlib

from pyspark.sql import functions as F

from rentlens.llm import prefix_trie as P
from rentlens.llm import queries as Q
from tests.conftest import SF_SMALL
from tests.oracle import compare, duck

TURN = "conv_id long, turn long, role string, text string, depth string, k1 string, block int"


def test_query_matches_its_sql(spark):
    r = compare(spark, "op12", Q.QUERIES["op12_prefix_trie"], Q.ORACLE["op12_prefix_trie"], SF_SMALL, duck(SF_SMALL))
    assert r["status"] == "match", r


def ordered(rows):
    """conv_id to turns, as the docstring orders them."""
    out = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            out.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(role, text) for *_, role, text in sorted(t)] for c, t in out.items()}


def forked(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def plain(convs):
    """conv_id, depth to the node's other values."""
    nodes = {}
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            nodes.setdefault(tuple(convs[c][:d]), []).append(c)
    out = {}
    for p, members in nodes.items():
        below = {x: m for x, m in nodes.items() if x[:len(p)] == p}
        childless = [x for x in below if not any(len(y) > len(x) and y[:len(x)] == x for y in below)]
        saved = sum((len(m) - 1) * len(x[-1][1].encode().split()) for x, m in below.items() if x)
        ends = ",".join(str(c) for c in members if len(convs[c]) == len(p))
        out[members[0], len(p)] = (nodes[p[:-1]][0] if p else None, len(members), sum(len(x) == len(p) + 1 for x in below),
                                   len(childless), saved, hashlib.sha256(ends.encode()).hexdigest())
    return out


def of_spark(nodes, ends):
    out = nodes.join(P.end_digests(ends), ["k1", "k2", "depth"], "left").collect()
    none = hashlib.sha256(b"").hexdigest()
    got = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_words, r.ends_sha256 or none)
           for r in out}
    assert len(got) == len(out)
    return got


def random_rows(rng, n):
    rows = []
    for c in rng.sample(range(200), n):
        for turn in range(rng.choice((1, 2, 3, 5, 9))):
            rows.append((c, rng.choice((turn, turn, turn, None, 7)), rng.choice(("u", "a", None)),
                         rng.choice(("x", "x y", "x\ty  z", "é\x85 b", None)), "d", "k", 1))
    return rows


def test_random_conversations_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(P, "BLOCK", 2)
    monkeypatch.setattr(P, "ID_BLOCK", 4)
    rng = random.Random(4)
    for n in (1, 40, 150):
        rows = random_rows(rng, n)
        df = spark.createDataFrame(rows, TURN).repartition(5)
        assert of_spark(*P.prefix_trie(*P.shared_heads(df))) == plain(forked(ordered(rows)))
        assert of_spark(*P.prefix_trie(*P.conversation_turns(df))) == plain(ordered(rows))


def test_identical_nested_and_turnless_conversations(spark):
    turns = [("u", "a b"), ("a", "c"), ("u", "d")]
    rows = [(c, i, *turns[i], "", "", 0) for c in range(100, 160) for i in range(c % 3 + 1)]
    rows += [(None, 0, "u", "nobody's", "", "", 0), (200, 0, "u", "a b", "", "", 0), (200, 0, "u", "a b", "", "", 0),
             (-20, 0, "u", "a b", "", "", 0)]
    df = spark.createDataFrame(rows, TURN)
    assert of_spark(*P.prefix_trie(*P.conversation_turns(df))) == plain(ordered(rows))
    # A conversation of which the fork leaves nothing.
    alone = next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 4 == 3)
    got = of_spark(*P.prefix_trie(*P.shared_heads(spark.createDataFrame([(alone, 0, "u", "a", "", "", 0)], TURN))))
    assert got == {(alone, 0): (None, 1, 0, 1, 0, hashlib.sha256(str(alone).encode()).hexdigest())}


def test_empty_table(spark):
    nodes, ends = P.prefix_trie(*P.shared_heads(spark.createDataFrame([], TURN)))
    assert nodes.count() == 0 and P.end_digests(ends).count() == 0


def test_long_conversation_is_spread_over_blocks(spark):
    df = spark.range(5000).select(F.lit(40).alias("conv_id"), F.col("id").alias("turn"), F.lit("u").alias("role"),
                                  F.lit("x").alias("text"))
    nodes, ends = P.prefix_trie(*P.conversation_turns(df))
    assert nodes.count() == 5001 and nodes.filter("n_leaves = 1 AND n_convs = 1").count() == 5001
    assert [r.depth for r in ends.collect()] == [5000]
