"""Conversation prefix trie by whole-sequence collapse.

Turns ``conv_id, depth, role, text`` (depth from 1, without gaps) make a trie:
a node for each distinct sequence of first turns, from the textless root down.

1. A turn's key is a 128-bit hash of its depth and the digest of its role and
   text; a prefix's key is the XOR of its turns' keys, a running aggregate.
2. Identical conversations collapse into one weighted sequence, named by its
   smallest conv_id; their ids stay in an end list of the sequence's key.
3. Sequences that are proper prefixes of others go by an anti-join; those left
   are the leaves.
4. Each sequence, once and with its weight, is taken apart into its prefixes,
   and the prefixes are aggregated into nodes.

A node belongs to the sequence with its smallest conv_id, so a sequence owns
its path from some depth on, and a sum over a node's subtree is a sum over the
sequences through it: of each, the path's rest by its weight, less once what it
owns of that. So no pairs of nodes and descendants are made.

Hot groups: identical conversations and common prefixes meet in partial
aggregates. Order inside a conversation is found in blocks of ``BLOCK`` turn
numbers (then depths), and only the blocks' totals meet by conversation, so a
conversation with a large share of all rows is spread out. Its blocks' totals
(rows / ``BLOCK`` where turn numbers are dense) meet in one task, as do rows
that repeat one turn number of one conversation. End lists are joined in
blocks of ids; the digest reads a node's blocks in a stream.

Defined cases: NULL role and text count as empty; a NULL turn sorts first; rows
that tie on turn are ordered by role, then text, and repeated rows are turns of
their own; rows with a NULL conv_id belong to no conversation; a conversation
without turns ends at the root; an empty table has no nodes, not even a root;
texts are read whole, as their digest and number of words. Only the four named
columns are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

BLOCK = 1024
ID_BLOCK = 4096
_WORD = "[^\\x20\\x09-\\x0D]+"



def numbered(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with their place inside their block, ``conv_id, block, place, role, text``, and blocks ``conv_id, block, n, before``.

    A row's place in its conversation is its place plus its block's ``before``.
    """
    r = rows.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    r = r.withColumn("block", F.floor(F.col("turn") / BLOCK))
    inside = Window.partitionBy("conv_id", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    placed = r.select("conv_id", "block", F.row_number().over(inside).cast("long").alias("place"), "role", "text")
    counts = r.groupBy("conv_id", "block").agg(F.count("*").alias("n"))
    earlier = (Window.partitionBy("conv_id").orderBy(F.col("block").asc_nulls_first())
               .rowsBetween(Window.unboundedPreceding, -1))
    blocks = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("long")))
    return placed, blocks


def conversation_turns(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv_id, depth, role, text`` of all turns, and ``conv_id`` of all conversations."""
    placed, blocks = numbered(rows)
    turns = placed.join(blocks.drop("n"), [placed.conv_id == blocks.conv_id, placed.block.eqNullSafe(blocks.block)]).select(
        placed.conv_id, (F.col("place") + F.col("before")).alias("depth"), "role", "text")
    return turns, blocks.select("conv_id").distinct()


def shared_heads(rows: DataFrame, group: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt as forks: ``(turns, conversations)`` as :func:`conversation_turns` gives them.

    With h = crc32(conv_id as text) % heads, conversation c is the first h
    turns of conversation ``c - c % group`` (all it has, if fewer), then its
    own turns behind its first h.
    """
    placed, blocks = numbered(rows)
    placed = placed.select("conv_id", "block", "place", F.struct("role", "text").alias("t"))
    lengths = blocks.groupBy("conv_id").agg(F.sum("n").alias("own"))
    info = lengths.select("conv_id", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).alias("h"),
                          (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
    bases = lengths.filter(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("base"), F.col("own").alias("base_n"))
    info = info.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0).cast("long"))))
    # What a row needs to know comes with its block, so no row is joined by conversation alone.
    known = blocks.join(info, "conv_id").select(
        F.col("conv_id").alias("c"), F.col("block").alias("b"), "before", "h", "taken")
    placed = placed.join(known, [F.col("conv_id") == F.col("c"), F.col("block").eqNullSafe(F.col("b"))]).withColumn(
        "pos", F.col("place") + F.col("before"))
    own = placed.filter("pos > h").select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("depth"), "t.role", "t.text")
    first = placed.filter((F.col("conv_id") % group == 0) & (F.col("pos") < heads)).select(
        F.col("conv_id").alias("base"), F.col("pos").alias("depth"), "t")
    head = info.filter("taken > 0").join(first, "base").filter(F.col("depth") <= F.col("taken"))
    return own.unionByName(head.select("conv_id", "depth", "t.role", "t.text")), info.select("conv_id")


def _keyed(turns: DataFrame) -> DataFrame:
    """``conv_id, depth, block, words, k1, k2``: each turn's words and 128-bit key."""
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256)
    t = turns.select("conv_id", "depth", F.floor(F.col("depth") / BLOCK).alias("block"), digest.alias("digest"),
                     F.regexp_count("text", F.lit(_WORD)).cast("long").alias("words"))
    return t.select("conv_id", "depth", "block", "words", *[F.xxhash64(F.lit(i), "depth", "digest").alias(f"k{i}") for i in (1, 2)])


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes of the trie, and the conversations' ends.

    Nodes: ``k1, k2, depth`` (the node's key), ``conv_id`` (smallest member),
    ``parent_conv_id, n_convs, n_children, n_leaves, saved_words`` (over the
    node's subtree, the words of a node's last text times its members but one).
    Ends: ``k1, k2, depth, conv_id`` of every conversation's last node.
    """
    keyed = staged(_keyed(turns), "trie-turns")
    total = keyed.groupBy("conv_id", "block").agg(
        F.bit_xor("k1").alias("b1"), F.bit_xor("k2").alias("b2"), F.sum("words").alias("words"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    blocks = staged(total.select(
        "conv_id", "block", "b1", "b2", "n", F.col("words").alias("block_words"),
        *[F.coalesce(F.bit_xor(f"b{i}").over(earlier), zero).alias(f"before{i}") for i in (1, 2)],
        F.coalesce(F.sum("words").over(earlier), zero).alias("words_before")), "trie-blocks")

    whole = blocks.groupBy("conv_id").agg(F.bit_xor("b1").alias("k1"), F.bit_xor("b2").alias("k2"),
                                          F.sum("n").alias("depth"), F.sum("block_words").alias("all_words"))
    ends = staged(conversations.join(whole, "conv_id", "left").select(
        "conv_id", *[F.coalesce(c, zero).alias(c) for c in ("k1", "k2", "depth", "all_words")]), "trie-ends")
    # Identical conversations collapse into one weighted sequence.
    seqs = staged(ends.groupBy("k1", "k2", "depth").agg(
        F.min("conv_id").alias("seq"), F.count("*").alias("weight"), F.first("all_words").alias("all_words")), "trie-sequences")

    # Each sequence once, taken apart into its prefixes.
    weighted = seqs.select(F.col("seq").alias("conv_id"), F.col("depth").alias("length"), "weight", "all_words")
    of_block = blocks.join(weighted, "conv_id").drop("b1", "b2", "n", "block_words")
    upto = (Window.partitionBy("conv_id", "block").orderBy("depth")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = keyed.join(of_block, ["conv_id", "block"])
    key = [F.col(f"before{i}").bitwiseXOR(F.bit_xor(f"k{i}").over(upto)) for i in (1, 2)]
    path = rows.select(
        F.col("conv_id").alias("seq"), "depth", "length", "weight", "all_words", *[key[i].alias(f"p{i + 1}") for i in (0, 1)],
        *[key[i].bitwiseXOR(F.col(f"k{i + 1}")).alias(f"up{i + 1}") for i in (0, 1)],
        (F.col("words_before") + F.sum("words").over(upto) - F.col("words")).alias("words_above"))
    path = path.withColumnsRenamed({"p1": "k1", "p2": "k2"})
    roots = weighted.select(F.col("conv_id").alias("seq"), zero.alias("depth"), "length", "weight", "all_words",
                            *[zero.alias(c) for c in ("k1", "k2", "up1", "up2", "words_above")])
    path = staged(path.unionByName(roots), "trie-paths")

    node = ["k1", "k2", "depth"]
    nodes = staged(path.groupBy(*node).agg(
        F.sum("weight").alias("n_convs"), F.min("seq").alias("conv_id"),
        *[F.first(c).alias(c) for c in ("up1", "up2", "words_above")]), "trie-nodes")
    leaves = seqs.join(path.filter("depth < length").select(*node).distinct(), node, "left_anti").select("seq", F.lit(1).alias("leaf"))
    # A sequence owns the nodes of its path that are named by it: those from some depth on.
    owned = nodes.groupBy(F.col("conv_id").alias("seq")).agg(F.min(F.struct("depth", "words_above", "up1", "up2")).alias("top"))
    facts = (seqs.select("seq").join(leaves, "seq", "left").join(owned, "seq", "left")
             .select("seq", F.coalesce("leaf", F.lit(0)).alias("leaf"), F.col("top.depth").alias("top"),
                     F.col("top.words_above").alias("top_words")))
    d = F.col("depth")
    rest = F.col("all_words") - F.col("words_above")
    mine = F.when(F.col("top").isNull(), zero).when(d >= F.col("top"), rest).otherwise(F.col("all_words") - F.col("top_words"))
    child = (d < F.col("length")) & (d + 1 >= F.col("top"))
    sums = (path.join(facts, "seq").groupBy(*node).agg(
        F.sum(F.when(child, 1).otherwise(0)).alias("n_children"), F.sum("leaf").cast("long").alias("n_leaves"),
        F.sum(F.col("weight") * rest - mine).alias("saved_words")))
    # A node below its owner's top has a parent of the same name; only tops look theirs up.
    tops = owned.filter("top.depth > 0").select("seq", (F.col("top.depth") - 1).alias("depth"),
                                                F.col("top.up1").alias("k1"), F.col("top.up2").alias("k2"))
    parents = tops.join(nodes.select(*node, F.col("conv_id").alias("above")), node).select("seq", "above")
    named = nodes.join(owned.select("seq", F.col("top.depth").alias("top")).join(parents, "seq", "left"),
                       F.col("conv_id") == F.col("seq"))
    parent = F.when(d == 0, None).when(d > F.col("top"), F.col("conv_id")).otherwise(F.col("above"))
    out = named.select(*node, "conv_id", parent.alias("parent_conv_id"), "n_convs").join(sums, node)
    return out, ends.select(*node, "conv_id")


def end_digests(ends: DataFrame) -> DataFrame:
    """``k1, k2, depth, ends_sha256``: SHA-256 of each end list, ids ascending, joined by commas.

    Ids are joined in blocks of ``ID_BLOCK`` numbers first; a node's blocks
    then pass through one running hash, in order, without being gathered.
    """
    node = ["k1", "k2", "depth"]
    blocks = (ends.groupBy(*node, F.floor(F.col("conv_id") / ID_BLOCK).alias("block"))
              .agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids")))
    parts = blocks.repartition(*node).sortWithinPartitions(*node, "block")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, done = None, None, []
        for b in batches:
            for *key, ids in zip(*[c.to_pylist() for c in b.columns]):
                if key != at:
                    if at is not None:
                        done.append((*at, state.hexdigest()))
                    at, state = key, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            if len(done) >= 4096:
                yield _digest_batch(done)
                done = []
        if at is not None:
            done.append((*at, state.hexdigest()))
        if done:
            yield _digest_batch(done)

    return parts.select(*node, "ids").mapInArrow(digest, "k1 long, k2 long, depth long, ends_sha256 string")


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                      names=["k1", "k2", "depth", "ends_sha256"])
