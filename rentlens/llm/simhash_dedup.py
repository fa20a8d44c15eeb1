"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprint: 64 bits, each the majority over the XXH64 hashes of the text's
word shingles. Search: every bit position gets a nonzero vector of r+1 bits,
and each nonzero vector v of the same length makes a table that keeps the bit
positions whose vector has an odd product with v. Two fingerprints that differ
in at most r positions meet in some table, since r vectors cannot span all
r+1 dimensions; nothing is missed.

Equal fingerprints are one node. A bucket with few distinct fingerprints is
compared in place; the fingerprints of fuller buckets are linked through their
single-bit neighbours instead (two at distance two or less share one, and at
most 65 share any), so the work stays linear however full a bucket is.

Defined cases: NULL and empty texts have fingerprint zero and are linked like
others; a text of fewer words than a shingle is one shingle; repeated rows
share their fingerprint's component; a NULL doc_id never names a component
unless no other id is in it; an empty table gives no rows. Extra columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, free_name, staged
from .components import connected_components

BITS = 64
# Buckets of up to this many distinct fingerprints are compared in place.
PAIRWISE = 64
CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash of one text."""
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: ASCII case and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1:]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, CHUNK):
        h = np.array([digest(joined[s:e], seed) for s, e in
                      zip(starts[at:min(at + CHUNK, n)].tolist(), last[at:at + CHUNK].tolist(), strict=True)], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << b for b in np.flatnonzero(2 * ones > n).tolist())


def fingerprints(docs: DataFrame, carry: list[str], shingle: int = 3, seed: int = 42, text: str = "text") -> DataFrame:
    """``carry`` columns and ``fp`` (signed 64-bit) of every row of ``docs``."""
    src = docs.select(*carry, F.col(text).cast("string").alias("__whole_text"))
    schema = T.StructType([docs.schema[c] for c in carry]).add("fp", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t.as_py(), shingle, seed) for t in b.column(b.num_columns - 1)]
            col = pa.array(np.array(fps, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], col], names=[*carry, "fp"])

    return src.mapInArrow(run, schema)


def covering_masks(radius: int) -> list[int]:
    """Bit masks (signed 64-bit) of the tables that cover ``radius``."""
    vectors = (1 << (radius + 1)) - 1
    masks = []
    for v in range(1, vectors + 1):
        m = sum(1 << b for b in range(BITS) if ((1 + b % vectors) & v).bit_count() % 2)
        masks.append(m - (1 << BITS) if m >> (BITS - 1) else m)
    return masks


def _near(a: Column, b: Column, radius: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= radius


def near_links(fps: DataFrame, radius: int = 2, pairwise: int = PAIRWISE) -> DataFrame:
    """Links ``a, b`` that connect all distinct ``fp`` within ``radius`` bits (at most 2).

    Every linked pair is within the radius, and any pair within it is joined
    by links (directly from small buckets).
    """
    if not 1 <= radius <= 2:
        raise ValueError("radius must be 1 or 2")
    tables = F.array(*[F.struct(F.lit(i).alias("v"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("key"))
                       for i, m in enumerate(covering_masks(radius))])
    rows = fps.select("fp", F.inline(tables))
    sizes = rows.groupBy("v", "key").agg(F.count("*").alias("n")).filter("n > 1")
    met = staged(rows.join(sizes, ["v", "key"]), "simhash-buckets")

    small = met.filter(F.col("n") <= pairwise).groupBy("v", "key").agg(F.collect_list("fp").alias("m"))
    pairs = F.flatten(F.transform("m", lambda a: F.transform(
        F.filter("m", lambda b: (b > a) & _near(a, b, radius)),
        lambda b: F.struct(a.alias("a"), b.alias("b")))))
    links = small.select(F.inline(pairs))

    full = met.filter(F.col("n") > pairwise).select("fp").distinct()
    flips = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit((1 << b) if b < 63 else -(1 << 63)).cast("long")) for b in range(BITS)])
    centres = (full.select("fp", F.explode(flips).alias("centre"))
               .groupBy("centre").agg(F.collect_set("fp").alias("m")).filter(F.size("m") > 1))
    # At radius 2 all round one centre are near each other; at radius 1 they
    # are near the centre, if that is a fingerprint itself.
    hub = F.array_min("m") if radius == 2 else F.when(F.array_contains("m", F.col("centre")), F.col("centre"))
    stars = (centres.select("m", hub.alias("a")).filter(F.col("a").isNotNull())
             .select("a", F.explode("m").alias("b")).filter("a != b"))
    return links.union(stars)


def simhash_components(docs: DataFrame, carry: list[str], shingle: int = 3, radius: int = 2, seed: int = 42) -> DataFrame:
    """``carry`` columns, ``fp``, ``root`` (smallest fingerprint of the component) and ``component_id``.

    ``carry`` must hold ``doc_id``; ``component_id`` is the smallest in the component.
    """
    marked = staged(fingerprints(docs, carry, shingle, seed), "simhash-fingerprints")
    nodes = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-nodes")
    roots = connected_components(near_links(nodes.select("fp"), radius), "simhash-links")
    rooted = (nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
              .withColumn("root", F.coalesce("root", "fp")))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.select("fp", "root").join(least, "root")
    return marked.join(named, "fp")


def keep_one_per_component(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """Rows of ``docs``, one per component: the smallest doc_id, then the smallest row hash."""
    row, key = (free_name(docs.columns, c) for c in ("_row_hash", "_row_id"))
    hashed = F.xxhash64(*[column(f.name) for f in docs.schema if not f.dataType.simpleString().startswith("map")])
    keyed = docs.withColumn(row, hashed).withColumn(key, F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    marked = simhash_components(keyed, ["doc_id", row, key], shingle, radius)
    keep = (marked.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", row, key)).alias("k"))
            .select(F.col(f"k.{row}").alias(row), F.col(f"k.{key}").alias(key)))
    # Copies of a row are dropped before its texts are shuffled (each map task sends one); the join shares that shuffle.
    return keyed.dropDuplicates([row, key]).join(keep.hint("shuffle_hash"), [row, key], "left_semi").drop(row, key)
