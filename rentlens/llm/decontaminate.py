"""Benchmark decontamination: prefix-filtered set join with exact verification.

A benchmark item is a set of windows of consecutive words. All of a window's
shingles must occur in a document that holds the window, so any one of them
is a sufficient prefix (containment 1 leaves a prefix of one token); the
rarest in the corpus is taken. A document's shingles meet the prefix tokens;
a hit fixes where the window would start, positions outside the document are
dropped (positional bound), windows longer than the document never start
(length bound), and the words are compared exactly.

Windows are cut, shingles counted and prefix tokens chosen by Spark jobs. The
size of what a broadcast would hold is summed first: up to ``BLOCK_BYTES`` the
index is broadcast and documents pass once, narrowly. Beyond that only a bit
map of fixed size is broadcast; shingles it lets through are joined with the
prefix tokens, and what they prove goes back to the documents by a hash of the
text. Either way the documents are read as often as for the smallest benchmark.

Defined cases: NULL and empty texts have no words and no hits; an item of
fewer words than a window is one window, one without words is none; very long
texts are taken whole (a task holds one text and its words); items with equal
windows are all reported; a NULL item id reads as the empty text; repeated
rows are judged alike; there are no ties to break but equally rare shingles,
of which the first in byte order is taken; empty tables give no hits or no
rows. Other columns of the documents are carried through, whatever they are
called: the results' names are those of :func:`result_names`.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import carried, free_name, given_back, staged

WINDOW = 13
SHINGLE = 5
# Most bytes of windows and shingles that are broadcast; more are joined.
BLOCK_BYTES = 16 << 20
# Bits of the map that parts shingles worth joining from the rest (16 MB).
BITS = 1 << 27
# Rows a Python task hands on at a time.
_ROWS = 1 << 16

# Everything ASCII but letters and digits parts words; only A-Z is lowered.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


class Words:
    """A text's words, joined by single spaces, and where each starts and ends."""

    def __init__(self, text: str | None):
        words = (text or "").encode().translate(_TABLE).split()
        self.n = len(words)
        self.joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, self.n) + 1) - 1
        self.ends = ends.tolist()
        self.starts = [0, *(ends[:-1] + 1).tolist()] if self.n else []

    def span(self, at: int, n: int) -> bytes:
        return self.joined[self.starts[at]:self.ends[at + n - 1]]

    def shingles(self, n: int) -> list[bytes]:
        j = self.joined
        return [j[s:e] for s, e in zip(self.starts, self.ends[n - 1:])]


def cut_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``item, w``: the distinct windows of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for item, text in zip(*b.columns):
                w = Words(text.as_py())
                n = min(window, w.n)
                starts = w.n - n + 1 if n else 0
                for at in range(0, starts, _ROWS):
                    part = list(dict.fromkeys(w.span(i, n).decode() for i in range(at, min(at + _ROWS, starts))))
                    yield pa.RecordBatch.from_arrays([pa.array([item.as_py()] * len(part)), pa.array(part)], names=["item", "w"])

    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")), F.col("text").cast("string"))
    return rows.mapInArrow(run, "item string, w string").distinct()


def window_shingles(windows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``w, n, at, s``: each distinct window's number of words and its shingles by place."""
    words = F.split("w", " ")
    d = windows.select("w").distinct().select("w", words.alias("words"), F.size(words).alias("n"))
    k = F.least(F.lit(shingle), F.col("n"))
    d = d.select("w", "n", k.alias("k"), "words", F.explode(F.sequence(F.lit(0), F.col("n") - k)).alias("at"))
    return d.select("w", "n", "at", F.array_join(F.slice("words", F.col("at") + 1, F.col("k")), " ").alias("s"))


def bit_map(shingles: DataFrame) -> bytes:
    """Bits at the CRC of every ``s``; of a fixed size, whatever the frame holds."""
    p = F.crc32(F.col("s").cast("binary")) % BITS
    rows = (shingles.select(p.alias("p")).groupBy(F.expr("p div 64").alias("at"))
            .agg(F.expr("bit_or(shiftleft(1L, CAST(p % 64 AS INT)))").alias("bits")).toArrow())
    out = np.zeros(BITS // 64, "<u8")
    out[rows["at"].to_numpy()] = rows["bits"].to_numpy().view("<u8")
    return out.tobytes()


def met(w: Words, k: int, known) -> list[tuple[int, bytes]]:
    """Shingles of ``k`` words with their places that are in ``known``, a container of shingles or a bit map."""
    if isinstance(known, bytes):
        return [(i, s) for i, s in enumerate(w.shingles(k)) if known[(p := crc32(s) % BITS) >> 3] >> (p & 7) & 1]
    return [(i, s) for i, s in enumerate(w.shingles(k)) if s in known]


def corpus_counts(docs: DataFrame, known, sizes: list[int]) -> DataFrame:
    """``s, c``: occurrences in all documents of shingles in ``known`` (by a bit map: and of a few others)."""
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def batch(seen: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([s.decode() for s in seen], pa.string()),
                                           pa.array(list(seen.values()), pa.int64())], names=["s", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            for t in b.column(0):
                w = Words(t.as_py())
                for k in sizes:
                    seen.update([s for _, s in met(w, k, shared.value)])
                if len(seen) > _ROWS:
                    yield batch(seen)
                    seen.clear()
        yield batch(seen)

    return docs.select(F.col("text").cast("string")).mapInArrow(run, "s string, c long").groupBy("s").agg(F.sum("c").alias("c"))


def prefix_tokens(shingles: DataFrame, counts: DataFrame) -> DataFrame:
    """``w, n, at, s``: the rarest shingle of every window."""
    rarity = F.struct(F.coalesce("c", F.lit(0)).alias("c"), "s", "at")
    best = shingles.join(counts, "s", "left").groupBy("w", "n").agg(F.min(rarity).alias("r"))
    return best.select("w", "n", "r.at", "r.s")


def hits(text: str | None, index: dict) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words, word intervals hit (unmerged, sorted) and items met of one text."""
    w = Words(text)
    found: set[tuple[int, int]] = set()
    items: set[str] = set()
    windows = index["windows"]
    for k, prefix in index["prefix"].items():
        for i, s in met(w, k, prefix):
            for at, n in prefix[s]:
                start = i - at
                if start < 0 or start + n > w.n or (start, start + n) in found:
                    continue
                holders = windows.get(w.span(start, n))
                if holders is not None:
                    found.add((start, start + n))
                    items.update(holders)
    return w.n, sorted(found), items


def merge(intervals: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of sorted intervals."""
    out: list[tuple[int, int]] = []
    for s, e in intervals:
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


_SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
_SPANS = T.ArrayType(_SPAN)
_ARROW_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def result_names(columns) -> tuple[str, str, str]:
    """Names of the number of words, the spans and the items beside ``columns``."""
    n_words, spans, items = (free_name(columns, c) for c in ("_n_words", "_spans", "_items"))
    return n_words, spans, items


def decontaminate(docs: DataFrame, benchmark: DataFrame, carry: list[str], window: int = WINDOW,
                  shingle: int = SHINGLE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``carry`` columns plus ``_n_words``, ``_spans`` (words hit, merged) and ``_items`` (sorted ids met).

    Every row of ``docs`` is in the result. A benchmark whose windows and
    shingles take more than ``block_bytes`` is joined, not broadcast.
    """
    windows = staged(cut_windows(benchmark, window), "decontaminate-windows")
    shingles = window_shingles(windows, shingle)
    distinct = shingles.groupBy("s").agg(F.max(F.size(F.split("s", " "))).alias("k"))
    size = windows.agg(F.coalesce(F.sum(F.octet_length("w") + F.octet_length("item") + 8), F.lit(0))).first()[0]
    size += distinct.agg(F.coalesce(F.sum(F.octet_length("s") + 8), F.lit(0))).first()[0] if size <= block_bytes else 0
    sizes = sorted(r.k for r in distinct.select("k").distinct().collect())
    frame, kept = carried(docs, carry, "text")
    if size <= block_bytes:
        known = {r.s.encode() for r in distinct.collect()}
        tokens = prefix_tokens(shingles, corpus_counts(docs, known, sizes)).collect() if known else []
        out = _by_broadcast(frame, kept, windows.collect(), tokens)
    else:
        counts = corpus_counts(docs, bit_map(distinct), sizes)
        tokens = staged(prefix_tokens(shingles, counts), "decontaminate-prefixes")
        out = _by_join(frame, kept, windows, tokens, sizes, window)
    return given_back(out, carry, [F.col(c).alias(a) for c, a in zip(("_n_words", "_spans", "_items"), result_names(carry))])


def _by_broadcast(frame: DataFrame, kept: T.StructType, windows: list, tokens: list) -> DataFrame:
    """One narrow pass with the index (bounded by its measured size) on every executor."""
    holders: dict[bytes, list[str]] = defaultdict(list)
    for r in windows:
        holders[r.w.encode()].append(r.item)
    prefix: dict[int, dict[bytes, list]] = defaultdict(lambda: defaultdict(list))
    for r in tokens:
        places = prefix[r.s.count(" ") + 1][r.s.encode()]
        if (r.at, r.n) not in places:
            places.append((r.at, r.n))
    shared = frame.sparkSession.sparkContext.broadcast(
        {"prefix": {k: dict(v) for k, v in prefix.items()}, "windows": dict(holders)})
    schema = T.StructType(kept.fields).add("_n_words", "long").add("_spans", _SPANS).add("_items", T.ArrayType(T.StringType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_words, spans, items = [], [], []
            for t in b.columns[-1]:
                n, found, which = hits(t.as_py(), shared.value)
                n_words.append(n)
                spans.append([{"start": s, "end": e} for s, e in merge(found)])
                items.append(sorted(which))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(n_words, pa.int64()), pa.array(spans, _ARROW_SPANS),
                                              pa.array(items, pa.list_(pa.string()))], names=schema.names)

    return frame.mapInArrow(run, schema)


def _by_join(frame: DataFrame, kept: T.StructType, windows: DataFrame, tokens: DataFrame, sizes: list[int],
             window: int) -> DataFrame:
    """Shingles that the bit map lets through, with the words round them, meet the prefix tokens by a shuffle.

    What is found goes by a hash of the text, so copies of a text are proven once.
    """
    shared = frame.sparkSession.sparkContext.broadcast(bit_map(tokens))
    names = ["key", "s", "i", "before", "round"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for b in batches:
            for key, t in zip(*b.columns):
                w = Words(t.as_py())
                for k in sizes:
                    for i, s in met(w, k, shared.value):
                        lo, hi = max(0, i - window + 1), min(w.n, i + window)
                        rows.append((key.as_py(), s.decode(), i, i - lo, w.span(lo, hi - lo).decode()))
                        if len(rows) == _ROWS:
                            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)
                            rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)

    key = F.sha2(F.coalesce("t", F.lit("")).cast("binary"), 256).alias("key")
    tried = (frame.select(key, "t").mapInArrow(run, "key string, s string, i long, before long, round string")
             .groupBy("key", "s", "i").agg(F.first("before").alias("before"), F.first("round").alias("round")))
    same = F.expr("CASE WHEN before >= at THEN array_join(slice(split(round, ' '), CAST(before - at AS INT) + 1, n), ' ') = w END")
    start = F.col("i") - F.col("at")
    found = staged(tried.join(tokens, "s").filter(same)
                   .select("key", F.struct(start.alias("start"), (start + F.col("n")).alias("end")).alias("span"), "w").distinct(),
                   "decontaminate-found")

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans = [[{"start": s, "end": e} for s, e in merge(sorted((x["start"], x["end"]) for x in row.as_py()))]
                     for row in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, _ARROW_SPANS)], names=["key", "_spans"])

    spans = (found.groupBy("key").agg(F.collect_set("span").alias("spans"))
             .mapInArrow(merged, T.StructType().add("key", "string").add("_spans", _SPANS)))
    items = (found.select("key", "w").distinct().join(windows, "w").groupBy("key")
             .agg(F.sort_array(F.collect_set("item")).alias("_items")))
    proven = spans.join(items, "key")
    every = frame.select(*kept.names, key, F.coalesce(F.regexp_count("t", F.lit(_WORD)), F.lit(0)).cast("long").alias("_n_words"))
    return every.join(proven, "key", "left").select(
        *kept.names, "_n_words", F.coalesce("_spans", F.array().cast(_SPANS)).alias("_spans"),
        F.coalesce("_items", F.array().cast("array<string>")).alias("_items"))


def is_contaminated(n_words, n_hit, share: int = 20):
    """At least one word in ``share`` lies in a benchmark window."""
    return (n_hit > 0) & (share * n_hit >= n_words)


def span_words(spans: str = "_spans"):
    """Words covered by merged intervals."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
