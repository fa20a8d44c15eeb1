"""Suffix-array dedup: passages of ``MIN_WORDS`` words or more shared by documents.

Sparse suffix array: of every window of ``MIN_WORDS`` words the position of its
least k-gram (by hash; the leftmost of equals) is a minimiser, so equal windows
have it at the same place. Only suffixes that start at minimisers are kept. A
suffix carries the hash of its first ``SEED`` words and codes of the words to
the right and left of them, as far as any window with this minimiser reaches.

Suffixes are dealt by seed and sorted by seed and right-hand codes; the common
prefix of neighbours gives, for every reach to the right, the runs of suffixes
that agree that far. Matches are then extended to the left: suffixes of a run
that also agree on the d words before the seed share the window that starts d
words before it. So every shared window is found and no other.

Of each shared window the document with the smallest doc_id is the owner; its
occurrences in other documents are duplicates. Repeats inside one document
alone do not count. Windows are merged into spans.

Suffixes are first counted by seed, over all documents. Seeds that crowd a
partition would fill one task. They take another road: equal suffixes become one class, each window of a class a row
keyed by its hash, owners come from a partial aggregate, and the joins back are
ones Spark can split. Which road a seed takes does not change the result.

Word codes are 16 bits of a pair of adjacent words, so a changed word inside a
window changes two codes (a miss has odds of 2^-32); at a window's last words it
changes one, so a span may be a word too long with odds of 2^-16.

Defined cases: words are runs without ASCII white space, case kept; NULL and
short texts have no windows; very long texts are read whole, in parts; rows
equal in doc_id and text are one document, whose spans are given once; a NULL
doc_id comes last when owners are chosen; empty tables give no spans; extra
columns are not read, and removal carries them under any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, free_name, given_back, staged

MIN_WORDS = 50
SEED = 25
REACH = MIN_WORDS - SEED  # farthest any window reaches from its seed; also k-grams per window less one
CHUNK = 1 << 16
# A seed whose suffixes fill more than this part of an even shuffle partition
# takes the other road.
CROWD = 0.25

_P = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)
_MUL = np.uint64(_P)
_POWERS: dict[int, np.ndarray] = {}

# One suffix: owner order (id missing, id, text key), place, reach of its windows to the left, codes.
SUFFIX = np.dtype([("null", "u1"), ("doc", "<i8"), ("key", "<u4"), ("pos", "<u4"), ("dmin", "u1"), ("dmax", "u1"),
                   ("left", "<u2", (REACH,)), ("right", ">u2", (REACH,))])


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if 0 not in _POWERS or len(_POWERS[0]) < n:
        for i, x in enumerate((_P, pow(_P, -1, 1 << 64))):
            _POWERS[i] = np.cumprod(np.full(max(n, 1 << 16), x, np.uint64), dtype=np.uint64)
    return _POWERS[0], _POWERS[1]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hash of each word of a text."""
    words = (text or "").encode().split()
    if not words:
        return np.zeros(0, np.uint64)
    buf = b" " + b" ".join(words)
    b = np.frombuffer(buf, np.uint8)
    up, down = _powers(len(b) + 1)
    total = np.cumsum(up[:len(b)] * (b + np.uint64(1)), dtype=np.uint64)
    at = np.flatnonzero(b == 32)
    end = np.concatenate((at[1:], [len(b)])) - 1
    return _mix((total[end] - total[at]) * down[at])


def _grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k words in a row."""
    up, down = _powers(len(h) + 1)
    c = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * up[:len(h)], dtype=np.uint64)))
    return _mix((c[k:] - c[:-k]) * down[:len(h) - k + 1])


def minimisers(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Seed hashes, positions, and the first and last window start of each minimiser."""
    if len(h) < MIN_WORDS:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none
    g = _grams(h, SEED)
    best = []
    for s in range(0, len(h) - MIN_WORDS + 1, CHUNK):  # long texts in parts: REACH + 1 k-grams a window
        part = g[s:s + CHUNK + REACH]
        view = np.lib.stride_tricks.sliding_window_view(part, REACH + 1)
        best.append(view.argmin(axis=1) + np.arange(s, s + len(view)))
    at = np.concatenate(best)
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    last = np.concatenate((first[1:], [len(at)])) - 1
    pos = at[first]
    return g[pos], pos, first, last


def suffixes(doc: int | None, key: int, text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Seeds and suffix records of one text."""
    h = word_hashes(text)
    seed, pos, first, last = minimisers(h)
    out = np.zeros(len(pos), SUFFIX)
    if len(pos):
        pair = _mix(h * _MUL + np.concatenate((h[1:], np.zeros(1, np.uint64))))
        code = np.concatenate((np.zeros(REACH, np.uint16), (pair >> np.uint64(48)).astype(np.uint16), np.zeros(REACH, np.uint16)))
        step = np.arange(REACH)
        out["null"], out["doc"], out["key"], out["pos"] = doc is None, doc or 0, key, pos
        out["dmin"], out["dmax"] = pos - last, pos - first
        out["left"] = code[REACH + pos[:, None] - 1 - step]  # nearest first
        out["right"] = code[REACH + pos[:, None] + SEED - 1 + step]
    return seed, out


def shared_windows(seed: np.ndarray, suf: np.ndarray) -> np.ndarray:
    """Owner of each suffix's windows: rank of the owning document by (suffix, d), -1 where not shared.

    All suffixes of a seed must be present. Ranks follow (null, doc, key).
    """
    m = len(suf)
    _, rank = np.unique(suf[["null", "doc", "key"]], return_inverse=True)
    owner = np.full((m, REACH + 1), -1, np.int64)
    text = np.empty(m, f"S{8 + 2 * REACH}")
    raw = np.concatenate((seed.astype(">u8").view(np.uint8).reshape(m, 8),
                          np.ascontiguousarray(suf["right"]).view(np.uint8).reshape(m, -1)), axis=1)
    text = np.ascontiguousarray(raw).view(f"S{raw.shape[1]}").ravel()
    order = np.argsort(text, kind="stable")
    s, right, left = seed[order], suf["right"][order], suf["left"][order]
    rk, dmin, dmax = rank[order], suf["dmin"][order], suf["dmax"][order]
    same = right[1:] == right[:-1]
    lcp = np.where(same.all(axis=1), REACH, same.argmin(axis=1)) if m > 1 else np.zeros(0, np.int64)
    lcp = np.concatenate(([-1], np.where(s[1:] == s[:-1], lcp, -1)))
    before = np.zeros(m, np.uint64)
    for d in range(REACH + 1):
        if d:
            before = (before + left[:, d - 1] + np.uint64(1)) * _MUL
        run = np.cumsum(lcp < REACH - d)
        has = np.flatnonzero((dmin <= d) & (d <= dmax))
        if len(has) < 2:
            continue
        cls = _mix(before[has] ^ _mix(run[has].astype(np.uint64)))
        by = np.argsort(cls, kind="stable")
        has, cls = has[by], cls[by]
        start = np.flatnonzero(np.concatenate(([True], cls[1:] != cls[:-1])))
        size = np.diff(np.concatenate((start, [len(cls)])))
        low, high = np.minimum.reduceat(rk[has], start), np.maximum.reduceat(rk[has], start)
        owner[order[has], d] = np.repeat(np.where(low != high, low, -1), size)
    return owner


_SPANS = "doc_id long, key long, start long, end long, owner_id long, duplicate boolean"
_NAMES = [c.split()[0] for c in _SPANS.split(", ")]
_TYPES = [pa.int64()] * 5 + [pa.bool_()]


def _spans_of(seed: np.ndarray, suf: np.ndarray) -> pa.RecordBatch | None:
    twin = seed[1:] == seed[:-1]
    some = np.concatenate((twin, [False])) | np.concatenate(([False], twin))
    seed, suf = seed[some], suf[some]
    if not len(suf):
        return None
    # A repeated row's suffixes count once.
    parts = [seed, *(suf[c].astype(np.uint64) for c in ("null", "doc", "key", "pos"))]
    hashed = np.zeros(len(suf), np.uint64)
    for x in parts:
        hashed = _mix((hashed + x) * _MUL)
    if len(np.unique(hashed)) < len(hashed):
        order = np.lexsort(parts[::-1])
        new = np.concatenate(([True], np.any([x[order][1:] != x[order][:-1] for x in parts], axis=0)))
        seed, suf = seed[order[new]], suf[order[new]]
    owner = shared_windows(seed, suf)
    docs, rank = np.unique(suf[["null", "doc", "key"]], return_inverse=True)
    # Runs of d with one owner make one span.
    wide = np.concatenate((np.full((len(owner), 1), -1), owner, np.full((len(owner), 1), -1)), axis=1)
    edge = wide[:, 1:] != wide[:, :-1]
    row, lo = np.nonzero(edge[:, :-1] & (owner >= 0))
    _, hi = np.nonzero(edge[:, 1:] & (owner >= 0))
    who, own = suf[row], docs[owner[row, lo]]
    pos = who["pos"].astype(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(who["doc"], mask=who["null"] == 1), pa.array(who["key"].astype(np.int64)), pa.array(pos - hi),
         pa.array(pos - lo + MIN_WORDS), pa.array(own["doc"], mask=own["null"] == 1),
         pa.array(rank[row] != owner[row, lo])], names=_NAMES)


def _hot_seeds(keyed: DataFrame, crowd: float, n_parts: int) -> np.ndarray:
    """Seeds with more than ``crowd`` of an even partition's suffixes; at most ``n_parts / crowd`` there are.

    Suffixes are counted over all documents, by partial aggregates. A row
    without a seed counts all of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held, n = [], 0
            for i, t in enumerate(b.column(0), 1):
                held.append(minimisers(word_hashes(t.as_py()))[0])
                n += len(held[-1])
                if n >= CHUNK or (n and i == b.num_rows):
                    seeds, counts = np.unique(np.concatenate(held), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([None, *seeds.view(np.int64).tolist()], pa.int64()), pa.array([n, *counts.tolist()], pa.int64())],
                        names=["seed", "n"])
                    held, n = [], 0

    counts = keyed.select("text").mapInArrow(run, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n"))
    often = staged(counts.filter("n > 3 OR seed IS NULL"), "suffix-seeds")
    total = often.filter("seed IS NULL").select("n").first()
    if total is None:
        return np.zeros(0, np.uint64)
    hot = often.filter("seed IS NOT NULL").filter(F.col("n") > crowd * total.n / n_parts).select("seed").collect()
    return np.array(sorted(r.seed for r in hot), np.int64).view(np.uint64)


def text_key():
    """Tells apart texts under one doc_id."""
    return F.xxhash64("text").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))


def shared_spans(docs: DataFrame, crowd: float = CROWD) -> DataFrame:
    """``doc_id, key, start, end, owner_id, duplicate``: word spans that documents share.

    A span is a union of windows with one owner. Rows with ``duplicate`` false are
    the owner's own.
    """
    spark = docs.sparkSession
    keyed = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    keyed = keyed.withColumn("key", text_key())
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = spark.sparkContext.broadcast(_hot_seeds(keyed, crowd, n_parts))

    def cut(crowded: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = hot.value
            for b in batches:
                docs_, texts, keys = b.columns
                seeds, bodies, n = [], [], 0
                for i in range(b.num_rows):
                    s, r = suffixes(docs_[i].as_py(), keys[i].as_py(), texts[i].as_py())
                    road = np.flatnonzero(np.isin(s, known) == crowded)
                    if len(road):
                        seeds.append(s[road])
                        bodies.append(r[road])
                        n += len(road)
                    if n >= CHUNK or (n and i == b.num_rows - 1):
                        s, r = np.concatenate(seeds), np.concatenate(bodies)
                        body = pa.FixedSizeBinaryArray.from_buffers(
                            pa.binary(SUFFIX.itemsize), len(r), [None, pa.py_buffer(r.tobytes())]).cast(pa.binary())
                        yield pa.RecordBatch.from_arrays([pa.array(s.view(np.int64)), body], names=["seed", "suffix"])
                        seeds, bodies, n = [], [], 0

        return keyed.select("doc_id", "text", "key").mapInArrow(run, "seed long, suffix binary")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0

        def flush(all_: bool):
            nonlocal held, n
            s, r = (np.concatenate(x) for x in zip(*held))
            at = len(s) if all_ else int(np.searchsorted(s.view(np.int64), s.view(np.int64)[-1]))
            held, n = ([(s[at:], r[at:])], len(s) - at) if at < len(s) else ([], 0)
            return _spans_of(s[:at], r[:at]) if at else None

        for b in batches:
            if not b.num_rows:
                continue
            held.append(_unpacked(b))
            n += b.num_rows
            if n >= CHUNK:
                out = flush(False)
                if out is not None:
                    yield out
        if held:
            out = flush(True)
            if out is not None:
                yield out

    parts = (cut(False).repartition(n_parts, "seed").sortWithinPartitions("seed").mapInArrow(compare, _SPANS))
    if len(hot.value):  # a second pass over the texts costs less than keeping all suffixes
        parts = parts.unionByName(_hot_spans(cut(True)))
    return _merged(parts)


_HOT = "c long, nul boolean, doc long, key long, pos long, seed long, suffix binary"


def _hot_spans(suf: DataFrame) -> DataFrame:
    """Spans of crowded seeds.

    Suffixes that agree in all they carry are one class, whatever their
    number (partial aggregate). Each window of a class is a row keyed by its
    hash; a window's owner is the least of its classes' least documents. The
    classes' spans are then joined back to their members.
    """

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                seed, r = _unpacked(b)
                raw = r.view(np.uint8).reshape(len(r), -1)
                c = seed.copy()
                for k in range(SUFFIX.fields["dmin"][1], SUFFIX.itemsize):  # all but whose and where
                    c = (c + raw[:, k].astype(np.uint64) + np.uint64(1)) * _MUL
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_mix(c).view(np.int64)), pa.array(r["null"] == 1), pa.array(r["doc"]),
                     pa.array(r["key"].astype(np.int64)), pa.array(r["pos"].astype(np.int64)), *b.columns],
                    names=["c", "nul", "doc", "key", "pos", "seed", "suffix"])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            seed, r = _unpacked(b)
            before, ahead = np.zeros(len(r), np.uint64), [seed]
            for k in range(REACH):
                ahead.append((ahead[-1] + r["right"][:, k].astype(np.uint64) + np.uint64(1)) * _MUL)
            for d in range(REACH + 1):
                if d:
                    before = (before + r["left"][:, d - 1] + np.uint64(1)) * _MUL
                at = np.flatnonzero((r["dmin"] <= d) & (d <= r["dmax"]))
                h = _mix(_mix(ahead[REACH - d][at] + np.uint64(d)) ^ before[at])
                rest = b.select(["c", "own", "far"]).take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(np.full(len(at), d, np.int32)), *rest.columns],
                    names=["w", "d", "c", "own", "far"])

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for shared in b.column(1).to_pylist():
                spans: list[dict] = []
                for x in shared:
                    if spans and spans[-1]["hi"] == x["d"] - 1 and spans[-1]["own"] == x["own"]:
                        spans[-1]["hi"] = x["d"]
                    else:
                        spans.append({"lo": x["d"], "hi": x["d"], "own": x["own"]})
                out.append(spans)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, _RUNS)], names=["c", "runs"])

    who = "struct<nul:boolean,doc:bigint,key:bigint>"
    own = pa.struct([("nul", pa.bool_()), ("doc", pa.int64()), ("key", pa.int64())])
    _RUNS = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32()), ("own", own)]))
    records = staged(suf.mapInArrow(unpack, _HOT), "suffix-crowded").withColumn("who", F.struct("nul", "doc", "key"))
    classes = (records.groupBy("c").agg(F.min(F.struct("who", "seed", "suffix")).alias("x"), F.max("who").alias("far"))
               .select("x.seed", "x.suffix", "c", F.col("x.who").alias("own"), "far"))
    rows = classes.mapInArrow(windows, f"w long, d int, c long, own {who}, far {who}")
    owners = (rows.groupBy("w").agg(F.min("own").alias("least"), F.max("far").alias("most"))
              .filter("least <> most").select("w", "least"))
    shared = (rows.select("w", "d", "c").join(owners, "w").groupBy("c")
              .agg(F.array_sort(F.collect_list(F.struct("d", F.col("least").alias("own")))).alias("shared"))
              .mapInArrow(runs, f"c long, runs array<struct<lo:int,hi:int,own:{who}>>"))
    spans = records.select("c", "who", "pos").distinct().join(shared, "c").select("who", "pos", F.inline("runs"))
    return spans.select(
        F.when(~F.col("who.nul"), F.col("who.doc")).alias("doc_id"), F.col("who.key").alias("key"),
        (F.col("pos") - F.col("hi")).alias("start"), (F.col("pos") - F.col("lo") + MIN_WORDS).alias("end"),
        F.when(~F.col("own.nul"), F.col("own.doc")).alias("owner_id"), (F.col("who") != F.col("own")).alias("duplicate"))


def _unpacked(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Seeds and suffix records of a batch with columns ``seed`` and ``suffix``."""
    body = b.column("suffix").cast(pa.binary(SUFFIX.itemsize))
    raw = np.frombuffer(body.buffers()[1], SUFFIX, len(body), body.offset * SUFFIX.itemsize)
    return b.column("seed").to_numpy().view(np.uint64), raw.copy()


def _merged(parts: DataFrame) -> DataFrame:
    """Overlapping or touching spans of one document and owner become one."""
    by = ["doc_id", "key", "owner_id", "duplicate"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, start, end, out = None, 0, 0, []
        for b in batches:
            for doc, key, s, e, own, dup in zip(*(c.to_pylist() for c in b.columns)):
                if (doc, key, own, dup) == last and s <= end:
                    end = max(end, e)
                    continue
                if last is not None:
                    out.append((last[0], last[1], start, end, last[2], last[3]))
                last, start, end = (doc, key, own, dup), s, e
            if len(out) >= 4096:
                yield _batch(out)
                out = []
        if last is not None:
            out.append((last[0], last[1], start, end, last[2], last[3]))
        if out:
            yield _batch(out)

    def _batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=_NAMES)

    return parts.repartition("doc_id", "key").sortWithinPartitions(*by, "start").mapInArrow(run, _SPANS)


def remove_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` without the duplicate spans of their texts.

    Documents of which nothing is left go; ``n_chars`` follows the text where
    the column exists. Texts without duplicates are unchanged.
    """
    names = docs.columns
    key, cuts, doc, cut_key = (free_name(names, c) for c in ("_text_key", "_cuts", "_doc", "_cut_key"))
    spans = (shared_spans(docs).filter("duplicate").groupBy(F.col("doc_id").alias(doc), F.col("key").alias(cut_key))
             .agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias(cuts)))
    both = docs.withColumn(key, F.xxhash64(F.coalesce("text", F.lit(""))).bitwiseAND(F.lit(0xFFFFFFFF).cast("long")))
    both = both.join(spans, F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col(key) == F.col(cut_key)), "left")
    at = names.index("text")
    schema = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema)])
    keep = both.select(*[column(c).alias(f.name) for c, f in zip(names, schema)], cuts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t if c is None else without_words(t, [(x["start"], x["end"]) for x in c])
                     for t, c in zip(b.column(at).to_pylist(), b.column(len(names)).to_pylist())]
            cols = b.columns[:-1]
            cols[at] = pa.array(texts, pa.string())
            left = pa.array([c is None or t != "" for t, c in zip(texts, b.column(len(names)).to_pylist())])
            yield pa.RecordBatch.from_arrays(cols, names=schema.names).filter(left)

    out = given_back(keep.mapInArrow(run, schema), names, [])
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text"))
                             .cast(docs.schema["n_chars"].dataType))
    return out


def without_words(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of ``spans`` and the white space behind each span; '' if no word is left."""
    import re

    starts = [m.start() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)] + [len(text)]
    out, at = [], 0
    for s, e in sorted(spans):
        s = max(s, at)
        if s < e:
            out.append(text[(starts[at] if at else 0):starts[s]])
            at = e
    out.append(text[(starts[at] if at else 0):])
    joined = "".join(out)
    return joined if joined.strip(" \t\n\r\x0b\x0c") else ""
