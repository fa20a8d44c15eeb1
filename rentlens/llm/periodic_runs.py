"""Periodic runs: maximal stretches of words that repeat with a small period.

A run is a stretch of consecutive words whose smallest period is q (words q
apart are the same) and whose length is at least ``max(SHORTEST, REPEATS * q)``,
which no neighbouring word extends keeping that period.

Method. Every word of a run occurs at least ``REPEATS`` times in it, so a word
that occurs fewer times in a segment can stand in no run there: it splits the
segment, and the parts are counted anew until no word is that rare. No run
crosses a split. The segments that survive are scanned lag by lag: a run of
period q holds ``REPEATS`` neighbouring multiples of q, so only the places
where those words agree are extended to both sides. Places inside a known run
whose period divides the lag are passed over, since they would give it again,
and so are places between which such a run ends, since a run's end is where its
words stop to agree at that lag. A lag costs the segments' length over the lag,
so a text of n words costs about n log n and not n squared.

Defined cases: NULL and empty texts have no words and no runs; runs of
different periods may overlap, and all are returned; repeated rows are scanned
each; an empty table gives no rows; a text is never cut off. Only ``carry`` and
the text column are read; a carried column with the name of a result column
gives way to the result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import carried, given_back

REPEATS = 4
SHORTEST = 6
RUN = T.StructType().add("start", "long").add("length", "long").add("period", "long")


def frequent_segments(codes: np.ndarray, repeats: int = REPEATS, shortest: int = SHORTEST) -> tuple[np.ndarray, np.ndarray]:
    """Places (ascending) that recursive frequency splitting leaves, and the segment of each.

    ``codes`` number the words; negative ones are known to be rare.
    """
    at = np.flatnonzero(codes >= 0)
    while len(at):
        # Places in a row form a segment; short segments hold no run.
        seg = np.concatenate(([0], np.cumsum(np.diff(at) > 1)))
        long_enough = np.bincount(seg)[seg] >= shortest
        at, seg = at[long_enough], seg[long_enough]
        if not len(at):
            break
        pair = seg * (int(codes.max()) + 1) + codes[at]
        _, which, n = np.unique(pair, return_inverse=True, return_counts=True)
        keep = n[which] >= repeats
        if keep.all():
            return at, seg
        at = at[keep]
    return at, np.zeros(0, np.int64)


def _agree(x: np.ndarray, at: int, lag: int, step: int) -> int:
    """How many places from ``at`` on, forwards or backwards, have the same word ``lag`` further on."""
    done, block = 0, 64
    while True:
        if step > 0:
            lo, hi = at + done, min(at + done + block, len(x) - lag)
            same = x[lo:hi] == x[lo + lag:hi + lag] if hi > lo else np.zeros(0, bool)
        else:
            lo, hi = max(0, at - done - block + 1), at - done + 1
            same = (x[lo:hi] == x[lo + lag:hi + lag])[::-1] if hi > lo else np.zeros(0, bool)
        bad = np.flatnonzero(~same)
        if len(bad):
            return done + int(bad[0])
        if len(same) < block:
            return done + len(same)
        done, block = done + block, 2 * block


def _unsettled(at: np.ndarray, q: int, repeats: int, period: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Those of ``at`` that lie in no known run of this lag and with which no known run says that a word disagrees."""
    last = (repeats - 2) * q  # all words up to there would agree at the lag
    p = period[at]
    at = at[(p == 0) | (q % np.maximum(p, 1) != 0) | (at + last + q >= end[at])]
    for k in range(repeats):
        if not len(at):
            break
        p, s, e = period[at + k * q], start[at + k * q], end[at + k * q]
        ends = (e - q >= np.maximum(s, at)) & (e - q <= at + last)
        begins = (s - 1 >= at) & (s - 1 <= at + last) & (s - 1 + q < e)
        at = at[~((p > 0) & (q % np.maximum(p, 1) == 0) & (ends | begins))]
    return at


def scan_lags(x: np.ndarray, longest: int, repeats: int = REPEATS, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """Runs ``(start, length, period)`` of ``x``, whose longest segment has ``longest`` words."""
    found: dict[tuple[int, int], int] = {}
    # Of the longest known run over a place: its period, start and end.
    period, start, end = (np.zeros(len(x), np.int64) for _ in range(3))
    for q in range(1, longest // repeats + 1):
        anchors = x[::q]
        same = anchors[1:] == anchors[:-1]
        hit = same[repeats - 2:].copy()
        for k in range(repeats - 2):
            hit &= same[k:len(same) - (repeats - 2) + k]
        at = np.flatnonzero(hit) * q
        if found and len(at):
            at = _unsettled(at, q, repeats, period, start, end)
        done = -1
        for a in at.tolist():
            if a < done:
                continue
            s = a - (_agree(x, a - 1, q, -1) if a else 0)
            e = a + _agree(x, a, q, 1) + q
            done = e - q  # no other stretch of this lag starts before
            if e - s < max(shortest, repeats * q) or (s, e) in found:
                continue
            found[s, e] = q
            less = end[s:e] - start[s:e] < e - s
            period[s:e][less], start[s:e][less], end[s:e][less] = q, s, e
    return [(s, e - s, q) for (s, e), q in found.items()]


def find_runs(words: list[bytes]) -> list[tuple[int, int, int]]:
    """All runs ``(start, length, period)`` of a text's words, by start, then period."""
    counts = Counter(words)
    codes = {w: i for i, w in enumerate(w for w, n in counts.items() if n >= REPEATS)}
    if not codes:
        return []
    rare = -1
    numbers = np.fromiter((codes.get(w, rare) for w in words), np.int64, len(words))
    at, seg = frequent_segments(numbers)
    if not len(at):
        return []
    # Segments side by side, each behind a number that agrees with nothing.
    first = np.flatnonzero(np.concatenate(([True], np.diff(seg) > 0)))
    sizes = np.diff(np.concatenate((first, [len(at)])))
    x = np.insert(numbers[at], first, -1 - np.arange(len(first)))
    place = np.insert(at, first, -1)
    return sorted(((int(place[s]), n, q) for s, n, q in scan_lags(x, int(sizes.max()))), key=lambda r: (r[0], r[2]))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that stand in no run behind its first period."""
    if not runs:
        return words
    drop = np.zeros(len(words) + 1, np.int64)
    for s, n, q in runs:
        drop[s + q] += 1
        drop[s + n] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(drop[:-1]) == 0).tolist()]


def split_words(text: str, _row: tuple) -> list[bytes]:
    """Words between ASCII white space."""
    return text.encode().split()


def periodic_runs(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",), text: str = "text",
                  words: Callable[[str, tuple], list[bytes]] = split_words) -> DataFrame:
    """``carry`` columns, ``n_words``, ``runs`` (by start, then period) and the ``collapsed`` text of every row.

    ``words(text, carried values)`` gives a row's words.
    """
    out = ("n_words", "runs", "collapsed")
    carry = [c for c in carry if c not in out]
    src, schema = carried(docs, carry, text)
    schema = schema.add("n_words", "long").add("runs", T.ArrayType(RUN)).add("collapsed", "string")
    run_type = pa.list_(pa.struct([(f.name, pa.int64()) for f in RUN.fields]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = zip(*[c.to_pylist() for c in b.columns[:-1]]) if carry else iter(lambda: (), None)
            n_words, runs, kept = [], [], []
            for t, row in zip(b.column(b.num_columns - 1), rows):
                w = words(t.as_py() or "", row)
                got = find_runs(w)
                n_words.append(len(w))
                runs.append([dict(zip(RUN.names, r)) for r in got])
                kept.append(b" ".join(collapse(w, got)).decode())
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(n_words, pa.int64()), pa.array(runs, run_type), pa.array(kept, pa.string())],
                names=schema.names)

    return given_back(src.mapInArrow(run, schema), carry, out)
