"""Approximate nearest neighbours by collision counting over single projections.

Rows and queries are dealt to blocks, and a task meets one block of rows with
one of queries. A block's rows get one component more, which lifts them all to
the length of its longest, and a query is scaled to that length, so that the
largest inner product becomes the smallest distance; then each is projected on
``m`` random lines, and the projections of a line are kept as a sorted array. A
query's window on a line is centred on its own projection, and virtual rehashing
widens all windows step by step: two places a line move outwards over the sorted
array, and the rows they pass are counted. A row that has collided on at least
``threshold`` of the lines is verified by the exact inner product. A query is done with a block when the
windows are so wide that a row no further than the k-th best verified one lies
in ``threshold`` of them with a chance of ``RECALL`` (or all rows lie in all
windows): on random lines that chance depends on distance and window alone,
whatever the rows. No number of rows ends a search. Blocks' best rows are
merged, so every row is searched. Recall against brute force is measured by the
tests.

Scores are inner products of the original vectors in double precision, summed
in the same order for every row, so equal vectors tie exactly; ties go to the
smaller vec_id. Rows met are first compared by their cosines, and those that
rounding may have kept from the best k are multiplied in that order.

Defined cases: vectors that are NULL, zero, or hold NULL or non-finite
components take no part, nor do those whose length differs from the commonest;
rows that repeat a vec_id are all candidates, except for a query's own vec_id;
fewer candidates than k: all; an empty table gives no rows. Components of any
finite size take part: blocks are scaled before anything is squared. A product
too large for a double is infinite, one too small is zero, none is NaN. Columns
beside vec_id and the vectors are not read, so they may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K = 20
PROJECTIONS = 48
ROW_BLOCK, QUERY_BLOCK = 8192, 1024
# Short vectors lie in up to four times larger blocks, of so many components: the k-th best
# of more rows is nearer, so a query's windows stay narrower.
COMPONENTS = 1 << 21
# Share of the windows that must hold a row before it is verified.
THRESHOLD = 0.5
# Chance that a row at the k-th best distance is verified before a query is done.
RECALL = 0.97
PIECE = 256
# Of the first window, in lengths of the block's longest row, and of each step.
FIRST_WIDTH, GROWTH = 0.02, 1.8


def usable(vectors: DataFrame, vec: str = "embedding") -> DataFrame:
    """``vec_id, v array<double>``, without vectors that take no part."""
    v = F.col(vec).cast("array<double>")
    ok = (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long"), v.alias("v")).filter(F.col("vec_id").isNotNull() & F.coalesce(ok, F.lit(False)))
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1)
    common = sizes.select("n").scalar()
    return rows.filter(F.size("v") == common)


def projections(dim: int, m: int, seed: int = 11) -> np.ndarray:
    """Directions of the single-projection hashes, for vectors with one added component."""
    a = np.random.default_rng(seed).normal(size=(dim + 1, m))
    return a / np.linalg.norm(a, axis=0)


def reach_factor(dim: int, m: int, threshold: int) -> float:
    """Window, in distances, that holds a row at that distance on ``threshold`` of ``m`` lines with a chance of ``RECALL``."""
    lo, hi = 0.0, 1.0
    for _ in range(60):
        p = (lo + hi) / 2
        met = sum(math.comb(m, i) * p ** i * (1 - p) ** (m - i) for i in range(threshold, m + 1))
        lo, hi = (lo, p) if met >= RECALL else (p, hi)
    # The cosine of a random line with a fixed vector: angles have density sin^(dim - 1) with the added component.
    angle = (np.arange(1 << 17) + 0.5) / (1 << 17) * (math.pi / 2)
    mass = np.cumsum(np.sin(angle[::-1]) ** (dim - 1))
    return float(np.cos(angle[::-1][min(np.searchsorted(mass, hi * mass[-1]), len(mass) - 1)]))


def rows_of_a_block(dim: int) -> int:
    return min(max(ROW_BLOCK, COMPONENTS // dim), 4 * ROW_BLOCK)


class Block:
    """Rows of one block as sorted projections, in lengths of the longest row."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, lines: np.ndarray):
        self.ids, self.x = ids, x
        # Scaled by the largest component first, so that no square leaves the range of doubles.
        self.scale = float(np.abs(x).max())
        unit = x / self.scale
        self.length = math.sqrt(float(np.einsum("ij,ij->i", unit, unit).max()))
        unit /= self.length
        self.unit = unit
        lift = np.sqrt(np.maximum(1.0 - np.einsum("ij,ij->i", unit, unit), 0.0))
        h = (np.concatenate((unit, lift[:, None]), axis=1) @ lines).T
        # One array for all lines: they lie between -1 and 1, so a step of 4 keeps them apart.
        self.line = 4.0 * np.arange(len(h))
        self.order = np.argsort(h, axis=1).ravel()
        self.sorted = (np.sort(h, axis=1) + self.line[:, None]).ravel()

    def _products(self, rows: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Inner products in double precision, each row summed alone; beyond its range they are infinite, never NaN."""
        with np.errstate(over="ignore", invalid="ignore"):
            out = np.concatenate([(self.x[rows[i:i + PIECE]] * q).sum(axis=1) for i in range(0, len(rows), PIECE)] or [np.zeros(0)])
            odd = np.flatnonzero(~np.isfinite(out))
            if len(odd):
                top = float(np.abs(q).max())
                small = (self.x[rows[odd]] / self.scale * (q / top)).sum(axis=1)
                out[odd] = small * self.scale * top
        return out

    def _cosines(self, rows: np.ndarray, unit: np.ndarray) -> np.ndarray:
        """Inner products with a query of length 1, in lengths of the longest row, but for rounding."""
        return np.concatenate([np.einsum("ij,j->i", self.unit.take(rows[i:i + PIECE], axis=0), unit) for i in range(0, len(rows), PIECE)] or [np.zeros(0)])

    def search(self, own: int, q: np.ndarray, lines: np.ndarray, k: int, threshold: int, factor: float) -> list[tuple[float, int]]:
        """The best k of the verified rows as (score, id), best first."""
        n, top = len(self.ids), float(np.abs(q).max())
        unit = q / top
        norm = math.sqrt(float(unit @ unit))
        unit /= norm
        centre, first = unit @ lines[:-1] + self.line, n * np.arange(len(self.line))
        lo = hi = np.clip(np.searchsorted(self.sorted, centre), first, first + n)
        count, waiting = np.zeros(n, np.int16), self.ids != own
        rows, near = np.zeros(0, np.int64), np.zeros(0)
        # The range of scores, from lengths of the query and of the longest row. Inside that of doubles, the order by
        # cosine is that by score but for rounding: only rows that close to the k-th best are multiplied exactly.
        whole = norm * top * self.length * self.scale
        plain, slack = 1e-280 < whole < 1e280, 8e-16 * (len(q) + 8)
        width = FIRST_WIDTH
        while True:
            # The windows grow to both sides; only rows that come in are counted.
            below = np.clip(np.searchsorted(self.sorted, centre - width, "left"), first, lo)
            above = np.clip(np.searchsorted(self.sorted, centre + width, "right"), hi, first + n)
            new = [self.order[a:b] for a, b in zip(below.tolist(), lo.tolist()) if a < b]
            new += [self.order[a:b] for a, b in zip(hi.tolist(), above.tolist()) if a < b]
            lo, hi = below, above
            if new:
                count += np.bincount(np.concatenate(new), minlength=n).astype(np.int16)
            met = np.flatnonzero((count >= threshold) & waiting)
            waiting[met] = False
            rows, near = np.concatenate((rows, met)), np.concatenate((near, self._cosines(met, unit)))
            if (hi - lo == n).all():
                break
            wide = width * GROWTH
            if len(rows) >= k:
                # Distance of the k-th best; the floor covers the rounding of equal vectors.
                least = float(np.partition(near, len(near) - k)[len(near) - k])
                bound = factor * math.sqrt(max(2 - 2 * least, 1e-10))
                if width >= bound:
                    break
                wide = min(wide, bound)
            width = wide
        self.verified = len(rows)
        if plain and len(rows) > k:
            rows = rows[near >= np.partition(near, len(near) - k)[len(near) - k] - 2 * slack]
        score = self._products(rows, q)
        if len(rows) > k:  # the k-th best and what ties with it
            best = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
            rows, score = rows[best], score[best]
        ids = self.ids[rows]
        best = np.lexsort((ids, -score))[:k]
        return list(zip(score[best].tolist(), ids[best].tolist()))


def _matrix(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = t.column("vec_id").to_numpy()
    flat = t.column("v").combine_chunks()
    x = flat.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
    return ids, x


def nearest(vectors: DataFrame, query_mod: int = 20, k: int = K, m: int = PROJECTIONS, row_block: int | None = None,
            query_block: int = QUERY_BLOCK, threshold: float = THRESHOLD) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best found for every row whose id is divisible by ``query_mod``."""
    rows = usable(vectors)
    n, dim = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    if not n:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    queries = rows.filter(F.col("vec_id") % query_mod == 0)
    n_rows = max(1, math.ceil(n / (row_block or rows_of_a_block(dim))))
    n_queries = max(1, math.ceil(n / query_mod / query_block))
    lines = vectors.sparkSession.sparkContext.broadcast(projections(dim, m))
    need = max(1, math.ceil(threshold * m))
    factor = reach_factor(dim, m, need)

    # Every block of rows meets every block of queries, once.
    part = F.pmod(F.xxhash64("vec_id", "v"), F.lit(n_rows)).cast("int").alias("i")
    left = rows.select("vec_id", "v", part, F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1))).alias("j"))
    part = F.pmod(F.xxhash64("vec_id", "v"), F.lit(n_queries)).cast("int").alias("j")
    right = queries.select("vec_id", "v", part, F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1))).alias("i"))

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        if a.num_rows and b.num_rows:
            ids, x = _matrix(a)
            block = Block(ids, x, lines.value)
            qids, q = _matrix(b)
            for own, v in zip(qids.tolist(), q):
                for score, other in block.search(own, v, lines.value, k, need, factor):
                    out[0].append(own), out[1].append(other), out[2].append(score)
        return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())],
                        names=["query_id", "vec_id", "score"])

    met = left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInArrow(meet, "query_id long, vec_id long, score double")
    # At most k rows of each block reach a query's final list.
    best = met.groupBy("query_id").agg(
        F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k).alias("b"))
    return best.select("query_id", F.posexplode("b").alias("p", "x")).select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), "x.vec_id", (-F.col("x.s")).alias("score"))
