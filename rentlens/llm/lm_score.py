"""LM scoring: marginal probability of whole texts under a subword lattice.

Vocabulary: the pieces of an existing file, whose scores give prior piece
probabilities. Training: piece probabilities are re-weighted once by their
expected counts over the distinct words of the training texts, and every word
seen in training is one more arc of the lattice, from one word end to the
next, weighted by its count. A token's probability is therefore

    q(word) = (1 - novel) * c / N + novel * sum over segmentations of prod p(piece)

with ``novel`` the Good-Turing share of unseen words, and a text's is the product
over its words and its end. Segmentations do not cross words, so each distinct
word is summed once, however often it occurs.

Plan: one pass counts words, one scores. Words of a count above a threshold
are broadcast (at most ``HOT_WORDS`` of at most ``HOT_BYTES`` bytes); the others of a
text are joined to their marginals by a shuffle on the word.

Defined cases: NULL and empty texts are the end token alone; a NULL doc_id
hashes as the empty text; repeated rows are counted and scored each; without
training rows half of the weight is the end's; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_crc, staged
from .subword_lattice import Lattice, read_pieces

HOT_WORDS, HOT_BYTES = 150_000, 32
PRIOR_WEIGHT = 1000.0
END = b""  # the end token: no word is empty


def tokens(text: str | None) -> list[bytes]:
    """Words, A-Z lower-cased, parted by ASCII white space."""
    return (text or "").encode().lower().split()


def word_counts(docs: DataFrame, held: str) -> DataFrame:
    """``word, c``: occurrences in training texts of every word of any text, and of the end token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: Counter = Counter()
            other: set[bytes] = set()
            for t, out in zip(b.column(0), b.column(1).to_pylist()):
                w = tokens(t.as_py())
                if out:
                    other.update(w)
                else:
                    seen.update(w)
                    seen[END] += 1
            words = list(seen) + [w for w in other if w not in seen]
            n = list(seen.values()) + [0] * (len(words) - len(seen))
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(n, pa.int64())], names=["word", "n"])

    found = docs.select(F.col("text").cast("string"), F.col(held)).mapInArrow(run, "word binary, n long")
    return found.groupBy("word").agg(F.sum("n").alias("c"))


def fit_pieces(types: DataFrame, prior: dict[bytes, float]) -> Lattice:
    """Piece probabilities after one step of expected counts over the distinct training words."""
    shared = types.sparkSession.sparkContext.broadcast(prior)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(shared.value)
        total = np.zeros(len(lattice.pieces))
        for b in batches:
            total += lattice.expected_counts(b.column(0).to_pylist())
        k = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(total[k])], names=["k", "n"])

    start = Lattice(prior)
    counts = types.filter(F.col("c") > 0).filter(F.length("word") > 0).select("word").mapInArrow(run, "k long, n double")
    got = np.zeros(len(start.pieces))
    for k, n in counts.groupBy("k").agg(F.sum("n")).toLocalIterator():
        got[k] = n
    p = got + PRIOR_WEIGHT * np.array([prior[s] for s in start.pieces])
    return Lattice(dict(zip(start.pieces, (p / p.sum()).tolist())))


class WordModel:
    """Log10 probabilities of distinct words: the base's and the model's."""

    def __init__(self, lattice: Lattice, n: int, v: int, n1: int):
        self.lattice, self.n, self.v = lattice, n, v
        self.novel = max(n1, 1) / (n + 1) if n else 0.5

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 1) / (self.n + self.v + 1))

    def model(self, words: list[bytes], c: np.ndarray) -> np.ndarray:
        ends = np.fromiter((len(w) == 0 for w in words), bool, len(words))
        sub = np.full(len(words), -np.inf)
        at = np.flatnonzero(~ends)
        if len(at):
            sub[at] = self.lattice.log_marginals([words[i] for i in at.tolist()]) + math.log(self.novel)
        with np.errstate(divide="ignore"):
            seen = np.log((1 - self.novel) * c / self.n) if self.n else np.where(ends, math.log(0.5), -np.inf)
        return np.logaddexp(seen, sub) / math.log(10)


def _hot_threshold(types: DataFrame, most: int) -> float:
    """Count above which at most ``most`` words lie, to an eighth of an octave."""
    bins = (types.filter((F.col("c") > 0) & (F.length("word") <= HOT_BYTES))
            .groupBy(F.floor(F.log2("c") * 8).alias("b")).count().orderBy(F.desc("b")).collect())
    total, last = 0, math.inf
    for b, n in bins:
        total += n
        if total > most:
            break
        last = b
    return last


def score_texts(docs: DataFrame, pieces_path: str, held_mod: int = 7, held: int = 2, hot_words: int = HOT_WORDS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row of ``docs``."""
    spark = docs.sparkSession
    src = docs.select("doc_id", F.col("text").cast("string").alias("text"),
                      (id_crc("doc_id") % held_mod == held).alias("held_out"))
    types = staged(word_counts(src, "held_out"), "lm-types")
    n, v, n1 = types.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0), F.count_if(F.col("c") == 1)).first()
    lattice = fit_pieces(types, read_pieces(pieces_path))
    model = spark.sparkContext.broadcast(WordModel(lattice, n, v, n1))

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c = b.column(1).to_numpy().astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(model.value.base(c)), pa.array(model.value.model(b.column(0).to_pylist(), c)),
                 pa.array((c > 0).astype(np.int64))], names=["word", "base", "model", "known"])

    rated = staged(types.mapInArrow(rate, "word binary, base double, model double, known long"), "lm-words")
    limit = _hot_threshold(types, hot_words)
    hot_types = types.filter((F.length("word") == 0) | ((F.length("word") <= HOT_BYTES) & (F.floor(F.log2("c") * 8) >= limit)
                                                        & (F.col("c") > 0)))
    top = rated.join(hot_types.select("word"), "word", "left_semi").toArrow()
    table = spark.sparkContext.broadcast((
        {w: i for i, w in enumerate(top.column("word").to_pylist())},
        np.stack([top.column(x).to_numpy().astype(np.float64) for x in ("base", "model", "known")], axis=1)))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A summary row for each text, and a row for each of its distinct words that are not broadcast."""
        at, value = table.value
        for b in batches:
            rows: list[list] = [[], [], [], [], [], [], [], [], []]
            row, doc, out, word, tf, n_tok, known, base, mod = rows
            for rid, d, t, h in zip(*(c.to_pylist() for c in b.columns)):
                seen = Counter(tokens(t))
                seen[END] = 1
                pairs = [(at[w], k) for w, k in seen.items() if w in at]
                idx, k = (np.array(x) for x in zip(*pairs)) if pairs else (np.zeros(0, int), np.zeros(0))
                s = k @ value[idx]
                row.append(rid), doc.append(d), out.append(h), word.append(None), tf.append(None)
                n_tok.append(seen.total()), known.append(int(s[2])), base.append(float(s[0])), mod.append(float(s[1]))
                for w, k in seen.items():
                    if w not in at:
                        row.append(rid), word.append(w), tf.append(k)
                        for x in (doc, out, n_tok, known, base, mod):
                            x.append(None)
            kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(rows, kinds)], names=_SPLIT_NAMES)

    numbered = src.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "text", "held_out")
    parts = staged(numbered.mapInArrow(split, _SPLIT), "lm-parts")
    rare = (parts.filter("word IS NOT NULL").select("row", "word", "tf").join(rated, "word")
            .select("row", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("boolean").alias("held_out"),
                    F.lit(None).cast("long").alias("n_tokens"), (F.col("tf") * F.col("known")).alias("known"),
                    (F.col("tf") * F.col("base")).alias("base"), (F.col("tf") * F.col("model")).alias("model")))
    whole = parts.filter("word IS NULL").select(rare.columns)
    return (whole.unionByName(rare).groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.max("n_tokens").alias("n_tokens"),
        F.sum("known").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        F.sum("base").alias("base_score"), F.sum("model").alias("score")).drop("row"))


_SPLIT = ("row long, doc_id long, held_out boolean, word binary, tf long, n_tokens long, known long, "
          "base double, model double")
_SPLIT_NAMES = [c.split()[0] for c in _SPLIT.split(", ")]
