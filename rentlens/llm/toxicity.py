"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word's vector is the mean of its hashed character n-gram vectors (with the
word's boundaries) and of the vector of the whole word, so a misspelling
shares most of its vectors with the word it stands for. Word vectors are
averaged over short windows of words, and a linear softmax reads the average;
embeddings and softmax are trained jointly, in numpy, on the whole sample. A
document scores as its worst window, so one insult in a long text counts, and
training sends a labelled document's gradient to its worst windows.

After training, softmax and embeddings fold into one number per n-gram
bucket, so scoring is a narrow vectorised pass: every byte of every text is
hashed once per n-gram length.

Only fitting is bounded: at most ``MAX_TOXIC + MAX_CLEAN`` labelled texts, and
for the search for hard clean windows at most ``POOL`` clean ones, the first by a
hash of the id among those that have a text. Of a text longer than ``MAX_CHARS``
(``POOL_CHARS`` in the search) passages of ``PASSAGE`` characters, chosen by a hash,
stand for the whole; as they may miss what made it toxic, a toxic text weighs by
the share of it that was chosen.

Defined cases: NULL texts and texts without words get the score of an empty
bag (the softmax bias); repeated rows score alike; a NULL label or one without a
document is not learned from; without labelled rows of both kinds all scores
are the share of toxic labels (0 without labels). Extra columns are not read;
carried ones may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import carried, given_back, id_crc

NGRAMS = (3, 4, 5)
BUCKET_BITS = 17
DIM = 4
WINDOW = 2
STRIDE = 1
EPOCHS = 60
MAX_TOXIC, MAX_CLEAN, MAX_CHARS = 900, 1600, 4_000
POOL, POOL_CHARS = 4000, 12_000
PASSAGE = 500
# Weight of all hard windows, where the sample's texts weigh one.
HARD_WEIGHT = 0.1
# How fast and how far a document's gradient moves to its worst windows.
SHARPEN, SHARPEST = 0.05, 2.5
# Length of a step of embeddings, softmax and bias.
RATES = (30.0, 0.2, 0.2)
PIECE = 1 << 20

_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_P32, _MIX32 = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B)
_P = 0x9E3779B97F4A7C15
_INV = pow(_P, -1, 1 << 64)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the word hash's base and of its inverse, kept for later calls."""
    if not _POWERS or len(_POWERS[0]) < n:
        _POWERS[:] = [np.cumprod(np.full(max(n, 1 << 16), x, np.uint64), dtype=np.uint64) for x in (_P, _INV)]
    return _POWERS


def clean_bytes(text: str | None) -> bytes:
    """Lower-cased bytes, words parted by single spaces, a space at both ends."""
    return b" " + b" ".join((text or "").encode().translate(_TABLE).split()) + b" "


def features(buf: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram length, and then the whole words: (word index, bucket) of every feature.

    ``buf`` comes from :func:`clean_bytes`; n-grams may take in the space on
    either side of their word, but no space inside.
    """
    b = np.frombuffer(buf, np.uint8)
    space = b == 32
    word = np.cumsum(space, dtype=np.int32) - 1  # at a space: index of the word behind it
    v = b.astype(np.uint32)
    h = v
    for n in range(2, max(NGRAMS) + 1):
        if len(b) < n:
            break
        h = h[:len(b) - n + 1] * _P32 + v[n - 1:]
        if n in NGRAMS:
            # No space from the second to the last but one character.
            inner = np.flatnonzero(word[n - 2:len(b) - 1] == word[:len(b) - n + 1])
            g = (h[inner] ^ np.uint32(n)) * _MIX32
            yield word[inner], ((g ^ (g >> np.uint32(15))) * _P32 >> np.uint32(32 - BUCKET_BITS)).astype(np.int32)
    at = np.flatnonzero(space)
    start, end = at[:-1] + 1, at[1:]
    if len(start):
        power, back = _powers(len(b))
        total = np.cumsum(power[:len(b)] * (b + np.uint64(1)), dtype=np.uint64)
        whole = (total[end - 1] - total[start - 1]) * back[start] * _MIX
        yield np.arange(len(start)), (whole >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)


def _feature_counts(buf: bytes) -> np.ndarray:
    """Features of each word: its n-grams with boundaries, and itself."""
    length = np.diff(np.flatnonzero(np.frombuffer(buf, np.uint8) == 32)) - 1
    return 1 + sum(np.maximum(0, length + 3 - n) for n in NGRAMS)


def _pieces(buf: bytes) -> Iterator[bytes]:
    """A long buffer in parts that begin and end at spaces."""
    at = 0
    while len(buf) - at > PIECE:
        cut = buf.find(b" ", at + PIECE - 1)
        if cut < 0 or cut == len(buf) - 1:
            break
        yield buf[at:cut + 1]
        at = cut
    yield buf[at:]


def word_scores(buf: bytes, weights: np.ndarray) -> np.ndarray:
    """Mean weight of each word's features."""
    out = []
    for p in _pieces(buf):
        if len(p) < 3:
            continue
        c = _feature_counts(p)
        s = np.zeros(len(c))
        for w, f in features(p):
            s += np.bincount(w, weights[f], len(c))
        out.append(s / c)
    return np.concatenate(out) if out else np.zeros(0)


def window_starts(n: int) -> np.ndarray:
    """Windows of WINDOW words every STRIDE words that cover all n words."""
    return np.arange(0, max(1, n - WINDOW + STRIDE), STRIDE) if n else np.zeros(0, np.int64)


def window_means(scores: np.ndarray) -> np.ndarray:
    starts = window_starts(len(scores))
    cum = np.concatenate(([0.0], np.cumsum(scores)))
    ends = np.minimum(starts + WINDOW, len(scores))
    return (cum[ends] - cum[starts]) / np.maximum(ends - starts, 1)


def train(texts: list[str], toxic: list[int], pool: list[str] = (), share: float | None = None,
          epochs: int = EPOCHS, seed: int = 7, seen: list[float] | None = None) -> tuple[np.ndarray, float]:
    """Fit embeddings and softmax jointly; returns each bucket's logit weight and the bias.

    ``pool`` holds further clean texts: halfway, the windows among them that
    score worst join the clean side. ``share`` is the share of toxic texts
    where the model is used; the bias is corrected from one half to it, and
    without texts of both kinds it is every text's score. ``seen`` is the share
    of each text that is given (default 1).
    """
    full = [i for i, t in enumerate(texts) if len(clean_bytes(t)) > 2]
    texts, y = [texts[i] for i in full], np.asarray(toxic, np.float64)
    part = np.ones(len(y)) if seen is None else np.asarray(seen, np.float64)
    mean = (float(y.mean()) if len(y) else 0.0) if share is None else share
    y, part = y[full], part[full]
    if len(y) == 0 or y.min() == y.max():
        p = float(np.clip(mean, 1e-6, 1 - 1e-6))
        return np.zeros(1 << BUCKET_BITS, np.float32), float(np.log(p / (1 - p)))
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.02, (1 << BUCKET_BITS, DIM)).astype(np.float32)
    soft = rng.normal(0, 0.5, (DIM, 2)).astype(np.float32)
    bias = np.array([0.0, -2.0], np.float32)
    params = (emb, soft, bias)
    state = [np.zeros_like(p) for p in params]
    half = epochs // 2
    weight = np.where(y == 1, 0.5 * part / part[y == 1].sum(), 0.5 / (len(y) - y.sum()))  # both kinds weigh the same
    _fit(params, state, texts, y, weight, range(1, half + 1), epochs)
    hard = _worst_windows(pool, _fold(params))
    weight = np.concatenate((weight, np.full(len(hard), HARD_WEIGHT / max(1, len(hard)))))
    _fit(params, state, [*texts, *hard], np.concatenate((y, np.zeros(len(hard)))), weight, range(half + 1, epochs + 1), epochs)
    weights, b = _fold(params)
    if share is not None and 0 < share < 1:
        b += float(np.log(share / (1 - share)))
    return weights, b


def _fold(params) -> tuple[np.ndarray, float]:
    emb, soft, bias = params
    return (emb @ (soft[:, 1] - soft[:, 0])).astype(np.float32), float(bias[1] - bias[0])


def _worst_windows(pool: list[str], model: tuple[np.ndarray, float], most: int = 4, above: float = -4.0) -> list[str]:
    """Words of the windows of ``pool`` that look toxic, at most ``most`` of each text."""
    weights, bias = model
    out = []
    for t in pool:
        buf = clean_bytes(t)
        z = window_means(word_scores(buf, weights)) + bias
        words = buf.split()
        for i in np.argsort(-z, kind="stable")[:most].tolist():
            if z[i] > above:
                out.append(b" ".join(words[i * STRIDE:i * STRIDE + WINDOW]).decode())
    return out


def _fit(params, state, texts: list[str], y: np.ndarray, weight: np.ndarray, steps: range, total: int) -> None:
    """Steps on all texts at once; ``params`` and ``state`` change in place."""
    emb, soft, bias = params
    # Words of the sample, each once, with their features.
    index: dict[bytes, int] = {}
    bags = [np.array([index.setdefault(w, len(index)) for w in clean_bytes(t).split()], np.int32) for t in texts]
    vocab = b" " + b" ".join(index) + b" "
    fw, fb = (np.concatenate(x) for x in zip(*features(vocab)))
    order = np.argsort(fw, kind="stable")
    fw, fb = fw[order].astype(np.int32), fb[order].astype(np.int32)
    count = np.bincount(fw, minlength=len(index)).astype(np.float32)
    word_at = np.concatenate(([0], np.cumsum(count)[:-1])).astype(np.int64)
    # Windows over all texts: words flat[s:e], owner document.
    keep = [i for i, b in enumerate(bags) if len(b)]
    flat = np.concatenate([bags[i] for i in keep])
    y, weight, base, starts, ends, owner = y[keep], weight[keep], 0, [], [], []
    for k, i in enumerate(keep):
        s = window_starts(len(bags[i]))
        starts.append(s + base)
        ends.append(np.minimum(s + WINDOW, len(bags[i])) + base)
        owner.append(np.full(len(s), k))
        base += len(bags[i])
    starts, ends, owner = (np.concatenate(x) for x in (starts, ends, owner))
    lengths = (ends - starts).astype(np.float32)
    first = np.searchsorted(owner, np.arange(len(keep)))

    for t in steps:
        vec = np.stack([np.add.reduceat(emb[:, d][fb], word_at) for d in range(DIM)], axis=1) / count[:, None]
        mean = np.empty((len(starts), DIM), np.float32)
        for d in range(DIM):  # one dimension at a time: the sample's words several times over are most of the driver's memory
            cum = np.concatenate(([0.0], np.cumsum(vec[flat, d], dtype=np.float64)))
            mean[:, d] = (cum[ends] - cum[starts]) / lengths
        logit = mean @ soft + bias
        z = (logit[:, 1] - logit[:, 0]).astype(np.float64)
        # A document's gradient is shared among its windows by a softmax that sharpens.
        sharp = min(SHARPEST, SHARPEN * t)
        top = np.maximum.reduceat(z, first)
        share = np.exp(np.clip(sharp * (z - top[owner]), -50, 0))
        share /= np.add.reduceat(share, first)[owner]
        g = ((1 / (1 + np.exp(-np.clip(z, -50, 50))) - y[owner]) * share * weight[owner]).astype(np.float32)
        gl = np.stack([-g, g], axis=1)
        grads_soft, grads_bias = mean.T @ gl, gl.sum(axis=0)
        gm = (gl @ soft.T) / lengths[:, None]
        # Windows hand their gradient to their words by differences, words to buckets.
        grad_emb = np.empty_like(emb)
        for d in range(DIM):
            diff = np.bincount(starts, gm[:, d], len(flat) + 1) - np.bincount(ends, gm[:, d], len(flat) + 1)
            gw = np.bincount(flat, np.cumsum(diff[:-1]), len(index)) / count
            grad_emb[:, d] = np.bincount(fb, gw[fw], 1 << BUCKET_BITS)
        # Momentum with steps of a set length per parameter: unlike a step scaled for
        # each bucket, it moves a word by how many documents speak for it.
        pace = 1 - 0.9 * (t - 1) / total
        for p, grad, m, rate in zip(params, (grad_emb, grads_soft, grads_bias), state, RATES):
            m *= 0.8
            m += grad
            p -= rate * pace * m / (np.linalg.norm(m) + 1e-12)


def passages(text: Column, seed: Column, chars: int) -> Column:
    """``text`` itself up to ``chars`` characters, else hash-chosen passages of it, about ``chars`` together."""
    places = F.sequence(F.lit(0), F.ceil(F.length(text) / PASSAGE).cast("int") - 1)
    drawn = F.slice(F.array_sort(F.transform(places, lambda i: F.struct(F.xxhash64(seed, i).alias("h"), i.alias("i")))),
                    1, chars // PASSAGE)
    parts = F.transform(F.array_sort(F.transform(drawn, lambda d: d["i"])), lambda i: F.substring(
        text, F.least(i * PASSAGE, F.length(text) - PASSAGE) + 1, F.lit(PASSAGE)))
    # Words cut at a passage's ends are left out.
    whole = F.transform(parts, lambda p: F.regexp_replace(p, r"^\S+(?=\s)|(?<=\s)\S+$", ""))
    return F.when(F.length(text) <= chars, text).otherwise(F.array_join(whole, " "))


def training_rows(docs: DataFrame, labels: DataFrame, held_mod: int = 4, held: int = 2) -> dict:
    """The bounded sample for :func:`train`: labelled texts outside the held-out rest, by hash order.

    It is drawn from the labelled ids that have a text, each text once; only ids and
    text hashes are shuffled for that. The chosen ids (at most ``MAX_TOXIC + POOL``)
    are broadcast to fetch the texts, so no text is shuffled.
    """
    seen = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").filter(id_crc("doc_id") % held_mod != held)
    seen = seen.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = seen.agg(F.avg("toxic")).first()[0]
    text = F.col("text").cast("string")
    src = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("t")).filter(F.length("text") > 0)
    order = F.xxhash64("doc_id").alias("h")
    # A text that several documents repeat counts for the first of them, as toxic if any is.
    drawn = (src.select("doc_id", "t").distinct().join(seen, "doc_id").select("t", "toxic", F.struct(order, "doc_id").alias("o"))
             .groupBy("t").agg(F.min("o").alias("o"), F.max("toxic").alias("toxic")).select("o.h", "o.doc_id", "t", "toxic"))
    ids = drawn.filter("toxic = 1").orderBy("h", "doc_id", "t").limit(MAX_TOXIC).unionByName(
        drawn.filter("toxic = 0").orderBy("h", "doc_id", "t").limit(POOL))
    rows = src.join(F.broadcast(ids), ["doc_id", "t"]).select(
        "h", "doc_id", "t", "toxic", F.length("text").alias("n"), passages(F.col("text"), F.col("t"), MAX_CHARS).alias("fit"),
        F.when(F.col("toxic") == 0, passages(F.col("text"), F.col("t"), POOL_CHARS)).alias("pool"))
    # A row that is repeated comes once, so the driver holds the sample and no more.
    found = rows.dropDuplicates(["doc_id", "t"]).toArrow().sort_by([(c, "ascending") for c in ("h", "doc_id", "t")])
    toxic, clean = (found.filter(pc.field("toxic") == label) for label in (1, 0))
    used = pa.concat_tables([toxic, clean.slice(0, MAX_CLEAN)])
    texts = used["fit"].to_pylist()
    return {"texts": texts, "toxic": used["toxic"].cast(pa.int64()).to_pylist(), "pool": clean["pool"].to_pylist(),
            "share": share, "seen": [min(1.0, len(t) / n) for t, n in zip(texts, used["n"].to_pylist())]}


def score_documents(docs: DataFrame, model: tuple[np.ndarray, float], carry: list[str], score: str = "score") -> DataFrame:
    """``carry`` columns and the score (0 to 1) of every row's whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    src, kept = carried(docs, carry, "text")
    schema = T.StructType(kept.fields).add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        for b in batches:
            out = np.empty(b.num_rows)
            for i, t in enumerate(b.column(b.num_columns - 1)):
                means = window_means(word_scores(clean_bytes(t.as_py()), weights))
                out[i] = (means.max() if len(means) else 0.0) + bias
            col = pa.array(1 / (1 + np.exp(-np.clip(out, -50, 50))))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], col], names=schema.names)

    return given_back(src.mapInArrow(run, schema), carry, [F.col("score").alias(score)])
