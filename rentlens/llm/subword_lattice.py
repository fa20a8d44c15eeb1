"""Unigram lattice over an existing piece vocabulary: marginals and expected piece counts of words.

A word is read as a space and its bytes. Every way to cut it into pieces is a
path; the log-space forward recursion sums the paths' weights. Words of one
length are computed together, column by column.
"""

from __future__ import annotations

import math

import numpy as np

_P = 0x9E3779B97F4A7C15
_TOGETHER = 64  # words of up to this many bytes are computed by length, longer ones one by one; no piece is longer
_ROWS = 8192


def read_pieces(path: str) -> dict[bytes, float]:
    """Surface -> prior probability, from a sentencepiece file's piece scores.

    The scores of the file order its pieces; a piece's weight follows Zipf's law
    in that order. Byte pieces make every text readable and take the last ranks.
    """
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ranked: list[tuple[float, bytes]] = []
    for i in range(sp.get_piece_size()):
        if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i):
            continue
        surface = sp.id_to_piece(i).replace("▁", " ").encode()
        if b" " not in surface[1:]:  # paths do not cross words, so such a piece is on none
            ranked.append((-sp.get_score(i), surface))
    ranked.sort()
    order = [s for _, s in ranked] + [bytes([b]) for b in range(256)]
    weights: dict[bytes, float] = {}
    for r, s in enumerate(order):
        weights[s] = weights.get(s, 0.0) + 1.0 / (r + 10)
    total = sum(weights.values())
    return {s: w / total for s, w in weights.items()}


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


_UP = np.cumprod(np.full(_TOGETHER + 2, _P, np.uint64), dtype=np.uint64)
_DOWN = np.cumprod(np.full(_TOGETHER + 2, pow(_P, -1, 1 << 64), np.uint64), dtype=np.uint64)


def _hash(s: bytes) -> int:
    b = np.frombuffer(s, np.uint8).astype(np.uint64) + np.uint64(1)
    h = (b * _UP[:len(b)]).sum(dtype=np.uint64, keepdims=True) * _DOWN[0]
    return int(_mix(h)[0])


class Lattice:
    """Pieces with log probabilities."""

    def __init__(self, probability: dict[bytes, float]):
        self.pieces = sorted(probability)
        self.logp = np.array([math.log(probability[s]) for s in self.pieces])
        keys = np.array([_hash(s) for s in self.pieces], np.uint64)
        order = np.argsort(keys)
        self.keys = keys[order]
        # Behind the last key: a piece that is none.
        self.ids = np.concatenate((order, [len(self.pieces)]))
        self.keys = np.concatenate((self.keys, [np.uint64(0)]))
        self.logs = np.concatenate((self.logp, [-np.inf]))
        self.longest = max(map(len, self.pieces))
        self.at = {s: i for i, s in enumerate(self.pieces)}

    def _columns(self, words: list[bytes]) -> list[list[tuple[int, np.ndarray]]]:
        """Pieces of equally long words that end at each byte: (where they start, piece or none)."""
        raw = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)
        n = raw.shape[1] + 1
        b = np.empty((n, len(words)), np.uint64)
        b[0], b[1:] = 33, raw.T.astype(np.uint64) + np.uint64(1)  # the space in front
        c = np.concatenate((np.zeros((1, len(words)), np.uint64), np.cumsum(b * _UP[:n, None], axis=0, dtype=np.uint64)))
        out = []
        for j in range(1, n + 1):
            col = []
            for i in range(max(0, j - self.longest), j):
                h = _mix((c[j] - c[i]) * _DOWN[i])
                k = np.searchsorted(self.keys[:-1], h)
                col.append((i, np.where(self.keys[k] == h, self.ids[k], len(self.pieces))))
            out.append(col)
        return out

    def _forward(self, columns, m: int) -> np.ndarray:
        a = np.full((len(columns) + 1, m), -np.inf)
        a[0] = 0
        for j, col in enumerate(columns, 1):
            paths = np.stack([a[i] + self.logs[k] for i, k in col])
            a[j] = np.logaddexp.reduce(paths, axis=0)
        return a

    def _by_length(self, words: list[bytes]):
        """Index arrays of words that share a length, short words only."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(size, kind="stable")
        edges = np.flatnonzero(np.diff(size[order])) + 1
        for group in np.split(order, edges):
            if len(group) and 0 < size[group[0]] < _TOGETHER:
                for s in range(0, len(group), _ROWS):
                    yield group[s:s + _ROWS]

    def _scalar(self, word: bytes) -> tuple[list[float], list[list[tuple[int, int]]]]:
        text = b" " + word
        a, arcs = [0.0], [[]]
        for j in range(1, len(text) + 1):
            found = [(i, self.at[text[i:j]]) for i in range(max(0, j - self.longest), j) if text[i:j] in self.at]
            xs = [a[i] + float(self.logp[k]) for i, k in found]
            top = max(xs)
            a.append(top + math.log(sum(math.exp(x - top) for x in xs)))
            arcs.append(found)
        return a, arcs

    def log_marginals(self, words: list[bytes]) -> np.ndarray:
        """Natural log of each word's probability, over all segmentations."""
        out = np.empty(len(words))
        for group in self._by_length(words):
            cols = self._columns([words[i] for i in group])
            out[group] = self._forward(cols, len(group))[-1]
        for i, w in enumerate(words):
            if not 0 < len(w) < _TOGETHER:
                out[i] = self._scalar(w)[0][-1]
        return out

    def expected_counts(self, words: list[bytes]) -> np.ndarray:
        """Sum over the words of each piece's expected number of uses."""
        total = np.zeros(len(self.pieces) + 1)
        for group in self._by_length(words):
            m = len(group)
            cols = self._columns([words[i] for i in group])
            a = self._forward(cols, m)
            back = np.full_like(a, -np.inf)
            back[-1] = 0
            for j in range(len(cols), 0, -1):
                for i, k in cols[j - 1]:
                    step = self.logs[k] + back[j]
                    total += np.bincount(k, np.exp(a[i] + step - a[-1]), len(total))
                    back[i] = np.logaddexp(back[i], step)
        for w in words:
            if not 0 < len(w) < _TOGETHER:
                a, arcs = self._scalar(w)
                back = [-math.inf] * (len(a) - 1) + [0.0]
                for j in range(len(a) - 1, 0, -1):
                    for i, k in arcs[j]:
                        step = float(self.logp[k]) + back[j]
                        total[k] += math.exp(a[i] + step - a[-1])
                        hi, lo = max(back[i], step), min(back[i], step)
                        back[i] = hi + math.log1p(math.exp(lo - hi)) if lo > -math.inf else hi
        return total[:-1]
