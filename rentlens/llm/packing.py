"""Packing: documents' tokens into sequences of one size, in bounded space.

Each partition keeps a fixed number of open windows. A document's tokens (its
full windows go out at once) are placed whole in the open window they fill
best; when none has room, the fullest is topped up with the head of the
tokens, which may be cut freely, and emitted full, and its place is opened
anew. What is still open at the end of a partition goes on as leftovers: they
are packed again over ever fewer partitions, until one task closes the last
few windows.

The first pass is written to the shared checkpoint folder, since its full
sequences and its leftovers are read apart. A leftover carries its token ids
(never more than the open windows of its partition), so any piece's checksum
can be taken after a cut.

Defined cases: NULL and empty texts are the end token alone; repeated rows
are packed each; an empty table gives no pieces. Extra columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

SIZE = 2048
OPEN_WINDOWS = 16
# Partitions whose leftovers meet in one task of the next round.
FAN_IN = 32
_ID = 4  # bytes of a token id, little endian


class _Cache(dict):
    """What ``make`` gives for a key, kept for the last ``most()`` to twice as many keys."""

    def __init__(self, make: Callable, most: Callable[[], int]):
        self.make, self.most = make, most
        self.older: dict = {}

    def __missing__(self, key):
        got = self.older.get(key)
        if got is None:
            got = self.make(key)
        if len(self) >= self.most():
            self.older = dict(self)
            self.clear()
        self[key] = got
        return got


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordTokenizer:
    """Token ids of texts, by way of a bounded cache of words.

    The tokenizer never joins characters across ASCII white space, so a text's
    ids are its words' ids in a row. Plain words (Latin-1 letters, then
    maybe punctuation) and printable ASCII are cut as its pre-tokenizer would
    and only the parts go through the model; every other word, and one with an
    apostrophe or a token of its own in it, goes through the whole tokenizer.
    """

    WORDS = 60_000  # words and letter runs that are cached at least, each; at most twice as many

    def __init__(self, path: str):
        import os
        import re

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        self.plain = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)").fullmatch
        self.ascii = re.compile(b"[!-&(-~]+").fullmatch
        self.parts = re.compile(b"[a-z]+|[0-9]|[^a-z0-9]+").findall
        self.special = [t.content.encode() for t in self.tok.get_added_tokens_decoder().values()]
        # Byte-level alphabet: printable Latin-1 stands for itself, the rest moves up.
        keep = {*range(33, 127), *range(161, 173), *range(174, 256)}
        rest = iter(range(256, 512))
        self.alphabet = {b: b if b in keep else next(rest) for b in range(256)}
        self.runs = _Cache(self._run, lambda: self.WORDS)
        self.words = _Cache(self._word, lambda: self.WORDS)

    def _run(self, run: bytes) -> bytes:
        # Letters and punctuation of ASCII stand for themselves.
        mapped = run.decode() if run.isascii() else run.decode("latin-1").translate(self.alphabet)
        return _packed([t.id for t in self.model.tokenize(mapped)])

    def _word(self, word: bytes) -> bytes:
        letters = word.rstrip(b".,;:!?")
        if letters.isalpha():  # of ASCII
            run, marks = letters.lower(), word[len(letters):]
        elif self.ascii(word) and not any(t in word for t in self.special):
            return b"".join([self.runs[part] for part in self.parts(word.lower())])
        else:
            m = self.plain(word.decode())
            if m is None:
                return _packed(self.tok.encode(word.decode(), add_special_tokens=False).ids)
            run, marks = m[1].lower().encode(), m[2].encode()
        return self.runs[run] + self.runs[marks] if marks else self.runs[run]

    def ids(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian 32-bit numbers."""
        return b"".join(map(self.words.__getitem__, (text or "").encode().split()))


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """One tokenizer per worker process and path."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


class Packer:
    """Bounded-space best-fit over open windows of ``size`` tokens.

    Pieces are ``(doc_id, start, total, ids)``; ``put`` yields the full
    sequences that placing them closes.
    """

    def __init__(self, size: int = SIZE, open_windows: int = OPEN_WINDOWS):
        self.size, self.most = size, open_windows
        self.fills: list[tuple[int, int]] = []  # (tokens held, window), sorted
        self.open: dict[int, list] = {}
        self.made = 0

    def _piece(self, p, at: int, n: int):
        doc, start, total, ids = p
        return doc, start + at, total, ids[at * _ID:(at + n) * _ID]

    def put(self, piece) -> Iterator[list]:
        size, at, left = self.size, 0, len(piece[3]) // _ID
        while left >= size:  # whole windows need no room
            yield [self._piece(piece, at, size)]
            at, left = at + size, left - size
        while left:
            # Best fit: the fullest window that takes all that is left.
            i = bisect_left(self.fills, (size - left + 1, -1)) - 1
            if i < 0 and len(self.fills) < self.most:
                self.open[self.made] = []
                insort(self.fills, (0, self.made))
                self.made += 1
                continue
            if i >= 0:
                held, w = self.fills.pop(i)
                n = left
            else:  # none fits: the fullest is topped up and goes
                held, w = self.fills.pop()
                n = size - held
            self.open[w].append(self._piece(piece, at, n))
            at, left = at + n, left - n
            if held + n == size:
                yield self.open.pop(w)
            else:
                insort(self.fills, (held + n, w))

    def rest(self) -> Iterator[list]:
        """What is still open, fullest first."""
        for _, w in reversed(self.fills):
            yield self.open.pop(w)
        self.fills = []


_OUT = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
        "ids binary, part int, seq long")
_NAMES = [c.split()[0] for c in _OUT.split(", ")]
_TYPES = [pa.int64()] * 7 + [pa.binary(), pa.int32(), pa.int64()]


def _rows(sequences: Iterator[tuple[int | None, list]], part: int) -> Iterator[pa.RecordBatch]:
    """Pieces as batches. Closed sequences have an id and no token ids, leftovers the reverse."""
    rows: list[tuple] = []
    for sid, pieces in sequences:
        offset = 0
        for k, (doc, start, total, ids) in enumerate(pieces):
            n = len(ids) // _ID
            rows.append((doc, start, n, zlib.crc32(ids), total, sid, offset, ids if sid is None else None, part, k))
            offset += n
        if len(rows) >= 4096:
            yield _batch(rows)
            rows = []
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=_NAMES)


def _pack(pieces: Iterator[tuple], part: int, level: int, size: int, open_windows: int, last: bool) -> Iterator[pa.RecordBatch]:
    packer = Packer(size, open_windows)
    # Level, partition and count make an id that no other task gives.
    first = (level << 58) | (part << 28)

    def sequences():
        n = 0
        for p in pieces:
            for seq in packer.put(p):
                yield first + n, seq
                n += 1
        for seq in packer.rest():
            yield (first + n if last else None), seq
            n += 1

    yield from _rows(sequences(), part)


def pack_documents(docs: DataFrame, tokenizer_path: str, size: int = SIZE, open_windows: int = OPEN_WINDOWS,
                   end_id: int = 1, fan_in: int = FAN_IN) -> DataFrame:
    """Pieces ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` of ``docs(doc_id, text)``."""
    end = np.array([end_id], "<u4").tobytes()

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tok = tokenizer(tokenizer_path)

        def pieces():
            for b in batches:
                for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                    ids = tok.ids(text.as_py()) + end
                    yield doc, 0, len(ids) // _ID, ids

        yield from _pack(pieces(), TaskContext.get().partitionId(), 0, size, open_windows, last=False)

    src = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    packed = staged(src.mapInArrow(first_pass, _OUT), "packing")
    closed = [packed.filter("sequence_id IS NOT NULL")]
    open_ = packed.filter("sequence_id IS NULL")
    most = open_.agg(F.max("part")).first()[0]
    level = 0
    while most is not None:
        level += 1
        most = most // fan_in
        merged = staged(_merge(open_, level, fan_in, most == 0, size, open_windows), f"packing-merge{level}")
        closed.append(merged.filter("sequence_id IS NOT NULL"))
        if most == 0:
            break
        open_ = merged.filter("sequence_id IS NULL")
    out = closed[0]
    for c in closed[1:]:
        out = out.unionByName(c)
    return out.select(*_NAMES[:7])


def _merge(open_: DataFrame, level: int, fan_in: int, last: bool, size: int, open_windows: int) -> DataFrame:
    """Leftovers of ``fan_in`` partitions packed together."""

    def run(key: tuple[pa.Scalar, ...], groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = key[0].as_py()

        def pieces():
            for b in groups:
                d = b.to_pydict()
                yield from zip(d["doc_id"], d["start"], d["doc_tokens"], d["ids"])

        yield from _pack(pieces(), part, level, size, open_windows, last)

    grouped = open_.withColumn("group", F.floor(F.col("part") / fan_in).cast("int"))
    return grouped.groupBy("group").applyInArrow(run, _OUT)
