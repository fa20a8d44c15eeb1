"""Token counts of whole texts by a two-tier lookup on the map side.

A byte-level BPE tokenizer cuts a text into pre-tokens and encodes each one by
itself, so a text's count is the sum of its pre-tokens' counts. Two tiers give
those:

- a compact table of frequent pre-tokens and their lengths in tokens, which
  every task gets by broadcast. It holds at most ``FREQUENT`` pre-tokens of at
  most ``ENTRY_BYTES`` bytes, so its size has a bound whatever the corpus;
- for misses, a bounded cache in each Python worker in front of the tokenizer.

Pre-tokens are never shuffled. The table comes from a pass over all texts in
which every task keeps a Misra-Gries summary (any pre-token with more than one
in ``FREQUENT`` of all occurrences is in it); a task's summary is one row, and
summaries merge ``FAN_IN`` at a time. The table decides speed only: a count is
the same whichever tier gives it.

Pre-tokens are cut by a regular expression where all characters are below
U+0250, whose classes are known to be the tokenizer's. Text with others is cut
where white space follows a character that is surely none, and the parts with
such characters go to the tokenizer whole.

Defined cases: NULL and empty texts have no bytes and no tokens; special tokens
written in a text are one token each (the tokenizer's default) unless
``plain_specials``; a text is never cut off, however long; repeated rows are
counted each; an empty table gives no rows. Only ``carry`` and the text column
are read, so other columns may have any name; a carried column with the name
of a result column gives way to the result.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import carried, column, given_back, staged

FREQUENT = 16384
ENTRY_BYTES = 48
# Summaries that meet in one task of the next round.
FAN_IN = 16
CACHED = 300_000  # misses kept by a worker; cleared when full
CACHED_CHARS = 256

_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_NUMBER = "0-9²³¹¼-¾"
_SPACE = "\t-\r \x85\xa0"
_PRE_TOKENS = re.compile(
    f" ?[{_LETTER}]+|'(?:[stmd]|re|ve|ll)| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+"
    f"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+").findall
_OTHER = re.compile("[\x1c-\x1fɐ-\U0010ffff]").search
# White space, or taken for it by some tables: no cut behind these.
_DOUBTFUL = "".join(map(chr, (*range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x2010), *range(0x2028, 0x2030),
                              *range(0x205F, 0x2070), 0x3000, 0xFEFF)))
_PARTS = re.compile(f"[\t-\r ]*[^\t-\r ]*(?:(?<=[{_DOUBTFUL}])[\t-\r ]+[^\t-\r ]*)*").findall


def pre_tokens(text: str) -> tuple[list[str], list[str]]:
    """Pre-tokens of ``text``, and the parts that only the tokenizer can cut."""
    if _OTHER(text) is None:
        return _PRE_TOKENS(text), []
    cut, rest = [], []
    for part in _PARTS(text):
        if _OTHER(part) is None:
            cut += _PRE_TOKENS(part)
        else:
            rest.append(part)
    return cut, rest


class Summary:
    """Misra-Gries summary of pre-tokens: ``size`` of them, up to four times as many meanwhile."""

    def __init__(self, size: int = FREQUENT):
        self.size, self.counts = size, Counter()

    def add(self, pieces: Iterable[str]) -> None:
        self.counts.update(pieces)
        if len(self.counts) > 4 * self.size:
            self.shrink()

    def merge(self, pieces: list[str], counts: list[int]) -> None:
        self.counts.update(dict(zip(pieces, counts, strict=True)))
        if len(self.counts) > 4 * self.size:
            self.shrink()

    def shrink(self) -> None:
        """Take the largest count left out from all; what has more stays."""
        if len(self.counts) <= self.size:
            return
        values = np.fromiter(self.counts.values(), np.int64, len(self.counts))
        out = int(np.partition(values, -self.size - 1)[-self.size - 1])
        self.counts = Counter({k: n - out for k, n in self.counts.items() if n > out})

    def batch(self, part: int) -> pa.RecordBatch:
        self.shrink()
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([list(self.counts)], pa.list_(pa.string())),
             pa.array([list(self.counts.values())], pa.list_(pa.int64()))], names=["part", "pieces", "counts"])


_SUMMARY = "part int, pieces array<string>, counts array<long>"


def frequent_pre_tokens(docs: DataFrame, text: str = "text", size: int = FREQUENT, fan_in: int = FAN_IN) -> list[str]:
    """At most ``size`` pre-tokens of at most ``ENTRY_BYTES`` bytes, among them every one with more than 1 in ``size`` of all."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        mine = Summary(size)
        for b in batches:
            for t in b.column(0):
                if t := t.as_py():
                    mine.add(pre_tokens(t)[0])
        mine.counts = Counter({k: n for k, n in mine.counts.items() if len(k.encode()) <= ENTRY_BYTES})
        if mine.counts:
            yield mine.batch(TaskContext.get().partitionId())

    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = Summary(size)
        for b in batches:
            for pieces, counts in zip(b.column("pieces"), b.column("counts"), strict=True):
                both.merge(pieces.as_py(), counts.as_py())
        yield both.batch(key[0].as_py())

    cur = staged(docs.select(column(text).cast("string").alias("t")).mapInArrow(summarise, _SUMMARY), "frequent-pre-tokens")
    most = cur.agg(F.max("part")).first()[0]
    while most:
        most //= fan_in
        cur = staged(cur.withColumn("group", F.floor(F.col("part") / fan_in).cast("int"))
                     .groupBy("group").applyInArrow(merge, _SUMMARY), "frequent-pre-tokens")
    row = cur.first()  # one row of at most ``size`` short strings
    return list(row["pieces"]) if row else []


def load_tokenizer(path: str, plain_specials: bool = False):
    """The tokenizer of a .json file, set to neither cut off nor pad."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    tok.encode_special_tokens = plain_specials
    return tok


def _specials(tok) -> list[str]:
    """Special strings; those that ask for more than plain finding are left to the tokenizer's own cutting."""
    return [t.content for t in tok.get_added_tokens_decoder().values()]


class Table:
    """Frequent pre-tokens and their lengths in tokens, packed: one string, its cuts and one byte a length."""

    def __init__(self, pieces: list[str], tok):
        self.text = "".join(pieces)
        self.cuts = np.fromiter(map(len, pieces), np.uint8, len(pieces))
        self.lengths = np.fromiter((len(tok.encode(p, add_special_tokens=False).ids) for p in pieces), np.uint8, len(pieces))

    def unpack(self) -> dict[str, int]:
        ends = np.cumsum(self.cuts, dtype=np.int64)
        return {self.text[e - n:e]: k for e, n, k in
                zip(ends.tolist(), self.cuts.tolist(), self.lengths.tolist(), strict=True)}


class Lengths(dict):
    """Pre-token to its number of tokens: the frequent ones, and misses as they were encoded."""

    def __init__(self, frequent: dict[str, int], tok, cached: int = CACHED):
        super().__init__(frequent)
        self.frequent, self.tok, self.most = frequent, tok, len(frequent) + cached

    def __missing__(self, piece: str) -> int:
        n = len(self.tok.encode(piece, add_special_tokens=False).ids)
        if len(piece) <= CACHED_CHARS:
            if len(self) >= self.most:
                self.clear()
                self.update(self.frequent)
            self[piece] = n
        return n

    def of_plain(self, text: str) -> int:
        cut, rest = pre_tokens(text)
        return sum(map(self.__getitem__, cut)) + sum(map(self.__getitem__, rest))


class TokenCounter:
    """Counts of whole texts by one tokenizer file and one table."""

    def __init__(self, path: str, table: Table | None, plain_specials: bool = False, cached: int = CACHED):
        self.tok = load_tokenizer(path, plain_specials)
        self.lengths = Lengths(table.unpack() if table else {}, self.tok, cached)
        found = [] if plain_specials else _specials(self.tok)
        self.specials = re.compile("|".join(map(re.escape, sorted(found, key=len, reverse=True)))) if found else None

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.specials is None or self.specials.search(text) is None:
            return self.lengths.of_plain(text)
        return sum(map(self.lengths.of_plain, self.specials.split(text))) + len(self.specials.findall(text))


def check_supported(tok) -> None:
    """Refuse tokenizers that this way of counting does not fit."""
    import json

    spec = json.loads(tok.to_str())
    pre, added = spec["pre_tokenizer"] or {}, spec["added_tokens"]
    if (spec["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True)
            or any(t["lstrip"] or t["rstrip"] or t["single_word"] or not t["special"] for t in added)):
        raise ValueError("a byte-level BPE tokenizer without normalizer and prefix space is needed")


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 1024, carry: tuple[str, ...] = ("doc_id",),
                 text: str = "text", plain_specials: bool = False, frequent: int = FREQUENT) -> DataFrame:
    """``carry`` columns, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every row of ``docs``."""
    tok = load_tokenizer(tokenizer_path, plain_specials)
    check_supported(tok)
    table = Table(frequent_pre_tokens(docs, text, frequent), tok)
    shared = docs.sparkSession.sparkContext.broadcast(table)
    out = ("n_bytes", "n_tokens", "over_limit")
    carry = [c for c in carry if c not in out]
    src, schema = carried(docs, carry, text)
    schema = schema.add("n_bytes", "long").add("n_tokens", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter(tokenizer_path, shared.value, plain_specials)
        for b in batches:
            whole = b.column(b.num_columns - 1)
            n_bytes = pc.fill_null(pc.cast(pc.binary_length(whole), pa.int64()), 0)
            n_tokens = pa.array((counter.count(t.as_py()) for t in whole), pa.int64(), size=len(whole))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], n_bytes, n_tokens], names=schema.names)

    counted = src.mapInArrow(run, schema)
    return given_back(counted, carry, ["n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")])
