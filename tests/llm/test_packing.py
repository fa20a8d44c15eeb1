"""Packing: token ids against the tokenizer, and each id in exactly one piece."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rentlens.llm import packing as P

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [None, "", " \n ", "Hello, world! It's 2024; we're (maybe) fine...", "Ärger über größe ÉTÉ ÿ Ÿ", "a" * 9000,
         "x y z \x85 \x1c end", "Σίσυφος ΟΔΟΣ İstanbul ﬁne é ́x", "<|endoftext|> a<|startoftext|>b", "日本語 テキスト 123",
         "word. " * 5000, "\x00\x01\x02 control", "don't can'T I'LL o'clock ''s 's", "ª º µ ² ¼ soft­hyphen ​zero"]


def ids_of(text):
    return np.array([*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def test_ids_equal_the_tokenizer(prose):
    tok = P.WordTokenizer(PATH)
    tok.WORDS = 50
    for t in [*TEXTS, prose(400)]:
        assert tok.ids(t) == ids_of(t)[:-1].tobytes(), t


def check(rows, docs, size):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert set(by_doc) == set(docs)
    for d, pieces in by_doc.items():
        ids, at = docs[d], 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids) and p.length > 0
            assert p.ids_crc32 == zlib.crc32(ids[p.start:p.start + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for pieces in by_seq.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= size
    return [sum(p.length for p in s) for s in by_seq.values()]


@pytest.mark.parametrize("parts,fan_in,windows", [(1, 32, 16), (9, 2, 3), (5, 32, 1)])
def test_every_id_lies_in_one_piece(spark, prose, parts, fan_in, windows):
    texts = TEXTS + [prose(prose.rng.randrange(1, 900)) for _ in range(60)]
    df = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)], "doc_id long, text string, part int").repartition(parts)
    rows = P.pack_documents(df, PATH, 512, windows, fan_in=fan_in).collect()
    fills = check(rows, {i: ids_of(t) for i, t in enumerate(texts)}, 512)
    assert sum(f < 512 for f in fills) <= windows  # only what stays open at the very end


def test_repeats_nulls_and_empty(spark):
    df = spark.createDataFrame([(None, "a b"), (None, "a b"), (3, None)], "doc_id long, text string")
    rows = P.pack_documents(df, PATH).collect()
    assert sorted(r.length for r in rows) == [1, 3, 3] and len({r.sequence_id for r in rows}) == 1
    assert P.pack_documents(df.limit(0), PATH).count() == 0


def test_packer_is_best_fit_and_tops_up_the_fullest():
    p = P.Packer(10, 2)
    piece = lambda d, n: (d, 0, n, b"\0" * 4 * n)
    sizes = lambda seqs: [[(x[0], x[1], len(x[3]) // 4) for x in s] for s in seqs]
    assert sizes(p.put(piece("a", 6))) == [] and sizes(p.put(piece("b", 8))) == []
    assert sizes(p.put(piece("c", 2))) == [[("b", 0, 8), ("c", 0, 2)]]
    assert sizes(p.put(piece("d", 7))) == []
    assert sizes(p.put(piece("e", 5))) == [[("d", 0, 7), ("e", 0, 3)]]
    assert sizes(p.rest()) == [[("a", 0, 6), ("e", 3, 2)]]


def test_ascii_words_are_cut_without_the_whole_tokenizer():
    tok = P.WordTokenizer(PATH)
    text = 'and&&& the##9a "x12y" a-b=c; mail.1@example.com || ...'
    want = ids_of(text)[:-1].tobytes()
    tok.tok = None
    assert tok.ids(text) == want


def test_words_in_use_stay_cached_when_others_come_and_go():
    tok = P.WordTokenizer(PATH)
    tok.WORDS = 40
    made, make = [], tok.words.make
    tok.words.make = lambda w: made.append(w) or make(w)
    for i in range(300):
        tok.ids(f"often again word{i}")
    assert made.count(b"often") == made.count(b"again") == 1
    assert len(tok.words) + len(tok.words.older) <= 2 * tok.WORDS


def test_words_of_many_texts_are_held_within_bounds():
    tok = P.WordTokenizer(PATH)
    for i in range(0, 260_000, 1000):
        tok.ids(" ".join(f"{chr(97 + j % 26)}x{j}%" for j in range(i, i + 1000)))
    assert sum(len(c) + len(c.older) for c in (tok.words, tok.runs)) <= 240_000
