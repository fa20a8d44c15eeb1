"""Token counts against the tokenizer itself."""

import random

import public_tokenizers
import pytest

from rentlens.llm import queries as Q
from rentlens.llm.token_counts import ENTRY_BYTES, Summary, Table, TokenCounter, count_tokens, frequent_pre_tokens, load_tokenizer
from rentlens.llm.token_counts import _PRE_TOKENS
from tests.conftest import SF_SMALL

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = (0x3000, 0xA0, 0x200B, 0x2028, 0x2003, 0x1C, 0x85, 0x180E, 0xFEFF, 0x301, 0, 0x250, 0x17F, 0x1C5, 0x663, 0xAA, 0xB2)
PARTS = ["a", "Bc", " ", "  ", "\n", "\t", ".", "'s", "'ll", "'", "1", "é", "ü", "漢", "😀", "<|endoftext|>", "<|", "|>", " the",
         *map(chr, ODD)]


def plain(text, tok=load_tokenizer(PATH)):
    return len(tok.encode(text or "", add_special_tokens=False).ids)


def test_character_classes_are_the_tokenizers():
    pre = load_tokenizer(PATH).pre_tokenizer
    for o in (*range(1, 0x1C), *range(0x20, 0x250)):
        for before in ("a", "1", ".", " ", "\t", "' "):
            text, at = f"{before}{chr(o)}b", 0
            for (_, place), piece in zip(pre.pre_tokenize_str(text), _PRE_TOKENS(text), strict=True):
                assert place == (at, at + len(piece)), (o, text)
                at += len(piece)


def test_random_texts_with_small_tables_and_caches():
    rng = random.Random(1)
    tok = load_tokenizer(PATH)
    for cached in (2, 1000):
        counter = TokenCounter(PATH, Table(["the", " the", "."], tok), cached=cached)
        for _ in range(4000):
            text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14)))
            assert counter.count(text) == plain(text), text


def test_plain_specials():
    tok = load_tokenizer(PATH, plain_specials=True)
    text = "a<|endoftext|> b"
    assert TokenCounter(PATH, None, plain_specials=True).count(text) == plain(text, tok) > plain(text)


def test_summary_keeps_what_is_frequent():
    rng = random.Random(2)
    words = ["often"] * 400 + [f"w{rng.randrange(3000)}" for _ in range(3000)]
    rng.shuffle(words)
    parts = [Summary(16) for _ in range(5)]
    for i, w in enumerate(words):
        parts[i % 5].add([w])
    both = Summary(16)
    for p in parts:
        p.shrink()
        both.merge(list(p.counts), list(p.counts.values()))
    both.shrink()
    assert "often" in both.counts and len(both.counts) <= 16


def test_frequent_pre_tokens_merge_over_partitions(spark, prose):
    rows = [(i, prose(30) + " common " * 5) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(40)
    got = frequent_pre_tokens(docs, size=20, fan_in=3)
    assert " common" in got and len(got) <= 20 and all(len(p.encode()) <= ENTRY_BYTES for p in got)


def test_nulls_long_texts_repeats_and_clashing_names(spark):
    long = "über alles, the 12 words' end\n" * 20000
    rows = [(1, None, "x", 5), (2, "", "x", 5), (3, long, "x", 5), (3, long, "x", 5), (None, "漢字 <|endoftext|>", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, __whole_text int")
    got = count_tokens(docs, PATH, limit=5, carry=("doc_id", "n_tokens", "__whole_text")).collect()
    assert got[0].asDict().keys() == {"doc_id", "__whole_text", "n_bytes", "n_tokens", "over_limit"}
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == sorted(
        (str(i), len((t or "").encode()), plain(t), plain(t) > 5) for i, t, *_ in rows)
    assert count_tokens(docs.limit(0), PATH).count() == 0


def test_other_tokenizers_are_refused(spark):
    with pytest.raises(ValueError):
        count_tokens(spark.createDataFrame([], "doc_id long, text string"), public_tokenizers.path("word_bpe_49k.json"))


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = Q.QUERIES["op11_token_counts"](spark, SF_SMALL).collect()
    assert len(got) == len(docs)
    for r in got:
        n = plain(docs[r.doc_id])
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 1024)
