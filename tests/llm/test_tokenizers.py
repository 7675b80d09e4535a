"""BPE codec and token counts against the tokenizer libraries."""

import hashlib
import random
import time

import numpy as np
import public_tokenizers
import pytest
import regex
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from roadbook.llm import bpe, queries, token_counts

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
LIBRARY, MODEL = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
TEXTS = [
    "", " ", "  a  b ", "a\n b", "a \nb\n", "a\t\tb   c", "<|endoftext|>x<|endoftext|><|endoftext|> y", "▁x▁▁ y",
    "x\x00y", "a" * 3000, "ab" * 1500, "é" * 300, "==" * 500, "﷽ﬁ 日本語 \U0001f600\U0001f600",
    "\x1c a\x1c b\x85 c　d", "don't we'll 's 'll  's", "a   b    c     d", " " * 40, "x" + " " * 33 + "y", "1234567890" * 20,
    "\r\n\r\n a", "the" * 1000, "<s>hi</s><unk>",
]


def _encoded(texts):
    tokens, ends = bpe.codec(BYTES).encode(texts)
    return [tokens[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def _library(texts):
    return [e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def test_codec_is_the_librarys():
    assert _encoded(TEXTS) == _library(TEXTS)
    for text, ids in zip(TEXTS, _library(TEXTS), strict=True):
        assert bpe.codec(BYTES).decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False) == text


def test_counts_are_the_librarys():
    assert token_counts.counter(PIECES).count(TEXTS) == [len(x) for x in MODEL.encode(TEXTS)]


def test_random_mixtures():
    chance = random.Random(1)
    alphabet = " \n\tabcdeéñ'0123▁.!,日\x1c "
    texts = ["".join(chance.choice(alphabet) for _ in range(chance.randint(1, 60))) for _ in range(3000)]
    assert _encoded(texts) == _library(texts)
    assert token_counts.counter(PIECES).count(texts) == [len(x) for x in MODEL.encode(texts)]


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80))
def test_any_text(text):
    assert _encoded([text]) == _library([text])
    assert token_counts.counter(PIECES).count([text]) == [len(MODEL.encode(text))]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=20), st.text("'stmdrevla 1.\n\u3000é", min_size=1, max_size=20)).filter(len), min_size=1, max_size=4))
def test_blocks_are_cut_by_the_pattern(texts):
    starts, at = [], 0
    for text in texts:
        starts += [at + found.start() for found in regex.finditer(bpe.WORD_PATTERN, text)]
        at += len(text)
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    begins = np.cumsum([0, *map(len, texts[:-1])])
    assert bpe.word_starts(codes, begins).tolist() == starts


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 50_000), max_size=6), max_size=5))
def test_any_tokens(lists):
    coder, lists = bpe.codec(BYTES), [[t for t in x if t < len(bpe.codec(BYTES).lengths)] for x in lists]
    tokens, ends = np.array(sum(lists, []), np.int32), np.cumsum([len(x) for x in lists], dtype=np.int64)
    assert coder.decode_block(tokens, ends).to_pylist() == [coder.decode(x) for x in lists]


def test_a_mark_makes_no_new_word():
    coder, words, marks = bpe.Codec(BYTES), ["was", "thenon", "ndstre"], [",", ".", ";", "!", ""]
    coder.encode(["".join(" " + word + mark for word in words for mark in marks)])
    assert len(coder.known.young) == len(coder.chunks.young) == 3 + 4


def test_memory_may_be_forgotten_at_any_time():
    coder = bpe.Codec(BYTES)
    coder.chunks.limit = coder.known.limit = 3
    tokens, ends = [], []
    for text in TEXTS * 2:
        found, end = coder.encode([text])
        assert found == _library([text])[0] and end == [len(found)]


def test_long_words():
    chance = random.Random(2)
    letters, signs = "abcdefghijklmnopqrstuvwxyz", "ABCxyz019+/é日\n"
    words = ["".join(chance.choices(al, k=n)) for al in (letters, signs, "etao", "ab") for n in (97, 98, 500, 20_000)]
    words += ["international" * 3000, "x y" + "q" * 400, "日本語" * 1000, " ".join(["straße" * 40, "aß" * 99]), '{"a":[1,2]},' * 900]
    assert token_counts.counter(PIECES).count(words) == [len(x) for x in MODEL.encode(words)]
    counts = [token_counts.Pieces(PIECES)._heap("▁" + w) for w in words[:3]]
    assert counts == [len(x) for x in MODEL.encode(words[:3])]


def test_a_very_long_word_takes_seconds():
    word = "".join(random.Random(3).choices("abcdefghijklmnopqrstuvwxyz", k=1_000_000))
    begin = time.perf_counter()
    assert token_counts.counter(PIECES).count([word]) == [len(MODEL.encode(word))]
    assert time.perf_counter() - begin < 20


def test_memory_is_bounded_by_bytes(monkeypatch):
    coder, counter = bpe.Codec(BYTES), token_counts.Counter(PIECES)
    coder.chunks.limit = coder.known.limit = 1 << 20
    monkeypatch.setattr(token_counts, "KNOWN_BYTES", 1 << 20)
    chance = random.Random(4)
    for _ in range(40):
        texts = ["".join(chance.choices("日本語中国人大小上下一二三", k=chance.choice([20, 60, 2000]))) for _ in range(60)]
        assert counter.count(texts) == [len(x) for x in MODEL.encode(texts)]
        coder.encode(texts)
        for known in (coder.chunks.young, coder.chunks.old, coder.known.young, coder.known.old, counter.known):
            assert all(len(key) <= 64 * 4 for key in known) and sum(map(len, known)) < 1 << 20
    assert all(len(key) <= token_counts.KNOWN_CHARS for key in counter.known)


def test_documents(odd_docs):
    expected = {(r.doc_id, r.text) for r in odd_docs.collect()}
    rows = bpe.round_trip(odd_docs, BYTES).collect()
    assert len(rows) == odd_docs.count()
    for row in rows:
        assert list(row.token_ids) == (_library([row.decoded_text])[0])
    assert {(r.doc_id, r.decoded_text) for r in rows} == {(i, t or "") for i, t in expected}
    apart = bpe.decode_documents(bpe.encode_documents(odd_docs, BYTES), BYTES).collect()
    assert sorted(str((r.doc_id, r.decoded_text)) for r in apart) == sorted(str((r.doc_id, r.decoded_text)) for r in rows)
    for row in token_counts.count_tokens(odd_docs, PIECES).collect():
        assert (row.n_bytes, row.n_tokens) == next(
            (len((t or "").encode()), len(MODEL.encode(t or ""))) for i, t in expected if i == row.doc_id
        )


def test_empty_and_clashing(no_docs, make_docs):
    assert bpe.round_trip(no_docs, BYTES).count() == token_counts.count_tokens(no_docs, PIECES).count() == 0
    clash = make_docs([(1, "a b")], "token_ids Decoded_Text N_tokens n_bytes")
    row = bpe.round_trip(clash, BYTES).first()
    assert list(row.token_ids) == _library(["a b"])[0] and row.decoded_text == "a b"
    assert token_counts.count_tokens(clash, PIECES).first().n_tokens == len(MODEL.encode("a b"))


def test_queries(spark, sf_dir):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for row in queries.queries()["op2_bpe_codec"](spark, sf_dir).collect():
        ids = _library([texts[row.doc_id]])[0]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()
    for row in queries.queries()["op7_token_counts"](spark, sf_dir).collect():
        n = len(MODEL.encode(texts[row.doc_id]))
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(texts[row.doc_id].encode()), n, n > 4096)


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        bpe.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))
