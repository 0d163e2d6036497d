"""Counts and ids equal the library's, for any text."""

import public_tokenizers
import pytest
from helpers import ODD, clashing, docs, rows
from hypothesis import given, settings
from hypothesis import strategies as st

from panelcast.llm import token_counts
from panelcast.llm.tokens import BYTE_PIECES, BYTE_RUNS, WORD_PIECES, WORD_RUNS, Encoder, special_strings, vocabulary

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
PARTS = st.sampled_from([
    "a", "Hello", "it's", "'ll", "  ", " ", "\n", "\r\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", " ", "　", "​",
    "ﬁ", "é", "é", "́", "İ", "ß", "Σ", "日本", "１２", "3.14", "!?", "😀", "_", "|", "<|", "|>", "x" * 70, "<|endoftext|>"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(PARTS, st.text(max_size=4)), max_size=14).map("".join))
def test_pieces_are_encoded_independently(text):
    text = text.encode("utf-8", "replace").decode()
    for path, cut in ((BYTES, BYTE_PIECES), (WORDS, WORD_PIECES)):
        tokenizer = vocabulary(path)
        if any(s in text for s in special_strings(tokenizer)):
            continue
        by_piece = [i for p in cut.findall(text) for i in tokenizer.encode(p, add_special_tokens=False).ids]
        assert by_piece == tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(PARTS, st.text(alphabet="aBé1Ñ.!'% \n", max_size=6)), max_size=8).map("".join), st.sampled_from([1, 1000]))
def test_cached_ids_are_those_of_the_library(text, size):
    text = text.encode("utf-8", "replace").decode()
    for path, cut, runs, lower in ((BYTES, BYTE_PIECES, BYTE_RUNS, False), (WORDS, WORD_PIECES, WORD_RUNS, True)):
        tokenizer = vocabulary(path)
        encode = Encoder(tokenizer, cut, runs, list, lambda parts: [i for part in parts for i in part], lower, size)
        for _ in range(2):
            assert encode(text) == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def odd(spark):
    return docs(spark, [*ODD, (9, "a <|endoftext|> b  <|endoftext|>"), (10, "  two  spaces \n\n end  ")])


def test_counts_equal_the_library(spark, odd):
    tokenizer = vocabulary(BYTES)
    got = token_counts.count_tokens(clashing(odd, ["n_tokens", "n_bytes", "piece"]), BYTES)
    want = [(r.doc_id, len((r.text or "").encode()), len(tokenizer.encode(r.text or "", add_special_tokens=False)))
            for r in odd.collect()]
    assert rows(got, "doc_id", "n_bytes", "n_tokens") == sorted(want, key=repr)


def test_counts_of_an_empty_table(spark, odd):
    assert token_counts.count_tokens(odd.where("false"), BYTES).count() == 0


def test_counts_on_the_corpus(spark, sf_dir):
    from panelcast.llm.queries import QUERIES

    tokenizer = vocabulary(BYTES)
    got = {r.doc_id: r for r in QUERIES["op10_token_counts"](spark, sf_dir).collect()}
    for d in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        n = len(tokenizer.encode(d.text, add_special_tokens=False))
        assert (got[d.doc_id].n_tokens, got[d.doc_id].over_limit) == (n, n > 512)
