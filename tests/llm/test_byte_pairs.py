"""Ids against the tokenizer library, decoding as an exact round trip."""

import hashlib
import random
import re

import public_tokenizers
import pytest
import tiktoken
from helpers import LONG, ODD, clashing, docs
from hypothesis import given, settings
from hypothesis import strategies as st

from panelcast.llm import byte_pairs
from panelcast.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def parts():
    ranks = byte_pairs.read_ranks(PATH)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    cut = re.compile(byte_pairs.spelled_out(public_tokenizers.PATTERN))
    return library, cut, byte_pairs.Vocabulary(ranks)


def check(parts, texts):
    library, cut, vocabulary = parts
    found = byte_pairs.encode_texts(texts, cut, vocabulary, {})
    assert [x.tolist() for x in found] == [library.encode_ordinary(t) for t in texts]
    assert [vocabulary.decode(x) for x in found] == [t.encode() for t in texts]


@settings(max_examples=200, deadline=None)
@given(texts=st.lists(st.text(max_size=80), max_size=8))
def test_any_text(parts, texts):
    check(parts, texts)


@settings(max_examples=100, deadline=None)
@given(texts=st.lists(st.text("aeno 's\n1é日", max_size=300), max_size=8))
def test_texts_that_merge_much(parts, texts):
    check(parts, texts)


def test_every_character(parts):
    points = [*range(0xD800), *range(0xE000, 0x110000)]
    random.Random(1).shuffle(points)
    check(parts, ["".join(f"{chr(c)}a" for c in points[k::400]) for k in range(0, 400, 8)])


@pytest.mark.parametrize("length", [*range(1, 18), 31, 32, 33, 64, 255, 256, 257, 1000])
def test_bucket_borders(parts, length):
    draw = random.Random(length)
    check(parts, ["".join(draw.choice("abcdeé") for _ in range(length)) for _ in range(20)] + ["a" * length, "é" * length])


def test_heap_and_matrix_agree(parts, monkeypatch):
    _, _, vocabulary = parts
    draw = random.Random(2)
    pieces = ["".join(draw.choice("abcdenorst") for _ in range(n)).encode() for n in (300, 700, 1500)]
    assert all(len(p) > byte_pairs.WIDEST for p in pieces)
    by_heap = [x.tolist() for x in vocabulary.encode(pieces)]
    monkeypatch.setattr(byte_pairs, "WIDEST", 2000)
    assert [x.tolist() for x in vocabulary.encode(pieces)] == by_heap


def test_a_full_cache_starts_afresh(parts, monkeypatch):
    library, cut, vocabulary = parts
    monkeypatch.setattr(byte_pairs, "CACHE_SIZE", 3)
    cache = {}
    for text in ["one two three four five", "six seven eight", "one nine"]:
        assert byte_pairs.encode_texts([text], cut, vocabulary, cache)[0].tolist() == library.encode_ordinary(text)


def digest(library, text):
    ids = library.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_query_equals_the_library(spark, parts):
    want = {r.doc_id: digest(parts[0], r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = QUERIES["op12_byte_bpe"](spark, FOLDER).collect()
    assert len(got) == len(want)
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want


@pytest.mark.parametrize("extra", [[], ["ids", "decoded", "text2"]])
def test_odd_documents(spark, parts, extra):
    table = clashing(docs(spark, [*ODD, (9, "<|endoftext|> ends"), (10, "x" * 5000)]), extra)
    encoded = byte_pairs.encode(table, PATH, public_tokenizers.PATTERN)
    trips = byte_pairs.round_trip(table, PATH, public_tokenizers.PATTERN)
    want = [(i, *digest(parts[0], t)) for i, t in [*ODD, (9, "<|endoftext|> ends"), (10, "x" * 5000)]]
    got = [tuple(r) for r in byte_pairs.digests(trips).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    decoded = {(r.doc_id, bytes(r.decoded)) for r in byte_pairs.decode(encoded, PATH).collect()}
    assert (7, LONG.encode()) in decoded and (1, b"") in decoded
    assert byte_pairs.round_trip(table.where("false"), PATH, public_tokenizers.PATTERN).count() == 0
    nulls = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r.decoded for r in byte_pairs.decode(nulls, PATH).orderBy("doc_id").collect()] == [None, b""]
