"""Runs against a search of every period, the planted texts and the digests against plain Python."""

import hashlib
import random
import re
import zlib

import pytest
from helpers import ODD, clashing, docs
from hypothesis import given, settings
from hypothesis import strategies as st

from panelcast.llm import periodic
from panelcast.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def brute(words, least=12):
    """Runs (start, length, period) and the words that stay, by every period at every place."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i < len(words) - q:
            start = i
            while i < len(words) - q and words[i] == words[i + q]:
                i += 1
            if i - start >= q and i - start + q >= least:
                found.setdefault((start, i + q), q)
            i += 1
    runs = sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return runs, [w for i, w in enumerate(words) if i not in gone]


def letters(text):
    return [c.encode() for c in text]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab", max_size=60), max_size=6), st.sampled_from([2, 12]))
def test_few_letters(texts, least):
    texts = [letters(t) for t in texts]
    assert periodic.search(texts, least) == [brute(t, least) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.text("abc", min_size=1, max_size=5), st.integers(1, 60)), min_size=1, max_size=6),
       st.integers(1, 3))
def test_touching_regions(parts, copies):
    words = letters("".join((unit * n)[:n] for unit, n in parts) * copies)
    assert periodic.search([words], 2) == [brute(words, 2)]


def test_two_regions_cross_at_many_periods():
    words = letters("ab" * 40 + "ba" * 40)
    runs, _ = periodic.search([words])[0]
    assert (runs, _) == brute(words) and len(runs) > 10


def test_periods_of_every_length():
    draw = random.Random(3)
    texts = []
    for q in [*range(1, 40), 63, 64, 65, 127, 200, 511]:
        unit = [str(draw.randrange(50)).encode() for _ in range(q)]
        texts.append([b"x"] + (unit * 3)[:2 * q + draw.randrange(q)] + [b"y"])
    assert periodic.search(texts) == [brute(t) for t in texts]


def test_nested_repeats():
    words = letters(("a" * 9 + "b") * 5 + "c")
    assert periodic.search([(words * 4)[:-3]]) == [brute((words * 4)[:-3])]


def test_a_long_text_of_one_word():
    words = [b"la"] * 300_000
    assert periodic.search([words]) == [([(0, 300_000, 1)], [b"la"])]


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if doc_id is not None and words:
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs, kept = brute(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    lines = "".join("%d,%d,%d\n" % r for r in runs)
    return (doc_id, len(runs), *best, best[1] and 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(" ".join(kept).encode()).hexdigest())


def result(df):
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_query_equals_brute_force(spark):
    texts = [r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op11_periodic_runs"](spark, FOLDER)
    by_id = {r[0]: r for r in result(got)}
    assert len(by_id) == len(texts) and any(r[1] for r in by_id.values())
    for doc_id, text in texts:
        if len(text or "") < 20_000:
            assert by_id[doc_id] == expected(doc_id, text)


def test_planted_words_repeat(spark):
    # The words of ids whose checksum is a multiple of ten, in texts of several lengths.
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0][:25]
    rows = [(i, " \t".join(f"w{k}" for k in range(1 + 7 * j))) for j, i in enumerate(ids)]
    got = periodic.digests(periodic.periodic_runs(periodic.plant(docs(spark, rows))))
    assert result(got) == sorted((expected(*r) for r in rows), key=repr)


@pytest.mark.parametrize("extra", [[], ["runs", "n", "a", "g", "chosen"]])
def test_odd_documents(spark, extra):
    table = clashing(docs(spark, ODD), extra)
    got = result(periodic.digests(periodic.periodic_runs(periodic.plant(table))))
    want = sorted((expected(i, t) if len(t or "") < 1000 else None for i, t in ODD if len(t or "") < 1000), key=repr)
    assert [r for r in got if r[0] != 7] == want
    long = next(r for r in got if r[0] == 7)
    assert long[1:6] == (1, 0, 60_000, 1, 60_000_000)
    empty = periodic.digests(periodic.periodic_runs(periodic.plant(table.where("false"))))
    assert empty.count() == 0
