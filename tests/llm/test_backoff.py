"""Scores against plain counting; blocks against their numbers."""

import math
from collections import Counter

import numpy as np
import pytest
from helpers import ODD, clashing, docs, rows

from panelcast.llm import backoff as B


def plain_scores(texts, order=B.ORDER):
    words = [(t or "").encode().lower().split() for t in texts]
    counts = Counter(tuple(w[i:i + n]) for w in words for n in range(1, order + 1) for i in range(len(w) - n + 1))
    total = sum(map(len, words))
    out = []
    for w in words:
        score = 0.0
        for i in range(len(w)):
            longest = min(order, i + 1)
            for n in range(longest, 0, -1):
                own = counts[tuple(w[i - n + 1:i + 1])]
                if n == 1 or own >= B.LEAST_COUNT:
                    score += math.log(own / (counts[tuple(w[i - n + 1:i])] if n > 1 else total))
                    score += (longest - n) * math.log(B.ALPHA)
                    break
        out.append((len(w), score))
    return out


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_scores_equal_plain_counting(spark, monkeypatch, order):
    monkeypatch.setattr(B, "CHUNK_CHARS", 300)
    monkeypatch.setattr(B, "SHARD_ENTRIES", 40)
    texts = [*[(100 + k, " ".join("the cat of a man and the cat sat on it".split()[k % 5:]) + f" x{k % 3} y{k}") for k in range(30)],
             *[(i, t) for i, t in ODD if t is None or len(t) < 100]]
    got = B.score(clashing(docs(spark, texts), ["chunk", "shard", "n_words", "log_score"]), order)
    want = [(i, n, pytest.approx(s)) for (i, _), (n, s) in zip(texts, plain_scores([t for _, t in texts], order))]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(rows(got, "doc_id", "n_words", "log_score"), key=key) == sorted(want, key=key)


def test_long_text_and_empty_table(spark):
    n, score = plain_scores([ODD[7][1]])[0]
    got = B.score(docs(spark, [ODD[7]])).collect()[0]
    assert (got.n_words, got.log_score) == (n, pytest.approx(score))
    assert B.score(docs(spark, ODD).where("false")).count() == 0
    assert [r.mean_log_score for r in B.score(docs(spark, [(1, None)])).collect()] == [None]


@pytest.mark.parametrize("values", [[], [0], [5, 2**63, 2**64 - 1], list(range(300))])
def test_blocks_hold_their_numbers(values):
    values = np.array(values, dtype=np.uint64)
    assert (B.unpack(B.pack(values)) == values).all()
    assert (B.unpack_sorted(B.pack_sorted(values)) == values).all()


def test_shards_cover_all_hashes():
    hashes = np.sort(np.random.default_rng(1).integers(0, 2**64, 1000, dtype=np.uint64))
    edges = B.bounds(hashes, 7)
    assert edges[0] == 0 and edges[-1] == 1000 and (np.diff(edges) > 50).all()
