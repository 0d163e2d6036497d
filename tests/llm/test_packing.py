"""Every token is packed once, sequences have no gaps, and few sequences are used."""

import random
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from helpers import ODD, clashing, docs
from pyspark.sql import functions as F

from panelcast.llm import packing
from panelcast.llm.tokens import vocabulary

PATH = public_tokenizers.path("word_bpe_49k.json")


def best_fit(lengths, capacity):
    rooms, n = [], 0
    for s in sorted(lengths, reverse=True):
        k = bisect_left(rooms, s)
        n += k == len(rooms)
        insort(rooms, (capacity if k == len(rooms) else rooms.pop(k)) - s)
    return n


def check_gapless(rows, capacity=2048):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def wanted_pieces(texts):
    tokenizer, found = vocabulary(PATH), Counter()
    for name, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[at:at + 2048], dtype="<u4").tobytes()
            found[(name, k, at, len(part) // 4, zlib.crc32(part))] += 1
    return found


@pytest.mark.parametrize("low, high, n, capacity", [(1, 2048, 3000, 2048), (600, 1100, 2000, 2048), (1, 3, 50, 7),
                                                    (2048, 2048, 9, 2048), (1, 1, 5, 10), (683, 683, 100, 2048)])
def test_plan_packs_the_histogram(low, high, n, capacity):
    draw = random.Random(1)
    lengths = [draw.randint(low, min(high, capacity)) for _ in range(n)]
    made = packing.plan(Counter(lengths), capacity, 60)
    assert Counter(s for m, part in made for s in part for _ in range(m)) == Counter(lengths)
    assert all(sum(part) <= capacity for _, part in made)
    used = sum(m for m, _ in made)
    assert used <= max(best_fit(lengths, capacity) * 1.01 + 1, -(-sum(lengths) // capacity))


def test_plan_beats_best_fit_where_that_wastes():
    """Halves and thirds that best-fit decreasing mixes badly."""
    lengths = [51] * 60 + [27] * 60 + [26] * 60 + [23] * 120
    made = packing.plan(Counter(lengths), 100, 200)
    assert sum(m for m, _ in made) <= best_fit(lengths, 100)


def test_knapsack_finds_the_dearest_multiset():
    sizes, prices = np.array([3, 5, 7]), np.array([3.0, 5.5, 7.1])
    take = packing.knapsack(sizes, prices, 15)
    assert take @ sizes <= 15 and take @ prices == pytest.approx(16.5)


def test_no_lengths():
    assert packing.plan({}) == []


def test_odd_documents(spark):
    table = clashing(docs(spark, ODD), ["piece", "length", "sequence_id", "offset", "ids"])
    pieces = packing.pieces(table, PATH).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    got = packing.pack(pieces).collect()
    assert Counter(tuple(r[:5]) for r in got) == wanted_pieces((r.doc_id, r.text) for r in table.collect())
    check_gapless(got)


def test_empty_table(spark):
    pieces = packing.pieces(docs(spark, ODD).where("false"), PATH)
    assert packing.pack(pieces).count() == 0


def test_extra_columns_stay_and_clash(spark):
    table = spark.createDataFrame([(1, 5, "a"), (2, 5, "b"), (3, 9, None)], "k int, length long, `piece chunk` string")
    got = packing.pack(table, capacity=10).collect()
    assert sorted((r.k, r["piece chunk"]) for r in got) == [(1, "a"), (2, "b"), (3, None)]
    assert check_gapless(got, 10) == 2


def test_corpus(spark, sf_dir):
    from panelcast.llm.queries import QUERIES

    got = QUERIES["op9_best_fit_packing"](spark, sf_dir).collect()
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert Counter(tuple(r[:5]) for r in got) == wanted_pieces((r.doc_id, r.text) for r in texts)
    assert check_gapless(got) <= best_fit([r.length for r in got], 2048) * 1.005 + 1
