"""Fingerprints, links and classes against brute force."""

import random

import numpy as np
import pytest
import xxhash
from helpers import ODD, clashing, docs, rows

from panelcast.llm import components, simhash


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum((2 * sum(h >> k & 1 for h in hashes) > len(hashes)) << k for k in range(64))


def plain_classes(prints):
    """Smallest place reachable over links of at most two bits."""
    values = np.array(prints, dtype=np.uint64)
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1:] ^ values[i]) <= 2):
            a, b = find(i), find(i + 1 + int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_fingerprint_of_a_long_text_is_counted_in_blocks(monkeypatch):
    text = " ".join(random.Random(2).choice("abcdefg") for _ in range(500))
    monkeypatch.setattr(simhash, "BLOCK", 7)
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_odd_documents(spark):
    table = clashing(docs(spark, ODD), ["fp", "fingerprint", "component_id", "cell"])
    got = rows(simhash.near_duplicates(table), "doc_id", "fingerprint", "component_id")
    prints = [plain_fingerprint(t) for _, t in ODD]
    classes = plain_classes(prints)
    smallest = {c: min((i for (i, _), k in zip(ODD, classes) if k == c and i is not None), default=None) for c in classes}
    assert got == sorted(((i, f"{p:016x}", smallest[c]) for (i, _), p, c in zip(ODD, prints, classes)), key=repr)


def test_empty_table(spark):
    assert simhash.near_duplicates(docs(spark, ODD).where("false")).count() == 0
    assert simhash.deduplicate(docs(spark, ODD).where("false")).count() == 0


@pytest.mark.parametrize("limit", [256, 3, 0])
def test_links_of_crowded_and_other_cells(spark, limit):
    """Chains and balls of near fingerprints; with small limits the one-bit words serve them."""
    draw = random.Random(4)
    prints = {draw.getrandbits(64) for _ in range(150)}
    for center in list(prints)[:8]:
        for _ in range(25):
            center ^= 1 << draw.randrange(64)
            if draw.random() < 0.5:
                center ^= 1 << draw.randrange(64)
            prints.add(center)
    values = sorted(prints)
    table = spark.createDataFrame([(simhash.signed(v),) for v in values], "fp long")
    named = components.components(simhash.links(table, cell_limit=limit))
    got = {r.node: r.component for r in named.collect()}
    classes = plain_classes(values)
    by_class = {}
    for v, c in zip(values, classes):
        by_class.setdefault(c, []).append(simhash.signed(v))
    want = {v: min(part) for part in by_class.values() for v in part if len(part) > 1}
    assert got == want


def test_cells_lose_no_pair():
    """Two fingerprints two bits apart agree in two quarters, and no distance differs by more."""
    draw = random.Random(5)
    for _ in range(200):
        a = draw.getrandbits(64)
        b = a ^ (1 << draw.randrange(64)) ^ (1 << draw.randrange(64))
        same = sum((a >> 16 * q & 0xFFFF) == (b >> 16 * q & 0xFFFF) for q in range(4))
        assert same >= 2
        assert all(abs((a ^ p).bit_count() - (b ^ p).bit_count()) <= 2 for p in simhash.pivots())


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(1000, 1400)] + [(5, 5)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(100, 161), 100), 7: 7, **dict.fromkeys(range(1000, 1400), 7)}


def test_deduplicate_keeps_one_of_each_class(spark):
    table = docs(spark, [(4, "one two three four"), (2, "one two three four"), (2, "one two three four"), (9, "other words"),
                         (None, "other words"), (None, "alone here"), (3, None), (8, "")])
    assert rows(simhash.deduplicate(table), "doc_id", "text") == sorted(
        [(2, "one two three four"), (9, "other words"), (None, "alone here"), (3, None)], key=repr)


def test_deduplicate_keeps_any_type_of_other_column(spark):
    from pyspark.sql import functions as F

    table = docs(spark, [(k, f"text number {k % 5} of some words", "a") for k in range(20)]).withColumn(
        "tags", F.create_map(F.lit("k"), F.col("doc_id")))
    got = simhash.deduplicate(table)
    assert got.schema == table.schema
    assert sorted((r.doc_id, r.tags["k"]) for r in got.collect()) == [(k, k) for k in range(5)]


def test_corpus(spark, sf_dir):
    from panelcast.llm.queries import QUERIES

    texts = sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    prints = [plain_fingerprint(r.text) for r in texts]
    classes = plain_classes(prints)
    want = [(r.doc_id, f"{p:016x}", texts[c].doc_id) for r, p, c in zip(texts, prints, classes)]
    assert rows(QUERIES["op8_simhash_near_dedup"](spark, sf_dir), "doc_id", "fingerprint", "component_id") == sorted(want, key=repr)
