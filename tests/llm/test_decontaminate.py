"""Benchmark passages are found, also with replaced words, and clean texts are left alone."""

import itertools
import random

import numpy as np
import pytest
from helpers import ODD, clashing, docs, rows

from panelcast.llm import decontaminate as D

ITEM = " ".join(f"item{i} word" if i % 3 else f"the{i}" for i in range(20))


def items(spark, pairs):
    return spark.createDataFrame(pairs, "item_id long, text string")


def found(spark, texts, pairs):
    return rows(D.leaks(docs(spark, texts), items(spark, pairs)), "doc_id", "item_id")


def noise(n, seed):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefgh") for _ in range(5)) for _ in range(n))


def test_any_two_substitutions_in_fifteen_words_leave_a_seed():
    for places in itertools.combinations(range(15), 2):
        assert any(all(mask[p - at] == "0" for p in places if 0 <= p - at < D.SPAN)
                   for mask in D.MASKS for at in range(15 - D.SPAN + 1))


@pytest.mark.parametrize("n", range(1, 15))
def test_short_items_are_hit_after_every_allowed_substitution(n):
    """All placements; what is reported is then up to the stretch."""
    words = noise(n, n).split()
    block, hashes = D.Block.of([(1, " ".join(words))]), D.WordHashes()
    for places in itertools.combinations(range(n), n - D.needed(n)):
        changed = ["zz" if k in places else w for k, w in enumerate(words)]
        text = D.words_of(" ".join(["x", "y", *changed, "z"]), hashes)
        assert [0, 0, 2] in block.hits(text, np.array([len(text)])).tolist()
        own = D.words_of(" ".join(words), hashes)
        best = D.stretch(own == text[2:2 + n])[0]
        assert bool(block.leaks([text])[0]) == (best >= D.needed(n))


def test_passages_with_replaced_words(spark):
    words = ITEM.split()
    texts = [(1, ITEM), (2, f"{noise(50, 1)} {ITEM.upper()}! {noise(50, 2)}"), (3, noise(400, 3)), (4, " ".join(words[:6]))]
    for k, every in enumerate((6, 8, 11)):
        changed = [noise(1, i) if i % every == every - 1 else w for i, w in enumerate(words)]
        texts.append((10 + k, f"{noise(30, k)} {' '.join(changed)} {noise(30, 9 + k)}"))
    assert found(spark, texts, [(7, ITEM), (8, noise(30, 77))]) == [(1, 7), (10, 7), (11, 7), (12, 7), (2, 7)]


def test_part_of_a_long_item(spark):
    item = noise(60, 5)
    words = item.split()
    texts = [(1, " ".join(words[20:34])), (2, " ".join(words[20:30])), (3, " ".join(words[40:]))]
    assert found(spark, texts, [(1, item)]) == [(1, 1), (3, 1)]


@pytest.mark.parametrize("n", range(1, 15))
def test_items_at_the_edge_of_a_text(n):
    """All cuts at either end with all placements of substitutions, against every alignment."""
    words = noise(n, 50 + n).split()
    block, hashes = D.Block.of([("k", " ".join(words))]), D.WordHashes()
    own = D.words_of(" ".join(words), hashes)
    for cut, left in itertools.product(range(n), (True, False)):
        kept = words[cut:] if left else words[:n - cut]
        for places in itertools.combinations(range(len(kept)), max(0, n - D.needed(n) - cut)):
            changed = ["zz" if k in places else w for k, w in enumerate(kept)]
            texts = [D.words_of(" ".join(t), hashes) for t in ([*changed, "x"] if left else ["x", *changed], ["x"])]
            best = 0
            for start in range(-n + 1, len(texts[0])):
                a, b = max(0, -start), min(n, len(texts[0]) - start)
                best = max(best, D.stretch(own[a:b] == texts[0][start + a:start + b])[0])
            got = block.leaks(texts)
            assert [sorted(g.values()) for g in got] == [[(best, int(not left) + next(
                k for k in range(len(changed)) if D.stretch(np.array([c != "zz" for c in changed]))[1] == k))]
                if best >= D.needed(n) else [], []]


def test_short_items(spark):
    nine, five = noise(9, 6), noise(5, 7)
    pairs = [(1, nine), (2, five), (3, None), (4, ""), (5, "...")]
    texts = [(1, f"x {nine} y"), (2, five), (3, " ".join(five.split()[:4])), (4, f"a {five.upper()}, {five} b"), (5, "...")]
    assert found(spark, texts, pairs) == [(1, 1), (2, 2), (4, 2)]


def test_one_word_and_repeated_items(spark):
    """Many ids of one text, and a word that stands everywhere."""
    pairs = [(k, "Yes") for k in range(300)] + [(1000 + k, "yes") for k in range(3)]
    got = found(spark, [(1, "no yes " * 5000), (2, "yesterday"), (3, "Yes!")], pairs)
    assert got == sorted([(d, k) for d in (1, 3) for k, _ in pairs], key=repr)


def test_blocks_find_what_one_block_finds(spark, monkeypatch):
    pairs = [(k, noise(25, 100 + k)) for k in range(12)]
    texts = [(k, f"{noise(20, k)} {pairs[k][1]} {pairs[(k + 1) % 12][1]}") for k in range(12)]
    whole = found(spark, texts, pairs)
    assert len(whole) == 24
    monkeypatch.setattr(D, "BLOCK_WORDS", 80)
    assert found(spark, texts, pairs) == whole


def test_odd_documents(spark):
    table = clashing(docs(spark, [*ODD, (30, ITEM), (30, ITEM), (None, ITEM)]), ["leaks", "item_id", "row"])
    bench = items(spark, [(1, ITEM), (1, ITEM), (None, noise(20, 4))])
    assert rows(D.leaks(table, bench), "doc_id", "item_id") == sorted([(30, 1)] * 4 + [(None, 1)] * 2, key=repr)
    left = D.decontaminate(table, bench)
    assert left.columns == table.columns
    assert rows(left, "doc_id", "text") == sorted(ODD, key=repr)


def test_empty_tables(spark):
    table, bench = docs(spark, ODD), items(spark, [(1, ITEM)])
    assert D.leaks(table, bench.where("false")).count() == 0
    assert D.leaks(table.where("false"), bench).count() == 0
    assert D.decontaminate(table, bench.where("false")).count() == len(ODD)


def test_corpus_against_every_alignment(spark, sf_dir):
    """Brute force: every item at every place of every text."""
    bench = [(r.item_id, D.WORD.findall(r.text.lower())) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    texts = [(r.doc_id, D.WORD.findall(r.text.lower())) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = []
    for doc, words in texts:
        known = set(words)
        for item, own in bench:
            need = D.needed(len(own))
            if not own or sum(w in known for w in own) < need:
                continue
            for start in range(-len(own) + 1, len(words)):
                a, b = max(0, -start), min(len(own), len(words) - start)
                same = D.np.array([own[k] == words[start + k] for k in range(a, b)])
                if same.sum() >= need and D.stretch(same)[0] >= need:
                    want.append((doc, item))
                    break
    from panelcast.llm.queries import QUERIES

    assert want
    assert rows(QUERIES["op7_benchmark_decontamination"](spark, sf_dir), "doc_id", "item_id") == sorted(want, key=repr)


@pytest.mark.parametrize("same, best", [([1, 1, 0, 1, 1, 1], (5, 0)), ([1, 0, 0, 1, 1, 1, 1], (4, 3)), ([0, 0], (0, 0))])
def test_stretch(same, best):
    assert D.stretch(D.np.array(same, dtype=bool)) == best
