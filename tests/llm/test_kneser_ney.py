"""The model's probabilities against plain Python, and verdicts against labels."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import ODD, clashing, docs, rows

from panelcast.llm import kneser_ney as K

TRAIN = ["the cat sat on the mat", "the cat ran", "a dog sat on the cat", "the dog ran on a mat and on the cat", "a cat a dog",
         "the mat and the dog", "Big cat!", "", "on the mat the cat sat and the dog sat"] * 2 + ["new words here 12 MAT"]


def plain_model(texts):
    """p(c | a, b) by the definition of interpolated modified Kneser-Ney smoothing."""
    words = Counter(t for x in texts for t in K.tokens(x))
    ids = {t for t, n in words.items() if n >= K.MIN_COUNT}
    sequences = [["<", "<", *[t if t in ids else K.shape(t) for t in K.tokens(x)], ">"] for x in texts]
    tri = Counter(tuple(s[i:i + 3]) for s in sequences for i in range(len(s) - 2))
    bi = Counter(k[1:] for k in tri)
    for k, n in tri.items():
        if k[:2] == ("<", "<"):
            bi[k[1:]] = max(bi[k[1:]], n)
    mono = Counter(k[1:] for k in bi)

    def smoothed(counts, lower):
        n = [sum(1 for v in counts.values() if v == k) for k in range(5)]
        if all(n[1:]):
            y = n[1] / (n[1] + 2 * n[2])
            d = [0, *[min(max(k - (k + 1) * y * n[k + 1] / n[k], 0), (0.99, 1.9, 2.9)[k - 1]) for k in (1, 2, 3)]]
        else:
            d = [0, 0.5, 0.75, 0.9]
        total, cut = defaultdict(float), defaultdict(float)
        for k, v in counts.items():
            total[k[:-1]] += v
            cut[k[:-1]] += d[min(v, 3)]

        def p(*k):
            if k[:-1] not in total:
                return lower(*k[1:])
            v = counts.get(k, 0)
            return (max(v - d[min(v, 3)], 0) + cut[k[:-1]] * lower(*k[1:])) / total[k[:-1]]

        return p

    uniform = 1 / (len(ids) + K.END)
    return ids, smoothed(tri, smoothed(bi, smoothed(mono, lambda *_: uniform)))


def plain_perplexity(ids, p, text):
    s = ["<", "<", *[t if t in ids else K.shape(t) for t in K.tokens(text)], ">"]
    return math.exp(-sum(math.log(p(*s[i:i + 3])) for i in range(len(s) - 2)) / (len(s) - 2))


def test_perplexities_equal_the_definition(spark, monkeypatch):
    model = K.train(docs(spark, list(enumerate(TRAIN))).select("text"))
    ids, p = plain_model(TRAIN)
    texts = [(1, "the cat sat"), (2, "a mat ran on"), (3, "unseen words %% !"), (4, "MAT 7 Big dog the"), (5, "the"), (6, "cat cat cat cat")]
    for limit in (1_000_000, 1):
        monkeypatch.setattr(K, "GROUP_TOKENS", limit)
        got = rows(K.perplexities(docs(spark, texts), model, ["doc_id"]), "doc_id", "n_tokens", "perplexity")
        assert got == [(i, len(K.tokens(t)), pytest.approx(plain_perplexity(ids, p, t), rel=1e-4)) for i, t in texts]


def test_probabilities_sum_to_one(spark):
    model = K.train(docs(spark, list(enumerate(TRAIN))).select("text"))
    for context in ((K.START, K.START), (model["ids"]["the"], model["ids"]["cat"]), (3, 4)):
        every = [np.array([*context, w]) for w in [*range(5), K.END, *model["ids"].values()]]
        # The class of words never seen keeps a part of the uniform share.
        assert sum(float(np.exp(K.log_probabilities(model, x))[0]) for x in every) == pytest.approx(1, abs=0.02)


def labels(spark, pairs):
    return spark.createDataFrame(pairs, "doc_id long, quality int, toxic int")


def test_odd_documents_and_tables(spark):
    good = [(100 + k, TRAIN[k % len(TRAIN)] + " and the cat sat on the mat") for k in range(60)]
    table = clashing(docs(spark, [*good, *ODD]), ["perplexity", "threshold", "kept", "own"])
    known = labels(spark, [*[(i, 1, 0) for i, _ in good], (101, 0, 0), (None, 1, 0), (102, None, 0), (999, 1, 0)])
    got = {r.doc_id: r for r in K.classify(table, known).collect()}
    assert len(got) == len({i for i, _ in [*good, *ODD]})
    assert not got[1].kept and got[1].perplexity is None and got[1].n_tokens == 0
    assert not got[2].kept and got[7].n_tokens == 60_000
    assert sum(got[i].kept for i, _ in good) >= 58
    assert K.classify(table.where("false"), known).count() == 0
    assert all(r.kept == (r.n_tokens > 0) for r in K.classify(table, known.where("false")).collect())


def test_verdicts_against_labels(spark):
    folder = "/root/testdata/sf0.01"
    known = spark.read.parquet(f"{folder}/labels.parquet")
    got = K.classify(spark.read.parquet(f"{folder}/documents.parquet"), known).join(known, "doc_id").collect()
    good, poor = ([r.kept for r in got if r.quality == q] for q in (1, 0))
    assert sum(good) >= 0.98 * len(good)
    assert sum(poor) <= 0.35 * len(poor)


def test_all_trusted_text_that_is_not_held_out_is_learned(spark):
    def name(k):
        return "".join("abcdefghij"[int(d)] for d in f"{k:05d}")

    texts = {k: f"the cat {name(k)} sat on {name(k)} {name(k // 2)}" for k in range(12_000)}
    table, known = docs(spark, list(texts.items())), labels(spark, [(k, 1, 0) for k in texts])
    learned = [r.doc_id for r in known.where(K.place("held", "doc_id") >= K.HELD_SHARE).collect()]
    assert len(learned) > 6_000
    ids, p = plain_model([texts[k] for k in learned])
    got = {r.doc_id: r.perplexity for r in K.classify(table, known).collect()}
    assert len(got) == len(texts)
    for k in range(0, 12_000, 97):
        assert got[k] == pytest.approx(plain_perplexity(ids, p, texts[k]), rel=1e-4)


def test_words_and_ngrams_beyond_the_frequent_ones(spark, monkeypatch):
    for limit, value in (("FREQUENT_WORDS", 3), ("FREQUENT_GRAMS", 2), ("SLICES", 2), ("SLICE_BYTES", 10), ("SLICE_GRAMS", 10), ("BUCKET_GRAMS", 20)):
        monkeypatch.setattr(K, limit, value)
    model = K.train(docs(spark, list(enumerate(TRAIN))).select("text"))
    assert len(model["ids"]) <= 3 and len(model["often"][0]) <= 2
    ids, p = plain_model(TRAIN)
    texts = [(1, "the cat sat"), (2, "a mat ran on"), (3, "unseen words %% !"), (4, "MAT 7 Big dog the"), (5, "the"), (5, "the"), (None, "the cat cat cat")]
    got = rows(K.perplexities(docs(spark, texts), model, ["doc_id"]), "doc_id", "n_tokens", "perplexity")
    want = [(i, len(K.tokens(t)), pytest.approx(plain_perplexity(ids, p, t), rel=1e-4)) for i, t in texts]
    assert got == sorted(want, key=lambda r: repr(r[0]))


def test_tokens_of_a_group_equal_those_of_the_pattern():
    drawn = np.random.default_rng(5)
    mixed = ["".join(map(chr, drawn.choice([*range(32, 0x250), 0x663, 0x4E00, 0x2019, 0x1D400, 0x1F600, 0x2028], 80))) for _ in range(50)]
    texts = ["", " \n", "x\u00b2y _a_ 12\u06634 a1b the the", *mixed]
    found, want = K.Tokens(texts), [K.tokens(t) for t in texts]
    every = [t for x in want for t in x]
    assert found.sizes.tolist() == [len(x) for x in want]
    assert found.strings(np.arange(len(found.begin))) == every
    assert len(set(zip(found.hash.tolist(), every))) == len(set(every)) == len(set(found.hash.tolist()))


def test_ngrams_cross_the_network_in_rows_by_shard(spark, monkeypatch):
    """One row per n-gram and text took most of the time and the disk."""
    monkeypatch.setattr(K, "FREQUENT_GRAMS", 2)
    monkeypatch.setattr(K, "BUCKET_GRAMS", 40)
    model = K.train(docs(spark, list(enumerate(TRAIN))).select("text"))
    texts = docs(spark, [(k, f"the cat {k} sat on word{k} mat dog") for k in range(400)]).select("text").coalesce(1)
    with K.sent(spark, K.hashed(model["ids"])) as words, K.sent(spark, (model["words"], *model["often"])) as often:
        got = K.exploded(texts, model, words, often).collect()
    assert model["shards"] > 1 and len(got) <= model["shards"] + 1
    assert sum(len(r.doc or []) for r in got) > 10 * 400
    assert sum(sum(r.times or []) for r in got) == sum(len(r.doc or []) for r in got)
