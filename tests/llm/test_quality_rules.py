"""Base counts and the estimated verdicts against plain Python."""

import math
import re
from collections import Counter

import pytest
from helpers import LONG, ODD, clashing, docs, rows

from panelcast.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[k:k + 8]) for k in range(len(words) - 7)]
    seen = Counter(windows)
    covered = {i for k, w in enumerate(windows) if seen[w] > 1 for i in range(k, k + 8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(covered), failed)


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_odd_documents(spark):
    texts = [*ODD, (11, "a b c d e f g h " * 3 + "x"), (12, "a\nb \n a\nb \nb\n\n\n"), (13, "a b c d e f g h\x0bi " * 2 + "#|<> %"),
             (14, " ".join(f"w{i}" for i in range(12)) + " " + " ".join(f"w{i}" for i in range(2, 11)))]
    got = rows(Q.judge(clashing(docs(spark, texts), ["n_words", "kept", "w", "lines", "v_symbols"])), "doc_id", *BASE)
    assert got == sorted([(i, *base_counts(t)) for i, t in texts], key=repr)


def test_corpus_base_counts(spark, sf_dir):
    from panelcast.llm.queries import QUERIES

    got = rows(QUERIES["op2_quality_rules"](spark, sf_dir), "doc_id", *BASE)
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert got == sorted(((r.doc_id, *base_counts(r.text)) for r in texts), key=repr)


def test_verdicts_against_labels(spark):
    folder = "/root/testdata/sf0.01"
    kept = Q.judge(spark.read.parquet(f"{folder}/documents.parquet"))
    got = kept.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("not base_failed").collect()
    good = [r.kept for r in got if r.quality == 1]
    poor = [r.kept for r in got if r.quality == 0]
    assert sum(good) >= 0.98 * len(good)
    assert sum(poor) <= 0.05 * len(poor)


def plain_estimate(patterns):
    """The same expectation-maximisation over (votes, n) in plain Python."""
    model = {"prior": Q.PRIOR_GOOD} | {s: dict.fromkeys(Q.RULES, Q.START[s]) for s in ("good", "bad")}
    for _ in range(Q.PASSES):
        total = {"good": 0.0, "bad": 0.0}
        cast = {s: {r: Counter() for r in Q.RULES} for s in total}
        for votes, n in patterns:
            p = plain_posterior(model, votes)
            for side, mass in (("good", n * p), ("bad", n * (1 - p))):
                total[side] += mass
                for rule, vote in zip(Q.RULES, votes):
                    cast[side][rule][vote] += mass
        new = {"prior": (total["good"] + Q.SMOOTHING * Q.PRIOR_GOOD) / (sum(total.values()) + Q.SMOOTHING)}
        for side in total:
            new[side] = {r: {v: (cast[side][r][v] + Q.SMOOTHING * Q.START[side][v]) / (total[side] + Q.SMOOTHING)
                             for v in (1, 0, -1)} for r in Q.RULES}
        model = new
    return model


def plain_posterior(model, votes):
    odds = math.log(model["prior"] / (1 - model["prior"]))
    odds += sum(math.log(model["good"][r][v] / model["bad"][r][v]) for r, v in zip(Q.RULES, votes))
    return 1 / (1 + math.exp(-odds))


def test_estimate_equals_plain_python(spark):
    n = len(Q.RULES)
    patterns = [((1,) * n, 900), ((1, -1) + (1,) * (n - 2), 40), ((-1, -1, -1) + (0,) * (n - 3), 60),
                ((0,) * n, 25), ((1, 1, -1) + (0, -1) * ((n - 3) // 2) + (1,) * ((n - 3) % 2), 30)]
    table = spark.createDataFrame([(*v, k) for v, k in patterns], ", ".join(f"v_{r} tinyint" for r in Q.RULES) + ", n long")
    got, want = Q.estimate(table), plain_estimate(patterns)
    for votes, _ in patterns:
        assert plain_posterior(got, votes) == pytest.approx(plain_posterior(want, votes), abs=1e-4)


def test_empty_table(spark):
    table = docs(spark, ODD).where("false")
    assert Q.judge(table).count() == 0
    assert Q.keep(table).count() == 0


def test_keep_gives_back_whole_rows(spark):
    good = "The quick men of the town are with it and he was not in on the way to his home. " * 1 + " ".join(
        f"of the {a}{b} and" for a in "bcdfgh" for b in "aeiou")
    table = clashing(docs(spark, [(1, good), (1, good), (None, good), (3, None), (4, LONG)]), ["kept", "row", "doc_id_2"])
    kept = Q.keep(table)
    assert kept.columns == table.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == [1, 1, None]
