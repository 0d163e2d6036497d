"""Weak supervision of document quality, on DataFrame functions alone.

Rules vote good (1), bad (-1) or abstain (0). Expectation-maximisation estimates for every
rule how often it casts each vote on good and on bad documents, and the posterior chance of
good replaces a filter in which every rule must pass. A document is one of at most
3^(number of rules) vote patterns, so the passes of the estimation read the counted patterns
and not the documents; the driver holds the rules' rates only.

Cases: a null or empty text has no words and fails the base check; null ids and repeated
rows are judged like any other; equal posteriors fall on the same side; other columns are
ignored; an empty table gives an empty result. Texts of any length are read whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.tables import Written

# White space between words, symbol characters, frequent words of four languages.
BLANK = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
STOP_WORDS = (
    "the of and to a in is that it with for this was on are be by from as at or an not have "
    "der die und das von des dem den mit für ist nicht ein eine zu auf im es sich auch "
    "de la le les et des du un une est dans que qui pour par sur au en pas avec "
    "el los las y del se con por una su al lo como más para"
).split()
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÄÈÉÊËÍÎÏÑÓÔÖÙÚÛÜÇ"

MIN_WORDS = 20
WINDOW = 8
# A document is kept when its chance of being good is at least this.
KEEP = 0.5

# name: (feature, good when, bad when); {0} stands for the feature.
RULES: dict[str, tuple[str, str, str]] = {
    "symbols": ("symbol_rate", "{0} < 0.02", "{0} > 0.1"),
    "capitals": ("capital_rate", "{0} < 0.15", "{0} > 0.4"),
    "stop_words": ("stop_rate", "{0} > 0.12", "{0} < 0.04"),
    "shouting": ("mark_rate", "{0} < 0.02", "{0} > 0.1"),
    "repetition": ("repeat_rate", "{0} < 0.05", "{0} > 0.25"),
    "vocabulary": ("distinct_rate", "{0} > 0.4", "{0} < 0.15"),
    "lines": ("dup_line_rate", "{0} < 0.1", "{0} > 0.3"),
    "word_length": ("mean_word", "{0} BETWEEN 3 AND 8", "{0} < 2 OR {0} > 12"),
    "sentences": ("stop_mark_rate", "{0} BETWEEN 0.02 AND 0.4", "{0} < 0.01 OR {0} > 0.6"),
}
# Before any vote is counted: the rates from which the estimation starts, and the rows of
# made-up votes that keep a rate from reaching 0 or 1.
PRIOR_GOOD = 0.85
START = {"good": {1: 0.8, 0: 0.17, -1: 0.03}, "bad": {1: 0.45, 0: 0.2, -1: 0.35}}
SMOOTHING = 2.0
PASSES = 40
TOLERANCE = 1e-7


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of eight found twice or more, the first one included."""
    count = F.size(words) - WINDOW + 1

    def of_hashes(h: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(h) - WINDOW)
        return F.transform(at, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))

    def covered(windows: Column) -> Column:
        placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
        again = let(placed, lambda s: F.filter(
            s, lambda x, i: (F.get(s, i - 1)["h"].eqNullSafe(x["h"])) | (F.get(s, i + 1)["h"].eqNullSafe(x["h"]))))
        starts = F.sort_array(F.transform(again, lambda x: x["p"]))
        begin = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(starts, begin, lambda acc, p: F.struct(
            p.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).cast("long").alias("n")),
            lambda acc: acc["n"])

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    found = let(let(hashes, of_hashes), lambda g: F.when(
        F.size(F.array_distinct(g)) < F.size(g), covered(g)).otherwise(F.lit(0).cast("long")))
    return F.when(count >= 2, found).otherwise(F.lit(0).cast("long"))


def without(text: Column, characters: str) -> Column:
    return F.char_length(F.translate(text, characters, ""))


def share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def measures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Base counts and the rates that the rules read, one row per row of ``docs``."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    rows = rows.select("doc_id", "t", F.filter(F.split("t", BLANK), lambda w: w != "").alias("w"),
                       F.filter(F.split("t", "\n"), lambda line: F.translate(line, BLANKS, "") != "").alias("lines"))
    t, w = F.col("t"), F.col("w")
    rows = rows.select(
        "doc_id",
        F.size(w).cast("long").alias("n_words"),
        without(t, BLANKS).cast("long").alias("word_chars"),
        (F.char_length(t) - without(t, SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(w).alias("n_repeat_words"),
        F.size("lines").alias("n_lines"),
        F.size(F.array_distinct(w)).alias("n_distinct"),
        F.size(F.filter(w, lambda x: x.isin(STOP_WORDS))).alias("n_stop"),
        (F.char_length(t) - without(t, CAPITALS)).alias("n_capitals"),
        (F.char_length(t) - without(t, "!|")).alias("n_marks"),
        (F.char_length(t) - without(t, ".?")).alias("n_stop_marks"),
    )
    n = F.col("n_words")
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((n < MIN_WORDS) | (100 * F.col("n_repeat_words") > 30 * n)).alias("base_failed"),
        share(F.col("n_symbols"), n).alias("symbol_rate"),
        share(F.col("n_capitals"), F.col("word_chars")).alias("capital_rate"),
        share(F.col("n_stop"), n).alias("stop_rate"),
        share(F.col("n_marks"), n).alias("mark_rate"),
        share(F.col("n_repeat_words"), n).alias("repeat_rate"),
        # Long texts use fewer new words: compare with the square root of the length.
        share(F.col("n_distinct"), F.least(n, 20 * F.sqrt(n))).alias("distinct_rate"),
        share(F.col("n_dup_lines"), F.col("n_lines")).alias("dup_line_rate"),
        share(F.col("word_chars"), n).alias("mean_word"),
        share(F.col("n_stop_marks"), n).alias("stop_mark_rate"),
    )


def votes(measured: DataFrame) -> DataFrame:
    """One column ``v_<rule>`` per rule; documents without words get no vote."""
    cast = {}
    for name, (feature, good, bad) in RULES.items():
        vote = F.when(F.expr(bad.format(feature)), -1).when(F.expr(good.format(feature)), 1).otherwise(0)
        cast[f"v_{name}"] = F.when(F.col("n_words") > 0, vote).otherwise(0).cast("tinyint")
    return measured.withColumns(cast)


def log_odds(model: dict) -> Column:
    """Log-odds of good, given the votes, under the rates of ``model``."""
    total = F.lit(math.log(model["prior"] / (1 - model["prior"])))
    for name in RULES:
        good, bad = model["good"][name], model["bad"][name]
        vote = F.col(f"v_{name}")
        weight = {v: math.log(good[v] / bad[v]) for v in (1, 0, -1)}
        total = total + F.when(vote == 1, weight[1]).when(vote == -1, weight[-1]).otherwise(weight[0])
    return total


def posterior(model: dict) -> Column:
    return 1 / (1 + F.exp(-log_odds(model)))


def estimate(patterns: DataFrame) -> dict:
    """Rates of the rules from the counted vote patterns (columns ``v_<rule>`` and ``n``)."""
    model = {"prior": PRIOR_GOOD} | {side: dict.fromkeys(RULES, START[side]) for side in ("good", "bad")}
    last = None
    for _ in range(PASSES):
        good, bad = F.col("n") * F.col("p"), F.col("n") * (1 - F.col("p"))
        sums = [F.sum(good).alias("good"), F.sum(bad).alias("bad")]
        for name in RULES:
            for v, tag in ((1, "up"), (-1, "down")):
                cast = F.col(f"v_{name}") == v
                sums.append(F.sum(F.when(cast, good).otherwise(0.0)).alias(f"good_{name}_{tag}"))
                sums.append(F.sum(F.when(cast, bad).otherwise(0.0)).alias(f"bad_{name}_{tag}"))
        got = patterns.withColumn("p", posterior(model)).agg(*sums).first()
        if not got["good"] and not got["bad"]:
            return model  # no rows
        total = {side: got[side] or 0.0 for side in ("good", "bad")}
        prior = (total["good"] + SMOOTHING * PRIOR_GOOD) / (total["good"] + total["bad"] + SMOOTHING)
        model = {"prior": prior, "good": {}, "bad": {}}
        for side in ("good", "bad"):
            for name in RULES:
                made_up = START[side]
                rate = {v: ((got[f"{side}_{name}_{tag}"] or 0.0) + SMOOTHING * made_up[v]) / (total[side] + SMOOTHING)
                        for v, tag in ((1, "up"), (-1, "down"))}
                model[side][name] = rate | {0: 1 - rate[1] - rate[-1]}
        flat = [prior] + [model[s][r][v] for s in ("good", "bad") for r in RULES for v in (1, -1)]
        if last and max(abs(a - b) for a, b in zip(flat, last)) < TOLERANCE:
            break
        last = flat
    return model


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: float = KEEP) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    good_probability) of every row of ``docs``."""
    voted = Written(votes(measures(docs, doc_id, text)), "rule_votes")
    names = [f"v_{name}" for name in RULES]
    patterns = Written(voted.df.where("n_words > 0").groupBy(*names).agg(F.count(F.lit(1)).alias("n")).coalesce(1),
                       "vote_patterns")
    model = estimate(patterns.df)
    patterns.drop()
    p = posterior(model)
    return voted.df.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (p >= keep)).alias("kept"), p.alias("good_probability"))


def keep(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text}`").alias("text"))
    return judge(rows, "row").where("kept").select("doc_id.*")
