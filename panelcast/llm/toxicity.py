"""Toxicity scores: boosted trees over dense features, calibrated by isotonic regression.

Features: densities of a lexicon, its hits near second-person words, capitals, punctuation,
obfuscated words. The lexicon is learned from the labelled rows: words and word beginnings
with the log-odds of the label among documents that hold them. It is cross-fitted: rows are
dealt to ``FOLDS`` parts by the hash of their id, and a labelled row is measured with a
lexicon that did not see its part, so the trees meet the lexicon as it works on new text. The
last part is kept from the trees and calibrates their margins.

Fits read at most about ``TRAIN_ROWS`` labelled rows, the ones with the smallest hashes, which
bounds the lexicon and the sample sent to the driver. Scores read every whole text.

Cases: a null text is read as empty and gets a score; labels that are null or whose document
is absent are not used, a document labelled twice is toxic if one label says so; null ids are
kept and never held out; repeated rows score alike; ``labels`` without a toxic row, or empty,
gives equal scores of 0; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm import boosting
from panelcast.llm.tables import Written

# Expected number of labelled rows that the fits read at most.
TRAIN_ROWS = 30_000
FOLDS = 5
# A lexicon entry stands in so many toxic documents; entries kept at most, the rarest go first.
MIN_TOXIC = 3
MAX_ENTRIES = 50_000
BEGINNINGS = (4, 5, 6, 7)
STRONG, MEDIUM = 3.0, 1.5
PREDICT_AT = 0.7
# Words around a hit in which a second-person word counts as near.
NEAR = 5
CACHE_SIZE = 500_000

WORD = re.compile(r"[^\W\d_]+")
TOKEN = re.compile(r"\S+")
# Second-person words of four languages.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos "
    "tú ti tus usted ustedes vosotros vuestro".split())
# A word broken up by digits or signs between letters.
OBFUSCATED = re.compile(r"[^\W\d_][\d@$*#!]+[^\W\d_]")

FEATURES = [
    "n_words", "strong_hits", "strong_types", "strong_density", "medium_density", "best_weight", "top3_weight",
    "mean_top", "near_person", "person_density", "capital_share", "shouted_share", "mark_share", "exclaim_share",
    "obfuscated_share", "digit_share", "mean_length",
]


def entries_of(word: str) -> list[str]:
    """A word, unless it is overlong, and its beginnings; a beginning ends in a star."""
    return [*[word][:len(word) <= 40], *[word[:k] + "*" for k in BEGINNINGS if len(word) >= k]]


def log_odds(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Smoothed log-odds of holding an entry, toxic against clean documents."""
    a = (toxic + 0.1) / (n_toxic + 1)
    b = (clean + 0.1 * max(n_clean, 1) / max(n_toxic, 1)) / (n_clean + 1)
    return np.log(a / b) * np.minimum(1.0, toxic / MIN_TOXIC)


class Lexicon:
    """Weight of a word under the lexicon without one part (``FOLDS``: with all parts)."""

    def __init__(self, weights: dict[str, np.ndarray], part: int):
        self.weights, self.part, self.cache = weights, part, {}

    def __getitem__(self, word: str) -> float:
        known = self.cache.get(word)
        if known is None:
            if len(self.cache) > CACHE_SIZE:
                self.cache.clear()
            found = [self.weights[e][self.part] for e in entries_of(word) if e in self.weights]
            known = self.cache[word] = float(max(found, default=0.0))
        return known


def features(text: str, lexicon: Lexicon) -> list[float]:
    words = WORD.findall(text.lower())
    n = len(words)
    weights = [lexicon[w] for w in words]
    strong = [i for i, x in enumerate(weights) if x >= STRONG]
    medium = sum(x >= MEDIUM for x in weights)
    top = sorted({w: x for w, x in zip(words, weights) if x > 0}.values(), reverse=True)[:3]
    person = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    near = sum(1 for i in strong if not SECOND_PERSON.isdisjoint(words[max(0, i - NEAR):i + NEAR + 1]))
    tokens = TOKEN.findall(text)
    letters = sum(map(len, words))
    seen = max(len(text) - text.count(" "), 1)
    return [
        float(n), float(len(strong)), float(len({words[i] for i in strong})), len(strong) / max(n, 1),
        medium / max(n, 1), max(top, default=0.0), sum(top), sum(top) / max(len(top), 1),
        float(near), len(person) / max(n, 1),
        sum(map(str.isupper, text)) / seen, sum(t.isupper() and len(t) > 2 for t in tokens) / max(len(tokens), 1),
        (seen - letters) / seen, text.count("!") / max(len(tokens), 1),
        sum(1 for t in tokens if OBFUSCATED.search(t)) / max(len(tokens), 1),
        sum(map(str.isdigit, text)) / seen, letters / max(n, 1),
    ]


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def training_rows(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Written:
    """(text, toxic, part) of the labelled rows that are not held out, by hash up to the bound."""
    known = (labels.where("toxic is not null and doc_id is not null").groupBy("doc_id")
             .agg(F.max("toxic").cast("int").alias("toxic")).where(remainder(F.col("doc_id")) != 1))
    known = Written(known, "toxic_labels").df
    total = known.count()
    place = F.pmod(F.xxhash64(F.lit("train"), "doc_id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    chosen = known.where(place < (min(1.0, train_rows / total) if total else 1.0))
    # The choice is bounded by its own parameter, so it may be sent to all tasks.
    return Written(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(
        F.coalesce("text", F.lit("")).alias("text"), "toxic",
        F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(FOLDS)).cast("int").alias("part")), "toxic_train")


def learn_lexicon(train: DataFrame) -> dict[str, np.ndarray]:
    """Entry -> its weight without each part, and last with all parts."""

    def held(rows: DataFrame, wanted: dict | None) -> DataFrame:
        def count(batches):
            seen: Counter = Counter()
            for batch in batches:
                for text, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    own = {e for w in set(WORD.findall(text.lower())) for e in entries_of(w)}
                    seen.update((e, part) for e in own if wanted is None or e in wanted)
            rows_out = [(e, p, n) for (e, p), n in seen.items()]
            columns = list(zip(*rows_out)) if rows_out else [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64())],
                names=["entry", "part", "n"])

        counted = rows.select("text", "part").mapInArrow(count, "entry string, part int, n long")
        return counted.groupBy("entry").agg(*[
            F.sum(F.when(F.col("part") == p, F.col("n")).otherwise(0)).alias(f"p{p}") for p in range(FOLDS)],
            F.sum("n").alias("n"))

    sizes = {(r["toxic"], r["part"]): r["n"] for r in
             train.groupBy("toxic", "part").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic = held(train.where("toxic = 1"), None).where(F.col("n") >= MIN_TOXIC)
    toxic = toxic.orderBy(F.desc("n"), "entry").limit(MAX_ENTRIES).collect()
    parts = range(FOLDS)
    hits = {r["entry"]: np.array([r[f"p{p}"] for p in parts]) for r in toxic}
    wanted = dict.fromkeys(hits)
    clean = {r["entry"]: np.array([r[f"p{p}"] for p in parts])
             for r in held(train.where("toxic = 0"), wanted).collect()}
    n = [np.array([sizes.get((x, p), 0) for p in parts]) for x in (0, 1)]
    weights = {}
    for entry, own in hits.items():
        other = clean.get(entry, np.zeros(FOLDS))
        without = [log_odds(own.sum() - own[p], other.sum() - other[p], n[1].sum() - n[1][p], n[0].sum() - n[0][p])
                   for p in parts]
        weight = np.array([*without, log_odds(own.sum(), other.sum(), n[1].sum(), n[0].sum())])
        if weight.max() >= MEDIUM:
            weights[entry] = weight
    return weights


def measured(train: DataFrame, weights: dict[str, np.ndarray]) -> DataFrame:
    """Features of the training rows under the lexicon without their part."""
    shared = train.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        lexicons = [Lexicon(shared.value, p) for p in range(FOLDS)]
        for batch in batches:
            rows = [features(t, lexicons[p]) for t, p in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())]
            x = np.array(rows, dtype=float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).cast(pa.float64()), batch.column(2), *[pa.array(c) for c in x.T]],
                names=["toxic", "part", *FEATURES])

    fields = ", ".join(f"{f} double" for f in FEATURES)
    return train.select("text", "toxic", "part").mapInArrow(run, f"toxic double, part int, {fields}")


def calibrate(rows: DataFrame, trees: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic steps (margin, share of toxic rows) on rows that the trees did not see."""

    def run(batches):
        for batch in batches:
            x = np.column_stack([batch.column(f).to_numpy() for f in FEATURES])
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(boosting.margin(trees, x))],
                                             names=["toxic", "margin"])

    scored = rows.select("toxic", *FEATURES).mapInArrow(run, "toxic double, margin double")
    if not trees or not scored.limit(1).count():
        return np.array([0.0]), np.array([0.0])
    points = VectorAssembler(inputCols=["margin"], outputCol="features").transform(scored)
    model = IsotonicRegression(labelCol="toxic", featuresCol="features").fit(points)
    return model.boundaries.toArray(), model.predictions.toArray()


def score(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, predict_at: float = PREDICT_AT) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``."""
    train = training_rows(docs, labels, train_rows)
    weights = learn_lexicon(train.df)
    table = Written(measured(train.df, weights).repartition(8), "toxic_features")
    train.drop()
    trees = boosting.fit(table.df.where(F.col("part") < FOLDS - 1), FEATURES, "toxic")
    steps = calibrate(table.df.where(F.col("part") == FOLDS - 1), trees)
    table.drop()
    shared = docs.sparkSession.sparkContext.broadcast((weights, trees, steps))

    def run(batches):
        weights, trees, (at, share) = shared.value
        lexicon = Lexicon(weights, FOLDS)
        for batch in batches:
            rows = [features(t.as_py() or "", lexicon) for t in batch.column(2)]
            margins = boosting.margin(trees, np.array(rows, dtype=float).reshape(-1, len(FEATURES)))
            # The steps are flat in places: a thousandth of the plain score orders rows there.
            scores = 0.999 * np.interp(margins, at, share) + 0.001 * boosting.probability(margins)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores if trees else np.zeros(len(scores)))],
                names=["doc_id", "held_out", "score"])

    rows = docs.select("doc_id", F.coalesce(remainder(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= predict_at).cast("int"))
