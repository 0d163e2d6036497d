"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model reads every trusted document that is not held out. Its n-grams are counted and smoothed
by Spark aggregates and joins, and kept in a table that is bucketed by shard, a range of the n-grams'
hashes. Scores come from joins with that table: the logarithm of an interpolated probability is a sum
of numbers that belong to one n-gram each, what it adds when its last word is predicted and when it is
the context, so the n-grams of a document are joined one by one, in any order, and added up. N-grams
cross the network as array columns, a row per group of texts and shard, and are joined shard by shard.
N-grams that are frequent in the trusted text are looked up before the shuffle, in a table of bounded
size that goes to all tasks; this saves entries and leaves no hot key. Documents and model are worked
off in slices, so that the disk holds the n-grams of one slice at a time. A document is kept if its
perplexity is at most its language's quantile among trusted documents that the model did not read.

The most frequent words go to all tasks too; if the vocabulary is longer than that, a join tells each
text which of its other words are in it.

Cases: a null or empty text has no tokens, no perplexity and is not kept; a language without
trusted documents, or a null one, takes the quantile of all; without trusted documents there
is no threshold and every text with a token is kept; labels that are null are not trusted, a
document labelled twice is trusted if all labels say so; null ids and repeated rows are scored
each; other columns are ignored; an empty table gives an empty result. Texts of any length are
scored whole. Texts and n-grams are joined by hashes of 64 bits.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.tables import Bucketed, Written

# Share of the trusted documents that set the thresholds instead.
HELD_SHARE = 0.4
# Texts are read together up to so many tokens, which fit a processor's cache.
GROUP_TOKENS = 100_000
QUANTILE = 0.995
MIN_COUNT = 2
# Words longer than this count by their shape.
LONGEST = 64
# Words and n-grams at most that go to all tasks; the others are joined.
FREQUENT_WORDS = 1 << 20
FREQUENT_GRAMS = 1 << 20
# Trigrams in a shard, bytes of text and trigrams in a slice, and slices at most.
BUCKET_GRAMS = 500_000
SLICE_BYTES = 8_000_000
SLICE_GRAMS = 1_000_000
SLICES = 7
# Words outside the vocabulary count by their shape: 0 to 4.
START, END = 5, 6
# Count of the n-grams of starts, which every text holds: past all others.
STARTS = 1 << 40
# The least weight of the lower order, so that its logarithm exists.
LEAST = 1e-9

TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]|_")
# Kinds of characters: a token is a run of letters, a run of figures or one sign; the others are white space.
SIGN = 3
KINDS = {1: r"[^\W\d_]", 2: r"\d", SIGN: r"[^\w\s]|_"}
# A token's hash is a polynomial of its characters' numbers; the factor has an inverse modulo 2^64.
FACTOR = 0x9E3779B97F4A7C13


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall(text or "")


def shape(token: str) -> int:
    """Class of an unknown word: lower case, capitalised, capitals, number, sign."""
    if token.isdigit():
        return 3
    if not token.isalpha():
        return 4
    return 0 if token.islower() else 2 if len(token) > 1 and token.isupper() else 1


def place(salt: str, key: str) -> Column:
    """A number from 0 to 1 that belongs to the key."""
    return F.pmod(F.xxhash64(F.lit(salt), key), F.lit(1 << 40)) / F.lit(float(1 << 40))


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


@functools.cache
def characters() -> tuple[np.ndarray, np.ndarray]:
    """(kind, number) of every character."""
    every = "".join(map(chr, range(0x110000)))
    kinds = np.zeros(len(every), np.uint8)
    for kind, pattern in KINDS.items():
        kinds[[ord(c) for c in re.findall(pattern, every)]] = kind
    return kinds, mixed(np.arange(1, len(every) + 1, dtype=np.uint64))


class Tokens:
    """The tokens of some texts in order: hashes, places in the joined texts, and number in each text."""

    def __init__(self, texts: list[str]):
        self.text = "\n".join(texts) + "\n"
        codes = np.frombuffer(self.text.encode("utf-32-le"), np.uint32)
        kinds, numbers = characters()
        kind = kinds[codes]
        differs = kind[1:] != kind[:-1]
        alone, some = kind == SIGN, kind != 0
        self.begin = np.flatnonzero(some & (np.concatenate([[True], differs]) | alone))
        self.end = np.flatnonzero(some & (np.concatenate([differs, [True]]) | alone)) + 1
        powers = lambda factor: np.cumprod(np.full(len(codes), factor, dtype=np.uint64))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(numbers[codes] * powers(FACTOR))])
        self.hash = mixed((sums[self.end] - sums[self.begin]) * powers(pow(FACTOR, -1, 1 << 64))[self.begin])
        starts = np.cumsum([0, *[len(t) + 1 for t in texts]])
        self.sizes = np.diff(np.searchsorted(self.begin, starts))

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hash, place of one, number) of the different tokens, and which of them each token is."""
        order = np.argsort(self.hash)
        ordered = self.hash[order]
        first = firsts(ordered)
        n = np.diff(first, append=len(order))
        which = np.empty(len(order), np.int64)
        which[order] = np.repeat(np.arange(len(first)), n)
        return ordered[first], order[first], n, which

    def strings(self, places: np.ndarray) -> list[str]:
        return [self.text[i:j] for i, j in zip(self.begin[places].tolist(), self.end[places].tolist())]


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go as soon as their query ends, not when the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def trusted(docs: DataFrame, labels: DataFrame) -> tuple[Written, DataFrame]:
    """(texts to learn from, ids of the trusted documents that set thresholds)."""
    known = Written(labels.where("doc_id is not null").groupBy("doc_id").agg(F.min(F.coalesce("quality", F.lit(0))).alias("q"))
                    .where("q = 1").select("doc_id"), "trusted").df
    learn = known.where(place("held", "doc_id") >= HELD_SHARE)
    texts = Written(docs.join(learn, "doc_id").where("text is not null").select("text"), "trusted_texts")
    return texts, known.where(place("held", "doc_id") < HELD_SHARE)


def least_count(counted: DataFrame, limit: int) -> int:
    """The least n that at most ``limit`` rows reach."""
    capped = counted.groupBy(F.least("n", F.lit(1 << 16)).alias("n")).count().orderBy(F.desc("n"))
    least, room = STARTS, limit
    for row in capped.collect():
        room -= row["count"]
        if room < 0:
            break
        least = row["n"]
    return least


def vocabulary(texts: DataFrame) -> tuple[dict[str, int], DataFrame | None, int]:
    """(ids of the frequent ones of the words that occur twice or more, the others, number of all)."""

    def split(batches):
        for batch in batches:
            for group in groups(batch, 6):
                found = Tokens([text for text, *_ in group])
                _, places, n, _ = found.distinct()
                short = found.end[places] - found.begin[places] <= LONGEST
                yield pa.RecordBatch.from_arrays([pa.array(found.strings(places[short]), pa.string()), pa.array(n[short])], names=["token", "n"])

    counted = texts.mapInArrow(split, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))
    counted = Written(counted.where(F.col("n") >= MIN_COUNT), "vocabulary").df
    total, least = counted.count(), least_count(counted, FREQUENT_WORDS)
    found = counted.where(F.col("n") >= least).toArrow()
    order = np.lexsort((np.array(found["token"].to_pylist(), dtype=object), -found["n"].to_numpy())) if len(found) else []
    ids = {t: k for k, t in enumerate(found["token"].take(pa.array(order, pa.int64())).to_pylist(), END + 1)}
    return ids, counted.where(F.col("n") < least).select("token") if len(ids) < total else None, total


def rare_id(token: str) -> int:
    """Id of a word that is not among the frequent ones: negative."""
    return -(xxhash.xxh64_intdigest(token) >> 1) - 2


def hashed(ids: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """(sorted hashes, ids) of the words."""
    hashes = Tokens([" ".join(ids)]).hash
    order = np.argsort(hashes)
    return hashes[order], np.fromiter(ids.values(), np.int64, len(ids))[order]


def sequences(rows: list[tuple], known: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, each between two starts and an end, their lengths) of rows (text, id, own); the own
    words of a text are its words of the vocabulary that are not ``known``."""
    found = Tokens([r[0] for r in rows])
    distinct, places, _, which = found.distinct()
    rare = {t: rare_id(t) for _, _, own in rows for t in own or ()}
    at, seen = found_in(known[0], distinct)
    ids = np.zeros(len(distinct), dtype=np.int64)
    ids[seen] = known[1][at[seen]]
    ids[~seen] = [rare[t] if t in rare else shape(t) for t in found.strings(places[~seen])]
    sizes = found.sizes + 3
    start = np.cumsum(sizes) - sizes
    out, inside = np.full(sizes.sum(), START, dtype=np.int64), np.ones(sizes.sum(), dtype=bool)
    out[start + sizes - 1] = END
    for edge in (start, start + 1, start + sizes - 1):
        inside[edge] = False
    out[inside] = ids[which]
    return out, sizes


def groups(batch: pa.RecordBatch, times: int = 1) -> Iterator[list[tuple]]:
    """Rows of a batch, together up to ``times`` the bound; the first column is the text."""
    waiting, room = [], 0
    for row in zip(*(c.to_pylist() for c in batch.columns)):
        waiting.append(row)
        room += len(row[0])
        if room > 5 * times * GROUP_TOKENS:
            yield waiting
            waiting, room = [], 0
    if waiting:
        yield waiting


@contextmanager
def sent(spark: SparkSession, value) -> Iterator[Broadcast]:
    """``value`` at all tasks, until the block ends."""
    shared = spark.sparkContext.broadcast(value)
    try:
        yield shared
    finally:
        shared.destroy()


def with_own_words(texts: DataFrame, shared: Broadcast, rare: DataFrame | None) -> DataFrame:
    """(text, id, own) of the rows of ``texts``: own words are those of the vocabulary that are not among the
    frequent words, which are ``shared``."""
    known = texts.select("text", F.xxhash64("text").alias("id"))
    if rare is None:
        return known.withColumn("own", F.lit(None).cast("array<string>"))

    def others(batches):
        for batch in batches:
            for text, key in zip(*(c.to_pylist() for c in batch.columns)):
                found = Tokens([text])
                distinct, places, _, _ = found.distinct()
                places = places[~found_in(shared.value[0], distinct)[1]]
                words = found.strings(places[found.end[places] - found.begin[places] <= LONGEST])
                yield pa.RecordBatch.from_arrays([pa.array([key] * len(words), pa.int64()), pa.array(words, pa.string())], names=["id", "token"])

    own = known.mapInArrow(others, "id long, token string").distinct().join(rare, "token", "left_semi")
    return known.join(own.groupBy("id").agg(F.collect_list("token").alias("own")), "id", "left").select("text", "id", "own")


def keys(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the n-grams abc, bc and c."""
    one = mixed(c.astype(np.uint64) + np.uint64(0x2545F4914F6CDD1D))
    two = mixed(one + b.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    three = mixed(two + a.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    return three.view(np.int64), two.view(np.int64), one.view(np.int64)


def shard_of(key: np.ndarray, shards: int) -> np.ndarray:
    """Shards are ranges of hashes: sorted hashes are sorted by shard."""
    return (((key >> 32) + (1 << 31)) * shards >> 32).astype(np.int32)


def blocks(shard: np.ndarray, columns: dict[str, np.ndarray]) -> pa.Table:
    """A row per shard of the sorted ``shard``, with its part of each column as an array; empty columns give empty ones."""
    first = firsts(shard)
    edges = pa.array(np.append(first, len(shard)).astype(np.int32))
    none = pa.array(np.zeros(len(first) + 1, np.int32))
    return pa.table({"shard": shard[first], **{
        name: pa.ListArray.from_arrays(edges if len(values) == len(shard) else none, pa.array(values)) for name, values in columns.items()}})


def firsts(*sorted_columns: np.ndarray) -> np.ndarray:
    """Where rows differ from the row before."""
    if not len(sorted_columns[0]):
        return np.empty(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], np.any([x[1:] != x[:-1] for x in sorted_columns], axis=0)]))


def flat(table: pa.Table | pa.RecordBatch, name: str, kind: type = np.int64) -> np.ndarray:
    """The entries of all arrays of a column."""
    column = table.column(name)
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    return np.concatenate([np.empty(0, kind), *[c.flatten().to_numpy(zero_copy_only=False) for c in chunks]])


def lengths(table: pa.Table, name: str) -> np.ndarray:
    """The lengths of all arrays of a column; null has none."""
    return np.array([0 if n is None else n for n in pc.list_value_length(table.column(name)).to_pylist()], dtype=np.int64)


def found_in(known: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places in the sorted ``known``, whether they hold what is wanted)."""
    if not len(known):
        return np.zeros(len(wanted), dtype=np.int64), np.zeros(len(wanted), dtype=bool)
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return at, known[at] == wanted


def trigram_counts(texts: DataFrame, shared: Broadcast, rare: DataFrame | None, shards: int) -> DataFrame:
    """(shard, a, b, c, n): the trigrams of the texts, sorted, a row per shard of the first two words."""

    def counted(a: np.ndarray, b: np.ndarray, c: np.ndarray, n: np.ndarray) -> pa.Table:
        shard = shard_of(keys(a, a, b)[1], shards)
        if max(x.max() for x in (a, b, c)) < 1 << 21 and min(x.min() for x in (a, b, c)) >= 0:
            order = np.argsort(a << 42 | b << 21 | c)
            order = order[np.argsort(shard[order], kind="stable")]
        else:
            order = np.lexsort((c, b, a, shard))
        a, b, c, n, shard = (x[order] for x in (a, b, c, n, shard))
        first = firsts(a, b, c)
        return blocks(shard[first], {"a": a[first], "b": b[first], "c": c[first], "n": np.add.reduceat(n, first)})

    def explode(batches):
        for batch in batches:
            for group in groups(batch):
                s, _ = sequences(group, shared.value)
                inner = s[2:] != START
                a, b, c = s[:-2][inner], s[1:-1][inner], s[2:][inner]
                yield from counted(a, b, c, np.ones(len(a), dtype=np.int64)).to_batches()

    def add_up(part: pa.Table) -> pa.Table:
        return counted(*[flat(part, x) for x in "abcn"])

    kind = "shard int, a array<long>, b array<long>, c array<long>, n array<long>"
    return with_own_words(texts, shared, rare).mapInArrow(explode, kind).groupBy("shard").applyInArrow(add_up, kind)


def pair_counts(trigrams: DataFrame, shards: int) -> DataFrame:
    """(b, c, n) of the bigrams. Lower orders count the different words to the left instead of occurrences;
    n-grams that begin a text have no word to their left and keep their occurrences."""

    def counted(b: np.ndarray, c: np.ndarray, left: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, ...]:
        key = keys(b, b, c)[1]
        order = np.argsort(key)
        first = firsts(key[order])
        which = order[first]
        return key[which], b[which], c[which], np.add.reduceat(left[order], first), np.maximum.reduceat(begins[order], first)

    def split(batches):
        for batch in batches:
            a, b, c, n = (flat(batch, x) for x in "abcn")
            if len(a):
                key, b, c, left, begins = counted(b, c, np.ones(len(a), dtype=np.int64), np.where((a == START) & (b == START), n, 0))
                yield from blocks(shard_of(key, shards), {"b": b, "c": c, "n": left, "begins": begins}).to_batches()

    def add_up(part: pa.Table) -> pa.Table:
        _, b, c, left, begins = counted(*[flat(part, x) for x in ("b", "c", "n", "begins")])
        return pa.table({"b": b, "c": c, "n": np.maximum(left, begins)})

    parts = trigrams.select("a", "b", "c", "n").mapInArrow(split, "shard int, b array<long>, c array<long>, n array<long>, begins array<long>")
    return parts.groupBy("shard").applyInArrow(add_up, "b long, c long, n long")


def discounts(counted: DataFrame) -> list[float]:
    """Modified Kneser-Ney discounts of counts 0, 1, 2 and 3 or more."""
    found = {r["n"]: r["count"] for r in counted.where("n between 1 and 4").groupBy("n").count().collect()}
    n = [0.0, *[float(found.get(k, 0)) for k in (1, 2, 3, 4)]]
    if not all(n[1:]):  # too few words to tell; the customary fixed values
        return [0.0, 0.5, 0.75, 0.9]
    y = n[1] / (n[1] + 2 * n[2])
    return np.clip([0.0, *[k - (k + 1) * y * n[k + 1] / n[k] for k in (1, 2, 3)]], 0.0, [0.0, 0.99, 1.9, 2.9]).tolist()


def cut(d: list[float]) -> Column:
    return F.when(F.col("n") == 1, d[1]).when(F.col("n") == 2, d[2]).otherwise(d[3])


def contexts(pairs: DataFrame, d: list[float]) -> DataFrame:
    """(b, total, left): each first word's count and its weight of the lower order."""
    return pairs.groupBy("b").agg(F.sum("n").alias("total"), F.greatest(F.sum(cut(d)) / F.sum("n"), F.lit(LEAST)).alias("left"))


MODEL = "shard int, key array<long>, n array<long>, delta array<float>, back array<float>"


def model_rows(shards: int, key: np.ndarray, n: np.ndarray, delta: np.ndarray, back: np.ndarray) -> pa.Table:
    """N-grams as rows of the model's table."""
    order = np.argsort(key)
    return blocks(shard_of(key[order], shards), {"key": key[order], "n": n[order], "delta": delta[order].astype(np.float32),
                                                 "back": back[order[:len(back)]].astype(np.float32)})


def word_rows(words: DataFrame, shards: int) -> DataFrame:
    """(c, n, delta, back) as rows of the model's table."""

    def run(batches):
        for batch in batches:
            c, n, delta, back = (batch.column(k).to_numpy() for k in range(4))
            yield from model_rows(shards, keys(c, c, c)[2], n, delta, back).to_batches()

    return words.select("c", "n", "delta", "back").mapInArrow(run, MODEL)


def pair_rows(pairs: DataFrame, shards: int) -> DataFrame:
    """(shard, key, n, p, delta): the bigrams of (b, c, n, p, delta) as arrays."""

    def run(batches):
        waiting, room = [], 0
        for batch in batches:
            waiting.append(batch)
            room += batch.num_rows
            if room >= BUCKET_GRAMS:
                yield from dealt(waiting)
                waiting, room = [], 0
        if room:
            yield from dealt(waiting)

    def dealt(batches):
        b, c, n, p, delta = (x.to_numpy() for x in pa.Table.from_batches(batches).columns)
        key = keys(b, b, c)[1]
        order = np.argsort(key)
        return blocks(shard_of(key[order], shards), {"key": key[order], "n": n[order], "p": p[order], "delta": delta[order]}).to_batches()

    return pairs.select("b", "c", "n", "p", "delta").mapInArrow(run, "shard int, key array<long>, n array<long>, p array<float>, delta array<float>")


def trigram_rows(trigrams: DataFrame, pairs: DataFrame, d: list[float], shards: int, low: int, high: int) -> DataFrame:
    """The trigrams whose last two words lie in shards ``low`` to ``high``, and these bigrams, which are ``pairs``,
    as rows of the model's table."""

    def split(batches):
        for batch in batches:
            a, b, c, n = (flat(batch, x) for x in "abcn")
            if not len(a):
                continue
            first = firsts(a, b)
            size = np.diff(first, append=len(a))
            cut = np.array([0.0, *d[1:]])[np.minimum(n, 3)]
            total = np.add.reduceat(n, first)
            left = np.maximum(np.add.reduceat(cut, first) / total, LEAST)
            gram, pair, _ = keys(a, b, c)
            yield from wanted(False, pair, (n - cut) / np.repeat(total * left, size), gram, n)
            yield from wanted(True, keys(a[first], a[first], b[first])[1], np.log(left))

    def wanted(contexts: bool, pair: np.ndarray, value: np.ndarray, *own: np.ndarray):
        shard = shard_of(pair, shards)
        here = np.flatnonzero((shard >= low) & (shard < high))
        here = here[np.argsort(shard[here], kind="stable")]
        gram, n = (x[here] for x in own) if own else [np.empty(0, np.int64)] * 2
        table = blocks(shard[here], {"pair": pair[here], "gram": gram, "n": n, "value": value[here]})
        return table.append_column("contexts", pa.array([contexts] * table.num_rows, pa.bool_())).to_batches()

    def join(grams: pa.Table, known: pa.Table) -> pa.Table:
        key = flat(known, "key")
        order = np.argsort(key)
        key, n, p, delta = (x[order] for x in (key, flat(known, "n"), flat(known, "p", np.float32), flat(known, "delta", np.float32)))
        before, grams = grams.filter(pc.field("contexts")), grams.filter(~pc.field("contexts"))
        # Every trigram's last two words are a bigram.
        at, _ = found_in(key, flat(grams, "pair"))
        three = model_rows(shards, flat(grams, "gram"), flat(grams, "n"), np.log1p(flat(grams, "value", np.float64) / p[at]), np.empty(0))
        context, left = flat(before, "pair"), flat(before, "value", np.float64).astype(np.float32)
        at, seen = found_in(key, context)
        back = np.zeros(len(key), np.float32)
        back[at[seen]] = left[seen]
        # The two starts are a context only.
        alone = np.zeros((~seen).sum(), np.float32)
        two = model_rows(shards, np.concatenate([key, context[~seen]]), np.concatenate([n, np.full(len(alone), STARTS)]),
                         np.concatenate([delta, alone]), np.concatenate([back, left[~seen]]))
        return pa.concat_tables([three, two])

    parts = trigrams.select("a", "b", "c", "n").mapInArrow(
        split, "shard int, pair array<long>, gram array<long>, n array<long>, value array<double>, contexts boolean")
    return parts.groupBy("shard").cogroup(pairs.groupBy("shard")).applyInArrow(join, MODEL)


def train(texts: DataFrame) -> dict:
    """The model: ids of the frequent words, the rare words, and the table of all n-grams.

    ``delta`` of an n-gram is what it adds to the logarithm of its last word's probability beyond
    the shorter n-gram, ``back`` what it adds as the context of any next word. ``floor`` is the
    logarithm for a word never seen."""
    return smooth(*count(texts))


def count(texts: DataFrame) -> tuple[dict[str, int], DataFrame | None, int, Written]:
    """(ids of the frequent words, the rare ones, number of all, trigrams with their counts)."""
    spark = texts.sparkSession
    with swept(spark):
        ids, rare, n_words = vocabulary(texts)
        size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        with sent(spark, hashed(ids)) as shared:
            return ids, rare, n_words, Written(trigram_counts(texts, shared, rare, 1 + size // (5 * BUCKET_GRAMS)), "trigrams")


def smooth(ids: dict[str, int], rare: DataFrame | None, n_words: int, counts: Written) -> dict:
    """The model from its counts, which are dropped."""
    with swept(counts.spark):
        return _smooth(ids, rare, n_words, counts)


def _smooth(ids: dict[str, int], rare: DataFrame | None, n_words: int, counts: Written) -> dict:
    size, spark = n_words + END, counts.spark
    n_grams = counts.df.agg(F.sum(F.size("n"))).first()[0] or 0
    shards, slices = 1 + n_grams // BUCKET_GRAMS, min(SLICES, 1 + n_grams // SLICE_GRAMS)
    tri, d3 = counts.df, discounts(counts.df.select(F.explode("n").alias("n")))
    pairs = Written(pair_counts(tri, shards), "pairs")
    bi, d2 = pairs.df, discounts(pairs.df)
    mono = Written(bi.groupBy("c").agg(F.count("*").alias("n")), "words").df
    d1 = discounts(mono)
    sums = mono.agg(F.sum("n").alias("n"), F.sum(cut(d1)).alias("cut")).first()
    left1 = max(sums["cut"] / sums["n"], LEAST) if sums["n"] else 1.0
    floor = math.log(left1 / size)
    words = mono.select("c", "n", ((F.col("n") - cut(d1)) / float(sums["n"] or 1) + left1 / size).alias("p"))

    before = Written(contexts(bi, d2), "word_contexts").df
    share, lower = (F.col("n") - cut(d2)) / F.col("total"), F.col("left") * F.col("p")
    two = bi.join(before, "b").join(words.select("c", "p"), "c").select(
        "b", "c", always("c").alias("n"), (share + lower).cast("float").alias("p"), F.log1p(share / lower).cast("float").alias("delta"))
    # A slice is a range of shards; its bigrams go when it is done.
    part_of = F.floor(((F.col("shard") + 1) * slices - 1) / shards).cast("int")
    two = Written(pair_rows(two, shards).withColumn("slice", part_of), "smoothed_pairs", "slice")
    pairs.drop()

    grams = Bucketed(spark, "shard", shards, "ngrams")
    one = words.select("c", "n", (F.log("p") - floor).alias("delta"), F.lit(0.0).alias("back")).unionByName(
        before.select(F.col("b").alias("c"), F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("delta"), F.log("left").alias("back")))
    one = one.groupBy("c").agg(*[F.sum(x).alias(x) for x in ("n", "delta", "back")])
    one = Written(one.withColumn("n", always("c")), "smoothed_words").df
    grams.append(word_rows(one, shards))
    for k in range(slices):
        low, high = k * shards // slices, (k + 1) * shards // slices
        grams.append(trigram_rows(tri, two.df.where(F.col("slice") == k).drop("slice"), d3, shards, low, high))
        two.drop(f"slice={k}")
    for table in (counts, two):
        table.drop()
    frequent = one.where("c >= 0").select("c", (F.col("delta").cast("float") + F.col("back").cast("float")).alias("weight")).toArrow()
    by_word = np.zeros(END + 1 + len(ids))
    by_word[frequent["c"].to_numpy()] = frequent["weight"].to_numpy()
    least = least_count(grams.df.select(F.explode("n").alias("n")), FREQUENT_GRAMS)
    often = entries(grams.df).where(F.col("n") >= least).select("key", (F.col("delta") + F.col("back")).alias("weight")).toArrow()
    order = np.argsort(often["key"].to_numpy())
    return {"ids": ids, "rare": rare, "size": size, "floor": floor, "table": grams, "shards": shards, "words": by_word,
            "often": (often["key"].to_numpy()[order], often["weight"].to_numpy()[order])}


def entries(model: DataFrame) -> DataFrame:
    """(key, n, delta, back) of the rows of the model's table."""
    each = model.select(F.explode(F.arrays_zip("key", "n", "delta", "back")).alias("gram"))
    return each.select("gram.key", "gram.n", "gram.delta", F.coalesce("gram.back", F.lit(0.0).cast("float")).alias("back"))


def always(word: str) -> Column:
    """Count of an n-gram, past all others for those of starts."""
    return F.when(F.col(word) == START, F.lit(STARTS)).otherwise(F.coalesce("n", F.lit(0)))


def log_probabilities(model: dict, ids: np.ndarray) -> np.ndarray:
    """Log-probability of every id from the third on, of a short sequence."""
    three, two, one = keys(ids[:-2], ids[1:-1], ids[2:])
    _, context, word = keys(ids[:-2], ids[:-2], ids[1:-1])
    wanted = np.unique(np.concatenate([three, two, one, context, word])).tolist()
    rows = {r["key"]: r for r in entries(model["table"].df).where(F.col("key").isin(wanted)).collect()}
    of = lambda found, name: np.array([rows[k][name] if k in rows else 0.0 for k in found.tolist()])
    return model["floor"] + sum(of(k, "delta") for k in (three, two, one)) + of(context, "back") + of(word, "back")


ASKED = "shard int, team long, texts long, key array<long>, times array<int>, doc array<int>, base array<double>, id array<long>, tokens array<int>"
ANSWERED = "team long, doc array<int>, log array<double>, id array<long>, tokens array<int>"


def exploded(texts: DataFrame, model: dict, words: Broadcast, often: Broadcast) -> DataFrame:
    """The n-grams of the texts. A team is a group of texts that one task reads together; it has a row per shard
    (key, times, doc) with its n-grams that are not frequent, how many texts' places follow for each, and these, and
    one row (base, id, tokens) with the sum over the frequent ones, the id and the number of tokens of each text."""
    floor, shards = model["floor"], model["shards"]

    def asked(rows: list[tuple], team: int):
        by_word, known, weights = often.value
        joined, sizes = sequences(rows, words.value)
        inner = joined[2:] != START
        each = np.arange(len(rows), dtype=np.int32)
        doc = np.repeat(each, sizes)[2:][inner]
        three, two, one = (k[inner] for k in keys(joined[:-2], joined[1:-1], joined[2:]))
        last = joined[2:][inner]
        rare = np.flatnonzero(last < 0)
        # The two starts are a context once in each text.
        pair = keys(*[np.array([START])] * 3)[1]
        key = np.concatenate([three, two, one[rare], np.repeat(pair, len(rows))])
        at = np.concatenate([doc, doc, doc[rare], each])
        order = np.argsort(key)
        key, at = key[order], at[order]
        first = firsts(key)
        key, times = key[first], np.diff(first, append=len(key))
        where, seen = found_in(known, key)
        hit = np.repeat(seen, times)
        value = np.repeat(weights[where[seen]], times[seen]) if len(known) else np.empty(0)
        base = np.bincount(at[hit], weights=value, minlength=len(rows)) + floor * (sizes - 2) + by_word[START]
        base += np.bincount(doc, weights=np.where(last < 0, 0.0, by_word[np.maximum(last, 0)]), minlength=len(rows))
        key, times, at = key[~seen], times[~seen].astype(np.int32), at[~hit]
        shard = shard_of(key, shards)
        table = blocks(shard, {"key": key, "times": times})
        edges = np.concatenate([[0], np.cumsum(times)])[np.append(firsts(shard), len(shard))]
        table = table.append_column("doc", pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(at)))
        whole = pa.table({"shard": pa.array([team % shards], pa.int32()), "base": [base], "id": [[r[1] for r in rows]],
                          "tokens": pa.array([(sizes - 3).tolist()], pa.list_(pa.int32()))})
        table = pa.concat_tables([table, whole], promote_options="default")
        table = table.add_column(1, "team", pa.array([team] * table.num_rows, pa.int64()))
        table = table.add_column(2, "texts", pa.array([len(rows)] * table.num_rows, pa.int64()))
        return table.to_batches()

    def run(batches):
        team = TaskContext.get().partitionId() << 32
        for batch in batches:
            for group in groups(batch):
                yield from asked(group, team)
                team += 1

    rows = with_own_words(texts, words, model["rare"])
    # Texts that come out of a join are put in order, so that a repeated task forms the same teams.
    return (rows if model["rare"] is None else rows.sortWithinPartitions("id")).mapInArrow(run, ASKED)


def answer(asked: pa.Table, grams: pa.Table) -> pa.Table:
    """A shard's sums over the n-grams of each text, as rows (team, doc, log), and the rows (base, id, tokens) as they are."""
    key, weight = flat(grams, "key"), flat(grams, "delta", np.float32).copy()
    weight[np.repeat(lengths(grams, "back") > 0, lengths(grams, "key"))] += flat(grams, "back", np.float32)
    order = np.argsort(key, kind="stable")
    key, weight = key[order], weight[order].astype(float)
    whole, asked = asked.filter(pc.field("id").is_valid()), asked.filter(pc.field("id").is_null())
    team, texts = asked["team"].to_numpy(), asked["texts"].to_numpy()
    start = np.cumsum(texts) - texts
    at, seen = found_in(key, flat(asked, "key"))
    times = flat(asked, "times", np.int32)
    text = (np.repeat(start, lengths(asked, "doc")) + flat(asked, "doc", np.int32))[np.repeat(seen, times)]
    sums = np.bincount(text, weights=np.repeat(weight[at[seen]], times[seen]), minlength=int(texts.sum())).astype(float)
    found = np.flatnonzero(sums)
    row = np.searchsorted(start, found, side="right") - 1
    table = blocks(row, {"doc": (found - start[row]).astype(np.int32), "log": sums[found]})
    table = table.set_column(0, "team", pa.array(team[table["shard"].to_numpy()]))
    base = pa.table({"team": whole["team"], "doc": pa.array([list(range(n)) for n in whole["texts"].to_pylist()], pa.list_(pa.int32())),
                     "log": whole["base"], "id": whole["id"], "tokens": whole["tokens"]})
    return pa.concat_tables([table, base], promote_options="default").select(["team", "doc", "log", "id", "tokens"])


def added_up(team: pa.Table) -> pa.Table:
    """(id, log, tokens) of the texts of a team."""
    ids = flat(team, "id")
    log = np.bincount(flat(team, "doc", np.int32), weights=flat(team, "log", np.float64), minlength=len(ids)).astype(float)
    return pa.table({"id": ids, "log": log, "tokens": flat(team, "tokens", np.int32).astype(np.int64)})


def perplexities(docs: DataFrame, model: dict, columns: list[str], text: str = "text") -> DataFrame:
    """``columns`` of ``docs`` with n_tokens and perplexity of the text."""
    texts = docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = min(SLICES, 1 + size // SLICE_BYTES)
    grams = model["table"].df.select("shard", "key", "delta", "back").groupBy("shard")
    spark = docs.sparkSession
    with swept(spark), sent(spark, hashed(model["ids"])) as words, sent(spark, (model["words"], *model["often"])) as often:
        parts = []
        for k in range(slices):
            asked = exploded(texts.where(F.pmod(F.xxhash64("text"), F.lit(slices)) == k), model, words, often)
            answered = asked.groupBy("shard").cogroup(grams).applyInArrow(answer, ANSWERED)
            parts.append(Written(answered.groupBy("team").applyInArrow(added_up, "id long, log double, tokens long"), "log_sums").df)
    sums = parts[0]
    for part in parts[1:]:
        sums = sums.unionByName(part)
    # Equal texts share an id and are scored each.
    sums = sums.groupBy("id").agg(F.max("tokens").alias("n_tokens"), F.max("log").alias("log"))
    sums = sums.select(F.col("id").alias("text_to_score"), "n_tokens",
                       F.when(F.col("n_tokens") > 0, F.exp(-F.col("log") / (F.col("n_tokens") + 1))).alias("perplexity"))
    rows = docs.select(*columns, F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("text_to_score"))
    return rows.join(sums, "text_to_score").select(*columns, "n_tokens", "perplexity")


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """(doc_id, lang, n_tokens, perplexity, threshold, kept) of every row of ``docs``."""
    with swept(docs.sparkSession):
        texts, held = trusted(docs, labels)
    counted = count(texts.df)
    texts.drop()
    model = smooth(*counted)
    scored = Written(perplexities(docs, model, ["doc_id", "lang"]), "perplexities").df
    model["table"].drop()
    measured = Written(scored.join(held, "doc_id").where("perplexity is not null").select("lang", "perplexity"), "held").df
    at = F.percentile_approx("perplexity", F.lit(quantile), F.lit(10_000)).alias("own")
    by_lang = measured.where("lang is not null").groupBy("lang").agg(at)
    every = measured.agg(at).first()["own"]
    return scored.join(by_lang, "lang", "left").select(
        "doc_id", "lang", "n_tokens", "perplexity",
        F.coalesce("own", F.lit(every).cast("double"), F.lit(float("inf"))).alias("threshold"),
    ).withColumn("kept", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(False)))
