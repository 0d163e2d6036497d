"""Benchmark decontamination by spaced seeds.

A seed is the hash of the words at the chosen positions of a fixed mask; the other positions
are ignored, so a seed still matches when words there were replaced. The seeds of the
benchmark are joined with those of every text, and around each hit the two texts are compared
word by word: the best stretch of the common diagonal, where a match counts 1 and a
substitution costs ``PENALTY``, must hold enough matches.

Equal item texts are searched once and their ids joined to what was found. The benchmark is
read in blocks of a bounded number of words. A block's seeds are sent to all tasks, so texts
are never shuffled; a larger benchmark means more blocks, not larger ones, and all blocks are
searched in one pass over the texts.

Items up to ``SHORT_ITEM`` words have masks of their own length. Every text is searched with a
few blank words at both ends, so that an item cut off by the edge of a text counts its missing
words as substitutions. Items under ``TOLERANT_ITEM`` words leak only as exact runs of words.

Cases: null, empty and wordless texts and items have no leak; a one-word item leaks wherever
its word stands; repeated rows and items are reported each; null ids are reported as null;
other columns are ignored; empty tables give no leaks. Texts of any length are searched whole.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType
from pyspark.sql.pandas.types import to_arrow_type

from panelcast.llm.tables import Written

WORD = re.compile(r"[^\W_]+")
# Fixed masks: 1 is compared, 0 is ignored. After any two substitutions in a passage of fifteen
# words one of them still matches somewhere, and after nearly any three.
MASKS = ("100011101001", "110010011001", "101001110001", "101000010111")
SPAN = 12
# Items up to so many words get masks of their own length as well.
SHORT_ITEM = 14
# Shorter items must match in all words.
TOLERANT_ITEM = 8
# Enough matches: this many words, or this share of a shorter item.
MIN_MATCH = 13
ITEM_SHARE = 0.8
PENALTY = 2
BLOCK_WORDS = 500_000
# Words of texts that are searched together.
GROUP_WORDS = 100_000
# Seeds are looked up in a table of bits first: 2 MB whatever the block holds.
FILTER_BITS = 24
CACHE_SIZE = 1_000_000


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > CACHE_SIZE:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "replace"))
        return value


def words_of(text: str | None, hashes: WordHashes) -> np.ndarray:
    found = WORD.findall((text or "").lower())
    return np.fromiter(map(hashes.__getitem__, found), dtype=np.uint64, count=len(found))


def multipliers() -> np.ndarray:
    draw = np.random.default_rng(11)
    return draw.integers(1, 2**63, size=max(SPAN, SHORT_ITEM), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(29))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


def seeds(words: np.ndarray, mask: str, salt: int) -> np.ndarray:
    """Hash of the compared words of every window of the mask's length."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    factor = multipliers()
    total = np.full(n, salt, dtype=np.uint64)
    for k, bit in enumerate(mask):
        if bit == "1":
            total += words[k:k + n] * factor[k]
    return mixed(total)


def needed(n_words: int) -> int:
    """Matching words that make a leak of an item of so many words."""
    if n_words < TOLERANT_ITEM:
        return n_words
    return int(min(MIN_MATCH, -(-n_words * ITEM_SHARE // 1)))


# Blank words before and after each text: as many as an item with masks of its own may miss.
EDGE = np.zeros(max(n - needed(n) for n in range(1, SHORT_ITEM + 1)), np.uint64)


def short_masks(n_words: int) -> list[str]:
    """Masks of an item's own length; after any allowed substitutions one still matches.

    Positions are dealt over two groups more than substitutions; each mask ignores as many
    groups as there are substitutions.
    """
    n = n_words - needed(n_words)
    return ["".join("0" if at % (n + 2) in out else "1" for at in range(n_words))
            for out in itertools.combinations(range(n + 2), n)]


def masks_of(n_words: int) -> list[tuple[int, str]]:
    """(salt, mask) that serve an item of so many words."""
    long = list(enumerate(MASKS, 1)) if n_words >= SPAN else []
    short = short_masks(n_words) if 0 < n_words <= SHORT_ITEM else []
    return long + list(enumerate(short, 100 * n_words))


@dataclass
class Block:
    """Benchmark items with their seeds: a bit table, and sorted hashes with their places."""

    keys: list[str]
    words: list[np.ndarray]
    masks: dict[int, str]
    values: np.ndarray
    item: np.ndarray
    at: np.ndarray
    bits: np.ndarray

    @classmethod
    def of(cls, items: list[tuple[str, str]]) -> Block:
        hashes = WordHashes()
        texts = [words_of(t, hashes) for _, t in items]
        masks: dict[int, str] = {}
        found, item, at = [], [], []
        for k, words in enumerate(texts):
            for salt, mask in masks_of(len(words)):
                masks[salt] = mask
                found.append(seeds(words, mask, salt))
                item.append(np.full(len(found[-1]), k))
                at.append(np.arange(len(found[-1])))
        values = np.concatenate([np.empty(0, np.uint64), *found])
        order = np.argsort(values, kind="stable")
        bits = np.zeros(1 << FILTER_BITS, dtype=bool)
        bits[(values >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        place = [np.concatenate([np.empty(0, np.int64), *x])[order].astype(np.int32) for x in (item, at)]
        return cls([key for key, _ in items], texts, masks, values[order], *place, np.packbits(bits))

    def hits(self, words: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Rows (text, item, place in ``words`` of the item's first word) of every seed that matches.

        ``words`` holds texts one after the other, ``ends`` where each ends.
        """
        found = [np.empty((0, 3), np.int64)]
        for salt, mask in self.masks.items():
            values = seeds(words, mask, salt)
            top = values >> np.uint64(64 - FILTER_BITS)
            maybe = np.flatnonzero(self.bits[(top >> np.uint64(3)).astype(np.int64)] >> (7 - (top & np.uint64(7)).astype(np.uint8)) & 1)
            low, high = (np.searchsorted(self.values, values[maybe], side=x) for x in ("left", "right"))
            n = high - low
            match = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
            place = np.repeat(maybe, n)
            text = np.searchsorted(ends, place, side="right")
            rows = np.stack([text, self.item[match], place - self.at[match]], axis=1)
            found.append(rows[place + len(mask) <= ends[text]])
        return np.unique(np.concatenate(found), axis=0)

    def leaks(self, texts: list[np.ndarray]) -> list[dict[int, tuple[int, int]]]:
        """For each text: item -> (matching words, first word) of its best stretch, if that is long enough."""
        words = np.concatenate([EDGE, *[part for t in texts for part in (t, EDGE, EDGE)]])
        ends = np.cumsum([len(t) + 2 * len(EDGE) for t in texts])
        best: list[dict[int, tuple[int, int]]] = [{} for _ in texts]
        for k, item, place in self.hits(words, ends).tolist():
            text, own = texts[k], self.words[item]
            if best[k].get(item, (0, 0))[0] == len(own):
                continue
            start = place - (int(ends[k]) - len(EDGE) - len(text))
            a, b = max(0, -start), min(len(own), len(text) - start)
            matches, first = stretch(own[a:b] == text[start + a:start + b])
            if matches >= needed(len(own)) and matches > best[k].get(item, (0, 0))[0]:
                best[k][item] = (matches, start + a + first)
        return best


def stretch(same: np.ndarray) -> tuple[int, int]:
    """(matches, start) of the stretch with the best score."""
    score = np.where(same, 1, -PENALTY)
    sums = np.concatenate([[0], np.cumsum(score)])
    low = np.minimum.accumulate(sums)
    end = int((sums - low).argmax())
    start = int(sums[:end + 1].argmin())
    return int(same[start:end].sum()), start


def blocks(items: DataFrame) -> Iterator[list[tuple[str, str]]]:
    """Items (key, text) in groups of about ``BLOCK_WORDS`` words, one group on the driver at a time."""
    total = items.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    n = -(-total // BLOCK_WORDS)
    for k in range(n):
        yield [tuple(r) for r in items.where(F.pmod(F.xxhash64("key"), F.lit(n)) == k).collect()]


def keyed(benchmark: DataFrame, text: str) -> DataFrame:
    """The benchmark's columns as a struct ``row`` and the key of its text, no null texts."""
    item = F.col(f"`{text}`")
    return benchmark.where(item.isNotNull()).select(
        F.sha2(item, 256).alias("key"), item.alias("text"), F.struct(*[F.col(f"`{c}`") for c in benchmark.columns]).alias("row"))


def search(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
           item_text: str = "text") -> DataFrame:
    """(doc_id, leaks) of every row of ``docs``; leaks holds (key, n_matched, n_item_words,
    first_word) of every item text found, ``key`` being its SHA-256."""
    kind = ArrayType(StructType([
        StructField("key", StringType()), StructField("n_matched", IntegerType()),
        StructField("n_item_words", IntegerType()), StructField("first_word", IntegerType())]))
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    out = StructType([rows.schema["doc_id"], StructField("leaks", kind)])
    arrow_kind = to_arrow_type(kind)
    items = Written(keyed(benchmark, item_text).select("key", "text").distinct(), "benchmark_items")
    sent = [docs.sparkSession.sparkContext.broadcast(vars(Block.of(part))) for part in blocks(items.df)]
    items.drop()

    def run(batches):
        known, hashes = [Block(**s.value) for s in sent], WordHashes()

        def leaks_of(texts):
            result = [[] for _ in texts]
            for block in known:
                for row, found in zip(result, block.leaks(texts)):
                    row += [{"key": block.keys[k], "n_matched": n, "n_item_words": len(block.words[k]), "first_word": at}
                            for k, (n, at) in sorted(found.items())]
            return result

        for batch in batches:
            leaks, waiting, size = [], [], 0
            for value in batch.column(1):
                waiting.append(words_of(value.as_py(), hashes))
                size += len(waiting[-1])
                if size > GROUP_WORDS:
                    leaks += leaks_of(waiting)
                    waiting, size = [], 0
            leaks += leaks_of(waiting)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(leaks, arrow_kind)], names=["doc_id", "leaks"])

    return rows.mapInArrow(run, out)


def leaks(docs: DataFrame, benchmark: DataFrame, item_id: str = "item_id") -> DataFrame:
    """(doc_id, item_id, n_matched, n_item_words, first_word): the documents that hold items."""
    found = search(docs, benchmark).select("doc_id", F.inline("leaks"))
    items = keyed(benchmark, "text").select("key", F.col("row").getField(item_id).alias("item_id"))
    return found.join(items, "key").select("doc_id", "item_id", "n_matched", "n_item_words", "first_word")


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` without any leak, with their columns."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text}`").alias("text"))
    return search(rows, benchmark, "row").where(F.size("leaks") == 0).select("doc_id.*")
