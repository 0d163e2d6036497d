"""Near-duplicates by SimHash fingerprints and pivot distance tables.

A 64-bit fingerprint per document, then links between fingerprints that differ in at most two
bits, then connected components. Work on links is done on different fingerprints only, so
exact copies cost nothing.

The pivot table holds, for every fingerprint, its Hamming distances to reference fingerprints,
one distance per 16-bit quarter and reference. Two fingerprints at most two bits apart agree
in at least two of four quarters, so they share a cell: the coordinates of two quarters.
Pairs inside a cell are discarded if a coordinate of the whole distance differs by more than
two (the triangle inequality), and the survivors are verified bit by bit. No link is lost.

Cells above ``CELL_LIMIT`` fingerprints are not paired. Their fingerprints emit themselves and
the 64 words one bit away; two fingerprints share such a word exactly if they are at most two
bits apart, and a shared word links all its holders to the least of them, without pairs.

Cases: null and empty texts have the fingerprint zero and are linked like any other; texts
with fewer words than a shingle count as one shingle; repeated rows get equal classes; a
null doc_id is kept and never names a class unless its class has no other; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.components import components
from panelcast.llm.tables import Written

SHINGLE = 3
SEED = 42
MAX_BITS = 2
CELL_LIMIT = 256
# Shingles whose bits are counted at once, to bound memory on very long texts.
BLOCK = 200_000
QUARTERS = 4
# Reference fingerprints: as many as bits in a quarter, so that the distances of a quarter
# tell its bits apart; drawn once from a fixed seed.
N_PIVOTS = 16


def pivots(n: int = N_PIVOTS, seed: int = 7) -> list[int]:
    draw = random.Random(seed)
    return [draw.getrandbits(64) for _ in range(n)]


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bits set in over half the hashes of the shingles of the lower-cased words."""
    words = text.lower().split()  # on bytes both know ASCII only
    if not words:
        return 0
    n = max(len(words) - shingle + 1, 1)
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for start in range(0, n, BLOCK):
        part = [digest(b" ".join(words[i:i + shingle]), SEED) for i in range(start, min(start + BLOCK, n))]
        raw = np.array(part, dtype=">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(raw, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long, one row per row of ``docs``."""

    def run(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            prints = np.array([fingerprint(t.as_py() or b"") for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints)], names=["doc_id", "fp"])

    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, fp long")


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def distance(fp: Column, pivot: int, quarter: int | None = None) -> Column:
    """Bits in which ``fp`` and the reference differ, in one quarter or in all."""
    bits = fp.bitwiseXOR(F.lit(signed(pivot)))
    if quarter is not None:
        bits = bits.bitwiseAND(F.lit(signed(0xFFFF << (16 * quarter))))
    return F.bit_count(bits)


def pivot_table(prints: DataFrame) -> DataFrame:
    """(fp, q0..q3, whole): distances per quarter and over all bits, one byte per reference."""
    refs = pivots()

    def row(quarter: int | None) -> Column:
        return F.array(*[distance(F.col("fp"), p, quarter).cast("tinyint") for p in refs])

    return prints.select("fp", *[row(q).alias(f"q{q}") for q in range(QUARTERS)], row(None).alias("whole"))


def cells(table: DataFrame) -> DataFrame:
    """(cell, fp, whole): a fingerprint in its six cells, one for each two quarters."""
    pairs = [(i, j) for i in range(QUARTERS) for j in range(i + 1, QUARTERS)]
    keys = F.array(*[F.xxhash64(F.lit(k), f"q{i}", f"q{j}") for k, (i, j) in enumerate(pairs)])
    return table.select(F.explode(keys).alias("cell"), "fp", "whole")


def links(prints: DataFrame, max_bits: int = MAX_BITS, cell_limit: int = CELL_LIMIT) -> DataFrame:
    """(a, b): links between different fingerprints at most ``max_bits`` (2) apart.

    Of fingerprints in crowded cells the links are a star with the same components.
    """
    if max_bits != MAX_BITS:
        raise ValueError("cells and one-bit words are built for two bits")
    placed = Written(cells(pivot_table(prints)), "cells")
    sizes = placed.df.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = Written(placed.df.join(sizes, "cell"), "shared_cells")
    placed.drop()
    small = shared.df.where(F.col("n") <= cell_limit)
    left = small.select("cell", F.col("fp").alias("a"), F.col("whole").alias("wa"))
    right = small.select("cell", F.col("fp").alias("b"), F.col("whole").alias("wb"))
    far = F.exists(F.zip_with("wa", "wb", lambda x, y: F.abs(x - y)), lambda d: d > max_bits)
    near = (left.join(right, "cell").where("a < b").where(~far)
            .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits).select("a", "b"))
    crowded = shared.df.where(F.col("n") > cell_limit).select("fp").distinct()
    flips = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(signed(1 << i))) for i in range(64)])
    words = crowded.select("fp", F.explode(flips).alias("word"))
    least = words.groupBy("word").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    star = words.join(least, "word").where("fp <> a").select("a", F.col("fp").alias("b"))
    found = Written(near.unionByName(star).distinct(), "links")
    shared.drop()
    return found.df


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    max_bits: int = MAX_BITS, cell_limit: int = CELL_LIMIT) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs``."""
    made = Written(fingerprints(docs, doc_id, text), "fingerprints")
    different = Written(made.df.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "different")
    joined = components(links(different.df.select("fp"), max_bits, cell_limit)).withColumnRenamed("node", "fp")
    classes = different.df.join(joined, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = classes.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = Written(classes.join(least, "component").select("fp", "component_id"), "classes")
    return made.df.join(named.df, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies: of each class the row with its smallest id.

    Classes are those of ``near_duplicates``. Rows that share the smallest id are kept together
    only if they are equal in id and text, and then once. A class whose ids are all null keeps the
    text of smallest hash. Other columns stay, whatever their names and types.
    """
    classes = near_duplicates(docs.select(F.struct(
        F.col(f"`{doc_id}`").isNull().alias("no_id"), F.col(f"`{doc_id}`").alias("id"),
        F.xxhash64(f"`{text}`").alias("hash")).alias("key"), F.col(f"`{text}`").alias("text")), "key", "text")
    first = Written(classes.where("doc_id = component_id").groupBy("doc_id.id", "doc_id.hash")
                    .agg(F.count(F.lit(1)).alias("n")), "first_of_class").df

    def rows_of(part: DataFrame) -> DataFrame:
        d, f = docs.alias("d"), part.alias("f")
        same = F.col("f.id").eqNullSafe(F.col(f"d.`{doc_id}`")) & (F.col("f.hash") == F.xxhash64(f"d.`{text}`"))
        return d.join(f, same, "left_semi")

    return rows_of(first.where("n = 1")).unionByName(rows_of(first.where("n > 1")).dropDuplicates([doc_id, text]))
