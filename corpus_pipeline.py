"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; ``run``
writes every stage as Parquet in the shared folder and rereads it as the next one's input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import decontaminate, line_dedup, packing, quality_rules, simhash
from panelcast.llm.tables import Written, read_table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep(docs)


def cut_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many sources share; n_chars follows the text."""
    cut = line_dedup.deduplicate(docs)
    return cut.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.deduplicate(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents with their place in a sequence."""
    pieces = packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


STAGES = [
    ("quality rules", keep_good),
    ("line dedup", cut_common_lines),
    ("simhash near-dedup", keep_one_of_each_group),
    ("benchmark decontamination", drop_leaks),
    ("best-fit packing", pack_sequences),
]

# The estimated rates of the rules, the components and the packing have no closed SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = Written(stage(spark, docs, sf_dir), name.replace(" ", "_")).df
    return STAGES[-1][1](spark, docs, sf_dir)
