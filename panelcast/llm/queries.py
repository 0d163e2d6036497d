"""The dealt operators as registered queries."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from panelcast.llm import (
    backoff,
    byte_pairs,
    decontaminate,
    html_extract,
    kneser_ney,
    line_dedup,
    merkle,
    packing,
    periodic,
    quality_rules,
    simhash,
    token_counts,
    toxicity,
)
from panelcast.llm.tables import read_table

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_toxicity")
def _(spark, sf_dir):
    return toxicity.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query("op2_quality_rules")
def _(spark, sf_dir):
    return quality_rules.judge(read_table(spark, sf_dir, "documents"))


@query("op3_quality_classifier")
def _(spark, sf_dir):
    return kneser_ney.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query("op4_html_extraction")
def _(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages")
    texts = html_extract.extract(pages, html_extract.fit(pages))
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))


@query("op5_lm_scoring", backoff.ORACLE)
def _(spark, sf_dir):
    scored = backoff.score(read_table(spark, sf_dir, "documents"))
    # Sums of logarithms in another order differ in their last digits.
    return scored.withColumns({c: F.round(c, 4) for c in ("log_score", "mean_log_score")})


@query("op6_line_dedup", line_dedup.ORACLE)
def _(spark, sf_dir):
    return line_dedup.clean(read_table(spark, sf_dir, "documents"))


@query("op7_benchmark_decontamination")
def _(spark, sf_dir):
    return decontaminate.leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query("op8_simhash_near_dedup")
def _(spark, sf_dir):
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


@query("op9_best_fit_packing")
def _(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    pieces = packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


@query("op10_token_counts")
def _(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    counts = token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 512)


@query("op11_periodic_runs")
def _(spark, sf_dir):
    texts = periodic.plant(read_table(spark, sf_dir, "documents"))
    return periodic.digests(periodic.periodic_runs(texts))


@query("op12_byte_bpe")
def _(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_pairs.digests(byte_pairs.round_trip(read_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN))


@query("op13_merkle_manifest", merkle.ORACLE)
def _(spark, sf_dir):
    return merkle.verified_documents(read_table(spark, sf_dir, "documents"))
