"""The training-data pipeline over ``documents``: one stage after the other, each on what the last one kept.

Each stage calls one operator of ``textmill.llm`` with production parameters. Its result is written
to the cluster's shared folder and read again as the documents of the next stage.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from textmill.llm import bpe, mixing, ngram_join, quality, suffix_dedup
from textmill.llm.arrow import free_name
from textmill.sources.staging import stage

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


# 51 words in a row have 315 bytes in the median and over 200 in 99 of 100 places of the given texts, so
# passages are looked for by 200 bytes, and their words are counted.
REPEATED_BYTES, REPEATED_GRAM, REPEATED_WORDS = 200, 64, 50

READ = {"doc_id", "text", "lang", "source", "n_chars"}


def with_own_columns(function):
    """``function`` with the columns that no stage reads under free names, so that no operator's column replaces them."""

    @functools.wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        aside = {c: free_name(f"_own{number}", docs) for number, c in enumerate(docs.columns) if c.lower() not in READ}
        return function(spark, docs.withColumnsRenamed(aside), sf_dir).withColumnsRenamed({b: a for a, b in aside.items()})

    return run_stage


@with_own_columns
def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules accept."""
    return quality.add_quality(docs, BYTE_BPE, PIECE_BPE).filter("kept").select(docs.columns)


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id in each group that links of a Jaccard similarity of 0.8 on five words make.

    Rows of one id are one document, of which one row stays; rows without an id stay.
    """
    links = ngram_join.link_documents(docs, ngram_join.Similarity(80, 100), width=5)
    mark, number = free_name("_kept", docs), free_name("_row", docs)
    kept = links.filter("component_id = doc_id").select(F.col("doc_id").alias(mark)).distinct()
    rows = docs.join(kept, docs["doc_id"] == kept[mark], "left").filter(F.col(mark).isNotNull() | F.col("doc_id").isNull())
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text")))
    return rows.withColumn(number, first).filter(F.col("doc_id").isNull() | (F.col(number) == 1)).select(docs.columns)


@with_own_columns
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of ``REPEATED_WORDS`` words or more that stand elsewhere too; a text of which nothing is left goes.

    A passage is a maximal run of bytes covered by strings of ``REPEATED_BYTES`` bytes that repeat.
    """
    cut = suffix_dedup.remove_repeats(docs, REPEATED_BYTES, REPEATED_GRAM, least_words=REPEATED_WORDS)
    cut = cut.filter("n_removed = 0 OR trim(kept_text) <> ''")
    changed = F.col("n_removed") > 0
    columns = {"text": F.when(changed, F.col("kept_text")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(changed, F.length("kept_text").cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumns(columns).select(docs.columns)


@with_own_columns
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's share of the mix takes it."""
    return mixing.repeat_rows(mixing.mix_sources(docs), docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text of the mix, and whether they decode to the text."""
    coded = bpe.encode_bpe(docs, BYTE_BPE, decoded="decoded")
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), same.alias("round_trip"), "ids")


STAGES = [
    ("quality rules", keep_quality),
    ("n-gram Jaccard join", keep_one_of_similar),
    ("suffix-array dedup", cut_repeats),
    ("mixing sources to target weights", mix),
    ("BPE encoding and decoding", encode),
]

# SQL can state neither the tokenisers' measures nor the ids; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stage(docs, f"stage-{number}")
    return docs
