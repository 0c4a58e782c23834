"""A training-data pipeline over ``documents``: quality rules, line dedup, MinHash near-dedup, mixing, BPE encoding.

Each stage takes what its predecessor wrote, decides on all of it, and returns the columns of ``documents``; the last returns
token ids. Null texts and texts without ten words go in the first stage; documents of which line dedup leaves no words go in the second; rows
that repeat an id with the same text count as one document from the third on.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.llm.bpe import bpe_encode
from terraloom.llm.line_dedup import line_dedup
from terraloom.llm.minhash import near_duplicates
from terraloom.llm.mixing import emitted, mixed
from terraloom.llm.quality import fit_crf, good_documents
from terraloom.llm.shared import drop, fresh_path, row_keys, saved, workspace


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, with line labels of a CRF fitted on the labelled ones."""
    crf = fit_crf(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return good_documents(docs, crf)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier line matches; those with no line left go."""
    clean = line_dedup(docs).where("n_lines > n_removed").withColumn("n_chars", F.length("text").cast("long"))
    return clean.select(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, Jaccard of 0.8 or more), and equal rows of an id once.

    Different texts of one id, and texts of null ids, are documents of their own: they are compared like all others.
    """
    key = f"key_{uuid.uuid4().hex}"  # that no column of the input has
    keyed = row_keys(docs, key)
    found = saved(near_duplicates(keyed, k=5, percent=80, id_col=key), "near")
    return keyed.join(found.where("kept").select(F.col("doc_id").alias(key)).hint("merge"), key, "left_semi").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight asks."""
    return emitted(mixed(docs), docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document."""
    encoded = bpe_encode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return encoded.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("near dedup", near),
    ("mixing", mix),
    ("bpe", tokens),
]

#: No SQL: the first stage decodes with a trained model. The tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn. What a stage wrote on its way goes when its result is written, its input with the next result."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        at = fresh_path(spark, f"stage-{name.replace(' ', '-')}")
        with workspace(spark):
            docs = saved(stage(spark, docs, sf_dir), at=at)
        if last is not None:
            drop(last)
        last = docs
    return docs
