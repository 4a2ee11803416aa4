"""Corpus pipeline: language ID, line dedup, SimHash near-dedup, benchmark
decontamination, BPE. Every stage is written to the shared folder and read again."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricegrid.llm import bpe, decontamination, language_id, line_dedup, simhash
from pricegrid.llm.common import table
from pricegrid.llm.queries import fast_pattern, tokenizer_file
from pricegrid.session import stage


def language(spark, docs, sf_dir):
    """Documents whose language is recognised; `und` and ambiguous ones go."""
    return language_id.keep_known(docs).select(*docs.columns)


def lines(spark, docs, sf_dir):
    """Texts without repeated lines; documents that lose every line go."""
    return line_dedup.keep_remaining(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_duplicates(spark, docs, sf_dir):
    """One document of each SimHash group, the one with the smallest doc_id."""
    return simhash.keep_one(docs).select(*docs.columns)


def benchmark(spark, docs, sf_dir):
    """Documents that leak no benchmark item."""
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def encode(spark, docs, sf_dir):
    """Token counts and digests of ids and decoded text of every document."""
    return bpe.digests(docs, tokenizer_file("byte_bpe_50k.json"), tokenizer_file("byte_bpe_50k.tiktoken"), fast_pattern())


STAGES = [
    ("language ID", language),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("BPE encoding and decoding", encode),
]

#: No SQL: fingerprints, classifiers and BPE have none in DuckDB; tests compare with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for k, (_, apply) in enumerate(STAGES):
        docs = apply(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{k}")
    return docs
