"""Corpus pipeline: documents to token ids, in five filtering and rewriting stages.

Each stage takes (spark, docs, sf_dir), works on every row the stage before it
kept and returns a DataFrame; all but the last return the columns of
``documents``. ``run`` writes each stage's rows as Parquet in the shared folder
and rereads them as the next one's ``docs``.

Rows with null or empty text are clean, have fingerprint zero (so one of them stays)
and no tokens; rows of null id take part like any other and come last where ids
decide; of repeated rows one stays, as of any near copies; ties between near copies
of one id go to an arbitrary fixed row; very long texts are worked on whole in every
stage; an empty table passes through every stage; extra columns, whatever their
names, are carried up to the last stage, which returns ids next to id and text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm import bpe, decontaminate, simhash, substring, toxicity
from tillcast.llm.store import fresh, materialize
from tillcast.sources.tables import read_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half."""
    score = fresh("_toxicity", docs.columns)
    scored = toxicity.classify(docs, read_table(spark, sf_dir, "labels", ["doc_id", "toxic"]), out=score)
    return scored.filter(F.col(score) < 0.5).drop(score)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one of the smallest id."""
    found = fresh("_copies", docs.columns)
    return simhash.simhash_groups(docs, out=found).filter(F.col(f"{found}.is_first")).drop(found)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without paragraphs that an earlier document holds; a document of
    which nothing is left goes."""
    found = fresh("_repeats", docs.columns)
    done = substring.remove_repeats(docs, out=found)
    shorter = F.col(f"{found}.removed") > 0
    kept = done.filter(~shorter | (F.trim(F.translate("text", "\n\t\r", "   ")) != ""))
    return kept.select(*[F.when(shorter, F.char_length("text").cast("long")).otherwise(F.col("n_chars")).alias(c) if c == "n_chars"
                         else F.col(f"`{c}`") for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold benchmark items."""
    bench = read_table(spark, sf_dir, "benchmark", ["item_id", "text"])
    found = fresh("_contamination", docs.columns)
    return decontaminate.remove_documents(decontaminate.find_contamination(docs, bench, out=found), found)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document (little-endian unsigned 32-bit integers), and digests
    of the ids and of the text decoded from them."""
    coded = bpe.encode_and_decode(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))
    return coded.select("doc_id", "text", F.col("coded.ids").alias("ids"), (F.octet_length("coded.ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("coded.ids", 256).alias("ids_sha256"), F.sha2("coded.decoded", 256).alias("decoded_sha256"))


STAGES = [("toxicity", drop_toxic), ("simhash_near_dedup", drop_near_copies), ("substring_dedup", cut_repeats),
          ("benchmark_decontamination", drop_contaminated), ("bpe", tokenize)]
ORACLE_SQL = None  # fingerprints, banding and the fitted model are beyond SQL; tests/llm compares with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
