"""A training corpus from raw documents: language, near copies, repeated passages, mixture, token ids.

Each stage is a function (spark, docs, sf_dir) over documents (doc_id, text, lang,
source, n_chars; other columns are left out). Each takes empty tables.
Its result is written and read again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.bpe import encode_texts
from shelfwise.llm.language_id import identify
from shelfwise.llm.minhash_dedup import drop_near_duplicates
from shelfwise.llm.mixing import mix_sources
from shelfwise.llm.queries import RANKS, TOKENIZERS
from shelfwise.llm.registry import reachable
from shelfwise.llm.substring_dedup import remove_repeats
from shelfwise.llm.support import Scratch
from shelfwise.session import configure

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that ``docs`` name; ``lang`` is the one the network tells.

    Rejected: null or empty texts, texts without letters (``und``), and those whose letters are
    unlike those of all learned languages (``foreign``). Null ids and repeated rows stay as
    they are; without any ``lang`` to learn from nothing is kept.
    """
    told = identify(docs, carry=("text", "source", "n_chars"))
    kept = told.where((F.col("lang_pred") != "und") & ~F.col("foreign"))
    return kept.select("doc_id", "text", F.col("lang_pred").alias("lang"), "source", "n_chars")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (the smallest id), and all that have no copy."""
    return drop_near_duplicates(docs.select(*COLUMNS))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 35 words that occur elsewhere.

    A text that loses nothing stays as it is, any other is its kept words joined by one space.
    """
    told = remove_repeats(docs, carry=("lang", "source", "n_chars"), with_text=True)
    size = F.when(F.col("n_removed") > 0, F.length("cleaned").cast("long")).otherwise(F.col("n_chars"))
    return told.select("doc_id", F.col("cleaned").alias("text"), "lang", "source", size.alias("n_chars"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them (0, 1 or 2 times)."""
    taken = mix_sources(docs, carry=("text", "lang", "n_chars")).where("taken > 0")
    times = F.explode(F.sequence(F.lit(1), (F.col("taken") / F.col("size")).cast("int")))
    return taken.withColumn("_time", times).select(*COLUMNS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, their number, and digests of ids and of what they decode to."""
    return encode_texts(docs, f"{TOKENIZERS}/{RANKS}", carry=("lang", "source"), with_ids=True)


STAGES = [
    ("language_id", known_language),
    ("near_duplicates", one_of_each_group),
    ("substring_dedup", without_repeats),
    ("mixing", mixed),
    ("byte_bpe", token_ids),
]

#: SQL cannot state the stages' models and tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each result is written before the next stage."""
    scratch = Scratch(configure(reachable(spark)), "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        docs = scratch.keep(out, name)
        if k:
            scratch.drop(STAGES[k - 1][0])
    return docs
