"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept.  All
but the last return the columns of documents.  The runner writes each stage's result as
Parquet and reads it back, so a stage's lineage ends with it.

All stages keep extra columns as they are, whatever their names, read texts whole, however
long, and give an empty table for an empty one.  A null text has nothing to reject, link or
remove: it stays null in the first three stages and is empty after the fourth.  A null doc_id
has no order: such a row removes nothing from others, and nothing is removed from it.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import toxicity as toxic
from tidemark.llm.line_dedup import remove_repeated_lines
from tidemark.llm.minhash import near_duplicates
from tidemark.llm.packing import pack
from tidemark.llm.queries import WORD_TOKENIZER, table
from tidemark.llm.shipping import ship
from tidemark.llm.suffix_array_dedup import remove_repeated_bytes
from tidemark.sources.store import Scratch

#: Documents with at least this score go.
TOXIC = 0.5


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose score, learned from the labelled ones, says toxic.

    Repeated rows score alike; a score of exactly ``TOXIC`` rejects.
    """
    ship(spark)
    lexicon = toxic.learn(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxic.scorer(lexicon)(F.col("text"))["score"] < TOXIC)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes line runs that an earlier place holds; every document stays.

    Of equal runs the one with the smallest doc_id stays, within a document the first; rows that
    repeat both doc_id and text are one place, so they stay alike.
    """
    return _counted(remove_repeated_lines(docs, counts=False))


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies, the one with the smallest id.

    Rows that repeat the doc_id that stays all stay; texts without a word are in no group.
    """
    ship(spark)
    gone = near_duplicates(docs).where(~F.col("kept")).select(F.col("doc_id").alias("gone_id")).distinct()
    # Stored, so that Spark knows its size and need not shuffle the texts for a short list.
    gone = Scratch(spark, "pipeline")(gone, "gone")
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes byte runs that an earlier document holds; every document stays.

    Where a run ends inside a character, the rest of that character goes too.  Of equal runs the
    one with the smallest doc_id stays; rows with the same doc_id remove nothing from each other.
    """
    ship(spark)
    others = tuple(c for c in docs.columns if c != "text")
    out = remove_repeated_bytes(docs, carry=others, whole_characters=True, within="row")
    return _counted(out.select(*[F.col("kept").cast("string").alias(c) if c == "text"
                                 else F.col("row").getField(c).alias(c) for c in docs.columns]))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 4096 tokens; an empty text is its end token alone."""
    ship(spark)
    return pack(docs, public_tokenizers.path(WORD_TOKENIZER))


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity), ("line_dedup", line_dedup), ("minhash_dedup", minhash_dedup),
    ("suffix_array_dedup", suffix_array_dedup), ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each stored before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES:
        docs = scratch(stage(spark, docs, sf_dir), name)
    return docs


#: A learned score, near copies and packing cannot be said in SQL; tests hold each stage
#: against a brute-force version.
ORACLE_SQL = None
