"""The registered queries of this subpackage: each applies one operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, sql, toxicity, url_filters
from .collocations import collocations
from .embedding_dedup import near_duplicate_vectors
from .line_dedup import remove_repeated_lines
from .minhash import near_duplicates
from .packing import pack
from .prefix_trie import prefix_trie, turn_sequences, with_shared_heads
from .quality_rules import judge
from .sentencepiece_bpe import encode_and_decode
from .shipping import ship
from .substring_dedup import remove_repeated_words
from .suffix_array_dedup import remove_repeated_bytes

Query = Callable[[SparkSession, str], DataFrame]

PIECE_MODEL = "piece_bpe_32k.model"
WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_RANKS = "byte_bpe_multi_50k.tiktoken"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = encode_and_decode(docs, public_tokenizers.path(PIECE_MODEL))
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).drop("lang")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeated_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"),
                      F.col("n_removed_lines").cast("long").alias("n_removed_lines"),
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def _held_out() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lexicon = toxicity.learn(docs, table(spark, sf_dir, "labels").where(~_held_out()))
    return toxicity.score(docs.select("doc_id", "text"), lexicon).select(
        "doc_id", F.coalesce(_held_out(), F.lit(False)).alias("held_out"), F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= 0.5).cast("int").alias("predicted"), "toxic_hits")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeated_words(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("n_tokens").alias("n_words"), "n_removed",
                      F.sha2("kept", 256).alias("kept_sha256"))


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge_urls(table(spark, sf_dir, "pages"))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeated_bytes(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("n_tokens").alias("n_bytes"), "n_removed",
                      F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = byte_bpe.encode_and_decode(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_RANKS))
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    sequences = turn_sequences(table(spark, sf_dir, "conversations"))
    heads = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")
    return prefix_trie(with_shared_heads(sequences, heads))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_sentencepiece, op2_embedding_dedup, op3_minhash_dedup, op4_quality_rules, op5_line_dedup, op6_toxicity,
    op7_best_fit_packing, op8_substring_dedup, op9_url_filters, op10_suffix_array_dedup,
    op11_byte_bpe, op12_prefix_trie, op13_collocations)}

ORACLE_SQL: dict[str, str] = {"op9_url_filters": url_filters.judge_sql(), "op12_prefix_trie": sql.PREFIX_TRIE,
                              "op13_collocations": sql.COLLOCATIONS}
