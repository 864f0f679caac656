"""The registered queries of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readyspark.llm import (chat, decontaminate, hard_negatives, html_extract, line_quality, mixing, near_dup, passages,
                             spelling, token_counts, token_store, toxicity, url_filter)
from readyspark.llm.common import crc32_of, table, written
from readyspark.llm.oracle import ORACLE


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    held_out = F.coalesce(crc32_of(F.col("doc_id")) % 3 == 1, F.lit(False))  # a null id is neither held out nor learned from
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted",
                         F.size("offending").alias("n_offending"))


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_store.write_store(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return token_store.digest(token_store.read_store(spark, path))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.createDataFrame([(-7, t, r, "</s>[INST] ok [/INST]") for t, r in enumerate(("user", "assistant"))],
                                   "conv_id long, turn long, role string, text string")
    path = chat.write_examples(given.unionByName(marked))
    return chat.digest(spark.read.parquet(path))


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = html_extract.extract(pages, html_extract.learn(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.digest(decontaminate.contamination(docs, benchmark))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op9_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.judge(table(spark, sf_dir, "documents")).drop("cleaned")


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.similar_groups(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


# (verdict, host, path) of the query's rules, and the words that put a domain on its list
URL_RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/"))
URL_TERMS = ("ads", "adult", "bets", "betting", "casino", "gambling", "pills", "poker", "porn", "spam", "viagra", "xxx")


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    keys = written(url_filter.universe(pages), "universe")
    return url_filter.judge(pages, URL_RULES, url_filter.domains_with_terms(keys, URL_TERMS), keys=keys)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_token_store": op2_token_store,
    "op3_mixing": op3_mixing,
    "op4_chat": op4_chat,
    "op5_html": op5_html,
    "op6_passages": op6_passages,
    "op7_decontamination": op7_decontamination,
    "op8_token_counts": op8_token_counts,
    "op9_line_quality": op9_line_quality,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_url_filter": op13_url_filter,
}
__all__ = ["ORACLE", "QUERIES"]
