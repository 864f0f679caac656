"""The corpus pipeline: stages over ``documents``, each written and read again.

Null and empty texts are no duplicates of others and hold no benchmark passage:
they go on, as token lists of the end id alone. Rows of a null id are no duplicates
either and draw copies by their text; of rows that repeat an id one goes on. Extra
columns of documents go on to the last stage, whatever their names but ``copy`` and
``mix_key``, which the mixture would replace. Empty tables give no rows.

Every stage is (name, function of (spark, docs, sf_dir)); all but the last return
the columns of documents. A stage works on all that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readyspark.llm import decontaminate, mixing, near_dup, token_store, toxicity
from readyspark.llm.common import table, written
from readyspark.llm.queries import tokenizer_path

SEED = 42


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model rejects (score 0.7 and more) go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that of the smallest id."""
    return near_dup.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated towards their source's target share and shuffled."""
    return mixing.mix(docs, seed=SEED).select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token store of all copies, digested as it is read back. The store is in
    id order, for selective reads; a copy's ``mix_key``, its place in the mixture's
    order, follows from its id and number; it is null for a null id, whose place
    depends on the text."""
    path = token_store.write_store(docs, tokenizer_path("byte_bpe_50k.json"))
    stored = token_store.digest(token_store.read_store(spark, path))
    key = mixing.mix_key(F.col("doc_id").cast("string"), F.col("copy"), SEED)
    return stored.withColumn("mix_key", F.when(F.col("doc_id").isNotNull(), key))


STAGES = [
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark),
    ("mixing", mixture),
    ("token_ids", token_ids),
]

# a fitted classifier and a tokenizer are not SQL; tests compare the run with a
# brute-force version of the stages
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
