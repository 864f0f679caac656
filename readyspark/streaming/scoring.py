"""Stream scoring (X2): the one-row scoring form re-aimed at a Parquet stream.

Stateless: each micro-batch is checked by the input contract, gets the derived
features and is scored by a fitted model or scorecard; rows failing the
contract go to their own sink with the reasons. No watermark or state is
needed. ``trigger(availableNow=True)`` drains what is there and stops, so the
same job serves backfills and scheduled runs; the checkpoint makes it
restartable after any failure.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from readyspark import presets as P
from readyspark.functions.exprs import lenient_double
from readyspark.operators.clean import contract_split
from readyspark.operators.features import calculate_features, drop_columns
from readyspark.operators.score import label_text, score
from readyspark.sources.sinks import PublishedModel


# files per micro-batch: ``availableNow`` still drains everything, but in
# batches of this many files, so a backfill of a large folder is many bounded
# batches (a failure repeats one batch, not the whole backfill)
MAX_FILES_PER_TRIGGER = 1000


def checked_stream(spark: SparkSession, source_dir: str, schema: StructType, required: list[str],
                   numeric: list[str], max_files_per_trigger: int = MAX_FILES_PER_TRIGGER) -> DataFrame:
    """The source with its contract verdict (``valid``, ``reasons``), columns as they came."""
    src = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
                .parquet(source_dir))
    return contract_split(src, required, numeric)


def score_valid(checked: DataFrame, scorer, numeric: list[str]) -> DataFrame:
    """Features and score of the valid rows. Rows are filtered first and numbers
    are read leniently, so no plan order can meet a rejected row's text."""
    valid = checked.where(F.col("valid"))
    featured = calculate_features(valid.withColumns(
        {c: lenient_double(c) for c in numeric if c in checked.columns}))
    featured = drop_columns(featured, [c for c in P.DELETED_ATTRIBUTES if c in featured.columns], strict=False)
    return label_text(score(featured, scorer))


def run_stream_scoring(spark: SparkSession, source_dir: str, schema: StructType, scorer, out_dir: str,
                       checkpoint_dir: str, required: list[str], numeric: list[str],
                       keep: list[str], max_files_per_trigger: int = MAX_FILES_PER_TRIGGER) -> dict:
    """Drain the source once (availableNow) into ``out_dir/scored`` and
    ``out_dir/rejected``; returns the sink paths.

    One query reads the source once; every micro-batch goes to both sinks.
    Rejected rows keep their columns as they came. A batch's files are written
    under its number and replaced when the batch is repeated after a failure, so
    no row appears twice. ``scorer`` may be a :class:`~readyspark.sources.sinks.PublishedModel`:
    every micro-batch then takes the version that is live as it begins, and its rows
    carry that number as ``model_version``.
    """
    scored_path, rejected_path = os.path.join(out_dir, "scored"), os.path.join(out_dir, "rejected")

    def write(batch: DataFrame, number: int) -> None:
        batch = batch.persist()  # both sinks read it: the source is scanned once
        try:
            version, model = scorer.current() if isinstance(scorer, PublishedModel) else (None, scorer)
            named = [] if version is None else [F.lit(version).cast("long").alias("model_version")]
            scored = score_valid(batch, model, numeric).select(
                *keep, *named, "p_bad", "prediction", "prediction_label", "probability_good", "probability_bad")
            rejected = batch.where(~F.col("valid")).select(*keep, F.array_join("reasons", ",").alias("reasons"))
            for rows, path in ((scored, scored_path), (rejected, rejected_path)):
                rows.write.mode("overwrite").parquet(os.path.join(path, f"batch={number}"))
        finally:
            batch.unpersist()

    checked = checked_stream(spark, source_dir, schema, required, numeric, max_files_per_trigger)
    query = (checked.writeStream.foreachBatch(write).trigger(availableNow=True)
                    .option("checkpointLocation", os.path.join(checkpoint_dir, "scoring")).start())
    query.awaitTermination()
    return {"scored": scored_path, "rejected": rejected_path}


def read_sink(spark: SparkSession, path: str) -> DataFrame:
    """A sink's rows without the batch number."""
    return spark.read.parquet(path).drop("batch")
