"""Sinks: Parquet, CSV, JSON report, metric history, publish-if-ready."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Mapping

from py4j.protocol import Py4JJavaError
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readyspark.operators.gates import verdict


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None) -> None:
    """S2."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """S3: CSV with a header line."""
    df.write.mode(mode).option("header", True).csv(path)


def write_report(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Gate rows as JSON lines, stamped with the creation time."""
    stamped = rows.withColumn("created_at", F.lit(_dt.datetime.now(_dt.timezone.utc).isoformat()))
    stamped.coalesce(1).write.mode(mode).json(path)


HISTORY = "run_id string, kind string, name string, value double, text string, logged_at timestamp"


def _log(rows: DataFrame, path: str) -> None:
    """Put a run's rows of one kind into the history; what the run had of it before goes."""
    (rows.withColumn("logged_at", F.current_timestamp()).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("run_id", "kind").parquet(path))


def append_metrics(metrics: DataFrame, path: str, run_id: str, kind: str = "metric") -> None:
    """Log (run_id, kind, name, value, text, logged_at) rows in a history table.
    ``metrics`` needs columns ``metric`` and ``value``. The table is partitioned by run
    and kind, and logging the same again, as a repeated run does, replaces its rows:
    they never double. Other runs and kinds are untouched. A run that logs several
    sets of metrics gives each a kind of its own."""
    _log(metrics.select(F.lit(run_id).alias("run_id"), F.lit(kind).alias("kind"),
                        F.col("metric").cast("string").alias("name"), F.col("value").cast("double").alias("value"),
                        F.lit(None).cast("string").alias("text")), path)


def append_params(spark: SparkSession, params: Mapping, path: str, run_id: str) -> None:
    """S6 for parameters of any type: every one is a row, its text as Python
    prints it (``None`` and booleans too) and its number where it is one."""
    number = lambda v: float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else None
    _log(spark.createDataFrame([(run_id, "param", str(k), number(v), str(v)) for k, v in params.items()],
                               "run_id string, kind string, name string, value double, text string"), path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    columns = [c.split()[0] for c in HISTORY.split(", ")]
    return spark.read.schema(HISTORY).parquet(path).select(columns)


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _create(spark: SparkSession, path: str) -> bool:
    """Create an empty file; false if it is there. Of several that try, one succeeds."""
    fs, p = _fs(spark, path)
    fs.mkdirs(p.getParent())
    if fs.getUri().getScheme() == "file":
        return spark._jvm.java.io.File(p.toUri().getPath()).createNewFile()
    try:
        fs.create(p, False).close()  # refused by the store itself if the file exists
        return True
    except Py4JJavaError:
        if fs.exists(p):
            return False
        raise


def claim_version(spark: SparkSession, target_path: str) -> int:
    """The next version number, claimed by creating its file: publishers at the same
    time get different numbers, whatever their clocks say."""
    claims = f"{target_path.rstrip('/')}/claims"
    fs, p = _fs(spark, claims)
    taken = [int(s.getPath().getName()) for s in fs.listStatus(p)] if fs.exists(p) else []
    n = max(taken, default=0) + 1
    while not _create(spark, f"{claims}/{n:010d}"):
        n += 1
    return n


def published_versions(spark: SparkSession, target_path: str) -> list[int]:
    """Numbers of the versions that are whole, in order."""
    fs, p = _fs(spark, f"{target_path.rstrip('/')}/published")
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(p)) if fs.exists(p) else []


def version_path(target_path: str, version: int) -> str:
    return f"{target_path.rstrip('/')}/versions/{version:010d}"


def drop_old_versions(spark: SparkSession, target_path: str, keep: int = 3) -> list[int]:
    """Remove published versions but the ``keep`` newest; the live one always stays.
    A version's mark goes before its files, so readers never meet a part of one.
    Versions that are being written have no mark and are left alone."""
    old = published_versions(spark, target_path)[:-max(1, keep)]
    for n in old:
        for path in (f"{target_path.rstrip('/')}/published/{n:010d}", version_path(target_path, n)):
            fs, p = _fs(spark, path)
            fs.delete(p, True)
    return old


def publish_if_ready(scored: DataFrame, gate_rows: DataFrame, staging_path: str, target_path: str,
                     model=None, audit: Callable[[DataFrame], DataFrame] | None = None) -> dict:
    """S7 as write-audit-publish.

    The scored table is written to ``staging_path`` first. ``audit`` computes gate
    rows from the staged table, the very bytes that are published; they and the
    given ``gate_rows`` (checks on other inputs) must all have passed. Then a version
    number is claimed, the staged data, and the model beside it, are written to the
    version's folder below ``target_path``, and its mark is created last: readers
    (:func:`read_published`) see the old version or the new one, never a part, and of
    several publishers the highest number is live. Otherwise it raises and the target
    is untouched. Each publication keeps a staging folder of its own.
    """
    write_parquet(scored, staging_path)
    spark = scored.sparkSession
    staged = spark.read.schema(scored.schema).parquet(staging_path)
    checks = [verdict(gate_rows).first()] + ([verdict(audit(staged)).first()] if audit else [])
    if not all(v["production_ready"] for v in checks):
        raise ValueError(f"not published: {sum(v['failed_checks'] for v in checks)} gate checks failed")
    number = claim_version(spark, target_path)
    version = version_path(target_path, number)
    staged.write.parquet(f"{version}/scored")
    out = {"published": f"{version}/scored", "failed_checks": 0, "version": number}
    if model is not None:
        model.write().save(f"{version}/model")
        out["model"] = f"{version}/model"
    _create(spark, f"{target_path.rstrip('/')}/published/{number:010d}")
    return out


def read_published(spark: SparkSession, target_path: str, version: int | None = None) -> DataFrame:
    """The scored table of the live version (the highest), or of a given one."""
    return spark.read.parquet(f"{version_path(target_path, version or published_versions(spark, target_path)[-1])}/scored")


class PublishedModel:
    """The live version's model, looked up whenever it is asked for and loaded when
    it is another than before."""

    def __init__(self, spark: SparkSession, target_path: str):
        self.spark, self.target = spark, target_path
        self.version, self.model = 0, None

    def current(self):
        live = published_versions(self.spark, self.target)
        if not live:
            raise ValueError(f"nothing is published in {self.target}")
        if live[-1] != self.version:
            self.model = PipelineModel.load(f"{version_path(self.target, live[-1])}/model")
            self.version = live[-1]
        return self.version, self.model
