"""Session helpers: the configuration every job of the package expects."""

from __future__ import annotations

import gc
import math
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# runtime SQL settings every job of the package relies on
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # the cleaning plans carry many aliased predicates over wide rows; inferring
    # constraints over them grows combinatorially in the optimizer, not at run time
    "spark.sql.constraintPropagation.enabled": "false",
    # the fused cleaning and rule predicates generate one very large method per
    # stage; the JVM never JIT-compiles a method above 8,000 bytes of bytecode,
    # so such a stage would run interpreted (measured: about 2x slower). Above
    # this size Spark keeps per-expression codegen, which splits the code.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # merged partitions of a shuffle are no larger than this. The application rows come from a
    # narrow shuffle (about 50 bytes an order) and are made wide, and hashed for duplicates, in the
    # task that reads it: 64 MB, the default, are over a million rows and gigabytes of one task
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
}

DEFAULT_CONF = {
    **RUNTIME_CONF,
    # AQE merges small shuffle partitions; the per-row work after the first
    # shuffles (trimming, parsing, scoring) is CPU-bound, so keep partitions
    # from being merged below this size (a lower bound only: large inputs
    # still get large partitions)
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.driver.memory": "8g",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # call-site capture costs several JVM round trips per Column call while a
    # plan is being built; error messages still name the failing expression
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# target bytes of one shuffle partition after AQE's merging, and of one scan split
PARTITION_BYTES = 128 * 1024 * 1024


def scale_conf(largest_shuffle_bytes: int, partition_bytes: int = PARTITION_BYTES) -> dict[str, str]:
    """Partition sizing for a data volume: the bytes of the largest shuffle of
    the run (for the credit flow, the application rows before the duplicate
    removal).

    AQE merges shuffle partitions but never splits them (apart from skewed
    join partitions), so the initial number must fit the largest shuffle:
    ceil(bytes / partition_bytes), at least 200. Smaller shuffles of the same
    run are merged back to about ``partition_bytes``; scans split files at the
    same size, so a task's input fits executor memory with room to sort.
    """
    n = max(200, math.ceil(largest_shuffle_bytes / partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        # merge up to the advisory size; the default would keep partitions small
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
    }


def build_session(master: str | None = None, app_name: str = "readyspark",
                  shuffle_partitions: int | None = None,
                  conf: dict[str, str] | None = None,
                  largest_shuffle_bytes: int | None = None) -> SparkSession:
    """Session with the package's settings. ``largest_shuffle_bytes`` sizes
    partitions for the data (:func:`scale_conf`); ``shuffle_partitions`` and
    ``conf`` given by the caller win over it."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if largest_shuffle_bytes:
        settings.update(scale_conf(largest_shuffle_bytes))
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
        settings.pop("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session created elsewhere, as far as its
    user hasn't set them: explicit settings win."""
    given = spark.conf.getAll
    for key, value in RUNTIME_CONF.items():
        if key not in given:
            spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must name shared storage and is only read here.
    Only a local-mode session without the setting (tests, a laptop) gets a
    fresh folder of its own.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a Spark Connect session: the server side owns the setting
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    # local and local[..] are one process; local-cluster[..] has executors of its own
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder for this cluster")
    local_dir = tempfile.mkdtemp(prefix="readyspark-ckpt-")
    sc.setCheckpointDir(local_dir)
    return local_dir


def cut_lineage(df):
    """Write ``df`` once as a Parquet table under the shared checkpoint folder
    and continue from that table.

    Like ``checkpoint()`` this cuts the lineage (a lost executor never sends the
    work back to the raw scans), but the copy is columnar and compressed, and
    later reads prune columns and push filters into it.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    if not base:
        return df.checkpoint(eager=True)
    return written_to(df, f"{run_tables(spark)}/{uuid.uuid4().hex}")


# Spark deletes the shuffle files of a query when the query ends
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark) -> Iterator[None]:
    """A write inside takes its shuffle files along when it ends. They are read by the
    write alone, but stay on the executors' disks until the driver happens to collect its
    garbage, so a run of many steps holds those of all its steps."""
    if SHUFFLE_CLEANUP in spark.conf.getAll:  # the user's
        yield
        return
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP)


def written_to(df, path: str):
    """``df`` written as Parquet files to ``path`` and read back from there."""
    spark = df.sparkSession
    with shuffles_dropped(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path  # for drop_tables
    return out


def drop_tables(*tables) -> None:
    """Delete tables of :func:`written_to` of which nothing is read any more: what was
    derived from them is written itself. Other DataFrames stay as they are."""
    for t in tables:
        if path := getattr(t, "_written_to", None):
            folder = t.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def drop_unused_shuffles(spark: SparkSession) -> None:
    """Have Spark delete shuffle files that no DataFrame refers to any more, which it
    finds out when the driver collects its garbage: after work on RDDs, as fits are,
    whose shuffle files no query's end takes along."""
    gc.collect()
    spark._jvm.System.gc()


# rows of one part of a table that :func:`spread` deals out
MOST_ROWS, FEWEST_ROWS = 200_000, 20_000


def spread(df, most_rows: int = MOST_ROWS, fewest_rows: int = FEWEST_ROWS):
    """``df`` in even parts, for work that costs much per row: the files it is read
    from may be fewer than the cores, and a split's test rows may lie in a few of them.

    No part holds more than ``most_rows``; below that, there are three parts a core
    as long as each has ``fewest_rows``. A table of one such part stays as it is. The
    rows are counted, so ``df`` should be cheap to count, as a written table is."""
    rows, cores = df.count(), df.sparkSession.sparkContext.defaultParallelism
    parts = max(math.ceil(rows / most_rows), min(3 * cores, math.ceil(rows / fewest_rows)))
    return df.repartition(parts) if parts > 1 else df


def spread_once(df):
    """:func:`spread`, dealt out once however many jobs read it: each job on a repartitioned
    DataFrame would write the shuffle's files again, and a fit runs several."""
    parts = spread(df)
    if parts is df:
        return df
    session = df.sparkSession._jsparkSession
    return DataFrame(session.createDataFrame(parts._jdf.javaRDD(), parts._jdf.schema()), df.sparkSession)


def run_tables(spark: SparkSession) -> str:
    """This run's folder of intermediate tables below the checkpoint folder."""
    return ensure_checkpoint_dir(spark).rstrip("/") + "/tables/" + spark.sparkContext.applicationId


def release_tables(spark: SparkSession) -> None:
    """Delete this run's intermediate tables. Call it when no DataFrame of the run
    is read any more: results that still depend on them fail afterwards."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(run_tables(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
