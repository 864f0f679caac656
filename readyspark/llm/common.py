"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
import os
import posixpath
import sys
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from readyspark.session import run_tables, written_to

# documents of a few kilobytes: a Python worker then holds a few megabytes of
# texts at a time, and a batch of very long ones still fits
BATCH_ROWS = 1000
# rows of a key table (one or two longs) that are broadcast: tens of megabytes
BROADCAST_KEYS = 2_000_000
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(posixpath.join(sf_dir, f"{name}.parquet"))


def prepare_python(spark: SparkSession) -> None:
    """Get a session ready for Python tasks: bound the rows that Spark hands to a
    worker at once, if its user hasn't, and send this package's modules along, so
    that executors need neither a copy of the repository nor its path."""
    if "spark.sql.execution.arrow.maxRecordsPerBatch" not in spark.conf.getAll:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    context = spark.sparkContext
    if getattr(context, "_readyspark_sent", False):
        return
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="readyspark-"), "readyspark_modules.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(home):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(home)))
    context.addPyFile(archive)  # served by the driver to every executor, new ones too
    context._readyspark_sent = True


# what an operator remembers in a Python worker for its next tasks there
_KEPT: dict[str, dict] = {}


def kept(operator: str) -> dict:
    """The memory of an operator in this worker: empty at first, and again after
    tasks of another operator ran here (:func:`tidy`)."""
    return _KEPT.setdefault(operator, {})


def drop_others(operator: str | None) -> None:
    if others := [k for k in _KEPT if k != operator]:
        for other in others:
            del _KEPT[other]
        gc.collect()  # an encoder and its pieces refer to each other
        give_back()


def give_back() -> None:
    """Return memory that this process has freed to the system: Arrow's and, with
    glibc, that of the C heap, which else keep it for good."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)):
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], operator: str | None = None) -> Callable:
    """``run`` for ``mapInArrow``, in workers that Spark uses again for the tasks of
    other operators: it begins without what those remember and leaves no freed
    memory behind, so an executor holds one operator's at a time and not their sum.
    ``operator``: the one whose own memory, and freed memory, stays for its next tasks."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_others(operator)
        yield from run(batches)
        if operator is None:  # else the next task of the operator takes it, or one of another gives it back
            give_back()

    return tidied


def shared_path(spark: SparkSession, kind: str) -> str:
    """A fresh folder among this run's tables below the shared checkpoint folder,
    which ``session.release_tables`` deletes with the others."""
    return posixpath.join(run_tables(spark), "llm", f"{kind}-{uuid.uuid4().hex}")


def written(df: DataFrame, kind: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back: cuts
    the lineage, so a lost executor repeats no earlier stage."""
    return written_to(df, shared_path(df.sparkSession, kind))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def few(keys: DataFrame) -> DataFrame:
    """A written table of keys, broadcast if its counted rows allow it; a join
    with a larger one shuffles both sides."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else. ``lower`` does that already where every
    character is one byte long; other texts take the slower ``translate``."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower()))


def crc32_of(key: Column) -> Column:
    return F.crc32(F.encode(key.cast("string"), "UTF-8"))


def strings(column: pa.Array) -> list[str]:
    """Python strings of an Arrow column; null becomes the empty text."""
    return [x or "" for x in column.to_pylist()]


# ---------------------------------------------------------------- word hashes

_ODD = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit integers (a multiply-xorshift finaliser)."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= _M1
        x ^= x >> np.uint64(27)
        x *= _M2
        x ^= x >> np.uint64(31)
    return x


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (bytes) of the words ``[^\\x20\\x09-\\x0D]+``."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    inside = np.empty(len(data) + 2, dtype=np.int8)
    inside[0] = inside[-1] = 0
    inside[1:-1] = ~_SPACE[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def word_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hash of each word of a UTF-8 text, A-Z folded to a-z; vectorised
    over bytes, the same in every process.

    A word's bytes, eight at a time, are little-endian 64-bit digits; each digit
    is scrambled with its place in the word and the scrambled digits and the
    length are added up and scrambled again.
    """
    starts, ends = word_bounds(data)
    if not len(starts):
        return np.empty(0, np.uint64)
    folded = np.concatenate([_FOLD[data], np.zeros(8, np.uint8)])
    length = ends - starts
    chunks = (length + 7) // 8
    first = np.cumsum(chunks) - chunks
    word = np.repeat(np.arange(len(starts)), chunks)
    place = np.arange(int(chunks.sum())) - first[word]
    at = starts[word] + 8 * place
    left = np.minimum(ends[word] - at, 8)
    octets = folded[at[:, None] + np.arange(8)]
    octets[np.arange(8) >= left[:, None]] = 0
    digit = octets.view("<u8").ravel().astype(np.uint64)
    with np.errstate(over="ignore"):
        digit = mix64(digit + (place.astype(np.uint64) + np.uint64(1)) * _ODD)
        total = np.add.reduceat(digit, first)
        return mix64(total + length.astype(np.uint64) * _M2)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of every run of ``size`` consecutive words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(n, np.uint64)
        for i in range(size):
            out = mix64(out * _ODD + words[i:i + n])
    return out


def shingles(data: np.ndarray, size: int = 5) -> np.ndarray:
    """Sorted distinct shingle hashes of a text: runs of ``size`` words, the
    whole sequence where there are fewer, none without words."""
    words = word_hashes(data)
    if not len(words):
        return words
    return np.unique(window_hashes(words, min(size, len(words))))


def text_bytes(column: pa.Array) -> list[np.ndarray]:
    """UTF-8 bytes of each text of an Arrow column, null as no bytes, uncopied."""
    column = column.cast(pa.large_string()) if pa.types.is_string(column.type) else column
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    ok = np.ones(len(column), bool) if not column.null_count else np.asarray(column.is_valid())
    return [raw[a:b] if v else raw[:0] for a, b, v in zip(at[:-1], at[1:], ok)]


def list_array(values: np.ndarray, lengths, kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(np.asarray(lengths, dtype=np.int64))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
