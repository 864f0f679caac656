"""Spelling variants by permuterm rotations (operator 11).

A word with a terminator has a rotation for each of its places. Two words that
differ in one replaced code point have rotations that are equal but for the
last one; a word with one code point more has a rotation whose beginning, all
but the last, is a whole rotation of the shorter word. So every word gives its
rotations whole, and those without their last code point; sorted, equal keys
stand together, and one scan of such a run finds all neighbours. A run holds at
most one whole rotation and one word for each letter of the alphabet, however
common the words are. The scan emits one row per word of a run (how many
neighbours, the most frequent one), never the pairs.

Documents are counted in Python tasks (words per distinct word of a document,
partial counts per task); everything after is DataFrame code.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from readyspark.llm.common import prepare_python, strings, written

LETTERS = "[a-zÀ-ÿ]+"  # runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased before
END = "$"  # the terminator: no letter
HELD_WORDS = 300_000  # distinct words that a counting task holds before it emits them
KEY_CHARS = 64  # rotations with more code points of the word are compared by 124-bit digests
ROWS_A_FILE = 20_000  # words of a written table for each of its files
_PRIMES = np.array([2147483647, 2147483629, 2147483587, 2147483579], np.int64)
_BASES = np.array([1103515245, 1664525, 69069, 1812433253], np.int64)


def word_counts(docs: DataFrame, least_chars: int = 6, every: int = 199, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``word``, ``n``: occurrences of every word of at least ``least_chars`` code
    points over all texts. With h = crc32 of ``<id>:<run>``, a run whose h is a
    multiple of ``every`` loses its code point h % length first."""
    prepare_python(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, crc, held = re.compile(LETTERS).findall, zlib.crc32, Counter()

        def emit():
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                             names=["word", "n"])
            held.clear()
            return out

        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), strings(b.column(1))):
                start = crc(f"{key}:".encode())
                # bytes.lower changes A-Z alone
                for run, n in Counter(runs(text.encode().lower().decode())).items():
                    if len(run) < least_chars:
                        continue
                    h = crc(run.encode(), start)
                    if h % every == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1:]
                        if len(run) < least_chars:
                            continue
                    held[run] += n
                if len(held) > HELD_WORDS:
                    yield emit()
        yield emit()

    read = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text"))
    return read.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def with_refs(words: DataFrame) -> DataFrame:
    """``ref``, a short stand-in that sorts like the word: the word itself, for one of
    more than ``KEY_CHARS`` code points its beginning and its number in sorted order."""
    is_long = F.length("word") > KEY_CHARS
    many = words.where(is_long).repartitionByRange("word").sortWithinPartitions("word")
    number = F.lpad(F.monotonically_increasing_id().cast("string"), 20, "0")
    many = many.withColumn("ref", F.concat(F.substring("word", 1, KEY_CHARS), F.lit(END), number))
    return words.where(~is_long).withColumn("ref", F.col("word")).unionByName(many)


def short_rotations(words: DataFrame) -> DataFrame:
    """``key, n, whole, first, letter, word``: rotations of at most ``KEY_CHARS`` code
    points of the word, whole or without the ``letter`` that would come last;
    ``first``: the letter begins a run of equal ones (leaving out any of a run
    gives the same shorter word, which must count once)."""
    size = F.length("word")
    place = words.where(size <= KEY_CHARS + 1).select("word", "ref", "n", F.explode(F.sequence(F.lit(0), 2 * size)).alias("p"))
    whole, before = F.col("p") >= size, F.when(F.col("p") >= size, F.col("p") - size).otherwise(F.col("p"))
    sub = lambda a, b: F.col("word").substr(a, b)
    step = F.when(whole, 1).otherwise(2)
    return place.where(~whole | (size <= KEY_CHARS)).select(
        F.concat(sub(before + step, size), F.lit(END), sub(F.lit(1), before)).alias("key"), "n", whole.alias("whole"),
        (~whole & ((before == 0) | (sub(before + 1, F.lit(1)) != sub(before, F.lit(1))))).alias("first"),
        F.when(whole, "").otherwise(sub(before + 1, F.lit(1))).alias("letter"),
        F.when(size > KEY_CHARS, F.col("ref")).alias("word"))


def _digests(word: str) -> tuple[np.ndarray, np.ndarray]:
    """Digests (four 31-bit ones) of every beginning and of every end of a word, from
    its own start and its own end on, so that equal ends of words of any length agree."""
    points = np.array([ord(c) for c in word], np.int64)
    found = []
    for seq in (points, points[::-1]):
        out = np.zeros((len(word) + 1, 4), np.int64)
        for k, (p, base) in enumerate(zip(_PRIMES, _BASES)):
            powers = np.ones(1, np.int64)
            step = int(base)
            while len(powers) < len(seq):
                powers = np.concatenate([powers, powers * step % p])
                step = step * step % int(p)
            terms = seq * powers[:len(seq)] % p
            # sums of 2**20 terms stay below 2**51; blocks carry on modulo p
            total = 0
            for a in range(0, len(seq), 1 << 20):
                part = (np.cumsum(terms[a:a + (1 << 20)]) + total) % p
                out[a + 1:a + 1 + len(part), k] = part
                total = int(part[-1])
        found.append(out)
    return found[0], found[1][::-1]


def long_rotations(words: DataFrame) -> DataFrame:
    """The same rows for longer rotations, linear in the word: the key is the place
    and the digests of what stands before and after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for word, ref, n in zip(*(b.column(i).to_pylist() for i in range(3))):
                head, tail = _digests(word)
                for whole in (False, True):
                    if len(word) - (not whole) <= KEY_CHARS:
                        continue
                    for a in range(0, len(word) + whole, 50_000):
                        at = np.arange(a, min(a + 50_000, len(word) + whole))
                        parts = np.column_stack([at, head[at], tail[at + (not whole)]])
                        keys = [" ".join(map(str, row)) for row in parts.tolist()]
                        first = [not whole and (i == 0 or word[i] != word[i - 1]) for i in at.tolist()]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(keys), pa.array([n] * len(at), pa.int64()), pa.array([whole] * len(at)),
                             pa.array(first), pa.array([""] * len(at)), pa.array([ref] * len(at))],
                            names=["key", "n", "whole", "first", "letter", "word"])

    prepare_python(words.sparkSession)
    return words.where(F.length("word") > KEY_CHARS).select("word", "ref", "n").mapInArrow(
        run, "key string, n long, whole boolean, first boolean, letter string, word string")


def neighbours(words: DataFrame, any_long: bool = True) -> DataFrame:
    """``word`` (its ref), ``n, near, best``: rows whose ``near`` sum up to a word's neighbour count
    and the least of whose ``best`` (minus n, word) is its most frequent neighbour."""
    rows = short_rotations(words)
    if any_long:
        rows = rows.unionByName(long_rotations(words))
    # a short word travels as its rotation and one letter, and is put together again
    rows = rows.repartition("key").withColumn("word", F.coalesce("word", F.concat(
        F.substring_index("key", END, -1), "letter", F.substring_index("key", END, 1))))
    member = F.struct((-F.col("n")).alias("minus_n"), F.col("word").alias("word"))
    run = Window.partitionBy("key").orderBy("whole", F.desc("n"), "word").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumns({
        "cut": F.sum((~F.col("whole")).cast("int")).over(run),
        "firsts": F.sum(F.col("first").cast("int")).over(run),
        "top": F.first(member).over(run), "second": F.nth_value(member, 2).over(run),
        "top_first": F.min(F.when(F.col("first"), member)).over(run),
        "shorter": F.min(F.when(F.col("whole"), member)).over(run)})
    replaced = F.when(F.col("cut") > 1, F.when(F.col("top.word") == F.col("word"), F.col("second")).otherwise(F.col("top")))
    shorter = F.when(F.col("first"), F.col("shorter"))
    return rows.select(
        "word", "n",
        F.when(F.col("whole"), F.col("firsts"))
         .otherwise(F.col("cut") - 1 + shorter.isNotNull().cast("int")).cast("long").alias("near"),
        F.when(F.col("whole"), F.col("top_first"))
         .otherwise(F.array_min(F.array_compact(F.array(replaced, shorter)))).alias("best")).where("near > 0")


def roots(forms: DataFrame, files: int) -> DataFrame:
    """``word, root`` of words with a form (``word, form``, a written table): the end of
    the chain of forms, by pointer doubling. Every form is at least ``times`` as frequent as
    its word, so chains have a few dozen links at most and few turns are needed. What a
    turn writes takes ``files`` files at most."""
    links = forms.select("word", F.col("form").alias("root"))
    while True:
        ends = links.select(F.col("word").alias("mid"), F.col("root").alias("end"))
        links = links.join(ends, F.col("root") == F.col("mid"), "left")
        if links.where(F.col("end").isNotNull()).isEmpty():
            return links.select("word", "root")
        links = written(links.select("word", F.coalesce("end", "root").alias("root")).coalesce(files), "forms")


def variants(docs: DataFrame, least_chars: int = 6, least_count: int = 5, times: int = 5, every: int = 199,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word (see :func:`word_counts`) of at least ``least_count``
    occurrences: ``word``, ``form`` (its most frequent near word, ties: smallest,
    if at least ``times`` as frequent, else null), ``root`` (last of the chain of
    forms), ``n``, ``n_near``, ``form_n``.

    Null and empty texts have no words; a null id counts as an empty one; every
    repeated row counts again; other columns are ignored, whatever their names;
    an empty table gives no rows. Words of any length are compared.
    """
    words = written(word_counts(docs, least_chars, every, id_col, text_col).where(F.col("n") >= least_count), "words")
    size = words.agg(F.count("word").alias("rows"), F.max(F.length("word")).alias("longest")).first()
    any_long = (size["longest"] or 0) > KEY_CHARS
    # one row a word: as many files as these need, not one for each shuffle partition
    files = max(1, math.ceil(size["rows"] / ROWS_A_FILE))
    words = written(with_refs(words), "words") if any_long else words.withColumn("ref", F.col("word"))
    rows = neighbours(words, any_long)
    alone = words.select(F.col("ref").alias("word"), "n", F.lit(0).cast("long").alias("near"), F.lit(None).cast(rows.schema["best"].dataType).alias("best"))
    found = rows.unionByName(alone).groupBy("word").agg(F.max("n").alias("n"), F.sum("near").alias("n_near"),
                                                        F.min("best").alias("best"))
    near_n = -F.col("best.minus_n")
    found = found.select("word", "n", "n_near", F.when(near_n >= times * F.col("n"), F.col("best.word")).alias("form"),
                         F.when(near_n >= times * F.col("n"), near_n).alias("form_n"))
    found = written(found.coalesce(files), "neighbours")
    last = roots(found.where(F.col("form").isNotNull()), files)
    found = found.join(last, "word", "left").withColumn("root", F.coalesce("root", "word"))
    if any_long:
        names = words.where(F.length("word") > KEY_CHARS).select(F.col("ref").alias("_ref"), F.col("word").alias("_word"))
        for c in ("word", "form", "root"):
            found = (found.join(names, F.col(c) == F.col("_ref"), "left")
                          .withColumn(c, F.coalesce("_word", c)).drop("_ref", "_word"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")
