"""URL filters by a Bloom filter cascade (operator 13).

The keys of a url are its host, every parent domain and host plus path. A list
of keys is encoded over the corpus's complete universe of keys: level 0 is a
Bloom filter of the listed keys; level 1 holds those other keys of the universe
that level 0 lets through by mistake; level 2 the listed keys that level 1 lets
through, and so on until no mistake is left. The first level that does not hold
a key tells whether it is listed: exact for every key of the corpus, without a
join, at a few bits for a listed key.

Level 0 is built by tasks that set bits and one small aggregate of the words set
twice. Lists whose filters would exceed ``SHARD_BITS`` are split by a hash of the
key into several cascades, one pass over the pages each.

Path rules stand above the list: a rule (host, path) fits a url whose host is the
rule's or a subdomain and whose path starts with the rule's; the longest wins.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readyspark.llm.common import ascii_lower, mix64, prepare_python, written

HOST_CHARS = 253  # of a domain name; parents of a longer host are sought in its last so many
SHARD_BITS = 1 << 28  # of a cascade's first level: 32 MB are broadcast at most
LOCAL_KEYS = 500_000  # remaining keys (8 MB of hashes) up to which the driver ends a cascade
MOST_LEVELS = 200
_ODD = np.uint64(0x9E3779B97F4A7C15)


# ------------------------------------------------------------------ url parts, keys and rules

def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def keys_of(host: Column, path: Column) -> Column:
    """The host and its parent domains, and host plus path; none without a host."""
    labels = F.split(F.substring(host, -HOST_CHARS, HOST_CHARS), r"\.")
    cut = F.length(host) > HOST_CHARS  # then the first label may be a part of one
    suffixes = F.transform(F.sequence(F.when(cut, 2).otherwise(1), F.greatest(F.size(labels), F.lit(2))),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    page = F.concat(host, F.when(path == "", "/").otherwise(path))
    every = F.concat(suffixes, F.array(page), F.when(cut, F.array(host)).otherwise(F.array().cast("array<string>")))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.filter(every, lambda k: k != "")))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest fitting rule as a struct (``rule`` its text, ``verdict``), null
    where none fits. ``rules``: (verdict, host, path). Ties: the longer host."""
    fitting = []
    for verdict, rule_host, rule_path in rules:
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        fitting.append(F.when(fits, F.struct(F.lit(len(rule_host + rule_path)).alias("size"), F.lit(len(rule_host)).alias("host"),
                                             F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.array_max(F.array_compact(F.array(*fitting))) if fitting else F.lit(None).cast("struct<rule:string,verdict:string>")


# ------------------------------------------------------------------ the cascade

def _places(h1: np.ndarray, h2: np.ndarray, level: int, bits: int, k: int) -> Iterator[np.ndarray]:
    """The ``k`` bits of each key in a level's filter."""
    with np.errstate(over="ignore"):
        step = np.uint64(level + 1) * _ODD
        a, b = mix64(h1.astype(np.uint64) + step), mix64(h2.astype(np.uint64) ^ step) | np.uint64(1)
        for i in range(k):
            yield (a + np.uint64(i) * b) % np.uint64(bits)


def _filter_size(n: int, rate: float) -> tuple[int, int]:
    """Bits and hashes of a Bloom filter of ``n`` keys with a rate of mistakes."""
    bits = max(64, math.ceil(n * math.log2(1 / rate) / math.log(2)))
    return -(-bits // 64) * 64, max(1, round(math.log2(1 / rate)))


class Cascade:
    """Levels (bits, hashes, words): even ones hold listed keys, odd ones others."""

    def __init__(self):
        self.levels: list[tuple[int, int, np.ndarray]] = []

    def holds(self, level: int, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        bits, k, words = self.levels[level]
        out = np.ones(len(h1), bool)
        for at in _places(h1, h2, level, bits, k):
            out &= (words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0
        return out

    def listed(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        out = np.zeros(len(h1), bool)
        left = np.arange(len(h1))
        for level in range(len(self.levels)):
            held = self.holds(level, h1[left], h2[left])
            out[left[~held]] = level % 2 == 1
            left = left[held]
        out[left] = len(self.levels) % 2 == 1  # held by the last level, which makes no mistake
        return out

    def add(self, n: int, rate: float, words: np.ndarray) -> None:
        self.levels.append((*_filter_size(n, rate), words))


def _set(words: np.ndarray, h1: np.ndarray, h2: np.ndarray, level: int, bits: int, k: int) -> np.ndarray:
    for at in _places(h1, h2, level, bits, k):
        np.bitwise_or.at(words, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    return words


def _filter(own: DataFrame, level: int, bits: int, k: int) -> np.ndarray:
    """The filter of a table of keys: tasks set bits, equal words are united."""

    def set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(bits // 64, np.uint64)
        for b in batches:
            _set(words, b.column(0).to_numpy(), b.column(1).to_numpy(), level, bits, k)
        at = np.flatnonzero(words)
        for i in range(0, len(at), 50_000):
            part = at[i:i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(words[part].view(np.int64))], names=["at", "word"])

    found = own.select("h1", "h2").mapInArrow(set_bits, "at long, word long").groupBy("at").agg(F.bit_or("word").alias("word"))
    words = np.zeros(bits // 64, np.uint64)
    rows = found.toArrow()  # at most SHARD_BITS / 64 words
    words[rows["at"].to_numpy()] = rows["word"].to_numpy().view(np.uint64)
    return words


def build_cascade(keys: DataFrame, local_keys: int = LOCAL_KEYS) -> Cascade:
    """The cascade of a table of distinct keys (``h1, h2, listed``), written before.

    A level keeps its own side and the other side's mistakes; when ``local_keys``
    are left at most, the rest is built on the driver with the same bits."""
    prepare_python(keys.sparkSession)
    cascade, level = Cascade(), 0
    counts = {r["listed"]: r["count"] for r in keys.groupBy("listed").count().collect()}
    rate = min(0.5, math.sqrt(2) * counts.get(True, 0) / max(1, counts.get(False, 0)))
    while counts.get(level % 2 == 0, 0):
        if level > MOST_LEVELS:
            raise RuntimeError("two keys with equal 128-bit hashes, one of them listed")
        own = F.col("listed") == F.lit(level % 2 == 0)
        n = counts[level % 2 == 0]
        cascade.add(n, rate, _filter(keys.where(own), level, *_filter_size(n, rate)))
        held = keys.sparkSession.sparkContext.broadcast(cascade)

        def keep(batches, level=level, held=held):
            for b in batches:
                mine = b.column(2).to_numpy(zero_copy_only=False) == (level % 2 == 0)
                ok = mine | held.value.holds(level, b.column(0).to_numpy(), b.column(1).to_numpy())
                yield b.filter(pa.array(ok))

        keys = written(keys.select("h1", "h2", "listed").mapInArrow(keep, "h1 long, h2 long, listed boolean"), "keys")
        counts = {r["listed"]: r["count"] for r in keys.groupBy("listed").count().collect()}
        level, rate = level + 1, 0.5
        if sum(counts.values()) <= local_keys:
            rest = keys.toArrow()
            listed = rest["listed"].to_numpy()
            h = {side: [rest[c].to_numpy()[listed == side] for c in ("h1", "h2")] for side in (True, False)}
            return _end(cascade, h, level)
    return cascade


def _end(cascade: Cascade, h: dict[bool, list[np.ndarray]], level: int) -> Cascade:
    while len(h[level % 2 == 0][0]):
        if level > MOST_LEVELS:
            raise RuntimeError("two keys with equal 128-bit hashes, one of them listed")
        own, other = h[level % 2 == 0], h[level % 2 == 1]
        size = _filter_size(len(own[0]), 0.5)
        cascade.add(len(own[0]), 0.5, _set(np.zeros(size[0] // 64, np.uint64), *own, level, *size))
        wrong = cascade.holds(level, *other)
        h[level % 2 == 1] = [x[wrong] for x in other]
        level += 1
    return cascade


# ------------------------------------------------------------------ judging pages

def universe(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """``key``: every distinct key of the pages' urls."""
    url = F.col(url_col)
    return pages.select(F.explode(keys_of(host_of(url), path_of(url))).alias("key")).distinct()


def domains_with_terms(keys: DataFrame, terms: Sequence[str]) -> DataFrame:
    """``key``: domains whose first label has one of ``terms`` as a part between hyphens."""
    first = F.split(F.substring_index("key", ".", 1), "-")
    return keys.where(~F.col("key").contains("/") & F.arrays_overlap(first, F.array(*[F.lit(t) for t in terms])))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]], listed: DataFrame, id_col: str = "page_id",
          url_col: str = "url", keys: DataFrame | None = None, shard_bits: int = SHARD_BITS,
          local_keys: int = LOCAL_KEYS) -> DataFrame:
    """One row per page: id, ``host``, ``path``, ``rule``, ``verdict`` (``allow`` or
    ``block``: the rule's, else block where a key of the url is in ``listed``, a
    table with a column ``key``), ``listed`` (whether a key is).

    A null url, or one without ``://``, has an empty host and path, no keys and no
    rule: allowed. Repeated rows and null ids are judged like others; null keys
    of the list are ignored, repeated ones count once, those that no page has
    cost nothing; other columns are ignored, whatever their names; an empty
    table gives no rows. Parents of a host of more than ``HOST_CHARS`` code points
    are those that fit its last ``HOST_CHARS``.
    """
    spark = pages.sparkSession
    keys = universe(pages, url_col) if keys is None else keys
    flagged = keys.select("key", F.lit(True).alias("seen"), F.lit(False).alias("listed")).unionByName(
        listed.where("key is not null").select("key", F.lit(False).alias("seen"), F.lit(True).alias("listed")))
    flagged = flagged.groupBy("key").agg(F.max("seen").alias("seen"), F.max("listed").alias("listed")).where("seen")
    hashes = [F.xxhash64("key").alias("h1"), F.xxhash64("key", F.lit(13)).alias("h2")]
    flagged = written(flagged.select(*hashes, "listed"), "keys")
    counts = {r["listed"]: r["count"] for r in flagged.groupBy("listed").count().collect()}
    rate = min(0.5, math.sqrt(2) * counts.get(True, 0) / max(1, counts.get(False, 0)))
    shards = max(1, math.ceil(_filter_size(counts[True], rate)[0] / shard_bits)) if counts.get(True) else 1

    url = F.col(url_col)
    rows = pages.select(F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rule = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.select("id", "host", "path", rule["rule"].alias("rule"), rule["verdict"].alias("verdict"), F.lit(False).alias("listed"))
    for shard in range(shards):
        part = F.pmod(F.col("h2"), F.lit(shards)) == shard
        cascade = build_cascade(flagged.where(part), local_keys)
        rows = _probe(rows, cascade, shards, shard)
        if shard < shards - 1:
            rows = written(rows, "judged")
    verdict = F.coalesce("verdict", F.when(F.col("listed"), "block").otherwise("allow"))
    return rows.select(F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), "listed")


def _probe(rows: DataFrame, cascade: Cascade, shards: int, shard: int) -> DataFrame:
    """``listed`` set where a key of the row is in the cascade."""
    held = rows.sparkSession.sparkContext.broadcast(cascade)
    keys = keys_of(F.col("host"), F.col("path"))
    hashed = rows.select("*", F.transform(keys, lambda k: F.xxhash64(k)).alias("h1"),
                         F.transform(keys, lambda k: F.xxhash64(k, F.lit(13))).alias("h2"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_columns
            lengths = np.diff(b.column(n - 2).offsets.to_numpy())
            h1, h2 = (b.column(i).flatten().to_numpy() for i in (n - 2, n - 1))
            hit = held.value.listed(h1, h2) & (h2 % shards == shard)
            row = np.repeat(np.arange(b.num_rows), lengths)
            found = b.column(n - 3).to_numpy(zero_copy_only=False).copy()
            found[row[hit]] = True
            yield pa.RecordBatch.from_arrays([*b.columns[:n - 3], pa.array(found)], names=b.schema.names[:n - 2])

    prepare_python(rows.sparkSession)
    return hashed.mapInArrow(probe, kinds)
