"""Mixing sources to target weights by Poisson replication (operator 3).

A source's target share of the characters divided by its own gives the mean
number of repetitions of its documents. Each document's count is drawn by
inverting the Poisson distribution of that mean at a uniform number hashed from
its id and the seed, so the count is the same on any partitioning and after any
retry. Copies are exploded and dealt over all partitions by another hash, in
whose order the result is sorted: a global shuffle whose order is fixed by the
seed alone.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readyspark.llm.common import written

CHUNK = 32           # larger means are sums of draws with means of at most this
TERMS = 160          # P(draw > 160 | mean 32) is below the resolution of the hash
PART_CHARS = 128_000_000    # characters of a partition of the mixture
BROADCAST_SOURCES = 10_000  # rates of so many sources are broadcast (a kilobyte each)


def uniform(*parts: Column) -> Column:
    """52 bits of md5 of the parts joined by '|', as a double in [0, 1)."""
    text = F.concat_ws("|", *parts)
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def key_of(id_col: str, text_col: str) -> Column:
    """What is hashed for a row: its id, or the md5 of its text without one."""
    return F.coalesce(F.col(id_col).cast("string"), F.md5(F.coalesce(text_col, F.lit(""))))


def mix_key(key: Column, copy: Column, seed: int) -> Column:
    """A copy's place in the shuffled order, in [0, 1)."""
    return uniform(key, F.lit(str(seed)), F.lit("order"), copy.cast("string"))


def rates(docs: DataFrame, weights: Mapping[str, float] | None = None, power: float = 0.5,
          target_chars: float | None = None, source_col: str = "source", text_col: str = "text") -> DataFrame:
    """One row per source: ``src``, ``n_docs``, ``n_chars``, ``share`` (its target)
    and ``rate`` (mean repetitions).

    Weights are given by source (others get none) or are the characters to the
    ``power``. The target size is that of the input unless given. A null source
    is one of its own, named null. A source whose texts are all empty takes no
    share; its documents are repeated once on average.
    """
    sizes = docs.groupBy(F.col(source_col).alias("src")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.coalesce(F.sum(F.length(text_col)), F.lit(0)).alias("n_chars"))
    if weights is None:
        weight = F.pow(F.col("n_chars").cast("double"), F.lit(float(power)))
    else:
        given = F.create_map(*[F.lit(x) for pair in weights.items() for x in (str(pair[0]), float(pair[1]))])
        weight = F.coalesce(F.try_element_at(given, F.col("src").cast("string")), F.lit(0.0))
    weighted = written(sizes.withColumn("w", F.when(F.col("n_chars") > 0, weight).otherwise(0.0)), "sizes")
    total = weighted.agg(F.sum("w").alias("w"), F.sum("n_chars").alias("c")).first()
    size = float(target_chars if target_chars is not None else total["c"] or 0)
    share = F.col("w") / F.lit(float(total["w"] or 1.0))
    return weighted.select("src", "n_docs", "n_chars", share.alias("share"), F.when(
        F.col("n_chars") > 0, F.lit(size) * share / F.col("n_chars")).otherwise(F.lit(1.0)).alias("rate"))


def _distribution(rate: Column) -> Column:
    """Cumulative probabilities of 0, 1, ... at the mean of one draw."""
    first = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("c"))

    def add(s: Column, k: Column) -> Column:
        p = s["p"] * rate / k
        return F.struct(p.alias("p"), F.concat(s["c"], F.array(F.element_at(s["c"], -1) + p)).alias("c"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), first, add, lambda s: s["c"])


def _drawn(docs: DataFrame, seed: int, id_col: str, source_col: str, text_col: str, how: dict) -> tuple[DataFrame, float]:
    """``_doc`` (a whole row), ``_key``, ``_times``, and the characters to expect of all copies."""
    table = rates(docs, source_col=source_col, text_col=text_col, **how)
    draws = F.greatest(F.ceil(F.col("rate") / F.lit(CHUNK)), F.lit(1)).cast("int")
    table = table.select("src", draws.alias("_draws"), (F.col("rate") / draws).alias("_mean"), (F.col("rate") * F.col("n_chars")).alias("_chars"))
    table = written(table.withColumn("_cdf", _distribution(F.col("_mean"))).drop("_mean"), "rates")
    size = table.agg(F.count(F.lit(1)).alias("n"), F.sum("_chars").alias("chars")).first()
    if size["n"] <= BROADCAST_SOURCES:
        table = F.broadcast(table)
    # whole rows travel as one struct, so no helper can clash with their columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col(source_col).alias("_src"),
                       key_of(id_col, text_col).alias("_key"))
    keyed = rows.join(table, rows["_src"].eqNullSafe(table["src"]))

    def draw(j: Column) -> Column:
        u = uniform(F.col("_key"), F.lit(str(seed)), F.lit("times"), j.cast("string"))
        return F.element_at(F.transform(F.array(u), lambda x: F.size(F.filter("_cdf", lambda c: c <= x))), 1)

    times = F.aggregate(F.transform(F.sequence(F.lit(1), F.col("_draws")), draw), F.lit(0), lambda s, x: s + x)
    return keyed.select("_doc", "_key", times.alias("_times")), size["chars"] or 0.0


def repetitions(docs: DataFrame, seed: int = 42, id_col: str = "doc_id", source_col: str = "source",
                text_col: str = "text", **how) -> DataFrame:
    """``docs`` with ``_key`` (what is hashed) and ``_times``, each row's count; columns
    so named before are replaced.

    Rows of a null id are keyed by the md5 of their text; equal rows draw alike.
    """
    drawn, _ = _drawn(docs.drop("_key", "_times"), seed, id_col, source_col, text_col, how)
    return drawn.select("_doc.*", "_key", "_times")


def mix(docs: DataFrame, seed: int = 42, id_col: str = "doc_id", source_col: str = "source",
        text_col: str = "text", partitions: int | None = None, **how) -> DataFrame:
    """The columns of ``docs``, then ``copy`` (1, 2, ...) and ``mix_key``, in the
    order of ``mix_key`` over the partitions and within them. Columns of ``docs`` so
    named are replaced; others stay, whatever their names.

    Every document's copies are whole rows; an empty table gives none. The key is
    uniform, so partition k of n holds the keys of [k/n, (k+1)/n): no sampling
    pass is needed to deal them evenly, whatever the sources' sizes. Their number
    grows with the characters counted, ``PART_CHARS`` each.
    """
    spark = docs.sparkSession
    drawn, chars = _drawn(docs.drop("copy", "mix_key"), seed, id_col, source_col, text_col, how)
    n = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(chars / PART_CHARS))
    copies = drawn.where("_times > 0").select("_doc", "_key", F.explode(F.sequence(F.lit(1), F.col("_times"))).alias("copy"))
    dealt = copies.select("_doc", "copy", mix_key(F.col("_key"), F.col("copy"), seed).alias("mix_key"))
    dealt = dealt.repartitionById(n, F.floor(F.col("mix_key") * n).cast("int")).sortWithinPartitions("mix_key", F.col("_doc")[id_col])
    return dealt.select("_doc.*", "copy", "mix_key")
