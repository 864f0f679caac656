"""Benchmark decontamination with DataFrame functions only (operator 7).

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. A window
is ``size`` consecutive words of a benchmark item; an item of fewer words, but
not none, is one window. A document's words inside any occurrence of a window
are hit.

A benchmark of at most ``LITERAL_WINDOWS`` windows and ``LITERAL_BYTES`` bytes of
windows and item ids (counted first) goes to the tasks as hash sets inside the
plan: the scan looks up the hash of each run of three words, verifies the whole
window at the few places that pass, and needs no shuffle, no join and no second
read. Of a larger benchmark the 64-bit window hashes are broadcast, up to
``BROADCAST_KEYS`` of them: the scan probes its windows' hashes, and only the hits
meet the benchmark's words and ids, in a join that verifies them. Beyond that the
probe is a shuffled join. All ways give the same rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readyspark.llm.common import ascii_lower, few, written

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SIZE = 10
PROBE = 3                 # words whose hash is looked up first
LITERAL_WINDOWS = 20_000
LITERAL_BYTES = 4 << 20   # of the windows and the ids of their items


def words_of(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), lambda w: w != "")


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                      size: int = SIZE) -> DataFrame:
    """``win`` (words joined by blanks), ``len`` and the sorted ``items`` that hold
    it, ids as strings. An item without an id has windows but isn't listed."""
    items = benchmark.select(F.col(id_col).cast("string").alias("item"), words_of(F.col(text_col)).alias("w"))
    items = items.where(F.size("w") > 0).withColumn("len", F.least(F.size("w"), F.lit(size)))
    each = items.select("item", "len", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("w") - F.col("len") + 1),
        lambda i: F.slice("w", i, F.col("len")))).alias("run"))
    return each.groupBy(F.array_join("run", " ").alias("win"), "len").agg(
        F.sort_array(F.collect_set("item")).alias("items"))


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _runs(w: str, length: int) -> str:
    """SQL of the 0-based starts of every run of ``length`` words of ``w``."""
    return f"if(size({w}) < {length}, array(), sequence(0, size({w}) - {length}))"


def _literal_hits(windows: list) -> str:
    """SQL: the sorted hits (``pos``, ``len``, ``items``) of the word array ``w``."""
    by_length: dict[int, list] = {}
    for r in windows:
        by_length.setdefault(r["len"], []).append(r)
    found = []
    for length, rows in sorted(by_length.items()):
        probe = min(PROBE, length)
        hashes = ",".join(str(h) for h in sorted({r["probe"] for r in rows}))
        names = ",".join(_quoted(r["win"]) for r in rows)
        items = ",".join(f"{_quoted(r['win'])},array({','.join(map(_quoted, r['items'])) or 'cast(null as string)'})"
                         for r in rows)
        key = ",".join(f"get(w, i + {k})" for k in range(probe))
        at = f"filter({_runs('w', length)}, i -> xxhash64({key}) IN ({hashes}))"
        run = f"array_join(slice(w, i + 1, {length}), ' ')"
        at = f"filter({at}, i -> {run} IN ({names}))"
        found.append(f"transform({at}, i -> struct(i AS pos, {length} AS len, element_at(map({items}), {run}) AS items))")
    hits = found[0] if len(found) == 1 else f"array_sort(concat({','.join(found)}))"
    return f"transform(array(words), w -> {hits})[0]"


HITS = "array<struct<pos:int,len:int,items:array<string>>>"


def with_hits(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", size: int = SIZE,
              item_col: str = "item_id", item_text: str = "text",
              literal_windows: int = LITERAL_WINDOWS) -> DataFrame:
    """The rows of ``docs`` (as struct ``row``) with ``n_words`` and ``hits``, the
    occurrences of benchmark windows in order: 0-based first word, length, items.

    Null and wordless texts have no words and no hits; repeated rows are kept;
    an empty benchmark hits nothing.
    """
    windows = written(benchmark_windows(benchmark, item_col, item_text, size), "windows")
    rows = docs.select(F.struct("*").alias("row"), words_of(docs[text_col]).alias("words"))
    size = windows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("win") + F.octet_length(F.array_join("items", " "))).alias("bytes")).first()
    n = size["n"]
    if not n:
        return rows.select("row", F.size("words").alias("n_words"), F.expr(f"cast(array() AS {HITS})").alias("hits"))
    if n <= literal_windows and size["bytes"] <= LITERAL_BYTES:
        first = F.split("win", " ")
        probe = windows.select("win", "len", "items", F.xxhash64(*[F.get(first, F.lit(k)) for k in range(PROBE)]).alias("p3"),
                               F.xxhash64(F.get(first, F.lit(0))).alias("p1"),
                               F.xxhash64(F.get(first, F.lit(0)), F.get(first, F.lit(1))).alias("p2"))
        short = F.when(F.col("len") == 1, F.col("p1")).when(F.col("len") == 2, F.col("p2")).otherwise(F.col("p3"))
        held = probe.select("win", "len", "items", short.alias("probe")).collect()
        return rows.select("row", F.size("words").alias("n_words"), F.expr(_literal_hits(held)).cast(HITS).alias("hits"))
    return _joined_hits(rows, windows)


def _joined_hits(rows: DataFrame, windows: DataFrame) -> DataFrame:
    """The same by joins, for benchmarks of any size: rows get a number in a
    written table, their windows' hashes meet the benchmark's hashes, and hits
    are verified on the words."""
    rows = written(rows.withColumn("_n", F.monotonically_increasing_id()), "numbered")
    lengths = [r["len"] for r in windows.select("len").distinct().collect()]  # at most the window size
    starts = [F.expr(f"transform({_runs('words', m)}, i -> struct(i AS pos, {m} AS len, "
                     f"xxhash64({','.join(f'get(words, i + {k})' for k in range(m))}) AS h))") for m in sorted(lengths)]
    runs = rows.select("_n", F.explode(F.concat(*starts)).alias("r")).select("_n", "r.*")
    first = F.split("win", " ")
    known = reduce(DataFrame.unionByName, [windows.where(F.col("len") == m).select("len", "win", "items", F.xxhash64(
        *[F.get(first, F.lit(k)) for k in range(m)]).alias("h")) for m in sorted(lengths)])
    probe = few(written(known.select("len", "h").distinct(), "probe"))
    met = runs.join(probe, ["len", "h"])  # few rows: places of hashes that the benchmark has
    near = met.join(known, ["len", "h"]).select("_n", "pos", "len", "win", "items")
    sure = near.join(rows.select("_n", "words"), "_n").where(
        F.expr("array_join(slice(words, pos + 1, len), ' ') = win"))
    hits = sure.groupBy("_n").agg(F.sort_array(F.collect_list(F.struct("pos", "len", "items"))).cast(HITS).alias("hits"))
    return rows.join(hits, "_n", "left").select("row", F.size("words").alias("n_words"), F.coalesce(
        "hits", F.expr(f"cast(array() AS {HITS})")).alias("hits"))


HIT_WORDS = """aggregate(hits, struct(0 AS upto, 0 AS total),
  (s, x) -> struct(greatest(s.upto, x.pos + x.len) AS upto,
                   s.total + greatest(0, x.pos + x.len - greatest(s.upto, x.pos)) AS total), s -> s.total)"""
ITEMS = "sort_array(filter(array_distinct(flatten(transform(hits, x -> x.items))), x -> x IS NOT NULL))"


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  **how) -> DataFrame:
    """Per row: id, ``n_words``, ``n_hit``, ``items``, ``contaminated``."""
    found = with_hits(docs.select(id_col, text_col), benchmark, text_col, **how)
    return found.select(F.col(f"row.{id_col}").alias(id_col), F.col("n_words").cast("long").alias("n_words"),
                        F.expr(HIT_WORDS).cast("long").alias("n_hit"), F.expr(ITEMS).alias("items"),
                        (F.size("hits") > 0).alias("contaminated"))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and the hash of the item list, as compared with other engines."""
    return found.select(id_col, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` without a benchmark window."""
    return with_hits(docs, benchmark, text_col, **how).where(F.size("hits") == 0).select("row.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """``docs`` with the hit words, and what separates them from the next word,
    cut out of the texts; other rows unchanged."""
    found = with_hits(docs, benchmark, text_col, **how).withColumn("_text", F.col("row")[text_col])
    # words and separators take turns; ``lead`` is 1 where a separator comes first
    cut = F.expr(rf"""transform(array(struct(regexp_extract_all(_text, r'[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+', 0) AS t,
      if(_text rlike r'^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]', 1, 0) AS lead)), x ->
      array_join(filter(x.t, (p, k) -> k < x.lead
        OR NOT exists(hits, h -> floor((k - x.lead) / 2) BETWEEN h.pos AND h.pos + h.len - 1)), ''))[0]""")
    text = F.when(F.size("hits") > 0, cut).otherwise(F.col("_text"))
    return found.select(*[text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])
