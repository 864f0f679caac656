"""Hard negatives by an inverted multi-index (operator 12).

Vectors are cut in two halves. A codebook of each half, fitted on a bounded
sample, gives every row a cell (a pair of centres). A row's score with an anchor
is the sum of two half scores, and a half score is at most that of the centre
plus the anchor half's length times the radius of the centre's rows. So cells
come in falling order of the sum of their two half bounds, from a heap over the
two sorted lists of half bounds, and a search is certified as soon as the next
bound is below everything it could still use. It is exact, whatever the
codebooks are: they decide only how early it stops.

The index is dealt by a hash of the id into shards, each small enough for one
task; every anchor visits every shard, and the shards' results are merged by
rank. Anchors stream through a shard's task, so a task holds one shard and one
batch of anchors.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from readyspark.llm.common import few, prepare_python, written

SAMPLE_ROWS = 20_000  # rows, of least id hash, that the codebooks are fitted on
SHARD_ROWS = 200_000  # at most about so many rows in a shard (its task's memory)
LEAST_SHARD_ROWS = 4_000
CELL_ROWS = 32  # rows of a cell on average, which sets the size of the codebooks
MOST_CENTRES = 256
_EXACT = float(1 << 53)


def rows_of(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int, swap_every: int,
            n_labels: int) -> DataFrame:
    """``id, label, x``: the rows that take part, components as whole numbers. Of rows
    with the same id the one of least label and vector takes part; the dimension is
    that of most rows (ties: the larger), and vectors of another take no part."""
    x = F.transform(F.col(vector_col), lambda v: F.floor(F.lit(scale).cast("double") * v.cast("double")).cast("double"))
    ok = F.forall(F.col(vector_col), lambda v: v.isNotNull() & ~F.isnan(v.cast("double"))
                  & (F.abs(v.cast("double")) != float("inf")))
    label = F.when(F.col(id_col) % swap_every == 0, (F.col(label_col) + 1) % n_labels).otherwise(F.col(label_col))
    good = vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (F.size(vector_col) > 0) & F.coalesce(ok, F.lit(False)))
    good = good.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), x.alias("x"))
    sizes = good.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    good = good.where(F.size("x") == (sizes["size"] if sizes else 0))
    return good.groupBy("id").agg(F.min(F.struct("label", "x")).alias("v")).select("id", "v.label", "v.x")


def _centres(x: np.ndarray, k: int, turns: int = 8) -> np.ndarray:
    """Lloyd's iterations from evenly spaced rows of the sample."""
    c = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(turns):
        at = _nearest(x, c)
        n = np.bincount(at, minlength=k)
        total = np.zeros_like(c)
        np.add.at(total, at, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.argmin((c * c).sum(1) - 2 * (x @ c.T), axis=1)


def codebooks(rows: DataFrame, shard_rows: int) -> tuple[np.ndarray, np.ndarray] | None:
    """The two halves' centres, from the rows of least id hash (at most ``SAMPLE_ROWS``)."""
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).select("x").toArrow()
    if not sample.num_rows:
        return None
    x = _matrix(sample.column(0).combine_chunks())
    k = max(1, min(MOST_CENTRES, len(x), round(math.sqrt(shard_rows / CELL_ROWS))))
    half = x.shape[1] // 2
    return _centres(x[:, :half], k), _centres(x[:, half:], k)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


class MultiIndex:
    """The rows of one shard, sorted by cell and label."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, books: tuple[np.ndarray, np.ndarray]):
        half = x.shape[1] // 2
        at = [_nearest(h, c) for h, c in zip((x[:, :half], x[:, half:]), books)]
        self.k = len(books[0])
        cell = at[0] * self.k + at[1]
        order = np.lexsort((ids, labels, cell))
        self.ids, self.labels, self.x, self.books, self.half = ids[order], labels[order], x[order], books, half
        self.kinds, kind = np.unique(self.labels, return_inverse=True)
        cell = cell[order]
        self.start = np.searchsorted(cell, np.arange(self.k * self.k + 1))
        self.place = cell * len(self.kinds) + kind  # sorted: rows of a cell's label lie together
        self.radius = []
        for h, (a, c) in enumerate(zip(at, books)):
            part = x[:, :half] if h == 0 else x[:, half:]
            r = np.zeros(self.k)
            np.maximum.at(r, a, np.sqrt(((part - c[a]) ** 2).sum(1)))
            self.radius.append(r)
        self.longest = float(np.abs(self.x).max(initial=0))

    def scores(self, q: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Exact integer scores of the rows at ``at``."""
        most = float(np.abs(q).sum()) * self.longest
        if most < _EXACT:
            return (self.x[at] @ q).astype(np.int64)
        exact = [sum(int(a) * int(b) for a, b in zip(row, q)) for row in self.x[at]]
        return np.array(exact, dtype=np.int64 if most < 2.0 ** 62 else object)

    def cells(self, q: np.ndarray) -> Iterator[tuple[list, list, float]]:
        """Batches of cells in falling order of their upper bounds (each batch twice the
        last one), their lower bounds, and the bound of the next cell."""
        bound, low = [], []
        for part, c, r in zip((q[:self.half], q[self.half:]), self.books, self.radius):
            near, reach = c @ part, np.sqrt((part * part).sum()) * r
            bound.append(near + reach)
            low.append(near - reach)
        order = [np.argsort(-b, kind="stable") for b in bound]
        a, b = (x[o].tolist() for x, o in zip(bound, order))
        slack = 1e-9 * (abs(a[0]) + abs(b[0]) + abs(a[-1]) + abs(b[-1])) + 1e-6  # of the bounds' own rounding
        (oa, ob), (la, lb) = (o.tolist() for o in order), (x.tolist() for x in low)
        heap, reached = [(-(a[0] + b[0]), 0, 0)], {(0, 0)}
        size, start = 8, self.start
        while heap:
            cells, lows = [], []
            while heap and len(cells) < size:
                _, i, j = heapq.heappop(heap)
                cell = oa[i] * self.k + ob[j]
                if start[cell] < start[cell + 1]:
                    cells.append(cell)
                    lows.append(la[oa[i]] + lb[ob[j]] - slack)
                for n in ((i + 1, j), (i, j + 1)):
                    if n[0] < self.k and n[1] < self.k and n not in reached:
                        reached.add(n)
                        heapq.heappush(heap, (-(a[n[0]] + b[n[1]]), *n))
            size *= 2
            yield cells, lows, (-heap[0][0] + slack if heap else -math.inf)

    def _slices(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        n = ends - starts
        return np.repeat(starts - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(int(n.sum()))

    def positives(self, anchor: int, label: int, q: np.ndarray, most: int) -> list[tuple[int, int]]:
        """The ``most`` best other rows of the label: (score, id), best first."""
        kind = int(np.searchsorted(self.kinds, label))
        if kind == len(self.kinds) or self.kinds[kind] != label:
            return []
        best: list[tuple[int, int]] = []
        for cells, _, bound in self.cells(q):
            key = np.array(cells, np.int64) * len(self.kinds) + kind
            at = self._slices(np.searchsorted(self.place, key), np.searchsorted(self.place, key + 1))
            at = at[self.ids[at] != anchor]
            best = _top(best, self.scores(q, at), self.ids[at], most)
            if len(best) == most and bound < best[-1][0]:
                break
        return best

    def windows(self, label: int, q: np.ndarray, positives: list[int], low: int, high: int, most: int) -> list[list]:
        """For each positive's score p the first ``most`` rows of other labels with
        ``low * p <= 100 * score <= high * p``."""
        found: list[list] = [[] for _ in positives]
        open_ = [n for n, p in enumerate(positives) if p >= 0]  # no score fits a negative p
        for cells, lows, bound in self.cells(q):
            if not open_:
                break
            top = max(high * positives[n] for n in open_)
            cells = np.array([c for c, l in zip(cells, lows) if 100 * l <= top], np.int64)  # else wholly above
            at = self._slices(self.start[cells], self.start[cells + 1])
            at = at[self.labels[at] != label]
            s = self.scores(q, at)
            for n in open_:
                p = positives[n]
                ok = (100 * s >= low * p) & (100 * s <= high * p)
                if len(found[n]) == most:
                    ok &= s >= found[n][-1][0]
                ok = np.flatnonzero(ok)
                found[n] = _top(found[n], s[ok], self.ids[at[ok]], most)
            open_ = [n for n in open_ if 100 * bound >= low * positives[n]
                     and (len(found[n]) < most or bound >= found[n][-1][0])]
        return found


def _top(held: list, scores: np.ndarray, ids: np.ndarray, most: int) -> list:
    if not len(scores):
        return held
    if len(scores) > most:
        keep = np.lexsort((ids, -scores))[:most]
        scores, ids = scores[keep], ids[keep]
    return sorted(held + list(zip(scores.tolist(), ids.tolist())), key=lambda r: (-r[0], r[1]))[:most]


def _search(index: DataFrame, anchors: DataFrame, shards: int, books, found: str,
            run: Callable[[MultiIndex, dict], Iterator[tuple]]) -> DataFrame:
    """Every anchor (``id, label, x, given``) at every shard: ``run``'s rows.

    A partition's rows come sorted: a shard's index rows, then the anchors that
    visit it. The shard is indexed when its first anchor arrives."""
    spark = index.sparkSession
    prepare_python(spark)
    held = spark.sparkContext.broadcast(books)
    wanted = anchors.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    both = index.select("shard", F.lit(0).alias("visits"), "id", "label", "x", F.lit(None).cast(anchors.schema["given"].dataType).alias("given"))
    both = both.unionByName(wanted.select("shard", F.lit(1).alias("visits"), "id", "label", "x", "given"))
    both = both.repartition(shards, "shard").sortWithinPartitions("shard", "visits")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, shard, made = [], None, None
        schema = pa.schema([(n.split()[0], pa.list_(pa.int64()) if n.endswith(">") else pa.int64()) for n in found.split(", ")])
        for b in batches:
            cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            x, given, out = _matrix(b.column(4)), b.column(5), []
            # rows of one shard and side at a time
            cuts = np.flatnonzero((np.diff(cols[0]) != 0) | (np.diff(cols[1]) != 0)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows]):
                if cols[0][lo] != shard:
                    parts, shard, made = [], cols[0][lo], None
                if cols[1][lo] == 0:
                    parts.append((cols[2][lo:hi].copy(), cols[3][lo:hi].copy(), x[lo:hi].copy()))
                    continue
                if made is None and parts:
                    made = MultiIndex(*(np.concatenate(p) for p in zip(*parts)), held.value)
                    parts = []
                if made is None:
                    continue  # a shard without rows
                for n in range(lo, hi):
                    out.extend(run(made, {"id": int(cols[2][n]), "label": int(cols[3][n]), "x": x[n], "given": given[n].as_py()}))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return both.mapInArrow(search, found)


def mine(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         anchor_every: int = 100, n_positives: int = 5, n_negatives: int = 10, low: int = 30, high: int = 90,
         scale: int = 256, swap_every: int = 7, n_labels: int = 10, shard_rows: int | None = None) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Scores are integer inner products of ``floor(scale * component)``; higher come
    first, ties by smaller id. Anchors are the rows whose id is divisible by
    ``anchor_every``; each has its first ``n_positives`` other rows of its label, and
    each of these the first ``n_negatives`` rows of other labels whose score is
    between ``low`` and ``high`` per cent of the positive's. Labels of ids divisible
    by ``swap_every`` become (label + 1) % ``n_labels`` first (planted noise).

    Rows with a null id, label or vector, an empty one, or a null or non-finite
    component take no part; see :func:`rows_of` for repeated ids and mixed
    dimensions. Exact as long as scores fit 64 bits. Other columns are ignored,
    whatever their names; an empty table, or one without anchors, gives no rows.
    """
    spark = vectors.sparkSession
    rows = written(rows_of(vectors, id_col, vector_col, label_col, scale, swap_every, n_labels), "vectors")
    n = rows.count()
    if shard_rows is None:
        shard_rows = min(SHARD_ROWS, max(LEAST_SHARD_ROWS, n // (2 * spark.sparkContext.defaultParallelism)))
    shards = max(1, math.ceil(n / shard_rows))
    books = codebooks(rows, min(n, shard_rows))
    index = rows.withColumn("shard", F.pmod(F.xxhash64("id", F.lit(12)), F.lit(shards)).cast("int"))
    anchors = rows.where(F.col("id") % anchor_every == 0)

    def positives(made: MultiIndex, a: dict) -> Iterator[tuple]:
        for s, i in made.positives(a["id"], a["label"], a["x"], n_positives):
            yield a["id"], i, s

    first = _search(index, anchors.withColumn("given", F.lit(None).cast("array<long>")), shards, books,
                    "id long, other long, score long", positives)
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("score"), "other"))
    best = written(first.withColumn("rank", rank).where(F.col("rank") <= n_positives), "positives")

    def negatives(made: MultiIndex, a: dict) -> Iterator[tuple]:
        for p, rows in enumerate(made.windows(a["label"], a["x"], a["given"], low, high, n_negatives)):
            for s, i in rows:
                yield a["id"], p + 1, i, s

    given = best.groupBy("id").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "score"))), lambda r: r["score"]).alias("given"))
    second = _search(index, anchors.join(few(given), "id"), shards, books,
                     "id long, positive long, other long, score long", negatives)
    rank = F.row_number().over(Window.partitionBy("id", "positive").orderBy(F.desc("score"), "other"))
    second = second.withColumn("place", rank).where(F.col("place") <= n_negatives)
    named = best.select("id", F.col("rank").cast("long").alias("positive"), F.col("other").alias("positive_id"),
                        F.col("score").alias("positive_score"))
    return second.join(named, ["id", "positive"]).select(
        F.col("id").alias("anchor_id"), "positive_id", F.col("place").cast("int").alias("rank"),
        F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
