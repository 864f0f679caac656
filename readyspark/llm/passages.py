"""Passages repeated across documents, by collinear chaining (operator 6).

1. Seeds. Texts of the same word sequence form a class, searched once. A class's
   seeds are its word k-mers of small hash, a fixed share of all k-mers whatever
   stands around them, and the least k-mer of every ``WINDOW`` neighbouring ones
   that have none: so any ``WINDOW + KMER - 1`` words that two texts share hold a
   common seed, and a passage with many changed words still shares several.
2. Join. A seed's owner is the least of the texts that have it (a map-side
   combined minimum); every other text's occurrence is matched with the owner's.
   That is one match per occurrence, however many texts share a passage. A match,
   a lone one too, is extended at both ends as the alignment would, on a byte a word
   of the ``CONTEXT`` words around it. Extents no more than ``SPARSE`` words apart in
   the text are a run; matches go on whose run spans a passage's words.
3. Chains. The matches of two texts, merged along diagonals, are chained in order
   in both: a match adds its words, a gap costs its words on either side. A
   Fenwick tree over places in the owner gives the best predecessor, so a
   pair's matches take n log n.
4. Alignment. Chains are extended word by word at both ends and their gaps aligned
   (edit distance); a chain of too low similarity falls apart at its large gaps.
5. Spans of a document that touch are joined, whoever owns them; those of
   ``MIN_WORDS`` words and more are its repeated passages.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readyspark.llm.common import (few, fresh, list_array, mix64, prepare_python, text_bytes, window_hashes, word_hashes, written)
from readyspark.session import drop_tables

KMER = 5
SHARE = 0.15         # of the k-mers that are seeds
WINDOW = 24
CONTEXT = 48         # words on either side of a match that its extent is found in
SPARSE = 40          # words between extents that may belong to one passage
RUN_SHARE = 0.85     # of a passage's words that extents must span
GAP_COST = 0.25      # words of score that a word of gap costs, on either side
LARGE_GAP = 8        # words; where a chain of low similarity is cut
GIVE_UP = 8         # score below the best at which an end is given up
REACH = 256          # words of an end that are compared at once
TOUCH = 5            # words between spans that are joined
HOT = 5000           # occurrences of a seed that one task joins
PART_WORDS = 12      # aligned words of a chain that counts towards a passage
ALIGN_PARTS = 4      # in which texts are aligned one after the other, so that a part's words lie on disk ..
ALIGN_PAIRS = 10_000  # .. where each has so many pairs of texts
MIN_WORDS = 50
MIN_SIMILARITY = 0.75
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def seeds(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of a text's seeds, by place. Of equal k-mers within
    ``WINDOW`` places one is a seed, so endless repeats have few."""
    grams = window_hashes(words, KMER)
    if not len(grams):
        return grams, np.empty(0, np.int64)
    least = np.flatnonzero(grams < np.uint64(SHARE * 2.0 ** 64))
    # runs of places without a seed that are WINDOW long or longer
    ends = np.concatenate([[-1], least, [len(grams)]])
    more = [least]
    for a, b in zip(ends[:-1][np.diff(ends) > WINDOW], ends[1:][np.diff(ends) > WINDOW]):
        free = grams[a + 1:b] & ~np.uint64(31) | (np.arange(b - a - 1) % WINDOW).astype(np.uint64)
        runs = np.lib.stride_tricks.sliding_window_view(free, WINDOW)
        more.append(np.unique(runs.argmin(axis=1) + np.arange(len(runs))) + a + 1)
    if len(grams) < WINDOW and not len(least):
        more.append(np.array([int(grams.argmin())]))
    at = np.sort(np.concatenate(more))
    block, order = at // WINDOW, np.lexsort((at, at // WINDOW, grams[at]))
    again = np.zeros(len(at), bool)
    again[order[1:]] = (grams[at][order[1:]] == grams[at][order[:-1]]) & (block[order[1:]] == block[order[:-1]])
    at = at[~again]
    return grams[at], at


def class_key(words: np.ndarray) -> int:
    """64-bit hash of a whole word sequence."""
    with np.errstate(over="ignore"):
        mixed = mix64(words + (np.arange(len(words), dtype=np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))
        return int(mix64(np.array([mixed.sum(dtype=np.uint64) ^ np.uint64(len(words))])).view(np.int64)[0])


class Fenwick:
    """Running maximum over places 0..n-1."""

    def __init__(self, n: int):
        self.best: list[tuple[float, int]] = [(float("-inf"), -1)] * (n + 1)

    def raise_to(self, place: int, value: tuple[float, int]) -> None:
        place += 1
        while place < len(self.best):
            if value > self.best[place]:
                self.best[place] = value
            place += place & -place

    def upto(self, place: int) -> tuple[float, int]:
        """The largest value at places below ``place``."""
        out = (float("-inf"), -1)
        while place > 0:
            if self.best[place] > out:
                out = self.best[place]
            place -= place & -place
        return out


def diagonals(x: np.ndarray, y: np.ndarray) -> list[tuple[int, int, int]]:
    """Matches of k-mers merged along diagonals: (x, y, words), by x."""
    order = np.lexsort((x, x - y))
    x, y = x[order], y[order]
    first = np.ones(len(x), bool)
    first[1:] = (np.diff(x - y) != 0) | (np.diff(x) > KMER)
    at = np.flatnonzero(first)
    last = np.append(at[1:], len(x)) - 1
    return sorted(zip(x[at].tolist(), y[at].tolist(), (x[last] - x[at] + KMER).tolist()))


def chains(anchors: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """Best chains of anchors that are in order in both texts, each anchor in one."""
    n = len(anchors)
    places = sorted({y + k for _, y, k in anchors} | {y for _, y, _ in anchors})
    rank = {p: i for i, p in enumerate(places)}
    tree, score, back = Fenwick(len(places)), [0.0] * n, [-1] * n
    # ends enter the tree before the starts at or behind them ask it
    events = sorted([(x, 1, i) for i, (x, _, _) in enumerate(anchors)]
                    + [(x + k, 0, i) for i, (x, _, k) in enumerate(anchors)])
    for _, is_start, i in events:
        x, y, k = anchors[i]
        if is_start:
            value, j = tree.upto(rank[y] + 1)  # ends at or before y
            value -= GAP_COST * (x + y)
            score[i], back[i] = (k + value, j) if j >= 0 and value > 0 else (float(k), -1)
        else:
            tree.raise_to(rank[y + k], (score[i] + GAP_COST * (x + k + y + k), i))
    out, used = [], [False] * n
    for i in sorted(range(n), key=lambda i: -score[i]):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(anchors[i])
            i = back[i]
        if chain:
            out.append(chain[::-1])
    return out


def _banded(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Edit distance over alignments that stay ``band`` places around the diagonal."""
    far = len(a) + len(b) + 1
    place = np.arange(2 * band + 1)
    row = np.where(place >= band, place - band, far)  # row 0: as many insertions as columns
    padded = np.concatenate([np.full(band + 1, -1, np.int64), b.astype(np.int64), np.full(band + len(a) + 1, -1, np.int64)])
    for i, w in enumerate(a.tolist(), 1):
        # column j = i - band + place; b[j - 1] lies at j + band of ``padded``
        best = row + (padded[i:i + 2 * band + 1] != w)
        best[:-1] = np.minimum(best[:-1], row[1:] + 1)
        column = place + (i - band)
        best = np.where((column < 0) | (column > len(b)), far, np.where(column == 0, i, best))
        # insertions: a running minimum along the row
        row = np.minimum.accumulate(best - place) + place
    return int(row[len(b) - len(a) + band])


def edits(a: np.ndarray, b: np.ndarray, most: int | None = None) -> int:
    """Edit distance of two word runs, exact up to ``most`` (beyond: more than it).
    Bands double until the distance fits, so time grows with length times distance
    and memory with the band alone."""
    longest = max(len(a), len(b))
    if not min(len(a), len(b)):
        return longest
    band = abs(len(a) - len(b)) + 16
    while band < longest:
        found = _banded(a, b, band)
        if found <= band:
            return found
        if most is not None and band > most:
            return band + 1
        band *= 2
    return _banded(a, b, longest)


def reach(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """How far two runs go on alike, word by word: words and words that differ.
    A word that differs costs one; the end is given up ``GIVE_UP`` below the best."""
    best = now = wrong = at = 0
    out, step, n = (0, 0), REACH, min(len(a), len(b))
    while at < n:
        same = a[at:min(at + step, n)] == b[at:min(at + step, n)]
        score = now + np.cumsum(np.where(same, 1, -1))
        top = np.maximum(np.maximum.accumulate(score), best)
        over = score < top - GIVE_UP
        upto = int(over.argmax()) if over.any() else len(score)
        if upto and int(score[:upto].max()) > best:
            k = int(score[:upto].argmax())
            best = int(score[k])
            out = at + k + 1, wrong + int(k + 1 - same[:k + 1].sum())
        if upto < len(score):
            break
        now, wrong, at, step = int(score[-1]), wrong + int(len(same) - same.sum()), at + step, min(2 * step, 1 << 16)
    return out


def align(chain: list[tuple[int, int, int]], a: np.ndarray, b: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """Aligned stretches (start, stop, owner's start, owner's stop, edits) of a
    chain on the word hashes of the text and its owner."""
    parts: list[list[int]] = []  # x, x end, y, y end, edits, gap before
    for x, y, k in chain:
        xe, ye = x + k, y + k
        if not parts:
            k, wrong = reach(a[max(0, x - y):x][::-1], b[max(0, y - x):y][::-1])
            parts.append([x - k, xe, y - k, ye, wrong, 0])
            continue
        last = parts[-1]
        while last[1] < x and last[3] < y and a[last[1]] == b[last[3]]:
            last[1], last[3] = last[1] + 1, last[3] + 1
        while x > last[1] and y > last[3] and a[x - 1] == b[y - 1]:
            x, y = x - 1, y - 1
        gap = max(x - last[1], y - last[3])
        parts.append([x, xe, y, ye, 0, gap])
    xe, ye = parts[-1][1], parts[-1][3]
    n = min(len(a) - xe, len(b) - ye)
    k, wrong = reach(a[xe:xe + n], b[ye:ye + n])
    parts[-1][1], parts[-1][3] = xe + k, ye + k
    parts[-1][4] += wrong

    def joined(run: list[list[int]]) -> tuple[int, int, int, int, int]:
        wrong = sum(p[4] for p in run)
        # more edits than these make the stretch too unlike, whatever their number
        most = int((1 - MIN_SIMILARITY) * max(run[-1][1] - run[0][0], run[-1][3] - run[0][2])) + 1
        for p, q in zip(run, run[1:]):
            if wrong > most:
                wrong += max(q[0] - p[1], q[2] - p[3])
            else:
                wrong += edits(a[p[1]:q[0]], b[p[3]:q[2]], most)
        return run[0][0], run[-1][1], run[0][2], run[-1][3], wrong

    def similar(s: tuple[int, int, int, int, int]) -> bool:
        longest = max(s[1] - s[0], s[3] - s[2])
        return longest - s[4] >= MIN_SIMILARITY * longest

    whole = joined(parts)
    if similar(whole):
        return [whole]
    cut = [i for i, p in enumerate(parts) if p[5] > LARGE_GAP] + [len(parts)]
    runs = [parts[i:j] for i, j in zip([0] + cut, cut) if j > i]
    return [s for s in map(joined, runs) if similar(s)]


def searched(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``key`` (its class), ``n`` words, ``seed``, ``pos`` arrays, ``short``
    (a byte of each word's hash, with ``CONTEXT`` zeros at both ends)."""
    prepare_python(docs.sparkSession)
    ends = bytes(CONTEXT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, n, hashes, places, short = [], [], [], [], []
            for data in text_bytes(b.column(1)):
                words = word_hashes(data)
                h, at = seeds(words)
                keys.append(class_key(words))
                n.append(len(words))
                hashes.append(h.view(np.int64))
                places.append(at.astype(np.int32))
                short.append(ends + np.maximum(words >> np.uint64(56), 1).astype(np.uint8).tobytes() + ends)
            lengths = [len(h) for h in hashes]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(keys, pa.int64()), pa.array(n, pa.int32()),
                 list_array(np.concatenate(hashes) if keys else np.empty(0, np.int64), lengths, pa.int64()),
                 list_array(np.concatenate(places) if keys else np.empty(0, np.int32), lengths, pa.int32()),
                 pa.array(short, pa.binary())],
                names=["id", "key", "n", "seed", "pos", "short"])

    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col(id_col).isNotNull())
    kind = read.schema["id"].dataType.simpleString()
    return read.mapInArrow(run, f"id {kind}, key long, n int, seed array<long>, pos array<int>, short binary")


def reaches(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``reach`` of the rows of two matrices; all their width where the end isn't
    given up within it. A zero is like nothing."""
    score = np.cumsum(np.where((a == b) & (a != 0), 1, -1), axis=1)
    best = np.maximum(np.maximum.accumulate(score, axis=1), 0)
    over = score < best - GIVE_UP
    at = np.where(over.any(axis=1), over.argmax(axis=1), score.shape[1] - 1)
    rows = np.arange(len(score))
    most = best[rows, at]
    first = np.where(most > 0, (score == most[:, None]).argmax(axis=1) + 1, 0)
    return np.where(over[rows, at], first, score.shape[1]).astype(np.int16)


def extents(matches: DataFrame) -> DataFrame:
    """Matches (``key``, ``owner``, ``x``, ``y``) with the words ``l`` and ``r`` by
    which they may go on to the left and right, from the words ``a``, ``b`` around."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for m in batches:
            if not m.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(m.column(i).to_pylist()), np.uint8).reshape(m.num_rows, -1) for i in (4, 5))
            left = reaches(a[:, :CONTEXT][:, ::-1], b[:, :CONTEXT][:, ::-1])
            right = reaches(a[:, CONTEXT + KMER:], b[:, CONTEXT + KMER:])
            yield pa.RecordBatch.from_arrays([*m.columns[:4], pa.array(left), pa.array(right)],
                                             names=["key", "owner", "x", "y", "l", "r"])

    return matches.select("key", "owner", "x", "y", "a", "b").mapInArrow(
        run, "key long, owner long, x int, y int, l short, r short")


def long_runs(x: np.ndarray, left: np.ndarray, right: np.ndarray, words: int) -> np.ndarray:
    """Which of the matches lie in a run of extents that spans ``RUN_SHARE`` of so many words."""
    first, last = x - left, x + KMER + right
    order = np.argsort(first, kind="stable")
    first, last = first[order], np.maximum.accumulate(last[order])
    cut = np.flatnonzero(first[1:] - last[:-1] > SPARSE) + 1
    start, stop = np.append(0, cut), np.append(cut, len(x)) - 1
    out = np.empty(len(x), bool)
    out[order] = np.repeat(last[stop] - first[start] >= RUN_SHARE * min(words, CONTEXT + KMER), stop - start + 1)
    return out


def chained(matches: DataFrame, min_words: int) -> DataFrame:
    """Chains of the matches of two texts: a row per pair (``key``, ``owner``) with
    the anchors (``xs``, ``ys``, ``ks``) of all its chains and their lengths
    (``sizes``). A text's matches are no more than its seeds; a task streams them
    text by text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def text(rows: list[tuple[np.ndarray, ...]]) -> list[tuple]:
            key, x, owner, y, left, right = (np.concatenate(c) for c in zip(*rows))
            x, y = x.astype(np.int64), y.astype(np.int64)
            keep = long_runs(x, left, right, min_words)
            x, owner, y = x[keep], owner[keep], y[keep]
            out = []
            for other in np.unique(owner):
                mine = owner == other
                found = chains(diagonals(x[mine], y[mine]))
                xs, ys, ks = (list(c) for c in zip(*(a for c in found for a in c)))
                out.append((int(key[0]), int(other), xs, ys, ks, [len(c) for c in found]))
            return out

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            ints = pa.list_(pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), ints, ints, ints, ints))],
                names=["key", "owner", "xs", "ys", "ks", "sizes"])

        for b in batches:
            key, x, owner, y, left, right = (c.to_numpy(zero_copy_only=False) for c in b.columns)
            if not len(key):
                continue
            cut = np.flatnonzero(np.diff(key) != 0) + 1
            rows = []
            for s, e in zip(np.append(0, cut), np.append(cut, len(key))):
                if held and held[0][0][0] != key[s]:
                    rows += text(held)
                    held = []
                held.append((key[s:e], x[s:e], owner[s:e], y[s:e], left[s:e], right[s:e]))
            if rows:
                yield batch(rows)
        if held and (rows := text(held)):
            yield batch(rows)

    columns = ["key", "x", "owner", "y", "l", "r"]
    ordered = matches.select(*columns).repartition("key").sortWithinPartitions(*columns[:4])
    return ordered.mapInArrow(run, "key long, owner long, xs array<int>, ys array<int>, ks array<int>, sizes array<int>")


def word_table(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``key``, ``words`` (32-bit word hashes) of the texts of the wanted ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [word_hashes(data) for data in text_bytes(b.column(0))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([class_key(w) for w in found], pa.int64()),
                 pa.array([(w >> np.uint64(32)).astype(np.uint32).tobytes() for w in found], pa.binary())],
                names=["key", "words"])

    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(wanted, "id", "left_semi")
    return read.select("text").mapInArrow(run, "key long, words binary")


def aligned(found: DataFrame, texts: DataFrame, part: Column | None = None) -> DataFrame:
    """The chains' aligned stretches of at least ``PART_WORDS`` words; of the keys
    for which ``part`` holds."""
    if part is not None:
        found = found.where(part)
    own = (texts if part is None else texts.where(part)).select("key", F.col("words").alias("a"))
    other = texts.select(F.col("key").alias("owner"), F.col("words").alias("b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "owner", "x", "xe", "y", "ye", "wrong"]
        for batch in batches:
            out = []
            for key, owner, xs, ys, ks, sizes, a, b in zip(*(c.to_pylist() for c in batch.columns)):
                a, b, anchors = np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32), iter(zip(xs, ys, ks))
                for size in sizes:
                    out += [(key, owner, *s) for s in align(list(islice(anchors, size)), a, b) if s[1] - s[0] >= PART_WORDS]
            if out:
                types = [pa.int64(), pa.int64(), *[pa.int32()] * 5]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    joined = found.join(own, "key").join(other, "owner").select(
        "key", "owner", "xs", "ys", "ks", "sizes", "a", "b")
    return joined.mapInArrow(run, "key long, owner long, x int, xe int, y int, ye int, wrong int")


def joined_spans(parts: DataFrame, min_words: int) -> DataFrame:
    """Touching stretches of a text as one span each; its owner is that of the
    longest stretch. ``matched`` counts the words that align over the span."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "owner", "x", "xe", "y", "ye", "matched"]
        types = [pa.int64(), pa.int64(), *[pa.int32()] * 5]
        now: list | None = None

        def close(span: list) -> list[tuple]:
            key, x, xe, _, (owner, px, pxe, y, ye), wrong = span
            return [(key, owner, x, xe, y, ye, xe - x - min(wrong, xe - x))] if xe - x >= min_words else []

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for b in batches:
            out = []
            for key, owner, x, xe, y, ye, wrong in zip(*(c.to_pylist() for c in b.columns)):
                part = (owner, x, xe, y, ye)
                if now and now[0] == key and x <= now[2] + TOUCH:
                    gap = max(0, x - now[2])
                    if xe > now[2]:
                        # words of an overlap keep the edits of the stretch before
                        share = (xe - max(x, now[2])) / max(1, xe - x)
                        now[5] += gap + round(wrong * share)
                        now[2] = xe
                    if xe - x > now[3]:
                        now[3], now[4] = xe - x, part
                else:
                    if now:
                        out += close(now)
                    now = [key, x, xe, xe - x, part, wrong]
            if out:
                yield batch(out)
        if now and (out := close(now)):
            yield batch(out)

    ordered = parts.repartition("key").sortWithinPartitions("key", "x", "xe", "owner", "y")
    return ordered.mapInArrow(run, "key long, owner long, x int, xe int, y int, ye int, matched int")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      min_words: int = MIN_WORDS) -> DataFrame:
    """One row per repeated passage: ``doc_id``, ``owner_id`` (the document that
    has it too), word ranges ``start``/``stop`` and ``owner_start``/``owner_stop``,
    ``n_words`` and ``similarity``; a whole-text copy has its class's smallest
    id as owner and its whole text as passage.

    A passage is reported for every text but its owner, the one of least hash.
    Null and short texts have none; rows of a null id are left out; rows that
    repeat an id are searched each, and an exact repeat of a row isn't reported.
    Other columns are ignored.
    """
    # tables with a row for each seed, word or document are deleted once what is
    # derived from them is written: the disk holds those of one step, not of all
    drawn = written(searched(docs, id_col, text_col), "seeds")
    members = written(drawn.where(F.col("n") >= KMER).select("id", "key", "n"), "members")
    classes = written(members.groupBy("key").agg(F.min("id").alias("id"), F.first("n").alias("n"),
                                                 F.count(F.lit(1)).alias("rows")), "classes")
    # a class's seeds once: those of the rows with its smallest id (a row that is
    # there twice has the same seeds twice, which changes nothing)
    copies = members.join(classes.where("rows > 1").select("key", F.col("id").alias("least")), "key")
    copies = few(written(copies.where("id != least").select("key", "id").distinct(), "copies"))
    once = drawn.where(F.col("n") >= KMER).join(copies, ["key", "id"], "left_anti")
    spread = once.select("key", F.explode(F.arrays_zip("seed", "pos")).alias("s")).select("key", "s.seed", "s.pos")
    owners = written(spread.groupBy("seed").agg(F.min("key").alias("owner"), F.max("key").alias("top"),
                                                F.count(F.lit(1)).alias("rows"))
                           .where("owner != top").select("seed", "owner", F.ceil(F.col("rows") / HOT).cast("int").alias("parts")), "owners")
    shared = written(spread.join(owners, "seed"), "shared")  # occurrences of seeds that two texts have
    drop_tables(owners)
    around = F.expr(f"substring(short, pos + 1, {2 * CONTEXT + KMER})")
    contexts = written(shared.join(once.select("key", "short"), "key").select("key", "seed", "pos", "owner", "parts", around.alias("a")),
                       "contexts")
    drop_tables(shared, drawn)
    # a seed that very many texts have is joined in parts, dealt by the text
    places = contexts.where("key = owner").groupBy("seed", "parts").agg(F.min(F.struct("pos", "a")).alias("o"))
    places = places.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    dealt = contexts.where("key != owner").withColumn("part", F.pmod(F.xxhash64("key", "pos"), F.col("parts")).cast("int"))
    matches = dealt.join(places, ["seed", "part"]).select(
        "key", "owner", F.col("pos").alias("x"), F.col("o.pos").alias("y"), "a", F.col("o.a").alias("b"))
    found = written(chained(extents(matches), min_words), "chains")
    drop_tables(contexts)
    wanted = found.select("key").union(found.select(F.col("owner").alias("key"))).distinct()
    ids = few(written(wanted.join(classes.select("key", "id"), "key").select("id").distinct(), "wanted"))
    texts = word_table(docs, ids, id_col, text_col).join(wanted, "key", "left_semi")
    texts = written(texts.dropDuplicates(["key"]), "words")
    # a pair carries the words of both texts through a shuffle, so those of all pairs at
    # once are the most that this operator would hold on disk; a text's pairs are one part's
    parts = min(ALIGN_PARTS, 1 + found.count() // ALIGN_PAIRS)
    part = F.pmod(F.xxhash64("key"), F.lit(parts))
    spans = reduce(DataFrame.unionByName, [
        written(joined_spans(aligned(found, texts, part == i), min_words), "spans") for i in range(parts)])
    drop_tables(found, texts)
    name = classes.select("key", "id")
    near = (spans.join(name, "key").withColumnRenamed("id", "doc_id").drop("key")
                 .join(name.select(F.col("key").alias("owner"), F.col("id").alias("owner_id")), "owner")
                 .select("doc_id", "owner_id", F.col("x").alias("start"), F.col("xe").alias("stop"),
                         F.col("y").alias("owner_start"), F.col("ye").alias("owner_stop"),
                         (F.col("xe") - F.col("x")).alias("n_words"),
                         F.round(F.col("matched") / (F.col("xe") - F.col("x")), 6).alias("similarity")))
    copied = members.where(F.col("n") >= min_words).join(
        classes.where("rows > 1").select("key", F.col("id").alias("owner_id")), "key").where("id != owner_id")
    zero = F.lit(0)
    exact = copied.select(F.col("id").alias("doc_id"), "owner_id", zero.alias("start"), F.col("n").alias("stop"),
                          zero.alias("owner_start"), F.col("n").alias("owner_stop"), F.col("n").alias("n_words"),
                          F.lit(1.0).alias("similarity")).distinct()
    return near.unionByName(exact).withColumnsRenamed({"doc_id": id_col} if id_col != "doc_id" else {})


def cut_passages(docs: DataFrame, passages: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the passages' words, and the white space after them, cut out."""
    prepare_python(docs.sparkSession)
    key, held = fresh(docs, "_id"), fresh(docs, "_spans")
    spans = passages.groupBy(F.col(id_col).alias(key)).agg(
        F.sort_array(F.collect_set(F.struct("start", "stop"))).alias(held))  # passages of one document
    given = docs.join(spans, docs[id_col] == spans[key], "left").drop(key)
    names, at = docs.columns, docs.columns.index(text_col)

    def cut(text: str, spans: list[dict]) -> str:
        words = [m.span() for m in WORD.finditer(text)]
        out, since = [], 0
        for s in spans:
            if s["start"] < len(words):
                a = words[s["start"]][0]
                z = words[s["stop"]][0] if s["stop"] < len(words) else len(text)
                if z > since:
                    out.append(text[since:max(a, since)])
                    since = z
        return "".join(out) + text[since:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t if not s or t is None else cut(t, s)
                     for t, s in zip(b.column(at).to_pylist(), b.column(len(names)).to_pylist())]
            columns = [pa.array(texts, pa.string()) if i == at else b.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return given.select(*names, held).mapInArrow(run, docs.schema)
