"""Token ids as Parquet list columns (operator 2).

File format: one Parquet table of the columns ``part`` int, ``doc_id``, ``copy``
int (a repeated row's number), ``local_start`` long, ``n_tokens`` int, ``ids`` array<int>, in ascending doc_id
order over the files, and beside it an index table with one row per part
(first and last id, documents, tokens, and ``part_start``, the ids before it).
The numbers before the list are delta-encoded (version 2 data pages), the ids
are dictionary-encoded as long as a row group's dictionary pays, row groups are
kept small and every page has an entry in the page index, so a reader of some
documents fetches only their pages and a reader of lengths fetches no ids.

Encoding is that of the tokenizers library. Byte-level BPE first cuts a text
into pre-tokens and merges within each alone. A blank or line break after a
character that isn't white space always starts a pre-token, so the texts are
cut there, each distinct piece is encoded once per worker and the pieces' ids
are strung together. A piece of Latin letters or of digits is one pre-token,
which the library's model merges directly; other pieces pass its pre-tokenizer
too, many at once. Texts with other white space or special strings go to the
library whole.
"""

from __future__ import annotations

import os
import string
import zlib
from array import array
from collections.abc import Iterator
from itertools import accumulate, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readyspark.llm.common import kept, list_array, shared_path, prepare_python, tidy

CACHE_WORDS = 700_000  # pieces whose ids a worker remembers
MARKS = ".,;:!?#$%&*|"
ALNUM = frozenset(string.ascii_letters + string.digits + "ßàáâäæçèéêëìíîïñòóôöùúûüœ")
LATIN = "\u024f"  # letters up to here are letters to the library and to Python alike
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
# byte-level alphabet: plain bytes stand for themselves, others for U+0100 and up
BYTE_SIGNS = {b: chr(256 + k) for k, b in enumerate(sorted(set(range(256)) - set(_PLAIN)))}
LEARN_CHARS = 400_000  # of the texts whose new pieces are learned together
EMIT_IDS = 1_000_000   # ids of one Arrow batch on the way to the writer

WRITER = {
    "parquet.block.size": str(16 << 20),         # row groups: what a selective reader skips
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",      # finer page index for the short columns
    "parquet.writer.version": "v2",              # delta encoding where no dictionary pays
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#copy": "false",
    "parquet.enable.dictionary#local_start": "false",
    "parquet.enable.dictionary#n_tokens": "false",
    "parquet.dictionary.page.size": str(1 << 20),
    "compression": "zstd",
}


def _one_word(piece: str) -> bool:
    """Whether a piece is one word, after its line break if it has one: not empty,
    no break alone, no other white space."""
    return bool(piece) and piece.split() == [piece[1:] if piece[0] == "\n" else piece]


class KnownPieces(dict):
    """Ids of pieces. A new piece of Latin letters or of digits, with marks after it or
    none, is encoded when it is asked for; others are noted in ``asked``, without ids yet."""

    def __init__(self, encoder: "ByteLevelEncoder", held=()):
        super().__init__(held)
        self.encoder, self.asked = encoder, []

    def __missing__(self, piece: str) -> bytes | None:
        stem = piece.rstrip(MARKS)
        word = stem[1:] if stem[:1] in ("\0", "\n") else stem
        if not (word.isalpha() and (word.isascii() or max(word) <= LATIN) or word.isascii() and word.isdigit()):
            self.asked.append(piece)
            return None
        if (ids := self.get(stem)) is None:
            ids = self[stem] = self.encoder.pre_token(word, word is stem)
            if stem[0] == "\n":
                ids = self[stem] = self.encoder.marks_ids("\n") + ids
        if stem != piece:
            ids = self[piece] = ids + self.encoder.marks_ids(piece[len(stem):])
        return ids


class ByteLevelEncoder:
    """Little-endian 32-bit ids of whole texts, as the library encodes them."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        import json

        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec["added_tokens"]]
        # a special string between pieces parts them in the library; its id parts their ids again
        plain = [t for t in spec["added_tokens"] if not (t["lstrip"] or t["rstrip"] or t["single_word"])]
        self.part, self.part_id = (plain[0]["content"], plain[0]["id"]) if plain else ("", -1)
        pre = spec["pre_tokenizer"] or {}
        self.cuts = bool(plain) and (pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
                                     and spec["normalizer"] is None and spec["post_processor"] is None)
        self.known = KnownPieces(self)
        self.marks: dict[str, bytes] = {}
        self.merge = self.model.model.tokenize

    def whole(self, texts: list[str]) -> list[bytes]:
        done = self.model.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in done]

    def pre_token(self, word: str, after_blank: bool) -> bytes:
        """The ids of a word that is one pre-token: the model alone merges its bytes."""
        signs = word if word.isascii() else word.encode().decode("latin-1").translate(BYTE_SIGNS)
        return array("I", [t.id for t in self.merge(BYTE_SIGNS[32] + signs if after_blank else signs)]).tobytes()

    def marks_ids(self, marks: str) -> bytes:
        """The ids of marks, or of a line break, which pre-tokens around them can't join."""
        if marks not in self.marks:
            self.marks[marks] = self.whole([marks])[0]
        return self.marks[marks]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; new pieces of a batch of texts are learned at once."""
        if len(self.known) > CACHE_WORDS:
            # what was met first is what is met often
            self.known = KnownPieces(self, islice(self.known.items(), CACHE_WORDS // 2))
            self.marks = {} if len(self.marks) > CACHE_WORDS else self.marks
        out, gaps, known, asked, new = [], [], self.known.__getitem__, self.known.asked, set()
        for n, text in enumerate(texts):
            pieces = self._pieces(text)
            ids = list(map(known, pieces)) if pieces else None
            if asked:
                asked.clear()
                at = [k for k, i in enumerate(ids) if i is None]
                missing = [pieces[k] for k in at]
                if all(map(_one_word, missing)):
                    new.update(missing)
                    gaps.append((n, at, missing))
                else:
                    ids = None
            out.append(ids)
        self._learn(new)
        for n, at, missing in gaps:
            for k, piece in zip(at, missing):
                out[n][k] = self.known[piece]
        rest = [n for n, ids in enumerate(out) if ids is None]
        whole = dict(zip(rest, self.whole([texts[n] for n in rest])))
        return [whole[n] if ids is None else b"".join(ids) for n, ids in enumerate(out)]

    def _parted(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece, from few library calls."""
        out = []
        for a in range(0, len(pieces), 1000):
            text = self.part.join(pieces[a:a + 1000])
            ids = np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
            raw, start = ids.tobytes(), 0
            for cut in [*(4 * np.flatnonzero(ids == self.part_id)).tolist(), len(raw)]:
                out.append(raw[start:cut])
                start = cut + 4
        return out

    def _learn(self, new: set[str]) -> None:
        """Encode pieces. A pre-token of letters or digits ends at a mark, so a
        piece that ends in marks is its stem and its marks; stems recur."""
        stems = {}
        for p in new:
            stem = p.rstrip(MARKS)
            if stem is not p and stem and (stem[-1] in ALNUM):
                stems[p] = stem
        first = [p for p in (new - stems.keys()) | set(stems.values()) if p not in self.known]
        marks = list({p[len(s):] for p, s in stems.items()}.difference(self.marks))
        if not first and not marks:
            return
        # a piece stands for itself and the blank before it, but for the first
        # of a text and those that begin with their line break
        ids = self._parted([p[1:] if p[0] == "\0" else p if p[0] == "\n" else " " + p for p in first] + marks)
        self.known.update(zip(first, ids))
        self.marks.update(zip(marks, ids[len(first):]))
        known, ends = self.known, self.marks
        for p, s in stems.items():
            known[p] = known[s] + ends[p[len(s):]]

    def _pieces(self, text: str) -> list[str] | None:
        """The text cut before blanks and line breaks, the first piece marked
        with a zero; None where cutting isn't proven safe."""
        if not self.cuts or not text or "\0" in text or any(s in text for s in self.special):
            return None
        return ("\0" + text.replace("\n", " \n")).split(" ")


OPERATOR = "token store"


def encoder(path: str) -> ByteLevelEncoder:
    encoders = kept(OPERATOR)
    if path not in encoders:
        encoders[path] = ByteLevelEncoder(path)
    return encoders[path]


def write_store(docs: DataFrame, tokenizer_path: str, path: str | None = None, id_col: str = "doc_id",
                text_col: str = "text", end_id: int = 0) -> str:
    """Write the token store of ``docs``; returns its folder (``tokens``, ``index``).

    Null and empty texts hold the end id alone. Null ids come first. Repeated
    rows are kept, next to each other and numbered by ``copy``; rows of one id are
    ordered by text. Other columns are ignored, whatever their names. Texts are
    range-partitioned by id once, before encoding (text is smaller than ids); a
    task streams its partition, so memory is bounded by a batch.
    """
    spark = docs.sparkSession
    prepare_python(spark)
    path = path or shared_path(spark, "tokens")
    read = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    # by id alone: the sample of keys that sets the ranges passes through the driver
    ordered = read.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start, enc = TaskContext.get().partitionId(), 0, encoder(tokenizer_path)
        end = np.array([end_id], dtype="<u4").tobytes()

        def encoded(texts: list[str]) -> Iterator[bytes]:
            """Ids of the texts, some at once, so that their new pieces are learned together."""
            at = 0
            while at < len(texts):
                size, upto = 0, at
                while upto < len(texts) and (upto == at or size + len(texts[upto]) <= LEARN_CHARS):
                    size, upto = size + len(texts[upto]), upto + 1
                yield from enc.encode_all(texts[at:upto])
                at = upto

        def batch(b: pa.RecordBatch, rows: list[bytes], copies: list[int]) -> pa.RecordBatch:
            nonlocal start
            lengths = [len(r) // 4 for r in rows]
            starts = list(accumulate(lengths, initial=start))
            start = starts.pop()
            ids = np.frombuffer(b"".join(rows), "<u4").astype(np.int32)
            return pa.RecordBatch.from_arrays(
                [pa.array([part] * len(rows), pa.int32()), b.column(0), pa.array(copies, pa.int32()),
                 pa.array(starts, pa.int64()), pa.array(lengths, pa.int32()), list_array(ids, lengths, pa.int32())],
                names=["part", "doc_id", "copy", "local_start", "n_tokens", "ids"])

        before, copy = None, 0
        for b in batches:
            rows, copies, held, since = [], [], 0, 0
            texts = b.column(1).to_pylist()
            for key, text, ids in zip(b.column(0).to_pylist(), texts, encoded(texts)):
                copy = copy + 1 if (key, text) == before else 1
                before = key, text
                rows.append(ids + end)
                copies.append(copy)
                held += len(ids) // 4 + 1
                if held >= EMIT_IDS:
                    yield batch(b.slice(since, len(rows)), rows, copies)
                    since, rows, copies, held = since + len(rows), [], [], 0
            if rows:
                yield batch(b.slice(since, len(rows)), rows, copies)

    kind = read.schema["doc_id"].dataType.simpleString()
    schema = f"part int, doc_id {kind}, copy int, local_start long, n_tokens int, ids array<int>"
    ordered.mapInArrow(tidy(encode, OPERATOR), schema).write.options(**WRITER).parquet(f"{path}/tokens")
    # lengths only: no page of ids is read. One row per part, so the window's
    # single task holds as many rows as the store has files
    parts = (spark.read.parquet(f"{path}/tokens").groupBy("part")
                  .agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"),
                       F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("n_tokens")))
    starts, rows = 0, []
    for r in sorted(parts.collect(), key=lambda r: r["part"]):
        rows.append((*r, starts))
        starts += r["n_tokens"]
    index = spark.createDataFrame(rows, f"part int, first_id {kind}, last_id {kind}, "
                                        "n_docs long, n_tokens long, part_start long")
    index.coalesce(1).write.parquet(f"{path}/index")
    return path


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """The store's rows with ``start``, the number of ids before each document.
    The index has one row per file, so it is small enough to broadcast."""
    tokens, index = spark.read.parquet(f"{path}/tokens"), spark.read.parquet(f"{path}/index")
    at = index.select("part", "part_start")
    joined = tokens.join(F.broadcast(at), "part")
    return joined.withColumn("start", F.col("part_start") + F.col("local_start")).drop("part_start", "local_start")


def digest(stored: DataFrame) -> DataFrame:
    """``doc_id``, ``copy``, ``start``, ``n_tokens`` and the crc32 of each row's ids."""
    prepare_python(stored.sparkSession)
    read = stored.select("doc_id", "copy", "start", "ids")

    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(3)
            offsets = ids.offsets.to_numpy()
            values = ids.values.to_numpy(zero_copy_only=False).astype("<u4")
            sums = [zlib.crc32(values[a:z]) for a, z in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(np.diff(offsets), pa.int64()), pa.array(sums, pa.int64())],
                                             names=["doc_id", "copy", "start", "n_tokens", "ids_crc32"])

    kind = read.schema["doc_id"].dataType.simpleString()
    return read.mapInArrow(tidy(crc, OPERATOR), f"doc_id {kind}, copy int, start long, n_tokens long, ids_crc32 long")
