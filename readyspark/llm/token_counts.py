"""Token counts by the whole-token shortcut (operator 8).

A sentencepiece BPE model merges characters only into pieces of its vocabulary.
Where no piece holds a given pair of neighbouring characters, no merge ever
crosses that pair, so the text may be cut there and its token count is the sum
over the parts. Two kinds of cut are proven against the vocabulary: before a
run of blanks, and on both sides of a line break. The parts are pre-tokens:
blanks and the word after them.

Offline, each vocabulary piece that is a blank and a word is encoded alone;
those that come back as themselves are whole tokens. Counting looks each
pre-token up among them (one token) and gives only the rest to the library,
each distinct one once per worker.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readyspark.llm.common import prepare_python, strings

BLANK = "▁"  # how the model writes a blank
CACHE_WORDS = 400_000  # counts of other pre-tokens that a worker remembers
PRETOKENS = re.compile(r" *[^ \n]+| +|\n")


def provable(model: sentencepiece.SentencePieceProcessor) -> bool:
    """Whether the cuts before blanks and around line breaks can't split a merge."""
    # byte, control and unknown pieces are never merged from characters
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())
              if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    crossing = re.compile(f"[^{BLANK}]{BLANK}|\n| ")
    identity = model.encode(f"a  b{BLANK}c\n d ", out_type=str)
    return (not any(crossing.search(p) for p in pieces)
            and "".join(identity).replace("<0x0A>", "\n") == f"{BLANK}a{BLANK}{BLANK}b{BLANK}c\n{BLANK}d{BLANK}"
            and model.encode("\n", out_type=str) == [BLANK, "<0x0A>"])


def whole_tokens(model: sentencepiece.SentencePieceProcessor) -> dict[str, int]:
    """Pre-tokens (a blank and a word) that the model encodes as one token."""
    words = [model.id_to_piece(i)[1:] for i in range(model.get_piece_size())
             if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))
             and model.id_to_piece(i).startswith(BLANK)]
    words = [w for w in words if w and BLANK not in w]
    found = {" " + w: 1 for w, ids in zip(words, model.encode(words, num_threads=1)) if len(ids) == 1}
    return {" ": 1, **found}  # a lone blank, as ``provable`` has seen before a line break


class PieceCounter:
    """Counts the tokens of whole texts exactly as the library's ``encode``."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.whole = whole_tokens(self.model) if provable(self.model) else None
        self.known = dict(self.whole or {})
        self.line_start = len(self.model.encode("\n"))

    def _merge(self, parts: list[str]) -> None:
        # the library puts one blank before a text: drop it from parts that have
        # one, and put a line break between it and parts that have none
        texts = [p[1:] if p[0] == " " else "\n" + p for p in parts]
        for part, ids in zip(parts, self.model.encode(texts, num_threads=1)):
            self.known[part] = len(ids) - (0 if part[0] == " " else self.line_start)

    def count(self, texts: list[str]) -> list[int]:
        if self.whole is None:
            return [len(ids) for ids in self.model.encode(texts, num_threads=1)]
        out = []
        for text in texts:
            if not text:
                out.append(0)
                continue
            parts = PRETOKENS.findall(" " + text.replace(BLANK, " "))
            rest = [p for p in set(parts) if p not in self.known]
            if rest:
                if len(self.known) + len(rest) > len(self.whole) + CACHE_WORDS:
                    self.known = dict(self.whole)
                    rest = [p for p in set(parts) if p not in self.known]
                self._merge(rest)
            out.append(sum(map(self.known.__getitem__, parts)))
        return out


_COUNTERS: dict[str, PieceCounter] = {}


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 4096) -> DataFrame:
    """One row per document: id, ``n_bytes``, ``n_tokens``, ``over_limit``.

    Null and empty texts have no bytes and no tokens; repeated rows and null ids
    are returned as they come; other columns are ignored, whatever their names.
    No shuffle: a map over the scan that reads two columns.
    """
    prepare_python(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model_path not in _COUNTERS:
            _COUNTERS[model_path] = PieceCounter(model_path)
        counter = _COUNTERS[model_path]
        for b in batches:
            n = pa.array(counter.count(strings(b.column(2))), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), n], names=["id", "n_bytes", "n_tokens"])

    read = docs.select(F.col(id_col).alias("id"),
                       F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
                       F.col(text_col).alias("text"))
    kind = read.schema["id"].dataType.simpleString()
    counted = read.mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens",
                          (F.col("n_tokens") > limit).alias("over_limit"))
