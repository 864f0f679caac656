"""Token counts (8) and the token store (2) against the libraries themselves."""

import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from readyspark.llm import token_counts, token_store

PIECES, BYTES = P.path("piece_bpe_32k.model"), P.path("byte_bpe_50k.json")
BITS = ["the", " ", "  ", "\n", "\n\n", "\t", "a", "ñandú", "ß", "don't", "'s", "'", ".", ",", "!!", "###", "123", "▁", "</s>",
        "<s>", "<|endoftext|>", " ", " ", "\x1c", "\x00", "漢字", "🙂", "é", "Hello", "world", "|", "\r\n"]


def random_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(BITS) for _ in range(rng.randrange(0, 40))) for _ in range(n)] + [
        " ".join(rng.choice(BITS) for _ in range(rng.randrange(1, 60))) for _ in range(n)] + ["", " ", "\n", "a" * 5000]


def test_piece_counts_equal_the_library():
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    counter = token_counts.PieceCounter(PIECES)
    assert counter.whole and len(counter.whole) > 10_000
    texts = random_texts(1500, 1)
    assert counter.count(texts) == [len(x) for x in model.encode(texts)]


def test_piece_counts_survive_a_full_memory(monkeypatch):
    monkeypatch.setattr(token_counts, "CACHE_WORDS", 20)
    texts = random_texts(200, 2)
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert token_counts.PieceCounter(PIECES).count(texts) == [len(x) for x in model.encode(texts)]


@pytest.mark.parametrize("memory", [500_000, 20])
def test_byte_ids_equal_the_library(monkeypatch, memory):
    monkeypatch.setattr(token_store, "CACHE_WORDS", memory)
    model, own = Tokenizer.from_file(BYTES), token_store.ByteLevelEncoder(BYTES)
    assert own.cuts
    for text in random_texts(1000, 3):
        assert np.frombuffer(own.encode(text) if text else b"", "<u4").tolist() == model.encode(
            text, add_special_tokens=False).ids, text


def test_new_words_are_merged_without_the_pre_tokenizer(monkeypatch):
    words = ["thingea", "cióncogarr,", "ERANOU,!!", "4711.", "Ÿčßeux", "x|"]
    texts = [" ".join(words[k:] + words[:k]) + "\n" + "\n".join(words) for k in range(len(words))] + ["", " a", "a  b\n\nc", "º² \u0250a"]
    model, own, learned = Tokenizer.from_file(BYTES), token_store.ByteLevelEncoder(BYTES), []
    learn = own._learn
    monkeypatch.setattr(own, "_learn", lambda new: learned.extend(new) or learn(new))
    want = [np.array(model.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert own.encode_all(texts) == want == own.encode_all(texts)
    assert not {p.lstrip("\0\n") for p in learned} & set(words)


ROWS = [(5, "five five\nlines"), (1, "one"), (None, "null id"), (3, None), (4, ""), (5, "five five\nlines"), (2, "x " * 30_000)]


def docs(spark, rows=ROWS):
    return spark.createDataFrame([(i, t, "src", 7, "part") for i, t in rows],
                                 "doc_id long, text string, source string, ids int, part string")


def test_counts_of_odd_rows(spark):
    got = sorted(map(tuple, token_counts.count_tokens(docs(spark), PIECES).collect()), key=str)
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = [(i, len((t or "").encode()), n := len(model.encode(t or "")), n > 4096) for i, t in ROWS]
    assert got == sorted(want, key=str)
    assert token_counts.count_tokens(docs(spark, []), PIECES).count() == 0


def test_store_round_trip(spark):
    path = token_store.write_store(docs(spark), BYTES)
    rows = token_store.digest(token_store.read_store(spark, path)).collect()
    model = Tokenizer.from_file(BYTES)
    at, want = 0, []
    for i, t in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = model.encode(t or "", add_special_tokens=False).ids + [0]
        copy = 2 if want and want[-1][0] == i == 5 else 1
        want.append((i, copy, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, rows), key=lambda r: r[2]) == want
    index = spark.read.parquet(f"{path}/index").collect()
    assert sum(r["n_tokens"] for r in index) == at and sum(r["n_docs"] for r in index) == len(ROWS)


def test_store_of_no_rows(spark):
    path = token_store.write_store(docs(spark, []), BYTES)
    assert token_store.digest(token_store.read_store(spark, path)).count() == 0


def test_store_reads_selectively(spark):
    path = token_store.write_store(docs(spark), BYTES)
    plan = token_store.read_store(spark, path).where("doc_id = 5").select("doc_id", "n_tokens")
    text = plan._jdf.queryExecution().toString()
    assert "EqualTo(doc_id,5)" in text and "ids:array" not in text
    import pyarrow.parquet as pq
    from glob import glob
    meta = pq.ParquetFile(glob(f"{path.removeprefix('file:')}/tokens/*.parquet")[0]).metadata.row_group(0)
    names = [meta.column(i).path_in_schema for i in range(meta.num_columns)]
    encodings = {n: meta.column(i).encodings for i, n in enumerate(names)}
    assert "DELTA_BINARY_PACKED" in encodings["local_start"]
    assert any("DICTIONARY" in e for e in encodings["ids.list.element"])
    assert all(meta.column(i).has_offset_index for i in range(meta.num_columns))
