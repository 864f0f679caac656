"""What Python workers keep between the tasks of a run."""

import gc
import re
import sys
import weakref
from pathlib import Path

import public_tokenizers as P
import pyarrow as pa
import pytest

from readyspark.llm import common, near_dup, token_store, toxicity

BYTES = P.path("byte_bpe_50k.json")


def handed_over(monkeypatch, df, build):
    """The functions that ``build`` gives to mapInArrow."""
    functions, real = [], type(df).mapInArrow
    with monkeypatch.context() as m:
        m.setattr(type(df), "mapInArrow", lambda self, f, *a, **k: functions.append(f) or real(self, f, *a, **k))
        build(df)
    return functions


def test_a_worker_keeps_the_memory_of_one_operator(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "some words of a text")], "doc_id long, text string")
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["some words of a text"])], names=["id", "text"])
    stored = spark.createDataFrame([(1, 1, 0, [5, 0])], "doc_id long, copy int, start long, ids array<int>")
    ids = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([1]), pa.array([0]), pa.array([[5, 0]], pa.list_(pa.int32()))],
                                     names=["doc_id", "copy", "start", "ids"])
    sketch = handed_over(monkeypatch, docs, lambda d: near_dup.sketch(d, "doc_id", "text", 5))
    score = handed_over(monkeypatch, docs, lambda d: toxicity.score(d, {toxicity.BIAS: -3.0}))
    digest = handed_over(monkeypatch, stored, token_store.digest)
    for others in (sketch, score):
        assert len(others) == len(digest) == 1
        held = weakref.ref(token_store.encoder(BYTES))
        gc.disable()  # whose turn may be long in coming
        try:
            assert len(list(digest[0](iter([ids])))) == 1
            assert held() is token_store.encoder(BYTES)
            assert len(list(others[0](iter([batch])))) == 1
            assert held() is None
        finally:
            gc.enable()


def resident_mb():
    return int(re.search(r"VmRSS:\s+(\d+)", Path("/proc/self/status").read_text())[1]) / 1024


@pytest.mark.skipif(sys.platform != "linux", reason="reads /proc")
def test_freed_memory_goes_back_to_the_system():
    pins = []

    def run(batches):
        for b in batches:
            texts = [bytes(1000) for _ in range(200_000)]
            pins.append(texts[1::1000])  # few that stay, among the many that go
            yield b

    batch = pa.RecordBatch.from_arrays([pa.array([1])], names=["id"])
    before = resident_mb()
    assert list(common.tidy(run)(iter([batch]))) == [batch]
    assert resident_mb() - before < 60
