"""Helper names as extra columns, and odd rows through the whole pipeline."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from readyspark.llm import (decontaminate, html_extract, line_quality, mixing, near_dup, passages, token_counts, token_store, toxicity)
from tests.llm.test_tokens import BYTES, PIECES

NAMES = """id key n words seed pos short owner x y a b l r xs ys ks sizes _id _spans _null _row _rows _doc _src _key _times _draws _cdf src
 copy mix_key rate share score offending predicted n_shingles component_id kept cleaned label weight word part local_start start stop k1 k2
 sig low node size tree level used html _html h1 h2 shard visits given""".split()
WORDS = " ".join(f"w{i}" for i in range(70))


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1, WORDS, "s"), (2, WORDS + " more", "t"), (3, None, None), (4, "", "s"), (None, WORDS, "s"), (None, None, None), (1, WORDS, "s"),
            (5, "five words are here now", "t"), (5, "five words are here then", "t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return df.select("*", *[F.lit(7).alias(c) for c in NAMES], F.create_map(F.lit("a"), F.lit(1)).alias("m"))


def test_operators_ignore_other_columns(spark, odd):
    plain = odd.select("doc_id", "text", "source")
    bench = spark.createDataFrame([(1, "w3 w4 w5 w6 w7 w8 w9 w10 w11 w12")], "item_id long, text string")
    model = {toxicity.BIAS: -3.0, "w1": 9.0}
    runs = {
        "toxicity": lambda d: toxicity.score(d, model).select("doc_id", "score"),
        "near": near_dup.similar_groups,
        "passages": passages.repeated_passages,
        "leaks": lambda d: decontaminate.digest(decontaminate.contamination(d, bench)),
        "lines": line_quality.judge,
        "counts": lambda d: token_counts.count_tokens(d, PIECES),
        "mix": lambda d: mixing.mix(d).select("doc_id", "text", "copy", "mix_key"),
        "store": lambda d: token_store.digest(token_store.read_store(spark, token_store.write_store(d, BYTES))),
    }
    for name, run in runs.items():
        a, b = run(plain), run(odd)
        assert a.columns == b.columns, name
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())), name


def test_rows_keep_their_other_columns(spark, odd):
    for name, out in {
        "one": near_dup.keep_one(odd), "clean": toxicity.drop_toxic(odd, spark.createDataFrame([(1, 0)], "doc_id long, toxic int")),
        "cut": passages.cut_passages(odd, passages.repeated_passages(odd)),
        "mixed": mixing.mix(odd).select(*odd.columns),
    }.items():
        assert out.columns == odd.columns, name
        rest = [c for c in NAMES if c not in ("copy", "mix_key")] if name == "mixed" else NAMES
        assert out.count() and out.where(" OR ".join(f"`{c}` <> 7 OR `{c}` IS NULL" for c in rest)).isEmpty(), name
    pages = odd.select("*", F.lit("<p>one two three</p>").alias("page")).drop("html")
    got = html_extract.extract(pages, html_extract.weights_of({}), html_col="page")
    assert set(got.columns) == set(pages.columns) - {"page"} and got.where("text <> 'one two three'").isEmpty()


@pytest.mark.parametrize("rows", ["odd", "none"])
def test_pipeline_of_odd_rows(spark, odd, tmp_path, rows):
    docs = odd.drop("copy", "mix_key") if rows == "odd" else odd.drop("copy", "mix_key").limit(0)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 0), (None, 1), (9, None)], "doc_id long, toxic int").limit(3 if rows == "odd" else 0).write.parquet(
        f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "something else"), (2, None)], "item_id long, text string").limit(2 if rows == "odd" else 0).write.parquet(
        f"{tmp_path}/benchmark.parquet")
    got = C.run(spark, str(tmp_path)).collect()
    if rows == "none":
        assert got == []
        return
    ids = [r["doc_id"] for r in got]
    assert set(ids) <= {1, 3, 4, 5, None} and ids.count(None) >= 1  # 2 is a near copy of 1
    starts = sorted((r["start"], r["n_tokens"]) for r in got)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))
    assert all((r["mix_key"] is None) == (r["doc_id"] is None) for r in got)
