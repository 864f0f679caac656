"""A2 with very many row keys, and with more columns than one list holds."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from readyspark.operators import features, profile


def test_a_million_row_keys(spark):
    df = spark.range(1_000_000).select(F.col("id").alias("r"), (F.col("id") % 3).cast("string").alias("c"))
    got = profile.crosstab_share(df, "r", "c")
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()
    sums = got.agg(F.count("*"), F.sum("n"), F.sum("share"), F.count_if(F.col("n") == 1)).first()
    assert tuple(sums) == (3_000_000, 1_000_000, 1_000_000.0, 1_000_000)
    sizes = got.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert sizes < 3_000_000  # dealt over the tasks


@pytest.mark.parametrize("limit", [10_000, 4, 1])
def test_columns_in_lists(spark, monkeypatch, limit):
    monkeypatch.setattr(profile, "COLUMN_LIST", limit)
    rows = [(f"r{i % 7}", f"c{i * i % 11}") for i in range(200)] + [(None, "c1"), ("r1", None)]
    got = profile.crosstab_share(spark.createDataFrame(rows, "r string, c string"), "r", "c").collect()
    live = [x for x in rows if None not in x]
    cols = {c for _, c in live}
    assert {(x["r"], x["c"], x["n"]) for x in got} == {(r, c, live.count((r, c))) for r in {r for r, _ in live} for c in cols}
    for r in {r for r, _ in live}:
        assert sum(x["share"] for x in got if x["r"] == r) == pytest.approx(1.0)


def test_every_numeric_type_is_a_feature(spark):
    kinds = "a byte, b short, c int, d long, e float, f double, g decimal(9,2), h string, i boolean, j date"
    df = spark.createDataFrame([], T._parse_datatype_string(kinds))
    assert features.numeric_columns(df, exclude=["c"]) == ["a", "b", "d", "e", "f", "g"]
