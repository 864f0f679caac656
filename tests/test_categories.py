"""L2 by joined category tables: the slots of the encoder stages, at any size."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from readyspark.operators import categories as K
from readyspark.operators import learn as L

ROWS = [(1, "b", "x", 0.0), (2, "a", "y", 1.0), (3, "é", None, 1.0), (4, "B", "x", 0.0), (5, " ", "x", 0.0), (6, "b", "y", 1.0), (6, "b", "y", 1.0)]
SCHEMA = "id long, c string, d string, class double"


def arrays(df, column):
    return sorted((r["id"], tuple(r["v"])) for r in df.select("id", vector_to_array(column).alias("v")).collect())


@pytest.mark.parametrize("broadcast", [True, False])
def test_same_slots_as_the_stages(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(K, "BROADCAST_BYTES", -1)
    train = spark.createDataFrame(ROWS, SCHEMA)
    seen = train.unionByName(spark.createDataFrame([(7, "new", "x", 0.0), (8, None, None, 1.0)], SCHEMA))
    staged = Pipeline(stages=L.encoders(["c", "d"])).fit(train).transform(seen)
    both = staged.withColumn("v", F.concat(vector_to_array("c__vec"), vector_to_array("d__vec")))
    fitted = K.fit_categories(train, ["c", "d"])
    assert (fitted["c"].size, fitted["d"].size, fitted["c"].small) == (5, 2, broadcast)
    got = K.encode(seen, fitted)
    assert got.columns == [*seen.columns, "onehot"]
    assert arrays(got, "onehot") == sorted((r["id"], tuple(r["v"])) for r in both.select("id", "v").collect())
    forest = RandomForestClassifier(featuresCol="onehot", labelCol="class", numTrees=3, seed=1).fit(K.encode(train, fitted))
    assert forest.numFeatures == 7 and forest.transform(got).count() == seen.count()


def test_empty_and_null_columns(spark):
    none = spark.createDataFrame([(1, None, "x", 0.0)], SCHEMA)
    fitted = K.fit_categories(none, ["c"])
    assert K.n_slots(fitted) == 0 and arrays(K.encode(none, fitted), "onehot") == [(1, ())]
    assert K.encode(none.where("false"), K.fit_categories(none, ["d"])).count() == 0
    # an empty text is a category (the stages refuse it)
    some = spark.createDataFrame([(1, "", "x", 0.0), (2, "a", "x", 0.0)], SCHEMA)
    assert arrays(K.encode(some, K.fit_categories(some, ["c"])), "onehot") == [(1, (1.0, 0.0)), (2, (0.0, 1.0))]


def test_many_categories_one_of_them_hot(spark, monkeypatch):
    """Half a million categories, joined by shuffle; a third of the rows share a value."""
    monkeypatch.setattr(K, "BROADCAST_ROWS", 1000)
    n = 500_000
    df = spark.range(n).select("id", F.md5(F.col("id").cast("string")).alias("c"))
    fitted = K.fit_categories(df, ["c"])
    assert fitted["c"].size == n and not fitted["c"].small
    hot = df.unionByName(spark.range(n, n + n // 2).select("id", F.lit(df.first()["c"]).alias("c")))
    out = K.with_slots(hot, fitted)
    # places follow the values' order without gap or tie
    assert out.agg(F.count("*"), F.count("c__idx"), F.count_distinct("c__idx"), F.max("c__idx")).first()[:] == (n + n // 2, n + n // 2, n, n - 1)
    ends = fitted["c"].table.agg(F.min_by("value", "idx"), F.min("value"), F.max_by("value", "idx"), F.max("value")).first()
    assert ends[0] == ends[1] and ends[2] == ends[3]
    tenth = sorted(r["c"] for r in df.collect())[n // 10]
    assert fitted["c"].table.where(F.col("value") == tenth).first()["idx"] == n // 10
