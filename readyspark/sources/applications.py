"""Credit applications derived from the order tables (FIXTURES F12).

The driver tables carry no credit data, so an application is built per order:
lineitem is pre-aggregated per order (map-side partial aggregation, one row per
order leaves the scan side), then joined to orders and customer on their keys.
The derivation only uses the row's own values, so it is exact on any number
of partitions and on DuckDB, which builds the same table for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readyspark import presets as P
from readyspark.functions.exprs import pick
from readyspark.sources.tables import read_table

# F12 column rules over the presets' category lists
PRIORITY_HISTORY = [
    "critical/other existing credit",
    "delayed previously",
    "existing paid",
    "all paid",
    "no credits/all paid",
]
SAVINGS_BY_CUSTKEY = P.ALLOWED_CATEGORIES["savings_status"]
PURPOSE_BY_ORDERKEY = P.ALLOWED_CATEGORIES["purpose"]
EMPLOYMENT_BY_CUSTKEY = P.ALLOWED_CATEGORIES["employment"]
JOB_BY_ORDERKEY = P.ALLOWED_CATEGORIES["job"]
HOUSING_BY_CUSTKEY = P.ALLOWED_CATEGORIES["housing"]
PARTIES_BY_ORDERKEY = P.ALLOWED_CATEGORIES["other_parties"]
PERSONAL_BY_CUSTKEY_MOD10 = [
    "male div/sep",
    "female div/dep/mar",
    "female div/dep/mar",
    "male mar/wid",
    "female single",
    "male single",
    "male single",
    "male single",
    "male single",
    "male single",
]
SEGMENT_PROPERTY = {
    "AUTOMOBILE": "car",
    "MACHINERY": "life insurance",
    "HOUSEHOLD": "no known property",
}
STATUS_PLANS = {"F": "bank", "O": "none", "P": "stores"}

APPLICATION_COLUMNS = [
    "app_id", "checking_status", "duration", "credit_history", "purpose", "credit_amount",
    "savings_status", "employment", "installment_commitment", "personal_status",
    "other_parties", "residence_since", "property_magnitude", "age", "other_payment_plans",
    "housing", "existing_credits", "job", "num_dependents", "own_telephone",
    "foreign_worker", "class",
]


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line count and returned-line count per order; partial aggregation runs
    before the shuffle, so only one row per (task, order) crosses it."""
    return (read_table(spark, sf_dir, "lineitem")
            .groupBy("l_orderkey")
            .agg(F.count(F.lit(1)).alias("n_lines"),
                 F.count_if(F.col("l_returnflag") == "R").alias("n_returned")))


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One clean application per order that has lines and a customer."""
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    c = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    lines = order_lines(spark, sf_dir)
    j = (o.join(lines, o.o_orderkey == lines.l_orderkey, "inner")
          .join(c, o.o_custkey == c.c_custkey, "inner"))

    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    n, r, bal = F.col("n_lines"), F.col("n_returned"), F.col("c_acctbal")
    bad_signals = ((n >= 5).cast("int") + (bal < 1000).cast("int") + (2 * r > n).cast("int"))
    segment = F.col("c_mktsegment")
    status = F.col("o_orderstatus")
    return j.select(
        ok.alias("app_id"),
        F.when(F.col("c_nationkey") % 4 == 0, "no checking")
         .when(bal < 1000, "<0").when(bal < 5000, "0<=X<200").otherwise(">=200")
         .alias("checking_status"),
        (n * 6).cast("double").alias("duration"),
        pick(F.substring("o_orderpriority", 1, 1).cast("int") - 1, PRIORITY_HISTORY).alias("credit_history"),
        pick(ok % 10, PURPOSE_BY_ORDERKEY).alias("purpose"),
        (F.col("o_totalprice") / 20).alias("credit_amount"),
        pick(ck % 5, SAVINGS_BY_CUSTKEY).alias("savings_status"),
        pick(ck % 5, EMPLOYMENT_BY_CUSTKEY).alias("employment"),
        (ok % 4 + 1).cast("double").alias("installment_commitment"),
        pick(ck % 10, PERSONAL_BY_CUSTKEY_MOD10).alias("personal_status"),
        pick(ok % 3, PARTIES_BY_ORDERKEY).alias("other_parties"),
        (F.col("c_nationkey") % 4 + 1).cast("double").alias("residence_since"),
        F.when(segment == "AUTOMOBILE", SEGMENT_PROPERTY["AUTOMOBILE"])
         .when(segment == "MACHINERY", SEGMENT_PROPERTY["MACHINERY"])
         .when(segment == "HOUSEHOLD", SEGMENT_PROPERTY["HOUSEHOLD"])
         .otherwise("real estate").alias("property_magnitude"),
        (ck % 60 + 18).cast("double").alias("age"),
        F.when(status == "F", STATUS_PLANS["F"]).when(status == "O", STATUS_PLANS["O"])
         .when(status == "P", STATUS_PLANS["P"]).alias("other_payment_plans"),
        pick(ck % 3, HOUSING_BY_CUSTKEY).alias("housing"),
        (ok % 3 + 1).cast("double").alias("existing_credits"),
        pick(ok % 4, JOB_BY_ORDERKEY).alias("job"),
        (ok % 2 + 1).cast("double").alias("num_dependents"),
        F.when(ok % 3 == 0, "yes").otherwise("no").alias("own_telephone"),
        F.when(ok % 2 == 0, "yes").otherwise("no").alias("foreign_worker"),
        F.when(bad_signals >= 2, "bad").otherwise("good").alias("class"),
    )


def dirty_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The application table with the defects the cleaning step must remove:
    unreadable durations, missing amounts, padded text, unknown categories,
    unknown targets and exact duplicate rows (all derived from the key)."""
    a = applications(spark, sf_dir)
    ok = F.col("app_id")
    dirty = a.withColumns({
        "duration": F.when(ok % 89 == 0, F.lit("n/a"))
                     .otherwise(F.col("duration").cast("bigint").cast("string")),
        "credit_amount": F.when(ok % 97 != 0, F.col("credit_amount")),
        "housing": F.when(ok % 53 == 0, F.concat(F.lit("  "), F.col("housing"), F.lit(" ")))
                    .otherwise(F.col("housing")),
        "purpose": F.when(ok % 71 == 0, F.lit("invalid")).otherwise(F.col("purpose")),
        "class": F.when(ok % 83 == 0, F.lit("unknown")).otherwise(F.col("class")),
    })
    # one pass: rows to be doubled are exploded, not re-read and unioned
    copies = F.when(ok % 101 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return dirty.withColumn("_copy", F.explode(copies)).drop("_copy")
