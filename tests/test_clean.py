"""Cleaning cases of FIXTURES F1."""

import pytest

from readyspark import presets as P
from readyspark.operators.clean import clean, clean_reason_counts, contract_split
from readyspark.sources.applications import APPLICATION_COLUMNS

# one admissible application: the last value of every domain, numbers above their bounds
VALID = {c: (sorted(P.ALLOWED_CATEGORIES[c])[-1] if c in P.ALLOWED_CATEGORIES else None) for c in APPLICATION_COLUMNS
         if c != "app_id"}
VALID.update({c: float(P.NUMERIC_MIN.get(c, 0)) + 3.0 + i for i, c in enumerate(P.NUMERIC_COLUMNS)})
VALID.update({"duration": "41", "age": 52.0, "own_telephone": VALID["own_telephone"] or "none", "class": P.TARGET_VALUES[-1]})
VALID.update({"housing": "rent", "checking_status": ">=200", "purpose": "education"})
SCHEMA = ", ".join(f"`{k}` {'double' if isinstance(v, float) else 'string'}" for k, v in VALID.items())


def table(spark, *overrides):
    rows = [dict(VALID, **o) for o in overrides]
    return spark.createDataFrame([tuple(r[k] for k in VALID) for r in rows], SCHEMA)


def test_valid_row_kept_and_numbers_converted(spark):
    out = clean(table(spark, {})).collect()
    assert len(out) == 1 and out[0]["duration"] == 41.0


def test_null_amount_dropped(spark):
    assert clean(table(spark, {}, {"credit_amount": None})).count() == 1


def test_exact_duplicate_dropped(spark):
    assert clean(table(spark, {}, {})).count() == 1


@pytest.mark.parametrize("bad", ["not_numeric", "24d", "nan", ""])
def test_unreadable_duration_dropped(spark, bad):
    assert clean(table(spark, {"duration": bad})).count() == 0


@pytest.mark.parametrize("col,value", [("duration", "0"), ("credit_amount", 99.0),
                                       ("installment_commitment", 0.0), ("residence_since", 0.0),
                                       ("age", 17.0), ("existing_credits", 0.0)])
def test_bounds(spark, col, value):
    assert clean(table(spark, {col: value})).count() == 0


def test_zero_dependents_kept(spark):
    assert clean(table(spark, {"num_dependents": 0.0})).count() == 1


@pytest.mark.parametrize("col", list(P.ALLOWED_CATEGORIES))
def test_invalid_category_dropped(spark, col):
    assert clean(table(spark, {col: "invalid"})).count() == 0


def test_invalid_target_dropped(spark):
    assert clean(table(spark, {"class": "maybe"})).count() == 0


def test_padded_values_trimmed_and_kept(spark):
    out = clean(table(spark, {"checking_status": " >=200 ", "purpose": "\teducation\n", "housing": " rent "})).collect()
    assert [(r["checking_status"], r["purpose"], r["housing"]) for r in out] == [(">=200", "education", "rent")]


def test_duplicates_removed_before_trimming(spark):
    # Q1: " rent" and "rent" are different raw rows, so both stay
    assert clean(table(spark, {}, {"housing": " rent"})).count() == 2


def test_reason_counts_follow_step_order(spark):
    df = table(spark, {}, {}, {"credit_amount": None}, {"duration": "x"}, {"age": 10.0},
               {"purpose": "bad"}, {"class": "unknown"})
    counts = {r["reason"]: r["rows"] for r in clean_reason_counts(df).collect()}
    assert counts == {"input_rows": 7, "null_rows": 1, "duplicate_rows": 1, "non_numeric_rows": 1,
                      "out_of_range_rows": 1, "invalid_category_rows": 1, "invalid_target_rows": 1,
                      "kept_rows": 1}
    assert counts["kept_rows"] == clean(df).count()


def test_contract_split_reasons(spark):
    df = table(spark, {}, {"duration": "n/a"}, {"credit_amount": None})
    rows = contract_split(df, ["duration", "credit_amount"], ["duration"]).select("reasons", "valid").collect()
    assert sorted((tuple(r["reasons"]), r["valid"]) for r in rows) == [
        ((), True), (("missing:credit_amount",), False), (("non_numeric:duration",), False)]


def test_input_not_changed(spark):
    df = table(spark, {"housing": " rent "})
    before = df.collect()
    clean(df).collect()
    assert df.collect() == before
