"""Driver contract and oracle agreement on the sf0.001 tables."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as E
from tests.conftest import SF0001
from tests.oracle_compare import compare, duck

ROWS_ONLY = {"forest_scores"}


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["gate", "metric", "subject", "value", "threshold", "comparison", "passed", "cases",
                          "violations"]
    assert df.count() > 0


def test_every_query_has_an_oracle_or_is_rows_only():
    own = set(E.queries()) - set(E.LLM_QUERIES) - {"pipeline"}
    assert own - set(E.oracle_sql()) == ROWS_ONLY
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_without_the_corpus_package():
    """The corpus operators are removable: the entry imports and offers the rest."""
    code = ("import sys; sys.modules['readyspark.llm'] = None; sys.modules['corpus_pipeline'] = None; "
            "import __spark_entry__ as E; assert not E.LLM_QUERIES and 'pipeline' not in E.queries() and E.oracle_sql()")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    assert subprocess.run([sys.executable, "-c", code], cwd=root).returncode == 0


FAST = ["clean_applications", "clean_reason_counts", "rule_suite_raw", "rule_suite_prepared", "group_quartiles",
        "box_stats", "exact_split", "stratified_folds", "classification_metrics", "separation_gap",
        "robustness_gate", "metamorphic_gate", "onehot_wide", "stream_rejected", "parquet_round_trip", "csv_round_trip",
        "report_round_trip", "history_round_trip", "published_scores", "refused_publication", "aligned_rates",
        "crosstab_wide", "weighted_rows", "numeric_column_counts"]


@pytest.mark.parametrize("name", FAST)
def test_oracle_agrees(spark, name):
    res = compare(spark, name, E.queries()[name], E.oracle_sql()[name], SF0001, duck(SF0001))
    assert res["ok"], res
