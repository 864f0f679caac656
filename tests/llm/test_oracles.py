"""The corpus queries against their DuckDB SQL, and their contracts' columns."""

import pytest

import __spark_entry__ as E
from readyspark.llm.oracle import ORACLE
from readyspark.llm.queries import QUERIES
from tests.conftest import SF0001
from tests.oracle_compare import compare, duck

# the columns that each query returns at least
COLUMNS = {
    "op1_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op2_token_store": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op4_chat": {"conv_id": "bigint", "n_turns": "bigint", "turns_sha256": "string", "loss_chars": "bigint",
                 "loss_sha256": "string", "formatted_chars": "bigint"},
    "op5_html": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op7_decontamination": {"doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint",
                            "items_sha256": "string", "contaminated": "boolean"},
    "op8_token_counts": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    "op9_line_quality": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint",
                         "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    "op11_spelling_variants": {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint",
                               "form_n": "bigint"},
    "op12_hard_negatives": {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint",
                            "positive_score": "bigint", "negative_score": "bigint"},
    "op13_url_filter": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op10_near_duplicates": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle_agrees(spark, name):
    res = compare(spark, name, QUERIES[name], ORACLE[name], SF0001, duck(SF0001))
    assert res["ok"], res


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_contract_columns(spark, name):
    df = QUERIES[name](spark, SF0001)
    kinds = dict(df.dtypes)
    assert {c: kinds.get(c) for c in COLUMNS[name]} == COLUMNS[name]


def test_registered():
    assert set(QUERIES) <= set(E.queries()) and "pipeline" in E.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
