"""Registered queries: SQL twins against DuckDB, and whole tables in every result."""

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(__file__)))

from compare import differences, open_tables  # noqa: E402

from shoplayers.llm.queries import QUERIES, SQL  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), open_tables(FOLDER), SQL[name]) == []


def test_thirteen_operators():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", ["op3_token_counts", "op5_simhash", "op6_sharding", "op7_quality_rules", "op8_quality_classifier", "op11_importance_resampling", "op12_byte_bpe"])
def test_one_row_per_document(spark, name):
    ids = [r["doc_id"] for r in QUERIES[name](spark, FOLDER).select("doc_id").collect()]
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id").collect()
    assert sorted(ids) == sorted(r["doc_id"] for r in documents)
