"""Queries against their SQL in another engine, over whole tables."""

import pytest
from compare import connect, spark_rows, sql_rows

from gridweave.llm.oracle import ORACLE
from gridweave.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
DOCUMENTS = {"op1_quality", "op3_language", "op5_decontamination", "op6_sentencepiece", "op10_toxicity"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, name):
    names, rows = spark_rows(QUERIES[name](spark, SF))
    want_names, want = sql_rows(connect(SF), ORACLE[name])
    assert names == want_names
    assert rows == want


@pytest.mark.parametrize("name", sorted(DOCUMENTS))
def test_a_row_per_document(spark, name):
    rows = QUERIES[name](spark, SF)
    ids = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id")
    assert sorted(r.doc_id for r in rows.select("doc_id").collect()) == sorted(
        r.doc_id for r in ids.collect()
    )


def test_every_operator():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))
