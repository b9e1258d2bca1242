"""The registered queries: those with an SQL twin against it, the others for rows and columns."""

import os

import duckdb
import pytest
from check import TABLES, normal

from fieldbook.llm import queries
from tests.llm.conftest import SMALL

COLUMNS = {
    "op3_byte_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op4_language_id": "doc_id held_out lang_pred score",
    "op5_fingerprints": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op9_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op10_quality_cotraining": "doc_id score keep",
    "op13_source_mixing": "doc_id size source_size target taken",
}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_values(spark, name):
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"create view {table} as select * from '{os.path.join(SMALL, table)}.parquet'")
    got, want = queries.QUERIES[name](spark, SMALL).toPandas(), duck.sql(queries.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert normal(got) == normal(want)


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_a_row_for_each_document(spark, table, name):
    df = queries.QUERIES[name](spark, SMALL)
    assert set(COLUMNS[name].split()) <= set(df.columns)
    assert df.count() == table("documents").count()


def test_all_are_registered():
    import __spark_entry__ as contract

    assert set(queries.QUERIES) <= set(contract.queries()) and len(queries.QUERIES) == 14
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES if name.startswith("op")) == list(range(1, 14))
