"""Every registered query against its SQL on the smallest tables."""

from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from oracle import compare, connect
from sluicebox.queries import all_queries, all_sql

SF_DIR = "/root/testdata/sf0.001"
WITHOUT_SQL = set()
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_only_what_sql_cannot_say_lacks_an_oracle():
    assert set(all_queries()) - set(all_sql()) == WITHOUT_SQL
    assert set(oracle_sql()) <= set(queries())
    assert set(all_queries()) <= set(queries())


@pytest.mark.parametrize("name", sorted(all_sql()))
def test_query_agrees_with_its_sql(spark, connection, name):
    assert compare(spark, connection, name, queries()[name], oracle_sql()[name], SF_DIR) is None


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


def test_normal_forms_of_whole_documents_agree_with_python(spark):
    import hashlib
    import unicodedata

    from sluicebox.functions.text import header_text

    texts = {row["doc_id"]: row["text"] for row in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    for row in queries()["normalise_text"](spark, SF_DIR).collect():
        whole = unicodedata.normalize("NFKC", texts[row["doc_id"]])
        forms = {
            "header_md5": header_text(texts[row["doc_id"]]),
            "value_md5": "".join(whole.split()).replace(",", ""),
            "query_md5": " ".join(whole.split()),
        }
        for name, expected in forms.items():
            assert row[name] == hashlib.md5(expected.encode()).hexdigest()
