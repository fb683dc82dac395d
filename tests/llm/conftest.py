import os

import duckdb
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents():
    """(doc_id, text, lang, source) of the smallest documents table."""
    return duckdb.sql(f"select doc_id, text, lang, source from '{os.path.join(SF, 'documents.parquet')}' order by 1").fetchall()
