import re

import duckdb
import pytest

from fleetgauge.llm import queries

DATA = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.queries()) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equals_its_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    want = db.sql(queries.oracle_sql()[name])
    got = queries.queries()[name](spark, DATA).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


@pytest.mark.parametrize("name", ["op1_html_extraction", "op8_mixing", "op9_language_id", "op10_secret_scan", "op2_pii", "op11_token_counts", "op13_tokenizer_alignment"])
def test_a_row_for_each_row(spark, name):
    table = "pages" if name.startswith("op1_") else "documents"
    got = queries.queries()[name](spark, DATA)
    assert got.count() == spark.read.parquet(f"{DATA}/{table}.parquet").count()
