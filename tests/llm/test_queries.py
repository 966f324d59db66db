"""The registered queries on the smallest tables, and the pipeline's stages."""

import duckdb
import pytest

import corpus_pipeline
from regbook.llm import oracles, queries
from regbook.llm.common import table

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", oracles.all_oracles())
def test_oracle(spark, rows, name):
    con = duckdb.connect()
    for view in ("documents", "conversations"):
        con.sql(f"create view {view} as select * from '{FOLDER}/{view}.parquet'")
    expected = con.sql(oracles.all_oracles()[name]).fetchall()
    got = rows(queries.all_queries()[name](spark, FOLDER))
    assert got == sorted(expected)


@pytest.mark.parametrize("number", range(1, 14))
def test_one_row_per_input_row(spark, number):
    (query,) = (f for n, f in queries.all_queries().items() if n.startswith(f"op{number}_"))
    if number == 13:
        assert query(spark, FOLDER).count() == table(spark, FOLDER, "conversations").select("conv_id").distinct().count()
    elif number != 3:
        source = "pages" if number == 2 else "documents"
        assert query(spark, FOLDER).count() == table(spark, FOLDER, source).count()
    else:
        assert query(spark, FOLDER).count() > 0


def test_pipeline(spark):
    docs = table(spark, FOLDER, "documents")
    sizes = [docs.count()]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, FOLDER)
        if number < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == list(corpus_pipeline.COLUMNS)
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[0] > sizes[1] > 0
    assert sizes[1] == sizes[2] and sizes[4] == sizes[5]
    assert docs.filter("not round_trip").isEmpty()
