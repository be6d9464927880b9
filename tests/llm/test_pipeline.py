import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
import corpus_pipeline as C
from codedframes.llm import queries as Q
from codedframes.llm.common import saved

TABLES = "/root/testdata/sf0.001"
given = pytest.mark.skipif(not os.path.isdir(TABLES), reason="the given tables are not here")


@given
@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_query_against_sql(spark, name):
    database = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "benchmark"):
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{TABLES}/{table}.parquet'")
    expected = database.execute(Q.ORACLES[name]).df()
    found = Q.QUERIES[name](spark, TABLES).toPandas()[list(expected.columns)]
    by = list(expected.columns)[:2]
    pd.testing.assert_frame_equal(
        found.sort_values(by).reset_index(drop=True), expected.sort_values(by).reset_index(drop=True), check_dtype=False)


@given
def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    for name, stage in C.STAGES[:-1]:
        docs = saved(stage(spark, docs, TABLES))
        assert docs.columns == list(C.COLUMNS) and docs.count() > 0, name
    assert C.STAGES[-1][1](spark, docs, TABLES).count() >= docs.count()
    assert set(entry.queries()) >= set(Q.QUERIES) | {"pipeline"}


def test_stages_on_rows_of_all_kinds(spark, kinds, none, folder):
    labels = "doc_id long, quality int, toxic int"
    spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, 0, 1)], labels).write.parquet(f"{folder}/labels.parquet")
    for docs in (kinds, none):
        for name, stage in C.STAGES:
            docs = saved(stage(spark, docs, folder))
        assert docs.count() >= 0
    near = C.drop_near_duplicates(spark, kinds, folder).collect()
    assert len({(r["doc_id"], r["text"]) for r in near}) == len(near)
    assert sum(r["text"] is None or not r["text"].strip() for r in near) == 1
