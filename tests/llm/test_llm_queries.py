"""The registered queries against their SQL, and the pipeline, on whole tables."""

import os

import duckdb
import pytest

import corpus_pipeline
from riskgraph.llm.queries import QUERIES, SQL
from tests.conftest import SF_SMALL


def values(df, columns):
    def text(x):
        if x is None or x != x:
            return "null"
        return f"{float(x):.6f}" if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)
    return sorted(tuple(text(x) for x in row) for row in df[columns].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"create view {t} as select * from '{os.path.join(SF_SMALL, t)}.parquet'")
    want = con.execute(SQL[name]).df()
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    assert values(got, columns) == values(want, columns)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, n = docs.columns, docs.count()
    sizes = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL)
        sizes.append(docs.count())
        assert name == "pack" or docs.columns == columns
    assert n >= sizes[0] >= sizes[1] > 0 and sizes[2] > 0 and sizes[3] > 0
