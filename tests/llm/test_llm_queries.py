"""Registered queries of the subpackage and the pipeline."""

import duckdb
import pytest

import corpus_pipeline
from reviewsieve.llm import oracle, queries

SF_SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query_beside_its_sql(spark, name):
    df = queries.queries()[name](spark, SF_SMALL)
    rows = df.collect()
    assert rows
    if name in oracle.expected():
        db = duckdb.connect()
        for table in ("documents", "pages", "benchmark", "embeddings", "labels"):
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_SMALL}/{table}.parquet'")
        cursor = db.execute(oracle.expected()[name])
        columns = [c[0] for c in cursor.description]
        assert sorted(columns) == sorted(df.columns)
        assert sorted(cursor.fetchall(), key=repr) == sorted((tuple(r[c] for c in columns) for r in rows), key=repr)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    counts = [docs.count()]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = corpus_pipeline.write_once(stage(spark, docs, SF_SMALL), name).data
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.schema == docs.schema
        docs = out
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] >= counts[3] > 0 and counts[4] == counts[5] > 0
    assert corpus_pipeline.run(spark, SF_SMALL).count() == counts[5]
    empty = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_SMALL).count() == 0
