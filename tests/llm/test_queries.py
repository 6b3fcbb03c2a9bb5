"""Queries of the subpackage against their SQL, and the pipeline, on the smallest data."""

import duckdb
import pytest

import corpus_pipeline
from auditloom.llm import queries
from auditloom.plans.standins import TABLES
from tools.compare import normal, same

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    made = duckdb.connect()
    for name in TABLES:
        made.execute(f"create view {name} as select * from '{DATA}/{name}.parquet'")
    return made


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, con, name):
    mine = queries.QUERIES[name](spark, DATA).toPandas()
    theirs = con.execute(queries.ORACLES[name]).df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert same(normal(mine), normal(theirs))


def test_each_operator_has_one_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))


def test_pipeline_keeps_documents_columns_until_the_last_stage(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.stored(stage(spark, docs, DATA), f"test-{name}")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == before.columns
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and 0 < counts[-1] < counts[0]
    whole = corpus_pipeline.run(spark, DATA)
    assert normal(whole.toPandas()) == normal(docs.toPandas())
    assert whole.filter("not round_trip or not parity").isEmpty()
