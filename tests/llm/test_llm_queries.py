"""The registered queries against their SQL, and the pipeline against its operators."""

from __future__ import annotations

import glob
import os

import corpus_pipeline
import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from vouch.llm.oracles import ORACLES
from vouch.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_registered():
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        duck.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    df = QUERIES[name](spark, SF)
    listed = ", ".join(sorted(df.columns))
    got = sorted(repr(tuple(r)) for r in df.select(*sorted(df.columns)).collect())
    assert got == sorted(map(repr, duck.execute(f"SELECT {listed} FROM ({ORACLES[name]})").fetchall()))


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("extra", F.lit("own"))
    columns, count = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, SF))
        assert docs.columns == columns and 0 < docs.count() <= count, name
        count = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == count
    empty = docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
