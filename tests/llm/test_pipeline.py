"""Stages of the pipeline against what they must keep, and queries against SQL."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rankloom.llm.mixing import mix_sources
from rankloom.llm.queries import QUERIES
from rankloom.llm.sql import SQL

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs, labels = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect():
        labels[r.doc_id] = r.quality
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        assert ids and ids <= before, name
        if k < 4:
            assert docs.columns == columns
        if k == 0:
            good = {d for d, q in labels.items() if q == 1}
            bad = {d for d, q in labels.items() if q == 0}
            assert len(good - ids) <= 0.05 * len(good) and len(bad & ids) <= 0.2 * len(bad)


CLASHING = (
    "size", "source_size", "target", "copies", "taken", "copy", "key", "rows", "ticket", "weight", "kept",
    "removed_chunks", "removed_lines", "_row", "_id", "_t", "_hash", "t", "cid", "runs",
)


def test_clashing_columns(spark):
    """Every stage keeps the values of columns that are called like an operator's own."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").filter("doc_id < 60")
    own = docs.select("*", *[F.concat(F.lit(f"{c} of "), "doc_id").alias(c) for c in CLASHING])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, own, FOLDER)
        assert got.columns == own.columns, name
        rows = got.collect()
        assert rows and all(r[c] == f"{c} of {r.doc_id}" for r in rows for c in CLASHING), name
        plain = stage(spark, docs, FOLDER)
        assert sorted(tuple(r)[: len(docs.columns)] for r in rows) == sorted(map(tuple, plain.collect())), name
    name, stage = corpus_pipeline.STAGES[-1]
    assert stage(spark, own, FOLDER).count() == stage(spark, docs, FOLDER).count() > 0
    carried = mix_sources(own, carry=("key", "rows")).select("doc_id", "key", "rows").collect()
    assert all((r.key, r.rows) == (f"key of {r.doc_id}", f"rows of {r.doc_id}") for r in carried)


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    got, want = QUERIES[name](spark, FOLDER).toPandas(), con.execute(SQL[name]).df()
    columns = sorted(got.columns)
    got, want = (f[columns].sort_values(columns).reset_index(drop=True) for f in (got, want))
    assert got.equals(want.astype(got.dtypes.to_dict()))
