"""Every registered query beside its SQL oracle on the smallest tables."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import SMOKE_DIR, entry, oracle_sql, queries
from bitexture.suite import queries as suite
from check_queries import TABLES, canonical

pytestmark = pytest.mark.skipif(not os.path.isdir(SMOKE_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{SMOKE_DIR}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(queries()))
def test_query_equals_oracle(spark, duck, name):
    got = queries()[name](spark, SMOKE_DIR).toPandas()
    assert len(got) > 0
    if name in oracle_sql():
        want = duck.execute(oracle_sql()[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert canonical(got) == canonical(want)


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).columns == ["pair_id", "src_text", "trg_text", "sort_score"]


def test_token_cache_reads_no_fixed_number_of_partitions(spark, tmp_path, monkeypatch):
    """The texts that are compared with the cache are dealt by size, however many share an id."""
    docs = spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("doc_id"),
        *(F.lit(x).alias(c) for c, x in (("source", "s"), ("lang", "en"))),
        F.concat_ws(" ", *(F.sha2(F.concat(F.lit(str(k)), F.col("id")), 256) for k in range(8))).alias("text"),
    )
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    given = []
    prepare_split = suite.prepare_split
    monkeypatch.setattr(suite, "prepare_split", lambda s, texts, *a, **k: given.append(texts) or prepare_split(s, texts, *a, **k))
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        rows = suite.token_cache(spark, str(tmp_path)).agg(F.sum("n")).first()[0]
        sizes = given[1].rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert rows == 4000 and given[0].count() == given[1].count()
    assert len(sizes) > 6 and max(sizes) < 1500
