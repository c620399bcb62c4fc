"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bitexture.session import scratch_dir

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared scratch folder and read it back.

    It cuts the lineage, gives later joins plain exchanges that adaptive execution can split, and a lost executor
    costs no recomputation of what lies before.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash; wraps around by design."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def id_sample(ids: DataFrame, id_col: str, at_most: int, seed: int = 0) -> DataFrame:
    """At most ``at_most`` distinct ids, the first by a seeded hash: the same under any partitioning.

    The result is small enough to broadcast because the bound is a parameter.
    """
    distinct = ids.where(F.col(id_col).isNotNull()).select(id_col).distinct()
    return distinct.orderBy(F.xxhash64(F.lit(seed), id_col), id_col).limit(at_most)
