"""Exact global positions from bucket counts: one shuffle, no window over the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bitexture.functions.hashing import HASH_SPAN, seeded_hash
from bitexture.operators.selection import bucket_of, one_row

BUCKETS = 1 << 16
BUCKET_ROWS = 1 << 20


def _position(df: DataFrame, bucket: Column, order: list[str], name: str) -> DataFrame:
    """0-based position by ``(bucket, *order)``; there are few buckets."""
    bucketed = df.withColumn("_bucket", bucket)
    ahead = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy("_bucket")
        .agg(F.count("*").alias("_n"))
        .select("_bucket", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("_bucket").orderBy(*order)
    return (
        bucketed.join(F.broadcast(offsets), "_bucket")
        .withColumn(name, F.col("_offset") + F.row_number().over(inside) - 1)
        .drop("_bucket", "_offset")
    )


def shuffled_position(df: DataFrame, id_col: str, seed: int, name: str = "position") -> DataFrame:
    """Position of every row in the seeded shuffle."""
    hashed = df.withColumn("_h", seeded_hash(id_col, seed))
    bucket = F.shiftright("_h", (HASH_SPAN // BUCKETS).bit_length() - 1)
    return _position(hashed, bucket, ["_h", id_col], name).drop("_h")


def id_position(df: DataFrame, id_col: str, name: str = "position") -> DataFrame:
    """Position of every row in the order of a unique whole-number id, bucketed by id range.

    Ids may crowd together beside far outliers: a range with more than ``BUCKET_ROWS`` rows is cut again between its own
    smallest and largest id, into as many parts as it has such loads. The two levels together tell 2^32 ranges apart at
    least, and there are ``BUCKETS`` plus one bucket per ``BUCKET_ROWS`` rows.
    """
    low, high = one_row(df.agg(F.min(id_col), F.max(id_col)))
    coarse = bucket_of(F.col(id_col), low or 0, high or 0, BUCKETS)
    loads = df.groupBy(coarse.alias("_coarse")).agg(
        F.ceil(F.count("*") / BUCKET_ROWS).alias("_parts"), F.min(id_col).alias("_low"), F.max(id_col).alias("_high")
    )
    placed = df.withColumn("_coarse", coarse).join(F.broadcast(loads), "_coarse")  # at most BUCKETS rows
    share = F.when(F.col("_parts") > 1, (F.col(id_col) - F.col("_low")) / (F.col("_high") - F.col("_low"))).otherwise(0.0)
    fine = F.least(F.floor(share * F.col("_parts")), F.col("_parts") - 1)
    placed = placed.withColumn("_fine", fine).drop("_parts", "_low", "_high")
    return _position(placed, F.struct("_coarse", "_fine"), [id_col], name).drop("_coarse", "_fine")


def seeded_shuffle(df: DataFrame, id_col: str, seed: int) -> DataFrame:
    """Rows in seeded random order (a range-partitioned sort by hash)."""
    return df.orderBy(seeded_hash(id_col, seed), id_col)
