"""Splits, samples, limits and the counts that describe them."""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bitexture.functions.hashing import HASH_SPAN, seeded_hash
from bitexture.operators.selection import DIRECT_TOP_K, covers, one_row, row_count, shuffle_cut, values_at
from bitexture.session import scratch_dir
from bitexture.sources.store import written

HASH_BITS = HASH_SPAN.bit_length() - 1
PREFIX_BITS = 10
CUT_ROWS = 1 << 16
BROADCAST_LABELS = 10_000


def split_three_way(
    df: DataFrame,
    id_col: str,
    train_ratio: float = 0.7,
    test_ratio: float = 0.15,
    val_ratio: float = 0.15,
    seed: int = 7812,
) -> DataFrame:
    """Add ``split``: exact train and test sizes over the seeded shuffle, the remainder is validation."""
    if abs(train_ratio + test_ratio + val_ratio - 1.0) > 1e-9:
        raise ValueError("train, test and validation ratios must sum to 1")
    total = row_count(df)
    n_train, n_test = math.floor(total * train_ratio), math.floor(total * test_ratio)
    in_train, in_train_or_test = shuffle_cut(df, id_col, seed, [n_train, n_train + n_test], total)
    return df.withColumn("split", F.when(in_train, "train").when(in_train_or_test, "test").otherwise("validation"))


def split_two_way(df: DataFrame, id_col: str, test_ratio: float = 0.1, *, seed: int) -> DataFrame:
    """Add ``split`` with ``ceil(n * test_ratio)`` test rows, the rest train."""
    total = row_count(df)
    (in_test,) = shuffle_cut(df, id_col, seed, [math.ceil(total * test_ratio)], total)
    return df.withColumn("split", F.when(in_test, "test").otherwise("train"))


def seeded_subsample(df: DataFrame, id_col: str, n: int | None, seed: int) -> DataFrame:
    """``n`` rows without replacement; the whole table when ``n`` is empty or not smaller than it."""
    if not n:
        return df
    total = row_count(df)
    if n >= total:
        return df
    (chosen,) = shuffle_cut(df, id_col, seed, [n], total)
    return df.where(chosen)


def limit_examples(df: DataFrame, id_col: str, max_examples: int | None, default: int | None = None) -> DataFrame:
    """The first ``max_examples`` rows by id. Missing or not positive means ``default``, or all rows without one."""
    k = max_examples if max_examples and max_examples > 0 else default
    if k is None:
        return df
    if k <= DIRECT_TOP_K:
        return df.orderBy(id_col).limit(k)
    (last,) = values_at(df.select(id_col), [k])
    return df if last is None else df.where(F.col(id_col) <= last.value)


def concat_splits(splits: dict[str, DataFrame]) -> DataFrame:
    """One DataFrame with a ``split`` column from a map of split names."""
    named = [df.withColumn("split", F.lit(name)) for name, df in splits.items()]
    return reduce(DataFrame.unionByName, named)


def _holds_end() -> Column:
    """Whether the ``n`` rows after ``before`` hold the last row of train or of test."""
    return reduce(or_, [covers(F.col(end), F.col("before"), F.col("n")) for end in ("first", "second")])


def _inside(keys: DataFrame, cuts: DataFrame, bits: int) -> DataFrame:
    """The keys in the buckets of ``cuts``, with the bucket as ``base`` and what is known about it."""
    cuts = cuts.withColumnsRenamed({"label": "_label", "prefix": "base"}).drop("n")
    at = F.col("label").eqNullSafe(F.col("_label")) & (F.shiftright("h", HASH_BITS - bits) == F.col("base"))
    return keys.join(cuts, at).drop("_label")


def resplit_stratified(
    df: DataFrame,
    id_col: str,
    label_col: str = "label",
    train_ratio: float = 0.7,
    test_ratio: float = 0.15,
    seed: int = 42,
) -> DataFrame:
    """Re-assign ``split`` so that each label is divided by the same ratios.

    Per label the first ``floor(n*train_ratio)`` rows of the shuffle are train, the next ``floor(n*test_ratio)``
    test and the rest validation; a label with fewer than two rows goes to train. The ends of train and test are found for
    all labels at once, from histograms over ever longer prefixes of the hash: each round keeps the buckets that hold an
    end, until they have at most ``CUT_ROWS`` rows or one hash value. The rows are then compared with their label's ends,
    so they stay where they are and one label may hold most of the table.
    """
    here = seeded_hash(id_col, seed)
    keys = df.select(F.col(label_col).alias("label"), F.col(id_col).alias("id"), here.alias("h"))
    scratch = scratch_dir(df.sparkSession, "strata")
    bits = PREFIX_BITS
    prefix = F.shiftright("h", HASH_BITS - bits).alias("prefix")
    # At most 2^PREFIX_BITS rows per label.
    buckets = written(keys.groupBy("label", prefix).agg(F.count("*").alias("n")), f"{scratch}/{bits}")
    upto = Window.partitionBy("label").orderBy("prefix").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("n").over(Window.partitionBy("label"))
    counted = buckets.withColumns({"before": F.sum("n").over(upto) - F.col("n"), "total": total})
    first = F.floor(F.col("total").cast("double") * F.lit(train_ratio))
    second = first + F.floor(F.col("total").cast("double") * F.lit(test_ratio))
    counted = counted.withColumns({"first": first, "second": second})
    totals = counted.where("before = 0").select("label", "total", "first", "second")
    cuts = counted.where(_holds_end())
    stats = one_row(counted.agg(F.max(F.when(_holds_end(), F.col("n"))).alias("n"), F.count_if(F.col("before") == 0).alias("labels")))
    n_labels = stats.labels
    while (stats.n or 0) > CUT_ROWS and bits < HASH_BITS:
        inside = _inside(keys, cuts, bits)
        bits = min(bits + PREFIX_BITS, HASH_BITS)
        finer = F.shiftright("h", HASH_BITS - bits).alias("prefix")
        parts = inside.groupBy("label", "base", "before", "first", "second", "total", finer).agg(F.count("*").alias("n"))
        within = Window.partitionBy("label", "base").orderBy("prefix").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        parts = parts.withColumn("before", F.col("before") + F.sum("n").over(within) - F.col("n"))
        cuts = written(parts.where(_holds_end()).drop("base"), f"{scratch}/{bits}")
        stats = one_row(cuts.agg(F.max("n").alias("n")))
    order = Window.partitionBy("label", "base").orderBy("h", "id")
    ranked = _inside(keys, cuts, bits).withColumn("rank", F.col("before") + F.row_number().over(order))
    ends = ranked.groupBy("label").agg(
        F.max(F.when(F.col("rank") == F.col("first"), F.struct("h", "id"))).alias("train_end"),
        F.max(F.when(F.col("rank") == F.col("second"), F.struct("h", "id"))).alias("test_end"),
    )
    ends = ends.withColumnRenamed("label", "_label")
    limits = totals.select("label", F.col("total").alias("_total"))
    limits = limits.join(ends, F.col("label").eqNullSafe(F.col("_label")), "left").drop("_label")
    limits = limits.withColumnRenamed("label", "_label")
    # One row per label. Beyond the bound the join is a merge, whose hot keys adaptive execution splits.
    if n_labels <= BROADCAST_LABELS:
        limits = F.broadcast(limits)

    def up_to(end: str) -> Column:
        return (here < F.col(end)["h"]) | ((here == F.col(end)["h"]) & (F.col(id_col) <= F.col(end)["id"]))

    # An empty split has no end, and no row is up to it.
    alone = F.col("_total") < 2
    split = F.when(alone | up_to("train_end"), "train").when(up_to("test_end"), "test").otherwise("validation")
    joined = df.drop("split").join(limits, F.col(label_col).eqNullSafe(F.col("_label")), "left")
    return joined.withColumn("split", split).drop("_label", "_total", "train_end", "test_end")


def split_counts(df: DataFrame) -> DataFrame:
    """Rows per split, and in total under the name ``all``."""
    counted = df.rollup("split").agg(F.count("*").alias("n"), F.grouping("split").alias("g"))
    return counted.select(F.when(F.col("g") == 1, "all").otherwise(F.col("split")).alias("split"), "n")


def class_distribution(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Share of every label within its split; rows without a label do not count."""
    counts = df.where(F.col(label_col).isNotNull()).groupBy("split", label_col).agg(F.count("*").alias("n"))
    share: Column = F.col("n") / F.sum("n").over(Window.partitionBy("split"))
    return counts.withColumn("share", share)
