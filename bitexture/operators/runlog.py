"""Training-metric series ``(run_id, step, loss)``: NaN guard, smoothed loss, optimizer steps.

These are running states over the steps of a run. A run may hold most of the log, so the state is carried in
blocks of steps: counts per block, a prefix sum over the (few) blocks, then a window inside each block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STEP_BLOCK = 4096
MAX_NAN = 3


def running_counts(df: DataFrame, keys: list[str], order: str, flags: dict[str, Column]) -> DataFrame:
    """Add, per flag, the number of flagged rows up to and including this one, in integer ``order`` within keys."""
    blocked = df.withColumn("_block", F.floor(F.col(order) / STEP_BLOCK))
    for name, flag in flags.items():
        blocked = blocked.withColumn(name, F.coalesce(flag, F.lit(False)).cast("bigint"))
    ahead = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    per_block = blocked.groupBy(*keys, "_block").agg(*[F.sum(n).alias(n) for n in flags])
    offsets = per_block.select(
        *keys, "_block", *[F.coalesce(F.sum(n).over(ahead), F.lit(0)).alias(f"_before_{n}") for n in flags]
    )
    inside = Window.partitionBy(*keys, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    counted = blocked.join(offsets, [*keys, "_block"])
    return counted.withColumns({n: F.col(f"_before_{n}") + F.sum(n).over(inside) for n in flags}).drop(
        "_block", *[f"_before_{n}" for n in flags]
    )


def _guarded(log: DataFrame, keys: list[str], max_nan: int, counts: dict[str, Column]) -> DataFrame:
    """Valid steps before the ``max_nan``-th NaN of their run, with ``nan_before`` and further running counts."""
    counted = running_counts(log, keys, "step", {"nan_before": F.isnan("loss"), **counts})
    return counted.where(~F.isnan("loss") & (F.col("nan_before") < max_nan))


def nan_guard(log: DataFrame, keys: list[str] = ["run_id"], max_nan: int = MAX_NAN) -> DataFrame:
    """Drop NaN steps, and everything from the ``max_nan``-th NaN of a run on; add ``nan_before``."""
    return _guarded(log, keys, max_nan, {})


def smoothed_loss(log: DataFrame, keys: list[str] = ["run_id"], width: int = 100) -> DataFrame:
    """Add ``smoothed``, the mean loss of the last ``width`` valid steps, and ``n_smoothed``, how many there were.

    Each block of positions also receives the last ``width - 1`` rows of the block before it.
    """
    valid = _guarded(log, keys, MAX_NAN, {"position": ~F.isnan("loss")})
    block = max(STEP_BLOCK, width)
    position = F.col("position") - 1
    home = F.floor(position / block)
    near_end = F.pmod(position, F.lit(block)) >= block - (width - 1)
    homes = F.when(near_end, F.array(home, home + 1)).otherwise(F.array(home))
    spread = valid.withColumn("_home", home).withColumn("_window", F.explode(homes))
    recent = Window.partitionBy(*keys, "_window").orderBy("position").rowsBetween(-(width - 1), 0)
    smoothed = spread.withColumns({"smoothed": F.avg("loss").over(recent), "n_smoothed": F.count("loss").over(recent)})
    return smoothed.where(F.col("_home") == F.col("_window")).drop("_home", "_window", "position")


def optimizer_steps(log: DataFrame, keys: list[str] = ["run_id"], accumulate: int = 8) -> DataFrame:
    """One row per optimizer step with the micro-steps whose gradients it applied.

    The optimizer fires on every ``accumulate``-th step of an epoch, unless that step is NaN; gradients not yet
    applied carry over to the next firing, also across epochs. A trailing incomplete group never fires.
    """
    fires = (F.pmod(F.col("step_in_epoch") + 1, F.lit(accumulate)) == 0) & ~F.isnan("loss")
    counted = _guarded(log.withColumn("fires", fires), keys, MAX_NAN, {"fired": F.col("fires")})
    group = F.col("fired") - F.col("fires").cast("bigint")
    return (
        counted.groupBy(*keys, group.alias("optimizer_step"))
        .agg(
            F.min("step").alias("first_step"),
            F.max("step").alias("last_step"),
            F.count("*").alias("n_micro"),
            F.sum("loss").alias("loss_sum"),
            F.max("fires").alias("fires"),
        )
        .where("fires")
        .drop("fires")
    )
