"""Training-log monitoring on streams: losses per time window, and the running state of every run."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from bitexture.operators.runlog import MAX_NAN
from bitexture.sources.store import child_folders, is_complete, path_exists

SMOOTHED_STEPS = 100


def windowed_losses(
    log: DataFrame, key: str, time_col: str = "ts", window: str = "1 hour", lateness: str = "10 minutes"
) -> DataFrame:
    """How many losses arrived per key and time window, their sum, and how many were NaN.

    Works on a stream or a table. Watermarks need instants, so NTZ times pass through the session time zone and
    come back."""
    return _windowed(log.withColumn("_ts", F.col(time_col).cast("timestamp")), key, window, lateness, F.lit(True))


def _windowed(timed: DataFrame, key: str, window: str, lateness: str, counts: Column) -> DataFrame:
    """``timed`` has instants ``_ts``; rows for which ``counts`` is false move the watermark only.

    They are left out behind the aggregate: a filter on rows would be moved in front of the watermark.
    """
    valid = ~F.isnan("loss")
    return (
        timed.withWatermark("_ts", lateness)
        .groupBy(F.window("_ts", window).alias("w"), key)
        .agg(
            F.count_if(counts).alias("n"),
            F.count_if(valid).alias("n_valid"),
            F.count_if(F.isnan("loss")).alias("n_nan"),
            F.sum(F.when(valid, F.col("loss"))).alias("loss_sum"),
        )
        .where("n > 0")
        .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), key, "n_valid", "n_nan", "loss_sum")
    )


def write_snapshots(aggregated: DataFrame, out_path: str, checkpoint: str) -> StreamingQuery:
    """Keep the full result table at ``out_path``, open windows included; each trigger replaces it."""

    def replace(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out_path)

    return (
        aggregated.writeStream.outputMode("complete")
        .foreachBatch(replace)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_closed_windows(aggregated: DataFrame, out_path: str, checkpoint: str) -> StreamingQuery:
    """Append each window once the watermark has passed it; state stays as small as the open windows."""
    return (
        aggregated.writeStream.outputMode("append")
        .format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


# Sink ---------------------------------------------------------------------------------------------------------------


def batch_folder(out_path: str, batch_id: int) -> str:
    return f"{out_path}/batch_id={batch_id}"


def write_batch(batch: DataFrame, out_path: str, batch_id: int) -> None:
    """One folder per batch id. A batch that is delivered again replaces its own folder and nothing else."""
    batch.write.mode("overwrite").parquet(batch_folder(out_path, batch_id))


def write_batches(rows: DataFrame, out_path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream's rows, exactly once: a restart delivers an unfinished batch again, under its old id."""
    return (
        rows.writeStream.outputMode("append")
        .foreachBatch(lambda batch, batch_id: write_batch(batch, out_path, batch_id))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_batches(like: DataFrame, out_path: str) -> DataFrame:
    """The rows of all finished batches; a folder without its success marker is being written or was cut short."""
    spark = like.sparkSession
    names = child_folders(spark, out_path) if path_exists(spark, out_path) else []
    finished = [f"{out_path}/{n}" for n in names if n.startswith("batch_id=") and is_complete(spark, f"{out_path}/{n}")]
    reader = spark.read.schema(like.schema)
    return reader.parquet(*finished) if finished else spark.createDataFrame([], like.schema)


class WindowMonitor:
    """Losses per key and time window of a log stream, appended as windows close.

    ``run`` takes what has arrived. ``flush`` closes the windows still open when the log has ended: it puts an
    instant behind them into a stream of its own, ``<work_dir>/clock``, that is read along with the log and counts for
    nothing but the watermark. Rows that arrive after a flush are late unless they lie behind those windows.
    """

    def __init__(
        self, log: DataFrame, key: str, out_path: str, work_dir: str, time_col: str = "ts", window: str = "1 hour", lateness: str = "10 minutes"
    ):
        self.spark, self.out_path, self.work_dir = log.sparkSession, out_path, work_dir
        self.window, self.lateness = window, lateness
        self.clock = f"{work_dir}/clock"
        if not path_exists(self.spark, self.clock):
            self.spark.createDataFrame([], "_ts timestamp").write.parquet(self.clock)
        ticks = self.spark.readStream.schema("_ts timestamp").parquet(self.clock).withColumn("_counts", F.lit(False))
        rows = log.select(F.col(time_col).cast("timestamp").alias("_ts"), key, "loss", F.lit(True).alias("_counts"))
        timed = rows.unionByName(ticks, allowMissingColumns=True)
        self.windows = _windowed(timed, key, window, lateness, F.col("_counts"))

    def run(self) -> StreamingQuery:
        query = write_batches(self.windows, self.out_path, f"{self.work_dir}/state")
        query.awaitTermination()
        return query

    def flush(self, last: StreamingQuery) -> StreamingQuery:
        """``last`` is the latest run; its watermark tells how far the log has come."""
        reached = (last.lastProgress or {}).get("eventTime", {}).get("watermark")
        if reached is None:
            return last
        waits = f"interval {self.lateness} + interval {self.window} + interval {self.lateness} + interval 1 second"
        tick = self.spark.range(1).select((F.to_timestamp(F.lit(reached)) + F.expr(waits)).alias("_ts"))
        tick.write.mode("append").parquet(self.clock)
        return self.run()

    def result(self) -> DataFrame:
        return read_batches(self.windows, self.out_path)


# Runs ---------------------------------------------------------------------------------------------------------------

RUN_STATE = "step bigint, n_nan int, recent array<double>, n_late bigint"


def run_states(
    log: DataFrame,
    run_col: str = "run_id",
    time_col: str = "ts",
    max_nan: int = MAX_NAN,
    width: int = SMOOTHED_STEPS,
    lateness: str = "10 minutes",
    idle: str = "1 hour",
) -> DataFrame:
    """What happens in every run of a log stream ``(run, step, ts, loss)``, while it happens.

    Rows ``(run, event, step, loss, nan_before, smoothed, n_smoothed, n_late)``:

    - ``step``: a valid step, the mean of the last ``width`` valid losses, and how many NaN steps came before;
    - ``stopped``: the ``max_nan``-th NaN of the run; nothing of the run is reported after it;
    - ``closed``: the run has been silent for ``idle`` of event time and its state is given up.

    The state of a run is its last step, the count of NaN steps and the last ``width`` losses. The steps of one trigger are
    put in order; a step that is not beyond the last one of an earlier trigger is late: it is counted in ``n_late`` and
    left out. A row more than ``lateness`` behind the newest of all earlier triggers is dropped. Rows of a run that was
    closed begin a new one. Rows without a run or step are left out; a missing loss counts
    as NaN.
    """
    kind = log.schema[run_col].dataType
    shape = T.StructType(
        [
            T.StructField(run_col, kind),
            T.StructField("event", T.StringType()),
            T.StructField("step", T.LongType()),
            T.StructField("loss", T.DoubleType()),
            T.StructField("nan_before", T.IntegerType()),
            T.StructField("smoothed", T.DoubleType()),
            T.StructField("n_smoothed", T.IntegerType()),
            T.StructField("n_late", T.LongType()),
        ]
    )
    timed = log.where(F.col(run_col).isNotNull() & F.col("step").isNotNull()).select(
        run_col,
        F.col("step").cast("bigint").alias("step"),
        F.coalesce(F.col("loss").cast("double"), F.lit(float("nan"))).alias("loss"),
        F.col(time_col).cast("timestamp").alias("_ts"),
    )
    wait = int(pd.Timedelta(idle).total_seconds() * 1000)

    def advance(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, n_nan, recent, n_late = state.get if state.exists else (-1, 0, [], 0)
        if state.hasTimedOut:
            state.remove()
            yield _events(shape, key, [("closed", last, None, n_nan, None, len(recent), n_late)])
            return
        arrived = pd.concat(list(rows)).sort_values("step", kind="stable")
        newest = arrived["_ts"].max()
        fresh = arrived[arrived["step"] > last]
        n_late += len(arrived) - len(fresh)
        events, n_nan, recent = _followed(fresh["step"].to_numpy(), fresh["loss"].to_numpy(), n_nan, list(recent), n_late, max_nan, width)
        state.update((max(last, int(arrived["step"].max())), n_nan, recent, n_late))
        reached = state.getCurrentWatermarkMs()
        seen = 0 if pd.isna(newest) else int(newest.timestamp() * 1000)
        state.setTimeoutTimestamp(max(seen + wait, reached + 1))
        if events:
            yield _events(shape, key, events)

    grouped = timed.withWatermark("_ts", lateness).groupBy(run_col)
    return grouped.applyInPandasWithState(advance, shape, RUN_STATE, "append", GroupStateTimeout.EventTimeTimeout)


def _followed(
    steps: np.ndarray, losses: np.ndarray, n_nan: int, recent: list[float], n_late: int, max_nan: int, width: int
) -> tuple[list[tuple], int, list[float]]:
    """Events of ordered steps, and the state behind them."""
    is_nan = np.isnan(losses)
    nan_upto = n_nan + np.cumsum(is_nan)
    events: list[tuple] = []
    valid = ~is_nan & (nan_upto < max_nan)
    series = np.r_[np.asarray(recent, np.float64), losses[valid]]
    sums = np.r_[0.0, np.cumsum(series)]
    end = np.arange(len(recent), len(series)) + 1
    begin = np.maximum(end - width, 0)
    size = end - begin
    means = (sums[end] - sums[begin]) / size
    columns = (steps[valid], losses[valid], nan_upto[valid], means, size)
    for step, loss, before, mean, n in zip(*(c.tolist() for c in columns)):
        events.append(("step", step, loss, before, mean, n, n_late))
    if n_nan < max_nan and len(steps) and nan_upto[-1] >= max_nan:
        at = int(np.argmax(nan_upto >= max_nan))
        events.append(("stopped", int(steps[at]), float("nan"), max_nan, None, min(len(series), width), n_late))
    return events, min(int(nan_upto[-1]) if len(steps) else n_nan, max_nan), series[-width:].tolist()


def _events(shape: T.StructType, key: tuple, events: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame([(*key, *event) for event in events], columns=shape.names)
