"""Length-grouped batches: sequences of similar length share a batch, in an order that stays random."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from bitexture.operators.ranking import shuffled_position
from bitexture.operators.selection import row_count
from bitexture.session import scratch_dir
from bitexture.sources.store import written

MEGABATCH_BATCHES = 50


def length_grouped_batches(df: DataFrame, id_col: str, length_col: str, batch_size: int, seed: int) -> DataFrame:
    """``(id, length, batch, slot)``: shuffle, cut into megabatches, sort each by falling length, cut into batches.

    A megabatch is 50 batches, fewer when the table is small. The longest row of all trades places with the
    first slot, so that a batch too large for memory fails at once.
    """
    narrow = df.select(F.col(id_col).alias("id"), F.col(length_col).cast("bigint").alias("length"))
    mega_size = max(min(row_count(narrow) // (batch_size * 4), MEGABATCH_BATCHES), 1) * batch_size
    placed = shuffled_position(narrow, "id", seed).withColumn("mega", F.floor(F.col("position") / mega_size))
    inside = Window.partitionBy("mega").orderBy(F.desc("length"), "position")
    ordered = placed.withColumn("place", F.col("mega") * mega_size + F.row_number().over(inside) - 1)
    # The head of the first megabatch holding the longest row swaps with the head of megabatch 0. It is found while the
    # places are written, so lengths are read and sorted once; a maximum stays the same if a task runs again.
    seen = Observation()
    is_head = F.col("place") % mega_size == 0
    head = F.max(F.when(is_head, F.struct("length", (-F.col("place")).alias("p")))).alias("head")
    ordered = written(ordered.select("id", "length", "place").observe(seen, head), scratch_dir(df.sparkSession, "places"))
    longest = F.lit(-seen.get["head"]["p"] if seen.get.get("head") else 0)
    place = (
        F.when(F.col("place") == longest, F.lit(0)).when(F.col("place") == 0, longest).otherwise(F.col("place"))
    )
    return ordered.select(
        "id",
        "length",
        F.floor(place / batch_size).cast("bigint").alias("batch"),
        (place % batch_size).cast("int").alias("slot"),
    )
