"""Readers for scored sentence pairs and for line corpora."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bitexture.functions.text import right_strip, strip
from bitexture.operators.selection import row_count
from bitexture.operators.splits import seeded_subsample
from bitexture.sources.store import written

BROADCAST_BLOCKS = 200_000

SCORE_COLUMNS = ("bicleaner_ai_score", "bleualign_score")


def read_pairs_tsv(spark: SparkSession, path: str, scores: tuple[str, ...] = SCORE_COLUMNS) -> DataFrame:
    """Tab-separated pairs with a header row. Quoting is off: every character between tabs is text.

    Columns go by the names in the header, in any order: scores become numbers, all others stay text. A file
    without ``pair_id`` gets one that is unique within the read and grows with file and line; write the pairs
    before two passes rely on it.
    """
    tabs = spark.read.option("sep", "\t").option("header", True).option("quote", "").option("escape", "")
    names = tabs.csv(path).columns  # reads one line
    schema = T.StructType([T.StructField(n, T.DoubleType() if n in scores else T.StringType()) for n in names])
    pairs = tabs.schema(schema).option("enforceSchema", False).csv(path)
    if "pair_id" in names:
        return pairs.withColumn("pair_id", F.col("pair_id").cast("long"))
    return pairs.select(F.monotonically_increasing_id().alias("pair_id"), "*")


def read_text_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", "text")


def read_line_sources(spark: SparkSession, paths: dict[str, str], work_dir: str) -> DataFrame:
    """Named line corpora as ``(source, line_key, text)``: right-stripped, blank lines kept.

    ``line_key`` runs from 0 in every source. A file block is read in order by one task, so a line's place in its
    block plus the lines in earlier blocks gives the key. The lines are written to ``work_dir`` once: where they
    stood is then fixed for both passes, and compressed files, which cannot be split, become files that can.
    """
    files = spark.read.text(list(paths.values()))
    source: Column | None = None
    for name, path in paths.items():
        place = path.removeprefix("file:").rstrip("/")
        inside = F.endswith(F.col("file"), F.lit(place)) | F.contains(F.col("file"), F.lit(f"{place}/"))
        source = (F if source is None else source).when(inside, name)
    lines = files.select(
        F.col("value").alias("text"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    ).withColumn("source", source)
    lines = written(lines, work_dir)
    # One row per file block, not per line.
    blocks = lines.groupBy("source", "file", "block").agg(F.min("line").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("source").orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("file", "block", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    few = row_count(offsets) <= BROADCAST_BLOCKS
    return lines.join(F.broadcast(offsets) if few else offsets, ["file", "block"]).select(
        "source",
        (F.col("before") + F.col("line") - F.col("first")).alias("line_key"),
        right_strip(F.col("text")).alias("text"),
    )


def text_column(
    df: DataFrame, column: str, id_col: str, subsample: int | None = None, seed: int = 5439
) -> DataFrame:
    """One column, stripped and renamed to ``text``; of a seeded sample of ``subsample`` rows if that is given."""
    narrow = df.select(id_col, F.col(column).alias("text"))
    return seeded_subsample(narrow, id_col, subsample, seed).withColumn("text", strip(F.col("text")))


def keep_column(df: DataFrame, column: str = "text") -> DataFrame:
    return df.select(column)


def as_evaluation_columns(df: DataFrame, start_col: str, dest_col: str) -> DataFrame:
    return df.withColumnsRenamed({start_col: "inputs", dest_col: "outputs"})
