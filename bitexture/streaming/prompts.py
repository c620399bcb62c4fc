"""Prompt rendering and the token budget on arriving pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from bitexture.functions.prompts import PromptComposer
from bitexture.functions.text import TokenCounter
from bitexture.operators.curate import expand_directions, within_budget


def pair_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def write_prompts(
    pairs: DataFrame,
    composer: PromptComposer,
    counter: TokenCounter,
    max_tokens: int,
    src_lang: str,
    trg_lang: str,
    out_path: str,
    checkpoint: str,
) -> StreamingQuery:
    """Append the instruction texts of every pair within budget; stateless, so batches are independent."""
    complete = pairs.dropna(subset=["src_text", "trg_text"])
    fitting = within_budget(complete, composer, counter, max_tokens, src_lang, trg_lang)
    texts = expand_directions(fitting, composer, src_lang, trg_lang)
    return (
        texts.writeStream.format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
