"""Training rows: one text column, tokenized to a fixed length, cached per split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bitexture.functions.tokens import codepoint_ids, file_content, file_token_ids, fixed_length_rows, loss_labels
from bitexture.sources.store import cache_label, token_cache


def token_ids(
    spark: SparkSession, text: Column, max_length: int, tokenizer_file: str | None, special: bool
) -> Column:
    """Ids from a tokenizer file, or code points without one."""
    if tokenizer_file is None:
        return codepoint_ids(text, max_length)
    return file_token_ids(spark, tokenizer_file, special, max_length)(text)


def prepare_split(
    spark: SparkSession,
    texts: DataFrame,
    cache_dir: str | None,
    *,
    model: str,
    dataset: str,
    split: str,
    max_length: int = 512,
    pad_id: int = 0,
    tokenizer_file: str | None = None,
    special: bool = True,
) -> DataFrame:
    """Token rows of one split with loss labels; read from the cache when it holds those of the same texts."""

    def tokenize() -> DataFrame:
        text_only = texts.select("text")
        ids = token_ids(spark, F.col("text"), max_length, tokenizer_file, special)
        return fixed_length_rows(text_only, ids, max_length, pad_id)

    content = file_content(spark, tokenizer_file) if cache_dir and tokenizer_file else None
    label = cache_label(model, dataset, split, max_length, content, pad_id, special) if cache_dir else None
    rows = token_cache(spark, cache_dir or "", label, tokenize, texts.select("text"))
    return rows.withColumn("labels", loss_labels(F.col("input_ids"), pad_id))
