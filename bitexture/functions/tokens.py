"""Token arrays: code-point tokenizer, fixed-length rows, masks, loss labels; tokenizer files as Arrow UDFs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

IGNORED_LABEL = -100
CHUNK_CHARS = 1 << 18  # encoded at once: a token takes some 100 bytes while its encoding is held


def codepoint_ids(text: Column, limit: int | None = None) -> Column:
    """One id per code point. ``limit`` bounds the work when the row is truncated to that length anyway."""
    kept = text if limit is None else F.substring(text, 1, limit)
    return F.when(F.length(kept) > 0, F.transform(F.split(kept, ""), F.ascii)).otherwise(
        F.array().cast("array<int>")
    )


def with_special_ids(ids: Column, begin: list[int] = [], end: list[int] = []) -> Column:
    lead = F.array(*[F.lit(i) for i in begin]).cast("array<int>")
    tail = F.array(*[F.lit(i) for i in end]).cast("array<int>")
    return F.concat(lead, ids, tail)


def pad_right(ids: Column, length: int, pad_id: int) -> Column:
    """Cut or pad to exactly ``length`` ids."""
    return F.slice(F.concat(ids, F.array_repeat(F.lit(pad_id), length)), 1, length)


def padding_mask(ids: Column, length: int) -> Column:
    """1 for real positions, 0 for padding."""
    real = F.least(F.size(ids), F.lit(length))
    return F.concat(F.array_repeat(F.lit(1), real), F.array_repeat(F.lit(0), F.lit(length) - real))


def loss_labels(ids: Column, pad_id: int) -> Column:
    """Labels for the loss: padding is ignored. Where pad and end share an id, real end ids go too."""
    return F.transform(ids, lambda i: F.when(i == pad_id, IGNORED_LABEL).otherwise(i))


def real_length(ids: Column, end_id: int) -> Column:
    """Number of ids before the first end id."""
    first_end = F.array_position(ids, F.lit(end_id))
    return F.when(first_end > 0, first_end - 1).otherwise(F.size(ids)).cast("int")


def fixed_length_rows(df: DataFrame, ids: Column, length: int, pad_id: int, text_col: str = "text") -> DataFrame:
    """Replace the text by ``input_ids``, ``attention_mask`` and ``labels`` (a copy of the ids)."""
    return (
        df.withColumn("_ids", ids)
        .withColumn("input_ids", pad_right(F.col("_ids"), length, pad_id))
        .withColumn("attention_mask", padding_mask(F.col("_ids"), length))
        .withColumn("labels", F.col("input_ids"))
        .drop("_ids", text_col)
    )


def file_content(spark: SparkSession, path: str) -> bytes:
    """Bytes of one small file on any storage that Spark reads."""
    return bytes(spark.read.format("binaryFile").load(path).select("content").first().content)


def _chunks(texts: list[str]) -> Iterator[list[str]]:
    """The texts in order, in lists of at most ``CHUNK_CHARS`` characters; a longer text is alone in its list."""
    chunk, size = [], 0
    for text in texts:
        if chunk and size + len(text) > CHUNK_CHARS:
            yield chunk
            chunk, size = [], 0
        chunk.append(text)
        size += len(text)
    if chunk:
        yield chunk


def _encoder(
    spark: SparkSession, path: str, special: bool, take: Callable, result_type: str, max_length: int | None = None
):
    """Arrow UDF over a tokenizer file of some MB, which is broadcast as it is and which each task loads once.

    Padding or truncation set in the file is switched off; ``max_length`` truncates so that special tokens stay. Encodings are
    held for one chunk of texts, whatever the size of the Arrow batch, and each chunk leaves the task as a batch of its own.
    """
    content = spark.sparkContext.broadcast(file_content(spark, path))

    @F.pandas_udf(result_type)
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_buffer(content.value)
        tokenizer.no_padding()
        if max_length is None:
            tokenizer.no_truncation()
        else:
            tokenizer.enable_truncation(max_length)
        for texts in batches:
            for chunk in _chunks(texts.fillna("").tolist()):
                encoded = tokenizer.encode_batch_fast(chunk, add_special_tokens=special)
                yield pd.Series([take(e) for e in encoded])

    return encode


def file_token_counter(spark: SparkSession, path: str, special: bool = True):
    """Token counter of a tokenizer file: whole text, no padding, no truncation, special tokens included."""
    return _encoder(spark, path, special, len, "int")


def file_token_ids(spark: SparkSession, path: str, special: bool = True, max_length: int | None = None):
    """Token ids from a tokenizer file, unpadded."""
    return _encoder(spark, path, special, lambda e: np.array(e.ids, np.int32), "array<int>", max_length)
