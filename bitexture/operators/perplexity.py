"""Perplexity of next-token predictions: exp of the mean cross-entropy over all labelled positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bitexture.functions.tokens import IGNORED_LABEL


def negative_log_likelihood(logits: Column, label: Column) -> Column:
    """``logsumexp(logits) - logits[label]``, shifted by the maximum so that nothing overflows."""
    top = F.array_max(logits).cast("double")
    mass = F.aggregate(logits, F.lit(0.0), lambda acc, x: acc + F.exp(x.cast("double") - top))
    return F.log(mass) + top - F.get(logits, label).cast("double")


def shift_labels(tokens: DataFrame, keys: list[str] = []) -> DataFrame:
    """Pair the logits at a position with the label at the next one; ignored labels are dropped.

    A window covers one sequence, whose length the model bounds.
    """
    following = Window.partitionBy(*keys, "seq_id").orderBy("pos")
    shifted = tokens.withColumn("label", F.lead("label").over(following))
    return shifted.where(F.col("label").isNotNull() & (F.col("label") != IGNORED_LABEL))


def perplexity(tokens: DataFrame, keys: list[str] = []) -> DataFrame:
    """From rows ``(seq_id, pos, logits, label)``."""
    scored = shift_labels(tokens, keys).select(*keys, negative_log_likelihood(F.col("logits"), F.col("label")).alias("nll"))
    return scored.groupBy(*keys).agg(F.count("*").alias("n_tokens"), F.exp(F.avg("nll")).alias("perplexity"))


def sequence_perplexity(batches: DataFrame, keys: list[str] = []) -> DataFrame:
    """From rows ``(logits ARRAY<ARRAY>, labels ARRAY)`` of one sequence each: no shuffle but the final sum."""
    steps = F.arrays_zip(
        F.slice("logits", F.lit(1), F.greatest(F.size("labels") - 1, F.lit(0))).alias("logits"),
        F.slice("labels", 2, F.greatest(F.size("labels") - 1, F.lit(0))).alias("label"),
    )
    flat = batches.select(*keys, F.inline(steps).alias("logits", "label"))
    kept = flat.where(F.col("label").isNotNull() & (F.col("label") != IGNORED_LABEL))
    scored = kept.select(*keys, negative_log_likelihood(F.col("logits"), F.col("label")).alias("nll"))
    return scored.groupBy(*keys).agg(F.count("*").alias("n_tokens"), F.exp(F.avg("nll")).alias("perplexity"))
