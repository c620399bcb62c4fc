"""Raw scored pairs to saved training data."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bitexture.functions.hashing import seeded_hash
from bitexture.functions.prompts import PromptComposer
from bitexture.functions.text import TokenCounter
from bitexture.operators.curate import curate_top, training_texts
from bitexture.operators.splits import split_three_way
from bitexture.session import scratch_dir
from bitexture.sources.store import build_if_missing, load_dataset, save_splits


def build_pairs_and_texts(
    spark: SparkSession,
    pairs: DataFrame,
    out_dir: str,
    composer: PromptComposer,
    counter: TokenCounter,
    *,
    src_lang: str,
    trg_lang: str,
    size: int = 100_000,
    max_tokens: int = 512,
    ratios: tuple[float, float, float] = (0.7, 0.15, 0.15),
    text_seed: int = 1337,
) -> tuple[DataFrame, DataFrame]:
    """Curate, split and write the pairs; expand train and validation into shuffled instruction texts.

    The curated pairs are written once before they are split, so scoring and token counting run once. Their folder is
    named after all parameters: a job that died goes on from there, one with other parameters curates anew, and
    splits and texts are replaced. Corpora with other contents need an ``out_dir`` of their own.
    """
    facts = (composer, getattr(counter, "__qualname__", counter), src_lang, trg_lang, size, max_tokens)
    curated = build_if_missing(
        spark,
        f"{out_dir}/curated-{hashlib.sha256(repr(facts).encode()).hexdigest()[:16]}",
        lambda: curate_top(
            pairs,
            composer,
            counter,
            max_tokens=max_tokens,
            size=size,
            src_lang=src_lang,
            trg_lang=trg_lang,
            work_dir=scratch_dir(spark, "scores"),
        ),
    )
    save_splits(split_three_way(curated, "pair_id", *ratios), f"{out_dir}/pairs", "overwrite")
    split_pairs = load_dataset(spark, f"{out_dir}/pairs")
    texts = training_texts(split_pairs, composer, src_lang, trg_lang)
    save_splits(seeded_shuffle_texts(texts, text_seed), f"{out_dir}/texts", "overwrite")
    return split_pairs, load_dataset(spark, f"{out_dir}/texts")


def seeded_shuffle_texts(texts: DataFrame, seed: int) -> DataFrame:
    """Instruction texts in seeded random order within their split; the two directions of a pair land apart.

    Sorting by split first inside a task is what a partitioned write asks for, so it leaves the order alone.
    """
    key = F.concat_ws("|", F.col("pair_id").cast("string"), "direction")
    keyed = texts.withColumn("_key", key).withColumn("_h", seeded_hash("_key", seed))
    ordered = keyed.repartitionByRange("_h", "_key").sortWithinPartitions("split", "_h", "_key")
    return ordered.drop("_h", "_key")
