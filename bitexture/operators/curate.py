"""Curation: clean pairs, render both directions, apply the token budget, keep the best."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitexture.functions.prompts import PromptComposer
from bitexture.functions.text import TokenCounter, harmonic_mean
from bitexture.operators.ranking import id_position
from bitexture.operators.selection import DIRECT_TOP_K, present, row_count, top_k, values_at
from bitexture.sources.store import written

DIRECT_PAIRS = 1 << 20
WIDEN = 4
MARGIN = 1.25


def clean_pairs(pairs: DataFrame, id_col: str = "pair_id") -> DataFrame:
    """Drop pairs with a missing side and exact copies, keeping the smallest id of each.

    Copies are matched on a digest of both sides, so the texts are not part of the grouping key, and the partial
    aggregation leaves at most one row per pair and task however many copies there are.
    """
    complete = pairs.dropna(subset=["src_text", "trg_text"])
    key = F.sha2(F.concat(F.length("src_text").cast("string"), F.lit("|"), "src_text", "trg_text"), 256)
    keepers = complete.groupBy(key.alias("_key")).agg(F.min(id_col).alias(id_col)).select(id_col)
    return complete.join(keepers, id_col, "left_semi")


def numbered_calls(df: DataFrame, composer: PromptComposer, id_col: str) -> tuple[DataFrame, Column]:
    """The table and the column that numbers its prompts: a ``position`` column it has, or else its dense rank by
    id for composers that go round robin, or the id itself. Rows of a stream have no rank: there the id numbers the
    calls of every composer, so a wording does not depend on how the rows arrive."""
    if "position" in df.columns:
        return df, F.col("position")
    if composer.sequential and not df.isStreaming:
        return id_position(df, id_col, "_call"), F.col("_call")
    return df, F.col(id_col)


def render_both(pairs: DataFrame, composer: PromptComposer, src_lang: str, trg_lang: str) -> DataFrame:
    """Add ``prompt_fwd`` and ``prompt_bwd``, the training prompts of the two directions.

    Pair i makes calls 2i and 2i+1 of a composer that picks its wording by call number.
    """
    pairs, i = numbered_calls(pairs, composer, "pair_id")
    return pairs.withColumns(
        {
            "prompt_fwd": composer.train(F.col("src_text"), F.col("trg_text"), src_lang, i * 2),
            "prompt_bwd": composer.train(F.col("trg_text"), F.col("src_text"), trg_lang, i * 2 + 1),
        }
    ).drop("_call")


def within_budget(
    pairs: DataFrame, composer: PromptComposer, counter: TokenCounter, max_tokens: int, src_lang: str, trg_lang: str
) -> DataFrame:
    """Keep pairs whose rendered prompts have at most ``max_tokens`` tokens in either direction."""
    rendered = render_both(pairs, composer, src_lang, trg_lang)
    longest = F.greatest(counter(F.col("prompt_fwd")), counter(F.col("prompt_bwd")))
    return rendered.where(longest <= max_tokens).drop("prompt_fwd", "prompt_bwd")


def curate_top(
    pairs: DataFrame,
    composer: PromptComposer,
    counter: TokenCounter,
    *,
    max_tokens: int = 512,
    size: int = 100_000,
    scores: tuple[str, str] = ("bicleaner_ai_score", "bleualign_score"),
    src_lang: str = "hr",
    trg_lang: str = "en",
    work_dir: str | None = None,
    heap: int = DIRECT_TOP_K,
) -> DataFrame:
    """The ``size`` best pairs by the harmonic mean of both scores among those within the token budget.

    Without ``work_dir`` the tokens of all pairs are counted. With it, and more than ``DIRECT_PAIRS`` pairs or ``heap`` wanted, the
    best ``WIDEN * size`` pairs by score are looked at first, then the next best ones as far as the share of fitting pairs so
    far suggests, until ``size`` of them fit: tokens are counted for about ``size`` over that share, or ``WIDEN * size`` pairs if
    that is more, whatever the size of the table. ``work_dir`` takes the ids and scores of the fitting pairs; the best of them are
    looked up by id. All ways give the same pairs.
    """
    scored = pairs.dropna(subset=["src_text", "trg_text"]).withColumn("sort_score", harmonic_mean(*map(F.col, scores)))

    def fitting(rows: DataFrame) -> DataFrame:
        return within_budget(rows, composer, counter, max_tokens, src_lang, trg_lang)

    if work_dir is None or (size <= heap and row_count(scored) <= DIRECT_PAIRS):
        return top_k(fitting(scored), "sort_score", "pair_id", size, heap)
    rows, ranking = scored, scored
    if composer.sequential and "position" not in scored.columns:
        # Prompts are numbered among all pairs, once.
        ranking = written(id_position(scored.select("pair_id", "sort_score"), "pair_id"), f"{work_dir}/numbered")
        rows = None
    bands: list[DataFrame] = []
    for k, band in enumerate(_bands(ranking.select("sort_score"), size, bands)):
        chosen = scored.where(band) if rows is not None else scored.join(ranking.where(band).select("pair_id", "position"), "pair_id")
        bands.append(written(fitting(chosen).select("pair_id", "sort_score"), f"{work_dir}/fitting-{k}"))
    best = top_k(reduce(DataFrame.unionByName, bands), "sort_score", "pair_id", size, heap).select("pair_id")
    return scored.join(best, "pair_id", "left_semi")


def _bands(ranking: DataFrame, size: int, fitting: list[DataFrame]) -> Iterator[Column]:
    """Conditions on ``sort_score`` for the next best pairs, until those in ``fitting`` are enough or all pairs were taken."""
    score = F.col("sort_score")
    numbers = ranking.where(present(score))
    taken, rank, found = F.lit(False), WIDEN * size, 0
    while True:
        (cut,) = values_at(numbers, [rank], descending=True)
        upto = F.lit(True) if cut is None else F.coalesce(present(score) & (score >= cut.value), F.lit(False))
        yield upto & ~taken
        found += row_count(fitting[-1])
        if cut is None or found >= size:
            return
        taken, looked_at = upto, cut.before + cut.n
        needed = looked_at * size / found if found else looked_at * WIDEN
        rank = min(max(math.ceil(needed * MARGIN), looked_at + size), looked_at * WIDEN**2)


def top_by_score(pairs: DataFrame, score: str = "bicleaner_ai_score", top_n: int = 1000) -> DataFrame:
    return top_k(pairs, score, "pair_id", top_n)


def top_score_floor(pairs: DataFrame, score: str = "bicleaner_ai_score", top_n: int = 1000) -> DataFrame:
    """Lowest score among the ``top_n`` best pairs."""
    return top_by_score(pairs.select("pair_id", score), score, top_n).agg(F.min(score).alias("lowest_score"))


def expand_directions(
    pairs: DataFrame, composer: PromptComposer, src_lang: str, trg_lang: str, id_col: str = "pair_id"
) -> DataFrame:
    """Two instruction texts per pair, ``fwd`` then ``bwd``, from one scan."""
    rendered = render_both(pairs, composer, src_lang, trg_lang)
    both = F.array(
        F.struct(F.lit("fwd").alias("direction"), F.col("prompt_fwd").alias("text")),
        F.struct(F.lit("bwd").alias("direction"), F.col("prompt_bwd").alias("text")),
    )
    kept = [id_col] + (["split"] if "split" in pairs.columns else [])
    return rendered.select(*kept, F.explode(both).alias("_x")).select(*kept, "_x.direction", "_x.text")


def training_texts(split_pairs: DataFrame, composer: PromptComposer, src_lang: str, trg_lang: str) -> DataFrame:
    """Instruction texts of the train and validation splits; test stays as raw pairs for evaluation."""
    return expand_directions(
        split_pairs.where(F.col("split").isin("train", "validation")), composer, src_lang, trg_lang
    )
