"""Numeric summary, histogram, density and length analysis."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from bitexture.functions.prompts import PromptComposer
from bitexture.functions.text import TokenCounter
from bitexture.operators.curate import render_both
from bitexture.operators.selection import bucket_of, one_row, values_at
from bitexture.operators.splits import seeded_subsample

QUARTILES = (0.25, 0.5, 0.75)
DENSITY_ERROR = 1e-9  # of the peak of a kernel


def _numbers(df: DataFrame, column: str) -> DataFrame:
    value = F.col(column).cast("double")
    return df.where(value.isNotNull() & ~F.isnan(value)).select(value.alias("x"))


SUMMARY_COLUMNS = ["n", "mean", "std", "min", "p25", "p50", "p75", "max"]


def summarize(df: DataFrame, *columns: str, approximate: bool = False) -> DataFrame:
    """Count, mean, sample deviation, min, quartiles with linear interpolation, max; missing numbers do not count.

    One row per column. The first pass covers all columns. The quartiles are exact: each is read off two ranks
    found by histogram, so no task holds all distinct values; that reads the input again per column, so give a
    saved table when it is costly to compute. ``approximate`` uses Spark's mergeable quantile sketch instead and
    needs the first pass only.
    """

    def measures(column: str) -> Column:
        x = F.col(column).cast("double")
        x = F.when(~F.isnan(x), x)
        sketch = F.percentile_approx(x, list(QUARTILES), 100_000) if approximate else F.lit(None)
        return F.struct(
            F.count(x).alias("n"),
            F.avg(x).alias("mean"),
            F.stddev_samp(x).alias("std"),
            F.min(x).alias("min"),
            F.max(x).alias("max"),
            sketch.alias("quartiles"),
        ).alias(column)

    totals = one_row(df.agg(*[measures(c) for c in columns]))
    rows = []
    for column in columns:
        m = totals[column]
        if approximate:
            quartiles = m.quartiles or [None] * len(QUARTILES)
        else:
            # The extent of infinite values is no range to cut: then it is looked for again, among the finite ones.
            finite = m.n and math.isfinite(m.min) and math.isfinite(m.max)
            quartiles = _quartiles(_numbers(df, column), m.n, (m.min, m.max, m.n) if finite else None)
        measured = zip(SUMMARY_COLUMNS, (m.n, m["mean"], m["std"], m.min, *quartiles, m.max))
        typed = [F.lit(v).cast("bigint" if name == "n" else "double").alias(name) for name, v in measured]
        rows.append(F.struct(F.lit(column).alias("column"), *typed))
    return df.sparkSession.range(1).select(F.inline(F.array(*rows)))


def _quartiles(numbers: DataFrame, n: int, extent: tuple | None) -> list[float | None]:
    if not n:
        return [None] * len(QUARTILES)
    spots = [(n - 1) * p for p in QUARTILES]
    ranks = [r for s in spots for r in (math.floor(s) + 1, math.ceil(s) + 1)]
    at = [v.value for v in values_at(numbers, ranks, extent=extent)]
    return [_between(a, b, s - math.floor(s)) for s, a, b in zip(spots, at[0::2], at[1::2])]


def _between(a: float, b: float, share: float) -> float:
    """Linear interpolation; equal ends are the result, infinite ones too."""
    return a if a == b or share == 0 else a * (1 - share) + b * share if math.isinf(a) or math.isinf(b) else a + (b - a) * share


def _extent(numbers: DataFrame) -> Row:
    """Ends, number and deviation of the finite values, and how many are infinite on either side."""
    infinity = float("inf")
    x = F.when(F.abs("x") < infinity, F.col("x"))
    return one_row(
        numbers.agg(
            F.coalesce(F.min(x), F.lit(0.0)).alias("low"),
            F.coalesce(F.max(x), F.lit(0.0)).alias("high"),
            F.count(x).alias("n"),
            F.stddev_samp(x).alias("std"),
            F.count_if(F.col("x") == -infinity).alias("below"),
            F.count_if(F.col("x") == infinity).alias("above"),
        )
    )


def _finite(numbers: DataFrame) -> DataFrame:
    return numbers.where(F.abs("x") < float("inf"))


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width bins ``(bin, low, high, n)`` of the finite values, including empty ones; the last bin is closed on the right.

    Infinite values have bins of their own, -1 and ``bins``, with the same infinity at both ends; only if there are any.
    """
    numbers = _numbers(df, column)
    extent = _extent(numbers)
    numbers = _finite(numbers)
    bin_of = bucket_of(F.col("x"), extent.low, extent.high, bins)
    counts = numbers.groupBy(bin_of.alias("bin")).agg(F.count("*").alias("n"))
    width = (extent.high - extent.low) / bins
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    binned = grid.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (F.lit(extent.low) + F.lit(width) * F.col("bin")).alias("low"),
        (F.lit(extent.low) + F.lit(width) * (F.col("bin") + 1)).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )
    outside = [(-1, float("-inf"), extent.below), (bins, float("inf"), extent.above)]
    rows = [(number, end, end, n) for number, end, n in outside if n]
    return binned.union(df.sparkSession.createDataFrame(rows, binned.schema)) if rows else binned


def density(df: DataFrame, column: str, bins: int = 30, points: int = 200, fine_bins: int | None = None) -> DataFrame:
    """Gaussian kernel density of the finite values on an even grid, scaled to the counts of a histogram with ``bins`` bins.

    Bandwidth is ``std * n^(-1/5)``. The values are first spread over the nodes of a fine grid by linear binning: each gives
    its two neighbours shares that keep its mass and its place. A kernel of bandwidth ``h`` has a second derivative of at
    most ``1 / (sqrt(2 pi) h^3)``, so with nodes ``d`` apart the density per value differs by at most ``d^2 / (8 sqrt(2 pi)
    h^3)`` from the sum over all values. That is ``(d / h)^2 / 8`` of the kernel's peak. Without ``fine_bins`` the grid is
    chosen to keep that below ``DENSITY_ERROR``; ``h`` shrinks with ``n^(-1/5)`` only, and nodes that no value is near take
    no part, so a few values far out do not matter.
    """
    numbers = _numbers(df, column)
    extent = _extent(numbers)
    if not extent.std:
        raise ValueError(f"{column} has no spread, so it has no density")
    width = extent.std * extent.n**-0.2
    span = extent.high - extent.low
    nodes = fine_bins or max(math.ceil(span / (width * math.sqrt(8 * DENSITY_ERROR))), 1)
    step = span / (points - 1)
    at_node = (F.col("x") - F.lit(extent.low)) / F.lit(span) * nodes
    lower = F.least(F.floor(at_node), F.lit(nodes - 1))
    share = at_node - lower
    shares = F.array(
        F.struct(lower.alias("node"), (1 - share).alias("w")), F.struct((lower + 1).alias("node"), share.alias("w"))
    )
    weighted = _finite(numbers).select(F.inline(shares)).groupBy("node").agg(F.sum("w").alias("w"))
    spread = weighted.select("w", "node", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    at = F.lit(extent.low) + F.lit(step) * F.col("point")
    z = (at - (F.lit(extent.low) + F.lit(span) * F.col("node") / nodes)) / F.lit(width)
    scale = span / bins / (width * math.sqrt(2 * math.pi))
    return (
        spread.groupBy("point")
        .agg(F.sum(F.col("w") * F.exp(-0.5 * z * z)).alias("k"))
        .select("point", at.alias("x"), (F.col("k") * F.lit(scale)).alias("density"))
    )


def pair_lengths(
    pairs: DataFrame,
    composer: PromptComposer,
    counter: TokenCounter,
    src_lang: str,
    trg_lang: str,
    subsample: int | None = None,
    seed: int = 42,
) -> DataFrame:
    """``prompt_length``: mean token count of both rendered directions; ``raw_length``: tokens of both texts.

    Of all complete pairs, or of a seeded sample of ``subsample`` of them.
    """
    complete = seeded_subsample(pairs.dropna(subset=["src_text", "trg_text"]), "pair_id", subsample, seed)
    rendered = render_both(complete, composer, src_lang, trg_lang)
    return rendered.select(
        "pair_id",
        ((counter(F.col("prompt_fwd")) + counter(F.col("prompt_bwd"))) / 2).alias("prompt_length"),
        (counter(F.col("src_text")) + counter(F.col("trg_text"))).alias("raw_length"),
    )
