"""Mixing sources to target weights by iterative proportional fitting.

Token counts form a table of cells: source, language and topic, each folded into the categories that have a target and
one for the rest, so the table is bounded by the targets. The cells are raked until every marginal has its target share.
Weights become sampling probabilities of a given share of all tokens; where a cell would need more than it has,
its probability stops at 1 and the raking goes on with the other cells. A document is drawn by a number made
from its id.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitexture.functions.hashing import HASH_SPAN, seeded_hash
from bitexture.llm.common import staged

REST = "(rest)"
MAX_CATEGORIES = 10_000  # per marginal
MAX_CELLS = 1_000_000  # of all marginals together: the bound of the table that is fitted and broadcast
ROUNDS = 200
TOLERANCE = 1e-6
SEED = 23
SHARE_TOLERANCE = 0.005  # how far a reached share may be from its target if the budget is derived
LEAST_BUDGET = 0.05  # a derived budget is not below this, whatever the targets

# Fixed values of the topic rule, tried in this order.
TOPICS = [
    ("legal", r"(?i)licen[sc]e|copyright|all rights reserved"),
    ("contact", r"(?<![\w.])[\w.]++@\w++\.\w|https?://|\+\d[\d (-]{6,}"),
    ("tabular", r" \| .* \| "),
]


def topic_of(text: Column) -> Column:
    """A coarse topic by the first pattern that occurs."""
    topic = F.lit("prose")
    for name, pattern in reversed(TOPICS):
        topic = F.when(text.rlike(pattern), F.lit(name)).otherwise(topic)
    return F.coalesce(topic, F.lit("prose"))


def token_count(text: Column) -> Column:
    """Words of a text; 0 if it is missing."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


@dataclass(frozen=True)
class Raked:
    """Result of the fitting: keep probability per cell, and the shares that a sample has in expectation."""

    probability: np.ndarray
    shares: list[np.ndarray]
    budget: float


def _shares(cells: np.ndarray, axis: int) -> np.ndarray:
    sums = cells.sum(axis=tuple(a for a in range(cells.ndim) if a != axis))
    return sums / max(sums.sum(), 1e-300)


def fit(cells: np.ndarray, targets: list[np.ndarray]) -> np.ndarray:
    """Rake a table to target shares of its marginals; categories without tokens give their share to the others."""
    fitted = cells / max(cells.sum(), 1e-300)
    for _ in range(ROUNDS):
        worst = 0.0
        for axis, target in enumerate(targets):
            now = _shares(fitted, axis)
            wanted = np.where(now > 0, target, 0)
            wanted = wanted / wanted.sum() if wanted.sum() else now
            factor = np.where(now > 0, wanted / np.where(now > 0, now, 1), 0)
            worst = max(worst, float(np.abs(now - wanted).max(initial=0)))
            fitted = fitted * factor.reshape([-1 if a == axis else 1 for a in range(cells.ndim)])
        if worst < TOLERANCE:
            break
    return fitted


def calibrate(cells: np.ndarray, targets: list[np.ndarray], budget: float) -> Raked:
    """Probabilities at most 1 whose expected tokens come to ``budget`` times all tokens and meet the targets.

    Cells that reach 1 are fixed there and taken out of the targets, and the rest is raked again.
    """
    total = cells.sum()
    probability = np.zeros_like(cells)
    full = np.zeros(cells.shape, bool)
    for _ in range(cells.size):
        free = np.where(full, 0, cells)
        left = budget * total - cells[full].sum()
        if left <= 0 or not free.any():
            break
        remaining = [
            np.maximum(target * budget * total - _shares(np.where(full, cells, 0), a) * cells[full].sum(), 0)
            for a, target in enumerate(targets)
        ]
        remaining = [r / r.sum() if r.sum() else _shares(free, a) for a, r in enumerate(remaining)]
        wanted = fit(free, remaining)
        wanted = wanted * left / max(wanted.sum(), 1e-300)
        probability = np.where(free > 0, wanted / np.where(free > 0, free, 1), 0)
        over = (probability > 1) & ~full
        if not over.any():
            break
        full |= over
    probability = np.where(full, 1.0, np.minimum(probability, 1.0))
    return Raked(probability, [_shares(cells * probability, a) for a in range(cells.ndim)], budget)


def _reachable(cells: np.ndarray, targets: list[np.ndarray]) -> list[np.ndarray]:
    """Targets with the shares of categories without tokens given to the others."""
    found = [np.where(_shares(cells, a) > 0, t, 0) for a, t in enumerate(targets)]
    return [f / f.sum() if f.sum() else _shares(cells, a) for a, f in enumerate(found)]


def largest_budget(cells: np.ndarray, targets: list[np.ndarray], tolerance: float = SHARE_TOLERANCE) -> float:
    """The largest budget, to a hundredth of itself, at which every reached share is within ``tolerance`` of its target.

    A category with too few tokens bounds it; below ``LEAST_BUDGET`` it is that, and such categories miss their target.
    """
    wanted = _reachable(cells, targets)

    def met(budget: float) -> bool:
        reached = calibrate(cells, targets, budget).shares
        return all(np.abs(r - w).max(initial=0) <= tolerance for r, w in zip(reached, wanted))

    # No share can be met beyond this, as its category would need more tokens than it has.
    least = [np.maximum(w - tolerance, 0) for w in wanted]
    bounds = [_shares(cells, a)[x > 0] / x[x > 0] for a, x in enumerate(least)]
    high = min([1.0, *(float(b.min()) for b in bounds if b.size)])
    if not cells.any() or high <= LEAST_BUDGET or not met(LEAST_BUDGET):
        return 1.0 if not cells.any() else LEAST_BUDGET
    if met(high):
        return high
    low = LEAST_BUDGET
    while high - low > 0.01 * low:
        middle = (low + high) / 2
        low, high = (middle, high) if met(middle) else (low, middle)
    return low


def _folded(column: Column, targets: Mapping[str, float]) -> Column:
    """A category with a target as it is, any other and a missing one as the rest."""
    return F.when(column.isin(list(targets)), column).otherwise(F.lit(REST))


def _wanted(target: Mapping[str, float], levels: list[str], natural: np.ndarray) -> np.ndarray:
    """Target shares of all categories; a rest without an entry has its natural share."""
    share = np.array([float(target.get(c, 0.0)) for c in levels])
    if REST not in target:
        rest = natural[-1] if share.sum() and natural[:-1].any() else 1.0
        share = share * (1 - rest) / max(share.sum(), 1e-300)
        share[-1] = rest
    return share / share.sum() if share.sum() else share


def _fitted(
    docs: DataFrame,
    targets: Mapping[str, Mapping[str, float]],
    categories: Mapping[str, Column],
    id_col: str,
    text_col: str,
    budget: float | None,
    row_col: str | None = None,
) -> tuple[DataFrame, dict[str, list[str]], np.ndarray, list[np.ndarray], Raked]:
    """The sized documents, the categories of each marginal, the cells, the target shares and the fitted probabilities."""
    names = list(targets)
    levels = {}
    for name in names:
        if len(targets[name]) > MAX_CATEGORIES:
            raise ValueError(f"{name} has more than {MAX_CATEGORIES} targets")
        levels[name] = [*(c for c in targets[name] if c != REST), REST]
    n_cells = math.prod(len(c) for c in levels.values())
    if n_cells > MAX_CELLS:
        raise ValueError(f"the targets make {n_cells} cells; the bound is {MAX_CELLS}")
    sized = docs.select(
        F.col(id_col).alias("doc"),
        (F.lit(None).cast("bigint") if row_col is None else F.col(row_col)).alias("row"),
        *(_folded(categories[name], targets[name]).alias(name) for name in names),
        token_count(F.col(text_col)).alias("n_tokens"),
    )
    sized = staged(sized, "sized")
    cells = np.zeros([len(levels[name]) for name in names])
    for row in sized.groupBy(*names).agg(F.sum("n_tokens").alias("n")).collect():  # bounded by the targets
        cells[tuple(levels[n].index(row[n]) for n in names)] = row["n"]
    wanted = [_wanted(targets[n], levels[n], _shares(cells, axis)) for axis, n in enumerate(names)]
    raked = calibrate(cells, wanted, largest_budget(cells, wanted) if budget is None else budget)
    return sized, levels, cells, wanted, raked


def mix_shares(
    docs: DataFrame,
    targets: Mapping[str, Mapping[str, float]],
    categories: Mapping[str, Column],
    id_col: str = "doc_id",
    text_col: str = "text",
    budget: float | None = 0.5,
) -> DataFrame:
    """One row per marginal and category: its ``natural``, ``target`` and ``reached`` token share, and the ``budget``.

    ``reached`` is what the probabilities of ``mix_to_targets`` with the same arguments give in expectation.
    """
    _, levels, cells, wanted, raked = _fitted(docs, targets, categories, id_col, text_col, budget)
    rows = [
        (name, c, *(float(x[i]) for x in (_shares(cells, axis), wanted[axis], raked.shares[axis])), float(raked.budget))
        for axis, name in enumerate(levels)
        for i, c in enumerate(levels[name])
    ]
    shape = "marginal string, category string, natural double, target double, reached double, budget double"
    return docs.sparkSession.createDataFrame(rows, shape)


def mix_to_targets(
    docs: DataFrame,
    targets: Mapping[str, Mapping[str, float]],
    categories: Mapping[str, Column],
    id_col: str = "doc_id",
    text_col: str = "text",
    budget: float | None = 0.5,
    seed: int = SEED,
    row_col: str | None = None,
) -> DataFrame:
    """One row per input row: id, ``row_col`` as it was, the folded category of each marginal, ``n_tokens``, ``weight`` (raked share over the
    natural one), ``probability``, ``kept``.

    ``targets`` has per marginal the wanted token share of its categories. A category that is not named, or missing, belongs
    to the rest. A ``(rest)`` entry is its target, and all are scaled to 1; without one the rest keeps the share of tokens
    that it has, and the named targets are scaled to what is left. ``categories`` has the column
    of each marginal. ``budget`` is the share of all tokens to keep; None takes the largest that meets the targets, see
    ``largest_budget``, and ``mix_shares`` tells which shares are reached. A document is kept if its hash lies below the probability of its cell, so decisions do not depend on
    the partitioning and rows with one id share theirs; texts of any length are read whole; a missing id is a key like any other. Documents without tokens
    have the probability of their cell; a cell without tokens has 0. An empty table gives an empty table.
    """
    sized, levels, cells, _, raked = _fitted(docs, targets, categories, id_col, text_col, budget, row_col)
    names, shape = list(levels), cells.shape
    expected = cells * raked.probability
    scale = max(expected.sum(), 1e-300) / max(cells.sum(), 1e-300)
    rows = [
        (*(levels[n][i] for n, i in zip(names, at)), float(raked.probability[at] / scale), float(raked.probability[at]))
        for at in np.ndindex(*shape)
        if cells[at] > 0
    ]
    kinds = ", ".join(f"{n} string" for n in names) + ", weight double, probability double"
    table = docs.sparkSession.createDataFrame(rows, kinds)
    drawn = sized.join(F.broadcast(table), names, "left")  # one row per cell
    drawn = drawn.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("weight", "probability")})
    number = seeded_hash(F.coalesce(F.col("doc").cast("string"), F.lit("")), seed) / HASH_SPAN
    return drawn.select(
        F.col("doc").alias(id_col), *([F.col("row").alias(row_col)] if row_col else []), *names, "n_tokens", "weight", "probability", (number < F.col("probability")).alias("kept")
    )


def even_targets(values: Iterable[str]) -> dict[str, float]:
    values = list(values)
    return {v: 1 / len(values) for v in values}


# The mix of the registered query and the pipeline.
TARGETS = {
    "source": even_targets(f"src{i}" for i in range(20)),
    "lang": {"en": 0.55, "de": 0.17, "fr": 0.17, "es": 0.11},
    "topic": {"prose": 0.84, "legal": 0.03, "contact": 0.08, "tabular": 0.05},
}


def standard_categories() -> dict[str, Column]:
    return {"source": F.col("source"), "lang": F.col("lang"), "topic": topic_of(F.col("text"))}


def standard_mix(docs: DataFrame, budget: float | None, row_col: str | None = None) -> DataFrame:
    return mix_to_targets(docs, TARGETS, standard_categories(), budget=budget, row_col=row_col)


def standard_shares(docs: DataFrame, budget: float | None) -> DataFrame:
    return mix_shares(docs, TARGETS, standard_categories(), budget=budget)
