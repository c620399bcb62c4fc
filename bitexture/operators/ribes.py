"""Rank correlation of word order per sentence.

A hypothesis unit is aligned through the shortest context that occurs exactly once on both sides, growing to the
right or to the left. Contexts of all positions are compared through prefix ranks of doubling length, for a whole
Arrow batch at once, so a row costs O(n log n) whatever its length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitexture.operators.ngrams import by_example

ALPHA = 0.25
BETA = 0.10


def _prefix_ranks(codes: np.ndarray) -> list[np.ndarray]:
    """ranks[k][i] identifies the 2^k units that start at i; texts end in units that occur nowhere else."""
    ranks = [np.unique(codes, return_inverse=True)[1]]
    while ranks[-1].max(initial=-1) + 1 < len(codes):
        span = 1 << (len(ranks) - 1)
        low = ranks[-1]
        beyond = np.zeros(min(span, len(low)), dtype=np.int64)
        follow = np.concatenate([low[span:] + 1, beyond])
        ranks.append(np.unique(low * (len(codes) + 1) + follow, return_inverse=True)[1])
    return ranks


def _common_prefix(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at a and b (positions below 0 share nothing)."""
    n = len(ranks[0])
    length = np.zeros(len(a), dtype=np.int64)
    alive = (a >= 0) & (b >= 0)
    for k in range(len(ranks) - 1, -1, -1):
        x, y = a + length, b + length
        ok = alive & (x < n) & (y < n)
        same = np.zeros(len(a), dtype=bool)
        same[ok] = ranks[k][x[ok]] == ranks[k][y[ok]]
        length[same] += 1 << k
    return length


def _nearest(is_member: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted places of the nearest and second nearest member before (+1) or after (-1) every place, or -1."""
    n = len(is_member)
    view = slice(None) if step > 0 else slice(None, None, -1)
    member = is_member[view]
    places = np.flatnonzero(member)
    upto = np.concatenate([[0], np.cumsum(member)])[:-1]

    def pick(back: int) -> np.ndarray:
        index = upto - back
        found = np.where(index >= 0, places[np.maximum(index, 0)] if len(places) else -1, -1)
        found = np.where(found >= 0, found if step > 0 else n - 1 - found, -1)
        return found[view]

    return pick(1), pick(2)


def _shortest_unique(codes: np.ndarray, is_hyp: np.ndarray, is_ref: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per hypothesis position: shortest context length unique on both sides (0 if none), and its place in the
    reference. A context of length n is unique in the hypothesis when n exceeds the longest prefix shared with
    another position there; in the reference when n lies between the second longest and the longest prefix shared.
    """
    ranks = _prefix_ranks(codes)
    place_of = ranks[-1]
    order = np.argsort(place_of, kind="stable")
    positions = np.flatnonzero(is_hyp)

    def longest(member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        best = np.zeros(len(positions), dtype=np.int64)
        second, where = best.copy(), best.copy() - 1
        for step in (1, -1):
            for place in _nearest(member[order], step):
                place = place[place_of[positions]]
                other = np.where(place >= 0, order[np.maximum(place, 0)], -1)
                common = _common_prefix(ranks, positions, other)
                better = common > best
                second = np.where(better, best, np.maximum(second, common))
                where = np.where(better, other, where)
                best = np.maximum(best, common)
        return best, second, where

    own, _, _ = longest(is_hyp)
    best_ref, second_ref, where = longest(is_ref)
    length = np.maximum(own, second_ref) + 1
    usable = length <= best_ref
    lengths = np.zeros(len(codes), dtype=np.int64)
    places = lengths - 1
    lengths[positions[usable]], places[positions[usable]] = length[usable], where[usable]
    return lengths, places


def _unit_codes(texts: list, unit: str) -> np.ndarray:
    if unit == "char":
        return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    return pd.factorize(np.array([w for t in texts for w in t], dtype=object))[0].astype(np.int64)


def batch_ribes(hypotheses: list, references: list, unit: str = "char") -> np.ndarray:
    """RIBES of aligned hypotheses and references: strings for characters, word lists for words."""
    scores = np.zeros(len(hypotheses))
    hl = np.array([len(h) for h in hypotheses], dtype=np.int64)
    rl = np.array([len(r) for r in references], dtype=np.int64)
    if not len(hl):
        return scores
    code = _unit_codes([t for pair in zip(hypotheses, references) for t in pair], unit)
    sizes = np.stack([hl, rl], axis=1).ravel()
    text_of = np.repeat(np.arange(len(sizes)), sizes)
    row = text_of // 2
    # Give every row its own alphabet and close every text with a unit of its own.
    width = code.max(initial=0) + 1
    total = int(sizes.sum()) + len(sizes)
    ends = np.cumsum(sizes + 1) - 1
    is_end = np.zeros(total, dtype=bool)
    is_end[ends] = True
    codes = np.empty(total, dtype=np.int64)
    codes[~is_end] = row * width + code
    codes[is_end] = len(hl) * width + np.arange(len(sizes))
    text = np.empty(total, dtype=np.int64)
    text[~is_end], text[is_end] = text_of, np.arange(len(sizes))
    hyp, ref = ~is_end & (text % 2 == 0), ~is_end & (text % 2 == 1)
    starts = ends - sizes

    right, right_at = _shortest_unique(codes, hyp, ref)
    left, left_at = _shortest_unique(codes[::-1], hyp[::-1], ref[::-1])
    left, left_at = left[::-1], np.where(left_at[::-1] >= 0, total - 1 - left_at[::-1], -1)

    i = np.arange(total) - starts[text]
    # The search stops one short of the whole left context when that is the longer side.
    left = np.where((left == i + 1) & (i > 0) & (2 * i > np.repeat(hl, 2)[text]), 0, left)
    use_right = (right > 0) & ((left == 0) | (right <= left))
    aligned = use_right | (left > 0)
    at = np.where(use_right, right_at, left_at) - np.repeat(starts[1::2], 2)[text]

    owner, rank = (text // 2)[aligned], at[aligned]
    count = np.bincount(owner, minlength=len(hl))
    follows = (owner[1:] == owner[:-1]) & (rank[1:] == rank[:-1] + 1) if len(owner) else np.zeros(0, dtype=bool)
    # Runs of consecutive positions: a run of length s holds s(s-1)/2 increasing pairs.
    run = np.cumsum(np.concatenate([[0], ~follows])) if len(owner) else np.zeros(0, dtype=np.int64)
    run_size = np.bincount(run) if len(owner) else np.zeros(0, dtype=np.int64)
    run_owner = owner[np.concatenate([[True], ~follows])] if len(owner) else owner
    pairs = np.bincount(run_owner, weights=run_size * (run_size - 1) / 2, minlength=len(hl))
    enough = (count >= 2) & (hl > 0)
    possible = count[enough] * (count[enough] - 1) / 2
    coverage = (count[enough] / hl[enough]) ** ALPHA
    brevity = np.minimum(1.0, np.exp(1.0 - rl[enough] / hl[enough])) ** BETA
    scores[enough] = pairs[enough] / possible * coverage * brevity
    return scores


def _chunked(hypotheses: list, references: list, unit: str, units_per_chunk: int = 50_000) -> np.ndarray:
    """Bound the working memory of a batch; a row is never cut."""
    ends = np.cumsum([len(h) + len(r) for h, r in zip(hypotheses, references)])
    edges = np.flatnonzero(np.diff(ends // units_per_chunk, prepend=0)).tolist()
    edges = [0, *[e for e in edges if e], len(ends)]
    parts = [batch_ribes(hypotheses[a:b], references[a:b], unit) for a, b in zip(edges, edges[1:])]
    return np.concatenate(parts)


def sentence_ribes(examples: DataFrame, unit: str = "char", tasks: int | None = None) -> DataFrame:
    """Add ``ribes`` to every example, spread over ``tasks`` if given. An empty hypothesis scores 0."""

    def cut(texts: pd.Series) -> list:
        whole = texts.fillna("").tolist()
        return whole if unit == "char" else [re.findall(r"\S+", t, re.ASCII) for t in whole]

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for hypotheses, references in batches:
            yield pd.Series(_chunked(cut(hypotheses), cut(references), unit))

    placed = examples if tasks is None else by_example(examples, tasks)
    return placed.withColumn("ribes", score("predictions", "outputs"))
