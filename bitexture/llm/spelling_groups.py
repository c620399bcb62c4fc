"""Spelling variants: words one letter apart, found with a bit-sliced position index over the vocabulary.

**Vocabulary.** Tasks count the words of whole texts; equal words meet in one aggregate.

**Buckets.** Of two words one edit apart, the shorter one of ``n`` letters, the first ``n // 2`` or the last ``n - n // 2`` letters
agree. Every word is therefore filed under both ends, once as the shorter word of a pair and once as the longer one. A bucket
with more than ``CROWD`` words is filed again by what lies between the ends it shares, until at most two letters are left
open, which bounds its words by the square of the alphabet. A pair belongs to one bucket: where the fronts agree, the front's.

**Index.** The words of many buckets lie side by side, 64 to a lane. For each open position and letter a lane has the bits of
the words with that letter there. A query reads its letters in turn and keeps, for the 64 words of a lane at once, which
match so far without an error and which with one: a replaced letter reads on at the same position, an extra letter of the word
one further, an extra letter of the query one back. All queries of a block advance together.

**Groups.** A word's form is its most frequent neighbour, if frequent enough. Frequencies at least double from form to form, so
chains are no longer than the logarithm of the largest count, and pointer doubling ends them in the logarithm of that.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitexture.llm.common import staged

MIN_LETTERS = 5
MIN_COUNT = 3
FORM_RATIO = 2
CROWD = 4_096
COUNTED_WORDS = 500_000
BLOCK_LETTERS = 200_000
QUERY_ROWS = 500_000
LANE = 64
BUCKET = ["cls", "path", "agreed"]


def _damaged(doc: str, word: str, seed: int, every: int) -> str:
    """The word without one letter if its checksum, continued from ``seed``, is a multiple of ``every``."""
    h = zlib.crc32(word.encode(), seed)
    return word if h % every else word[: h % len(word)] + word[h % len(word) + 1 :]


def _table(total: Counter[str]) -> pd.DataFrame:
    return pd.DataFrame({"word": _strings(total), "n": np.fromiter(total.values(), np.int64, len(total))})


def _strings(values: Iterable[str]) -> pd.Series:
    return pd.Series(list(values), dtype=object)


def _counted(min_letters: int, every: int | None):
    run = re.compile("[a-zÀ-ÿ]{%d,}" % min_letters)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter[str] = Counter()
        for batch in batches:
            for doc, text in zip(batch["doc"], batch["text"]):
                if text is None:
                    continue
                found = Counter(run.findall(text.encode().lower().decode()))  # bytes lower A-Z only
                if every:
                    seed = zlib.crc32(f"{doc or ''}:".encode())
                    for word, n in found.items():
                        total[_damaged(doc, word, seed, every)] += n
                else:
                    total.update(found)
            if len(total) > COUNTED_WORDS:
                yield _table(total)
                total = Counter()
        yield _table(total)

    return counted


def vocabulary(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_letters: int = MIN_LETTERS,
    min_count: int = MIN_COUNT,
    drop_letter_every: int | None = None,
) -> DataFrame:
    """``(word, n)``: words of at least ``min_letters`` letters that occur ``min_count`` times in all texts."""
    texts = docs.select(F.col(id_col).cast("string").alias("doc"), F.col(text_col).alias("text"))
    parts = texts.mapInPandas(_counted(min_letters, drop_letter_every), "word string, n bigint")
    words = parts.where(F.length("word") >= min_letters).groupBy("word").agg(F.sum("n").alias("n"))
    return words.where(F.col("n") >= min_count)


def _filed(rows: DataFrame) -> DataFrame:
    """Every row under the front and under the back half of its open letters."""
    open_letters = F.col("cls") - F.col("skip") - F.col("tail")
    half = F.floor(open_letters / 2).cast("int")
    front = F.struct(F.lit("f").alias("side"), (F.col("skip") + half).alias("skip"), F.col("tail").alias("tail"))
    back = F.struct(F.lit("b").alias("side"), F.col("skip").alias("skip"), (F.col("tail") + open_letters - half).alias("tail"))
    both = rows.select("word", "n", "cls", "path", F.explode(F.array(front, back)).alias("to"))
    filed = both.select("word", "n", "cls", F.concat("path", "to.side").alias("path"), "to.skip", "to.tail")
    ends = F.concat(F.expr("left(word, skip)"), F.expr("right(word, tail)"))
    return filed.withColumn("agreed", ends)


def buckets(words: DataFrame, min_letters: int = MIN_LETTERS, crowd: int = CROWD) -> DataFrame:
    """``(word, n, cls, path, skip, tail, agreed)``: ``cls`` is the length of the shorter word of the pairs looked for, ``path`` which
    halves agree, ``skip`` and ``tail`` how many letters in front and behind do."""
    length = F.length("word")
    classes = F.filter(F.array(length, length - 1), lambda n: n >= min_letters)
    rows = words.select("word", "n", F.explode(classes).alias("cls"), F.lit("").alias("path"), F.lit(0).alias("skip"), F.lit(0).alias("tail"))
    rows, done = staged(_filed(rows), "filed"), []
    while True:
        open_letters = F.col("cls") - F.col("skip") - F.col("tail")
        sizes = rows.where(open_letters > 1).groupBy(*BUCKET).agg(F.count("*").alias("size"))
        crowded = staged(sizes.where(F.col("size") > crowd).select(*BUCKET), "crowded")
        if crowded.isEmpty():
            break
        done.append(rows.join(crowded, BUCKET, "left_anti").select(rows.columns))
        rows = staged(_filed(rows.join(crowded, BUCKET, "left_semi")), "filed")
    for part in done:
        rows = rows.unionByName(part)
    return rows


def _lanes(first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per query with the words ``first <= i < end`` the lanes of these: number of the query, lane, bits of its words."""
    low, high = first // LANE, (end - 1) // LANE
    n = high - low + 1
    query = np.repeat(np.arange(len(first)), n)
    lane = low[query] + np.arange(len(query)) - np.repeat(np.cumsum(n) - n, n)
    every = np.uint64(2**64 - 1)
    above = np.maximum(first[query] - lane * LANE, 0).astype(np.uint64)
    below = (LANE - np.minimum(end[query] - lane * LANE, LANE)).astype(np.uint64)
    return query, lane, (every >> below) & (every << above)


class PositionIndex:
    """Bits of the words of a block per (position, letter), and the search for words one error away."""

    def __init__(self, rests: list[str], shorter: int):
        """``rests`` have ``shorter`` letters or one more."""
        width = shorter + 1
        letters = np.frombuffer("".join(r.ljust(width, "\0") for r in rests).encode("utf-32-le"), np.uint32)
        known, codes = np.unique(np.r_[np.uint32(0), letters], return_inverse=True)
        self.codes, self.shorter = codes[1:].reshape(len(rests), width), shorter
        at = np.arange(len(rests))
        bit = np.uint64(1) << (at % LANE).astype(np.uint64)
        lanes = -(-len(rests) // LANE)
        # One position before the first and one after the last, where no word has a letter.
        self.bits = np.zeros((width + 2, len(known), lanes), np.uint64)
        for i in range(width):
            np.bitwise_or.at(self.bits[i + 1], (self.codes[:, i], at // LANE), bit)
        self.bits[:, 0] = 0
        self.is_short = self.codes[:, shorter] == 0
        self.short = np.zeros(lanes, np.uint64)
        np.bitwise_or.at(self.short, at[self.is_short] // LANE, bit[self.is_short])

    def near(self, queries: np.ndarray, lane: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """For queries of one length, the bits of the words one error away. Longer queries find shorter words only."""
        short = bool(self.is_short[queries[0]])
        none = mask.copy()
        replaced, extra, lacking = np.zeros((3, len(mask)), np.uint64)
        for i in range(self.shorter + (not short)):
            letter = self.codes[queries, i]
            back, here, ahead = (self.bits[i + k, letter, lane] for k in range(3))
            extra = (extra | none) & ahead
            lacking = (lacking & back) | none
            replaced = (replaced & here) | (none & ~here)
            none = none & here
        extra |= none
        shorter = self.short[lane]
        return (replaced & shorter) | (extra & ~shorter) if short else lacking & shorter

    def pairs(self, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (query, word) one error apart, each query among the words ``first <= i < end`` of its bucket."""
        found = [np.zeros((2, 0), np.int64)]
        for group in (np.flatnonzero(self.is_short), np.flatnonzero(~self.is_short)):
            start = 0
            n_lanes = np.cumsum((end[group] - 1) // LANE - first[group] // LANE + 1)
            while start < len(group):
                done = n_lanes[start - 1] if start else 0
                stop = max(int(np.searchsorted(n_lanes, done + QUERY_ROWS, side="right")), start + 1)
                part = group[start:stop]
                query, lane, mask = _lanes(first[part], end[part])
                query = part[query]
                hits = self.near(query, lane, mask)
                some = np.flatnonzero(hits)
                spots = np.unpackbits(hits[some].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                row, bit = np.nonzero(spots)
                found.append(np.stack([query[some[row]], lane[some[row]] * LANE + bit]))
                start = stop
        return tuple(np.concatenate(found, axis=1))


def canonical_path(a: str, b: str, depth: int) -> str:
    """The bucket path of a pair: at each level the front half if it agrees, otherwise the back half."""
    if len(a) > len(b):
        a, b = b, a
    path = ""
    while len(path) < depth:
        half = len(a) // 2
        if a[:half] == b[:half]:
            path, a, b = path + "f", a[half:], b[half:]
        else:
            keep = len(a) - half
            path, a, b = path + "b", a[: len(a) - keep], b[: len(b) - keep]
    return path


def _searched(block: pd.DataFrame) -> pd.DataFrame:
    """Neighbours of the words of whole buckets that share class and path."""
    words, counts = block["word"].tolist(), block["n"].to_numpy()
    cls, path, skip, tail = (block[c].iloc[0] for c in ("cls", "path", "skip", "tail"))
    agreed = block["agreed"].to_numpy()
    new = np.flatnonzero(np.r_[True, agreed[1:] != agreed[:-1]])
    size = np.diff(np.r_[new, len(words)])
    index = PositionIndex([w[skip : len(w) - tail] for w in words], int(cls - skip - tail))
    query, word = index.pairs(np.repeat(new, size), np.repeat(new + size, size))
    if "b" in path and len(query):  # an extra letter between the halves agrees in front and behind
        own = [canonical_path(words[q], words[w], len(path)) == path for q, w in zip(query.tolist(), word.tolist())]
        query, word = query[own], word[own]
    order = np.lexsort((word, -counts[word], query))  # the words of a bucket are in order
    query, word = query[order], word[order]
    lead = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else np.zeros(0, np.int64)
    best = word[lead]
    return pd.DataFrame(
        {
            "word": _strings(words[i] for i in query[lead]),
            "n_near": np.diff(np.r_[lead, len(query)]),
            "best_n": counts[best],
            "best": _strings(words[i] for i in best),
        }
    )


def _neighbours(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come ordered by bucket. The last bucket of a batch waits for the next one."""
    rest = None
    for batch in batches:
        rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        starts = _bucket_starts(rows)
        yield from _blocks(rows.iloc[: starts[-1]] if len(starts) else rows, starts[:-1])
        rest = rows.iloc[starts[-1] :] if len(starts) else None
    if rest is not None and len(rest):
        yield from _blocks(rest.reset_index(drop=True), np.zeros(1, np.int64))


def _bucket_starts(rows: pd.DataFrame) -> np.ndarray:
    if not len(rows):
        return np.zeros(0, np.int64)
    changed = np.zeros(len(rows), bool)
    changed[0] = True
    for c in BUCKET:
        values = rows[c].to_numpy()
        changed[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(changed)


def _blocks(rows: pd.DataFrame, starts: np.ndarray) -> Iterator[pd.DataFrame]:
    """Buckets with company, those of one class and path together, in blocks of about ``BLOCK_LETTERS`` letters."""
    size = np.diff(np.r_[starts, len(rows)])
    company = np.flatnonzero(np.repeat(size > 1, size))
    if not len(company):
        return
    rows = rows.iloc[company].reset_index(drop=True)
    kind = rows["cls"].astype(str) + rows["path"]
    for _, same in rows.groupby(kind, sort=False):
        limit = max(BLOCK_LETTERS // (int(same["cls"].iloc[0]) + 1), 1)
        agreed = same["agreed"].to_numpy()
        cuts, start = np.flatnonzero(np.r_[True, agreed[1:] != agreed[:-1]]), 0
        while start < len(same):
            after = cuts[np.searchsorted(cuts, start + limit) :]
            stop = int(after[0]) if len(after) else len(same)
            yield _searched(same.iloc[start:stop])
            start = stop


def _with_roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` from ``(word, form)``: the end of the chain of forms, by pointer doubling."""
    roots = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        beyond = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = staged(roots.join(beyond, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.isnotnull("next").alias("moved")), "roots")
        roots = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return roots


def spelling_groups(words: DataFrame, ratio: int = FORM_RATIO, min_letters: int = MIN_LETTERS, crowd: int = CROWD) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of a vocabulary ``(word, n)`` of distinct words with at least ``min_letters`` letters.

    Two words are near if exactly one inserted, deleted or replaced letter lies between them. The form of a word is its
    near word with the largest ``n``, ties to the first in code-point order, if that is at least ``ratio`` times its own
    (``ratio`` above 1); the root follows the forms to the last.

    In ``vocabulary`` a missing text has no words and a missing id counts as an empty one. Texts and words of any length are
    handled. Equal rows count as often as they are there. An empty table gives an empty table; other columns play no part.
    """
    words = staged(words.select("word", "n"), "words")
    filed = buckets(words, min_letters, crowd).repartition(*BUCKET).sortWithinPartitions(*BUCKET, "word")
    near = filed.mapInPandas(_neighbours, "word string, n_near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("form"))).alias("best")
    near = near.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    found = staged(words.join(near.hint("merge"), "word", "left"), "near")
    apt = -F.col("best.less") >= ratio * F.col("n")
    found = found.select(
        "word",
        F.when(apt, F.col("best.form")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(apt, -F.col("best.less")).alias("form_n"),
    )
    roots = _with_roots(found.where("form is not null"))
    joined = found.join(roots.hint("merge"), "word", "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
