"""Quality selection by importance resampling.

Two multinomials over hashed n-grams, one of trusted target documents and one of the raw corpus, give every document a
log ratio. A Gumbel variable from the row's key is added, and the documents with the ``k`` largest sums are a sample
without replacement in proportion to the ratio. The ``k`` largest are a filter at an exact cut, not a sort.

n-grams are taken over words and over the shape of the text: the class of every word, punctuation as it stands, and a
mark for a word that repeats the one before or ends a word triple the document has had already. Shapes are few, so
their buckets stay sharp however large the corpus is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitexture.functions.hashing import HASH_SPAN, seeded_hash
from bitexture.llm.common import MULTIPLIER, id_sample, mixed, staged
from bitexture.operators.selection import among_top, row_count

BUCKETS = 1 << 11  # few enough to be well filled by small corpora, so that documents outside the target score alike
TARGET_DOCS = 20_000  # bound of the labelled sample
HELD_OUT = 4  # one in so many of the labelled good documents sets the cut instead of fitting the target
LOSS_WEIGHT = 10  # a share of good documents lost counts as much as ten times that share of bad ones passed
SMOOTHING = 1.0
SEED = 17
SHAPE_SEED = 1
TOKENS = re.compile(r"\w+|[^\w\s]+")
REPEAT, SEEN = 2, 3  # shapes that no token hash equals


def _kind(token: str) -> str:
    if token.isdigit():
        return "0"
    if token.isupper() and len(token) > 1:
        return "A"
    return "a"


def _hashes(tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens in lower case, and of their shapes."""
    words = np.fromiter((xxhash.xxh64_intdigest(t.lower()) for t in tokens), np.uint64, len(tokens))
    is_word = np.fromiter((t[0].isalnum() or t[0] == "_" for t in tokens), bool, len(tokens))
    shapes = np.fromiter(
        (xxhash.xxh64_intdigest(_kind(t) if w else t[:4], SHAPE_SEED) for t, w in zip(tokens, is_word)),
        np.uint64,
        len(tokens),
    )
    at = np.flatnonzero(is_word)
    own = words[at]
    if len(own) > 2:
        triples = mixed((own[:-2] * MULTIPLIER + own[1:-1]) * MULTIPLIER + own[2:])
        order = np.argsort(triples, kind="stable")
        again = np.zeros(len(triples), bool)
        again[order[1:]] = triples[order[1:]] == triples[order[:-1]]
        shapes[at[2:][again]] = SEEN
    if len(own) > 1:
        shapes[at[1:][own[1:] == own[:-1]]] = REPEAT
    return words, shapes


def gram_buckets(text: str | None, buckets: int = BUCKETS) -> np.ndarray:
    """Buckets of the word unigrams and bigrams, and of the shape unigrams to trigrams, of a whole text."""
    tokens = TOKENS.findall(text or "")
    if not tokens:
        return np.empty(0, np.int64)
    words, shapes = _hashes(tokens)
    grams = [words, words[:-1] * MULTIPLIER + words[1:], shapes]
    pairs = shapes[:-1] * MULTIPLIER + shapes[1:] + np.uint64(5)
    grams += [pairs, pairs[:-1] * MULTIPLIER + shapes[2:]]
    half = buckets // 2  # words and shapes have a half of the buckets each
    index = [(mixed(g) % np.uint64(half)).astype(np.int64) for g in grams]
    return np.concatenate(index[:2] + [i + half for i in index[2:]])


def _counter(buckets: int):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = np.zeros((2, buckets), np.int64)
        for batch in batches:
            for text, trusted in zip(batch["text"], batch["trusted"]):
                counts = np.bincount(gram_buckets(text, buckets), minlength=buckets)
                totals[0] += counts
                if trusted:
                    totals[1] += counts
        used = np.flatnonzero(totals[0])
        yield pd.DataFrame({"bucket": used, "raw": totals[0][used], "target": totals[1][used]})

    return count


@dataclass(frozen=True)
class RatioModel:
    """Log of target probability over raw probability, per bucket."""

    log_ratio: np.ndarray

    def score(self, text: str | None) -> float:
        return float(self.log_ratio[gram_buckets(text, len(self.log_ratio))].sum())

    def of(self, text: Column) -> Column:
        weights = self.log_ratio

        @F.pandas_udf("double")
        def scored(texts: pd.Series) -> pd.Series:
            model = RatioModel(weights)
            return pd.Series([model.score(t) for t in texts], dtype="float64")

        return scored(text)


def fit_ratio(docs: DataFrame, trusted_ids: DataFrame, id_col: str, text_col: str, buckets: int = BUCKETS) -> RatioModel:
    """Fit on all documents as the raw corpus and on those in ``trusted_ids``, a bounded table, as the target.

    Each task sends one row per bucket it has seen, and the driver gets one row per bucket.
    """
    trusted = F.broadcast(trusted_ids.select(F.col(id_col).alias("doc"), F.lit(True).alias("trusted")))
    texts = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).join(trusted, "doc", "left")
    texts = texts.select("text", F.coalesce("trusted", F.lit(False)).alias("trusted"))
    counts = texts.mapInPandas(_counter(buckets), "bucket int, raw bigint, target bigint")
    rows = counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    totals = np.zeros((2, buckets))
    totals[:, rows["bucket"]] = rows[["raw", "target"]].to_numpy().T
    if not totals[1].any():
        return RatioModel(np.zeros(buckets))
    raw, target = totals + SMOOTHING
    return RatioModel(np.log(target / target.sum()) - np.log(raw / raw.sum()))


def gumbel(key: Column | str, seed: int) -> Column:
    """A standard Gumbel variable that depends on the row's key and the seed alone."""
    uniform = (seeded_hash(key, seed) + 0.5) / HASH_SPAN
    return -F.log(-F.log(uniform))


def trusted_and_rejected(labels: DataFrame, id_col: str, quality_col: str, at_most: int) -> tuple[DataFrame, DataFrame]:
    """Ids of documents labelled good by every label they have, and of those labelled bad by one; bounded samples."""
    worst = labels.groupBy(id_col).agg(F.min(quality_col).alias("quality"))
    good, bad = worst.where("quality >= 1"), worst.where("quality < 1")
    return id_sample(good, id_col, at_most), id_sample(bad, id_col, at_most)


def best_cut(good: np.ndarray, bad: np.ndarray) -> float:
    """The cut between scores of good and bad documents with the least weighted errors; the middle of the widest such gap.

    Without bad examples nothing lies below the cut, without good ones neither.
    """
    if not len(good) or not len(bad):
        return -np.inf
    scores = np.unique(np.concatenate((good, bad)))
    lost = np.searchsorted(np.sort(good), scores)  # good ones below a cut at each score
    passed = len(bad) - np.searchsorted(np.sort(bad), scores)
    errors = LOSS_WEIGHT * lost / len(good) + passed / len(bad)
    errors = np.append(errors, LOSS_WEIGHT)  # a cut above all
    low = np.concatenate((scores[:1], scores))
    high = np.append(scores, scores[-1] + 1)
    best = np.flatnonzero(errors == errors.min())
    widest = best[np.argmax(high[best] - low[best])]
    return float((low[widest] + high[widest]) / 2)


def importance_sample(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    quality_col: str = "quality",
    k: int | None = None,
    target_docs: int = TARGET_DOCS,
    seed: int = SEED,
    row_col: str | None = None,
) -> DataFrame:
    """One row per input row: id, ``log_ratio``, ``priority`` (log ratio and Gumbel variable), ``kept``, and ``row_col`` as it was.

    ``k`` documents are kept, or all if there are fewer. If it is not given, it is the number of documents whose log
    ratio lies above the cut that separates the labelled good from the labelled bad ones best.
    The target and the cut come from at most ``target_docs`` labelled documents of each kind, the raw model and the
    selection from all documents. Good documents that set the cut take no part in the target, because documents the
    target has seen score higher than equally good ones it has not.

    Texts of any length are read whole. A missing text and one without tokens have a log ratio of 0. A missing id draws its Gumbel variable like any other
    value; rows that repeat an id share it. Ties go to the smaller id, and rows equal in both are kept or not together,
    so that repeated rows can raise the number kept above ``k``. Without usable labels every document is kept, and an
    empty table gives an empty table. Other columns play no part.
    """
    good, bad = trusted_and_rejected(labels, id_col, quality_col, target_docs)
    good, bad = staged(good, "trusted"), staged(bad, "rejected")
    held_out = (seeded_hash(id_col, seed) % HELD_OUT == 0) if k is None else F.lit(False)
    model = fit_ratio(docs, good.where(~held_out), id_col, text_col)
    row = F.lit(None).cast("bigint") if row_col is None else F.col(row_col)
    scored = docs.select(
        F.col(id_col).alias("doc"),
        row.alias("row"),
        model.of(F.col(text_col)).alias("log_ratio"),
        gumbel(id_col, seed).alias("noise"),
    )
    scored = scored.select("doc", "row", "log_ratio", (F.col("log_ratio") + F.coalesce("noise", F.lit(0.0))).alias("priority"))
    scored = staged(scored, "scored")
    if k is None:
        ratios = [
            scored.join(F.broadcast(ids.withColumnRenamed(id_col, "doc")), "doc").select("log_ratio").toPandas()
            for ids in (good.where(held_out), bad)
        ]
        cut = best_cut(*(r["log_ratio"].to_numpy() for r in ratios))
        k = row_count(scored.where(F.col("log_ratio") >= F.lit(cut)))
    kept = among_top(scored, "priority", "doc", k) if k > 0 else F.lit(False)
    return scored.select(
        F.col("doc").alias(id_col),
        "log_ratio",
        "priority",
        F.coalesce(kept, F.lit(k > 0)).alias("kept"),
        *([F.col("row").alias(row_col)] if row_col else []),
    )
