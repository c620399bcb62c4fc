"""Deletion of repeated line runs with a suffix array over the line sequences of all documents.

Every line with a word is a symbol, every symbol of every document starts a suffix. Prefix doubling ranks the suffixes
by their first 1, 2, 4, ... lines: a rank is the place of the first suffix of its group in the sorted order, found by a
range-partitioned sort of the distinct keys. A suffix whose prefix is unique leaves the next round, so later rounds hold
repeated runs only. Depth is bounded, because a run counts as soon as it has ``min_words`` words, which takes at most
as many lines.

A run of ``n`` lines has the ranks of its first and its last ``2^k`` lines as its key, ``2^k <= n < 2^(k+1)``; runs with
one key are an interval of the suffix array whose common prefix is at least ``n`` lines. From every line the shortest
run with ``min_words`` words forwards and backwards is looked up. Together these cover every maximal repeated run
with as many words: a line of it that is in no shortest run of its own lies inside the one that starts with the run.
In each interval the first copy by (id, line) stays, and the lines of all later copies go.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bitexture.llm.common import staged

MIN_WORDS = 50
PLACE = ["doc", "version"]


def worded_lines(text: str | None) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """All lines, the numbers of those with a word, and how many words these have."""
    lines = (text or "").encode().split(b"\n")
    words = np.fromiter((len(line.split()) for line in lines), np.int64, len(lines))
    worded = np.flatnonzero(words)
    return lines, worded, words[worded]


def shortest_runs(words: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Per line the number of lines in the shortest run that starts, and that ends, here; 0 where there is none."""
    before = np.concatenate(([0], np.cumsum(words)))
    at = np.arange(len(words))
    end = np.searchsorted(before, before[:-1] + min_words)
    forward = np.where(end <= len(words), end - at, 0)
    start = np.searchsorted(before, before[1:] - min_words, side="right") - 1
    backward = np.where(start >= 0, at + 1 - start, 0)
    return forward, backward


def _suffixes(min_words: int):
    def suffixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), 1000):
                parts = []
                part = batch.iloc[start : start + 1000]
                for doc, version, text in zip(part["doc"], part["version"], part["text"]):
                    lines, worded, words = worded_lines(text)
                    forward, backward = shortest_runs(words, min_words)
                    symbols = np.fromiter((xxhash.xxh64_intdigest(lines[i]) for i in worded), np.uint64, len(worded))
                    parts.append((doc, version, len(worded), symbols.view(np.int64), forward, backward))
                sizes = [p[2] for p in parts]
                yield pd.DataFrame(
                    {
                        "doc": np.repeat(part["doc"].to_numpy(), sizes),
                        "version": np.repeat(part["version"].to_numpy(), sizes),
                        "at": np.concatenate([np.arange(n) for n in sizes]),
                        "symbol": np.concatenate([p[3] for p in parts]),
                        "forward": np.concatenate([p[4] for p in parts]),
                        "backward": np.concatenate([p[5] for p in parts]),
                    }
                )

    return suffixes


def _numbered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Running count of suffixes before each key of a sorted partition."""
    part, before = TaskContext.get().partitionId(), 0
    for batch in batches:
        counts = batch["n"].to_numpy()
        upto = np.cumsum(counts)
        yield batch.assign(part=part, before=before + upto - counts)
        before += int(upto[-1]) if len(upto) else 0


def _ranked(keys: DataFrame, by: list[str]) -> DataFrame:
    """Distinct keys with counts ``n`` get ``rank``: how many suffixes sort before them."""
    keys = staged(keys, "keys")
    ordered = keys.repartitionByRange(*by).sortWithinPartitions(*by)
    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keys.schema) + ", part int, before bigint"
    numbered = staged(ordered.mapInPandas(_numbered, shape), "numbered")
    totals = numbered.groupBy("part").agg(F.sum("n").alias("total"))
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("total").over(upto), F.lit(0)).alias("offset"))
    ranks = numbered.join(F.broadcast(offsets), "part")  # one row per partition
    return staged(ranks.select(*by, (F.col("offset") + F.col("before")).alias("rank")), "ranks")


def suffix_ranks(symbols: DataFrame, depth: int) -> list[DataFrame]:
    """Per level k the suffixes ``(doc, version, at, rank)`` whose first 2^k symbols occur elsewhere too."""
    keys = symbols.groupBy("symbol").agg(F.count("*").alias("n")).where("n > 1")
    ranked = symbols.join(_ranked(keys, ["symbol"]), "symbol")
    levels = [staged(ranked.select(*PLACE, "at", "rank"), "level")]
    while 2 ** len(levels) <= depth and not levels[-1].isEmpty():
        known, step = levels[-1], 2 ** (len(levels) - 1)
        ahead = known.select(*PLACE, (F.col("at") - step).alias("at"), F.col("rank").alias("then"))
        pairs = staged(known.withColumnRenamed("rank", "lead").join(ahead, [*PLACE, "at"]), "pairs")
        keys = pairs.groupBy("lead", "then").agg(F.count("*").alias("n")).where("n > 1")
        ranks = _ranked(keys, ["lead", "then"])
        levels.append(staged(pairs.join(ranks, ["lead", "then"]).select(*PLACE, "at", "rank"), "level"))
    return levels


def repeated_lines(docs: DataFrame, id_col: str, text_col: str, min_words: int = MIN_WORDS) -> DataFrame:
    """Per document with later copies ``(doc, version, gone)``: which of its lines with words go, counted from 0."""
    texts = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("version"), F.col(text_col).alias("text")
    )
    kind = docs.schema[id_col].dataType.simpleString()
    shape = f"doc {kind}, version bigint, at int, symbol bigint, forward int, backward int"
    suffixes = staged(texts.mapInPandas(_suffixes(min_words), shape), "suffixes")
    repeated = staged(suffixes.groupBy("symbol").count().where("count > 1").select("symbol"), "repeated")
    suffixes = staged(suffixes.join(repeated, "symbol").dropDuplicates([*PLACE, "at"]), "suffixes")
    levels = suffix_ranks(suffixes.select(*PLACE, "at", "symbol"), min_words)

    starts = suffixes.select(*PLACE, F.col("at").alias("first"), F.col("forward").alias("n"))
    ends = suffixes.select(*PLACE, (F.col("at") + 1 - F.col("backward")).alias("first"), F.col("backward").alias("n"))
    runs = starts.union(ends).where("n > 0").distinct().withColumn("level", F.floor(F.log2("n")).cast("int"))
    runs = runs.withColumn("last", F.expr("first + n - shiftleft(1, level)"))
    ranks = reduce(DataFrame.union, [x.withColumn("level", F.lit(k)) for k, x in enumerate(levels)])
    for end in ("first", "last"):
        here = ranks.select(*PLACE, "level", F.col("at").alias(end), F.col("rank").alias(f"{end}_rank"))
        runs = runs.join(here, [*PLACE, "level", end])
    runs = staged(runs.select(*PLACE, "first", "n", "first_rank", "last_rank"), "runs")
    interval = ["n", "first_rank", "last_rank"]
    earliest = runs.groupBy(*interval).agg(F.count("*").alias("copies"), F.min(F.struct(*PLACE, "first")).alias("original"))
    earliest = staged(earliest.where("copies > 1").drop("copies"), "intervals")
    later = runs.join(earliest, interval).where(F.struct(*PLACE, "first") != F.col("original"))
    gone = later.select(*PLACE, F.explode(F.expr("sequence(first, first + n - 1)")).alias("at")).distinct()
    return staged(gone.groupBy(*PLACE).agg(F.collect_list("at").alias("gone")), "gone")


@F.pandas_udf(T.StringType())
def without_lines(text: pd.Series, gone: pd.Series) -> pd.Series:
    def cut(text, gone):
        if text is None or gone is None:
            return None
        lines, worded, _ = worded_lines(text)
        drop = set(worded[np.asarray(gone, np.int64)].tolist())
        return b"\n".join(line for i, line in enumerate(lines) if i not in drop).decode()

    return pd.Series([cut(*pair) for pair in zip(text, gone)], dtype=object)


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of the table has."""
    while name.lower() in [c.lower() for c in df.columns]:
        name = "_" + name
    return name


def dedupe_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """The documents without later copies of repeated line runs, all columns as they were, and ``n_removed_lines``.

    A run is a sequence of lines, those without a word left out of account, with ``min_words`` words or more. Of equal
    runs the first by (id, line) stays, within a document too; lines without a word stay where they are. A document
    that holds nothing but later copies is left with an empty text, or with its blank lines.

    A missing text stays missing. A row without an id stays as it is and is no original for others. Rows that repeat an
    id with the same text are one document and get the same result; with other texts they are documents of their own.
    A line of any length is one symbol. If the table has a column ``n_removed_lines`` already, the new one gets a
    leading underscore. An empty table gives an empty table.
    """
    gone = repeated_lines(docs, id_col, text_col, min_words)
    counted, doc, version, cut = (fresh_name(docs, n) for n in ("n_removed_lines", "doc", "version", "gone"))
    gone = gone.select(F.col("doc").alias(doc), F.col("version").alias(version), F.col("gone").alias(cut))
    here = docs.withColumns({doc: F.col(id_col), version: F.xxhash64(text_col)})
    joined = here.join(gone.hint("merge"), [doc, version], "left")  # the same plan at every size
    touched = F.when(F.col(cut).isNotNull(), F.col(text_col))
    text = F.when(F.col(cut).isNull(), F.col(text_col)).otherwise(without_lines(touched, F.col(cut)))
    columns = [text.alias(c) if c == text_col else F.col(c) for c in docs.columns]
    return joined.select(*columns, F.coalesce(F.size(cut), F.lit(0)).alias(counted))
