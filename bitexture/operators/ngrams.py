"""N-gram tables of hypotheses and their references.

The rows are partitioned by example once, while they are still plain text. Counting n-grams per example needs no
further shuffle: an example is one row, whose n-grams are counted in its batch (``batch_ngrams``). Two kinds of examples
are exploded to one row per occurrence instead, and counted by Spark: those with a text beyond ``LONG_TEXT``, which are cut into
overlapping pieces that are dealt out on their own, and those that share their id, whose counts are merged per n-gram. One
aggregate over the texts finds out how many tasks the texts are worth, and whether there are any such examples.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bitexture.operators.batch_ngrams import chunks, match_counts, reference_grams
from bitexture.operators.selection import one_row

EXAMPLE = "example_id"
LONG_TEXT = 1 << 18
PIECE_UNITS = 1 << 16
TASK_BYTES = 1 << 20
LEAST_TASK_BYTES = 1 << 16


@dataclass(frozen=True)
class Extent:
    """What the texts of a table of examples amount to."""

    size: int  # bytes of all texts
    longest: int  # characters
    references: int  # the most that one example has
    tasks: int
    repeated: bool  # two rows or more are one example

    @property
    def has_long(self) -> bool:
        return self.longest > LONG_TEXT


def reference_list(examples: DataFrame, column: Column) -> Column:
    """References as an array: a single text is a list of one; a missing or empty list holds one empty text."""
    kind = examples.select(column.alias("c")).schema["c"].dataType
    if not isinstance(kind, T.ArrayType):
        return F.array(F.coalesce(column, F.lit("")))
    filled = F.transform(column, lambda text: F.coalesce(text, F.lit("")))
    return F.when(F.size(filled) > 0, filled).otherwise(F.array(F.lit("")))


def extent_of(examples: DataFrame) -> Extent:
    """One pass over ``predictions`` and the list ``outputs``; the other columns tell the examples apart."""
    texts = F.concat(F.array(F.coalesce("predictions", F.lit(""))), "outputs")
    total = F.aggregate(texts, F.lit(0).cast("bigint"), lambda n, text: n + F.octet_length(text))
    each = examples.groupBy(*_others(examples)).agg(
        F.sum(total).alias("size"), F.max(_longest(texts)).alias("longest"), F.max(F.size("outputs")).alias("k"), F.count("*").alias("rows")
    )
    row = one_row(
        each.agg(F.sum("size").alias("size"), F.max("longest").alias("longest"), F.max("k").alias("k"), F.max("rows").alias("rows"))
    )
    size, cores = row["size"] or 0, examples.sparkSession.sparkContext.defaultParallelism
    tasks = max(-(-size // TASK_BYTES), min(cores, -(-size // LEAST_TASK_BYTES)), 1)
    return Extent(size, row.longest or 0, row.k or 1, tasks, (row.rows or 0) > 1)


def _others(examples: DataFrame) -> list[str]:
    return [c for c in examples.columns if c not in ("predictions", "outputs")]


def _longest(texts: Column) -> Column:
    return F.array_max(F.transform(texts, F.length))


def by_example(df: DataFrame, tasks: int) -> DataFrame:
    """Partition by example into ``tasks`` parts.

    The count is given because the work per byte is far above a plain shuffle's: sized by bytes alone, adaptive
    execution would merge these partitions into too few tasks.
    """
    return df.repartition(tasks, EXAMPLE)


def units(text: Column, unit: str) -> Column:
    """Characters (code points) or white-space separated words of a text that is not empty."""
    if unit == "char":
        return F.split(text, "")
    if unit == "word":
        return F.regexp_extract_all(text, F.lit(r"\S+"), F.lit(0))
    raise ValueError(f"unit must be char or word, not {unit}")


def unit_separator(unit: str) -> str:
    return "" if unit == "char" else " "


def gram_count(n_units: Column, n: Column | int) -> Column:
    """How many n-grams a text of ``n_units`` units has."""
    return F.greatest(n_units - n + 1, F.lit(0))


def gram_order(gram: Column, unit: str) -> Column:
    """The n of an n-gram: its characters, or its separators plus one."""
    return F.length(gram) if unit == "char" else F.regexp_count(gram, F.lit(unit_separator(unit))) + 1


def counts_of(j: int) -> str:
    """Column with the counts in the j-th reference."""
    return f"r{j}"


def _most(columns: list[Column]) -> Column:
    return F.greatest(*columns) if len(columns) > 1 else columns[0]


def example_ngrams(examples: DataFrame, extent: Extent, keys: list[str], max_n: int, unit: str = "char") -> DataFrame:
    """Rows ``(*keys, example_id, gram, n, h, r0, r1, ...)``: counts of a gram in the hypothesis and in each reference.

    ``examples`` has ``predictions`` and the list ``outputs``.
    """
    listed = F.transform("outputs", lambda text, j: F.struct(j.alias("side"), text.alias("text")))
    sides = F.concat(F.array(F.struct(F.lit(-1).alias("side"), F.coalesce("predictions", F.lit("")).alias("text"))), listed)
    spread = examples.select(*keys, EXAMPLE, "predictions", "outputs", F.explode(sides).alias("s"))

    def counted(occurrences: DataFrame) -> DataFrame:
        of = lambda side: F.sum(F.when(F.col("side") == side, 1).otherwise(0))
        refs = [of(j).alias(counts_of(j)) for j in range(extent.references)]
        return occurrences.groupBy(*keys, EXAMPLE, "gram").agg(of(-1).alias("h"), *refs)

    columns = [*keys, EXAMPLE, "s.*"]
    if extent.has_long:
        texts = F.concat(F.array(F.coalesce("predictions", F.lit(""))), F.col("outputs"))
        is_long = _longest(texts) > LONG_TEXT
        pieces = _pieces(spread.where(is_long).select(*columns), max_n, unit)
        pieces = pieces.repartition(extent.tasks, EXAMPLE, "side", "piece").drop("piece")
        long_counts = counted(_occurrences(pieces, max_n, unit, PIECE_UNITS))
        spread = spread.where(~is_long)
    counts = counted(_occurrences(by_example(spread.select(*columns), extent.tasks), max_n, unit))
    if extent.has_long:
        counts = counts.unionByName(long_counts)
    return counts.withColumn("n", gram_order(F.col("gram"), unit))


def _pieces(texts: DataFrame, max_n: int, unit: str) -> DataFrame:
    """Texts in pieces of ``PIECE_UNITS`` units, each with the ``max_n - 1`` units behind it."""
    others = [c for c in texts.columns if c != "text"]
    if unit == "char":
        whole, n_units = F.col("text"), F.length("text")
        cut = lambda i: F.substring(F.col("text"), i * PIECE_UNITS + 1, F.lit(PIECE_UNITS + max_n - 1))
    else:
        texts = texts.where(F.col("text") != "").select(*others, units(F.col("text"), unit).alias("text"))
        whole, n_units = F.col("text"), F.size("text")
        cut = lambda i: F.array_join(F.slice(F.col("text"), i * PIECE_UNITS + 1, F.lit(PIECE_UNITS + max_n - 1)), " ")
    last = F.floor((F.greatest(n_units, F.lit(1)) - 1) / PIECE_UNITS).cast("int")
    numbered = texts.select(*others, whole.alias("text"), F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    return numbered.select(*others, "piece", cut(F.col("piece")).alias("text"))


def _occurrences(texts: DataFrame, max_n: int, unit: str, starts: int | None = None) -> DataFrame:
    """Replace ``text`` by one row ``gram`` per n-gram occurrence of orders 1 to ``max_n`` that starts in its first ``starts``
    units, or anywhere."""
    sep = unit_separator(unit)
    others = [c for c in texts.columns if c != "text"]
    cut = texts.where(F.col("text") != "").select(*others, units(F.col("text"), unit).alias("u"))
    # A text of blanks has no words: its only starts lie outside the array and give no gram.
    last = F.size("u") - 1 if starts is None else F.least(F.size("u"), F.lit(starts)) - 1
    placed = cut.select("*", F.explode(F.sequence(F.lit(0), last)).alias("i"))
    window = [F.get("u", F.col("i") + k) for k in range(max_n)]
    # ``concat`` with a unit beyond the end is NULL.
    spaced = [[p for unit_at in window[:n] for p in (F.lit(sep), unit_at)][1:] for n in range(1, max_n + 1)]
    grams = F.array(*[F.concat(*(parts if sep else parts[::2])) for parts in spaced])
    return placed.select(*others, F.explode(grams).alias("gram")).where(F.col("gram").isNotNull())


def _split(examples: DataFrame, extent: Extent) -> tuple[DataFrame, DataFrame | None]:
    """Examples that are one row with texts of bounded length, and the others."""
    if not extent.has_long and not extent.repeated:
        return examples, None
    texts = F.concat(F.array(F.coalesce("predictions", F.lit(""))), F.col("outputs"))
    marked = examples.withColumn("odd", _longest(texts) > LONG_TEXT)
    if extent.repeated:
        # A struct compares equal where its fields do, NULL included.
        ids = examples.groupBy(F.struct(*_others(examples)).alias("one")).count().where("count > 1")
        marked = marked.withColumn("one", F.struct(*_others(examples))).join(ids, "one", "left")
        marked = marked.withColumn("odd", F.col("odd") | F.col("count").isNotNull())
    return tuple(marked.where(odd).select(examples.columns) for odd in (~F.col("odd"), F.col("odd")))


def _in_batches(examples: DataFrame, keys: list[str], extent: Extent, unit: str, found, kept: list[str], added: list) -> DataFrame:
    """Apply ``found`` to the chunks of the examples; the result has the ``kept`` columns of them and the ``added`` fields."""
    filled = examples.select(*keys, EXAMPLE, F.coalesce("predictions", F.lit("")).alias("predictions"), "outputs")
    shape = T.StructType([*(T.StructField(c, filled.schema[c].dataType) for c in kept), *(T.StructField(*field) for field in added)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch, unit):
                yield from found(chunk)

    return by_example(filled, extent.tasks).mapInArrow(run, shape)


def example_matches(examples: DataFrame, extent: Extent, keys: list[str], max_n: int, unit: str = "char") -> DataFrame:
    """Matches per example, one row per example that has any unit.

    ``m1 .. m<max_n>`` clip each gram at the most any reference has of it, ``m<n>_<j>`` at what the j-th has.
    """
    plain, odd = _split(examples, extent)
    orders, several = range(1, max_n + 1), range(extent.references) if extent.references > 1 else ()
    names = [*(f"m{n}" for n in orders), *(f"m{n}_{j}" for j in several for n in orders)]

    def found(chunk) -> Iterator[pa.RecordBatch]:
        counts = match_counts(chunk, extent.references, max_n)
        any_unit = np.unique(chunk.example)
        rows = chunk.rows.select([*keys, EXAMPLE]).take(pa.array(any_unit))
        yield pa.RecordBatch.from_arrays([*rows.columns, *(pa.array(counts[c][any_unit]) for c in names)], names=[*keys, EXAMPLE, *names])

    matches = _in_batches(plain, keys, extent, unit, found, [*keys, EXAMPLE], [(c, T.LongType()) for c in names])
    if odd is None:
        return matches
    counts = example_ngrams(odd, extent, keys, max_n, unit)
    refs = [F.col(counts_of(j)) for j in range(extent.references)]

    def matched(n: int, limit: Column) -> Column:
        return F.sum(F.when(F.col("n") == n, F.least("h", limit)).otherwise(0))

    clipped = [matched(n, _most(refs)).alias(f"m{n}") for n in orders]
    single = [matched(n, refs[j]).alias(f"m{n}_{j}") for j in several for n in orders]
    return matches.unionByName(counts.groupBy(*keys, EXAMPLE).agg(*clipped, *single))


def group_grams(examples: DataFrame, extent: Extent, group: str, max_n: int, unit: str = "char") -> DataFrame:
    """Rows ``(group, gram, n, r, matched)``: a gram's occurrences in all references of a group, and its matches, clipped
    per example at the first reference."""
    plain, odd = _split(examples, extent)

    def found(chunk) -> Iterator[pa.RecordBatch]:
        groups = chunk.rows.column(group)
        for g in reference_grams(chunk, _group_numbers(groups), extent.references, max_n):
            n = pa.array(np.full(len(g.count), g.n, np.int32))
            columns = [groups.take(pa.array(g.row)), g.text, n, pa.array(g.count), pa.array(g.matched)]
            yield pa.RecordBatch.from_arrays(columns, names=[group, "gram", "n", "r", "matched"])

    added = [("gram", T.StringType()), ("n", T.IntegerType()), ("r", T.LongType()), ("matched", T.LongType())]
    grams = _in_batches(plain, [group], extent, unit, found, [group], added)
    if odd is not None:
        counted = example_ngrams(odd, extent, [group], max_n, unit)
        clipped = F.least("h", counts_of(0)).alias("matched")
        grams = grams.unionByName(counted.select(group, "gram", "n", reference_count(extent).alias("r"), clipped))
    return grams.groupBy(group, "gram", "n").agg(F.sum("r").alias("r"), F.sum("matched").alias("matched"))


def matched_grams(examples: DataFrame, extent: Extent, group: str, max_n: int, unit: str = "char") -> DataFrame:
    """Rows ``(group, gram, n, examples, c0, c1, ...)`` of grams that hypotheses share with references: lists of examples and of
    their matches, clipped at each reference. A gram has one row per chunk of examples."""
    plain, odd = _split(examples, extent)
    clipped = [f"c{j}" for j in range(extent.references)]
    names = [group, "gram", "n", "examples", *clipped]

    def found(chunk) -> Iterator[pa.RecordBatch]:
        groups, ids = chunk.rows.column(group), chunk.rows.column(EXAMPLE)
        for g in reference_grams(chunk, _group_numbers(groups), extent.references, max_n):
            order = np.argsort(g.gram, kind="stable")
            gram = g.gram[order]
            first = np.flatnonzero(np.diff(gram, prepend=-1))
            cuts = pa.array(np.append(first, len(gram)).astype(np.int32))
            entries = [ids.take(pa.array(g.example[order])), *(pa.array(c[order].astype(np.int32)) for c in g.clipped)]
            lists = [pa.ListArray.from_arrays(cuts, x) for x in entries]
            n = pa.array(np.full(len(first), g.n, np.int32))
            columns = [groups.take(pa.array(g.row[gram[first]])), g.text.take(pa.array(gram[first])), n, *lists]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    added = [("gram", T.StringType()), ("n", T.IntegerType()), ("examples", T.ArrayType(examples.schema[EXAMPLE].dataType))]
    added += [(c, T.ArrayType(T.IntegerType())) for c in clipped]
    matched = _in_batches(plain, [group], extent, unit, found, [group], added)
    if odd is None:
        return matched
    counted = example_ngrams(odd, extent, [group], max_n, unit).where((F.col("h") > 0) & (reference_count(extent) > 0))
    least = [F.array(F.least("h", counts_of(j)).cast("int")).alias(c) for j, c in enumerate(clipped)]
    return matched.unionByName(counted.select(group, "gram", F.col("n").cast("int").alias("n"), F.array(EXAMPLE).alias("examples"), *least))


def _group_numbers(groups: pa.Array) -> np.ndarray:
    """Equal numbers for equal groups; groups that are merged later anyway may get several."""
    known: dict[str, int] = {}
    return np.array([known.setdefault(repr(g), len(known)) for g in groups.to_pylist()], np.int64)


def reference_count(extent: Extent) -> Column:
    """Occurrences of a gram in all references of its example."""
    return reduce(lambda a, b: a + b, [F.col(counts_of(j)) for j in range(extent.references)])
