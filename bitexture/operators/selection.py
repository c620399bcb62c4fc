"""Exact selection by rank without sorting the table or bringing a group into one task.

The value at a rank is found from histograms of bounded size: each round keeps the one bucket that holds the rank,
until that bucket is small or holds a single value. What reaches the driver is one row per rank and round. The
selection itself is then a filter with constants, so the selected rows are never shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from bitexture.functions.hashing import HASH_SPAN, seeded_hash

HISTOGRAM_BUCKETS = 1 << 16
DIRECT_ROWS = 1 << 16
DIRECT_TOP_K = 1000


def one_row(aggregate: DataFrame) -> Row:
    """The single row of a global aggregate."""
    return aggregate.first()


def row_count(df: DataFrame) -> int:
    return one_row(df.agg(F.count("*").alias("n"))).n


def bucket_of(value: Column, low: float, high: float, buckets: int) -> Column:
    """Equal-width bucket of a value in [low, high], both finite; the last bucket is closed.

    Integers are compared before they become floating-point numbers, and other values at half their size, so that
    neither ids beyond 2^53 nor a range beyond the largest number end up in one bucket.
    """
    if high <= low:
        return F.lit(0)
    if isinstance(low, int) and isinstance(high, int):
        share = (value - F.lit(low)).cast("double") / F.lit(float(high - low))
    else:
        share = (value.cast("double") / 2 - F.lit(low / 2)) / F.lit(high / 2 - low / 2)
    position = F.floor(share * buckets)
    return F.greatest(F.least(position, F.lit(buckets - 1)), F.lit(0)).cast("int")


def covers(rank: Column, before: Column, n: Column) -> Column:
    """Whether the ``n`` rows after the first ``before`` hold the 1-based rank."""
    return (before < rank) & (rank <= before + n)


@dataclass(frozen=True)
class ValueAtRank:
    """A value, how many rows sort ahead of it, and how many rows hold it."""

    value: float | int
    before: int
    n: int


@dataclass(frozen=True)
class _Range:
    low: float | int
    high: float | int
    before: int
    n: int
    ranks: tuple[int, ...]

    def narrowed(self, row: Row) -> "_Range":
        before = self.before + row.before
        ranks = tuple(r for r in self.ranks if before < r <= before + row.n)
        return replace(self, low=row.low, high=row.high, before=before, n=row.n, ranks=ranks)


def _covers_any(ranks: tuple[int, ...], offset: int) -> Column:
    return reduce(or_, [covers(F.lit(r), F.col("before") + offset, F.col("n")) for r in ranks])


def _running(counts: DataFrame, key: str, descending: bool) -> DataFrame:
    """Add ``before`` to bounded counts ``(key, n)``."""
    order = F.desc(key) if descending else F.asc(key)
    upto = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.withColumn("before", F.sum("n").over(upto) - F.col("n"))


def present(value: Column | str) -> Column:
    """Whether a number is there: neither NULL nor NaN."""
    value = F.col(value) if isinstance(value, str) else value
    return value.isNotNull() & ~F.isnan(value)


def _parts(values: DataFrame, ranks: list[int], descending: bool) -> list[_Range]:
    """The ranges to start from: the finite values, and each infinity as a range of its own."""
    infinity = float("inf")
    value = F.col("value")
    finite = F.abs(value.cast("double")) < infinity
    row = one_row(
        values.agg(
            F.min(F.when(finite, value)).alias("low"),
            F.max(F.when(finite, value)).alias("high"),
            F.count_if(finite).alias("n"),
            F.count_if(value == F.lit(-infinity)).alias("lowest"),
            F.count_if(value == F.lit(infinity)).alias("highest"),
        )
    )
    ends = [(-infinity, -infinity, row.lowest), (row.low, row.high, row.n), (infinity, infinity, row.highest)]
    parts, before = [], 0
    for low, high, n in reversed(ends) if descending else ends:
        inside = tuple(sorted({r for r in ranks if before < r <= before + n}))
        if inside:
            parts.append(_Range(low, high, before, n, inside))
        before += n
    return parts


def values_at(
    values: DataFrame, ranks: list[int], *, descending: bool = False, extent: tuple | None = None
) -> list[ValueAtRank | None]:
    """What stands at the 1-based ``ranks`` of a one-column table; NULL and NaN do not count; None beyond its ends.

    ``extent`` is ``(low, high, n)``, both finite, where it is known already.
    """
    (name,) = values.columns
    values = values.select(F.col(name).alias("value")).where(present("value"))
    if extent is None:
        pending = _parts(values, ranks, descending)
    else:
        low, high, n = extent
        wanted = tuple(sorted({r for r in ranks if 0 < r <= n}))
        pending = [_Range(low, high, 0, n, wanted)] if wanted else []
    found: dict[int, ValueAtRank] = {}
    while pending:
        part = pending.pop()
        inside = values.where(F.col("value").between(F.lit(part.low), F.lit(part.high)))
        if part.low == part.high:
            found.update({r: ValueAtRank(part.low, part.before, part.n) for r in part.ranks})
        elif part.n <= DIRECT_ROWS:
            counts = _running(inside.groupBy("value").agg(F.count("*").alias("n")), "value", descending)
            for row in counts.where(_covers_any(part.ranks, part.before)).collect():  # at most len(ranks) rows
                before = part.before + row.before
                hit = ValueAtRank(row.value, before, row.n)
                found.update({r: hit for r in part.ranks if before < r <= before + row.n})
        else:
            bucket = bucket_of(F.col("value"), part.low, part.high, HISTOGRAM_BUCKETS)
            buckets = inside.groupBy(bucket.alias("bucket")).agg(
                F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
            )
            counts = _running(buckets, "bucket", descending)
            holding = counts.where(_covers_any(part.ranks, part.before)).collect()  # at most len(ranks) rows
            narrowed = [part.narrowed(row) for row in holding]
            if any(x.n == part.n and (x.low, x.high) == (part.low, part.high) for x in narrowed):
                raise RuntimeError(f"values between {part.low} and {part.high} cannot be told apart")
            pending += narrowed
    return [found.get(r) for r in ranks]


def first_k(df: DataFrame, value: str, id_col: str, k: int, *, descending: bool = True) -> Column:
    """True for the first ``k`` rows by ``value``, ties in order of the unique numeric ``id_col``.

    With fewer than ``k`` rows every row qualifies. Rows without a number must be filtered out.
    """
    (cut,) = values_at(df.select(value), [k], descending=descending)
    if cut is None:
        return F.lit(k > 0)
    ahead = F.col(value) > cut.value if descending else F.col(value) < cut.value
    level = F.col(value) == F.lit(cut.value)
    if cut.before + cut.n == k:
        return ahead | level
    (last,) = values_at(df.where(level).select(id_col), [k - cut.before])
    return ahead | (level & (F.col(id_col) <= last.value))


def top_k(df: DataFrame, score: str, id_col: str, k: int, heap: int = DIRECT_TOP_K) -> DataFrame:
    """The ``k`` rows with the highest score, ties by id, NULL and NaN scores last.

    Up to ``heap`` rows are one bounded heap per task. More would send ``k`` rows of every task to a single
    reducer, so they become a filter at the exact cut instead. Both ways give the same rows.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    if k <= heap:
        return df.orderBy(F.when(present(score), F.col(score)).desc_nulls_last(), F.asc(id_col)).limit(k)
    return df.where(among_top(df.select(score, id_col), score, id_col, k))


def among_top(ranking: DataFrame, score: str, id_col: str, k: int) -> Column:
    """True for the ``k`` best rows of ``ranking``, NULL and NaN scores last; usable on any table with both columns."""
    there = ranking.where(present(score))
    n = row_count(there)
    if n >= k:
        return present(score) & first_k(there, score, id_col, k)
    (last,) = values_at(ranking.where(~present(score)).select(id_col), [k - n])
    return F.lit(True) if last is None else present(score) | (F.col(id_col) <= last.value)


def shuffle_cut(df: DataFrame, id_col: str, seed: int, cuts: list[int], n: int) -> list[Column]:
    """Per cut c: true for the first c of the ``n`` rows in the seeded shuffle.

    Reads the id column only; the rows themselves stay where they are.
    """
    keys = df.select(F.col(id_col).alias("id"), seeded_hash(id_col, seed).alias("h"))
    here = seeded_hash(id_col, seed)
    within = []
    for cut, at in zip(cuts, values_at(keys.select("h"), cuts, extent=(0, HASH_SPAN, n))):
        if at is None:
            within.append(F.lit(cut > 0))
        elif at.before + at.n == cut:
            within.append(here <= at.value)
        else:
            (last,) = values_at(keys.where(F.col("h") == at.value).select("id"), [cut - at.before])
            within.append((here < at.value) | ((here == at.value) & (F.col(id_col) <= last.value)))
    return within
