"""Corpus translation metrics as grouped aggregates, plus the registry that dispatches them by name.

Every metric takes examples ``(example_id, outputs, predictions)``, grouping columns, and a unit: ``char`` (the
default, as raw strings are scored) or ``word``. It returns ``(*keys, metric, score)``.

``outputs`` is a reference text or a list of them. With several, BLEU clips each n-gram at the most any reference has and takes
the reference length closest to the hypothesis, the shorter of two; GLEU, chrF and RIBES score an example by its best
reference, and NIST by its best for each order, with weights from all of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bitexture.functions.text import count_words, without_spaces
from bitexture.operators.ngrams import (
    EXAMPLE,
    Extent,
    example_matches,
    extent_of,
    gram_count,
    group_grams,
    matched_grams,
    reference_list,
    unit_separator,
)
from bitexture.operators.ribes import sentence_ribes
from bitexture.session import scratch_dir
from bitexture.sources.store import written

# Fixed values of the published metrics and of their customary implementation.
SMALLEST_PRECISION = 2.2250738585072014e-308
BLEU_ORDERS = 4
GLEU_ORDERS = 4
CHRF_ORDERS = 6
CHRF_BETA = 3.0
CHRF_FLOOR = 1e-16
NIST_ORDERS = 5


GROUP = "group"


def _grouped(examples: DataFrame, keys: list[str]) -> DataFrame:
    """``(group, example_id, predictions, outputs)`` with a list of references. A struct of the keys compares equal where
    the keys do, NULL included, so groups can be joined by plain equality."""
    group = F.struct(*keys) if keys else F.lit(0)
    references = reference_list(examples, F.col("outputs")).alias("outputs")
    return examples.select(group.alias(GROUP), EXAMPLE, "predictions", references)


def _keys_of(keys: list[str]) -> list[Column]:
    return [F.col(GROUP)[k].alias(k) for k in keys]


def _scored(df: DataFrame, keys: list[str], name: str, score: Column) -> DataFrame:
    return df.select(*_keys_of(keys), F.lit(name).alias("metric"), score.cast("double").alias("score"))


def _with_lengths(examples: DataFrame, unit: str) -> DataFrame:
    """``(group, example_id, hl, rls)``: units of the hypothesis and of each reference."""

    def n_units(text: Column) -> Column:
        return F.length(text) if unit == "char" else count_words(text)

    hypothesis = n_units(F.coalesce("predictions", F.lit(""))).alias("hl")
    return examples.select(GROUP, EXAMPLE, hypothesis, F.transform("outputs", n_units).alias("rls"))


def _total(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, parts)


def _all_grams(length: Column) -> Column:
    """How many n-grams of the GLEU orders a text of ``length`` units has."""
    return _total([gram_count(length, n) for n in range(1, GLEU_ORDERS + 1)])


def _closest_length() -> Column:
    """The reference length nearest to the hypothesis, the shorter of two."""
    return F.array_min(F.transform("rls", lambda n: F.struct(F.abs(n - F.col("hl")), n.alias("n"))))["n"]


def _overlap_sums(examples: DataFrame, extent: Extent, unit: str) -> DataFrame:
    """Per group: matches per order, hypothesis totals per order, lengths, and the sentence-level GLEU sums."""
    matches = example_matches(examples, extent, [GROUP], BLEU_ORDERS, unit)
    orders = range(1, BLEU_ORDERS + 1)
    lengths = _with_lengths(examples, unit)
    totals = [
        *[F.sum(F.greatest(gram_count(F.col("hl"), n), F.lit(1))).alias(f"t{n}") for n in orders],
        F.sum("hl").alias("hyp_len"),
        F.sum(_closest_length()).alias("ref_len"),
    ]
    clipped = [F.sum(f"m{n}").alias(f"m{n}") for n in orders]
    if extent.references > 1:
        # The best reference of an example is known only beside its lengths.
        joined = lengths.join(matches, [GROUP, EXAMPLE], "left").withColumn("best", _best_overlap(extent.references))
        sums = [F.sum("best.matched").alias("gleu_matched"), F.sum("best.grams").alias("gleu_total")]
        return joined.groupBy(GROUP).agg(*totals, *clipped, *sums).fillna(0, [f"m{n}" for n in orders])
    grams = F.greatest(_all_grams(F.col("hl")), _all_grams(F.col("rls")[0]))
    whole = lengths.groupBy(GROUP).agg(*totals, F.sum(grams).alias("gleu_total"))
    found = matches.groupBy(GROUP).agg(*clipped)
    found = whole.join(found, GROUP, "left").fillna(0, [f"m{n}" for n in orders])
    return found.withColumn("gleu_matched", _total([F.col(f"m{n}") for n in range(1, GLEU_ORDERS + 1)]))


def _best_overlap(references: int) -> Column:
    """Matched n-grams and all n-grams of the reference with the highest share, the first of equals."""

    def option(j: int) -> Column:
        matched = F.coalesce(_total([F.col(f"m{n}_{j}") for n in range(1, GLEU_ORDERS + 1)]), F.lit(0))
        grams = F.greatest(_all_grams(F.col("hl")), _all_grams(F.get("rls", F.lit(j))))
        share = F.try_divide(matched, grams).alias("share")
        fields = F.struct(share, F.lit(-j).alias("first"), matched.alias("matched"), grams.alias("grams"))
        return F.when((F.size("rls") > j) & (grams > 0), fields)

    return F.array_max(F.array(*[option(j) for j in range(references)]))


def _bleu_score() -> Column:
    logs = [
        F.log(F.when(F.col(f"m{n}") > 0, F.col(f"m{n}") / F.col(f"t{n}")).otherwise(F.lit(SMALLEST_PRECISION)))
        for n in range(1, BLEU_ORDERS + 1)
    ]
    brevity = (
        F.when(F.col("hyp_len") > F.col("ref_len"), 1.0)
        .when(F.col("hyp_len") == 0, 0.0)
        .otherwise(F.exp(1 - F.try_divide(F.col("ref_len"), F.col("hyp_len"))))
    )
    return F.when(F.col("m1") > 0, brevity * F.exp(_total(logs) / BLEU_ORDERS)).otherwise(0.0)


def _gleu_score() -> Column:
    return F.coalesce(F.try_divide(F.col("gleu_matched"), F.col("gleu_total")), F.lit(0.0))


def bleu(examples: DataFrame, keys: list[str] = [], unit: str = "char") -> DataFrame:
    examples = _grouped(examples, keys)
    return _scored(_overlap_sums(examples, extent_of(examples), unit), keys, "bleu", _bleu_score())


def gleu(examples: DataFrame, keys: list[str] = [], unit: str = "char") -> DataFrame:
    examples = _grouped(examples, keys)
    return _scored(_overlap_sums(examples, extent_of(examples), unit), keys, "gleu", _gleu_score())


def chrf(examples: DataFrame, keys: list[str] = [], unit: str = "char") -> DataFrame:
    """Character F-score averaged over orders and examples. Always on characters; white space is left out."""
    packed = _grouped(examples, keys).select(
        GROUP,
        EXAMPLE,
        without_spaces(F.coalesce("predictions", F.lit(""))).alias("predictions"),
        F.transform("outputs", without_spaces).alias("outputs"),
    )
    orders = range(1, CHRF_ORDERS + 1)
    extent = extent_of(packed)
    matches = example_matches(packed, extent, [GROUP], CHRF_ORDERS)
    joined = _with_lengths(packed, "char").join(matches, [EXAMPLE, GROUP], "left")

    def f_score(n: int, matched: str, length: Column) -> Column:
        m = F.coalesce(F.col(matched), F.lit(0))
        precision = F.try_divide(m, gram_count(F.col("hl"), n))
        recall = F.try_divide(m, gram_count(length, n))
        weight = CHRF_BETA**2
        score = F.try_divide((1 + weight) * (precision * recall), weight * precision + recall)
        return F.coalesce(score, F.lit(CHRF_FLOOR))

    if extent.references > 1:
        options = [
            F.when(F.size("rls") > j, _total([f_score(n, f"m{n}_{j}", F.get("rls", F.lit(j))) for n in orders]))
            for j in range(extent.references)
        ]
        scored = joined.select(GROUP, F.greatest(*options).alias("f"))
    else:
        scored = joined.select(GROUP, _total([f_score(n, f"m{n}", F.col("rls")[0]) for n in orders]).alias("f"))
    sums = scored.groupBy(GROUP).agg(F.sum("f").alias("f"), F.count("*").alias("n"))
    return _scored(sums, keys, "chrf", F.col("f") / CHRF_ORDERS / F.col("n"))


LOWER = [f"c{n}" for n in range(NIST_ORDERS)]


def _scan_prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per gram of a sorted partition the count of the last gram before it that is one unit shorter: its prefix.

    Missing where that gram is in an earlier partition.
    """
    part = TaskContext.get().partitionId()
    latest = np.full(NIST_ORDERS, -1, np.int64)
    for batch in batches:
        order, count = (batch.column(c).to_numpy() for c in ("n", "r"))
        prefix = np.full(len(order), -1, np.int64)
        for n in range(NIST_ORDERS):
            at = np.maximum.accumulate(np.where(order == n, np.arange(len(order)), -1))
            known = np.where(at >= 0, count[at], latest[n])
            wanted = order == n + 1
            prefix[wanted] = known[wanted]
            if len(known):
                latest[n] = known[-1]
        columns = [*batch.columns, pa.array(prefix, pa.int64(), mask=prefix < 0), pa.array(np.full(len(order), part, np.int32))]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "prefix", "part"])


def information_weights(grams: DataFrame, lengths: DataFrame, unit: str = "char") -> DataFrame:
    """Add ``info = log2(count(prefix) / count(gram))`` to reference grams ``(group, gram, n, r, ...)`` of orders 1 to 5.

    A gram sorts behind its prefix, with only grams of that prefix between them. So the grams are range-partitioned by
    (group, gram), and each takes the count of the last shorter one. The prefix of a unigram is the empty gram, which counts
    all units of the group (``ref_len`` in ``lengths``). What lies before a partition is a row of counts per partition.
    """
    others = [c for c in grams.columns if c not in (GROUP, "gram", "n", "r")]
    empty = lengths.select(
        GROUP, F.lit("").alias("gram"), F.lit(0).alias("n"), F.col("ref_len").alias("r"), *(F.lit(None).alias(c) for c in others)
    )
    longer = grams.where(F.col("r") > 0).select(empty.columns)
    rows = empty.unionByName(longer).withColumns({"n": F.col("n").cast("int"), "r": F.col("r").cast("bigint")})
    # Separators sort before all letters: words are compared as a list.
    key = F.col("gram") if unit == "char" else F.when(F.col("n") > 0, F.split("gram", unit_separator(unit))).otherwise(F.array().cast("array<string>"))
    scratch = scratch_dir(rows.sparkSession, "grams")
    rows = written(rows.withColumn("key", key), f"{scratch}/counted")
    ordered = rows.repartitionByRange(GROUP, "key").sortWithinPartitions(GROUP, "key")
    shape = T.StructType([*rows.schema.fields, T.StructField("prefix", T.LongType()), T.StructField("part", T.IntegerType())])
    scanned = written(ordered.mapInArrow(_scan_prefixes, shape), f"{scratch}/scanned")
    place = F.struct(GROUP, "key")
    per_part = scanned.groupBy("part").agg(
        *[F.max_by("r", F.when(F.col("n") == n, place)).alias(c) for n, c in enumerate(LOWER)]
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    carried = per_part.select("part", *[F.last(c, ignorenulls=True).over(before).alias(c) for c in LOWER])
    joined = scanned.where("n > 0").join(F.broadcast(carried), "part", "left")
    prefix = F.coalesce("prefix", F.get(F.array(*LOWER), F.col("n") - 1))
    return joined.withColumn("info", F.log2(prefix / F.col("r"))).select(*grams.columns, "info")


def nist(examples: DataFrame, keys: list[str] = [], unit: str = "char") -> DataFrame:
    """Information-weighted precision summed over orders, with a length penalty; weights are per group."""
    examples = _grouped(examples, keys)
    extent = extent_of(examples)
    orders = range(1, NIST_ORDERS + 1)
    lengths = _with_lengths(examples, unit)
    totals = [F.sum(gram_count(F.col("hl"), n)).alias(f"t{n}") for n in orders]
    whole = lengths.groupBy(GROUP).agg(F.sum(F.aggregate("rls", F.lit(0).cast("bigint"), lambda a, b: a + b)).alias("ref_len"))
    weighted = information_weights(group_grams(examples, extent, GROUP, NIST_ORDERS, unit), whole, unit)
    if extent.references > 1:
        matched = matched_grams(examples, extent, GROUP, NIST_ORDERS, unit)
        telling = weighted.where("info != 0").select(GROUP, "gram", "info")  # the others gain nothing
        clipped = [f"c{j}" for j in range(extent.references)]
        each = F.inline(F.arrays_zip(F.col("examples").alias(EXAMPLE), *clipped))
        matched = matched.join(telling, [GROUP, "gram"]).select(GROUP, "n", "info", each)
        gain = lambda n, j: F.sum(F.when(F.col("n") == n, F.col("info") * F.col(f"c{j}")).otherwise(0.0))
        refs = range(extent.references)
        gains = matched.groupBy(GROUP, EXAMPLE).agg(*[gain(n, j).alias(f"g{n}_{j}") for j in refs for n in orders])
        joined = lengths.join(gains, [GROUP, EXAMPLE], "left")

        def best(n: int) -> Column:
            """Gain and length of the best reference; of gains equal to six places the longer reference, however summed."""
            options = []
            for j in refs:
                found, length = F.coalesce(f"g{n}_{j}", F.lit(0.0)), F.get("rls", F.lit(j))
                fields = F.struct(F.round(found, 6).alias("level"), length.alias("length"), found.alias("gain"))
                options.append(F.when(F.size("rls") > j, fields))
            return F.array_max(F.array(*options))

        joined = joined.withColumns({f"b{n}": best(n) for n in orders})
        sums = joined.groupBy(GROUP).agg(
            *totals,
            (F.sum("hl") * NIST_ORDERS).alias("hyp_len"),
            _total([F.sum(f"b{n}.length") for n in orders]).alias("ref_len"),
            *[F.sum(f"b{n}.gain").alias(f"g{n}") for n in orders],
        )
    else:
        gain = F.col("info") * F.col("matched")
        gains = weighted.groupBy(GROUP).agg(*[F.sum(F.when(F.col("n") == n, gain).otherwise(0.0)).alias(f"g{n}") for n in orders])
        sums = lengths.groupBy(GROUP).agg(*totals, F.sum("hl").alias("hyp_len"), F.sum(F.col("rls")[0]).alias("ref_len"))
        sums = sums.join(gains, GROUP, "left")
    precision = _total(
        [F.coalesce(F.try_divide(F.coalesce(F.col(f"g{n}"), F.lit(0.0)), F.col(f"t{n}")), F.lit(0.0)) for n in orders]
    )
    ratio = F.try_divide(F.col("hyp_len"), F.col("ref_len"))
    beta = F.log(F.lit(0.5)) / F.pow(F.log(F.lit(1.5)), F.lit(2.0))
    penalty = F.when((ratio > 0) & (ratio < 1), F.exp(beta * F.pow(F.log(ratio), F.lit(2.0)))).otherwise(
        F.greatest(F.least(F.coalesce(ratio, F.lit(0.0)), F.lit(1.0)), F.lit(0.0))
    )
    return _scored(sums, keys, "nist", precision * penalty)


def ribes(examples: DataFrame, keys: list[str] = [], unit: str = "char") -> DataFrame:
    """Mean over examples of the rank correlation of word order, by the best reference of each."""
    examples = _grouped(examples, keys)
    extent = extent_of(examples)
    pairs = examples.select(GROUP, EXAMPLE, "predictions", F.explode("outputs").alias("outputs"))
    scored = sentence_ribes(pairs, unit, extent.tasks)
    if extent.references > 1:
        scored = scored.groupBy(GROUP, EXAMPLE).agg(F.max("ribes").alias("ribes"))
    return _scored(scored.groupBy(GROUP).agg(F.avg("ribes").alias("mean")), keys, "ribes", F.col("mean"))


Metric = Callable[..., DataFrame]
METRICS: dict[str, Metric] = {"bleu": bleu, "gleu": gleu, "chrf": chrf, "nist": nist, "ribes": ribes}


def get_metric(name: str) -> Metric:
    try:
        return METRICS[name.lower()]
    except KeyError:
        raise NotImplementedError(f"unknown metric {name}; known: {', '.join(METRICS)}") from None


def evaluate(
    examples: DataFrame, metrics: list[str] = ["bleu"], keys: list[str] = [], unit: str = "char"
) -> DataFrame:
    """Scores of every group for every metric, in long form. BLEU and GLEU share one pass over the n-grams."""
    chosen = [(name, get_metric(name)) for name in dict.fromkeys(m.lower() for m in metrics)]
    shared = {"bleu": _bleu_score, "gleu": _gleu_score}
    parts = []
    together = [name for name, metric in chosen if name in shared and metric in (bleu, gleu)]
    if len(together) > 1:
        grouped = _grouped(examples, keys)
        sums = _overlap_sums(grouped, extent_of(grouped), unit)
        pairs = F.array(
            *[F.struct(F.lit(n).alias("metric"), shared[n]().cast("double").alias("score")) for n in together]
        )
        parts.append(sums.select(*_keys_of(keys), F.inline(pairs)))
        chosen = [(name, metric) for name, metric in chosen if name not in together]
    parts += [metric(examples, keys, unit) for _, metric in chosen]
    return reduce(DataFrame.unionByName, parts)
