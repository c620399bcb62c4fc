"""Quality rules and a hashed n-gram likelihood ratio, in DataFrame functions alone.

The ratio compares a multinomial of trusted documents with one of the whole corpus. Its symbols are words reduced to
their shape: runs of small letters, capitals and digits shrink, punctuation stays. Few shapes mean that counts
stay sharp at any size of the corpus. Every word gives one bigram with the shape before it, and the sum of log ratios is
divided by the number of words, so that long and short documents meet the same threshold.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bitexture.llm.common import staged

BLANK = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
NOT_SYMBOL = r"[^#*$%&|<>]+"
WINDOW = 5
LEAST_WORDS = 10
REPEAT_PERCENT = 20
BUCKETS = 4096
SMOOTHING = 0.5
RATIO_PLACES = 6
CELLS = 100  # cells of scores per unit of the log ratio
LOSS_WEIGHT = 10  # a share of good documents lost counts as much as ten times that share of bad ones passed
RULES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

# What a run of characters shrinks to, in this order.
SHAPES = [(r"\p{Ll}+", "a"), (r"\p{Lu}\p{Lu}+", "AA"), (r"\p{Lu}", "A"), (r"\p{Nd}+", "0")]


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def shape_words(text: Column) -> Column:
    for pattern, short in SHAPES:
        text = F.regexp_replace(text, pattern, short)
    return words_of(text)


def twins(marked: str) -> Column:
    """Starts of windows that occur twice or more, in order; ``marked`` has sorted (hash, start) pairs."""
    start = F.transform(
        marked,
        lambda x, j: F.when((x["h"] == F.get(marked, j - 1)["h"]) | (x["h"] == F.get(marked, j + 1)["h"]), x["i"]),
    )
    return F.sort_array(F.filter(start, lambda i: i.isNotNull()))


def covered_words(starts: str) -> Column:
    """How many words lie in the windows at these starts."""
    none = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    step = lambda acc, p: F.struct(
        (p + WINDOW).alias("end"), (acc["n"] + p + WINDOW - F.greatest(p, acc["end"])).alias("n")
    )
    return F.aggregate(starts, none, step, lambda acc: acc["n"])


def with_rules(df: DataFrame, text: str) -> DataFrame:
    """Add the columns in ``RULES``; ``text`` must not be missing."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    df = df.withColumns({"_words": words_of(F.col(text)), "_lines": lines})
    at = lambda i: F.get("_words", i)
    windows = F.transform(F.sequence(F.lit(0), F.size("_words") - WINDOW), lambda i: F.xxhash64(*(at(i + j) for j in range(WINDOW))))
    df = df.withColumn("_windows", F.when(F.size("_words") >= WINDOW, windows))
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    marked = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # Lambdas refer to columns of an earlier step only: an expression inside one would be computed for every element.
    df = df.withColumn("_marked", F.when(repeats, marked)).withColumn("_starts", twins("_marked"))
    df = df.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": F.length(F.regexp_replace(text, NOT_SYMBOL, "")).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": F.coalesce(covered_words("_starts"), F.lit(0)).cast("long"),
        }
    )
    return df.drop("_words", "_lines", "_windows", "_marked", "_starts")


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def bigram_bucket(shapes: str, i: Column) -> Column:
    """Bucket of a word's shape and the one before it; the first word follows nothing."""
    return F.pmod(F.xxhash64(F.coalesce(F.get(shapes, i - 1), F.lit("")), F.get(shapes, i)), F.lit(BUCKETS)).cast("int")


def _places(shapes: str) -> Column:
    return F.when(F.size(shapes) > 0, F.sequence(F.lit(0), F.size(shapes) - 1)).otherwise(F.array().cast("array<int>"))


def shape_buckets(shapes: str) -> Column:
    """The buckets of all words, in order; a bucket fits two bytes."""
    return F.transform(_places(shapes), lambda i: bigram_bucket(shapes, i).cast("smallint"))


def fit_log_ratios(bucketed: DataFrame, trusted: DataFrame) -> list[float]:
    """Per bucket the log of its share in trusted documents over its share in the corpus.

    Counts cover all of ``bucketed (doc, buckets)``, and all of them that are in ``trusted (doc)``, distinct ids. Buckets meet the ids,
    not texts, and by the same plan at every size. The driver gets one row per bucket and count.
    """

    def counts(rows: DataFrame) -> dict[int, int]:
        found = rows.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))
        return {row.bucket: row.n for row in found.collect()}

    raw, target = counts(bucketed), counts(bucketed.join(trusted.hint("merge"), "doc"))
    if not target:
        return [0.0] * BUCKETS
    raw, target = ([SMOOTHING + n.get(bucket, 0) for bucket in range(BUCKETS)] for n in (raw, target))
    shift = math.log(sum(raw)) - math.log(sum(target))
    return [round(math.log(t / r) + shift, 4) for t, r in zip(target, raw)]


def mean_ratio(buckets: str, log_ratios: list[float]) -> Column:
    """Sum of the log ratios of all bigrams over their number; 0 without words."""
    weights = F.split(F.lit(",".join(map(str, log_ratios))), ",").cast("array<double>")
    total = F.aggregate(buckets, F.lit(0.0), lambda acc, bucket: acc + F.get(weights, bucket.cast("int")))
    return F.when(F.size(buckets) > 0, F.round(total / F.size(buckets), RATIO_PLACES)).otherwise(F.lit(0.0))


def threshold_between(labelled: DataFrame) -> float:
    """The cut with the lowest weighted sum of error rates, in the middle of the widest gap that has it.

    ``labelled (log_ratio, good)`` is of any size. Equal scores are counted together. How many documents lie below a score comes
    from the totals of the cells before it and a window inside its cell, which has few scores, as scores have six places.
    """
    counts = labelled.groupBy("log_ratio").agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    scores = staged(counts.withColumn("cell", F.floor(F.col("log_ratio") * CELLS)), "scores")
    total = scores.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).first()
    if not total.good or not total.bad:
        return -math.inf
    cells = scores.groupBy("cell").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"), F.max("log_ratio").alias("last"))
    lower = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)  # one row per cell
    before = cells.select(
        "cell", *(F.sum(n).over(lower).alias(f"{n}_before") for n in ("good", "bad")), F.max("last").over(lower).alias("last_before")
    )
    inside = Window.partitionBy("cell").orderBy("log_ratio")

    def below(n: str) -> Column:
        here = F.sum(n).over(inside.rowsBetween(Window.unboundedPreceding, -1))
        return F.coalesce(f"{n}_before", F.lit(0)) + F.coalesce(here, F.lit(0))

    high = F.col("log_ratio")
    low = F.coalesce(F.lag("log_ratio").over(inside), "last_before", high)
    placed = scores.join(F.broadcast(before), "cell").select(
        below("good").alias("lost"), below("bad").alias("stopped"), low.alias("low"), high.alias("high")
    )
    error = LOSS_WEIGHT * F.col("lost") / F.lit(total.good) + 1 - F.col("stopped") / F.lit(total.bad)
    best = placed.agg(F.min(F.struct(error.alias("error"), (F.col("low") - F.col("high")).alias("gap"), "low", "high")).alias("best"))
    cut = best.first().best
    return (cut.low + cut.high) / 2


def quality_verdicts(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    quality_col: str = "quality",
) -> DataFrame:
    """One row per input row: id, the columns in ``RULES``, ``base_failed``, ``kept``, ``log_ratio``.

    ``kept`` is false for documents that fail the rules, else whether the mean log ratio reaches the threshold, which
    separates the labelled good from the labelled bad documents best. All labelled documents take part in fitting, however
    many; a document with any bad label is bad. Without labels of both kinds the ratio rejects none.

    A missing text has no words and fails. Rows that repeat an id are judged by their own text, a missing id has no
    label. Equal texts get equal verdicts. Other columns play no part. An empty table gives an empty table.
    """
    worst = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("doc")).agg(F.min(quality_col).alias("quality"))
    known = staged(worst.where("quality is not null").select("doc", (F.col("quality") >= 1).alias("good")), "labelled")
    texts = docs.select(F.col(id_col).alias("doc"), F.coalesce(text_col, F.lit("")).alias("text"))
    shaped = with_rules(texts, "text").withColumn("shapes", shape_words(F.col("text")))
    shaped = shaped.select("doc", *RULES, base_failed().alias("base_failed"), shape_buckets("shapes").alias("buckets"))
    shaped = staged(shaped, "shaped")  # texts are read once, what follows needs their buckets only
    log_ratios = fit_log_ratios(shaped.select("doc", "buckets"), known.where("good").select("doc"))

    judged = shaped.withColumn("log_ratio", mean_ratio("buckets", log_ratios)).drop("buckets")
    judged = staged(judged, "judged")
    passing = judged.where("not base_failed").select("doc", "log_ratio")
    cut = threshold_between(passing.join(known, "doc").select("log_ratio", "good"))
    kept = ~F.col("base_failed") & (F.col("log_ratio") >= F.lit(cut))
    return judged.select(F.col("doc").alias(id_col), *RULES, "base_failed", kept.alias("kept"), "log_ratio")
