"""Metrics against brute force from their published definitions, on small adversarial examples."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from bitexture.operators import metrics
from bitexture.operators.ribes import _chunked, batch_ribes, sentence_ribes

rng = random.Random(11)

CASES = [
    ("the cat sat", "the cat sat"),
    ("", "reference"),
    ("hypothesis", ""),
    ("", ""),
    ("ab", "abcdef"),
    ("aaaaaaaa", "aaab"),
    ("x", "y"),
    ("emoji \U0001F600 é {output}", "emoji \U0001F600 e {input}"),
    (" spaces  every where ", "spaces everywhere"),
    ("the the the cat", "the cat the mat"),
]
CASES += [
    ("".join(rng.choices("abc ", k=rng.randint(1, 40))), "".join(rng.choices("abc ", k=rng.randint(1, 40))))
    for _ in range(30)
]


def cut(text, unit):
    return list(text) if unit == "char" else text.split()


def grams(seq, n):
    return Counter(tuple(seq[i : i + n]) for i in range(len(seq) - n + 1))


def total(counter):
    return sum(counter.values())


def bleu(pairs):
    logs, hyp, ref = 0.0, sum(len(h) for h, _ in pairs), sum(len(r) for _, r in pairs)
    for n in range(1, 5):
        matched = sum(total(grams(h, n) & grams(r, n)) for h, r in pairs)
        if n == 1 and not matched:
            return 0.0
        logs += math.log(matched / sum(max(1, total(grams(h, n))) for h, _ in pairs) if matched else 2.2250738585072014e-308)
    return (1.0 if hyp > ref else math.exp(1 - ref / hyp)) * math.exp(logs / 4)


def gleu(pairs):
    def all_orders(seq):
        return sum((grams(seq, n) for n in range(1, 5)), Counter())

    matched = sum(total(all_orders(h) & all_orders(r)) for h, r in pairs)
    whole = sum(max(total(all_orders(h)), total(all_orders(r))) for h, r in pairs)
    return matched / whole if whole else 0.0


def chrf(pairs):
    scores = []
    for h, r in pairs:
        h, r = ("".join("".join(x).split()) for x in (h, r))
        for n in range(1, 7):
            m, a, b = total(grams(h, n) & grams(r, n)), total(grams(h, n)), total(grams(r, n))
            scores.append(10 * (m / a) * (m / b) / (9 * m / a + m / b) if m else 1e-16)
    return sum(scores) / len(scores)


def nist(pairs):
    seen = sum((grams(r, n) for _, r in pairs for n in range(1, 6)), Counter())
    hyp, ref = sum(len(h) for h, _ in pairs), sum(len(r) for _, r in pairs)

    def info(g):
        return math.log2((seen[g[:-1]] if len(g) > 1 else ref) / seen[g])

    score = 0.0
    for n in range(1, 6):
        gain = sum(info(g) * c for h, r in pairs for g, c in (grams(h, n) & grams(r, n)).items())
        count = sum(total(grams(h, n)) for h, _ in pairs)
        score += gain / count if count else 0.0
    x = hyp / ref
    penalty = math.exp(math.log(0.5) / math.log(1.5) ** 2 * math.log(x) ** 2) if 0 < x < 1 else max(min(x, 1.0), 0.0)
    return score * penalty


def places(seq, part):
    return [i for i in range(len(seq) - len(part) + 1) if seq[i : i + len(part)] == part]


def ribes_one(h, r):
    if not h:
        return 0.0
    order = []
    for i, unit in enumerate(h):
        if unit not in r:
            continue
        if h.count(unit) == r.count(unit) == 1:
            order.append(r.index(unit))
            continue
        for w in range(1, max(i, len(h) - i + 1)):
            right, left = h[i : i + w + 1], h[i - w : i + 1]
            if i + w < len(h) and len(places(h, right)) == len(places(r, right)) == 1:
                order.append(places(r, right)[0])
                break
            if w <= i and len(places(h, left)) == len(places(r, left)) == 1:
                order.append(places(r, left)[0] + w)
                break
    if len(order) < 2:
        return 0.0
    runs, size = [], 1
    for a, b in zip(order, order[1:]):
        if b == a + 1:
            size += 1
        else:
            runs.append(size)
            size = 1
    runs.append(size)
    tau = sum(s * (s - 1) / 2 for s in runs) / (len(order) * (len(order) - 1) / 2)
    return tau * (len(order) / len(h)) ** 0.25 * min(1.0, math.exp(1 - len(r) / len(h))) ** 0.10


def ribes(pairs):
    return sum(ribes_one(h, r) for h, r in pairs) / len(pairs)


BRUTE = {"bleu": bleu, "gleu": gleu, "chrf": chrf, "nist": nist, "ribes": ribes}


@pytest.fixture(scope="module")
def examples(spark):
    rows = [(i, "even" if i % 2 == 0 else None, h, r) for i, (h, r) in enumerate(CASES)]
    return spark.createDataFrame(rows, "example_id long, dataset string, predictions string, outputs string").cache()


@pytest.mark.parametrize("unit", ["char", "word"])
@pytest.mark.parametrize("name", list(BRUTE))
def test_against_brute_force(examples, name, unit):
    got = {r.dataset: r.score for r in metrics.get_metric(name)(examples, ["dataset"], unit).collect()}
    # chrF is defined on characters whatever the unit of the other metrics.
    size = "char" if name == "chrf" else unit
    pairs = [(cut(h, size), cut(r, size)) for h, r in CASES]
    assert got == {"even": pytest.approx(BRUTE[name](pairs[0::2])), None: pytest.approx(BRUTE[name](pairs[1::2]))}
    (whole,) = metrics.get_metric(name)(examples, unit=unit).collect()
    assert whole.score == pytest.approx(BRUTE[name](pairs)) and whole.metric == name


def test_identical_texts_score_one(spark):
    df = spark.createDataFrame([(1, "a whole sentence here", "a whole sentence here")], "example_id int, predictions string, outputs string")
    scores = {r.metric: r.score for r in metrics.evaluate(df, ["bleu", "gleu", "chrf", "ribes"]).collect()}
    assert scores == {m: pytest.approx(1.0) for m in ("bleu", "gleu", "chrf", "ribes")}


def test_same_result_under_any_partitioning(examples):
    one = metrics.nist(examples.coalesce(1), ["dataset"]).collect()
    many = metrics.nist(examples.repartition(13), ["dataset"]).collect()
    assert {r.dataset: pytest.approx(r.score) for r in one} == {r.dataset: r.score for r in many}


def test_dispatch(examples):
    got = metrics.evaluate(examples, ["BLEU", "gleu", "bleu"], ["dataset"]).collect()
    assert sorted((str(r.dataset), r.metric) for r in got) == [
        ("None", "bleu"),
        ("None", "gleu"),
        ("even", "bleu"),
        ("even", "gleu"),
    ]
    assert [r.metric for r in metrics.evaluate(examples).collect()] == ["bleu"]
    with pytest.raises(NotImplementedError, match="bleu, gleu"):
        metrics.get_metric("meteor")


def test_ngrams_take_one_shuffle(examples):
    """Text is partitioned by example once; counting its n-grams needs no exchange of its own."""
    from bitexture.operators.ngrams import example_matches, extent_of, reference_list

    listed = examples.withColumn("outputs", reference_list(examples, F.col("outputs")))
    matches = example_matches(listed, extent_of(listed), ["dataset"], 4)
    plan = matches._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_rank_correlation_of_many_random_texts():
    for alphabet in ("ab", "abcdefgh", "aé世\U0001F600 "):
        pairs = [
            ("".join(rng.choices(alphabet, k=rng.randint(0, 30))), "".join(rng.choices(alphabet, k=rng.randint(0, 30))))
            for _ in range(150)
        ]
        pairs += [(t, t) for t, _ in pairs[:10]] + [(h, h[5:] + h[:5]) for h, _ in pairs[:20]]
        got = batch_ribes([h for h, _ in pairs], [r for _, r in pairs])
        want = [ribes_one(list(h), list(r)) for h, r in pairs]
        assert got == pytest.approx(want)
        assert _chunked([h for h, _ in pairs], [r for _, r in pairs], "char", 50) == pytest.approx(want)


def test_rank_correlation_of_empty_input(spark):
    df = spark.createDataFrame([], "example_id int, predictions string, outputs string")
    assert sentence_ribes(df).count() == 0
    df = spark.createDataFrame([(1, None, "x")], "example_id int, predictions string, outputs string")
    assert sentence_ribes(df).first().ribes == 0.0


# Several references

MANY = [(h, [r, *extra]) for (h, r), extra in zip(CASES, ([], ["the cat"], ["", "ab"], [CASES[0][0], "x y z", "aaab"]) * 20)]


def clipped(h, refs, n):
    most = Counter()
    for r in refs:
        most |= grams(r, n)
    return total(grams(h, n) & most)


def many_bleu(pairs):
    hyp = sum(len(h) for h, _ in pairs)
    ref = sum(min((abs(len(r) - len(h)), len(r)) for r in refs)[1] for h, refs in pairs)
    logs = 0.0
    for n in range(1, 5):
        matched = sum(clipped(h, refs, n) for h, refs in pairs)
        if n == 1 and not matched:
            return 0.0
        logs += math.log(matched / sum(max(1, total(grams(h, n))) for h, _ in pairs) if matched else 2.2250738585072014e-308)
    return (1.0 if hyp > ref else math.exp(1 - ref / hyp)) * math.exp(logs / 4)


def many_gleu(pairs):
    matched = whole = 0
    for h, refs in pairs:
        options = []
        for r in refs:
            both = [(grams(h, n), grams(r, n)) for n in range(1, 5)]
            size = max(sum(total(a) for a, _ in both), sum(total(b) for _, b in both))
            if size:
                options.append((sum(total(a & b) for a, b in both), size))
        if options:
            m, size = max(options, key=lambda o: o[0] / o[1])
            matched, whole = matched + m, whole + size
    return matched / whole


def many_nist(pairs):
    seen = sum((grams(r, n) for _, refs in pairs for r in refs for n in range(1, 6)), Counter())
    units = sum(len(r) for _, refs in pairs for r in refs)
    score, hyp, ref = 0.0, 0, 0
    for n in range(1, 6):
        gain = count = 0
        for h, refs in pairs:
            info = lambda g: math.log2((seen[g[:-1]] if len(g) > 1 else units) / seen[g])
            gains = [(sum(info(g) * c for g, c in (grams(h, n) & grams(r, n)).items()), len(r)) for r in refs]
            best = max((round(g, 6), size, g) for g, size in gains)
            gain, ref, hyp = gain + best[2], ref + best[1], hyp + len(h)
            count += total(grams(h, n))
        score += gain / count if count else 0.0
    x = hyp / ref
    return score * (math.exp(math.log(0.5) / math.log(1.5) ** 2 * math.log(x) ** 2) if 0 < x < 1 else max(min(x, 1.0), 0.0))


MANY_BRUTE = {
    "bleu": many_bleu,
    "gleu": many_gleu,
    "nist": many_nist,
    "chrf": lambda pairs: sum(max(chrf([(h, r)]) for r in refs) for h, refs in pairs) / len(pairs),
    "ribes": lambda pairs: sum(max(ribes_one(h, r) for r in refs) for h, refs in pairs) / len(pairs),
}


@pytest.mark.parametrize("unit", ["char", "word"])
def test_lists_of_references(spark, unit):
    rows = [(i, h, refs) for i, (h, refs) in enumerate(MANY)]
    df = spark.createDataFrame(rows, "example_id long, predictions string, outputs array<string>")
    got = {r.metric: r.score for r in metrics.evaluate(df, list(MANY_BRUTE), unit=unit).collect()}
    for name, brute in MANY_BRUTE.items():
        size = "char" if name == "chrf" else unit
        assert got[name] == pytest.approx(brute([(cut(h, size), [cut(r, size) for r in refs]) for h, refs in MANY])), name


def test_lists_of_one_and_missing_references(spark):
    texts = [(1, "a b", ["a c"]), (2, "a", None), (3, "b", []), (4, "c d", [None]), (5, None, ["x"])]
    single = [(i, h, r[0] if r else None) for i, h, r in texts]
    lists = spark.createDataFrame(texts, "example_id long, predictions string, outputs array<string>")
    plain = spark.createDataFrame(single, "example_id long, predictions string, outputs string")
    names = list(MANY_BRUTE)
    assert metrics.evaluate(lists, names).collect() == metrics.evaluate(plain, names).collect()


@pytest.mark.parametrize("unit", ["char", "word"])
def test_long_examples_in_pieces(spark, examples, monkeypatch, unit):
    """Texts beyond the bound are cut, and every score stays what it was."""
    from bitexture.operators import ngrams

    names = ["bleu", "gleu", "chrf", "nist"]
    want = {(r.dataset, r.metric): r.score for r in metrics.evaluate(examples, names, ["dataset"], unit).collect()}
    monkeypatch.setattr(ngrams, "LONG_TEXT", 12)
    monkeypatch.setattr(ngrams, "PIECE_UNITS", 5)
    got = {(r.dataset, r.metric): r.score for r in metrics.evaluate(examples, names, ["dataset"], unit).collect()}
    assert got == {k: pytest.approx(v) for k, v in want.items()}


def test_one_long_example_is_spread(spark):
    """The pieces of one example lie in many partitions, sized by bytes."""
    from bitexture.operators import ngrams

    text = " ".join(f"w{i % 977}" for i in range(700_000))
    df = spark.createDataFrame([(1, text, text[:-9] + "x")], "example_id long, predictions string, outputs string")
    df = metrics._grouped(df, [])
    extent = ngrams.extent_of(df)
    assert extent.has_long and extent.tasks == -(-extent.size // ngrams.TASK_BYTES) > 6
    sides = df.select("example_id", F.lit(0).alias("side"), F.col("predictions").alias("text"))
    pieces = ngrams._pieces(sides, 4, "char").repartition(extent.tasks, "example_id", "side", "piece")
    per_task = [r.n for r in pieces.groupBy(F.spark_partition_id()).agg(F.sum(F.length("text")).alias("n")).collect()]
    assert len(per_task) >= 4 and max(per_task) < len(text)


def test_prefix_counts_follow_sort_order(spark):
    """Weights of words that hold characters below the separator, over many range partitions."""
    texts = ["a b", "a\x01 b", "a!b c", "a b c", "ab a b", "a"] * 3
    df = spark.createDataFrame([(i, t, t) for i, t in enumerate(texts)], "example_id long, predictions string, outputs string")
    want = nist([(t.split(), t.split()) for t in texts])
    assert metrics.nist(df, unit="word").first().score == pytest.approx(want)


@pytest.mark.parametrize("unit", ["char", "word"])
def test_ngrams_of_an_example_are_counted_in_its_batch(spark, monkeypatch, unit):
    """No row per occurrence for examples of bounded length; examples are dealt to chunks of a few units."""
    from bitexture.operators import batch_ngrams, ngrams

    rows = [(i, h, refs) for i, (h, refs) in enumerate(MANY)]
    df = spark.createDataFrame(rows, "example_id long, predictions string, outputs array<string>")
    names = ["bleu", "gleu", "chrf", "nist"]

    def no_rows(*_):
        raise AssertionError("one row per occurrence")

    monkeypatch.setattr(ngrams, "_occurrences", no_rows)
    monkeypatch.setattr(batch_ngrams, "UNITS_A_CHUNK", 60)
    got = {r.metric: r.score for r in metrics.evaluate(df.coalesce(2), names, unit=unit).collect()}
    for name in names:
        size = "char" if name == "chrf" else unit
        pairs = [(cut(h, size), [cut(r, size) for r in refs]) for h, refs in MANY]
        assert got[name] == pytest.approx(MANY_BRUTE[name](pairs)), name


def test_rows_that_share_an_id_are_one_example(spark):
    """Their n-grams are counted together, beside examples of their own; a missing id is an id."""
    from bitexture.operators.ngrams import example_matches, extent_of

    rows = [(1, "g", "abab", ["ab"]), (1, "g", "ab", ["abab", "b"]), (1, "h", "a", ["a"]), (None, "g", "b", ["b"]), (None, "g", "", ["b"])]
    df = spark.createDataFrame(rows, "example_id long, dataset string, predictions string, outputs array<string>")
    extent = extent_of(df)
    assert extent.repeated and not extent_of(df.where("dataset = 'h'")).repeated
    got = {(r.example_id, r.dataset): (r.m1, r.m2, r.m1_0, r.m1_1) for r in example_matches(df, extent, ["dataset"], 2).collect()}
    assert got == {(1, "g"): (6, 4, 6, 1), (1, "h"): (1, 0, 1, 0), (None, "g"): (1, 0, 1, 0)}


def test_any_integer_keys_are_numbered_in_order():
    import numpy as np

    from bitexture.operators.batch_ngrams import numbered

    for bound in (1, 7, 1 << 40, (1 << 63) - 1):
        keys = np.array([rng.randrange(min(bound, 1 << 62)) for _ in range(50)] * 2, np.int64)
        number, count = numbered(keys, bound)
        order = {k: i for i, k in enumerate(sorted({*keys.tolist()}))}
        assert count == len(order) and number.tolist() == [order[k] for k in keys.tolist()]
    assert numbered(np.empty(0, np.int64), 0)[1] == 0
