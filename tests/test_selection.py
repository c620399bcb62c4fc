import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from bitexture.functions.hashing import seeded_hash
from bitexture.operators import ranking, selection, splits

rng = random.Random(5)


def skewed_values(n):
    """A third of the rows share one value, some lie far out, the rest crowd together."""
    values = [0.5] * (n // 3) + [1e12, -1e9] + [rng.random() / 1000 for _ in range(n - n // 3 - 2)]
    rng.shuffle(values)
    return values


@pytest.fixture(params=["direct", "histograms"])
def route(request, monkeypatch):
    """The same results whether a range is small enough to list or has to be narrowed by histograms."""
    if request.param == "histograms":
        monkeypatch.setattr(selection, "DIRECT_ROWS", 5)
        monkeypatch.setattr(selection, "HISTOGRAM_BUCKETS", 16)


@pytest.mark.parametrize("descending", [False, True])
def test_values_at(spark, route, descending):
    values = skewed_values(300)
    df = spark.createDataFrame([(v,) for v in values], "x double")
    ordered = sorted(values, reverse=descending)
    ranks = [1, 2, 99, 100, 150, 299, 300]
    found = selection.values_at(df, [*ranks, 0, 301], descending=descending)
    assert [f.value for f in found[:-2]] == [ordered[r - 1] for r in ranks]
    assert all(f.before == ordered.index(f.value) and f.n == values.count(f.value) for f in found[:-2])
    assert found[-2:] == [None, None]


def test_values_at_of_nothing(spark):
    assert selection.values_at(spark.createDataFrame([], "x double"), [1]) == [None]


@pytest.mark.parametrize("k", [1, 50, 100, 150, 299, 300, 400])
def test_top_k_by_cut_equals_sort(spark, route, monkeypatch, k):
    monkeypatch.setattr(selection, "DIRECT_TOP_K", 0)
    rows = [(i, v if i % 10 else None) for i, v in enumerate(skewed_values(300))]
    df = spark.createDataFrame(rows, "id long, s double")
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))[:k]
    got = selection.top_k(df, "s", "id", k).collect()
    assert sorted(tuple(r) for r in got) == sorted(want, key=lambda r: r[0])


def test_top_k_needs_a_size(spark):
    with pytest.raises(ValueError):
        selection.top_k(spark.range(3), "id", "id", 0)


def shuffled_ids(spark, n, seed):
    return [r.id for r in ranking.seeded_shuffle(spark.range(n), "id", seed).collect()]


def test_positions_follow_the_shuffle(spark):
    want = shuffled_ids(spark, 500, 3)
    got = ranking.shuffled_position(spark.range(500).repartition(7), "id", 3).orderBy("position").collect()
    assert [r.id for r in got] == want and [r.position for r in got] == list(range(500))


def test_id_positions(spark):
    ids = sorted(rng.sample(range(-(10**12), 10**12), 400)) + [10**15]
    df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(5)
    got = ranking.id_position(df, "id").orderBy("position").collect()
    assert [r.id for r in got] == ids and [r.position for r in got] == list(range(401))


@pytest.mark.parametrize("n", [0, 1, 3, 7, 101])
def test_three_way_split(spark, route, n):
    want = shuffled_ids(spark, n, 7812)
    got = {r.id: r.split for r in splits.split_three_way(spark.range(n), "id").collect()}
    a, b = int(n * 0.7), int(n * 0.7) + int(n * 0.15)
    expected = {i: "train" if p < a else "test" if p < b else "validation" for p, i in enumerate(want)}
    assert got == expected


def test_split_does_not_depend_on_partitioning(spark):
    df = spark.range(200)
    one = splits.split_three_way(df.coalesce(1), "id").orderBy("id").collect()
    many = splits.split_three_way(df.repartition(50), "id").orderBy("id").collect()
    assert one == many


def test_split_with_equal_hashes(spark, monkeypatch):
    """Rows with the same hash are divided by id."""
    monkeypatch.setattr(selection, "seeded_hash", lambda key, seed: F.lit(7).cast("bigint"))
    got = {r.id: r.split for r in splits.split_three_way(spark.range(20), "id", 0.5, 0.25, 0.25).collect()}
    assert [got[i] for i in range(20)] == ["train"] * 10 + ["test"] * 5 + ["validation"] * 5


def test_split_rejects_bad_ratios(spark):
    with pytest.raises(ValueError):
        splits.split_three_way(spark.range(3), "id", 0.7, 0.2, 0.2)


def test_two_way_split_rounds_test_up(spark):
    counts = splits.split_two_way(spark.range(101), "id", seed=1).groupBy("split").count().collect()
    assert {r.split: r["count"] for r in counts} == {"test": 11, "train": 90}


def test_subsample(spark):
    assert [r.id for r in splits.seeded_subsample(spark.range(50), "id", 8, 4).orderBy("id").collect()] == sorted(
        shuffled_ids(spark, 50, 4)[:8]
    )
    assert splits.seeded_subsample(spark.range(50), "id", None, 4).count() == 50
    assert splits.seeded_subsample(spark.range(50), "id", 60, 4).count() == 50


def test_limit_examples(spark, monkeypatch):
    df = spark.range(30).repartition(4)
    assert [r.id for r in splits.limit_examples(df, "id", 3).orderBy("id").collect()] == [0, 1, 2]
    assert splits.limit_examples(df, "id", -1).count() == 30
    assert splits.limit_examples(df, "id", None, default=10).count() == 10
    monkeypatch.setattr(splits, "DIRECT_TOP_K", 2)
    assert [r.id for r in splits.limit_examples(df, "id", 5).orderBy("id").collect()] == [0, 1, 2, 3, 4]
    assert splits.limit_examples(df, "id", 99).count() == 30


def test_stratified_split_with_a_hot_label(spark):
    df = spark.range(400).withColumn("label", F.when(F.col("id") < 300, "hot").when(F.col("id") < 399, "b").otherwise("one"))
    got = splits.resplit_stratified(df, "id")
    counts = {(r.label, r.split): r["count"] for r in got.groupBy("label", "split").count().collect()}
    assert counts == {
        ("hot", "train"): 210,
        ("hot", "test"): 45,
        ("hot", "validation"): 45,
        ("b", "train"): 69,
        ("b", "test"): 14,
        ("b", "validation"): 16,
        ("one", "train"): 1,
    }


@pytest.mark.parametrize("bits,rows", [(3, 1 << 16), (3, 2), (20, 1)])
@pytest.mark.parametrize("ratios", [(0.7, 0.15), (0.2, 0.1), (0.0, 0.5)])
def test_stratified_split_follows_the_shuffle(spark, monkeypatch, ratios, bits, rows):
    monkeypatch.setattr(splits, "PREFIX_BITS", bits)
    monkeypatch.setattr(splits, "CUT_ROWS", rows)
    df = spark.range(150).withColumn("label", F.expr("case when id % 7 = 0 then null when id < 4 then 1 else 2 end"))
    got = {r.id: r.split for r in splits.resplit_stratified(df.repartition(5), "id", "label", *ratios).collect()}
    labels = {r.id: r.label for r in df.collect()}
    for label in (None, 1, 2):
        ids = [i for i in shuffled_ids(spark, 150, 42) if labels[i] == label]
        a, b = int(len(ids) * ratios[0]), int(len(ids) * ratios[0]) + int(len(ids) * ratios[1])
        for p, i in enumerate(ids):
            assert got[i] == ("train" if p < a or len(ids) < 2 else "test" if p < b else "validation")
    assert len(got) == 150


def test_stratified_split_of_one_large_label(spark, monkeypatch):
    """However large the label, what is ranked by a window is a bucket of at most ``CUT_ROWS`` rows."""
    sizes = []
    monkeypatch.setattr(splits, "PREFIX_BITS", 4)
    monkeypatch.setattr(splits, "CUT_ROWS", 50)
    inside = splits._inside
    monkeypatch.setattr(splits, "_inside", lambda *args: sizes.append(inside(*args)) or sizes[-1])
    df = spark.range(200_000).withColumn("label", F.when(F.col("id") % 1000 == 0, "rare").otherwise("hot"))
    got = splits.resplit_stratified(df, "id")
    order = Window.partitionBy("label").orderBy(seeded_hash("id", 42), "id")
    n = F.count("*").over(Window.partitionBy("label"))
    ranked = df.withColumns({"rank": F.row_number().over(order), "n": n})
    a, b = F.floor(F.col("n") * F.lit(0.7)), F.floor(F.col("n") * F.lit(0.15))
    want = F.when(F.col("rank") <= a, "train").when(F.col("rank") <= a + b, "test").otherwise("validation")
    assert got.join(ranked.select("id", want.alias("want")), "id").where("split <> want").count() == 0
    assert len(sizes) > 2
    assert sizes[-1].groupBy("label", "base").count().agg(F.max("count")).first()[0] <= 50


def test_stratified_split_of_equal_hashes(spark, monkeypatch):
    monkeypatch.setattr(splits, "seeded_hash", lambda key, seed: F.col(key) % 2)
    monkeypatch.setattr(splits, "CUT_ROWS", 5)
    got = splits.resplit_stratified(spark.range(40).withColumn("label", F.lit(1)), "id").collect()
    ordered = sorted(got, key=lambda r: (r.id % 2, r.id))
    assert [r.split for r in ordered] == ["train"] * 28 + ["test"] * 6 + ["validation"] * 6


def test_counts_and_classes(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("a", None), ("b", 1)], "split string, label int")
    assert {r.split: r.n for r in splits.split_counts(df).collect()} == {"a": 3, "b": 1, "all": 4}
    got = {(r.split, r.label): r.share for r in splits.class_distribution(df).collect()}
    assert got == {("a", 1): 0.5, ("a", 0): 0.5, ("b", 1): 1.0}


def test_concat_splits(spark):
    merged = splits.concat_splits({"x": spark.range(2), "y": spark.range(3)})
    assert {r.split: r["count"] for r in merged.groupBy("split").count().collect()} == {"x": 2, "y": 3}


@pytest.mark.parametrize("descending", [True, False])
def test_infinite_and_missing_values_beyond_the_direct_bound(spark, monkeypatch, descending):
    monkeypatch.setattr(selection, "DIRECT_ROWS", 5)
    inf, nan = float("inf"), float("nan")
    numbers = [float(i) for i in range(40)] + [inf, inf, -inf, 1e308, -1e308]
    df = spark.createDataFrame([(x,) for x in numbers + [nan, None]], "v double")
    ordered = sorted(numbers, reverse=descending)
    ranks = [1, 2, 3, 20, 44, 45, 46]
    got = selection.values_at(df, ranks, descending=descending)
    assert [g and g.value for g in got] == [ordered[r - 1] if r <= 45 else None for r in ranks]


def test_top_k_is_the_same_by_heap_and_by_cut(spark):
    nan, inf = float("nan"), float("inf")
    scores = [1.0, nan, None, 3.0, 3.0, inf, -inf, nan, 2.0, 3.0, None]
    df = spark.createDataFrame(list(enumerate(scores)), "id int, s double")
    for k in range(1, 13):
        one, other = ([r.id for r in selection.top_k(df, "s", "id", k, heap).collect()] for heap in (1000, 0))
        assert sorted(one) == sorted(other) and len(one) == min(k, 11)
    assert one[:8] == [5, 3, 4, 9, 8, 0, 6, 1]


def test_positions_of_a_dense_cluster_beside_an_outlier(spark, monkeypatch):
    monkeypatch.setattr(ranking, "BUCKET_ROWS", 16)
    ids = list(range(1000, 1300)) + [10**15]
    df = spark.createDataFrame([(i,) for i in rng.sample(ids, len(ids))], "id long")
    got = {r.id: r.position for r in ranking.id_position(df, "id").collect()}
    assert got == {i: n for n, i in enumerate(ids)}
