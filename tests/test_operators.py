import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from bitexture.functions import text as txt
from bitexture.functions.prompts import FixedPrompt, Template, TemplatePrompt
from bitexture.operators import batching, curate, perplexity, ranking, runlog, selection, stats
from bitexture.operators.generate import cut_prompt, echo_generator, echo_words, generate

rng = random.Random(3)
PROMPT = FixedPrompt({"hr": "H", "en": "E"}, "GO:")
PAIRS = "pair_id long, src_text string, trg_text string, bicleaner_ai_score double, bleualign_score double"


@pytest.fixture(scope="module")
def pairs(spark):
    rows = [(i, "w " * (i % 5), "v " * (i % 3), (i % 7) / 7, (i % 4) / 4) for i in range(60)]
    rows += [(60, None, "x", 1.0, 1.0), (61, "x", None, 1.0, 1.0), (62, "x", "y", None, 1.0)]
    return spark.createDataFrame(rows, PAIRS)


def brute_curation(rows, max_tokens, size):
    def hm(r):
        a, b = r.bicleaner_ai_score, r.bleualign_score
        return None if a is None or a + b == 0 else 2 * a * b / (a + b)

    ordered = sorted(rows, key=lambda r: (hm(r) is None, -(hm(r) or 0), r.pair_id))
    # Prompt words: instruction, two labels, both texts.
    kept = [r for r in ordered if r.src_text is not None and r.trg_text is not None]
    kept = [r.pair_id for r in kept if 3 + len(r.src_text.split()) + len(r.trg_text.split()) <= max_tokens]
    return kept[:size]


@pytest.mark.parametrize("size", [1, 10, 500])
@pytest.mark.parametrize("direct,saved", [(1000, False), (0, False), (0, True)])
def test_curation(pairs, monkeypatch, tmp_path, size, direct, saved):
    monkeypatch.setattr(selection, "DIRECT_TOP_K", direct)
    monkeypatch.setattr(curate, "DIRECT_TOP_K", direct)
    work_dir = str(tmp_path / "scores") if saved else None
    got = curate.curate_top(pairs, PROMPT, txt.count_words, max_tokens=7, size=size, work_dir=work_dir)
    assert sorted(r.pair_id for r in got.collect()) == sorted(brute_curation(pairs.collect(), 7, size))


def test_token_budget_keeps_the_limit_itself(spark):
    df = spark.createDataFrame([(1, "a b", "c"), (2, "a b", "c d")], "pair_id int, src_text string, trg_text string")
    kept = curate.within_budget(df, PROMPT, txt.count_words, 6, "hr", "en")
    assert [r.pair_id for r in kept.collect()] == [1] and kept.columns == df.columns


def test_clean_pairs(spark):
    rows = [(5, "a", "b"), (3, "a", "b"), (4, "ab", ""), (6, "a", None), (7, None, "b"), (8, "", "ab"), (9, "ab", "")]
    df = spark.createDataFrame(rows, "pair_id int, src_text string, trg_text string")
    assert sorted(r.pair_id for r in curate.clean_pairs(df).collect()) == [3, 4, 8]


def test_top_score_floor(pairs):
    scores = sorted((r.bleualign_score for r in pairs.collect()), reverse=True)
    assert curate.top_score_floor(pairs, "bleualign_score", 5).first().lowest_score == scores[4]


def test_expansion_and_training_texts(spark):
    df = spark.createDataFrame(
        [(1, "a", "b", "train"), (2, "c", "d", "test"), (3, "e", "f", "validation")],
        "pair_id int, src_text string, trg_text string, split string",
    )
    got = {(r.pair_id, r.direction): r.text for r in curate.expand_directions(df, PROMPT, "hr", "en").collect()}
    assert len(got) == 6 and got[1, "bwd"] == "GO: E: b H: a"
    texts = curate.training_texts(df, PROMPT, "hr", "en").collect()
    assert sorted((r.pair_id, r.split) for r in texts) == [(1, "train")] * 2 + [(3, "validation")] * 2


@pytest.mark.parametrize("numbered", [False, True])
@pytest.mark.parametrize("longest", [3, 9, 30])
def test_curation_widens_by_survivors(spark, monkeypatch, tmp_path, numbered, longest):
    """The same pairs as by counting all tokens, with the tokens of the best pairs counted only."""
    monkeypatch.setattr(curate, "DIRECT_PAIRS", 0)
    nan = float("nan")
    rows = [(i, "a " * (i * 7 % 10), "b", rng.choice([0.1, 0.5, 0.7, rng.random(), nan]), rng.choice([0.5, None, 0.9])) for i in range(400)]
    pairs = spark.createDataFrame(rows, "pair_id long, src_text string, trg_text string, bicleaner_ai_score double, bleualign_score double")
    prompt = TemplatePrompt({"hr": [Template.parse("x {input} y {output}"), Template.parse("x x x x x {input} {output}")], "en": [Template.parse("x {input} {output}")] * 2}) if numbered else PROMPT
    for size in (1, 7, 90, 1000):
        seen = []
        within = curate.within_budget
        monkeypatch.setattr(curate, "within_budget", lambda df, *args: seen.append(df.count()) or within(df, *args))
        args = (pairs, prompt, txt.count_words)
        got = curate.curate_top(*args, max_tokens=longest, size=size, work_dir=f"{tmp_path}/{size}")
        looked_at = sum(seen)
        want = curate.curate_top(*args, max_tokens=longest, size=size)
        assert sorted(r.pair_id for r in got.collect()) == sorted(r.pair_id for r in want.collect())
        assert sorted(got.columns) == sorted(want.columns)
        monkeypatch.setattr(curate, "within_budget", within)
        if size == 1 and longest == 30:
            assert looked_at < 200 and len(seen) >= 1


@pytest.mark.parametrize("histograms", [False, True])
def test_summary(spark, monkeypatch, histograms):
    if histograms:
        monkeypatch.setattr(selection, "DIRECT_ROWS", 4)
        monkeypatch.setattr(selection, "HISTOGRAM_BUCKETS", 8)
    values = [rng.gauss(0, 1) for _ in range(50)] + [0.25] * 30 + [1e6]
    df = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "x double")
    row = stats.summarize(df, "x").first()
    want = np.percentile(values, [25, 50, 75])
    assert [row.p25, row.p50, row.p75] == pytest.approx(list(want))
    assert (row.n, row.min, row.max) == (81, min(values), 1e6)
    assert row["mean"] == pytest.approx(np.mean(values)) and row["std"] == pytest.approx(statistics.stdev(values))
    rough = stats.summarize(df, "x", approximate=True).first()
    assert rough.p50 == pytest.approx(sorted(values)[40], abs=0.1)


def test_summary_of_nothing(spark):
    row = stats.summarize(spark.createDataFrame([], "x double"), "x").first()
    assert row.n == 0 and row.p50 is None and row["mean"] is None


def test_histogram(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 0, 1, 29.99, 30, 30]] + [(None,)], "x double")
    got = {r.bin: r.n for r in stats.histogram(df, "x").collect()}
    assert got == {**{i: 0 for i in range(30)}, 0: 2, 1: 1, 29: 3}
    flat = stats.histogram(spark.createDataFrame([(2.0,), (2.0,)], "x double"), "x", bins=3).orderBy("bin").collect()
    assert [r.n for r in flat] == [2, 0, 0]


@pytest.mark.parametrize("histograms", [False, True])
def test_infinite_values_in_statistics(spark, monkeypatch, histograms):
    if histograms:  # more rows than are listed directly
        monkeypatch.setattr(selection, "DIRECT_ROWS", 4)
        monkeypatch.setattr(selection, "HISTOGRAM_BUCKETS", 8)
    inf = float("inf")
    finite = [float(i) for i in range(40)]
    for ends in ([inf], [-inf], [inf] * 3 + [-inf] * 2, [inf] * 50):
        values = finite + ends
        df = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "x double")
        row = stats.summarize(df, "x").first()
        ordered = sorted(values)
        assert (row.n, row.min, row.max) == (len(values), ordered[0], ordered[-1])
        for p, got in zip((0.25, 0.5, 0.75), (row.p25, row.p50, row.p75)):
            spot = (len(values) - 1) * p
            a, b, share = ordered[math.floor(spot)], ordered[math.ceil(spot)], spot % 1
            assert got == (a if a == b or not share else pytest.approx(a * (1 - share) + b * share))
        bins = {r.bin: (r.low, r.n) for r in stats.histogram(df, "x", bins=4).collect()}
        want = {0: (0.0, 10), 1: (9.75, 10), 2: (19.5, 10), 3: (29.25, 10)}
        if -inf in ends:
            want[-1] = (-inf, ends.count(-inf))
        if inf in ends:
            want[4] = (inf, ends.count(inf))
        assert bins == want
        plain = stats.density(spark.createDataFrame([(v,) for v in finite], "x double"), "x").collect()
        got = [r.density for r in stats.density(df, "x").orderBy("point").collect()]
        assert got == pytest.approx([r.density for r in sorted(plain)])


def test_statistics_of_infinite_values_only(spark):
    df = spark.createDataFrame([(float("inf"),)] * 3, "x double")
    assert stats.summarize(df, "x").first().p50 == float("inf")
    assert {r.bin: r.n for r in stats.histogram(df, "x", bins=2).collect()} == {0: 0, 1: 0, 2: 3}
    with pytest.raises(ValueError, match="no spread"):
        stats.density(df, "x")


@pytest.mark.parametrize("nodes", [20, 500])
def test_density_stays_within_its_bound(spark, nodes):
    """Linear binning on a coarse grid differs from the sum over all values by the stated share of the peak."""
    values = [rng.choice([0.0, 1.0, rng.random()]) for _ in range(400)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    width = statistics.stdev(values) * len(values) ** -0.2
    scale = (max(values) - min(values)) / 30 / (width * math.sqrt(2 * math.pi))
    bound = ((max(values) - min(values)) / nodes / width) ** 2 / 8 * len(values) * scale
    for row in stats.density(df, "x", fine_bins=nodes).collect():
        want = scale * sum(math.exp(-0.5 * ((row.x - v) / width) ** 2) for v in values)
        assert abs(row.density - want) <= bound


def test_density(spark):
    values = [rng.gauss(5, 2) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = stats.density(df, "x").orderBy("point").collect()
    width = statistics.stdev(values) * len(values) ** -0.2
    scale = (max(values) - min(values)) / 30 / (width * math.sqrt(2 * math.pi))
    assert len(got) == 200 and got[0].x == min(values) and got[-1].x == pytest.approx(max(values))
    for row in got:
        want = scale * sum(math.exp(-0.5 * ((row.x - v) / width) ** 2) for v in values)
        assert row.density == pytest.approx(want, rel=1e-6, abs=1e-6 * scale)


def test_pair_lengths(spark):
    df = spark.createDataFrame([(1, "a b", "c"), (2, None, "c")], "pair_id int, src_text string, trg_text string")
    (row,) = stats.pair_lengths(df, PROMPT, txt.count_chars, "hr", "en").collect()
    forward, backward = "GO: H: a b E: c", "GO: E: c H: a b"
    assert (row.prompt_length, row.raw_length) == ((len(forward) + len(backward)) / 2, 4)


@pytest.mark.parametrize("n,batch", [(10, 4), (203, 2), (40, 1)])
def test_length_grouped_batches(spark, n, batch):
    lengths = {i: rng.randint(1, 30) for i in range(n)}
    df = spark.createDataFrame(list(lengths.items()), "id long, length int")
    got = batching.length_grouped_batches(df.repartition(6), "id", "length", batch, 9).collect()
    order = [r.id for r in ranking.seeded_shuffle(df, "id", 9).collect()]
    mega = max(min(n // (batch * 4), 50), 1) * batch
    megas = [sorted(order[i : i + mega], key=lambda x: -lengths[x]) for i in range(0, n, mega)]
    best = max(range(len(megas)), key=lambda m: lengths[megas[m][0]])
    megas[0][0], megas[best][0] = megas[best][0], megas[0][0]
    want = [x for m in megas for x in m]
    assert {r.id: (r.batch, r.slot) for r in got} == {x: (p // batch, p % batch) for p, x in enumerate(want)}


def losses(spark, runs, epoch_steps):
    rows = [
        (run, step // epoch_steps, step, step % epoch_steps, loss)
        for run, series in runs.items()
        for step, loss in enumerate(series)
    ]
    schema = "run_id string, epoch int, step long, step_in_epoch long, loss double"
    return spark.createDataFrame(rows, schema).repartition(5)


def brute_run(series, epoch_steps, width, accumulate):
    nan, window, smoothed, pending, steps = 0, [], {}, [], []
    for step, loss in enumerate(series):
        if math.isnan(loss):
            nan += 1
            if nan >= 3:
                break
            continue
        pending.append((step, loss))
        if (step % epoch_steps + 1) % accumulate == 0:
            steps.append(pending)
            pending = []
        window = [*window, loss][-width:]
        smoothed[step] = sum(window) / len(window)
    return smoothed, steps


def test_run_log_states(spark, monkeypatch):
    monkeypatch.setattr(runlog, "STEP_BLOCK", 16)
    nan = float("nan")
    runs = {"hot": [rng.random() for _ in range(400)], "short": [1.0, nan], "stop": [rng.random() for _ in range(90)]}
    runs["hot"][7] = runs["hot"][200] = nan
    runs["stop"][5] = runs["stop"][15] = runs["stop"][60] = nan
    log = losses(spark, runs, epoch_steps=30)
    got_smooth = {(r.run_id, r.step): r.smoothed for r in runlog.smoothed_loss(log, width=10).collect()}
    got_steps = {(r.run_id, r.optimizer_step): r for r in runlog.optimizer_steps(log).collect()}
    want_smooth, want_steps = {}, {}
    for run, series in runs.items():
        smoothed, steps = brute_run(series, 30, 10, 8)
        want_smooth |= {(run, s): pytest.approx(v) for s, v in smoothed.items()}
        want_steps |= {(run, i): s for i, s in enumerate(steps)}
    assert got_smooth == want_smooth
    assert got_steps.keys() == want_steps.keys()
    for key, micro in want_steps.items():
        row = got_steps[key]
        assert (row.first_step, row.last_step, row.n_micro) == (micro[0][0], micro[-1][0], len(micro))
        assert row.loss_sum == pytest.approx(sum(loss for _, loss in micro))


def test_nan_guard(spark):
    nan = float("nan")
    log = losses(spark, {"r": [1.0, nan, 2.0, nan, 3.0, nan, 4.0]}, 10)
    got = runlog.nan_guard(log).orderBy("step").collect()
    assert [(r.loss, r.nan_before) for r in got] == [(1.0, 0), (2.0, 1), (3.0, 2)]


def test_perplexity(spark):
    vocabulary, rows, nll = 6, [], []
    for seq in range(4):
        logits = [[rng.uniform(-900, 900) / 300 for _ in range(vocabulary)] for _ in range(seq + 1)]
        labels = [rng.choice([-100, *range(vocabulary)]) for _ in range(seq + 1)]
        rows.append((seq, logits, labels))
        for at, label in zip(logits, labels[1:]):
            if label != -100:
                nll.append(math.log(sum(math.exp(x) for x in at)) - at[label])
    nested = spark.createDataFrame(rows, "seq_id int, logits array<array<double>>, labels array<int>")
    flat = nested.select("seq_id", F.posexplode(F.arrays_zip("logits", "labels")).alias("pos", "s"))
    tokens = flat.select("seq_id", "pos", "s.logits", F.col("s.labels").alias("label")).repartition(3)
    want = math.exp(sum(nll) / len(nll))
    for got in (perplexity.perplexity(tokens).first(), perplexity.sequence_perplexity(nested).first()):
        assert (got.n_tokens, got.perplexity) == (len(nll), pytest.approx(want))


def test_large_logits_do_not_overflow(spark):
    row = spark.createDataFrame([([1e4, 0.0],)], "l array<double>").select(
        perplexity.negative_log_likelihood(F.col("l"), F.lit(1)).alias("x")
    )
    assert row.first().x == pytest.approx(1e4)


def test_generation_and_prefix(spark):
    df = spark.createDataFrame([(1, "say it"), (2, "")], "example_id int, inputs string")
    got = {r.example_id: r.generated for r in generate(df, echo_generator).collect()}
    assert got == {r.example_id: r.generated for r in generate(df, echo_words).collect()}
    assert got == {1: "say itit say", 2: ""}
    both = spark.createDataFrame([("abé", "abéxyz")], "p string, g string")
    assert both.select(cut_prompt(F.col("g"), F.col("p"), strict=True)).first()[0] == "xyz"
    assert both.select(cut_prompt(F.lit("12345"), F.col("p"))).first()[0] == "45"
    with pytest.raises(Exception, match="does not start"):
        both.select(cut_prompt(F.lit("12345"), F.col("p"), strict=True)).collect()
