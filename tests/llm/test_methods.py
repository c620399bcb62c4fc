"""The operators beside brute-force versions, round trips and held-out accuracy."""

import hashlib
import math
import random
import re
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from bitexture.llm import importance, mixing, passage_dedup, piece_sampling, quality_rules, token_store, topk_search
from bitexture.llm.html_extract import count_labelled, TreeModel, extract_main_text
from bitexture.llm.license_rules import signature_rules
from bitexture.llm.license_scan import BASE, gate, scan_licenses
from bitexture.llm.line_dedup import dedupe_lines
from bitexture.llm.minhash_dedup import bands_for, estimate, lowest_estimate, near_duplicates
from bitexture.llm.passage_dedup import dedupe_passages
from bitexture.llm.quality_rules import quality_verdicts
from bitexture.llm.suffix_array import later_copies, sorted_groups

SMALL = "/root/testdata/sf0.001"


def frame(spark, rows, shape="doc_id long, text string"):
    return spark.createDataFrame(rows, shape).repartition(3)


def words(rng, n, size=400):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def shingles(text):
    found = text.encode().lower().split()
    return {tuple(found[i : i + 5]) for i in range(max(len(found) - 4, 1))} if found else set()


def components(texts, percent):
    sets, parent = {i: shingles(t) for i, t in texts}, {i: i for i, _ in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sorted(sets):
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for i, s in sets.items()}


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_of_a_continuum(spark, percent):
    """One large group of copies with few to many edits, so that links between the copies decide the components."""
    rng = random.Random(percent)
    base, texts = words(rng, 120), []
    for i in range(260):
        copy = list(base)
        for _ in range(rng.choice([0, 0, 1, 2, 3, 4, 6, 9])):
            copy[rng.randrange(len(copy))] = f"edit{rng.randrange(10**6)}"
        texts.append((i, " ".join(copy)))
    texts += [(1000 + i, " ".join(words(rng, 60))) for i in range(40)]
    rng.shuffle(texts)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(frame(spark, texts), percent=percent).collect()}
    assert got == components(texts, percent)


def test_estimate_and_bands():
    assert (1 - 0.85**4) ** bands_for(0.85) <= 1e-8
    assert estimate(0, 192) == 1.0 and abs(estimate(144, 192)) < 1e-9
    assert 0.6 < lowest_estimate(0.85, 192) < 0.75


def repeated(texts, least):
    """Lines to delete by definition: in a run of at least ``least`` words that occurs at an earlier place."""
    docs = {i: [x for x in t.split("\n") if x.split()] for i, t in texts}
    places = defaultdict(list)
    for i in sorted(docs):
        for a in range(len(docs[i])):
            for b in range(a, len(docs[i])):
                run = tuple(docs[i][a : b + 1])
                if sum(len(x.split()) for x in run) >= least:
                    places[run].append((i, a, b))
    return {(i, k) for copies in places.values() for i, a, b in sorted(copies)[1:] for k in range(a, b + 1)}


def test_line_runs_against_the_definition(spark):
    rng = random.Random(4)
    lines = [" ".join(words(rng, n)) for n in (1, 1, 2, 3, 3, 5, 8)]
    texts = [(i, "\n".join(rng.choice([*lines, "", " "]) for _ in range(rng.randrange(12)))) for i in range(60)]
    gone = repeated(texts, 10)
    want = {}
    for i, text in texts:
        kept, at = [], 0
        for line in text.split("\n"):
            if line.split():
                at += 1
                if (i, at - 1) in gone:
                    continue
            kept.append(line)
        want[i] = "\n".join(kept)
    assert gone
    assert {r.doc_id: r.text for r in dedupe_lines(frame(spark, texts), min_words=10).collect()} == want


def test_passages_over_fifty_words_go_and_short_lines_stay(spark):
    rng = random.Random(5)
    passage, greeting = " ".join(words(rng, 51)), "good morning to all of you"
    texts = [(i, f"{' '.join(words(rng, 20))}\n{passage}\n{' '.join(words(rng, 9))}\n{greeting}") for i in range(5)]
    got = {r.doc_id: r.text for r in dedupe_lines(frame(spark, texts)).collect()}
    assert [passage in got[i] for i in range(5)] == [True, False, False, False, False]
    assert all(greeting in t for t in got.values())


def test_passages_inside_lines_go(spark, tmp_path):
    """Word runs by definition: every window with an earlier copy, with passages that start and end inside lines."""
    rng = random.Random(6)
    passages = [words(rng, n, 5000) for n in (50, 53, 61, 90)]
    texts = []
    for i in range(60):
        found = words(rng, rng.randrange(30), 5000)
        for _ in range(rng.randrange(4)):
            part = rng.choice(passages)
            found += part[rng.randrange(12) :] + words(rng, rng.randrange(9), 5000)
        texts.append((i, "".join(w + rng.choice([" "] * 9 + ["\n"]) for w in found)))
    seen, want = set(), {}
    for i, text in texts:
        found, drop = text.split(), set()
        for a in range(len(found) - 49):
            window = tuple(found[a : a + 50])
            drop |= set(range(a, a + 50)) if window in seen else set()
            seen.add(window)
        want[i] = [w for k, w in enumerate(found) if k not in drop]
    got = {r.doc_id: r.text for r in dedupe_passages(frame(spark, texts)).collect()}
    assert {i: t.split() for i, t in got.items()} == want
    assert sum(map(len, want.values())) < 0.6 * sum(len(t.split()) for _, t in texts)
    inside = [(1, "Start here " + " ".join(passages[0]) + " and end."), (2, "Other\nline  " + "\n".join(passages[0]) + " it is.\n\nx")]
    got = {r.doc_id: (r.text, r.n_removed_lines) for r in dedupe_passages(frame(spark, inside)).collect()}
    assert got == {1: (inside[0][1], 0), 2: ("Other\nline\nit is.\n\nx", 50)}
    docs = frame(spark, inside).withColumns({"n_chars": F.length("text").cast("long")})
    got = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, docs, str(tmp_path)).collect()}
    assert got == {1: inside[0][1], 2: "Other\nline\nit is.\n\nx"}


@pytest.fixture
def many_partitions(spark):
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield spark
    spark.conf.set(name, "true")


def test_ranks_are_places_in_the_sorted_order(many_partitions):
    """One key fills several partitions, equal rows are one."""
    spark, rng = many_partitions, random.Random(16)
    rows = sorted({(rng.choice([4] * 9 + list(range(12))), i) for i in range(600)} | {(50, 1), (51, 2)})
    table = spark.createDataFrame(rows + rows[::7], "key long, at int")
    keys = [key for key, _ in rows]
    want = [(k, a, keys.index(k), keys.index(k) == n) for n, (k, a) in enumerate(rows)]
    for alone in (True, False):
        ranked = sorted_groups(table.withColumn("_key", F.col("key")), ["key"], ["at"], keep_alone=alone)
        assert len(ranked.inputFiles()) == 4
        got = [(r["_key"], r["at"], r["rank"], r["first"]) for r in ranked.collect()]
        assert sorted(got) == [w for w in want if alone or keys.count(w[0]) > 1]


def test_line_dedup_finds_passages_by_suffix_ranks(many_partitions, tmp_path, monkeypatch):
    """Runs by definition, over the borders of blocks; the stage of the pipeline takes its places from them."""
    spark, rng = many_partitions, random.Random(17)
    run = [rng.randrange(50) for _ in range(60)]
    texts = {1: run + [7] * 30, 4: [rng.randrange(50) for _ in range(4060)] + run + run[5:], 9: [7] * 25 + run[:19] + run[:18]}
    for depth in (8, 9, 19, 40):
        suffixes = [(no, i, hash(tuple(t[i : i + 8]))) for no, t in texts.items() for i in range(len(t) - 7)]
        seen, want = set(), set()
        for no, t in texts.items():
            for i in range(len(t) - depth + 1):
                want |= {(no, i)} if tuple(t[i : i + depth]) in seen else set()
                seen.add(tuple(t[i : i + depth]))
        got = later_copies(spark.createDataFrame(suffixes, "no long, at int, symbol long"), 8, depth)
        assert want and sorted((r.no, r.at) for r in got.collect()) == sorted(want)

    depths = []
    monkeypatch.setattr(passage_dedup, "later_copies", lambda s, width, depth: depths.append(depth) or later_copies(s, width, depth))
    passage = " ".join(words(rng, 55))
    docs = frame(spark, [(1, f"one {passage} two"), (2, f"three\nfour {passage}")]).withColumn("n_chars", F.length("text").cast("long"))
    got = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, docs, str(tmp_path)).collect()}
    assert got == {1: f"one {passage} two", 2: "three\nfour"} and depths == [50]


def labelled(spark):
    return (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))


def test_importance_on_held_out_labels(spark):
    docs, labels = labelled(spark)
    half = labels.where(F.col("doc_id") % 2 == 0)
    got = importance.importance_sample(docs, half).join(labels.where(F.col("doc_id") % 2 == 1), "doc_id").collect()
    good, bad = ([r.kept for r in got if r.quality == q] for q in (1, 0))
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.5


def test_importance_scores_and_selection_by_brute_force(spark):
    docs, labels = labelled(spark)
    rows, marks = docs.collect(), {r.doc_id: r.quality for r in labels.collect()}
    raw = sum(np.bincount(importance.gram_buckets(r.text), minlength=importance.BUCKETS) for r in rows) + 1.0
    target = sum(np.bincount(importance.gram_buckets(r.text), minlength=importance.BUCKETS) for r in rows if marks.get(r.doc_id)) + 1.0
    log_ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())
    got = importance.importance_sample(docs, labels, k=40).collect()
    want = {r.doc_id: log_ratio[importance.gram_buckets(r.text)].sum() for r in rows}
    assert all(abs(r.log_ratio - want[r.doc_id]) < 1e-6 for r in got)
    best = sorted(got, key=lambda r: (-r.priority, r.doc_id))[:40]
    assert {r.doc_id for r in got if r.kept} == {r.doc_id for r in best}


def test_best_cut():
    assert importance.best_cut(np.array([5.0, 6.0]), np.array([-4.0, 1.0])) == 3.0
    assert importance.best_cut(np.array([1.0]), np.array([])) == -np.inf


def test_quality_rules_by_brute_force(spark):
    rng = random.Random(8)
    texts = [(i, " ".join(words(rng, rng.randrange(60), 6)).replace(" w3", "\n w3").replace("w2", "#$é😀")) for i in range(80)]
    labels = frame(spark, [(0, 1)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality_verdicts(frame(spark, texts), labels).collect()}
    for i, text in texts:
        found = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = [tuple(found[k : k + 5]) for k in range(len(found) - 4)]
        often = Counter(windows)
        covered = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(5)}
        lines = [x for x in text.split("\n") if x.split()]
        r = got[i]
        assert (r.n_words, r.word_chars) == (len(found), sum(map(len, found)))
        assert (r.n_symbols, r.n_dup_lines) == (len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)))
        assert r.n_repeat_words == len(covered)
        assert r.base_failed == (len(found) < 10 or 100 * len(covered) > 20 * len(found))


def test_quality_verdicts_on_labels(spark):
    docs, labels = labelled(spark)
    got = quality_verdicts(docs, labels).join(labels, "doc_id").where("not base_failed").collect()
    assert np.mean([r.kept for r in got if r.quality == 1]) > 0.98
    assert np.mean([r.kept for r in got if r.quality == 0]) < 0.3


def test_quality_verdicts_fit_all_labelled_documents(spark):
    """Over 20,000 labelled documents of each kind: every one counts for the ratios and for the cut."""
    n, kind = 42_000, F.col("id") % 2
    spelled = F.transform(F.sequence(F.lit(0), F.lit(11)), lambda k: F.xxhash64(F.col("id"), k) % 4 + k)
    marks = F.transform(spelled, lambda x: F.concat(F.lit("w"), F.substring(F.lit(".,;:!?()-+=_~^"), (F.abs(x) % 14 + 1).cast("int"), F.lit(1))))
    ends = F.when(kind == 1, F.lit(" (w) W-w")).otherwise(F.when(F.col("id") % 3 == 0, F.lit(" w~w W-w")).otherwise(F.lit(" ww, W")))
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.concat_ws(" ", marks), ends).alias("text"))
    labels = spark.range(n).select(F.col("id").alias("doc_id"), kind.cast("int").alias("quality"))
    buckets = F.transform(quality_rules._places("s"), lambda i: quality_rules.bigram_bucket("s", i))
    shaped = docs.select("doc_id", quality_rules.shape_words(F.col("text")).alias("s")).select("doc_id", buckets.alias("b"))
    raw, target = Counter(), Counter()
    for r in shaped.collect():
        raw.update(r.b)
        target.update(r.b if r.doc_id % 2 else [])
    smooth = quality_rules.SMOOTHING * quality_rules.BUCKETS
    shift = math.log(raw.total() + smooth) - math.log(target.total() + smooth)
    ratio = {b: math.log((target[b] + quality_rules.SMOOTHING) / (raw[b] + quality_rules.SMOOTHING)) + shift for b in raw}
    got = quality_verdicts(docs, labels).collect()
    want = {r.doc_id: np.mean([ratio[b] for b in r.b]) for r in shaped.collect()}
    assert all(abs(r.log_ratio - want[r.doc_id]) < 1e-4 for r in got)
    judged = [r for r in got if not r.base_failed]
    good, bad = (sorted(r.log_ratio for r in judged if r.doc_id % 2 == q) for q in (1, 0))
    assert len(good) > 20_000 and len(bad) > 20_000
    cut = best_threshold(good, bad)
    assert all(r.kept == (r.log_ratio >= cut) for r in judged)


def best_threshold(good, bad):
    scores = sorted({*good, *bad})
    errors = [10 * bisect_left(good, s) / len(good) + 1 - bisect_left(bad, s) / len(bad) for s in scores]
    _, _, low, high = min((e, low - high, low, high) for e, low, high in zip(errors, [scores[0], *scores[:-1]], scores))
    return (low + high) / 2


def test_quality_fit_moves_no_texts(spark, monkeypatch):
    """Only two-byte buckets meet the labels, in one plan at every size; a missing id is a document of the corpus."""
    seen, fit = [], quality_rules.fit_log_ratios

    def spied(rows, trusted):
        seen.append((rows, fit(rows, trusted)))
        return seen[-1][1]

    monkeypatch.setattr(quality_rules, "fit_log_ratios", spied)
    texts = [(1, "aa Bb 12 " * 4), (1, "AA - " * 5), (None, "zz Zz " * 6), (2, "x9 " * 11), (3, None)]
    labels = frame(spark, [(1, 1), (2, 0), (None, 1)], "doc_id long, quality int")
    assert quality_verdicts(frame(spark, texts), labels).count() == len(texts)
    ((rows, got),) = seen
    assert dict(rows.dtypes) == {"doc": "bigint", "buckets": "array<smallint>"}
    counted = {None: Counter(), 1: Counter(), 2: Counter(), 3: Counter()}
    for row in rows.collect():
        counted[row.doc].update(row.buckets)
    raw, target = sum(counted.values(), Counter()), counted[1]
    assert sum(raw.values()) == 12 + 10 + 12 + 11 and sum(target.values()) == 22
    smooth = quality_rules.SMOOTHING * quality_rules.BUCKETS
    shift = math.log(sum(raw.values()) + smooth) - math.log(sum(target.values()) + smooth)
    for b in raw:
        want = math.log((target[b] + quality_rules.SMOOTHING) / (raw[b] + quality_rules.SMOOTHING)) + shift
        assert got[b] == round(want, 4)


def test_quality_threshold_by_brute_force(spark):
    rng = random.Random(11)
    for size, places in ((1, 2), (4, 1), (300, 2), (300, 6)):
        rows = [(round(rng.gauss(0.4 * good, 1), places), good) for good in (True, False) for _ in range(size)]
        good, bad = (sorted(x for x, kind in rows if kind == q) for q in (True, False))
        assert quality_rules.threshold_between(frame(spark, rows, "log_ratio double, good boolean")) == best_threshold(good, bad)
    only = frame(spark, [(1.0, True)], "log_ratio double, good boolean")
    assert quality_rules.threshold_between(only) == -math.inf


def test_license_base_phrases_by_brute_force(spark):
    rng = random.Random(9)
    pool = "mit MIT license License, apache general public the x é under licensed-under".split()
    texts = [(i, rng.choice([" ", " -- ", "\n"]).join(rng.choice(pool) for _ in range(rng.randrange(40)))) for i in range(80)]
    for r in scan_licenses(frame(spark, texts)).collect():
        text = dict(texts)[r.doc_id]
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        at = [(k, label) for phrase, label in BASE.items() for k in range(len(found)) if found[k : k + len(phrase.split())] == phrase.split()]
        assert (r.n_words, r.n_base) == (len(found), len(at))
        assert (r.first_word, r.last_word) == ((min(at)[0], max(at)[0]) if at else (None, None))
        assert r.base_labels == ",".join(sorted({label for _, label in at}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_license_priority_and_containment(spark):
    text = "Licensed under the Apache License, Version 2.0. SPDX-License-Identifier: BSD-3-Clause. GNU Lesser General Public License"
    (row,) = scan_licenses(frame(spark, [(1, text)])).collect()
    assert row.labels == "apache,bsd,gpl,lgpl" and row.base_labels == "apache,gpl" and row.score == 1.0
    spans = sorted((d.start, d.end) for d in row.detections)
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_raking_meets_targets():
    rng = np.random.default_rng(3)
    cells = rng.integers(50, 500, (4, 3, 2)).astype(float)
    targets = [np.array([0.4, 0.3, 0.2, 0.1]), np.array([0.5, 0.3, 0.2]), np.array([0.6, 0.4])]
    raked = mixing.calibrate(cells, targets, 0.3)
    assert all(np.allclose(got, want, atol=1e-4) for got, want in zip(raked.shares, targets))
    assert abs((cells * raked.probability).sum() - 0.3 * cells.sum()) < 1e-6 * cells.sum()
    tight = mixing.calibrate(cells, targets, 0.95)
    assert tight.probability.max() <= 1 and abs((cells * tight.probability).sum() / cells.sum() - 0.95) < 0.01


def test_rows_outside_the_targets_are_sampled(spark):
    """A hot source that no target names, missing sources and languages and a fifth language keep their share."""
    kinds = [("hot", "en")] * 4 + [(None, "en"), ("src1", None), ("src2", "it"), ("src3", "en"), ("src4", "de"), ("src5", "fr")]
    rows = [(i, " ".join(["word"] * 20), *kinds[i % 10]) for i in range(4000)]
    got = mixing.standard_mix(frame(spark, rows, "doc_id long, text string, source string, lang string"), 0.5).toPandas()
    kept = got[got.kept]
    assert abs(len(kept) / len(got) - 0.5) < 0.03
    assert abs((kept.source == mixing.REST).mean() - 0.5) < 0.04 and abs((kept.lang == mixing.REST).mean() - 0.2) < 0.04
    made = got.merge(got.doc_id.map(lambda i: kinds[i % 10]).rename("kind"), left_index=True, right_index=True)
    assert made.groupby("kind", dropna=False).kept.sum().min() > 0


def test_the_pipeline_mix_meets_its_targets_with_a_hot_source(spark, tmp_path):
    """A third of all tokens from one source, and one topic far below its target."""
    rng = random.Random(12)
    texts = ["plain " * 20, "licence " * 20, "a@b.org " * 20, "a | b | c " * 4]
    rows = []
    for i in range(12_000):
        source = 0 if i % 3 == 0 else rng.randrange(1, 20)
        text = texts[rng.choices(range(4), [85, 4, 4, 7])[0]]
        rows.append((i, text, f"src{source}", rng.choices(["en", "de", "fr", "es"], [60, 15, 15, 10])[0], len(text)))
    docs = frame(spark, rows, "doc_id long, text string, source string, lang string, n_chars long")
    shares = mixing.standard_shares(docs, corpus_pipeline.MIX_BUDGET).toPandas()
    assert (shares.reached - shares.target).abs().max() <= mixing.SHARE_TOLERANCE + 1e-9
    assert 0.4 < shares.budget[0] < 0.65
    got = corpus_pipeline.mixing(spark, docs, str(tmp_path)).toPandas()
    assert abs((got.source == "src0").mean() - 0.05) < 0.02 and len(got) > 4000


def test_derived_budget_has_a_floor():
    cells, targets = np.array([[1000.0, 1.0]]), [np.array([1.0]), np.array([0.5, 0.5])]
    assert mixing.largest_budget(cells, targets) == mixing.LEAST_BUDGET
    assert mixing.largest_budget(cells, [np.array([1.0]), np.array([1.0, 0.0])]) > 0.99


def test_sampled_segmentations(spark):
    vocab = piece_sampling.vocabulary(piece_sampling.MODEL)
    texts = ["", "a▁b  c\n\n x▁", "日本語 \U0001f600 ok\t\x00end", "x" * 3000 + " y", " the  the the the"] * 3
    pieces, counts = piece_sampling.sample_batch(texts, piece_sampling.row_keys(list(range(15)), 1), vocab, 1.0)
    parts = np.split(pieces, np.cumsum(counts)[:-1])
    assert [piece_sampling.decode_pieces(p, vocab) for p in parts] == texts
    alone = [piece_sampling.sample_batch([t], piece_sampling.row_keys([i], 1), vocab, 1.0)[0] for i, t in enumerate(texts)]
    assert all(np.array_equal(a, b) for a, b in zip(parts, alone))


def test_segmentation_frequencies_follow_the_lattice():
    """Sampled shares of all segmentations of a word against their exact probabilities."""
    vocab, word, n = piece_sampling.vocabulary(piece_sampling.MODEL), "then", 20_000
    ids = {p: i for i, p in enumerate(vocab.pieces)}

    def splits(rest):
        if not rest:
            yield ()
        for k in range(1, len(rest) + 1):
            if rest[:k] in ids:
                yield from ((ids[rest[:k]], *more) for more in splits(rest[k:]))

    weight = {s: np.exp(sum(vocab.log_weights[i] for i in s)) for s in splits(word)}
    pieces, counts = piece_sampling.sample_batch([word] * n, piece_sampling.row_keys(list(range(n)), 1), vocab, 1.0)
    seen = Counter(tuple(p.tolist()) for p in np.split(pieces, np.cumsum(counts)[:-1]))
    total = sum(weight.values())
    assert set(seen) <= set(weight)
    assert all(abs(seen[s] / n - w / total) < 0.015 for s, w in weight.items())


def test_token_store_against_direct_encoding(spark, tmp_path):
    odd = ["<|endoftext|> a<|endoftext|>", "a  b \n c", " lead", "trail ", " x  y", "it's we're", "x" * 5000]
    texts = [(i * 3, t) for i, t in enumerate(odd)] + [(r.doc_id + 100, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").limit(60).collect()]
    token_store.write_token_store(frame(spark, texts), f"{tmp_path}/s")
    rows = {r.doc_id: r for r in token_store.read_token_store(spark, f"{tmp_path}/s").collect()}
    model, start = token_store.tokenizer(token_store.TOKENIZER), 0
    for i, text in sorted(texts):
        ids = model.encode(text, add_special_tokens=False).ids + [0]
        assert (rows[i].start, rows[i].n_tokens, rows[i].ids) == (start, len(ids), ids)
        assert rows[i].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_units_are_encoded_as_in_the_whole_text(monkeypatch):
    """Every letter that is joined to words, marks, and the places where no cut is allowed; units forgotten between calls."""
    model, rng = token_store.tokenizer(token_store.TOKENIZER), random.Random(3)
    letters = token_store.LetterModel.LETTERS
    odd = [*letters, "they'll", "x2", "3.5", "a.b", "|", "-", "\u00b5", "\u0434\u0430", "\u4e2d\u6587", "\U0001f600", "\0", "\1", "a\0", "\u0120the", "<|endoftext|>", "a<|endoftext|>."]
    odd += [a + b for a in ("the", "Ontion", "\u0161to") for b in (".", ",,", "%%%", "&*!", "?!...", "'s", "\n", "\t", "\u00a0", "\x1c")]
    odd += ["", "\n", " ", "\r\n", "\u0085", "and", "of", "x" * 400]
    texts = ["", "\n", " ", "a", "a\n", "\na", "a\n\nb", "a \nb", "a\n b", *(f"it {c}word{c}. {c}, \n{c}{c}" for c in letters)]
    texts += ["".join(rng.choice(odd) + rng.choice([" ", " ", " ", "\n"]) for _ in range(n))[: -(n % 2) or None] for n in range(300)]
    texts += ["".join(rng.choice(odd[: len(letters) + 20]) + " " for _ in range(n)) + "end" for n in range(100)]
    want = [np.array(model.encode(t, add_special_tokens=False).ids, np.uint32) for t in texts]
    joined, alone = token_store.UnitEncoder(token_store.TOKENIZER), token_store.UnitEncoder(token_store.TOKENIZER)
    assert joined._letters
    alone._letters = None  # as with a tokenizer whose words cannot be joined
    monkeypatch.setattr(token_store, "KNOWN_UNITS", 300)
    monkeypatch.setattr(token_store, "ROWS_A_CALL", 7)
    for encoder in (joined, alone):
        for size, upto in ((len(texts), len(texts)), (40, len(texts)), (1, 40)):
            for i in range(0, upto, size):
                found = list(encoder.encode(token_store.pa.array(texts[i : i + size], token_store.pa.string()).slice(0)))
                assert len(found) == len(texts[i : i + size])
                assert all(np.array_equal(a, b) for a, b in zip(found, want[i : i + size]))


def test_a_word_is_encoded_once_with_any_marks(monkeypatch):
    """The tokenizer is given each different word once, not once for each of its marks and texts."""
    given, ids = [], token_store._ids
    encoder = token_store.UnitEncoder(token_store.TOKENIZER)
    monkeypatch.setattr(token_store, "_ids", lambda model, text: given.append(text) or ids(model, text))
    marks = ["", ".", ",", "%%%", "?!", ";;"]
    stems = [f"{a}{b}ontion" for a in "bcdfghjklm" for b in "aeiou"]
    texts = [" ".join(rng.sample([s + m for s in stems for m in marks], 300)) for rng in map(random.Random, range(40))]
    found = [x for i in range(0, 40, 10) for x in encoder.encode(token_store.pa.array(texts[i : i + 10]))]
    model = token_store.tokenizer(token_store.TOKENIZER)
    assert all(x.tolist() == model.encode(t, add_special_tokens=False).ids for x, t in zip(found, texts))
    assert sum(text.count("ontion") for text in given) <= 2 * len(stems)  # after a blank and after a line break


def test_pruning_loses_nothing():
    rng = np.random.default_rng(1)
    for trial in range(200):
        dim, n = rng.choice([2, 3, 8]), 200
        vectors = rng.integers(-20, 21, (n, dim)) if trial % 2 else np.repeat(rng.integers(-20, 21, (5, dim)), 40, 0)
        lengths = np.sqrt((vectors.astype(float) ** 2).sum(1))
        order = np.argsort(-lengths)
        vectors, lengths = vectors[order], lengths[order]
        query = vectors[rng.integers(n)] + rng.integers(-1, 2, dim)
        scores = vectors @ query
        threshold = np.sort(scores)[-rng.integers(1, 30)]
        unit = vectors / np.where(lengths > 0, lengths, 1)[:, None]
        left = topk_search.survivors(query, float(np.linalg.norm(query)), float(threshold), lengths, unit)
        assert set(np.flatnonzero(scores >= threshold)) <= set(left)


def test_top_k_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "BUCKET", 64)
    monkeypatch.setattr(topk_search, "QUERY_BLOCK", 16)
    rng = np.random.default_rng(2)
    vectors = rng.integers(-9, 10, (700, 6))
    vectors[100:300] = vectors[100]  # many ties
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    df = frame(spark, rows, "vec_id long, vector array<long>")
    got = topk_search.top_k_products(df, df.where("vec_id % 20 = 0"), k=7).collect()
    scores = vectors @ vectors.T
    want = set()
    for q in range(0, 700, 20):
        best = sorted((c for c in range(700) if c != q), key=lambda c: (-scores[q, c], c))[:7]
        want |= {(q, n, c, int(scores[q, c])) for n, c in enumerate(best, 1)}
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in got} == want


def test_main_text_of_held_out_pages(spark):
    """Trained on half of the pages, the model finds exactly the marked article of the other half."""
    import html

    pages = spark.read.parquet(f"{SMALL}/pages.parquet").toPandas()
    counts = next(count_labelled(iter([pages[pages.page_id % 2 == 0]])))
    model = TreeModel.from_counts(list(counts.itertuples(index=False, name=None)))
    rest = pages[pages.page_id % 2 == 1]
    for page, got in zip(rest.html, model.texts(rest.html.tolist())):
        article = re.search(r"<article>(.*?)</article>", page, re.S)[1].replace("<br>", " ")
        blocks = [html.unescape(re.sub("<[^>]*>", "", b)) for b in re.split(r"</?(?:p|h1)>", article)]
        assert got == " ".join(" ".join(b.split()) for b in blocks if b.split())


def test_main_text_without_marked_articles(spark):
    page = (
        "<body class='nav-open'><header>Site</header><div class='page with-sidebar'><div class=content><h2>T&eacute;</h2>"
        "<p>One two three,\n four <b>five</b>six seven.<p>Next one is here, and long enough to be content.<ul><li>a<li>b &amp; c</ul></div>"
        "<div class=sidebar><p>Read more of these long stories, which are not part of it.</p></div></div>"
        "<div id=comments><p>Nice post, thank you very much for it, really.</p></div><form>Mail</form><script>x<p></script></body>"
    )
    rows = frame(spark, [(1, page), (2, "<p>Only a paragraph, with commas, that is long enough to count as text.</p>")], "page_id long, html string")
    got = {r.page_id: r.text for r in extract_main_text(rows).collect()}
    assert got[1] == "Té One two three, four fivesix seven. Next one is here, and long enough to be content. a b & c"
    assert got[2] == "Only a paragraph, with commas, that is long enough to count as text."


def test_main_text_with_anchors_and_unclosed_elements():
    long = "This sentence is long enough, with commas, to count as text of an article."
    page = (
        f"<body><nav>Menu</nav><article><h1>Title</h1><p>{long}</p><h2 id='related-work'>Related work</h2><p class=popular>{long}</p>"
        f"<section id='discussion'><h2 id=search-results>Results</h2><p>{long}</p></section>"
        f"<section id=comments><p>{long}</p></section><div class=ad><p>{long}</p></div>"
        f"<div><video src=a>old browser</div><p>{long} End.</p></article></body>"
    )
    (got,) = TreeModel.from_counts([]).texts([page])
    assert got == f"Title {long} Related work {long} Results {long} {long} End."


def test_mix_against_brute_force(spark):
    """Raking in plain loops, and the draw of every document, at a budget that every cell can meet."""
    rng = random.Random(4)
    rows = [(i, " ".join(words(rng, rng.randrange(20, 60))), rng.choice("abc"), rng.choice("xy")) for i in range(400)]
    rows += [(400, None, "a", "x"), (401, "", None, "y"), (None, "a b c d e", "b", None), (402, "one two", "other", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").repartition(3)
    targets = {"source": {"a": 0.5, "b": 0.3, "c": 0.2}, "lang": {"x": 0.4, "y": 0.6}}
    budget = 0.2
    got = mixing.mix_to_targets(docs, targets, {"source": F.col("source"), "lang": F.col("lang")}, budget=budget).collect()

    fold = lambda value, named: value if value in named else mixing.REST
    tokens = {r.doc_id: r.n_tokens for r in got}
    cells, marginal = defaultdict(float), [defaultdict(float), defaultdict(float)]
    for i, _, *kinds in rows:
        cell = tuple(fold(k, t) for k, t in zip(kinds, targets.values()))
        cells[cell] += tokens[i]
        for axis in range(2):
            marginal[axis][cell[axis]] += tokens[i]
    total = sum(cells.values())
    wanted = []
    for axis, named in enumerate(targets.values()):
        rest = marginal[axis][mixing.REST] / total
        wanted.append({**{c: share * (1 - rest) for c, share in named.items()}, mixing.REST: rest})
    amount = dict(cells)
    for _ in range(2000):
        for axis in range(2):
            sums = defaultdict(float)
            for cell, n in amount.items():
                sums[cell[axis]] += n
            for cell in amount:
                if sums[cell[axis]]:
                    amount[cell] *= wanted[axis][cell[axis]] * budget * total / sums[cell[axis]]
    assert max(amount[c] / cells[c] for c in cells if cells[c]) < 1
    for r in got:
        cell = (r.source, r.lang)
        want = amount[cell] / cells[cell] if cells[cell] else 0.0
        assert r.probability == pytest.approx(want, rel=1e-3)
        digest = hashlib.md5(f"{'' if r.doc_id is None else r.doc_id}|{mixing.SEED}".encode()).hexdigest()
        assert r.kept == (int(digest[:8], 16) / 2**32 < r.probability)


def test_mix_refuses_too_many_cells(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    many = {f"m{k}": {str(i): 1.0 for i in range(200)} for k in range(3)}
    with pytest.raises(ValueError, match="cells"):
        mixing.mix_to_targets(docs, many, {name: F.lit("1") for name in many})


def test_license_gate_is_plain_search(spark):
    """No pattern is tried at every character; any case of a keyword passes, other letters than A-Z find nothing."""
    texts = [(1, "The MiT LICENSE here"), (2, "mit lıcense"), (3, "MİT LİCENSE"), (4, "all RIGHTS reserved"), (5, "nothing"), (6, None)]
    docs = frame(spark, texts)
    low = docs.select("doc_id", F.lower(F.coalesce("text", F.lit(""))).alias("low"))
    passed = low.where(gate(F.col("low"), signature_rules()))
    assert {r.doc_id for r in passed.collect()} >= {1, 4} and 5 not in {r.doc_id for r in passed.collect()}
    assert "RLIKE" not in passed._jdf.queryExecution().optimizedPlan().toString()
    got = {r.doc_id: (r.n_base, r.labels) for r in scan_licenses(docs).collect()}
    assert got == {1: (1, "mit"), 2: (0, ""), 3: (0, ""), 4: (0, "proprietary"), 5: (0, ""), 6: (0, "")}
