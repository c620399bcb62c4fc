import gzip
import os
import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from bitexture.functions.hashing import seeded_hash
from bitexture.functions.prompts import FixedPrompt, Template, TemplatePrompt
from bitexture.functions.text import count_words
from bitexture.functions.tokens import file_token_counter, file_token_ids
from bitexture.operators.generate import echo_generator
from bitexture.operators.runlog import smoothed_loss
from bitexture.plans import curation
from bitexture.plans import evaluation as ev
from bitexture.plans.training import prepare_split
from bitexture.session import scratch_dir
from bitexture.sources import catalog, readers, store
from bitexture.sources.registry import DatasetRegistry
from bitexture.streaming import monitor
from bitexture.streaming import prompts as prompt_stream

PAIRS = "pair_id long, src_text string, trg_text string, bicleaner_ai_score double, bleualign_score double"
PROMPT = FixedPrompt({"hr": "H", "en": "E"}, "GO:")


def test_tsv_is_taken_literally(spark, tmp_path):
    path = tmp_path / "pairs.tsv"
    path.write_text(
        "pair_id\tsrc_text\ttrg_text\tbicleaner_ai_score\tbleualign_score\n"
        '1\t"open quote\tNA\t0.5\t0.25\n'
        "2\tback\\slash\t\t\t1\n"
        "3\tnull\t nbsp \t0.1\t0.2\n",
        encoding="utf-8",
    )
    rows = [tuple(r) for r in readers.read_pairs_tsv(spark, str(path)).orderBy("pair_id").collect()]
    assert rows == [
        (1, '"open quote', "NA", 0.5, 0.25),
        (2, "back\\slash", None, None, 1.0),
        (3, "null", " nbsp ", 0.1, 0.2),
    ]


def test_line_sources_keep_order_and_blank_lines(spark, tmp_path):
    lines = {"src1": [f"a{i}  " for i in range(500)] + ["", "  ", "end"], "src10": ["x\t", "", "y"]}
    paths = {}
    for name, texts in lines.items():
        folder = tmp_path / name
        folder.mkdir()
        with gzip.open(folder / "lines.gz", "wt", encoding="utf-8") as f:
            f.write("\n".join(texts) + "\n")
        paths[name] = str(folder)
    paths["plain"] = str(tmp_path / "plain.txt")
    lines["plain"] = ["p", "q"]
    (tmp_path / "plain.txt").write_text("p\nq\n")
    got = readers.read_line_sources(spark, paths, str(tmp_path / "work")).orderBy("source", "line_key").collect()
    for name, texts in lines.items():
        mine = [r for r in got if r.source == name]
        assert [r.text for r in mine] == [t.rstrip() for t in texts]
        assert [r.line_key for r in mine] == list(range(len(texts)))


def test_keys_of_a_file_read_in_blocks(spark, tmp_path):
    path = tmp_path / "long.txt"
    path.write_text("".join(f"line {i}\n" for i in range(5000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        got = readers.read_line_sources(spark, {"long": str(path)}, str(tmp_path / "work"))
        assert got.where(F.col("text") != F.concat(F.lit("line "), "line_key")).count() == 0
        assert got.count() == 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_small_readers(spark):
    df = spark.createDataFrame([(1, " a \t", "z")], "id int, output string, other string")
    assert readers.text_column(df, "output", "id").collect()[0].text == "a"
    assert readers.keep_column(df, "other").columns == ["other"]
    assert readers.as_evaluation_columns(df, "output", "other").columns == ["id", "inputs", "outputs"]


def test_registry(spark, tmp_path):
    registry = DatasetRegistry()
    registry.add("Known", lambda s: s.range(3).withColumn("split", F.when(F.col("id") == 0, "test").otherwise("train")))
    spark.createDataFrame([("en-hr", 1), ("en-de", 2)], "pair string, x int").write.parquet(str(tmp_path / "c"))
    registry.add_corpus("mirror", str(tmp_path / "c"), config={"pair": "en-hr"})
    assert registry.load(spark, "KNOWN", "test").count() == 1
    assert [r.x for r in registry.load(spark, "mirror").collect()] == [1]
    assert registry.load(spark, str(tmp_path / "c")).count() == 2
    with pytest.raises(ValueError, match="known, mirror"):
        registry.load(spark, "absent")


def test_build_if_missing_repairs_half_written_data(spark, tmp_path):
    path = str(tmp_path / "data")
    calls = []

    def build():
        calls.append(1)
        return spark.range(4).withColumn("split", F.lit("train"))

    assert store.build_if_missing(spark, path, build).count() == 4
    assert store.build_if_missing(spark, path, build).count() == 4 and len(calls) == 1
    os.remove(f"{path}/_SUCCESS")
    assert store.build_if_missing(spark, path, build).count() == 4 and len(calls) == 2


def test_one_split_prunes_folders(spark, tmp_path):
    path = str(tmp_path / "data")
    store.save_splits(spark.range(4).withColumn("split", F.when(F.col("id") < 3, "train").otherwise("test")), path)
    test = store.load_dataset(spark, path, "test")
    assert test.count() == 1 and "PartitionFilters: [isnotnull(split" in test._jdf.queryExecution().toString()
    with pytest.raises(Exception, match="(?i)exists"):
        store.save_splits(test, path)


def test_catalogs(spark, tmp_path):
    assert set(catalog.read_wordings(spark, "plain", "fr")) == {"en", "fr"}
    path = tmp_path / "mine.yml"
    path.write_text('en:\n  hr:\n    - "T {input}\\n{output}"\n')
    assert catalog.read_wordings(spark, str(tmp_path / "mine")) == {"hr": ["T {input}\n{output}"]}
    with pytest.raises(KeyError, match="available: en"):
        catalog.read_wordings(spark, str(path), "de")
    table = catalog.catalog_table(spark, {"hr": [Template.parse("T {input}\n{output}")]})
    assert [tuple(r) for r in table.collect()] == [("hr", 0, 1, "T ", "\n", "")]


def test_lookup_goes_round_robin_per_language(spark):
    templates = {"a": [Template.parse(f"a{i}{{input}}{{output}}") for i in range(3)], "b": [Template.parse("b{input}{output}")]}
    rows = spark.createDataFrame([(i, "ab"[i % 2], "", "") for i in range(6)], "i int, start_lang string, source string, target string")
    got = catalog.render_by_lookup(rows, templates, F.col("i")).orderBy("i").collect()
    assert [r.prompt for r in got] == ["a0", "b", "a2", "b", "a1", "b"]


def test_predictions_and_scores(spark, tmp_path):
    out = str(tmp_path / "p")
    rows = [("d", 1, "i", "o", "p"), ("d", 2, "i", "o", ""), ("0012", 1, "i", None, "q")]
    df = spark.createDataFrame(rows, "dataset string, example_id int, inputs string, outputs string, predictions string")
    run = store.run_id(datetime(2024, 5, 6, 7, 8, 9))
    assert run == "2024-05-06-07-08-09"
    answers = df.where("not (dataset = 'd' and example_id = 1)").select("dataset", "example_id", "predictions")
    aligned = store.align_predictions(df.drop("predictions"), answers)
    store.save_predictions(aligned.withColumn("example_id", F.col("example_id").cast("long")), out, "exp", run)
    back = store.read_predictions(spark, out, "exp", run)
    assert sorted(tuple(r[c] for c in ("dataset", "example_id", "outputs", "predictions")) for r in back.collect()) == [
        ("0012", 1, "", "q"),
        ("d", 2, "o", ""),
    ]
    text = store.read_predictions(spark, out, dataset="0012", null_as_nan_text=True).first()
    assert (text.outputs, text.run_id) == ("nan", run)
    scores = spark.createDataFrame(
        [("e", "r", "d", "nist", 2.0), ("e", "r", "d", "bleu", 1.0)],
        "experiment string, run_id string, dataset string, metric string, score double",
    )
    store.save_scores(scores, str(tmp_path / "s"))
    documents = spark.read.text(str(tmp_path / "s")).collect()
    assert [r.value for r in documents] == ['{"scores":{"bleu":1.0,"nist":2.0}}']
    assert store.read_scores(spark, str(tmp_path / "s")).count() == 2
    store.save_scores(scores, str(tmp_path / "s"))
    store.save_predictions(aligned.withColumn("example_id", F.col("example_id").cast("long")), out, "exp", run)
    assert store.read_scores(spark, str(tmp_path / "s")).count() == 2
    assert store.read_predictions(spark, out, "exp", run).count() == 2


def test_token_cache(spark, tmp_path):
    texts = spark.createDataFrame([("ab", 1), ("c", 2)], "text string, other int")
    options = dict(model="org/m", dataset="/x/d", split="train", max_length=3)
    first = prepare_split(spark, texts, str(tmp_path), **options)
    assert sorted(r.labels for r in first.collect()) == [[97, 98, -100], [99, -100, -100]]
    (folder,) = tmp_path.glob("tokenized_m_d_train_3_*")
    cached = spark.read.parquet(str(folder))
    assert cached.columns == ["input_ids", "attention_mask"]
    files = {f.name for f in folder.glob("part-*")}
    assert prepare_split(spark, texts.repartition(2), str(tmp_path), **options).count() == 2
    assert {f.name for f in folder.glob("part-*")} == files  # the same rows in another order: nothing is written
    changed = texts.withColumn("text", F.replace("text", F.lit("c"), F.lit("d")))
    assert {r.input_ids[0] for r in prepare_split(spark, changed, str(tmp_path), **options).collect()} == {97, 100}
    assert prepare_split(spark, texts, str(tmp_path), **options).count() == 2
    assert prepare_split(spark, texts.limit(1), None, **options).count() == 1
    padded = prepare_split(spark, texts, str(tmp_path), **options, pad_id=9)
    assert sorted(r.input_ids for r in padded.collect()) == [[97, 98, 9], [99, 9, 9]]
    parts = sorted(folder.glob("part-*"))
    for part in parts:
        part.write_bytes(b"broken")
    assert prepare_split(spark, texts, str(tmp_path), **options).count() == 2
    max(folder.glob("part-*"), key=lambda f: f.stat().st_size).unlink()  # a lost file leaves all footers in order
    assert prepare_split(spark, texts, str(tmp_path), **options).count() == 2


def test_tokenizer_file(spark, tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers, processors

    tokenizer = Tokenizer(models.WordLevel({"[B]": 1, "[E]": 2, "a": 3, "b": 4, "?": 5}, unk_token="?"))
    tokenizer.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    tokenizer.post_processor = processors.TemplateProcessing(single="[B] $A [E]", special_tokens=[("[B]", 1), ("[E]", 2)])
    tokenizer.enable_padding(length=9, pad_id=7)
    path = str(tmp_path / "words.json")
    tokenizer.save(path)
    texts = spark.createDataFrame([("a b x",), ("",), (None,)], "text string").coalesce(1)
    counts = [r[0] for r in texts.select(file_token_counter(spark, path)(F.col("text"))).collect()]
    assert counts == [5, 2, 2]
    plain = [r[0] for r in texts.select(file_token_counter(spark, path, special=False)(F.col("text"))).collect()]
    assert plain == [3, 0, 0]
    options = dict(model="m", dataset="d", split="s", max_length=4, pad_id=0, tokenizer_file=path)
    rows = prepare_split(spark, texts.limit(1), str(tmp_path), **options).collect()
    assert [(r.input_ids, r.attention_mask, r.labels) for r in rows] == [([1, 3, 4, 2], [1] * 4, [1, 3, 4, 2])]
    (folder,) = tmp_path.glob("tokenized_m_d_s_4_*")
    assert store.is_complete(spark, str(folder))
    short = prepare_split(spark, texts.limit(2).where("text = ''"), None, **options).first()
    assert (short.input_ids, short.attention_mask, short.labels) == ([1, 2, 0, 0], [1, 1, 0, 0], [1, 2, -100, -100])


def test_tokenizer_file_takes_a_batch_in_chunks(spark, tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    tokenizer = Tokenizer(models.WordLevel({"a": 3, "?": 5}, unk_token="?"))
    tokenizer.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    path = str(tmp_path / "words.json")
    tokenizer.save(path)
    texts = pd.Series([None, *["a " * n for n in (30_000, 90_000, 3, 50_000, 200_000, 1, 0)]])
    batches = list(file_token_counter(spark, path).func(iter([texts, texts[:0]])))
    assert [n for b in batches for n in b] == [0, 30_000, 90_000, 3, 50_000, 200_000, 1, 0]
    assert [len(b) for b in batches] == [4, 1, 1, 2]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").coalesce(1)
    got = rows.select("i", F.size(file_token_ids(spark, path)(F.col("text"))).alias("n")).collect()
    assert [r.n for r in sorted(got)] == [0, 30_000, 90_000, 3, 50_000, 200_000, 1, 0]


def test_curation_job(spark, tmp_path):
    pairs = spark.createDataFrame(
        [(i, f"s{i}", f"t{i}", 0.5, i / 50) for i in range(1, 41)], PAIRS
    )
    options = dict(src_lang="hr", trg_lang="en", size=20, max_tokens=9)
    split_pairs, texts = curation.build_pairs_and_texts(spark, pairs, str(tmp_path / "o"), PROMPT, count_words, **options)
    assert {r.pair_id for r in split_pairs.collect()} == set(range(21, 41))
    assert {r.split: r["count"] for r in split_pairs.groupBy("split").count().collect()} == {
        "train": 14,
        "test": 3,
        "validation": 3,
    }
    assert {r.split: r["count"] for r in texts.groupBy("split").count().collect()} == {"train": 28, "validation": 6}
    # In every file the texts lie in the order of the seeded shuffle.
    key = F.concat_ws("|", F.col("pair_id").cast("string"), "direction")
    files = {}
    for r in texts.select("_metadata.file_path", seeded_hash(key, 1337).alias("h")).collect():
        files.setdefault(r.file_path, []).append(r.h)
    assert all(hashes == sorted(hashes) for hashes in files.values())


def test_evaluation_job(spark, tmp_path):
    registry = DatasetRegistry()
    rows = [(i, f"a{i}", f"b{i}", "test" if i < 6 else "train") for i in range(10)]
    schema = "pair_id long, src_text string, trg_text string, split string"
    registry.add("one", lambda s: s.createDataFrame(rows, schema))
    registry.add("two", lambda s: s.createDataFrame(rows[:4], schema))
    job = ev.EvaluationJob("exp", ["one", "two"], PROMPT, "hr", split="test", metrics=["bleu", "chrf"], max_examples=5)
    scores = ev.run_evaluation(spark, registry, job, echo_generator, str(tmp_path / "o"), "r1")
    assert sorted((r.dataset, r.metric) for r in scores.collect()) == [
        (d, m) for d in ("one", "two") for m in ("bleu", "chrf")
    ]
    saved = store.read_predictions(spark, str(tmp_path / "o" / "predictions"))
    assert {r.dataset: r["count"] for r in saved.groupBy("dataset").count().collect()} == {"one": 5, "two": 4}
    row = saved.where("dataset = 'two' and example_id = 0").first()
    assert row.inputs == "GO: H: a0 E: " and row.predictions == " E: a0 H: GO:"
    preview = ev.preview_prompts(spark, registry, ev.EvaluationJob("e", ["one"], PROMPT, "hr", split="train"))
    assert sorted(r.expected for r in preview.collect()) == ["b6", "b7", "b8", "b9"]


def test_round_robin_prompts_number_the_examples(spark):
    wordings = [Template.parse(f"{i} {{input}}{{output}}") for i in range(3)]
    registry = DatasetRegistry()
    schema = "pair_id long, src_text string, trg_text string"
    registry.add("d", lambda s: s.createDataFrame([(10 * i, "x", "y") for i in range(7)], schema).repartition(3))
    for random_choice in (False, True):
        prompt = TemplatePrompt({"hr": wordings}, random_choice)
        job = ev.EvaluationJob("e", ["d"], prompt, "hr", split=None)
        got = [r.inputs[0] for r in ev.load_examples(spark, registry, job).orderBy("example_id").collect()]
        if not random_choice:
            assert got == list("0120120")


def test_prompt_stream(spark, tmp_path):
    pairs = spark.createDataFrame([(1, "a", "b"), (2, "a " * 50, "b"), (3, None, "b")], "pair_id int, src_text string, trg_text string")
    pairs.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = prompt_stream.pair_stream(spark, str(tmp_path / "in"), pairs.schema, files_per_batch=1)
    for _ in range(2):  # A second run finds nothing new.
        prompt_stream.write_prompts(
            stream, PROMPT, count_words, 20, "hr", "en", str(tmp_path / "out"), str(tmp_path / "state")
        ).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.pair_id, r.direction) for r in got) == [(1, "bwd"), (1, "fwd")]


def test_log_monitor(spark, tmp_path):
    rows = [(datetime(2024, 1, 1, h, m), k, v) for h in range(4) for m, k, v in [(5, "a", 1.0), (6, "a", float("nan")), (7, "b", 2.0)]]
    log = spark.createDataFrame(rows, "ts timestamp_ntz, kind string, loss double")
    log.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(log.schema).parquet(str(tmp_path / "in"))
    watched = monitor.windowed_losses(stream, "kind")
    monitor.write_snapshots(watched, str(tmp_path / "all"), str(tmp_path / "s1")).awaitTermination()
    monitor.write_closed_windows(watched, str(tmp_path / "closed"), str(tmp_path / "s2")).awaitTermination()
    every = {tuple(r) for r in spark.read.parquet(str(tmp_path / "all")).collect()}
    assert every == {tuple(r) for r in monitor.windowed_losses(log, "kind").collect()} and len(every) == 8
    closed = {tuple(r) for r in spark.read.parquet(str(tmp_path / "closed")).collect()}
    # The watermark trails the newest event by ten minutes, so only windows that end by 02:57 are closed.
    assert closed == {r for r in every if r[0].hour < 2}


def hours(*spans):
    return [(datetime(2024, 1, 1, h, m), k, v) for h in spans for m, k, v in [(5, "a", 1.0), (6, "a", float("nan")), (7, None, 2.0)]]


def test_window_monitor_appends_and_flushes(spark, tmp_path):
    shape = "ts timestamp_ntz, kind string, loss double"
    arrive = lambda *spans: spark.createDataFrame(hours(*spans), shape).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    arrive(0, 1)
    stream = spark.readStream.schema(shape).parquet(str(tmp_path / "in"))
    watch = monitor.WindowMonitor(stream, "kind", str(tmp_path / "out"), str(tmp_path / "work"))
    got = lambda: sorted((str(tuple(r)) for r in watch.result().collect()))
    want = lambda *spans: sorted(str(tuple(r)) for r in monitor.windowed_losses(spark.createDataFrame(hours(*spans), shape), "kind").collect())
    watch.run()
    assert got() == []  # the first hour is still within the lateness
    arrive(2, 3)
    again = monitor.WindowMonitor(stream, "kind", str(tmp_path / "out"), str(tmp_path / "work"))  # a restart
    last = again.run()
    assert got() == want(0, 1)
    ended = watch.flush(last)
    assert got() == want(0, 1, 2, 3)
    assert ended.lastProgress["stateOperators"][0]["numRowsTotal"] <= 1  # the instant itself


def test_replayed_batches_change_nothing(spark, tmp_path):
    """A batch whose commit was lost is delivered again under its id."""
    shape = "ts timestamp_ntz, kind string, loss double"
    for span in (0, 2, 4):
        spark.createDataFrame(hours(span), shape).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(shape).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    watch = monitor.WindowMonitor(stream, "kind", str(tmp_path / "out"), str(tmp_path / "work"))
    watch.run()
    before = sorted(str(tuple(r)) for r in watch.result().collect())
    commits = sorted((p for p in (tmp_path / "work" / "state" / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    watch.run()
    assert sorted(str(tuple(r)) for r in watch.result().collect()) == before and before
    unfinished = tmp_path / "out" / "batch_id=99"
    unfinished.mkdir()
    assert sorted(str(tuple(r)) for r in watch.result().collect()) == before


def test_run_states(spark, tmp_path):
    """Smoothing and the NaN stop go on over triggers; late and repeated steps are counted; silent runs are closed."""
    nan = float("nan")
    at = lambda minute: datetime(2024, 1, 1) + timedelta(minutes=minute)
    parts = [
        [("a", 2, at(2), 3.0), ("a", 1, at(1), 1.0), ("b", 1, at(1), nan), ("b", 2, at(2), None)],
        [("a", 2, at(3), 9.0), ("a", 3, at(4), 5.0), ("b", 3, at(3), 7.0), ("b", 4, at(4), nan), ("b", 5, at(5), 1.0)],
        [("b", 6, at(6), 1.0), ("a", 4, at(6), 6.0), (None, 1, at(6), 1.0), ("c", None, at(6), 1.0)],
        [("d", 1, at(600), 1.0)],
    ]
    shape = "run_id string, step long, ts timestamp_ntz, loss double"
    for part in parts:
        spark.createDataFrame(part, shape).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(shape).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    states = monitor.run_states(stream, width=2, idle="2 hours")
    monitor.write_batches(states, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    rows = [tuple(r) for r in monitor.read_batches(states, str(tmp_path / "out")).collect()]
    of = lambda run, event: sorted((r[2:] for r in rows if r[:2] == (run, event)), key=str)
    assert of("a", "step") == [(1, 1.0, 0, 1.0, 1, 0), (2, 3.0, 0, 2.0, 2, 0), (3, 5.0, 0, 4.0, 2, 1), (4, 6.0, 0, 5.5, 2, 1)]
    assert of("b", "step") == [(3, 7.0, 2, 7.0, 1, 0)]
    (stop,) = of("b", "stopped")
    assert (stop[0], stop[2], stop[4], stop[5]) == (4, 3, 1, 0)
    assert of("a", "closed") == [(4, None, 0, None, 2, 1)] and of("b", "closed") == [(6, None, 3, None, 1, 0)]
    assert of("d", "step") == [(1, 1.0, 0, 1.0, 1, 0)] and not of("c", "step")


def test_run_states_equal_the_batch_result(spark, tmp_path):
    rng = random.Random(3)
    rows = [(run, step, datetime(2024, 1, 1), float("nan") if rng.random() < 0.004 else rng.random()) for run in range(6) for step in range(400)]
    log = spark.createDataFrame(rows, "run_id long, step long, ts timestamp_ntz, loss double")
    for low in (0, 90, 250):
        part = log.where((F.col("step") >= low) & (F.col("step") < {0: 90, 90: 250, 250: 400}[low]))
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    states = monitor.run_states(stream)
    monitor.write_batches(states, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got = {(r.run_id, r.step): (r.nan_before, r.n_smoothed, r.smoothed) for r in monitor.read_batches(states, str(tmp_path / "out")).where("event = 'step'").collect()}
    want = {(r.run_id, r.step): (r.nan_before, r.n_smoothed, pytest.approx(r.smoothed)) for r in smoothed_loss(log).collect()}
    assert got == want


def test_scratch_folders_are_new_each_time(spark):
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")
