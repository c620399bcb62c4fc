"""One query per operator, each over whole tables. Keys match the oracle statements in ``oracles``."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bitexture.functions import text as txt
from bitexture.functions.prompts import FixedPrompt, TemplatePrompt, by_start_language, template_grid
from bitexture.functions.tokens import (
    codepoint_ids,
    file_token_counter,
    file_token_ids,
    fixed_length_rows,
    loss_labels,
    real_length,
)
from bitexture.functions.wrappers import get_wrapper, system_wrapper
from bitexture.operators import batching, curate, metrics, perplexity, ranking, runlog, splits, stats
from bitexture.operators.generate import cut_prompt, echo_words, generate
from bitexture.plans import evaluation as ev
from bitexture.plans.curation import build_pairs_and_texts
from bitexture.plans.training import prepare_split
from bitexture.session import scratch_dir
from bitexture.sources import catalog, readers, store
from bitexture.sources.registry import DatasetRegistry
from bitexture.streaming import monitor
from bitexture.streaming import prompts as prompt_stream
from bitexture.suite import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]

SRC, TRG = fx.SRC_LANG, fx.TRG_LANG
MAX_TOKENS = 250
TOP = 200
ROW_LENGTH = 128
PAD = 0
FIXED = FixedPrompt({SRC: "ENGLISH", TRG: "FRENCH"}, "RENDER:")

_registry: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _registry[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_registry)


# Curation -----------------------------------------------------------------------------------------------------------


def _curated(spark: SparkSession, sf: str, size: int) -> DataFrame:
    return curate.curate_top(
        fx.pairs(spark, sf),
        FIXED,
        txt.count_words,
        max_tokens=MAX_TOKENS,
        size=size,
        src_lang=SRC,
        trg_lang=TRG,
        work_dir=scratch_dir(spark, "scores"),
    )


@query
def curate_topk(spark, sf):
    best = _curated(spark, sf, TOP)
    return best.select("pair_id", "src_text", "trg_text", F.round("sort_score", 6).alias("sort_score"))


@query
def curate_large(spark, sf):
    """A size beyond the bounded heap: the exact-cut route, which here keeps every pair within budget."""
    return _curated(spark, sf, 100_000).select("pair_id", F.round("sort_score", 6).alias("sort_score"))


CUT = 150


@query
def curate_cut(spark, sf):
    """A cut beyond the heap that leaves pairs out, with prompts numbered round robin and missing scores."""
    best = curate.curate_top(
        fx.pairs(spark, sf),
        catalog.template_prompt(spark, "plain"),
        txt.count_bytes,
        max_tokens=1200,
        size=CUT,
        src_lang=SRC,
        trg_lang=TRG,
        work_dir=scratch_dir(spark, "scores"),
        heap=10,
    )
    return best.select("pair_id", F.round("sort_score", 6).alias("sort_score"))


@query
def token_budget(spark, sf):
    fitting = curate.within_budget(fx.pairs(spark, sf), FIXED, txt.count_bytes, 1200, SRC, TRG)
    return fitting.select("pair_id", "src_text", "trg_text")


@query
def top_by_score(spark, sf):
    return curate.top_by_score(fx.pairs(spark, sf), "bleualign_score", TOP).select("pair_id", "bleualign_score")


@query
def top_score_floor(spark, sf):
    return curate.top_score_floor(fx.pairs(spark, sf), "bicleaner_ai_score", TOP)


@query
def clean_pairs(spark, sf):
    kept = curate.clean_pairs(fx.noisy_pairs(spark, sf))
    return kept.select("pair_id", "src_text", F.array("trg_text")[0].alias("reference"))


@query
def harmonic_scores(spark, sf):
    score = txt.harmonic_mean(F.col("bicleaner_ai_score"), F.col("bleualign_score"))
    return fx.pairs(spark, sf).select("pair_id", F.round(score, 6).alias("sort_score"))


# Statistics ---------------------------------------------------------------------------------------------------------


def _rounded(df: DataFrame) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(c, 6) for c in doubles})


@query
def score_summary(spark, sf):
    return _rounded(stats.summarize(fx.pairs(spark, sf), "bicleaner_ai_score", "bleualign_score"))


@query
def score_histogram(spark, sf):
    return _rounded(stats.histogram(fx.pairs(spark, sf), "bicleaner_ai_score"))


@query
def score_density(spark, sf):
    return stats.density(fx.pairs(spark, sf), "bicleaner_ai_score").select(
        "point", F.round("x", 6).alias("x"), F.round("density", 4).alias("density")
    )


@query
def extreme_quartiles(spark, sf):
    """Infinite values take part in order, missing ones do not."""
    return _rounded(stats.summarize(fx.extremes(spark, sf), "x").select("n", "min", "p25", "p50", "p75", "max"))


@query
def extreme_histogram(spark, sf):
    return _rounded(stats.histogram(fx.extremes(spark, sf), "x"))


def _lengths(spark: SparkSession, sf: str) -> DataFrame:
    return stats.pair_lengths(fx.pairs(spark, sf), FIXED, txt.count_words, SRC, TRG)


@query
def length_analysis(spark, sf):
    lengths = store.written(_lengths(spark, sf), scratch_dir(spark, "lengths"))
    return _rounded(stats.summarize(lengths, "prompt_length", "raw_length"))


@query
def length_histogram(spark, sf):
    return _rounded(stats.histogram(_lengths(spark, sf), "raw_length"))


@query
def token_counters(spark, sf):
    text = F.col("text")
    counts = {f"n_{name}": counter(text) for name, counter in txt.TOKEN_COUNTERS.items()}
    return fx.corpus(spark, sf).select("doc_id", *[c.alias(n) for n, c in counts.items()])


# Splits and samples -------------------------------------------------------------------------------------------------


@query
def seeded_shuffle(spark, sf):
    return ranking.shuffled_position(fx.corpus(spark, sf), "doc_id", 1337).select("position", "doc_id", "text")


@query
def seeded_subsample(spark, sf):
    return splits.seeded_subsample(fx.corpus(spark, sf), "doc_id", 150, 5439)


@query
def sample_preview(spark, sf):
    return splits.seeded_subsample(fx.corpus(spark, sf).select("doc_id", "text"), "doc_id", 10, 9123)


@query
def split_three_way(spark, sf):
    return splits.split_three_way(fx.pairs(spark, sf).select("pair_id", "src_text", "trg_text"), "pair_id")


@query
def split_two_way(spark, sf):
    return splits.split_two_way(fx.corpus(spark, sf).select("doc_id", "source"), "doc_id", seed=42)


@query
def split_counts(spark, sf):
    return splits.split_counts(splits.split_three_way(fx.corpus(spark, sf).select("doc_id"), "doc_id"))


@query
def stratified_resplit(spark, sf):
    """Rows without a label are a stratum of their own."""
    data = fx.labelled(spark, sf)
    by_split = {name: data.where(F.col("split") == name) for name in ("train", "test", "validation")}
    merged = splits.concat_splits({name: part.drop("split") for name, part in by_split.items()})
    resplit = splits.resplit_stratified(merged, "doc_id")
    return resplit.select("doc_id", F.coalesce(F.col("label").cast("string"), F.lit("none")).alias("label"), "split")


@query
def class_distribution(spark, sf):
    return _rounded(splits.class_distribution(fx.labelled(spark, sf)))


@query
def limit_examples(spark, sf):
    return splits.limit_examples(fx.corpus(spark, sf), "doc_id", 100)


@query
def concat_splits(spark, sf):
    data = fx.labelled(spark, sf).fillna(-1, ["label"])
    parts = {n: data.where(F.col("split") == n).drop("split") for n in ("train", "test", "validation")}
    return splits.concat_splits(parts)


# Prompts ------------------------------------------------------------------------------------------------------------


def _texts(spark: SparkSession, sf: str) -> DataFrame:
    return fx.pairs(spark, sf).select("pair_id", "src_text", "trg_text")


@query
def prompts_fixed_train(spark, sf):
    rendered = curate.render_both(_texts(spark, sf), FIXED, SRC, TRG)
    return rendered.select("pair_id", "prompt_fwd", "prompt_bwd")


@query
def prompts_fixed_query(spark, sf):
    start = F.when(F.col("pair_id") % 2 == 0, SRC).otherwise(TRG)
    prompt = by_start_language(start, {lang: FIXED.query(F.col("src_text"), lang) for lang in (SRC, TRG)})
    return _texts(spark, sf).select("pair_id", start.alias("start_lang"), prompt.alias("prompt"))


def _expanded(spark: SparkSession, sf: str, composer) -> DataFrame:
    return curate.expand_directions(_texts(spark, sf), composer, SRC, TRG)


@query
def prompts_round_robin(spark, sf):
    return _expanded(spark, sf, catalog.template_prompt(spark, "plain"))


@query
def prompts_random(spark, sf):
    return _expanded(spark, sf, catalog.template_prompt(spark, "plain", random_choice=True))


@query
def prompts_lookup(spark, sf):
    """Template choice by a join with the catalogue, start language and call number from the data."""
    numbered = ranking.id_position(_texts(spark, sf), "pair_id")
    rows = numbered.select(
        "pair_id",
        F.when(F.col("pair_id") % 2 == 0, SRC).otherwise(TRG).alias("start_lang"),
        F.col("src_text").alias("source"),
        F.col("trg_text").alias("target"),
        "position",
    )
    templates = catalog.parse_wordings(catalog.read_wordings(spark, "plain.yml", "fr"))
    rendered = catalog.render_by_lookup(rows, templates, F.col("position"))
    return rendered.select("pair_id", "start_lang", "template_idx", "prompt")


@query
def prompts_turn_query(spark, sf):
    composer = catalog.template_prompt(spark, "turns", instruction_tuned=True)
    return _texts(spark, sf).select("pair_id", composer.query(F.col("src_text"), SRC, F.col("pair_id")).alias("prompt"))


def _wrapped(spark: SparkSession, sf: str, wrapper) -> DataFrame:
    instruction, response = F.col("src_text"), F.col("trg_text")
    return _texts(spark, sf).select(
        "pair_id",
        wrapper.train(instruction, response).alias("train_text"),
        wrapper.query(instruction).alias("query_text"),
    )


@query
def wrap_identity(spark, sf):
    return _wrapped(spark, sf, get_wrapper(None))


@query
def wrap_bracket(spark, sf):
    return _wrapped(spark, sf, get_wrapper("Mistral-Instruct"))


@query
def wrap_system(spark, sf):
    return _wrapped(spark, sf, system_wrapper("You translate."))


@query
def wrap_turns(spark, sf):
    return _wrapped(spark, sf, get_wrapper("gemma-it"))


GRID_NAMES = {
    "en": {"en": {"plain": "English", "from": "English"}, "fr": {"plain": "French", "from": "French"}},
    "fr": {"en": {"plain": "anglais", "from": "l'anglais"}, "fr": {"plain": "français", "from": "le français"}},
}
GRID_WORDINGS = {
    "en": ["From {source:from} to {target:plain}.\n{input}\n\n{output}", "{target:plain} wanted.\n{input}\n{output}"],
    "fr": ["{source:plain} -> {target:plain}.\n{input}\n\n{output}", "{target:plain} voulu.\n{input}\n{output}"],
}


@query
def template_grid_prompts(spark, sf):
    grid = template_grid(GRID_NAMES, GRID_WORDINGS)
    rendered = [
        _expanded(spark, sf, TemplatePrompt(catalog.parse_wordings(wordings))).withColumn("written_in", F.lit(language))
        for language, wordings in grid.items()
    ]
    return reduce(DataFrame.unionByName, rendered)


@query
def bidirectional_expand(spark, sf):
    return curate.expand_directions(_texts(spark, sf), FIXED, SRC, TRG)


@query
def training_texts(spark, sf):
    split = splits.split_three_way(_texts(spark, sf), "pair_id")
    return curate.training_texts(split, FIXED, SRC, TRG)


# Sources and sinks --------------------------------------------------------------------------------------------------


@query
def strip_text(spark, sf):
    padded = fx.corpus(spark, sf).withColumn("text", F.concat(F.lit(" \t "), "text", F.lit("  \n")))
    return readers.text_column(padded, "text", "doc_id", subsample=None)


@query
def source_union(spark, sf):
    """Documents written as gzip line files per source, read back as named line corpora with running keys."""
    out = scratch_dir(spark, "lines")
    docs = fx.corpus(spark, sf).select("source", "text")
    docs.write.partitionBy("source").option("compression", "gzip").text(out)
    paths = {folder.removeprefix("source="): f"{out}/{folder}" for folder in store.child_folders(spark, out)}
    lines = readers.read_line_sources(spark, paths, scratch_dir(spark, "lines"))
    return lines.groupBy("source", "text").agg(
        F.count("*").alias("n"),
        (F.count_distinct("line_key") == F.count("*")).alias("keys_distinct"),
    )


@query
def text_lines(spark, sf):
    out = scratch_dir(spark, "text")
    fx.corpus(spark, sf).select("text").write.text(out)
    lines = readers.keep_column(readers.read_text_lines(spark, out))
    return lines.groupBy("text").agg(F.count("*").alias("n"))


def _flat_pairs(spark: SparkSession, sf: str) -> DataFrame:
    def one_line(column: str) -> Column:
        return F.concat(F.lit('"NA" '), F.regexp_replace(column, r"[\r\n\t]", " ")).alias(column)

    return fx.pairs(spark, sf).select(
        "pair_id", one_line("src_text"), one_line("trg_text"), "bicleaner_ai_score", "bleualign_score"
    )


@query
def tsv_roundtrip(spark, sf):
    """A file without ids, with its columns in another order and one that only passes through."""
    out = scratch_dir(spark, "tsv")
    address = F.concat(F.lit("http://x/"), F.col("pair_id").cast("string")).alias("src_url")
    flat = _flat_pairs(spark, sf).select(address, "bleualign_score", "trg_text", "src_text", "bicleaner_ai_score")
    writer = flat.write.option("sep", "\t").option("header", True)
    writer.option("quote", "\u0000").option("escapeQuotes", False).option("emptyValue", "").csv(out)
    pairs = readers.read_pairs_tsv(spark, out)
    same_id = F.count("*").over(Window.partitionBy("pair_id"))
    return pairs.withColumn("rows_with_id", same_id).drop("pair_id")


def _registered(spark: SparkSession, sf: str) -> DatasetRegistry:
    registry = DatasetRegistry()
    registry.add("pairs", lambda s: splits.split_three_way(fx.pairs(s, sf), "pair_id"))
    registry.add_corpus("english-documents", f"{sf}/documents.parquet", config={"lang": "en"})
    return registry


@query
def dataset_registry(spark, sf):
    registry = _registered(spark, sf)
    by_label = registry.load(spark, "English-Documents").select(F.lit("label").alias("origin"), "doc_id", "text")
    by_path = registry.load(spark, f"{sf}/documents.parquet").select(F.lit("path").alias("origin"), "doc_id", "text")
    return by_label.unionByName(by_path)


@query
def build_if_missing(spark, sf):
    out = scratch_dir(spark, "pairs")

    def build() -> DataFrame:
        return splits.split_three_way(_texts(spark, sf), "pair_id")

    store.build_if_missing(spark, out, build)
    store.build_if_missing(spark, out, lambda: spark.range(0).select(F.lit("never").alias("split")))
    return store.load_dataset(spark, out, "validation").select("pair_id", "src_text", "trg_text", "split")


@query
def curation_job(spark, sf):
    """The whole curation: curate, split, write pairs, expand, shuffle, write texts, read both back."""
    out = scratch_dir(spark, "curation")
    split_pairs, texts = build_pairs_and_texts(
        spark,
        fx.pairs(spark, sf),
        out,
        FIXED,
        txt.count_words,
        src_lang=SRC,
        trg_lang=TRG,
        size=TOP,
        max_tokens=MAX_TOKENS,
    )
    held_out = split_pairs.where("split = 'test'").select("split", F.col("src_text").alias("text"))
    return held_out.unionByName(texts.select("split", "text"))


# Tokens -------------------------------------------------------------------------------------------------------------


def _token_rows(spark: SparkSession, sf: str) -> DataFrame:
    docs = fx.corpus(spark, sf).select("doc_id", "text")
    return fixed_length_rows(docs, codepoint_ids(F.col("text"), ROW_LENGTH), ROW_LENGTH, PAD)


@query
def tokenize_fixed(spark, sf):
    return _token_rows(spark, sf)


@query
def loss_label_rows(spark, sf):
    return _token_rows(spark, sf).select("doc_id", loss_labels(F.col("input_ids"), PAD).alias("labels"))


@query
def real_lengths(spark, sf):
    """The period stands in for the end token, so that it occurs inside texts as well."""
    period = 46
    return _token_rows(spark, sf).select("doc_id", real_length(F.col("input_ids"), period).alias("real_length"))


def byte_tokenizer_file(spark: SparkSession) -> str:
    """A byte-level tokenizer file without merges: one token per UTF-8 byte."""
    from tokenizers import Tokenizer, models, pre_tokenizers

    alphabet = sorted(pre_tokenizers.ByteLevel.alphabet())
    tokenizer = Tokenizer(models.BPE(vocab={c: i for i, c in enumerate(alphabet)}, merges=[]))
    tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    folder = scratch_dir(spark, "tokenizer")
    spark.createDataFrame([(tokenizer.to_str(),)], "value string").coalesce(1).write.text(folder)
    return spark.read.text(folder).select("_metadata.file_path").first()[0]


@query
def tokenize_plugin(spark, sf):
    path = byte_tokenizer_file(spark)
    ids = file_token_ids(spark, path)(F.col("text"))
    docs = fx.corpus(spark, sf).select("doc_id", "text", ids.alias("ids"))
    rows = fixed_length_rows(docs, F.col("ids"), ROW_LENGTH, -1)
    return rows.select(
        "doc_id",
        F.size("ids").alias("n_tokens"),
        F.size("input_ids").alias("row_length"),
        F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("n_real"),
    )


@query
def token_budget_plugin(spark, sf):
    """The token budget with a user's counter, here one that reads a tokenizer file."""
    counter = file_token_counter(spark, byte_tokenizer_file(spark))
    fitting = curate.within_budget(fx.pairs(spark, sf), FIXED, counter, 1200, SRC, TRG)
    return fitting.select("pair_id", "src_text", "trg_text")


@query
def token_cache(spark, sf):
    cache = scratch_dir(spark, "tokens")
    texts = fx.corpus(spark, sf)
    options = dict(model="hub/codepoints", dataset="docs", split="train", max_length=ROW_LENGTH, pad_id=PAD)
    prepare_split(spark, texts, cache, **options)
    again = texts.hint("rebalance", "doc_id")  # the same rows in other partitions, more of them for a larger table
    rows = prepare_split(spark, again, cache, **options)  # read from the cache
    return rows.groupBy("input_ids", "attention_mask", "labels").agg(F.count("*").alias("n"))


@query
def length_grouped_batches(spark, sf):
    docs = fx.corpus(spark, sf).select("doc_id", F.length("text").alias("length"))
    return batching.length_grouped_batches(docs, "doc_id", "length", 8, 42)


# Evaluation ---------------------------------------------------------------------------------------------------------


def _job(**changes) -> ev.EvaluationJob:
    settings = dict(
        experiment="suite", datasets=["pairs"], composer=FIXED, start_lang=SRC, split="test", wrapper="llama2-chat"
    )
    return ev.EvaluationJob(**{**settings, **changes})


@query
def eval_inputs(spark, sf):
    return ev.load_examples(spark, _registered(spark, sf), _job())


@query
def prompt_preview(spark, sf):
    return ev.preview_prompts(spark, _registered(spark, sf), _job(wrapper=None))


@query
def batch_generate(spark, sf):
    inputs = ev.load_examples(spark, _registered(spark, sf), _job(split=None, wrapper=None))
    return generate(inputs, echo_words).select("example_id", "inputs", "generated")


@query
def cut_prefix(spark, sf):
    inputs = ev.load_examples(spark, _registered(spark, sf), _job(split=None, wrapper=None))
    answered = inputs.withColumn("generated", F.concat("inputs", "outputs"))
    return answered.select("example_id", cut_prompt(F.col("generated"), F.col("inputs"), strict=True).alias("predictions"))


@query
def predictions_roundtrip(spark, sf):
    out = scratch_dir(spark, "predictions")
    rows = fx.examples(spark, sf)
    answered = rows.where(F.col("example_id") % 3 != 0).select("dataset", "example_id", "predictions")
    aligned = store.align_predictions(rows.drop("predictions"), answered)
    store.save_predictions(aligned, out, "suite", "2024-01-01-00-00-00")
    read = store.read_predictions(spark, out, "suite", null_as_nan_text=True)
    return read.select(*store.RUN_KEYS, "example_id", *store.PREDICTION_COLUMNS)


@query
def evaluation_job(spark, sf):
    """The whole evaluation with the stand-in generator, scores read back from their documents."""
    out = scratch_dir(spark, "evaluation")
    job = _job(wrapper=None, max_examples=50, metrics=["bleu", "gleu"])
    ev.run_evaluation(spark, _registered(spark, sf), job, echo_words, out, "r1")
    return _rounded(store.read_scores(spark, f"{out}/scores"))


def _score(spark: SparkSession, sf: str, name: str, unit: str = "char") -> DataFrame:
    scores = metrics.get_metric(name)(fx.examples(spark, sf), ["dataset"], unit)
    return scores.select("dataset", "metric", F.round("score", 6).alias("score"))


@query
def metric_bleu(spark, sf):
    return _score(spark, sf, "BLEU")


@query
def metric_bleu_words(spark, sf):
    return _score(spark, sf, "bleu", "word")


@query
def metric_gleu(spark, sf):
    return _score(spark, sf, "gleu")


@query
def metric_chrf(spark, sf):
    return _score(spark, sf, "chrf")


@query
def metric_nist(spark, sf):
    return _score(spark, sf, "nist")


@query
def metric_ribes(spark, sf):
    return _score(spark, sf, "ribes")


@query
def metric_references(spark, sf):
    """All metrics but rank correlation over examples with one to three references."""
    many = fx.with_references(spark, sf)
    return _rounded(metrics.evaluate(many, ["bleu", "gleu", "chrf", "nist"], ["dataset"]))


@query
def metric_report(spark, sf):
    scores = metrics.evaluate(fx.examples(spark, sf), ["bleu", "gleu", "chrf", "nist"], store.RUN_KEYS)
    out = scratch_dir(spark, "scores")
    store.save_scores(scores, out)
    return _rounded(store.read_scores(spark, out))


@query
def perplexity_score(spark, sf):
    return _rounded(perplexity.perplexity(fx.tokens(spark, sf)))


@query
def perplexity_sequences(spark, sf):
    """The same from one row per sequence, as a model returns its batches."""
    steps = F.array_sort(F.collect_list(F.struct("pos", "logits", "label")))
    rows = fx.tokens(spark, sf).groupBy("seq_id").agg(steps.alias("s"))
    batches = rows.select(F.col("s.logits").alias("logits"), F.col("s.label").alias("labels"))
    return _rounded(perplexity.sequence_perplexity(batches))


# Run logs -----------------------------------------------------------------------------------------------------------


@query
def nan_guard(spark, sf):
    return runlog.nan_guard(fx.run_log(spark, sf)).select("run_id", "step", "loss", "nan_before")


@query
def smoothed_loss(spark, sf):
    smoothed = runlog.smoothed_loss(fx.run_log(spark, sf))
    cents = F.round(F.col("smoothed") * F.col("n_smoothed") * 100).cast("bigint")
    return smoothed.select("run_id", "step", "n_smoothed", cents.alias("window_cents"))


@query
def accumulation_groups(spark, sf):
    steps = runlog.optimizer_steps(fx.run_log(spark, sf))
    return steps.withColumn("loss_sum", F.round("loss_sum", 4))


@query
def stream_prompts(spark, sf):
    staged, out = scratch_dir(spark, "stream-in"), scratch_dir(spark, "stream-out")
    pairs = _texts(spark, sf)
    pairs.write.parquet(staged)
    arriving = prompt_stream.pair_stream(spark, staged, pairs.schema)
    run = prompt_stream.write_prompts(
        arriving, FIXED, txt.count_words, MAX_TOKENS, SRC, TRG, out, scratch_dir(spark, "stream-state")
    )
    run.awaitTermination()
    return spark.read.parquet(out)


def _log_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The event table read as a stream and mapped to step losses."""
    schema = fx.table(spark, sf, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    broken = (F.col("event_type") == "error") & (F.col("value") < 1.0)
    return events.select("ts", "event_type", F.when(broken, float("nan")).otherwise(F.col("value")).alias("loss"))


@query
def stream_monitor(spark, sf):
    """Windows appended as they close, the open ones at the end of the log."""
    watch = monitor.WindowMonitor(_log_stream(spark, sf), "event_type", scratch_dir(spark, "monitor"), scratch_dir(spark, "monitor-work"))
    watch.flush(watch.run())
    return watch.result().withColumn("loss_sum", F.round("loss_sum", 4))


@query
def stream_runs(spark, sf):
    """Smoothed loss of every run while it arrives: the log comes in four parts that cut runs in two."""
    arriving, out = scratch_dir(spark, "runs-in"), scratch_dir(spark, "runs-out")
    log = fx.run_log(spark, sf).select("run_id", "step", "ts", "loss")
    last = log.agg(F.max("run_id").alias("n")).first().n or 0
    quarter = F.least(F.floor((F.col("run_id") * 1000 + F.col("step")) * 4 / ((last + 1) * 1000)), F.lit(3))
    parts = log.withColumn("part", quarter)
    for part in range(4):
        parts.where(F.col("part") == part).drop("part").coalesce(1).write.mode("append").parquet(arriving)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(arriving)
    states = monitor.run_states(stream, idle="1 day")
    monitor.write_batches(states, out, scratch_dir(spark, "runs-state")).awaitTermination()
    steps = monitor.read_batches(states, out).where("event = 'step'")
    cents = F.round(F.col("smoothed") * F.col("n_smoothed") * 100).cast("bigint")
    return steps.select("run_id", "step", "nan_before", "n_smoothed", cents.alias("window_cents"))
