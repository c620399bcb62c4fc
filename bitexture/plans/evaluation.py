"""Evaluation: load examples, render prompts, generate, save predictions, score every dataset."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bitexture.functions.prompts import PromptComposer
from bitexture.functions.wrappers import ModelWrapper, get_wrapper
from bitexture.operators.curate import numbered_calls
from bitexture.operators.generate import MakeGenerator, cut_prompt, generate
from bitexture.operators.metrics import evaluate
from bitexture.operators.splits import limit_examples
from bitexture.sources.registry import DatasetRegistry
from bitexture.sources.store import RUN_KEYS, read_predictions, read_scores, save_predictions, save_scores


@dataclass
class EvaluationJob:
    experiment: str
    datasets: list[str]
    composer: PromptComposer
    start_lang: str
    start_col: str = "src_text"
    dest_col: str = "trg_text"
    id_col: str = "pair_id"
    split: str | None = "validation"
    wrapper: str | ModelWrapper | None = None
    max_examples: int | None = None
    metrics: list[str] = field(default_factory=lambda: ["bleu"])
    unit: str = "char"


def evaluation_inputs(df: DataFrame, job: EvaluationJob) -> DataFrame:
    """``(example_id, inputs, outputs)`` with the start column replaced by its rendered query prompt."""
    df, call = numbered_calls(df, job.composer, job.id_col)
    prompt = get_wrapper(job.wrapper).query(job.composer.query(F.col(job.start_col), job.start_lang, call))
    return df.select(
        F.col(job.id_col).alias("example_id"), prompt.alias("inputs"), F.col(job.dest_col).alias("outputs")
    )


def load_examples(
    spark: SparkSession, registry: DatasetRegistry, job: EvaluationJob, default_limit: int | None = None
) -> DataFrame:
    """Examples of all datasets of a job, limited per dataset, under a ``dataset`` column."""
    parts = []
    for name in job.datasets:
        rows = limit_examples(registry.load(spark, name, job.split), job.id_col, job.max_examples, default_limit)
        parts.append(evaluation_inputs(rows, job).withColumn("dataset", F.lit(name)))
    return reduce(DataFrame.unionByName, parts)


def preview_prompts(spark: SparkSession, registry: DatasetRegistry, job: EvaluationJob) -> DataFrame:
    """Prompts and expected outputs of a few examples, without inference: 10 per dataset unless the job says."""
    shown = load_examples(spark, registry, job, default_limit=10)
    return shown.select("dataset", "example_id", F.col("inputs").alias("prompt"), F.col("outputs").alias("expected"))


def predict(examples: DataFrame, make_generator: MakeGenerator) -> DataFrame:
    generated = generate(examples, make_generator)
    return generated.withColumn("predictions", cut_prompt(F.col("generated"), F.col("inputs"))).drop("generated")


def run_evaluation(
    spark: SparkSession,
    registry: DatasetRegistry,
    job: EvaluationJob,
    make_generator: MakeGenerator,
    out_dir: str,
    run: str,
) -> DataFrame:
    """Predictions and scores are written before they are read, so both are computed once. Returns the saved scores; a run
    that is repeated replaces its earlier results."""
    examples = load_examples(spark, registry, job)
    save_predictions(predict(examples, make_generator), f"{out_dir}/predictions", job.experiment, run)
    saved = read_predictions(spark, f"{out_dir}/predictions", job.experiment, run)
    scores = evaluate(saved, job.metrics, RUN_KEYS, job.unit)
    save_scores(scores, f"{out_dir}/scores")
    return read_scores(spark, f"{out_dir}/scores").where((F.col("experiment") == job.experiment) & (F.col("run_id") == run))
