"""Prompt catalogues: YAML maps of instruction language, start language and wordings."""

from __future__ import annotations

import os

import yaml
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bitexture.functions.prompts import Template, TemplatePrompt

PACKAGED = os.path.join(os.path.dirname(os.path.dirname(__file__)), "catalogs")
BROADCAST_ROWS = 10_000

Wordings = dict[str, list[str]]


def read_wordings(spark: SparkSession, name_or_path: str, instruct_lang: str = "en") -> Wordings:
    """Wordings of one instruction language. ``.yml`` may be left out; a bare name is a packaged catalogue."""
    path = name_or_path if name_or_path.endswith(".yml") else f"{name_or_path}.yml"
    packaged = os.path.join(PACKAGED, path)
    if os.path.exists(packaged):
        with open(packaged, encoding="utf-8") as f:
            text = f.read()
    else:
        text = spark.read.text(path, wholetext=True).first()[0]
    languages = yaml.safe_load(text)
    if instruct_lang not in languages:
        raise KeyError(f"no prompts in instruction language {instruct_lang}; available: {', '.join(languages)}")
    return languages[instruct_lang]


def parse_wordings(wordings: Wordings) -> dict[str, list[Template]]:
    return {lang: [Template.parse(w) for w in texts] for lang, texts in wordings.items()}


def template_prompt(
    spark: SparkSession,
    name_or_path: str,
    instruct_lang: str = "en",
    *,
    random_choice: bool = False,
    seed: int = 123,
    instruction_tuned: bool = False,
) -> TemplatePrompt:
    templates = parse_wordings(read_wordings(spark, name_or_path, instruct_lang))
    return TemplatePrompt(templates, random_choice, seed, instruction_tuned)


def catalog_table(spark: SparkSession, templates: dict[str, list[Template]]) -> DataFrame:
    """``(start_lang, template_idx, n_templates, prefix, middle, suffix)``, one row per wording."""
    rows = [
        (lang, i, len(texts), t.prefix, t.middle, t.suffix)
        for lang, texts in templates.items()
        for i, t in enumerate(texts)
    ]
    schema = "start_lang string, template_idx int, n_templates int, prefix string, middle string, suffix string"
    table = spark.createDataFrame(rows, schema)
    return F.broadcast(table) if len(rows) <= BROADCAST_ROWS else table


def render_by_lookup(
    texts: DataFrame, templates: dict[str, list[Template]], call: Column, name: str = "prompt"
) -> DataFrame:
    """Render ``(start_lang, source, target)`` rows whose language differs from row to row, round robin by ``call``."""
    spark = texts.sparkSession
    sizes = F.create_map(*[F.lit(x) for lang, t in templates.items() for x in (lang, len(t))])
    indexed = texts.withColumn("template_idx", F.pmod(call, sizes[F.col("start_lang")]).cast("int"))
    joined = indexed.join(catalog_table(spark, templates), ["start_lang", "template_idx"])
    return joined.withColumn(name, F.concat("prefix", "source", "middle", "target", "suffix")).drop(
        "prefix", "middle", "suffix", "n_templates"
    )
