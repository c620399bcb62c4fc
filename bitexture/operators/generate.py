"""Batch inference shell: prompts in, generated text out, prompt prefix cut off."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Generator = Callable[[list[str]], list[str]]


@dataclass(frozen=True)
class ColumnGenerator:
    """A generator that is an expression over the prompt: no Python worker takes part."""

    expression: Callable[[Column], Column]


MakeGenerator = Callable[[], Generator] | ColumnGenerator


def generate(examples: DataFrame, make_generator: MakeGenerator, prompt_col: str = "inputs") -> DataFrame:
    """Add ``generated``. ``make_generator`` runs once per task and returns a function over a list of prompts, or is an
    expression.

    Write the result before scoring it: a plan that is evaluated again generates again.
    """
    if isinstance(make_generator, ColumnGenerator):
        return examples.withColumn("generated", make_generator.expression(F.col(prompt_col)))

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        generator = make_generator()
        for prompts in batches:
            yield pd.Series(generator(prompts.tolist()))

    return examples.withColumn("generated", run(prompt_col))


def _reversed_words(text: Column) -> Column:
    return F.array_join(F.reverse(F.split(text, " ")), " ")


echo_words = ColumnGenerator(lambda prompt: F.concat(prompt, _reversed_words(prompt)))


def echo_generator() -> Generator:
    """Deterministic stand-in for a model: the prompt, then its own words in reverse order. ``echo_words`` is the same as an
    expression."""
    return lambda prompts: [p + " ".join(reversed(p.split(" "))) for p in prompts]


def cut_prompt(generated: Column, prompt: Column, strict: bool = False) -> Column:
    """What follows the prompt, by its length in characters. ``strict`` rejects text that does not repeat it."""
    rest = F.substring(generated, F.length(prompt) + 1, F.length(generated))
    if not strict:
        return rest
    return F.when(F.startswith(generated, prompt), rest).otherwise(
        F.raise_error(F.lit("generated text does not start with its prompt"))
    )
