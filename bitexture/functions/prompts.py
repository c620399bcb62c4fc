"""Prompt composers. A composer turns text columns into one rendered prompt column."""

from __future__ import annotations

import itertools
import re
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import Column
from pyspark.sql import functions as F

from bitexture.functions.hashing import seeded_hash

# Fixed value: the marker that closes a turn in instruction-tuned templates.
END_OF_TURN = "<end_of_turn>\n"


class PromptComposer(Protocol):
    """Extension point: anything with these members can drive curation, expansion and evaluation.

    ``call`` is a column with the number of the prompt. ``sequential`` tells that calls must be numbered without
    gaps, which costs a shuffle; otherwise any unique number will do.
    """

    @property
    def sequential(self) -> bool: ...

    def train(self, source: Column, target: Column, start_lang: str, call: Column | None = None) -> Column: ...

    def query(self, source: Column, start_lang: str, call: Column | None = None) -> Column: ...


@dataclass(frozen=True)
class FixedPrompt:
    """One wording for two languages: ``[instruction ]HEADING: source HEADING: target``.

    ``headings`` has the heading of each language; prompts start with the heading of the start language.
    """

    headings: Mapping[str, str]
    instruction: str = ""
    sequential = False

    def __post_init__(self) -> None:
        if len(self.headings) != 2:
            raise ValueError(f"headings of two languages are needed, not of {len(self.headings)}")

    def query(self, source: Column, start_lang: str, call: Column | None = None) -> Column:
        others = [heading for lang, heading in self.headings.items() if lang != start_lang]
        if len(others) != 1:
            raise ValueError(f"no heading for {start_lang}; there are {sorted(self.headings)}")
        opening = " ".join(filter(None, [self.instruction, f"{self.headings[start_lang]}: "]))
        return F.concat(F.lit(opening), source, F.lit(f" {others[0]}: "))

    def train(self, source: Column, target: Column, start_lang: str, call: Column | None = None) -> Column:
        return F.concat(self.query(source, start_lang), target)


@dataclass(frozen=True)
class Template:
    """A wording cut once at its placeholders, so that placeholder-like user text is never re-read."""

    prefix: str
    middle: str
    suffix: str

    @staticmethod
    def parse(wording: str) -> "Template":
        pieces = re.split(r"\{(input|output)\}", wording)
        if pieces[1::2] != ["input", "output"]:
            raise ValueError(f"template needs {{input}} then {{output}}, once each: {wording!r}")
        return Template(pieces[0], pieces[2], pieces[4])


@dataclass(frozen=True)
class TemplatePrompt:
    """Prompts chosen from a list of wordings per start language.

    ``random_choice`` hashes the call number with the seed; otherwise calls go round robin.
    """

    templates: dict[str, list[Template]]
    random_choice: bool = False
    seed: int = 123
    instruction_tuned: bool = False

    @property
    def sequential(self) -> bool:
        return not self.random_choice and any(len(t) > 1 for t in self.templates.values())

    def _wordings(self, start_lang: str) -> list[Template]:
        if start_lang not in self.templates:
            raise ValueError(f"no templates for start language {start_lang}; known: {sorted(self.templates)}")
        return self.templates[start_lang]

    def index(self, start_lang: str, call: Column) -> Column:
        draw = seeded_hash(call, self.seed) if self.random_choice else call
        return F.pmod(draw, F.lit(len(self._wordings(start_lang)))).cast("int")

    def _render(self, source: Column, target: Column | None, start_lang: str, call: Column | None) -> Column:
        wordings = self._wordings(start_lang)
        index = self.index(start_lang, F.lit(0) if call is None else call)

        def part(field: str) -> Column:
            texts = [getattr(t, field) for t in wordings]
            if len(set(texts)) == 1:
                return F.lit(texts[0])
            return F.get(F.array(*[F.lit(t) for t in texts]), index)

        pieces = [part("prefix"), source, part("middle"), target, part("suffix")]
        return F.concat(*[p for p in pieces if p is not None])

    def train(self, source: Column, target: Column, start_lang: str, call: Column | None = None) -> Column:
        return self._render(source, target, start_lang, call)

    def query(self, source: Column, start_lang: str, call: Column | None = None) -> Column:
        prompt = self._render(source, None, start_lang, call)
        return cut_closing_marker(prompt) if self.instruction_tuned else prompt


def cut_closing_marker(prompt: Column, marker: str = END_OF_TURN) -> Column:
    """Leave the answer turn open; a prompt without the marker is an error."""
    return F.when(
        F.endswith(prompt, F.lit(marker)), F.substring(prompt, F.lit(1), F.length(prompt) - len(marker))
    ).otherwise(F.raise_error(F.lit("prompt does not end with the closing marker")))


def template_grid(
    names: dict[str, dict[str, dict[str, str]]], wordings: dict[str, list[str]]
) -> dict[str, dict[str, list[str]]]:
    """Every wording for every ordered pair of different languages, in every instruction language.

    ``names[instruction language][language]`` maps a grammatical form to the inflected language name;
    a wording refers to it as ``{source:form}`` or ``{target:form}``.
    """
    grid: dict[str, dict[str, list[str]]] = {}
    for instruct_lang, patterns in wordings.items():
        by_start = grid.setdefault(instruct_lang, {})
        for source, target in itertools.permutations(names[instruct_lang], 2):
            for pattern in patterns:
                def name(match: re.Match, source=source, target=target) -> str:
                    lang = source if match[1] == "source" else target
                    return names[instruct_lang][lang][match[2]]

                by_start.setdefault(source, []).append(re.sub(r"\{(source|target):(\w+)\}", name, pattern))
    return grid


def by_start_language(start_lang: Column, rendered: dict[str, Column]) -> Column:
    """Pick the rendering that fits a start-language column; an unknown language is an error."""
    choice = None
    for lang, prompt in rendered.items():
        choice = (F if choice is None else choice).when(start_lang == lang, prompt)
    return choice.otherwise(
        F.raise_error(F.concat(F.lit("unknown start language "), F.coalesce(start_lang, F.lit("NULL"))))
    )
