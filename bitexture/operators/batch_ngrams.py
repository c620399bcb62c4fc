"""N-grams of the examples of one Arrow batch, counted side by side in numpy.

Units become numbers, and an n-gram is the number of its first ``n - 1`` units and its last unit, so grams of any length are
compared exactly as pairs of integers. Batches are taken in chunks of about ``UNITS_A_CHUNK`` units, which bounds memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

UNITS_A_CHUNK = 1 << 18


@dataclass
class Units:
    """The characters or words of texts, one text after another."""

    code: np.ndarray  # equal where the units are
    text: np.ndarray  # number of the unit's text
    start: np.ndarray  # bytes in ``data``; the units of a text stand side by side, words with one blank between them
    end: np.ndarray
    data: np.ndarray


def cut_units(texts: pa.Array, unit: str) -> Units:
    texts = texts.cast(pa.string())
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset).astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    if unit == "char":
        lead = (data[offsets[0] : offsets[-1]] & 0xC0) != 0x80
        start = np.flatnonzero(lead) + offsets[0]
        end = np.append(start[1:], offsets[-1])[: len(start)]
        code, width = data[start].astype(np.int64), end - start
        for k in range(1, int(width.max(initial=1))):
            longer = np.flatnonzero(width > k)
            code[longer] = code[longer] * 256 + data[start[longer] + k]
        before = np.concatenate(([0], np.cumsum(lead)))
        return Units(code, np.repeat(np.arange(len(texts)), np.diff(before[offsets - offsets[0]])), start, end, data)
    if unit != "word":
        raise ValueError(f"unit must be char or word, not {unit}")
    found = [data[a:b].tobytes().split() for a, b in zip(offsets, offsets[1:])]
    words = [word for some in found for word in some]
    numbers: dict[bytes, int] = {}
    code = np.fromiter((numbers.setdefault(word, len(numbers)) for word in words), np.int64, len(words))
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    text = np.repeat(np.arange(len(texts)), [len(some) for some in found])
    return Units(code, text, end - size, end, np.frombuffer(b" ".join(words), np.uint8))


def numbered(keys: np.ndarray, bound: int) -> tuple[np.ndarray, int]:
    """Number different keys from 0 to ``bound - 1`` in ascending order: the number of each, and how many there are."""
    bits = len(keys).bit_length()
    if int(bound).bit_length() + bits > 63:
        different, number = np.unique(keys, return_inverse=True)
        return number, len(different)
    packed = np.sort((keys << bits) | np.arange(len(keys)))  # key and place in one integer: no argsort
    place, packed = packed & ((1 << bits) - 1), packed >> bits
    number = np.empty(len(keys), np.int64)
    number[place] = np.cumsum(np.concatenate(([0], packed[1:] != packed[:-1]))[: len(keys)])
    return number, int(number[place[-1]]) + 1 if len(keys) else 0


class Grams:
    """Grams of growing order that start at some places, numbered within an owner (an example or a group)."""

    def __init__(self, units: Units, owner: np.ndarray):
        self.code, self.size = numbered(units.code, int(units.code.max(initial=0)) + 1)
        self.stop = np.searchsorted(units.text, units.text, side="right")  # behind the last unit of the text
        self.at, self.n = np.arange(len(self.code)), 1
        self.number, self.count = numbered(owner * self.size + self.code, (int(owner.max(initial=0)) + 1) * self.size)

    def grow(self, alive: np.ndarray) -> None:
        """Add a unit to the grams that are alive and do not end with their text."""
        on = np.flatnonzero(alive & (self.at + self.n < self.stop[self.at]))
        self.at, number = self.at[on], self.number[on]
        keys = number * self.size + self.code[self.at + self.n]
        self.number, self.count = numbered(keys, self.count * self.size)
        self.n += 1


@dataclass
class Chunk:
    """Some examples of a batch: their texts, the hypothesis before the references."""

    rows: pa.RecordBatch
    units: Units
    example: np.ndarray  # per unit
    side: np.ndarray  # per unit: 0 for the hypothesis, j + 1 for the j-th reference

    def counts(self, grams: Grams, references: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Per gram its example and its counts in the hypothesis and in each reference."""
        side = self.side[grams.at]
        h, *refs = (np.bincount(grams.number[side == s], minlength=grams.count) for s in range(references + 1))
        example = np.empty(grams.count, np.int64)
        example[grams.number] = self.example[grams.at]
        return example, h, refs


def chunks(batch: pa.RecordBatch, unit: str) -> Iterator[Chunk]:
    """``batch`` has ``predictions`` and the list ``outputs``, both without missing texts, beside other columns."""
    outputs = batch.column("outputs")
    n_refs = np.diff(outputs.offsets.to_numpy()).astype(np.int64)
    upto = np.concatenate(([0], np.cumsum(pc.binary_length(outputs.flatten()).to_numpy())))
    sizes = pc.binary_length(batch.column("predictions")).to_numpy() + np.diff(upto[np.concatenate(([0], np.cumsum(n_refs)))])
    part = np.cumsum(sizes) // UNITS_A_CHUNK
    firsts = np.flatnonzero(np.diff(part, prepend=-1))
    for first, end in zip(firsts, np.append(firsts[1:], len(batch))):
        rows, k = batch.slice(first, end - first), n_refs[first:end]
        texts = pa.concat_arrays([rows.column("predictions"), rows.column("outputs").flatten()])
        example = np.concatenate((np.arange(len(k)), np.repeat(np.arange(len(k)), k)))
        side = np.concatenate((np.zeros(len(k), np.int64), np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k) + 1))
        units = cut_units(texts, unit)
        yield Chunk(rows, units, example[units.text], side[units.text])


def _most(counts: list[np.ndarray]) -> np.ndarray:
    return np.maximum.reduce(counts)


def match_counts(chunk: Chunk, references: int, max_n: int) -> dict[str, np.ndarray]:
    """Per example that has any unit the matches of each order: ``m<n>``, and ``m<n>_<j>`` with several references."""
    total = len(chunk.rows)
    found = {f"m{n}": np.zeros(total, np.int64) for n in range(1, max_n + 1)}
    if references > 1:
        found |= {f"m{n}_{j}": np.zeros(total, np.int64) for j in range(references) for n in range(1, max_n + 1)}
    grams = Grams(chunk.units, chunk.example)
    for n in range(1, max_n + 1):
        if not grams.count:
            break
        example, h, refs = chunk.counts(grams, references)
        sums = lambda limit: np.bincount(example, np.minimum(h, limit), total).astype(np.int64)
        found[f"m{n}"] = sums(_most(refs))
        if references > 1:
            found |= {f"m{n}_{j}": sums(limit) for j, limit in enumerate(refs)}
        if n < max_n:  # a match begins with a match
            grams.grow(((h > 0) & (_most(refs) > 0))[grams.number])
    return found


def gram_texts(units: Units, at: np.ndarray, n: int) -> pa.Array:
    """The grams of ``n`` units that start at these units, as strings."""
    start, size = units.start[at], units.end[at + n - 1] - units.start[at]
    offsets = np.concatenate(([0], np.cumsum(size)))
    places = np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])
    return pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(units.data[places]))


@dataclass
class ReferenceGrams:
    """Grams of one order that references of a chunk have, each once per group, and what each example has of them."""

    n: int
    text: pa.Array
    row: np.ndarray  # a row of the group
    count: np.ndarray  # in all references
    matched: np.ndarray  # clipped at the first reference, summed over examples
    gram: np.ndarray  # per gram of an example that matches: number of the gram above
    example: np.ndarray
    clipped: list[np.ndarray]  # at each reference


def reference_grams(chunk: Chunk, group: np.ndarray, references: int, max_n: int) -> Iterator[ReferenceGrams]:
    """``group`` is a number per row of the chunk; rows of one number are in one group."""
    own, shared = Grams(chunk.units, chunk.example), Grams(chunk.units, group[chunk.example])
    for n in range(1, max_n + 1):
        if not own.count:
            return
        example, h, refs = chunk.counts(own, references)
        r = sum(refs)
        gram, at = np.empty(own.count, np.int64), np.empty(shared.count, np.int64)
        gram[own.number], at[shared.number] = shared.number, shared.at
        count = np.bincount(gram, r, shared.count).astype(np.int64)
        matched = np.bincount(gram, np.minimum(h, refs[0]), shared.count).astype(np.int64)
        known = np.flatnonzero(count)
        renumbered = np.cumsum(count > 0) - 1
        both = np.flatnonzero((h > 0) & (r > 0))
        yield ReferenceGrams(
            n, gram_texts(chunk.units, at[known], n), chunk.example[at[known]], count[known], matched[known],
            renumbered[gram[both]], example[both], [np.minimum(h, one)[both] for one in refs],
        )
        if n < max_n:  # a gram of a reference begins with one
            alive = (r > 0)[own.number]
            own.grow(alive)
            shared.grow(alive)
