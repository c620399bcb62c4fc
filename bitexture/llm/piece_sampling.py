"""Sampled SentencePiece segmentations by forward filtering and backward sampling, and lossless decoding.

Pieces and their order come from a public model file. A text is cut into units before every run of blanks and around
every line break; no piece of the vocabulary reaches across such a cut, so the lattice of the text is the chain of the
lattices of its units. A unit's lattice is filtered forwards once per batch and gives, for each place in it, the
probabilities of the piece that ends there. The backward draws of all units of a batch run side by side: in each step
every unfinished unit draws its next piece with a number made from the row's key, the unit's place and the step. So a
row's segmentation depends on its key, text and seed alone.

The text is taken as it is: no normalisation and no blank put in front. A blank is the mark that the vocabulary uses for
it; characters without a piece, line breaks and the mark itself become byte pieces. Decoding gives back every text.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitexture.llm.common import MULTIPLIER, mixed

MODEL = public_tokenizers.path("piece_bpe_32k.model")
MARK = "▁"
UNITS = re.compile(r"\n| *[^ \n]+| +")
BYTE = re.compile(r"<0x([0-9A-F]{2})>")
SEED = 7
SHARPNESS = 1.0  # exponent of the piece probabilities: 0 draws all segmentations alike, large values the most likely
LITERAL_MARK = 0x110000  # no code point: the mark as a character of the text, which has no piece
BATCH_CHARS = 1_000_000
BATCH_ROWS = 500


class Vocabulary:
    """Pieces with log weights. The model ranks its pieces by merges, so the weights follow Zipf's law over ranks.

    A hash table over code points holds every piece and every beginning of one, so that all places of many texts are
    looked up at once, one length after another.
    """

    def __init__(self, model_file: str):
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.byte_ids, self.log_weights, known = np.zeros(256, np.int32), np.zeros(len(self.pieces)), {}
        for i, piece in enumerate(self.pieces):
            if model.is_byte(i):
                self.byte_ids[int(BYTE.fullmatch(piece)[1], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                known[piece] = i
                self.log_weights[i] = -math.log(1 - model.get_score(i))
        self.byte_weight = -math.log(1 + len(self.pieces))
        self.longest = max(map(len, known))
        self.bytes_of = [p.replace(MARK, " ").encode() for p in self.pieces]
        for value, i in enumerate(self.byte_ids):
            self.bytes_of[i] = bytes([value])
        starts = {piece[:n]: -1 for piece in known for n in range(1, len(piece))} | known
        self._build({self._hash(text): i for text, i in starts.items()})

    @staticmethod
    def _hash(text: str) -> int:
        h = np.zeros(1, np.uint64)
        for char in text:
            h = h * MULTIPLIER + np.uint64(ord(char) + 1)
        return int(h[0])

    def _build(self, ids: dict[int, int]) -> None:
        size = 1 << (8 * len(ids)).bit_length()
        self._mask, self._hashes, self._ids = np.uint64(size - 1), np.zeros(size, np.uint64), np.full(size, -1, np.int32)
        for h, i in ids.items():
            slot = int(mixed(np.array([h], np.uint64))[0] & self._mask)
            while self._hashes[slot]:
                slot = (slot + 1) % size
            self._hashes[slot], self._ids[slot] = h, i

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each is the start of a piece, and the piece it is, or -1."""
        slots = mixed(hashes) & self._mask
        held = self._hashes[slots]
        open_ = np.flatnonzero((held != hashes) & (held != 0))
        while len(open_):
            slots[open_] = (slots[open_] + np.uint64(1)) & self._mask
            held[open_] = self._hashes[slots[open_]]
            open_ = open_[(held[open_] != hashes[open_]) & (held[open_] != 0)]
        found = held == hashes
        return found, np.where(found, self._ids[slots], -1)


@lru_cache(maxsize=2)
def vocabulary(model_file: str) -> Vocabulary:
    return Vocabulary(model_file)


@dataclass(frozen=True)
class Lattices:
    """Filtered lattices of many units, one after another.

    State 0 is the start of every unit, state ``c + 1`` the place after character ``c``. The choices of a state are its
    pieces, longest first: cumulated probability, state before the piece, and piece. A character that only bytes can
    write is a choice ``-1 - code point``.
    """

    ends: np.ndarray  # last state of each unit
    first: np.ndarray  # first choice of each state, and the number of choices
    chance: np.ndarray
    before: np.ndarray
    piece: np.ndarray


def code_points(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    mark = ord(MARK)
    return np.where(points == mark, LITERAL_MARK, np.where(points == 32, mark, points))


def utf8(point: int) -> bytes:
    return (MARK if point == LITERAL_MARK else chr(point)).encode()


def filtered(units: list[str], vocab: Vocabulary, sharpness: float) -> Lattices:
    """Forward filtering of non-empty units, side by side."""
    points = code_points("".join(units))
    sizes = np.fromiter(map(len, units), np.int64, len(units))
    ends = np.cumsum(sizes)
    place = np.arange(len(points)) - np.repeat(ends - sizes, sizes)
    left = np.repeat(sizes, sizes) - place  # characters from here to the end of the unit
    found = []
    at, hashes = np.arange(len(points)), np.zeros(len(points), np.uint64)
    for length in range(1, vocab.longest + 1):
        fits = left[at] >= length
        at, hashes = at[fits], hashes[fits]
        hashes = hashes * MULTIPLIER + (points[at + length - 1] + 1).astype(np.uint64)
        alive, ids = vocab.look_up(hashes)
        whole = np.flatnonzero(ids >= 0)
        found.append((at[whole], ids[whole], sharpness * vocab.log_weights[ids[whole]]))
        if length == 1:
            alone = np.flatnonzero(ids < 0)
            spelled = points[at[alone]]
            n_bytes = 1 + (spelled > 0x7F) + (spelled > 0x7FF) + ((spelled > 0xFFFF) & (spelled != LITERAL_MARK))
            spelled_edges = (at[alone], (-1 - spelled).astype(np.int32), sharpness * vocab.byte_weight * n_bytes)
        at, hashes = at[alive], hashes[alive]
    edges = [(length, *edge) for length, edge in enumerate(found, 1)][::-1] + [(1, *spelled_edges)]

    n_choices = np.zeros(len(points) + 1, np.int64)
    for length, start, _, _ in edges:
        n_choices[start + length] += 1  # starts are distinct within an entry
    first = np.concatenate(([0], np.cumsum(n_choices)))
    piece, weight, before = np.empty(first[-1], np.int32), np.empty(first[-1]), np.empty(first[-1], np.int64)
    filled = first[:-1].copy()
    for length, start, ids, weights in edges:
        to = filled[start + length]
        piece[to], weight[to], before[to] = ids, weights, np.where(place[start] > 0, start, 0)
        filled[start + length] += 1

    alpha = np.full(len(points) + 1, -np.inf)
    alpha[0] = 0.0
    by_place = np.argsort(place, kind="stable")
    bounds = np.concatenate(([0], np.cumsum(np.bincount(place))))
    for low, high in zip(bounds[:-1], bounds[1:]):
        states = by_place[low:high] + 1
        choice, stop = first[states], first[states + 1]
        total = weight[choice] + alpha[before[choice]]
        more = np.flatnonzero(choice + 1 < stop)
        while len(more):
            choice[more] += 1
            total[more] = np.logaddexp(total[more], weight[choice[more]] + alpha[before[choice[more]]])
            more = more[choice[more] + 1 < stop[more]]
        alpha[states] = total
    of = np.repeat(np.arange(len(points) + 1), n_choices)
    chance = np.cumsum(np.exp(weight + alpha[before] - alpha[of]))
    chance -= np.concatenate(([0.0], chance))[first[:-1]][of]
    chance[first[2:] - 1] = 2.0  # the last choice takes what rounding leaves; state 0 has none
    return Lattices(ends, first, chance, before, piece)


def row_keys(keys: list, seed: int) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(str(k), seed) for k in keys), np.uint64, len(keys))


def sample_batch(texts: list[str], keys: np.ndarray, vocab: Vocabulary, sharpness: float) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all texts, one after another, and how many each text has."""
    numbers: dict[str, int] = {}
    units = [[numbers.setdefault(u, len(numbers)) for u in UNITS.findall(text)] for text in texts]
    counts = np.fromiter(map(len, units), np.int64, len(units))
    if not numbers:
        return np.empty(0, np.int32), np.zeros(len(texts), np.int64)
    lattices = filtered(list(numbers), vocab, sharpness)
    state = lattices.ends[np.fromiter(chain.from_iterable(units), np.int64, int(counts.sum()))]
    first, chance = lattices.first, lattices.chance
    row = np.repeat(np.arange(len(texts)), counts)
    place = np.arange(len(state)) - np.repeat(np.cumsum(counts) - counts, counts)
    unit_key = mixed(keys[row] + place.astype(np.uint64) * MULTIPLIER)
    live, drawn, n_pieces = np.arange(len(state)), [], np.zeros(len(state), np.int64)
    while len(live):
        here = state[live]
        draw = (mixed(unit_key[live] + np.uint64(len(drawn))) >> np.uint64(11)).astype(np.float64) / (1 << 53)
        choice = first[here]
        on = np.flatnonzero(chance[choice] <= draw)
        while len(on):  # walk to the first choice whose cumulated probability exceeds the draw
            choice[on] += 1
            on = on[chance[choice[on]] <= draw[on]]
        drawn.append((live, lattices.piece[choice]))
        n_pieces[live] += 1
        after = lattices.before[choice]
        state[live] = after
        live = live[after > 0]
    last = np.cumsum(n_pieces) - 1
    pieces = np.empty(int(n_pieces.sum()), np.int32)
    for step, (unit, piece) in enumerate(drawn):  # drawn from the end of a unit to its start
        pieces[last[unit] - step] = piece
    per_text = np.bincount(row, n_pieces, len(texts)).astype(np.int64)
    spelled = np.flatnonzero(pieces < 0)
    if len(spelled):
        written = [vocab.byte_ids[list(utf8(-1 - int(p)))] for p in pieces[spelled]]
        extra = np.fromiter((len(w) - 1 for w in written), np.int64, len(written))
        sizes = np.ones(len(pieces), np.int64)
        sizes[spelled] += extra
        within = np.repeat(np.arange(len(texts)), per_text)
        per_text += np.bincount(within[spelled], extra, len(texts)).astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        at = np.repeat(starts[spelled], extra + 1) + np.concatenate([np.arange(n + 1) for n in extra])
        pieces = np.repeat(pieces, sizes)
        pieces[at] = np.concatenate(written)
    return pieces, per_text


def decode_pieces(ids: np.ndarray, vocab: Vocabulary) -> str:
    return b"".join(map(vocab.bytes_of.__getitem__, ids.tolist())).decode()


def _chunks(texts: list[str]) -> Iterator[slice]:
    """Runs of rows with about ``BATCH_CHARS`` characters."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= BATCH_CHARS:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def sample_pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    model_file: str = MODEL,
    seed: int = SEED,
    sharpness: float = SHARPNESS,
) -> DataFrame:
    """One row per input row: id, ``pieces`` (ids of a sampled segmentation).

    A missing text counts as empty and has no pieces. Rows with the same id and text get the same pieces; a missing id
    is a key like any other. A word without blanks is one unit of any length. Other columns play no part, and an empty
    table gives an empty table.
    """

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(model_file)
        for whole in batches:
            for batch in (whole.slice(start, BATCH_ROWS) for start in range(0, len(whole), BATCH_ROWS)):
                ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
                keys = row_keys(ids.to_pylist(), seed)
                for part in _chunks(texts):
                    pieces, counts = sample_batch(texts[part], keys[part], vocab, sharpness)
                    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(pieces, pa.int32()))
                    yield pa.RecordBatch.from_arrays([ids[part.start : part.stop], lists], names=["id", "pieces"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(sample, f"id {kind}, pieces array<int>").withColumnRenamed("id", id_col)


def decoded(pieces: Column, model_file: str = MODEL) -> Column:
    """The text that an array of piece ids writes; missing for a missing array."""

    @F.pandas_udf("string")
    def decode(rows):
        vocab = vocabulary(model_file)
        return rows.map(lambda ids: None if ids is None else decode_pieces(np.asarray(ids, np.int64), vocab))

    return decode(pieces)
