"""Token-id store: every document is one zstandard frame made with a dictionary that all documents share.

A store is a folder of three parquet tables, so that any file system Spark writes to can hold it:

``shards``      ``shard``, ``dictionary_hash``, ``frames``: the frames of consecutive documents, one after another; beside
                them the documents' ids, lengths and token counts, so that a scan needs no index
``index``       ``doc_id``, ``place``, ``shard``, ``offset``, ``length`` (bytes in the shard), ``start`` (ids of all
                documents before), ``n_tokens``
``dictionary``  ``dictionary_hash``, ``dictionary``, ``id_bytes`` (2 or 4: little-endian unsigned width of an id),
                ``end_id``, ``tokenizer_hash``

Documents stand in ascending order of their id. A short document is read through the index: its shard, and in that
the bytes of its frame alone are decompressed.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import Sequence

from bitexture.llm.common import id_sample, staged

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 0
SAMPLE_DOCS = 512  # bound of the dictionary's training sample
SAMPLE_CHUNK = 16_384  # bytes; longer documents of the sample are cut into several training samples
DICTIONARY_BYTES = 65_536
LEVEL = 3
SHARD_BYTES = 1 << 20
KNOWN_UNITS = 600_000  # units a worker remembers
UNITS_A_CALL = 300
BYTES_A_CALL = 1 << 23  # of texts; a longer text is a call of its own
ROWS_A_CALL = 1_000
MARKS = ".,;:!?#$%&*"
MARKS_OUT = str.maketrans("", "", MARKS)


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def file_hash(path: str) -> str:
    with open(path, "rb") as file:
        return xxhash.xxh128_hexdigest(file.read())


def _ids(model: Tokenizer, text: str) -> np.ndarray:
    (found,) = model.encode_batch_fast([text], add_special_tokens=False)
    return np.array(found.ids, np.uint32)


def _starts(counts: np.ndarray) -> np.ndarray:
    return np.cumsum(counts) - counts


def _gathered(ids: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The runs of ``counts`` ids from ``starts`` on, one after another."""
    return ids[np.repeat(starts - _starts(counts), counts) + np.arange(counts.sum())]


class LetterModel:
    """Ids of words of letters, many of them in one call, by the tokenizer's own model without its search for cuts.

    The ends of the words are given as a byte that no merge has, so pairs are merged as they are in each word alone, in
    the same order. A word stands with the blank before it, or with a line break, which is cut off in the same way.
    """

    CUT, END = "\0", "\1"
    LETTERS = "".join(map(chr, (*range(65, 91), *range(97, 123), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x180))))

    def __init__(self, model: Tokenizer):
        others = iter(range(256, 512))  # a byte that cannot be shown stands as the next character from U+0100 on
        plain = (33 <= b < 127 or 161 <= b < 173 or b > 173 for b in range(256))
        self._shown = np.array([b if as_is else next(others) for b, as_is in enumerate(plain)], "<u2")
        self._cut, self._end = (model.token_to_id(chr(self._shown[ord(c)])) for c in (self.CUT, self.END))
        self._model = Tokenizer.from_str(model.to_str())
        self._model.pre_tokenizer = Sequence([])

    @classmethod
    def of(cls, model: Tokenizer) -> LetterModel | None:
        """None for a tokenizer whose words cannot be joined so."""
        facts, found = json.loads(model.to_str()), cls(model)
        merging, before = facts["model"], facts["pre_tokenizer"] or {}
        changed = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        if merging["type"] != "BPE" or any(merging.get(k) for k in changed) or facts["normalizer"]:
            return None
        if before.get("type") != "ByteLevel" or not before.get("use_regex") or before.get("add_prefix_space"):
            return None
        bounds = {chr(found._shown[ord(c)]) for c in (cls.CUT, cls.END)}
        joined = any(len(piece) > 1 and not bounds.isdisjoint(piece) for piece in merging["vocab"])
        # An added token has a character that neither words nor their marks have, so it stands in none of them.
        added = all(re.search("[!-@[-`{-~]", token["content"].translate(MARKS_OUT)) for token in facts["added_tokens"])
        every = all(chr(c) in merging["vocab"] for c in found._shown)
        return found if every and added and not joined else None

    def encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after another, and the count of each."""
        (text,) = pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), f"{self.END} ").to_pylist()
        text = f" {text}{self.END}" if len(words) else ""
        raw = np.frombuffer(text.replace(" \n", f"\n{self.CUT}").encode(), np.uint8)
        shown, cuts = self._shown[raw], np.flatnonzero(raw == ord(self.END))[UNITS_A_CALL - 1 :: UNITS_A_CALL] + 1
        calls = [_ids(self._model, part.tobytes().decode("utf-16-le")) for part in np.split(shown, cuts) if len(part)]
        ids = np.concatenate([*calls, np.empty(0, np.uint32)])
        ids = ids[ids != self._cut]
        ends = ids == self._end
        return ids[~ends], np.diff(np.flatnonzero(ends), prepend=-1) - 1


class UnitEncoder:
    """Ids of whole texts through ids of their lines' blank-separated units, each of which is encoded once.

    The pre-tokenizer of a byte-level model always cuts around a single line break and before a single blank between
    two characters that are no white space, and between a letter and ``MARKS`` at the end of a unit. So the ids of the parts, one
    after another, are the ids of the whole. A text with any other white space at such a place is encoded as a whole.

    Units are split and looked up in Arrow, a call's texts at a time; words without their marks go to ``LetterModel``.

    The first unit of a line is held with its line break, any other one without its blank. The ids of all units stand in
    one array, those of a unit from ``_begins`` on, ``_counts`` of them (-1 forbids the cut).
    """

    def __init__(self, path: str):
        self._model = tokenizer(path)
        self._letters = LetterModel.of(self._model)
        self._break = _ids(self._model, "\n")
        self._known = pa.array([], pa.string())
        self._ids = np.empty(0, np.uint32)
        self._begins, self._counts, self._seen = (np.empty(0, np.int64) for _ in range(3))

    def _forget(self) -> None:
        """Keep the units that came again, the most frequent ones if they are more than half of what may be remembered."""
        kept = np.flatnonzero(self._seen > 1)
        if len(kept) > KNOWN_UNITS // 2:
            kept = np.sort(kept[np.argsort(-self._seen[kept], kind="stable")[: KNOWN_UNITS // 2]])
        self._known, self._counts, self._seen = self._known.take(pa.array(kept)), self._counts[kept], self._seen[kept] // 2
        lengths = np.maximum(self._counts, 0)
        self._ids, self._begins = _gathered(self._ids, self._begins[kept], lengths), _starts(lengths)

    def _encoded(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units in lines of one text, one after another, and the count of each: no unit has a line break."""
        ids = _ids(self._model, "\n".join(units))
        cuts = np.flatnonzero(ids == self._break[0]) if len(self._break) == 1 else ()
        if len(cuts) == len(units) - 1:
            return np.delete(ids, cuts), np.diff(cuts, prepend=-1, append=len(ids)) - 1
        parts = [_ids(self._model, unit) for unit in units]  # a model without an id of its own for the line break
        return np.concatenate(parts), np.array([len(x) for x in parts], np.int64)

    def _in_calls(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [self._encoded(units[i : i + UNITS_A_CALL]) for i in range(0, len(units), UNITS_A_CALL)]
        return tuple(np.concatenate(x) for x in zip(*found, (np.empty(0, np.uint32), np.empty(0, np.int64))))

    def _words(self, units: pa.Array, bare: pa.Array, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and counts of words of letters with or without marks. ``bare``: without; ``at``: its number, -1 if not known."""
        marks = pc.utf8_ltrim(units, "\n" + LetterModel.LETTERS).dictionary_encode()
        words = bare.filter(pa.array(at < 0)).dictionary_encode()
        pool, runs = [self._ids], []
        for ids, counts in (self._letters.encode(words.dictionary), self._in_calls(marks.dictionary.to_pylist())):
            runs.append(np.stack([sum(map(len, pool)) + _starts(counts), counts]))
            pool.append(ids)
        of_bare = np.empty((2, len(units)), np.int64)
        of_bare[:, at < 0] = runs[0][:, words.indices.to_numpy()]
        of_bare[:, at >= 0] = self._begins[at[at >= 0]], self._counts[at[at >= 0]]
        of_marks = runs[1][:, marks.indices.to_numpy()]
        both = np.stack([of_bare, of_marks], 2).reshape(2, -1)  # each word's ids, then those of its marks
        return _gathered(np.concatenate(pool), *both), of_bare[1] + of_marks[1]

    def _others(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        firsts = np.array([unit[:1] == "\n" for unit in units], bool)
        ids, counts = self._in_calls([unit[1:] if first else f" {unit}" for first, unit in zip(firsts, units)])
        ids = np.insert(ids, np.repeat(_starts(counts)[firsts], len(self._break)), np.tile(self._break, firsts.sum()))
        return ids, counts + firsts * len(self._break)

    def _learned(self, units: pa.Array) -> np.ndarray:
        """Numbers of different units; ids of those not known yet are found out."""
        bare, known = pc.utf8_rtrim(units, MARKS), len(self._known)
        at = pc.index_in(pa.concat_arrays([units, bare]), value_set=self._known).fill_null(-1).to_numpy()
        numbers, of_bare = at[: len(units)].astype(np.int64), at[len(units) :]
        new = np.flatnonzero(numbers < 0)
        units, bare, of_bare = units.take(pa.array(new)), bare.take(pa.array(new)), of_bare[new]
        kinds = np.zeros(len(new), np.int8)  # 0: a word, 1: another unit, 2: one that forbids the cut
        if self._letters:
            pattern = f"^\n?[{LetterModel.LETTERS}]+[{re.escape(MARKS)}]*$"
            kinds += ~pc.match_substring_regex(units, pattern).to_numpy(zero_copy_only=False)
        else:
            kinds += 1
        others = np.flatnonzero(kinds)
        for place, unit in zip(others.tolist(), units.take(pa.array(others)).to_pylist()):
            text = unit[unit[:1] == "\n" :]
            kinds[place] += not text or text[0].isspace() or text[-1].isspace()
        words, others, none = (np.flatnonzero(kinds == kind) for kind in range(3))
        part = pa.array(words)
        found = [self._words(units.take(part), bare.take(part), of_bare[words])] if len(words) else []
        found += [self._others(units.take(pa.array(others)).to_pylist()), (np.empty(0, np.uint32), np.full(len(none), -1))]
        order, ids, counts = np.concatenate([words, others, none]), *(np.concatenate(x) for x in zip(*found))
        numbers[new[order]] = known + np.arange(len(new))
        self._known = pa.concat_arrays([self._known, units.take(pa.array(order))])
        self._begins = np.append(self._begins, len(self._ids) + _starts(np.maximum(counts, 0)))
        self._counts, self._seen = np.append(self._counts, counts), np.append(self._seen, np.zeros(len(new), np.int64))
        self._ids = np.append(self._ids, ids)
        return numbers

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        if len(self._known) > KNOWN_UNITS:
            self._forget()
        # As if each text began after a line break.
        lines = pc.binary_join_element_wise("\n", pc.replace_substring(texts.cast(pa.string()), "\n", " \n"), "")
        split = pc.split_pattern(lines, " ")
        bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
        units = split.flatten().dictionary_encode()
        numbers, places = self._learned(units.dictionary), units.indices.to_numpy()
        self._seen[numbers] += np.bincount(places, minlength=len(numbers))
        begins, counts = self._begins[numbers], self._counts[numbers]
        for row in range(0, len(texts), ROWS_A_CALL):
            cuts = bounds[row : row + ROWS_A_CALL + 1]
            part = places[cuts[0] : cuts[-1]]
            firsts, lengths = cuts[:-1] - cuts[0], counts[part]
            whole = np.minimum.reduceat(lengths, firsts) < 0  # a unit forbids the cut
            lengths = np.maximum(lengths, 0)
            ids, ends = _gathered(self._ids, begins[part], lengths), np.cumsum(lengths)
            spans = zip(whole, (ends - lengths)[firsts] + len(self._break), ends[cuts[1:] - cuts[0] - 1])
            for place, (alone, start, end) in enumerate(spans, row):
                yield _ids(self._model, texts[place].as_py()) if alone else ids[start:end]


@lru_cache(maxsize=2)
def unit_encoder(path: str) -> UnitEncoder:
    """One per worker process, so that later tasks know the units of earlier ones."""
    return UnitEncoder(path)


@dataclass(frozen=True)
class Codec:
    """How ids become frames."""

    dictionary: bytes
    id_bytes: int

    @property
    def hash(self) -> str:
        return xxhash.xxh128_hexdigest(self.dictionary)

    def _shared(self) -> zstandard.ZstdCompressionDict | None:
        return zstandard.ZstdCompressionDict(self.dictionary) if self.dictionary else None

    def serialized(self, ids: np.ndarray) -> bytes:
        return ids.astype(f"<u{self.id_bytes}").tobytes()

    def compressor(self) -> zstandard.ZstdCompressor:
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=self._shared())

    def decompressor(self) -> zstandard.ZstdDecompressor:
        return zstandard.ZstdDecompressor(dict_data=self._shared())

    def ids(self, raw: bytes) -> np.ndarray:
        return np.frombuffer(raw, f"<u{self.id_bytes}").astype(np.uint32)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def _encoded(model_file: str, end_id: int):
    """Per batch of texts their ids with the end id, by calls of bounded size."""

    def encode(texts: pa.Array) -> Iterator[list[np.ndarray]]:
        encoder = unit_encoder(model_file)
        upto = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64)
        first, done = 0, 0
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(upto, done + BYTES_A_CALL, "right")))
            yield [np.append(ids, np.uint32(end_id)) for ids in encoder.encode(texts.slice(first, last - first))]
            first, done = last, upto[last - 1]

    return encode


def train_dictionary(texts: DataFrame, model_file: str, end_id: int, id_bytes: int) -> bytes:
    """A dictionary from the serialized ids of at most ``SAMPLE_DOCS`` documents; empty if they are too few to train."""
    chosen = F.broadcast(id_sample(texts.select("doc_id"), "doc_id", SAMPLE_DOCS))
    sample = texts.join(chosen, "doc_id", "left_semi")
    plain, encode = Codec(b"", id_bytes), _encoded(model_file, end_id)

    def serialize(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for arrays in encode(pa.array(batch["text"], pa.string())):
                yield pd.DataFrame({"raw": [plain.serialized(ids) for ids in arrays]})

    rows = [r.raw for r in sample.mapInPandas(serialize, "raw binary").limit(SAMPLE_DOCS).collect()]
    pieces = [bytes(raw[i : i + SAMPLE_CHUNK]) for raw in sorted(rows) for i in range(0, len(raw), SAMPLE_CHUNK)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces, level=LEVEL, threads=0).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _frames(codec: Codec, model_file: str, end_id: int):
    encode = _encoded(model_file, end_id)

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = codec.compressor()
        for batch in batches:
            first = 0
            for arrays in encode(batch.column("text")):
                frames = [compressor.compress(codec.serialized(ids)) for ids in arrays]
                sizes = pa.array([len(ids) for ids in arrays], pa.int64())
                columns = [batch.column("doc_id").slice(first, len(arrays)), sizes, pa.array(frames, pa.binary())]
                first += len(arrays)
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "frame"])

    return compress


def _sharded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Gather the frames of a sorted partition into shards of about ``SHARD_BYTES``."""
    part, shard, held, size = TaskContext.get().partitionId(), 0, [], 0

    def row():
        ids, tokens, frames = zip(*held)
        return pd.DataFrame(
            {
                "part": [part],
                "shard": [shard],
                "doc_ids": [list(ids)],
                "n_tokens": [list(tokens)],
                "lengths": [[len(f) for f in frames]],
                "tokens": [sum(tokens)],
                "frames": [b"".join(frames)],
            }
        )

    for batch in batches:
        ids = [None if pd.isna(i) else i for i in batch["doc_id"]]
        for doc in zip(ids, batch["n_tokens"].tolist(), batch["frame"]):
            held.append(doc)
            size += len(doc[2])
            if size >= SHARD_BYTES:
                yield row()
                shard, held, size = shard + 1, [], 0
    if held:
        yield row()


def write_token_store(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    model_file: str = TOKENIZER,
    end_id: int = END_ID,
) -> None:
    """Encode whole texts, add ``end_id`` to each, and write them in ascending order of their id.

    A missing text counts as empty: the end id alone. Rows with a missing id come first; rows that repeat an id stand
    side by side, those with fewer tokens first and equal counts in order of their frames. Other columns are left out.
    An empty table gives an empty store. Memory is bounded by one batch of documents and one shard.
    """
    spark = docs.sparkSession
    id_bytes = 2 if max(tokenizer(model_file).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    texts = _texts(docs, id_col, text_col)
    codec = Codec(train_dictionary(texts, model_file, end_id, id_bytes), id_bytes)
    kind = docs.schema[id_col].dataType.simpleString()
    frames = texts.mapInArrow(_frames(codec, model_file, end_id), f"doc_id {kind}, n_tokens bigint, frame binary")
    frames = staged(frames, "frames")  # so that sampling the range bounds encodes nothing twice
    ordered = frames.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "n_tokens", "frame")
    shape = (
        f"part int, shard int, doc_ids array<{kind}>, n_tokens array<bigint>, lengths array<int>, tokens bigint, frames binary"
    )
    number = (F.col("part").cast("long") * F.lit(1 << 32)) + F.col("shard")
    shards = ordered.mapInPandas(_sharded, shape).withColumn("shard", number)
    shards.withColumn("dictionary_hash", F.lit(codec.hash)).write.parquet(f"{path}/shards")
    shards = spark.read.parquet(f"{path}/shards").drop("frames")

    totals = shards.groupBy("part").agg(F.sum("tokens").alias("tokens"), F.sum(F.size("doc_ids")).alias("docs"))
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per task of the sort
    before = totals.select(
        "part",
        F.coalesce(F.sum("tokens").over(upto), F.lit(0)).alias("tokens_before"),
        F.coalesce(F.sum("docs").over(upto), F.lit(0)).alias("docs_before"),
    )
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    places = shards.select("part", "shard", "doc_ids", "n_tokens", "lengths", "tokens").join(F.broadcast(before), "part")
    places = places.withColumns(
        {
            "tokens_before": F.col("tokens_before") + F.coalesce(F.sum("tokens").over(within), F.lit(0)),
            "docs_before": F.col("docs_before") + F.coalesce(F.sum(F.size("doc_ids")).over(within), F.lit(0)),
        }
    )
    entries = places.select("shard", "tokens_before", "docs_before", "doc_ids", "n_tokens", "lengths")
    shape = f"doc_id {kind}, place bigint, shard bigint, offset bigint, length int, start bigint, n_tokens bigint"
    entries.mapInPandas(_index_rows, shape).write.parquet(f"{path}/index")
    facts = [(codec.hash, bytearray(codec.dictionary), id_bytes, end_id, file_hash(model_file))]
    names = "dictionary_hash string, dictionary binary, id_bytes int, end_id long, tokenizer_hash string"
    spark.createDataFrame(facts, names).coalesce(1).write.parquet(f"{path}/dictionary")


def _index_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for row in batch.itertuples():
            tokens, lengths = np.asarray(row.n_tokens, np.int64), np.asarray(row.lengths, np.int64)
            yield pd.DataFrame(
                {
                    "doc_id": pd.Series(list(row.doc_ids), dtype=object),
                    "place": row.docs_before + np.arange(len(tokens)),
                    "shard": row.shard,
                    "offset": np.cumsum(lengths) - lengths,
                    "length": lengths,
                    "start": row.tokens_before + np.cumsum(tokens) - tokens,
                    "n_tokens": tokens,
                }
            )


def _codec(spark: SparkSession, path: str) -> Codec:
    row = spark.read.parquet(f"{path}/dictionary").first()
    codec = Codec(bytes(row.dictionary), row.id_bytes)
    if codec.hash != row.dictionary_hash:
        raise ValueError(f"the dictionary of {path} does not have the hash that its shards name")
    return codec


def _reader(codec: Codec, with_ids: bool):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decompressor = codec.decompressor()
        for batch in batches:
            for row in batch.itertuples():
                if row.dictionary_hash != codec.hash:
                    raise ValueError(f"shard {row.shard} was written with another dictionary")
                lengths = np.asarray(row.lengths, np.int64)
                offsets = np.cumsum(lengths) - lengths if row.offsets is None else np.asarray(row.offsets, np.int64)
                for start in range(0, len(lengths), 500):
                    part = slice(start, start + 500)
                    spans = zip(offsets[part], lengths[part])
                    ids = [codec.ids(decompressor.decompress(row.frames[at : at + length])) for at, length in spans]
                    found = {
                        "doc_id": pd.Series(list(row.doc_ids[part]), dtype=object),
                        "shard": row.shard,
                        "offset": offsets[part],
                        "n_tokens": [len(x) for x in ids],
                        "ids_crc32": [zlib.crc32(x.tobytes()) for x in ids],
                    }
                    yield pd.DataFrame(found | ({"ids": [x.astype(np.int64) for x in ids]} if with_ids else {}))

    return read


def read_token_store(spark: SparkSession, path: str, doc_ids: DataFrame | None = None, with_ids: bool = True) -> DataFrame:
    """Documents as written: ``doc_id``, ``place`` (from 0), ``start``, ``n_tokens``, ``ids_crc32`` (of the ids as
    little-endian 32-bit integers), ``ids``. ``doc_ids`` restricts it to documents whose frames alone are decompressed."""
    codec = _codec(spark, path)
    index = spark.read.parquet(f"{path}/index")
    shards = spark.read.parquet(f"{path}/shards")
    if doc_ids is None:
        none = F.lit(None).cast("array<bigint>").alias("offsets")  # frames follow each other without gaps
        shards = shards.select("shard", "dictionary_hash", "frames", "doc_ids", "lengths", none)
    else:
        wanted = doc_ids.select(F.col(doc_ids.columns[0]).alias("doc_id")).distinct()
        index = index.join(wanted, "doc_id", "left_semi")
        some = index.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("offset", "length", "doc_id"))).alias("e"))
        frames = shards.select("shard", "dictionary_hash", "frames").join(some, "shard")  # a shard has a bounded size
        shards = frames.select("shard", "dictionary_hash", "frames", F.col("e.doc_id").alias("doc_ids"), F.col("e.length").alias("lengths"), F.col("e.offset").alias("offsets"))
    kind = index.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {kind}, shard bigint, offset bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * with_ids
    found = shards.mapInPandas(_reader(codec, with_ids), shape)
    where = index.select("shard", "offset", "place", "start")
    columns = ["doc_id", "place", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    return found.join(where, ["shard", "offset"]).select(*columns)
