"""Deletion of repeated phrases, located by sharded Aho-Corasick automata.

A window of ``width`` words repeats if it starts in documents with different ids; the document with the smallest id owns it,
and the words under it go from all others.

- **Candidates.** Each window has an anchor, the run of ``ANCHOR_WORDS`` words in it whose hash is smallest. Equal windows have
  equal anchors, and neighbours mostly share one. Only anchors of two different texts go on.
- **Shards.** All windows of a text round one shared anchor form a stretch of at most ``2 * width - ANCHOR_WORDS`` words. It is
  sent where its anchor belongs. An anchor in more than ``CROWD`` texts sends windows one by one, each where its own hash
  belongs, so a place never gets more than ``CROWD`` texts of different stretches. Equal stretches are sent once.
- **Phrases.** The windows of a shard are compared word by word. Those of several documents are confirmed and compiled into
  automata of about ``SHARD_PHRASES`` phrases, whose letters are the words.
- **Streaming.** The stretches run through the automaton of their shard, which gives every occurrence and its owner. Their places
  in the documents are joined back, and the words under windows with an owner before the document go.

Documents with the same words are one text: its first one stands for all, and the others hold nothing that is not owned by it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bitexture.llm.common import MULTIPLIER, mixed, staged
from bitexture.llm.line_dedup import fresh_name

WIDTH = 13
ANCHOR_WORDS = 5
CROWD = 10_000
SHARD_PHRASES = 1_000
SLICE = 1 << 20
PORTION = 1 << 20
INVERSE = np.uint64(pow(int(MULTIPLIER), -1, 2**64))
LETTERS = mixed(np.arange(1, 257, dtype=np.uint64) * MULTIPLIER)  # a number per byte
IS_SPACE = np.isin(np.arange(256), list(b"\t\n\x0b\x0c\r "))
NEXT_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _slices(buffer: bytes) -> Iterator[np.ndarray]:
    """The bytes in slices that end with white space, as the buffer does; only a longer word makes one longer than ``SLICE``."""
    start = 0
    while start < len(buffer):
        stop = len(buffer)
        if stop - start > SLICE:
            after = NEXT_SPACE.search(buffer, start + SLICE)
            stop = after.end()
        yield np.frombuffer(buffer, np.uint8, stop - start, start)
        start = stop


class WordHashes:
    """Hashes of all words of a list of texts: sums of their letters' numbers times powers of an odd multiplier."""

    def __init__(self):
        self.powers = np.zeros(0, np.uint64)

    def _grown(self, n: int) -> None:
        if len(self.powers) < n:
            self.powers, self.inverses = (np.cumprod(np.full(n, p, np.uint64)) for p in (MULTIPLIER, INVERSE))

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The hashes, and for each text the number of words before it, and that of all."""
        hashes, begins, offset = [], [], 0
        for data in _slices(b"\n".join([*texts, b""])):
            self._grown(len(data))
            space = IS_SPACE[data]
            edge = np.flatnonzero(np.diff(np.r_[True, space].astype(np.int8)))
            first, end = edge[0::2], edge[1::2]
            sums = np.r_[np.uint64(0), np.cumsum(LETTERS[data] * self.powers[: len(data)])]
            hashes.append(mixed((sums[end] - sums[first]) * self.inverses[first]))
            begins.append(first + offset)
            offset += len(data)
        lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        starts = np.r_[0, np.cumsum(lengths)]
        if not hashes:
            return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
        return np.concatenate(hashes), np.searchsorted(np.concatenate(begins), starts)


def anchors(hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``ANCHOR_WORDS`` words, and for each window the place of its smallest, the leftmost of equals.

    Runs and windows that leave the sequence read on at its last word.
    """
    runs = np.zeros(len(hashes), np.uint64)
    for k in range(ANCHOR_WORDS):
        runs = runs * MULTIPLIER + _ahead(hashes, k)
    runs = mixed(runs)
    best, reach, n_runs = np.arange(len(runs)), 1, width - ANCHOR_WORDS + 1
    while reach < n_runs:
        step = min(reach, n_runs - reach)
        other = _ahead(best, step)
        best = np.where(runs[other] < runs[best], other, best)
        reach += step
    return runs, best


def _ahead(values: np.ndarray, step: int) -> np.ndarray:
    return values[np.minimum(np.arange(len(values)) + step, len(values) - 1)]


def text_key(words: list[bytes]) -> tuple[bytes, int]:
    """What tells texts apart: the digest of their words, and its first 8 bytes as a number."""
    digest = hashlib.sha256(b" ".join(words)).digest()
    return digest, int.from_bytes(digest[:8], "little", signed=True)


def _segments(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end of the runs of equal values."""
    starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return starts, np.r_[starts[1:], len(at)]


def _described(width: int):
    def described(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes_of = WordHashes()
        for batch in batches:
            for part in _portions(batch):
                texts = [(t or "").encode() for t in part["text"]]
                hashes, place = hashes_of(texts)
                runs, at = anchors(hashes, width)
                rows = []
                for doc, text, first, end in zip(part["doc"], texts, place[:-1].tolist(), place[1:].tolist()):
                    windows = at[first : end - width + 1] if end - first >= width else at[:0]
                    found = np.unique(runs[windows[_segments(windows)[0]]]) if len(windows) else runs[:0]
                    rows.append((doc, *text_key(text.split()), end - first, found.view(np.int64)))
                yield pd.DataFrame(rows, columns=["doc", "digest", "key", "n_words", "anchors"])

    return described


def _portions(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Rows of a batch with about ``PORTION`` letters, one row at least."""
    upto = batch["text"].str.len().fillna(0).cumsum().to_numpy()
    start = 0
    while start < len(batch):
        before = upto[start - 1] if start else 0
        stop = max(int(np.searchsorted(upto, before + PORTION, side="right")), start + 1)
        yield batch.iloc[start:stop]
        start = stop


def _stretches(width: int):
    def stretches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes_of = WordHashes()
        for batch in batches:
            for part in _portions(batch[batch["marked"].notna()]):
                texts = [(t or "").encode() for t in part["text"]]
                hashes, place = hashes_of(texts)
                runs, at = anchors(hashes, width)
                runs = runs.view(np.int64)
                out: list[tuple] = []
                for i, (doc, marked) in enumerate(zip(part["doc"], part["marked"])):
                    words = texts[i].split()
                    _, key = text_key(words)
                    wanted = {a: crowded for m in marked if m["key"] == key for a, crowded in zip(m["anchors"], m["crowded"])}
                    if wanted:
                        own = at[place[i] : place[i + 1] - width + 1]
                        firsts, ends = _segments(own)
                        for first, end, anchor in zip(firsts.tolist(), ends.tolist(), runs[own[firsts]].tolist()):
                            if anchor in wanted:
                                out += _sent(words, first, end, anchor, wanted[anchor], width, doc, key)
                table = pd.DataFrame(out, columns=["place", "stretch", "doc", "key", "first"])
                yield table.assign(stretch=pd.Series([s.decode() for s in table["stretch"]], dtype=object))

    return stretches


def _sent(words: list[bytes], first: int, end: int, anchor: int, crowded: bool, width: int, doc, key: int) -> list[tuple]:
    """The windows ``first <= i < end`` as one stretch to their anchor's place, or one by one to their own."""
    if not crowded:
        return [(anchor, b" ".join(words[first : end + width - 1]), doc, key, first)]
    out = []
    for i in range(first, end):
        window = b" ".join(words[i : i + width])
        out.append((int(np.uint64(xxhash.xxh64_intdigest(window, 1)).view(np.int64)), window, doc, key, i))
    return out


def _confirmed(stretches: list[tuple], width: int) -> dict[tuple, int]:
    """Windows of several documents, and the smallest of these."""
    extents: dict[tuple, tuple] = {}
    for letters, low, high in stretches:
        for i in range(len(letters) - width + 1):
            window = letters[i : i + width]
            seen = extents.get(window)
            if seen is None:
                extents[window] = (low, high)
            elif low < seen[0] or high > seen[1]:
                extents[window] = (min(low, seen[0]), max(high, seen[1]))
    return {window: low for window, (low, high) in extents.items() if low < high}


class Shard:
    """Stretches of whole places: their confirmed phrases make one automaton, through which they all run."""

    def __init__(self, width: int):
        self.width = width
        self.alphabet: dict[str, str] = {}
        self.phrases: dict[str, int] = {}
        self.stretches: list[tuple] = []

    def _letter(self, word: str) -> str:
        found = self.alphabet.get(word)
        if found is None:
            n = len(self.alphabet) + 1
            found = self.alphabet[word] = chr(n if n < 0xD800 else n + 0x800)
        return found

    def add(self, place: int, members: list[tuple]) -> None:
        """``members`` are the stretches of one place with the first and last document that holds each."""
        spelled = [("".join(map(self._letter, s.split(" "))), low, high) for s, low, high in members]
        self.phrases.update(_confirmed(spelled, self.width))
        self.stretches += [(place, s, letters) for (s, _, _), (letters, _, _) in zip(members, spelled)]

    @property
    def full(self) -> bool:
        return len(self.phrases) >= SHARD_PHRASES or len(self.stretches) >= 20 * SHARD_PHRASES

    def occurrences(self) -> pd.DataFrame:
        """Per stretch with phrases: where they start, and who owns them."""
        automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY)
        for phrase, owner in self.phrases.items():
            automaton.add_word(phrase, owner)
        automaton.make_automaton()
        rows = []
        for place, stretch, letters in self.stretches:
            hits = list(automaton.iter(letters)) if self.phrases else []
            if hits:
                rows.append((place, stretch, [end - self.width + 1 for end, _ in hits], [owner for _, owner in hits]))
        return pd.DataFrame(rows, columns=["place", "stretch", "offsets", "owners"], dtype=object)


def _located(width: int):
    def located(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Stretches come ordered by place. A place is complete when the next one starts."""
        shard, place, members = Shard(width), None, []
        for batch in batches:
            for row in zip(batch["place"], batch["stretch"], batch["low"], batch["high"]):
                if row[0] != place:
                    if members:
                        shard.add(place, members)
                    if shard.full:
                        yield shard.occurrences()
                        shard = Shard(width)
                    place, members = row[0], []
                members.append(row[1:])
        if members:
            shard.add(place, members)
        yield shard.occurrences()

    return located


def _kept(width: int):
    def kept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, counts, removed = [], [], []
            for text, verdicts in zip(batch["_text"], batch["_verdicts"]):
                words = (text or "").encode().split()
                gone = np.zeros(len(words) + 1, np.int64)
                if verdicts is not None and len(verdicts):
                    _, key = text_key(words)
                    for verdict in verdicts:
                        if verdict["key"] != key:
                            continue
                        first = np.asarray(verdict["first"], np.int64)
                        np.add.at(gone, first, 1)
                        np.add.at(gone, first + verdict["width"], -1)
                gone = np.cumsum(gone)[:-1] > 0
                left = [w for w, g in zip(words, gone.tolist()) if not g] if gone.any() else words
                texts.append(b" ".join(left).decode())
                counts.append(len(words))
                removed.append(len(words) - len(left))
            yield batch.drop(columns=["_text", "_verdicts"]).assign(
                _kept=pd.Series(texts, batch.index, dtype=object), _n_words=counts, _n_removed=removed
            )

    return kept


def phrase_places(docs: DataFrame, kind: str, width: int) -> DataFrame:
    """``(doc, key, first, width)``: the words of a document to delete, as starts of windows or as one whole text.

    ``docs`` is ``(doc, text)`` without missing ids.
    """
    shape = f"doc {kind}, digest binary, key bigint, n_words int, anchors array<bigint>"
    described = staged(docs.mapInPandas(_described(width), shape), "described")
    first = described.groupBy("digest").agg(F.min("doc").alias("first_doc"), F.first("key").alias("key"))
    texts = staged(first, "texts")

    pairs = described.select("key", F.explode("anchors").alias("anchor"))
    shared = pairs.groupBy("anchor").agg(F.min("key").alias("a"), F.max("key").alias("b"), F.count("*").alias("n"))
    shared = staged(shared.where("a < b").select("anchor", (F.col("n") > CROWD).alias("crowded")), "shared")
    held = pairs.join(shared.hint("merge"), "anchor").distinct()
    held = held.groupBy("key").agg(F.collect_list(F.struct("anchor", "crowded")).alias("found"))
    marks = F.struct("key", F.col("found.anchor").alias("anchors"), F.col("found.crowded").alias("crowded"))
    marked = texts.join(held.hint("merge"), "key").groupBy(F.col("first_doc").alias("doc"))
    marked = staged(marked.agg(F.collect_list(marks).alias("marked")), "marked")

    shape = f"place bigint, stretch string, doc {kind}, key bigint, first int"
    stretches = docs.join(marked.hint("merge"), "doc", "left").mapInPandas(_stretches(width), shape)
    distinct = stretches.groupBy("place", "stretch").agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
    ordered = distinct.repartition("place").sortWithinPartitions("place", "stretch")
    shape = f"place bigint, stretch string, offsets array<int>, owners array<{kind}>"
    occurrences = ordered.mapInPandas(_located(width), shape)
    digest = F.xxhash64("stretch").alias("digest")
    found = occurrences.select("place", digest, F.arrays_zip("offsets", "owners").alias("hits"))
    at = stretches.select("place", digest, "doc", "key", "first").join(found.hint("merge"), ["place", "digest"])
    earlier = F.filter("hits", lambda h: h["owners"] < F.col("doc"))
    starts = at.select("doc", "key", F.transform(earlier, lambda h: h["offsets"] + F.col("first")).alias("starts"))
    windows = starts.where(F.size("starts") > 0).groupBy("doc", "key").agg(F.flatten(F.collect_list("starts")).alias("first"))

    copies = described.select("doc", "digest", "n_words").join(texts.select("digest", "first_doc", "key").hint("merge"), "digest")
    copies = copies.where((F.col("doc") > F.col("first_doc")) & (F.col("n_words") >= width)).distinct()
    whole = copies.select("doc", "key", F.array(F.lit(0)).alias("first"), F.col("n_words").alias("width"))
    return windows.withColumn("width", F.lit(width)).select(whole.columns).union(whole)


def dedupe_phrases(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """The documents without words of later copies of repeated windows of ``width`` words, all columns as they were but for the
    text, and ``n_words`` before, ``n_removed``.

    Words are what stands between ASCII white space; the text becomes its kept words joined by one space. A window goes if
    its words also start in a document with a smaller id, judged on the input as it was. Repeats within one document stay.

    A missing text counts as empty. A row without an id loses nothing and owns nothing. Rows that repeat an id are one document
    with the windows of all of them: none of them is earlier than the other. Texts of fewer than ``width`` words lose nothing.
    Texts and words of any length are handled, one text at a time in a task. Columns named ``n_words`` or ``n_removed`` stay, the
    new ones get leading underscores. An empty table gives an empty table.
    """
    n_words, n_removed = fresh_name(docs, "n_words"), fresh_name(docs, "n_removed")
    kind = docs.schema[id_col].dataType.simpleString()
    # The same columns in the same order wherever texts are dealt out by id, so that one exchange serves all of them.
    texts = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    places = phrase_places(texts, kind, width)
    verdicts = places.groupBy("doc").agg(F.collect_list(F.struct("key", "first", "width")).alias("_verdicts"))
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    rest = [F.col(c).alias(f"_{i}") for i, c in enumerate(others)]
    held = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"), *rest)
    joined = held.join(verdicts.hint("merge"), "doc", "left").withColumnRenamed("text", "_text")
    fields = [f for f in joined.schema.fields if f.name not in ("_text", "_verdicts")]
    added = [T.StructField("_kept", T.StringType()), T.StructField("_n_words", T.LongType()), T.StructField("_n_removed", T.LongType())]
    cut = joined.mapInPandas(_kept(width), T.StructType(fields + added))
    back = {id_col: F.col("doc"), text_col: F.col("_kept"), **{c: F.col(f"_{i}") for i, c in enumerate(others)}}
    columns = [back[c].alias(c) for c in docs.columns]
    return cut.select(*columns, F.col("_n_words").alias(n_words), F.col("_n_removed").alias(n_removed))
