"""Near-duplicate documents by b-bit MinHash.

A document is its set of distinct word shingles, 64-bit hashes in practice. Documents with the same set collapse to
one representative first, so a group of exact copies costs one row per map task whatever its size. Of each minimum the
low bits are kept and packed into longs. Bands of minima give candidates, bit counts of the packed signatures give a
similarity corrected for chance collisions, and what may reach the threshold is confirmed on full sets.

First every member of a bucket is held against the bucket's leader, which places most of a group of copies. Where
members with different labels remain, those outside the most frequent label meet all others of their cluster in blocks
of bounded size. A task compares the signatures of two blocks, tries the most similar pairs first and skips pairs that
links have joined already, so that only links leave it, never the pairs of a group.
"""

from __future__ import annotations

import math
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitexture.llm.common import MULTIPLIER, mixed, staged
from bitexture.llm.components import merge_labels

SHINGLE = 5
ROWS_PER_BAND = 4
MISS = 1e-8  # chance that a pair exactly at the threshold shares no band
BITS = 2  # kept of each minimum
HASHES = 192  # minima in a signature at least; the bands use the first of them
SIGMAS = 5  # how far below the threshold an estimate may lie, in standard errors
BLOCK = 256
EVEN_BITS = 0x5555555555555555


def bands_for(threshold: float, rows: int = ROWS_PER_BAND, miss: float = MISS) -> int:
    return math.ceil(math.log(miss) / math.log1p(-(threshold**rows)))


def shingle_set(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; the whole sequence if it is shorter; nothing without words."""
    words = (text or "").encode().lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    width = min(width, len(words))
    n = len(words) - width + 1
    shingles = np.full(n, width, np.uint64)
    for i in range(width):
        shingles = shingles * MULTIPLIER + hashes[i : i + n]
    return np.unique(mixed(shingles))


def minima(shingles: np.ndarray, factors: np.ndarray, offsets: np.ndarray, block: int = 1024) -> np.ndarray:
    """Per hash function the smallest 32-bit value; bounded memory for any set."""
    low = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), block):
        values = np.multiply.outer(shingles[start : start + block], factors)
        values += offsets
        np.minimum(low, values.min(axis=0), out=low)
    return low >> np.uint64(32)


def packed(lows: np.ndarray) -> np.ndarray:
    """The low bits of each minimum, 32 pairs of bits in a long; unused places stay 0."""
    slots = np.zeros(-(-len(lows) // 32) * 32, np.uint64)
    slots[: len(lows)] = lows & np.uint64((1 << BITS) - 1)
    shifted = slots.reshape(-1, 32) << (np.arange(32, dtype=np.uint64) * np.uint64(BITS))
    return np.bitwise_or.reduce(shifted, axis=1).view(np.int64)


def band_keys(lows: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for column in lows.reshape(bands, rows).T:
        keys = mixed(keys * MULTIPLIER + column)
    return keys.view(np.int64)


def mismatches(one: Column, other: Column, longs: int) -> Column:
    """In how many places two packed signatures differ."""
    total = F.lit(0)
    for i in range(longs):
        differ = one[i].bitwiseXOR(other[i])
        either = differ.bitwiseOR(F.shiftrightunsigned(differ, 1)).bitwiseAND(F.lit(EVEN_BITS))
        total = total + F.bit_count(either)
    return total


def estimate(differing, hashes: int):
    """Jaccard similarity from differing places, without the matches that the kept bits give by chance."""
    chance = 1 / (1 << BITS)
    return (1 - differing / hashes - chance) / (1 - chance)


def lowest_estimate(threshold: float, hashes: int) -> float:
    """An estimate that a pair at the threshold stays above, up to ``SIGMAS`` standard errors."""
    chance = 1 / (1 << BITS)
    match = chance + (1 - chance) * threshold
    return threshold - SIGMAS * math.sqrt(match * (1 - match) / hashes) / (1 - chance)


@dataclass(frozen=True)
class _Plan:
    """What two representatives need to be compared."""

    percent: int
    hashes: int
    width: int

    @property
    def lowest(self) -> float:
        return lowest_estimate(self.percent / 100, self.hashes)

    def likely(self, one: str, other: str) -> Column:
        """Whether sizes and packed signatures of two rows leave the threshold within reach."""
        n, m, s, t = f"{one}.n_shingles", f"{other}.n_shingles", f"{one}.signature", f"{other}.signature"
        similar = estimate(mismatches(F.col(s), F.col(t), -(-self.hashes // 32)), self.hashes)
        return (100 * F.least(n, m) >= self.percent * F.greatest(n, m)) & (similar >= self.lowest)

    def enough(self, one: np.ndarray, other: np.ndarray) -> bool:
        common = len(np.intersect1d(one, other, assume_unique=True))
        return 100 * common >= self.percent * (len(one) + len(other) - common)


def _signer(bands: int, rows: int, plan: _Plan):
    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        draw = np.random.default_rng(20240229)
        factors = draw.integers(0, 2**63, plan.hashes, np.uint64) * np.uint64(2) + np.uint64(1)
        offsets = draw.integers(0, 2**63, plan.hashes, np.uint64)
        for batch in batches:
            for start in range(0, len(batch), 1000):
                part = batch.iloc[start : start + 1000]
                out = []
                for doc, row, text in zip(part["doc"], part["row"], part["text"]):
                    shingles = shingle_set(text, plan.width)
                    if not len(shingles):
                        out.append((doc, row, 0, None, None, None))
                        continue
                    lows = minima(shingles, factors, offsets)
                    digest = xxhash.xxh128_digest(shingles.tobytes())
                    out.append((doc, row, len(shingles), digest, packed(lows), band_keys(lows[: bands * rows], bands, rows)))
                yield pd.DataFrame(out, columns=["doc", "row", "n_shingles", "digest", "signature", "bands"])

    return sign


def _confirmer(plan: _Plan):
    def confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        recent: OrderedDict[bytes, np.ndarray] = OrderedDict()

        def known(digest: bytes, text: str) -> np.ndarray:
            if digest not in recent:
                recent[digest] = shingle_set(text, plan.width)
                if len(recent) > 64:
                    recent.popitem(last=False)
            return recent[digest]

        for batch in batches:
            rows = zip(batch["a"], batch["b"], batch["text_a"], batch["text_b"])
            linked = [plan.enough(known(a, text_a), known(b, text_b)) for a, b, text_a, text_b in rows]
            yield batch.loc[linked, ["a", "b"]]

    return confirm


def _leader_links(members: DataFrame, texts: DataFrame, plan: _Plan) -> DataFrame:
    """Links (a, b) between the members of a bucket and its leader, the one with the smallest digest."""
    leaders = members.groupBy("key").agg(F.min(F.struct("digest", "n_shingles", "signature")).alias("l"))
    leaders = staged(leaders.select("key", "l.*"), "leaders")
    joined = members.alias("m").join(
        leaders.alias("l"), (F.col("m.key") == F.col("l.key")) & F.expr("m.digest > l.digest") & plan.likely("m", "l")
    )
    pairs = staged(joined.select(F.col("l.digest").alias("a"), F.col("m.digest").alias("b")).distinct(), "pairs")
    for end in ("a", "b"):
        side = texts.select(F.col("digest").alias(end), F.col("text").alias(f"text_{end}"))
        pairs = pairs.join(side.hint("merge"), end)
    return staged(pairs.mapInPandas(_confirmer(plan), "a binary, b binary"), "links")


def _block_comparer(plan: _Plan):
    def compare(block: pd.DataFrame) -> pd.DataFrame:
        """Links that join different labels, between the odd members and the others of a block."""
        odd, rest = block[block["odd"]], block[~block["odd"]]
        texts = dict(zip(block["digest"], block["text"]))
        sets: dict[bytes, np.ndarray] = {}
        root: dict[bytes, bytes] = {}

        def label(x: bytes) -> bytes:
            while x in root:
                x = root[x]
            return x

        def known(digest: bytes) -> np.ndarray:
            if digest not in sets:
                sets[digest] = shingle_set(texts[digest], plan.width)
            return sets[digest]

        one, other = (np.array(x["signature"].tolist(), np.int64).view(np.uint64).reshape(len(x), -1) for x in (odd, rest))
        sizes, others = odd["n_shingles"].to_numpy()[:, None], rest["n_shingles"].to_numpy()[None, :]
        similar = np.zeros((len(odd), len(rest)), np.int64)
        for i in range(one.shape[1]):
            differ = one[:, i][:, None] ^ other[:, i][None, :]
            similar += np.bitwise_count((differ | differ >> np.uint64(1)) & np.uint64(EVEN_BITS))
        similar = estimate(similar, plan.hashes)
        fits = 100 * np.minimum(sizes, others) >= plan.percent * np.maximum(sizes, others)
        i, j = np.nonzero(fits & (similar >= plan.lowest))
        names, labels = odd["digest"].tolist(), odd["label"].tolist()
        mates, mate_labels = rest["digest"].tolist(), rest["label"].tolist()
        links = []
        for at in np.argsort(-similar[i, j], kind="stable"):
            x, y = i[at], j[at]
            a, b = label(labels[x]), label(mate_labels[y])
            if a != b and plan.enough(known(names[x]), known(mates[y])):
                root[max(a, b)] = min(a, b)
                links.append((names[x], mates[y]))
        return pd.DataFrame(links, columns=["a", "b"])

    return compare


def _block_links(members: DataFrame, labels: DataFrame, texts: DataFrame, plan: _Plan) -> DataFrame:
    """Links between members of buckets that still hold different labels, found block by block inside tasks.

    Buckets with common members form a cluster. Its members outside the most frequent label are the odd ones; blocks
    of odd members meet blocks of all members. Only links leave a task, at most one per label it joins.
    """
    label = labels.withColumnRenamed("node", "digest")
    now = members.select("key", "digest").join(label, "digest", "left")
    now = staged(now.select("key", "digest", F.coalesce("label", "digest").alias("label")), "members")
    spread = now.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.min("digest").alias("first"), F.count("*").alias("n"))
    undecided = staged(spread.where("lo != hi and n > 2").select("key", "first"), "undecided")
    if undecided.isEmpty():
        return undecided.select(F.col("first").alias("a"), F.col("first").alias("b"))
    within = staged(now.join(undecided, "key"), "undecided")
    nobody = labels.limit(0)
    clusters = merge_labels(nobody, within.where("digest != first").select(F.col("digest").alias("a"), F.col("first").alias("b")).distinct())
    placed = within.select("digest", "label").distinct().join(clusters.select(F.col("node").alias("digest"), F.col("label").alias("cluster")), "digest")
    placed = staged(placed, "placed")
    sizes = placed.groupBy("cluster", "label").agg(F.count("*").alias("n")).groupBy("cluster")
    sizes = sizes.agg(F.sum("n").alias("all"), F.max(F.struct("n", "label")).alias("most"))
    sizes = staged(sizes.select("cluster", "all", F.expr("all - most.n").alias("odd"), F.expr("most.label").alias("main")), "clusters")
    sized = placed.join(sizes, "cluster").withColumns(
        {
            "odd_blocks": F.ceil(F.col("odd") / BLOCK).cast("int"),
            "all_blocks": F.ceil(F.col("all") / BLOCK).cast("int"),
            "is_odd": F.col("label") != F.col("main"),
        }
    )
    sized = sized.select("cluster", "digest", "label", "is_odd", "odd_blocks", "all_blocks").where("odd_blocks > 0")
    facts = members.select("digest", "n_shingles", "signature").distinct()
    sized = staged(sized.join(facts, "digest").join(texts.hint("merge"), "digest"), "sized")
    place = lambda n, seed: F.pmod(F.xxhash64(F.lit(seed), "digest"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["cluster", "digest", "label", "n_shingles", "signature", "text"]
    odd = sized.where("is_odd").select(*columns, F.lit(True).alias("odd"), place("odd_blocks", 1).alias("row"), every("all_blocks").alias("column"))
    rest = sized.select(*columns, F.lit(False).alias("odd"), every("odd_blocks").alias("row"), place("all_blocks", 2).alias("column"))
    blocks = odd.union(rest).groupBy("cluster", "row", "column")
    return staged(blocks.applyInPandas(_block_comparer(plan), "a binary, b binary"), "links")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = 80,
    width: int = SHINGLE,
    rows: int = ROWS_PER_BAND,
    row_col: str | None = None,
) -> DataFrame:
    """One row per input row: id, ``n_shingles``, ``component_id``, ``kept``.

    With ``row_col``, the name of a column of whole numbers without missing ones, also that column as it was, and ``group_key``,
    which tells the groups of texts apart (missing without shingles).

    Two documents are linked if ``100 * common >= percent * union`` of their shingle sets. ``component_id`` is the
    smallest id that links reach, and ``kept`` marks the document with that id.

    Texts of any length are read whole. A missing or blank text has an empty set, no links and its own component. A row without an id links with nothing,
    has no component and is not kept. Rows that repeat an id are each linked by their own text, and the row or rows
    with the smallest id of a group are kept. Other columns play no part. An empty table gives an empty table.
    """
    bands = bands_for(percent / 100, rows)
    plan = _Plan(percent, max(HASHES, bands * rows), width)
    kind = docs.schema[id_col].dataType.simpleString()
    row = F.lit(0).cast("bigint") if row_col is None else F.col(row_col)
    texts = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    shape = f"doc {kind}, row bigint, n_shingles bigint, digest binary, signature array<bigint>, bands array<bigint>"
    marked = docs.select(F.col(id_col).alias("doc"), row.alias("row"), F.col(text_col).alias("text"))
    signed = staged(marked.mapInPandas(_signer(bands, rows, plan), shape), "signed")

    first = F.min(F.struct("doc", "n_shingles", "signature", "bands")).alias("first")
    reps = signed.where("doc is not null and digest is not null").groupBy("digest").agg(first)
    reps = staged(reps.select("digest", "first.*"), "representatives")
    banded = reps.select(F.explode("bands").alias("key"), "digest")
    shared = staged(banded.groupBy("key").count().where("count > 1").select("key"), "shared")
    members = staged(banded.join(shared, "key"), "members")  # most keys occur once: signatures follow only now
    members = staged(members.join(reps.select("digest", "n_shingles", "signature"), "digest"), "members")

    wanted = reps.join(members.select("digest").distinct(), "digest", "left_semi").select("doc", "digest")
    wanted = staged(wanted, "wanted")
    own = staged(texts.join(wanted.hint("merge"), "doc"), "texts")
    if own.select("doc").count() > wanted.count():  # ids repeat with other texts: keep the text of the digest
        own = own.mapInPandas(_right_texts(width), own.schema)
    own = own.select("digest", "text")
    labels = texts.sparkSession.createDataFrame([], "node binary, label binary")
    for find in (lambda: _leader_links(members, own, plan), lambda: _block_links(members, labels, own, plan)):
        links = find()
        if not links.isEmpty():
            labels = merge_labels(labels, links)

    labelled = reps.select("digest", "doc").join(labels.withColumnRenamed("node", "digest"), "digest", "left")
    labelled = staged(labelled.select("digest", "doc", F.coalesce("label", "digest").alias("label")), "labelled")
    smallest = staged(labelled.groupBy("label").agg(F.min("doc").alias("component")), "smallest")
    component = staged(labelled.join(smallest, "label").select("digest", "label", "component"), "component")
    found = signed.select("doc", "row", "n_shingles", "digest").join(component, "digest", "left")
    found = found.select("doc", "row", "n_shingles", F.coalesce("label", "digest").alias("group_key"), F.when(F.col("doc").isNotNull(), F.coalesce("component", "doc")).alias("c"))
    return found.select(
        F.col("doc").alias(id_col),
        "n_shingles",
        F.col("c").alias("component_id"),
        F.coalesce(F.col("doc") == F.col("c"), F.lit(False)).alias("kept"),
        *([F.col("row").alias(row_col), "group_key"] if row_col else []),
    )


def _right_texts(width: int):
    def right(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            digests = [xxhash.xxh128_digest(shingle_set(text, width).tobytes()) for text in batch["text"]]
            yield batch[[a == b for a, b in zip(digests, batch["digest"])]]

    return right
