"""Exact top-k by inner product over buckets of vectors of similar length.

Candidates are sorted by length into buckets of bounded size. Every query gets a first threshold from the bucket of the
longest vectors. For any other bucket the threshold divided by the query's length and the bucket's greatest length is the
least cosine that a useful candidate needs. Above 1 the bucket is skipped. If it is high, a few coordinates in which the
query is large bound the same coordinates of the candidates; if it is low, only the candidates long enough are taken.
What is left is verified by exact products. Queries travel in blocks to the buckets, one task holds one bucket and one
block of queries at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bitexture.llm.common import staged

K = 20
BUCKET = 8192  # candidates in a bucket at most
QUERY_BLOCK = 512
COORDINATE_COSINE = 0.75  # local thresholds from here on are pruned by coordinates, others by length
FOCUS = 4  # coordinates looked at
SLACK = 1e-9  # of rounding in bounds; products themselves are exact
EXACT = float(1 << 53)

PACK = "dim int, pack bigint, longest double, ids binary, vectors binary, dtype string"


def usable(vector: Column) -> Column:
    """Neither missing nor holding missing or non-finite components."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return vector.isNotNull() & F.forall(vector, finite)


def _packed(ids: np.ndarray, vectors: np.ndarray, pack: int, longest: float, dim: int) -> pd.DataFrame:
    small = not vectors.size or np.abs(vectors).max() < 1 << 15
    kind = "<i2" if small else "<i8"
    return pd.DataFrame(
        {
            "dim": [dim],
            "pack": [pack],
            "longest": [longest],
            "ids": [ids.astype("<i8").tobytes()],
            "vectors": [vectors.astype(kind).tobytes()],
            "dtype": [kind],
        }
    )


def _packer(size: int):
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Runs of a partition sorted by (dim, length descending) as rows of at most ``size`` vectors."""
        serial = TaskContext.get().partitionId() << 32
        held: list[pd.DataFrame] = []

        def flush():
            nonlocal serial
            rows = pd.concat(held)
            held.clear()
            serial += 1
            dim = int(rows["dim"].iloc[0])
            vectors = np.array(rows["vector"].tolist(), np.int64).reshape(len(rows), dim)
            return _packed(rows["id"].to_numpy(), vectors, serial, float(rows["length"].iloc[0]), dim)

        for batch in batches:
            for start in range(0, len(batch), size // 4):
                for dim, rows in batch.iloc[start : start + size // 4].groupby("dim", sort=False):
                    if held and (held[0]["dim"].iloc[0] != dim or sum(map(len, held)) + len(rows) > size):
                        yield flush()
                    held.append(rows)
        if held:
            yield flush()

    return pack


def _matrix(row, dim: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], "<i8")
    return ids, np.frombuffer(row["vectors"], row["dtype"]).astype(np.int64).reshape(len(ids), dim)


def products(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Exact integer products of rows: in floating point while every sum fits, else in integers of any size."""
    reach = float(np.abs(one).max(initial=0)) * float(np.abs(other).max(initial=0)) * one.shape[1]
    if reach < EXACT:
        return (one.astype(np.float64) @ other.T.astype(np.float64)).astype(np.int64)
    wide = one.astype(object) @ other.T.astype(object)
    return wide if reach >= 2.0**62 else wide.astype(np.int64)


def survivors(query: np.ndarray, length: float, threshold: float, lengths: np.ndarray, unit: np.ndarray) -> np.ndarray:
    """Candidates of a bucket, longest first, that may reach the threshold with a query."""
    longest = lengths[0]
    if threshold <= 0 or length == 0 or longest == 0:
        return np.arange(len(lengths)) if threshold <= 0 else np.empty(0, np.int64)
    cosine = threshold / (length * longest) - SLACK
    if cosine > 1:
        return np.empty(0, np.int64)
    if cosine < COORDINATE_COSINE:
        return np.arange(np.searchsorted(-lengths, -(threshold / length) * (1 - SLACK), side="right"))
    direction = query / length
    at = np.argsort(-np.abs(direction))[:FOCUS]
    middle = direction[at] * cosine
    spread = np.sqrt(max(0.0, 1 - cosine * cosine) * np.maximum(0.0, 1 - direction[at] ** 2)) + SLACK
    low = np.where(direction[at] <= -cosine, -1.0, middle - spread)  # open where the axis itself is near enough
    high = np.where(direction[at] >= cosine, 1.0, middle + spread)
    within = ((unit[:, at] >= low - SLACK) & (unit[:, at] <= high + SLACK)).all(axis=1)
    return np.flatnonzero(within)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    if len(ids) > 4 * k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= cut)
    else:
        near = np.arange(len(ids))
    return near[np.lexsort((ids[near], -scores[near]))[:k]]


def _searcher(k: int):
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                dim = row["dim"]
                q_ids, queries = _matrix({n: row[f"q_{n}"] for n in ("ids", "vectors", "dtype")}, dim)
                thresholds = np.frombuffer(row["q_thresholds"], "<f8") if row["q_thresholds"] else np.full(len(q_ids), -np.inf)
                ids, vectors = _matrix(row, dim)
                found = search_block(q_ids, queries, thresholds, ids, vectors, k)
                yield pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype(np.int64)

    return search


def search_block(q_ids, queries, thresholds, ids, vectors, k: int) -> list[tuple[int, int, int]]:
    """The best ``k`` candidates of a bucket per query, those below the query's threshold left out."""
    lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
    order = np.lexsort((ids, -lengths))
    ids, vectors, lengths = ids[order], vectors[order], lengths[order]
    unit = vectors / np.where(lengths > 0, lengths, 1)[:, None]
    q_lengths = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1))
    found = []
    for i, (q_id, threshold) in enumerate(zip(q_ids, thresholds)):
        near = survivors(queries[i], q_lengths[i], threshold, lengths, unit)
        near = near[ids[near] != q_id]
        if not len(near):
            continue
        scores = products(queries[i : i + 1], vectors[near])[0]
        reached = np.flatnonzero(scores >= threshold)
        near, scores = near[reached], scores[reached]
        best = _best(ids[near], scores, k)
        found += [(int(q_id), int(c), int(s)) for c, s in zip(ids[near][best], scores[best])]
    return found


def _first_thresholds(k: int):
    def seeded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Query blocks with each query's k-th best score in the seed bucket, where it has as many candidates."""
        for batch in batches:
            for row in batch.to_dict("records"):
                q_ids, queries = _matrix({n: row[f"q_{n}"] for n in ("ids", "vectors", "dtype")}, row["dim"])
                ids, vectors = _matrix(row, row["dim"])
                lows = np.full(len(q_ids), -np.inf)
                for i, q_id in enumerate(q_ids):
                    scores = products(queries[i : i + 1], vectors[ids != q_id])[0]
                    if len(scores) >= k:
                        lows[i] = float(np.sort(scores)[len(scores) - k]) 
                kept = {n: [row[n]] for n in ("dim", "q_pack", "q_ids", "q_vectors", "q_dtype")}
                yield pd.DataFrame(kept | {"q_thresholds": [np.nextafter(lows, -np.inf).astype("<f8").tobytes()]})

    return seeded


def top_k_products(
    vectors: DataFrame,
    queries: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "vector",
    k: int = K,
) -> DataFrame:
    """The ``k`` highest inner products of every query with all other vectors: ``query_id``, ``rank`` from 1, ``vec_id``,
    ``score``; ties go to the smaller id, fewer than ``k`` candidates give all.

    Both tables hold an id and an integer vector. Missing vectors and those with a missing component take no part, nor
    do rows without an id. A query meets only vectors of its own dimension. A vector is no candidate for a query with its
    id; other copies of it are. Rows that repeat an id are candidates of their own. Scores are exact within 64 bits. Other
    columns play no part; without queries or candidates the result is empty.
    """
    def prepared(df: DataFrame) -> DataFrame:
        whole = df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull())
        whole = whole.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<bigint>").alias("vector"))
        whole = whole.where(F.forall("vector", lambda x: x.isNotNull()))
        square = F.aggregate("vector", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x)
        return whole.select("id", "vector", F.size("vector").alias("dim"), F.sqrt(square).alias("length"))

    by_length = ["dim", F.desc("length"), "id"]
    buckets = prepared(vectors).repartitionByRange(*by_length).sortWithinPartitions(*by_length)
    buckets = staged(buckets.mapInPandas(_packer(BUCKET), PACK), "buckets")
    order = [F.pmod(F.xxhash64("id"), F.lit(1 << 20)), "id"]
    blocks = prepared(queries).repartitionByRange("dim", *order).sortWithinPartitions("dim", *order)
    blocks = blocks.mapInPandas(_packer(QUERY_BLOCK), PACK)
    blocks = staged(blocks.select("dim", *(F.col(n).alias(f"q_{n}") for n in ("pack", "ids", "vectors", "dtype"))), "blocks")

    seeds = buckets.groupBy("dim").agg(F.max(F.struct("longest", -F.col("pack"))).alias("top"), F.count("*").alias("n"))
    seeds = staged(seeds.select("dim", (-F.col("top.col2")).alias("pack")), "seeds")
    seed_buckets = staged(buckets.join(seeds, ["dim", "pack"]), "seeds")
    shape = "dim int, q_pack bigint, q_ids binary, q_vectors binary, q_dtype string, q_thresholds binary"
    aimed = blocks.join(seed_buckets.select("dim", "ids", "vectors", "dtype"), "dim")
    aimed = staged(aimed.mapInPandas(_first_thresholds(k), shape), "aimed")

    # Every block goes to every bucket of its dimension: blocks are few and small, buckets stay where they are.
    targets = buckets.select("dim", "pack")
    sent = aimed.join(targets, "dim").repartition("dim", "pack")
    met = sent.join(buckets, ["dim", "pack"])
    found = staged(met.mapInPandas(_searcher(k), "query_id bigint, vec_id bigint, score bigint"), "found")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
