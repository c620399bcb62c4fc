"""The registered queries of the operators in this folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bitexture.llm.common import table
from bitexture.llm.conversation_repair import conversation_digests, damaged_conversations, repair_conversations
from bitexture.llm.html_extract import extract_main_text
from bitexture.llm.importance import importance_sample
from bitexture.llm.license_scan import scan_licenses
from bitexture.llm.line_dedup import dedupe_lines
from bitexture.llm.minhash_dedup import near_duplicates
from bitexture.llm.mixing import standard_mix
from bitexture.llm.phrase_dedup import dedupe_phrases
from bitexture.llm.piece_sampling import decoded, sample_pieces
from bitexture.llm.quality_rules import quality_verdicts
from bitexture.llm.spelling_groups import spelling_groups, vocabulary
from bitexture.llm.token_store import read_token_store, write_token_store
from bitexture.llm.topk_search import top_k_products, usable
from bitexture.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]

_registry: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _registry[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_registry)


@query
def op1_minhash_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(table(spark, sf, "documents"), percent=85)


@query
def op10_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every document without later copies of repeated line runs."""
    cleaned = dedupe_lines(table(spark, sf, "documents"))
    return cleaned.select("doc_id", "n_removed_lines", "text")


@query
def op6_importance_sample(spark: SparkSession, sf: str) -> DataFrame:
    return importance_sample(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op8_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality_verdicts(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op5_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return scan_licenses(table(spark, sf, "documents"))


@query
def op7_piece_sampling(spark: SparkSession, sf: str) -> DataFrame:
    """A sampled segmentation of every document, and the text that decoding it gives back."""
    sampled = sample_pieces(table(spark, sf, "documents"))
    return sampled.select("doc_id", F.size("pieces").alias("n_pieces"), "pieces", decoded("pieces").alias("text"))


@query
def op3_token_store(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "token-store")
    write_token_store(table(spark, sf, "documents"), path)
    return read_token_store(spark, path, with_ids=False).select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op2_topk_products(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors scaled to integers; every twentieth id is a query against all other rows."""
    rows = table(spark, sf, "embeddings").where(usable(F.col("embedding")))
    scaled = F.transform("embedding", lambda x: F.floor(64 * x.cast("double")))
    vectors = rows.select("vec_id", scaled.alias("vector"))
    return top_k_products(vectors, vectors.where(F.col("vec_id") % 20 == 0))


@query
def op9_mix_to_targets(spark: SparkSession, sf: str) -> DataFrame:
    return standard_mix(table(spark, sf, "documents"), budget=0.5)


@query
def op4_main_text(spark: SparkSession, sf: str) -> DataFrame:
    return extract_main_text(table(spark, sf, "pages"), keep=("url",))


@query
def op12_phrase_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every document without the words that repeat a 13-word window of an earlier one."""
    cleaned = dedupe_phrases(table(spark, sf, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


@query
def op13_spelling_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Words of all documents, some of which lose a letter by checksum, with their near words, forms and roots."""
    return spelling_groups(vocabulary(table(spark, sf, "documents"), drop_letter_every=97))


@query
def op11_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    """Every conversation after damage by checksum: its faults, the cheapest repair and a digest of the repaired lines."""
    rows = table(spark, sf, "conversations")
    found, repaired = repair_conversations(damaged_conversations(rows))
    result = rows.select("conv_id").distinct()
    for part in (found, conversation_digests(repaired)):
        part = part.withColumnRenamed("conv_id", "_id")
        result = result.join(part, F.col("conv_id").eqNullSafe(F.col("_id")), "left").drop("_id")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    empty = {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit("").cast("binary"), 256)}
    return result.select(
        "conv_id",
        *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts),
        *(F.coalesce(c, value).alias(c) for c, value in empty.items()),
    )
