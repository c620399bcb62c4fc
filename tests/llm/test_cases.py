"""Every operator and stage with missing values, empty and long texts, ties, repeated rows, empty tables, extra columns."""

import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from bitexture.llm.html_extract import extract_main_text
from bitexture.llm.importance import importance_sample
from bitexture.llm.license_scan import scan_licenses
from bitexture.llm.line_dedup import dedupe_lines
from bitexture.llm.minhash_dedup import near_duplicates
from bitexture.llm.mixing import standard_mix, topic_of
from bitexture.llm.piece_sampling import decoded, sample_pieces
from bitexture.llm.quality_rules import quality_verdicts
from bitexture.llm.token_store import read_token_store, write_token_store
from bitexture.llm.topk_search import top_k_products

SENTENCE = "the quick brown fox jumps over the lazy dog near the river bank today"
LONG = " ".join(f"word{i} and other{i % 7}" for i in range(30_000))
# Clashing names: what the operators call their own columns.
EXTRA = ["kept", "doc", "text_a", "label", "digest", "gone", "version", "n_tokens", "best", "id", "row_hash"]
ROWS = [
    (1, SENTENCE),
    (1, SENTENCE),  # a repeated row
    (2, SENTENCE),  # a tie
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (6, "one"),
    (7, LONG),
    (None, SENTENCE),
    (None, None),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame(ROWS, "doc_id long, text string")
    return rows.select(
        "doc_id",
        "text",
        F.lit("en").alias("lang"),
        F.when(F.col("doc_id") != 2, F.lit("src1")).alias("source"),
        F.length("text").cast("long").alias("n_chars"),
        *(F.lit("x").alias(c) for c in EXTRA),
    )


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (2, None, None), (6, 0, 0), (None, 1, 0), (99, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def encoded(docs):
    return sample_pieces(docs).withColumn("text", decoded("pieces"))


OPERATORS = {
    "near_duplicates": lambda docs, labels: near_duplicates(docs),
    "dedupe_lines": lambda docs, labels: dedupe_lines(docs),
    "importance_sample": importance_sample,
    "quality_verdicts": quality_verdicts,
    "scan_licenses": lambda docs, labels: scan_licenses(docs),
    "standard_mix": lambda docs, labels: standard_mix(docs, 0.5),
    "sample_pieces": lambda docs, labels: encoded(docs),
    "extract_main_text": lambda docs, labels: extract_main_text(docs, "doc_id", "text"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_input_row(docs, labels, name):
    got = OPERATORS[name](docs, labels).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in ROWS)
    same = [r for r in got if r.doc_id == 1]
    assert same[0] == same[1]


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(docs, labels, name):
    assert OPERATORS[name](docs.limit(0), labels.limit(0)).collect() == []


def test_near_duplicates_of_odd_rows(docs):
    got = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs).collect()]
    by_id = {}
    for row in got:
        by_id.setdefault(row[0], []).append(row[1:])
    assert by_id[1] == [(10, 1, True)] * 2 and by_id[2] == [(10, 1, False)]
    assert by_id[3] == [(0, 3, True)] and by_id[5] == [(0, 5, True)]
    assert by_id[6] == [(1, 6, True)]
    assert sorted(by_id[None]) == [(0, None, False), (10, None, False)]


def test_line_dedup_keeps_columns_and_odd_rows(docs):
    long_line = SENTENCE * 4
    got = dedupe_lines(docs.withColumn("text", F.when(F.col("text") == SENTENCE, long_line).otherwise(F.col("text"))))
    assert got.columns == docs.columns + ["n_removed_lines"]
    texts = {}
    for r in got.collect():
        texts.setdefault(r.doc_id, []).append((r.text, r.n_removed_lines))
    assert texts[1] == [(long_line, 0)] * 2  # equal rows are one document
    assert texts[2] == [("", 1)]
    assert texts[3] == [(None, 0)] and texts[5] == [(" \n\t ", 0)]
    assert (long_line, 0) in texts[None]


def test_quality_rules_of_odd_rows(docs, labels):
    rows = {r.doc_id: r for r in quality_verdicts(docs, labels).collect()}
    assert (rows[3].n_words, rows[3].base_failed, rows[3].kept) == (0, True, False)
    assert (rows[6].n_words, rows[6].word_chars) == (1, 3)
    assert rows[1].n_repeat_words == 0 and rows[1].kept


def test_pieces_are_lossless_and_follow_the_key(docs):
    for row in encoded(docs).collect():
        want = [t for i, t in ROWS if i == row.doc_id]
        assert row.text in [t or "" for t in want]
    twice = [sample_pieces(docs.repartition(n)).where("doc_id = 7").first().pieces for n in (1, 5)]
    assert twice[0] == twice[1]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages(spark, docs, labels, tmp_path, name):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    stage = dict(corpus_pipeline.STAGES)[name]
    got = stage(spark, docs, str(tmp_path))
    if name != corpus_pipeline.STAGES[-1][0]:
        assert got.columns == docs.columns
    assert {r.doc_id for r in got.collect()} <= {i for i, _ in ROWS}
    assert stage(spark, docs.limit(0), str(tmp_path)).collect() == []


def test_near_dedup_stage_keeps_one_row_of_a_group(spark, docs, tmp_path):
    other = docs.where("doc_id = 7").limit(1).withColumn("text", F.lit("a text of its own under an id that is there already"))
    got = corpus_pipeline.near_dedup(spark, docs.unionByName(other), str(tmp_path))
    assert sorted((r.doc_id for r in got.collect()), key=str) == [1, 3, 4, 5, 6, 7, 7, None, None]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:4]])
def test_stages_lose_no_row_for_its_id(spark, docs, labels, tmp_path, name, monkeypatch):
    """Rows without an id, and rows that share one with other texts, are judged by their own text."""
    labels.limit(0).write.parquet(f"{tmp_path}/labels.parquet")  # without usable labels every document is kept
    monkeypatch.setattr(corpus_pipeline, "MIX_BUDGET", 1.0)
    texts = [(1, f"alpha {i} beta {i * 7} gamma {i * i} delta eps {i}") for i in range(3)] + [(None, "nobody's text, short"), (None, "another one")]
    rows = spark.createDataFrame(texts, "doc_id long, text string")
    rows = rows.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("src1").alias("source"), F.length("text").cast("long").alias("n_chars"))
    got = dict(corpus_pipeline.STAGES)[name](spark, rows, str(tmp_path)).collect()
    assert sorted((str(r.doc_id), r.text) for r in got) == sorted((str(i), t) for i, t in texts)


def test_topics_of_long_words(spark):
    """One word of a million characters is read once."""
    long = "a." * 500_000
    rows = [("mail me@site.org", "contact"), (long, "prose"), (long + "@b", "prose"), (long + "@b.c", "contact"), ("@x.y", "prose")]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    start = time.perf_counter()
    got = [r.t for r in docs.select("doc_id", topic_of(F.col("text")).alias("t")).orderBy("doc_id").collect()]
    assert got == [t for _, t in rows] and time.perf_counter() - start < 20


def test_token_store_of_odd_rows(spark, docs, tmp_path):
    write_token_store(docs, f"{tmp_path}/store")
    rows = read_token_store(spark, f"{tmp_path}/store").orderBy("place").collect()
    assert [r.doc_id for r in rows] == [None, None, 1, 1, 2, 3, 4, 5, 6, 7]
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:i]) for i in range(len(rows))]
    assert rows[5].ids == [0] and rows[6].ids == [0]
    write_token_store(docs.limit(0), f"{tmp_path}/none")
    assert read_token_store(spark, f"{tmp_path}/none").collect() == []
    wanted = spark.createDataFrame([(6,), (77,)], "doc_id long")
    (one,) = read_token_store(spark, f"{tmp_path}/store", wanted).collect()
    assert one.ids == rows[8].ids


def test_top_k_of_odd_rows(spark):
    rows = [(0, [1, 2]), (1, [3, 4]), (2, None), (3, [1, None]), (4, [3, 4]), (None, [9, 9]), (5, [7]), (1, [3, 4]), (6, [0, 0])]
    vectors = spark.createDataFrame(rows, "vec_id long, vector array<long>").withColumn("rank", F.lit("x"))
    got = top_k_products(vectors, vectors.where("vec_id in (0, 2, 5, 6)"), k=3).collect()
    found = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got)
    assert found == [(0, 1, 1, 11), (0, 2, 1, 11), (0, 3, 4, 11), (6, 1, 0, 0), (6, 2, 1, 0), (6, 3, 1, 0)]
    assert top_k_products(vectors.limit(0), vectors, k=3).collect() == []
    assert top_k_products(vectors, vectors.limit(0), k=3).collect() == []
