"""Datasets on shared storage: splits, build-if-missing, predictions, scores, token cache."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from datetime import datetime
from pathlib import PurePosixPath

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

RUN_KEYS = ["experiment", "run_id", "dataset"]
PREDICTION_COLUMNS = ["inputs", "outputs", "predictions"]


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path``."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    listing = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(jvm_path)
    return sorted(s.getPath().getName() for s in listing if s.isDirectory())


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a dataset was written to the end; a job that died half-way leaves no success marker."""
    return path_exists(spark, f"{path}/_SUCCESS")


def save_splits(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).partitionBy("split").parquet(path)


def load_dataset(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """A saved dataset; asking for one split prunes the others' folders."""
    df = spark.read.parquet(path)
    return df if split is None else df.where(F.col("split") == split)


def written(df: DataFrame, path: str) -> DataFrame:
    """The same rows read back from ``path``, for inputs that several passes would compute again."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


def build_if_missing(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    if not is_complete(spark, path):
        df = build()
        writer = df.write.mode("overwrite")
        (writer.partitionBy("split") if "split" in df.columns else writer).parquet(path)
    return spark.read.parquet(path)


def run_id(moment: datetime) -> str:
    return moment.strftime("%Y-%m-%d-%H-%M-%S")


def align_predictions(examples: DataFrame, predictions: DataFrame) -> DataFrame:
    """Inputs, outputs and predictions of the examples that have all three, matched by id."""
    return examples.join(predictions.select("dataset", "example_id", "predictions"), ["dataset", "example_id"])


def _replacing(df: DataFrame, keys: list[str]) -> DataFrameWriter:
    """A writer that replaces the folders of the keys in ``df`` and leaves all others."""
    return df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys)


def save_predictions(predictions: DataFrame, path: str, experiment: str, run: str) -> None:
    """Predictions of one run; saving a run again replaces what it had for the same datasets."""
    named = (
        predictions.select("dataset", "example_id", *PREDICTION_COLUMNS)
        .withColumns({"experiment": F.lit(experiment), "run_id": F.lit(run)})
    )
    _replacing(named, RUN_KEYS).parquet(path)


def read_predictions(
    spark: SparkSession,
    path: str,
    experiment: str | None = None,
    run: str | None = None,
    dataset: str | None = None,
    *,
    null_as_nan_text: bool = False,
) -> DataFrame:
    """Prediction table with all three columns as text. NULL becomes empty text.

    ``null_as_nan_text`` turns missing and empty cells into the text ``nan``, as a spreadsheet round trip does.
    """
    # Partition values stay text even when they look like numbers or dates.
    schema = (
        "example_id bigint, inputs string, outputs string, predictions string, "
        "experiment string, run_id string, dataset string"
    )
    df = spark.read.schema(schema).parquet(path)
    for column, value in (("experiment", experiment), ("run_id", run), ("dataset", dataset)):
        if value is not None:
            df = df.where(F.col(column) == value)

    def text(column: str) -> Column:
        cell = F.coalesce(F.col(column).cast("string"), F.lit(""))
        return F.when(cell == "", "nan").otherwise(cell) if null_as_nan_text else cell

    return df.withColumns({c: text(c) for c in PREDICTION_COLUMNS})


def score_documents(scores: DataFrame) -> DataFrame:
    """One row per experiment, run and dataset with a map of its scores, metric names in order."""
    entries = F.array_sort(F.collect_list(F.struct("metric", "score")))
    return scores.groupBy(*RUN_KEYS).agg(F.map_from_entries(entries).alias("scores"))


def save_scores(scores: DataFrame, path: str) -> None:
    """One document per run and dataset; saving a run again replaces its document."""
    _replacing(score_documents(scores), RUN_KEYS).json(path)


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    schema = "scores map<string,double>, experiment string, run_id string, dataset string"
    documents = spark.read.schema(schema).json(path)
    return documents.select(*RUN_KEYS, F.explode("scores").alias("metric", "score"))


def cache_label(
    model: str,
    dataset: str,
    split: str,
    max_length: int,
    tokenizer: bytes | None = None,
    pad_id: int = 0,
    special: bool = True,
) -> str:
    """Folder name of cached token rows: everything that makes them other rows.

    A tokenizer file counts by its content, ``tokenizer``, and dataset and model by their whole names.
    """
    names = [PurePosixPath(part).name for part in (model, dataset)]
    identity = "codepoints" if tokenizer is None else hashlib.sha256(tokenizer).hexdigest()
    facts = "|".join([model, dataset, split, str(max_length), identity, str(pad_id), str(special)])
    return "_".join(["tokenized", *names, split, str(max_length), hashlib.sha256(facts.encode()).hexdigest()[:16]])


def fingerprint(df: DataFrame) -> dict[str, int]:
    """Count, sum and exclusive or of the row hashes: equal for equal rows in any order, from one pass."""
    h = F.xxhash64(*df.columns)
    row = df.agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum(F.pmod(h, F.lit(1 << 31))), F.lit(0)).alias("total"),
        F.coalesce(F.bit_xor(h), F.lit(0)).alias("mixed"),
    ).first()
    return row.asDict()


def _manifest(spark: SparkSession, path: str) -> dict[str, dict[str, int]]:
    """What a cache was made from and holds; nothing if that was never written."""
    if not is_complete(spark, path):
        return {}
    rows = spark.read.schema("part string, n bigint, total bigint, mixed bigint").parquet(path).collect()  # two rows
    return {r.part: {"n": r.n, "total": r.total, "mixed": r.mixed} for r in rows}


def _write_manifest(spark: SparkSession, path: str, parts: dict[str, dict[str, int]]) -> None:
    rows = [(part, *(facts[k] for k in ("n", "total", "mixed"))) for part, facts in parts.items()]
    manifest = spark.createDataFrame(rows, "part string, n bigint, total bigint, mixed bigint")
    manifest.coalesce(1).write.mode("overwrite").parquet(path)


def _cached_facts(spark: SparkSession, path: str) -> dict[str, int] | None:
    """Fingerprint of a complete dataset, or None if it cannot be read to its last row."""
    if not is_complete(spark, path):
        return None
    try:
        return fingerprint(spark.read.parquet(path))
    except (PySparkException, Py4JJavaError):
        return None


def token_cache(
    spark: SparkSession, folder: str, label: str | None, tokenize: Callable[[], DataFrame], source: DataFrame | None = None
) -> DataFrame:
    """Cached token rows (ids and mask only); no label, no cache.

    They are tokenized and saved when there are none, when they are not the rows that were saved (a lost, cut or changed
    file), or when ``source``, the rows they come from, is not what it was. A manifest beside the rows has the
    fingerprints of both; it is written last, so a job that dies half-way leaves none that fits.
    """
    if not label:
        return tokenize()
    path, manifest = f"{folder}/{label}", f"{folder}/manifests/{label}"
    facts = {} if source is None else {"source": fingerprint(source)}
    known = _manifest(spark, manifest)
    fits = known.get("source") == facts.get("source") and known.get("rows") is not None
    if not (fits and known["rows"] == _cached_facts(spark, path)):
        tokenize().drop("labels").write.mode("overwrite").parquet(path)
        _write_manifest(spark, manifest, {**facts, "rows": fingerprint(spark.read.parquet(path))})
    return spark.read.parquet(path)
