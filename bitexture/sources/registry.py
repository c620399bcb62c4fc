"""Named datasets: a label, else an existing path, else an error that lists the labels."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bitexture.sources.store import path_exists

Builder = Callable[[SparkSession], DataFrame]


class DatasetRegistry:
    def __init__(self) -> None:
        self._builders: dict[str, Builder] = {}

    def add(self, label: str, build: Builder) -> None:
        self._builders[label.lower()] = build

    def add_corpus(
        self, label: str, path: str, fmt: str = "parquet", config: dict[str, str] | None = None, **options: str
    ) -> None:
        """A mirrored public corpus; ``config`` picks a subset such as a language pair by column value."""

        def build(spark: SparkSession) -> DataFrame:
            df = spark.read.format(fmt).options(**options).load(path)
            for column, value in (config or {}).items():
                df = df.where(F.col(column) == value)
            return df

        self.add(label, build)

    def labels(self) -> list[str]:
        return sorted(self._builders)

    def load(self, spark: SparkSession, label_or_path: str, split: str | None = None) -> DataFrame:
        if label_or_path.lower() in self._builders:
            df = self._builders[label_or_path.lower()](spark)
        elif path_exists(spark, label_or_path):
            df = spark.read.parquet(label_or_path)
        else:
            raise ValueError(
                f"dataset {label_or_path} is neither a known label ({', '.join(self.labels())}) nor a path"
            )
        return df if split is None else df.where(F.col("split") == split)
