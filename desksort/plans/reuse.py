"""Checking that prepared data from an earlier run is all there."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.feeds import read_label_map

SPLITS = ("train", "val", "test")


class MissingOutputs(RuntimeError):
    def __init__(self, missing: list[str]):
        super().__init__(f"missing required outputs: {', '.join(missing)}")
        self.missing = missing


def _present(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
    except AnalysisException:
        return False
    return True


def prepared_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per split of earlier output; raises ``MissingOutputs`` naming every
    split and table that is not there."""
    folder = folder.rstrip("/")
    missing = [s for s in SPLITS if not _present(spark, f"{folder}/splits/split={s}")]
    try:
        read_label_map(spark, folder)
    except AnalysisException:
        missing.append("label_map")
    if missing:
        raise MissingOutputs(missing)
    return (
        spark.read.parquet(f"{folder}/splits").groupBy("split").agg(F.count("*").alias("count"))
    )
