"""Session and scratch-space helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from operator import and_
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app_name: str = "desksort", **conf: object) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``.

    Only a local master may go without one; it then gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="desksort-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write a frame that several later steps read, and read it back.

    Written to reliable storage, so a lost executor costs a re-read and not
    the frame's whole lineage; written as Parquet, so each later step reads
    only the columns it names, and packed closer than usual, as it is mostly text.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "stage")
    df.write.parquet(path, compression="zstd")
    drop_at_end(spark, path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame) -> Iterator[DataFrame]:
    """``materialize`` for steps inside the block only: the stage goes after it, so
    that a job's stages do not all lie on the disk at once."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "stage")
    df.write.parquet(path, compression="zstd")
    drop_at_end(spark, path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def drop_at_end(spark: SparkSession, path: str) -> None:
    """Have the driver remove a stage when it ends."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)


def joined(
    rows: DataFrame, table: DataFrame, keys: list[str], how: str = "inner", few: int = 50_000, salts: int = 32
) -> DataFrame:
    """``rows`` beside the row of ``table`` with equal keys (null equals null).

    A table counted to have ``few`` rows at most is broadcast. A larger one is
    repeated ``salts`` times and ``rows`` are dealt out among the copies, so that
    a key with many rows is met in as many tasks.
    """
    if table.count() <= few:
        left, right, on = rows, F.broadcast(table), list(keys)
    else:
        left = rows.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
        right = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        on = [*keys, "_salt"]
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"t.{k}")) for k in on]
    others = [F.col(f"t.{c}") for c in table.columns if c not in keys]
    return left.alias("r").join(right.alias("t"), reduce(and_, same) if same else F.lit(True), how).select(
        *[F.col(f"r.{c}") for c in rows.columns], *others
    )


_shipped: WeakKeyDictionary = WeakKeyDictionary()


def ship_package(spark: SparkSession, folder: str = os.path.dirname(os.path.abspath(__file__))) -> None:
    """Have the executors' Python import this package, or another by its folder,
    as the driver does. Sent once per Spark context, as a zip of its sources."""
    done = _shipped.setdefault(spark.sparkContext, set())
    if folder in done:
        return
    name = os.path.basename(folder)
    path = os.path.join(os.path.realpath(tempfile.mkdtemp()), f"{name}-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for top, _, files in os.walk(folder):
            for file in files:
                if file.endswith(".py"):
                    whole = os.path.join(top, file)
                    archive.write(whole, os.path.join(name, os.path.relpath(whole, folder)))
    spark.sparkContext.addPyFile(path)
    done.add(folder)
