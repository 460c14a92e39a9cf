"""Seekable store of batches (O5, O10, P12): resuming reads only the files from the resume step on.

Batches are written in ranges of ``batches_per_range`` consecutive batches of a rank, one folder a (rank, range), each range sorted by
batch and slot. A manifest holds every file's rank and its first and last batch, from the files' own statistics of one narrow pass.
A resumed epoch opens the ranges from the step's range on, later epochs open all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.order import resume_step

RANGE = 256


def write_batches(df: DataFrame, path: str, *, batches_per_range: int = RANGE, rank_col: str = "rank", batch_col: str = "batch", slot_col: str = "slot") -> DataFrame:
    """Write rows that carry their rank, batch and slot; returns the manifest ``(file, rank, first, last, rows)``.

    A range is one shuffle partition's work and at most ``batches_per_range`` batches, so no rank is one task.
    """
    spark = df.sparkSession
    path = path.rstrip("/")
    ranged = df.withColumn("range", F.floor(F.col(batch_col) / batches_per_range).cast("bigint"))
    ordered = ranged.repartition(F.col(rank_col), F.col("range")).sortWithinPartitions(rank_col, "range", batch_col, slot_col)
    ordered.write.mode("overwrite").partitionBy(rank_col, "range").parquet(f"{path}/batches")
    stored = spark.read.parquet(f"{path}/batches")
    manifest = stored.groupBy(F.col("_metadata.file_path").alias("file"), F.col(rank_col).cast("bigint").alias("rank"), F.col("range").cast("bigint").alias("range")).agg(
        F.min(batch_col).alias("first"), F.max(batch_col).alias("last"), F.count(F.lit(1)).alias("rows")
    )
    manifest.write.mode("overwrite").parquet(f"{path}/manifest")
    return spark.read.parquet(f"{path}/manifest")


def read_from(spark: SparkSession, path: str, step: int = 0, *, batch_col: str = "batch") -> DataFrame:
    """The stored rows of the batches from ``step`` on; ranges whose last batch is before it are not opened."""
    path = path.rstrip("/")
    stored = spark.read.parquet(f"{path}/batches")
    if step <= 0:
        return stored.drop("range")
    first = spark.read.parquet(f"{path}/manifest").filter(F.col("last") >= step).agg(F.min("range")).first()[0]
    if first is None:
        return stored.filter(F.lit(False)).drop("range")
    return stored.filter((F.col("range") >= first) & (F.col(batch_col) >= step)).drop("range")


def resume_epochs(spark: SparkSession, path: str, num_epochs: int, checkpoint: str | None = None, *, batch_col: str = "batch") -> DataFrame:
    """O10 + P12 from the store: epoch 0 goes on from the checkpoint's step, the others are whole."""
    step = 0 if checkpoint is None else spark.range(1).select(resume_step(checkpoint)).first()[0] or 0
    first = read_from(spark, path, step, batch_col=batch_col).withColumn("epoch", F.lit(0).cast("bigint"))
    if num_epochs <= 1:
        return first
    rest = read_from(spark, path).withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(num_epochs - 1)).cast("array<bigint>")))
    return first.unionByName(rest)
