"""Session helpers: settings that results depend on, and lineage cuts on shared storage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

from .errors import require

ROWS_PER_BLOCK = "spark.contractflow.rowsPerBlock"
DEFAULT_ROWS_PER_BLOCK = 4_000_000


def rows_per_block(spark: SparkSession, given: int | None = None) -> int:
    """Largest number of one key's rows that a single task may order."""
    return int(given or spark.conf.get(ROWS_PER_BLOCK, str(DEFAULT_ROWS_PER_BLOCK)))


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, which every executor can reach."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            require(
                context.master.startswith("local"),
                "Set spark.checkpoint.dir to a folder that every executor can reach",
            )
            folder = tempfile.mkdtemp(prefix="run-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def checkpoint(frame: DataFrame) -> DataFrame:
    """Write a frame to the session's shared checkpoint folder and read it back."""
    shared_folder(frame.sparkSession)
    return frame.checkpoint()
