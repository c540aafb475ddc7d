"""What the operators of this subpackage share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: The code points [\x20\x09-\x0D] that part words and are stripped from line ends.
SPACES = " \t\n\x0b\x0c\r"

#: Bytes of a batch that are worked on at once (one row at least), so that a worker's memory doesn't follow the batch size.
SLICE_BYTES = 4 << 20

#: The folder that holds the package.
ROOT = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> None:
    """Python workers find the package even if the driver found it by its own path only."""
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def by_batch(fn: Callable[[pa.RecordBatch], pa.RecordBatch | None]) -> Callable:
    """``fn`` over each Arrow batch of a partition, in slices of about ``SLICE_BYTES``, for ``mapInArrow``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = max(1, batch.num_rows * SLICE_BYTES // max(1, batch.nbytes))
            for start in range(0, batch.num_rows, rows):
                out = fn(batch.slice(start, rows))
                if out is not None and out.num_rows:
                    yield out

    return run


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch, null as empty."""
    return [t or "" for t in batch.column(name).to_pylist()]
