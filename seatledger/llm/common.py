"""Reading the tables and cutting lineage in the folder the cluster shares."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..sources.workspace import workspace


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame written once to the shared folder and read back.

    What is computed from the result no longer depends on the work before it,
    nor on executors that held its shuffle files.
    """
    path = workspace(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_arrow(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` whose workers find this package.

    A cluster gets the package like any other (``--py-files``); the workers of
    a local session do not share the driver's import path and are told it.
    """
    context = df.sparkSession.sparkContext
    if context.master.startswith("local["):
        context.environment["PYTHONPATH"] = str(Path(__file__).resolve().parents[2])
    return df.mapInArrow(fn, schema)


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of rows of about ``most_bytes`` of ``column``; a longer value makes a run of its own."""
    start = size = 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()):
        if i > start and size + n > most_bytes:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if batch.num_rows > start:
        yield batch.slice(start)


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """Groups of equal ``keys`` in sorted batches, as iterators over rows.

    A group's rows are read as they are asked for; no group is held as a whole.
    """
    from itertools import groupby

    rows = (row for batch in batches for part in _short(batch) for row in part.to_pylist())
    return groupby(rows, key=lambda row: tuple(row[k] for k in keys))


def _short(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)
