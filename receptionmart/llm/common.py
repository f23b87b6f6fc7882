"""Small helpers of the operators in this folder.

Shared rules: a null text counts as empty. Operators read only the columns they are told to, so further
columns, whatever their names, never clash. Each row is a document of its own, repeated or not, and row order
never matters. An empty table gives an empty result of the same schema.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize

__all__ = ["BROADCAST_ROWS", "anti_join", "bounded_batches", "materialize", "runs_of", "semi_join", "small_enough", "table", "text_batches", "text_rows"]

# Rows of an Arrow batch; texts may be long, so fewer than the default.
BATCH_ROWS = 2000
# Rows of at most 100 bytes that a broadcast may hold; more go through a shuffle.
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_enough(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows; counts no further than that."""
    return df.limit(rows + 1).count() <= rows


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Jobs that start from now on send so many rows to Python at a time; 10,000 whole texts take much memory outside the heap."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def semi_join(df: DataFrame, keys: DataFrame, column: str, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Rows of ``df`` whose ``column`` is in ``keys``, a stored frame of fixed-size values.

    Up to ``rows`` keys are broadcast, more are joined by a shuffle; the result is the same.
    """
    keys = keys.select(column).distinct()
    return df.join(F.broadcast(keys) if small_enough(keys, rows) else keys, column, "left_semi")


def text_batches(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Each batch with its texts; null is empty."""
    for batch in batches:
        for start in range(0, batch.num_rows, BATCH_ROWS):
            part = batch.slice(start, BATCH_ROWS)
            yield part, [t or "" for t in part.column(text).to_pylist()]


def text_rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    bounded_batches(df.sparkSession)
    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def anti_join(df: DataFrame, keys: DataFrame, column: str, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Rows of ``df`` whose ``column`` is null or not in ``keys``; see ``semi_join``."""
    keys = keys.select(column).distinct()
    return df.join(F.broadcast(keys) if small_enough(keys, rows) else keys, column, "left_anti")


def runs_of(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows of a sorted stream, one table for each run of equal ``keys``."""
    held: list[pa.RecordBatch] = []
    at = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_pylist() for k in keys]
        rows = list(zip(*columns))
        start = 0
        for i, row in enumerate(rows):
            if row != at:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, start, at = [], i, row
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)
