"""Preparation of rows that arrive over time.

Cleaning, templates and the length filter look at one row only, so they run on a stream as they are.
Deduplication, split sizing and sharding need the whole table and stay with the batch plans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from textmill.plans.prepare import prepare_split
from textmill.plans.settings import PrepareSettings


def prepare_stream(df: DataFrame, settings: PrepareSettings) -> DataFrame:
    """The row-local part of the preparation on a streaming DataFrame."""
    if not df.isStreaming:
        raise ValueError("prepare_stream takes a streaming DataFrame; use prepare_split for a table")
    if settings.deduplicate_columns:
        raise ValueError("deduplication needs the whole table; run it as a batch plan")
    return prepare_split(df, settings)


def write_available(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write all rows that are there as parquet, then stop; a restart continues at the checkpoint."""
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
