"""Deduplication by columns in turn."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from textmill.functions.keys import required, value_digest


def dedup_seq(df: DataFrame, columns: Sequence[str], row_id: str = "_row_id") -> DataFrame:
    """For each column in turn keep the first row of each value; the next column sees the survivors.

    Null is one value; a null row id is an error. The decision is made on a narrow table of row ids and value digests: one
    aggregate per column, with map-side combine, so a value that fills a third of the table costs one
    row per task. The full rows then cross one shuffle, in a semi-join on the unique row id.
    """
    if not columns:
        return df
    names = [f"d{i}" for i in range(len(columns))]
    narrow = df.select(
        required(row_id).alias("id"),
        *(value_digest(F.col(f"`{c}`"), df.schema[c].dataType).alias(n) for c, n in zip(columns, names)),
    )
    for place, name in enumerate(names):
        later = names[place + 1 :]
        if later:
            first = F.min(F.struct("id", *later)).alias("first")
            narrow = narrow.groupBy(name).agg(first).select("first.*")
        else:
            narrow = narrow.groupBy(name).agg(F.min("id").alias("id"))
    kept = narrow.select(F.col("id").alias(row_id))
    return df.join(kept, row_id, "left_semi")
