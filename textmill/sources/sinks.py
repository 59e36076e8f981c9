"""Writers for model rows, predictions and metrics. Every write is a plain distributed DataFrame write."""

from __future__ import annotations

from pyspark.sql import DataFrame

from textmill.operators.shard import lay_out


def write_model_rows(df: DataFrame, path: str, *, mode: str = "errorifexists") -> str:
    """Packed rows as parquet, one folder per rank, each file in the order of its positions.

    The sort is within partitions; with :func:`textmill.operators.shard.lay_out` before encoding, a
    chunk of a rank is one file and a reader can stream it.
    """
    df.sortWithinPartitions("rank", "pos").write.mode(mode).partitionBy("rank").parquet(path)
    return path


def write_predictions(
    df: DataFrame,
    path: str,
    *,
    by_rank: bool = False,
    format: str = "json",
    mode: str = "errorifexists",
) -> str:
    """Prediction rows as JSON lines or parquet; ``by_rank`` makes one folder per rank.

    Rows with a ``pos`` are brought together by rank and written in order, so a rank gets few files and
    not one from every task; the model's output is then in shuffle files should the write be retried.
    A non-empty target is an error unless ``mode`` says otherwise; nothing is cleared silently.
    Nulls are written out in JSON, so every row keeps its columns.
    """
    if by_rank and {"rank", "pos"} <= set(df.columns):
        df = lay_out(df).sortWithinPartitions("rank", "pos")
    writer = df.write.mode(mode).format(format)
    if format == "json":
        writer = writer.option("ignoreNullFields", False)
    if by_rank:
        if "rank" not in df.columns:
            raise ValueError("by_rank needs a `rank` column; see shard_rows")
        writer = writer.partitionBy("rank")
    writer.save(path)
    return path


def write_metrics(df: DataFrame, path: str, *, mode: str = "errorifexists") -> str:
    """The metric table (a few rows per metric) as one JSON file."""
    df.select("metric", "field", "value").coalesce(1).write.mode(mode).json(path)
    return path
