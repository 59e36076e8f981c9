"""Epoch order, shards over ranks, and batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from textmill.operators.ranks import number_by_hash, number_by_id


def epoch_order(
    df: DataFrame, *, seed: str | int = 42, epoch: int = 0, shuffle: bool = True, row_id: str = "_row_id"
) -> DataFrame:
    """Add ``idx``, the place of a row in the epoch (0..), and ``n_rows``, the rows of the table.

    Shuffled order sorts by a seeded key, so it is the same on any cluster and differs by epoch; it is
    one shuffle and no job. Row order cuts ``row_id``, a whole number, into ranges by histograms and
    numbers rows inside them: one shuffle, and nothing is written.
    """
    if shuffle:
        return number_by_hash(df, f"{seed}:{epoch}", row_id, "idx", "n_rows")
    return number_by_id(df, row_id, "idx", "n_rows")


def shard_rows(df: DataFrame, world: int, *, pad: str = "none") -> DataFrame:
    """Deal rows to ``world`` ranks: add ``rank``, ``pos`` (the place inside the rank) and ``rank_rows``.

    ``pad="wrap"`` repeats rows from the front until every rank has the same number, as a training
    loop over ranks expects; ``"none"`` keeps each row once. Row-local in both cases.
    """
    if world < 1:
        raise ValueError("world must be at least 1")
    if pad not in ("none", "wrap"):
        raise ValueError(f"unknown pad {pad!r}")
    share = F.call_function("div", F.col("n_rows") + (world - 1), F.lit(world))
    if pad == "wrap":
        turns = F.sequence(F.col("idx"), share * world - 1, F.col("n_rows"))
        df = df.withColumn("_turn", F.explode(turns))
    else:
        df = df.withColumn("_turn", F.col("idx"))
    rank = F.pmod(F.col("_turn"), F.lit(world)).cast("int")
    pos = F.call_function("div", F.col("_turn"), F.lit(world))
    if pad == "none":
        share = F.call_function("div", F.col("n_rows") - rank + (world - 1), F.lit(world))
    return df.withColumns({"rank": rank, "pos": pos, "rank_rows": share}).drop("_turn")


def effective_batch_size(batch_size: int, ranks: int, strategy: str = "") -> int:
    """Rows per step over all ranks when the strategy is data-parallel."""
    return batch_size * max(1, ranks) if "dp" in strategy else batch_size


def batch_rows(df: DataFrame, batch_size: int = 8) -> DataFrame:
    """Add ``batch_id`` and ``n_batches`` of the rank: ``batch_size`` rows each, the last kept short."""
    size = F.lit(batch_size)
    return df.withColumns(
        {
            "batch_id": F.call_function("div", F.col("pos"), size),
            "n_batches": F.call_function("div", F.col("rank_rows") + (batch_size - 1), size),
        }
    )


def limit_batches(df: DataFrame, k: int | float | None) -> DataFrame:
    """Only the first ``k`` batches of each rank, or the share ``k`` of them if it is a float."""
    if k is None:
        return df
    if isinstance(k, float):
        if not 0.0 <= k <= 1.0:
            raise ValueError("a share of batches must be between 0.0 and 1.0")
        return df.filter(F.col("batch_id") < F.floor(F.col("n_batches") * F.lit(k)))
    return df.filter(F.col("batch_id") < k)


def lay_out(df: DataFrame, chunk_rows: int = 100_000, batch_size: int = 1) -> DataFrame:
    """Bring neighbouring rows of a rank together, ``chunk_rows`` per group, for an ordered write.

    With the loader's ``batch_size`` a group holds whole batches only.

    Run it while rows are still text: encoding and packing follow without another shuffle. Chunks are
    cut from the positions, so they are even and no pass over the data is needed to find bounds.
    """
    chunk_rows = max(1, chunk_rows // batch_size) * batch_size
    return df.repartition(F.col("rank"), F.call_function("div", F.col("pos"), F.lit(chunk_rows)))


def collate(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per batch with each column stacked in order. A group is a batch, so it is never large."""
    rows = F.array_sort(F.collect_list(F.struct("pos", *columns)))
    stacked = df.groupBy("rank", "batch_id").agg(rows.alias("_rows"))
    return stacked.select(
        "rank",
        "batch_id",
        F.size("_rows").alias("n_rows"),
        *(F.col(f"_rows.{c}").alias(c) for c in columns),
    )
