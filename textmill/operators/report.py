"""Row counts and samples for a look at the data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from textmill.functions.keys import hash_key, leading_number

def row_funnel(df: DataFrame, stages: Sequence[tuple[str, Column]], split: str = "split") -> DataFrame:
    """Rows before and after each filter, per split: ``(split, stage, rows_in, rows_out)``.

    ``stages`` are ``(name, keep predicate)`` in the order they are applied. All counts come from one
    aggregate, which stays exact when a lost executor makes Spark run a task twice; counters that are
    updated on the side of a query would count such rows again.
    """
    alive = F.lit(True)
    passed: list[Column] = [F.count(F.lit(1)).alias("n0")]
    for place, (_, keep) in enumerate(stages, 1):
        alive = alive & F.coalesce(keep, F.lit(False))
        passed.append(F.count_if(alive).alias(f"n{place}"))
    counts = df.groupBy(split).agg(*passed)
    rows = F.array(
        *(
            F.struct(
                F.lit(name).alias("stage"), F.col(f"n{i}").alias("rows_in"), F.col(f"n{i + 1}").alias("rows_out")
            )
            for i, (name, _) in enumerate(stages)
        )
    )
    return counts.select(split, F.inline(rows))


def peek_sample(df: DataFrame, seed: str | int = 42, row_id: str = "_row_id", split: str = "split") -> DataFrame:
    """One random row of each split, repeatable by seed.

    The smallest sampling key of each split is an aggregate over two narrow columns that combines before its
    shuffle; a semi-join with it leaves about one row for each split, however many there are. A null
    split is a split.
    """
    key = hash_key(seed, row_id)
    number = leading_number(key)
    smallest = df.groupBy(F.col(split).alias("_drawn")).agg(F.min(number).alias("_least"))
    drawn = df.join(smallest, F.col(split).eqNullSafe(F.col("_drawn")) & (number == F.col("_least")), "left_semi")
    others = [c for c in df.columns if c != split]
    first = F.min_by(F.struct(*others), F.struct(key, row_id))
    return drawn.groupBy(split).agg(first.alias("row")).select(split, "row.*")


def split_counts(splits: Mapping[str, DataFrame] | DataFrame, split: str = "split") -> DataFrame:
    """Rows per split: ``(split, rows)``."""
    if isinstance(splits, DataFrame):
        return splits.groupBy(split).agg(F.count(F.lit(1)).alias("rows"))
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias(split), "rows")
        for name, df in splits.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
