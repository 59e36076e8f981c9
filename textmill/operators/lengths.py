"""Length filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from textmill.functions.text import token_count


def within_limits(
    columns: list[str],
    input_limit: int = 512,
    target_limit: int = 30,
    n_special: int = 1,
    length=token_count,
) -> Column:
    """True where ``input`` and, if the table has it, ``target`` are within their token limits.

    ``length`` maps a text column to a token count, such as :func:`textmill.operators.vocab.token_lengths`
    of a user tokenizer; ``n_special`` is added for the special tokens of the default one.
    """
    keep = length(F.col("input")) + n_special <= input_limit
    if "target" in columns:
        keep = keep & (length(F.col("target")) + n_special <= target_limit)
    return keep


def filter_long(
    df: DataFrame,
    input_limit: int = 512,
    target_limit: int = 30,
    n_special: int = 1,
    length=token_count,
) -> DataFrame:
    """Keep rows within the token limits; row-local."""
    return df.filter(within_limits(df.columns, input_limit, target_limit, n_special, length))
