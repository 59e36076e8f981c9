"""Seeded sampling keys that do not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def required(row_id: str) -> Column:
    """The row id, or an error where it is null: such a row could be neither kept nor dropped for certain."""
    return F.coalesce(F.col(row_id), F.raise_error(F.lit(f"null in the row id column {row_id!r}")))


def hash_key(seed: str | int, row_id: str | Column) -> Column:
    """``md5("seed:id")``: a uniform, repeatable sort key, the same in any SQL engine."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), required(row_id) if isinstance(row_id, str) else row_id))


def leading_number(md5_hex: Column) -> Column:
    """The first 60 bits of an md5 as a BIGINT; orders rows as the hex string does, up to ties."""
    return F.conv(F.substring(md5_hex, 1, 15), 16, 10).cast("bigint")


def value_digest(column: Column, data_type) -> Column:
    """A fixed-width stand-in for a value that is grouped on.

    Text and binary shrink to their 32-byte SHA-256, so a shuffle moves 32 bytes and not the
    document; null stays null. Other types are already narrow and are used as they are.
    """
    if data_type.typeName() in ("string", "binary", "varchar", "char"):
        return F.unhex(F.sha2(column.cast("binary"), 256))
    return column
