"""Array expressions that turn id lists into fixed-length model rows.

Everything is a plain ``slice``/``concat``/``transform``, so packing adds no shuffle and no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

IGNORE = -100  # label value that a loss skips


def _int(value: int | Column) -> Column:
    return F.lit(value).cast("int") if isinstance(value, int) else value


def repeat(value: int, times: int | Column) -> Column:
    """``times`` copies of an int; none if ``times`` is negative."""
    count = _int(times)
    return F.array_repeat(F.lit(value).cast("int"), F.greatest(count, F.lit(0)))


def empty_ids() -> Column:
    return F.array().cast("array<int>")


def truncate_ids(ids: Column, length: int | None, side: str) -> Column:
    """Keep at most ``length`` ids, dropping from the ``left`` or the ``right``."""
    if length is None:
        return ids
    if side == "right":
        return F.slice(ids, 1, length)
    return F.slice(ids, F.greatest(F.size(ids) - F.lit(length - 1), F.lit(1)), length)


def pad_ids(ids: Column, length: int | Column | None, pad: int, side: str) -> Column:
    """Fill up to ``length`` with the pad id on the given side."""
    if length is None:
        return ids
    fill = repeat(pad, _int(length) - F.size(ids))
    return F.concat(fill, ids) if side == "left" else F.concat(ids, fill)


def pad_mask(ids: Column, length: int | Column | None, side: str) -> Column:
    """1 for every real id, 0 for every pad that :func:`pad_ids` adds."""
    ones = repeat(1, F.size(ids))
    if length is None:
        return ones
    zeros = repeat(0, _int(length) - F.size(ids))
    return F.concat(zeros, ones) if side == "left" else F.concat(ones, zeros)


def mask_labels(ids: Column, pad: int, prompt_length: int | Column = 0) -> Column:
    """Ids as labels: pads and the first ``prompt_length`` positions become -100."""
    prompt = _int(prompt_length)
    return F.transform(
        ids,
        lambda x, k: F.when((k < prompt) | (x == F.lit(pad)), F.lit(IGNORE)).otherwise(x),
    )


def put_front(values: Column, fill: int, count: int) -> Column:
    """``count`` copies of ``fill`` before the array."""
    return F.concat(repeat(fill, count), values)


def put_after_pads(values: Column, mask: Column, fill: int, count: int) -> Column:
    """``count`` copies of ``fill`` between the left pads and the first real position."""
    pads = F.size(mask) - F.aggregate(mask, F.lit(0), lambda total, m: total + m)
    head = F.slice(values, F.lit(1), pads)
    tail = F.slice(values, pads + 1, F.size(values))
    return F.concat(head, repeat(fill, count), tail)


def joined(ids: Column) -> Column:
    """An id array as one space-separated string."""
    return F.array_join(F.transform(ids, lambda x: x.cast("string")), " ")
