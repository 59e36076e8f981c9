"""Objects that a Python worker makes once and keeps between tasks, and the runs of rows that it takes at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from uuid import UUID

from pyspark.ml.model_cache import ModelCache


def once_per_worker(key: UUID, factory: Callable):
    """``factory()``, called at the first task of a worker process and reused by its later tasks."""
    made = ModelCache.get(key)
    if made is None:
        made = factory()
        ModelCache.add(key, made)
    return made


def runs(rows: int, size: int, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """First row and number of rows of runs of about ``most`` bytes, of ``rows`` that have ``size`` bytes.

    What Python makes of a batch is many times its Arrow bytes, and Spark's batches grow with the input up to their bound.
    """
    step = max(1, rows * most // max(size, 1))
    for first in range(0, rows, step):
        yield first, min(step, rows - first)
