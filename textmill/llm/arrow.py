"""Small helpers for functions that map Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType


def with_fields(schema: StructType, *fields: StructField) -> StructType:
    """``schema`` plus ``fields``; a new field takes the place of an old one of its name."""
    names = {f.name for f in fields}
    return StructType([f for f in schema.fields if f.name not in names] + list(fields))


def with_arrays(batch: pa.RecordBatch, names: list[str], arrays: list[pa.Array]) -> pa.RecordBatch:
    """The columns of ``batch`` that are not in ``names``, then ``arrays`` under ``names``."""
    kept = [n for n in batch.schema.names if n not in names]
    return pa.RecordBatch.from_arrays([batch.column(n) for n in kept] + arrays, kept + names)


def add_columns(df: DataFrame, fields: list[StructField], make: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]]) -> DataFrame:
    """``df`` with ``fields`` made from each Arrow batch; ``make()`` runs once per task and returns the maker."""
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = make()
        for batch in batches:
            for part in slices(batch, 1 << 20):
                yield with_arrays(part, names, columns(part))

    return df.mapInArrow(run, with_fields(df.schema, *fields))


def slices(batch: pa.RecordBatch, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``size`` bytes, so that what is made from them stays small."""
    rows = max(1, int(batch.num_rows * size / max(batch.nbytes, 1)))
    for first in range(0, batch.num_rows, rows):
        yield batch.slice(first, rows)


def free_name(name: str, df: DataFrame) -> str:
    """``name``, with underscores before it until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def texts_of(column: pa.Array) -> list[str]:
    """Python strings of a column, null as the empty string."""
    return [t or "" for t in column.to_pylist()]


def lists_of(blobs: list[bytes], kind: pa.DataType, width: int) -> pa.Array:
    """A list array from little-endian buffers of fixed-width values, one buffer for each row."""
    ends = [0]
    for blob in blobs:
        ends.append(ends[-1] + len(blob) // width)
    values = pa.Array.from_buffers(kind, ends[-1], [None, pa.py_buffer(b"".join(blobs))])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
