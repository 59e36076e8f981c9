"""Whole-number vectors in packed blocks, and groups of queries that meet all blocks in strips."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from textmill.llm.arrow import slices
from textmill.sources.staging import stage

LARGEST = 1 << 26  # components saturate here, so that products of 2,048 of them fit 64 bits
BLOCK_ROWS = 4096
STRIP_BLOCKS = 64

BLOCK = StructType([StructField("dims", IntegerType()), StructField("block", LongType())] + [StructField(n, BinaryType()) for n in ("ids", "labels", "vectors", "more")])


def whole_rows(df: DataFrame, row_id: str, vector: str, label: str | None = None, scale: int = 256) -> DataFrame:
    """``id, label, vector, dims``: components as ``floor(scale * x)``, one row for each id.

    Rows whose id is null, whose label is null if one is named, or whose vector is null, empty or
    holds a null or non-finite component take no part. Of several rows of one id, that with the
    least label and vector counts.
    """
    x = F.col(vector)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    known = F.lit(True) if label is None else F.col(label).isNotNull()
    some = df.filter(F.col(row_id).isNotNull() & known & x.isNotNull() & (F.size(x) > 0) & finite)
    bound = F.lit(float(LARGEST))
    component = lambda c: F.greatest(-bound, F.least(bound, F.floor(c.cast("double") * scale).cast("double"))).cast("int")
    labels = F.lit(0) if label is None else F.col(label)
    one = F.min(F.struct(labels.cast("long").alias("label"), F.transform(x, component).alias("vector"))).alias("one")
    rows = some.groupBy(F.col(row_id).cast("long").alias("id")).agg(one)
    return rows.select("id", "one.label", "one.vector", F.size("one.vector").alias("dims"))


def packed(rows: DataFrame, size: int, more: Callable[[np.ndarray], bytes] | None = None, parts: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` in blocks of at most ``size`` of one dimension, as they lie in their partitions; written once.

    Rows for which the columns in ``parts`` differ are in different blocks. ``more`` makes a further
    column from a block's matrix of vectors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, key = TaskContext.get().partitionId() << 32, [], None

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal number, held
            if held:
                ids, labels, vectors = (np.concatenate(c) for c in zip(*held))
                matrix = vectors.reshape(len(ids), -1)
                values = [[matrix.shape[1]], [number], [ids.tobytes()], [labels.tobytes()], [vectors.tobytes()], [more(matrix) if more else None]]
                yield pa.record_batch([pa.array(v, t) for v, t in zip(values, (pa.int32(), pa.int64(), *[pa.binary()] * 4))], names=BLOCK.names)
                number, held = number + 1, []

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("dims", *parts)], axis=1)
            turns = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)])).tolist()
            for first, stop in zip(turns, [*turns[1:], len(keys)]):
                if key is not None and (keys[first] != key).any():
                    yield from close()
                key = keys[first]
                while first < stop:
                    room = size - sum(len(h[0]) for h in held)
                    part = batch.slice(first, min(room, stop - first))
                    held.append(tuple(c.to_numpy() for c in (part.column("id"), part.column("label"), part.column("vector").flatten())))
                    first += part.num_rows
                    if part.num_rows == room:
                        yield from close()
        yield from close()

    names = ["id", "label", "vector", "dims", *parts]
    return stage(rows.select(*names).mapInArrow(run, BLOCK), "blocks")


def dealt(groups: DataFrame, blocks: DataFrame) -> DataFrame:
    """Groups of queries and blocks as ``group, strip, kind, ...``: in a strip a group stands before its blocks.

    Every group meets every block of its dimension once. A strip holds about ``STRIP_BLOCKS`` blocks, or
    fewer if there would be too few tasks; the group's own columns travel once for each strip.
    """
    spark = blocks.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_groups, n_blocks = groups.count(), blocks.count()
    strips = max(1, -(-n_blocks // STRIP_BLOCKS), min(n_blocks, -(-2 * tasks // max(1, n_groups))))
    every = groups.select("dims", F.col("block").alias("group"), F.explode(F.sequence(F.lit(0), F.lit(strips - 1))).alias("strip"))
    asking = groups.withColumnRenamed("block", "group").join(every.drop("dims"), "group").withColumns({"kind": F.lit(0), "block": F.lit(-1).cast("long")})
    placed = blocks.withColumn("strip", F.pmod(F.xxhash64("block"), F.lit(strips)).cast("int"))
    met = placed.join(every, ["dims", "strip"]).withColumn("kind", F.lit(1))
    columns = ["group", "strip", "kind", *BLOCK.names]
    own = [c for c in asking.columns if c not in columns]  # what only the groups have
    both = asking.select(columns + own).unionByName(met.select(columns), allowMissingColumns=True)
    return both.repartition(tasks, "group", "strip").sortWithinPartitions("group", "strip", "kind", "block")


def unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, labels and the matrix of vectors of a block."""
    ids, labels = (np.frombuffer(row[c], dtype=np.int64) for c in ("ids", "labels"))
    return ids, labels, np.frombuffer(row["vectors"], dtype=np.int32).reshape(len(ids), -1)


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for part in slices(batch):
            yield from part.to_pylist()


def exact_products(matrix: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers as 64-bit integers; in floating point only where that is exact."""
    largest = float(np.abs(matrix).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * matrix.shape[-1]
    if largest < 2.0**53:
        return (matrix.astype(np.float64) @ vectors.astype(np.float64).T).astype(np.int64)
    return matrix.astype(np.int64) @ vectors.astype(np.int64).T


def best_first(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, equal ones by the smaller id."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)
        return some[np.lexsort((ids[some], -scores[some]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def hash_groups(rows: DataFrame, size: int, queries: Column) -> DataFrame:
    """The rows for which ``queries`` holds, dealt by id to groups of about ``size``, sorted by group within a task."""
    some = rows.filter(queries)
    number = max(1, -(-some.count() // size))
    group = F.pmod(F.xxhash64("id"), F.lit(number)).cast("int")
    return some.withColumn("part", group).repartition("part").sortWithinPartitions("part", "dims", "id")
