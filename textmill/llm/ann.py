"""Nearest neighbours by inner product with a permutation index.

A vector is represented by the pivots in order of distance. It is posted in the inverted files of the
nearest few, and a query reads the files of its own nearest pivots, which are more. What it finds there
is ranked by the footrule distance of the stored order of pivots from the query's own, and the best
share of each block is ranked again by the inner product in double precision. Inner products become
distances by one more coordinate, which fills every entry up to the length of the longest and is 0 for
a query, so a query has its pivots in the order of their inner products with it.

How many files are read, and which share of a block is ranked again, is measured on the vectors at hand:
a sample of the queries is compared with all entries, and as many files are read as hold the wanted
share of the sample's neighbours; then the sample reads these files whole, and the share follows from
the places that its neighbours have in them by footrule.

Equal vectors are one entry with the smallest ids, so a vector that is very common is searched once.
Files are cut into blocks of bounded size. A query that finds too few is compared with all entries,
block by block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from textmill.llm.arrow import add_columns
from textmill.sources.staging import stage

LEAST_PIVOTS = 256
STORED = 64  # nearest pivots whose order is stored for an entry
BLOCK_ROWS = 4096
SAMPLED = 256  # queries whose neighbours decide how many files are read, and what is ranked again

FOUND = StructType([StructField("query", LongType()), StructField("id", LongType()), StructField("score", DoubleType()), StructField("place", DoubleType())])


def pivots_for(entries: int) -> int:
    """Twice the square root of the number of entries, so that files grow as slowly as their number."""
    return max(LEAST_PIVOTS, 2 * math.isqrt(entries))


def usable(vector: Column) -> Column:
    """True for vectors without null or non-finite components that are not zero or empty."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def add_permutation(df: DataFrame, pivots: np.ndarray, longest: float, prefix: int, asking: bool = False) -> DataFrame:
    """``df`` with ``near``, the numbers of the nearest pivots of ``vector`` in order.

    ``longest`` is the greatest squared length of a vector; the filling coordinate of entries follows
    from it. That of ``asking`` vectors is 0.
    """

    def filled(x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(longest - (x * x).sum(axis=1), 0))
        return np.concatenate([x, rest[:, None]], axis=1)

    def make():
        ends = filled(pivots)

        def columns(batch: pa.RecordBatch) -> list[pa.Array]:
            found = []
            x = _matrix(batch.column("vector"), pivots.shape[1])
            for first in range(0, len(x), 2048):
                # All filled vectors are of one length, so the greatest product is the least distance.
                part = x[first : first + 2048]
                products = part @ pivots.T if asking else filled(part) @ ends.T
                some = np.argpartition(-products, prefix - 1, axis=1)[:, :prefix] if prefix < len(ends) else np.tile(np.arange(len(ends)), (len(products), 1))
                order = np.argsort(-np.take_along_axis(products, some, axis=1), axis=1, kind="stable")
                found.append(np.take_along_axis(some, order, axis=1))
            near = np.concatenate(found).astype(np.int32)
            return [pa.ListArray.from_arrays(pa.array(np.arange(len(near) + 1) * prefix, pa.int32()), pa.array(near.ravel()))]

        return columns

    return add_columns(df, [StructField("near", ArrayType(IntegerType(), False), False)], make)


class Block:
    """Entries of one inverted file, or of a part of it: the order of their pivots, of which ``posts`` are those they are posted under."""

    def __init__(self, ids: np.ndarray, orders: np.ndarray, vectors: np.ndarray, posts: int, pivots: int):
        self.ids, self.orders, self.vectors, self.posts, self.pivots = ids, orders, vectors, posts, pivots

    def footrule(self, rows: np.ndarray, order: np.ndarray) -> np.ndarray:
        """Distances of the stored orders of ``rows`` from ``order``; a pivot that is not in it stands behind its end."""
        place = np.full(self.pivots, len(order), dtype=np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        return np.abs(place[self.orders[rows]] - np.arange(self.orders.shape[1], dtype=np.int32)).sum(axis=1)

    def nearest(self, order: np.ndarray, file: int, vector: np.ndarray, k: int, share: float | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, products and places by footrule (as shares of the block) of the best ``k``.

        ``file`` is the number of files that the query, whose order of pivots is ``order``, reads before this
        one; what they hold is left to them. Of the rest the best ``share`` by footrule is ranked by products,
        with all that are as near as its last; without a share, and for a negative ``file``, everything is.
        """
        rows = np.arange(len(self.ids))
        if file > 0:
            read = np.zeros(self.pivots, dtype=bool)
            read[order[:file]] = True
            rows = np.flatnonzero(~read[self.orders[:, : self.posts]].any(axis=1))
        distances = None if file < 0 or not len(rows) else self.footrule(rows, order)
        some = rows
        if distances is not None and share is not None:
            last = min(len(rows), math.ceil(share * len(rows))) - 1
            if last < len(rows) - 1:
                some = rows[distances <= np.partition(distances, max(last, 0))[max(last, 0)]]
        ids, products = self.ids[some], self.vectors[some] @ vector
        best = np.arange(len(ids))
        if len(ids) > k:
            best = np.flatnonzero(products >= np.partition(products, len(ids) - k)[len(ids) - k])
        best = best[np.lexsort((ids[best], -products[best]))[:k]]
        places = np.zeros(len(best))
        if distances is not None and share is None:
            places = (np.searchsorted(np.sort(distances), distances[best]) + 1) / len(rows)
        return ids[best], products[best], places


def files_needed(indexed: DataFrame, sample: DataFrame, pivots: np.ndarray, k: int, posts: int, share: float) -> int:
    """The least number of files in which the rows of ``sample`` find ``share`` of their ``k`` nearest entries.

    The sample comes to the driver and meets all entries once; a task returns its nearest ``k`` only.
    """
    rows = sample.select("id", "vector").collect()
    if not rows:
        return 1
    own, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=np.float64)
    order = np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")
    places = np.empty_like(order)
    np.put_along_axis(places, order, np.arange(len(pivots))[None, :], axis=1)
    schema = StructType([StructField("query", LongType()), StructField("id", LongType()), StructField("score", DoubleType()), StructField("files", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64))] * len(own)
        for batch in batches:
            for first in range(0, batch.num_rows, 2048):
                part = batch.slice(first, 2048)
                ids = part.column("id").to_numpy()
                posted = part.column("near").flatten().to_numpy().reshape(len(ids), -1)[:, :posts]
                products = _matrix(part.column("vector"), pivots.shape[1]) @ vectors.T
                for i in range(len(own)):
                    some = np.argpartition(-products[:, i], k)[: k + 1] if len(ids) > k + 1 else np.arange(len(ids))
                    some = some[ids[some] != own[i]]
                    new = (ids[some], products[some, i], places[i][posted[some]].min(axis=1) + 1)
                    all_ = [np.concatenate(x) for x in zip(best[i], new)]
                    kept = np.lexsort((all_[0], -all_[1]))[:k]
                    best[i] = tuple(x[kept] for x in all_)
        columns = [np.repeat(own, [len(b[0]) for b in best]), *(np.concatenate([b[c] for b in best]) for c in range(3))]
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64(), pa.int64()))], names=schema.names)

    found = indexed.select("id", "near", "vector").mapInArrow(run, schema)
    nearest = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    found = found.withColumn("_place", F.row_number().over(nearest)).filter(F.col("_place") <= k)
    counts = dict(found.groupBy("files").count().collect())  # one row for each number of files
    wanted, held = share * sum(counts.values()), 0
    for files in sorted(counts):
        held += counts[files]
        if held >= wanted:
            return files
    return 1


def footrule_needed(found: DataFrame, share: float) -> float:
    """The least part of a block by footrule that holds ``share`` of the neighbours ``found`` by reading whole blocks.

    One row for each of a sample's neighbours comes to the driver.
    """
    places = sorted(r[0] for r in found.select("place").collect())
    return places[max(0, math.ceil(share * len(places)) - 1)] if places else 1.0


def search_blocks(rows: DataFrame, k: int, pivots: int, posts: int, size: int, share: float | None) -> DataFrame:
    """``query, id, score, place`` from entries (``file`` null) and queries that meet in blocks ``pivot, salt``.

    ``near`` holds the order of an entry's or a query's pivots. See ``Block.nearest`` for ``file`` and ``share``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts, block = None, [], None
        for batch in batches:
            pivot, salt = (batch.column(c).to_numpy() for c in ("pivot", "salt"))
            cuts = np.flatnonzero(np.concatenate([[True], (pivot[1:] != pivot[:-1]) | (salt[1:] != salt[:-1]), [True]]))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if (pivot[a], salt[a]) != current:
                    current, parts, block = (pivot[a], salt[a]), [], None
                part = batch.slice(a, b - a)
                ids = part.column("id").to_numpy()
                near = part.column("near")
                vectors = _matrix(part.column("vector"), size)
                entries = np.array(part.column("file").is_null())
                if entries.any():
                    some = near.filter(pa.array(entries))
                    parts.append((ids[entries], some.flatten().to_numpy().reshape(len(some), -1), vectors[entries]))
                if entries.all() or not parts:
                    continue
                block = block or Block(*(np.concatenate(x) for x in zip(*parts)), posts, pivots)
                files = part.column("file").to_pylist()
                asking = np.flatnonzero(~entries).tolist()
                found = [(ids[i], *block.nearest(near[i].values.to_numpy(), files[i], vectors[i], k, share)) for i in asking]
                columns = [np.repeat([f[0] for f in found], [len(f[1]) for f in found]), *(np.concatenate([f[c] for f in found]) for c in (1, 2, 3))]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64(), pa.float64()))], names=FOUND.names)

    dealt = rows.repartition("pivot", "salt").sortWithinPartitions("pivot", "salt", F.col("file").isNotNull())
    return dealt.mapInArrow(run, FOUND)


def nearest_neighbours(
    df: DataFrame, queries: Column, k: int = 20, row_id: str = "vec_id", vector: str = "embedding",
    posts: int = 6, probes: int = 40, share: float = 0.97, ranked: float = 0.99, pivots: int | None = None,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found to every row for which ``queries`` holds.

    The nearest have the greatest inner product, equal ones the smaller id; a row is no neighbour of
    its own id. ``row_id`` must be a whole number. Rows with a null id, and vectors that are null,
    empty, zero or hold null or non-finite components, take no part; vectors of different lengths
    are searched apart. Repeated rows count once. Other columns are not read.

    ``pivots`` entries (``pivots_for`` their number by default) are chosen by a hash of their ids, or all
    entries if there are fewer; they and the sample of ``SAMPLED`` queries alone come to the driver. Every
    entry is indexed, in ``posts`` files; a query reads ``probes`` files, or more if fewer than ``share`` of
    the true neighbours of the sample are in them, up to all files. In each block, as large a share by
    footrule is ranked by products as holds ``ranked`` of the neighbours that the sample finds in its files.
    """
    rows = df.filter(F.col(row_id).isNotNull() & usable(F.col(vector)))
    rows = rows.select(F.col(row_id).cast("long").alias("id"), F.col(vector).alias("vector"), queries.alias("asks")).distinct()
    place = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    few = rows.withColumn("place", place).filter(F.col("place") <= k + 1)
    entries = few.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    entries = stage(entries.select(F.element_at("ids", 1).alias("id"), "vector", "ids"), "entries")
    asked = rows.filter("asks").select(F.col("id").alias("query_id"), "vector")
    asked = stage(asked.join(entries.select("id", "vector"), "vector").select("query_id", "id"), "asked")
    schema = StructType([StructField("query_id", LongType()), StructField("rank", LongType()), StructField("vec_id", LongType()), StructField("score", DoubleType())])
    out = df.sparkSession.createDataFrame([], schema)
    for size in sorted(r[0] for r in entries.select(F.size("vector")).distinct().collect()):
        some = entries.filter(F.size("vector") == size)
        out = out.unionByName(_search(some, asked, size, k, posts, probes, share, ranked, pivots))
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias(row_id), "score")


def _search(entries: DataFrame, asked: DataFrame, size: int, k: int, posts: int, probes: int, share: float, ranked: float, wanted_pivots: int | None) -> DataFrame:
    longest = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    count, most, names = entries.agg(F.count("*"), F.max(longest), F.sum(F.size("ids"))).head()
    number = min(count, wanted_pivots or pivots_for(count))
    chosen = entries.orderBy(F.xxhash64("id"), "id").limit(number).select("vector").collect()
    pivots = np.array([r[0] for r in chosen], dtype=np.float64)
    posts = min(posts, (number + 1) // 2)
    stored = max(posts, min(STORED, number))
    indexed = stage(add_permutation(entries.drop("ids"), pivots, float(most), stored), "indexed")
    posted = indexed.select("id", "near", "vector", F.explode(F.slice("near", 1, posts)).alias("pivot"))
    files = posted.groupBy("pivot").agg(F.ceil(F.count("*") / F.lit(BLOCK_ROWS)).cast("int").alias("salts"))
    files = F.broadcast(stage(files, "files"))  # one row for each pivot
    wanted = stage(indexed.drop("near").join(asked.select("id").distinct(), "id", "left_semi"), "wanted")
    sample = wanted.orderBy(F.xxhash64("id", F.lit(1)), "id").limit(SAMPLED)
    probes = max(min(probes, (number + 1) // 2), files_needed(indexed, sample, pivots, k, posts, share))
    wanted = add_permutation(wanted, pivots, float(most), min(number, max(probes, 2 * stored)), asking=True)

    def dealt(entry_rows: DataFrame) -> DataFrame:
        rows = entry_rows.join(files, "pivot").withColumn("salt", F.pmod(F.xxhash64("id"), "salts").cast("int"))
        return rows.select("pivot", "salt", "id", "near", "vector", F.lit(None).cast("int").alias("file"))

    def asking(query_rows: DataFrame) -> DataFrame:
        rows = query_rows.join(files, "pivot")
        return rows.select("pivot", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "id", "near", "vector", "file")

    def top(found: DataFrame) -> DataFrame:
        best = Window.partitionBy("query").orderBy(F.desc("score"), "id")
        # One more than asked for, as the query is among the entries.
        return found.withColumn("_place", F.row_number().over(best)).filter(F.col("_place") <= k + 1).drop("_place")

    def named(best: DataFrame) -> DataFrame:
        """Neighbours of each asking row, from the entries found for its vector."""
        lists = best.join(entries.select("id", "ids"), "id").groupBy("query").agg(F.collect_list(F.struct("score", "ids")).alias("found"))
        one = lambda f: F.transform(f["ids"], lambda i: F.struct((-f["score"]).alias("less"), i.alias("vec_id")))
        joined = asked.join(lists, asked["id"] == lists["query"], "left")
        near = F.array_sort(F.filter(F.flatten(F.transform("found", one)), lambda x: x["vec_id"] != F.col("query_id")))
        return joined.select("query_id", "id", F.slice(near, 1, k).alias("near"))

    def found_by(query_rows: DataFrame, part: float | None) -> DataFrame:
        asks = query_rows.select("id", "near", "vector", F.posexplode(F.slice("near", 1, probes)).alias("file", "pivot"))
        return top(search_blocks(dealt(posted).unionByName(asking(asks)), k + 1, number, posts, size, part))

    tried = found_by(wanted.join(sample.select("id"), "id", "left_semi"), None).filter("query <> id")
    part = footrule_needed(tried, ranked)
    first = stage(named(found_by(wanted, part)), "first")
    short = F.coalesce(F.size("near"), F.lit(0)) < min(k, names - 1)
    lacking = stage(first.filter(short).select("id").distinct(), "lacking")
    found = first
    if not lacking.isEmpty():
        home = indexed.select("id", "near", "vector", F.element_at("near", 1).alias("pivot"))
        every = F.explode(F.sequence(F.lit(0), F.lit(number - 1))).alias("pivot")
        again = wanted.join(lacking, "id", "left_semi").select("id", "near", "vector", every, F.lit(-1).alias("file"))
        whole = named(top(search_blocks(dealt(home).unionByName(asking(again)), k + 1, number, posts, size, None)))
        found = first.filter(~short).unionByName(whole.join(lacking, "id", "left_semi").select(first.columns))
    ranked = found.select("query_id", F.posexplode("near").alias("place", "one"))
    return ranked.select("query_id", (F.col("place") + 1).cast("long").alias("rank"), "one.vec_id", (-F.col("one.less")).alias("score"))
