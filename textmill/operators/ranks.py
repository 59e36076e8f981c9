"""Exact ranks without a global sort: cut-offs, samples and row numbers.

``limit(n)`` moves n rows of every task through one reducer, and a window without partitions moves
the whole table through one task. Neither holds for large n, so the helpers here find the row at a
rank from bounded histograms, or number rows inside many small buckets.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, Window, functions as F

from textmill.functions.keys import hash_key, leading_number, required
from textmill.sources.staging import stage

HISTOGRAM_BINS = 4096
DIRECT_ROWS = 100_000  # a range with at most this many rows is sorted as it is
BUCKET_DIGITS = 4  # hex digits of an md5: at most 65,536 buckets
_LOCAL_BITS = 33  # monotonically_increasing_id keeps the position in a partition in the low 33 bits


def rank_cut(df: DataFrame, key: Column, ties: list[Column], n: int, direct_rows: int | None = None) -> Column:
    """A predicate that holds for exactly the first ``n`` rows in the order of ``(key, *ties)``.

    The columns together make the order total and hold no nulls. Each round counts rows in ranges of
    a column (a map-side aggregate of at most 65,793 rows) and narrows to the range that holds the
    n-th row: whole numbers by equal ranges, text by the two bytes after what all of the range have
    in common. A column that is down to one value hands over to the next, so a crowd of ties is
    narrowed like the key itself. Once at most ``direct_rows`` rows are left, the row is read. Only the columns
    named are scanned, and applying the predicate needs no shuffle.
    """
    direct_rows = DIRECT_ROWS if direct_rows is None else direct_rows
    columns = [key, *ties]
    names = [f"k{i}" for i in range(len(columns))]
    inside = df.select(*(c.alias(name) for c, name in zip(columns, names)))
    low, high, total = inside.agg(F.min("k0"), F.max("k0"), F.count(F.lit(1))).first()
    if n >= total:
        return F.lit(True)
    if n <= 0:
        return F.lit(False)
    wanted = n
    for place, name in enumerate(names):
        if total <= direct_rows:
            break
        if place:
            low, high = inside.agg(F.min(name), F.max(name)).first()
        while total > direct_rows and low != high:
            digit = _digit(inside, name, low, high)
            if digit is None:
                break
            found = (F.count(F.lit(1)), F.min(name), F.max(name))
            for _, total, low, high in sorted(inside.groupBy(digit.alias("range")).agg(*found).collect()):
                if wanted <= total:
                    break
                wanted -= total
            inside = inside.filter(F.col(name).between(F.lit(low), F.lit(high)))
        if low != high:
            break

    bound = inside.orderBy(*names).offset(wanted - 1).limit(1).first() if low != high or total <= direct_rows else inside.first()
    keep = columns[-1] <= F.lit(bound[-1])
    for column, value in list(zip(columns, bound))[-2::-1]:
        keep = (column < F.lit(value)) | ((column == F.lit(value)) & keep)
    return keep


def _digit(df: DataFrame, name: str, low, high) -> Column | None:
    """The range in which a value between ``low`` and ``high`` lies, as something that sorts; None for other types."""
    kind = df.schema[name].dataType.typeName()
    if kind in ("byte", "short", "integer", "long"):
        return F.call_function("div", F.col(name), F.lit((high - low) // HISTOGRAM_BINS + 1))
    if kind in ("string", "binary"):
        ends = [v.encode() if isinstance(v, str) else bytes(v) for v in (low, high)]
        return F.hex(F.substring(F.col(name).cast("binary"), len(os.path.commonprefix(ends)) + 1, 2))
    return None


def first_rows(df: DataFrame, n: int, row_id: str) -> Column:
    """Predicate for the ``n`` rows with the smallest row ids."""
    return rank_cut(df, required(row_id), [], n)


def sampled_rows(df: DataFrame, n: int, seed: str | int, row_id: str) -> Column:
    """Predicate for ``n`` rows drawn without replacement; the same rows however the table is split."""
    key = hash_key(seed, row_id)
    return rank_cut(df, leading_number(key), [key, required(row_id)], n)


def _shift(df: DataFrame, group: str, position: Column, out: str, total: str) -> DataFrame:
    """Turn a position inside a group into a place in the whole: add the rows of the groups before it.

    The table of groups is bounded by construction (hash buckets or shuffle partitions), which is what
    makes its one-task running sum and its broadcast safe.
    """
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias("_rows"))
    running = Window.orderBy(group).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.orderBy(group).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = counts.select(
        group,
        (F.sum("_rows").over(running) - F.col("_rows")).alias("_before"),
        F.sum("_rows").over(whole).cast("bigint").alias(total),
    )
    placed = df.withColumn(out, position).join(F.broadcast(offsets), group)
    return placed.withColumn(out, (F.col(out) + F.col("_before")).cast("bigint")).drop(group, "_before")


def number_by_hash(df: DataFrame, seed: str | int, row_id: str, out: str, total: str) -> DataFrame:
    """Number all rows 0.. in the order of their sampling key.

    The leading digits of the key name one of at most 65,536 evenly filled buckets. Rows are numbered
    inside their bucket and shifted by the rows of the buckets before it: one shuffle, no driver job.
    """
    keyed = df.withColumn("_key", hash_key(seed, row_id)).withColumn(
        "_bucket", F.substring("_key", 1, BUCKET_DIGITS)
    )
    inside = Window.partitionBy("_bucket").orderBy("_key", row_id)
    position = F.row_number().over(inside) - 1
    return _shift(keyed, "_bucket", position, out, total).drop("_key")


def number_by_order(df: DataFrame, order: list[str], out: str, total: str) -> DataFrame:
    """Number all rows 0.. in the order of the given columns, which must be unique together.

    Rows are range-partitioned and sorted, and written once with their partition and position. The
    written numbers cannot change when an executor is lost, unlike range bounds that are drawn again.
    """
    laid_out = stage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id()),
        "ordered",
    )
    parts = laid_out.withColumn("_part", F.shiftright("_place", _LOCAL_BITS))
    position = F.col("_place").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return _shift(parts, "_part", position, out, total).drop("_place")


MOST_RANGES = 65_536
RANGE_ROWS = 10_000  # a range has about as many rows at least


class IdRanges:
    """Ranges of a whole-number id, each of bounded size, from histograms that are counted round by round.

    Each round cuts the ranges that hold too many rows into equal cells, all in one aggregate; light
    neighbours then make up a range together. What comes to the driver and goes into the plan is
    bounded by a few times ``MOST_RANGES`` numbers. A row finds its range by binary search in an array constant.
    """

    def __init__(self, df: DataFrame, row_id: str, pieces: int | None = None):
        ids = df.select(required(row_id).cast("bigint").alias("id"))
        low, high, self.total = ids.agg(F.min("id"), F.max("id"), F.count(F.lit(1))).first()
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        pieces = pieces or min(MOST_RANGES, max(1024, 4 * partitions), self.total // RANGE_ROWS + 1)
        self.lows, self.offsets = [low or 0], [0]
        if pieces == 1 or not self.total:
            return
        target = -(-self.total // pieces)
        # Differences within a part fit 63 bits, so ids of both signs are two parts.
        parts = [(low, -1), (0, high)] if low < 0 <= high else [(low, high)]
        done: list[tuple[int, int]] = []
        cells = 2 * pieces
        while parts:
            widths = [(b - a) // cells + 1 for a, b in parts]
            found = _search([a for a, _ in parts], F.col("id"))
            at = lambda values: F.element_at(_literal(values), F.col("part"))  # noqa: B023, E731
            placed = ids.withColumn("part", found).filter((F.col("part") > 0) & (F.col("id") <= at([b for _, b in parts])))
            cell = F.call_function("div", F.col("id") - at([a for a, _ in parts]), at(widths))
            heavy = []
            for part, c, n in placed.groupBy("part", cell.alias("cell")).count().collect():
                (low, high), width = parts[part - 1], widths[part - 1]
                first = low + c * width
                if n > 4 * target and width > 1:
                    heavy.append((first, min(first + width - 1, high)))
                else:
                    done.append((first, n))
            parts, cells = sorted(heavy), max(16, min(HISTOGRAM_BINS, 2 * MOST_RANGES // max(1, len(heavy))))
        rows = before = 0
        for first, n in sorted(done):
            if rows and rows + n > target:
                before += rows
                self.lows.append(first)
                self.offsets.append(before)
                rows = 0
            rows += n

    def range_of(self, id_: Column) -> Column:
        """The range of an id, an INT from 1."""
        return F.lit(1) if len(self.lows) == 1 else _search(self.lows, id_)

    def offset(self, range_: Column) -> Column:
        """The rows before a range."""
        return F.element_at(_literal(self.offsets), range_)


def _search(lows: list[int], value: Column) -> Column:
    """How many of the rising ``lows`` are at most ``value``, by binary search: an INT."""
    steps = [1 << k for k in reversed(range(len(lows).bit_length()))]
    bounds = _literal(lows)

    def further(place: Column, step: Column) -> Column:
        there = place + step
        return F.when((there <= len(lows)) & (F.get(bounds, F.least(there, F.lit(len(lows))) - 1) <= value), there).otherwise(place)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), further)


def _literal(values: list[int]) -> Column:
    """A BIGINT array constant; parsed from text, as thousands of literals would each cross to the JVM."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def number_by_id(df: DataFrame, row_id: str, out: str, total: str, pieces: int | None = None) -> DataFrame:
    """Number all rows 0.. in the order of a unique whole-number id.

    Histograms of the id, read from that column alone, cut it into ranges of known sizes. Rows are
    numbered inside their range and shifted by the rows before it: one shuffle, nothing is written,
    and the numbers depend on the ids only, however often a lost task is run again.
    """
    ranges = IdRanges(df, row_id, pieces)
    names = {c: f"_c{i}" for i, c in enumerate(df.columns)}
    marked = df.withColumnsRenamed(names).withColumn("id", F.col(names[row_id]).cast("bigint"))
    marked = marked.withColumn("_range", ranges.range_of(F.col("id")))
    position = F.row_number().over(Window.partitionBy("_range").orderBy("id")) - 1
    placed = marked.withColumn("_place", (position + ranges.offset(F.col("_range"))).cast("bigint"))
    columns = [F.col(n).alias(c) for c, n in names.items() if c not in (out, total)]
    return placed.select(*columns, F.col("_place").alias(out), F.lit(ranges.total).cast("bigint").alias(total))


CHUNK_BITS = 20


def number_in_files(df: DataFrame, files: list[str], seen: str, within: list[str], out: str) -> DataFrame:
    """Number all rows 0.. in the order of the file blocks they were read from, without moving the order itself.

    ``files`` name the block, ``seen`` is ``monotonically_increasing_id`` of the scan, and ``within`` are further
    columns that order rows of one ``seen``. Rows of a block are cut into chunks of about a million; the chunks'
    sizes are counted first, in a small table. A layout of the scan that changed in between is an
    error, as chunks then have other sizes.
    """
    chunk = F.shiftright(seen, CHUNK_BITS).alias("_chunk")
    sizes = stage(df.groupBy(*files, chunk).agg(F.count(F.lit(1)).alias("_rows")), "chunks")
    running = Window.orderBy(*files, "_chunk").rowsBetween(Window.unboundedPreceding, -1)  # a row for a million rows
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_rows").over(running), F.lit(0)))
    keyed = df.withColumn("_chunk", F.shiftright(seen, CHUNK_BITS))
    inside = Window.partitionBy(*files, "_chunk").orderBy(seen, *within)
    placed = keyed.withColumn("_place", F.row_number().over(inside)).join(offsets, [*files, "_chunk"], "left")
    known = F.when(F.col("_place") <= F.col("_rows"), F.col("_before") + F.col("_place") - 1)
    checked = F.coalesce(known, F.raise_error(F.lit("the files were read in another layout than when their rows were counted")))
    return placed.withColumn(out, checked.cast("bigint")).drop("_chunk", "_place", "_rows", "_before")
