"""CSV files with line breaks inside quotes, read by many tasks for each file.

Spark splits a file at line feeds, and whether such a line begins a record depends on all the quotes
before it. So the quotes of each block of a file are counted first; running sums over the blocks tell
which blocks begin inside quotes. Each block then turns its lines into records. Only what crosses the
edge of a block is left as fragments, at most two for each block, which are put together by file.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructType

from textmill.operators.ranks import number_in_files
from textmill.sources.staging import SHIP_ROWS

RECORDS = "_path string, _start bigint, _seen bigint, part string, record string"
WHOLE, HEAD, TAIL, MIDDLE = "whole", "head", "tail", "middle"


def read_csv_split(
    spark: SparkSession, path: str, schema: StructType | str | None = None, *, row_id: str | None = None, missing: Iterable[str] = (), out: str = "_row_id",
) -> DataFrame:
    """Comma-separated text with a header in each file and RFC 4180 quoting; files are split.

    Without ``schema`` all columns are strings, named by the first file's header; with one, they go by
    their places. Empty cells and the ``missing`` texts are null, empty lines are skipped. Rows get ids in
    the order of path and place, unless ``row_id`` names a column that gives it. A record that does not fit
    the schema is an error, as is a file that ends inside quotes; an empty file has no rows. Files are
    scanned for the quotes, for the records and for the fragments, and numbering scans them once more;
    no full row is shuffled but for the ids.
    """
    lines = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(path)
    lines = lines.select("value", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_start"))
    rows = whole_records(lines.withColumn("_line", F.monotonically_increasing_id()), _blocks(spark, path) <= SHIP_ROWS)
    header = (F.col("_start") == 0) & (F.col("_seen") == 0)
    if schema is None:
        first = rows.filter(header).orderBy("_path").head()
        if first is None:
            raise ValueError(f"no header in {path!r}, so the columns have no names")
        names = spark.createDataFrame([(first.record,)], "record string").select(F.from_csv("record", *_row_options(first.record))).head()[0]
        schema = StructType()
        for name in names:
            schema.add(name, StringType())
    row = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    options = {"sep": ",", "quote": '"', "escape": '"', "multiLine": "true", "mode": "FAILFAST", "emptyValue": ""}
    parsed = F.from_csv("record", F.lit(_ddl(row)), options)
    df = rows.filter(~header).select("_path", "_start", "_seen", parsed.alias("_row"))
    absent = ["", *missing]
    cells = [
        F.when(~F.col("_row")[f.name].isin(absent), F.col("_row")[f.name]).alias(f.name) if f.dataType.typeName() == "string" else F.col("_row")[f.name].alias(f.name)
        for f in row.fields
    ]
    if row_id is not None:
        return df.select(*cells)
    return number_in_files(df.select("_path", "_start", "_seen", *cells), ["_path", "_start"], "_seen", [], out).drop("_path", "_start", "_seen")


def _ddl(row: StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in row.fields)


def _row_options(record: str) -> tuple:
    """A schema that is wide enough for the names in a header, and how to read it."""
    width = 1 + record.count(",")
    return F.lit(", ".join(f"c{k} string" for k in range(width))), {"sep": ",", "quote": '"', "escape": '"', "multiLine": "true"}


def _blocks(spark: SparkSession, path: str) -> int:
    """An upper bound of the number of blocks that Spark cuts the files into, from their lengths."""
    size = _bytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("length")
    count, total = files.agg(F.count("*"), F.sum("length")).head()
    # Small inputs are cut finer, to one block for each core.
    return count + math.ceil((total or 0) / size) + spark.sparkContext.defaultParallelism


def _bytes(setting: str) -> int:
    units = {"b": 0, "k": 1, "m": 2, "g": 3}
    text = setting.lower().removesuffix("b") if setting[-1:].isalpha() and len(setting) > 1 and setting[-2].isalpha() else setting.lower()
    return int(text[:-1]) << (10 * units[text[-1]]) if text[-1] in units else int(text)


def whole_records(lines: DataFrame, few: bool) -> DataFrame:
    """``_path, _start, _seen, record`` from ``value, _path, _start, _line``: records by the block in which they begin.

    ``few`` says that the blocks' table, a row for each block, may be sent to all tasks. If not, lines
    are brought to their block's row by a shuffle and put back in order.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counts = lines.groupBy("_path", "_start").agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("_path").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    blocks = counts.select("_path", "_start", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("inside"))
    if few:
        placed = lines.join(F.broadcast(blocks), ["_path", "_start"], "left")
    else:
        placed = lines.join(blocks.hint("merge"), ["_path", "_start"], "left").repartition("_path", "_start")
        placed = placed.sortWithinPartitions("_path", "_start", "_line")
    rows = placed.select("value", "_path", "_start", "inside").mapInArrow(_records, RECORDS)
    whole = rows.filter(F.col("part") == WHOLE).drop("part")
    found = whole.unionByName(_joined(rows.filter(F.col("part") != WHOLE)))
    return found.withColumn("record", F.regexp_replace("record", r"\r\z", "")).filter("record <> ''")


def _joined(fragments: DataFrame) -> DataFrame:
    """Records that cross blocks: a tail, the blocks that lie within, and the head that closes it."""
    along = Window.partitionBy("_path").orderBy("_start", "_seen")
    opened = F.sum((F.col("part") == TAIL).cast("int")).over(along.rowsBetween(Window.unboundedPreceding, 0))
    pieces = F.array_sort(F.collect_list(F.struct("_start", "_seen", "part", "record"))).alias("pieces")
    whole = fragments.withColumn("number", opened).groupBy("_path", "number").agg(pieces)
    open_end = F.concat(F.lit("a quote is not closed in "), "_path")
    closed = F.element_at("pieces", -1)["part"] == HEAD
    record = F.when(closed, F.array_join("pieces.record", "\n")).otherwise(F.raise_error(open_end))
    first = F.element_at("pieces", 1)
    return whole.select("_path", first["_start"].alias("_start"), first["_seen"].alias("_seen"), record.alias("record"))


class _Block:
    """The lines of one block of a file, in order, as they become records."""

    def __init__(self, path: str, start: int, inside: bool):
        self.path, self.start, self.odd = path, start, int(inside)
        self.count, self.head, self.open = 0, inside, []

    def add(self, lines: pa.Array) -> Iterator[pa.RecordBatch]:
        """Records that these lines end; the last one may go on and waits."""
        quotes = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)
        after = (self.odd + np.cumsum(quotes)) & 1
        before = np.concatenate([[self.odd], after[:-1]])
        starts = np.flatnonzero(before == 0)
        self.odd = int(after[-1])
        if not len(starts):
            self.open.extend(lines.to_pylist())
            return
        self.open.extend(lines[: int(starts[0])].to_pylist())
        yield from self.close()
        grouped = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), lines[: int(starts[-1])])
        if len(grouped):
            yield self.rows(pc.binary_join(grouped, "\n"), WHOLE)
        self.open = lines[int(starts[-1]) :].to_pylist()

    def close(self, part: str = WHOLE) -> Iterator[pa.RecordBatch]:
        if self.open:
            record, self.open = "\n".join(self.open), []
            yield self.rows(pa.array([record]), HEAD if self.head and part == WHOLE else part)
        self.head = False

    def end(self) -> Iterator[pa.RecordBatch]:
        yield from self.close(WHOLE if not self.odd else MIDDLE if self.head else TAIL)

    def rows(self, records: pa.Array, part: str) -> pa.RecordBatch:
        n, first = len(records), self.count
        self.count += n
        columns = [pa.array([self.path] * n), pa.array([self.start] * n, pa.int64()), pa.array(range(first, first + n), pa.int64())]
        return pa.record_batch([*columns, pa.array([part] * n), records.cast(pa.string())], names=["_path", "_start", "_seen", "part", "record"])


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block = None
    for batch in batches:
        if not batch.num_rows:
            continue
        paths, starts = batch.column("_path").dictionary_encode(), batch.column("_start").to_numpy()
        codes = paths.indices.to_numpy()
        cuts = np.flatnonzero(np.concatenate([[True], (codes[1:] != codes[:-1]) | (starts[1:] != starts[:-1]), [True]]))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            path, start = paths.dictionary[codes[a]].as_py(), int(starts[a])
            if block is None or (block.path, block.start) != (path, start):
                if block is not None:
                    yield from block.end()
                inside = batch.column("inside")[a].as_py()
                if inside is None:
                    raise ValueError(f"{path} was cut into other blocks than when its quotes were counted")
                block = _Block(path, start, inside)
            yield from block.add(batch.column("value")[a:b])
    if block is not None:
        yield from block.end()
