"""Token ids as Arrow files of equal-length sequences.

A shard is one Arrow IPC file. Its record batches have two columns of fixed-size lists: ``tokens``
(unsigned integers of the narrowest width that holds the vocabulary) and ``mask`` (false only for
the padding at the end of the shard). All values of a column lie in one uncompressed buffer, and all
batches but a shard's last have the same number of rows, so ``TokenSequences`` finds any sequence at
once and takes it and its mask from a mapped file as slices, without a copy. Documents follow
each other without padding in ascending id order, within a shard and from shard to shard. Beside
each shard lies ``.docs``, an Arrow file with the id and the number of tokens of each document.

The manifest has one row for each shard. Tasks may be run again: each attempt writes files of its
own, and only those that the manifest names count.
"""

from __future__ import annotations

import bisect
import contextlib
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType
from tokenizers import Tokenizer

from textmill.llm.arrow import slices, texts_of
from textmill.llm.shared import attempt_name, open_folder, reading
from textmill.llm.units import WHITE_SPACE, split_units
from textmill.sources.staging import fresh_folder, stage

ROWS_PER_BATCH = 256


def _joinable(unit: str) -> bool:
    """One space or line feed, then a visible character, and a visible character at the end."""
    return len(unit) > 1 and unit[0] in " \n" and unit[1] not in WHITE_SPACE and unit[-1] not in WHITE_SPACE



class LibraryEncoder:
    """The tokenizers library with its results kept by unit; made once per worker process.

    Units that are new in a batch are encoded together, as one text: each starts with one space or line
    feed and ends with a visible character, so the library cuts between them, and the lengths of the
    tokens tell which belong to which. ``limit`` bounds memory only: units that fell out are encoded again.
    """

    def __init__(self, path: str, limit: int = 1_000_000, special_as_text: bool = False):
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = special_as_text
        self.library.no_truncation()
        self.library.no_padding()
        size = self.library.get_vocab_size(with_added_tokens=True)
        self.narrow = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        added = self.library.get_added_tokens_decoder()
        self.specials = [t.content for t in added.values()]
        # In a byte-level vocabulary each character of a token stands for one byte.
        self.lengths = np.array([len(self.library.id_to_token(i) or "") for i in range(size)])
        self.known: dict[str, bytes] = {}
        self.limit = limit

    def packed(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.narrow).tobytes()

    def encode_together(self, units: list[str]) -> list[bytes]:
        out = []
        for first in range(0, len(units), 64):
            some = units[first : first + 64]
            ids = np.array(self.library.encode_batch_fast(["".join(some)], add_special_tokens=False)[0].ids, dtype=self.narrow)
            ends = np.cumsum([len(u.encode()) for u in some])
            cuts = np.searchsorted(np.cumsum(self.lengths[ids]), ends) + 1
            data, width = ids.tobytes(), self.narrow.itemsize
            out += [data[a * width : b * width] for a, b in zip([0, *cuts[:-1].tolist()], cuts.tolist())]
        return out

    def encode_units(self, units: list[str]) -> list[bytes]:
        joinable = [u for u in units if _joinable(u)]
        together = iter(self.encode_together(joinable))
        if len(joinable) == len(units):
            return list(together)
        return [next(together) if _joinable(u) else self.whole(u) for u in units]

    def encode(self, texts: list[str]) -> list[bytes]:
        plain = [not any(s in t for s in self.specials) for t in texts]
        split = [split_units(t) if ok else [] for t, ok in zip(texts, plain)]
        get = self.known.get
        found = [list(map(get, units)) for units in split]
        missing = list({u for units, f in zip(split, found) if None in f for u, x in zip(units, f) if x is None})
        made = dict(zip(missing, self.encode_units(missing)))
        out = []
        for text, ok, units, f in zip(texts, plain, split, found):
            if None in f:
                f = [made[u] if x is None else x for u, x in zip(units, f)]
            out.append(b"".join(f) if ok else self.whole(text))
        if len(self.known) + len(made) > self.limit:
            self.known = {u: x for units, f in zip(split, found) for u, x in zip(units, f) if x is not None}
        self.known.update(made)
        return out

    def whole(self, text: str) -> bytes:
        return self.packed(self.library.encode(text, add_special_tokens=False).ids)


@functools.cache
def library_encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


class ShardWriter:
    """Appends documents to one shard; holds no more than one record batch in memory."""

    def __init__(self, system, path: str, width: np.dtype, length: int):
        self.kind = pa.from_numpy_dtype(width)
        self.length, self.step = length, length * width.itemsize
        self.schema = pa.schema([("tokens", pa.list_(self.kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.file = system.open_output_stream(path)
        self.writer = pa.ipc.new_file(self.file, self.schema)
        self.waiting, self.size = [], 0

    def add(self, tokens: bytes) -> None:
        self.waiting.append(tokens)
        self.size += len(tokens)
        if self.size >= self.step * ROWS_PER_BATCH:
            self.flush(self.size // (self.step * ROWS_PER_BATCH) * ROWS_PER_BATCH)

    def flush(self, rows: int, filled: int | None = None) -> None:
        data = b"".join(self.waiting)
        for first in range(0, rows, ROWS_PER_BATCH):
            some = min(ROWS_PER_BATCH, rows - first)
            part = data[first * self.step : (first + some) * self.step]
            values = pa.Array.from_buffers(self.kind, some * self.length, [None, pa.py_buffer(part)])
            mask = np.ones(some * self.length, dtype=bool)
            if filled is not None:
                mask[max(0, filled - first * self.length) :] = False
            columns = [pa.FixedSizeListArray.from_arrays(v, self.length) for v in (values, pa.array(mask))]
            self.writer.write_batch(pa.record_batch(columns, schema=self.schema))
        rest = data[rows * self.step :]
        self.waiting, self.size = [rest], len(rest)

    def close(self) -> None:
        if self.size:
            filled = self.size * self.length // self.step
            rows = -(-self.size // self.step)
            self.waiting.append(bytes(rows * self.step - self.size))
            self.flush(rows, filled)
        self.writer.close()
        self.file.close()


def write_token_files(
    df: DataFrame, path: str, folder: str | None = None, row_id: str = "doc_id", text: str = "text",
    end_id: int = 0, length: int = 2048,
) -> DataFrame:
    """Encode ``text`` with the vocabulary file ``path`` and write shards; returns the manifest.

    Rows are dealt by ranges of ``row_id`` and sorted by it within a shard, null first; rows of equal
    ids stand in order of their texts. A null or empty text is written as ``end_id`` alone. Other
    columns are not read. An empty table writes no shard. ``folder`` (a URI or an absolute path that
    all executors share) is a fresh one below the cluster's shared folder by default.
    """
    spark = df.sparkSession
    folder = folder or fresh_folder(spark, "tokens")
    schema = StructType(
        [StructField("folder", StringType()), StructField("file", StringType()), StructField("shard", IntegerType())]
        + [StructField(n, LongType()) for n in ("n_docs", "n_tokens")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer, docs, total, name = library_encoder(path), None, 0, 0, ""
        width, end = encoder.narrow, encoder.packed([end_id])
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                system, place = open_folder(folder)
                name = attempt_name("tokens")
                writer = ShardWriter(system, f"{place}/{name}.arrow", width, length)
                index_schema = pa.schema([("id", batch.column(0).type), ("n_tokens", pa.int64())])
                index_file = system.open_output_stream(f"{place}/{name}.docs")
                index = pa.ipc.new_file(index_file, index_schema)
            sizes = []
            for part in slices(batch):
                for tokens in encoder.encode(texts_of(part.column(1))):
                    writer.add(tokens + end)
                    sizes.append(len(tokens) // width.itemsize + 1)
            index.write_batch(pa.record_batch([batch.column(0), pa.array(sizes, pa.int64())], schema=index_schema))
            docs, total = docs + len(sizes), total + sum(sizes)
        if writer is not None:
            writer.close()
            index.close()
            index_file.close()
            shard = TaskContext.get().partitionId()
            values = [[folder], [name], [shard], [docs], [total]]
            kinds = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.record_batch([pa.array(v, k) for v, k in zip(values, kinds)], names=[f.name for f in schema])

    rows = df.select(F.col(row_id).alias("id"), F.col(text).alias("text"))
    dealt = rows.repartitionByRange("id").sortWithinPartitions("id", "text")
    return stage(dealt.mapInArrow(run, schema), "manifest")


def read_token_files(manifest: DataFrame, row_id_type: str = "bigint") -> DataFrame:
    """The documents of the shards: ``id, start, n_tokens, tokens`` (little-endian unsigned 32-bit integers).

    ``start`` counts the tokens of all documents before this one, in all shards. A shard is read
    batch by batch; the manifest, one row for each shard, is the only thing that is ordered in one task.
    """
    spark = manifest.sparkSession
    before = F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    shards = manifest.withColumn("before", F.coalesce(before, F.lit(0)))
    files = max(1, manifest.count())
    schema = spark.range(0).select(F.col("id").cast(row_id_type).alias("id")).schema
    schema = schema.add("start", LongType()).add("n_tokens", LongType()).add("tokens", BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _documents(row["folder"], row["file"], row["before"])

    return shards.repartitionByRange(files, "shard").mapInArrow(run, schema)


def _documents(folder: str, name: str, before: int) -> Iterator[pa.RecordBatch]:
    with reading(folder, f"{name}.docs") as index_file, reading(folder, f"{name}.arrow") as file:
        index, shard = pa.ipc.open_file(index_file), pa.ipc.open_file(file)
        at, held = 0, np.empty(0, dtype="<u4")
        for k in range(index.num_record_batches):
            docs = index.get_batch(k)
            sizes = docs.column(1).to_numpy()
            tokens, pieces, have = int(sizes.sum()), [held], len(held)
            while have < tokens:
                sequences = shard.get_batch(at)
                ids, mask = (sequences.column(c).flatten() for c in (0, 1))
                ids = ids.to_numpy() if pc.all(mask).as_py() else ids.filter(mask).to_numpy()
                at += 1
                pieces.append(ids.astype("<u4"))
                have += len(pieces[-1])
            flat = np.concatenate(pieces)
            held = flat[tokens:]
            ends = np.cumsum(sizes)
            blob, kind = pa.py_buffer(flat[:tokens].tobytes()), docs.column(0).type
            offsets = pa.py_buffer((np.concatenate([[0], ends]) * 4).astype(np.int64).tobytes())
            blobs = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, offsets, blob]).cast(pa.binary())
            yield pa.record_batch(
                [docs.column(0).cast(kind), pa.array(before + ends - sizes), pa.array(sizes), blobs],
                names=["id", "start", "n_tokens", "tokens"],
            )
            before += tokens


class TokenSequences:
    """Random access to the sequences of all shards of a manifest, for a data loader.

    ``sequences[i]`` is the ``i``-th of ``len(sequences)`` by shard and place: its token ids as a numpy
    array and its mask as an Arrow array of booleans, both views of the mapped file (of the batch read,
    where the folder is no local one). Of the manifest, one row for each shard comes to this process;
    shards are opened when they are first asked for and stay open until ``close``.
    """

    def __init__(self, manifest: DataFrame, length: int = 2048):
        self.shards = manifest.select("folder", "file", "n_tokens").orderBy("shard").collect()
        self.starts = [0]  # sequences of all shards before each one
        for row in self.shards:
            self.starts.append(self.starts[-1] + -(-row["n_tokens"] // length))
        self.length, self.opened, self.files = length, {}, contextlib.ExitStack()

    def __len__(self) -> int:
        return self.starts[-1]

    def __getitem__(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        if not 0 <= i < len(self):
            raise IndexError(f"{i} is not one of {len(self)} sequences")
        number = bisect.bisect_right(self.starts, i) - 1
        batch, row = divmod(i - self.starts[number], ROWS_PER_BATCH)
        tokens, mask = self._shard(number).get_batch(batch).columns
        return tokens[row].values.to_numpy(zero_copy_only=True), mask[row].values

    def _shard(self, number: int) -> pa.ipc.RecordBatchFileReader:
        if number not in self.opened:
            row = self.shards[number]
            shard = pa.ipc.open_file(self.files.enter_context(reading(row["folder"], f"{row['file']}.arrow")))
            if shard.schema.field("tokens").type.list_size != self.length:
                raise ValueError(f"{row['file']} holds no sequences of {self.length} tokens")
            self.opened[number] = shard
        return self.opened[number]

    def close(self) -> None:
        self.opened.clear()
        self.files.close()

    def __enter__(self) -> TokenSequences:
        return self

    def __exit__(self, *error: object) -> None:
        self.close()
