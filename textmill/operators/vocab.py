"""Corpus vocabulary, encoding and decoding."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType
from pyspark.sql.window import Window

from textmill.functions.keys import required
from textmill.functions.text import tokens
from textmill.functions.workers import once_per_worker, runs
from textmill.operators.ranks import number_by_order, rank_cut
from textmill.sources.staging import SHIP_BYTES, SHIP_ROWS, stage

# Reserved ids, fixed.
UNK, BOS, EOS = 0, 1, 2
RESERVED = ("<unk>", "<bos>", "<eos>")

# Tokens that hold more than one in this many are looked up apart from the rest.
HOT_SHARE = 1_000
HOT_BYTES = 4_096  # and are at most this long, so that the hot table is at most 4 MB
WARM_BYTES = 64  # so short, a hundredth of that share is enough: at most 100,000 tokens and 6.4 MB more
# Up to this many rows in one reducer the top tokens are taken directly.
TOP_ROWS = 5_000_000

Tokenizer = Callable[[list[str]], list[list[int]]]


def build_vocab(df: DataFrame, columns: str | list[str], size: int, *, staged: bool = True, direct_rows: int | None = None) -> DataFrame:
    """The ``size`` most frequent tokens as ``(token, id, freq)``, ties in token order.

    Ids 0, 1, 2 are the reserved unknown, begin and end tokens with frequency 0. Counting combines
    on the map side, so frequent tokens do not skew it. The result is written once by default:
    encoding reads it more than once, and counting the corpus again would be wasteful.

    Where reducers would hold more than ``direct_rows`` rows (``TOP_ROWS``), the last token is found by histograms of the
    counts and, among equal counts, of the tokens' leading bytes, and ids are numbered inside ranges.
    """
    names = [columns] if isinstance(columns, str) else columns
    texts = F.array(*(F.coalesce(tokens(F.col(c)), F.array().cast("array<string>")) for c in names))
    counts = (
        df.select(F.explode(F.flatten(texts)).alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("freq"))
    )
    reducers = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = TOP_ROWS if direct_rows is None else direct_rows
    if size * reducers <= most:
        top = counts.orderBy(F.desc("freq"), "token").limit(size)
        place = F.row_number().over(Window.orderBy(F.desc("freq"), "token")) - 1  # of few rows
        placed = top.withColumn("place", place)
    else:
        counts = stage(counts.withColumn("less", -F.col("freq")), "token-counts")
        keep = rank_cut(counts, F.col("less"), [F.col("token")], size, direct_rows)
        placed = number_by_order(counts.filter(keep), ["less", "token"], "place", "_n")
    ranked = placed.select("token", (F.col("place") + len(RESERVED)).cast("int").alias("id"), "freq")
    values = ", ".join(f"('{token}', {i}, 0L)" for i, token in enumerate(RESERVED))
    reserved = df.sparkSession.sql(f"SELECT * FROM VALUES {values} AS reserved(token, id, freq)")
    vocab = reserved.unionByName(ranked)
    return stage(vocab, "vocab") if staged else vocab


def shippable(vocab: DataFrame) -> bool:
    """Whether the vocabulary is within ``SHIP_ROWS`` and ``SHIP_BYTES``; measured, not assumed."""
    rows, size = vocab.agg(F.count(F.lit(1)), F.sum(F.octet_length("token"))).first()
    return rows <= SHIP_ROWS and (size or 0) <= SHIP_BYTES


def encode(
    df: DataFrame,
    columns: Mapping[str, str],
    vocab: DataFrame | None = None,
    *,
    tokenizer: Callable[[], Tokenizer] | None = None,
    row_id: str = "_row_id",
) -> DataFrame:
    """Add an id array for each ``{text column: id column}``; tokens not in ``vocab`` become 0.

    A vocabulary that is small enough (checked) goes to the tasks once, and whole Arrow batches of
    tokens are looked up there: no shuffle at all. A larger one is joined, see :func:`encode_by_join`.
    ``tokenizer`` is a factory that is called once per Python worker and replaces tokens and vocabulary.
    """
    if tokenizer is not None:
        ids = _tokenizer_udf(tokenizer)
        return df.withColumns({out: ids(F.col(text)) for text, out in columns.items()})
    if vocab is None:
        raise ValueError("encode needs a vocabulary or a tokenizer")
    if not shippable(vocab):
        return encode_by_join(df, columns, vocab, row_id)
    lookup = _lookup_udf(df, vocab)
    return df.withColumns({out: lookup(tokens(F.col(text))) for text, out in columns.items()})


def _lookup_udf(df: DataFrame, vocab: DataFrame):
    table = vocab.filter(F.col("id") >= len(RESERVED)).select("token", "id").toArrow()
    shared = df.sparkSession.sparkContext.broadcast(
        (table["token"].combine_chunks(), table["id"].combine_chunks())
    )
    key = uuid4()

    @arrow_udf(ArrayType(IntegerType(), False))
    def lookup(batch: pa.Array) -> pa.Array:
        known = once_per_worker(key, lambda: _dictionary(shared.value))
        return _lists(batch, _looked_up(known, batch.flatten(), UNK, pa.int32()))

    return lookup


def _dictionary(columns: tuple[pa.Array, pa.Array]) -> dict:
    return dict(zip(*(c.to_pylist() for c in columns)))


def _looked_up(known: dict, values: pa.Array, default, kind: pa.DataType) -> pa.Array:
    """The entry of every value; each distinct value of a run is looked up once."""
    out = []
    for first, rows in runs(len(values), values.nbytes):
        distinct = values.slice(first, rows).dictionary_encode()
        found = pa.array([known.get(v, default) for v in distinct.dictionary.to_pylist()], kind)
        out.append(pc.take(found, distinct.indices))
    return pa.concat_arrays(out) if out else pa.array([], kind)


def _lists(like: pa.Array, flat: pa.Array) -> pa.Array:
    """``flat`` cut into lists of the lengths of ``like``; null lists stay null."""
    lengths = pc.fill_null(pc.list_value_length(like), 0)
    ends = pc.cumulative_sum(lengths.cast(pa.int32()))
    offsets = pa.concat_arrays([pa.array([0], pa.int32()), ends])
    mask = like.is_null() if like.null_count else None
    return pa.ListArray.from_arrays(offsets, flat, mask=mask)


def encode_by_join(
    df: DataFrame, columns: Mapping[str, str], vocab: DataFrame, row_id: str = "_row_id"
) -> DataFrame:
    """Encode against a vocabulary of any size, by joins, see :func:`_values_by_join`."""
    known = vocab.filter(F.col("id") >= len(RESERVED)).select("token", "id")
    lists = {out: tokens(F.col(text)) for text, out in columns.items()}
    return _values_by_join(df, lists, known, row_id, ArrayType(IntegerType(), False), UNK)


def _values_by_join(
    df: DataFrame, lists: Mapping[str, Column], table: DataFrame, row_id: str, kind: ArrayType, default=None
) -> DataFrame:
    """``df`` with an array for each of ``lists``: the value that ``table`` (key, value) has for each of the list's keys.

    The distinct keys are joined with the table first, one row per key on both sides. Keys that hold more than
    1/``HOT_SHARE`` of all occurrences, and short ones that hold more than 1/(100 * ``HOT_SHARE``), are at most that
    many: they are broadcast and looked up in whole Arrow batches, where they stand. Only the other occurrences become
    rows, of place and key, and are rare enough for a shuffle join; those that the table knows are regrouped by row,
    joined to the full rows once, and put in their places. Rows of one id, as padded ranks have them, hold the same
    lists. A null list stays null; a key that the table lacks has the ``default``.
    """
    key, value = table.columns
    found = df.select(required(row_id).alias("row"), F.array(*lists.values()).alias("lists"))
    counts = stage(
        found.select(F.explode(F.flatten(F.filter("lists", lambda x: x.isNotNull()))).alias(key))
        .groupBy(key).agg(F.count(F.lit(1)).alias("n")).join(table, key, "left"),
        "key-values",
    )
    occurrences = counts.agg(F.sum("n")).first()[0] or 0
    size = F.octet_length(F.col(key).cast("string"))
    hot = ((F.col("n") * HOT_SHARE > occurrences) & (size <= HOT_BYTES)) | (
        (F.col("n") * (100 * HOT_SHARE) > occurrences) & (size <= WARM_BYTES)
    )
    hot = F.coalesce(hot, F.lit(False))
    common = counts.filter(hot).select(key, value).toArrow()
    shared = df.sparkSession.sparkContext.broadcast(tuple(c.combine_chunks() for c in common.columns))
    worker_key = uuid4()

    def place_of(flat: pa.Array) -> pa.Array:
        """The row of each key among the broadcast ones; null for the others."""
        known = once_per_worker(worker_key, lambda: {k: i for i, k in enumerate(shared.value[0].to_pylist())})
        return _looked_up(known, flat, None, pa.int32())

    rare_type = ArrayType(StructType([StructField("pos", IntegerType(), False), StructField("key", table.schema[key].dataType)]), False)

    def rare_of(batch: pa.Array) -> pa.Array:
        flat = batch.flatten()
        apart = np.asarray(place_of(flat).is_null())
        ends = _ends(batch)
        position = np.arange(len(flat)) - np.repeat(ends[:-1], np.diff(ends))
        kept = np.concatenate([[0], np.cumsum(apart)])[ends]
        items = [pa.array(position[apart], pa.int32()), flat.filter(pa.array(apart))]
        return pa.ListArray.from_arrays(pa.array(kept, pa.int32()), pa.StructArray.from_arrays(items, ["pos", "key"]))

    def placed_in(batch: pa.Array, hits: pa.Array) -> pa.Array:
        flat, more = batch.flatten(), hits.flatten()
        position, values = more.field(0), more.field(1)
        starts = np.repeat(_ends(batch)[:-1], np.diff(_ends(hits)))
        hot_values = shared.value[1]
        where = pc.fill_null(place_of(flat).cast(pa.int64()), len(hot_values)).to_numpy(zero_copy_only=False).copy()
        where[starts + position.to_numpy(zero_copy_only=False)] = len(hot_values) + 1 + np.arange(len(more))
        every = pa.concat_arrays([hot_values, pa.nulls(1, hot_values.type), values.cast(hot_values.type)])
        out = pc.take(every, pa.array(where))
        return _lists(batch, out if default is None else pc.fill_null(out, default))

    def in_runs(make: Callable[..., pa.Array], *columns: pa.Array) -> pa.Array:
        cut = list(runs(len(columns[0]), sum(c.nbytes for c in columns))) or [(0, 0)]
        return pa.concat_arrays([make(*(c.slice(first, rows) for c in columns)) for first, rows in cut])

    @arrow_udf(rare_type)
    def rare(batch: pa.Array) -> pa.Array:
        return in_runs(rare_of, batch)

    @arrow_udf(kind)
    def placed(batch: pa.Array, hits: pa.Array) -> pa.Array:
        return in_runs(placed_in, batch, hits)

    texts = [F.struct(F.lit(k).alias("out"), rare(x).alias("rare")) for k, x in enumerate(lists.values())]
    others = (
        df.select(required(row_id).alias("row"), F.explode(F.array(*texts)).alias("text"))
        .select("row", "text.out", F.explode("text.rare").alias("at"))
        .select("row", "out", "at.pos", F.col("at.key").alias(key))
    )
    hits = others.join(counts.filter(~hot & F.col(value).isNotNull()).select(key, value), key)
    names = [f"_hits_{k}" for k in range(len(lists))]
    at = F.struct(F.col("pos"), F.col(value).alias("value"))
    grouped = hits.groupBy(F.col("row").alias(row_id)).agg(
        *(F.collect_list(F.when(F.col("out") == k, at)).alias(name) for k, name in enumerate(names))
    )
    joined = df.join(grouped, row_id, "left")
    return joined.withColumns({out: placed(x, F.col(name)) for (out, x), name in zip(lists.items(), names)}).drop(*names)


def _ends(lists: pa.Array) -> np.ndarray:
    """Where each list begins among the flattened items, and where the last one ends."""
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])


def _tokenizer_udf(factory: Callable[[], Tokenizer]):
    key = uuid4()

    @arrow_udf(ArrayType(IntegerType(), False))
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokenizer = once_per_worker(key, factory)
        for batch in batches:
            made = []
            for first, rows in runs(len(batch), batch.nbytes):
                texts = batch.slice(first, rows).to_pylist()
                ids = tokenizer(["" if t is None else t for t in texts])
                made.append(pa.array([None if t is None else i for t, i in zip(texts, ids)], pa.list_(pa.int32())))
            yield pa.concat_arrays(made) if made else pa.array([], pa.list_(pa.int32()))

    return run


def token_lengths(factory: Callable[[], Tokenizer]) -> Callable[[Column], Column]:
    """A length function for the length filter that counts a user tokenizer's ids and returns only the count."""
    key = uuid4()

    @arrow_udf(IntegerType())
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokenizer = once_per_worker(key, factory)
        for batch in batches:
            lengths = []
            for first, rows in runs(len(batch), batch.nbytes):
                texts = ["" if t is None else t for t in batch.slice(first, rows).to_pylist()]
                lengths += [len(ids) for ids in tokenizer(texts)]
            yield pa.array(lengths, pa.int32())

    return count


def ids_to_tokens(df: DataFrame, column: str, vocab: DataFrame, row_id: str = "_row_id") -> DataFrame:
    """Replace an id array by the array of its tokens; ids outside the vocabulary are dropped."""
    if not shippable(vocab):
        return _tokens_by_join(df, column, vocab, row_id)
    table = vocab.select("id", "token").toArrow()
    shared = df.sparkSession.sparkContext.broadcast(
        (table["id"].combine_chunks(), table["token"].combine_chunks())
    )
    key = uuid4()

    @arrow_udf("array<string>")
    def lookup(batch: pa.Array) -> pa.Array:
        known = once_per_worker(key, lambda: _dictionary(shared.value))
        return _lists(batch, _looked_up(known, batch.flatten(), None, pa.string()))

    return df.withColumn(column, F.filter(lookup(F.col(column)), lambda t: t.isNotNull()))


def _tokens_by_join(df: DataFrame, column: str, vocab: DataFrame, row_id: str) -> DataFrame:
    named = _values_by_join(df, {"_tokens": F.col(column)}, vocab.select("id", "token"), row_id, ArrayType(StringType()))
    return named.withColumn(column, F.filter("_tokens", lambda t: t.isNotNull())).drop("_tokens")
