"""Batch prediction, decoding and post-processing."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from uuid import uuid4

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf, pandas_udf
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DataType, IntegerType, StringType, StructField, StructType

from textmill.functions.workers import once_per_worker, runs
from textmill.operators.vocab import RESERVED, ids_to_tokens

# What a decoder tidies up after joining tokens with spaces.
TIDY = (
    (" .", "."), (" ?", "?"), (" !", "!"), (" ,", ","), (" ' ", "'"),
    (" n't", "n't"), (" 'm", "'m"), (" 's", "'s"), (" 've", "'ve"), (" 're", "'re"),
)

Predictor = Callable[..., Sequence]


def batch_predict(
    df: DataFrame,
    factory: Callable[[], Predictor],
    *,
    columns: Sequence[str] = ("input_ids", "attention_mask"),
    out: str = "output_ids",
    return_type: DataType | str = ArrayType(IntegerType()),
    batch_size: int = 8,
    together: Sequence[str] = ("rank", "batch_id"),
    order: str = "pos",
    regroup: bool = False,
) -> DataFrame:
    """Run a model over the rows and append its output.

    ``factory`` is called once per Python worker and returns ``predict(*columns) -> outputs``, which
    gets plain lists of at most ``batch_size`` rows (of id arrays or of texts). Where the table has
    the columns ``together``, a list is one loader batch of a partition, in ``order``, or a part of it if
    it has more than ``batch_size`` rows, so that arrays padded for a loader's batch have one length.
    Rows are sorted inside their partition for that, and a batch that one Arrow batch begins is held back until
    the next ones have completed it. Rows that :func:`textmill.operators.shard.lay_out` or ``model_rows`` brought together
    stay where they are; ``regroup`` shuffles them by loader batch first, for tables whose batches lie
    in several partitions.
    """
    key = uuid4()
    loader = [c for c in together if c in df.columns]
    loader = loader if len(loader) == len(together) else []
    if loader:
        df = df.repartition(*loader) if regroup else df
        df = df.sortWithinPartitions(*loader, *([order] if order in df.columns else []))
    kind = DataType.fromDDL(return_type) if isinstance(return_type, str) else return_type
    schema = StructType([*(f for f in df.schema.fields if f.name != out), StructField(out, kind)])
    arrow = to_arrow_schema(StructType([schema[out]])).field(0).type
    names = list(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = once_per_worker(key, factory)
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for first, rows in runs(batch.num_rows, batch.nbytes):
                held.append(batch.slice(first, rows))
                ready, rest = _whole_lists(pa.Table.from_batches(held).combine_chunks(), loader, batch_size, last=False)
                yield from _predicted(ready, predict, names, out, arrow)
                held = rest
        if held:
            ready, _ = _whole_lists(pa.Table.from_batches(held).combine_chunks(), loader, batch_size, last=True)
            yield from _predicted(ready, predict, names, out, arrow)

    return df.mapInArrow(run, schema)


def _whole_lists(table: pa.Table, loader: list[str], size: int, last: bool) -> tuple[list[pa.RecordBatch], list[pa.RecordBatch]]:
    """Lists of at most ``size`` rows of one loader batch, and the rows that may belong with the next Arrow batch."""
    batch = table.to_batches()[0]
    turns = [0]
    if loader:
        keys = list(zip(*(batch.column(c).to_pylist() for c in loader)))
        turns += [i for i in range(1, len(keys)) if keys[i] != keys[i - 1]]
    turns.append(batch.num_rows)
    lists = [(a, min(a + size, stop)) for start, stop in zip(turns, turns[1:]) for a in range(start, stop, size)]
    # Of the last loader batch more rows may come, unless the list is full.
    open_ = [] if last or lists[-1][1] - lists[-1][0] == size else [lists.pop()]
    return [batch.slice(a, b - a) for a, b in lists], [batch.slice(a, b - a) for a, b in open_]


def _predicted(lists: list[pa.RecordBatch], predict: Predictor, names: list[str], out: str, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    for some in lists:
        result = list(predict(*(some.column(c).to_pylist() for c in names)))
        if len(result) != some.num_rows:
            raise ValueError("the predictor returned another number of outputs than inputs")
        kept = [c for c in some.schema.names if c != out]
        yield pa.RecordBatch.from_arrays([*(some.column(c) for c in kept), pa.array(result, kind)], names=[*kept, out])


def tidy_text(text: Column) -> Column:
    """Remove the spaces that joining tokens left before punctuation and contractions."""
    for spaced, tidy in TIDY:
        text = F.replace(text, F.lit(spaced), F.lit(tidy))
    return text


def decode_output(
    df: DataFrame,
    vocab: DataFrame | None = None,
    *,
    decoder: Callable[[], Callable[[list[list[int]]], list[str]]] | None = None,
    output: str = "output_ids",
    input_ids: str = "input_ids",
    out: str = "prediction",
    special: Sequence[int] = tuple(range(len(RESERVED))),
    strip_prompt: bool = True,
    tidy: bool = True,
    row_id: str = "_row_id",
) -> DataFrame:
    """Output ids as text: cut the prompt, drop special ids, join tokens, tidy.

    ``strip_prompt`` cuts as many ids as the padded input has; switch it off for encoder-decoder output.
    ``decoder`` is a factory, called once per Python worker, of a function from id lists to texts; it
    replaces the vocabulary for a user tokenizer.
    """
    ids = F.col(output)
    if strip_prompt:
        ids = F.slice(ids, F.size(input_ids) + 1, F.size(ids))
    ids = F.filter(ids, lambda x: ~x.isin([int(i) for i in special]))
    if decoder is not None:
        text = _decoder_udf(decoder)(ids)
    elif vocab is not None:
        df = ids_to_tokens(df.withColumn("_ids", ids), "_ids", vocab, row_id)
        text = F.array_join("_ids", " ")
    else:
        raise ValueError("decode_output needs a vocabulary or a decoder")
    return df.withColumn(out, tidy_text(text) if tidy else text).drop("_ids")


def _decoder_udf(factory: Callable[[], Callable[[list[list[int]]], list[str]]]):
    key = uuid4()

    @arrow_udf(StringType())
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decode = once_per_worker(key, factory)
        for batch in batches:
            texts = []
            for first, rows in runs(len(batch), batch.nbytes):
                texts += decode([ids or [] for ids in batch.slice(first, rows).to_pylist()])
            yield pa.array(texts, pa.string())

    return run


_POSTPROCESSORS: dict[str, Callable[[Column], Column]] = {"identity": lambda text: text}


def register_postprocessor(name: str, function: Callable[[Column], Column]) -> None:
    """Add a named ``Column -> Column`` step; a pandas UDF on strings qualifies."""
    _POSTPROCESSORS[name] = function


def register_python_postprocessor(name: str, function: Callable[[str], str]) -> None:
    """Add a named ``str -> str`` step, run over Arrow batches. Prefer a column expression where one exists."""

    @pandas_udf(StringType())
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(function, na_action="ignore")

    _POSTPROCESSORS[name] = run


def postprocess(df: DataFrame, name: str = "identity", column: str = "prediction") -> DataFrame:
    """Apply a registered post-processing step to the predictions."""
    if name not in _POSTPROCESSORS:
        raise ValueError(f"unknown post-processor {name!r}; there are {sorted(_POSTPROCESSORS)}")
    return df.withColumn(column, _POSTPROCESSORS[name](F.col(column)))


def carry_columns(df: DataFrame, *, prediction: str = "prediction", numbers: bool = True) -> DataFrame:
    """``prediction`` first, then every column that is not an array.

    ``numbers=False`` drops numeric and boolean columns too, as a loader does that turns them into tensors.
    """
    tensors = {"array"}
    if not numbers:
        tensors |= {"byte", "short", "integer", "long", "float", "double", "decimal", "boolean"}
    carried = [
        f.name for f in df.schema.fields if f.name != prediction and f.dataType.typeName() not in tensors
    ]
    return df.select(prediction, *[f"`{c}`" for c in carried])


def merge_ranks(spark, path: str, schema=None, order: Sequence[str] = ("rank", "batch_id", "pos")) -> DataFrame:
    """All ranks' prediction files as one table, rank by rank; order by the row id for input order."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.json(path)
    by = [c for c in order if c in df.columns]
    return df.orderBy(*by) if by else df
