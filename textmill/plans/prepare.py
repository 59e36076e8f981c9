"""Raw splits to packed, sharded, batched model rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from textmill.functions.text import token_count
from textmill.operators.clean import complete_row, inputs_and_targets, label_to_word, without_table
from textmill.operators.dedup import dedup_seq
from textmill.operators.lengths import filter_long, within_limits
from textmill.operators.pack import pack
from textmill.operators.report import row_funnel
from textmill.operators.shard import batch_rows, epoch_order, lay_out, limit_batches, shard_rows
from textmill.operators.splits import make_splits, rename_splits
from textmill.operators.vocab import encode, token_lengths
from textmill.plans.settings import PrepareSettings
from textmill.sources.readers import ROW_ID, pick_splits, read_splits, with_row_id
from textmill.sources.staging import materialize, stage


def prepare_split(df: DataFrame, settings: PrepareSettings, length=token_count) -> DataFrame:
    """Label names, dedupe, clean and length filter of one split, in the fixed order; lazy."""
    if settings.id2label is not None:
        df = label_to_word(df, settings.id2label)
    df = dedup_seq(df, settings.deduplicate_columns, settings.row_id)
    clean = settings.clean
    df = inputs_and_targets(
        df,
        column_dict=clean.column_dict,
        input_template=clean.input_template,
        target_template=clean.target_template,
        remove_html=clean.remove_html,
        pad_punctuation=clean.pad_punctuation,
        drop_tables_flag=clean.drop_tables,
        drop_na_flag=clean.drop_na,
        constants=clean.add_constants,
        keep=clean.keep_columns,
        row_id=settings.row_id,
    )
    if settings.filter_long_sequences:
        n_special = 1 if length is token_count else 0
        df = filter_long(df, settings.input_limit, settings.target_limit, n_special, length)
    return df


def load_splits(spark: SparkSession, settings: PrepareSettings) -> dict[str, DataFrame]:
    """The chosen splits under their final names, each with BIGINT row ids."""
    own_key = settings.row_id if settings.row_id != ROW_ID else None
    raw = settings.raw_data
    if isinstance(raw, Mapping):
        # Names are settled on the paths, so splits that nobody asked for are never read.
        raw = pick_splits(rename_splits(raw, settings.predict_split), settings.splits)
        splits = read_splits(spark, raw, row_id=own_key, **settings.read_options)
    else:
        loaded = read_splits(spark, raw, row_id=own_key, **settings.read_options)
        splits = pick_splits(rename_splits(loaded, settings.predict_split), settings.splits)
    return {name: _with_bigint_id(df, settings.row_id) for name, df in splits.items()}


def _with_bigint_id(df: DataFrame, row_id: str) -> DataFrame:
    if row_id not in df.columns:
        return with_row_id(df, row_id=row_id)
    if df.schema[row_id].dataType.typeName() == "string":
        return df.withColumn(row_id, F.col(row_id).cast("bigint"))
    return df


def prepare_funnel(splits: Mapping[str, DataFrame], settings: PrepareSettings, length=token_count) -> DataFrame:
    """Rows before and after each filter of the preparation: ``(split, stage, rows_in, rows_out)``.

    One aggregate per split over loaded splits; the filters become flags, so nothing is run twice.
    """
    clean = settings.clean
    parts = []
    for name, df in splits.items():
        df = dedup_seq(df, settings.deduplicate_columns, settings.row_id)
        filters = [("drop_na", complete_row(df.schema))] if clean.drop_na else []
        df = prepare_split(
            df,
            replace(
                settings,
                deduplicate_columns=(),
                filter_long_sequences=False,
                clean=replace(clean, drop_na=False, drop_tables=False, keep_columns=None),
            ),
        )
        if clean.drop_tables:
            filters.append(("drop_tables", without_table()))
        if settings.filter_long_sequences:
            n_special = 1 if length is token_count else 0
            limits = within_limits(df.columns, settings.input_limit, settings.target_limit, n_special, length)
            filters.append(("filter_long", limits))
        parts.append(row_funnel(df.withColumn("split", F.lit(name)), filters))
    return reduce(DataFrame.unionByName, parts)


def prepare_text(
    spark: SparkSession,
    settings: PrepareSettings,
    *,
    tokenizer: Callable | None = None,
    staged: bool = True,
    cache: tuple[str, str] | None = None,
) -> dict[str, DataFrame]:
    """All splits with ``input``, ``target`` and the kept columns, sized and sampled.

    Sizing reads row ids, sampling too, and the vocabulary and the encoder read the texts, so each
    prepared split is written once first; ``staged=False`` leaves everything lazy and recomputed.
    ``cache`` is ``(folder, version)``: splits prepared from the same rows under the same settings and
    version are read from the folder instead. Changed rows are noticed by their fingerprint, which
    reads the source once; change the version when the tokenizer changes.
    """
    splits = load_splits(spark, settings)
    length = token_lengths(tokenizer) if tokenizer is not None else token_count
    prepared = {name: prepare_split(df, settings, length) for name, df in splits.items()}
    if cache is not None:
        folder, version = cache
        # Sizes and packing do not change the prepared texts, so runs that differ in them share a cache.
        texts = {
            f: getattr(settings, f)
            for f in ("splits", "predict_split", "id2label", "deduplicate_columns", "clean",
                      "filter_long_sequences", "input_limit", "target_limit", "row_id", "read_options")
        }
        prepared = materialize(prepared, folder, [version, texts], splits)
    elif staged:
        prepared = {name: stage(df, f"split={name}") for name, df in prepared.items()}
    s = settings.split
    return make_splits(
        prepared,
        dev_size=s.dev_size,
        dev_from_train_rows=s.dev_from_train,
        tiny=s.tiny,
        tiny_size=s.tiny_size,
        shots=s.shots,
        overfit=s.overfit,
        predict_size=s.predict_size,
        seed=settings.seed,
        row_id=settings.row_id,
    )


def encode_split(
    df: DataFrame, settings: PrepareSettings, vocab: DataFrame | None = None, tokenizer: Callable | None = None
) -> DataFrame:
    """Add ``input_ids`` and, for a split with targets, ``target_ids``."""
    columns = {"input": "input_ids"}
    if "target" in df.columns:
        columns["target"] = "target_ids"
    return encode(df, columns, vocab, tokenizer=tokenizer, row_id=settings.row_id)


def model_rows(
    df: DataFrame,
    settings: PrepareSettings,
    split: str,
    *,
    vocab: DataFrame | None = None,
    tokenizer: Callable | None = None,
    world: int = 1,
    epoch: int = 0,
    pad_ranks: str = "none",
    limit: int | float | None = None,
    laid_out: bool = False,
) -> DataFrame:
    """One split as the table a training or prediction loop reads.

    Columns: the kept ones, ``idx, rank, pos, batch_id`` and the packed arrays. Train is shuffled by
    epoch, other splits keep row order. Rows are placed while they are still text, so the wide arrays
    are made after the last shuffle. ``laid_out`` brings neighbours of a rank together for
    :func:`textmill.sources.sinks.write_model_rows`.
    """
    predict = split == "predict"
    placed = epoch_order(
        df, seed=settings.seed, epoch=epoch, shuffle=split == "train", row_id=settings.row_id
    )
    placed = batch_rows(shard_rows(placed, world, pad=pad_ranks), settings.batch_size)
    placed = limit_batches(placed, limit)
    if laid_out:
        placed = lay_out(placed, batch_size=settings.batch_size)
    packing = replace(
        settings.pack, predict=predict, prefix=settings.predict_prefix if predict else settings.pack.prefix
    )
    return pack(encode_split(placed, settings, vocab, tokenizer), packing)
