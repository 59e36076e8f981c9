"""Row and column preparation. Every step is row-local: no shuffle, and it runs on a stream as well."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructType

from textmill.functions.text import pad_punct, render_expr, strip_html
from textmill.sources.staging import SHIP_BYTES, SHIP_ROWS

LITERAL_LABELS = 256  # a larger label map is joined as a table


def label_to_word(
    df: DataFrame,
    id2label: Mapping[int, str] | Sequence[str] | DataFrame,
    label: str = "label",
    out: str = "word_label",
) -> DataFrame:
    """Add the name of each class label; an id without a name is an error.

    A small map becomes a literal. A large one, or a ``(id, name)`` DataFrame, is joined: broadcast if
    it is counted to be small, so that a frequent label costs nothing, else as a shuffle join, where
    adaptive execution splits a frequent label. Either way the ids are compared as values of the label's type.
    """
    unknown = F.raise_error(F.concat(F.lit("unknown label: "), F.col(label).cast("string")))
    if not isinstance(id2label, DataFrame):
        pairs = list(id2label.items() if isinstance(id2label, Mapping) else enumerate(id2label))
        if len(pairs) <= LITERAL_LABELS:
            kind = df.schema[label].dataType
            names = F.create_map(*(x for key, word in pairs for x in (F.lit(key).cast(kind), F.lit(word))))
            return df.withColumn(out, F.coalesce(F.try_element_at(names, F.col(label)), unknown))
        id2label = df.sparkSession.createDataFrame([(str(k), w) for k, w in pairs], "_label string, _word string")
    # One row for each id, so that no row of the table is joined twice.
    names = id2label.toDF("_label", "_word").withColumn("_label", F.col("_label").cast(df.schema[label].dataType))
    clash = F.raise_error(F.concat(F.lit("two names for label "), F.first("_label").cast("string")))
    word = F.when(F.min("_word").eqNullSafe(F.max("_word")), F.min("_word")).otherwise(clash)
    names = names.groupBy("_label").agg(word.alias("_word"))
    rows, size = names.agg(F.count(F.lit(1)), F.sum(F.octet_length("_word"))).first()
    if rows <= SHIP_ROWS and (size or 0) <= SHIP_BYTES:
        names = F.broadcast(names)
    return (
        df.join(names, F.col(label) == F.col("_label"), "left")
        .withColumn(out, F.coalesce(F.col("_word"), unknown))
        .drop("_label", "_word")
    )


def complete_row(schema: StructType, columns: Iterable[str] | None = None) -> Column:
    """True where no column is null or the empty string. White space, NaN and empty arrays count as data."""
    wanted = set(schema.fieldNames() if columns is None else columns)
    keep = F.lit(True)
    for field in schema.fields:
        if field.name in wanted:
            value = F.col(f"`{field.name}`")
            keep = keep & value.isNotNull()
            if isinstance(field.dataType, StringType):
                keep = keep & (value != "")
    return keep


def drop_na(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Drop a row if any column (or any of ``columns``) is null or the empty string."""
    return df.filter(complete_row(df.schema, columns))


def add_constants(df: DataFrame, constants: Mapping[str, object]) -> DataFrame:
    """Add literal columns; run it after :func:`drop_na`."""
    return df.withColumns({name: F.lit(value) for name, value in constants.items()}) if constants else df


def render(df: DataFrame, out: str, template: str, columns: str | Sequence[str]) -> DataFrame:
    """Fill ``template`` from ``columns``; an existing ``out`` column is replaced."""
    names = [columns] if isinstance(columns, str) else list(columns)
    return df.withColumn(out, render_expr(df.schema, template, names))


def clean_text(
    df: DataFrame, columns: Iterable[str], *, remove_html: bool = True, pad_punctuation: bool = False
) -> DataFrame:
    """Strip HTML and pad punctuation, in this order, in the given text columns."""
    changed = {}
    for name in columns:
        text = F.col(name)
        text = strip_html(text) if remove_html else text
        changed[name] = pad_punct(text) if pad_punctuation else text
    return df.withColumns(changed) if changed and (remove_html or pad_punctuation) else df


def without_table(column: str = "input") -> Column:
    """True where the lower-cased text has no literal ``<table>``."""
    return ~F.contains(F.lower(F.col(column)), F.lit("<table>"))


def drop_tables(df: DataFrame, column: str = "input") -> DataFrame:
    """Drop rows with a ``<table>`` tag. It can only act on text whose tags were left in."""
    return df.filter(without_table(column))


def keep_columns(df: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """Only the listed columns that exist, in table order; all of them by default."""
    if names is None:
        return df
    wanted = set(names)
    return df.select(*[f"`{c}`" for c in df.columns if c in wanted])


def inputs_and_targets(
    df: DataFrame,
    *,
    column_dict: Mapping[str, str | Sequence[str]] | None = None,
    input_template: str = "{}",
    target_template: str = "{}",
    remove_html: bool = True,
    pad_punctuation: bool = False,
    drop_tables_flag: bool = True,
    drop_na_flag: bool = True,
    constants: Mapping[str, object] | None = None,
    keep: Iterable[str] | None = None,
    na_columns: Iterable[str] | None = None,
    row_id: str | None = None,
) -> DataFrame:
    """The whole preparation of one split, in its fixed order.

    ``na_columns`` narrows the null check, and with it the scan; by default every column counts.
    ``row_id`` is kept beside the listed columns.
    """
    roles = column_dict or {"inputs": ["text"], "target": "label"}
    if drop_na_flag:
        df = drop_na(df, na_columns)
    df = add_constants(df, constants or {})
    df = render(df, "input", input_template, roles["inputs"])
    texts = ["input"]
    if "target" in roles:
        df = render(df, "target", target_template, roles["target"])
        texts.append("target")
    df = clean_text(df, texts, remove_html=remove_html, pad_punctuation=pad_punctuation)
    # Once tags are stripped, or spaced out by punctuation padding, no text can hold "<table>".
    # Leaving the filter out then saves a second run of the same patterns below the projection.
    if drop_tables_flag and not (remove_html or pad_punctuation):
        df = drop_tables(df)
    if keep is not None and row_id is not None:
        keep = [*keep, row_id]
    return keep_columns(df, keep)
