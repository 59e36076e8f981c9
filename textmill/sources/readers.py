"""Split readers: CSV, JSON, stored tables and DataFrames become ``{split name: DataFrame}``."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, StructType

from textmill.operators.ranks import number_by_order, number_in_files
from textmill.sources.csv_split import read_csv_split
from textmill.sources.staging import path_exists

ROW_ID = "_row_id"

# The cell texts that a pandas-style CSV reader takes as missing.
CSV_MISSING = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_splits(
    spark: SparkSession,
    raw_data: str | DataFrame | Mapping[str, str | DataFrame],
    splits: Iterable[str] | None = None,
    schema: StructType | str | None = None,
    *,
    row_id: str | None = None,
    multi_line: bool = True,
    infer_schema: bool = False,
    missing: Iterable[str] = CSV_MISSING,
    split_files: bool = False,
) -> dict[str, DataFrame]:
    """Load the splits of ``raw_data``.

    * a mapping ``split -> path``: CSV if the first path contains ``csv``, else JSON if it contains
      ``json`` (see :func:`read_json_columns`);
    * a mapping ``split -> DataFrame``, or one DataFrame, which becomes ``train``;
    * a string: a table with a ``split`` column, or a folder of ``split=*`` parquet.

    ``row_id`` names a unique BIGINT column that gives the row order. Without one, files get
    ``_row_id`` from their path and position, which costs one ordered write; tables and DataFrames
    need it only when a later step asks for an order. ``splits`` picks the splits to load.
    """
    if isinstance(raw_data, DataFrame):
        return pick_splits({"train": raw_data}, splits)
    if isinstance(raw_data, str):
        return pick_splits(_stored_splits(spark, raw_data), splits)
    if not isinstance(raw_data, Mapping) or not raw_data:
        raise ValueError("raw_data must be a table name, a folder, a DataFrame or a non-empty mapping")

    first = next(iter(raw_data.values()))
    chosen = pick_splits(raw_data, splits)
    if all(isinstance(v, DataFrame) for v in raw_data.values()):
        return chosen
    if not all(isinstance(v, str) for v in raw_data.values()):
        raise ValueError("a raw_data mapping holds either paths or DataFrames")
    if "csv" in first:
        return {
            name: read_csv(
                spark, path, schema, row_id=row_id, multi_line=multi_line,
                infer_schema=infer_schema, missing=missing, split_files=split_files,
            )
            for name, path in chosen.items()
        }
    if "json" in first:
        return {
            name: (read_json_lines if path.rstrip("/").endswith(".jsonl") else read_json_columns)(
                spark, path, schema, row_id=row_id
            )
            for name, path in chosen.items()
        }
    raise ValueError(f"cannot tell the format of {first!r}: the path must contain 'csv' or 'json'")


def with_row_id(df: DataFrame, by: Iterable[str] | None = None, row_id: str = ROW_ID) -> DataFrame:
    """Add dense row ids in the order of the columns ``by``, unique together.

    Without ``by`` the order is that of the files the table is read from: path, then position. Tables
    that do not come from files need ``by``, and are written once in that order.
    """
    if by is not None:
        return number_by_order(df, list(by), row_id, "_n").drop("_n")
    try:
        placed = _with_file_order(df, None)
    except AnalysisException as error:
        raise ValueError("a table that is not read from files needs `by` columns for its order") from error
    return number_in_files(placed, ["_path", "_start"], "_seen", [], row_id).drop(*_ORDER)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal the rows of a table with fewer scan tasks than cores to all cores, by ``key``.

    Text work is bound by the CPU, and a small file with one row group is one task. A table that
    already fills the cluster is returned as it is, so no large table is shuffled here.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def pick_splits(table: Mapping[str, object], splits: Iterable[str] | None) -> dict:
    """The chosen splits, in the chosen order; all of them by default."""
    if splits is None:
        return dict(table)
    wanted = list(splits)
    unknown = [name for name in wanted if name not in table]
    if unknown:
        raise ValueError(f"unknown splits {unknown}; there are {list(table)}")
    return {name: table[name] for name in wanted}


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    *,
    row_id: str | None = None,
    multi_line: bool = True,
    infer_schema: bool = False,
    missing: Iterable[str] = CSV_MISSING,
    split_files: bool = False,
) -> DataFrame:
    """Comma-separated text with a header, RFC 4180 quoting.

    ``multi_line`` allows line breaks inside quotes and makes each file one task; switch it off for
    big files without such breaks so that they can be split. ``split_files`` splits big files with such
    breaks, at the price of further scans. Empty cells and the ``missing`` texts are null.
    """
    if split_files:
        if infer_schema:
            raise ValueError("split files need a schema for types other than strings")
        return read_csv_split(spark, path, schema, row_id=row_id, missing=missing, out=ROW_ID)
    reader = spark.read.options(
        header=True, sep=",", quote='"', escape='"', multiLine=multi_line, inferSchema=infer_schema,
        emptyValue="", mode="FAILFAST",
    )
    df = (reader.schema(schema) if schema is not None else reader).csv(path)
    absent = ["", *missing]
    df = _with_file_order(df, row_id)
    nulled = {
        f.name: F.when(~F.col(f"`{f.name}`").isin(absent), F.col(f"`{f.name}`"))
        for f in df.schema.fields
        if f.dataType.typeName() == "string" and f.name not in _ORDER
    }
    return _number_files(df.withColumns(nulled) if nulled else df, row_id)


def read_json_columns(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    *,
    row_id: str | None = None,
) -> DataFrame:
    """Files that hold one object of columns each, ``{"a": [..], "b": [..]}``.

    One object is parsed by one task, so this form suits many moderate files; use JSON lines for big
    ones. Columns of different length are an error. ``schema`` is the schema of the rows.
    """
    reader = spark.read.options(multiLine=True, recursiveFileLookup=True, mode="FAILFAST")
    if schema is not None:
        row = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        columns = StructType()
        for field in row.fields:
            columns.add(field.name, ArrayType(field.dataType))
        reader = reader.schema(columns)
    objects = reader.json(path)
    _refuse_json_lines(spark, path)
    names = objects.columns
    not_lists = [f.name for f in objects.schema.fields if not isinstance(f.dataType, ArrayType)]
    if not_lists:
        raise ValueError(f"not an object of columns; these are not lists: {not_lists}")
    lengths = [F.coalesce(F.size(F.col(f"`{n}`")), F.lit(-1)) for n in names]
    uneven = F.array_size(F.array_distinct(F.array(*lengths))) > 1
    checked = F.when(
        uneven, F.raise_error(F.lit("the columns of a JSON object differ in length"))
    ).otherwise(F.arrays_zip(*(F.col(f"`{n}`") for n in names)))
    df = _with_file_order(objects.select(checked.alias("rows")), row_id)
    df = df.select("*", F.posexplode("rows").alias("_position", "row")).drop("rows")
    df = df.select(*[c for c in df.columns if c != "row"], "row.*")
    if row_id is not None:
        return df.drop("_position")
    return number_in_files(df, ["_path", "_start"], "_seen", ["_position"], ROW_ID).drop(*_ORDER, "_position")


def _refuse_json_lines(spark: SparkSession, path: str) -> None:
    """An error if a file has more than one root value: only the first of them would be read."""
    lines = spark.read.option("recursiveFileLookup", True).text(path).filter(F.trim("value") != "")
    whole = F.from_json(F.when(F.trim("value").rlike(r"^\{.*\}$"), F.col("value")), "map<string,string>").isNotNull()
    counts = lines.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("n"), F.count_if(whole).alias("whole"))
    found = counts.filter("n > 1 AND whole = n").head()
    if found is not None:
        raise ValueError(f"{found.file} has {found.n} JSON objects; read it as JSON lines")
    # In brackets, one root value is a list of one; two of them without a comma are no list at all.
    whole = spark.read.text(path, wholetext=True, recursiveFileLookup=True).filter(F.trim("value") != "")
    roots = F.coalesce(F.size(F.from_json(F.concat(F.lit("["), F.col("value"), F.lit("]")), "array<string>")), F.lit(0))
    found = whole.filter(roots != 1).select(F.col("_metadata.file_path").alias("file")).head()
    if found is not None:
        raise ValueError(f"{found.file} has more than one root value or is not JSON")


def read_json_lines(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    *,
    row_id: str | None = None,
) -> DataFrame:
    """One row object per line: the JSON form that splits and scales."""
    reader = spark.read.option("mode", "FAILFAST")
    df = (reader.schema(schema) if schema is not None else reader).json(path)
    return _number_files(_with_file_order(df, row_id), row_id)


# File position of a row: path, start of the read block, order within the task.
_ORDER = ("_path", "_start", "_seen")


def _with_file_order(df: DataFrame, row_id: str | None) -> DataFrame:
    if row_id is not None:
        return df
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_seen"),
    )


def _number_files(df: DataFrame, row_id: str | None) -> DataFrame:
    if row_id is not None:
        return df
    return number_in_files(df, ["_path", "_start"], "_seen", [], ROW_ID).drop(*_ORDER)


def _stored_splits(spark: SparkSession, name: str) -> dict[str, DataFrame]:
    """Splits of a stored table. Only the split names are read here; rows stay partition-pruned."""
    if path_exists(spark, name):
        df = spark.read.parquet(name)
    elif "/" not in name and spark.catalog.tableExists(name):
        df = spark.table(name)
    else:
        raise ValueError(f"no table and no folder named {name!r}")
    if "split" not in df.columns:
        return {"train": df}
    # The result is a dictionary by name, so the names come to the driver; rows do not.
    names = sorted(row[0] for row in df.filter("split IS NOT NULL").select("split").distinct().collect())
    return {n: df.filter(F.col("split") == n).drop("split") for n in names}
