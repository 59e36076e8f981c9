"""Inputs that several queries share, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from textmill.functions.keys import hash_key
from textmill.sources.readers import spread

# Patterns in the syntax of the SQL engine.
SQL_TOKEN = r"\p{L}+|\p{N}+|[^\t-\r \p{L}\p{N}]"
SQL_SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
SQL_VISIBLE = SQL_SPACE.replace("[", "[^", 1)
SQL_PUNCTUATION = r"([!\"#$%&''()*+,\-./:;<=>?@\[\]^_`{|}~])"

VOCAB = 5000


# Tables of long texts and the key that spreads them over the cores when the file is small.
TEXT_TABLES = {"documents": "doc_id", "pages": "page_id", "conversations": "text"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df, TEXT_TABLES[name]) if name in TEXT_TABLES else df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").withColumnRenamed("doc_id", "_row_id")


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns with the assistant turn that follows; the join key is unique on both sides."""
    turns = table(spark, sf_dir, "conversations")
    asked = turns.filter("role = 'user'").select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("question"))
    answered = turns.filter("role = 'assistant'").select("conv_id", "turn", F.col("text").alias("answer"))
    row_id = (F.col("conv_id") * F.lit(1 << 32) + F.col("turn")).alias("_row_id")
    return asked.join(answered, ["conv_id", "turn"]).select(row_id, "conv_id", "turn", "question", "answer")


SQL_PAIRS = """pairs AS (
  SELECT a.conv_id * 4294967296 + a.turn AS _row_id, a.conv_id, a.turn, u.text AS question, a.text AS answer
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')"""


def label_split(names: dict[str, str], other: str = "train", row_id: str = "_row_id"):
    """A split name for every row from one hex digit of its key: ``{digits: split}``."""
    digit = F.substring(hash_key("split", row_id), 1, 1)
    out = F.lit(other)
    for digits, name in names.items():
        out = F.when(digit.isin(list(digits)), name).otherwise(out)
    return out


def sql_label(names: dict[str, str], other: str = "train", row_id: str = "doc_id") -> str:
    whens = " ".join(
        f"WHEN substr(md5('split:' || {row_id}), 1, 1) IN ({', '.join(repr(d) for d in digits)}) THEN '{name}'"
        for digits, name in names.items()
    )
    return f"CASE {whens} ELSE '{other}' END"


# One eighth of the rows each for two held-out splits.
HELD_OUT = {"01": "validation", "23": "test"}


def split_documents(spark: SparkSession, sf_dir: str, names: dict[str, str] | None = None) -> DataFrame:
    return documents(spark, sf_dir).withColumn("split", label_split(names or HELD_OUT))


def split_frames(spark: SparkSession, sf_dir: str, names: dict[str, str] | None = None) -> dict[str, DataFrame]:
    names = names or HELD_OUT
    df = split_documents(spark, sf_dir, names)
    return {s: df.filter(F.col("split") == s).drop("split") for s in ("train", *names.values())}


SQL_SPLITS = f"docs AS (SELECT *, {sql_label(HELD_OUT)} AS split FROM documents)"


def sql_vocab(texts: str, size: int = VOCAB) -> str:
    """``vocab(token, id, freq)`` of the texts that ``texts`` selects as ``text``."""
    return f"""counted AS (
  SELECT token, count(*) AS freq FROM (
    SELECT unnest(regexp_extract_all(text, '{SQL_TOKEN}')) AS token FROM ({texts}) AS corpus)
  GROUP BY token ORDER BY freq DESC, token LIMIT {size}),
vocab AS (
  SELECT token, CAST(row_number() OVER (ORDER BY freq DESC, token) + 2 AS INTEGER) AS id, freq FROM counted
  UNION ALL SELECT * FROM (VALUES ('<unk>', 0, 0), ('<bos>', 1, 0), ('<eos>', 2, 0)))"""


def sql_encode(name: str, source: str, row_id: str, text: str) -> str:
    """``name(rid, ids)``: the ids of ``text`` for every row of ``source``, empty lists included."""
    return f"""{name}_at AS (
  SELECT rid, unnest(range(1, len(words) + 1)) AS place, unnest(words) AS token FROM (
    SELECT {row_id} AS rid, regexp_extract_all({text}, '{SQL_TOKEN}') AS words FROM {source})),
{name}_ids AS (
  SELECT rid, list(coalesce(vocab.id, 0) ORDER BY place) AS ids
  FROM {name}_at LEFT JOIN vocab ON vocab.id > 2 AND vocab.token = {name}_at.token GROUP BY rid),
{name} AS (
  SELECT {row_id} AS rid, coalesce(ids, CAST([] AS INTEGER[])) AS ids
  FROM {source} LEFT JOIN {name}_ids ON {name}_ids.rid = {row_id})"""


def sql_repeat(value: int, times: str) -> str:
    return f"list_transform(range(CAST({times} AS BIGINT)), lambda r: {value})"


def sql_join(ids: str) -> str:
    return f"array_to_string({ids}, ' ')"
