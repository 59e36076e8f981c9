"""Whole runs: prepared training text, model rows, and scored predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from textmill.catalog import query
from textmill.catalog.common import SQL_PAIRS, SQL_TOKEN, pairs, sql_encode, sql_join, sql_vocab
from textmill.catalog.scoring import reversing_model
from textmill.catalog.tokens import shown, sql_causal, sql_decode, sql_tidy
from textmill.operators.pack import PackSettings
from textmill.operators.vocab import build_vocab
from textmill.plans.predict import predict_and_score
from textmill.plans.prepare import load_splits, model_rows, prepare_funnel, prepare_text
from textmill.plans.settings import PrepareSettings
from textmill.sources.sinks import write_model_rows
from textmill.sources.staging import fresh_folder

INSTRUCTION = "Reply to this turn."
TEMPLATE = "Task: {} Turn: {} Reply:"
LIMITS = {"max_output_length": 60, "max_target_length": 300, "max_input_length": 48}
SHOTS = 100

# The same settings as a training config would hold them.
CONFIG = {
    "deduplicate_columns": ["question"],
    "filter_long_sequences": True,
    "overfit": False,
    "shots": SHOTS,
    "batch_size": 8,
    "batch_tokenize": True,
    "preprocessing_kwargs": {
        "add_constants": {"instruction": INSTRUCTION},
        "column_dict": {"inputs": ["instruction", "question"], "target": "answer"},
        "input_template": TEMPLATE,
        "target_template": "{}",
        "keep_columns": ["input", "target"],
    },
    "tokenization_kwargs": {"concat_input_output": True, **LIMITS},
}

SQL_PREPARED = f"""{SQL_PAIRS},
firsts AS (SELECT * FROM pairs WHERE _row_id IN (SELECT min(_row_id) FROM pairs GROUP BY question)),
rendered AS (
  SELECT _row_id, regexp_replace('Task: {INSTRUCTION} Turn: ' || question || ' Reply:', '<.*?>', '', 'g') AS input,
    regexp_replace(answer, '<.*?>', '', 'g') AS target
  FROM firsts WHERE question <> '' AND answer <> ''),
fitting AS (
  SELECT * FROM rendered WHERE lower(input) NOT LIKE '%<table>%'
    AND len(regexp_extract_all(input, '{SQL_TOKEN}')) + 1 <= {LIMITS["max_output_length"]}
    AND len(regexp_extract_all(target, '{SQL_TOKEN}')) + 1 <= {LIMITS["max_target_length"]}),
prepared AS (SELECT * FROM fitting ORDER BY md5('42:' || _row_id), _row_id LIMIT {SHOTS})"""


def prepared(spark, sf_dir, **changes):
    settings = PrepareSettings.from_kwargs(raw_data=pairs(spark, sf_dir), **{**CONFIG, **changes})
    return settings, prepare_text(spark, settings)


@query("prepare_train", f"WITH {SQL_PREPARED} SELECT _row_id, input, target FROM prepared")
def q_prepare_train(spark, sf_dir):
    return prepared(spark, sf_dir)[1]["train"].select("_row_id", "input", "target")


@query(
    "prepare_funnel",
    f"""WITH {SQL_PREPARED},
tried AS (
  SELECT question <> '' AND answer <> '' AS a,
    len(regexp_extract_all(regexp_replace('Task: {INSTRUCTION} Turn: ' || question || ' Reply:', '<.*?>', '', 'g'), '{SQL_TOKEN}')) + 1 <= {LIMITS["max_output_length"]}
      AND len(regexp_extract_all(regexp_replace(answer, '<.*?>', '', 'g'), '{SQL_TOKEN}')) + 1 <= {LIMITS["max_target_length"]} AS c FROM firsts)
SELECT 'train' AS split, 'drop_na' AS stage, count(*) AS rows_in, count(*) FILTER (a) AS rows_out FROM tried
UNION ALL SELECT 'train', 'drop_tables', count(*) FILTER (a), count(*) FILTER (a) FROM tried
UNION ALL SELECT 'train', 'filter_long', count(*) FILTER (a), count(*) FILTER (a AND c) FROM tried""",
)
def q_prepare_funnel(spark, sf_dir):
    settings = PrepareSettings.from_kwargs(raw_data=pairs(spark, sf_dir), **CONFIG)
    return prepare_funnel(load_splits(spark, settings), settings)


L_IN, L_OUT, WORLD, BATCH = LIMITS["max_input_length"], LIMITS["max_target_length"], 2, 8
BOTH = "SELECT input AS text FROM fitting UNION ALL SELECT target FROM fitting"


SQL_TRAIN_ROWS = f"""WITH {SQL_PREPARED}, {sql_vocab(BOTH)},
{sql_encode("q", "fitting", "_row_id", "input")}, {sql_encode("a", "fitting", "_row_id", "target")},
cut AS (
  SELECT q.rid AS _row_id, list_concat([1], q.ids)[greatest(len(q.ids) + 1 - {L_IN} + 1, 1):len(q.ids) + 1] AS x,
    list_concat(a.ids, [2])[1:{L_OUT}] AS t FROM q JOIN a ON a.rid = q.rid),
packed AS ({sql_causal(str(L_IN), str(L_OUT), "cut")}),
placed AS (SELECT _row_id, row_number() OVER (ORDER BY md5('42:3:' || _row_id), _row_id) - 1 AS idx FROM fitting)
SELECT _row_id, CAST(idx % {WORLD} AS INTEGER) AS rank, idx // {WORLD} AS pos, idx // {WORLD} // {BATCH} AS batch_id,
  input_ids, attention_mask, labels FROM packed JOIN placed USING (_row_id)"""
ROW_COLUMNS = ["_row_id", "rank", "pos", "batch_id", "input_ids", "attention_mask", "labels"]


def train_rows(spark, sf_dir, **options):
    settings, splits = prepared(spark, sf_dir, shots=-1)
    train = splits["train"]
    vocab = build_vocab(train, ["input", "target"], 5000)
    rows = model_rows(train, settings, "train", vocab=vocab, world=WORLD, epoch=3, **options)
    return rows.select(ROW_COLUMNS)


@query("model_rows_train", SQL_TRAIN_ROWS)
def q_model_rows_train(spark, sf_dir):
    return shown(train_rows(spark, sf_dir))


@query("sink_model_rows", SQL_TRAIN_ROWS)
def q_sink_model_rows(spark, sf_dir):
    rows = train_rows(spark, sf_dir, laid_out=True)
    folder = write_model_rows(rows, fresh_folder(spark, "train"))
    return shown(spark.read.schema(rows.schema).parquet(folder).select(ROW_COLUMNS))


@query(
    "predict_and_score",
    f"""WITH {SQL_PREPARED}, {sql_vocab(BOTH)}, {sql_encode("q", "fitting", "_row_id", "input")},
cut AS (
  SELECT rid AS _row_id, list_reverse(list_concat([1], ids)[greatest(len(ids) + 1 - {L_IN} + 1, 1):len(ids) + 1]) AS y FROM q),
{sql_decode("decoded", "cut", "y")}
SELECT _row_id, {sql_tidy("coalesce(text, '')")} AS prediction, target
FROM fitting LEFT JOIN decoded ON rid = _row_id""",
)
def q_predict_and_score(spark, sf_dir):
    settings, splits = prepared(spark, sf_dir, shots=-1)
    rows = splits["train"]
    vocab = build_vocab(rows, ["input", "target"], 5000)
    packed = model_rows(rows, settings, "predict", vocab=vocab, world=WORLD)
    written = predict_and_score(
        packed, reversing_model, vocab, fresh_folder(spark, "run"), metrics=["bleu", "exact_match"]
    )
    schema = "prediction string, _row_id bigint, target string"
    return spark.read.schema(schema).json(written["merged"]).select("_row_id", "prediction", "target")
