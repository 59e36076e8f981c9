"""Queries for the vocabulary, encoding, packing and decoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from textmill.catalog import query
from textmill.catalog.common import (
    SQL_PAIRS,
    VOCAB,
    documents,
    pairs,
    sql_encode,
    sql_join,
    sql_repeat,
    sql_vocab,
    table,
)
from textmill.functions.arrays import joined, pad_ids, pad_mask, truncate_ids
from textmill.operators.pack import PackSettings, add_special, pack
from textmill.operators.predict import decode_output
from textmill.operators.shard import batch_rows, epoch_order, shard_rows
from textmill.operators.vocab import BOS, EOS, build_vocab, encode, encode_by_join

L_IN, L_OUT, N_PREFIX, PREFIX_ID = 48, 160, 6, 50256

DOCUMENT_TEXTS = "SELECT text FROM documents"
TURN_TEXTS = "SELECT text FROM conversations"


@query("build_vocab", f"WITH {sql_vocab(DOCUMENT_TEXTS)} SELECT token, id, CAST(freq AS BIGINT) AS freq FROM vocab")
def q_build_vocab(spark, sf_dir):
    return build_vocab(documents(spark, sf_dir), "text", VOCAB)


TIED = 50_000  # ends among the many tokens that occur once


@query("build_vocab_ties", f"WITH {sql_vocab(DOCUMENT_TEXTS, TIED)} SELECT token, id, CAST(freq AS BIGINT) AS freq FROM vocab")
def q_build_vocab_ties(spark, sf_dir):
    # The way that a vocabulary takes which is too large for one reducer.
    return build_vocab(documents(spark, sf_dir), "text", TIED, direct_rows=100)


SQL_ENCODED_DOCUMENTS = f"""WITH {sql_vocab(DOCUMENT_TEXTS)},
{sql_encode("encoded", "documents", "doc_id", "text")}
SELECT rid AS doc_id, {sql_join("ids")} AS ids FROM encoded"""


@query("encode", SQL_ENCODED_DOCUMENTS)
def q_encode(spark, sf_dir):
    docs = documents(spark, sf_dir)
    ids = encode(docs, {"text": "ids"}, build_vocab(docs, "text", VOCAB))
    return ids.select(F.col("_row_id").alias("doc_id"), joined(F.col("ids")).alias("ids"))


@query("encode_by_join", SQL_ENCODED_DOCUMENTS)
def q_encode_by_join(spark, sf_dir):
    docs = documents(spark, sf_dir)
    ids = encode_by_join(docs, {"text": "ids"}, build_vocab(docs, "text", VOCAB))
    return ids.select(F.col("_row_id").alias("doc_id"), joined(F.col("ids")).alias("ids"))


def turn_vocab(spark, sf_dir) -> DataFrame:
    return build_vocab(table(spark, sf_dir, "conversations"), "text", VOCAB)


def encoded_pairs(spark, sf_dir) -> DataFrame:
    """Pairs as ``_row_id, input_ids, target_ids`` over the vocabulary of all turns."""
    ids = encode(pairs(spark, sf_dir), {"question": "input_ids", "answer": "target_ids"}, turn_vocab(spark, sf_dir))
    return ids.select("_row_id", "input_ids", "target_ids")


def sql_packed(select: str, bos: bool = True, eos: bool = True, causal: bool = True) -> str:
    """A query over ``cut``: the pairs with their id lists x and t after special ids and truncation."""
    x = f"list_concat([{BOS}], q.ids)" if bos else "q.ids"
    t = f"list_concat(a.ids, [{EOS}])" if eos else "a.ids"
    cut = f"x[greatest(len(x) - {L_IN} + 1, 1):len(x)]" if causal else f"x[1:{L_IN}]"
    return f"""WITH {sql_vocab(TURN_TEXTS)}, {SQL_PAIRS},
{sql_encode("q", "pairs", "_row_id", "question")},
{sql_encode("a", "pairs", "_row_id", "answer")},
special AS (SELECT q.rid AS _row_id, {x} AS x, {t} AS t FROM q JOIN a ON a.rid = q.rid),
cut AS (SELECT _row_id, {cut} AS x, t[1:{L_OUT}] AS t FROM special)
{select}"""


def shown(df: DataFrame) -> DataFrame:
    """Array columns as joined strings."""
    return df.select(*(joined(F.col(n)).alias(n) if t.startswith("array") else n for n, t in df.dtypes))


@query(
    "add_bos_eos",
    f"""WITH {sql_vocab(TURN_TEXTS)}, {SQL_PAIRS},
{sql_encode("q", "pairs", "_row_id", "question")}, {sql_encode("a", "pairs", "_row_id", "answer")}
SELECT q.rid AS _row_id, {sql_join(f"list_concat([{BOS}], q.ids)")} AS input_ids,
  {sql_join(f"list_concat(a.ids, [{EOS}])")} AS target_ids FROM q JOIN a ON a.rid = q.rid""",
)
def q_add_bos_eos(spark, sf_dir):
    df = encoded_pairs(spark, sf_dir)
    return shown(
        df.withColumns(
            {
                "input_ids": add_special(F.col("input_ids"), bos=BOS),
                "target_ids": add_special(F.col("target_ids"), eos=EOS),
            }
        )
    )


@query(
    "truncate",
    sql_packed(f"SELECT _row_id, {sql_join('x')} AS input_ids, {sql_join('t')} AS target_ids FROM cut", False, False),
)
def q_truncate(spark, sf_dir):
    df = encoded_pairs(spark, sf_dir)
    return shown(
        df.withColumns(
            {
                "input_ids": truncate_ids(F.col("input_ids"), L_IN, "left"),
                "target_ids": truncate_ids(F.col("target_ids"), L_OUT, "right"),
            }
        )
    )


@query(
    "pad_mask",
    sql_packed(
        f"""SELECT _row_id,
  {sql_join(f"list_concat({sql_repeat(0, f'{L_IN} - len(x)')}, x)")} AS left_ids,
  {sql_join(f"list_concat({sql_repeat(0, f'{L_IN} - len(x)')}, {sql_repeat(1, 'len(x)')})")} AS left_mask,
  {sql_join(f"list_concat(t, {sql_repeat(0, f'{L_OUT} - len(t)')})")} AS right_ids,
  {sql_join(f"list_concat({sql_repeat(1, 'len(t)')}, {sql_repeat(0, f'{L_OUT} - len(t)')})")} AS right_mask
FROM cut""",
        False,
        False,
    ),
)
def q_pad_mask(spark, sf_dir):
    df = encoded_pairs(spark, sf_dir)
    x, t = truncate_ids(F.col("input_ids"), L_IN, "left"), truncate_ids(F.col("target_ids"), L_OUT, "right")
    return shown(
        df.select(
            "_row_id",
            pad_ids(x, L_IN, 0, "left").alias("left_ids"),
            pad_mask(x, L_IN, "left").alias("left_mask"),
            pad_ids(t, L_OUT, 0, "right").alias("right_ids"),
            pad_mask(t, L_OUT, "right").alias("right_mask"),
        )
    )


def sql_causal(l_in: str, l_out: str, source: str, prefix: int = 0) -> str:
    """The causal row of x and t in ``source`` for the two padded lengths."""
    pads = f"{l_in} + {l_out} - len(x) - len(t)"
    ids = f"list_concat(list_concat(x, t), {sql_repeat(0, pads)})"
    mask = f"list_concat({sql_repeat(1, 'len(x) + len(t)')}, {sql_repeat(0, pads)})"
    labels = f"list_transform({ids}, lambda v, i: CASE WHEN i <= len(x) OR v = 0 THEN -100 ELSE v END)"
    if prefix:
        ids = f"list_concat({sql_repeat(PREFIX_ID, str(prefix))}, {ids})"
        mask = f"list_concat({sql_repeat(1, str(prefix))}, {mask})"
        labels = f"list_concat({sql_repeat(-100, str(prefix))}, {labels})"
    return f"""SELECT _row_id, {sql_join(ids)} AS input_ids, {sql_join(mask)} AS attention_mask,
  {sql_join(labels)} AS labels FROM {source}"""


CAUSAL = PackSettings.per_item(max_input=L_IN, max_target=L_OUT)


@query("pack_causal", sql_packed(sql_causal(str(L_IN), str(L_OUT), "cut")))
def q_pack_causal(spark, sf_dir):
    return shown(pack(encoded_pairs(spark, sf_dir), CAUSAL))


@query("pack_causal_whole_table", sql_packed(sql_causal(str(L_IN), str(L_OUT), "cut"), bos=False))
def q_pack_causal_whole_table(spark, sf_dir):
    return shown(pack(encoded_pairs(spark, sf_dir), PackSettings.whole_table(max_input=L_IN, max_target=L_OUT)))


@query(
    "label_mask",
    sql_packed(
        """SELECT _row_id, CAST(len(list_filter(list_concat(x, t), lambda v, i: i > len(x) AND v <> 0)) AS BIGINT) AS scored,
  CAST(len(list_filter(list_concat(x, t), lambda v, i: i <= len(x) OR v = 0)) AS BIGINT) AS ignored FROM cut"""
    ),
)
def q_label_mask(spark, sf_dir):
    packed = pack(encoded_pairs(spark, sf_dir), CAUSAL)
    scored = F.size(F.filter("labels", lambda v: v != -100))
    pads = F.size(F.filter("attention_mask", lambda v: v == 0))
    ignored = F.size("labels") - scored - pads
    return packed.select("_row_id", scored.cast("bigint").alias("scored"), ignored.cast("bigint").alias("ignored"))


@query(
    "pad_longest",
    sql_packed(
        f"""SELECT * FROM (WITH placed AS (SELECT *, row_number() OVER (ORDER BY md5('42:0:' || _row_id), _row_id) - 1 AS idx FROM cut),
batched AS (SELECT *, idx % 2 AS rank, idx // 2 // 8 AS batch_id FROM placed),
sized AS (SELECT *, max(len(x)) OVER (PARTITION BY rank, batch_id) AS l_in, max(len(t)) OVER (PARTITION BY rank, batch_id) AS l_out FROM batched)
{sql_causal("l_in", "l_out", "sized")})"""
    ),
)
def q_pad_longest(spark, sf_dir):
    placed = batch_rows(shard_rows(epoch_order(pairs(spark, sf_dir)), 2), 8)
    ids = encode(placed, {"question": "input_ids", "answer": "target_ids"}, turn_vocab(spark, sf_dir))
    packed = pack(ids, CAUSAL, padding="longest")
    return shown(packed.select("_row_id", "input_ids", "attention_mask", "labels"))


def sql_seq2seq(eos: bool, decoder: bool = False) -> str:
    labels = f"list_concat(t, {sql_repeat(0, f'{L_OUT} - len(t)')})"
    extra = f", {sql_join(sql_repeat(PREFIX_ID, str(N_PREFIX)))} AS decoder_input_ids" if decoder else ""
    return sql_packed(
        f"""SELECT _row_id, {sql_join(f"list_concat(x, {sql_repeat(0, f'{L_IN} - len(x)')})")} AS input_ids,
  {sql_join(f"list_concat({sql_repeat(1, 'len(x)')}, {sql_repeat(0, f'{L_IN} - len(x)')})")} AS attention_mask,
  {sql_join(f"list_transform({labels}, lambda v: CASE WHEN v = 0 THEN -100 ELSE v END)")} AS labels{extra} FROM cut""",
        bos=eos,
        eos=eos,
        causal=False,
    )


SEQ2SEQ = PackSettings.per_item(mode="seq2seq", max_input=L_IN, max_target=L_OUT)


@query("pack_seq2seq", sql_seq2seq(True))
def q_pack_seq2seq(spark, sf_dir):
    return shown(pack(encoded_pairs(spark, sf_dir), SEQ2SEQ))


@query("pack_seq2seq_whole_table", sql_seq2seq(False))
def q_pack_seq2seq_whole_table(spark, sf_dir):
    settings = PackSettings.whole_table(mode="seq2seq", max_input=L_IN, max_target=L_OUT)
    return shown(pack(encoded_pairs(spark, sf_dir), settings))


@query("decoder_prefix", sql_seq2seq(True, decoder=True))
def q_decoder_prefix(spark, sf_dir):
    return shown(pack(encoded_pairs(spark, sf_dir), SEQ2SEQ, decoder_prefix=True, n_prefix=N_PREFIX))


def sql_predict(prefix: int = 0) -> str:
    pads = f"{L_IN} - len(x)"
    front = sql_repeat(PREFIX_ID, str(prefix))
    return sql_packed(
        f"""SELECT _row_id,
  {sql_join(f"list_concat(list_concat({sql_repeat(0, pads)}, {front}), x)")} AS input_ids,
  {sql_join(f"list_concat({sql_repeat(0, pads)}, {sql_repeat(1, f'{prefix} + len(x)')})")} AS attention_mask
FROM cut"""
    )


@query("pack_predict", sql_predict())
def q_pack_predict(spark, sf_dir):
    return shown(pack(encoded_pairs(spark, sf_dir), CAUSAL, predict=True))


@query("prefix_front", sql_packed(sql_causal(str(L_IN), str(L_OUT), "cut", N_PREFIX)))
def q_prefix_front(spark, sf_dir):
    return shown(pack(encoded_pairs(spark, sf_dir), CAUSAL, prefix="front", n_prefix=N_PREFIX))


@query("prefix_after_pad", sql_predict(N_PREFIX))
def q_prefix_after_pad(spark, sf_dir):
    return shown(pack(encoded_pairs(spark, sf_dir), CAUSAL, predict=True, prefix="after_pad", n_prefix=N_PREFIX))


@query(
    "prefix_only",
    sql_packed(f"SELECT * FROM (WITH bare AS (SELECT _row_id, CAST([] AS INTEGER[]) AS x, t FROM cut) {sql_causal('0', str(L_OUT), 'bare')})"),
)
def q_prefix_only(spark, sf_dir):
    return shown(pack(encoded_pairs(spark, sf_dir), CAUSAL, prefix_only=True))


def sql_tidy(text: str) -> str:
    for spaced, tidy in (
        (" .", "."), (" ?", "?"), (" !", "!"), (" ,", ","), (" '' ", "''"),
        (" n''t", "n''t"), (" ''m", "''m"), (" ''s", "''s"), (" ''ve", "''ve"), (" ''re", "''re"),
    ):
        text = f"replace({text}, '{spaced}', '{tidy}')"
    return text


def sql_decode(name: str, source: str, ids: str) -> str:
    """``name(rid, text)``: the known, non-special ids of a list as tidied text."""
    return f"""{name}_at AS (SELECT _row_id AS rid, unnest(range(1, len({ids}) + 1)) AS place, unnest({ids}) AS id FROM {source}),
{name} AS (
  SELECT rid, string_agg(token, ' ' ORDER BY place) AS text FROM {name}_at JOIN vocab USING (id) WHERE id > 2 GROUP BY rid)"""


@query(
    "decode_output",
    sql_packed(
        f"""SELECT * FROM (WITH {sql_decode("decoded", "cut", "t")}
SELECT _row_id, {sql_tidy("coalesce(text, '')")} AS prediction FROM cut LEFT JOIN decoded ON rid = _row_id)"""
    ),
)
def q_decode_output(spark, sf_dir):
    vocab = turn_vocab(spark, sf_dir)
    df = encode(pairs(spark, sf_dir), {"question": "input_ids", "answer": "target_ids"}, vocab)
    target = F.slice(add_special(F.col("target_ids"), eos=EOS), 1, L_OUT)
    output = df.withColumn("output_ids", F.concat("input_ids", target))
    return decode_output(output, vocab).select("_row_id", "prediction")
