"""Queries for prediction, post-processing and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from textmill.catalog import query
from textmill.catalog.common import SQL_PAIRS, SQL_TOKEN, SQL_VISIBLE, pairs, sql_join, sql_repeat, table
from textmill.catalog.tokens import CAUSAL, L_IN, encoded_pairs, sql_packed
from textmill.functions.arrays import joined
from textmill.functions.text import strip_html, tokens
from textmill.operators.pack import pack
from textmill.operators.predict import batch_predict, carry_columns, postprocess, register_postprocessor
from textmill.operators.score import Metric, bleu, bleu_counts, register_metric, score


def reversing_model():
    """A model whose continuation is the prompt backwards."""

    def predict(input_ids, attention_mask):
        outputs = []
        for ids, mask in zip(input_ids, attention_mask):
            real = [int(i) for i, m in zip(ids, mask) if m == 1]
            outputs.append([int(i) for i in ids] + real[::-1])
        return outputs

    return predict


@query(
    "batch_predict",
    sql_packed(
        f"""SELECT _row_id, {sql_join(f"list_concat(list_concat({sql_repeat(0, f'{L_IN} - len(x)')}, x), list_reverse(x))")} AS output_ids
FROM cut"""
    ),
)
def q_batch_predict(spark, sf_dir):
    rows = pack(encoded_pairs(spark, sf_dir), CAUSAL, predict=True)
    return batch_predict(rows, reversing_model).select("_row_id", joined(F.col("output_ids")).alias("output_ids"))


def first_line_model():
    """A text model that answers with the first line of its input, in brackets."""
    return lambda texts: ["[" + text.split("\n")[0] + "]" for text in texts]


@query(
    "batch_predict_text",
    f"""WITH {SQL_PAIRS} SELECT _row_id, '[' || split_part(question, chr(10), 1) || ']' AS prediction FROM pairs""",
)
def q_batch_predict_text(spark, sf_dir):
    rows = pairs(spark, sf_dir)
    out = batch_predict(rows, first_line_model, columns=["question"], out="prediction", return_type="string")
    return out.select("_row_id", "prediction")


@query(
    "postprocess",
    f"""WITH {SQL_PAIRS} SELECT _row_id, trim(question, ' ') AS prediction FROM pairs""",
)
def q_postprocess(spark, sf_dir):
    register_postprocessor("trimmed", lambda text: F.trim(text))
    df = pairs(spark, sf_dir).select("_row_id", F.col("question").alias("prediction"))
    return postprocess(postprocess(df, "identity"), "trimmed")


@query(
    "carry_columns",
    f"""WITH {SQL_PAIRS} SELECT question AS prediction, _row_id, conv_id, turn, answer FROM pairs""",
)
def q_carry_columns(spark, sf_dir):
    df = pairs(spark, sf_dir).withColumn("words", tokens(F.col("answer")))
    return carry_columns(df.withColumnRenamed("question", "prediction"))


def predicted_pairs(spark, sf_dir):
    return pairs(spark, sf_dir).select("_row_id", F.col("question").alias("prediction"), F.col("answer").alias("target"))


def sql_mt(text: str) -> str:
    """The default tokens of corpus BLEU."""
    for found, replacement in (
        ("'<skipped>'", "''"), ("'-' || chr(10)", "''"), ("chr(10)", "' '"),
        ("'&quot;'", "'\"'"), ("'&amp;'", "'&'"), ("'&lt;'", "'<'"), ("'&gt;'", "'>'"),
    ):
        text = f"replace({text}, {found}, {replacement})"
    text = f"' ' || {text} || ' '"
    for pattern, replacement in (
        (r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", r" \1 "),
        (r"([^0-9])([\.,])", r"\1 \2 "),
        (r"([\.,])([^0-9])", r" \1 \2"),
        (r"([0-9])(-)", r"\1 \2 "),
    ):
        text = f"regexp_replace({text}, '{pattern}', '{replacement}', 'g')"
    return f"regexp_extract_all({text}, '{SQL_VISIBLE}')"


def sql_bleu_counts(prediction: str, target: str, source: str) -> str:
    following = ", ".join(f"lead(token, {n}) OVER seq AS w{n}" for n in (1, 2, 3))
    grams = " UNION ALL ".join(
        f"""SELECT rid, side, {n} AS n, concat_ws(' ', {", ".join(["token", "w1", "w2", "w3"][:n])}) AS gram
  FROM windows{f" WHERE w{n - 1} IS NOT NULL" if n > 1 else ""}"""
        for n in (1, 2, 3, 4)
    )
    return f"""words AS (SELECT row_number() OVER () AS rid, {prediction} AS p, {target} AS t FROM {source}),
placed AS (
  SELECT rid, 'p' AS side, unnest(range(len(p))) AS place, unnest(p) AS token FROM words
  UNION ALL SELECT rid, 't', unnest(range(len(t))), unnest(t) FROM words),
windows AS (SELECT rid, side, token, {following} FROM placed WINDOW seq AS (PARTITION BY rid, side ORDER BY place)),
grams AS ({grams}),
per_gram AS (
  SELECT rid, n, gram, count(*) FILTER (side = 'p') AS p, count(*) FILTER (side = 't') AS t
  FROM grams GROUP BY rid, n, gram),
counts AS (
  SELECT n, CAST(sum(least(p, t)) AS DOUBLE) AS matches, CAST(sum(p) AS DOUBLE) AS possible,
    CAST(sum(t) AS DOUBLE) AS target_grams FROM per_gram GROUP BY n)"""


SQL_BLEU = """wide AS (
  SELECT max(possible) FILTER (n = 1) AS c, max(target_grams) FILTER (n = 1) AS r,
    max(matches / possible) FILTER (n = 1) AS p1, max(matches / possible) FILTER (n = 2) AS p2,
    max(matches / possible) FILTER (n = 3) AS p3, max(matches / possible) FILTER (n = 4) AS p4 FROM counts),
scored AS (SELECT *, CASE WHEN c > r THEN 1.0 ELSE exp(1.0 - r / c) END AS bp FROM wide),
fields AS (
  SELECT 'bleu' AS field, bp * exp((ln(p1) + ln(p2) + ln(p3) + ln(p4)) / 4) AS value FROM scored
  UNION ALL SELECT 'precision_1', p1 FROM scored UNION ALL SELECT 'precision_2', p2 FROM scored
  UNION ALL SELECT 'precision_3', p3 FROM scored UNION ALL SELECT 'precision_4', p4 FROM scored
  UNION ALL SELECT 'brevity_penalty', bp FROM scored UNION ALL SELECT 'length_ratio', c / r FROM scored
  UNION ALL SELECT 'translation_length', c FROM scored UNION ALL SELECT 'reference_length', r FROM scored)
SELECT 'bleu' AS metric, field, round(value, 9) AS value FROM fields"""


def rounded(df):
    """Floating results to nine places, where two engines' logarithms agree."""
    return df.withColumn("value", F.round("value", 9))


@query("metric_bleu", f"WITH {SQL_PAIRS}, {sql_bleu_counts(sql_mt('question'), sql_mt('answer'), 'pairs')}, {SQL_BLEU}")
def q_metric_bleu(spark, sf_dir):
    return rounded(bleu(predicted_pairs(spark, sf_dir)))


def sql_words(column: str) -> str:
    return f"regexp_extract_all({column}, '{SQL_TOKEN}')"


@query(
    "metric_bleu_words",
    f"WITH {SQL_PAIRS}, {sql_bleu_counts(sql_words('question'), sql_words('answer'), 'pairs')}, {SQL_BLEU}",
)
def q_metric_bleu_words(spark, sf_dir):
    # Without row ids, so that the distinct pairs are scored with their weights.
    return rounded(bleu(predicted_pairs(spark, sf_dir).drop("_row_id"), tokens))


@query(
    "bleu_counts",
    f"""WITH {sql_bleu_counts(sql_words("regexp_replace(html, '<.*?>', '', 'g')"), sql_words('html'), 'pages')}
SELECT CAST(n AS INTEGER) AS n, CAST(matches AS BIGINT) AS matches, CAST(possible AS BIGINT) AS possible,
  CAST(target_grams AS BIGINT) AS target_grams FROM counts""",
)
def q_bleu_counts(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("_row_id"), strip_html(F.col("html")).alias("prediction"), F.col("html").alias("target")
    )
    return bleu_counts(pages, tokens)


SQL_EXACT = """SELECT 'exact_match' AS metric, 'exact_match' AS field,
  round(avg(CASE WHEN regexp_replace(text, '<.*?>', '', 'g') = text THEN 1.0 ELSE 0.0 END), 9) AS value FROM documents"""


@query("metric_exact", SQL_EXACT)
def q_metric_exact(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        strip_html(F.col("text")).alias("prediction"), F.col("text").alias("target")
    )
    return rounded(score(docs, ["exact_match"]))


@query(
    "score",
    f"""WITH {SQL_PAIRS}, {sql_bleu_counts(sql_mt('question'), sql_mt('answer'), 'pairs')}, {SQL_BLEU}
UNION ALL SELECT 'exact_match', 'exact_match', round(avg(CASE WHEN question = answer THEN 1.0 ELSE 0.0 END), 9) FROM pairs""",
)
def q_score(spark, sf_dir):
    return rounded(score(predicted_pairs(spark, sf_dir), ["bleu", "exact_match"]))


# A user's metric: its state is a sum, a maximum and a count, which Spark merges over partitions.
LENGTHS = Metric(
    lambda prediction, target: {
        "chars": F.length(prediction),
        "longest": F.length(prediction),
        "rows": F.lit(1),
        "shorter": F.when(F.length(prediction) < F.length(target), 1).otherwise(0),
    },
    {"chars": "sum", "longest": "max", "rows": "sum", "shorter": "sum"},
    lambda state: [
        ("mean_chars", state["chars"] / state["rows"]),
        ("longest", state["longest"]),
        ("shorter_share", state["shorter"] / state["rows"]),
    ],
)


@query(
    "score_custom",
    f"""WITH {SQL_PAIRS}
SELECT 'lengths' AS metric, unnest(['mean_chars', 'longest', 'shorter_share']) AS field,
  unnest([round(sum(length(question)) / count(*), 9), CAST(max(length(question)) AS DOUBLE),
    round(count(*) FILTER (length(question) < length(answer)) / count(*), 9)]) AS value FROM pairs
UNION ALL SELECT 'exact_match', 'exact_match', round(avg(CASE WHEN question = answer THEN 1.0 ELSE 0.0 END), 9) FROM pairs""",
)
def q_score_custom(spark, sf_dir):
    register_metric("lengths", LENGTHS)
    return rounded(score(predicted_pairs(spark, sf_dir), ["lengths", "exact_match"]))
