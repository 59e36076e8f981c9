"""Queries for row and column preparation, deduplication, the length filter and the reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from textmill.catalog import query
from textmill.catalog.common import (
    HELD_OUT,
    SQL_PAIRS,
    SQL_PUNCTUATION,
    SQL_SPACE,
    SQL_SPLITS,
    SQL_TOKEN,
    documents,
    label_split,
    pairs,
    split_documents,
    split_frames,
    table,
)
from textmill.functions.text import pad_punct, strip_html
from textmill.operators.clean import (
    add_constants,
    complete_row,
    drop_na,
    drop_tables,
    inputs_and_targets,
    keep_columns,
    label_to_word,
    render,
    without_table,
)
from textmill.operators.dedup import dedup_seq
from textmill.operators.lengths import filter_long, within_limits
from textmill.operators.report import peek_sample, row_funnel, split_counts
from textmill.plans.settings import PrepareSettings
from textmill.sources.staging import fresh_folder
from textmill.streaming.rowwise import prepare_stream, write_available


@query(
    "label_to_word",
    """SELECT doc_id, quality AS label, CASE quality WHEN 0 THEN 'low' WHEN 1 THEN 'high' END AS word_label
FROM labels""",
)
def q_label_to_word(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return label_to_word(labels, {0: "low", 1: "high"})


@query(
    "label_to_word_table",
    """SELECT doc_id, toxic AS label, CASE toxic WHEN 0 THEN 'fine' WHEN 1 THEN 'toxic' END AS word_label
FROM labels""",
)
def q_label_to_word_table(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    names = labels.select("label").distinct().withColumn(
        "word", F.when(F.col("label") == 0, "fine").when(F.col("label") == 1, "toxic")
    )
    return label_to_word(labels, names)


def gappy_documents(spark, sf_dir):
    """Documents in which one language is null and one source is empty."""
    return documents(spark, sf_dir).withColumns(
        {
            "lang": F.nullif(F.col("lang"), F.lit("de")),
            "source": F.when(F.col("source") == "src3", "").otherwise(F.col("source")),
        }
    )


@query(
    "drop_na",
    """SELECT doc_id, md5(text) AS text_md5, lang, source, n_chars FROM documents
WHERE lang <> 'de' AND source <> 'src3' AND source <> '' AND text <> ''""",
)
def q_drop_na(spark, sf_dir):
    kept = drop_na(gappy_documents(spark, sf_dir))
    return kept.select(F.col("_row_id").alias("doc_id"), F.md5("text").alias("text_md5"), "lang", "source", "n_chars")


@query(
    "drop_na_mixed_types",
    """SELECT l_returnflag, l_linestatus, count(*) AS n_rows, CAST(sum(l_linenumber) AS BIGINT) AS lines
FROM lineitem WHERE l_returnflag <> 'N' GROUP BY ALL""",
)
def q_drop_na_mixed(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").withColumn(
        "l_returnflag", F.nullif(F.col("l_returnflag"), F.lit("N"))
    )
    return (
        drop_na(items)
        .groupBy("l_returnflag", "l_linestatus")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("l_linenumber").cast("bigint").alias("lines"))
    )


INSTRUCTION = "Reply in one short sentence."


@query(
    "add_constants",
    f"""WITH {SQL_PAIRS}
SELECT _row_id, question, answer, '{INSTRUCTION}' AS instruction, CAST(3 AS INTEGER) AS level FROM pairs""",
)
def q_add_constants(spark, sf_dir):
    df = pairs(spark, sf_dir).select("_row_id", "question", "answer")
    return add_constants(df, {"instruction": INSTRUCTION, "level": 3})


@query(
    "render_input",
    f"""WITH {SQL_PAIRS}
SELECT _row_id, 'Turn ' || turn || ' {{of ' || conv_id || '}}: ' || question || ' | ' || turn AS input FROM pairs""",
)
def q_render_input(spark, sf_dir):
    template = "Turn {1} {{of {2}}}: {0} | {1}"
    return render(pairs(spark, sf_dir), "input", template, ["question", "turn", "conv_id"]).select("_row_id", "input")


@query(
    "render_target",
    f"""WITH {SQL_PAIRS}
SELECT _row_id, 'Answer: ' || answer || ' (' || CASE WHEN turn > 1 THEN 'True' ELSE 'False' END || ')' AS target
FROM pairs""",
)
def q_render_target(spark, sf_dir):
    df = pairs(spark, sf_dir).withColumn("later", F.col("turn") > 1)
    return render(df, "target", "Answer: {} ({})", ["answer", "later"]).select("_row_id", "target")


@query("strip_html", "SELECT page_id, regexp_replace(html, '<.*?>', '', 'g') AS text FROM pages")
def q_strip_html(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", strip_html(F.col("html")).alias("text"))


@query(
    "pad_punct",
    f"""SELECT doc_id, regexp_replace(regexp_replace(text, '{SQL_PUNCTUATION}', ' \\1 ', 'g'), '{SQL_SPACE}', ' ', 'g') AS text
FROM documents""",
)
def q_pad_punct(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", pad_punct(F.col("text")).alias("text"))


def tabled_pages(spark, sf_dir):
    """Pages whose lists are tables where the address is https; the data has no tables of its own."""
    html = F.when(F.col("url").startswith("https"), F.replace("html", F.lit("<ul>"), F.lit("<TABLE>")))
    return table(spark, sf_dir, "pages").select("page_id", "url", F.coalesce(html, "html").alias("input"))


@query(
    "drop_tables",
    """SELECT page_id, url FROM (
  SELECT page_id, url, CASE WHEN url LIKE 'https%' THEN replace(html, '<ul>', '<TABLE>') ELSE html END AS input
  FROM pages) WHERE lower(input) NOT LIKE '%<table>%'""",
)
def q_drop_tables(spark, sf_dir):
    return drop_tables(tabled_pages(spark, sf_dir)).select("page_id", "url")


@query(
    "drop_tables_after_strip",
    """SELECT page_id, regexp_replace(CASE WHEN url LIKE 'https%' THEN replace(html, '<ul>', '<TABLE>') ELSE html END,
  '<.*?>', '', 'g') AS input FROM pages""",
)
def q_drop_tables_after_strip(spark, sf_dir):
    pages = tabled_pages(spark, sf_dir).withColumn("input", strip_html(F.col("input")))
    return drop_tables(pages).select("page_id", "input")


@query(
    "keep_columns",
    f"""WITH {SQL_PAIRS} SELECT 'Q: ' || question AS input, answer AS target FROM pairs""",
)
def q_keep_columns(spark, sf_dir):
    df = render(render(pairs(spark, sf_dir), "input", "Q: {}", "question"), "target", "{}", "answer")
    return keep_columns(df, ["target", "input", "not_there"])


SQL_INPUTS = f"""SELECT page_id AS _row_id, input, target FROM (
  SELECT page_id,
    regexp_replace(regexp_replace(regexp_replace('Page ' || url || ': ' || html, '<.*?>', '', 'g'),
      '{SQL_PUNCTUATION}', ' \\1 ', 'g'), '{SQL_SPACE}', ' ', 'g') AS input,
    regexp_replace(regexp_replace(url, '{SQL_PUNCTUATION}', ' \\1 ', 'g'), '{SQL_SPACE}', ' ', 'g') AS target
  FROM pages WHERE html <> '' AND url <> '')"""


@query("inputs_and_targets", SQL_INPUTS)
def q_inputs_and_targets(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").withColumnRenamed("page_id", "_row_id")
    return inputs_and_targets(
        pages,
        column_dict={"inputs": ["kind", "url", "html"], "target": "url"},
        input_template="{} {}: {}",
        pad_punctuation=True,
        constants={"kind": "Page"},
        keep=["input", "target"],
        row_id="_row_id",
    )


@query(
    "dedup_seq",
    """SELECT doc_id, md5(text) AS text_md5, lang, source, n_chars FROM documents
WHERE doc_id IN (SELECT min(doc_id) FROM documents GROUP BY text)""",
)
def q_dedup_seq(spark, sf_dir):
    kept = dedup_seq(documents(spark, sf_dir), ["text"])
    return kept.select(F.col("_row_id").alias("doc_id"), F.md5("text").alias("text_md5"), "lang", "source", "n_chars")


@query(
    "dedup_seq_columns",
    """WITH first_text AS (SELECT * FROM documents WHERE doc_id IN (SELECT min(doc_id) FROM documents GROUP BY text)),
first_size AS (SELECT * FROM first_text WHERE doc_id IN (SELECT min(doc_id) FROM first_text GROUP BY n_chars)),
first_source AS (SELECT * FROM first_size WHERE doc_id IN (SELECT min(doc_id) FROM first_size GROUP BY source))
SELECT doc_id, md5(text) AS text_md5, lang, source, n_chars FROM first_source""",
)
def q_dedup_seq_columns(spark, sf_dir):
    kept = dedup_seq(documents(spark, sf_dir), ["text", "n_chars", "source"])
    return kept.select(F.col("_row_id").alias("doc_id"), F.md5("text").alias("text_md5"), "lang", "source", "n_chars")


@query(
    "filter_long",
    f"""WITH {SQL_PAIRS} SELECT _row_id, turn FROM pairs
WHERE len(regexp_extract_all(question, '{SQL_TOKEN}')) + 1 <= 40
  AND len(regexp_extract_all(answer, '{SQL_TOKEN}')) + 1 <= 200""",
)
def q_filter_long(spark, sf_dir):
    df = pairs(spark, sf_dir).withColumnsRenamed({"question": "input", "answer": "target"})
    return filter_long(df, input_limit=40, target_limit=200).select("_row_id", "turn")


@query(
    "filter_long_documents",
    f"""SELECT doc_id, n_chars FROM documents WHERE len(regexp_extract_all(text, '{SQL_TOKEN}')) + 1 <= 512""",
)
def q_filter_long_documents(spark, sf_dir):
    df = documents(spark, sf_dir).withColumnRenamed("text", "input")
    return filter_long(df).select(F.col("_row_id").alias("doc_id"), "n_chars")


@query(
    "row_funnel",
    f"""WITH {SQL_SPLITS},
flags AS (
  SELECT split, lang <> 'de' AND source <> 'src3' AS a, lower(text) NOT LIKE '%<table>%' AS b,
    len(regexp_extract_all(text, '{SQL_TOKEN}')) + 1 <= 512 AS c FROM docs),
counts AS (
  SELECT split, count(*) AS n0, count(*) FILTER (a) AS n1, count(*) FILTER (a AND b) AS n2,
    count(*) FILTER (a AND b AND c) AS n3 FROM flags GROUP BY split)
SELECT split, 'drop_na' AS stage, n0 AS rows_in, n1 AS rows_out FROM counts
UNION ALL SELECT split, 'drop_tables', n1, n2 FROM counts
UNION ALL SELECT split, 'filter_long', n2, n3 FROM counts""",
)
def q_row_funnel(spark, sf_dir):
    df = gappy_documents(spark, sf_dir).withColumn("split", label_split(HELD_OUT)).withColumnRenamed("text", "input")
    stages = [
        ("drop_na", complete_row(df.schema)),
        ("drop_tables", without_table()),
        ("filter_long", within_limits(df.columns)),
    ]
    return row_funnel(df, stages)


@query(
    "peek_sample",
    f"""WITH {SQL_SPLITS},
drawn AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY md5('42:' || doc_id), doc_id) AS place FROM docs)
SELECT split, doc_id, lang, source, text FROM drawn WHERE place = 1""",
)
def q_peek_sample(spark, sf_dir):
    drawn = peek_sample(split_documents(spark, sf_dir))
    return drawn.select("split", F.col("_row_id").alias("doc_id"), "lang", "source", "text")


@query("split_counts", f"WITH {SQL_SPLITS} SELECT split, count(*) AS rows FROM docs GROUP BY split")
def q_split_counts(spark, sf_dir):
    return split_counts(split_documents(spark, sf_dir))


@query("split_counts_frames", f"WITH {SQL_SPLITS} SELECT split, count(*) AS rows FROM docs GROUP BY split")
def q_split_counts_frames(spark, sf_dir):
    return split_counts(split_frames(spark, sf_dir))


@query("stream_prepare", SQL_INPUTS)
def q_stream_prepare(spark, sf_dir):
    """Pages that arrive in two parts: the stream stops after the first and goes on from its checkpoint."""
    arrived, out, checkpoint = (fresh_folder(spark, n) for n in ("arrived", "prepared", "checkpoint"))
    settings = PrepareSettings.from_kwargs(
        raw_data="pages", row_id="_row_id",
        preprocessing_kwargs={
            "column_dict": {"inputs": ["kind", "url", "html"], "target": "url"}, "input_template": "{} {}: {}",
            "pad_punctuation": True, "add_constants": {"kind": "Page"}, "keep_columns": ["input", "target"],
        },
    )
    pages = table(spark, sf_dir, "pages").withColumnRenamed("page_id", "_row_id")
    for part in (0, 1):
        pages.filter(F.col("_row_id") % 2 == part).write.mode("append").parquet(arrived)
        stream = spark.readStream.schema(pages.schema).option("maxFilesPerTrigger", 4).parquet(arrived)
        prepared = prepare_stream(stream, settings)
        write_available(prepared, out, checkpoint).awaitTermination()
    return spark.read.schema(prepared.schema).parquet(out).select("_row_id", "input", "target")
