"""Prediction, decoding and metrics."""

import math
import random
import re
import sys
from collections import Counter

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from textmill.functions.text import tokens
from textmill.operators.predict import (
    batch_predict,
    carry_columns,
    decode_output,
    postprocess,
    register_python_postprocessor,
    tidy_text,
)
from textmill.operators.score import bleu, bleu_counts, exact_match, mt_tokens, register_metric, score

# The models below travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def grams(words, n):
    return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def plain_bleu(pairs):
    matches, possible = [0] * 4, [0] * 4
    for p, t in pairs:
        for n in range(1, 5):
            matches[n - 1] += sum((grams(p, n) & grams(t, n)).values())
            possible[n - 1] += max(len(p) - n + 1, 0)
    c, r = sum(len(p) for p, _ in pairs), sum(len(t) for _, t in pairs)
    precisions = [m / p if p else 0.0 for m, p in zip(matches, possible)]
    penalty = 0.0 if c == 0 else 1.0 if c > r else math.exp(1 - r / c)
    value = penalty * math.exp(sum(map(math.log, precisions)) / 4) if min(precisions) > 0 else 0.0
    return {"bleu": value, **{f"precision_{i + 1}": p for i, p in enumerate(precisions)}, "brevity_penalty": penalty,
            "length_ratio": c / r if r else 0.0, "translation_length": c, "reference_length": r}


def as_dict(df):
    return {r.field: r.value for r in df.collect()}


@pytest.mark.parametrize("with_ids", [True, False])
def test_bleu_is_the_plain_formula(spark, with_ids):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 30))) for _ in range(120)]
    pairs = list(zip(texts[:60], texts[60:])) + [("a b c a b c", "a b c a b")] * 30
    df = spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(pairs)], "_row_id long, prediction string, target string")
    got = as_dict(bleu(df if with_ids else df.drop("_row_id"), tokens))
    wanted = plain_bleu([(p.split(), t.split()) for p, t in pairs])
    assert got.keys() == wanted.keys()
    assert all(math.isclose(got[k], wanted[k], rel_tol=1e-12, abs_tol=1e-15) for k in wanted)


def test_bleu_edges(spark):
    schema = "prediction string, target string"
    perfect = as_dict(bleu(spark.createDataFrame([("a b c d e", "a b c d e")], schema)))
    assert perfect["bleu"] == 1.0 and perfect["brevity_penalty"] == 1.0
    assert as_dict(bleu(spark.createDataFrame([("", "a b")], schema)))["bleu"] == 0.0
    assert as_dict(bleu(spark.createDataFrame([], schema)))["bleu"] == 0.0
    assert as_dict(bleu(spark.createDataFrame([("a b", None)], schema)))["reference_length"] == 0.0


def test_mt_tokens(spark):
    cases = {
        'Hello, world! "x" 3.5 and 1,000.': ["Hello", ",", "world", "!", '"', "x", '"', "3.5", "and", "1,000", "."],
        "a-b 5-6 &amp; &lt;x&gt;": ["a-b", "5", "-", "6", "&", "<", "x", ">"],
        "end-\nline\nnext": ["endline", "next"],
        "": [],
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r.t: r.w for r in df.select("t", mt_tokens(F.col("t")).alias("w")).collect()} == cases


def test_mt_tokens_on_random_texts(spark):
    def plain(text):
        for found, other in (("<skipped>", ""), ("-\n", ""), ("\n", " "), ("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
            text = text.replace(found, other)
        text = f" {text} "
        for rule, other in ((r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", r" \1 "), (r"([^0-9])([\.,])", r"\1 \2 "),
                            (r"([\.,])([^0-9])", r" \1 \2"), (r"([0-9])(-)", r"\1 \2 ")):
            text = re.sub(rule, other, text)
        return text.split()

    rng = random.Random(11)
    pieces = [" ", "  ", ".", ",", "-", "1", "23", "a", "é", "\n", "\t", "\xa0", "&amp;", "&lt;", "'", '"', "/", "(", "~", "<skipped>"]
    cases = {"".join(rng.choice(pieces) for _ in range(rng.randint(0, 14))) for _ in range(3000)}
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    assert {r.t: r.w for r in df.select("t", mt_tokens(F.col("t")).alias("w")).collect()} == {c: plain(c) for c in cases}


def test_score_registry(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "c"), (None, "c")], "prediction string, target string")
    assert as_dict(score(df, ["exact_match"])) == {"exact_match": pytest.approx(1 / 3)}
    assert score(df, []).count() == 0
    with pytest.raises(ValueError):
        score(df, ["nope"])
    register_metric(
        "rows", lambda d: d.agg(F.count(F.lit(1)).cast("double").alias("value")).select(
            F.lit("rows").alias("metric"), F.lit("rows").alias("field"), "value"
        )
    )
    assert {(r.metric, r.value) for r in score(df, ["rows", "exact_match"]).collect()} == {
        ("rows", 3.0), ("exact_match", 1 / 3),
    }


def counting_model():
    calls = []

    def predict(ids, mask):
        calls.append(len(ids))
        return [[int(x) for x in row] + [len(ids), len(calls)] for row in ids]

    return predict


def test_predictor_is_made_once_and_gets_batches(spark):
    df = spark.range(10).coalesce(1).select(
        "id", F.array(F.col("id").cast("int")).alias("input_ids"), F.array(F.lit(1)).alias("attention_mask")
    )
    rows = batch_predict(df, counting_model, batch_size=4).orderBy("id").collect()
    assert [r.output_ids[:2] for r in rows] == [[i, 4 if i < 8 else 2] for i in range(10)]
    # The sort samples its input first, and the same worker's model counts on.
    first = rows[0].output_ids[2]
    assert [r.output_ids[2] - first for r in rows] == [i // 4 for i in range(10)]


def short_model():
    return lambda texts: texts[:-1]


def test_predictor_must_answer_every_row(spark):
    df = spark.createDataFrame([("a",), ("b",)], "t string").coalesce(1)
    with pytest.raises(Exception, match="another number of outputs"):
        batch_predict(df, short_model, columns=["t"], out="o", return_type="string").collect()


def test_decoding(spark):
    vocab = spark.createDataFrame(
        [("<unk>", 0), ("<bos>", 1), ("<eos>", 2), ("it", 3), ("'s", 4), ("fine", 5), (".", 6)], "token string, id int"
    )
    df = spark.createDataFrame([(0, [0, 1, 3], [0, 1, 3, 3, 4, 0, 5, 6, 2]), (1, [3], [3])],
                               "_row_id long, input_ids array<int>, output_ids array<int>")
    got = {r._row_id: r.prediction for r in decode_output(df, vocab).collect()}
    assert got == {0: "it's fine.", 1: ""}
    whole = {r._row_id: r.prediction for r in decode_output(df, vocab, strip_prompt=False, tidy=False).collect()}
    assert whole == {0: "it it 's fine .", 1: "it"}


def shouting_decoder():
    return lambda batch: [" ".join(f"<{i}>" for i in ids) + " !" for ids in batch]


def test_decoding_by_a_user_decoder(spark):
    df = spark.createDataFrame([(0, [0, 7], [0, 7, 8, 2, 9]), (1, [7], [7])],
                               "_row_id long, input_ids array<int>, output_ids array<int>")
    got = {r._row_id: r.prediction for r in decode_output(df, decoder=shouting_decoder).collect()}
    assert got == {0: "<8> <9>!", 1: "!"}
    with pytest.raises(ValueError):
        decode_output(df)


def test_tidy_text(spark):
    df = spark.createDataFrame([("a . b ? c ! d , it 's we 're do n't I 'm I 've x ' y",)], "t string")
    assert df.select(tidy_text(F.col("t"))).first()[0] == "a. b? c! d, it's we're don't I'm I've x'y"


def test_postprocessors(spark):
    df = spark.createDataFrame([("ab",), (None,)], "prediction string")
    assert {r[0] for r in postprocess(df).collect()} == {"ab", None}
    register_python_postprocessor("backwards", lambda s: s[::-1])
    assert {r[0] for r in postprocess(df, "backwards").collect()} == {"ba", None}
    with pytest.raises(ValueError):
        postprocess(df, "nope")


def test_carry_columns(spark):
    df = spark.createDataFrame([(1, "p", "t", [1], True)], "n int, prediction string, target string, ids array<int>, b boolean")
    assert carry_columns(df).columns == ["prediction", "n", "target", "b"]
    assert carry_columns(df, numbers=False).columns == ["prediction", "target"]


def test_named_metrics_share_one_scan_and_partial_sums(spark, tmp_path):
    rows = [(i, f"the cat {i % 7} sat on the mat .", f"a cat {i % 5} sat on the mat .") for i in range(400)]
    rows += [(400, None, "x"), (401, "", ""), (402, "same.", "same."), (403, "lost", None)]
    spark.createDataFrame(rows, "_row_id long, prediction string, target string").repartition(5).write.parquet(f"{tmp_path}/p")
    df = spark.read.parquet(f"{tmp_path}/p")
    found = score(df, ["exact_match", "bleu"])
    physical = found._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert physical.count("FileScan") == 1 and "partial_sum" in physical and physical.count("Exchange") == 1
    values = {(r.metric, r.field): r.value for r in found.collect()}
    apart = {(r.metric, r.field): r.value for r in bleu(df).unionByName(exact_match(df)).collect()}
    assert values == apart and values["exact_match", "exact_match"] == pytest.approx(sum(p == t for _, p, t in rows) / 404)
    empty = {r.field: r.value for r in score(df.limit(0), ["bleu", "exact_match"]).collect()}
    assert empty["bleu"] == 0.0 and empty["exact_match"] == 0.0


def test_ngrams_are_no_rows_of_a_table(spark):
    rows = [(i, "a b c d a b", "a b x") for i in range(20)]
    df = spark.createDataFrame(rows, "_row_id long, prediction string, target string")
    counts = bleu_counts(df, tokens)
    assert "keys=[row" not in counts._jdf.queryExecution().executedPlan().toString()
    found = {r.n: (r.matches, r.possible, r.target_grams) for r in counts.collect()}
    assert found == {1: (40, 120, 60), 2: (20, 100, 40), 3: (0, 80, 20), 4: (0, 60, 0)}
    assert bleu_counts(df.filter("_row_id < 0"), tokens).collect() == []
    short = bleu_counts(spark.createDataFrame([(1, "a", "b c")], df.schema), tokens)
    assert {r.n for r in short.collect()} == {1, 2}
