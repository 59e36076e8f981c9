"""Readers, sinks, staging, whole runs and the row-local stream."""

import csv
import json

import pytest
from pyspark.sql import functions as F

from textmill.operators.clean import drop_na
from textmill.operators.predict import merge_ranks
from textmill.operators.report import peek_sample, row_funnel, split_counts
from textmill.operators.vocab import build_vocab
from textmill.plans.prepare import model_rows, prepare_split, prepare_text
from textmill.plans.settings import CleanSettings, PrepareSettings
from textmill.sources.readers import read_splits, with_row_id
from textmill.sources.sinks import write_metrics, write_model_rows, write_predictions
from textmill.sources.staging import materialize, shared_folder, stage
from textmill.sources.staging import fingerprint
from textmill.streaming.rowwise import prepare_stream, write_available


def test_csv_quotes_line_breaks_and_missing_cells(spark, tmp_path):
    path = tmp_path / "train.csv"
    path.write_text('a,b\n"x, ""y""\nz",1\n,2\n"",3\nNA,4\n keep ,5\n')
    df = read_splits(spark, {"train": str(path)})["train"]
    assert [(r.a, r.b) for r in df.orderBy("_row_id").collect()] == [
        ('x, "y"\nz', "1"), (None, "2"), (None, "3"), (None, "4"), (" keep ", "5"),
    ]
    assert {r.b for r in drop_na(df).collect()} == {"1", "5"}
    raw = read_splits(spark, {"train": str(path)}, schema="a string, b int", missing=())["train"]
    assert [r.a for r in raw.filter("b = 4").collect()] == ["NA"]


@pytest.mark.parametrize("few", [True, False])
def test_csv_files_are_split_inside_quotes(spark, tmp_path, monkeypatch, few):
    from textmill.sources import csv_split

    rows = [(str(k), None if k % 7 == 0 else "x, " * (k % 5) + '\n"q"\n' * (k % 11) + "é" + "\r\n" * (k % 3) + "end") for k in range(400)]
    rows[50] = ("50", "long\n" * 300 + '"')  # crosses several blocks
    folder = tmp_path / "train.csv"
    folder.mkdir()
    for name, part in (("a", rows[:250]), ("b", []), ("c", rows[250:])):
        with open(folder / f"{name}.csv", "w", newline="") as file:
            writer = csv.writer(file, lineterminator="\r\n" if name == "c" else "\n")
            writer.writerows([("key", "two\nlines"), *part])
            if name == "a":
                file.write("\n")
    (folder / "d.csv").write_text("")
    if not few:
        monkeypatch.setattr(csv_split, "SHIP_ROWS", 0)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", 700)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
        df = read_splits(spark, {"train": str(folder)}, split_files=True)["train"]
        assert df.columns == ["key", "two\nlines", "_row_id"]
        assert [tuple(r) for r in df.orderBy("_row_id").collect()] == [(*r, k) for k, r in enumerate(rows)]
        typed = read_splits(spark, {"train": str(folder)}, schema="key int, text string", row_id="key", split_files=True)["train"]
        assert sorted(tuple(r) for r in typed.collect()) == [(int(k), t) for k, t in rows]
        lines = spark.read.option("lineSep", "\n").text(str(folder))
        assert lines.select("_metadata.file_path", "_metadata.file_block_start").distinct().count() > 20
        (folder / "d.csv").write_text('key,x\n1,"open\n')
        with pytest.raises(Exception, match="not closed"):
            read_splits(spark, {"train": str(folder)}, schema="key int, text string", row_id="key", split_files=True)["train"].collect()
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)


@pytest.mark.parametrize("kind", ["csv", "jsonl"])
def test_row_ids_follow_files_and_lines(spark, tmp_path, kind):
    folder = tmp_path / f"rows.{kind}"
    folder.mkdir()
    count = 0
    for name, rows in (("a", 5), ("b", 3000), ("c", 1)):
        lines = range(count, count + rows)
        text = "n\n" + "".join(f"{i}\n" for i in lines) if kind == "csv" else "".join(f'{{"n": {i}}}\n' for i in lines)
        (folder / f"{name}.{kind}").write_text(text)
        count += rows
    path = str(folder) if kind == "jsonl" else str(folder)
    df = read_splits(spark, {"train": path}, schema="n int")["train"]
    assert [(r._row_id, r.n) for r in df.orderBy("_row_id").collect()] == [(i, i) for i in range(count)]
    assert "_row_id" not in read_splits(spark, {"train": path}, schema="n int", row_id="n")["train"].columns


def test_json_columns_keep_order_and_check_lengths(spark, tmp_path):
    good, bad, wrong = (tmp_path / f"{n}.json" for n in ("good", "bad", "wrong"))
    good.write_text(json.dumps({"q": [f"q{i}" for i in range(50)], "n": list(range(50))}, indent=1))
    bad.write_text(json.dumps({"q": ["a"], "n": [1, 2]}))
    wrong.write_text(json.dumps({"q": "a"}))
    splits = read_splits(spark, {"train": str(good), "validation": str(good)}, splits=["train"])
    assert set(splits) == {"train"}
    rows = splits["train"].orderBy("_row_id").collect()
    assert [(r._row_id, r.q, r.n) for r in rows] == [(i, f"q{i}", i) for i in range(50)]
    with pytest.raises(Exception, match="differ in length"):
        read_splits(spark, {"train": str(bad)})["train"].collect()
    with pytest.raises(ValueError, match="not lists"):
        read_splits(spark, {"train": str(wrong)})


def test_refused_sources(spark):
    for raw in (None, 7, {}, {"train": "data.parquet"}, "/no/such/folder", "no_such_table", {"train": 3}):
        with pytest.raises(ValueError):
            read_splits(spark, raw)
    with pytest.raises(ValueError):
        read_splits(spark, {"train": spark.range(1)}, splits=["dev"])


def test_a_table_name_gives_its_splits(spark):
    spark.createDataFrame([(1, "train"), (2, "dev"), (3, "train")], "n int, split string").createOrReplaceTempView("stored")
    splits = read_splits(spark, "stored", splits=["train"])
    assert list(splits) == ["train"] and sorted(r.n for r in splits["train"].collect()) == [1, 3]


def test_row_ids_for_tables(spark, tmp_path):
    for part in range(3):
        spark.range(part * 10, part * 10 + 10).coalesce(1).write.mode("append").parquet(str(tmp_path / f"t/part={part}"))
    from_files = with_row_id(spark.read.parquet(str(tmp_path / "t")).filter("id % 2 = 0"))
    assert [(r._row_id, r.id) for r in from_files.orderBy("_row_id").collect()] == [(i, 2 * i) for i in range(15)]
    made = spark.createDataFrame([("b", 1), ("a", 2), ("a", 1)], "k string, n int")
    assert [(r.k, r.n) for r in with_row_id(made, ["k", "n"]).orderBy("_row_id").collect()] == [("a", 1), ("a", 2), ("b", 1)]
    with pytest.raises(ValueError):
        with_row_id(made)


def test_staged_tables_live_in_the_shared_folder(spark):
    folder = shared_folder(spark)
    assert folder == (spark.conf.get("spark.checkpoint.dir", None) or folder).rstrip("/")
    table = stage(spark.range(5), "numbers")
    assert table.count() == 5 and all(folder.removeprefix("file:") in f for f in table.inputFiles())


def test_materialize_reuses_by_settings(spark, tmp_path):
    def frame(value):
        return {"train": spark.range(3).withColumn("v", F.lit(value))}

    read = lambda value, settings: materialize(frame(value), str(tmp_path), settings)["train"].first().v
    assert read(1, {"a": 1}) == 1
    assert read(2, {"a": 1}) == 1
    assert read(2, {"a": 2}) == 2


def test_prediction_and_metric_files(spark, tmp_path):
    df = spark.createDataFrame([("a", None, 0, 0, 1), ("b", "t", 0, 0, 0), ("c", "t", 1, 0, 0)],
                               "prediction string, target string, rank int, batch_id long, pos long")
    path = write_predictions(df, str(tmp_path / "p"), by_rank=True)
    assert sorted(p.name for p in (tmp_path / "p").glob("rank=*")) == ["rank=0", "rank=1"]
    assert [r.prediction for r in merge_ranks(spark, path, df.schema).collect()] == ["b", "a", "c"]
    assert len(list((tmp_path / "p").glob("rank=0/*.json"))) == 1
    assert merge_ranks(spark, path).filter("target is null").count() == 1
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        write_predictions(df, str(tmp_path / "p"), by_rank=True)
    with pytest.raises(ValueError):
        write_predictions(df.drop("rank"), str(tmp_path / "q"), by_rank=True)
    metrics = spark.createDataFrame([("m", "f", 0.5)], "metric string, field string, value double")
    write_metrics(metrics, str(tmp_path / "m"))
    assert len(list((tmp_path / "m").glob("*.json"))) == 1


def test_reports(spark):
    df = spark.createDataFrame([("a", i, i) for i in range(6)] + [("b", 9, None)], "split string, _row_id long, n int")
    funnel = row_funnel(df, [("small", F.col("n") < 4), ("even", F.col("n") % 2 == 0)]).collect()
    assert {tuple(r) for r in funnel} == {("a", "small", 6, 4), ("a", "even", 4, 2), ("b", "small", 1, 0), ("b", "even", 0, 0)}
    drawn = peek_sample(df, seed=3).collect()
    assert {r.split for r in drawn} == {"a", "b"} and drawn == peek_sample(df.repartition(5), seed=3).collect()
    assert {tuple(r) for r in split_counts(df).collect()} == {("a", 6), ("b", 1)}
    many = spark.range(4500).select(F.col("id").alias("_row_id"), (F.col("id") % 1500).alias("split"))
    drawn = peek_sample(many).collect()
    assert sorted(r.split for r in drawn) == list(range(1500)) and all(r._row_id % 1500 == r.split for r in drawn)
    unnamed = spark.createDataFrame([(1, None), (2, None), (3, "a")], "_row_id long, split string")
    assert {r.split for r in peek_sample(unnamed).collect()} == {None, "a"}


CONFIG = {
    "deduplicate_columns": ["key"],
    "shots": 4,
    "dev_size": 2,
    "overfit": False,
    "filter_long_sequences": True,
    "batch_tokenize": True,
    "preprocessing_kwargs": {
        "column_dict": {"inputs": ["task", "source"], "target": "answer"},
        "input_template": "Task: {} | {} =",
        "keep_columns": ["task", "input", "target", "other"],
        "remove_html": False,
        "drop_tables": False,
    },
    "tokenization_kwargs": {"concat_input_output": True, "max_target_length": 4, "max_input_length": 8},
    # Settings of other parts of a run, which are passed along and ignored.
    "num_workers": 3,
    "load_from_cache_file": True,
}


def test_settings_from_a_config():
    settings = PrepareSettings.from_kwargs(**CONFIG)
    assert settings.split.dev_from_train is False and settings.split.shots == 4
    assert (settings.input_limit, settings.target_limit) == (512, 4)
    assert settings.pack.mode == "causal" and settings.pack.add_bos and settings.pack.prefix is None
    bare = PrepareSettings.from_kwargs()
    assert bare.split.overfit and bare.pack.mode == "seq2seq" and not bare.pack.add_bos and not bare.pack.add_eos
    assert bare.clean == CleanSettings() and (bare.pack.max_input, bare.pack.max_target) == (512, 30)
    tuned = {**CONFIG["tokenization_kwargs"], "prefix_tuning": True, "prefix_input_left_padding": True, "n_prefix_tokens": 5}
    prefixed = PrepareSettings.from_kwargs(**{**CONFIG, "tokenization_kwargs": tuned})
    assert (prefixed.pack.prefix, prefixed.predict_prefix, prefixed.pack.n_prefix) == ("front", "after_pad", 5)


def sums(spark, n, start=0):
    rows = [
        (i, f"id{i - i % 2 if i % 5 == 0 else i}", "Add <b>these</b>", f"{i} and {i + 1}", None if i % 7 == 6 else f"{2 * i + 1}")
        for i in range(start, start + n)
    ]
    return spark.createDataFrame(rows, "_row_id long, key string, task string, source string, answer string")


def test_a_run_from_splits_to_model_rows(spark):
    raw = {"train": sums(spark, 30), "validation": sums(spark, 8, 100)}
    settings = PrepareSettings.from_kwargs(**{**CONFIG, "raw_data": raw})
    splits = prepare_text(spark, settings)
    assert splits["train"].columns == ["_row_id", "task", "input", "target"]
    assert splits["train"].count() == 4
    dev = splits["dev"].orderBy("_row_id").collect()
    assert [r.input for r in dev] == [f"Task: Add <b>these</b> | {i} and {i + 1} =" for i in (100, 101)]

    vocab = build_vocab(splits["train"], ["input", "target"], 100)
    rows = model_rows(splits["train"], settings, "train", vocab=vocab, world=2, pad_ranks="wrap")
    got = rows.collect()
    assert len(got) == 4 and {len(r.input_ids) for r in got} == {12} and {len(r.labels) for r in got} == {12}
    assert {(r.rank, r.batch_id, r.pos) for r in got} == {(0, 0, 0), (0, 0, 1), (1, 0, 0), (1, 0, 1)}
    predict = model_rows(splits["dev"], settings, "predict", vocab=vocab)
    assert "labels" not in predict.columns and {len(r.input_ids) for r in predict.collect()} == {8}


def test_a_run_from_csv_files_with_an_own_key(spark, tmp_path):
    rows = "".join(f'{i},"a {i}, b","{i}"\n' for i in range(20, 0, -1))
    for name in ("train", "val"):
        (tmp_path / f"{name}.csv").write_text("key,q,a\n" + rows)
    settings = PrepareSettings.from_kwargs(
        raw_data={n: str(tmp_path / f"{n}.csv") for n in ("train", "val")},
        row_id="key",
        read_options={"multi_line": False},
        dev_size=3,
        overfit=False,
        preprocessing_kwargs={"column_dict": {"inputs": ["q"], "target": "a"}, "keep_columns": ["input", "target"]},
    )
    splits = prepare_text(spark, settings)
    assert splits["train"].count() == 20 and splits["train"].columns == ["key", "input", "target"]
    assert [tuple(r) for r in splits["dev"].orderBy("key").collect()] == [(i, f"a {i}, b", str(i)) for i in (1, 2, 3)]


def test_written_model_rows_are_in_order(spark, tmp_path):
    raw = {"train": sums(spark, 200)}
    settings = PrepareSettings.from_kwargs(**{**CONFIG, "raw_data": raw, "shots": -1, "batch_size": 4})
    train = prepare_text(spark, settings)["train"]
    vocab = build_vocab(train, ["input", "target"], 20)
    rows = model_rows(train, settings, "train", vocab=vocab, world=3, laid_out=True)
    path = write_model_rows(rows, str(tmp_path / "rows"))
    files = spark.read.parquet(path).select("rank", "pos", F.input_file_name().alias("file")).collect()
    assert len(files) == train.count()
    assert len({r.file for r in files}) == 3
    for part in (tmp_path / "rows").glob("rank=*/*.parquet"):
        positions = [r.pos for r in spark.read.parquet(str(part)).coalesce(1).select("pos").collect()]
        assert positions == list(range(len(positions)))


def test_prepared_texts_are_cached_by_settings(spark, tmp_path):
    def run(rows, shots, version="1", template="{} {}"):
        prep = {**CONFIG["preprocessing_kwargs"], "input_template": template}
        settings = PrepareSettings.from_kwargs(
            **{**CONFIG, "raw_data": {"train": sums(spark, rows)}, "shots": shots, "preprocessing_kwargs": prep}
        )
        return prepare_text(spark, settings, cache=(str(tmp_path), version))["train"].count()

    first = run(20, -1)
    assert first > 5 and run(20, -1) == first and run(20, 5) == 5
    assert len(list(tmp_path.iterdir())) == 1  # one preparation served all three
    assert run(40, -1) > first  # other rows under the same settings are noticed
    run(20, -1, version="2")
    run(20, -1, template="{}/{}")
    assert len(list(tmp_path.iterdir())) == 4


def test_a_fingerprint_tells_contents_apart(spark):
    schema = "a string, b string, n double, l array<string>"
    rows = [("x", None, 1.0, ["p", None]), (None, "x", 1.5, None), ("x", None, 1.0, ["p", None]), ("", "é", None, [])]
    of = lambda some: fingerprint(spark.createDataFrame(some, schema))
    whole = of(rows)
    assert whole == of(rows[::-1]) == fingerprint(spark.createDataFrame(rows, schema).repartition(3))
    swapped = [(None, "x", 1.0, ["p", None]), *rows[1:]]
    moved = [("x", None, 1.0, [None, "p"]), *rows[1:]]
    others = [rows[1:], [*rows, rows[3]], swapped, moved, [*rows[:3], (None, "é", None, [])], []]
    assert len({whole, *map(of, others)}) == 7
    assert fingerprint(spark.createDataFrame(rows, schema).withColumnRenamed("b", "c")) != whole


def test_results_do_not_depend_on_shuffle_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for parts in ("1", "4", "11"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            raw = {"train": sums(spark, 60).repartition(int(parts))}
            settings = PrepareSettings.from_kwargs(**{**CONFIG, "raw_data": raw, "shots": 20})
            train = prepare_text(spark, settings)["train"]
            vocab = build_vocab(train, ["input", "target"], 12)
            rows = model_rows(train, settings, "train", vocab=vocab, world=3, epoch=2)
            results.append(sorted(map(repr, rows.select(sorted(rows.columns)).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1] == results[2]


def test_the_row_local_steps_run_on_a_stream(spark, tmp_path):
    source = sums(spark, 40)
    source.repartition(3).write.parquet(str(tmp_path / "in"))
    settings = PrepareSettings.from_kwargs(**{**CONFIG, "deduplicate_columns": []})
    stream = spark.readStream.schema(source.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = write_available(prepare_stream(stream, settings), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    assert query.awaitTermination(120)
    wanted = prepare_split(source, settings)
    got = spark.read.schema(wanted.schema).parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, wanted.collect()))
    with pytest.raises(ValueError):
        prepare_stream(source, settings)
    with pytest.raises(ValueError):
        prepare_stream(stream, PrepareSettings.from_kwargs(**CONFIG))
