"""Operators on single texts and pages: quality rules, HTML extraction, BPE, token files, archives."""

import base64
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField
from tokenizers import Tokenizer

from textmill.llm import bpe, html_extract, quality, token_files, warc
from textmill.llm.arrow import add_columns
from textmill.llm.shared import reading
from textmill.llm.units import UnitCache, split_units

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
ODD = "aabcdeST  \n\n\t ..,'s'll'éüß日本ё٣½Ᲊ\U0001e5ea\x1c\xa0\x85​퟿😀<|endoftext|>0123 "


def odd_texts(count: int, seed: int = 1) -> list[str]:
    rng = random.Random(seed)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 60))) for _ in range(count)]
    texts += ["a<|endoftext|>b", "<|endoftext|>", "a\n\n<|endoftext|>  x", " " * 50 + "a", "\0\0 a \0b", "a" * 3000, "ab" * 2000]
    return texts + ["!" * 777, "aaa aaaa aaaaa", "", " ", "\n \n", "x  ", "it's we'll I'd"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE_BPE)


def test_prefix_programming_gives_the_ids_of_the_library(library):
    coder, speller = bpe.BpeCoder(BYTE_BPE), bpe.Speller(BYTE_BPE)
    for text in odd_texts(4000):
        ids = library.encode(text, add_special_tokens=False).ids
        found = np.frombuffer(coder.encode(text), dtype="<i4")
        assert found.tolist() == ids, text
        assert speller.decode(found) == library.decode(ids, skip_special_tokens=False) == text


def test_ids_that_are_not_whole_characters_decode_as_the_library_does(library):
    speller = bpe.Speller(BYTE_BPE)
    assert speller.decode(np.array([], dtype="<i4")) == ""
    for ids in ([222], [33176, 98, 50256, 0]):
        assert speller.decode(np.array(ids)) == library.decode(ids, skip_special_tokens=False)


def test_encoded_frame_keeps_other_columns_and_null_texts(spark):
    rows = [(1, None, "x"), (2, "", None), (3, "one two", "y"), (3, "one two", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = bpe.encode_bpe(df, BYTE_BPE, decoded="again")
    assert out.columns == ["doc_id", "text", "ids", "again"]
    found = sorted((r.doc_id, list(r.ids), r.again) for r in out.collect())
    assert found[0] == (1, [], "") and found[1] == (2, [], "") and found[2] == found[3] and found[2][2] == "one two"
    back = bpe.decode_bpe(out.drop("again"), BYTE_BPE)
    assert sorted(r.decoded for r in back.collect()) == ["", "", "one two", "one two"]
    nothing = spark.createDataFrame([(None,)], "ids array<int>")
    assert bpe.decode_bpe(nothing, BYTE_BPE).collect()[0].decoded is None
    assert bpe.encode_bpe(df.limit(0), BYTE_BPE).count() == 0


def test_units_rejoin_to_the_text_and_the_cache_is_bounded():
    assert all("".join(split_units(t)) == t for t in odd_texts(300, 3))
    cache = UnitCache(len, limit=3)
    assert [cache["x" * (k % 7)] for k in range(50)] == [k % 7 for k in range(50)]
    assert len(cache) <= 4 and len(cache.old) <= 4


def test_library_encoder_joins_units_without_changing_ids(library):
    encoder = token_files.LibraryEncoder(BYTE_BPE, limit=50)
    texts = odd_texts(3000, 5)
    for k in range(0, len(texts), 100):
        for text, packed in zip(texts[k : k + 100], encoder.encode(texts[k : k + 100])):
            assert np.frombuffer(packed, "<u2").tolist() == library.encode(text, add_special_tokens=False).ids


def test_token_files_round_trip_in_id_order(spark, library):
    texts = [None, "", *odd_texts(60, 7)]
    rows = [(k * 3 % 101, t, "n") for k, t in enumerate(texts)]
    rows += [(5000, "same", None)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, id string").repartition(5)
    manifest = token_files.write_token_files(df, BYTE_BPE, length=16)
    found = sorted((r.start, r.id, r.n_tokens, bytes(r.tokens)) for r in token_files.read_token_files(manifest).collect())
    at = 0
    for (start, key, n, tokens), (row, text, _) in zip(found, sorted(rows, key=lambda r: (r[0], r[1] or ""))):
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        assert (start, key, n, tokens) == (at, row, len(ids), np.array(ids, "<u4").tobytes())
        at += n
    assert len(found) == len(rows)
    shard = manifest.collect()[0]
    with reading(shard.folder, f"{shard.file}.arrow") as file:
        batch = pa.ipc.open_file(file).get_batch(0)
        assert batch.column(0).type == pa.list_(pa.uint16(), 16) and batch.column(1).type == pa.list_(pa.bool_(), 16)
    empty = token_files.write_token_files(df.limit(0), BYTE_BPE)
    assert empty.count() == 0 and token_files.read_token_files(empty).count() == 0


def test_any_sequence_of_the_token_files_without_a_copy(spark, library):
    texts = [f"Sequence {n} of the token files. " * (n % 7) for n in range(3000)] + ["long " * 9000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    manifest = token_files.write_token_files(df, BYTE_BPE, length=16)
    expected = [i for e in library.encode_batch(texts, add_special_tokens=False) for i in [*e.ids, 0]]
    with token_files.TokenSequences(manifest, length=16) as sequences:
        assert len(sequences) == sum(-(-r.n_tokens // 16) for r in manifest.collect()) > 2 * token_files.ROWS_PER_BATCH
        allocated = pa.total_allocated_bytes()
        some = {i: sequences[i] for i in [len(sequences) - 1, *range(0, len(sequences), 97)]}
        assert pa.total_allocated_bytes() == allocated
        for tokens, mask in some.values():
            assert len(tokens) == len(mask) == 16 and not tokens.flags.owndata and not tokens.flags.writeable
        found = [t for i in range(len(sequences)) for t, m in zip(sequences[i][0].tolist(), sequences[i][1].to_pylist()) if m]
        assert found == expected
        with pytest.raises(IndexError):
            sequences[len(sequences)]
    with token_files.TokenSequences(manifest, length=8) as wrong, pytest.raises(ValueError):
        wrong[0]
    with token_files.TokenSequences(manifest.limit(0), length=16) as empty:
        assert len(empty) == 0



def counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = list(zip(words, words[1:], words[2:]))
    times = collections.Counter(windows)
    repeated = {k + i for k, w in enumerate(windows) if times[w] > 1 for i in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated)


def test_quality_counts_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang").collect()
    rows = [tuple(r) for r in docs] + [(9000 + k, t, None) for k, t in enumerate([None, "", " \n", "a b c a b c\n\na b c\nx# $\n" * 30, "é　x y\x85z " * 40])]
    df = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, lang string, kept int")
    out = quality.add_quality(df, BYTE_BPE, PIECE_BPE)
    assert out.columns.count("kept") == 1
    found = {r.doc_id: r for r in out.collect()}
    for key, text, _ in rows:
        r, expected = found[key], counts(text or "")
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == (expected[0] < 50 or 100 * expected[4] > 50 * expected[0])
        assert not (r.base_failed and r.kept)
    assert sum(r.kept for r in found.values()) > 100
    assert quality.add_quality(df.limit(0), BYTE_BPE, PIECE_BPE).count() == 0


def test_fertility_equals_both_libraries_word_by_word():
    from sentencepiece import SentencePieceProcessor

    measure = quality.Fertility(BYTE_BPE, PIECE_BPE, limit=4)
    library, pieces = Tokenizer.from_file(BYTE_BPE), SentencePieceProcessor(model_file=PIECE_BPE)
    library.encode_special_tokens = True
    for text in ("the cat and the dog\x85 日本 the", "<|endoftext|> naïve　x"):
        words = text.encode().split()
        order = {w: k for k, w in enumerate(dict.fromkeys(words))}
        tokens, codes, chars = measure.tokens(order), np.array([order[w] for w in words]), sum(len(w.decode()) for w in words)
        for which, encode in enumerate((lambda w: library.encode(" " + w, add_special_tokens=False).ids, pieces.encode)):
            ids = [i for w in words for i in encode(w.decode())]
            shares = np.array(list(collections.Counter(ids).values())) / len(ids)
            found = measure.measure(which, tokens[which], codes, chars)
            assert found[0] == chars / len(ids) and abs(found[2] + (shares * np.log2(shares)).sum()) < 1e-9


def test_bands_reject_what_a_language_does_not_look_like(spark):
    good = "The quick brown fox jumps over the lazy dog while children play games near the old river bank today. " * 1
    good += " ".join(f"{w}ing {w}er" for w in "walk talk sing read play jump work paint teach clean cook dream help learn open start turn watch want climb build".split())
    noise = " ".join(chr(0x4E00 + k * 37 % 5000) for k in range(80))
    rows = [(1, good, "en"), (2, noise, "en"), (3, noise, None), (4, good, "unknown")]
    out = quality.add_quality(spark.createDataFrame(rows, "doc_id long, text string, lang string"), BYTE_BPE, PIECE_BPE)
    assert {r.doc_id: (r.band, r.kept) for r in out.collect()} == {1: ("en", True), 2: ("en", False), 3: ("cjk", True), 4: ("latin", True)}


PAGE = """<body class="has-sidebar"><header><h1>Site</h1></header><div class=cookie-notice>We use</div><div id=wrap>
<div id=content><h1>Title &amp; more</h1><div class="entry"><p>One, two, three&nbsp;and   four.<p>Five <a href=x>six</a> seven.
<ul><li>i1<li>i2</ul><form><p>sub</p></form><div class="ad">buy</div></div></div><aside>side</aside>
<section id="comments"><p>Nice, very nice, truly, I say, good.</p></section></div><footer>f</footer>"""


@pytest.mark.parametrize(
    "page, text",
    [
        (PAGE, "Title & more\n\nOne, two, three and four.\n\nFive six seven.\n\ni1\n\ni2"),
        ("", ""),
        ("plain text, only", "plain text, only"),
        ("<div>" * 20000 + "a, b.", "a, b."),
        ("<p>a<script>if (x</p>) y", "a"),
        ('<script>var t="</p>";</script><article><p>x<br>y</p></article><nav>n</nav>', "x y"),
        ("<ul><li><a href=1>one</a><li><a href=2>two</a></ul>", ""),
        ("<p>a<!-- <p>b</p> -->c</p>", "ac"),
        ("<article><p><b>One.<br><p>Two.</article>", "One.\n\nTwo."),
    ],
)
def test_main_text(page, text):
    assert html_extract.main_text(page) == text


ARTICLE = "<p>One, two, three and four make ten, he said.</p><p>Five, six, and seven make eighteen, I said.</p>"
ARTICLE_TEXT = "One, two, three and four make ten, he said.\n\nFive, six, and seven make eighteen, I said."
COMMENTS = "<p>Nice, very nice, truly.</p>" * 20


@pytest.mark.parametrize(
    "page",
    [
        f"<body><div id=page class='has-sidebar'><div>{ARTICLE}</div></div></body>",
        f"<div class='site header-fixed'><div class=no-sidebar><div class=sidebar><p>Side, side.</p></div><div>{ARTICLE}</div></div></div>",
        f"<body><form action=x><div>{ARTICLE}</div><nav>n</nav></form><p><a href=x>Home, news</a></p></body>",
        f"<form class=toolbar><fieldset><div>{ARTICLE}</div></fieldset></form><footer>f</footer>",
        f"<div class=popup><p><a href=x>a</a></p></div><form><div>{ARTICLE}</div><div class=comments><p>No.</p></div></form>",
        f"<div><div>{ARTICLE}</div></div><div class=comments>{COMMENTS}</div>",
        f"<div class=with-menu><div>{ARTICLE}</div><div class=comments>{COMMENTS.replace('<p>', '<p class=comment>')}</div></div>",
    ],
)
def test_wrappers_with_unlikely_names_keep_the_article(page):
    assert html_extract.main_text(page) == ARTICLE_TEXT


REMARKS = "".join(f"<div><b>Reader {k}</b><p>I think, as ever, that this is right, and well said, number {k}.</p></div>" for k in range(20))


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<body><article>{ARTICLE}</article><section id=discussion>{REMARKS}</section></body>", ARTICLE_TEXT),
        (f"<body><article>{ARTICLE}</article><section id=voices>{REMARKS}</section></body>", ARTICLE_TEXT),
        (f"<body><article>{ARTICLE}</article><div class=post-comments>{REMARKS * 3}</div></body>", ARTICLE_TEXT),
        (f"<article>{ARTICLE}<ul><li><a href=1>Source one</a><li><a href=2>Source two</a></ul></article>", f"{ARTICLE_TEXT}\n\nSource one\n\nSource two"),
        (f"<article><div class=header><h1>Title</h1></div>{ARTICLE}</article>", f"Title\n\n{ARTICLE_TEXT}"),
        (f"<article>{ARTICLE}<p>So <math><mi>x</mi><mo>=</mo><mn>1</mn></math>.</p></article>", f"{ARTICLE_TEXT}\n\nSo x=1."),
        (f"<body><div>{ARTICLE}</div><ul><li><a href=1>Menu one</a><li><a href=2>Menu two</a></ul></body>", ARTICLE_TEXT),
        (f"<article>{ARTICLE}</article><p title='a > b", ARTICLE_TEXT),
        (f"<article>{ARTICLE}</article><![CDATA[ <p title=", ARTICLE_TEXT),
    ],
)
def test_named_articles_and_their_parts(page, text):
    assert html_extract.main_text(page) == text


@pytest.mark.parametrize(
    "unit, tail",
    [
        ("<a ", ""), ("<![CDATA[", ""), ("<div>", "</span>"), ("<b>", "<p>x</p>y"), ("<script></script ", ""), ("<p title=\"x' ", ""),
        ("<div class=comment>x", ""), ("<td><div>", "</td><p>"), ("<!", ""), ("&amp", "&"),
    ],
)
def test_malformed_pages_take_time_in_proportion(unit, tail):
    import time

    def seconds(n: int) -> float:
        begin = time.perf_counter()
        html_extract.main_text(unit * n + tail * n)
        return time.perf_counter() - begin

    seconds(100)
    assert seconds(40_000) < 20 * seconds(8_000) + 0.5 and seconds(40_000) < 6


def test_a_page_of_unlikely_names_only_still_has_a_text():
    page = "<div class=promo><p>One, two.</p></div><div class=widget><p>Three, four, five.</p></div>"
    assert "Three, four, five." in html_extract.main_text(page)


def test_pages_of_the_tables_give_their_article(spark):
    import html as decode

    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect()
    for (page,) in rows:
        article = re.search(r"<article>(.*)</article>", page, re.S)[1]
        blocks = re.split(r"</?(?:p|h1|li|ul|div|section)[^>]*>", article.replace("<br>", " "))
        blocks = [" ".join(decode.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in blocks]
        assert html_extract.main_text(page) == "\n\n".join(b for b in blocks if b)
    odd = spark.createDataFrame([(1, None, "old"), (2, "<p>x</p>", None)], "page_id long, html string, text string")
    assert sorted(tuple(r) for r in html_extract.extract_main_text(odd).select("page_id", "text").collect()) == [(1, ""), (2, "x")]


def archived(rows):
    first = {}
    for key, _, page in rows:
        payload = (page or "").encode()
        first[payload] = min(first.get(payload, key), key)
    out = []
    for key, _, page in rows:
        payload = (page or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        same = first[payload] == key
        out.append((key, len(payload), digest, "response" if same else "revisit", None if same else first[payload]))
    return sorted(out)


def test_archives_give_back_every_record(spark):
    pages = ["a", None, "", "a", "b" * 300_000, "é", "\r\n\r\nWARC/1.1\r\n", None, "é"]
    rows = [(k, f"http://x/{k} é\r\n", p) for k, p in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    archives, folder = warc.archive_pages(df)
    read = warc.read_archives(archives, folder)
    found = read.select("key", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(tuple(r) for r in found) == archived(rows)
    for r in read.filter("record_type = 'response'").collect():
        assert bytes(r.payload) == (pages[r.key] or "").encode()
    assert read.filter("record_type = 'revisit' AND payload IS NOT NULL").count() == 0
    none, folder = warc.archive_pages(df.limit(0))
    assert warc.read_archives(none, folder).count() == 0


def test_small_payloads_and_null_keys_are_no_revisits(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, "x"), (None, None, "long enough"), (7, "u", "long enough")], "page_id long, url string, html string")
    archives, folder = warc.archive_pages(df, least_bytes=5)
    found = {(r.key, r.record_type, r.refers_to) for r in warc.read_archives(archives, folder).collect()}
    assert found == {(1, "response", None), (2, "response", None), (None, "revisit", 7), (7, "response", None)}


def test_inflating_a_stream_of_several_members_in_pieces():
    import gzip
    import io

    data = warc.record("1", "http://a", b"x" * 1000, "D") + warc.record("2", "http://b", b"", "E", "1", 1000)
    stream = io.BytesIO(gzip.compress(data[:700]) + gzip.compress(data[700:]))
    first, second = warc.records(warc.inflate(stream))
    assert warc.parse(first)[2] == b"x" * 1000
    headers, http, payload = warc.parse(second)
    assert headers["warc-type"] == "revisit" and http["content-length"] == "1000" and payload == b""
    with pytest.raises(ValueError):
        list(warc.records(iter([data[:-2]])))
    assert zlib.crc32(first + second) == zlib.crc32(data)


def test_bands_reject_gibberish_that_passes_the_base_rules(spark):
    rng = np.random.default_rng(1)
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang").collect()]
    letters = list("abcdefghijklmnopqrstuvwxyz")
    noise = [" ".join("".join(rng.choice(letters, rng.integers(2, 11))) for _ in range(200)) for _ in range(12)]
    strokes = [" ".join("".join(map(chr, rng.integers(0x4E00, 0x9FA0, rng.integers(2, 7)))) for _ in range(200)) for _ in range(4)]
    coded = [t.encode("cp037", "ignore").decode("latin-1").replace("@", " ") for _, t, lang in docs if lang == "en" and t and t.isascii()][:20]
    bad = [(t, lang) for t in noise for lang in ("en", "de", "fr", "es", None)] + [(t, None) for t in strokes] + [(t, "en") for t in coded]
    bad += [("".join(map(chr, rng.permutation([ord(c) for c in t]))), lang) for t, lang in zip(noise, ("en", "de", "fr", "es"))]
    rows = docs + [(10_000 + k, *b) for k, b in enumerate(bad)]
    found = quality.add_quality(spark.createDataFrame(rows, "doc_id long, text string, lang string"), BYTE_BPE, PIECE_BPE).collect()
    passed = [r for r in found if not r.base_failed]
    made = [r for r in passed if r.doc_id >= 10_000]
    assert len(made) >= 70 and not any(r.kept for r in made)
    given = [r for r in passed if r.doc_id < 10_000]
    assert sum(r.kept for r in given) >= 0.99 * len(given)


def test_bpe_remembers_a_bounded_number_of_pairs(monkeypatch, library):
    monkeypatch.setattr(bpe, "KNOWN_PAIRS", 50)
    coder = bpe.BpeCoder(BYTE_BPE)
    rng = random.Random(5)
    for _ in range(40):
        text = "".join(rng.choice("abcdefghij éß") for _ in range(80))
        assert list(np.frombuffer(coder.encode(text), dtype="<i4")) == library.encode(text, add_special_tokens=False).ids
        assert len(coder.known) <= 51


def test_columns_are_made_from_a_megabyte_at_a_time(spark):
    def make():
        return lambda part: [pa.array([part.num_rows] * part.num_rows, pa.int64())]

    df = spark.range(3000).select("id", F.repeat(F.lit("x"), 2000).alias("text")).coalesce(1)
    seen = [r.n for r in add_columns(df, [StructField("n", LongType())], make).collect()]
    assert len(seen) == 3000 and max(seen) < 1000


def words_of_syllables(count: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    syllables = ["he", "sh", "ea", "tion", "ing", "ß", "ü", "é", "qu", "x", "on", "aa", "s", "日本"]
    return ["".join(rng.choices(syllables, k=rng.randint(1, 7))) + rng.choice(["", "", ",", ".)", "'s", "42"]) for _ in range(count)]


def test_bpe_encodes_the_new_pieces_of_several_texts_together(monkeypatch, library):
    words = words_of_syllables(6000, 11)
    texts = [" ".join(words[i : i + 100]) for i in range(0, 6000, 100)] + ["a" * 300, "", "<|endoftext|>", "x\0y \0 z"]
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for pairs, together in ((1 << 17, 1 << 16), (3, 50)):
        monkeypatch.setattr(bpe, "KNOWN_PAIRS", pairs)
        monkeypatch.setattr(bpe, "TOGETHER", together)
        coder = bpe.BpeCoder(BYTE_BPE)
        alone, calls = coder.encode_piece, []
        monkeypatch.setattr(coder, "encode_piece", lambda piece: calls.append(piece) or alone(piece))
        found = coder.encode_texts(texts)
        assert [np.frombuffer(f, dtype="<i4").tolist() for f in found] == expected
        assert len(coder.remembered) <= pairs and set(calls) <= {"", "a" * 300}
        rows = [p for p in coder.pieces if p]
        assert coder.encode_pieces(rows) == [alone(p) for p in rows]


def test_unit_cache_makes_what_is_new_in_one_call():
    calls = []
    cache = UnitCache(len, limit=4)
    make = lambda new: calls.append(sorted(new)) or [len(u) for u in new]
    assert cache.all_of({"a", "bb"}, make) == {"a": 1, "bb": 2}
    assert cache.all_of({"bb", "ccc", "d"}, make) == {"bb": 2, "ccc": 3, "d": 1}
    assert cache.all_of({"a"}, make) == {"a": 1} and len(cache) <= 4
    assert calls == [["a", "bb"], ["ccc", "d"], []]
