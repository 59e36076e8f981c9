"""Quality rules: word counts of every text, and the fertility of public tokenisers on it.

Fertility is measured with two public vocabularies, a byte-level BPE and a BPE with byte fallback.
Both encode each distinct word of a text once; the counts of the words weigh the tokens. Text of a
language that the vocabularies know takes few tokens for a character, hardly falls back to bytes,
and spreads over many tokens. Bands of these measures, chosen by the row's language or else by the
script of its letters, decide what is kept.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField
from sentencepiece import SentencePieceProcessor

from textmill.llm.arrow import add_columns, texts_of
from textmill.llm.token_files import LibraryEncoder
from textmill.llm.workers import kept_by_worker

SYMBOLS = b"#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Bounds:
    """What a vocabulary may measure on a text that is accepted."""

    least_chars: float
    most_chars: float
    most_fallback: float
    least_entropy: float


# For each band the bounds of the byte-level and of the piece vocabulary: characters for each token, share of
# byte-fallback tokens, and entropy in bits of the tokens. Floors of the four languages lie about a tenth
# below the lowest of clean texts and above words of random letters (1.5 to 1.6). Other languages in Latin
# letters take more tokens of the byte vocabulary. A script whose letters a vocabulary lacks is spelled in
# bytes but for the marks of its words' beginnings; of Chinese the piece vocabulary has the frequent characters.
BANDS: Mapping[str, tuple[Bounds, Bounds]] = {
    "en": (Bounds(1.70, 9.0, 0.12, 4.0), Bounds(1.70, 9.0, 0.05, 4.0)),
    "de": (Bounds(1.65, 9.0, 0.15, 4.0), Bounds(1.70, 9.0, 0.05, 4.0)),
    "fr": (Bounds(1.60, 9.0, 0.15, 4.0), Bounds(1.65, 9.0, 0.05, 4.0)),
    "es": (Bounds(1.55, 9.0, 0.15, 4.0), Bounds(1.65, 9.0, 0.05, 4.0)),
    "latin": (Bounds(1.20, 10.0, 0.40, 3.0), Bounds(1.60, 10.0, 0.20, 3.0)),
    "greek": (Bounds(0.40, 8.0, 0.60, 3.0), Bounds(0.60, 8.0, 0.30, 3.0)),
    "cyrillic": (Bounds(0.40, 8.0, 0.60, 3.0), Bounds(1.00, 8.0, 0.30, 3.0)),
    "cjk": (Bounds(0.20, 4.0, 0.95, 3.0), Bounds(0.20, 4.0, 0.80, 3.0)),
    "other": (Bounds(0.25, 10.0, 0.97, 2.5), Bounds(0.25, 10.0, 0.97, 2.5)),
}

# Letters by which the script of a text is told; the most frequent group counts.
SCRIPTS = {
    "latin": re.compile("[A-Za-z\xaa\xba\xc0-ɏḀ-ỿ]"),
    "greek": re.compile("[Ͱ-Ͽἀ-῿]"),
    "cyrillic": re.compile("[Ѐ-ԯ]"),
    "cjk": re.compile("[぀-ヿ㐀-鿿가-힯]"),
    "other": re.compile("[԰-᷿]"),
}

MEASURES = ("byte_chars_per_token", "byte_fallback", "byte_entropy", "piece_chars_per_token", "piece_fallback", "piece_entropy")


class Fertility:
    """Tokens of single words under both vocabularies, kept by word; made once per worker process.

    Words that are new in a batch are encoded together. ``limit`` bounds memory only: words that fell
    out are encoded again.
    """

    def __init__(self, byte_path: str, piece_path: str, limit: int = 120_000):
        self.bytes = LibraryEncoder(byte_path, special_as_text=True)
        self.pieces = SentencePieceProcessor(model_file=piece_path)
        vocabulary = self.bytes.library.get_vocab()
        alone = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        ascii_ = {chr(b) for b in range(33, 127)} | {"Ġ"}
        for token, number in vocabulary.items():
            alone[number] = len(token) == 1 and token not in ascii_
        fallback = np.array([self.pieces.is_byte(i) for i in range(self.pieces.get_piece_size())])
        self.spelled = (alone, fallback)
        self.kinds = (self.bytes.narrow, np.dtype("<u2" if len(fallback) <= 1 << 16 else "<u4"))
        self.known: dict[bytes, tuple[bytes, bytes]] = {}
        self.limit = limit

    def tokens(self, words: dict[bytes, int]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each vocabulary the ids of all words in order, where each word's ids start, and how many there are."""
        missing = [w for w in words if w not in self.known]
        if len(self.known) + len(missing) > self.limit:
            self.known = {w: self.known[w] for w in words if w in self.known}
        texts = [w.decode() for w in missing]
        by_bytes = self.bytes.encode_units([f" {t}" for t in texts])
        by_pieces = [np.array(ids, dtype=self.kinds[1]).tobytes() for ids in self.pieces.encode(texts, num_threads=1)]
        self.known.update(zip(missing, zip(by_bytes, by_pieces)))
        found = [self.known[w] for w in words]
        out = []
        for which in (0, 1):
            blobs = [f[which] for f in found]
            ids = np.frombuffer(b"".join(blobs), dtype=self.kinds[which]).astype(np.int32)
            sizes = np.array([len(b) for b in blobs], dtype=np.int64) // self.kinds[which].itemsize
            out.append((ids, np.cumsum(sizes) - sizes, sizes))
        return out

    def measure(self, which: int, tokens: tuple, codes: np.ndarray, chars: int) -> tuple[float, float, float]:
        """Characters per token, fallback share and entropy in bits; zeros without tokens."""
        ids, starts, sizes = tokens
        own = sizes[codes]
        total = int(own.sum())
        if not total:
            return 0.0, 0.0, 0.0
        shift = np.repeat(starts[codes] - (np.cumsum(own) - own), own)
        here = ids[np.arange(total) + shift]
        spelled = int(self.spelled[which][here].sum())
        here.sort()
        edges = np.flatnonzero(np.concatenate([[True], here[1:] != here[:-1], [True]]))
        counts = np.diff(edges)
        entropy = np.log2(total) - float((counts * np.log2(counts)).sum()) / total
        return chars / total, spelled / total, max(0.0, float(entropy))


def repeated_windows(codes: np.ndarray, distinct: int, width: int = 3) -> int:
    """Words that lie in a window of ``width`` words found twice or more; ``codes`` number the words."""
    n = len(codes)
    if n <= width:
        return 0
    windows = codes[: n - width + 1]
    for k in range(1, width):
        if k > 1 and distinct ** (k + 1) >= 1 << 62:
            windows = np.unique(windows, return_inverse=True)[1]
        windows = windows * distinct + codes[k : n - width + 1 + k]
    ordered = np.sort(windows)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    repeated = np.isin(windows, twice)
    covered = np.zeros(n, dtype=bool)
    for k in range(width):
        covered[k : n - width + 1 + k] |= repeated
    return int(covered.sum())


def script_of(text: str) -> str:
    if text.isascii():
        return "latin"
    counts = {name: len(pattern.findall(text)) for name, pattern in SCRIPTS.items()}
    best = max(counts, key=counts.get)
    return best if counts[best] else "other"


def add_quality(
    df: DataFrame, byte_path: str, piece_path: str, text: str = "text", language: str | None = "lang",
    bands: Mapping[str, tuple[Bounds, Bounds]] = BANDS, least_words: int = 50, most_repeated: int = 50,
) -> DataFrame:
    """``df`` with word counts, the measures of both vocabularies, and the verdict of the rules.

    Words are runs without ASCII white space. Added: ``n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, band``, the six ``MEASURES`` and ``kept``. ``base_failed``: fewer
    than ``least_words`` words, or more than ``most_repeated`` per cent of them in repeated windows
    of three. ``band`` is the row's language if ``bands`` has it (null, unknown or no such column:
    the script of the text). A null text counts as empty: no words, not kept. Columns of these
    names are replaced. Rows are independent: no shuffle, whole texts.
    """
    has_language = language is not None and language in df.columns
    fields = [StructField(n, LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    fields += [StructField("base_failed", BooleanType()), StructField("band", StringType())]
    fields += [StructField(n, DoubleType()) for n in MEASURES] + [StructField("kept", BooleanType())]

    def make():
        tokens = kept_by_worker(Fertility, byte_path, piece_path)

        def row(value: str, data: bytes, words: list[bytes], lang: str | None, order: dict[bytes, int], found: list) -> tuple:
            n, chars = len(words), len(value) - sum(map(value.count, WHITE))
            codes = np.fromiter(map(order.__getitem__, words), dtype=np.int64, count=n)
            lines = [line for line in data.split(b"\n") if line.strip()]
            repeats = repeated_windows(codes, len(order))
            symbols = len(data) - len(data.translate(None, SYMBOLS))
            failed = n < least_words or 100 * repeats > most_repeated * n
            name = lang if lang in bands else script_of(value)
            measures = [m for which in (0, 1) for m in tokens.measure(which, found[which], codes, chars)]
            kept = not failed and all(
                bounds.least_chars <= measures[k] <= bounds.most_chars
                and measures[k + 1] <= bounds.most_fallback
                and measures[k + 2] >= bounds.least_entropy
                for k, bounds in zip((0, 3), bands[name])
            )
            return n, chars, symbols, len(lines) - len(set(lines)), repeats, failed, name, *measures, kept

        def columns(batch: pa.RecordBatch) -> list[pa.Array]:
            values = texts_of(batch.column(text))
            langs = batch.column(language).to_pylist() if has_language else [None] * len(values)
            data = [v.encode() for v in values]
            words = [d.split() for d in data]
            order = {w: k for k, w in enumerate(dict.fromkeys(itertools.chain.from_iterable(words)))}
            found = tokens.tokens(order)
            made = list(zip(*(row(*doc, order, found) for doc in zip(values, data, words, langs))))
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.string()] + [pa.float64()] * 6 + [pa.bool_()]
            return [pa.array(v, k) for v, k in zip(made, kinds)]

        return columns

    return add_columns(df, fields, make)
