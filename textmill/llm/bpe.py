"""BPE encoding by dynamic programming over prefixes, and decoding.

Every prefix of a piece has exactly one last token in its BPE encoding. An automaton over the
vocabulary lists the tokens that are suffixes of each prefix; the one whose predecessor - the last
token of what is left before it - is compatible with it is stored. The ids follow from the stored
tokens backwards. Nothing is merged and no queue is kept, so a piece costs time in proportion to
its length. The new pieces of a run of rows are encoded together: prefixes of one length at a time,
each with the tokens that end there.

Two tokens are compatible if BPE, run over their joined text, never merges across their boundary.
"""

from __future__ import annotations

import functools
import json
import re
from array import array
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField
from tokenizers import Tokenizer

from textmill.llm.arrow import add_columns, lists_of, texts_of
from textmill.llm.units import UnitCache, split_with_specials
from textmill.llm.workers import kept_by_worker

NEVER = 1 << 60
# Pairs whose compatibility a worker remembers, 1 MB for pieces encoded together and about 15 MB for long ones.
# The bound affects only speed.
KNOWN_PAIRS = 1 << 17
# Pieces of more characters are encoded by themselves; the others together, about so many characters at a time.
LONG, TOGETHER = 256, 1 << 16
SPREAD = np.uint64(0x9E3779B97F4A7C15)
# A word of Latin letters with its space, then marks: the pre-tokeniser cuts such a unit between the two.
# Units are matched all at once, each with a character after it that no text can hold.
BETWEEN = "\ud800"
_SIMPLE_OR_NOT = re.compile(f"( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([!#$%&()*+,./:;<=>?@^_|~-]*){BETWEEN}|([^{BETWEEN}]*){BETWEEN}")


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of every byte in a byte-level vocabulary: visible Latin-1, else 256 upwards."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Speller:
    """The bytes of every token of one vocabulary file; made once per worker process."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        alphabet = byte_alphabet()
        spelled = {n: bytes(alphabet[c] for c in token) for token, n in spec["model"]["vocab"].items()}
        spelled |= {t["id"]: t["content"].encode() for t in spec.get("added_tokens") or ()}
        rows = [spelled.get(n, b"") for n in range(1 + max(spelled))]
        self.bytes = np.frombuffer(b"".join(rows), dtype=np.uint8)
        self.lengths = np.array([len(r) for r in rows], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def decode(self, ids: np.ndarray) -> str:
        lengths = self.lengths[ids]
        shift = np.repeat(self.starts[ids] - (np.cumsum(lengths) - lengths), lengths)
        return self.bytes[np.arange(len(shift)) + shift].tobytes().decode("utf-8", "replace")


class BpeCoder:
    """Encodes with one vocabulary file; made once per worker process."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, vocab = spec["model"], spec["model"]["vocab"]
        ranks = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        for place, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b, made = vocab[left], vocab[right], vocab[left + right]
            ranks[a, b] = place
            if made not in self.parts:
                self.parts[made], self.rank[made] = (a, b), place
        self.ranks = ranks
        # A token of one character is the last one of a prefix where no longer one fits, so it needs no match.
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        self.single = {token: number for token, number in vocab.items() if len(token) == 1}
        for token, number in vocab.items():
            if len(token) > 1 and self.whole(number):
                self.automaton.add_word(token, number)
        self.automaton.make_automaton()
        self.characters = np.zeros(1 + max(vocab.values()), dtype=np.int64)
        self.characters[list(vocab.values())] = [len(t) for t in vocab]
        self.sizes = self.characters.tolist()
        self.singles = np.full(1 + max(map(ord, self.single)), -1, dtype=np.int64)
        self.singles[[ord(c) for c in self.single]] = list(self.single.values())
        self.left, self.right, self.made = (np.full(len(self.characters), -1, dtype=np.int64) for _ in range(3))
        for number, (a, b) in self.parts.items():
            self.left[number], self.right[number], self.made[number] = a, b, self.rank[number]
        merges = sorted((a << 32 | b, place) for (a, b), place in ranks.items())
        self.merged, self.places = np.array(merges + [(NEVER, NEVER)], dtype=np.int64).T.copy()
        marks = {t["content"]: array("i", [t["id"]]).tobytes() for t in spec.get("added_tokens") or ()}
        self.marks = dict(sorted(marks.items(), key=lambda t: -len(t[0])))
        self.specials = list(self.marks)
        self.pre_tokenizer = Tokenizer.from_file(path).pre_tokenizer
        self.known: dict[int, bool] = {}
        # A pair and whether it fits, at the place that the pair's hash gives; a later pair takes an earlier one's place.
        self.remembered = np.full(1 << (KNOWN_PAIRS.bit_length() - 1), -1, dtype=np.int64)
        self.pieces = UnitCache(self.encode_piece)
        self.units = UnitCache(lambda unit: self.encode_units([unit])[0])
        self.speller = Speller(path)
        self.shown = {b: c for c, b in byte_alphabet().items()}

    def merged_before(self, a: int, b: int, until: int) -> bool:
        """True if a merge of lower rank than ``until`` crosses the boundary between two adjacent tokens.

        The merges that formed the tokens are undone from the last one on; each pair of parts that
        met at the boundary is looked up. Of equal merges the leftmost comes first.
        """
        ranks, parts, rank = self.ranks, self.parts, self.rank
        until_a = until_b = until
        while True:
            met = ranks.get((a, b))
            if met is not None and met < until_a and (met < until_b or met == until_b < until):
                return True
            rank_a, rank_b = rank.get(a, -1), rank.get(b, -1)
            if rank_a > rank_b:
                until_a, a = rank_a, parts[a][1]
            elif rank_b >= 0:
                until_b, b = rank_b, parts[b][0]
            else:
                return False

    def whole(self, token: int) -> bool:
        """True if BPE makes this one token of the token's own text."""
        while token in self.parts:
            (a, b), made = self.parts[token], self.rank[token]
            if self.merged_before(a, b, made) or not (a not in self.parts or self.whole(a)):
                return False
            token = b
        return True

    def encode_piece(self, piece: str) -> bytes:
        """Ids of one pre-token, spelled in the byte alphabet, as little-endian 32-bit integers."""
        last, done, known, sizes = [self.single[c] for c in piece], -1, self.known, self.sizes
        for at, token in self.automaton.iter(piece):
            if at == done:
                continue
            length = sizes[token]
            if length <= at:
                pair = last[at - length] << 32 | token
                fits = known.get(pair)
                if fits is None:
                    if len(known) > KNOWN_PAIRS:
                        known.clear()
                    fits = known[pair] = not self.merged_before(pair >> 32, token, NEVER)
                if not fits:
                    continue
            last[at], done = token, at
        ids, at = [], len(piece) - 1
        while at >= 0:
            token = last[at]
            ids.append(token)
            at -= sizes[token]
        ids.reverse()
        return array("i", ids).tobytes()

    def merged_across(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``merged_before`` without a limit, for many pairs of adjacent tokens."""
        out, which = np.zeros(len(a), dtype=bool), np.arange(len(a))
        until_a = until_b = np.full(len(a), NEVER)
        while len(which):
            pairs = a << 32 | b
            at = np.searchsorted(self.merged, pairs)
            met = np.where(self.merged[at] == pairs, self.places[at], NEVER)
            across = (met < until_a) & ((met < until_b) | (met == until_b))
            out[which[across]] = True
            rank_a, rank_b = self.made[a], self.made[b]
            undo_a = rank_a > rank_b
            go = ~across & (undo_a | (rank_b >= 0))
            until_a, until_b = np.where(undo_a, rank_a, until_a)[go], np.where(undo_a, until_b, rank_b)[go]
            a, b, which = np.where(undo_a, self.right[a], a)[go], np.where(undo_a, b, self.left[b])[go], which[go]
        return out

    def fit(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether each token of ``left`` is compatible with the one of ``right`` after it."""
        pairs, table = left << 32 | right, self.remembered

        def places(of: np.ndarray) -> np.ndarray:
            return (of.view(np.uint64) * SPREAD >> np.uint64(40)).astype(np.int64) & (len(table) - 1)

        held = table[places(pairs)]
        fits, new = (held & 1).astype(bool), held >> 1 != pairs
        if new.any():
            pairs, which = np.unique(pairs[new], return_inverse=True)
            made = ~self.merged_across(pairs >> 32, pairs & 0xFFFFFFFF)
            table[places(pairs)] = pairs << 1 | made
            fits[new] = made[which]
        return fits

    def encode_together(self, pieces: list[str]) -> list[bytes]:
        """The same as ``encode_piece`` for several pieces: the prefixes of one length of all of them at a time."""
        sizes = self.characters
        # The character between the pieces is in no token.
        text = "\n".join(pieces)
        matches = np.fromiter(chain.from_iterable(self.automaton.iter(text)), dtype=np.int64).reshape(-1, 2)
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        starts = np.cumsum(lengths + 1) - lengths - 1
        last = self.singles[np.frombuffer(text.encode("utf-32-le"), dtype="<u4")]
        at = (np.arange(len(last) + 1) - np.repeat(starts, lengths + 1)).astype(np.int16)[matches[:, 0]]
        order = np.argsort(at, kind="stable")
        ends, tokens = matches[order].T
        before = ends - sizes[tokens]
        inside = at[order] >= sizes[tokens]
        bounds = np.cumsum(np.bincount(at)).tolist()
        for a, b in zip([0, *bounds], bounds):
            # The tokens that end at a place follow each other, the longest first.
            fits = ~inside[a:b]
            some = a + np.flatnonzero(inside[a:b])
            fits[some - a] = self.fit(last[before[some]], tokens[some])
            some = a + np.flatnonzero(fits)
            some = some[np.diff(ends[some], prepend=-1) != 0]
            last[ends[some]] = tokens[some]
        steps, which, at = [], np.arange(len(pieces)), starts + lengths - 1
        counts = np.zeros(len(pieces), dtype=np.int64)
        while len(which):
            found = last[at]
            steps.append((which, found))
            counts[which] += 1
            at = at - sizes[found]
            more = at >= starts[which]
            which, at = which[more], at[more]
        stops = np.cumsum(counts)
        ids = np.empty(stops[-1], dtype="<i4")
        for back, (which, found) in enumerate(steps, 1):
            ids[stops[which] - back] = found
        data, cuts = ids.tobytes(), (4 * stops).tolist()
        return [data[a:b] for a, b in zip([0, *cuts], cuts)]

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        made: dict[str, bytes] = {}
        group, size = [], 0
        for piece in sorted(pieces, key=len):
            if not 0 < len(piece) <= LONG:
                made[piece] = self.encode_piece(piece)
                continue
            group.append(piece)
            size += len(piece)
            if size >= TOGETHER:
                made.update(zip(group, self.encode_together(group)))
                group, size = [], 0
        if group:
            made.update(zip(group, self.encode_together(group)))
        return [made[p] for p in pieces]

    def encode_units(self, units: list[str]) -> list[bytes]:
        split = _SIMPLE_OR_NOT.findall(BETWEEN.join(units) + BETWEEN)
        words = "\n".join([word for word, _, _ in split]).encode().decode("latin-1").translate(self.shown).split(self.shown[10])
        others = {u: [p for p, _ in self.pre_tokenizer.pre_tokenize_str(u)] for _, _, u in split if u and u not in self.marks}
        wanted = {*words, *(marks for _, marks, _ in split), *chain.from_iterable(others.values())}
        found = self.pieces.all_of(wanted, self.encode_pieces)
        values = self.marks | {u: b"".join([found[p] for p in parts]) for u, parts in others.items()}
        return [values[u] if u else found[word] + found[marks] for word, (_, marks, u) in zip(words, split)]

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers; what is new in all of them is encoded together."""
        split = [split_with_specials(t, self.specials) for t in texts]
        found = self.units.all_of(set(chain.from_iterable(split)), self.encode_units)
        return [b"".join(map(found.__getitem__, units)) for units in split]

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit integers."""
        return self.encode_texts([text])[0]


def encode_bpe(df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``df`` with the token ids of ``text`` as an array; ``path`` names the vocabulary on every worker.

    A null or empty text has an empty array. Strings of special tokens become their ids. With
    ``decoded``, a column of that name has what the ids spell, decoded in the same pass over the rows.
    Columns of these names are replaced; all others stay. Rows are independent: no shuffle.
    """
    fields = [StructField(ids, ArrayType(IntegerType(), False), False)]
    fields += [StructField(decoded, StringType(), False)] if decoded else []

    def make():
        bpe = kept_by_worker(BpeCoder, path)
        speller = bpe.speller

        def columns(batch: pa.RecordBatch) -> list[pa.Array]:
            blobs = bpe.encode_texts(texts_of(batch.column(text)))
            out = [lists_of(blobs, pa.int32(), 4)]
            if decoded:
                out.append(pa.array([speller.decode(np.frombuffer(b, dtype="<i4")) for b in blobs], pa.string()))
            return out

        return columns

    return add_columns(df, fields, make)


def decode_bpe(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text that ``ids`` spell; bytes that are not UTF-8 become U+FFFD, null ids null."""

    def make():
        speller = kept_by_worker(Speller, path)

        def columns(batch: pa.RecordBatch) -> list[pa.Array]:
            rows = batch.column(ids)
            return [pa.array([speller.decode(r.values.to_numpy()) if r.is_valid else None for r in rows], pa.string())]

        return columns

    return add_columns(df, [StructField(text, StringType())], make)
