"""Jaccard join of documents on word n-grams, by rare shingles, size-banded tiles and bitmap signatures.

In any one order of all shingles, two sets that are similar enough have one in common among the first
few of each: all but so many as a pair must share, and one more. The order goes by the number of sets
that have a shingle, rarest first, so lines that many documents share decide only for documents that
have little else, and chance matches of common words hardly ever. Each shingle is counted in its bucket;
those of several sets go to the sets' homes, and what a set shows of them meets. Documents that show
a shingle in common are joined into candidate clusters, which fall into tiles. Within a tile only
sizes that allow the similarity meet. A bitmap of each set bounds the overlap: bits that one bitmap
has and the other lacks are elements that they do not share. First only the bitmaps, a few bits for
each shingle, meet in tiles; pairs that pass the bound make smaller clusters. For these the sets
meet, and pairs that pass are intersected exactly, unless they are known to belong together already.

Equal sets are one vertex from the start, so thousands of copies cost one set. A few samples of each
set join most near copies beforehand, at a fixed number of rows for each document; what they show
then speaks for such a group as a whole, so near copies make no edges among themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from textmill.llm import hashing
from textmill.llm.arrow import add_columns, slices, texts_of
from textmill.llm.components import components
from textmill.llm.hashing import lower_ascii, mix, word_hashes
from textmill.sources.staging import stage

POSTINGS_PER_BUCKET, SET_BITS = 1_000_000, 14
TILE_ROWS, TILE_SHINGLES = 4096, 1 << 22
SAMPLES, SAMPLE_WIDTH = 8, 3


@dataclass(frozen=True)
class Similarity:
    """Sets are linked if ``den * intersection >= num * union``."""

    num: int
    den: int

    def linked(self, shared: int, a: int, b: int) -> bool:
        return self.den * shared >= self.num * (a + b - shared)

    def band(self, size: int) -> int:
        """Sizes of a band allow the similarity among themselves; similar sets lie in one band or in two that adjoin."""
        return int(np.searchsorted(self.edges(size), size, side="right")) - 1

    def edges(self, size: int) -> list[int]:
        out = [1]
        while out[-1] <= size:
            out.append(out[-1] * self.den // self.num + 1)
        return out

    def parts(self, band: int) -> tuple[int, int]:
        """Number of parts for pairs whose larger set lies in the band, and how many of them may be empty.

        Beyond the elements in which a pair can differ there is one part to be equal, and spare ones, so
        that the equal part is not an empty one.
        """
        low = 1
        for _ in range(band):
            low = low * self.den // self.num + 1
        differ = 2 * (low * self.den // self.num) * (self.den - self.num) // (self.den + self.num)
        if differ == 0:
            return 0, 0
        spare = 3 + differ // 10
        return differ + 1 + spare, spare


    def prefix(self, size: int) -> int:
        """In any one order of all elements, similar sets have one in common among so many first ones of each."""
        return size + self.num * size // -self.den + 1

    def has_others(self, size: int) -> bool:
        """Whether a set of this size can be similar to a different one."""
        return size * self.den // self.num > size or self.prefix(size) > 1


class PartKeys:
    """Keys of a set's parts, for its own band and the next; two similar sets have a key in common.

    Parts need no counts of shingles, but lines that many documents share fill some parts of them. ``link_documents``
    therefore takes rare shingles instead.
    """

    def __init__(self, similarity: Similarity):
        self.similarity, self.known = similarity, {}
        self.edges = np.array(similarity.edges(1 << 31))

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        own = int(np.searchsorted(self.edges, len(hashes), side="right")) - 1
        return np.concatenate([self.of_band(hashes, band) for band in (own, own + 1)])

    def of_band(self, hashes: np.ndarray, band: int) -> np.ndarray:
        if band not in self.known:
            self.known[band] = self.similarity.parts(band)
        count, spare = self.known[band]
        if not count:
            return np.empty(0, np.uint64)
        part = (((hashes >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)).astype(np.int64)
        mixed = mix(hashes)
        # Sums of halves stay below 2**53, so they are exact in floating point.
        low = np.bincount(part, weights=(mixed & np.uint64(0xFFFFFFFF)).astype(np.float64), minlength=count)
        high = np.bincount(part, weights=(mixed >> np.uint64(32)).astype(np.float64), minlength=count)
        key = mix(low.astype(np.uint64) + mix(high.astype(np.uint64) + np.uint64(band)))
        key = mix(key + np.arange(count, dtype=np.uint64))
        filled = np.bincount(part, minlength=count) > 0
        # A set with more empty parts than the spare ones, which is rare, is found by those too.
        return key[filled] if count - int(filled.sum()) <= spare else key


def with_sets(make_set: Callable[[list[str]], list[np.ndarray]], text: str) -> Callable[[pa.RecordBatch], list[np.ndarray]]:
    return lambda batch: make_set(texts_of(batch.column(text)))


def shingle_sets(width: int) -> Callable[[list[str]], list[np.ndarray]]:
    """The sets of hashed shingles of ASCII-lower-cased texts."""
    return lambda texts: hashing.shingle_sets(word_hashes([lower_ascii(t) for t in texts]), width)


def bitmap(hashes: np.ndarray) -> np.ndarray:
    """A bit for each hash in a map of two to four bits for each; a map of half the bits is the union of its halves."""
    bits = 1 << max(6, int(2 * len(hashes) - 1).bit_length()) if len(hashes) else 64
    places = np.zeros(bits, dtype=bool)
    places[(hashes & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(places, bitorder="little").view(np.uint64)


def sample_keys(hashes: np.ndarray) -> np.ndarray:
    """For each of ``SAMPLES`` fixed points the next ``SAMPLE_WIDTH`` hashes of the sorted set, as one key.

    Near copies have most of them in common, unlike sets that only share a passage. They save work, and decide nothing.
    """
    return np.array(sorted(set(all_sample_keys([hashes])[0].tolist())), dtype=np.uint64)


def all_sample_keys(sets: list[np.ndarray]) -> np.ndarray:
    """The samples of sets that are not empty, one row for each."""
    points = mix(np.arange(1, SAMPLES + 1, dtype=np.uint64))
    picked = [s[(np.searchsorted(s, points)[:, None] + np.arange(SAMPLE_WIDTH)) % len(s)] for s in sets]
    picked = np.array(picked, dtype=np.uint64).reshape(-1, SAMPLES, SAMPLE_WIDTH)
    keys = np.tile(points, (len(sets), 1))
    for k in range(SAMPLE_WIDTH):
        keys = mix(keys + picked[:, :, k])
    return keys


def set_keys(df: DataFrame, text: str, width: int) -> DataFrame:
    """``df`` with ``n_shingles``, ``set_key``, equal for equal sets only and null for an empty one, ``bitmap`` and ``samples``."""

    def make():
        sets = with_sets(shingle_sets(width), text)

        def columns(batch: pa.RecordBatch) -> list[pa.Array]:
            found = sets(batch)
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in found]
            maps = [bitmap(s).tobytes() for s in found]
            drawn = iter(all_sample_keys([s for s in found if len(s)]).view(np.int64).tolist())
            samples = [sorted(set(next(drawn))) if len(s) else [] for s in found]
            sizes = pa.array([len(s) for s in found], pa.int64())
            return [sizes, pa.array(keys, pa.binary()), pa.array(maps, pa.binary()), pa.array(samples, pa.list_(pa.int64()))]

        return columns

    fields = [StructField("n_shingles", LongType(), False), StructField("set_key", BinaryType()), StructField("bitmap", BinaryType())]
    fields.append(StructField("samples", ArrayType(LongType())))
    return add_columns(df, fields, make)


def forest(edges: np.ndarray) -> np.ndarray:
    """Edges from each vertex to the smallest that it reaches: the same components by one edge for each vertex but one."""
    if not len(edges):
        return edges
    vertices, ends = np.unique(edges, return_inverse=True)
    ends, root = ends.reshape(-1, 2), np.arange(len(vertices))
    while len(ends):
        low = ends.min(axis=1)
        for side in (0, 1):
            np.minimum.at(root, ends[:, side], low)
        while not np.array_equal(jump := root[root], root):
            root = jump
        ends = root[ends]
        ends = np.unique(ends[ends[:, 0] != ends[:, 1]], axis=0)
    out = np.stack([vertices, vertices[root]], axis=1)
    return out[out[:, 0] != out[:, 1]]


def _pairs_with_least(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by key and id; the first row of each key, and a forest of the ids that have keys in common."""
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    first = np.concatenate([[True], keys[1:] != keys[:-1]])
    least = ids[np.flatnonzero(first)][np.cumsum(first) - 1]
    other = ids != least
    edges = forest(np.unique(np.stack([ids[other], least[other]], axis=1), axis=0)) if other.any() else np.empty((0, 2), np.int64)
    return keys[first], ids[first], edges


def _planes(values: np.ndarray) -> bytes:
    """The first bytes of all values, then the second ones, and so on: what is equal among them packs well."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.dtype.itemsize).T.tobytes()


def _values(blobs: list[bytes], dtype: type) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    parts = [np.frombuffer(b, dtype=np.uint8).reshape(width, -1).T for b in blobs]
    return np.ascontiguousarray(np.concatenate(parts)).view(dtype).ravel() if parts else np.empty(0, dtype)


def _cuts(ordered: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin, and the end."""
    if not len(ordered):
        return np.zeros(1, np.int64)
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1], [True]]))


def _dealt(values: np.ndarray, parts: int) -> np.ndarray:
    """A part for each value, by the upper half of its bits."""
    return (((values >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int32)


def _by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """Each value of the first column with its rows, from rows in its order."""
    current, rows = None, []
    for batch in batches:
        for part, *row in zip(*(batch.column(c).to_pylist() for c in range(batch.num_columns))):
            if part != current:
                if rows:
                    yield current, rows
                current, rows = part, []
            rows.append(row)
    if rows:
        yield current, rows


def _rows_of(rows: list[tuple], schema: StructType) -> pa.RecordBatch:
    kinds = {IntegerType(): pa.int32(), BinaryType(): pa.binary()}
    return pa.record_batch([pa.array(v, kinds[f.dataType]) for v, f in zip(zip(*rows), schema)], names=schema.names)


def _regrouped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType) -> DataFrame:
    part = df.columns[0]
    return df.repartition(part).sortWithinPartitions(part).mapInArrow(run, schema)


def post_shingles(docs: DataFrame, similarity: Similarity, width: int, buckets: int) -> DataFrame:
    """Blocks ``bucket, refs, tokens, sizes, groups`` of the shingles of the sets, from ``id, group, many, text``.

    A token is a shingle's bucket and 32 more bits of its hash. A set's ``ref`` is its document's id, or a hash
    of id and set if the document has ``many`` sets. Blocks without tokens have a set's number of tokens, the
    number of them that it needs to show (its prefix) and its group.
    """
    schema = _schema("bucket", "refs", "tokens", "sizes", "groups")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = shingle_sets(width)
        for batch in batches:
            for part in (p.slice(k, 1 << SET_BITS) for p in slices(batch, 8 << 20) for k in range(0, p.num_rows, 1 << SET_BITS)):
                # Bucket, token and place of the set fill one number of 64 bits, so that one sort orders them.
                sets = make(texts_of(part.column("text")))
                refs = part.column("id").to_numpy().copy()
                for k in np.flatnonzero(part.column("many").to_numpy(zero_copy_only=False)):
                    own = hashlib.blake2b(refs[k].tobytes() + sets[k].tobytes(), digest_size=8).digest()
                    refs[k] = np.frombuffer(own, np.int64)[0]
                sizes = np.array([len(s) for s in sets])
                sizes[[not similarity.has_others(n) for n in sizes.tolist()]] = 0
                if not sizes.any():
                    continue
                hashes = np.concatenate([s[:n] for s, n in zip(sets, sizes.tolist())])
                keys = (_dealt(hashes, buckets).astype(np.uint64) << np.uint64(32)) | (hashes & np.uint64(0xFFFFFFFF))
                keys = np.sort((keys << np.uint64(SET_BITS)) | np.repeat(np.arange(len(sets), dtype=np.uint64), sizes))
                keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
                owner = (keys & np.uint64((1 << SET_BITS) - 1)).astype(np.int64)
                keys >>= np.uint64(SET_BITS)
                bucket, tokens, of = (keys >> np.uint64(32)).astype(np.int32), keys.astype(np.uint32), refs[owner]
                cuts = _cuts(bucket)
                rows = [(int(bucket[a]), _planes(of[a:b]), _planes(tokens[a:b]), None, None) for a, b in zip(cuts[:-1], cuts[1:])]
                used = np.flatnonzero(sizes)
                shown = np.array([similarity.prefix(n) for n in sizes[used].tolist()])
                numbers = np.stack([np.bincount(owner, minlength=len(sets))[used], shown], axis=1)
                groups = part.column("group").to_numpy()[used]
                rows.append((int(used[0] + bucket[0]) % buckets, _planes(refs[used]), None, _planes(numbers), _planes(groups)))
                yield _rows_of(rows, schema)

    return docs.mapInArrow(run, schema)


def repeated_shingles(posted: DataFrame, homes: int) -> DataFrame:
    """Blocks ``home, refs, keys, rarity, sizes, groups`` of the tokens that several sets have, for the sets' homes.

    ``rarity`` is eight times the logarithm of the number of sets. Blocks about sets pass through.
    """
    schema = _schema("home", "refs", "keys", "rarity", "sizes", "groups")

    def to_homes(refs: np.ndarray, *columns: np.ndarray | None) -> list[tuple]:
        home = _dealt(mix(refs.view(np.uint64)), homes)
        order = np.argsort(home, kind="stable")
        cuts = _cuts(home[order])
        some = [order[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        return [(int(home[k[0]]), _planes(refs[k]), *(None if c is None else _planes(c[k]) for c in columns)) for k in some]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _by_part(batches):
            for refs, tokens, sizes, groups in rows:
                if tokens is None:
                    about = to_homes(_values([refs], np.int64), None, None, _values([sizes], np.int64).reshape(-1, 2), _values([groups], np.int64))
                    yield _rows_of(about, schema)
            refs, tokens = (_values([r[k] for r in rows if r[1] is not None], kind) for k, kind in ((0, np.int64), (1, np.uint32)))
            order = np.sort((tokens.astype(np.uint64) << np.uint64(32)) | np.arange(len(tokens), dtype=np.uint64))
            cuts = _cuts(order >> np.uint64(32))
            order = (order & np.uint64(0xFFFFFFFF)).astype(np.int64)
            order = order[np.repeat(np.diff(cuts) > 1, np.diff(cuts))]
            # Rows that stand twice in the table are one set.
            order = order[np.lexsort((refs[order], tokens[order]))]
            refs, tokens = refs[order], tokens[order]
            if len(refs):
                new = np.concatenate([[True], (tokens[1:] != tokens[:-1]) | (refs[1:] != refs[:-1])])
                refs, tokens = refs[new], tokens[new]
            times = np.diff(_cuts(tokens))
            rarity = np.repeat(np.minimum(8 * np.log2(np.maximum(times, 1)), 255).astype(np.uint8), times)
            keys = (np.uint64(bucket) << np.uint64(32)) | tokens.astype(np.uint64)
            several = np.repeat(times > 1, times)
            if several.any():
                yield _rows_of(to_homes(refs[several], keys[several], rarity[several], None, None), schema)

    return _regrouped(posted, run, schema)


def shown_shingles(repeated: DataFrame, parts: int) -> DataFrame:
    """Blocks ``part, groups, keys`` of the tokens among each set's rarest that other sets have too."""
    schema = _schema("part", "groups", "keys")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _by_part(batches):
            about, rows = [r for r in rows if r[1] is None], [r for r in rows if r[1] is not None]
            known, place = np.unique(_values([r[0] for r in about], np.int64), return_index=True)
            sizes = _values([r[3] for r in about], np.int64).reshape(-1, 2)[place]
            groups = _values([r[4] for r in about], np.int64)[place]
            refs, keys, rarity = (_values([r[k] for r in rows], kind) for k, kind in ((0, np.int64), (1, np.uint64), (2, np.uint8)))
            owner = np.searchsorted(known, refs)
            # Tokens of one set only stand first and meet nothing, so most sets show none.
            several = np.bincount(owner, minlength=len(known))
            shown = sizes[:, 1] - (sizes[:, 0] - several)
            some = shown[owner] > 0
            owner, keys, rarity = owner[some], keys[some], rarity[some]
            order = np.lexsort((keys, rarity, owner))
            owner, keys = owner[order], keys[order]
            first = _cuts(owner)
            number = np.arange(len(owner)) - np.repeat(first[:-1], np.diff(first))
            kept = number < shown[owner]
            owner, keys = owner[kept], keys[kept]
            part = _dealt(mix(keys), parts)
            order = np.argsort(part, kind="stable")
            cuts = _cuts(part[order])
            blocks = [order[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
            if blocks:
                yield _rows_of([(int(part[k[0]]), _planes(groups[owner[k]]), _planes(keys[k])) for k in blocks], schema)

    return _regrouped(repeated, run, schema)


def candidate_edges(docs: DataFrame, similarity: Similarity, width: int, buckets: int) -> DataFrame:
    """``a, b``: a forest, for each part of the tokens, of the groups whose sets show a token in common, from ``id, group, many, text``.

    All tokens go to their buckets once, where it is counted how many sets have each. Those of several sets go
    to the sets' homes, which put them in order, and what a set shows of them meets. The order is the same for all
    sets, so two similar ones show a token in common; a chance match of tokens only adds a candidate.
    """
    schema = StructType([StructField("a", LongType()), StructField("b", LongType())])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _by_part(batches):
            groups, keys = (_values([r[k] for r in rows], kind) for k, kind in ((0, np.int64), (1, np.uint64)))
            yield _edge_batch(_pairs_with_least(keys, groups)[2])

    homes = 1 + buckets // 4
    shown = shown_shingles(repeated_shingles(post_shingles(docs, similarity, width, buckets), homes), homes)
    return _regrouped(shown, meet, schema)


def _schema(part: str, *blobs: str) -> StructType:
    return StructType([StructField(part, IntegerType()), *(StructField(b, BinaryType()) for b in blobs)])


def sample_edges(classes: DataFrame) -> DataFrame:
    """``a, b``: each id with the smallest that has a sample in common, from ``id, samples``."""
    rows = classes.select(F.col("id").alias("a"), F.explode("samples").alias("sample"))
    least = rows.groupBy("sample").agg(F.min("a").alias("b"), F.count("*").alias("times")).filter("times > 1")
    return rows.join(least.hint("merge"), "sample").filter("a <> b").select("a", "b")


def _edge_batch(edges: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array(edges[:, 0]), pa.array(edges[:, 1])], names=["a", "b"])


class Tile:
    """Sets that meet in one task, and the links among them as a forest of their ids.

    Without ``sets``, pairs whose bitmaps allow the similarity count as links.
    """

    def __init__(self, ids: list[int], sizes: list[int], maps: list[np.ndarray], sets: list[np.ndarray] | None, similarity: Similarity):
        order = sorted(range(len(ids)), key=lambda i: (sizes[i], ids[i]))
        self.ids, self.sizes = np.array([ids[i] for i in order], dtype=np.int64), np.array([sizes[i] for i in order])
        self.sets = None if sets is None else [sets[i] for i in order]
        self.root, self.similarity = np.arange(len(ids)), similarity
        # Maps grow with the sets, so those of one width stand together.
        words = np.array([len(maps[i]) for i in order])
        cuts = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1], [True]]))
        self.groups = [(a, b, {int(words[a]): np.stack([maps[order[k]] for k in range(a, b)])}) for a, b in zip(cuts[:-1], cuts[1:])]

    def folded(self, maps: dict[int, np.ndarray], words: int) -> np.ndarray:
        if words not in maps:
            wide = self.folded(maps, 2 * words)
            maps[words] = wide[:, :words] | wide[:, words:]
        return maps[words]

    def overlap_bound(self, i: int, here: np.ndarray, others: np.ndarray, maps: np.ndarray) -> np.ndarray:
        return np.minimum(
            self.sizes[i] - np.bitwise_count(here & ~maps).sum(axis=1, dtype=np.int64),
            self.sizes[others] - np.bitwise_count(maps & ~here).sum(axis=1, dtype=np.int64),
        )

    def join(self) -> np.ndarray:
        """Edges from each id to the smallest that its links reach within the tile."""
        sizes, root, sim = self.sizes, self.root, self.similarity
        for number, (begin, end, maps) in enumerate(self.groups):
            words = max(maps)
            for i in range(begin, end):
                last = int(np.searchsorted(sizes, sizes[i] * sim.den // sim.num, side="right"))
                here = maps[words][i - begin]
                for first, stop, wider in self.groups[number:]:
                    low, high = max(first, i + 1), min(stop, last)
                    if low < high:
                        others = low + np.flatnonzero(root[low:high] != root[i])
                        for at in range(0, len(others), 4096):
                            some = others[at : at + 4096]
                            shared = self.overlap_bound(i, here, some, self.folded(wider, words)[some - first])
                            self.link(i, some[sim.den * shared >= sim.num * (sizes[i] + sizes[some] - shared)])
        least = np.full(len(self.ids), np.iinfo(np.int64).max)
        np.minimum.at(least, root, self.ids)
        edges = np.stack([self.ids, least[root]], axis=1)
        return edges[edges[:, 0] != edges[:, 1]]

    def link(self, i: int, others: np.ndarray) -> None:
        for j in others.tolist():
            if self.root[j] != self.root[i]:
                if self.sets is not None:
                    both = len(np.intersect1d(self.sets[i], self.sets[j], assume_unique=True))
                    if not self.similarity.linked(both, len(self.sets[i]), len(self.sets[j])):
                        continue
                self.root[self.root == self.root[j]] = self.root[i]


def tile_links(rows: DataFrame, similarity: Similarity, exact: bool) -> DataFrame:
    """``a, b``: a forest of the links within each tile, from ``tile, id, n, bits``.

    ``bits`` are the sorted hashes of the set if ``exact``, else its bitmap.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows = None, []

        def close() -> Iterator[pa.RecordBatch]:
            if len(rows) > 1:
                ids, sizes, bits = zip(*rows)
                arrays = [np.frombuffer(b, dtype=np.uint64) for b in bits]
                maps = [bitmap(a) for a in arrays] if exact else arrays
                edges = Tile(ids, sizes, maps, arrays if exact else None, similarity).join()
                if len(edges):
                    yield _edge_batch(edges)

        for batch in batches:
            for tile, *row in zip(*(batch.column(c).to_pylist() for c in ("tile", "id", "n", "bits"))):
                if tile != current:
                    yield from close()
                    current, rows = tile, []
                rows.append(row)
        yield from close()

    schema = StructType([StructField("a", LongType()), StructField("b", LongType())])
    return rows.repartition("tile").sortWithinPartitions("tile").mapInArrow(run, schema)


def link_documents(
    df: DataFrame, similarity: Similarity = Similarity(85, 100), width: int = 4, row_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``df``.

    ``row_id`` must be a whole number; rows of one id are one document, and a row with a null id or
    without words is linked with nothing. Texts are lower-cased in ASCII; words are runs without ASCII
    white space; a text of fewer words than ``width`` is one shingle. Other columns are not read.

    The text is scanned for the set keys, shuffled to the distinct sets' ids for their shingles, and
    once more for the sets of the documents whose bitmaps have a similar one. Shingles move as packed blocks in buckets whose number follows
    theirs. Clusters beyond a tile's bounds are cut into a grid of tiles within size bands.
    """
    docs = df.select(F.col(row_id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    keyed = stage(set_keys(docs, "text", width).drop("text"), "sets")
    known = keyed.filter("id IS NOT NULL AND set_key IS NOT NULL")
    classes = known.groupBy("set_key").agg(F.min("id").alias("id"), F.first("n_shingles").alias("n"), F.first("samples").alias("samples"))
    classes = stage(classes, "classes")
    postings = classes.agg(F.sum("n")).head()[0] or 0
    buckets = min(1 + postings // POSTINGS_PER_BUCKET, 1 << (32 - SET_BITS))
    # Ids grow with the documents: they are joined by merging at every size, not sent to all tasks.
    groups = components(sample_edges(classes))
    many = known.groupBy("id").agg((F.min("set_key") != F.max("set_key")).alias("many"))
    own = classes.select("id").distinct().join(many.hint("merge"), "id").join(groups.hint("merge"), "id", "left")
    own = own.select("id", F.coalesce("component", "id").alias("group"), "many").hint("merge")
    spoken = docs.join(own, "id").select("id", "group", "many", "text")
    edges = candidate_edges(spoken, similarity, width, buckets)
    near = components(edges.unionByName(groups.select(F.col("id").alias("a"), F.col("component").alias("b"))))

    placed = _placed(near.join(classes, "id"), similarity).hint("merge")
    maps = keyed.select("id", F.col("n_shingles").alias("n"), F.col("bitmap").alias("bits"))
    near = components(tile_links(_tiled(maps.join(placed, "id")), similarity, exact=False))

    def make():
        sets = with_sets(shingle_sets(width), "text")
        return lambda batch: [pa.array([s.tobytes() for s in sets(batch)], pa.binary())]

    placed = _placed(near.join(classes, "id"), similarity).hint("merge")
    sets = add_columns(docs.join(placed, "id"), [StructField("bits", BinaryType(), False)], make).drop("text")
    sets = sets.withColumn("n", (F.length("bits") / 8).cast("long"))
    linked = components(tile_links(_tiled(sets), similarity, exact=True))
    vertices = classes.join(linked, "id", "left").select("set_key", F.coalesce("component", "id").alias("component"))
    out = keyed.join(vertices, "set_key", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(F.col("id").alias(row_id), "n_shingles", component.alias("component_id"))


def _placed(members: DataFrame, similarity: Similarity) -> DataFrame:
    """``id, tiles``: a cluster within the bounds is one tile; a larger one has tiles for each band of sizes.

    The tile of a band has its own sets and those of the band below, which may be similar to them. If
    even these are too many, they are dealt to blocks, and each pair of blocks is a tile: a set takes
    part in the row and in the column of its block.
    """
    clusters = members.groupBy("component").agg(F.count("*").alias("members"), F.sum("n").alias("shingles"))
    members = members.join(clusters.filter("members > 1"), "component")
    # A little wider than the similarity allows, so that rounding can't part two sets by more than one band.
    width = 1.0001 * float(np.log(similarity.den / similarity.num))
    rows = members.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / F.lit(width)).cast("int"))
    small = (F.col("members") <= TILE_ROWS) & (F.col("shingles") <= TILE_SHINGLES)
    whole = rows.filter(small).select("id", F.col("component").cast("string").alias("tile"))
    rows = rows.filter(~small)
    own = rows.groupBy("component", "band").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
    below = own.select("component", (F.col("band") + 1).alias("band"), F.col("c").alias("c0"), F.col("s").alias("s0"))
    count, shingles = (F.col(a) + F.coalesce(F.col(b), F.lit(0)) for a, b in (("c", "c0"), ("s", "s0")))
    blocks = F.ceil(F.greatest(count / F.lit(TILE_ROWS), shingles / F.lit(TILE_SHINGLES))).cast("int").alias("blocks")
    bands = own.join(below, ["component", "band"], "left").select("component", "band", blocks)
    meets = rows.select("id", "component", F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("band"))
    meets = meets.join(bands, ["component", "band"])
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    meets = meets.select("id", "component", "band", block.alias("block"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    tile = F.concat_ws(".", "component", "band", F.least("block", "other"), F.greatest("block", "other"))
    placed = whole.unionByName(meets.select("id", tile.alias("tile")))
    return stage(placed.groupBy("id").agg(F.collect_list("tile").alias("tiles")), "placed")


def _tiled(rows: DataFrame) -> DataFrame:
    return rows.select(F.explode("tiles").alias("tile"), "id", "n", "bits")
