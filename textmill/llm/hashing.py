"""Vectorised 64-bit hashes of words, shingles and byte strings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 5  # odd; its distance from 1 holds few factors of two
CHUNK = 1 << 20

_tables: dict[int, np.ndarray] = {}
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_values(seed: int) -> np.ndarray:
    if seed not in _tables:
        _tables[seed] = mix(np.arange(1 + 1000 * seed, 257 + 1000 * seed, dtype=np.uint64) * np.uint64(BASE))
    return _tables[seed]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base, and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        for k, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            steps = np.full(max(n, CHUNK + 1024), base, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0][:n], _powers[1][:n]


def prefix_sums(data: np.ndarray, seed: int = 0) -> np.ndarray:
    """Sums from which ``span_hashes`` takes the hash of any span of the bytes."""
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(byte_values(seed)[data] * powers(len(data))[0], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the bytes from each start to its end; equal bytes have equal hashes wherever they stand."""
    return mix((sums[ends] - sums[starts]) * powers(len(sums))[1][starts])


def _chunks(data: bytes) -> Iterator[tuple[int, bytes]]:
    """Parts of about ``CHUNK`` bytes that end at a space or line feed."""
    at = 0
    while at < len(data):
        stop = at + CHUNK
        if stop < len(data):
            cut = max(data.rfind(b" ", at, stop), data.rfind(b"\n", at, stop))
            if cut <= at:
                cut = min([c for c in (data.find(b" ", stop), data.find(b"\n", stop)) if c >= 0], default=len(data))
            stop = cut
        yield at, data[at:stop]
        at = stop


def word_hashes(texts: list[bytes]) -> list[np.ndarray]:
    """For each text the hashes of its words: runs without ASCII white space, as they stand."""
    bounds = np.cumsum([0] + [len(t) + 1 for t in texts])
    places, hashes = [], []
    for at, part in _chunks(b" ".join(texts)):
        data = np.frombuffer(part, dtype=np.uint8)
        inside = np.concatenate([[False], _IS_WORD[data], [False]])
        starts = np.flatnonzero(inside[1:] & ~inside[:-1])
        ends = np.flatnonzero(~inside[1:] & inside[:-1])
        places.append(starts + at)
        hashes.append(span_hashes(prefix_sums(data), starts, ends))
    if not places:
        return [np.empty(0, np.uint64) for _ in texts]
    cuts = np.searchsorted(np.concatenate(places), bounds)
    flat = np.concatenate(hashes)
    return [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def shingle_sets(words: list[np.ndarray], width: int) -> list[np.ndarray]:
    """For each text's words the sorted distinct hashes of all runs of ``width`` words; fewer words are one shingle, none are no shingle."""
    counts = np.array([len(w) for w in words], dtype=np.int64)
    # Spans are the same for all but short texts, whose words are one run.
    spans = np.minimum(counts, width)
    flat, starts = np.concatenate([*words, np.zeros(width, np.uint64)]), np.cumsum(counts) - counts
    runs = np.where(counts > 0, counts - spans + 1, 0)
    ends = np.cumsum(runs)
    first = np.repeat(starts - (ends - runs), runs) + np.arange(runs.sum())
    total = np.repeat(spans, runs).astype(np.uint64)
    factors = mix(np.arange(1, width + 1, dtype=np.uint64) * np.uint64(BASE)) | np.uint64(1)
    short = np.flatnonzero((counts > 0) & (counts < width))
    for k in range(width):
        total += flat[first + k] * factors[k]
        # A short text's run ends with the text.
        past = ends[short[counts[short] <= k]] - 1
        total[past] -= flat[first[past] + k] * factors[k]
    total = mix(total)
    for a, b in zip(ends - runs, ends):
        total[a:b].sort()
    new = np.ones(len(total), dtype=bool)
    new[1:] = total[1:] != total[:-1]
    new[(ends - runs)[runs > 0]] = True
    kept = np.concatenate([[0], np.cumsum(new)])
    total, cuts = total[new], kept[np.concatenate([[0], ends])]
    return [total[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def lower_ascii(text: str) -> bytes:
    return text.encode().lower()
