"""Words, shingles and hashes of many texts at once, as numpy arrays.

All hashes wrap modulo 2**64 and depend on nothing but the text, so every
executor computes the same ones.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)

_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all 64 bits."""
    h = (h ^ (h >> np.uint64(31))) * _ODD
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _grown(table: np.ndarray, factor: int, size: int) -> np.ndarray:
    while len(table) < size:
        step = np.uint64(pow(factor, len(table), 1 << 64))
        table = np.concatenate([table, table * step])
    return table


def range_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of ``codes[start:end]`` for each pair, from one running sum."""
    global _powers, _inverses
    size = len(codes) + 1
    _powers, _inverses = _grown(_powers, _BASE, size), _grown(_inverses, _BASE_INVERSE, size)
    sums = np.zeros(size, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * _powers[: len(codes)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _inverses[starts] + (ends - starts).astype(np.uint64))


def words_of(texts: Sequence[str | None], clean: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-case words of all texts, one after the other, and the
    place where each text's words begin (one more entry than texts). Words are
    what white space separates; None has none. ``clean`` texts are lower-case words
    with a blank between them already."""
    cleaned = texts if clean else [" ".join(t.lower().split()) if t else "" for t in texts]
    joined = "\n".join(cleaned) + "\n"
    if joined.isascii():
        codes = np.frombuffer(joined.encode("ascii"), np.uint8)
    else:
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.flatnonzero((codes == 32) | (codes == 10))
    starts = np.concatenate([[0], ends[:-1] + 1]).astype(np.int64)
    lines = np.cumsum(codes[ends] == 10)
    lines = np.concatenate([[0], lines[:-1]])
    real = ends > starts  # the empty piece of a text without words
    hashes = range_hashes(codes, starts[real], ends[real])
    first = np.searchsorted(lines[real], np.arange(len(texts) + 1))
    return hashes, first


def shingles_of(words: np.ndarray, size: int) -> np.ndarray:
    """A hash per run of ``size`` words; a shorter text is one run of all its words."""
    if len(words) == 0:
        return words
    size = min(size, len(words))
    out = np.zeros(len(words) - size + 1, np.uint64)
    for i in range(size):
        out = out * np.uint64(_BASE) + words[i : i + len(out)]
    return mix(out)


def signed(h: np.ndarray) -> np.ndarray:
    """As Spark's BIGINT."""
    return h.view(np.int64)


def batches(lengths: Sequence[int], most: int) -> Iterator[slice]:
    """Runs of neighbours with at most ``most`` units together; a longer one is alone."""
    begin, held = 0, 0
    for i, n in enumerate(lengths):
        if held and held + n > most:
            yield slice(begin, i)
            begin, held = i, 0
        held += n
    if begin < len(lengths):
        yield slice(begin, len(lengths))
