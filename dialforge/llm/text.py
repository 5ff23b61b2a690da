"""Words and hashes of whole texts, vectorised over Arrow string buffers.

A word is a maximal run of bytes other than space and ``\\t\\n\\v\\f\\r``
(``[^\\x20\\x09-\\x0D]+``). Words are hashed to 64 bits: every pair of a byte and
its place in the word has a random number of its own, and their sum is mixed.
Windows of words are hashed by doubling, each step with a multiplier of its own and
a fold that is not linear. Two seeds share no number, so two of them give 128 bits
(powers of one multiplier would not: modulo 2^64 some words collide under all odd
ones). Nothing here depends on the batch a text arrives in.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
SEEDS = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)   # one per hash
CHUNK_BYTES = 1 << 21
_IS_WORD = np.ones(256, bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False
_PLACES = 64            # places of a word whose numbers are kept in a table
_NUMBERS: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift-multiply rounds)."""
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


def _number(seed: int, place: np.ndarray, byte: np.ndarray) -> np.ndarray:
    """The random number of a byte at a place of a word."""
    return mix(mix(place.astype(U) * U(0x9E3779B97F4A7C15) + U(seed)) + byte.astype(U) * U(0xBF58476D1CE4E5B9))


def _numbers(seed: int) -> np.ndarray:
    if seed not in _NUMBERS:
        _NUMBERS[seed] = _number(seed, np.repeat(np.arange(_PLACES), 256), np.tile(np.arange(256), _PLACES))
    return _NUMBERS[seed]


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    """A-Z to a-z in UTF-8 bytes; every other byte stays."""
    return np.where((buf >= 65) & (buf <= 90), buf + 32, buf).astype(np.uint8)


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` slices of about ``limit``
    bytes; a null text is empty, a longer text is a slice of its own."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    if n == 0:
        return
    _, offs, data = texts.buffers()
    offs = np.frombuffer(offs, np.int64, n + 1 + texts.offset)[texts.offset:]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


def word_spans(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start and end of every word, and the number of words per row."""
    if len(buf) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs) - 1, np.int64)
    word = _IS_WORD[buf]
    before = np.empty(len(buf), bool)
    before[0] = False
    before[1:] = word[:-1]
    first = offs[:-1][offs[:-1] < offs[1:]]           # first byte of each non-empty row
    before[first] = False
    start = np.flatnonzero(word & ~before)
    after = np.empty(len(buf), bool)
    after[-1] = False
    after[:-1] = word[1:]
    after[first[1:] - 1] = False                      # last byte of the rows before
    end = np.flatnonzero(word & ~after) + 1
    per_row = np.diff(np.searchsorted(start, offs))
    return start, end, per_row


def word_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hash of every word."""
    if len(start) == 0:
        return np.zeros(0, U)
    size = end - start
    at = np.cumsum(size) - size
    inside = np.arange(int(size.sum())) - np.repeat(at, size)
    letters = buf[inside + np.repeat(start, size)]
    numbers = _numbers(seed)[np.minimum(inside, _PLACES - 1) * 256 + letters]
    far = np.flatnonzero(inside >= _PLACES) if size.max() > _PLACES else []
    if len(far):
        numbers[far] = _number(seed, inside[far], letters[far])
    return mix(np.add.reduceat(numbers, at) + size.astype(U) * U(SEEDS[0]))


def _multiplier(seed: int, step: int) -> np.uint64:
    return mix(np.array([(seed + step * 0xA0761D6478BD642F) % (1 << 64)], U))[0] | U(1)


def _joined(left: np.ndarray, right: np.ndarray, seed: int, step: int) -> np.ndarray:
    x = left * _multiplier(seed, step) + right
    x ^= x >> U(29)
    return x


def window_hashes(h: np.ndarray, width: int, seed: int) -> np.ndarray:
    """Hash of every ``width`` consecutive word hashes (``len(h) - width + 1``
    of them, or none); windows across rows must be masked by the caller."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, U)
    out, done, run, run_len, left, step = None, 0, h, 1, width, 0
    while left:
        if left & 1:
            part = run[done:done + n]
            out = part if out is None else _joined(out, part, seed, 2 * step + 1)
            done += run_len
        left >>= 1
        if left:
            run = _joined(run[:-run_len], run[run_len:], seed, 2 * step + 2)
            run_len *= 2
        step += 1
    return mix(out * _multiplier(seed, 0))


def row_of(per_row: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(per_row)), per_row)


def as_strings(batch: pa.RecordBatch, name: str) -> list[str]:
    return ["" if t is None else t for t in batch.column(name).to_pylist()]
