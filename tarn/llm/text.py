"""Words and shingles of whole batches of texts, as numpy arrays.

All functions work on the UTF-8 bytes of an Arrow column, so that no Python
string is made for a word. A word's hash is a polynomial over its bytes modulo
2**64, taken from prefix sums and mixed; callers that must be exact compare the
bytes or sets behind equal hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Bytes of text worked on at once; about 60 bytes of memory are needed for each.
CHUNK_BYTES = 2_000_000

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_STEP = np.uint64(0xD6E8FEB86659FD93)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _class(inside) -> np.ndarray:
    table = np.zeros(256, bool)
    for b in range(256):
        table[b] = inside(b)
    return table


#: Anything but space and the five ASCII controls for white space.
NON_SPACE = _class(lambda b: b != 32 and not 9 <= b <= 13)
#: Digits, a to z and all beyond ASCII (texts are lower-cased first).
ALNUM = _class(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, for exponents 0 to n."""
    if len(_powers[0]) <= n:
        for k, factor in enumerate((_BASE, _INVERSE)):
            steps = np.full(n + 1, factor, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of a run of texts: ``starts``/``ends`` are byte positions in
    ``data``; text ``i`` owns the words ``first[i]`` to ``first[i + 1]``."""

    lo: int
    data: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray | None
    #: The first words that an earlier piece of the same text held too, and whether the text goes on in a later one.
    carried: int = 0
    goes_on: bool = False
    #: The bytes as they were, with capitals.
    raw: np.ndarray | None = None

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and bounds of an Arrow text column; null texts are empty."""
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, bounds, data = column.buffers()
    bounds = np.frombuffer(bounds, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds.astype(np.int64) - int(bounds[0])


def chunks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``CHUNK_BYTES``: first index, bytes, bounds."""
    data, bounds = buffers(column)
    lo, n = 0, len(bounds) - 1
    while lo < n:
        hi = int(np.searchsorted(bounds, bounds[lo] + CHUNK_BYTES, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, data[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo]
        lo = hi


def _spans(data: np.ndarray, bounds: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of ``letters`` that lie within one text."""
    starts, ends = [], []
    for lo in range(0, len(data) + 1, CHUNK_BYTES):
        hi = min(lo + CHUNK_BYTES, len(data) + 1)
        inside = np.zeros(hi - lo + 1, bool)  # from the place before ``lo`` on
        inside[int(lo == 0) : min(hi, len(data)) - lo + 1] = letters[data[max(lo - 1, 0) : hi]]
        cut = np.zeros(hi - lo, bool)
        cut[bounds[np.searchsorted(bounds, lo) : np.searchsorted(bounds, hi)] - lo] = True
        starts.append(lo + np.flatnonzero(inside[1:] & (~inside[:-1] | cut)))
        ends.append(lo + np.flatnonzero(inside[:-1] & (~inside[1:] | cut)))
    return np.concatenate(starts), np.concatenate(ends)


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Block by block, so that one long word needs no more memory than a block."""
    power, inverse = _power_tables(min(len(data), CHUNK_BYTES))
    before, after, back = (np.zeros(len(starts), np.uint64) for _ in range(3))
    total = np.zeros(1, np.uint64)
    for lo in range(0, len(data), CHUNK_BYTES):
        block = data[lo : lo + CHUNK_BYTES]
        n, shift = len(block), np.uint64(pow(int(_BASE), lo, 1 << 64))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((block.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
        sums = sums * shift + total
        own = slice(*np.searchsorted(starts, [lo, lo + n]))
        before[own] = sums[starts[own] - lo]
        back[own] = inverse[starts[own] - lo] * np.uint64(pow(int(_INVERSE), lo, 1 << 64))
        own = slice(*np.searchsorted(ends, [lo, lo + n], side="right"))
        after[own] = sums[ends[own] - lo]
        total = sums[-1:]
    return mix((after - before) * back + (ends - starts).astype(np.uint64))


def words(column: pa.Array, letters: np.ndarray) -> Iterator[Words]:
    """Lower-cases A-Z and cuts each text into maximal runs of ``letters``."""
    for lo, data, bounds in chunks(column):
        data = _LOWER[data]
        starts, ends = _spans(data, bounds, letters)
        yield Words(lo, data, bounds, starts, ends, np.searchsorted(starts, bounds), _hashes(data, starts, ends))


def _cut_after(data: np.ndarray, at: int, letters: np.ndarray) -> int:
    """The first place from ``at`` on that is not within a word."""
    while at < len(data) and letters[_LOWER[data[at - 1]]]:
        stop = np.flatnonzero(~letters[_LOWER[data[at : at + 4096]]])
        if len(stop):
            return at + int(stop[0])
        at = min(len(data), at + 4096)
    return at


def word_pieces(column: pa.Array, letters: np.ndarray, carry: int, hashed: bool = True) -> Iterator[Words]:
    """As ``words``, but a text of more than ``CHUNK_BYTES`` comes in pieces of about that size, cut between words (one longer word
    is not cut). Each piece begins with the last ``carry`` words before it, so that every run of
    ``carry + 1`` words lies in one piece and, whole, in one only."""
    for lo, raw, bounds in chunks(column):
        if len(raw) <= CHUNK_BYTES:
            data = _LOWER[raw]
            starts, ends = _spans(data, bounds, letters)
            yield Words(lo, data, bounds, starts, ends, np.searchsorted(starts, bounds), _hashes(data, starts, ends) if hashed else None, raw=raw)
            continue
        at, begins = 0, []
        while at < len(raw):
            end = _cut_after(raw, min(len(raw), at + CHUNK_BYTES), letters)
            start = begins[0] if begins else at
            data = _LOWER[raw[start:end]]
            edge = np.array([0, len(data)])
            starts, ends = _spans(data, edge, letters)
            made = _hashes(data, starts, ends) if hashed else None
            yield Words(lo, data, edge, starts, ends, np.searchsorted(starts, edge), made, len(begins), end < len(raw), raw[start:end])
            begins = [start + int(s) for s in starts[-carry:]] if carry else []
            at = end


def runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive words, by its first word. Runs
    over the end of a text are among them: callers leave them out."""
    n = max(0, len(hashes) - size + 1)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = total * _STEP + hashes[k : k + n]
    return mix(total)


def run_of(hashes: np.ndarray) -> np.uint64:
    """The hash ``runs`` gives to exactly these words."""
    return runs(hashes, len(hashes))[0]
