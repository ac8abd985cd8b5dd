r"""Words of many texts at once, in numpy, straight from an Arrow column's bytes.

For use inside tasks: a batch of texts is cut into pieces of about ``PIECE`` bytes, and each piece gives arrays
with a row per word: where it starts and ends, and a 64-bit hash of it with A-Z in lower case. A word's hash is a
polynomial over its bytes, taken from prefix sums, so no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
#: Texts in a piece at most, so that a text's number and 52 bits of a hash fit in 64.
PIECE_ROWS = 4095
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)

#: The bytes that are not part of a word.
SPACES = bytes([0x20, *range(0x09, 0x0E)])
NOT_ALNUM = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_VALUE = mix64(np.arange(1, 257, dtype=_U) * _U(_BASE))[LOWER]
_powers = [np.ones(1, dtype=_U), np.ones(1, dtype=_U)]


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_BASE, _INVERSE)):
            factors = np.full(size, base, dtype=_U)
            factors[0] = 1
            _powers[k] = np.multiply.accumulate(factors)
    return _powers


@dataclass
class Piece:
    """Words of the texts ``first_row`` ... of a batch. ``word_at[i]:word_at[i + 1]`` are the words of the i-th."""

    first_row: int
    data: np.ndarray
    text_at: np.ndarray
    start: np.ndarray
    end: np.ndarray
    word_at: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.text_at) - 1

    def hashes(self) -> np.ndarray:
        power, inverse = _power_tables(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, dtype=_U)
        np.cumsum(_VALUE[self.data] * power[: len(self.data)], out=sums[1:])
        return mix64((sums[self.end] - sums[self.start]) * inverse[self.start])


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and where each text starts (and the last ends); null as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def pieces(column: pa.Array, apart: bytes = SPACES) -> Iterator[Piece]:
    """The words of a column of texts: runs of bytes not in ``apart``."""
    inside = np.ones(256, dtype=bool)
    inside[list(apart)] = False
    data, at = bytes_of(column)
    row = 0
    while row < len(at) - 1:
        stop = min(row + PIECE_ROWS, max(row + 1, int(np.searchsorted(at, at[row] + PIECE, side="right")) - 1), len(at) - 1)
        yield _cut(row, data[at[row] : at[stop]], at[row : stop + 1] - at[row], inside)
        row = stop


def _cut(row: int, data: np.ndarray, text_at: np.ndarray, inside: np.ndarray) -> Piece:
    n = len(data)
    word = np.zeros(n + 2, dtype=bool)
    word[1:-1] = inside[data]
    begins = word[1:-1] & ~word[:-2]
    ends = word[1:-1] & ~word[2:]
    edge = text_at[(text_at > 0) & (text_at < n)]  # a text's last word and the next one's first are apart
    begins[edge] |= word[1:-1][edge]
    ends[edge - 1] |= word[1:-1][edge - 1]
    start = np.flatnonzero(begins)
    return Piece(row, data, text_at, start, np.flatnonzero(ends) + 1, np.searchsorted(start, text_at))


def shingles(piece: Piece, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row in the piece) of each run of ``k`` words; a text with fewer words, but some, has all as one."""
    h, count = piece.hashes(), np.diff(piece.word_at)
    row = np.repeat(np.arange(piece.rows), count)
    whole = np.zeros(max(len(h) - k + 1, 0), dtype=_U)
    for j in range(k):
        whole = mix64(whole + h[j : j + len(whole)] + _U(j + 1))
    good = np.flatnonzero(row[: len(whole)] == row[k - 1 : k - 1 + len(whole)]) if len(whole) else np.zeros(0, np.int64)
    out, rows = [whole[good]], [row[good]]
    for i in np.flatnonzero((count > 0) & (count < k)):
        x = np.asarray([count[i]], dtype=_U)
        for j in range(piece.word_at[i], piece.word_at[i + 1]):
            x = mix64(x + h[j : j + 1])
        out.append(x)
        rows.append(np.asarray([i]))
    return np.concatenate(out), np.concatenate(rows)


def char_at(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code points before each byte position of one text."""
    lead = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
    return lead[at]


def shingle_sets(piece: Piece, k: int = 5) -> np.ndarray:
    """The distinct shingles of each text: sorted numbers of the text's row (12 bits) and 52 bits of the hash."""
    h, row = shingles(piece, k)
    keys = np.sort((row.astype(_U) << _U(52)) | (h >> _U(12)))
    return keys[np.r_[True, keys[1:] != keys[:-1]]] if len(keys) else keys
