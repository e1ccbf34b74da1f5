"""Words of whole batches of texts as numpy arrays: boundaries and 64-bit hashes, no loop over words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

_RATE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_MASK = (1 << 64) - 1


def _byte_table(blank: bool) -> np.ndarray:
    """Which bytes belong to words: all but blanks, or ASCII letters and digits and all of UTF-8 above."""
    if blank:
        return ~np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
    table = np.arange(256) >= 0x80
    for first, last in ("09", "AZ", "az"):
        table[ord(first) : ord(last) + 1] = True
    return table


_TOKEN_BYTES = _byte_table(True)
_ALNUM_BYTES = _byte_table(False)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up = np.full(n, _RATE, np.uint64)
        down = np.full(n, pow(_RATE, -1, 1 << 64), np.uint64)
        up[:1] = down[:1] = 1
        return np.multiply.accumulate(up), np.multiply.accumulate(down)


class PowerTable:
    """Powers of the rate and of its inverse, as many as were asked for so far."""

    def __init__(self) -> None:
        self.up, self.down = _powers(1 << 16)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            self.up, self.down = _powers(max(n, 2 * len(self.up)))
        return self.up, self.down


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: PowerTable) -> np.ndarray:
    """A 64-bit hash of ``data[s:e]`` for each pair; equal bytes give equal hashes anywhere."""
    up, down = table.of(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))


@dataclass
class Words:
    """Words of some texts in order: byte range in ``data``, hash, and row of the text."""

    data: np.ndarray
    text_starts: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    row: np.ndarray
    #: first_word[i] to first_word[i + 1] are the words of text i.
    first_word: np.ndarray

    @property
    def n_texts(self) -> int:
        return len(self.first_word) - 1


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string or binary array without nulls, end to end, and the offsets."""
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, values = texts.buffers()
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(values, np.uint8) if values is not None else np.empty(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def split_words(texts: pa.Array, table: PowerTable, *, tokens: bool = False) -> Words:
    """Words of ``texts`` (no nulls).  ``tokens``: runs of non-blanks, else runs of letters and digits.

    Words are compared as bytes: lower-case the texts before if case is not to matter.
    """
    data, at = text_bytes(texts)
    inside = (_TOKEN_BYTES if tokens else _ALNUM_BYTES)[data]
    edge = np.empty(len(data) + 1, bool)
    edge[:-1] = inside
    edge[-1] = False
    opens = edge.copy()
    opens[1:-1] &= ~inside[:-1]
    text_start = at[:-1][at[:-1] < at[1:]]
    opens[text_start] = inside[text_start]
    closes = np.zeros(len(data) + 1, bool)
    closes[1:] = inside
    closes[:-1] &= ~inside
    cut = text_start[text_start > 0]
    closes[cut] = inside[cut - 1]
    starts, ends = np.flatnonzero(opens[:-1]), np.flatnonzero(closes)
    first = np.searchsorted(starts, at)
    row = np.repeat(np.arange(len(at) - 1), np.diff(first))
    return Words(data, at, starts, ends, range_hashes(data, starts, ends, table), row, first)


def shingle_hashes(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every run of ``size`` words; a text of fewer (at least one) gives its whole."""
    lengths = np.diff(words.first_word)
    counts = np.where(lengths >= size, lengths - size + 1, np.minimum(lengths, 1))
    row = np.repeat(np.arange(words.n_texts), counts)
    first = np.cumsum(counts) - counts
    at = np.arange(len(row)) - np.repeat(first, counts) + np.repeat(words.first_word[:-1], counts)
    width = np.minimum(np.repeat(lengths, counts), size)
    out = width.astype(np.uint64)
    for k in range(size):
        inside = k < width
        nxt = words.hashes[np.minimum(at + k, max(len(words.hashes) - 1, 0))] if len(words.hashes) else out
        out = np.where(inside, mix64(out * np.uint64(_RATE) + nxt), out)
    return row, out


def text_slices(batch: pa.RecordBatch, column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of about ``most_bytes`` of text each, of at least one row."""
    sizes = np.asarray(pa.compute.binary_length(batch.column(column)).fill_null(0), dtype=np.int64)
    group = (np.cumsum(sizes) - sizes) // most_bytes
    cuts = np.flatnonzero(np.diff(group)) + 1
    for a, b in zip([0, *cuts], [*cuts, len(sizes)]):
        if b > a:
            yield batch.slice(a, b - a)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
#: ASCII bytes that are neither letters nor digits.
_ASCII_GAPS = ~_ALNUM_BYTES


def lowered_pieces(texts: pa.Array, most_bytes: int) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """``texts`` (no nulls) with only A-Z lower-cased, in pieces of about ``most_bytes`` end to end.

    Yields the row of each piece and the pieces.  A longer text is cut before ASCII characters that are
    neither letters nor digits, so that no run of letters and digits is parted.
    """
    data, at = text_bytes(texts)
    rows, borders = [], [0]
    for row, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
        while b - a > most_bytes:
            cut = a + most_bytes
            while cut < b and not _ASCII_GAPS[data[cut : min(cut + 4096, b)]].any():
                cut += 4096
            if cut >= b:
                break
            a = cut + int(np.argmax(_ASCII_GAPS[data[cut : cut + 4096]]))
            rows.append(row)
            borders.append(a)
        rows.append(row)
        borders.append(b)
    rows, borders = np.array(rows, np.int64), np.array(borders, np.int64)
    first = 0
    while first < len(rows):
        last = max(int(np.searchsorted(borders, borders[first] + most_bytes, "right")) - 1, first + 1)
        low = _LOWER[data[borders[first] : borders[last]]]
        offsets = borders[first : last + 1] - borders[first]
        yield rows[first:last], pa.Array.from_buffers(pa.large_binary(), last - first, [None, pa.py_buffer(offsets), pa.py_buffer(low)])
        first = last
