"""Benchmark decontamination: SimHash over item-sized windows, multi-index Hamming search, exact check.

Benchmark items are compared with windows of about their own length in every document.  Window lengths
form a geometric series; an item belongs to the largest length that leaves room for the stride of that
length, so that a copy of it holds a window that lies on the grid and equals one of the item's own
windows word for word.  Each window has a 64-bit SimHash of its words.

A changed copy need not hold such a window, but some run of words that it shares with the item is long
(``clean_run``).  So the windows of all offsets in the item, of a length that fits such a run on the grid,
are kept too and searched for equal fingerprints; this finds long items however the changes lie.

Fingerprints are searched by a multi-index: 64 bits are cut into 4 blocks of 16; two fingerprints at
most ``radius`` bits apart agree in some block up to ``radius // 4`` bits, so looking up each block
among all values that near finds every fingerprint within the radius.  Each candidate is verified by
the weighted Jaccard similarity (occurrence counts as weights) of five-word shingles, of the item and
of the best place around the window, of any extent that the similarity permits.

Benchmark items come to the driver in blocks of bounded size and each block is broadcast; documents
are read once per block and never moved.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideflow.llm.common import arrow_batches
from rideflow.llm.words import PowerTable, Words, mix64, split_words, text_slices
from rideflow.sources import materialize

SHINGLE = 5
_SLICE = 1 << 19
_BLOCKS, _BLOCK_BITS = 4, 16
_GROWTH = 1.2

LEAK = pa.struct([("item_id", pa.int64()), ("similarity", pa.float64()), ("start_word", pa.int64()), ("n_words", pa.int64())])
_LEAK_DDL = "array<struct<item_id:bigint,similarity:double,start_word:bigint,n_words:bigint>>"


def stride_of(length: int) -> int:
    return max(1, length // 8)


def window_length(n_words: int) -> int:
    """The largest length of the series 5, 6, 7, ... that leaves room for its stride in n words."""
    length = SHINGLE
    while True:
        longer = max(length + 1, int(length * _GROWTH))
        if longer + stride_of(longer) - 1 > n_words:
            return length
        length = longer


def clean_run(n_words: int, least: float) -> int:
    """Words of the longest run that any place at least ``least`` similar shares with an item of n words.

    Where two runs meet in the place, at least 4 shingles of the item are lost and 4 are foreign (unless
    the item repeats four words in a row).  With x lost and y foreign of m shingles, (m - x) / (m + y)
    >= least bounds the number of such meetings, and the shingles left over are shared by that many runs
    and one.
    """
    m = max(n_words - SHINGLE + 1, 0)
    cost = SHINGLE - 1
    most = int((1 - least) * m / (cost * (1 + least)) + 1e-9)
    runs = (-(-(least * m + least * cost * k - 1e-9) // (k + 1)) for k in range(most + 1))
    return min(n_words, int(min(runs)) + SHINGLE - 1)


def word_bits(hashes: np.ndarray, longest: int) -> np.ndarray:
    """Running counts of set bits, a row per word and one before: (words + 1, 64).

    Counts of windows are differences, so they may wrap around as long as ``longest`` fits the type.
    """
    kind = np.uint8 if longest < 1 << 8 else np.uint32
    bits = np.unpackbits(mix64(hashes).view(np.uint8).reshape(-1, 8), axis=1)
    sums = np.zeros((len(hashes) + 1, 64), kind)
    np.cumsum(bits.astype(kind, copy=False), axis=0, out=sums[1:])
    return sums


def fingerprints(sums: np.ndarray, length: int, step: int = 1) -> np.ndarray:
    """SimHash of the windows of ``length`` words that start at every ``step``-th word: a bit is set
    if most words have it set."""
    n = max((len(sums) - 1 - length) // step + 1, 0)
    out = np.empty(n, np.uint64)
    for a in range(0, n, 1 << 12):
        b = min(a + (1 << 12), n)
        low, high = sums[a * step : (b - 1) * step + 1 : step], sums[a * step + length : (b - 1) * step + length + 1 : step]
        out[a:b] = np.packbits((high - low) > length // 2, axis=1).view(np.uint64).ravel()
    return out


def shingles_at(hashes: np.ndarray) -> np.ndarray:
    """The shingle that begins at each word (of those that have room)."""
    n = max(len(hashes) - SHINGLE + 1, 0)
    out = np.full(n, np.uint64(SHINGLE))
    for k in range(SHINGLE):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n])
    return out


def counted(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles and how often each occurs."""
    return np.unique(shingles, return_counts=True)


class _LengthIndex:
    """Fingerprints of the items of one window length, by each block's nearby values."""

    def __init__(self, fps: np.ndarray, items: np.ndarray, offsets: np.ndarray, radius: int):
        self.fps, self.items, self.offsets = fps, items, offsets
        flips = [0] + [
            sum(1 << b for b in some) for k in range(1, radius // _BLOCKS + 1) for some in combinations(range(_BLOCK_BITS), k)
        ]
        flips = np.array(flips, np.uint32)
        self.first, self.entries = [], []
        for b in range(_BLOCKS):
            value = self.block(fps, b)
            near = (value[:, None] ^ flips[None, :]).ravel()
            order = np.argsort(near, kind="stable")
            self.entries.append(np.repeat(np.arange(len(fps)), len(flips))[order].astype(np.int32))
            self.first.append(np.searchsorted(near[order], np.arange((1 << _BLOCK_BITS) + 1)).astype(np.int32))

    @staticmethod
    def block(fps: np.ndarray, b: int) -> np.ndarray:
        return ((fps >> np.uint64(_BLOCK_BITS * b)) & np.uint64((1 << _BLOCK_BITS) - 1)).astype(np.uint32)

    def within(self, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """All (window, fingerprint) pairs at most ``radius`` bits apart."""
        found_w, found_f = [], []
        for a in range(0, len(fps), 1 << 15):
            part = fps[a : a + (1 << 15)]
            for b in range(_BLOCKS):
                value = self.block(part, b)
                first, n = self.first[b][value], self.first[b][value + 1] - self.first[b][value]
                hit = np.flatnonzero(n)
                n = n[hit]
                w = np.repeat(hit, n)
                f = self.entries[b][np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[hit], n)]
                near = np.bitwise_count(part[w] ^ self.fps[f]) <= radius
                found_w.append(w[near] + a)
                found_f.append(f[near])
        return np.concatenate(found_w or [np.zeros(0, int)]), np.concatenate(found_f or [np.zeros(0, int)])


class _EqualIndex:
    """Fingerprints of the items of one window length at all offsets, for equal ones."""

    def __init__(self, fps: np.ndarray, items: np.ndarray):
        order = np.lexsort((items, fps))
        fps, items = fps[order], items[order]
        new = np.r_[True, (np.diff(fps) != 0) | (np.diff(items) != 0)]
        self.fps, self.items = fps[new], items[new]
        self.marks = np.zeros(1 << 22, bool)
        self.marks[self._mark(self.fps)] = True

    @staticmethod
    def _mark(fps: np.ndarray) -> np.ndarray:
        return (mix64(fps) >> np.uint64(42)).astype(np.int64)

    def equal(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (window, item) pairs of equal fingerprints."""
        some = np.flatnonzero(self.marks[self._mark(fps)])
        first = np.searchsorted(self.fps, fps[some])
        n = np.searchsorted(self.fps, fps[some], side="right") - first
        return np.repeat(some, n), self.items[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)]


class ItemIndex:
    """A block of benchmark items, ready to be searched for in documents."""

    def __init__(self, items: list[tuple[int | None, str]], radius: int, least: float):
        self.radius, self.least = radius, least
        table = PowerTable()
        words = split_words(pa.array([t for _, t in items], pa.large_string()), table)
        self.ids = [i for i, _ in items]
        self.shingles: list = []
        by_length: dict[int, list[tuple[np.ndarray, int, np.ndarray]]] = {}
        clean: dict[int, list[tuple[np.ndarray, int]]] = {}
        for k in range(len(items)):
            own = words.hashes[words.first_word[k] : words.first_word[k + 1]]
            n = len(own)
            self.shingles.append(counted(shingles_at(own)))
            if n < SHINGLE:
                continue
            length = window_length(n)
            step = stride_of(length)
            last = n - length
            offsets = np.arange(last + 1)
            offsets = offsets[(offsets < 2 * step) | (offsets > last - 2 * step)]
            by_length.setdefault(length, []).append((fingerprints(word_bits(own, length), length)[offsets], k, offsets))
            part = window_length(clean_run(n, least))
            clean.setdefault(part, []).append((fingerprints(word_bits(own, part), part), k))
        #: The most shingles that a place as similar as ``least`` has.
        self.reach = np.array([int(times.sum() / least + 1e-6) for _, times in self.shingles], np.int64)
        self.lengths = {
            length: _LengthIndex(
                np.concatenate([f for f, _, _ in rows]),
                np.concatenate([np.full(len(f), k) for f, k, _ in rows]),
                np.concatenate([o for _, _, o in rows]),
                radius,
            )
            for length, rows in by_length.items()
        }
        self.clean = {
            length: _EqualIndex(np.concatenate([f for f, _ in rows]), np.concatenate([np.full(len(f), k) for f, k in rows]))
            for length, rows in clean.items()
        }

    def leaks(self, words: Words) -> list[list[dict]]:
        """The leaks in each text: item, similarity and place, each item at its best place only."""
        out: list[list[dict]] = [[] for _ in range(words.n_texts)]
        if not len(words.hashes) or not self.lengths:
            return out
        sums = word_bits(words.hashes, max(self.lengths))
        places = []
        for length in self.lengths.keys() | self.clean.keys():
            fps = fingerprints(sums, length, stride_of(length))
            starts = np.arange(len(fps)) * stride_of(length)
            inside = words.row[starts] == words.row[starts + length - 1]
            starts, fps = starts[inside], fps[inside]
            w, item = np.zeros(0, np.int64), np.zeros(0, np.int64)
            if length in self.lengths:
                w, f = self.lengths[length].within(fps, self.radius)
                item = self.lengths[length].items[f]
            if length in self.clean:
                found = self.clean[length].equal(fps)
                w, item = np.r_[w, found[0]], np.r_[item, found[1]]
            at, row = starts[w], words.row[starts[w]]
            # A place that holds some of the window lies between these shingles.
            low = np.maximum(at - self.reach[item], words.first_word[row])
            high = np.minimum(at + length + self.reach[item], words.first_word[row + 1] - SHINGLE + 1)
            places.append(np.c_[row, item, low, high])
        best: dict[tuple[int, int], tuple[float, int, int]] = {}
        shingles = shingles_at(words.hashes)
        for row, item, low, high in self._joined(np.concatenate(places)):
            found = self._verify(shingles, item, low, high)
            if found[0] >= self.least - 1e-9 and found > best.get((row, item), (0.0, 0, 0)):
                best[row, item] = found
        for (row, item), (similarity, start, n) in sorted(best.items()):
            at = start - int(words.first_word[row])
            out[row].append({"item_id": self.ids[item], "similarity": similarity, "start_word": at, "n_words": n})
        return out

    @staticmethod
    def _joined(places: np.ndarray) -> list[list[int]]:
        """(row, item, low, high) of ``places``, those of a row and item that overlap made one."""
        if not len(places):
            return []
        places = places[np.lexsort(places.T[::-1])]
        new = (np.diff(places[:, :2], axis=0) != 0).any(1) | (places[1:, 2] > places[:-1, 3])
        first = np.flatnonzero(np.r_[True, new])
        return np.c_[places[first, :3], np.maximum.reduceat(places[:, 3], first)].tolist()

    def _verify(self, shingles: np.ndarray, item: int, low: int, high: int) -> tuple[float, int, int]:
        """The best similarity of any run of the shingles from ``low`` to ``high``, its first word and
        number of words.  (Zero if all are below ``least``.)

        The best run begins and ends with a shingle of the item.  From each beginning the counts of
        what is shared run on over the ends: an occurrence counts unless the run holds as many of its
        kind before it as the item does.
        """
        kinds, times = self.shingles[item]
        size = int(times.sum())
        own = shingles[low:high]
        kind = np.minimum(np.searchsorted(kinds, own), len(kinds) - 1)
        at = np.flatnonzero(kinds[kind] == own)
        # What is shared is at least this, and a run at most ``reach`` long.
        need, reach = self.least * size - 1e-6, int(self.reach[item])
        best = (0.0, low, 0)
        if len(at) < need:
            return best
        order = np.argsort(kind[at], kind="stable")
        k = kind[at][order]
        rank = np.arange(len(k)) - np.searchsorted(k, k)
        full = np.empty(len(at), np.int64)  # the occurrence that a run must not reach back to
        full[order] = np.where(rank >= times[k], at[order][np.maximum(np.arange(len(k)) - times[k], 0)], -1)
        ends = np.searchsorted(at, at + reach)
        for i in np.flatnonzero(ends - np.arange(len(at)) >= need).tolist():
            shared = np.cumsum(full[i : ends[i]] < at[i])
            extent = at[i : ends[i]] - at[i] + 1
            similarity = shared / (size + extent - shared)
            j = int(similarity.argmax())
            best = max(best, (float(similarity[j]), low + int(at[i]), int(extent[j]) + SHINGLE - 1))
            if best[0] == 1.0:
                break
        return best


def item_blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[int | None, str]]]:
    """The items (item_id, text) in blocks of at most ``block_bytes`` of text, or one item."""
    held, size = [], 0
    rows = benchmark.filter(F.col("text").isNotNull()).select(F.col("item_id").cast("long"), F.lower("text").alias("text"))
    for row in rows.toLocalIterator():
        n = len(row.text.encode())
        if held and size + n > block_bytes:
            yield held
            held, size = [], 0
        held.append((row.item_id, row.text))
        size += n
    if held:
        yield held


def _finder(index):
    """A UDF that gives the leaks in each text of the items of a broadcast index."""

    @F.arrow_udf(_LEAK_DDL)
    def find(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = PowerTable()
        for batch in texts:
            one = pa.RecordBatch.from_arrays([batch.fill_null("")], names=["text"])
            found = []
            for part in text_slices(one, "text", _SLICE):
                found += index.value.leaks(split_words(part.column("text"), table))
            yield pa.array(found, pa.list_(LEAK))

    return find


def mark_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    least: float = 0.8,
    radius: int = 7,
    block_bytes: int = 4 << 20,
    carry: list[str] | None = None,
) -> DataFrame:
    """Every row of ``docs`` with a column ``leaks``: the items found in its text, written already.
    ``carry`` names the columns to keep (default: all).

    Texts are lower-cased; words are runs of letters and digits.  An item is found where the weighted
    Jaccard similarity of its shingles and those of a place in the text, of any extent, is at least ``least``; each
    item is reported once per document, at its best place.  Items of fewer than five words, empty and
    null ones have no shingle and are never found; repeated items are each found.  Null and empty
    texts have no leak.  An empty table of documents gives no rows, an empty benchmark no leaks.
    A column ``leaks`` is replaced.
    """
    spark = docs.sparkSession
    kept = [c for c in (docs.columns if carry is None else carry) if c != "leaks"]
    with arrow_batches(spark, 500):
        marked = docs.withColumn("leaks", F.array().cast(_LEAK_DDL))
        blocks = item_blocks(benchmark, block_bytes)
        items = next(blocks, None)
        while items is not None:
            find = _finder(spark.sparkContext.broadcast(ItemIndex(items, radius, least)))
            items = next(blocks, None)
            marked = marked.withColumn("leaks", F.concat("leaks", find(F.lower("text"))))
            # The text is needed as long as there are blocks to come.
            marked = materialize(marked if items is not None else marked.select(*kept, "leaks"), label="leaks")
        return marked.select(*kept, "leaks")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without a leak."""
    return mark_leaks(docs, benchmark, **options).filter(F.size("leaks") == 0).select(*docs.columns)
