"""Suffix-array dedup: removal of 50-byte strings that occur in an earlier document.

A byte goes if some string of ``SPAN`` bytes that covers it also starts in a document of smaller id.
Finding them takes these steps, each linear in the text:

1. Anchors.  Of the grams in every 50-byte string the one of smallest hash is its anchor, the leftmost
   on ties; equal strings have equal anchors at equal places.  Anchors are one gram in thirteen.
   A shuffle finds the anchors that occur in several documents.
2. Shards.  The piece of text around each such anchor (all strings that have it as anchor, end to end)
   goes to the shard of the anchor.  Of equal pieces of a batch only that of the smallest document
   travels with its bytes: what the others lose is known.
3. In a shard, a suffix array of its pieces is built by Larsson-Sadakane refinement (ranks of 8 bytes,
   then of 16, 32 and 50, only unsorted groups being sorted again), and common prefixes of neighbours
   are taken by Kasai's rule, over all pieces in lockstep.  Neighbours that share 50 bytes are equal
   strings; all but those of the smallest document are found.
4. Anchors with very many pieces are spread over several shards by document.  Each of these shards
   gives the sorted run of its distinct strings; runs are dealt by string and merged by binary search.

Which anchors occur in several documents is kept as a bitmap of bounded size that tasks read from the
shared folder; a wrong hit costs a piece that is compared in vain, and nothing is ever missed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rideflow.llm.common import arrow_batches
from rideflow.llm.words import mix64, text_bytes, text_slices
from rideflow.session import scratch_path
from rideflow.sources import materialize, save_table

SPAN = 50
_GRAM = 26
_SLICE = 1 << 21
#: Texts hashed at once: what numpy passes over again and again is to stay in the cache.
_HASHED = 1 << 18
#: Bytes of pieces compared at once: the arrays of their suffixes take some eighty times as much.
_CHUNK = 1 << 19
#: Pieces of a partition, on average: a task holds its pieces.
_PIECES = 1 << 18
_ANCHOR_BITS = 48
_ANCHOR_MASK = np.uint64((1 << _ANCHOR_BITS) - 1)
#: Bits of the bitmap: 16 for each anchor, at most 2**31 (256 MB).
_MOST_BITS = 31
_SEGMENT_BITS = 20
#: At most so many anchors can be called hot, so their list has a proven bound.
_MOST_HOT = 1 << 20
_LEAST_HOT = 4096
_HOT_SHARDS = 64


# ---- anchors ----------------------------------------------------------------------------------


def words_at(data: np.ndarray) -> np.ndarray:
    """The 8 bytes at each position as a big-endian number (zeros behind the end)."""
    padded = np.zeros((len(data) + 15) // 8 * 8 + 8, np.uint8)
    padded[: len(data)] = data
    out = np.empty(len(data), np.uint64)
    for r in range(8):
        n = len(out[r::8])
        out[r::8] = padded[r : r + 8 * n].view(">u8")
    return out


def anchors(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, first, count): the 48-bit anchor, the text, and the ``count`` strings that start at
    ``first`` and have it, of the texts ``data[at[i] : at[i + 1]]``."""
    none = np.zeros(0, np.int64)
    last = len(data) - SPAN + 1
    if last <= 0:
        return none.astype(np.uint64), none, none, none
    words = words_at(data)
    n = len(data) - _GRAM + 1
    value = np.zeros(n, np.uint64)
    for at_byte in (*range(0, _GRAM - 8, 8), _GRAM - 8):
        value = (value + words[at_byte : at_byte + n]) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(32)
    value *= np.uint64(0xBF58476D1CE4E5B9)
    value ^= value >> np.uint64(32)

    # Smallest value and its leftmost offset over 2, 4, 8, 16 and then all grams of a string.
    least, offset = value, np.zeros(n, np.uint8)
    grams, width = SPAN - _GRAM + 1, 1
    while width < grams:
        shift = min(width, grams - width)
        left, right = least[:-shift], least[shift:]
        offset = np.where(right < left, offset[shift:] + np.uint8(shift), offset[:-shift])
        least = np.minimum(left, right)
        width += shift

    sizes = np.maximum(np.diff(at) - SPAN + 1, 0)
    row = np.repeat(np.arange(len(sizes)), sizes)
    start = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(at[:-1], sizes)
    where = start + offset[start]
    new = np.flatnonzero(np.r_[True, (np.diff(where) != 0) | (np.diff(row) != 0)]) if len(row) else none
    count = np.diff(np.r_[new, len(row)])
    return least[start[new]] & _ANCHOR_MASK, row[new], start[new], count


def batch_anchors(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """``anchors`` of all texts of a batch, hashed in small slices; places count within the batch."""
    found, rows, done = [], 0, 0
    for part in text_slices(batch, "text", _HASHED):
        data, at = text_bytes(part.column("text"))
        anchor, row, first, count = anchors(data, at)
        found.append((anchor, row + rows, first + done, count))
        rows, done = rows + part.num_rows, done + len(data)
    if not found:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    return tuple(np.concatenate(x) for x in zip(*found))


_PACKED = "slot int, grams binary, docs binary, counts binary"


def _pack_anchors(n_slots: int):
    """Anchors of a slice by slot, 6 bytes each, documents apart: what the shuffle carries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text", _SLICE):
                anchor, row, _, _ = batch_anchors(part)
                doc = np.asarray(part.column("doc"))[row]
                slot = (mix64(anchor) % np.uint64(n_slots)).astype(np.int64)
                order = np.lexsort((anchor, doc, slot))
                anchor, doc, slot = anchor[order], doc[order], slot[order]
                same = np.r_[False, (np.diff(anchor) == 0) & (np.diff(doc) == 0) & (np.diff(slot) == 0)] if len(doc) else doc == 0
                anchor, doc, slot = anchor[~same], doc[~same], slot[~same]
                six = anchor.view(np.uint8).reshape(-1, 8)[:, :6]
                cuts = np.r_[np.flatnonzero(np.diff(slot, prepend=-1)), len(slot)] if len(slot) else np.zeros(1, int)
                out: dict[str, list] = {"slot": [], "grams": [], "docs": [], "counts": []}
                for a, b in zip(cuts[:-1], cuts[1:]):
                    first = np.flatnonzero(np.r_[True, np.diff(doc[a:b]) != 0])
                    out["slot"].append(int(slot[a]))
                    out["grams"].append(six[a:b].tobytes())
                    out["docs"].append(doc[a:b][first].tobytes())
                    out["counts"].append(np.diff(np.r_[first, b - a]).astype(np.uint16 if b - a < 65536 else np.int64).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out["slot"], pa.int32())] + [pa.array(out[c], pa.binary()) for c in ("grams", "docs", "counts")],
                    names=["slot", "grams", "docs", "counts"],
                )

    return run


def _unpack(row: dict) -> tuple[np.ndarray, np.ndarray]:
    six = np.frombuffer(row["grams"], np.uint8).reshape(-1, 6)
    wide = np.zeros((len(six), 8), np.uint8)
    wide[:, :6] = six
    docs = np.frombuffer(row["docs"], np.int64)
    counts = np.frombuffer(row["counts"], np.uint16 if len(row["counts"]) == 2 * len(docs) else np.int64)
    return wide.view(np.uint64).ravel(), np.repeat(docs, counts)


def _shared_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the slots of a partition: anchors of two documents or more, and in how many pieces of text."""
    by_slot: dict[int, list] = {}
    for batch in batches:
        for row in batch.to_pylist():
            by_slot.setdefault(row["slot"], []).append(row)
    for rows in by_slot.values():
        parts = [_unpack(row) for row in rows]
        anchor, doc = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        order = np.argsort(anchor, kind="stable")
        anchor, doc = anchor[order], doc[order]
        first = np.flatnonzero(np.r_[True, np.diff(anchor) != 0])
        several = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)
        n = np.diff(np.r_[first, len(anchor)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(anchor[first][several].view(np.int64)), pa.array(n[several])], names=["anchor", "n"]
        )


def _bitmap_segments(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}
        for batch in batches:
            at = np.asarray(batch.column("place"))
            for segment in np.unique(at >> _SEGMENT_BITS).tolist():
                own = at[at >> _SEGMENT_BITS == segment] & ((1 << _SEGMENT_BITS) - 1)
                made.setdefault(segment, np.zeros(1 << min(bits, _SEGMENT_BITS), bool))[own] = True
        for segment, marks in made.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([segment], pa.int32()), pa.array([np.packbits(marks).tobytes()], pa.binary())], names=["segment", "marks"]
            )

    return run


class SharedAnchors:
    """Whether an anchor may occur in several documents, and whether it is hot, as a task asks."""

    def __init__(self, path: str, bits: int, hot_path: str):
        store, top = fs.FileSystem.from_uri(path)
        table = pq.read_table(top, filesystem=store)
        self.bits = bits
        self.marks = np.zeros(1 << (bits - 3), np.uint8)
        size = 1 << (min(bits, _SEGMENT_BITS) - 3)
        for segment, marks in zip(table.column("segment").to_pylist(), table.column("marks")):
            self.marks[segment * size : (segment + 1) * size] = np.frombuffer(marks.as_py(), np.uint8)
        store, top = fs.FileSystem.from_uri(hot_path)
        self.hot = np.sort(pq.read_table(top, filesystem=store).column("anchor").to_numpy())

    def has(self, anchor: np.ndarray) -> np.ndarray:
        at = place_of(anchor, self.bits)
        return (self.marks[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1

    def is_hot(self, anchor: np.ndarray) -> np.ndarray:
        if not len(self.hot):
            return np.zeros(len(anchor), bool)
        at = np.minimum(np.searchsorted(self.hot, anchor.view(np.int64)), len(self.hot) - 1)
        return self.hot[at] == anchor.view(np.int64)


def place_of(anchor: np.ndarray, bits: int) -> np.ndarray:
    return (anchor & np.uint64((1 << bits) - 1)).astype(np.int64)


# ---- pieces -----------------------------------------------------------------------------------

#: A null piece: its strings are known to start in a smaller document.  The shard is 64 times the
#: anchor, and for hot anchors one of 64 by document more.
_PIECE = "shard long, hot boolean, doc long, row long, first int, count int, piece binary"


def _codes(pieces: pa.Array) -> np.ndarray:
    """Numbers, equal for equal pieces."""
    return pieces.dictionary_encode().indices.to_numpy()


def _known(shard: np.ndarray, code: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which pieces equal one of the same shard and a smaller document: all their strings are found."""
    order = np.lexsort((doc, code, shard))
    new = np.r_[True, (np.diff(shard[order]) != 0) | (np.diff(code[order]) != 0)] if len(order) else order.astype(bool)
    least = doc[order][new][np.cumsum(new) - 1] if len(order) else doc
    out = np.empty(len(order), bool)
    out[order] = doc[order] > least
    return out


def _cut_pieces(path: str, bits: int, hot_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = SharedAnchors(path, bits, hot_path)
        for batch in batches:
            for part in text_slices(batch, "text", _SLICE):
                data, at = text_bytes(part.column("text"))
                anchor, row, first, count = batch_anchors(part)
                hit = shared.has(anchor)
                anchor, row, first, count = anchor[hit], row[hit], first[hit], count[hit]
                raw = data.tobytes()
                ends = first + count + SPAN - 1
                texts = [raw[a:b] for a, b in zip(first.tolist(), ends.tolist())]
                doc, key = np.asarray(part.column("doc"))[row], np.asarray(part.column("row"))[row]
                hot = shared.is_hot(anchor)
                pieces = pa.array(texts, pa.binary())
                known = _known(anchor.view(np.int64), _codes(pieces), doc)
                spread = np.where(hot, mix64(doc.view(np.uint64)) % np.uint64(_HOT_SHARDS), 0).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64) * _HOT_SHARDS + spread), pa.array(hot), pa.array(doc), pa.array(key),
                     pa.array((first - at[row]).astype(np.int32)), pa.array(count.astype(np.int32)),
                     pa.compute.if_else(pa.array(known), pa.scalar(None, pa.binary()), pieces)],
                    names=["shard", "hot", "doc", "row", "first", "count", "piece"],
                )

    return run


# ---- suffix arrays ----------------------------------------------------------------------------


def suffix_order(words: np.ndarray) -> np.ndarray:
    """The suffix array of a text given by its words: Larsson-Sadakane refinement.

    Sorted by 8 bytes first; then the rank of the suffix 8, 16, 32, ... behind sorts what is still in
    groups.  The rank of a suffix is the place of its group's first member, so a group that is split
    gets ranks within its own range and sorted groups are never touched again.
    """
    n = len(words)
    order = np.argsort(words, kind="stable")
    ranks = np.empty(n + 1, np.int64)
    ranks[n] = -1  # the end of the text is before all

    def regroup(places: np.ndarray, differs: np.ndarray) -> np.ndarray:
        """Rank the members at ``places``, a group beginning where it differs; the places not alone."""
        ranks[order[places]] = np.maximum.accumulate(np.where(differs, places, 0))
        return places[~(differs & np.r_[differs[1:], True])]

    # Zeros behind the end look like bytes of value 0: the last seven suffixes are ranked by step 1 on.
    unsorted = regroup(np.arange(n), np.r_[True, np.diff(words[order]) != 0]) if n else order
    step = 8
    while len(unsorted):
        at = order[unsorted]
        own, behind = ranks[at], ranks[np.minimum(at + step, n)]
        sort = np.lexsort((-at if step >= n else behind, own))
        order[unsorted] = at[sort]
        own, behind = own[sort], behind[sort]
        unsorted = regroup(unsorted, np.r_[True, (np.diff(own) != 0) | (np.diff(behind) != 0) | (step >= n)])
        step *= 2
    return order


def common_prefixes(words: np.ndarray, order: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Of each suffix, the prefix (up to 50) it shares with the one before it in the order.

    Kasai's rule: where p shares c bytes with its neighbour, p + 1 shares at least c - 1 with its own,
    so counting goes on from there.  The text is walked from several places side by side: piece i has
    ``size[i]`` positions from ``first[i]``.
    """
    before = np.full(len(words), -1, np.int64)
    before[order[1:]] = order[:-1]
    out = np.zeros(len(words), np.int64)
    longest = np.argsort(-size, kind="stable")
    first, size = first[longest], size[longest]
    shared = np.zeros(len(first), np.int64)
    last = len(words) - 1
    for t in range(int(size.max(initial=0))):
        live = int(np.searchsorted(-size, -t, side="left"))
        p = first[:live] + t
        q = before[p]
        c = np.where(q >= 0, np.maximum(shared[:live] - 1, 0), 0)
        todo = np.flatnonzero(q >= 0)
        while len(todo):
            x = words[np.minimum(p[todo] + c[todo], last)] ^ words[np.minimum(q[todo] + c[todo], last)]
            # Whole bytes that agree from the front.
            same = np.full(len(todo), 8, np.int64)
            for b in range(7, -1, -1):
                same[(x >> np.uint64(56 - 8 * b)) & np.uint64(255) != 0] = b
            c[todo] += same
            todo = todo[(same == 8) & (c[todo] < SPAN)]
        shared[:live] = c
        out[p] = np.minimum(c, SPAN)
    return out


def equal_strings(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, offset, group): every 50-byte string of the pieces in order, equal ones in one group.

    Groups are numbered in the order of their strings.
    """
    sizes = np.array([len(p) for p in pieces], np.int64)
    first = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(pieces), np.uint8)
    words = words_at(data)
    order = suffix_order(words)
    group = np.cumsum(common_prefixes(words, order, first, sizes)[order] < SPAN) - 1
    piece = np.repeat(np.arange(len(pieces)), sizes)
    offset = np.arange(len(data)) - first[piece]
    whole = (offset + SPAN <= sizes[piece])[order]
    order, group = order[whole], group[whole]
    return piece[order], offset[order], np.cumsum(np.diff(group, prepend=group[:1]) != 0)


_FOUND = "row long, first int, count int, doc long, piece binary"


def _found_batch(rows: list[tuple]) -> pa.RecordBatch:
    r, f, c, d, p = zip(*rows) if rows else ([],) * 5
    return pa.RecordBatch.from_arrays(
        [pa.array(r, pa.int64()), pa.array(f, pa.int32()), pa.array(c, pa.int32()), pa.array(d, pa.int64()), pa.array(p, pa.binary())],
        names=["row", "first", "count", "doc", "piece"],
    )


def _compare(kept: list[tuple]) -> Iterator[tuple]:
    """Of (anchor, hot, doc, row, first, count, piece): (row, first, count, doc, None) of the strings of
    a larger document than the smallest, and (.., 1, doc, string) of strings of a hot anchor that are
    the smallest in this shard.  Equal pieces of an anchor are of one document."""
    distinct: dict[tuple, int] = {}
    holders: list[list[tuple]] = []
    for p in kept:
        k = distinct.setdefault((p[0], p[6]), len(holders))
        if k == len(holders):
            holders.append([])
        holders[k].append(p)
    doc = np.array([h[0][2] for h in holders], np.int64)  # of equal pieces, all of one document are left
    piece, offset, group = equal_strings([key[1] for key in distinct])
    first = np.flatnonzero(np.r_[True, np.diff(group) != 0]) if len(group) else group
    least = np.minimum.reduceat(doc[piece], first)[group] if len(group) else doc[:0]
    order = np.lexsort((offset, piece))
    piece, offset, larger = piece[order], offset[order], (doc[piece] > least)[order]
    # Runs of strings that are found, within their piece.
    new = np.r_[True, np.diff(piece) != 0] if len(piece) else piece
    before = np.r_[False, larger[:-1]] & ~new if len(piece) else larger
    starts = np.flatnonzero(larger & ~before)
    after = np.r_[larger[1:] & ~new[1:], False] if len(piece) else larger
    ends = np.flatnonzero(larger & ~after) + 1
    for k, a, n in zip(piece[starts].tolist(), offset[starts].tolist(), (ends - starts).tolist()):
        for p in holders[k]:
            yield p[3], p[4] + a, n, p[2], None
    hot = np.array([h[0][1] for h in holders], bool)
    rest = np.flatnonzero(~larger & hot[piece])
    for k, a in zip(piece[rest].tolist(), offset[rest].tolist()):
        for p in holders[k]:
            yield p[3], p[4] + a, 1, p[2], p[6][a : a + SPAN]


def _compare_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole shards at a time, in chunks of bounded size."""
    names = ["row", "first", "count", "doc", "piece"]
    parts = []
    for batch in batches:
        known = batch.column("piece").is_null()
        yield pa.RecordBatch.from_arrays([batch.filter(known).column(c) for c in names], names=names)
        parts.append(batch.filter(pa.compute.invert(known)))
    if not sum(p.num_rows for p in parts):
        return
    kinds = parts[0].schema
    # Column by column, so that only one is there twice.
    columns = [[p.column(c) for p in parts] for c in kinds.names]
    parts.clear()
    for k, column in enumerate(columns):
        columns[k] = pa.concat_arrays(column)
        column.clear()
    rows = pa.RecordBatch.from_arrays(columns, schema=kinds)
    shard, doc = rows.column("shard").to_numpy(), rows.column("doc").to_numpy()
    anchor, hot = shard // _HOT_SHARDS, rows.column("hot").to_numpy(zero_copy_only=False)
    code = _codes(rows.column("piece"))
    # All shards of a hot anchor that are here are compared at once.
    known = _known(anchor, code, doc)
    yield pa.RecordBatch.from_arrays(
        [rows.column(c).filter(pa.array(known)) for c in names[:4]] + [pa.nulls(int(known.sum()), pa.binary())], names=names
    )
    left = np.flatnonzero(~known)
    left = left[np.argsort(anchor[left], kind="stable")]
    code = code[left]
    # An anchor with a single piece has nothing to be compared with, unless it has other shards.
    new = np.r_[True, np.diff(anchor[left]) != 0]
    first = np.flatnonzero(new)
    several = np.minimum.reduceat(code, first) != np.maximum.reduceat(code, first)
    left = left[(several | hot[left][first])[np.cumsum(new) - 1]]
    size = np.cumsum(np.asarray(pa.compute.binary_length(rows.column("piece")), np.int64)[left])
    # Chunks end where an anchor does.
    chunk = size // _CHUNK
    starts = np.r_[True, np.diff(anchor[left]) != 0] if len(left) else np.zeros(0, bool)
    chunk = chunk[np.maximum.accumulate(np.where(starts, np.arange(len(left)), 0))] if len(left) else chunk
    cuts = np.r_[0, np.flatnonzero(np.diff(chunk)) + 1, len(left)]
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        part = rows.take(pa.array(left[a:b]))
        cols = [part.column(c).to_pylist() for c in ("hot", "doc", "row", "first", "count", "piece")]
        if a < b:
            yield _found_batch(list(_compare(list(zip(anchor[left[a:b]].tolist(), *cols)))))


def _merge_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Strings of hot anchors from several shards: each is sought by binary search in the merged run,
    and found if it starts in a smaller document there."""
    rows, docs, firsts, strings = [], [], [], []
    for batch in batches:
        rows.append(np.asarray(batch.column("row")))
        docs.append(np.asarray(batch.column("doc")))
        firsts.append(np.asarray(batch.column("first")))
        strings += batch.column("piece").to_pylist()
    if not strings:
        return
    row, doc, first = (np.concatenate(x) for x in (rows, docs, firsts))
    run = np.array([s + b"\x01" for s in strings], f"S{SPAN + 1}")  # the end keeps trailing zeros apart
    merged, group = np.unique(run, return_inverse=True)
    least = np.full(len(merged), np.iinfo(np.int64).max)
    np.minimum.at(least, group, doc)
    larger = doc > least[np.searchsorted(merged, run)]
    yield _found_batch([(r, f, 1, d, None) for r, f, d in zip(row[larger].tolist(), first[larger].tolist(), doc[larger].tolist())])


# ---- the operator -----------------------------------------------------------------------------


def repeated_strings(texts: DataFrame) -> DataFrame:
    """(row, first, count): ``count`` strings from byte ``first`` of text ``row`` that also start in a
    text of smaller ``doc``.  ``texts`` has (row, doc, text); rows of one key have one text."""
    spark = texts.sparkSession
    slots = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    with arrow_batches(spark, 1000):
        packed = texts.select("doc", "text").mapInArrow(_pack_anchors(slots), _PACKED).repartition("slot")
        shared = materialize(packed.mapInArrow(_shared_anchors, "anchor long, n long"), label="suffix-anchors")
    total = shared.agg(F.count(F.lit(1)).alias("anchors"), F.coalesce(F.sum("n"), F.lit(0)).alias("pieces")).first()
    bits = min(max((16 * total.anchors).bit_length(), _SEGMENT_BITS), _MOST_BITS)
    map_at, hot_at = scratch_path(spark, "suffix-bitmap"), scratch_path(spark, "suffix-hot")
    place = F.col("anchor").bitwiseAND((1 << bits) - 1)
    placed = shared.select(place.alias("place")).repartition(F.shiftright("place", _SEGMENT_BITS))
    save_table(placed.mapInArrow(_bitmap_segments(bits), "segment int, marks binary"), map_at)
    hot = max(_LEAST_HOT, -(-total.pieces // _MOST_HOT))
    save_table(shared.filter(F.col("n") >= hot).select("anchor").coalesce(1), hot_at)

    with arrow_batches(spark, 1000):
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total.pieces // _PIECES))
        pieces = texts.mapInArrow(_cut_pieces(map_at, bits, hot_at), _PIECE).repartition(parts, "shard")
        compared = materialize(pieces.mapInArrow(_compare_shards, _FOUND), label="suffix-compared")
    runs = compared.filter(F.col("piece").isNotNull()).repartition("piece")
    merged = runs.mapInArrow(_merge_runs, _FOUND).select("row", "first", "count")
    return compared.filter(F.col("piece").isNull()).select("row", "first", "count").unionByName(merged)


_CLEANED = "n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"


def _merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """The maximal runs of bytes that the strings cover, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["first"], s["first"] + s["count"] + SPAN - 1) for s in spans or ()):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _within_characters(text: bytes, a: int, b: int) -> tuple[int, int]:
    """The run shortened to whole UTF-8 characters."""
    while a < b and text[a] & 0xC0 == 0x80:
        a += 1
    while a < b < len(text) and text[b] & 0xC0 == 0x80:
        b -= 1
    return a, b


def clean(text: bytes, spans: list[dict] | None, whole_characters: bool) -> tuple[int, int, bytes]:
    """(bytes removed, runs removed, what is left)."""
    kept, at, removed, runs = [], 0, 0, 0
    for a, b in _merged(spans):
        if whole_characters:
            a, b = _within_characters(text, a, b)
        if a < b:
            kept.append(text[at:a])
            at, removed, runs = b, removed + b - a, runs + 1
    kept.append(text[at:])
    return removed, runs, b"".join(kept)


def _apply(with_text: bool, whole_characters: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                removed, runs, kept = clean(text, spans, whole_characters)
                out.append((len(text), removed, runs, kept if with_text else None, hashlib.sha256(kept).hexdigest()))
            n, m, s, k, h = zip(*out) if out else ([],) * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("carried"), pa.array(n, pa.int64()), pa.array(m, pa.int64()), pa.array(s, pa.int64()),
                 pa.array(k, pa.binary()), pa.array(h, pa.string())],
                names=["carried", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"],
            )

    return run


def remove_repeats(
    docs: DataFrame, *, with_text: bool = True, carry: list[str] | None = None, whole_characters: bool = False
) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with n_bytes, n_removed, n_spans, kept_sha256, and with
    ``with_text`` what is left as ``kept`` (binary), written already.

    Texts are UTF-8 bytes, a null text none.  Texts below 50 bytes lose nothing.  A null doc_id counts
    as larger than every other, and rows of equal doc_id take nothing from each other, equal rows
    included.  Strings may begin or end inside a character; with ``whole_characters`` a run removed is
    shortened to whole ones, so that what is left is text.  ``carry`` names the columns to keep (default: all but text); columns of the results'
    names are replaced.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    made = ["n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"]
    carried = [c for c in (docs.columns if carry is None else carry) if c not in (*made, "text")]
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
    texts = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carried]).alias("carried"),
        doc.alias("doc"),
        F.coalesce(F.encode("text", "UTF-8"), F.lit(b"")).alias("text"),
    ).withColumn("row", F.xxhash64("doc", "text"))
    found = materialize(repeated_strings(texts.select("row", "doc", "text")), label="suffix-found")
    # A document's runs are bounded by its length; equal rows share a key and so one list.
    spans = materialize(
        found.distinct().groupBy("row").agg(F.collect_list(F.struct("first", "count")).alias("spans")), label="suffix-spans"
    )
    of = spans.withColumnRenamed("row", "of")
    joined = texts.join(of, F.col("row") == F.col("of"), "left").select("carried", "text", "spans")
    schema = T.StructType([joined.schema["carried"], *T.StructType.fromDDL(_CLEANED).fields])
    with arrow_batches(spark, 1000):
        done = materialize(joined.mapInArrow(_apply(with_text, whole_characters), schema), label="suffix-cleaned")
    return done.select(*[F.col("carried")[c].alias(c) for c in carried], *[c for c in made if with_text or c != "kept"])
