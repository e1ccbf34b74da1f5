"""Spelling variants: words within one edit of each other, found by dynamic programming over sorted lists.

Two words one edit apart agree on their first or on their last half.  Each word goes to the lists of
its halves; a list is the sorted words that share a half, and Spark spreads the lists over tasks.  A
task walks a list once for all of its words as patterns: the row of the edit matrix at a depth, banded
to one off the diagonal, is kept while the next word shares that many characters with the one before
(their longest common prefix), patterns whose whole band exceeds one edit leave the row, and when none
is left every following word that shares the prefix is skipped.

A list of more than ``max_list`` words is parted again: its words agree on one half, so two of them
that are one edit apart agree on the first or the last half of what remains, and so on until at most
one place is open, where a list is bounded by the alphabet.  A pair is counted in one list only: that
of the first halves that it shares, or else of the last.

Defined cases: null and empty texts have no runs; a null doc_id counts as the empty string; rows that
share an id are each a document; very long texts are read in pieces and a very long run is one word.
An empty table gives an empty table; further columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideflow.llm.common import arrow_batches
from rideflow.llm.words import PowerTable, lowered_pieces, range_hashes, text_bytes
from rideflow.sources import materialize

_PIECE = 4 << 20
#: A run's code point is dropped if this divides the checksum.
_TYPO = 97
#: Up to so many patterns are followed one by one.
_FEW = 8
#: Runs of more bytes get their checksum one at a time.
_LONG = 64


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table.astype(np.uint32)


_CRC = _crc_table()


def letter_runs(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, number of code points) of the runs of ASCII letters and U+00C0 to U+00FF in texts
    that lie end to end, parted at ``at``."""
    upper = data & 0xDF
    inside = (upper >= ord("A")) & (upper <= ord("Z")) & (data < 0x80)
    lead = data == 0xC3  # U+00C0 to U+00FF are C3 80 to C3 BF
    inside |= lead
    inside[1:] |= lead[:-1]
    edge = np.zeros(len(data) + 1, np.int8)
    edge[:-1] = inside
    opens = np.flatnonzero(np.diff(edge, prepend=0) == 1)
    cuts = at[1:-1][(at[1:-1] > 0) & (at[1:-1] < len(data))]
    parted = cuts[inside[cuts] & inside[cuts - 1]]
    starts = np.union1d(opens, parted)
    ends = np.union1d(np.flatnonzero(np.diff(edge, prepend=0) == -1), parted)
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    return starts, ends, points[ends] - points[starts]


def _checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """crc32 of each range, carried on from the checksum ``before``."""
    sizes = ends - starts
    order = np.argsort(-sizes, kind="stable")
    state = ~before[order].astype(np.uint32)
    first = starts[order]
    left = np.minimum(sizes[order], _LONG)
    for j in range(int(left.max(initial=0))):
        n = int(np.searchsorted(-left, -j, "left"))
        state[:n] = _CRC[(state[:n] ^ data[first[:n] + j]) & 0xFF] ^ (state[:n] >> np.uint32(8))
    found = np.empty(len(order), np.uint32)
    found[order] = ~state
    for k in np.flatnonzero(sizes > _LONG).tolist():
        found[k] = zlib.crc32(data[starts[k] + _LONG : ends[k]].tobytes(), int(found[k]))
    return found


def _count_words(least: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = PowerTable()
        for batch in batches:
            prefixes = np.array([zlib.crc32(f"{'' if d is None else d}:".encode()) for d in batch.column("doc_id").to_pylist()], np.uint32)
            for rows, pieces in lowered_pieces(batch.column("text").fill_null(""), _PIECE):
                data, at = text_bytes(pieces)
                starts, ends, points = letter_runs(data, at)
                long = points >= least
                starts, ends, points = starts[long], ends[long], points[long]
                hashes = range_hashes(data, starts, ends, table)
                row = rows[np.searchsorted(at, starts, "right") - 1]
                # A run has one checksum in a document, however often it stands there.
                order = np.lexsort((hashes, row))
                first = np.flatnonzero(np.r_[True, (np.diff(hashes[order]) != 0) | (np.diff(row[order]) != 0)]) if len(order) else order
                times = np.diff(np.r_[first, len(order)])
                at_run = order[first]
                h = _checksums(data, starts[at_run], ends[at_run], prefixes[row[at_run]])
                typo = h % _TYPO == 0
                words, n = [], []
                for k, t, c in zip(at_run[typo].tolist(), times[typo].tolist(), h[typo].tolist()):
                    run = data[starts[k] : ends[k]].tobytes().decode()
                    drop = c % len(run)
                    if len(run) > least:
                        words.append(run[:drop] + run[drop + 1 :])
                        n.append(t)
                same, times = at_run[~typo], times[~typo]
                _, one, which = np.unique(hashes[same], return_index=True, return_inverse=True)
                raw = data.tobytes()
                words += [raw[a:b].decode() for a, b in zip(starts[same[one]].tolist(), ends[same[one]].tolist())]
                n += np.bincount(which, weights=times, minlength=len(one)).astype(np.int64).tolist()
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(n, pa.int64())], names=["word", "n"])

    return count


def count_words(docs: DataFrame, *, least_length: int = 5, least_count: int = 3) -> DataFrame:
    """(word, n): the words of ``docs`` (doc_id, text) with at least ``least_length`` code points and
    ``least_count`` occurrences.

    Words are runs of ASCII letters and U+00C0 to U+00FF, A-Z lower-cased.  If 97 divides h, the crc32 of
    ``<doc_id>:<run>``, the run's code point h % length is dropped.
    """
    with arrow_batches(docs.sparkSession, 2000):
        runs = docs.select("doc_id", "text").mapInArrow(_count_words(least_length), "word string, n long")
        counts = runs.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)
        return materialize(counts, label="spelling-words")


class _Patterns:
    """The words of a list that are ``size`` long, as rows of characters with one cell of padding before."""

    def __init__(self, chars: np.ndarray, rows: np.ndarray):
        self.chars = np.zeros((len(rows), chars.shape[1] + 3), np.uint8)
        self.chars[:, 1:-2] = chars[rows]
        self.few = [c.tobytes() for c in self.chars] if len(rows) <= _FEW else None

    def first_row(self) -> tuple | list:
        n = len(self.chars)
        if self.few is not None:
            return [(who, 2, 0, 1) for who in range(n)]
        return np.arange(n), np.full(n, 2, np.uint8), np.zeros(n, np.uint8), np.ones(n, np.uint8)

    def next_row(self, row: tuple | list, depth: int, char: int) -> tuple | list:
        """The banded row of the edit matrix at ``depth``, from the one above; columns depth - 1, depth,
        depth + 1 of the patterns that still are within one edit.  Few patterns are a list, pattern by
        pattern; many are arrays."""
        if isinstance(row, list):
            return self._next_few(row, depth, char)
        who, above0, above1, above2 = row
        if len(who) <= _FEW:
            return self._next_few(list(zip(*[x.tolist() for x in row])), depth, char)
        q = self.chars[who, depth - 1 : depth + 2] != char
        left = np.minimum(above0 + q[:, 0], above1 + 1)
        middle = np.minimum(np.minimum(above1 + q[:, 1], above2 + 1), left + 1)
        right = np.minimum(above2 + q[:, 2], middle + 1)
        near = np.minimum(np.minimum(left, middle), right) <= 1
        return who[near], left[near], middle[near], right[near]

    def _next_few(self, row: list, depth: int, char: int) -> list:
        found = []
        for who, above0, above1, above2 in row:
            q = self.few[who] if self.few is not None else self.chars[who].tobytes()
            left = min(above0 + (q[depth - 1] != char), above1 + 1)
            middle = min(above1 + (q[depth] != char), above2 + 1, left + 1)
            right = min(above2 + (q[depth + 1] != char), middle + 1)
            if left <= 1 or middle <= 1 or right <= 1:
                found.append((who, left, middle, right))
        return found


def near_pairs(words: list[bytes], size: int, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (pattern, word) one edit apart of the ascending list ``words`` (one byte a character), as
    places: patterns are ``size`` long, words ``size`` or one more, and they share fewer than ``cap``
    characters at their start."""
    lengths = np.array([len(w) for w in words])
    width = int(lengths.max())
    chars = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width)
    rows = np.flatnonzero(lengths == size)
    patterns = _Patterns(chars, rows)
    prefix = np.minimum((chars[1:] != chars[:-1]).argmax(axis=1), np.minimum(lengths[1:], lengths[:-1]))
    above = [patterns.first_row()]
    found_q, found_w = [], []
    dead = width + 1
    for k, word in enumerate(words):
        shared = int(prefix[k - 1]) if k else 0
        if shared >= dead:
            continue  # the prefix that it shares already exceeds one edit for every pattern
        del above[shared + 1 :]
        dead = width + 1
        for depth in range(shared + 1, len(word) + 1):
            row = patterns.next_row(above[-1], depth, word[depth - 1])
            if not len(row if isinstance(row, list) else row[0]):
                dead = depth
                break
            above.append(row)
        else:
            last, column = above[-1], 2 if len(word) == size else 1
            if isinstance(last, list):
                near = [r[0] for r in last if r[column] == 1]
            else:
                near = last[0][last[column] == 1].tolist()
            found_q += near
            found_w += [k] * len(near)
    if not found_q:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    q, w = rows[np.array(found_q)], np.array(found_w)
    if cap <= width:
        early = (chars[q, :cap] != chars[w, :cap]).any(axis=1)
        q, w = q[early], w[early]
    return q, w


def _scan_list(words: list[bytes], n: np.ndarray, size: int, cap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the words of a list that have near ones: (place, number of them, place of the most frequent)."""
    q, w = near_pairs(words, size, cap)
    longer = np.array([len(words[k]) > size for k in w.tolist()], bool)
    of, near = np.r_[q, w[longer]], np.r_[w, q[longer]]
    order = np.lexsort((near, -n[near], of))
    of, near = of[order], near[order]
    first = np.flatnonzero(np.r_[True, np.diff(of) != 0]) if len(of) else of
    return of[first], np.diff(np.r_[first, len(of)]), near[first]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lists of a partition, sorted, one after the other."""
    names = ["word", "n_near", "best_n", "best"]
    found: list[tuple] = []

    def close(key: tuple, rows: list[tuple[bytes, int]]) -> None:
        size, cap = key[0], key[1]
        words = [w for w, _ in rows]
        if len(rows) < 2 or not any(len(w) == size for w in words):
            return
        n = np.array([x for _, x in rows], np.int64)
        for of, n_near, best in zip(*[x.tolist() for x in _scan_list(words, n, size, cap)]):
            found.append((words[of].decode("latin-1"), n_near, int(n[best]), words[best].decode("latin-1")))

    key, rows = None, []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("size", "cap", "head", "tail", "word", "n")]
        for size, cap, head, tail, word, n in zip(*columns):
            if (size, cap, head, tail) != key:
                if key is not None:
                    close(key, rows)
                key, rows = (size, cap, head, tail), []
            rows.append((word.encode("latin-1"), n))
        if len(found) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], names=names)
            found.clear()
    if key is not None:
        close(key, rows)
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], names=names)


_KEY = ["size", "cap", "head", "tail"]
_NO_CAP = 1 << 30


def _halves(rows: DataFrame) -> DataFrame:
    """Each row (word, n, size, cap, a, b) to the lists of its two halves: of the ``size`` characters of
    the shorter word of a pair the first ``a`` and the last ``b`` are shared already."""
    half = ((F.col("size") - F.col("a") - F.col("b")) / 2).cast("int")
    first = F.struct((F.col("a") + half).alias("a"), F.col("b").alias("b"), F.col("cap").alias("cap"))
    last = F.struct(F.col("a").alias("a"), (F.col("b") + half).alias("b"), F.least("cap", F.col("a") + half).alias("cap"))
    parted = rows.select("word", "n", "size", F.explode(F.array(first, last)).alias("to")).select("word", "n", "size", "to.*")
    return parted.withColumn("head", F.expr("substring(word, 1, a)")).withColumn("tail", F.expr("substring(word, -b, b)"))


def near_words(words: DataFrame, *, max_list: int = 5000) -> DataFrame:
    """(word, n_near, best_n, best): of the words of ``words`` (word, n; at least two characters, none
    above U+00FF) that have words one edit away, their number and the most frequent one (of equally
    frequent ones the smallest)."""
    length = F.length("word")
    sizes = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("size"))
    start = sizes.select("*", F.lit(_NO_CAP).alias("cap"), F.lit(0).alias("a"), F.lit(0).alias("b"))
    lists = materialize(_halves(start), label="spelling-lists")
    while True:
        # Lists that are too long, unless only one place of theirs is open.
        long = lists.groupBy(*_KEY, "a", "b").agg(F.count(F.lit(1)).alias("rows")).filter((F.col("rows") > max_list) & (F.col("size") - F.col("a") - F.col("b") >= 2))
        long = materialize(long.select(*[F.col(c).alias(f"long_{c}") for c in [*_KEY, "a", "b"]]), label="spelling-long")
        if long.isEmpty():
            break
        same = [F.col(c) == F.col(f"long_{c}") for c in [*_KEY, "a", "b"]]
        short = lists.join(long, same, "left_anti")
        lists = materialize(short.unionByName(_halves(lists.join(long, same, "left_semi"))), label="spelling-lists")
    sorted_lists = lists.select(*_KEY, "word", "n").repartition(*_KEY).sortWithinPartitions(*_KEY, "word")
    found = sorted_lists.mapInArrow(_scan, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    sums = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return materialize(sums.select("word", "n_near", (-F.col("best.n")).alias("best_n"), F.col("best.word").alias("best")), label="spelling-near")


def follow(links: DataFrame) -> DataFrame:
    """(word, root): the end of the chain of ``links`` (word, form), which has no circles, by doubling."""
    ends = materialize(links.select("word", F.col("form").alias("root")), label="spelling-roots")
    while True:
        beyond = ends.select(F.col("word").alias("at"), F.col("root").alias("beyond"))
        ends = materialize(
            ends.join(beyond, F.col("root") == F.col("at"), "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("at").isNotNull().alias("moved")),
            label="spelling-roots",
        )
        if ends.filter("moved").isEmpty():
            return ends.select("word", "root")
        ends = ends.select("word", "root")


def spelling_variants(docs: DataFrame, *, ratio: int = 2, max_list: int = 5000) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``docs`` (doc_id, text), see ``count_words``.

    The form is the near word of largest n if that is at least ``ratio`` times the word's; the root is
    where the forms lead.
    """
    words = count_words(docs)
    near = near_words(words, max_list=max_list).withColumnRenamed("word", "of")
    common = F.col("best_n") >= ratio * F.col("n")
    joined = words.join(near, F.col("word") == F.col("of"), "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(common, F.col("best")).alias("form"),
        F.when(common, F.col("best_n")).alias("form_n"),
    )
    joined = materialize(joined, label="spelling-forms")
    roots = follow(joined.filter(F.col("form").isNotNull()).select("word", "form")).withColumnRenamed("word", "of")
    found = joined.join(roots, F.col("word") == F.col("of"), "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
