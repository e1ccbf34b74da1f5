"""Ranked lexical search of a set of items over all documents, by groups of equal presence masks.

One pass over the texts writes down, for every document, its number of terms and which of the items'
terms it holds how often; sums over these give the numbers of documents, terms and holders.  A second
pass takes blocks of documents.  For each item the presence bits of its terms are packed to one mask a
document, and documents of equal masks are one group.  The most that a document of a group can score
follows from its mask, the largest frequencies in the block and the group's shortest document.  Groups
are evaluated by descending maximum until the next is below the tenth best score that the task knows;
no document left out can be among the best.  Each task hands on its best per item, and a window over
those ranks them.

Documents that cannot be told from better ones are never dropped: a group whose maximum equals the
tenth best score is evaluated, since ties go to the smaller id.

Defined cases: null and empty texts have no terms and are not counted; items without a term have no
rows; rows that share an item_id are one item with the terms of all; rows that share a doc_id are each
a document; a null doc_id comes last among ties.  Very long texts are read in pieces.  An empty table
of either kind gives no rows; further columns of either table are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rideflow.llm.common import arrow_batches
from rideflow.llm.words import PowerTable, lowered_pieces, split_words
from rideflow.session import scratch_path
from rideflow.sources import materialize, save_table

_PIECE = 4 << 20
#: Documents of a block, and how many a task evaluates at first.
_BLOCK, _FIRST = 8192, 64
_NO_ID = np.iinfo(np.int64).max


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct terms of each item, as hashes."""
    table = PowerTable()
    for batch in batches:
        for rows, pieces in lowered_pieces(batch.column("text").fill_null(""), _PIECE):
            words = split_words(pieces, table)
            pairs = np.unique(np.c_[rows[words.row], words.hashes.view(np.int64)], axis=0)
            yield pa.RecordBatch.from_arrays([batch.column("item").take(pa.array(pairs[:, 0])), pa.array(pairs[:, 1])], names=["item", "term"])


def _read(path: str, columns: list[str]) -> pa.Table:
    store, top = fs.FileSystem.from_uri(path)
    return pq.read_table(top, filesystem=store, columns=columns)


def _vocabulary(path: str) -> np.ndarray:
    """The distinct terms of a block of items, ascending."""
    lists = _read(path, ["terms"]).column("terms")
    return np.unique(np.concatenate([np.zeros(0, np.int64), *[c.flatten().to_numpy() for c in lists.chunks]]))


def _profiles(path: str):
    """Of each document its id, number of terms, and the items' terms that it holds with their frequencies."""

    def profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, vocabulary = PowerTable(), _vocabulary(path)
        for batch in batches:
            n, found = np.zeros(batch.num_rows, np.int64), []
            for rows, pieces in lowered_pieces(batch.column("text").fill_null(""), _PIECE):
                words = split_words(pieces, table)
                row, hashes = rows[words.row], words.hashes.view(np.int64)
                n += np.bincount(row, minlength=batch.num_rows)
                if len(vocabulary):
                    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
                    known = vocabulary[at] == hashes
                    found.append(np.unique(row[known] * len(vocabulary) + at[known], return_counts=True))
            keys = np.concatenate([np.zeros(0, np.int64), *[k for k, _ in found]])
            times = np.concatenate([np.zeros(0, np.int64), *[t for _, t in found]])
            order = np.argsort(keys, kind="stable")
            keys, times = keys[order], times[order]
            # The pieces of one long text may have the same term.
            first = np.flatnonzero(np.r_[True, np.diff(keys) != 0]) if len(keys) else order
            times = np.add.reduceat(times, first) if len(first) else times
            row, term = np.divmod(keys[first], max(len(vocabulary), 1))
            cuts = np.searchsorted(row, np.arange(batch.num_rows + 1))

            def packed(x: np.ndarray) -> pa.Array:
                offsets = (cuts * 4).astype(np.int32)
                return pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(offsets), pa.py_buffer(x.astype("<u4"))])

            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n), packed(term), packed(times)], names=["doc_id", "n", "terms", "times"])

    return profiles


def _postings(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, frequency) of all rows of a profile, by row."""
    ends = np.asarray(pa.compute.binary_length(batch.column("terms")), np.int64) // 4
    lists = [np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u4").astype(np.int64) for c in ("terms", "times")]
    return np.repeat(np.arange(batch.num_rows), ends), *lists


def _holders(path: str):
    def holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(path)
        df = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            df += np.bincount(_postings(batch)[1], minlength=len(df))
        yield pa.RecordBatch.from_arrays([pa.array(vocabulary), pa.array(df)], names=["term", "df"])

    return holders


def _impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class _Best:
    """The best documents of an item so far."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def least(self) -> int:
        """A score below this cannot be among the best."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        some = scores >= self.least
        scores, ids = np.r_[self.scores, scores[some]], np.r_[self.ids, ids[some]]
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]


def group_masks(present: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents by the mask of the terms they hold, from ``present`` (terms x documents).

    Returns the distinct masks (masks x terms, 0 or 1) and each document's mask.
    """
    n_terms, n_docs = present.shape
    bits = np.zeros((-(-n_terms // 64) * 8, n_docs), np.uint8)
    packed = np.packbits(present, axis=0, bitorder="little")
    bits[: len(packed)] = packed
    bits = np.ascontiguousarray(bits.T)
    keys = bits.view(np.uint64)[:, 0] if bits.shape[1] == 8 else bits.view(f"V{bits.shape[1]}")[:, 0]
    _, first, mask = np.unique(keys, return_index=True, return_inverse=True)
    return np.unpackbits(bits[first], axis=1, bitorder="little", count=n_terms).astype(np.int64), mask


def _search_block(best: _Best, tf: np.ndarray, w: np.ndarray, m: np.ndarray, ids: np.ndarray) -> None:
    """Add the documents of a block (``tf``: terms x documents) to the best of an item."""
    some = np.flatnonzero(tf.any(axis=0))
    if not len(some):
        return
    tf = tf[:, some]
    masks, mask = group_masks(tf > 0)
    order = np.argsort(mask, kind="stable")
    starts = np.searchsorted(mask[order], np.arange(len(masks) + 1))
    shortest = np.minimum.reduceat(m[some][order], starts[:-1])
    most_tf = tf.max(axis=1).astype(np.int64)
    # First by the block's shortest document, then, of what may still count, by the group's own.
    bound = masks @ (w * _impact(most_tf, shortest.min()))
    alive = np.flatnonzero(bound >= best.least)
    bound = (masks[alive] * w * _impact(most_tf, shortest[alive][:, None])).sum(axis=1)
    by_bound = np.argsort(-bound, kind="stable")
    alive, bound = alive[by_bound], bound[by_bound]
    sizes = np.cumsum(starts[alive + 1] - starts[alive])
    done, step = 0, _FIRST
    while done < len(alive) and bound[done] >= best.least:
        reach = int(np.searchsorted(sizes, (sizes[done - 1] if done else 0) + step)) + 1
        reach = min(reach, int(np.searchsorted(-bound, -best.least, "right")))
        docs = np.concatenate([order[starts[g] : starts[g + 1]] for g in alive[done:reach]])
        scores = (w[:, None] * _impact(tf[:, docs].astype(np.int64), m[some[docs]])).sum(axis=0)
        best.add(scores, ids[some[docs]])
        done, step = reach, 2 * step


def _search(path: str, weights_at: str, n_docs: int, n_terms: int, k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(path)
        found = _read(weights_at, ["term", "w"])
        order = np.argsort(found.column("term").to_numpy())
        weights = found.column("w").to_numpy()[order]
        items = _read(path, ["item", "terms"])
        wanted = [np.searchsorted(vocabulary, np.asarray(t, np.int64)) for t in items.column("terms").to_pylist()]
        best = [_Best(k) for _ in wanted]
        column_of = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            ids = batch.column("doc_id").fill_null(_NO_ID).to_numpy()
            m = 10 + (90 * batch.column("n").to_numpy() * n_docs) // n_terms
            row, term, times = _postings(batch)
            by_term = np.argsort(term, kind="stable")
            row, times = row[by_term], times[by_term]
            cuts = np.searchsorted(term[by_term], np.arange(len(vocabulary) + 1))
            for terms, top in zip(wanted, best):
                terms = terms[cuts[terms + 1] > cuts[terms]]
                tf = np.zeros((len(terms), batch.num_rows), np.int32)
                for j, t in enumerate(terms.tolist()):
                    tf[j, row[cuts[t] : cuts[t + 1]]] = times[cuts[t] : cuts[t + 1]]
                _search_block(top, tf, weights[terms], m, ids)
        sizes = [len(b.ids) for b in best]
        ids = np.concatenate([np.zeros(0, np.int64), *[b.ids for b in best]])
        scores = np.concatenate([np.zeros(0, np.int64), *[b.scores for b in best]])
        named = items.column("item").combine_chunks().take(pa.array(np.repeat(np.arange(len(best)), sizes)))
        yield pa.RecordBatch.from_arrays([named, pa.array(ids, mask=ids == _NO_ID), pa.array(scores)], names=["item", "doc_id", "score"])

    return search


def rank_documents(docs: DataFrame, items: DataFrame, *, k: int = 10, block_terms: int = 500_000) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best of ``docs`` (doc_id, text) for each of ``items``
    (item_id, text), scores above 0, equal scores by ascending doc_id.

    Terms are runs of ASCII letters and digits and of all other characters, A-Z lower-cased, compared
    by 64-bit hashes.  ``doc_id`` is a whole number.  Items are taken in blocks of about ``block_terms``
    terms in all, which is what a task holds of them; each block reads the documents once.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    kind = items.schema["item_id"].dataType.simpleString()
    pairs = items.select(F.col("item_id").alias("item"), "text").mapInArrow(_terms, f"item {kind}, term long")
    lists = materialize(pairs.groupBy("item").agg(F.array_sort(F.collect_set("term")).alias("terms")), label="search-items")
    total = lists.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("n")).first().n
    n_blocks = -(-total // block_terms)
    parts = []
    for block in range(n_blocks):
        path, weights_at = scratch_path(spark, "search-block"), scratch_path(spark, "search-weights")
        save_table(lists.filter(F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == block), path)
        with arrow_batches(spark, 1000):
            rows = docs.mapInArrow(_profiles(path), "doc_id long, n long, terms binary, times binary")
            rows = materialize(rows, label="search-profiles")
        size = rows.filter("n > 0").agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        if not size.docs:
            break
        with arrow_batches(spark, _BLOCK):
            held = rows.select("terms", "times").mapInArrow(_holders(path), "term long, df long")
            ratio = F.lit(2.0 * size.docs + 2.0) / (2.0 * F.col("df") + 1.0)
            weights = held.groupBy("term").agg(F.sum("df").alias("df")).select("term", F.floor(F.log(ratio) * 1000).alias("w"))
            save_table(weights, weights_at)
            found = rows.mapInArrow(_search(path, weights_at, size.docs, size.terms, k), f"item {kind}, doc_id long, score long")
            parts.append(materialize(found, label="search-best"))
    if not parts:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select(F.col("item").alias("item_id"), "rank", "doc_id", "score")
