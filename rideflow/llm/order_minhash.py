"""Near duplicates by Order MinHash.

A text is its sequence of shingles (five words), each labelled with its occurrence number in the text.
For each of several hash functions the sketch keeps the few labelled shingles of smallest hash, *in
the order of the text*; texts that agree in one such entry are candidates.  Agreement is likely only
if shingles are shared and stand in the same order, as in texts of small edit distance.

Candidates are verified by alignment: the longest common subsequence of the two shingle sequences,
in the band of diagonals that the threshold leaves open.  With L shingles aligned, the similarity is
L / (m + n - L), the Jaccard similarity of labelled shingles as far as they can be aligned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rideflow.llm.common import arrow_batches
from rideflow.llm.components import components
from rideflow.llm.words import PowerTable, Words, mix64, shingle_hashes, split_words, text_slices
from rideflow.sources import materialize

SHINGLE = 5
_SLICE = 1 << 20
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


# ---- sketches ---------------------------------------------------------------------------------


def _labelled(row: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Hashes of (shingle, occurrence number in its text)."""
    key = mix64(hashes ^ mix64(row.astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    same = np.r_[False, key[order][1:] == key[order][:-1]]
    again = np.flatnonzero(same)
    out = mix64(hashes)
    if len(again):
        at = np.arange(len(order))
        first = np.maximum.accumulate(np.where(same, 0, at))
        out[order[again]] = mix64(hashes[order[again]] + (at - first)[again].astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    return out


def sketch_keys(words: Words, n_hashes: int, n_least: int) -> np.ndarray:
    """(texts, n_hashes) keys; rows of texts without words are meaningless."""
    row, hashes = shingle_hashes(words, SHINGLE)
    counts = np.bincount(row, minlength=words.n_texts)
    some = np.flatnonzero(counts)
    out = np.zeros((words.n_texts, n_hashes), np.uint64)
    if not len(some):
        return out
    label = _labelled(row, hashes)
    n = counts[some]
    first = np.cumsum(n) - n
    rates = mix64(np.arange(1, n_hashes + 1, dtype=np.uint64)) | np.uint64(1)
    for t, rate in enumerate(rates):
        value = label * rate
        value ^= value >> np.uint64(32)
        at = np.empty((n_least, len(some)), np.int64)
        for k in range(n_least):
            least = np.minimum.reduceat(value, first)
            hit = np.flatnonzero(value == np.repeat(least, n))
            # Equal values within a text only come from a text that ran out (all at the top).
            group = np.searchsorted(first, hit, side="right") - 1
            one = np.r_[True, group[1:] != group[:-1]]
            at[k] = hit[one]
            value[hit] = _TOP
        out_of = np.arange(n_least)[:, None] >= n[None, :]
        at = np.where(out_of, np.iinfo(np.int64).max, at)
        at.sort(axis=0)
        key = np.full(len(some), np.uint64(t + 1))
        for k in range(n_least):
            there = at[k] < np.iinfo(np.int64).max
            key = np.where(there, mix64(key * np.uint64(0x9E3779B97F4A7C15) + label[np.where(there, at[k], 0)]), key)
        out[some, t] = key
    return out


def _sketch(n_hashes: int, n_least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = PowerTable()
        for batch in batches:
            for part in text_slices(batch, "text", _SLICE):
                words = split_words(part.column("text"), table, tokens=True)
                keys = sketch_keys(words, n_hashes, n_least)
                n = np.diff(words.first_word)
                some = n > 0
                flat = pa.array(keys[some].ravel().view(np.int64))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(some.sum() + 1, dtype=np.int32) * n_hashes), flat)
                keep = pa.array(some)
                size = np.maximum(n[some] - SHINGLE + 1, 1).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("node").filter(keep), part.column("same").filter(keep), pa.array(size), lists],
                    names=["node", "same", "size", "keys"],
                )

    return run


# ---- alignment --------------------------------------------------------------------------------


def aligned_at_least(x: np.ndarray, y: np.ndarray, need: int) -> bool:
    """Whether the longest common subsequence of x and y has at least ``need`` elements.

    Equal ends are aligned first.  The middle is aligned by rows kept as bits of an integer; only the
    diagonals in reach are kept: one that leaves out more of x or y than ``need`` allows is of no use.
    """
    if min(len(x), len(y)) < need:
        return False
    n = min(len(x), len(y))
    differs = np.flatnonzero(x[:n] != y[:n])
    head = int(differs[0]) if len(differs) else n
    x, y = x[head:], y[head:]
    n = min(len(x), len(y))
    differs = np.flatnonzero(x[len(x) - n :][::-1] != y[len(y) - n :][::-1])
    tail = int(differs[0]) if len(differs) else n
    x, y = x[: len(x) - tail], y[: len(y) - tail]
    need -= head + tail
    if need <= 0:
        return True
    if min(len(x), len(y)) < need:
        return False
    # What the two share without regard to order bounds what can be aligned.
    ux, cx = np.unique(x, return_counts=True)
    uy, cy = np.unique(y, return_counts=True)
    _, ix, iy = np.intersect1d(ux, uy, assume_unique=True, return_indices=True)
    if np.minimum(cx[ix], cy[iy]).sum() < need:
        return False
    return _banded_lcs(x, y, len(x) - need, len(y) - need) >= need


def _banded_lcs(x: np.ndarray, y: np.ndarray, skip_x: int, skip_y: int) -> int:
    """Longest common subsequence over alignments that skip at most skip_x of x and skip_y of y.

    Element i of x is then aligned with y[i - skip_x : i + skip_y + 1].  Bit j of ``row`` is clear
    where the length grows at y[j]; the update is the usual one of carries.
    """
    places: dict[int, int] = {}
    for j, v in enumerate(y.tolist()):
        places[v] = places.get(v, 0) | (1 << j)
    full = (1 << len(y)) - 1
    row = full
    for i, v in enumerate(x.tolist()):
        match = places.get(v, 0)
        if not match:
            continue
        low = max(i - skip_x, 0)
        match = (match >> low << low) & ((1 << (i + skip_y + 1)) - 1)
        hit = row & match
        row = ((row + hit) | (row - hit)) & full
    return len(y) - row.bit_count()


def similar(x: np.ndarray, y: np.ndarray, least: float) -> bool:
    """Whether the aligned similarity of two shingle sequences is at least ``least``."""
    total = len(x) + len(y)
    # L / (total - L) >= least; the small slack keeps exact fractions such as 0.8 in.
    return aligned_at_least(x, y, int(np.ceil(least * total / (1 + least) - 1e-9)))


def _sequences(texts: pa.Array, table: PowerTable) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Of each text, its shingles in order, and its labelled shingles."""
    row, hashes = shingle_hashes(split_words(texts, table, tokens=True), SHINGLE)
    cuts = np.searchsorted(row, np.arange(1, len(texts)))
    return np.split(hashes, cuts), np.split(_labelled(row, hashes), cuts)


def _verify(least: float, with_rest: bool):
    """Pairs that are similar; ``with_rest``: all pairs, how many labelled shingles each has and both
    share, those that b has besides and, if a has ``least`` of b's, those of a that b lacks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = PowerTable()
        for batch in batches:
            for part in (p for some in text_slices(batch, "text_b", _SLICE) for p in text_slices(some, "text_a", _SLICE)):
                (xs, marked_x), (ys, marked_y) = (_sequences(part.column(c), table) for c in ("text_a", "text_b"))
                found = np.array([similar(x, y, least) for x, y in zip(xs, ys)], bool)
                if not with_rest:
                    yield part.select(["a", "b"]).filter(pa.array(found))
                    continue
                rest = [np.setdiff1d(y, x, assume_unique=True) for x, y in zip(marked_x, marked_y)]
                size_a, size_b = (np.array([len(v) for v in m], np.int32) for m in (marked_x, marked_y))
                shared = size_b - np.array([len(r) for r in rest], np.int32)
                near = shared >= size_b * least - 1e-9
                lost = [np.setdiff1d(x, y, assume_unique=True) if c else x[:0] for x, y, c in zip(marked_x, marked_y, near)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("a"), part.column("b"), pa.array(found), pa.array(size_a), pa.array(size_b), pa.array(shared),
                     pa.array(near), _lists(rest), _lists(lost)],
                    names=["a", "b", "similar", "size_a", "size_b", "shared", "near", "rest", "lost"],
                )

    return run


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    flat = np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, parts)]).astype(np.int32)), pa.array(flat))


# ---- the join ---------------------------------------------------------------------------------

_LINKS = "a long, b long"
_COMPARED = f"{_LINKS}, similar boolean, size_a int, size_b int, shared int, near boolean, rest array<long>, lost array<long>"


def _compared(pairs: DataFrame, texts: DataFrame, least: float, with_rest: bool = False) -> DataFrame:
    """The pairs (a, b), their texts compared.  b's text is joined first: a may be in very many pairs,
    and then Spark splits that key of the second join, whose sides are both plain."""
    b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    both = pairs.join(b, "b").join(a, "a").select("a", "b", "text_a", "text_b")
    with arrow_batches(pairs.sparkSession, 500):
        return materialize(both.mapInArrow(_verify(least, with_rest), _COMPARED if with_rest else _LINKS), label="near-links")


def _unsettled(compared: DataFrame, found: DataFrame) -> DataFrame:
    """``compared`` with the class of b, of those leaders whose texts are not all in one class yet."""
    of = found.select(F.col("node").alias("b"), F.col("label").alias("class"))
    classes = materialize(
        compared.select("a", "b").join(of, "b", "left").select("a", "b", F.coalesce("class", "b").alias("class")), label="near-classed"
    )
    several = classes.groupBy("a").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter("low <> high")
    return materialize(compared.join(classes.join(several.select("a"), "a", "left_semi"), ["a", "b"]), label="near-unsettled")


def _common(unsettled: DataFrame) -> DataFrame:
    """(a, b, shingle, weight, other, n): labelled shingles in which b and its leader a differ, n texts of
    the leader like b, and not all of one class.  ``other``: b has it, else a has.

    Shingles of the same texts are one, ``weight`` says how many: all of a passage, or around a changed
    word.  What only texts of one class have or lack is left out: only texts of two classes are still to
    meet, and whatever both have or lack is had or lacked by two classes.  So a group of changed copies
    that are similar to their leader gives no rows, however many shingles they change alike.
    """
    differ = unsettled.select("a", "b", "class", F.explode("rest").alias("shingle"), F.lit(True).alias("other")).unionByName(
        unsettled.select("a", "b", "class", F.explode("lost").alias("shingle"), F.lit(False).alias("other"))
    )
    texts = differ.groupBy("a", "shingle", "other").agg(
        F.count(F.lit(1)).alias("n"), F.min("class").alias("low"), F.max("class").alias("high"),
        F.bit_xor(F.xxhash64("b")).alias("one"), F.bit_xor(F.xxhash64(F.lit(7), "b")).alias("two"),
    )
    common = texts.filter("low <> high").groupBy("a", "other", "n", "one", "two").agg(
        F.min("shingle").alias("shingle"), F.count(F.lit(1)).alias("weight")
    )
    common = materialize(common.select("a", "shingle", "n", "weight"), label="near-common")
    return materialize(differ.drop("class").join(common, ["a", "shingle"]), label="near-common")


def _reach(compared: DataFrame, common: DataFrame, least: float) -> DataFrame:
    """(led, node, size, size_led, shared, near, differ, close, own, held) of every text and leader.

    ``near``: the leader has ``least`` of its shingles.  ``differ``: the labelled shingles that one of the
    two has alone; ``close``: so few that the two are similar but for the order.  ``own`` and ``held``: its
    shingles besides the leader's, and those in which it differs, that texts of other classes differ in, too.

    Two texts of a leader and of two classes share at most the smaller ``shared`` plus the smaller ``own``:
    a shingle they share is the leader's or not.
    """
    sums = common.groupBy("a", "b").agg(
        F.sum(F.when(F.col("other"), F.col("weight")).otherwise(0)).cast("int").alias("own"), F.sum("weight").cast("int").alias("held")
    )
    differ = F.col("size_a") + F.col("size_b") - 2 * F.col("shared")
    return materialize(
        compared.drop("rest", "lost", "similar", "class").join(sums, ["a", "b"], "left").select(
            F.col("a").alias("led"), F.col("b").alias("node"), F.col("size_b").alias("size"), F.col("size_a").alias("size_led"),
            "shared", "near", differ.alias("differ"),
            (differ <= (F.col("size_a") + F.col("size_b")) * ((1 - least) / (1 + least)) + 1e-9).alias("close"),
            F.coalesce("own", F.lit(0)).alias("own"), F.coalesce("held", F.lit(0)).alias("held"),
        ),
        label="near-reach",
    )


def _rare_buckets(common: DataFrame, reach: DataFrame, least: float) -> DataFrame:
    """(bucket, node, shared, own, kind): texts of a leader that have something rare in common.

    If two sets must have k elements in common, they have one that is not among the k - 1 most frequent
    of either.  Three kinds of pairs use that:

    * one text is not near the leader: it shares at least ceil(least * size) shingles with a similar one,
      and what the leader does not give of them must come from its others;
    * both are near it but not close: let D be the shingles in which a text differs from the leader.  Those
      of x and y outside both D are shared, so similar texts have |Dx| + |Dy| - 2 |Dx and Dy| of at most
      (1 - least) / (1 + least) of both sizes, while |Dy| alone is more than that of y and the leader;
    * one is near, the other close: likewise, and |Dx and Dy| is also at least |Dx| less that bound.

    So texts that share a passage but are mostly their own, and copies changed in different places, meet
    nowhere.  Buckets of the same texts are one, and those without a pair of their kind are left out.  In
    one of the last kind, texts of kind 1 need not meet each other.
    """
    bound = (1 - least) / (1 + least)
    lacking = F.ceil(F.col("size") * least - 1e-9) - F.col("shared")
    half = F.ceil((F.col("differ") + (F.col("size_led") - F.col("size")) * bound) / 2 - 1e-9)
    whole = F.ceil(F.col("differ") - F.col("size") * (bound * (1 + 1 / least)) - 1e-9)

    placed = common.select(F.col("a").alias("led"), F.col("b").alias("node"), "shingle", "weight", "n", "other")
    by_n = Window.partitionBy("led", "node").orderBy("n", "shingle").rowsBetween(Window.unboundedPreceding, 0)
    # The place of the first of the shingles that are one.
    placed = placed.withColumn("all_place", F.sum("weight").over(by_n) - F.col("weight") + 1).withColumn(
        "place", F.sum(F.when(F.col("other"), F.col("weight")).otherwise(0)).over(by_n) - F.col("weight") + 1
    )
    placed = placed.join(reach, ["led", "node"])

    def within(place: str, most: str, k: Column) -> Column:
        return F.col(place) <= F.col(most) - F.greatest(k, F.lit(1)) + 1

    kinds = F.array(
        F.when(F.col("other") & within("place", "own", lacking), F.struct(F.lit(0).alias("family"), (~F.col("near")).alias("side"))),
        F.when(F.expr("near AND NOT close") & within("all_place", "held", half), F.struct(F.lit(1).alias("family"), F.lit(True).alias("side"))),
        F.when(
            F.col("near") & within("all_place", "held", F.when(F.col("close"), half).otherwise(whole)),
            F.struct(F.lit(2).alias("family"), (~F.col("close")).alias("side")),
        ),
    )
    rare = placed.select("led", "shingle", "node", "shared", "own", F.explode(F.array_compact(kinds)).alias("in"))
    rare = materialize(rare.select("led", "shingle", "node", "shared", "own", "in.family", "in.side"), label="near-rare")
    groups = rare.groupBy("family", "led", "shingle").agg(
        F.count(F.lit(1)).alias("n"), F.max("side").alias("any"), F.min("side").alias("all"),
        F.bit_xor(F.xxhash64("node")).alias("one"), F.bit_xor(F.xxhash64(F.lit(7), "node")).alias("two"),
    )
    groups = groups.filter("n > 1 AND any AND (family < 2 OR NOT all)")
    groups = groups.groupBy("family", "led", "n", "one", "two").agg(F.min("shingle").alias("shingle"))
    groups = materialize(groups.select("family", "led", "shingle"), label="near-groups")
    return rare.join(groups, ["family", "led", "shingle"]).select(
        F.xxhash64("family", "led", "shingle").alias("bucket"), "node", "shared", "own",
        F.expr("int(family = 2 AND side)").alias("kind"),
    )


def _merged(found: DataFrame, links: DataFrame) -> DataFrame:
    """The classes (node, label), joined by further links: components of the links between labels."""
    for end in ("a", "b"):
        of = found.select(F.col("node").alias(end), "label")
        links = links.join(of, end, "left").withColumn(end, F.coalesce("label", end)).drop("label")
    joined = materialize(components(links), label="near-joined")
    grown = found.join(joined.select(F.col("node").alias("label"), F.col("label").alias("less")), "label", "left").select(
        "node", F.coalesce("less", "label").alias("label")
    )
    alone = joined.join(found, "node", "left_anti").select("node", "label")
    return materialize(grown.unionByName(alone), label="near-classes")


def near_duplicates(
    docs: DataFrame, *, least: float = 0.8, n_hashes: int = 16, n_least: int = 3
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id and class_id, the smallest doc_id of its class.

    Texts are in a class if they are equal or a chain of pairs of aligned similarity ``least`` or more
    connects them.  Equal texts are joined first, so copies are compared once.  A bucket is parted by
    size, so that texts which may be similar are together in a part, and each text of a part is compared
    with the most central one, its leader.  Texts that are not close to the leader then meet others of it
    only where both have or lack the same rare shingles (:func:`_rare_buckets`); those that are close, but
    for their order, meet in the part itself.  As long as such a bucket holds texts of several classes, its texts are
    compared with the next 16, 256, ... of it.  Every pair of a bucket is compared, or already in one
    class, or cannot be similar, by the sizes of the two, by what both share with the leader or by their
    rare shingles: so neither a group of similar texts, nor one of changed copies, nor one of texts that
    share a passage gives all its pairs.

    Words are runs of non-blank characters; a text of fewer than five is one shingle.  Null and empty
    texts and texts of blanks have nothing to compare: each row is a class of its own.  A null doc_id
    comes back with a null class_id.  Rows that share a doc_id are one document.  An empty table
    gives no rows.
    """
    spark = docs.sparkSession
    ids = docs.select("doc_id")
    texts = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(
        F.col("doc_id").cast("long").alias("node"), "text"
    )
    with arrow_batches(spark, 500):
        sketched = texts.withColumn("same", F.unhex(F.md5("text")))
        sketches = materialize(
            sketched.select("node", "same", "text").mapInArrow(
                _sketch(n_hashes, n_least), "node long, same binary, size int, keys array<long>"
            ),
            label="near-sketches",
        )
    kept = materialize(
        sketches.groupBy("same").agg(F.min("node").alias("first"), F.min_by("keys", "node").alias("keys"), F.min("size").alias("size")),
        label="near-kept",
    )
    copies = materialize(sketches.select("same", "node").join(kept.select("same", "first"), "same").select("node", "first"), label="near-copies")
    # Unlike texts of one doc_id are linked, too.
    twice = copies.groupBy("node").agg(F.min("first").alias("a"), F.max("first").alias("b")).filter("a <> b").select("node", "a")
    bridges = copies.join(twice, "node").select("a", F.col("first").alias("b")).filter("a <> b")

    entries = kept.select(F.col("first").alias("node"), "size", F.explode("keys").alias("bucket"))
    shared = materialize(
        entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("low"), F.max("node").alias("high"))
        .filter("low <> high").select("bucket", "n"),
        label="near-buckets",
    )
    # How central a text is: the sizes of its buckets.  The source of many copies shares most keys.
    members = entries.join(shared, "bucket")
    rank = members.groupBy("node").agg(F.sum("n").alias("weight"))
    rank = materialize(rank, label="near-rank")
    # Similar texts lie in the same band of sizes or in neighbouring ones, so in one of the two parts.
    band = F.floor(F.log(F.col("size")) / (-math.log(least) + 1e-6))
    parts = members.select("node", "size", F.explode(F.array(band, band + 1)).alias("part"), "bucket")
    parts = materialize(parts.select(F.xxhash64("bucket", "part").alias("bucket"), "node", "size").join(rank, "node"), label="near-members")
    several = parts.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low <> high")
    rest = materialize(parts.join(several.select("bucket"), "bucket", "left_semi"), label="near-members")
    needed = texts.join(rank.select("node"), "node", "left_semi").groupBy("node").agg(F.min("text").alias("text"))
    needed = materialize(needed, label="near-texts")

    order = Window.partitionBy("bucket").orderBy(F.col("weight").desc(), "node")

    def leading(rows: DataFrame, n: int) -> DataFrame:
        best = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
        kept = {"node": "a", "class": "class_a", "size": "size_a", "weight": "weight_a", "shared": "shared_a", "own": "own_a", "kind": "kind_a"}
        return materialize(best.select("bucket", *[F.col(c).alias(k) for c, k in kept.items()]), label="near-leaders")

    def fits(most_shared: Column) -> Column:
        total = F.col("size") + F.col("size_a")
        return most_shared * (1 + least) >= total * least - 1e-9

    # The first leader of each bucket meets all of it.
    first = F.max(F.struct("weight", F.bitwise_not("node").alias("not_node"))).alias("first")
    lead = rest.groupBy("bucket").agg(first).select("bucket", F.bitwise_not("first.not_node").alias("led"))
    rest = rest.join(materialize(lead, label="near-leaders"), "bucket").filter("node <> led")
    rest = materialize(rest, label="near-members")
    compared = _compared(
        materialize(rest.select(F.col("led").alias("a"), F.col("node").alias("b")).distinct(), label="near-pairs"), needed, least, True
    )
    found = materialize(components(compared.filter("similar").select("a", "b").unionByName(bridges)), label="near-classes")
    unsettled = _unsettled(compared, found)
    common = _common(unsettled)
    reach = _reach(unsettled, common, least)
    close = rest.join(reach.filter("near AND close").drop("size"), ["led", "node"]).withColumn("kind", F.lit(0))
    rare = _rare_buckets(common, reach, least).join(rest.select("node", "size", "weight").distinct(), "node")
    columns = ["bucket", "node", "size", "weight", "shared", "own", "kind"]
    rest = materialize(close.select(columns).unionByName(rare.select(columns)), label="near-members")
    smaller = F.least("size", "size_a")
    leaders = 16
    while True:
        rest = rest.drop("class").join(found.withColumnRenamed("label", "class"), "node", "left").withColumn("class", F.coalesce("class", "node"))
        rest = materialize(rest, label="near-members")
        open_ = rest.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter("low <> high")
        rest = materialize(rest.join(materialize(open_.select("bucket"), label="near-open"), "bucket", "left_semi"), label="near-members")
        if rest.isEmpty():
            break
        lead = leading(rest, leaders)
        after = (F.col("weight") < F.col("weight_a")) | ((F.col("weight") == F.col("weight_a")) & (F.col("node") > F.col("a")))
        reachable = F.least(smaller, F.least("shared", "shared_a") + F.least("own", "own_a"))
        pairs = rest.join(lead, "bucket").filter(
            (F.col("class") != F.col("class_a")) & fits(reachable) & after & (F.col("kind") + F.col("kind_a") < 2)
        )
        pairs = materialize(pairs.select("a", F.col("node").alias("b")).distinct(), label="near-pairs")
        if not pairs.isEmpty():
            links = _compared(pairs, needed, least)
            if not links.isEmpty():
                found = _merged(found, links)
        led = lead.select("bucket", F.col("a").alias("node"))
        rest = rest.join(led, ["bucket", "node"], "left_anti")
        leaders *= 16
    # Copies are of the class of the text they equal; as that is the first of them, labels stay smallest.
    of = found.withColumnRenamed("node", "first")
    classes = copies.join(of, "first", "left").select("node", F.coalesce("label", "first").alias("label")).distinct()
    return ids.join(classes, F.col("doc_id") == F.col("node"), "left").select(
        "doc_id", F.coalesce("label", F.col("doc_id").cast("long")).alias("class_id")
    )
