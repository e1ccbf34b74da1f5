"""Toxicity by class-conditional Kneser-Ney language models.

Two bigram models, one of toxic and one of ordinary texts, are counted over all labelled training
texts.  Each interpolates discounted bigrams with continuation counts of words, and these with
continuation counts shared by both classes.  The discount is two sightings: what a class has seen once
or twice passes wholly to the shared counts, so that an expression too rare to tell the classes apart
weighs the same in both.  A text's evidence is its log-likelihood ratio per word, what strongly and very
strongly toxic expressions add to that, its length, and its most toxic expression; for a long text may
hold few insults.  A logistic curve, fitted on labelled rows that the models were not counted on, turns the
evidence into a score.

The counts are gathered by Spark over every training text, all of them.  For the scores only those
rows matter that some class has seen more often than the discount: of any other word, pair or context
the ratio is that of one never seen, exactly, since the shared count cancels out.  These rows are kept
as tables.  A task that scores texts holds the most frequent entries of each table (at most ``head``) and a bitmap of the others.
What neither settles, a word or pair that may be among the others, is joined to the whole tables by
shuffle, as distinct pairs per text, so that the size of the head changes no score.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideflow.llm.common import arrow_batches
from rideflow.llm.words import PowerTable, Words, mix64, split_words, text_slices
from rideflow.session import scratch_path
from rideflow.sources import materialize, save_table

_SLICE = 2 << 20
#: The context of a text's first word.
_BEGIN = np.uint32(0)
_GRAMS = pa.schema([("w", pa.int64()), ("h", pa.int32()), ("n", pa.int64())])
_COUNTS = pa.schema(
    [("kind", pa.int8()), ("key", pa.int64()), ("h", pa.int32())]
    + [(c, pa.int64()) for c in ("toxic", "ordinary", "toxic_types", "ordinary_types", "types")]
)
_COUNTS_DDL = "kind byte, key long, h int, toxic long, ordinary long, toxic_types long, ordinary_types long, types long"
_WORD, _PAIR = 1, 2
#: Mean ratio, largest ratio, logs of the sums of strong and of very strong ratios, log of the length.
N_FEATURES = 5


def _contexts(words: Words) -> np.ndarray:
    """The word before each word, as 32 bits of its hash."""
    before = np.empty(len(words.hashes), np.uint32)
    before[1:] = (words.hashes[:-1] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    starts = words.first_word[:-1][np.diff(words.first_word) > 0]
    before[starts] = _BEGIN
    return before


def _pair_key(w: np.ndarray, h: np.ndarray) -> np.ndarray:
    return mix64(w ^ (h.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))


def _count_slice(words: Words, toxic: np.ndarray) -> pa.RecordBatch:
    h = _contexts(words)
    key = _pair_key(words.hashes, h)
    order = np.argsort(key)
    first = np.flatnonzero(np.r_[True, np.diff(key[order]) != 0]) if len(key) else order
    marks = toxic[words.row][order].astype(np.int64)
    n_all = np.diff(np.r_[first, len(order)])
    n_toxic = np.add.reduceat(marks, first) if len(first) else n_all
    at = order[first]
    packed = (n_toxic << 32) + (n_all - n_toxic)
    return pa.RecordBatch.from_arrays(
        [pa.array(words.hashes[at].view(np.int64)), pa.array(h[at].view(np.int32)), pa.array(packed)], schema=_GRAMS
    )


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = PowerTable()
    for batch in batches:
        for part in text_slices(batch, "text", _SLICE):
            words = split_words(part.column("text").fill_null(""), table)
            yield _count_slice(words, np.asarray(part.column("toxic").fill_null(0)) == 1)


def _sum_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of a partition: a row per pair and one per word (key is its hash)."""
    parts = [b for b in batches if b.num_rows]
    if not parts:
        return
    grams = pa.Table.from_batches(parts)
    w, h, n = (grams.column(c).to_numpy() for c in ("w", "h", "n"))
    order = np.lexsort((h, w))
    w, h, n = w[order], h[order], n[order]
    first = np.flatnonzero(np.r_[True, (np.diff(w) != 0) | (np.diff(h) != 0)])
    # Two counts in one long add up apart while each stays below 2**32, as within a partition.
    n = np.add.reduceat(n, first)
    w, h, toxic, ordinary = w[first], h[first], n >> 32, n & 0xFFFFFFFF
    none = np.zeros(len(w), np.int64)
    key = _pair_key(w.view(np.uint64), h.view(np.uint32)).view(np.int64)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(w), _PAIR, np.int8)), key, h, toxic, ordinary, none, none, none], schema=_COUNTS
    )
    first = np.flatnonzero(np.r_[True, np.diff(w) != 0])
    sums = [np.add.reduceat(x, first) for x in (toxic, ordinary, (toxic > 0).astype(np.int64), (ordinary > 0).astype(np.int64))]
    types = np.diff(np.r_[first, len(w)])
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(first), _WORD, np.int8)), w[first], np.zeros(len(first), np.int32), *sums, types],
        schema=_COUNTS,
    )


@dataclass
class Counts:
    """A table (key, values), its most frequent rows, and a bitmap of the keys of the others."""

    path: str
    head_path: str
    bits_path: str | None
    n_bits: int


@dataclass
class Models:
    """Where the counts lie, their totals, and the fitted curve."""

    words: Counts
    contexts: Counts
    pairs: Counts
    totals: dict[str, float]
    #: What a word that no text holds gets from the shared distribution, by class.
    unseen: dict[str, float]
    discount: float
    strong: tuple[float, float]
    prior: float
    weights: list[float] = field(default_factory=list)

    @property
    def trained(self) -> bool:
        return self.totals["toxic"] > 0 and self.totals["ordinary"] > 0

    @property
    def in_head(self) -> bool:
        """Whether tasks hold all counts."""
        return all(c.bits_path is None for c in (self.words, self.contexts, self.pairs))


#: Bits of one bitmap, and the most bitmaps there are (64 MB in all).
_BITMAP_BITS, _MOST_BITMAPS = 32768, 1 << 14
#: Counts from here on are alike when the head is chosen.
_OFTEN = 100_000


def _keep_counts(whole: DataFrame, path: str, head: int) -> Counts:
    """Write what tasks hold of ``whole`` (key, n, ...), which lies at ``path``."""
    spark = whole.sparkSession
    head_path, bits_path = (scratch_path(spark, f"toxic-{x}") for x in ("head", "bits"))
    sizes = whole.groupBy(F.least("n", F.lit(_OFTEN)).alias("n")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("n"))
    least, held, n_rest = _OFTEN + 1, 0, 0
    for row in sizes.limit(_OFTEN).collect():
        if not n_rest and held + row.rows <= head:
            least, held = row.n, held + row.rows
        else:
            n_rest += row.rows
    if not n_rest:
        return Counts(path, path, None, 0)
    # Of counts above _OFTEN the head holds all or, if they are too many, none.
    often = F.least("n", F.lit(_OFTEN)) >= least
    save_table(whole.filter(often).drop("n"), head_path)
    n_bits = min(-(-16 * n_rest // _BITMAP_BITS), _MOST_BITMAPS) * _BITMAP_BITS
    slot = F.pmod("key", F.lit(n_bits))
    maps = whole.filter(~often).groupBy(F.floor(slot / _BITMAP_BITS).cast("long").alias("part"))
    save_table(maps.agg(F.bitmap_construct_agg(slot % _BITMAP_BITS).alias("bits")), bits_path)
    return Counts(path, head_path, bits_path, n_bits)


def count_models(labelled: DataFrame, *, head: int = 4_000_000, discount: float = 2.0, strong: tuple[float, float] = (1.5, 2.5)) -> Models:
    """Count both models over ``labelled`` (text, toxic 0/1).

    Every word and pair is counted; rows that neither class has seen more than ``discount`` times are as
    if unseen and not kept.  ``head`` is the most entries of a table that a task holds.  A ratio above
    the first of ``strong`` (e-fold) is strong, above the second very strong.
    """
    spark = labelled.sparkSession
    grams_at, words_at = (scratch_path(spark, f"toxic-{x}") for x in ("grams", "word-sums"))
    texts = labelled.select(F.lower("text").alias("text"), F.col("toxic").cast("int").alias("toxic"))
    with arrow_batches(spark, 500):
        grams = texts.mapInArrow(_count_grams, "w long, h int, n long").repartition("w", "h")
        save_table(grams.mapInArrow(_sum_partition, _COUNTS_DDL), grams_at)
    counts = spark.read.schema(_COUNTS_DDL).parquet(grams_at)
    sums = ["toxic", "ordinary", "toxic_types", "ordinary_types", "types"]
    save_table(counts.filter(F.col("kind") == _WORD).groupBy("key").agg(*[F.sum(c).alias(c) for c in sums]), words_at)
    words = spark.read.schema("key long, " + ", ".join(f"{c} long" for c in sums)).parquet(words_at)

    def rest_of(c: str):
        return F.greatest(F.col(c) - F.lit(discount), F.lit(0.0))

    classes = ("toxic", "ordinary")
    own = [F.coalesce(F.sum(rest_of(f"{c}_types")), F.lit(0.0)).alias(f"{c}_kept") for c in classes]
    totals = words.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums], *own).first().asDict()
    # The shared distribution: continuation counts of both classes, one part in a million words unseen.
    left = {c: max(1.0 - totals[f"{c}_kept"] / max(totals[f"{c}_types"], 1), 1e-9) for c in classes}
    low = [
        (rest_of(f"{c}_types") / max(totals[f"{c}_types"], 1) + left[c] * F.col("types") / max(totals["types"], 1)).alias(f"low_{c}")
        for c in classes
    ]
    both = F.col("toxic") + F.col("ordinary")
    short = F.lit(0xFFFFFFFF)
    often = F.greatest(*classes) > discount
    pairs = counts.filter((F.col("kind") == _PAIR) & often)
    # Mass that the pairs leave to words alone, by context; a text's first word has no context.
    held = pairs.groupBy(F.col("h").cast("long").bitwiseAND(short).alias("of")).agg(*[F.sum(rest_of(c)).alias(f"held_{c}") for c in classes])
    seen = words.groupBy(F.col("key").bitwiseAND(short).alias("key")).agg(*[F.sum(c).alias(c) for c in classes])
    contexts = seen.filter(F.col("key") != int(_BEGIN)).join(held, F.col("key") == F.col("of"))

    def size_of(c: str):
        return F.greatest(F.col(c), F.lit(1)).cast("double")

    def free(c: str):
        return F.greatest(F.least(1.0 - F.coalesce(f"held_{c}", F.lit(0.0)) / size_of(c), F.lit(1.0)), F.lit(1e-3))

    def kept(rows: DataFrame, label: str) -> Counts:
        path = scratch_path(spark, f"toxic-{label}")
        save_table(rows, path)
        return _keep_counts(spark.read.schema(rows.schema).parquet(path), path, head)

    contexts = contexts.select(
        "key", both.alias("n"), *[size_of(c).alias(f"size_{c}") for c in classes], *[free(c).alias(f"rest_{c}") for c in classes]
    )
    return Models(
        kept(words.filter(often).select("key", both.alias("n"), *low), "words"),
        kept(contexts, "contexts"),
        kept(pairs.select("key", both.alias("n"), *classes), "pairs"),
        totals,
        {c: left[c] * 1e-6 for c in classes},
        discount,
        strong,
        0.0,
    )


def _read(path: str, columns: list[str]) -> pa.Table:
    store, top = fs.FileSystem.from_uri(path)
    return pq.read_table(top, filesystem=store, columns=columns)


class _Held:
    """What a task holds of a table: sorted keys, values (a last one for keys that are not held)."""

    def __init__(self, counts: Counts, names: list[str], missing: list[float]):
        def read(c: str) -> np.ndarray:
            return _read(counts.head_path, [c]).column(c).to_numpy()

        # One column at a time: less memory.
        keys = read("key")
        order = np.argsort(keys)
        self.keys = keys[order]
        del keys
        self.values = [np.r_[read(c)[order], m] for c, m in zip(names, missing)]
        self.n_bits, self.bits = counts.n_bits, None
        if counts.bits_path is not None:
            self.bits = np.zeros(counts.n_bits // 8, np.uint8)
            maps = _read(counts.bits_path, ["part", "bits"])
            for part, bits in zip(maps.column("part").to_pylist(), maps.column("bits").to_pylist()):
                at = part * (_BITMAP_BITS // 8)
                self.bits[at : at + len(bits)] = np.frombuffer(bits, np.uint8)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each key, or one past the last, and whether the table may hold it elsewhere."""
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            at = np.where(self.keys[at] == keys, at, len(self.keys))
        else:
            at = np.zeros(len(keys), np.int64)
        if self.bits is None:
            return at, np.zeros(len(keys), bool)
        slot = np.mod(keys, self.n_bits)
        return at, (at == len(self.keys)) & ((self.bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1).astype(bool)


_OPEN = pa.struct([("key", pa.int64()), ("w", pa.int64()), ("h", pa.int64()), ("n", pa.int64())])
_PART_DDL = "struct<total:double,top:double,strong:double,stronger:double,n:bigint,open:array<struct<key:bigint,w:bigint,h:bigint,n:bigint>>>"


class Scorer:
    """The head of the models in a task."""

    def __init__(self, models: Models):
        self.models = models
        u = models.unseen
        self.words = _Held(models.words, ["low_toxic", "low_ordinary"], [u["toxic"], u["ordinary"]])
        self.contexts = _Held(models.contexts, ["size_toxic", "size_ordinary", "rest_toxic", "rest_ordinary"], [np.inf, np.inf, 1.0, 1.0])
        self.pairs = _Held(models.pairs, ["toxic", "ordinary"], [0.0, 0.0])
        for n in self.pairs.values:
            np.maximum(n - models.discount, 0.0, out=n)
        self.low = dict(zip(("toxic", "ordinary"), self.words.values))

    def _keys(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h = _contexts(words)
        return words.hashes.view(np.int64), h.astype(np.int64), _pair_key(words.hashes, h).view(np.int64)

    def ratios(self, words: Words) -> np.ndarray:
        """log P(word | before, toxic) - log P(word | before, ordinary) of every word, by the head."""
        return self._ratios(*self._keys(words))[0]

    def _ratios(self, w: np.ndarray, h: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ratios, and which of them the head does not settle."""
        (word, open_w), (before, open_h), (pair, open_p) = self.words.find(w), self.contexts.find(h), self.pairs.find(key)
        logs = [
            np.log(self.pairs.values[c][pair] / self.contexts.values[c][before] + self.contexts.values[2 + c][before] * self.words.values[c][word])
            for c in (0, 1)
        ]
        return logs[0] - logs[1], open_w | open_h | open_p

    def parts(self, words: Words) -> pa.StructArray:
        """Per text: sum and largest of the settled ratios, sums of the strong and very strong ones, number
        of words, and the distinct pairs that are open."""
        total, top, strong = np.zeros(words.n_texts), np.full(words.n_texts, -np.inf), np.zeros((2, words.n_texts))
        n = np.diff(words.first_word)
        some = np.flatnonzero(n)
        w, h, key = self._keys(words)
        ratios, unsettled = self._ratios(w, h, key)
        if len(some):
            first = words.first_word[some]
            settled = np.where(unsettled, 0.0, ratios)
            total[some] = np.add.reduceat(settled, first)
            top[some] = np.maximum.reduceat(np.where(unsettled, -np.inf, ratios), first)
            for k, least in enumerate(self.models.strong):
                strong[k, some] = np.add.reduceat(np.where(settled > least, settled, 0.0), first)
        at = np.flatnonzero(unsettled)
        at = at[np.lexsort((key[at], words.row[at]))]
        new = np.r_[True, (np.diff(key[at]) != 0) | (np.diff(words.row[at]) != 0)] if len(at) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        times, at = np.diff(np.r_[first, len(at)]), at[first]
        items = pa.StructArray.from_arrays([pa.array(x) for x in (key[at], w[at], h[at], times)], fields=list(_OPEN))
        cuts = np.searchsorted(words.row[at], np.arange(words.n_texts + 1)).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(cuts), items)
        return pa.StructArray.from_arrays(
            [pa.array(total), pa.array(top), pa.array(strong[0]), pa.array(strong[1]), pa.array(n.astype(np.int64)), lists],
            names=["total", "top", "strong", "stronger", "n", "open"],
        )


def _parts_of(models: Models):
    @F.arrow_udf(_PART_DDL)
    def parts(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table, scorer = PowerTable(), Scorer(models)
        for batch in texts:
            one = pa.RecordBatch.from_arrays([batch.fill_null("")], names=["text"])
            found = [scorer.parts(split_words(part.column("text"), table)) for part in text_slices(one, "text", _SLICE)]
            yield pa.concat_arrays(found) if found else scorer.parts(split_words(batch.fill_null(""), table))

    return parts


def _settled(rows: DataFrame, models: Models) -> DataFrame:
    """``rows`` (_row, _part, ...), written already, with the open pairs added to what is settled."""
    spark = rows.sparkSession
    tables = {name: spark.read.parquet(getattr(models, name).path).drop("n") for name in ("words", "contexts")}
    tables["pairs"] = spark.read.schema("key long, toxic long, ordinary long").parquet(models.pairs.path)
    found = rows.select("_row", F.inline("_part.open"))
    for name, key in (("pairs", "key"), ("words", "w"), ("contexts", "h")):
        found = found.join(tables[name].withColumnRenamed("key", f"_{name}"), F.col(key) == F.col(f"_{name}"), "left")

    def log_of(c: str):
        kept = F.greatest(F.coalesce(c, F.lit(0)) - F.lit(models.discount), F.lit(0.0)) / F.coalesce(f"size_{c}", F.lit(float("inf")))
        return F.log(kept + F.coalesce(f"rest_{c}", F.lit(1.0)) * F.coalesce(f"low_{c}", F.lit(models.unseen[c])))

    found = found.select("_row", F.col("n").alias("times"), (log_of("toxic") - log_of("ordinary")).alias("ratio"))
    strong = [F.when(F.col("ratio") > least, F.col("ratio")).otherwise(0.0) for least in models.strong]
    more = found.groupBy(F.col("_row").alias("_of")).agg(
        F.sum(F.col("times") * F.col("ratio")).alias("_total"),
        F.max("ratio").alias("_top"),
        *[F.sum(F.col("times") * x).alias(c) for x, c in zip(strong, ("_strong", "_stronger"))],
    )
    whole = F.struct(
        (F.col("_part.total") + F.coalesce("_total", F.lit(0.0))).alias("total"),
        F.greatest("_part.top", "_top").alias("top"),
        *[(F.col(f"_part.{c}") + F.coalesce(f"_{c}", F.lit(0.0))).alias(c) for c in ("strong", "stronger")],
        F.col("_part.n").alias("n"),
    )
    return rows.join(more, F.col("_row") == F.col("_of"), "left").withColumn("_part", whole).drop("_of", "_total", "_top", "_strong", "_stronger")


def _with_parts(docs: DataFrame, models: Models, carry: Sequence[str]) -> DataFrame:
    """The columns ``carry`` of ``docs`` with _part, whole: written already, and joined to the counts if
    tasks hold not all."""
    with arrow_batches(docs.sparkSession, 500):
        rows = docs.select(*[F.col(f"`{c}`") for c in carry], _parts_of(models)(F.lower("text")).alias("_part"))
        if models.in_head:
            return materialize(rows.withColumn("_part", F.col("_part").dropFields("open")), label="toxic-parts")
        return _settled(materialize(rows.withColumn("_row", F.monotonically_increasing_id()), label="toxic-parts"), models).drop("_row")


def _features() -> list:
    """Of a row with _part, N_FEATURES numbers (zeros without words)."""
    n = F.greatest("_part.n", F.lit(1))
    own = [F.col("_part.total") / n, F.col("_part.top"), F.log1p("_part.strong"), F.log1p("_part.stronger"), F.log1p("_part.n")]
    return [F.when(F.col("_part.n") > 0, x).otherwise(0.0) for x in own]


def _fit_curve(x: np.ndarray, y: np.ndarray) -> list[float]:
    """Logistic regression with a small ridge, by Newton steps on standardised features."""
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-9)
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    ridge = np.diag([0.1] * x.shape[1] + [1e-3])
    b = np.zeros(z.shape[1])

    def loss(b: np.ndarray) -> float:
        return float(np.logaddexp(0.0, z @ b).sum() - y @ (z @ b) + b @ ridge @ b / 2)

    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(z @ b, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (y - p) - ridge @ b)
        # Classes that separate well make full steps overshoot.
        while loss(b + step) > loss(b) and np.abs(step).max() > 1e-8:
            step = step / 2
        b += step
        if np.abs(step).max() < 1e-8:
            break
    slope = b[:-1] / scale
    return [*map(float, slope), float(b[-1] - slope @ mean)]


def with_mark(docs: DataFrame, marks: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` with a column mark (boolean): true where ``marks`` may hold the row's ``key``, by a bitmap
    of their keys; all that it holds have one, so that few texts are moved in vain.  The bitmaps are
    broadcast: there are 16 bits for each key, up to a fixed bound beyond which more rows have a mark."""
    n = min(max(-(-16 * marks.count() // _BITMAP_BITS), 1), _MOST_BITMAPS)
    slot = F.pmod(F.xxhash64(key, F.lit("mark")), F.lit(n * _BITMAP_BITS))
    part, place = F.floor(slot / _BITMAP_BITS).cast("long"), slot % _BITMAP_BITS
    maps = marks.groupBy(part.alias("_bits_of")).agg(F.bitmap_construct_agg(place).alias("_bits"))
    maps = materialize(maps, label="toxic-bitmaps")
    byte = F.conv(F.hex(F.substring("_bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.coalesce(F.call_function("getbit", byte, (place % 8).cast("int")) == 1, F.lit(False))
    return docs.join(F.broadcast(maps), part == F.col("_bits_of"), "left").select(*docs.columns, bit.alias("mark"))


def fit(docs: DataFrame, marks: DataFrame, *, max_fit_rows: int = 20_000, **model) -> Models:
    """Models and curve from ``docs`` (doc_id, text) and ``marks`` (doc_id, toxic 0/1, null: no mark).

    Four fifths of the marked rows, by a hash of doc_id, are counted; at most ``max_fit_rows`` of the
    rest fit the curve.  A doc_id marked several times is toxic if any mark says so.
    """
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(5))
    marks = marks.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    docs = docs.select("doc_id", "text")
    counted = materialize(marks.filter(fold != 0), label="toxic-marks")
    models = count_models(with_mark(docs.filter(fold != 0), counted).filter("mark").drop("mark").join(counted, "doc_id"), **model)
    held = marks.filter(fold == 0).orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(max_fit_rows)
    # At most max_fit_rows rows of two numbers: small by construction.
    sample = docs.join(F.broadcast(held), "doc_id").select(F.lower("text").alias("text"), F.col("toxic").cast("int").alias("toxic"))
    if models.trained:
        rows = _with_parts(sample, models, ["toxic"]).select(F.array(*_features()).alias("x"), "toxic").limit(2 * max_fit_rows).toPandas()
    else:
        rows = sample.select("toxic").limit(2 * max_fit_rows).toPandas()
    y = rows.toxic.to_numpy(float)
    models.prior = float(y.mean()) if len(y) else 0.0
    # With one class only there is nothing to fit: the most toxic expression decides.
    models.weights = _fit_curve(np.stack(rows.x), y) if models.trained and 0 < y.sum() < len(y) else [0.0, 2.0, 0.0, 0.0, 0.0, -6.0]
    return models


def score(docs: DataFrame, models: Models, *, carry: Sequence[str] | None = None) -> DataFrame:
    """The columns ``carry`` (default: all) of every row of ``docs`` with a column score between 0 and 1;
    a higher score is likelier toxic.

    Null and empty texts, and texts without letters or digits, get the share of toxic marks; so does
    every text if the marks have one class only (0 without marks).  Repeated rows and rows that share a
    doc_id are scored each by its text, long texts whole.  A column score is replaced.
    """
    carry = [c for c in (docs.columns if carry is None else carry) if c != "score"]
    if not models.trained:
        return docs.select(*[F.col(f"`{c}`") for c in carry], F.lit(models.prior).alias("score"))

    z = F.lit(models.weights[-1])
    for weight, x in zip(models.weights, _features()):
        z = z + F.lit(weight) * x
    z = F.greatest(F.least(z, F.lit(500.0)), F.lit(-500.0))
    found = F.when(F.col("_part.n") > 0, 1.0 / (1.0 + F.exp(-z))).otherwise(F.lit(models.prior))
    return _with_parts(docs.drop("score"), models, carry).select(*[F.col(f"`{c}`") for c in carry], found.alias("score"))
