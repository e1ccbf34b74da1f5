"""BPE encoding with content-defined chunk reuse, and decoding.

A rolling hash over the last bytes cuts texts into chunks, so that the same passage is cut alike in
every document.  Chunks that occur more than once are encoded once, by Spark, and their ids travel to
each place; what lies between them is encoded where the text is read.  A chunk's own encoding is wrong
near its ends, where the cut may part a word: every join is therefore encoded again over a window that
reaches into the chunks on either side up to their second blank, and the window's ids must agree with
those of each chunk over a whole stretch between two blanks.  Where they do not, the window becomes
the whole text.  The result is that of encoding each text whole.

Texts move only as the chunks that are shared; other text never leaves the task that reads it.

Defined cases: null and empty texts have no ids and decode to the empty string; rows that share an id
or a text are encoded each on its own; a very long text is encoded in stretches between blanks, and a
run without a blank in one go; columns of any name may be carried.  An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import os
import string
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rideflow.llm.common import arrow_batches
from rideflow.llm.words import text_bytes, text_slices
from rideflow.session import scratch_path
from rideflow.sources import materialize, save_table

_SLICE = 4 << 20
#: Bytes of the rolling hash's window; least and most bytes of a chunk; one place in 2**_CUT_BITS is a cut.
_WINDOW, _LEAST, _MOST, _CUT_BITS = 32, 128, 8192, 9
#: Words whose ids a task remembers, and bytes of text that it splits at once.
_MEMO, _STRETCH = 600_000, 1 << 20
#: Marks that may stand behind a word, alone or in runs; an apostrophe may belong to the word.
_PUNCTUATION = string.punctuation.replace("'", "").encode()
#: Ids whose names and tokens are put end to end at once.
_AT_ONCE = 1 << 20
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True

#: What ``encode_documents`` can return, by name.
OUTPUTS = {
    "ids": "array<int>",
    "decoded": "string",
    "n_tokens": "bigint",
    "ids_sha256": "string",
    "decoded_sha256": "string",
}


def _gear() -> np.ndarray:
    """A fixed random number for each byte, the same on every executor."""
    return np.frombuffer(b"".join(hashlib.blake2b(bytes([b]), digest_size=4).digest() for b in range(256)), np.uint32)


_GEAR = _gear()


def rolling_cuts(data: np.ndarray) -> np.ndarray:
    """Places in ``data`` after which the hash of the last bytes asks for a cut, never inside a character."""
    h = _GEAR[data]
    k = 1
    while k < _WINDOW:
        h[k:] += h[:-k] << np.uint32(k)
        k *= 2
    at = np.flatnonzero(h >> np.uint32(32 - _CUT_BITS) == 0) + 1
    at = at[at < len(data)]
    return at[(data[at] & 0xC0) != 0x80]


def chunk_bounds(data: np.ndarray, text_starts: np.ndarray) -> list[list[int]]:
    """Chunk borders of each text of ``data``; the first is its start, the last its end."""
    cuts = rolling_cuts(data)
    found = []
    for a, b in zip(text_starts[:-1].tolist(), text_starts[1:].tolist()):
        borders = [a]
        lo, hi = np.searchsorted(cuts, [a + _LEAST, b])
        for cut in cuts[lo:hi].tolist():
            while cut - borders[-1] > _MOST:
                borders.append(_whole_character(data, borders[-1] + _MOST))
            if cut - borders[-1] >= _LEAST:
                borders.append(cut)
        while b - borders[-1] > _MOST:
            borders.append(_whole_character(data, borders[-1] + _MOST))
        if b > a:
            borders.append(b)
        found.append(borders)
    return found


def _whole_character(data: np.ndarray, at: int) -> int:
    while data[at] & 0xC0 == 0x80:
        at -= 1
    return at


def _safe_points(chunk: np.ndarray) -> np.ndarray:
    """Places where a blank follows something else."""
    blank = _BLANK[chunk]
    return np.flatnonzero(blank[1:] & ~blank[:-1]) + 1


def _marks(raw: bytes) -> tuple[int, int, int, int] | None:
    """The first two and the last two safe points of a chunk; None if it has fewer than two."""
    points = _safe_points(np.frombuffer(raw, np.uint8))
    return (int(points[0]), int(points[1]), int(points[-2]), int(points[-1])) if len(points) >= 2 else None


def _key(raw: bytes) -> bytes:
    return hashlib.blake2b(raw, digest_size=16).digest()


class TextEncoder:
    """A tokenizer in a task."""

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives each task one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.kind = np.dtype(np.uint16 if size <= 1 << 16 else np.uint32)
        self.names = pa.array([b"%d " % i for i in range(size)], pa.large_binary())
        # Without a decoder the library joins tokens by blanks.
        tokens = ((self.tokenizer.id_to_token(i) or "").encode() + b" " for i in range(size))
        self.tokens = None if self.tokenizer.decoder else pa.array(tokens, pa.large_binary())
        self.memo: dict[bytes, bytes] = {}
        self.by_words = self._drops_blanks()
        self.marks: dict[bytes, bytes] = {}
        self.plain = self.by_words and self._takes_plain_words()

    def _drops_blanks(self) -> bool:
        """Whether texts may be encoded word by word: blanks part tokens and leave none."""
        words = ["a", "Été", "don't", "42", "x<y", "'s", "́e", "字", "...", "A"]
        alone = [i for w in words for i in self._whole(w)]
        return all(self._whole(blank.join(words)) == alone for blank in (" ", "\n", "\t", "\r\n", "\x0b \x0c"))

    def _takes_plain_words(self) -> bool:
        """Whether ASCII letters in either case, with or without marks behind them, are for the model
        their lower-case word and the run of marks."""
        marks = _PUNCTUATION.decode()
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if any(not t.rstrip(marks) or (t.isascii() and t.rstrip(marks).isalpha()) for t in added):
            return False
        words = ["".join(chr(97 + (i * j + i) % 26) for j in range(1 + i % 13)) for i in range(60)]
        texts = [f(w) + m for w in words for f in (str.lower, str.upper, str.title) for m in ("", *marks)]
        texts += [words[(i + j) % 60] + m + n * k for i, m in enumerate(marks) for j, n in enumerate(marks) for k in (1, 3)]
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return all(self._pack(f.ids) == self._plain_word(t.encode()) for t, f in zip(texts, found))

    def _plain_word(self, word: bytes) -> bytes | None:
        """The packed ids of a word of ASCII letters, None if it is of another kind."""
        head = word.rstrip(_PUNCTUATION)
        if not head.isalpha():
            return None
        low = head.lower()
        found = self.memo.get(low) or self._pack([t.id for t in self.tokenizer.model.tokenize(low.decode())])
        if len(head) == len(word):
            return found
        tail = word[len(head) :]
        if (marks := self.marks.get(tail)) is None:
            if len(self.marks) >= _MEMO // 8:
                self.marks.clear()
            marks = self.marks[tail] = self._pack(self._whole(tail.decode()))
        return found + marks

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _pack(self, ids: Sequence[int]) -> bytes:
        return array(self.kind.char, ids).tobytes()

    def encode(self, raw: bytes) -> bytes:
        """The ids of a whole text, packed."""
        if not self.by_words:
            return self._pack(self._whole(raw.decode()))
        out, a = [], 0
        while a < len(raw):
            b = a + _STRETCH
            while b < len(raw) and not _BLANK[raw[b]]:
                b += 1
            out.append(self._by_words(raw[a:b]))
            a = b
        return b"".join(out)

    def _by_words(self, raw: bytes) -> bytes:
        words = raw.split()
        new = list(set(words).difference(self.memo))
        if len(self.memo) + len(new) > _MEMO:
            self.memo.clear()
            new = list(set(words))
        if self.plain:
            for word in new:
                if (found := self._plain_word(word)) is not None:
                    self.memo[word] = found
            new = [word for word in new if word not in self.memo]
        for k in range(0, len(new), 4096):
            part = new[k : k + 4096]
            for word, found in zip(part, self.tokenizer.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)):
                self.memo[word] = self._pack(found.ids)
        return b"".join(map(self.memo.__getitem__, words))

    def encode_marked(self, raw: bytes, marks: Sequence[int]) -> tuple[bytes, list[int]]:
        """The ids of ``raw`` and how many of them start before each of the places ``marks`` (ascending)."""
        if self.by_words:
            parts = [self.encode(raw[a:b]) for a, b in zip([0, *marks], [*marks, len(raw)])]
            return b"".join(parts), np.cumsum([len(p) // self.kind.itemsize for p in parts[:-1]]).tolist()
        text = raw.decode()
        found = self.tokenizer.encode(text, add_special_tokens=False)
        places = [len(raw[:m].decode()) for m in marks]
        return self._pack(found.ids), np.searchsorted([s for s, _ in found.offsets], places).tolist()

    def results(self, packed: Sequence[bytes], outputs: Sequence[str]) -> list[pa.Array]:
        """A column for each of ``outputs`` from the ids of some texts."""
        counts = np.array([len(ids) for ids in packed], np.int64) // self.kind.itemsize
        columns = []
        for name in outputs:
            if name == "ids":
                column = pa.array([np.frombuffer(ids, self.kind) for ids in packed], pa.list_(pa.int32()))
            elif name == "n_tokens":
                column = pa.array(counts)
            else:
                if name == "ids_sha256":
                    texts = self._spelled(packed, counts, self.names)
                elif self.tokens is not None:
                    texts = self._spelled(packed, counts, self.tokens)
                else:
                    lists = (np.frombuffer(ids, self.kind).tolist() for ids in packed)
                    texts = (self.tokenizer.decode(ids, skip_special_tokens=False).encode() for ids in lists)
                if name == "decoded":
                    column = pa.array([bytes(t).decode() for t in texts], pa.string())
                else:
                    column = pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())
            columns.append(column)
        return columns

    def _spelled(self, packed: Sequence[bytes], counts: np.ndarray, spellings: pa.Array) -> Iterator[memoryview]:
        """Of each text the ``spellings`` of its ids, joined by blanks; they end in one."""
        group = (np.cumsum(counts) - counts) // _AT_ONCE
        cuts = np.flatnonzero(np.diff(group)) + 1
        for first, last in zip([0, *cuts.tolist()], [*cuts.tolist(), len(packed)]):
            ids = np.frombuffer(b"".join(packed[first:last]), self.kind)
            _, offsets, values = spellings.take(pa.array(ids)).buffers()
            at = np.frombuffer(offsets, np.int64)[np.concatenate([[0], np.cumsum(counts[first:last])])].tolist()
            spelled = memoryview(values) if values is not None else memoryview(b"")
            for a, b in zip(at[:-1], at[1:]):
                yield spelled[a : max(b - 1, a)]


def _text_chunks(texts: pa.Array) -> Iterator[tuple[int, bytes, list[int]]]:
    """(row, bytes, chunk borders) of each text, slice by slice."""
    row = 0
    for part in text_slices(pa.RecordBatch.from_arrays([texts], names=["text"]), "text", _SLICE):
        data, starts = text_bytes(part.column("text"))
        for borders, a, b in zip(chunk_bounds(data, starts), starts[:-1].tolist(), starts[1:].tolist()):
            yield row, data[a:b].tobytes(), [c - a for c in borders]
            row += 1


def _count_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each chunk that can be reused and how often it occurs; with ``digest``, per text instead."""
    for batch in batches:
        seen: dict = {}
        by_text = "digest" in batch.schema.names
        digests = batch.column("digest").to_pylist() if by_text else []
        for row, raw, borders in _text_chunks(batch.column("text").fill_null("")):
            for a, b in zip(borders[:-1], borders[1:]):
                if _marks(raw[a:b]) is not None:
                    key = (digests[row], _key(raw[a:b])) if by_text else _key(raw[a:b])
                    seen[key] = seen.get(key, 0) + 1
        if by_text:
            yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in seen], pa.binary()) for i in (0, 1)], names=["digest", "chunk"])
        else:
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["chunk", "n"])


@dataclass
class _Shared:
    """Which chunks are reused: a file of them that tasks read, or a column of each row's."""

    path: str
    held: bool

    def test(self):
        """A function (chunk keys, the row's column) -> bool array; may be true for a few others too,
        but says the same in every task."""
        if not self.held:
            return lambda keys, own: np.array([k in own for k in keys], bool)
        store, top = fs.FileSystem.from_uri(self.path)
        found = pq.read_table(top, filesystem=store, columns=["chunk"]).column("chunk")
        known = np.sort(np.frombuffer(b"".join(k[:8] for c in found.chunks for k in c.to_pylist()), np.uint64))
        if not len(known):
            return lambda keys, own: np.zeros(len(keys), bool)

        def test(keys: list[bytes], own) -> np.ndarray:
            short = np.frombuffer(b"".join(k[:8] for k in keys), np.uint64)
            return known[np.minimum(np.searchsorted(known, short), len(known) - 1)] == short

        return test


def _shared_of(batch: pa.RecordBatch) -> list:
    if "shared" not in batch.schema.names:
        return [()] * batch.num_rows
    return [frozenset(x or ()) for x in batch.column("shared").to_pylist()]


def _reused(raw: bytes, borders: list[int], test, own) -> list[tuple[int, int, bytes, tuple[int, int, int, int]]]:
    """(start, end, key, marks) of the chunks of a text that are reused."""
    found = []
    for a, b in zip(borders[:-1], borders[1:]):
        if (marks := _marks(raw[a:b])) is not None:
            found.append((a, b, _key(raw[a:b]), marks))
    return [f for f, yes in zip(found, test([f[2] for f in found], own)) if yes] if found else found


def _shared_texts(shared: _Shared):
    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test, sent = shared.test(), set()
        for batch in batches:
            own, new = _shared_of(batch), {}
            for row, raw, borders in _text_chunks(batch.column("text").fill_null("")):
                new |= {key: raw[a:b] for a, b, key, _ in _reused(raw, borders, test, own[row]) if key not in sent}
            if len(sent) + len(new) > _MEMO:
                sent.clear()
            sent |= set(new)
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.binary()) for x in (new, new.values())], names=["chunk", "raw"])

    return texts


def _encode_chunks(tokenizer_json: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or TextEncoder(tokenizer_json)
            rows = []
            for key, raw in zip(batch.column("chunk").to_pylist(), batch.column("raw").to_pylist()):
                p1, p2, q1, q2 = _marks(raw)
                places = sorted({p1, p2, q1, q2})
                ids, counts = encoder.encode_marked(raw, places)
                at = dict(zip(places, counts))
                rows.append((key, ids, at[p1], at[p2], at[q1], at[q2]))
            columns = list(zip(*rows)) if rows else [()] * 6
            kinds = [pa.binary(), pa.binary(), *[pa.int32()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["chunk", "ids", "p1", "p2", "q1", "q2"])

    return encode


_PIECE = pa.struct([("pos", pa.int32()), ("chunk", pa.binary()), ("ids", pa.binary()), ("left", pa.int32()), ("right", pa.int32())])
_PIECES_DDL = "array<struct<pos:int,chunk:binary,ids:binary,left:int,right:int>>"


def _pieces(raw: bytes, reused: list, encoder: TextEncoder) -> list[dict]:
    """Reused chunks by key and, between them, the ids of the windows over their joins; ``left`` and
    ``right`` are the window's first and last ids that the chunks before and after must have too."""
    pieces, start, skip = [], 0, 0
    for a, b, key, (p1, p2, q1, q2) in [*reused, (len(raw), len(raw), None, (0, 0, 0, 0))]:
        # The window: from the last chunk's last stretch (start, of skip bytes) to this one's first.
        window = raw[start : a + p2]
        marks = [skip, len(window) - (p2 - p1)]
        ids, (left, before) = encoder.encode_marked(window, marks)
        pieces.append({"pos": len(pieces), "chunk": None, "ids": ids, "left": left, "right": len(ids) // encoder.kind.itemsize - before})
        if key is not None:
            pieces.append({"pos": len(pieces), "chunk": key, "ids": None, "left": None, "right": None})
            start, skip = a + q1, q2 - q1
    return pieces


def _encode_texts(tokenizer_json: str, shared: _Shared, outputs: Sequence[str]):
    """Of each text its results, or the pieces to put together."""
    names = [*outputs, "pieces", "digest"]
    ddl = ", ".join([*[f"{n} {OUTPUTS[n]}" for n in outputs], f"pieces {_PIECES_DDL}", "digest binary"])

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = test = None
        for batch in batches:
            if encoder is None:
                encoder, test = TextEncoder(tokenizer_json), shared.test()
            own, whole, pieces, digests = _shared_of(batch), [], [], []
            for row, raw, borders in _text_chunks(batch.column("text").fill_null("")):
                reused = _reused(raw, borders, test, own[row])
                whole.append(b"" if reused else encoder.encode(raw))
                pieces.append(_pieces(raw, reused, encoder) if reused else None)
                digests.append(_key(raw) if reused else None)
            columns = [*encoder.results(whole, outputs), pa.array(pieces, pa.list_(_PIECE)), pa.array(digests, pa.binary())]
            keep = [batch.column(c) for c in batch.schema.names if c not in ("text", "shared")]
            yield pa.RecordBatch.from_arrays([*keep, *columns], names=[c for c in batch.schema.names if c not in ("text", "shared")] + names)

    return texts, ddl


def _stitch(tokenizer_json: str, outputs: Sequence[str]):
    """Of the pieces of a text its results, and whether all windows agree with their chunks."""
    kinds = ", ".join(f"{n} {OUTPUTS[n]}" for n in outputs)

    def put_together(pieces: list[dict], width: int) -> bytes | None:
        pieces = sorted(pieces, key=lambda p: p["pos"])
        out = []
        for k, p in enumerate(pieces):
            ids = p["ids"]
            if k % 2 == 0:  # a window: without what it shares with the chunks
                out.append(ids[p["left"] * width : len(ids) - p["right"] * width])
                continue
            before, after = pieces[k - 1], pieces[k + 1]
            p1, p2, q1, q2 = (p[c] * width for c in ("p1", "p2", "q1", "q2"))
            tail = before["ids"][len(before["ids"]) - before["right"] * width :]
            if ids[p1:p2] != tail or ids[q1:q2] != after["ids"][: after["left"] * width]:
                return None
            out.append(ids[p1:q2])
        return b"".join(out)

    def stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or TextEncoder(tokenizer_json)
            found = [put_together(p, encoder.kind.itemsize) for p in batch.column("pieces").to_pylist()]
            columns = encoder.results([f or b"" for f in found], outputs)
            agree = pa.array([f is not None for f in found], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("row"), *columns, agree], names=["row", *outputs, "agree"])

    return stitch, f"row long, {kinds}, agree boolean"


def _with_shared(docs: DataFrame, shared: _Shared) -> DataFrame:
    """``docs`` (text, ...) with the reused chunks of each row, if tasks cannot hold them all."""
    if shared.held:
        return docs
    spark = docs.sparkSession
    digest = F.unhex(F.sha2("text", 256)).alias("digest")
    chunks = docs.select(digest, "text").mapInArrow(_count_chunks, "digest binary, chunk binary").distinct()
    known = spark.read.schema("chunk binary").parquet(shared.path)
    lists = chunks.join(known, "chunk", "left_semi").groupBy("digest").agg(F.collect_list("chunk").alias("shared"))
    lists = materialize(lists, label="bpe-lists").withColumnRenamed("digest", "of")
    return docs.join(lists, F.unhex(F.sha2("text", 256)) == F.col("of"), "left").drop("of")


def encode_documents(
    docs: DataFrame,
    tokenizer_json: str,
    *,
    outputs: Sequence[str] = ("ids",),
    carry: Sequence[str] | None = None,
    max_held: int = 4_000_000,
) -> DataFrame:
    """``docs`` (text, ...) encoded with ``tokenizer_json`` (the contents of a tokenizer file of the
    tokenizers library), special tokens not added.

    Returns the columns ``carry`` (default: all but text) and those of ``OUTPUTS`` that are named;
    ``decoded`` is what the ids decode to, special tokens included.  A carried column of the same name
    gives way.  Tasks hold the keys of reused chunks, 8 bytes each, while there are at most
    ``max_held``; beyond it each row gets its own by a join.  The results are the same.
    """
    spark = docs.sparkSession
    unknown = [o for o in outputs if o not in OUTPUTS]
    if unknown:
        raise ValueError(f"no such output: {', '.join(unknown)}")
    carry = [c for c in (docs.columns if carry is None else carry) if c not in outputs and (carry is not None or c != "text")]
    packed = docs.select(F.struct(F.lit(0).alias("none"), *[F.col(f"`{c}`") for c in carry]).alias("rest"), "text")
    with arrow_batches(spark, 500):
        chunks = packed.select("text").mapInArrow(_count_chunks, "chunk binary, n long")
        shared = _Shared(scratch_path(spark, "bpe-shared"), True)
        save_table(chunks.groupBy("chunk").agg(F.sum("n").alias("n")).filter("n > 1").select("chunk"), shared.path)
        shared.held = spark.read.schema("chunk binary").parquet(shared.path).count() <= max_held
        marked = _with_shared(packed, shared)

        # One text of each reused chunk, encoded once.
        texts = marked.drop("rest").mapInArrow(_shared_texts(shared), "chunk binary, raw binary")
        once = texts.groupBy("chunk").agg(F.first("raw").alias("raw"))
        ids_ddl = "chunk binary, ids binary, p1 int, p2 int, q1 int, q2 int"
        encoded = materialize(once.mapInArrow(_encode_chunks(tokenizer_json), ids_ddl), label="bpe-chunks")

        fn, ddl = _encode_texts(tokenizer_json, shared, outputs)
        schema = T.StructType([marked.schema["rest"], *T.StructType.fromDDL(ddl)])
        rows = marked.mapInArrow(fn, schema).withColumn("row", F.monotonically_increasing_id())
        rows = materialize(rows, label="bpe-rows")

        parts = rows.filter(F.col("pieces").isNotNull()).select("row", F.inline("pieces"))
        windows = parts.filter(F.col("chunk").isNull()).drop("chunk")
        places = parts.filter(F.col("chunk").isNotNull()).select("row", "pos", F.col("chunk").alias("of"))
        filled = places.join(encoded, F.col("of") == F.col("chunk")).drop("of", "chunk")
        piece = F.struct("pos", "ids", "left", "right", "p1", "p2", "q1", "q2")
        lists = windows.unionByName(filled, allowMissingColumns=True).groupBy("row").agg(F.collect_list(piece).alias("pieces"))
        fn, ddl = _stitch(tokenizer_json, outputs)
        stitched = materialize(lists.mapInArrow(fn, ddl), label="bpe-stitched")

        apart = rows.select("row", "digest").join(stitched.filter("NOT agree").select("row"), "row", "left_semi").select("digest").distinct()
        apart = materialize(apart, label="bpe-apart")
        results = stitched.filter("agree").drop("agree")
        if not apart.isEmpty():
            results = results.unionByName(_whole_texts(docs, apart, rows, tokenizer_json, outputs))
    found = results.select(F.col("row").alias("of"), F.struct(*outputs).alias("found"))
    joined = rows.join(found, F.col("row") == F.col("of"), "left")
    return joined.select(*[F.col("rest")[c].alias(c) for c in carry], *[F.coalesce(F.col("found")[o], F.col(o)).alias(o) for o in outputs])


def _whole_texts(docs: DataFrame, apart: DataFrame, rows: DataFrame, tokenizer_json: str, outputs: Sequence[str]) -> DataFrame:
    """Results of the rows whose windows and chunks do not agree, from their whole texts."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or TextEncoder(tokenizer_json)
            columns = encoder.results([encoder.encode(t.encode()) for t in batch.column("text").to_pylist()], outputs)
            yield pa.RecordBatch.from_arrays([batch.column("digest"), *columns], names=["digest", *outputs])

    @F.arrow_udf("binary")
    def key_of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array([_key((t or "").encode()) for t in batch.to_pylist()], pa.binary())

    texts = docs.select("text", key_of("text").alias("digest")).join(apart, "digest", "left_semi").dropDuplicates(["digest"])
    ddl = ", ".join(f"{n} {OUTPUTS[n]}" for n in outputs)
    found = materialize(texts.select("text", "digest").mapInArrow(whole, f"digest binary, {ddl}"), label="bpe-whole")
    return rows.select("row", "digest").join(found, "digest").drop("digest")
