import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from rideflow.llm import suffix_dedup as sd
from tests.llm import brute


@pytest.mark.parametrize("letters", [b"ab", b"abcdef", b"\0a", b"a"])
def test_suffix_arrays(letters):
    rnd = random.Random(5)
    for n in (1, 2, 7, 8, 9, 63, 300):
        data = bytes(rnd.choice(letters) for _ in range(n))
        words = sd.words_at(np.frombuffer(data, np.uint8))
        order = sd.suffix_order(words)
        assert order.tolist() == sorted(range(n), key=lambda i: data[i:])
        prefixes = sd.common_prefixes(words, order, np.array([0]), np.array([n]))
        for a, b in zip(order, order[1:]):
            same = next((k for k, (x, y) in enumerate(zip(data[a:], data[b:])) if x != y), min(n - a, n - b))
            if max(a, b) + sd.SPAN <= n:  # zeros behind the end count as bytes
                assert prefixes[b] == min(same, sd.SPAN)


def test_equal_strings_have_one_anchor_at_one_place():
    rnd = random.Random(8)
    pieces = [bytes(rnd.choice(b"ab") for _ in range(40)) for _ in range(6)]
    texts = [b"".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 6))) + b"a" * rnd.randint(0, 90) for _ in range(30)]
    at = np.r_[0, np.cumsum([len(t) for t in texts])]
    anchor, row, first, count = sd.anchors(np.frombuffer(b"".join(texts), np.uint8), at)
    of: dict = {}
    starts = set()
    for x, r, f, c in zip(anchor.tolist(), row.tolist(), first.tolist(), count.tolist()):
        for s in range(f, f + c):
            starts.add(s)
            assert of.setdefault(texts[r][s - at[r] : s - at[r] + sd.SPAN], x) == x
    assert starts == {int(a) + i for a, t in zip(at, texts) for i in range(len(t) - sd.SPAN + 1)}


def _docs(seed=1):
    rnd = random.Random(seed)
    def text(n):
        return "".join(rnd.choice("abcdefgé \n") for _ in range(n))
    passages = [text(rnd.choice([30, 49, 50, 51, 120, 700])) for _ in range(12)]
    docs = []
    for _ in range(150):
        docs.append("".join(rnd.choice([text(rnd.randint(0, 60)), rnd.choice(passages)]) for _ in range(rnd.randint(0, 6))))
    docs += [docs[3]] * 5 + ["x" * 400] * 3 + ["y" * 49] * 3 + ["z" * 50] * 3 + [None, None, ""]
    rnd.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("hot", [4096, 3])
def test_removal_equals_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(sd, "_LEAST_HOT", hot)
    docs = _docs(hot)
    frame = spark.createDataFrame([(i, t, "s", 1) for i, t in docs], "doc_id long, text string, source string, row int").repartition(4)
    got = sd.remove_repeats(frame)
    assert got.columns == ["doc_id", "source", "row", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"]
    rows = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()}
    want = brute.removed_repeats(docs)
    assert rows == want and sum(v[1] for v in want.values()) > 5000


def test_a_partition_is_compared_in_bounded_memory():
    rnd = random.Random(6)
    n = 12_000  # anchors, each of three pieces: 2.6 MB
    rows = []
    for i in range(n):
        piece = rnd.randbytes(72)
        rows += [(i * 64, False, doc, 10 * i + doc, 0, 23, p) for doc, p in ((1, piece), (2, piece[:71] + bytes([piece[71] ^ 1])), (3, rnd.randbytes(72)))]
    kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    names = ["shard", "hot", "doc", "row", "first", "count", "piece"]
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
    parts = [batch.slice(k, 1000) for k in range(0, len(rows), 1000)]
    tracemalloc.start()
    got = [tuple(r.values()) for out in sd._compare_shards(iter(parts)) for r in out.to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sorted(got) == sorted((10 * i + 2, 0, 22, 2, None) for i in range(n))
    assert peak < 100e6


def test_whole_characters_leave_text(spark):
    shared = "é" * 60
    rows = [(1, shared), (2, "x" + shared), (3, "a" + shared[:30] + "b")]
    got = sd.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), whole_characters=True)
    kept = {r.doc_id: bytes(r.kept).decode() for r in got.collect()}
    assert kept == {1: shared, 2: "x", 3: "ab"}
    odd = sd.clean("aéb".encode(), [{"first": 2, "count": -47}], True)  # bytes 2 to 4 begin inside the é
    assert odd == (1, 1, "aé".encode())


def test_nulls_ties_and_empty_tables(spark):
    text = "0123456789" * 6
    rows = [(None, text), (4, text), (4, text), (4, text + "!"), (9, text), (None, text), (2, None), (2, "")]
    got = sd.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), with_text=False, carry=["doc_id"])
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed) for r in got.collect()), key=str) == sorted(
        [(None, 60, 60), (None, 60, 60), (4, 60, 0), (4, 60, 0), (4, 61, 0), (9, 60, 60), (2, 0, 0), (2, 0, 0)], key=str
    )
    assert sd.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
