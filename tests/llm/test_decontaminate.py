import random

import numpy as np
import pyarrow as pa
import pytest

from rideflow.llm import decontaminate as dc
from rideflow.llm.words import PowerTable, split_words
from tests.llm import brute


@pytest.mark.parametrize("radius", [3, 7])
def test_search_finds_all_within_the_radius(radius):
    rnd = np.random.default_rng(radius)
    fps = rnd.integers(0, 2**63, 50, dtype=np.uint64)
    asked = np.concatenate([fps, fps, rnd.integers(0, 2**63, 2000, dtype=np.uint64)])
    for i in range(50, 100):  # some bits away
        for b in rnd.choice(64, rnd.integers(0, 12), replace=False):
            asked[i] ^= np.uint64(1) << np.uint64(b)
    index = dc._LengthIndex(fps, np.arange(50), np.zeros(50, int), radius)
    w, f = index.within(asked, radius)
    near = np.argwhere(np.bitwise_count(asked[:, None] ^ fps[None, :]) <= radius)
    assert set(zip(w.tolist(), f.tolist())) == set(map(tuple, near.tolist()))


def test_a_copy_always_holds_a_window_on_the_grid():
    for n in [*range(5, 120), 500, 3000]:
        length = dc.window_length(n)
        assert 5 <= length <= n and length + dc.stride_of(length) - 1 <= n
        assert n < 12 or length > 0.65 * n


def _corpus(seed=2):
    rnd = random.Random(seed)
    def words(n):
        return ["".join(rnd.choice("abcdefghijk") for _ in range(rnd.randint(2, 6))) for _ in range(n)]
    items = [words(rnd.choice([3, 5, 9, 20, 45, 70, 200])) for _ in range(25)]
    docs = []
    for i in range(160):
        body = words(rnd.randint(0, 150))
        if i % 4 == 0:
            item = list(rnd.choice(items))
            if i % 8 == 0 and len(item) > 40:  # a light change, one word in fifty
                item[rnd.randrange(len(item))] = "changed"
            at = rnd.randint(0, len(body))
            body[at:at] = item
        text = " ".join(body)
        docs.append((i, text.title().replace(" ", ", ") if i % 3 == 0 else text))
    return docs, [(i, " ".join(w)) for i, w in enumerate(items)]


def test_leaks_equal_brute_force(spark):
    docs, items = _corpus()
    want = brute.leaks(docs, items)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block in (1 << 20, 400):
        marked = dc.mark_leaks(frame, bench, block_bytes=block)
        got = {(r.doc_id, x.item_id) for r in marked.collect() for x in r.leaks}
        assert got >= want and len(want) > 20
        assert all(brute.leaks([docs[d]], [items[i]], 0.75) for d, i in got - want)  # ends moved by a word


def test_odd_tables(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta"
    bench = spark.createDataFrame([(1, item), (1, item), (None, item), (2, None), (3, ""), (4, "two words")], "item_id long, text string")
    rows = [(1, "x " * 50_000 + item, 5), (1, "x " * 50_000 + item, 5), (None, item.upper(), 6), (3, None, 7), (4, "", 8), (5, "two words", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, leaks int")
    marked = {(r.doc_id, r.text): sorted((x.item_id or -1) for x in r.leaks) for r in dc.mark_leaks(docs, bench).collect()}
    assert [v for (d, t), v in marked.items() if t and "alpha" in t.lower()] == [[-1, 1, 1]] * 2
    kept = dc.remove_contaminated(docs.drop("leaks"), bench)
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5]
    assert dc.mark_leaks(docs.limit(0), bench).count() == 0
    assert dc.mark_leaks(docs, bench.limit(0)).filter("size(leaks) > 0").isEmpty()


def test_fingerprints_are_majorities():
    words = split_words(pa.array(["a b c d e f g h"]), PowerTable())
    got = dc.fingerprints(dc.word_bits(words.hashes, 5), 5)
    assert (got == dc.fingerprints(dc.word_bits(words.hashes, 1000), 5)).all() and len(got) == 4
    assert (dc.fingerprints(dc.word_bits(words.hashes, 5), 5, 2) == got[::2]).all()
    bits = np.unpackbits(dc.mix64(words.hashes).view(np.uint8).reshape(-1, 8), axis=1)
    for s in range(4):
        want = np.packbits(bits[s : s + 5].sum(0) > 2.5).view(np.uint64)[0]
        assert got[s] == want


def _best_extent(item, have):
    """The largest weighted Jaccard similarity of the item and any run of words, by brute force."""
    own, n = brute.shingles(item), len(item)
    runs = ((i, j) for i in range(len(have)) for j in range(i + 5, min(i + 2 * n, len(have)) + 1))
    return max((brute.weighted_jaccard(own, brute.shingles(have[i:j])) for i, j in runs), default=0.0)


def _found(item, have):
    index = dc.ItemIndex([(1, " ".join(item))], 7, 0.8)
    words = split_words(pa.array([" ".join(have)], pa.large_string()), PowerTable())
    return index.leaks(words)[0]


def _changed(rnd, item, kind):
    n, copy = len(item), list(item)
    if kind == "inserted":
        at = rnd.randint(3, n - 3)
        copy[at:at] = [f"new{k}" for k in range(4)]
    elif kind == "deleted":
        at = rnd.randint(3, n - 7)
        del copy[at : at + 4]
    elif kind == "first cut":
        copy = copy[int(n * 0.15) :]
    elif kind == "last cut":
        copy = copy[: n - int(n * 0.15)]
    return copy


@pytest.mark.parametrize("kind", ["same", "inserted", "deleted", "first cut", "last cut"])
def test_best_place_of_any_extent(kind):
    rnd = random.Random(kind)
    for trial in range(6):
        item = [f"w{rnd.randrange(200)}" for _ in range(60)]
        have = [f"x{k}" for k in range(rnd.randint(0, 30))] + _changed(rnd, item, kind) + [f"y{k}" for k in range(rnd.randint(0, 30))]
        want = _best_extent(item, have)
        index = dc.ItemIndex([(1, " ".join(item))], 7, 0.8)
        shingles = dc.shingles_at(split_words(pa.array([" ".join(have)], pa.large_string()), PowerTable()).hashes)
        got, start, n = index._verify(shingles, 0, 0, len(shingles))
        assert want >= 0.8 and got == pytest.approx(want)
        assert brute.weighted_jaccard(brute.shingles(item), brute.shingles(have[start : start + n])) == pytest.approx(want)
        if kind in ("same", "inserted"):
            assert _found(item, have)[0]["similarity"] == pytest.approx(want)


def test_changed_copies_of_long_items_are_found():
    rnd = random.Random(9)
    for n in (12, 36, 41, 80, 100, 200, 400, 900):
        item = [f"w{k}" for k in range(n)]
        copies = [_changed(rnd, item, kind) for kind in ("inserted", "deleted", "first cut", "last cut") if n > 30]
        for run in (1, 2, n // 10, n // 12):  # one replaced run
            at = rnd.randint(0, n - run)
            copies.append(item[:at] + [f"r{k}" for k in range(run)] + item[at + run :])
        for every in (25, 37, 45, 50, 70):  # spread changes, replaced and deleted
            copies.append([w if k % every != every // 2 else "other" for k, w in enumerate(item)])
            copies.append([w for k, w in enumerate(item) if k % every != every // 2])
        for cut in (n // 3, n // 2):
            copies.append(item[cut:] + item[:cut])
        for copy in copies:
            have = [f"x{k}" for k in range(rnd.randint(0, 30))] + copy + [f"y{k}" for k in range(rnd.randint(0, 30))]
            if brute.weighted_jaccard(brute.shingles(item), brute.shingles(copy)) >= 0.8:
                assert _found(item, have), (n, copy)
