import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rideflow.llm import order_minhash as om
from rideflow.llm.components import components
from rideflow.llm.words import PowerTable, split_words
from tests.llm import brute


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=25), st.lists(st.integers(0, 5), max_size=25), st.integers(0, 25))
def test_alignment_equals_longest_common_subsequence(x, y, need):
    got = om.aligned_at_least(np.array(x, np.int64), np.array(y, np.int64), need)
    assert got == (brute.lcs(x, y) >= need)


def test_sketch_depends_on_order():
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words), " ".join(words), " ".join(words[30:] + words[:30]), "one", ""]
    keys = om.sketch_keys(split_words(pa.array(texts), PowerTable(), tokens=True), 64, 3)
    assert (keys[0] == keys[1]).all()
    agree = (keys[0] == keys[2]).mean()  # nearly all shingles are shared, a third of the orders are
    assert 0.02 < agree < 0.8


def _texts(seed=3):
    rnd = random.Random(seed)
    def word():
        return "".join(rnd.choice("abcdefgh") for _ in range(4))
    docs = []
    for _ in range(25):  # groups of near copies, some below the threshold
        base = [word() for _ in range(rnd.randint(8, 300))]
        docs.append(base)
        for _ in range(rnd.randint(0, 6)):
            copy = list(base)
            for _ in range(rnd.randint(0, max(1, len(base) // 30))):
                at = rnd.randrange(len(copy))
                copy[at : at + rnd.randint(0, 1)] = [word()] * rnd.randint(0, 2)
            docs.append(copy)
    passage = [word() for _ in range(40)]
    docs += [[word() for _ in range(15)] + passage + [word() for _ in range(15)] for _ in range(12)]  # share a passage only
    hub = [word() for _ in range(120)]  # copies that are close to the source, but not to each other
    docs += [hub] + [hub[:i] + [word() for _ in range(9)] + hub[i:] for i in range(0, 120, 8)]
    docs += [["a", "b"], ["a", "b"], ["a", "b", "c"], ["x"], ["x"]]
    rnd.shuffle(docs)
    return [(i, " ".join(d)) for i, d in enumerate(docs)]


def test_classes_equal_brute_force(spark):
    docs = _texts()
    rows = [(*d, "src", i) for i, d in enumerate(docs)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, class_id int").repartition(5)
    got = {r.doc_id: r.class_id for r in om.near_duplicates(frame.select("doc_id", "text")).collect()}
    assert got == brute.near_duplicate_classes(docs)


def _changed_copies(seed):
    """Copies of two sources around the threshold: changed in own or common places, cut, moved, extended."""
    rnd = random.Random(seed)
    def word():
        return "".join(rnd.choice("abcdefgh") for _ in range(5))
    sources = [[word() for _ in range(rnd.randint(60, 90))]]
    sources.append(sources[0][:45] + [word() for _ in range(30)])  # shares a passage with the first
    variants = [word() for _ in range(4)]
    docs = list(sources)
    for i in range(90):
        copy = list(sources[i % 2])
        for _ in range(rnd.randint(0, 3)):
            kind = rnd.randrange(5)
            at = rnd.randrange(len(copy) - 8)
            if kind == 0:
                copy[at] = word()
            elif kind == 1:  # few places and few values, so that changes are shared
                copy[rnd.choice([7, 8, 30])] = rnd.choice(variants)
            elif kind == 2:
                del copy[at : at + rnd.randint(1, 6)]
            elif kind == 3:
                copy = copy[at:] + copy[:at]
            else:
                copy += variants[: rnd.randint(1, 4)] + [word()]
        docs.append(copy)
    return [(i, " ".join(d)) for i, d in enumerate(docs)]


@pytest.mark.parametrize("seed", [1, 2])
def test_changed_copies_equal_brute_force(spark, seed):
    docs = _changed_copies(seed)
    got = om.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), n_hashes=48, n_least=1)
    assert {r.doc_id: r.class_id for r in got.collect()} == brute.near_duplicate_classes(docs)


def test_changes_of_one_class_are_not_joined_and_like_shingles_are_one(spark, monkeypatch):
    rnd = random.Random(4)
    def words(n):
        return ["".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(n)]
    source, other, passage, tails = words(120), words(120), words(40), [words(2) for _ in range(4)]
    docs = [source] + [source[:k] + words(1) + source[k + 1 :] + tails[i % 4] for i, k in enumerate(range(10, 110, 2))]
    near = len(docs)
    docs += [other] + [words(50 + i) + passage + words(50 + i) for i in range(20)]
    docs = [(i, " ".join(d)) for i, d in enumerate(docs)]
    joined = []

    def counted(df, *args, real=om.materialize, **more):
        out = real(df, *args, **more)
        if more.get("label") == "near-common" and "b" in out.columns:
            joined.append(out.count())
        return out

    monkeypatch.setattr(om, "materialize", counted)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for part, most in ((frame.filter(F.col("doc_id") < near), 0), (frame, 100)):
        joined.clear()
        got = {r.doc_id: r.class_id for r in om.near_duplicates(part, n_hashes=48, n_least=1).collect()}
        assert got == brute.near_duplicate_classes(docs[: len(got)])
        assert len(joined) == 1 and joined[0] <= most


def test_nulls_empties_and_repeated_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, ""), (None, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f"), (9, "a b c d e f"), (9, "z y x w v u"), (11, "z y x w v u"), (7, "q " * 20_000)]
    got = om.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(1, 1), (2, 2), (3, 3), (4, 4), (None, None), (5, 5), (5, 5), (9, 5), (9, 5), (11, 5), (7, 7)], key=str
    )
    assert om.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components(spark):
    rnd = random.Random(2)
    links = [(i, i + 1) for i in range(40)] + [(1000, i) for i in range(2000, 2300)] + [(rnd.randrange(100, 200), rnd.randrange(100, 200)) for _ in range(80)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    parent: dict = {}
    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    alone = {a for a, b in links if a == b} - {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: root(x) for x in parent if x not in alone}
    assert components(spark.createDataFrame([], "a long, b long").withColumn("c", F.lit(1))).count() == 0
