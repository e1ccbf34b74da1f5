import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rideflow.llm import spelling as sp
from tests.llm import brute


def _docs(seed):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abé") for _ in range(rnd.randint(4, 9))) for _ in range(150)]
    words += ["Étude", "étude", "HELLO", "hello", "hallo", "hellos", "x" * 200, "x" * 201, "naïve", "ÿabcd", "×abcd"]
    docs = [" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 80))) for _ in range(80)]
    docs += ["aaaaa-aaaaab3aaaaab字aaaaab"] * 3 + [None, "", "hello" * 3, "Ā" + "hello" + "Ā"]
    return [(i if i % 9 else None, t) for i, t in enumerate(docs)]


@pytest.mark.parametrize("max_list, piece", [(5000, 4 << 20), (3, 64)])
def test_equal_to_comparing_all_words(spark, monkeypatch, max_list, piece):
    monkeypatch.setattr(sp, "_PIECE", piece)
    docs = _docs(max_list)
    frame = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, word string").repartition(3)
    found = sp.spelling_variants(frame, max_list=max_list)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute.spelling(docs)
    assert len(want) > 50
    rows = found.collect()
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows} == want and len(rows) == len(want)


def test_empty_table(spark):
    assert sp.spelling_variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abc", min_size=5, max_size=6), unique=True, min_size=2, max_size=40), st.integers(0, 4))
def test_sorted_lists_give_all_pairs_one_edit_apart(words, cap):
    words = sorted(w.encode() for w in words)
    got = list(zip(*[x.tolist() for x in sp.near_pairs(words, 5, cap or 99)]))

    def edits(x, y):
        row = list(range(len(y) + 1))
        for i, a in enumerate(x, 1):
            last, row[0] = row[0], i
            for j, b in enumerate(y, 1):
                last, row[j] = row[j], min(last + (a != b), row[j] + 1, row[j - 1] + 1)
        return row[-1]

    want = [
        (i, k)
        for i, x in enumerate(words)
        for k, y in enumerate(words)
        if len(x) == 5 and len(y) in (5, 6) and edits(x, y) == 1 and (not cap or x[:cap] != y[:cap])
    ]
    assert sorted(got) == want


@given(st.lists(st.binary(max_size=150), min_size=1, max_size=8))
@settings(max_examples=50, deadline=None)
def test_checksums(runs):
    data = np.frombuffer(b"".join(runs), np.uint8)
    ends = np.cumsum([len(r) for r in runs])
    starts = ends - [len(r) for r in runs]
    before = np.array([zlib.crc32(f"{i}:".encode()) for i in range(len(runs))], np.uint32)
    assert sp._checksums(data, starts, ends, before).tolist() == [zlib.crc32(f"{i}:".encode() + r) for i, r in enumerate(runs)]


def test_chains_lead_to_the_last_form(spark):
    links = [(f"w{i}", f"w{i + 1}") for i in range(37)] + [(f"h{i}", "w3") for i in range(50)]
    found = sp.follow(spark.createDataFrame(links, "word string, form string"))
    assert {r.root for r in found.collect()} == {"w37"} and found.count() == 87
