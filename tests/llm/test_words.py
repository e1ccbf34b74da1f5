import random
import re

import numpy as np
import pyarrow as pa
import pytest

from rideflow.llm.words import PowerTable, shingle_hashes, split_words, text_slices


@pytest.mark.parametrize("tokens", [True, False])
def test_words_are_those_of_the_pattern(tokens):
    rnd = random.Random(4)
    texts = ["".join(rnd.choice("ab Zé9-\n\t.") for _ in range(rnd.randint(0, 30))) for _ in range(200)] + ["", " ", "é"]
    pattern = r"[^\x20\x09-\x0D]+" if tokens else r"[0-9A-Za-z\x80-\U0010ffff]+"
    want = [(i, w) for i, t in enumerate(texts) for w in re.findall(pattern, t)]
    for array in (pa.array(texts), pa.array(["x", *texts, "y"], pa.large_string()).slice(1, len(texts))):
        words = split_words(array, PowerTable(), tokens=tokens)
        got = [(int(r), words.data[s:e].tobytes().decode()) for r, s, e in zip(words.row, words.starts, words.ends)]
        assert got == want
        assert np.diff(words.first_word).tolist() == [len(re.findall(pattern, t)) for t in texts]
        by_hash: dict = {}
        for (_, w), h in zip(want, words.hashes.tolist()):
            assert by_hash.setdefault(h, w) == w
        assert len(by_hash) == len({w for _, w in want})


def test_shingles_of_short_and_long_texts():
    words = split_words(pa.array(["a b c d e f", "", "a b", "b c d e f", "x a b c d e"]), PowerTable())
    row, hashes = shingle_hashes(words, 5)
    assert row.tolist() == [0, 0, 2, 3, 4, 4]
    assert hashes[1] == hashes[3] and hashes[0] == hashes[5]
    assert len(set(hashes.tolist())) == 4


def test_slices_hold_whole_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * n for n in (5, 5, 100, 1, 0, 3)])], names=["text"])
    parts = list(text_slices(batch, "text", 10))
    assert [r for p in parts for r in p.column(0).to_pylist()] == batch.column(0).to_pylist()
    assert max(p.num_rows for p in parts) < 6
    assert list(text_slices(batch.slice(0, 0), "text", 10)) == []
