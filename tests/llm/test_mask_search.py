import random

import numpy as np
import pytest

from rideflow.llm import mask_search as ms
from tests.llm import brute


def _tables(seed):
    rnd = random.Random(seed)
    words = [f"w{int(rnd.paretovariate(0.7)) % 300}" for _ in range(400)] + ["Été", "ÉTÉ", "字", "x9", "AbC", "abc"]

    def text(n):
        return "".join(rnd.choice(words) + rnd.choice([" ", ", ", "\n", "--"]) for _ in range(n))

    docs = [text(rnd.choice([0, 1, 3, 40, 300])) for _ in range(300)]
    docs += [docs[7]] * 30 + ["abc"] * 40 + [None, "", "?!", " "]
    docs = [(i if i % 50 else None, t) for i, t in enumerate(docs)] + [(3, "abc abc"), (3, "abc w1")]
    items = [(i, text(rnd.choice([1, 3, 20, 150]))) for i in range(20)] + [(20, None), (21, "..."), (22, "nowhere"), (5, "Abc"), (23, " ".join(words))]
    return docs, items


def _found(frame):
    got: dict = {}
    for r in sorted(frame.collect(), key=lambda r: r["rank"]):
        got.setdefault(r.item_id, []).append((r.doc_id, r.score))
        assert r["rank"] == len(got[r.item_id])
    return got


@pytest.mark.parametrize("block_terms, block, piece", [(500_000, 8192, 4 << 20), (40, 16, 100)])
def test_equal_to_scoring_every_document(spark, monkeypatch, block_terms, block, piece):
    monkeypatch.setattr(ms, "_BLOCK", block)
    monkeypatch.setattr(ms, "_PIECE", piece)
    monkeypatch.setattr(ms, "_FIRST", 4)
    docs, items = _tables(block)
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, score int").repartition(3)
    b = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int")
    found = ms.rank_documents(d, b, block_terms=block_terms)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert _found(found) == brute.ranked(docs, items)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ms.rank_documents(docs.limit(0), items).collect() == []
    assert ms.rank_documents(docs, items.limit(0)).collect() == []
    assert ms.rank_documents(docs.withColumn("text", docs.text.substr(1, 0)), items).collect() == []
    assert _found(ms.rank_documents(docs, items)) == {1: [(1, 287 * (10**9 // (1000 + 8 * 100)))]}


@pytest.mark.parametrize("n_terms", [1, 8, 63, 64, 65, 130])
def test_masks_group_documents_that_hold_the_same_terms(n_terms):
    rng = np.random.default_rng(n_terms)
    present = rng.random((n_terms, 5))[:, rng.integers(0, 5, 200)] > 0.5
    masks, mask = ms.group_masks(present)
    assert (masks[mask] == present.T).all()
    assert len(np.unique(masks, axis=0)) == len(masks)


def test_few_groups_are_evaluated():
    """Groups whose maximum is below the tenth best score are not looked at."""
    seen = []

    class Watched(ms._Best):
        def add(self, scores, ids):
            seen.append(len(ids))
            super().add(scores, ids)

    rng = np.random.default_rng(0)
    tf = (rng.random((12, 5000)) < np.linspace(0.02, 0.9, 12)[:, None]).astype(np.int32)
    w = np.linspace(6000, 100, 12).astype(np.int64)
    best = Watched(10)
    ms._search_block(best, tf, w, np.full(5000, 100), np.arange(5000))
    scores = (w[:, None] * ms._impact(tf.astype(np.int64), np.full(5000, 100))).sum(axis=0)
    order = np.lexsort((np.arange(5000), -scores))[:10]
    assert best.ids.tolist() == order.tolist() and best.scores.tolist() == scores[order].tolist()
    assert sum(seen) < 1000
