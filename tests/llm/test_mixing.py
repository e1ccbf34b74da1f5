import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from rideflow.llm import mixing


def _targets(sizes, share=Fraction(3, 2), cap=2, weights=(3, 1, 2)):
    """Shares by weight; what is above a cap is shared again until none is."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: Fraction(weights[i % len(weights)]) for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level >= cap * sizes[s]}
        if not full:
            return out | {s: weight[s] * level for s in open_}
        for s in full:
            out[s] = Fraction(cap * sizes[s])
            left -= out[s]
        open_ -= full
    return out


def _check(rows, docs):
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes: dict = {}
    for _, text, source in docs:
        sizes[source] = sizes.get(source, 0) + words(text)
    want = _targets(sizes)
    taken: dict = {}
    for r in rows:
        assert r.target == pytest.approx(float(want[r.source]), abs=1e-9) and r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 2 * r.size
        assert (r.position is None) == (r.taken == 0)
        if r.taken:
            assert 0 <= r.position <= r.last_position <= 1
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, t in taken.items():
        assert abs(t - float(want[s])) <= 0.5
    assert len(rows) == len(docs)


def test_targets_are_met(spark):
    docs = [(i, " ".join("w" * (1 + i % 3) for _ in range(i % 17)), f"s{(i * i) % 7}" if i % 11 else None) for i in range(900)]
    docs += [(1000 + i, "word " * 40, "hot") for i in range(500)] + [(5000, "x " * 30_000, "long"), (5001, None, "nothing")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(4)
    mixed = mixing.mix_sources(frame, bucket_rows=16).collect()
    _check(mixed, docs)
    positions = [r.position for r in mixed if r.position is not None]
    assert positions == sorted(positions)
    again = mixing.mix_sources(frame.repartition(2), bucket_rows=500)
    assert sorted((r.doc_id, r.taken) for r in again.collect()) == sorted((r.doc_id, r.taken) for r in mixed)


def test_small_empty_and_clashing_tables(spark):
    ddl = "doc_id long, text string, source string, size string, target int, rank int"
    frame = spark.createDataFrame([(None, "a b", None, "s", 1, 2), (None, "a b", None, "s", 1, 2), (1, "", "x", None, 1, 2)], ddl)
    got = mixing.mix_sources(frame)
    assert got.columns == ["doc_id", "text", "source", "rank", "size", "source_size", "target", "taken", "position", "last_position"]
    assert sorted(r.taken for r in got.collect()) == [0, 2, 4] or sum(r.taken for r in got.collect()) == 6
    assert mixing.mix_sources(frame.limit(0)).count() == 0
    nothing = mixing.mix_sources(spark.createDataFrame([(1, None, "a"), (2, " ", "b")], "doc_id long, text string, source string"))
    assert [(r.size, r.target, r.taken) for r in nothing.collect()] == [(0, 0.0, 0)] * 2


@pytest.mark.parametrize("schedule", [*mixing.CURRICULUM, ((0.0, 1.0), (0.25, 3.0), (0.5, 0.0), (1.0, 2.0))])
def test_positions_invert_the_demand(spark, schedule):
    def demand(t):
        done = 0.0
        for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
            if t <= t0:
                break
            x = min(t, t1) - t0
            done += w0 * x + (w1 - w0) / (t1 - t0) * x * x / 2
        return done

    total = float(mixing.schedule_weight(schedule))
    assert demand(1.0) == pytest.approx(total)
    rows = spark.range(101).select((F.col("id") / 100).alias("q")).withColumn("t", mixing.invert_demand(F.col("q"), schedule))
    for r in rows.collect():
        assert demand(r.t) == pytest.approx(r.q * total, abs=1e-9)
