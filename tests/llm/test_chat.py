import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rideflow.llm import chat


def _random_chain(seed):
    rnd = np.random.default_rng(seed)
    return chat._chain(rnd.integers(0, 9, chat._N_COUNTS))


@pytest.mark.parametrize("seed", range(4))
def test_viterbi_equals_all_paths(seed):
    chain = _random_chain(seed)
    emission = chain.emissions(["Human: hello?", "a b c", "AI: x", "Context: y:"][: 2 + seed % 3])

    def value(path, before=None):
        at = (chain.start if before is None else chain.steps[before])[path[0]]
        return at + sum(chain.steps[a, b] for a, b in zip(path, path[1:])) + sum(e[s] for e, s in zip(emission, path))

    for before, last in ((None, None), (2, None), (None, 3), (1, 4)):
        paths = [p for p in itertools.product(range(chat.N_STATES), repeat=len(emission)) if last is None or p[-1] == last]
        got = chat.viterbi(chain, emission, before, last)
        assert value(got, before) == pytest.approx(max(value(p, before) for p in paths))


def _conversations(n=200, seed=3):
    rnd = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rnd.randint(1, 6)):
            role = ("user", "assistant")[t % 2]
            long = " ".join("word" for _ in range(rnd.randint(40, 90) if role == "assistant" else rnd.randint(2, 9)))
            rows.append((c, t, role, "\n".join([long] * (rnd.randint(1, 3) if role == "assistant" else 1))))
    return rows


def test_roles_are_recovered(spark):
    frame = spark.createDataFrame(_conversations(), "conv_id long, turn long, role string, text string")
    out = chat.format_chats(chat.rough_transcripts(frame)).collect()
    assert len(out) == frame.count()
    assert sum(r.role == r.recovered for r in out) > 0.95 * len(out)
    whole: dict = {}
    for r in sorted(out, key=lambda r: (r.conv_id, r.turn)):
        whole[r.conv_id] = whole.get(r.conv_id, "") + r.rendered
    for c, text in whole.items():
        assert text.startswith("<|") and text.endswith(chat.CLOSE)
        assert text.count("<|end|>") == sum(text.count(f"<|{x}|>") for x in chat.ROLES)


def test_conversations_across_runs_are_decoded_as_wholes(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"{'Human: ' if t % 6 == 0 else ''}line {t}" + " more" * (t % 5)) for t in range(300)]
    rows += [(c, 0, "user", "hi") for c in range(2, 6)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, raw string")
    chain = _random_chain(9)
    one = chat.sorted_runs(frame).withColumn("part", F.lit(0))
    one = one.withColumn("idx", F.row_number().over(Window.partitionBy("part").orderBy("conv_id", "turn")).cast("long"))
    want = {(r.conv_id, r.turn): (r.recovered, r.rendered) for r in chat.format_chats(frame, chain, runs=one).collect()}
    # The same rows, cut into parts of 40.
    cut = one.withColumn("part", F.floor(F.col("idx") / 40).cast("int"))
    got = {(r.conv_id, r.turn): (r.recovered, r.rendered) for r in chat.format_chats(frame, chain, runs=cut).collect()}
    assert got == want and len(got) == 304


def test_odd_rows(spark):
    rows = [(None, None, None, None), (None, 1, "user", ""), (1, 0, "user", "Human: a"), (1, 0, "user", "Human: a"), (1, None, "other", "AI:"), (2, 0, "user", "x\n" * 5000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, raw string").selectExpr("*", "1 AS part", "'x' AS rendered")
    out = chat.format_chats(frame).collect()
    assert len(out) == len(rows) and {r.n_lines for r in out} == {1, 5001}
    assert chat.format_chats(frame.limit(0)).count() == 0


def test_markers():
    assert chat.marker_of("Human: hi") == (2, "hi") and chat.marker_of("**AI**: yes") == (3, "yes")
    assert chat.marker_of("[System] be kind") == (1, "be kind") and chat.marker_of("<|user|> x") == (2, "x")
    assert chat.marker_of("Users: none") == (0, "Users: none") and chat.marker_of("") == (0, "")
