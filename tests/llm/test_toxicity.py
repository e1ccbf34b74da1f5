import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rideflow.llm import toxicity as tox
from rideflow.llm.words import PowerTable, split_words
from tests.llm import brute

INSULTS = ["dolt", "oaf", "cretin", "twit"]


def _texts(n, seed):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("aeioulmnrst") for _ in range(rnd.randint(2, 4))) for _ in range(250)]
    rows = []
    for i in range(n):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randint(20, 120))]
        bad = i % 6 == 0
        for _ in range(4 if bad else 0):
            words.insert(rnd.randrange(len(words)), rnd.choice(INSULTS))
        rows.append((i, " ".join(words), int(bad)))
    return rows


@pytest.fixture(scope="module")
def models(spark):
    rows = spark.createDataFrame(_texts(1200, 1), "doc_id long, text string, toxic int").repartition(4)
    return tox.fit(rows.select("doc_id", "text"), rows.select("doc_id", "toxic"))


def test_held_out_accuracy(spark, models):
    rows = [(10_000 + i, t, y) for i, t, y in _texts(1500, 1)[1200:]]  # texts after those learnt from
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int").selectExpr("*", "'old' AS score")
    got = {r.doc_id: r.score for r in tox.score(docs, models).collect()}
    label = [y for _, _, y in rows]
    assert brute.auc([got[i] for i, _, _ in rows], label) > 0.97
    assert sum((got[i] >= 0.7) != y for i, _, y in rows) <= 10


def test_odd_texts_have_scores(spark, models):
    rows = [(1, None), (2, ""), (3, "?! \n"), (None, "dolt"), (5, "word " * 40_000), (6, "unheard of ßeyond")]
    got = tox.score(spark.createDataFrame(rows, "doc_id long, text string"), models).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in got if r.doc_id in (1, 2, 3)} == {models.prior}
    assert tox.score(spark.createDataFrame([], "doc_id long, text string"), models).count() == 0


def test_no_marks_and_one_class(spark):
    docs = spark.createDataFrame([(i, f"text number {i}") for i in range(30)], "doc_id long, text string")
    none = tox.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.score for r in tox.score(docs, none).collect()} == {0.0}
    one = tox.fit(docs, docs.selectExpr("doc_id", "1 AS toxic"))
    assert all(0 <= r.score <= 1 for r in tox.score(docs, one).collect())


def test_probabilities_of_a_context_add_up(models):
    scorer = tox.Scorer(models)
    # Over all kept words, with the mass of the shared rest left out: never above one, and most of it.
    for c in ("toxic", "ordinary"):
        low = scorer.low[c][:-1].sum()
        assert 0.5 < low <= 1 + 1e-9
    words = split_words(pa.array(["dolt oaf"]), PowerTable())
    assert np.all(scorer.ratios(words) > 1.0)


def test_rare_expressions_weigh_the_same_in_both_classes(spark):
    rare = {6: " zyzzyva quagga", 12: " zyzzyva quagga", 18: " zyzzyva", 24: " zyzzyva", 7: " quokka quokka"}
    rows = [(i, t + rare.get(i, ""), y) for i, t, y in _texts(300, 3)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(3)
    got = tox.Scorer(tox.count_models(labelled))
    often, toxic, ordinary, unseen = got.ratios(split_words(pa.array(["zyzzyva", "quagga", "quokka", "unseen"]), PowerTable()))
    # Four occurrences, all toxic: the class's own counts speak.  Two: as if never seen.
    assert often > 1.0 and abs(toxic - unseen) < 1e-9 and abs(ordinary - unseen) < 1e-9


@pytest.mark.parametrize("head", [0, 1_000_000])
def test_ratios_equal_brute_force(spark, head):
    rows = _texts(150, 6)
    labelled = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(3)
    models = tox.count_models(labelled, head=head)
    texts = [t for _, t, _ in rows[:20]] + ["dolt oaf unheard of dolt", "ee", "Twit, cretin!"]
    want = [sum(brute.kneser_ney_ratios([(t, y) for _, t, y in rows], t)) for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.total for r in tox._with_parts(docs, models, ["doc_id"]).select("doc_id", "_part.total").collect()}
    assert np.allclose([got[i] for i in range(len(texts))], want, atol=1e-6)


def test_marks_without_words(spark):
    docs = spark.createDataFrame([(i, [None, "", "?!", "one"][i % 4]) for i in range(60)], "doc_id long, text string")
    for marks in ("CAST(doc_id % 4 = 0 AS INT)", "CAST(doc_id % 8 = 3 AS INT)"):
        models = tox.fit(docs, docs.selectExpr("doc_id", f"{marks} AS toxic"))
        assert all(0 <= r.score <= 1 for r in tox.score(docs, models).collect())


@pytest.mark.skipif(not Path("/root/testdata/sf0.1/labels.parquet").exists(), reason="driver tables not present")
def test_accuracy_on_held_out_labels(spark):
    from rideflow.llm.queries import QUERIES

    folder = "/root/testdata/sf0.1"
    marks = spark.read.parquet(f"{folder}/labels.parquet").filter("toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    found = QUERIES["op6_toxicity"](spark, folder).filter("held_out").join(marks, "doc_id").groupBy("toxic").agg(F.avg("predicted").alias("share")).collect()
    share = {r.toxic: r.share for r in found}
    assert share[1] >= 0.75 and share[0] <= 0.02


def test_what_tasks_hold_changes_no_score(spark):
    rows = [(i, t, y) for i, t, y in _texts(600, 4)] + [(None, None, None), (7, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(3)
    found = []
    for head in (0, 40, 1_000_000):
        models = tox.fit(docs.filter("toxic IS NOT NULL").select("doc_id", "text"), docs.filter("toxic IS NOT NULL").select("doc_id", "toxic"), head=head)
        assert models.in_head == (head == 1_000_000)
        scored = tox.score(docs.select("doc_id", "text"), models).collect()
        assert len(scored) == len(rows)
        found.append(sorted((r.doc_id or -1, r.text or "", r.score) for r in scored))
    for other in found[:2]:
        assert [x[:2] for x in other] == [x[:2] for x in found[2]]
        assert np.allclose([x[2] for x in other], [x[2] for x in found[2]], atol=1e-6)


def test_marks_miss_no_key_and_leave_every_row(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i in [*range(500), 3, 3, None]], "doc_id long, text string")
    for marks in ([], [3], [*range(0, 500, 7)]):
        got = tox.with_mark(docs, spark.createDataFrame([(i,) for i in marks], "doc_id long")).collect()
        assert sorted((r.text for r in got)) == sorted(r.text for r in docs.collect())
        assert set(marks) <= {r.doc_id for r in got if r.mark} and sum(r.mark for r in got) < len(marks) * 2 + 60
