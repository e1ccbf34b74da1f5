"""The pipeline over small tables: each stage's decisions, and tables of every odd kind."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tests.llm import brute

INSULTS = ["dolt", "oaf", "cretin", "twit"]


def _corpus(rnd):
    vocabulary = ["".join(rnd.choice("aeioulmnrst") for _ in range(rnd.randint(2, 6))) for _ in range(2000)]

    def text(n):
        return [rnd.choice(vocabulary) for _ in range(n)]

    items = [(i, " ".join(text(30))) for i in range(8)]
    passage = " ".join(text(40))
    docs, kind = [], {}
    for i in range(600):
        body, k = text(rnd.randint(40, 160)), "clean"
        if i % 10 == 1:
            k = "toxic"
            for _ in range(5):
                body.insert(rnd.randrange(len(body)), rnd.choice(INSULTS))
        elif i % 20 == 2 and docs:
            k = "near"
            body = docs[(i - 2) // 20 * 20][1].split()
            body[len(body) // 2] = "other"
        elif i % 20 == 4:
            k, body = "leak", body[:20] + rnd.choice(items)[1].split() + body[20:]
        elif i % 20 == 6:
            k, body = "passage", body + passage.split()
        docs.append((i, " ".join(body), "en", f"s{i % 4}", 0))
        kind[i] = k
    labels = [(i, 1, int(kind[i] == "toxic")) for i in range(600) if i % 2]
    return docs, labels, items, kind, passage


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs, labels, items, kind, passage = _corpus(random.Random(11))
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    frame.withColumn("n_chars", F.length("text").cast("long")).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, kind, passage


def test_stages_are_in_order_and_each_works_on_what_is_left(spark, made):
    folder, kind, passage = made
    docs = before = spark.read.parquet(f"{folder}/documents.parquet")
    clean = {i for i, k in kind.items() if k == "clean"}
    for number, (name, stage) in enumerate(cp.STAGES):
        after = cp.materialize(stage(spark, docs, folder), label=f"test-{name}")
        ids = {r.doc_id for r in after.select("doc_id").collect()}
        had = {r.doc_id for r in docs.select("doc_id").collect()}
        if number < 4:
            assert after.columns == before.columns and clean & had <= ids
        if name == "toxicity":
            toxic = {i for i, k in kind.items() if k == "toxic"}
            assert len(ids & toxic) <= 3
        elif name == "near_duplicates":
            want = brute.near_duplicate_classes([tuple(r) for r in docs.select("doc_id", "text").collect()])
            assert ids == {i for i, c in want.items() if i == c}
        elif name == "repeated_passages":
            want = brute.removed_repeats([tuple(r) for r in docs.select("doc_id", "text").collect()])
            kept = {r.doc_id: r for r in after.collect()}
            assert ids == had and {i: len(r.text.encode()) for i, r in kept.items()} == {i: b - g for i, (b, g, _, _) in want.items()}
            assert all(r.n_chars == len(r.text) for r in kept.values())
            assert sum(passage in r.text for r in kept.values()) == 1
        elif name == "decontamination":
            bench = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
            found = brute.leaks([tuple(r) for r in docs.select("doc_id", "text").collect()], bench)
            assert had - ids == {d for d, _ in found} and found
        else:
            assert ids == had and after.filter("taken > 2 * size").isEmpty()
        docs = after


def test_run_gives_the_last_stage(spark, made):
    assert cp.run(spark, made[0]).filter("position IS NOT NULL").count() > 100


def _scratch(spark):
    from rideflow.session import checkpoint_root

    root = Path(checkpoint_root(spark).removeprefix("file:")) / "rideflow"
    return {p.name for p in root.iterdir()} if root.exists() else set()


def test_run_leaves_no_scratch_but_its_result(spark, made):
    before = _scratch(spark)
    mixed = cp.run(spark, made[0])
    assert {n.rsplit("-", 1)[0] for n in _scratch(spark) - before} == {"mixing"}
    assert mixed.count() > 100


def test_scratch_of_a_stage_goes_but_what_its_result_reads(spark, made):
    docs, before = spark.read.parquet(f"{made[0]}/documents.parquet"), _scratch(spark)
    left = cp.drop_toxic(spark, docs, made[0])
    assert {n.rsplit("-", 1)[0] for n in _scratch(spark) - before} == {"toxic-parts"}
    # Not written in between: what the input reads stays.
    cut = cp.cut_repeats(spark, left, made[0])
    assert left.count() == cut.count() > 400
    mixed = cp.mix(spark, docs, made[0])
    assert not {n for n in _scratch(spark) - before if n.startswith(("toxic", "suffix"))}
    assert mixed.count() == docs.count()


@pytest.mark.parametrize("rows", [0, 1, 2])
def test_odd_tables_pass_every_stage(spark, made, tmp_path, rows):
    odd = [
        (None, "some text with a null id and six words", "en", None, 1, 2.0), (1, None, None, None, None, None), (1, None, None, None, None, None),
        (2, "", "en", "a", 0, 1.0), (3, "twice the same row here and there", "en", "a", 9, 1.0), (3, "twice the same row here and there", "en", "a", 9, 1.0),
        (2, "quite another text under an id that is used twice", "en", "a", 5, 1.0), (4, "long " * 40_000, "en", "b", 5, 0.5), (5, "é" * 100, "fr", "b", 5, 0.5), (6, "x" + "é" * 100, "fr", "b", 5, 0.5),
    ]
    ddl = "doc_id long, text string, lang string, source string, n_chars long, score double"
    frame = spark.createDataFrame(odd if rows == 2 else odd[:rows], ddl).selectExpr("*", "'k' AS kept", "1 AS leaks", "2 AS row", "3 AS node")
    docs = frame
    for number, (_, stage) in enumerate(cp.STAGES):
        docs = cp.materialize(stage(spark, docs, made[0]), label="test-odd")
        if number < 4:
            assert docs.columns == frame.columns
            assert {r.kept for r in docs.select("kept").collect()} <= {"k"}
    if rows == 2:
        left = {r.doc_id: r for r in docs.filter("doc_id IS NOT NULL").collect()}
        assert set(left) == {1, 2, 3, 4, 5, 6} and left[6].text == "x" and left[1].text is None
        assert docs.filter("doc_id IS NULL").count() == 1 and docs.filter("doc_id = 3").count() == 1
        assert {r.text for r in docs.filter("doc_id = 2").collect()} == {"", "quite another text under an id that is used twice"}
