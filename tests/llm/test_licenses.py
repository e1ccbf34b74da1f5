import pytest

from rideflow.llm import licenses as lic


@pytest.fixture(scope="module")
def classifier(spark):
    lines = spark.createDataFrame([(f"some plain line number {i} of a text",) for i in range(50)], "line string")
    return lic.train(spark, lines)


def test_every_template_is_found_and_confirmed(spark, classifier):
    rows = [(i, f"first line\nNote. {text} Thanks.\nlast line", family) for i, (family, text) in enumerate((f, t) for f, ts in lic.TEMPLATES.items() for t in ts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, family string")
    got = {r.doc_id: (r.line_no, r.family, r.confirmed) for r in lic.scan(docs, classifier).collect()}
    assert got == {i: (1, family, True) for i, _, family in rows}


def test_lookalikes_and_odd_texts(spark, classifier):
    rows = [(i, t) for i, t in enumerate([*lic.LOOKALIKES, None, "", "\n\n", "license " * 30_000, "the licensee left"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert lic.scan(docs, classifier).filter("confirmed").isEmpty()
    assert lic.scan(docs.limit(0), classifier).isEmpty()


def test_documents_keep_their_rows(spark, classifier):
    rows = [(1, "x\nReleased under the MIT License.\nAll rights reserved."), (None, "Licensed under CC BY 4.0."), (3, None), (3, "plain"), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'a' AS family", "1 AS words")
    got = {r.doc_id: (r.n_paragraphs, r.families) for r in lic.document_licenses(docs, classifier=classifier).collect()}
    assert got == {1: (3, ["all-rights-reserved", "mit"]), None: (1, ["cc-by"]), 3: (1, []), 4: (0, [])}


def test_notices_without_a_stem_are_found(spark, classifier):
    rows = [
        ("cc-by-sa", "CC BY-SA 4.0"),
        ("cc-by-sa", "Creative Commons Attribution-ShareAlike 4.0 International"),
        ("gpl", "Distributed under the terms of the GNU GPL v3"),
        ("apache", "SPDX: Apache-2.0"),
    ]
    docs = spark.createDataFrame([(f, f"some text\n{t}\nmore of it") for f, t in rows], "doc_id string, text string")
    got = sorted((r.doc_id, r.line_no, r.family, r.confirmed) for r in lic.scan(docs, classifier).collect())
    assert got == sorted((f, 1, f, True) for f, _ in rows)


def test_the_filter_keeps_all_that_have_features(spark, classifier):
    weights = classifier.model.coefficientMatrix.toArray()
    terms = [(t,) for t, w in zip(classifier.vectors.vocabulary, weights.T) if w.any()]
    rows = spark.createDataFrame(terms, "t string").select(lic.words_of(lic.F.col("t")).alias("words"))
    assert terms and rows.filter(~classifier.may_have_features(lic.F.col("words"))).isEmpty()
