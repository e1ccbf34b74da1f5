"""The registered queries on the smallest tables, against DuckDB or brute force."""

from pathlib import Path

import duckdb
import pytest

from rideflow.llm.queries import ORACLE, QUERIES
from tests.llm import brute

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF, "documents.parquet").exists(), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _rows(spark, name):
    return QUERIES[name](spark, SF).collect()


def test_every_operator_has_one_query():
    numbers = sorted(int(name.split("_")[0][2:]) for name in QUERIES)
    assert numbers == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    result = duck.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    want = sorted((tuple(r[names.index(c)] for c in sorted(names)) for r in result.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in sorted(names)) for r in df.collect()), key=repr) == want


def test_decontamination(spark, duck):
    docs = duck.execute("SELECT doc_id, text FROM documents").fetchall()
    want = brute.leaks(docs, duck.execute("SELECT item_id, text FROM benchmark").fetchall())
    assert {(r.doc_id, r.item_id) for r in _rows(spark, "op3_decontaminate")} == want


def test_nearest_neighbours(spark, duck):
    vectors = dict(duck.execute("SELECT vec_id, embedding FROM embeddings").fetchall())
    want = brute.nearest(vectors, [v for v in vectors if v % 100 == 0], 10)
    got: dict = {}
    for r in _rows(spark, "op4_nearest_neighbours"):
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert sum(len(got[q] & {v for v, _ in x}) for q, x in want.items()) >= 0.9 * 10 * len(want)


def test_toxicity_scores(spark, duck):
    rows = _rows(spark, "op6_toxicity")
    assert len(rows) == duck.execute("SELECT count(*) FROM documents").fetchone()[0]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)


def test_license_scan(spark, duck):
    got = {r.doc_id for r in _rows(spark, "op7_license_scan") if r.families}
    lines = "Apache License, Version 2.0|MIT License|CC BY-NC 4.0|GNU General Public License|All rights reserved"
    want = {r[0] for r in duck.execute(f"SELECT doc_id FROM documents WHERE regexp_matches(text, '{lines}')").fetchall()}
    assert got == want


def test_removal_of_repeats(spark, duck):
    want = brute.removed_repeats(duck.execute("SELECT doc_id, text FROM documents").fetchall())
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in _rows(spark, "op8_remove_repeats")} == want


def test_near_duplicates(spark, duck):
    want = brute.near_duplicate_classes(duck.execute("SELECT doc_id, text FROM documents").fetchall())
    assert {r.doc_id: r.class_id for r in _rows(spark, "op9_near_duplicates")} == want


def test_chat_turns(spark):
    rows = _rows(spark, "op10_chat_turns")
    assert sum(r.n_right for r in rows) > 0.85 * sum(r.n_lines for r in rows)


def test_bpe_round_trip(spark, duck):
    want = brute.encoded(duck.execute("SELECT doc_id, text FROM documents").fetchall(), "word_bpe_49k.json")
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in _rows(spark, "op11_bpe_round_trip")} == want


def test_spelling_variants(spark, duck):
    want = brute.spelling(duck.execute("SELECT doc_id, text FROM documents").fetchall())
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in _rows(spark, "op13_spelling_variants")} == want
