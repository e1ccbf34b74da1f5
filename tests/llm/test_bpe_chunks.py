import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from rideflow.llm import bpe_chunks as bc
from tests.llm import brute

ODD = ["\n", "  ", "\t", "<|endoftext|>", "<|startoftext|", "é", "́", "É", "字字", "don't", "'s", "...", " ", "\x1c", "\x0b", "İ", "42", "ß", " "]


def _json(file):
    with open(public_tokenizers.path(file), encoding="utf-8") as f:
        return f.read()


def _docs(seed, n=60):
    rnd = random.Random(seed)

    def words(k):
        return "".join(rnd.choice([*ODD, *["abcdefghij"[: rnd.randint(1, 9)] for _ in range(60)]]) + rnd.choice(["", " ", " ", " "]) for _ in range(k))

    passages = [words(rnd.choice([5, 80, 400])) for _ in range(8)] + ["x" * 3000, "字" * 900, "ab" * 20 + " " + "q" * 5000]
    docs = ["".join(rnd.choice([words(rnd.randint(0, 120)), rnd.choice(passages)]) for _ in range(rnd.randint(0, 7))) for _ in range(n)]
    docs += [docs[2]] * 4 + [None, "", " ", "\n\n"] + [passages[2] + "ly" + passages[2], "un" + passages[2]]
    return list(enumerate(docs))


def _digests(rows):
    return {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows}


@pytest.mark.parametrize(
    "file, options", [("word_bpe_49k.json", {}), ("word_bpe_49k.json", {"max_held": 0}), ("byte_bpe_50k.json", {}), ("byte_bpe_50k.json", {"max_held": 0})]
)
def test_equal_to_encoding_whole_texts(spark, file, options):
    docs = _docs(3)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = bc.encode_documents(frame, _json(file), outputs=["n_tokens", "ids_sha256", "decoded_sha256"], **options)
    assert _digests(found.collect()) == brute.encoded(docs, file)


def test_ids_and_text_and_carried_columns(spark):
    docs = [(1, "one two", 5, "a"), (1, "one two", 6, "b"), (None, None, 7, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, row int, `pieces.x` string")
    found = bc.encode_documents(frame, _json("word_bpe_49k.json"), outputs=["ids", "decoded"])
    assert found.columns == ["doc_id", "row", "pieces.x", "ids", "decoded"]
    rows = {r.row: (r.doc_id, r.ids, r.decoded) for r in found.collect()}
    assert rows[5] == rows[6] and rows[5][2] == "one</w> two</w>" and rows[7] == (None, [], "")
    clash = bc.encode_documents(frame.withColumnRenamed("row", "ids"), _json("word_bpe_49k.json"))
    assert clash.columns == ["doc_id", "pieces.x", "ids"] and clash.count() == 3
    assert bc.encode_documents(frame.limit(0), _json("word_bpe_49k.json")).collect() == []
    with pytest.raises(ValueError):
        bc.encode_documents(frame, _json("word_bpe_49k.json"), outputs=["tokens"])


def test_windows_that_do_not_agree_become_the_whole_text(spark, monkeypatch):
    """Chunks whose ids were wrong are noticed, and their documents encoded whole."""
    docs = _docs(5)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    good = bc._encode_chunks

    def bad(tokenizer_json):
        encode = good(tokenizer_json)

        def spoilt(batches):
            import pyarrow as pa

            for batch in encode(batches):
                ids = [x[::-1] for x in batch.column("ids").to_pylist()]
                yield batch.set_column(1, "ids", pa.array(ids, pa.binary()))

        return spoilt

    monkeypatch.setattr(bc, "_encode_chunks", bad)
    found = bc.encode_documents(frame, _json("word_bpe_49k.json"), outputs=["n_tokens", "ids_sha256", "decoded_sha256"])
    assert _digests(found.collect()) == brute.encoded(docs, "word_bpe_49k.json")


def test_chunks_of_a_passage_do_not_depend_on_its_place():
    rnd = random.Random(1)
    passage = "".join(rnd.choice("abcdefgh é") for _ in range(20_000)).encode()
    found = []
    for before in (b"", b"x" * 501, "é".encode() * 2000):
        data = np.frombuffer(before + passage, np.uint8)
        (borders,) = bc.chunk_bounds(data, np.array([0, len(data)]))
        assert borders[0] == 0 and borders[-1] == len(data) and max(np.diff(borders)) <= bc._MOST
        data.tobytes()[borders[1] :].decode()  # never inside a character
        found.append({hashlib.md5(data[a:b].tobytes()).digest() for a, b in zip(borders, borders[1:])})
    assert len(found[0] & found[1] & found[2]) >= 0.8 * len(found[0])


def test_long_text_is_encoded_in_stretches(monkeypatch):
    monkeypatch.setattr(bc, "_STRETCH", 50)
    monkeypatch.setattr(bc, "_MEMO", 20)
    encoder = bc.TextEncoder(_json("word_bpe_49k.json"))
    for _, text in _docs(9, 20):
        want = encoder._pack(encoder._whole(text or ""))
        assert encoder.encode((text or "").encode()) == want


def test_marks_behind_words_and_spelled_ids(monkeypatch):
    monkeypatch.setattr(bc, "_AT_ONCE", 3)
    encoder = bc.TextEncoder(_json("word_bpe_49k.json"))
    words = [w + m for w in ("word", "Été", "DON", "x") for m in ("", "$$$", ".%%%", "...!?", "_-_", "<|", "'s", "***'", "<|endoftext|>")]
    for word in words:
        assert encoder.encode(word.encode()) == encoder._pack(encoder._whole(word))
    assert encoder._plain_word(b"word.%%%") and encoder._plain_word(b"word's") is None and encoder._plain_word(b"$$$") is None
    texts = ["", "one two", *words, "", "a b c d e f g"]
    ids = [encoder._whole(t) for t in texts]
    numbers, spelled, digests, lists = encoder.results([encoder._pack(i) for i in ids], ["n_tokens", "decoded", "ids_sha256", "ids"])
    assert numbers.to_pylist() == [len(i) for i in ids] and lists.to_pylist() == ids
    assert spelled.to_pylist() == [encoder.tokenizer.decode(i, skip_special_tokens=False) for i in ids]
    assert digests.to_pylist() == [hashlib.sha256(" ".join(map(str, i)).encode()).hexdigest() for i in ids]
    assert [c.to_pylist() for c in encoder.results([], ["n_tokens", "decoded"])] == [[], []]
