"""Ids and texts against the sentencepiece library, whole texts."""

from __future__ import annotations

import hashlib
import os
import random

import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
pytest.importorskip("sentencepiece")

from tierline.llm import pieces  # noqa: E402

PATH = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"
PARTS = [
    "the", "a", "ing", "tion", "Thing", "é", "ß", "é", " ", "  ", "    ", "▁", "▁▁", "\n", "\t", "\x00", "\r\n", ".", ",",
    "1", "2024", "日本", "ไทย", "😀", "\U00100000", "​", "<s>", "</s>", "<unk>", "<0x41>", "aaaa", "x" * 60, "ab" * 40,
]


@pytest.fixture(scope="module")
def model():
    return pieces.Pieces(PATH)


def random_text(rng, n=40):
    return "".join(rng.choice(PARTS) for _ in range(rng.randint(0, n)))


def check(model, texts):
    ids = model.encode(pa.array(texts, pa.string()))
    expected = [model.library.encode(t) for t in texts]
    assert ids.to_pylist() == expected
    assert model.decode(ids).to_pylist() == [model.library.decode(e) for e in expected]


def test_random_texts(model):
    rng = random.Random(3)
    check(model, [random_text(rng) for _ in range(3000)] + ["", " ", "  ", "▁", "\n", " a", "a ", "a  "])


def test_heap_and_rows_agree(model, monkeypatch):
    rng = random.Random(4)
    keys = [random_text(rng, 8).replace(" ", "") + "z" for _ in range(500)]
    side_by_side = model.segments(keys)
    monkeypatch.setattr(pieces, "SIDE_BY_SIDE", 0)
    assert model.segments(keys) == side_by_side


@pytest.mark.parametrize("letters", ["abcdethinso", "a", "▁ ", "éàñ", "日本語", "\n\t"])
def test_long_words(model, letters):
    rng = random.Random(1)
    check(model, ["".join(rng.choice(letters) for _ in range(9001)), letters[0] * 5000])


@pytest.mark.parametrize("stretch", [3, 20, 500])
def test_stretches(model, monkeypatch, stretch):
    monkeypatch.setattr(pieces, "STRETCH", stretch)
    rng = random.Random(stretch)
    check(model, [random_text(rng, 80) for _ in range(300)] + ["", "a  ", "x" * 2000, " " * 50])


def test_table_starts_afresh(model, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_SEGMENTS", 3)
    for _ in range(3):
        check(model, ["one two three", "four five six seven", "one, two. Three!"])


def test_difference_raises(model):
    with pytest.raises(RuntimeError):
        model.check(["the thing"], [b"\x05\x00\x00\x00"])


def test_ids_of_no_text(model):
    lists = [[0], [1, 264, 2], [198], [229, 5], [264, 1], [], [28705], [28705, 28705]]
    assert model.decode(pa.array(lists, pa.list_(pa.int32()))).to_pylist() == [model.library.decode(r) for r in lists]


def test_documents(spark):
    rng = random.Random(5)
    texts = [None, "", " ", "the Same", "the Same", *(random_text(rng, 200) for _ in range(20)), "x" * 3000 + " end", "ab " * 1500]
    rows = [(None if i == 3 else i, t, i, "c") for i, t in enumerate(texts)]
    rows += [rows[-1], rows[-2], (1, "other text of id 1", 0, "d")]  # repeated rows and ids
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int, decoded string")
    got = pieces.encode_pieces(docs, PATH)
    assert got.columns == ["doc_id", "ids", "decoded"]
    lib = pieces.pieces(PATH).library
    expected = [(i, lib.encode(t or ""), lib.decode(lib.encode(t or "")) if t else "") for i, t, *_ in rows]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, expected))
    assert pieces.encode_pieces(docs.limit(0), PATH).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_query(spark):
    from tierline.llm.queries import op13_pieces

    lib = pieces.pieces(PATH).library
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = op13_pieces(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = lib.encode(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(lib.decode(ids).encode()).hexdigest()
