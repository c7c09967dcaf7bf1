"""Ids and texts against the tokenizers library, whole texts."""

from __future__ import annotations

import os
import random

import pytest

os.environ["TOKENIZERS_PARALLELISM"] = "false"
public_tokenizers = pytest.importorskip("public_tokenizers")

from tierline.llm import bpe  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")
PIECES = [
    "the", "an", "Thing", "é", "ß", "H̱", "K", " ", "  ", "\n", "'s", "'", "..", ",", ".", "1", "23", "<|endoftext|>",
    "<|ENDOFTEXT|>", "日本", "　", "\xa0", "\x85", "\x1c", "İ", "Σ", "ΑΣ", "aaaa", "́", "ﬁ", "ไทย", "😀", " ",
]


def library(text):
    return bpe.codec(PATH).whole.encode(text, add_special_tokens=False).ids


def random_text(rng, n=60):
    text = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, n)))
    return text.replace(" ", "").replace("\n", "") if rng.random() < 0.4 else text


def by_pieces(text, most):
    cod, ids, leaves = bpe.codec(PATH), [], []
    for kind, piece in bpe.text_pieces(text, most, cod.words):
        if kind in ("text", "special"):
            ids += bpe._list_array(cod.encode([piece])).values.to_pylist()
        elif kind == "word":
            ids += cod.piece(piece, True)
        else:
            leaves.append(cod.piece(piece, kind == "last"))
            if kind == "last":
                ids += cod.concatenate(leaves)
                leaves = []
    return ids


@pytest.mark.parametrize("most", [4, 17, 10**6])
def test_pieces_of_random_texts(most):
    rng = random.Random(most)
    for _ in range(400):
        text = random_text(rng)
        assert by_pieces(text, most) == library(text), repr(text)


@pytest.mark.parametrize("letters", ["abcdethinso", "a", "éàñ", "日本語"])
def test_long_unsplit_word(letters):
    rng = random.Random(1)
    text = "".join(rng.choice(letters) for _ in range(9001))
    assert by_pieces(text, 256) == library(text)


def test_table_of_chunks_starts_afresh(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_CHUNKS", 5)
    cod = bpe.Codec(PATH)
    texts = ["one two three", "four five six seven", "one, two. Three!", ""]
    for _ in range(3):
        got = [bpe._list_array([b]).values.to_pylist() for b in cod.encode(texts)]
        assert got == [library(t) for t in texts]


def test_documents(spark):
    rng = random.Random(5)
    texts = [None, "", " ", "the Same", "the Same", *(random_text(rng, 200) for _ in range(20)), "x" * 3000 + " end", "ab " * 1500]
    rows = [(None if i == 3 else i, t, i, "c") for i, t in enumerate(texts)]
    rows += [rows[-1], rows[-2], (1, "other text of id 1", 0, "d")]  # repeated rows and ids
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int, decoded string")
    got = bpe.encode_documents(docs, PATH, leaf_chars=100)
    assert got.columns == ["doc_id", "ids", "decoded"]
    expected = []
    for i, t, *_ in rows:
        ids = library(t or "")
        expected.append((i, ids, bpe.codec(PATH).whole.decode(ids, skip_special_tokens=False)))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, expected))
    assert bpe.encode_documents(docs.limit(0), PATH).collect() == []
