"""Surrogates: types and formats, coreference, distinctness, collisions."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F
from tierline.llm import pii as P


KEY = b"a key of the tests"


def kinds(text):
    return [(m.type, text[m.start : m.end]) for m in P.mentions(text)]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        (None, []),
        ("", []),
        ("nothing here, 12 words and 3.5 more", []),
        ("mail bob.42@mail8.example.com, ok", [("email", "bob.42@mail8.example.com")]),
        ("a@b @ c@ @d x@y.z a@b.co", [("email", "a@b.co")]),
        ("ip 42.144.35.254. and 300.1.1.1 and 1.2.3.4.5", [("ip", "42.144.35.254")]),
        ("call +1 (988) 555-2485 or 4111 1111 1111 1111.", [("phone", "+1 (988) 555-2485"), ("card", "4111 1111 1111 1111")]),
        ("4041894974608795", [("card", "4041894974608795")]),
        ("ids 123-45-6789 and 123-45-67890", [("ssn", "123-45-6789")]),
        ("9.9.9.9", [("ip", "9.9.9.9")]),
        ("+55555555", [("phone", "+55555555")]),
        ("ring 06 12 34 56 78, +33 6 12 34 56 78.", [("phone", "06 12 34 56 78"), ("phone", "+33 6 12 34 56 78")]),
        ("030 1234567 or +49 30 1234567", [("phone", "030 1234567"), ("phone", "+49 30 1234567")]),
        ("91 234 56 78; (555)123-4567; 5551234567", [("phone", "91 234 56 78"), ("phone", "(555)123-4567"), ("phone", "5551234567")]),
        ("on 2024-10-12 at 10 12 14 we had 1234567 of 12,345,678 and 3.14159265", []),
        ("Mr John Smith said. Later Smith left, and John too. Smithson stayed.",
         [("name", "John"), ("name", "Smith"), ("name", "Smith"), ("name", "John")]),
        ("Mrs O'Brien and Dr Smith-Jones", [("name", "O'Brien"), ("name", "Smith-Jones")]),
        ("to DE89 3704 0044 0532 0130 00 not DE88 3704 0044 0532 0130 00", [("iban", "DE89 3704 0044 0532 0130 00")]),
        ("Mrs. Anna Schmidt met Herr Weber", [("name", "Anna"), ("name", "Schmidt"), ("name", "Weber")]),
        ("Иван Петров и Μαρία Παππά", [("name", "Иван"), ("name", "Петров"), ("name", "Μαρία"), ("name", "Παππά")]),
    ],
)
def test_mentions(text, expected):
    assert kinds(text) == expected


def test_permutation_is_one():
    for size in (1, 2, 7, 100, 1000):
        assert sorted(P.permute(i, size, b"k", "x") for i in range(size)) == list(range(size))


def test_surrogates_keep_type_and_format():
    s = P.surrogate
    card = s("card", "4111111111111111", b"k")
    assert card[0] == "4" and len(card) == 16 and P.luhn(card) and card != "4111111111111111"
    assert re.fullmatch(r"[a-z]{3}\.\d\d@[a-z]{4}\d\.[a-z]{7}\.com", s("email", "bob.42@mail8.example.com", b"k"))
    assert all(0 <= int(o) < 256 for o in s("ip", "1.2.3.4", b"k").split("."))
    assert re.fullmatch(r"\+1\d{10}", s("phone", "+19885552485", b"k"))
    for (gender, script), names in P.NAMES.items():
        got = s("name", f"given {gender}:{names.split()[0]}", b"k").partition(":")[2]
        assert got in names.split() and P.script_of(got) == script
        family = s("name", f"family:{names.split()[0]}", b"k").partition(":")[2]
        assert P.script_of(family) == script and family.istitle()
    assert s("card", "4111111111111111", b"k") != s("card", "4111111111111111", b"other")


def test_coreference_and_distinctness(spark):
    people = [f"user{i}@host.example.org" for i in range(100)]
    rows = [(i, f"to {p} and {p.upper()} from +1 (555) 123-{i:04d} or +1 555 123 {i:04d}") for i, p in enumerate(people)]
    rows += [(200, None), (201, ""), (202, "no one"), (None, rows[0][1]), rows[5], rows[5], (300, "x " * 40_000 + people[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'t' AS type", "1 AS id", "2 AS entities")
    out = [tuple(r) for r in P.pseudonymize(docs, KEY).collect()]
    got = {}
    for i, text, _ in out:
        got.setdefault(i, []).append(text)
    assert got[200] == [None] and got[201] == [""] and got[202] == ["no one"] and got[None] == got[0]
    assert len(got[5]) == 3 and len(set(got[5])) == 1
    mails, phones = set(), set()
    for i in range(100):
        lower, upper = re.findall(r"\S+@\S+", got[i][0])
        assert lower == upper.lower() and lower != people[i]
        a, b = re.findall(r"\+1[ ()\d-]+\d", got[i][0])
        assert re.sub(r"\D", "", a) == re.sub(r"\D", "", b)
        mails.add(lower)
        phones.add(re.sub(r"\D", "", a))
    assert len(mails) == len(phones) == 100
    assert got[300][0].endswith(re.findall(r"\S+@\S+", got[0][0])[0])
    assert P.pseudonymize(docs.limit(0), KEY).collect() == []


def test_collisions_are_drawn_again(spark, monkeypatch):
    """Family names of a tiny pool collide; all must end up distinct, and none
    may be a name of the corpus."""
    monkeypatch.setitem(P.SYLLABLES, "latin", "ba be bi bo")
    names = ["Schmidt", "Weber", "Meier", "Huber", "Bababa", "Bebebe", "Bobobo", "Bibibi"] + [f"Q{c}x" for c in "abcdefghijklmnopqrstuvwxyz"]
    docs = spark.createDataFrame([(i, f"Herr {n} came") for i, n in enumerate(names)], "doc_id long, text string")
    out = {r.doc_id: r.text.split()[1] for r in P.pseudonymize(docs, KEY).collect()}
    assert len(set(out.values())) == len(names)
    assert not set(out.values()) & set(names)


def test_given_names_are_permuted():
    for (gender, _), names in P.NAMES.items():
        for key in (KEY, b"k", b"other"):
            images = {n: P.surrogate("name", f"given {gender}:{n}", key).partition(":")[2] for n in names.split()}
            assert set(images.values()) == set(images)
            assert all(a != b for a, b in images.items())


def test_given_names_stay_distinct(spark, monkeypatch):
    monkeypatch.setitem(P.SYLLABLES, "latin", "ba be bi bo")
    people = ["John", "David", "Daniel", "Pierre", *(f"Q{c}x" for c in "abcdefghijklmnopqrst")]
    docs = spark.createDataFrame([(i, f"Mr {n} Weber came") for i, n in enumerate(people)], "doc_id long, text string")
    out = [r.text.split()[1:3] for r in P.pseudonymize(docs, KEY).collect()]
    assert len({given for given, _ in out}) == len(people) and len({family for _, family in out}) == 1
    assert not {given for given, _ in out[4:]} & {*people, *P.GIVEN, out[0][1]}
    assert all(given != n for (given, _), n in zip(out, people, strict=True))


def test_accounts_and_compound_names_keep_their_format():
    code = P.surrogate("iban", "DE89370400440532013000", KEY)
    assert code[:2] == "DE" and len(code) == 22 and code != "DE89370400440532013000"
    assert kinds(code) == [("iban", code)]
    text, _ = P.replaced("to GB82 WEST 1234 5698 7654 32.", {}, KEY)
    assert re.fullmatch(r"to GB\d\d [A-Z]{4} \d{4} \d{4} \d{4} \d\d\.", text) and kinds(text)
    text, _ = P.replaced("Mrs O'Brien, Dr Smith-Jones", {}, KEY)
    assert re.fullmatch(r"Mrs O'[A-Z][a-z]+, Dr [A-Z][a-z]+-[A-Z][a-z]+", text) and "Brien" not in text and "Jones" not in text


def test_later_mentions_change_alike():
    text, found = P.replaced("Mr John Smith said. Later Smith left, and John too. Smithson stayed.", {}, KEY)
    given, family, again, first = (w for w in re.findall("[A-Z][a-z]+", text) if w not in ("Mr", "Later", "Smithson"))
    assert (given, family) == (first, again) and given != "John" and family != "Smith" and len(found) == 4


def test_crowded_formats_end(spark):
    """All one-letter addresses of a host: they can't all get another one of
    that format, so some grow; numbers raise when their format is full."""
    mails = [f"{c}@full.example.org" for c in "abcdefghijklmnopqrstuvwxyz"]
    docs = spark.createDataFrame([(i, m) for i, m in enumerate(mails)], "doc_id long, text string")
    out = [r.text for r in P.pseudonymize(docs, KEY).collect()]
    assert len(set(out)) == 26


def test_full_format_raises(spark, monkeypatch):
    monkeypatch.setattr(P, "LIMIT", 2)
    monkeypatch.setattr(P, "_draw", lambda key: lambda *c: F.lit("same"))
    docs = spark.createDataFrame([(i, f"+1 555 123 {i:04d}") for i in range(9)], "doc_id long, text string")
    with pytest.raises(ValueError, match="phone"):
        P.attempt_numbers(docs, "text", KEY)


def test_a_key_is_needed(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    with pytest.raises(ValueError):
        P.pseudonymize(docs, b"")
    texts = {P.replaced("Mr Weber, 030 1234567", {}, k)[0] for k in (b"1", b"2", b"3")}
    assert len(texts) == 3
