"""Personal data: surrogate generation.

Detected entities are replaced by keyed, type-consistent surrogates.  An
entity has a canonical form (digits of a number, lower-case e-mail address,
name as written), and the surrogate depends on type, canonical form and key
only, so all mentions of an entity change alike (coreference), in their own
punctuation.

* Numbers and the parts of e-mail addresses go through a keyed Feistel
  permutation of all strings of the same shape: digits stay digits, letters
  stay letters, card numbers keep their first digit and their valid check
  digit, IPv4 addresses their octets' range.  A permutation maps different
  entities of a shape to different surrogates.
* Given names on the list are replaced by others of the same gender and script
  from it, by a keyed permutation without fixed points; other given names and
  family names by made-up ones in the same script.

A given or family name found in a text counts wherever the word stands in it,
alone as well, so no later mention gives the person away.

Collision checks: over all distinct entities of the corpus, surrogates that
two entities share, or that are themselves an entity of the corpus, are drawn
again with the next attempt number for all but the first of them, until none
is left.  Names and e-mail addresses grow by a letter or syllable every few
attempts, so they always end; numbers keep their format, and if nearly all
numbers of one format are in the corpus, so that ``LIMIT`` rounds do not
suffice, it raises instead of leaving collisions.  Names are compared as
written, whatever their role.  Surrogates of listed given names are distinct as
they are, and names of the list by intent; no other entity gets one of these.
Only those (few) attempt numbers travel back to the texts that need them, by a
join on a digest of the text.

The key is the caller's secret: whoever has it can undo the permutations.

Edge cases: null texts stay null, texts without entities stay as they are.
Very long texts are searched whole.  Equal rows give equal rows; an empty table
gives an empty result.  Only the two columns named are looked at, and inside
they have names of their own.
"""

from __future__ import annotations

import hashlib
import hmac
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import small_batches
from tierline.sources.sinks import stage_table

#: Attempts after which an e-mail address grows by a letter.
ROUNDS = 25
#: Rounds of collision checks after which a format counts as full.
LIMIT = 200

TYPES = ("email", "iban", "card", "ip", "ssn", "phone", "name")

# What entities look like, and the names to draw from.
EMAIL = re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9._%+-]{0,62}[A-Za-z0-9_%+-])?@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}")
IP = re.compile(r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9])")
CARD = re.compile(r"(?<![0-9-])[0-9](?:[ -]?[0-9]){12,18}(?![ -]?[0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_GAP = "[ .-]"
PHONE = re.compile(
    # Groups of three and four, an area code maybe in brackets.
    rf"(?<![\w.])(?:\+[0-9]{{1,3}}{_GAP}?)?(?:\([0-9]{{2,5}}\){_GAP}?|[0-9]{{2,4}}{_GAP})[0-9]{{3,4}}(?:{_GAP}[0-9]{{3,4}}){{1,2}}(?![\w-])"
    # With a country code: any groups.
    rf"|(?<![\w.])\+[0-9]{{1,3}}(?:{_GAP}?\([0-9]{{1,5}}\))?(?:{_GAP}?[0-9]{{1,8}}){{1,6}}(?!\w)"
    # National with a leading zero: pairs, or an area code and the rest.
    rf"|(?<![\w.])0[0-9](?:{_GAP}[0-9]{{2}}){{4}}(?![\w-])"
    rf"|(?<![\w.])(?:\(0[0-9]{{1,4}}\)|0[0-9]{{1,4}})[ /-][0-9]{{5,8}}(?![\w-])"
    # Nine digits from 6 to 9 on, in groups that end in pairs; ten without gaps.
    rf"|(?<![\w.])[6-9][0-9]{{1,2}}(?:{_GAP}[0-9]{{2,3}}){{1}}(?:{_GAP}[0-9]{{2}}){{2}}(?![\w-])"
    r"|(?<![\w.-])[2-9][0-9]{9}(?![\w-]|\.[0-9])"
)
PHONE_DIGITS = range(7, 16)
#: Runs of what numbers of these kinds are made of; the patterns above are
#: tried within them only.
NUMBER = re.compile(r"[0-9][0-9()+. /-]*[0-9]")
NAMES = {
    ("f", "latin"): "Anna Maria Emma Julia Laura Sarah Lisa Claire Marie Sofia Elena Carmen Lucia Helen Alice Emily",
    ("m", "latin"): "John Peter Thomas Michael David Daniel Paul Martin Pierre Louis Hans Karl Carlos Miguel Juan James",
    ("f", "cyrillic"): "Анна Мария Елена Ольга Наталья Ирина Светлана Татьяна",
    ("m", "cyrillic"): "Иван Пётр Алексей Дмитрий Сергей Андрей Михаил Николай",
    ("f", "greek"): "Μαρία Ελένη Αικατερίνη Σοφία Άννα Ειρήνη",
    ("m", "greek"): "Γεώργιος Ιωάννης Νικόλαος Δημήτριος Πέτρος Ανδρέας",
}
TITLES = {
    "f": "Mrs Ms Miss Frau Mme Madame Señora Sra Doña Госпожа Κυρία",
    "m": "Mr Sir Herr Monsieur Señor Sr Don Господин Κύριος",
    "": "Dr Prof",
}
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga ge ha ka ke la le lo ma me mi na ne no pa ra re ri ro sa se so ta te to va ve",
    "cyrillic": "ба бе во га да до ка ко ла ле ма ми на не по ра ре ро са се та те ту ва",
    "greek": "βα γα δε κα κο λα λε μα με νι πα ρα ρε σα σε τα το φα",
}

GIVEN = {name: k for k, names in NAMES.items() for name in names.split()}
TITLE_GENDER = {t: g for g, ts in TITLES.items() for t in ts.split()}
_UPPER, _LOWER = "[A-ZÀ-ÖØ-ÞА-ЯЁΆ-Ϋ]", "[a-zß-öø-ÿа-яёά-ώ]"
# O'Brien, McNeil and Smith-Jones as well.
_WORD = rf"(?:{_UPPER}['’])?{_UPPER}{_LOWER}+(?:{_UPPER}{_LOWER}+)?(?:-{_UPPER}{_LOWER}+)*"
_JOINTS = re.compile("(['’-])")
# Both begin with fixed letters, which makes them quick to look for; that a
# word begins there is checked afterwards.
TITLED = re.compile(rf"({'|'.join(map(re.escape, TITLE_GENDER))})\b\.?[ ]({_WORD})(?:[ ]({_WORD}))?")
FULL = re.compile(rf"({'|'.join(map(re.escape, GIVEN))})[ ]({_WORD})\b")


@dataclass(frozen=True, slots=True)
class Mention:
    type: str
    start: int
    end: int
    entity: str  # canonical form


def script_of(word: str) -> str:
    c = ord(word[0])
    return "cyrillic" if 0x400 <= c < 0x530 else "greek" if 0x370 <= c < 0x400 else "latin"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def mentions(text: str | None) -> list[Mention]:
    """Entities in a text, in order; of overlapping ones the earlier type of
    TYPES stays."""
    if not text:
        return []
    found: list[Mention] = []
    if "@" in text:
        found += [Mention("email", *m.span(), m[0].lower()) for m in _emails(text)]
    for m in IBAN.finditer(text):
        code = m[0].replace(" ", "")
        if 15 <= len(code) <= 34 and _check97(code[4:], code[:2]) == int(code[2:4]):
            found.append(Mention("iban", *m.span(), code))
    for run in NUMBER.finditer(text):
        begin, end = run.start(), min(len(text), run.end() + 2)  # what follows is looked at as well
        if run.end() - begin < 7:
            continue
        while begin and text[begin - 1] in "+(":
            begin -= 1
        for m in CARD.finditer(text, begin, end):
            digits = re.sub("[^0-9]", "", m[0])
            if luhn(digits) or len(digits) == 16:
                found.append(Mention("card", *m.span(), digits))
        for m in IP.finditer(text, begin, end):
            if all(int(o) < 256 for o in m[0].split(".")):
                found.append(Mention("ip", *m.span(), ".".join(str(int(o)) for o in m[0].split("."))))
        found += [Mention("ssn", *m.span(), m[0]) for m in SSN.finditer(text, begin, end)]
        for m in PHONE.finditer(text, begin, end):
            digits = re.sub("[^0-9+]", "", m[0])
            if len(digits.lstrip("+")) in PHONE_DIGITS:
                found.append(Mention("phone", *m.span(), digits))
    for m in _at_words(TITLED, text):
        gender = TITLE_GENDER[m[1]]
        for g in (2, 3):
            if m[g]:
                given = m[g] in GIVEN and bool(m[3]) and g == 2
                kind = f"given {GIVEN[m[g]][0]}" if given else f"given {gender}" if m[3] and g == 2 and gender else "family"
                found.append(Mention("name", *m.span(g), f"{kind}:{m[g]}"))
    for m in _at_words(FULL, text):
        found.append(Mention("name", *m.span(1), f"given {GIVEN[m[1]][0]}:{m[1]}"))
        found.append(Mention("name", *m.span(2), f"family:{m[2]}"))
    found += _again(text, [m for m in found if m.type == "name"])
    order = {t: i for i, t in enumerate(TYPES)}
    if not found:
        return []
    taken = bytearray(len(text))
    kept = []
    for m in sorted(found, key=lambda m: (order[m.type], m.start, -m.end)):
        if not any(taken[m.start : m.end]):
            taken[m.start : m.end] = b"\x01" * (m.end - m.start)
            kept.append(m)
    return sorted(kept, key=lambda m: m.start)


def _again(text: str, names: list[Mention]) -> Iterator[Mention]:
    """Names found in a text, wherever else they stand in it as a word."""
    by_word: dict[str, str] = {}
    for m in names:
        by_word.setdefault(m.entity.partition(":")[2], m.entity)
    if not by_word:
        return
    known = {m.start for m in names}
    words = "|".join(re.escape(w) for w in sorted(by_word, key=lambda w: (-len(w), w)))
    for m in re.finditer(rf"(?<!\w)(?:{words})(?!\w)", text):
        if m.start() not in known:
            yield Mention("name", *m.span(), by_word[m[0]])


def _check97(body: str, country: str) -> int:
    """The check digits of an account number."""
    return 98 - int("".join(str(int(c, 36)) for c in f"{body}{country}00")) % 97


def _at_words(pattern: re.Pattern, text: str) -> Iterator[re.Match]:
    """Matches that begin where a word does."""
    m = pattern.search(text)
    while m:
        before = text[m.start() - 1] if m.start() else " "
        inside = before.isalnum() or before == "_"
        if not inside:
            yield m
        m = pattern.search(text, m.start() + 1 if inside else m.end())


def _emails(text: str) -> Iterator[re.Match]:
    """Addresses, looked for around each @ only."""
    at = text.find("@")
    done = 0
    while at >= 0:
        begin = max(done, at - 64)
        m = EMAIL.search(text, begin, at + 600)
        while m and m.end() <= at:
            m = EMAIL.search(text, m.end(), at + 600)
        if m and m.start() < at < m.end():
            yield m
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _random(key: bytes, *parts: object) -> int:
    return int.from_bytes(hmac.new(key, "\x1f".join(map(str, parts)).encode(), hashlib.sha256).digest(), "big")


def permute(value: int, size: int, key: bytes, label: str) -> int:
    """A keyed permutation of range(size): a Feistel network over the next
    larger square, walked until the result is in range."""
    if size <= 1:
        return 0
    half = math.isqrt(size - 1) + 1
    while True:
        a, b = divmod(value, half)
        for r in range(6):
            a, b = b, (a + _random(key, label, size, r, b)) % half
        value = a * half + b
        if value < size:
            return value


def _shaped(text: str, key: bytes, label: str) -> str:
    """Permute the letters and digits of a text; other characters stay."""
    bases = [10 if "0" <= c <= "9" else 26 if "a" <= c <= "z" else 1 for c in text]
    size, value = 1, 0
    for c, base in zip(text, bases, strict=True):
        if base > 1:
            value = value * base + (int(c) if base == 10 else ord(c) - 97)
            size *= base
    shape = "".join("9" if b == 10 else "a" if b == 26 else c for c, b in zip(text, bases, strict=True))
    value = permute(value, size, key, f"{label}\x1f{shape}")
    out = []
    for c, base in zip(reversed(text), reversed(bases), strict=True):
        if base > 1:
            value, d = divmod(value, base)
            c = str(d) if base == 10 else chr(97 + d)
        out.append(c)
    return "".join(reversed(out))


@lru_cache(64)
def _cycle(gender: str, script: str, key: bytes) -> list[str]:
    """The listed given names in keyed order; each is replaced by the next,
    so no two by one and none by itself."""
    return sorted(NAMES[gender, script].split(), key=lambda name: _random(key, "given", name))


def surrogate(kind: str, entity: str, key: bytes, attempt: int = 0) -> str:
    """The canonical form of an entity's surrogate."""
    label = f"{kind}\x1f{attempt}"
    if kind == "email":
        local, _, domain = entity.partition("@")
        host, _, tld = domain.rpartition(".")
        local += "a" * (attempt // ROUNDS)
        return f"{_shaped(local, key, label)}@{_shaped(host, key, 'domain')}.{tld}"
    if kind == "iban":
        body = _shaped(entity[4:].lower(), key, label).upper()
        return f"{entity[:2]}{_check97(body, entity[:2]):02d}{body}"
    if kind == "card":
        body = entity[0] + _shaped(entity[1:-1], key, label)
        if not luhn(entity):
            return entity[0] + _shaped(entity[1:], key, label)
        return next(body + str(d) for d in range(10) if luhn(body + str(d)))
    if kind == "ip":
        octets = [int(o) for o in entity.split(".")]
        value = 0
        for o in octets:
            value = value << 8 | o
        value = permute(value, 1 << 32, key, label)
        return ".".join(str(value >> s & 255) for s in (24, 16, 8, 0))
    if kind == "ssn":
        return _shaped(entity, key, label)
    if kind == "phone":
        keep = 2 if entity.startswith("+") else 0
        return entity[:keep] + _shaped(entity[keep:], key, label)
    sort, _, word = entity.partition(":")
    script = script_of(word)
    r = _random(key, label, entity)
    if sort.startswith("given"):
        names = _cycle(sort[6:] or "f", script, key)
        if word in names:
            return f"{sort}:{names[(names.index(word) + 1) % len(names)]}"
    parts = SYLLABLES[script].split()
    n = 3 + attempt // 4

    def made_up(r: int) -> str:
        return "".join(parts[(r >> (16 * i)) % len(parts)] for i in range(min(n, 15))).capitalize()

    if not _JOINTS.search(word):
        return f"{sort}:{made_up(r)}"
    pieces = _JOINTS.split(word)
    return f"{sort}:" + "".join(p if len(p) < 2 else made_up(_random(key, label, entity, i)) for i, p in enumerate(pieces))


def rendered(mention: str, kind: str, value: str) -> str:
    """A surrogate in the punctuation and letter case of a mention."""
    if kind == "name":
        return value.partition(":")[2]
    if kind == "ip":
        return value
    if kind == "email":
        local, _, rest = value.partition("@")
        own, _, host = mention.partition("@")
        cased = "".join(v.upper() if m.isupper() else v for m, v in zip(own, local, strict=False))
        return cased + local[len(own) :] + "@" + "".join(v.upper() if m.isupper() else v for m, v in zip(host, rest, strict=True))
    if kind == "iban":
        letters = iter(value)
        return "".join(c if c == " " else next(letters) for c in mention)
    digits = iter(c for c in value if c.isdigit())
    return "".join(next(digits) if c.isdigit() else c for c in mention)


def replaced(text: str | None, attempts: dict[tuple[str, str], int], key: bytes) -> tuple[str | None, list[Mention]]:
    """The text with surrogates, and what was found."""
    found = mentions(text)
    out, done = [], 0
    for m in found:
        value = surrogate(m.type, m.entity, key, attempts.get((m.type, m.entity), 0))
        out += [text[done : m.start], rendered(text[m.start : m.end], m.type, value)]
        done = m.end
    return ("".join([*out, text[done:]]) if found else text), found


def _draw(key: bytes):
    @F.arrow_udf("string")
    def draw(kinds: pa.Array, entities: pa.Array, attempts: pa.Array) -> pa.Array:
        rows = zip(kinds.to_pylist(), entities.to_pylist(), attempts.to_pylist(), strict=True)
        return pa.array([surrogate(k, e, key, a) for k, e, a in rows], pa.string())

    return draw


def found_entities(text: Column) -> Column:
    """Array of (type, entity) in a text, each once."""

    @F.arrow_udf("array<struct<type:string,entity:string>>")
    def find(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("type", pa.string()), ("entity", pa.string())]))
        return pa.array(
            [[{"type": t, "entity": e} for t, e in sorted({(m.type, m.entity) for m in mentions(x.as_py())})] for x in texts], kind
        )

    return find(text)


def attempt_numbers(docs: DataFrame, text_col: str, key: bytes) -> DataFrame:
    """(type, entity, attempt) of the entities whose first draw collides."""
    draw = _draw(key)
    entities = (
        docs.select(F.explode(found_entities(F.col(text_col))).alias("e"))
        .select("e.type", "e.entity")
        .groupBy("type", "entity")
        .agg(F.count("*").alias("n"))
        .drop("n")
    )
    drawn = stage_table(
        entities.withColumn("attempt", F.lit(0)).withColumn("surrogate", draw("type", "entity", F.lit(0))), "surrogates"
    )
    # What is compared: names without their role.
    shown = lambda c: F.when(F.col("type") == "name", F.regexp_replace(c, "^[^:]*:", "")).otherwise(F.col(c))
    names = [("name", n) for n in GIVEN]
    originals = drawn.select("type", shown("entity").alias("shown")).unionByName(
        docs.sparkSession.createDataFrame(names, "type string, shown string")
    )
    listed = (F.col("type") == "name") & F.col("entity").isin([f"given {g}:{n}" for n, (g, _) in GIVEN.items()])
    for number in range(LIMIT + 1):
        made = drawn.where(~listed).withColumn("shown", shown("surrogate"))
        real = made.join(originals, ["type", "shown"], "left_semi").select("type", "entity")
        # Of entities with one surrogate the smallest keeps it.
        first = made.groupBy("type", "shown").agg(F.min("entity").alias("first"), F.count("*").alias("n")).where("n > 1")
        shared = made.join(first, ["type", "shown"]).where("entity <> first").select("type", "entity")
        again = stage_table(real.unionByName(shared).distinct().withColumn("again", F.lit(True)), "again")
        left = again.first()
        if left is None:
            break
        if number == LIMIT:
            raise ValueError(f"too many entities of type {left['type']} in one format to give each another one")
        attempt = F.when(F.col("again"), F.col("attempt") + 1).otherwise(F.col("attempt"))
        moved = drawn.join(again, ["type", "entity"], "left").select("type", "entity", attempt.alias("attempt"), "again", "surrogate")
        drawn = stage_table(
            moved.where("again is null")
            .select("type", "entity", "attempt", "surrogate")
            .unionByName(moved.where("again").select("type", "entity", "attempt", draw("type", "entity", "attempt").alias("surrogate"))),
            "surrogates",
        )
    return drawn.where("attempt > 0").select("type", "entity", "attempt")


RESULT = "struct<text:string,entities:array<struct<type:string,start:bigint,end:bigint>>>"


def pseudonymize(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, text, entities) for every row: the text with surrogates, and
    type and span of what they replaced in the original.  ``key`` is secret."""
    if not key:
        raise ValueError("a key is needed")
    spark = docs.sparkSession
    small_batches(spark)
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    numbers = stage_table(attempt_numbers(own, "text", key), "attempts")
    kind = pa.struct(
        [("text", pa.string()), ("entities", pa.list_(pa.struct([("type", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))]
    )

    def result(text: str | None, attempts: dict[tuple[str, str], int]) -> dict:
        new, found = replaced(text, attempts, key)
        return {"text": new, "entities": [{"type": m.type, "start": m.start, "end": m.end} for m in found]}

    # Attempts go to the texts that need them, by a join on the mentions.
    # Written first: Spark then knows the size, and sends few of them to the
    # texts instead of the texts to them.
    keyed = own.withColumn("k", F.md5(F.coalesce("text", F.lit(""))))
    needed = (
        keyed.select("k", F.explode(found_entities(F.col("text"))).alias("e"))
        .select("k", "e.type", "e.entity")
        .join(numbers, ["type", "entity"])
        .distinct()
        .groupBy("k")
        .agg(F.collect_list(F.struct("type", "entity", "attempt")).alias("attempts"))
    )
    needed = stage_table(needed, "needed")

    @F.arrow_udf(RESULT)
    def apply(texts: pa.Array, attempts: pa.Array) -> pa.Array:
        return pa.array(
            [
                result(t.as_py(), {(a["type"], a["entity"]): a["attempt"] for a in own_attempts.as_py() or ()})
                for t, own_attempts in zip(texts, attempts, strict=True)
            ],
            kind,
        )

    out = keyed.join(needed, "k", "left").select("id", apply("text", "attempts").alias("r"))
    return out.select(F.col("id").alias(id_col), "r.text", "r.entities")
