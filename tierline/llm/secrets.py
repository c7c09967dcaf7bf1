"""Secret scans through nested encodings.

A worklist starts with the text itself.  Every layer is scanned; what it
holds in URL escapes, Unicode escapes, base64 or compressed base64 is decoded
to new layers, until no layer is new: a layer already met at the same place (by
digest and span of the text) is left out, so cycles end.  Each layer carries a
map from its characters to the original text, and findings are reported as
spans of that text: exact characters for URL and Unicode escapes, the encoded
run for base64.

No layer is cut or left out for its size or depth.  Layers decoded without
decompression are smaller than what they come from.  A compressed layer may be
of any size; as all it holds has the same span (its run), only the kinds found
in it matter, so it is decompressed as a stream, all members and frames of it,
through any number of compressions, and scanned in blocks that overlap by
``OVERLAP`` bytes; encoded runs longer than that inside it are streams of their
own.  The work then takes a few blocks of memory per nesting, whatever the
size.

Edge cases: null and empty texts hold no secrets.  Very long texts are scanned
whole.  Equal rows give equal rows; an empty table gives an empty result.
Spans found in several layers at the same place count once.
:func:`find_secrets` returns two columns only and :func:`redact` replaces one
in place, so other columns of the input can't clash.
"""

from __future__ import annotations

import base64
import bz2
import codecs
import hashlib
import lzma
import re
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import chain

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import small_batches

# What counts as a secret.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile("AKIA[A-Z0-9]{12,}")
HEX = re.compile("[0-9a-f]{32,}")
MIN_VALUE = 8
WORDS = ("passw", "secret", "token", "api")

URL_RUN = re.compile("(?:%[0-9A-Fa-f]{2})+")
UNICODE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})")
#: Shorter runs can't hold a secret.
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{19,}={0,2}")
#: Runs that go on after single line breaks, indented or not.
LINES = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:\r?\n[ \t]*[A-Za-z0-9+/_-]++)+={0,2}")
#: What bytes hold of text, and how much of it a secret needs.
TEXT = re.compile(rb"(?:[\t\n\r\x1b\x20-\x7e]|[\xc2-\xdf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2})+")
ENOUGH = re.compile(rb"[\t\n\r\x20-\x7e]{14}")
PACKED = re.compile(rb"\x1f\x8b\x08|BZh[1-9]1AY&SY|\xfd7zXZ\x00|\x28\xb5\x2f\xfd|\x78[\x01\x5e\x9c\xda]")
#: Bytes of a decompressed layer that are scanned at once, and bytes that
#: neighbouring blocks have in common.
MAX_DECODED = 1 << 20
OVERLAP = 1 << 16

SPAN = "struct<kind:string,start:bigint,end:bigint,depth:int>"
#: From a span of a layer to the spans of the layer around it.
Place = Callable[[int, int], list[tuple[int, int]]]
#: Maps from a layer to the text, innermost first; None for the text itself.
Chain = tuple[Place, "Chain"] | None
#: A layer inside another: its text, or the kinds that it holds with their
#: depth (for compressed ones, which are not kept).
Inner = str | dict[str, int]


def scan(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the secrets in one layer."""
    found = []
    low = text.lower()
    if any(w in low for w in WORDS):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return found


def _unescaped(text: str, pattern: re.Pattern, decode: Callable[[re.Match], Iterator[tuple[str, int]]]) -> tuple[str, Place] | None:
    """The text with escapes decoded and its map to that with them; None if
    there are none.  ``decode`` gives (character, letters it was written with)."""
    parts: list[str] = []
    # Where an escape's character stands in the new and in the old text, and
    # where the old text goes on; between escapes the places run in parallel.
    new, old, after = array("q"), array("q"), array("q")
    done = size = 0
    for m in pattern.finditer(text):
        at = m.start()
        for char, letters in decode(m):
            if letters != 1:
                parts += [text[done:at], char]
                size += at - done
                new.append(size)
                old.append(at)
                after.append(at + letters)
                size += 1
                done = at + letters
            at += letters
    if not parts:
        return None
    parts.append(text[done:])

    def start(at: int) -> int:
        k = bisect_right(new, at) - 1
        if k < 0:
            return at
        return old[k] if new[k] == at else after[k] + at - new[k] - 1

    def end(at: int) -> int:  # of the character before ``at``
        k = bisect_right(new, at - 1) - 1
        return at if k < 0 else after[k] + at - 1 - new[k]

    return "".join(parts), lambda a, b: [(start(a), end(b))]


def _url(m: re.Match) -> Iterator[tuple[str, int]]:
    """Bytes that are no UTF-8 stay as they are written."""
    at = m.start()
    for char in bytes.fromhex(m[0].replace("%", "")).decode("utf-8", "surrogateescape"):
        if "\ud800" <= char <= "\udfff":
            yield from ((c, 1) for c in m.string[at : at + 3])
            at += 3
        else:
            letters = 3 * len(char.encode())
            yield char, letters
            at += letters


def _unicode(m: re.Match) -> Iterator[tuple[str, int]]:
    code = int(m[1] or m[2] or m[3], 16)
    if code < 0xD800 or 0xDFFF < code < 0x110000:
        yield chr(code), m.end() - m.start()
    else:
        yield from ((c, 1) for c in m[0])


# Compressed layers.

_DAMAGED = (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError, zstandard.ZstdError)


def _decompressor(head: bytes):
    """A fresh decompressor for data that starts so; None if it is none."""
    if head[:3] == b"\x1f\x8b\x08":
        return zlib.decompressobj(31)
    if head[:1] == b"\x78" and len(head) > 2 and int.from_bytes(head[:2], "big") % 31 == 0:
        return zlib.decompressobj()
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if head[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor()
    if head[:4] == b"\x28\xb5\x2f\xfd":
        return zstandard.ZstdDecompressor().decompressobj()
    return None


def _member(tool, head: bytes, more: Iterator[bytes], rest: list[bytes]) -> Iterator[bytes]:
    """The plain blocks of one member or frame; what follows it goes to
    ``rest``.  Damaged data end it."""
    limited = not isinstance(tool, _UNLIMITED)
    data, at = head, 0
    try:
        while True:
            if limited:
                out, data = tool.decompress(data, MAX_DECODED), b""
                data = getattr(tool, "unconsumed_tail", b"")
            else:  # a little at a time
                out, at = tool.decompress(data[at : at + _STEP]), at + _STEP
            if out:
                yield out
            if tool.eof:
                rest.append(tool.unused_data + (b"" if limited else data[at:]))
                return
            if (data and limited) or at < len(data) or not getattr(tool, "needs_input", True):
                continue
            data, at = next(more, b""), 0
            if not data and not (limited and out):  # else the tool may hold more
                return
    except _DAMAGED:
        return


_UNLIMITED = type(zstandard.ZstdDecompressor().decompressobj())
#: Compressed bytes handed at once to a tool without an output limit.
_STEP = 1 << 9


def _members(blocks: Iterator[bytes], head: bytes) -> Iterator[bytes]:
    """The plain blocks of all members and frames, one after the other."""
    while True:
        if (tool := _decompressor(head)) is not None:
            rest: list[bytes] = []
            yield from _member(tool, head, blocks, rest)
            head = b"".join(rest)
        elif _SKIPPABLE.match(head):  # a frame of Zstandard without content
            size = 8 + int.from_bytes(head[4:8], "little")
            while len(head) < size and (more := next(blocks, b"")):
                size, head = size - len(head), more
            head = head[size:]
        else:
            return
        head = head.lstrip(b"\0")  # padding
        while len(head) < 8 and (more := next(blocks, b"")):
            head = (head + more).lstrip(b"\0")


_SKIPPABLE = re.compile(rb"[\x50-\x5f]\x2a\x4d\x18.{4}", re.DOTALL)


def _inflated(blocks: Iterator[bytes]) -> tuple[Iterator[bytes], int]:
    """Blocks with all compressions taken off, and their number.  Data that
    come out as they went in end it."""
    levels, met = 0, set()
    while True:
        head = b""
        while len(head) < 1 << 12 and (more := next(blocks, b"")):
            head += more
        digest = hashlib.sha256(head).digest()
        if _decompressor(head) is None or digest in met:
            return chain([head], blocks), levels
        met.add(digest)
        inner = _members(blocks, head)
        first = next(inner, b"")
        if not first:  # only looked like it
            return chain([head], blocks), levels
        blocks, levels = chain([first], inner), levels + 1


def _kinds(blocks: Iterator[bytes]) -> dict[str, int]:
    """Kinds of secrets in a stream of bytes, with their least depth."""
    found: dict[str, int] = {}

    def add(kinds: Iterator[tuple[str, int]]) -> None:
        for kind, depth in kinds:
            found[kind] = min(depth, found.get(kind, depth))

    buffer = next(blocks, b"")
    wide = _utf16(buffer)
    if wide:
        decoder = codecs.getincrementaldecoder(wide)("replace")
        blocks, buffer = (decoder.decode(b).encode("utf-8", "replace") for b in chain([buffer], blocks)), b""
    while True:
        last = False
        while len(buffer) < MAX_DECODED + OVERLAP:
            more = next(blocks, b"")
            if not more:
                last = True
                break
            # Blanks between a name and its value may be any number.
            buffer += _BLANKS.sub(b" " * 64, more)
        add((k, d) for k, _, _, d in secrets(buffer.decode("utf-8", "replace")))
        if last:
            return found
        run = buffer[_open_run(buffer) :]
        begin = _begin64(run[:OVERLAP].translate(_TO_64, b"\r\n \t")) if len(run) > OVERLAP else None
        if begin is None:
            buffer = buffer[-OVERLAP:]
            continue
        # An encoded run that goes on: a stream of its own.
        rest: list[bytes] = []
        plain, levels = _inflated(_decoded(_letters(run, blocks, rest), *begin))
        add((k, d + levels + 1) for k, d in _kinds(plain).items())
        for _ in plain:  # read on to the run's end, should the stream end before
            pass
        buffer = b"".join(rest)


_BLANKS = re.compile(rb"\x20{64,}")
_LETTERS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
#: What can't be inside a run: another character, a blank behind a letter, an
#: empty line.
_BREAK = re.compile(rb"[^A-Za-z0-9+/_\r\n \t-]|(?<=[A-Za-z0-9+/_-])[ \t]|\n[ \t]*\r?\n")
_TO_64 = bytes.maketrans(b"-_", b"+/")
#: Bytes of a run's end that are scanned as text again, with what follows.
_TAIL = 1 << 12


def _open_run(buffer: bytes) -> int:
    """Where the run begins that the buffer ends in."""
    begin = len(buffer.rstrip(_LETTERS + b"\r\n \t"))
    for m in _BREAK.finditer(buffer, begin):
        begin = m.end()
    return begin


def _letters(run: bytes, blocks: Iterator[bytes], rest: list[bytes]) -> Iterator[bytes]:
    """The letters of a run, without line breaks, up to its end; its last
    bytes and what follows go to ``rest``."""
    data, tail = run, b""
    while data:
        # One letter of what was before, for the look behind.
        seen = tail[-1:]
        stop = _BREAK.search(seen + data)
        part = data[: stop.start() - len(seen)] if stop else data
        yield part.translate(_TO_64, b"\r\n \t")
        tail = (tail + part)[-_TAIL:]
        if stop:
            rest.append(tail + data[len(part) :])
            return
        data = next(blocks, b"")
    rest.append(tail)


def _begin64(letters: bytes) -> tuple[int, int] | None:
    """Letters and then bytes to pass over before what a run holds begins: 0
    and 0 if it is text or compressed from its start, else what comes before a
    compressed payload or before text; None if there is none of them."""
    data = _bytes64(letters.decode())
    if _utf16(data) or _mostly(data) is not None or _decompressor(data) is not None:
        return 0, 0
    for skip in range(4):
        data = _bytes64(letters[skip:].decode())
        for m in PACKED.finditer(data):
            # Some give nothing before a whole block is read, but begin with
            # bytes that do not come by chance.
            if m[0][:1] in b"\x28\xfdB" or ENOUGH.search(next(_inflated(iter([data[m.start() :]]))[0], b"")):
                return skip, m.start()
    for skip in range(1, 4):
        data = _bytes64(letters[skip:].decode())
        for m in TEXT.finditer(data):
            if 2 * len(m[0]) > len(data) and ENOUGH.search(m[0]):
                return skip, m.start()
    return None


def _decoded(letters: Iterator[bytes], skip: int, over: int) -> Iterator[bytes]:
    held = b""
    for part in letters:
        part, skip = part[skip:], max(0, skip - len(part))
        held += part
        whole = len(held) // 4 * 4
        data, held = base64.b64decode(held[:whole]), held[whole:]
        data, over = data[over:], max(0, over - len(data))
        if data:
            yield data
    if len(held) > 1:
        yield base64.b64decode(held + b"=" * (4 - len(held)))


def _packed(data: bytes) -> dict[str, int] | None:
    """What compressed bytes hold; None if they are none."""
    plain, levels = _inflated(iter([data]))
    if not levels:
        return None
    return {k: d + levels - 1 for k, d in _kinds(plain).items()}


# Base64.


def _utf16(data: bytes) -> str | None:
    """UTF-16 text: every other byte is mostly zero, or it has a mark."""
    if data[:2] in (b"\xff\xfe", b"\xfe\xff"):
        return "utf-16"
    some = data[: 1 << 12]
    for name, zeros, others in (("utf-16-le", some[1::2], some[::2]), ("utf-16-be", some[::2], some[1::2])):
        if len(some) > 15 and 10 * zeros.count(0) > 9 * len(zeros) and not others.count(0):
            return name
    return None


def _plain(data: bytes) -> str | None:
    """Text, if the bytes are readable UTF-8."""
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return None
    return text if text and text.replace("\n", "").replace("\t", "").replace("\r", "").isprintable() else None


def _bytes64(letters: str) -> bytes:
    if len(letters) % 4 == 1:
        letters = letters[:-1]
    return base64.b64decode(letters + "=" * (-len(letters) % 4))


def _mostly(data: bytes) -> str | None:
    """Text, if the bytes begin with some and at least half of them are."""
    if (text := _plain(data)) is not None:
        return text
    if not (TEXT.match(data) and ENOUGH.search(data)) or 2 * sum(len(m[0]) for m in TEXT.finditer(data)) < len(data):
        return None
    return data.decode("utf-8", "replace")


def _unwrap64(run: str) -> list[tuple[Inner, int, int, bool]]:
    """What a run holds, with the letters it comes from, and whether all of it
    has that place.  If the run is neither text nor compressed from its start,
    the four ways to begin are tried."""
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    data = _bytes64(body)
    if (wide := _utf16(data)) is not None:
        return [(data.decode(wide, "replace"), 0, len(run), True)]
    if (text := _mostly(data)) is not None:
        return [(text, 0, len(run), False)]
    if (kinds := _packed(data)) is not None:
        return [(kinds, 0, len(run), True)]
    found: list[tuple[Inner, int, int, bool]] = []
    for skip in range(4):
        data = _bytes64(body[skip:])
        for m in TEXT.finditer(data) if ENOUGH.search(data) else ():
            if ENOUGH.search(m[0]):
                found.append((m[0].decode(), skip + m.start() * 4 // 3, min(len(run), skip - (-m.end() * 4 // 3)), False))
        for m in PACKED.finditer(data):
            if kinds := _packed(data[m.start() :]):
                found.append((kinds, skip + m.start() * 4 // 3, len(run), True))
    return found


def _lines(m: re.Match) -> Iterator[tuple[Inner, Place]]:
    """What a run over several lines holds, mapped to the lines it is on."""
    parts = [(p.start(), p.end()) for p in re.finditer(r"[^\r\n \t]+", m[0])]
    starts = [0]
    for a, b in parts:
        starts.append(starts[-1] + b - a)
    if starts[-1] < 19:
        return

    def on(a: int, b: int) -> list[tuple[int, int]]:
        first, last = bisect_right(starts, a) - 1, bisect_right(starts, max(a, b - 1)) - 1
        return [(m.start() + parts[min(first, len(parts) - 1)][0], m.start() + parts[min(last, len(parts) - 1)][1])]

    for inner, a, b, whole in _unwrap64("".join(m[0][x:y] for x, y in parts)):
        if whole:
            yield inner, lambda *_, a=a, b=b: on(a, b)
        else:
            at = lambda x, inner=inner, a=a: a + len(inner[:x].encode()) * 4 // 3
            yield inner, lambda x, y, at=at: on(at(x), at(y) + 1)


def _layers(text: str) -> Iterator[tuple[Inner, Place]]:
    """What a text holds, decoded, each with its map to the text.  What
    stands at several places is there once, with a map to all of them."""
    if "%" in text and (out := _unescaped(text, URL_RUN, _url)):
        yield out
    if "\\" in text and (out := _unescaped(text, UNICODE, _unicode)):
        yield out
    places: dict[str, list[int]] = {}
    for m in BASE64.finditer(text):
        places.setdefault(m[0], []).append(m.start())
    for run, at in places.items():
        for inner, a, b, _ in _unwrap64(run):
            yield inner, lambda *_, spans=[(s + a, s + b) for s in at]: spans
    for m in LINES.finditer(text) if "\n" in text else ():
        yield from _lines(m)


def _original(place: Chain, a: int, b: int) -> list[tuple[int, int]]:
    spans = [(a, b)]
    while place:
        spans, place = [inner for s in spans for inner in place[0](*s)], place[1]
    return spans


def secrets(text: str | None) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, depth) of all secrets in a text: spans of the text
    in code points, depth 0 for those that need no decoding; by start, then
    kind as listed in KINDS, then end."""
    if not text:
        return []
    found: dict[tuple[str, int, int], int] = {}

    def add(kind: str, spans: list[tuple[int, int]], depth: int) -> None:
        for span in spans:
            found[(kind, *span)] = min(depth, found.get((kind, *span), depth))

    # Last in, first out: a layer is let go when what it holds is on the list.
    work: list[tuple[str, Chain, int]] = [(text, None, 0)]
    seen = {(hashlib.sha256(text.encode()).digest(), 0, len(text))}
    while work:
        layer, place, depth = work.pop()
        for kind, a, b in scan(layer):
            add(kind, _original(place, a, b), depth)
        for inner, within in _layers(layer):
            inner_place = (within, place)
            if isinstance(inner, dict):
                for kind, deeper in inner.items():
                    add(kind, _original(inner_place, 0, 0), depth + 1 + deeper)
                continue
            met = [(hashlib.sha256(inner.encode("utf-8", "replace")).digest(), *s) for s in _original(inner_place, 0, len(inner))]
            if not seen.issuperset(met):
                seen.update(met)
                work.append((inner, inner_place, depth + 1))
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted(((k, a, b, d) for (k, a, b), d in found.items()), key=lambda s: (s[1], order[s[0]], s[2]))


def secret_spans(text: Column) -> Column:
    """Array of the secrets' spans in a text column."""

    @F.arrow_udf(f"array<{SPAN}>")
    def spans(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("depth", pa.int32())]))
        names = ("kind", "start", "end", "depth")
        return pa.array([[dict(zip(names, s, strict=True)) for s in secrets(t.as_py())] for t in texts], kind)

    return spans(text)


def redacted(text: str | None) -> str | None:
    """The text with every secret replaced by [kind]; overlapping spans are
    replaced together, under the kind of the first."""
    found = secrets(text)
    if not found:
        return text
    out, done, merged = [], 0, []
    for kind, a, b, _ in found:
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], b)
        else:
            merged.append([kind, a, b])
    for kind, a, b in merged:
        out += [text[done:a], f"[{kind}]"]
        done = b
    return "".join([*out, text[done:]])


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, spans) for every row."""
    small_batches(docs.sparkSession)
    return docs.select(id_col, secret_spans(F.col(text_col)).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the secrets in ``text_col`` replaced."""
    small_batches(docs.sparkSession)

    @F.arrow_udf("string")
    def clean(texts: pa.Array) -> pa.Array:
        return pa.array([redacted(t.as_py()) for t in texts], pa.string())

    return docs.withColumn(text_col, clean(F.col(text_col)))
