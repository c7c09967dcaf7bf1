"""SentencePiece encoding and decoding for merge-type vocabularies.

A text is one row of symbols (its code points, a space being the mark U+2581,
with one mark put in front).  An agenda holds every pair of adjacent symbols
whose concatenation is a piece, ordered by the piece's score (best first) and
then by place (left first).  The first entry is merged, the pairs around it
are looked up anew, and so on until the agenda is empty.  Symbols that are no
piece at the end become their UTF-8 bytes.

No piece holds the mark behind another symbol (checked when the model is
read), so no merge crosses the place before a mark: a text's ids are those of
its segments (marks, then other symbols), and equal segments are encoded once
per worker, in a bounded table.  The agendas of many short segments are kept
side by side in numpy arrays, one row per segment; a long segment has a heap.

In every Arrow batch, the segments that enter the table and the first text of
each slice are checked against the sentencepiece library (of the segments, the
decoded text against themselves); a difference raises.

Edge cases: null and empty texts give no ids and an empty decoded text.
Equal rows give equal rows, an empty table an empty result; columns other
than the two named are not looked at, so their names can't clash.  A text is
cut into stretches of about ``STRETCH`` code points at spaces, so memory does
not grow with its length beyond the row itself, except for a single word
(without any space) longer than that, whose agenda is held whole.  A literal
mark in a text counts as a space, as in the library, and decodes to one.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import slices, small_batches

MARK = "▁"
#: Segments kept encoded per worker; beyond that the table starts afresh.
KEPT_SEGMENTS = 600_000
#: Segments longer than this have a heap of their own.
SIDE_BY_SIDE = 48
#: Rows of agendas held side by side at once.
ROWS = 16_384
#: Code points of a long text that are worked on at once.
STRETCH = 1 << 20
#: Segments that the library encodes in one call.
CHECKED_TOGETHER = 65_536
#: Longest text that is checked as a whole.
CHECKED_CHARS = 16_384

_NEVER = np.iinfo(np.int32).max
#: Symbols: no symbol, and the one of code point 0 where that is in no piece.
_PAD, _OUTSIDE = -1, -2
_SEGMENT = re.compile(" *[^ ]+| +")


def _model_type(model: bytes) -> int:
    """Field 3 (model_type) of message 2 (trainer_spec) of a model file."""

    def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
        at = 0

        def varint() -> int:
            nonlocal at
            value = shift = 0
            while True:
                byte = data[at]
                at += 1
                value |= (byte & 127) << shift
                shift += 7
                if byte < 128:
                    return value

        while at < len(data):
            tag = varint()
            kind = tag & 7
            if kind == 0:
                yield tag >> 3, varint()
            else:
                size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
                yield tag >> 3, data[at : at + size]
                at += size

    for number, value in fields(model):
        if number == 2:
            return next((v for n, v in fields(value) if n == 3), 1)
    return 1


class Pairs:
    """Merged symbol of a pair of symbols: a hash table in numpy arrays for
    many pairs at once, and a dict for one."""

    def __init__(self, merged: dict[int, int]):
        self.one = merged
        bits = max(4, (8 * len(merged)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.mask = (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, -1, np.int32)
        for key, value in merged.items():
            at = int(self._place(np.array([key], np.int64))[0])
            while self.keys[at] != -1:
                at = (at + 1) & self.mask
            self.keys[at], self.values[at] = key, value

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def many(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """-1 where two symbols don't merge."""
        keys = (left.astype(np.int64) << 32) | right
        at = self._place(keys)
        found = self.keys[at]
        out = np.where(found == keys, self.values[at], -1)
        todo = np.flatnonzero((found != keys) & (found != -1))
        while todo.size:
            at[todo] = (at[todo] + 1) & self.mask
            found = self.keys[at[todo]]
            hit = found == keys[todo]
            out[todo[hit]] = self.values[at[todo[hit]]]
            todo = todo[~hit & (found != -1)]
        out[(left < 0) | (right < 0)] = -1
        return out


class Pieces:
    """A sentencepiece model file of the merge type with byte pieces, identity
    normalisation and a mark put in front."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        with open(path, "rb") as fh:
            if _model_type(fh.read()) != 2:
                raise ValueError(f"{path} is not a merge-type model")
        if lib.normalize(" ﬁ  x ") != f"{MARK}{MARK}ﬁ{MARK}{MARK}x{MARK}":
            raise ValueError("only identity normalisation with a mark in front is supported")
        n = lib.get_piece_size()
        names = [lib.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i))]
        if any(lib.is_unused(i) for i in plain):
            raise ValueError("unused pieces are not supported")
        if any(MARK in names[i].lstrip(MARK) for i in plain):
            raise ValueError("pieces with a mark behind another symbol are not supported")
        byte_of = {int(names[i][3:5], 16): i for i in range(n) if lib.is_byte(i)}
        if len(byte_of) != 256:
            raise ValueError("a piece for every byte is needed")
        self.byte_ids = np.array([byte_of[b] for b in range(256)], np.int32)

        # Symbols are pieces' ids; code points that occur in pieces without
        # being one have numbers from n on.
        self.symbol = {names[i]: i for i in plain}
        self.n = n
        extra = sorted({c for i in plain for c in names[i]} - set(self.symbol))
        self.extra = {n + k: c for k, c in enumerate(extra)}
        self.symbol |= {c: s for s, c in self.extra.items()}
        self.alphabet = np.full(0x110000, -1, np.int32)
        for text, s in self.symbol.items():
            if len(text) == 1:
                self.alphabet[ord(text)] = s
        merged = {}
        for i in plain:
            for k in range(1, len(names[i])):
                a, b = self.symbol.get(names[i][:k]), self.symbol.get(names[i][k:])
                if a is not None and b is not None:
                    merged[a << 32 | b] = i
        self.pairs = Pairs(merged)
        scores = {i: lib.get_score(i) for i in plain}
        order = {s: k for k, s in enumerate(sorted(set(scores.values()), reverse=True))}
        #: Place of a piece's score among all scores; the last one for -1.
        self.rank = np.full(n + 1, _NEVER, np.int32)
        for i, s in scores.items():
            self.rank[i] = order[s]

        raw = [names[i].replace(MARK, " ").encode() for i in range(n)]
        for b, i in byte_of.items():
            raw[i] = bytes([b])
        self.special = {i for i in range(n) if lib.is_control(i) or lib.is_unknown(i)}
        #: Bytes of the pieces, and behind them those of pieces that start a text.
        self.raw = pa.array(raw + [r.removeprefix(b" ") for r in raw], pa.binary())
        self.kept: dict[str, bytes] = {}

    # The agenda.

    def _ids(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of rows of final symbols (flat, ``sizes`` a row): a symbol that
        is no piece becomes its bytes."""
        odd = np.flatnonzero((symbols < 0) | (symbols >= self.n))
        if not odd.size:
            return symbols, sizes
        points = _OUTSIDE - symbols[odd]
        for k in np.flatnonzero(symbols[odd] >= 0).tolist():
            points[k] = ord(self.extra[int(symbols[odd[k]])])
        width = np.ones(len(symbols), np.int64)
        width[odd] += (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
        out = np.repeat(symbols, width)
        at = (np.cumsum(width) - width)[odd]
        low = points <= 0x7F
        out[at[low]] = self.byte_ids[points[low]]
        for k, point in zip(at[~low].tolist(), points[~low].tolist(), strict=True):
            raw = np.frombuffer(chr(point).encode(), np.uint8)
            out[k : k + len(raw)] = self.byte_ids[raw]
        row = np.repeat(np.arange(len(sizes)), sizes)
        return out, np.bincount(row, weights=width, minlength=len(sizes)).astype(np.int64)

    def _symbols(self, points: np.ndarray) -> np.ndarray:
        """A code point outside the alphabet is a negative number."""
        found = self.alphabet[points]
        return np.where(found == -1, _OUTSIDE - points, found)

    def _side_by_side(self, points: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Agendas of many segments, one row each: a round merges the best
        pair, the leftmost of equals, of every row that has one."""
        rows, wide = len(sizes), int(sizes.max())
        steps = np.arange(wide)
        held = steps < sizes[:, None]
        symbols = np.full((rows, wide), _PAD, np.int32)
        symbols[held] = self._symbols(points)
        agenda = np.full((rows, wide), _NEVER, np.int32)
        if wide > 1:
            agenda[:, :-1] = self.rank[self.pairs.many(symbols[:, :-1].ravel(), symbols[:, 1:].ravel())].reshape(rows, wide - 1)
        final, place = symbols, np.arange(rows)
        while True:
            best = agenda.argmin(axis=1)
            row = np.arange(len(best))
            some = agenda[row, best] != _NEVER
            if not some.all():
                # Rows without an entry are finished.
                if symbols is not final:
                    final[place[~some], : symbols.shape[1]] = symbols[~some]
                symbols, agenda, place, best = symbols[some], agenda[some], place[some], best[some]
                row = row[: len(best)]
                if not row.size:
                    break
            # Symbol ``best`` becomes the merged one, the next one goes away.
            new = self.pairs.many(symbols[row, best], symbols[row, best + 1])
            move = steps[: symbols.shape[1] - 1] > best[:, None]
            symbols[:, :-1] = np.where(move, symbols[:, 1:], symbols[:, :-1])
            agenda[:, :-1] = np.where(move, agenda[:, 1:], agenda[:, :-1])
            symbols[:, -1] = _PAD
            agenda[:, -1] = _NEVER
            symbols[row, best] = new
            agenda[row, best] = self.rank[self.pairs.many(new, symbols[row, np.minimum(best + 1, symbols.shape[1] - 1)])]
            ok = np.flatnonzero(best > 0)
            agenda[ok, best[ok] - 1] = self.rank[self.pairs.many(symbols[ok, best[ok] - 1], new[ok])]
        held = final != _PAD
        return self._ids(final[held], held.sum(axis=1))

    def _heap(self, points: np.ndarray) -> np.ndarray:
        """The agenda of one long segment.  An entry (rank, left) holds as
        long as the pair that starts at ``left`` still has that rank."""
        symbols = self._symbols(points).tolist()
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        one, rank = self.pairs.one, self.rank.tolist()
        into = [-1] * n

        def look(left: int) -> int:
            right = after[left]
            if right >= n or symbols[left] < 0 or symbols[right] < 0:
                into[left] = -1
            else:
                into[left] = one.get(symbols[left] << 32 | symbols[right], -1)
            return into[left]

        agenda = [rank[look(i)] * n + i for i in range(n - 1) if look(i) >= 0]
        heapq.heapify(agenda)
        while agenda:
            r, left = divmod(heapq.heappop(agenda), n)
            if into[left] < 0 or rank[into[left]] != r:
                continue
            right = after[left]
            symbols[left] = into[left]
            into[right] = -1
            symbols[right] = _PAD
            after[left] = after[right]
            if after[left] < n:
                before[after[left]] = left
            for i in (before[left], left):
                if i >= 0 and look(i) >= 0:
                    heapq.heappush(agenda, rank[into[i]] * n + i)
        final = np.array(symbols, np.int32)
        final = final[final != _PAD]
        return self._ids(final, np.array([len(final)]))[0]

    def segments(self, keys: list[str]) -> list[bytes]:
        """Little-endian int32 ids of segments, each given without its first
        mark and with spaces for the others."""
        texts = [MARK + k.replace(" ", MARK) for k in keys]
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int32)
        sizes = np.array([len(t) for t in texts], np.int64)
        starts = np.cumsum(sizes) - sizes
        out: list[bytes] = [b""] * len(keys)
        order = np.argsort(sizes, kind="stable")
        short = order[: np.searchsorted(sizes[order], SIDE_BY_SIDE, side="right")]
        first = 0
        while first < len(short):
            # Rows of one block differ little in length.
            most = max(8, int(sizes[short[first]]) + int(sizes[short[first]]) // 4)
            last = min(first + ROWS, int(np.searchsorted(sizes[short], most, side="right")))
            block = short[first:last]
            n = sizes[block]
            at = np.repeat(starts[block] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            ids, counts = self._side_by_side(points[at], n)
            raw = ids.astype("<i4").tobytes()
            ends = (4 * np.cumsum(counts)).tolist()
            begin = 0
            for i, e in zip(block.tolist(), ends, strict=True):
                out[i] = raw[begin:e]
                begin = e
            first = last
        for i in order[len(short) :].tolist():
            out[i] = self._heap(points[starts[i] : starts[i] + sizes[i]]).astype("<i4").tobytes()
        return out

    # Whole texts.

    def learn(self, missing: list[str]) -> None:
        """Put segments into the table, checked against the library."""
        found = self.segments(missing)
        self.kept.update(zip(missing, found, strict=True))
        # The library gives nothing for a lone mark, which is an empty text
        # to it; segments of marks only would grow if others followed them.
        single = [i for i, k in enumerate(missing) if k and k[-1] == " "]
        self.check([missing[i] for i in single], [found[i] for i in single])
        many = [i for i, k in enumerate(missing) if k and k[-1] != " "]
        for first in range(0, len(many), CHECKED_TOGETHER):
            block = many[first : first + CHECKED_TOGETHER]
            groups = [block[i : i + 32] for i in range(0, len(block), 32)]
            self.check([" ".join([missing[i] for i in g]) for g in groups], [b"".join([found[i] for i in g]) for g in groups])

    def check(self, texts: list[str], ids: list[bytes]) -> None:
        """Raise unless the library gives the same ids, and the ids the texts."""
        theirs = self.library.encode(texts, num_threads=1)
        if array("i", chain.from_iterable(theirs)).tobytes() != b"".join(ids) or [4 * len(t) for t in theirs] != list(map(len, ids)):
            wrong = next(t for t, a, b in zip(texts, theirs, ids, strict=True) if array("i", a).tobytes() != b)
            raise RuntimeError(f"ids differ from the library's for {wrong[:200]!r}")
        if self.decode(id_lists(ids)) != pa.array([t.replace(MARK, " ") for t in texts], pa.string()):
            raise RuntimeError("decoded texts differ from the encoded ones")

    def stretches(self, text: str) -> Iterator[str]:
        """Cut a text before segments; the space cut at is left out, as every
        stretch gets a mark in front again."""
        start = 0
        while len(text) - start > STRETCH:
            at = start + STRETCH
            while True:
                at = text.find(" ", at)
                if at < 0 or at + 1 == len(text):
                    at = -1
                    break
                if text[at - 1] not in (" ", MARK):
                    break
                at += 1
            if at < 0:
                break
            yield text[start:at]
            start = at + 1
        if start < len(text):
            yield text[start:]

    def encode(self, texts: pa.Array) -> pa.Array:
        """Ids of each text, as a list array."""
        if pc.max(pc.binary_length(texts)).as_py() is None or pc.max(pc.binary_length(texts)).as_py() <= STRETCH:
            return self._encode(texts)
        whole: list[pa.Array] = []
        for text in texts.to_pylist():
            parts = [self._encode(pa.array([s], pa.string())).flatten() for s in self.stretches(text)]
            whole.append(pa.concat_arrays([pa.array([], pa.int32()), *parts]))
        offsets = np.cumsum([0, *map(len, whole)], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.concat_arrays(whole))

    def _encode(self, texts: pa.Array) -> pa.Array:
        texts = pc.replace_substring(texts, MARK, " ")
        # Single spaces split a text; the segments of others are looked for.
        odd = np.asarray(pc.match_substring_regex(texts, "^$|  |^ | $"))
        even = texts if not odd.any() else texts.filter(pa.array(~odd))
        parts = [pc.split_pattern(even, " ")]
        if odd.any():
            found = [[s[1:] for s in _SEGMENT.findall(" " + t)] if t else [] for t in texts.filter(pa.array(odd)).to_pylist()]
            parts.append(pa.array(found, pa.list_(pa.string())))
        segments = pa.concat_arrays(parts)
        words = pc.dictionary_encode(segments.flatten())
        keys = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        missing = [k for k in keys if k not in self.kept]
        if len(self.kept) + len(missing) > KEPT_SEGMENTS:
            self.kept.clear()
            missing = keys
        if missing:
            self.learn(missing)
        encoded = id_lists(list(map(self.kept.__getitem__, keys))).take(words.indices)
        starts = np.asarray(encoded.offsets)[np.asarray(segments.offsets)]
        ids = pa.ListArray.from_arrays(pa.array(starts), encoded.flatten())
        if not odd.any():
            return ids
        back = np.empty(len(texts), np.int64)
        back[np.concatenate([np.flatnonzero(~odd), np.flatnonzero(odd)])] = np.arange(len(texts))
        return ids.take(pa.array(back))

    def decode(self, ids: pa.Array) -> pa.Array:
        """Texts of a list array of ids."""
        starts, values = np.asarray(ids.offsets), np.array(ids.flatten())
        if not self.special.isdisjoint(np.unique(values).tolist()):
            return self.library_texts(ids)
        values[starts[:-1][starts[:-1] < starts[1:]]] += self.n  # a text's first piece
        raw = pc.binary_join(pa.ListArray.from_arrays(ids.offsets, self.raw.take(pa.array(values))), b"")
        try:
            return raw.cast(pa.string())
        except pa.ArrowInvalid:  # bytes that are no UTF-8, which no text encodes to
            return self.library_texts(ids)

    def library_texts(self, ids: pa.Array) -> pa.Array:
        return pa.array([self.library.decode(r) for r in ids.to_pylist()], pa.string())


def id_lists(ids: list[bytes]) -> pa.Array:
    offsets = np.zeros(len(ids) + 1, np.int32)
    np.cumsum([len(b) // 4 for b in ids], out=offsets[1:])
    values = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(ids))])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def encode_pieces(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, ``ids`` (array of int) and
    ``decoded`` (the text of the ids).  No shuffle."""
    small_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(model_path)
        for batch in batches:
            for part in slices(batch, "text"):
                ids = model.encode(part.column("text"))
                decoded = model.decode(ids)
                first = part.column("text")[0].as_py()
                if len(first) <= CHECKED_CHARS:
                    model.check([first], [array("i", ids[0].as_py()).tobytes()])
                    if model.library_texts(ids[:1]) != decoded[:1]:
                        raise RuntimeError("a decoded text differs from the library's")
                yield pa.RecordBatch.from_arrays([part.column("id"), ids, decoded], ["id", "ids", "decoded"])

    return rows.mapInArrow(run, f"id {id_type}, ids array<int>, decoded string").withColumnRenamed("id", id_col)
