"""BPE encoding and decoding by tree concatenation.

White space separates words for this kind of tokenizer, so a text's ids are
its chunks' ids in order.  Chunks repeat, so each worker keeps a bounded
table of chunks already encoded by the library.

Texts longer than ``leaf_chars`` are cut into pieces that tasks encode in
parallel.  Cuts fall on white space where there is any.  A stretch of text
without any ("unsplit") is normalised and split into words; a word longer
than ``leaf_chars`` is halved until its pieces fit, the pieces are encoded in
parallel, and the halves' ids are joined pairwise up the tree: the ids around
a join are encoded again, in a window that grows until its first and its last
id equal what the left and the right side had there.  Every adjacent pair of
ids then lies within one exact encoding, and BPE has only one sequence of ids
for a string in which all adjacent pairs encode to themselves, so the joined
ids are exactly those of the whole word.

Edge cases: null and empty texts give no ids and an empty decoded text (the
query's digests are those of the empty string).  Equal rows give equal rows.
An empty table gives an empty result.  Other columns of the input are not
looked at.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import slices, small_batches

LEAF_CHARS = 16384
#: Chunks kept encoded per worker; beyond that the table starts afresh with
#: those of the texts in hand.
KEPT_CHUNKS = 400_000
#: Ids taken from either side of a join at first.
FIRST_WINDOW = 8

_SPACE = re.compile("[ \t\n\r\x0b\x0c]+")
_PLAIN = re.compile(rb"([a-z]+)([.,]?)")


class Codec:
    """A tokenizer file of the kind whose words are separated by white space:
    normaliser, word splitter and BPE with a word-end suffix, no decoder."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, models

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as fh:
            spec = json.load(fh)
        model = spec["model"]
        if spec.get("decoder") or spec.get("post_processor"):
            raise ValueError("decoders and post-processors are not supported")
        self.whole.no_truncation()
        self.whole.no_padding()
        self.suffix = model["end_of_word_suffix"] or ""
        merges = [tuple(m) for m in model["merges"]]
        self.word = Tokenizer(models.BPE(model["vocab"], merges, end_of_word_suffix=self.suffix))
        self.inner = Tokenizer(models.BPE(model["vocab"], merges))
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.special_start = [s.encode()[:2] for s in self.special]
        size = max([*model["vocab"].values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.names = [self.whole.id_to_token(i) for i in range(size)]
        self.names_array = pa.array(self.names, pa.string())
        self.kept: dict[bytes, bytes] = {}
        self.mark = {m: self.ids_of(m) for m in (".", ",")}

    def ids_of(self, text: str) -> bytes:
        return pa.array(self.whole.encode(text, add_special_tokens=False).ids, pa.int32()).buffers()[1][:].to_pybytes()

    def chunks(self, text: str) -> list[bytes]:
        """The words between ASCII white space, in a form that encodes alike:
        A-Z lower-cased where that can't meet a combining mark (lead bytes CC
        and CD) or the text of a special token."""
        raw = text.encode()
        if b"\xcc" not in raw and b"\xcd" not in raw and not any(s in raw for s in self.special_start):
            raw = raw.lower()
        return raw.split()

    def learn(self, missing: set[bytes]) -> None:
        """Encode chunks that are not in the table yet."""
        plain, rest = [], []
        for chunk in missing:
            m = _PLAIN.fullmatch(chunk)
            if m:
                plain.append((chunk, m[1].decode(), m[2].decode()))
            else:
                rest.append(chunk)
        for (chunk, _, mark), e in zip(plain, self.word.encode_batch_fast([w for _, w, _ in plain], add_special_tokens=False), strict=True):
            ids = b"".join(i.to_bytes(4, "little") for i in e.ids)
            self.kept[chunk] = ids + self.mark[mark] if mark else ids
        for chunk, e in zip(rest, self.whole.encode_batch_fast([c.decode() for c in rest], add_special_tokens=False), strict=True):
            self.kept[chunk] = b"".join(i.to_bytes(4, "little") for i in e.ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian int32 ids of each text."""
        split = [self.chunks(t) for t in texts]
        needed = set().union(*split)
        missing = needed.difference(self.kept)
        if len(self.kept) + len(missing) > KEPT_CHUNKS:
            self.kept.clear()
            missing = needed
        self.learn(missing)
        get = self.kept.__getitem__
        return [b"".join(map(get, words)) for words in split]

    def decode(self, ids: pa.Array) -> pa.Array:
        """Texts of a list array of ids: without a decoder, the library puts
        one space between the names of the ids."""
        values = self.names_array.take(ids.flatten())
        return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, values), " ")

    # Long unsplit text.

    def words(self, chunk: str) -> list[tuple[str, str]]:
        """("special", text) or ("word", its byte-level form) of a chunk."""
        out: list[tuple[str, str]] = []
        parts = re.split("(" + "|".join(map(re.escape, self.special)) + ")", chunk) if self.special else [chunk]
        for k, part in enumerate(parts):
            if k % 2:
                out.append(("special", part))
            elif part:
                text = self.whole.normalizer.normalize_str(part) if self.whole.normalizer else part
                out += [("word", w) for w, _ in self.whole.pre_tokenizer.pre_tokenize_str(text)]
        return out

    def piece(self, text: str, ends_word: bool) -> list[int]:
        return (self.word if ends_word else self.inner).encode(text, add_special_tokens=False).ids

    def text_of(self, ids: list[int], ends_word: bool) -> str:
        text = "".join(self.names[i] for i in ids)
        return text.removesuffix(self.suffix) if ends_word else text

    def join(self, left: list[int], right: list[int], ends_word: bool) -> list[int]:
        """Ids of the concatenation of two encoded neighbours."""
        k = FIRST_WINDOW
        while True:
            a, b = min(k, len(left)), min(k, len(right))
            ends = ends_word and b == len(right)
            window = self.piece(self.text_of(left[len(left) - a :] + right[:b], ends), ends)
            if (a == len(left) or window[0] == left[len(left) - a]) and (b == len(right) or window[-1] == right[b - 1]):
                return left[: len(left) - a] + window + right[b:]
            k *= 2

    def concatenate(self, leaves: list[list[int]]) -> list[int]:
        """Join the halves pairwise, level by level."""
        while len(leaves) > 1:
            last = len(leaves) - 1
            leaves = [
                self.join(leaves[i], leaves[i + 1], i + 1 == last) if i < last else leaves[i]
                for i in range(0, len(leaves), 2)
            ]
        return leaves[0]


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def halves(text: str, most: int) -> list[str]:
    """Halve until no piece is longer than ``most``."""
    pieces = [text]
    while max(map(len, pieces)) > most:
        pieces = [h for p in pieces for h in (p[: len(p) // 2], p[len(p) // 2 :])]
    return pieces


def text_pieces(text: str, most: int, words: Callable[[str], list[tuple[str, str]]]) -> Iterator[tuple[str, str]]:
    """Cut a text: ("text", piece that ends at white space), or for unsplit
    stretches longer than ``most`` ("special"|"word", word) and ("half",
    piece of a longer word), the word's last one being ("last", piece)."""
    start = 0
    while start < len(text):
        if len(text) - start <= most:
            yield "text", text[start:]
            return
        cut = -1
        for m in _SPACE.finditer(text, start, start + most):
            cut = m.end()
        if cut > start:
            yield "text", text[start:cut]
            start = cut
            continue
        m = _SPACE.search(text, start)
        end = m.start() if m else len(text)
        for kind, word in words(text[start:end]):
            if kind == "special" or len(word) <= most:
                yield kind, word
            else:
                *some, last = halves(word, most)
                for piece in some:
                    yield "half", piece
                yield "last", last
        start = end


def _list_array(ids: list[bytes]) -> pa.Array:
    offsets = [0]
    for b in ids:
        offsets.append(offsets[-1] + len(b) // 4)
    values = pa.Array.from_buffers(pa.int32(), offsets[-1], [None, pa.py_buffer(b"".join(ids))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def encode_documents(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    leaf_chars: int = LEAF_CHARS,
) -> DataFrame:
    """One row per input row: ``id_col``, ``ids`` (array of int) and
    ``decoded`` (the text of the ids)."""
    spark = docs.sparkSession
    small_batches(spark)
    id_type = docs.schema[id_col].dataType.simpleString()
    docs = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    out = f"id {id_type}, ids array<int>, decoded string"

    def finished(ids_column: pa.Array, encoded: list[bytes], cod: Codec) -> pa.RecordBatch:
        ids = _list_array(encoded)
        return pa.RecordBatch.from_arrays([ids_column, ids, cod.decode(ids)], ["id", "ids", "decoded"])

    def encode_short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cod = codec(tokenizer_path)
        for batch in batches:
            for part in slices(batch, "text"):
                yield finished(part.column("id"), cod.encode(part.column("text").to_pylist()), cod)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cod = codec(tokenizer_path)
        for batch in batches:
            for row, key, text in zip(*(batch.column(c).to_pylist() for c in ("id", "copy", "text")), strict=True):
                cols: list[list] = [[], [], [], [], []]
                held = 0
                for seq, (kind, piece) in enumerate(text_pieces(text, leaf_chars, cod.words)):
                    for c, v in zip(cols, (row, key, seq, kind, piece), strict=True):
                        c.append(v)
                    held += len(piece)
                    if held > 1 << 22:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (batch.schema.field("id").type, pa.int64(), pa.int32(), pa.string(), pa.string()), strict=True)], ["id", "copy", "seq", "kind", "piece"])
                        cols, held = [[], [], [], [], []], 0
                if cols[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (batch.schema.field("id").type, pa.int64(), pa.int32(), pa.string(), pa.string()), strict=True)], ["id", "copy", "seq", "kind", "piece"])

    def encode_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cod = codec(tokenizer_path)
        for batch in batches:
            for part in slices(batch, "piece"):
                kinds, pieces = part.column("kind").to_pylist(), part.column("piece").to_pylist()
                texts = iter(cod.encode([p for k, p in zip(kinds, pieces, strict=True) if k in ("text", "special")]))
                ids = [
                    next(texts) if k in ("text", "special") else pa.array(cod.piece(p, k != "half"), pa.int32()).buffers()[1].to_pybytes()
                    for k, p in zip(kinds, pieces, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("id", "copy", "seq", "kind")), pa.array(ids, pa.binary())],
                    ["id", "copy", "seq", "kind", "ids"],
                )

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cod = codec(tokenizer_path)
        for batch in batches:
            for i in range(batch.num_rows):
                out_ids: list[bytes] = []
                leaves: list[list[int]] = []
                copies = 0
                seen = -1
                for p in batch.column("pieces")[i].as_py():
                    copies += p["seq"] == 0
                    if p["seq"] == seen:  # an equal row's piece
                        continue
                    seen = p["seq"]
                    if p["kind"] in ("half", "last"):
                        leaves.append(_list_array([p["ids"]]).values.to_pylist())
                    else:
                        out_ids.append(p["ids"])
                    if p["kind"] == "last":
                        out_ids.append(pa.array(cod.concatenate(leaves), pa.int32()).buffers()[1].to_pybytes())
                        leaves = []
                one = finished(batch.column("id").slice(i, 1), [b"".join(out_ids)], cod)
                for _ in range(copies):
                    yield one

    short = docs.where(F.length("text") <= leaf_chars).mapInArrow(encode_short, out)
    pieces = (
        docs.where(F.length("text") > leaf_chars)
        .withColumn("copy", F.xxhash64("text"))
        .mapInArrow(cut, f"id {id_type}, copy bigint, seq int, kind string, piece string")
        # Pieces of one long text go to different tasks.
        .repartition(F.col("id"), F.col("copy"), F.col("seq"))
        .mapInArrow(encode_pieces, f"id {id_type}, copy bigint, seq int, kind string, ids binary")
    )
    # One group is one document: no larger than a row that the input holds.
    long = (
        pieces.groupBy("id", "copy")
        .agg(F.sort_array(F.collect_list(F.struct("seq", "kind", "ids"))).alias("pieces"))
        .select("id", "pieces")
        .mapInArrow(gather, out)
    )
    return short.unionByName(long).withColumnRenamed("id", id_col)
