"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints are 64-bit majority votes over the XXH64 of word shingles.  Two
fingerprints within ``radius`` bits agree on all bits of at least
``BLOCKS - radius`` of the ``BLOCKS`` blocks that their bits are cut into; for
every choice of that many blocks, fingerprints with equal bits there meet in
a bucket.  Only distinct fingerprints are compared, so exact copies cost
nothing more.

Buckets lie side by side in one sorted run of rows, and a slice of the run is
compared by bit planes: plane p holds bit p of every fingerprint, 64 of them
to a word.  The planes xor the planes moved by d rows give, for all pairs d
rows apart at once, the differing bits; carry-save counters add them up
vertically, and a shift is abandoned once all of its pairs exceed the radius.
Of the links found, a task passes on a spanning forest.

A bucket with more than ``CHUNK`` fingerprints is dealt out in chunks, every
pair of chunks to a task of its own, so no group has to fit a task.

Edge cases: a text without words (null, empty, white space) has fingerprint
zero and is linked like any other; with fewer words than a shingle has, the
whole sequence is the shingle.  Rows with a null id get their fingerprint's
component; ids may repeat.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import free_name, slices, small_batches
from tierline.llm.components import components
from tierline.sources.sinks import stage_table

SHINGLE = 3
RADIUS = 2
SEED = 42
BLOCKS = 4
#: Fingerprints of a bucket that one task compares with each other.
CHUNK = 2048
#: Rows of buckets compared at once.
SLICE_ROWS = 1 << 16
ONE = np.uint64(1)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text, as an unsigned number."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    width = min(shingle, len(words))
    stops = ends[width - 1 :].tolist()
    starts = [0, *(ends[: len(stops) - 1] + 1).tolist()]
    votes = np.zeros(64, np.int64)
    for i in range(0, len(stops), 1 << 16):
        some = zip(starts[i : i + (1 << 16)], stops[i : i + (1 << 16)], strict=True)
        votes += _bit_counts(np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in some], dtype="<u8"))
    return int(np.packbits(votes * 2 > len(stops), bitorder="little").view("<u8")[0])


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.add.reduce(bits, axis=0, dtype=np.int64)


def row_key(id_col: str, text_col: str) -> Column:
    """A digest that tells rows apart by id and text."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in (id_col, text_col)]
    return F.unhex(F.md5(F.concat_ws("\x01", *parts).cast("binary")))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, row_key, fp): the signed 64-bit value of every row's fingerprint."""
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                fps = np.array([fingerprint(t, shingle) for t in part.column("text").to_pylist()], dtype="<u8")
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("row_key"), pa.array(fps.view("<i8"))], ["id", "row_key", "fp"])

    picked = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("row_key"), F.col(text_col).alias("text"))
    return picked.mapInArrow(run, f"id {kind}, row_key binary, fp bigint")


def planes(fps: np.ndarray) -> np.ndarray:
    """Bit planes of uint64 fingerprints: row p holds bit p of all of them,
    64 to a word, one word of zeros at the end."""
    words = len(fps) // 64 + 2
    padded = np.zeros(words * 64, "<u8")
    padded[: len(fps)] = fps
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def shifted(p: np.ndarray, d: int) -> np.ndarray:
    """The planes moved by d rows: lane i holds what lane i + d held."""
    k, r = divmod(d, 64)
    out = np.zeros_like(p)
    out[:, : p.shape[1] - k] = p[:, k:]
    if r:
        out >>= np.uint64(r)
        out[:, : p.shape[1] - k - 1] |= p[:, k + 1 :] << np.uint64(64 - r)
    return out


def within(differ: np.ndarray, lanes: np.ndarray, radius: int) -> np.ndarray:
    """Of the lanes, those with at most ``radius`` bits set over all planes,
    counted by carry-save adders; gives up once no lane is left."""
    width = radius.bit_length()
    counters = [np.zeros_like(lanes) for _ in range(width)]
    beyond = np.zeros_like(lanes)

    def exceeds() -> np.ndarray:
        more, equal = beyond.copy(), ~np.zeros_like(lanes)
        for bit in reversed(range(width)):  # counter > radius, from the top
            if radius >> bit & 1:
                equal &= counters[bit]
            else:
                more |= equal & counters[bit]
                equal &= ~counters[bit]
        return more

    for i, plane in enumerate(differ):
        carry = plane
        for c in range(width):
            counters[c], carry = counters[c] ^ carry, counters[c] & carry
        beyond |= carry
        if i % 8 == 7 and not (lanes & ~exceeds()).any():
            return np.zeros_like(lanes)
    return lanes & ~exceeds()


def links(fps: np.ndarray, group: np.ndarray, part: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) of rows in one group at most ``radius`` bits apart.
    ``group`` numbers runs of rows.  ``part`` 2 marks rows of a bucket's
    second chunk: pairs within one chunk of a two-chunk task are left to the
    task that compares the chunk with itself (all its rows have part 0)."""
    found_i, found_j = [], []
    rows = np.arange(len(fps))
    size = np.bincount(group)[group] if len(group) else np.zeros(0, int)
    first = np.zeros(len(fps), np.int64)
    if len(fps):
        begins = np.r_[True, group[1:] != group[:-1]]
        first = np.maximum.accumulate(np.where(begins, rows, 0))
    last = first + size  # exclusive
    d = 1
    p = None
    while len(rows):
        keep = size[rows] > d
        if p is None or keep.mean() < 0.7:  # compress to the runs that are long enough
            rows = rows[keep]
            if not len(rows):
                break
            p = planes(fps[rows])
        lanes_ok = np.zeros(p.shape[1] * 64, bool)
        ahead = rows + d < last[rows]
        i = np.flatnonzero(ahead)
        ok = (part[rows[i]] == part[rows[i] + d]) & (part[rows[i]] == 0) | (part[rows[i]] != part[rows[i] + d])
        lanes_ok[i[ok]] = True
        if lanes_ok.any():
            lanes = np.packbits(lanes_ok, bitorder="little").view("<u8")
            hit = np.unpackbits(within(p ^ shifted(p, d), lanes, radius).view(np.uint8), bitorder="little")
            at = np.flatnonzero(hit)
            found_i.append(rows[at])
            found_j.append(rows[at] + d)
        d += 1
    none = np.zeros(0, np.int64)
    return np.concatenate(found_i or [none]), np.concatenate(found_j or [none])


def forest(i: np.ndarray, j: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The same components with a link from each row to its smallest one."""
    root = np.arange(n)
    while len(i):
        a, b = root[i], root[j]
        low = np.minimum(a, b)
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            break
    moved = np.flatnonzero(root != np.arange(n))
    return moved, root[moved]


def bucket_links(pairs: DataFrame, radius: int) -> DataFrame:
    """``pairs``: rows (bucket columns, fp, part), sorted within partitions by
    bucket; -> links (a, b) that span what is within the radius."""

    def compare(keys: np.ndarray, fps: np.ndarray, part: np.ndarray) -> pa.RecordBatch:
        group = np.cumsum(np.r_[False, (keys[1:] != keys[:-1]).any(axis=1)]) if len(fps) else np.zeros(0, int)
        i, j = forest(*links(fps, group, part, radius), len(fps))
        signed = fps.view("<i8")
        differ = signed[i] != signed[j]
        return pa.RecordBatch.from_arrays([pa.array(signed[i][differ]), pa.array(signed[j][differ])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def arrays() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            t = pa.Table.from_batches(held)
            keys = np.stack([t.column(c).to_numpy() for c in ("scheme", "bucket", "x", "y")], axis=1)
            return keys, t.column("fp").to_numpy().astype("<i8").view("<u8"), t.column("part").to_numpy()

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) < SLICE_ROWS:
                continue
            keys, fps, part = arrays()
            changes = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1))
            if len(changes):  # the last run may go on in the next batch
                cut = int(changes[-1]) + 1
                yield compare(keys[:cut], fps[:cut], part[:cut])
                held = pa.Table.from_batches(held).slice(cut).combine_chunks().to_batches()
        if held:
            yield compare(*arrays())

    return pairs.select("scheme", "bucket", "x", "y", "fp", "part").mapInArrow(run, "a bigint, b bigint")


def fingerprint_links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``fps``: distinct (fp).  -> (a, b): links that connect exactly the
    fingerprints connected by steps of at most ``radius`` bits."""
    blocks = max(BLOCKS, radius + 1)
    edges = [64 * i // blocks for i in range(blocks + 1)]
    schemes = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum(((1 << edges[b + 1]) - 1) ^ ((1 << edges[b]) - 1) for b in chosen)
        mask -= (mask >> 63) << 64  # as a signed number
        schemes.append(F.struct(F.lit(number).alias("scheme"), F.col("fp").bitwiseAND(F.lit(mask)).alias("bucket")))
    dealt = fps.select("fp", F.inline(F.array(*schemes)))
    counts = dealt.groupBy("scheme", "bucket").agg(F.count("*").alias("n")).where("n > 1")
    n_chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    shared = (
        dealt.join(counts, ["scheme", "bucket"])
        .withColumn("chunks", n_chunks)
        .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
        # Chunk x meets every chunk y: one task's rows for each pair (x, y).
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(
            "scheme",
            "bucket",
            F.least("own", "other").alias("x"),
            F.greatest("own", "other").alias("y"),
            "fp",
            F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("part"),
        )
    )
    keys = ["scheme", "bucket", "x", "y"]
    dealt_out = shared.repartition(*[F.col(c) for c in keys]).sortWithinPartitions(*keys)
    return bucket_links(dealt_out, radius)


def clusters(own: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``own`` (id, fp, ...) -> (fp, root, component_id) for every fingerprint:
    ``root`` names its component, ``component_id`` is the smallest id in it
    (null if all are null)."""
    nodes = own.groupBy("fp").agg(F.min("id").alias("least"))
    roots = components(fingerprint_links(nodes.select("fp"), radius))
    labelled = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    return labelled.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
) -> DataFrame:
    """(id, row_key, fp, root, component_id) for every row, see
    :func:`clusters`."""
    own = stage_table(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    return own.join(clusters(own, radius), "fp")


def keep_one(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest id
    (nulls last; of several with that id, the smallest digest of the row's
    text; of rows equal in id and text, any one)."""
    own = stage_table(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    # The first row of a fingerprint, before fingerprints meet: however many
    # copies a text has, one row of it goes on.
    place = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row_key")).alias("first")
    firsts = own.groupBy("fp").agg(place).join(clusters(own, radius), "fp")
    kept_rows = firsts.groupBy("root").agg(F.min("first").alias("first"))
    key, kept = free_name("row_key", docs.columns), free_name("kept_key", docs.columns)
    marked = docs.withColumn(key, row_key(id_col, text_col))
    rows = marked.join(kept_rows.select(F.col("first.row_key").alias(kept)), F.col(key) == F.col(kept), "left_semi")
    return rows.dropDuplicates([key]).select(*[F.col(f"`{c}`") for c in docs.columns])
