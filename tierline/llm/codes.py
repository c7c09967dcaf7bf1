"""Vector code compression: every vector becomes one entry number per part.

Vectors are scaled to integers and cut into equal parts; each part position
has a codebook, refined by rounds of "nearest entry, then mean of the parts
that chose it".  All arithmetic that decides anything is on integers, so the
result depends neither on the order of rows nor on the number of tasks.

Method (norm-of-sum bounds): for every vector and part, the entries other than
the chosen one are taken in ``groups``, and a lower bound of the distance to
the nearest entry of a group is kept with the *stamp* of the round in which it
was measured.  The history of codebooks is kept as well, so a later round
lowers a bound by the true net displacement of the group's entries since the
stamp, |c(now) - c(stamp)|.  That is never more than the sum of the
round-by-round drifts, which a bound without a stamp would be lowered by, and
is nothing at all for an entry that came back.  The distance to the chosen
entry is computed exactly; only groups whose bound does not clear it are
scanned again, exactly, and get a fresh bound and stamp.

Scale: vectors are never shuffled.  A round is one pass over the rows with
their state (entry numbers, bounds, stamps: written to the shared folder, so a
lost executor costs its part of a round) and one narrow pass that adds up the
parts of each entry inside tasks; a task sends one row per (part, entry).  The
driver holds the codebooks, whose size is that of ``entries`` vectors.

Edge cases: rows whose vector is null or empty, or holds null, NaN or infinite
components, are dropped.  So are, as no codebook could hold them too, vectors
of another length than the table's most frequent one (of equally frequent
ones, the longest).  Fewer vectors than entries give smaller codebooks.  Rows
with equal ids stand in order of their components among the first entries, a
null id last; equal rows give equal rows.  Labels may be null.  An empty table
gives an empty result.  Components are floored, negative ones down.  It raises
if the length is no multiple of ``parts``, or if components are so large that
a squared distance does not fit 64 bits.  Other columns of the input are not
looked at, and those of the work have names of their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tierline.operators.mart import salted_join
from tierline.sources.sinks import stage_table

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Groups of entries that have a bound in common.
GROUPS = 4
#: Components that a task works on at once.
COMPONENTS = 1 << 22

#: Bounds give way by this much, relatively, for rounding in square roots.
_SLACK = 1e-9


@dataclass
class State:
    """What a block of vectors carries from round to round, per part: chosen
    entry; per group the lower bound and the round it was measured in."""

    chosen: np.ndarray  # (n, parts) uint8
    low: np.ndarray  # (n, parts, groups) float32
    stamp: np.ndarray  # (n, parts, groups) uint8


def group_slices(entries: int, groups: int) -> list[slice]:
    size = -(-entries // groups)
    return [slice(s, min(s + size, entries)) for s in range(0, entries, size)]


def net_displacements(history: list[np.ndarray], slices: list[slice]) -> np.ndarray:
    """(round, parts, groups): how far the group's entries lie at most from
    where they were in that round; rounded up."""
    now = history[-1].astype(np.float64)
    out = np.zeros((len(history), now.shape[0], len(slices)))
    for t, book in enumerate(history[:-1]):
        moved = np.sqrt(((now - book) ** 2).sum(axis=2)) * (1 + _SLACK)
        for g, s in enumerate(slices):
            out[t, :, g] = moved[:, s].max(axis=1)
    return out


def _squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """(n, entries) exact squared distances of integers."""
    out = np.zeros((len(x), len(entries)), x.dtype)
    for k in range(x.shape[1]):
        step = x[:, k, None] - entries[None, :, k]
        out += step * step
    return out


def assign(x: np.ndarray, history: list[np.ndarray], state: State | None, groups: int = GROUPS) -> tuple[State, np.ndarray, int]:
    """Nearest entries of ``x`` (n, parts, width) in the last codebooks
    (parts, entries, width) of ``history`` -> the new state, the squared
    distances (n, parts), and the number of distances computed."""
    n, parts, _ = x.shape
    now, book = len(history) - 1, history[-1].astype(x.dtype)
    entries = book.shape[1]
    slices = group_slices(entries, groups)
    size = slices[0].stop
    # Integers up to 2**53 are exact as doubles, whose sums are faster.
    none = np.iinfo(np.int64).max if x.dtype == np.int64 else np.inf
    first = state is None
    if first:
        state = State(np.zeros((n, parts), np.uint8), np.zeros((n, parts, len(slices)), np.float32), np.zeros((n, parts, len(slices)), np.uint8))
    else:
        state = State(state.chosen.copy(), state.low.copy(), state.stamp.copy())
    moved = net_displacements(history, slices)
    found = np.empty((n, parts), x.dtype)
    scanned = 0
    for p in range(parts):
        part = x[:, p]
        before = state.chosen[:, p].astype(np.int64)
        if first:
            best = np.full(n, none, x.dtype)
            chosen = np.full(n, entries, np.int64)
            bound = None
            need = np.ones((n, len(slices)), bool)
        else:
            best = ((part - book[p, before]) ** 2).sum(axis=1)
            chosen = before.copy()
            scanned += n
            bound = state.low[:, p].astype(np.float64) - moved[state.stamp[:, p], p, np.arange(len(slices))]
            need = bound * (1 - _SLACK) <= np.sqrt(best.astype(np.float64))[:, None] * (1 + _SLACK)
        own = best.copy()
        nearest: list[tuple] = []
        for g, s in enumerate(slices):
            rows = np.flatnonzero(need[:, g])
            if not rows.size:
                continue
            away = _squared(part[rows], book[p, s])
            scanned += away.size
            at = away.argmin(axis=1)
            line = np.arange(len(rows))
            least = away[line, at]
            away[line, at] = none
            second = away.min(axis=1)  # none, where the group has one entry
            entry = at + s.start
            better = (least < best[rows]) | ((least == best[rows]) & (entry < chosen[rows]))
            best[rows[better]] = least[better]
            chosen[rows[better]] = entry[better]
            nearest.append((g, rows, entry, least, second))
        for g, rows, entry, least, second in nearest:
            low = np.where(entry == chosen[rows], second, least).astype(np.float64)
            low[low >= float(none)] = np.inf
            state.low[rows, p, g] = np.nextafter(np.sqrt(low).astype(np.float32), np.float32(-np.inf))
            state.stamp[rows, p, g] = now
        if not first:
            # The entry left behind is one of the others of its group now.
            left = before // size
            rows = np.flatnonzero((chosen != before) & ~need[np.arange(n), left])
            g = left[rows]
            low = np.minimum(bound[rows, g], np.sqrt(own[rows].astype(np.float64)))
            state.low[rows, p, g] = np.nextafter((low * (1 - _SLACK)).astype(np.float32), np.float32(-np.inf))
            state.stamp[rows, p, g] = now
        state.chosen[:, p] = chosen
        found[:, p] = best
    return state, found, scanned


@dataclass
class Compressed:
    """``rows``: (id, label, codes binary, error); ``books``: the final
    codebooks, (parts, entries, width)."""

    rows: DataFrame
    books: np.ndarray

    def books_sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()


def compress(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    groups: int = GROUPS,
) -> Compressed:
    spark = rows.sparkSession
    if not 0 < entries <= 256 or not 0 < rounds < 256:
        raise ValueError("entries and rounds are kept in a byte")
    vector = F.col("vector")
    good = rows.select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("vector")
    ).where(vector.isNotNull() & (F.size("vector") > 0) & F.forall("vector", lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False))))
    id_type, label_type = (good.schema[c].dataType.simpleString() for c in ("id", "label"))

    size = F.size("vector").alias("size")
    largest = F.max(F.array_max(F.transform("vector", F.abs))).alias("largest")
    common = good.groupBy(size).agg(F.count(F.lit(1)).alias("n"), largest).orderBy(F.desc("n"), F.desc("size")).first()
    if common is None:
        schema = StructType([*good.drop("vector").schema.fields, StructField("codes", StringType()), StructField("error", LongType())])
        return Compressed(spark.createDataFrame([], schema), np.zeros((parts, 0, 0), np.int64))
    if common["size"] % parts:
        raise ValueError(f"vectors of {common['size']} components can't be cut into {parts} equal parts")
    width = common["size"] // parts
    reach = (2 * (scale * common["largest"] + 1)) ** 2 * common["size"]
    if reach >= 2.0**62:
        raise ValueError(f"components up to {common['largest']:g} are too large for 64-bit squared distances")
    exact = np.float64 if reach < 2.0**53 else np.int64

    scaled = good.where(F.size("vector") == common["size"]).select(
        "id", "label", F.transform("vector", lambda v: F.floor(v * scale).cast("int")).alias("x")
    )
    # As many rows as a codebook has entries: a bounded sample by contract.
    start = scaled.orderBy(F.asc_nulls_last("id"), "x").limit(entries).select("x").collect()
    first = np.array([r["x"] for r in start], np.int64).reshape(len(start), parts, width).transpose(1, 0, 2)
    history = [np.ascontiguousarray(first)]
    n_groups = len(group_slices(len(start), groups))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        most = max(1, COMPONENTS // (parts * width))
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                part = batch.slice(at, most)
                yield part, np.asarray(part.column("x").flatten()).astype(exact).reshape(-1, parts, width)

    def packed(values: np.ndarray) -> pa.Array:
        flat = np.ascontiguousarray(values).reshape(len(values), -1)
        return pa.array([r.tobytes() for r in flat], pa.binary())

    def unpacked(column: pa.Array, kind: type, *shape: int) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), *shape)

    def stepper(books: list[np.ndarray], last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, x in blocks(batches):
                state = None
                if len(books) > 1:
                    state = State(
                        unpacked(batch.column("chosen"), np.uint8, parts),
                        unpacked(batch.column("low"), np.float32, parts, n_groups),
                        unpacked(batch.column("stamp"), np.uint8, parts, n_groups),
                    )
                state, away, _ = assign(x, books, state, groups)
                out = {"id": batch.column("id"), "label": batch.column("label")}
                if last:
                    out |= {"codes": packed(state.chosen), "error": pa.array(away.astype(np.int64).sum(axis=1))}
                else:
                    out |= {"x": batch.column("x"), "chosen": packed(state.chosen), "low": packed(state.low), "stamp": packed(state.stamp)}
                yield pa.RecordBatch.from_pydict(out)

        return run

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_entries = len(start)
        count = np.zeros((parts, n_entries), np.int64)
        total = np.zeros((parts, n_entries, width), np.int64)
        for batch, x in blocks(batches):
            chosen = unpacked(batch.column("chosen"), np.uint8, parts)
            whole = x.astype(np.int64)
            for p in range(parts):
                count[p] += np.bincount(chosen[:, p], minlength=n_entries)
                np.add.at(total[p], chosen[:, p], whole[:, p])
        part, entry = np.nonzero(count)
        if len(part):
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array(part.astype(np.int32)),
                    "entry": pa.array(entry.astype(np.int32)),
                    "n": pa.array(count[part, entry]),
                    "total": pa.array(total[part, entry].tolist(), pa.list_(pa.int64())),
                }
            )

    names = f"id {id_type}, label {label_type}"
    state_schema = f"{names}, x array<int>, chosen binary, low binary, stamp binary"
    now = scaled
    for _ in range(rounds):
        now = stage_table(now.mapInArrow(stepper(list(history), False), state_schema), "codes-round")
        # Decimals: sums of any number of rows are exact.
        sums = [F.sum(F.col("total")[k].cast("decimal(38,0)")).alias(f"s{k}") for k in range(width)]
        totals = (
            now.select("x", "chosen")
            .mapInArrow(add_up, "part int, entry int, n bigint, total array<bigint>")
            .groupBy("part", "entry")
            .agg(F.sum("n").alias("n"), *sums)
        )
        book = history[-1].copy()
        for r in totals.collect():  # at most one row per entry of the codebooks
            book[r["part"], r["entry"]] = [int(r[f"s{k}"]) // r["n"] for k in range(width)]
        history.append(book)
    coded = stage_table(now.mapInArrow(stepper(list(history), True), f"{names}, codes binary, error bigint"), "codes")
    return Compressed(coded, history[-1])


def with_label_error(coded: DataFrame) -> DataFrame:
    """Adds ``label_error``: the errors of all rows with the same label, added
    up; null labels are one.  Added up inside tasks first, joined back with
    the rows of a label dealt out to several tasks."""
    keys = {"key": F.coalesce(F.col("label").cast("string"), F.lit("")), "none": F.col("label").isNull()}
    rows = coded.withColumns(keys)
    sums = rows.groupBy("key", "none").agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error"))
    return salted_join(rows, sums, ["key", "none"]).drop("key", "none")
