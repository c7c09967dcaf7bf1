"""Benchmark decontamination by a prefix-filtered set join.

Windows of an item are runs of ``window`` consecutive item words (the whole
item, if it has fewer).  A window is a set of word shingles.  As all of a
window's shingles must occur, a prefix of one shingle is necessary: the one
that the documents hold least often.

1. Every document position whose shingle hash is one of the benchmark's is
   found in one pass over the texts, by hash joins against broadcast blocks of
   the benchmark's shingles (each block has at most ``BLOCK`` rows; larger
   benchmarks take more passes).  Such a position keeps the words around it.
2. Occurrences are counted by shingle; windows take the rarest one.
3. Windows meet the occurrences of their rarest shingle only.  The shingle's
   place in the window fixes where the window would start (positional bound)
   and end (length bound); the words there are compared with the window's.

Everything on this path is DataFrame expressions.

Edge cases: null and empty texts have no words, are never hit and not
contaminated; items without words have no windows and null item ids take no
part in ``items``.  Rows that repeat a document id are judged each by its own
text; items that repeat an id count once.  Empty tables give no hits or no
rows.  Other columns of the inputs are not looked at.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.common import ascii_lower, free_name
from tierline.sources.sinks import stage_table

WINDOW = 13
SHINGLE = 5
#: A document with at least one hit word in so many words is contaminated.
ONE_IN = 20
#: Rows of a broadcast block (a hash, a length: some 16 bytes each).
BLOCK = 1_000_000
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words before A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """A-Z lower-cased; digits, a-z and all non-ASCII characters are letters
    of words."""
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD), lambda w: w != "")


def _shingle_hash(ws: Column, at: Column, length: int) -> Column:
    return F.xxhash64(*[F.get(ws, at + i) for i in range(length)])


def item_windows(items: DataFrame, item_col: str, text_col: str, window: int, shingle: int) -> DataFrame:
    """One row per distinct window of an item and shingle in it: item_id,
    window_words, q (the shingle's length), offset (its place in the window),
    hash."""
    ws = items.select(F.col(item_col).alias("item_id"), words(F.col(text_col)).alias("ws")).where(F.size("ws") > 0)
    size = F.least(F.size("ws"), F.lit(window))
    windows = (
        ws.withColumn("start", F.explode(F.sequence(F.lit(0), F.size("ws") - size)))
        .select("item_id", F.slice("ws", F.col("start") + 1, size).alias("window_words"))
        .distinct()
    )
    q = F.least(F.size("window_words"), F.lit(shingle))
    shingles = windows.withColumn("q", q).withColumn(
        "offset", F.explode(F.sequence(F.lit(0), F.size("window_words") - F.col("q")))
    )
    hashes = reduce(
        lambda other, n: F.when(F.col("q") == n, _shingle_hash(F.col("window_words"), F.col("offset"), n)).otherwise(other),
        range(1, shingle),
        _shingle_hash(F.col("window_words"), F.col("offset"), shingle),
    )
    return shingles.withColumn("hash", hashes)


def occurrences(docs: DataFrame, shingles: DataFrame, window: int, shingle: int) -> DataFrame:
    """``docs`` (doc, text_key, ws) against distinct ``shingles`` (q, hash):
    doc, text_key, n_words, pos, q, hash, from_pos and near (the words from
    there on: all that a window with this shingle can cover)."""
    stats = {r["q"]: r["n"] for r in shingles.groupBy("q").agg(F.count("*").alias("n")).collect()}  # at most `shingle` rows
    found = []
    for q, n in sorted(stats.items()):
        blocks = -(-n // BLOCK)
        for block in range(blocks):
            some = shingles.where((F.col("q") == q) & (F.pmod(F.col("hash"), F.lit(blocks)) == block)).select("hash")
            at = docs.select("doc", "text_key", "ws", F.posexplode("ws").alias("pos", "word"))
            hit = at.where(F.col("pos") + q <= F.size("ws")).withColumn("hash", _shingle_hash(F.col("ws"), F.col("pos"), q))
            reach = max(0, window - q) if q == shingle else 0
            first = F.greatest(F.col("pos") - reach, F.lit(0))
            found.append(
                hit.join(F.broadcast(some), "hash").select(
                    "doc",
                    "text_key",
                    F.size("ws").alias("n_words"),
                    "pos",
                    F.lit(q).alias("q"),
                    "hash",
                    first.alias("from_pos"),
                    F.slice("ws", first + 1, F.col("pos") - first + q + reach).alias("near"),
                )
            )
    if not found:
        empty = docs.select("doc", "text_key", F.size("ws").alias("n_words"), F.lit(0).alias("pos"), F.lit(0).alias("q"))
        return empty.select("*", F.lit(0).cast("long").alias("hash"), F.lit(0).alias("from_pos"), F.array(F.lit("")).alias("near")).limit(0)
    return reduce(DataFrame.unionByName, found)


def contained_windows(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
) -> DataFrame:
    """Distinct (doc, text_key, item_id, start, length): where windows of items
    occur in documents."""
    windows = stage_table(item_windows(items, item_col, item_text_col, window, shingle), "windows")
    prepared = docs.select(
        F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("text_key"), words(F.col(text_col)).alias("ws")
    )
    found = stage_table(occurrences(prepared, windows.select("q", "hash").distinct(), window, shingle), "occurrences")
    # Rarity: how often the documents hold each shingle; most hold none.
    counts = found.groupBy("q", "hash").agg(F.count("*").alias("n"))
    ranked = windows.join(counts, ["q", "hash"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    prefix = (
        ranked.groupBy("item_id", "window_words", "q")
        .agg(F.min(F.struct("n", "offset", "hash")).alias("rarest"))
        .where("rarest.n > 0")
        .select("item_id", "window_words", "q", F.col("rarest.offset").alias("offset"), F.col("rarest.hash").alias("hash"))
    )
    start = F.col("pos") - F.col("offset")
    size = F.size("window_words")
    return (
        found.join(prefix, ["q", "hash"])
        .where((start >= 0) & (start + size <= F.col("n_words")))
        .where(F.slice("near", start - F.col("from_pos") + 1, size) == F.col("window_words"))
        .select("doc", "text_key", "item_id", start.alias("start"), size.alias("length"))
        .distinct()
    )


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
    one_in: int = ONE_IN,
) -> DataFrame:
    """``docs`` with n_words, n_hit, items (sorted ids, as strings) and
    contaminated; input columns with these names are replaced."""
    hits = contained_windows(docs, items, id_col, text_col, item_col, item_text_col, window, shingle)
    hits = stage_table(hits, "hits")
    # Words hit: the length of the union of the windows.
    spans = hits.groupBy("doc", "text_key", "start").agg(F.max(F.col("start") + F.col("length")).alias("stop"))
    before = Window.partitionBy("doc", "text_key").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    covered = F.greatest(F.col("start"), F.coalesce(F.max("stop").over(before), F.lit(0)))
    n_hit = (
        spans.withColumn("new", F.greatest(F.col("stop") - covered, F.lit(0)))
        .groupBy("doc", "text_key")
        .agg(F.sum("new").alias("n_hit"))
    )
    by_doc = (
        hits.where("item_id is not null").groupBy("doc", "text_key").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    )
    found = n_hit.join(
        by_doc.select(F.col("doc").alias("doc_"), F.col("text_key").alias("key_"), "items"),
        F.col("doc").eqNullSafe(F.col("doc_")) & (F.col("text_key") == F.col("key_")),
        "left",
    ).select(F.struct("doc", "text_key").alias("found_key"), "n_hit", "items")
    kept = [c for c in docs.columns if c not in ("n_words", "n_hit", "items", "contaminated")]
    mark = free_name("row_of", docs.columns)
    n_words = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long")
    # Counted before the join, so that the texts take part in it only if they
    # are asked for.
    rows = docs.withColumns(
        {mark: F.struct(F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("text_key")), "words_" + mark: n_words}
    )
    joined = rows.join(
        found.select(F.col("found_key").alias("found_" + mark), F.col("n_hit").alias("hit_" + mark), F.col("items").alias("items_" + mark)),
        F.col(mark).eqNullSafe(F.col("found_" + mark)),
        "left",
    )
    return joined.select(
        *[F.col(f"`{c}`") for c in kept],
        F.col("words_" + mark).alias("n_words"),
        F.coalesce(F.col("hit_" + mark), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.col("items_" + mark), F.array().cast("array<string>")).alias("items"),
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * one_in >= F.col("n_words")))
