"""Merkle manifest of a table: a root digest for all of it, and for every row
a proof that leads from the row's digest to the root.

Rows are leaves.  Leaves of one group (here: a language) stand in order; every
``FANOUT`` consecutive nodes become one node, level by level, until one is
left, the group's subroot; the subroots, in order of their groups, make a tree
of the same kind, whose last node is the root.  A node is the digest of its
children's hex digests, concatenated; the last run of a level may be short,
even a single node, and is hashed all the same.

Method: a leaf's rank, written in base ``FANOUT``, is its way down the tree.
Blocks of ``FANOUT ** DIGITS`` leaves are brought together by one shuffle; in a
block the rank's digits are grouped away one after the other, lowest first,
each grouping nesting the sorted child structs in their parent's.  Block nodes
are the leaves of the next round, until every group is one block.  On the way
back a block learns the proof of its own node by a union and a grouping (no
join), and ``transform`` and ``explode`` hand it down through the nested
structs: every child gets its siblings in front of its parent's proof.

Scale: no group, language or tree is ever in one task.  Ranks come from a range
partitioning by (group, order, leaf, row) and counts per partition, so neither
a group with a third of all rows nor equal rows meet in one task; a nested
block is bounded by ``FANOUT ** DIGITS`` leaves, a proof by the tree's height.
The number of rounds is the logarithm of the largest group.  Each round's
blocks are written to the shared folder, so a lost executor costs no more than
its part of a round.

Edge cases: null values are a ``-``; a null group is a group of its own, the
first; a null order comes first.  Rows of equal order stand in order of their
digests, equal rows are leaves of their own (with equal digests, but proofs of
their own).  Empty and very long texts are values like any other.  An empty
table gives an empty result.  Other columns of the input are not looked at;
inside, all columns have names of their own, so none can clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.common import ascii_lower
from tierline.sources.sinks import stage_table

FANOUT = 8
#: Digits of a rank that one round groups away; a block holds
#: ``FANOUT ** DIGITS`` nodes.
DIGITS = 4


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of strings, concatenated."""
    return F.sha2(F.concat(*parts), 256)


def value(c: Column) -> Column:
    """A value in a leaf: ``-`` if null, else its UTF-8 bytes, counted."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: Sequence[Column]) -> Column:
    """Digest of a row."""
    return digest(*[value(c) for c in columns])


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf's digest and its proof lead to."""
    return F.aggregate(path, start, lambda acc, step: digest(step["before"], acc, step["after"]))


def siblings(path: Column) -> Column:
    """The siblings' digests in a proof, level by level, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "")


def _ranked(rows: DataFrame) -> DataFrame:
    """``rows`` (grp, ord, node, item) -> (grp, n, rank, node, item): place of
    a row in its group, from 0, and the group's size."""
    # Equal rows get different numbers, so that they are dealt out as well.
    rows = stage_table(rows, "merkle-rows").withColumn("row", F.monotonically_increasing_id())
    dealt = rows.repartitionByRange("grp", "ord", "node", "row").withColumn("part", F.spark_partition_id())
    dealt = stage_table(dealt, "merkle-dealt")
    earlier = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        dealt.groupBy("grp", "part")
        .agg(F.count(F.lit(1)).alias("here"))
        .select(
            F.col("grp").alias("of_grp"),
            F.col("part").alias("of_part"),
            F.sum("here").over(Window.partitionBy("grp")).alias("n"),
            F.coalesce(F.sum("here").over(earlier), F.lit(0)).alias("before"),
        )
    )
    inside = F.row_number().over(Window.partitionBy("grp", "part").orderBy("ord", "node", "row")) - 1
    return (
        dealt.withColumn("inside", inside)
        .join(parts, F.col("grp").eqNullSafe(F.col("of_grp")) & (F.col("part") == F.col("of_part")))
        .select("grp", "n", (F.col("before") + F.col("inside")).alias("rank"), "node", "item")
    )


def _blocks(nodes: DataFrame, digits: int) -> DataFrame:
    """``nodes`` (grp, n, rank, node, item) -> one row per block: (grp, n,
    rank of the block, node, kids), the nodes below nested in ``kids``."""
    names = [f"d{k}" for k in range(digits)]
    rows = nodes.select(
        "grp",
        "n",
        F.floor(F.col("rank") / FANOUT**digits).alias("block"),
        *[(F.floor(F.col("rank") / FANOUT**k) % FANOUT).cast("int").alias(names[k]) for k in range(digits)],
        "node",
        F.col("item").alias("kids"),
    ).repartition("grp", "block")  # all groupings below keep to this
    for k in range(digits):
        kids = F.sort_array(F.collect_list(F.struct(F.col(names[k]).alias("digit"), "node", "kids")))
        rows = rows.groupBy("grp", "n", "block", *names[k + 1 :]).agg(kids.alias("kids"))
        # A level with a single node is the tree's top: nothing to hash.
        parent = F.sha2(F.array_join(F.col("kids")["node"], ""), 256)
        rows = rows.withColumn("node", F.when(F.col("n") > FANOUT**k, parent).otherwise(F.col("kids")[0]["node"]))
    return rows.select("grp", "n", F.col("block").alias("rank"), "node", "kids")


def _climb(nodes: DataFrame, digits: int) -> tuple[list[DataFrame], DataFrame]:
    """Rounds of blocks up to one block per group, and (grp, node) of these."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    rounds: list[DataFrame] = []
    while True:
        blocks = stage_table(_blocks(nodes, digits), "merkle-blocks")
        rounds.append(blocks)
        most = -(-most // FANOUT**digits)
        if most <= 1:
            return rounds, blocks.select("grp", "node")
        nodes = blocks.select("grp", F.ceil(F.col("n") / FANOUT**digits).alias("n"), "rank", "node", F.col("rank").alias("item"))


def _children(k: int) -> Column:
    """The child structs of a row (n, kids, path), each with its own path."""
    nodes = F.col("kids")["node"]

    def child(kid: Column, i: Column) -> Column:
        step = F.struct(
            F.array_join(F.slice(nodes, F.lit(1), i), "").alias("before"),
            F.array_join(F.slice(nodes, i + 2, F.lit(FANOUT)), "").alias("after"),
        )
        path = F.when(F.col("n") > FANOUT**k, F.concat(F.array(step), F.col("path"))).otherwise(F.col("path"))
        return F.struct(kid["kids"].alias("kids"), kid["node"].alias("node"), path.alias("path"))

    return F.transform("kids", child)


def _descend(rounds: list[DataFrame], proofs: DataFrame, digits: int) -> DataFrame:
    """``proofs`` (grp, subroot, root, path), one row per group -> (grp, item,
    node, subroot, root, path) of every leaf."""
    proofs = proofs.withColumn("rank", F.lit(0).cast("long"))
    for blocks in reversed(rounds):
        # A block meets its own proof: one of each per (grp, rank).
        both = blocks.select("grp", "rank", "n", "kids").unionByName(proofs, allowMissingColumns=True)
        rows = both.groupBy("grp", "rank").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("n", "kids", "subroot", "root", "path")])
        for k in reversed(range(digits)):
            rows = rows.select("grp", "n", "subroot", "root", F.inline(_children(k)))
        proofs = rows.select("grp", F.col("kids").alias("rank"), "subroot", "root", "path")
    return rows.select("grp", F.col("kids").alias("item"), "node", "subroot", "root", "path")


def manifest(rows: DataFrame, group: Column, order: Column, leaf: Column, item: Column, digits: int = DIGITS) -> DataFrame:
    """(item, leaf, subroot, root, path) for every row; ``item`` is what the
    caller wants back (keep it small, it travels with the leaf), ``path`` the
    proof: an array of (before, after), the joined hex digests of the siblings
    to either side, from the leaf's level to the root's."""
    leaves = rows.select(group.alias("grp"), order.alias("ord"), leaf.alias("node"), item.alias("item"))
    rounds, subroots = _climb(_ranked(leaves), digits)
    # The subroots are the leaves of the upper tree, their groups its items.
    # A field of a struct, as a group may be null.
    upper = subroots.select(F.lit(0).alias("grp"), F.col("grp").alias("ord"), "node", F.struct("grp").alias("item"))
    upper_rounds, root = _climb(_ranked(upper), digits)
    no_steps = F.array().cast("array<struct<before:string,after:string>>")
    top = root.select("grp", F.lit("").alias("subroot"), F.col("node").alias("root"), no_steps.alias("path"))
    groups = _descend(upper_rounds, top, digits)
    seeds = stage_table(groups.select("item.grp", F.col("node").alias("subroot"), "root", "path"), "merkle-groups")
    found = _descend(rounds, seeds, digits)
    return found.select("item", F.col("node").alias("leaf"), "subroot", "root", "path")


#: What a leaf of the documents table is the digest of, in this order.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def document_manifest(docs: DataFrame, digits: int = DIGITS) -> DataFrame:
    """The manifest of documents, and a check of it: (doc_id, leaf, subroot,
    root, path, tampered).  ``tampered`` is the digest of the row with its
    text's A-Z lower-cased where 3 divides crc32(doc_id as text), else null."""
    columns = {c: F.col(c) for c in LEAF_COLUMNS}
    chosen = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    changed = leaf(list((columns | {"text": ascii_lower(F.col("text"))}).values()))
    # Leaves as struct fields, so that no name of the input plays a part.
    item = F.struct(F.col("doc_id"), F.when(chosen, changed).alias("tampered"))
    out = manifest(docs, F.col("lang"), F.col("doc_id"), leaf(list(columns.values())), item, digits)
    return out.select("item.doc_id", "leaf", "subroot", "root", "path", "item.tampered")
