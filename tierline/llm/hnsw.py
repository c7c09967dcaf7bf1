"""Approximate nearest neighbours by hierarchical small-world graphs.

Equal vectors are one node that knows its smallest ids.  Nodes are dealt to
shards by hash; each shard has a graph of layers, a layer holding one in
``FAN`` of the nodes below it, with the nodes' links in one flat array per
layer (``width`` places a node, -1 for none).  Nodes are inserted in batches: each searches the
graph so far for candidates and takes its links from them by the usual
diversity rule (a candidate closer to a link than to the node is left out at
first); links are mutual, and a node with too many keeps the diverse nearest.

A search starts from the whole top layer (it is small), follows links with a
beam on every layer below, for a block of queries at once, and computes the
cosines of what it ends with from the original vectors in double precision.
Every shard answers for every query: the queries are written to the shared
folder in blocks, a task holds one shard and reads block after block, so
neither the index nor the queries are shuffled, broadcast or collected; only
each shard's best rows are, and they are merged by rank.

Edge cases: vectors that are null, empty, zero or hold null or non-finite
components take no part, nor do rows without an id; a query meets only
vectors of its own length.  Rows that repeat an id and a vector are one; all
rows with the query's id count as its own.  With fewer candidates than asked
for, all are returned.  Empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.common import small_batches
from tierline.session import scratch_path
from tierline.sources.sinks import stage_table

#: Distinct vectors of a shard, on average.
SHARD = 16_384
#: Nodes of a layer for each node in the layer above.
FAN = 16
#: Links of a node: candidates looked at, chosen, and places it has.
CANDIDATES = 48
CHOSEN = 16
PLACES = 32
#: Nodes inserted at once: at first, and at most.
FIRST = 512
BATCH = 2048
#: Beam widths on the upper layers and on the lowest.
BEAM_UPPER = 16
BEAM = 192
#: Nodes or queries looked at at once in a task, and queries of a block.
AT_ONCE = 256
QUERY_BLOCK = 8192


def _diverse(sims: np.ndarray, among: np.ndarray, take: int) -> np.ndarray:
    """Which candidates become links, nearest first (rows of similarities to a
    node, and among each other): not those closer to a link than to the node,
    unless there is room left at the end.  -inf stands for no candidate."""
    picked = np.zeros(sims.shape, bool)
    full = np.zeros(len(sims), np.int32)
    there = np.isfinite(sims)
    for j in range(sims.shape[1]):
        closer = (among[:, j, :] > sims[:, j : j + 1]) & picked
        ok = ~closer.any(axis=1) & (full < take) & there[:, j]
        picked[:, j] = ok
        full += ok
    for j in range(sims.shape[1]):
        ok = ~picked[:, j] & (full < take) & there[:, j]
        picked[:, j] |= ok
        full += ok
    return picked


def _chosen(unit: np.ndarray, own: np.ndarray, cand: np.ndarray, take: int) -> np.ndarray:
    """Links (rows x take, -1 for none) of nodes ``own`` among candidates
    (rows x some, -1 for none, no repeats)."""
    sims = np.where(cand >= 0, np.einsum("qd,qed->qe", unit[own], unit[cand]), -np.inf)
    order = np.argsort(-sims, axis=1, kind="stable")
    cand, sims = np.take_along_axis(cand, order, axis=1), np.take_along_axis(sims, order, axis=1)
    vectors = unit[cand]
    picked = _diverse(sims, np.einsum("qid,qjd->qij", vectors, vectors), take)
    where = np.argsort(~picked, axis=1, kind="stable")[:, :take]
    out = np.take_along_axis(cand, where, axis=1)
    out[~np.take_along_axis(picked, where, axis=1)] = -1
    return np.pad(out, ((0, 0), (0, take - out.shape[1])), constant_values=-1)


def _link(unit: np.ndarray, links: np.ndarray, own: np.ndarray, cand: np.ndarray) -> None:
    """Give new nodes their links and the nodes at the other ends theirs; of
    more than fit, the nearest diverse ones stay."""
    for a in range(0, len(own), AT_ONCE):
        links[own[a : a + AT_ONCE], :CHOSEN] = _chosen(unit, own[a : a + AT_ONCE], cand[a : a + AT_ONCE], CHOSEN)
    src = np.repeat(own, CHOSEN)
    dst = links[own, :CHOSEN].ravel()
    src, dst = src[dst >= 0], dst[dst >= 0]
    new = ~(links[dst] == src[:, None]).any(axis=1)
    src, dst = src[new], dst[new]
    order = np.lexsort((-np.einsum("ed,ed->e", unit[src], unit[dst]), dst))  # nearest first
    src, dst = src[order], dst[order]
    rank = np.arange(len(dst)) - np.searchsorted(dst, dst)
    src, dst, rank = src[rank < PLACES], dst[rank < PLACES], rank[rank < PLACES]
    ends = np.unique(dst)
    more = np.full((len(ends), PLACES), -1, np.int32)
    more[np.searchsorted(ends, dst), rank] = src
    for a in range(0, len(ends), AT_ONCE):
        part = ends[a : a + AT_ONCE]
        both = np.concatenate([links[part], more[a : a + AT_ONCE]], axis=1)
        width = int((both >= 0).sum(axis=1).max())
        both = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable")[:, :width], axis=1)
        over = (both >= 0).sum(axis=1) > PLACES
        fits = np.pad(both[~over, :PLACES], ((0, 0), (0, max(0, PLACES - width))), constant_values=-1)
        links[part[~over]] = fits
        if over.any():
            links[part[over]] = _chosen(unit, part[over], both[over], PLACES)


def layer_links(unit: np.ndarray) -> np.ndarray:
    """Flat links (nodes * PLACES) among unit vectors of one layer.  Nodes are
    inserted in batches no larger than what is there: each searches the graph
    so far for its candidates, and its own batch, which is bounded."""
    n = len(unit)
    links = np.full((n, PLACES), -1, np.int32)
    done = 0
    while done < n:
        batch = np.arange(done, min(n, done + min(max(done, FIRST), BATCH)), dtype=np.int32)
        mates = min(CANDIDATES, len(batch) - 1)
        cand = np.full((len(batch), CANDIDATES + mates), -1, np.int32)
        if done:
            entry = np.arange(min(done, FIRST), dtype=np.int32)
            for a in range(0, len(batch), AT_ONCE):
                q = unit[batch[a : a + AT_ONCE]]
                best = np.argsort(-(q @ unit[entry].T), axis=1, kind="stable")[:, :BEAM_UPPER].astype(np.int32)
                cand[a : a + AT_ONCE, :CANDIDATES] = beam_search(unit[:done], links[:done].ravel(), q, best, CANDIDATES)
        if mates > 0:
            for a in range(0, len(batch), AT_ONCE):
                near = unit[batch[a : a + AT_ONCE]] @ unit[batch].T
                near[np.arange(len(near)), np.arange(a, a + len(near))] = -np.inf
                cand[a : a + AT_ONCE, CANDIDATES:] = batch[np.argpartition(-near, mates - 1, axis=1)[:, :mates]]
        _link(unit, links, batch, cand)
        done = int(batch[-1]) + 1
    return links.ravel()


def build(vectors: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """(nodes of each layer as rows of ``vectors``, flat links of each layer
    as places within the layer), lowest layer first.  ``vectors`` are in an
    order that is random with respect to their values, so a layer is a prefix
    of the one below."""
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    unit = (vectors / norms[:, None]).astype(np.float32)
    nodes, links = [np.arange(len(vectors), dtype=np.int32)], []
    while True:
        links.append(layer_links(unit[nodes[-1]]))
        if len(nodes[-1]) <= 4 * FAN:
            return nodes, links
        nodes.append(nodes[-1][: -(-len(nodes[-1]) // FAN)])


def beam_search(unit: np.ndarray, links: np.ndarray, q: np.ndarray, entry: np.ndarray, beam: int) -> np.ndarray:
    """For unit queries ``q``, the ``beam`` best nodes met (queries x beam, -1
    for none), from entry nodes (queries x entries, -1 for none)."""
    n, links = len(unit), links.reshape(-1, PLACES)
    rows = np.arange(len(q))
    met = np.zeros((len(q), n + 1), bool)  # the last column stands for none
    met[rows[:, None], entry] = True
    met[:, n] = True
    ids = np.full((len(q), beam), -1, np.int32)
    sims = np.full((len(q), beam), -np.inf, np.float32)
    width = min(beam, entry.shape[1])
    ids[:, :width] = entry[:, :width]
    sims[:, :width] = np.where(ids[:, :width] >= 0, np.einsum("qd,qed->qe", q, unit[ids[:, :width]]), -np.inf)
    done = ids < 0
    while True:
        open_sims = np.where(done, -np.inf, sims)
        best = open_sims.argmax(axis=1)
        live = np.flatnonzero(np.isfinite(open_sims[rows, best]))
        if not len(live):
            return ids
        done[live, best[live]] = True
        near = links[ids[live, best[live]]]
        near = np.where(met[live[:, None], near], -1, near)
        met[live[:, None], near] = True
        got = np.where(near >= 0, np.einsum("qd,qed->qe", q[live], unit[near]), -np.inf)
        all_ids = np.concatenate([ids[live], near], axis=1)
        all_sims = np.concatenate([sims[live], got], axis=1)
        all_done = np.concatenate([done[live], near < 0], axis=1)
        top = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
        ids[live] = np.take_along_axis(all_ids, top, axis=1)
        sims[live] = np.take_along_axis(all_sims, top, axis=1)
        done[live] = np.take_along_axis(all_done, top, axis=1)
        ids[live] = np.where(np.isfinite(sims[live]), ids[live], -1)
        done[live] |= ids[live] < 0


def search(vectors: np.ndarray, layers: list[tuple[int, np.ndarray]], queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best nodes (-1 for none) and their cosines, in double
    precision.  ``layers``: (number of nodes, flat links), lowest first."""
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    unit = (vectors / norms[:, None]).astype(np.float32)
    q_norms = np.sqrt((queries * queries).sum(axis=1))
    q = (queries / q_norms[:, None]).astype(np.float32)
    k = min(k, len(vectors))
    top = layers[-1][0]
    out_ids, out_sims = [], []
    for a in range(0, len(q), AT_ONCE):
        part = q[a : a + AT_ONCE]
        entry = np.argsort(-(part @ unit[:top].T), axis=1, kind="stable")[:, : max(BEAM_UPPER, k)].astype(np.int32)
        for depth in range(len(layers) - 2, -1, -1):
            size, links = layers[depth]
            entry = beam_search(unit[:size], links, part, entry, max(BEAM, k) if depth == 0 else BEAM_UPPER)
        exact = np.einsum("qd,qed->qe", queries[a : a + AT_ONCE], vectors[entry])
        exact = exact / (q_norms[a : a + AT_ONCE, None] * norms[entry])
        exact = np.where(entry >= 0, exact, -np.inf)
        order = np.argsort(-exact, axis=1, kind="stable")[:, :k]
        out_ids.append(np.take_along_axis(entry, order, axis=1))
        out_sims.append(np.take_along_axis(exact, order, axis=1))
    return np.concatenate(out_ids), np.concatenate(out_sims)


def usable(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector): rows that take part, vectors as doubles."""
    v = F.col("vector")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return (
        table.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
        .where("id is not null and vector is not null")
        .where(F.forall(v, finite) & F.exists(v, lambda x: x != 0))
    )


def nodes_of(rows: DataFrame, k: int) -> DataFrame:
    """Distinct vectors: (node, vector, ids): the smallest id names the node;
    ``ids`` are its k + 1 smallest (more can't be among a query's k nearest,
    itself left out)."""
    by_id = Window.partitionBy("vector").orderBy("id")
    first = rows.distinct().withColumn("r", F.row_number().over(by_id)).where(F.col("r") <= k + 1)
    return first.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(F.col("ids")[0].alias("node"), "vector", "ids")


INDEX = "dim int, shard int, n int, nodes binary, vectors binary, sizes array<int>, links array<binary>"


def build_index(nodes: DataFrame, shard_size: int = SHARD) -> DataFrame:
    """One row per shard: node ids, vectors and the graph's flat arrays."""
    sized = nodes.withColumn("dim", F.size("vector"))
    shards = {r["dim"]: max(1, -(-r["n"] // shard_size)) for r in sized.groupBy("dim").agg(F.count("*").alias("n")).collect()}  # a row per length
    if not shards:
        return nodes.sparkSession.createDataFrame([], INDEX)
    shard_of = F.lit(0)
    for dim, n in shards.items():
        shard_of = F.when(F.col("dim") == dim, F.pmod(F.xxhash64("node"), F.lit(n))).otherwise(shard_of)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        order = group["spread"].argsort(kind="stable")
        group = group.iloc[order]
        vectors = np.stack(group["vector"].to_numpy()).astype(np.float64)
        layers, links = build(vectors)
        return pd.DataFrame(
            {
                "dim": [group["dim"].iloc[0]],
                "shard": [group["shard"].iloc[0]],
                "n": [len(group)],
                "nodes": [group["node"].to_numpy().astype("<i8").tobytes()],
                "vectors": [vectors.astype("<f8").tobytes()],
                "sizes": [[len(x) for x in layers]],
                "links": [[x.astype("<i4").tobytes() for x in links]],
            }
        )

    dealt = sized.select("dim", shard_of.cast("int").alias("shard"), F.xxhash64("node", F.lit(1)).alias("spread"), F.col("node").cast("bigint").alias("node"), "vector")
    return stage_table(dealt.groupBy("dim", "shard").applyInPandas(run, INDEX), "hnsw")


def nearest(table: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", shard_size: int = SHARD) -> DataFrame:
    """For every row of ``queries`` its ``k`` nearest rows of ``table`` found:
    query_id, rank, id_col, score."""
    small_batches(table.sparkSession)
    rows = usable(table, id_col, vector_col)
    nodes = stage_table(nodes_of(rows, k), "nodes")
    index = build_index(nodes, shard_size)
    asked = usable(queries, id_col, vector_col).distinct().withColumn("dim", F.size("vector"))
    asked = asked.select(F.col("id").cast("bigint").alias("query_id"), "vector", "dim")
    folder = scratch_path(table.sparkSession, "queries")
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    asked.repartition(blocks, "query_id", "vector").write.parquet(folder)
    if "://" not in folder:
        folder = f"file://{folder}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        files = sorted(f.path for f in fs.get_file_info(pafs.FileSelector(base)) if f.path.endswith(".parquet"))
        for batch in batches:
            for s in batch.to_pylist():
                ids = np.frombuffer(s["nodes"], "<i8")
                vectors = np.frombuffer(s["vectors"], "<f8").reshape(len(ids), -1)
                layers = [(int(n), np.frombuffer(x, "<i4")) for n, x in zip(s["sizes"], s["links"], strict=True)]
                for path in files:
                    with fs.open_input_file(path) as fh:
                        block = pq.read_table(fh)
                    block = block.filter(pc.equal(block["dim"], s["dim"])).combine_chunks()
                    if not block.num_rows:
                        continue
                    q = pc.list_flatten(block["vector"]).to_numpy().reshape(block.num_rows, -1)
                    found, scores = search(vectors, layers, q, k + 1)
                    keep = found >= 0
                    yield pa.RecordBatch.from_pydict(
                        {
                            "query_id": pa.array(np.repeat(block["query_id"].to_numpy(), keep.sum(axis=1))),
                            "node": pa.array(ids[found[keep]]),
                            "score": pa.array(scores[keep]),
                        }
                    )

    # A shard a task, whatever its size in bytes.
    n_shards = max(1, index.count())
    hits = index.repartition(n_shards, "dim", "shard").mapInArrow(run, "query_id bigint, node bigint, score double")
    by_rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "node")
    hits = hits.withColumn("r", F.row_number().over(by_rank)).where(F.col("r") <= k + 1).drop("r")
    members = nodes.select(F.col("node").cast("bigint").alias("node"), F.explode("ids").alias("id"))
    pairs = hits.join(members, "node").where(F.col("id") != F.col("query_id")).select("query_id", "id", "score").distinct()
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (
        pairs.groupBy("query_id", "id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias(id_col), "score")
    )
