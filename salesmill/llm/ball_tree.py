"""Operator 9: exact top-k by integer inner product, with a ball tree per shard.

Vectors are dealt by hash to shards of bounded size. A task builds the ball tree
of a shard: a node halves its vectors along its widest direction until few are
left, and knows their centre c and radius r. No vector below it scores more than
q.c + |q| r. The queries of a block go down a tree together, each only to nodes
whose bound reaches its k-th score, and open the leaves in order of bound.

That k-th score is shared: every query searches a few shards first, and the k-th
score it finds there goes with it to all other shards as a floor.

Scores are sums of products of whole numbers and exact: doubles are used only
while no sum can pass 2**53, else 64-bit integers. Bounds get an allowance far
above the rounding of doubles.

Defined results: vectors that are null, empty or hold null or non-finite
components take no part, nor do rows without id; vectors meet only those of the
same length; a zero vector is like any other; equal scores go to the smaller id;
copies of a vector are candidates; rows of one id are rows like others, each a query
and a candidate of all but itself; an empty table gives no rows. Other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmill.llm.base import read, saved
from salesmill.llm.vectors import blocks, dumped, loaded, met, ranked, shard_count, shards, vectors

K = 5
SCALE = 256
SHARD = 4096
BLOCK = 256
LEAF = 64
PILOT = 64  # one shard of so many is searched first
NONE = -(1 << 62)
EXACT = float(1 << 53)


def build(ids: np.ndarray, points: np.ndarray) -> bytes:
    """The ball tree of a shard: node i has children ``down[i]`` or vectors first to last."""
    points = points.astype(np.int64)
    real = points.astype(np.float64)
    order = np.arange(len(points))
    first, last, down = [0], [len(points)], []
    node = 0
    while node < len(first):
        s, e = first[node], last[node]
        if e - s <= LEAF:
            down.append((-1, -1))
        else:
            part = real[order[s:e]]
            half = (e - s) // 2
            widest = part[:, int(np.argmax(part.var(0)))]
            order[s:e] = order[s:e][np.argpartition(widest, half)]
            down.append((len(first), len(first) + 1))
            first += [s, s + half]
            last += [s + half, e]
        node += 1
    parts = [real[order[s:e]] for s, e in zip(first, last)]
    centre = np.array([p.mean(0) for p in parts])
    radius = np.array([np.sqrt(((p - c) ** 2).sum(1).max()) for p, c in zip(parts, centre)])
    return dumped(
        ids=ids[order], points=points[order], first=np.array(first), last=np.array(last),
        down=np.array(down), centre=centre, radius=radius,
    )


def search(tree: dict, own: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int):
    """Branch and bound of a block of queries: places of queries, ids, scores."""
    n = len(queries)
    points, ids = tree["points"], tree["ids"]
    reach = float(np.abs(queries).max()) * float(np.abs(points).max()) * points.shape[1]
    kind = np.float64 if reach < EXACT else np.int64
    asked, points = queries.astype(kind), points.astype(kind)
    real = queries.astype(np.float64)
    norm = np.sqrt((real**2).sum(1))

    def bound(q: np.ndarray, node: np.ndarray) -> np.ndarray:
        raw = np.einsum("ij,ij->i", real[q], tree["centre"][node])
        raw += norm[q] * tree["radius"][node]
        return raw + 1e-6 * (np.abs(raw) + norm[q] + 1)

    score, name = np.full((n, k), NONE, np.int64), np.full((n, k), np.iinfo(np.int64).max)
    # Down to the leaves, leaving out what the shared score already rules out.
    query, node = np.arange(n), np.zeros(n, np.int64)
    leaves = []
    while len(query):
        b = bound(query, node)
        open_ = b >= floors[query]
        query, node, b = query[open_], node[open_], b[open_]
        leaf = tree["down"][node, 0] < 0
        leaves.append((query[leaf], node[leaf], b[leaf]))
        query, node = np.repeat(query[~leaf], 2), tree["down"][node[~leaf]].reshape(-1)
    query, node, b = (np.concatenate(part) for part in zip(*leaves))
    order = np.lexsort((-b, query))
    query, node, b = query[order], node[order], b[order]
    # The i-th best leaf of every query at a time, the queries of a leaf together.
    turn = np.arange(len(query)) - np.searchsorted(query, query)
    by_turn = np.argsort(turn, kind="stable")
    edges = np.searchsorted(turn[by_turn], np.arange(turn.max() + 2)) if len(turn) else [0]
    for s, e in zip(edges[:-1], edges[1:]):
        step = by_turn[s:e]
        kth = np.maximum(score[query[step], -1], floors[query[step]])
        step = step[b[step] >= kth]
        step = step[np.argsort(node[step], kind="stable")]
        cuts = np.flatnonzero(np.diff(node[step])) + 1
        for some in np.split(step, cuts):
            if not len(some):
                continue
            rows, at = query[some], int(node[some[0]])
            span = slice(int(tree["first"][at]), int(tree["last"][at]))
            got = (asked[rows] @ points[span].T).astype(np.int64)
            got[ids[span][None, :] == own[rows][:, None]] = NONE
            every = np.concatenate([score[rows], got], 1)
            who = np.concatenate([name[rows], np.broadcast_to(ids[span], got.shape)], 1)
            top = np.lexsort((who, -every), axis=1)[:, :k]
            score[rows] = np.take_along_axis(every, top, 1)
            name[rows] = np.take_along_axis(who, top, 1)
    who, place = np.nonzero(score > NONE)
    return who, name[who, place], score[who, place]


def _searcher(k: int):
    known: dict = {}

    def run(body, ids, queries, floors):
        if known.get("body") is not body:
            known.update(body=body, tree=loaded(body))
        start = np.full(len(ids), NONE) if floors is None else floors
        return search(known["tree"], ids, queries, start, k)

    return run


def top_inner_products(
    rows: DataFrame,
    key: str,
    column: str,
    is_query: F.Column,
    k: int = K,
    scale: int = SCALE,
    per_shard: int = SHARD,
    per_block: int = BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best candidates of each query.

    ``is_query`` is a condition on the column ``id``.
    """
    whole = F.transform("v", lambda x: F.floor(x * F.lit(float(scale))).cast("long"))
    base = saved(vectors(rows, key, column, zero_counts=True).select("row", "id", whole.alias("v")), "whole")
    asked = base.where(is_query)
    n, n_asked = shard_count(base.count(), per_shard), asked.count()
    n_blocks = -(-n_asked // per_block)
    trees = saved(shards(base, n, build), "trees")
    groups = saved(blocks(asked, n_asked, per_block), "blocks")
    # Some of the shards give the first floors.
    pilots = -(-n // PILOT)
    early = saved(met(trees, groups, (0, pilots), n_blocks, _searcher(k), "long"), "early")
    if pilots == n:
        return ranked(early, k).drop("query")
    kth = ranked(early, k).where(F.col("rank") == k).select(F.col("query").alias("row"), F.col("score").alias("floor"))
    floored = saved(
        groups.select("block", "size", F.posexplode("rows").alias("at", "row"))
        .join(kth, "row", "left")
        .groupBy("block", "size")
        .agg(F.array_sort(F.collect_list(F.struct("at", F.coalesce("floor", F.lit(NONE)).alias("floor")))).alias("f"))
        .select("block", "size", F.col("f.floor").alias("floors"))
        .join(groups, ["block", "size"]),
        "floors",
    )
    late = met(trees, floored, (pilots, n), n_blocks, _searcher(k), "long")
    return ranked(early.unionByName(late), k).drop("query")


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    return top_inner_products(rows, "vec_id", "embedding", F.col("id") % 50 == 0)
