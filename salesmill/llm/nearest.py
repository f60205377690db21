"""Operator 2: approximate nearest neighbours by small-world graphs, one per shard.

Vectors are dealt by hash to shards of bounded size. A task builds the graph of a
shard: equal vectors are one node with all their ids, a node's highest level is
drawn from a hash of its place, and each level keeps its links as one flat array
of neighbours. Nodes are put in by batches: all of a batch walk down the levels
together and keep, on each, the best neighbours of which none is nearer to
another kept one than to the node.

Nearness is the inner product. For links, a component is added that gives all
vectors of a shard the same length, so that the largest inner product is the
smallest distance. A query walks down the upper levels, searches the lowest one
with a beam, and the shards' results are merged. Scores are inner products of
the original vectors in double precision.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components take no part, nor do rows without id; vectors meet only those of the
same length; equal scores go to the smaller id; copies are candidates, and each is
indexed; rows of one id are rows like others, each a query and a candidate of all
but itself; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmill.llm.base import read, saved
from salesmill.llm.hashing import mixed
from salesmill.llm.vectors import blocks, dumped, loaded, met, ranked, shard_count, shards, vectors

K = 20
SHARD = 8192
BLOCK = 256
LINKS = 16  # per node on upper levels, twice as many on the lowest
BUILD_BEAM = 96
SEARCH_BEAM = 128
STEP = 4  # beam members opened together


class Graph:
    """Levels of flat neighbour arrays over the rows of a matrix; -1 where there is none."""

    def __init__(self, v: np.ndarray, links: int = LINKS):
        self.v, self.links = v, links
        n = len(v)
        u = (mixed(np.arange(1, n + 1, dtype=np.uint64)) >> np.uint64(11)) / float(1 << 53)
        height = np.minimum((-np.log(u + 1e-300) / np.log(links)).astype(np.int64), 8)
        self.order = np.argsort(-height, kind="stable")
        self.height = height
        self.near = [
            np.full((n, links * (1 if level else 2)), -1, np.int32) for level in range(int(height.max(initial=0)) + 1)
        ]
        self.entry = int(self.order[0])
        self._fill()

    def _fill(self) -> None:
        done = 1
        while done < len(self.order):
            batch = self.order[done : done + min(256, max(1, done))]
            self._insert(batch)
            done += len(batch)

    def _insert(self, batch: np.ndarray) -> None:
        at = np.full((len(batch), 1), self.entry)
        for level in range(len(self.near) - 1, -1, -1):
            own = self.height[batch] >= level
            if not own.any():
                at = self.beam(self.v[batch], at, level, 1)[0]
                continue
            ids, scores = self.beam(self.v[batch], at, level, BUILD_BEAM)
            at = ids[:, :1]
            rows = np.flatnonzero(own)
            # Members of the batch do not know each other yet.
            peers = batch[rows]
            mutual = self.v[peers] @ self.v[peers].T
            np.fill_diagonal(mutual, -np.inf)
            some = min(self.links, len(peers))
            best = np.argpartition(-mutual, some - 1, axis=1)[:, :some]
            near = np.concatenate([ids[rows], peers[best]], 1)
            score = np.concatenate([scores[rows], np.take_along_axis(mutual, best, 1)], 1)
            near[score == -np.inf] = -1
            width = self.near[level].shape[1]
            self.near[level][peers] = self._select(peers, near, score, self.links, width)
            self._back(peers, level)

    def _select(self, nodes, near, score, keep: int, width: int) -> np.ndarray:
        """Candidates by nearness, leaving out those nearer to a kept one than to the node."""
        order = np.argsort(-np.where(near < 0, -np.inf, score), axis=1, kind="stable")[:, :64]
        near, score = np.take_along_axis(near, order, 1), np.take_along_axis(score, order, 1)
        v = self.v[np.maximum(near, 0)]
        mutual = v @ v.transpose(0, 2, 1)
        kept = np.zeros(near.shape, bool)
        for c in range(near.shape[1]):
            hidden = (kept & (mutual[:, c] >= score[:, c : c + 1])).any(1)
            kept[:, c] = (near[:, c] >= 0) & ~hidden & (kept.sum(1) < keep)
        # Free places go to the nearest of those left out.
        rank = np.argsort(~kept, axis=1, kind="stable")
        kept_first = np.take_along_axis(near, rank, 1)
        room = kept.sum(1)[:, None] + (keep - kept.sum(1)[:, None]) // 2
        kept_first[np.arange(near.shape[1])[None, :] >= np.minimum(room, keep)] = -1
        out = np.full((len(nodes), width), -1, np.int32)
        n = min(width, kept_first.shape[1])
        out[:, :n] = kept_first[:, :n]
        return out

    def _back(self, nodes: np.ndarray, level: int) -> None:
        """Adds the links from the neighbours of new nodes back to them."""
        table = self.near[level]
        width = table.shape[1]
        target = table[nodes].reshape(-1)
        source = np.repeat(nodes, width)[target >= 0]
        target = target[target >= 0]
        order = np.argsort(target, kind="stable")
        target, source = target[order], source[order]
        who, first, count = np.unique(target, return_index=True, return_counts=True)
        have = (table[who] >= 0).sum(1)
        for extra in np.unique(count).tolist():
            rows = np.flatnonzero(count == extra)
            added = source[first[rows][:, None] + np.arange(extra)]
            old = table[who[rows]]
            dup = (added[:, :, None] == old[:, None, :]).any(2)
            both = np.concatenate([old, np.where(dup, -1, added)], 1)
            fits = have[rows] + extra <= width
            packed = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), 1)[:, :width]
            table[who[rows[fits]]] = packed[fits]
            over = np.flatnonzero(~fits)
            if len(over):
                node, near = who[rows[over]], both[over]
                score = np.einsum("id,ikd->ik", self.v[node], self.v[np.maximum(near, 0)])
                table[node] = self._select(node, near, score, width, width)

    def beam(self, q: np.ndarray, start: np.ndarray, level: int, size: int):
        """(ids, scores) of a beam search of all queries side by side, best first."""
        n, table = len(q), self.near[level]
        seen = np.zeros((n, len(self.v)), bool)
        ids = np.full((n, size), -1)
        scores = np.full((n, size), -np.inf)
        open_ = np.zeros((n, size), bool)
        w = min(size, start.shape[1])
        ids[:, :w] = start[:, :w]
        scores[:, :w] = np.einsum("id,ikd->ik", q, self.v[start[:, :w]])
        open_[:, :w] = True
        seen[np.arange(n)[:, None], start[:, :w]] = True
        step = min(STEP, size)
        while True:
            rows = np.flatnonzero(open_.any(1))
            if not len(rows):
                return ids, scores
            # The beam is kept in order, so the first open members are the best.
            pick = np.argsort(~open_[rows], axis=1, kind="stable")[:, :step]
            live = np.take_along_axis(open_[rows], pick, 1)
            node = np.where(live, np.take_along_axis(ids[rows], pick, 1), -1)
            open_[rows[:, None], pick] = False
            near = np.where(node[:, :, None] >= 0, table[np.maximum(node, 0)], -1).reshape(len(rows), -1)
            near = np.sort(near, axis=1)
            fresh = near >= 0
            fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
            fresh &= ~seen[rows[:, None], np.maximum(near, 0)]
            r, c = np.nonzero(fresh)
            if not len(r):
                continue
            found = near[r, c]
            seen[rows[r], found] = True
            got = np.full(near.shape, -np.inf)
            got[r, c] = np.einsum("id,id->i", q[rows[r]], self.v[found])
            every = np.concatenate([scores[rows], got], 1)
            order = np.argsort(-every, axis=1, kind="stable")[:, :size]
            scores[rows] = np.take_along_axis(every, order, 1)
            who = np.concatenate([ids[rows], np.where(fresh, near, -1)], 1)
            ids[rows] = np.take_along_axis(who, order, 1)
            state = np.concatenate([open_[rows], fresh], 1)
            open_[rows] = np.take_along_axis(state, order, 1) & (scores[rows] > -np.inf)

    def search(self, q: np.ndarray, size: int):
        at = np.full((len(q), 1), self.entry)
        for level in range(len(self.near) - 1, 0, -1):
            at = self.beam(q, at, level, 1)[0]
        return self.beam(q, at, 0, size)


def build(ids: np.ndarray, points: np.ndarray) -> bytes:
    """The graph of a shard and the ids of its nodes."""
    distinct, node = np.unique(points, axis=0, return_inverse=True)
    order = np.lexsort((ids, node.reshape(-1)))
    starts = np.searchsorted(node.reshape(-1)[order], np.arange(len(distinct) + 1))
    graph = Graph(level_lengths(distinct))
    levels = {f"near{i}": t for i, t in enumerate(graph.near)}
    return dumped(points=distinct, ids=ids[order], starts=starts, entry=np.array(graph.entry), **levels)


def level_lengths(points: np.ndarray) -> np.ndarray:
    """Vectors with one more component, all of the length of the longest; at most 1."""
    scaled = points / max(np.abs(points).max(initial=0), 1e-300)
    square = (scaled**2).sum(1)
    longest = square.max(initial=0)
    more = np.sqrt(np.maximum(longest - square, 0))
    return (np.concatenate([scaled, more[:, None]], 1) / np.sqrt(longest)).astype(np.float32)


def opened(body: bytes) -> dict:
    """A graph as it was built, without building it again."""
    parts = loaded(body)
    graph = Graph.__new__(Graph)
    graph.v = level_lengths(parts["points"])
    graph.near = [parts[f"near{i}"] for i in range(sum(n.startswith("near") for n in parts))]
    graph.entry = int(parts["entry"])
    return parts | {"graph": graph}


def search(shard: dict, own: np.ndarray, queries: np.ndarray, k: int, beam: int):
    """Places of queries, ids and scores of the k best that each query finds in a shard."""
    size = np.abs(queries).max(1, keepdims=True)
    flat = np.concatenate([queries / size, np.zeros((len(queries), 1))], 1).astype(np.float32)
    node, _ = shard["graph"].search(flat, max(beam, k + 1))
    who, place = np.nonzero(node >= 0)
    node = node[who, place]
    score = np.einsum("id,id->i", queries[who], shard["points"][node])
    # The smallest k + 1 ids of a node are all that can be among the k best.
    starts, n = shard["starts"], k + 1
    some = np.minimum(starts[node + 1] - starts[node], n)
    place = np.arange(int(some.sum())) + np.repeat(starts[node] - (np.cumsum(some) - some), some)
    who, score, ids = np.repeat(who, some), np.repeat(score, some), shard["ids"][place]
    other = ids != own[who]
    who, score, ids = who[other], score[other], ids[other]
    order = np.lexsort((ids, -score, who))
    who, score, ids = who[order], score[order], ids[order]
    best = np.arange(len(who)) - np.searchsorted(who, who) < k
    return who[best], ids[best], score[best]


def _searcher(k: int, beam: int):
    known: dict = {}

    def run(body, ids, queries, _floors):
        if known.get("body") is not body:
            known.update(body=body, shard=opened(body))
        return search(known["shard"], ids, queries, k, beam)

    return run


def nearest(
    rows: DataFrame,
    key: str,
    column: str,
    is_query: F.Column,
    k: int = K,
    per_shard: int = SHARD,
    per_block: int = BLOCK,
    beam: int = SEARCH_BEAM,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the nearest found; ``is_query`` is on ``id``."""
    base = saved(vectors(rows, key, column, zero_counts=False), "vectors")
    asked = base.where(is_query)
    n, n_asked = shard_count(base.count(), per_shard), asked.count()
    graphs = saved(shards(base, n, build), "graphs")
    groups = blocks(asked, n_asked, per_block)
    found = met(graphs, groups, (0, n), -(-n_asked // per_block), _searcher(k, beam), "double")
    return ranked(found, k).drop("query")


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("id") % 20 == 0)
