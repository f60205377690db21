"""Operator 6: near copies by SimHash fingerprints and BK-trees.

A text's fingerprint has a bit set where over half of the hashes of its 3-word
shingles have it set. Copies share a fingerprint, so the search is over distinct
fingerprints. Two of them that differ in two bits at most agree on at least two of
four quarters; each fingerprint is dealt to a shard for each of the six pairs of
quarters, and shards that come out large are dealt again by pairs of quarters of
their open bits, as often as needed. So shard trees stay small and meet their
queries through the shuffle; broadcasting the trees of all shards would ship the
whole corpus to every task.

In a shard, a BK-tree keeps the children of a node by their Hamming distance to
it; a query at distance d from a node follows only the edges d-2 to d+2. All
fingerprints of a shard walk down its tree together. A shard returns a spanning
forest of its links, never all pairs.

Defined results: a null text counts as empty; texts without words have the
fingerprint zero; repeated rows are linked; a null ``doc_id`` gets a row, joins
its component and is never its name unless it is alone; an empty table gives no
rows. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmill.llm.base import arrow_batch, lean, read, saved, shuffle_width, slices, small_batches, texts_of
from salesmill.llm.components import components

WORDS = 3
SEED = 42
RADIUS = 2
SHARD = 2000  # fingerprints of one tree; larger shards are dealt again
BATCH_BYTES = 2 << 20

PRINT = pa.schema([("doc_id", pa.int64()), ("print", pa.int64())])


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """SimHash of a text's shingles, as an unsigned number."""
    found = text.lower().split()  # on bytes, both know ASCII only
    if not found:
        return 0
    line = b" ".join(found)
    if len(found) <= words:
        return xxhash.xxh64_intdigest(line, SEED)
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    one = xxhash.xxh64_intdigest
    hashes = np.array(
        [one(line[s:e], SEED) for s, e in zip(starts.tolist(), ends[words - 1 :].tolist())], np.uint64
    )
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 14):
        part = hashes[i : i + (1 << 14)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def _printer(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            prints = [fingerprint(t, words) for t in texts_of(batch.column("text"))]
            signed = np.array(prints, np.uint64).view(np.int64)
            yield arrow_batch(PRINT, {"doc_id": batch.column("doc_id"), "print": signed})

    return run


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, print), the print as a signed number with the same bits."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(lean(_printer(words)), "doc_id long, print long")


class BKTrees:
    """One BK-tree per shard, walked by many queries at once.

    ``first`` has, for each print, the place of the first one of its shard,
    which is the root of the shard's tree. Prints of a shard are distinct.
    """

    def __init__(self, prints: np.ndarray, first: np.ndarray):
        self.prints, self.first = prints, first
        n = len(prints)
        # The child of a node at each distance, -1 for none.
        self.child = np.full((n, 65), -1, np.int32)
        flat = self.child.reshape(-1)
        waiting = np.flatnonzero(first != np.arange(n))
        at = first[waiting]
        while len(waiting):
            slot = at * 65 + np.bitwise_count(prints[waiting] ^ prints[at])
            free = np.flatnonzero(flat[slot] < 0)
            # Of those that come to a free edge together, the first one takes it.
            _, one = np.unique(slot[free], return_index=True)
            taken = free[one]
            flat[slot[taken]] = waiting[taken]
            stays = np.ones(len(waiting), bool)
            stays[taken] = False
            at = flat[slot[stays]].astype(np.int64)
            waiting = waiting[stays]

    def pairs(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) of all nodes within the radius of the prints at some places."""
        found, query, node = [], queries, self.first[queries]
        while len(query):
            d = np.bitwise_count(self.prints[query] ^ self.prints[node]).astype(np.int64)
            near = d <= radius
            found.append((query[near], node[near]))
            steps = []
            for off in range(-radius, radius + 1):
                some = np.flatnonzero((d + off > 0) & (d + off <= 64))
                down = self.child[node[some], d[some] + off]
                some, down = some[down >= 0], down[down >= 0]
                steps.append((query[some], down.astype(np.int64)))
            query, node = (np.concatenate(part) for part in zip(*steps))
        if not found:
            return queries, queries
        return tuple(np.concatenate(part) for part in zip(*found))


def forest(prints: np.ndarray, first: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Places linked within shards, each to the first member of its component there."""
    trees = BKTrees(prints, first)
    root = np.arange(len(prints))
    for start in range(0, len(prints), 1024):
        some = np.arange(start, min(start + 1024, len(prints)))
        root = _joined(root, *trees.pairs(some, radius))
    member = np.flatnonzero(root != np.arange(len(prints)))
    return member, root[member]


def _joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Roots after the links a-b; the root of a component is its smallest place."""
    a, b = a[a != b], b[a != b]
    while True:
        ra, rb = root[a], root[b]
        open_ = ra != rb
        if not open_.any():
            return root
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        new = root.copy()
        np.minimum.at(new, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = new[new]
            if (up == new).all():
                break
            new = up
        root = new


def _masks(fixed: int, radius: int) -> list[int]:
    """Masks over the open bits: two prints within the radius agree on all of one of them."""
    bits = [b for b in range(64) if not fixed >> b & 1]
    parts = radius + 2
    cut = [bits[len(bits) * i // parts : len(bits) * (i + 1) // parts] for i in range(parts)]
    return [fixed | sum(1 << b for i in pair for b in cut[i]) for pair in combinations(range(parts), 2)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(prints: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """Links (a, b) that connect whatever is within the radius, of a table of distinct prints.

    Each round fixes half of the bits left open, so after three rounds a shard
    of 64-bit prints holds a few hundred at most.
    """
    spark = prints.sparkSession
    level = prints.select("print", F.lit(0).cast("long").alias("fixed"))
    fixed, found = [0], []
    while True:
        masks = {f: _masks(f, radius) for f in fixed}
        # Six rows per mask of the round before: 6, 36, 216.
        table = spark.createDataFrame(
            [(_signed(f), _signed(m)) for f, ms in masks.items() for m in ms], "fixed long, mask long"
        )
        value = F.col("print").bitwiseAND(F.col("mask"))
        dealt = level.join(F.broadcast(table), "fixed").select("print", "mask", value.alias("value"))
        sizes = dealt.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        joined = saved(dealt.join(sizes, ["mask", "value"]), "shards")
        fixed = sorted({m for ms in masks.values() for m in ms})
        last = 64 - fixed[0].bit_count() <= 8
        found.append(_walk(joined if last else joined.where(F.col("n") <= shard), radius))
        level = joined.where(F.col("n") > shard).select("print", F.col("mask").alias("fixed")).distinct()
        if last or level.isEmpty():
            break
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _walk(shards: DataFrame, radius: int) -> DataFrame:
    rows = shards.select("mask", "value", "print").repartition(shuffle_width(shards.sparkSession), "mask", "value")
    return rows.sortWithinPartitions("mask", "value", "print").mapInArrow(
        _walker(radius), "a long, b long"
    )


def _walker(radius: int, enough: int = 1 << 15):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def linked(rows: np.ndarray) -> pa.RecordBatch:
            fresh = np.ones(len(rows), bool)
            fresh[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
            first = np.maximum.accumulate(np.where(fresh, np.arange(len(rows)), 0))
            prints = np.ascontiguousarray(rows[:, 2])
            a, b = forest(prints.view(np.uint64), first, radius)
            return pa.RecordBatch.from_pydict({"a": prints[a], "b": prints[b]})

        for batch in batches:
            held.append(np.stack([c.to_numpy() for c in batch.columns], 1))
            size += batch.num_rows
            if size >= enough:
                rows = np.concatenate(held)
                # The last shard may go on in the next batch.
                cut = int(np.flatnonzero((rows[:, :2] != rows[-1, :2]).any(1))[-1:].sum() + 1)
                if (rows[0, :2] != rows[-1, :2]).any():
                    yield linked(rows[:cut])
                    rows = rows[cut:]
                held, size = [rows], len(rows)
        if size:
            yield linked(np.concatenate(held))

    return run


def near_copies(
    docs: DataFrame, words: int = WORDS, radius: int = RADIUS, shard: int = SHARD
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document."""
    small_batches(docs.sparkSession)
    prints = saved(fingerprints(docs, words), "prints")
    named = prints.groupBy("print").agg(F.min("doc_id").alias("least"))
    roots = components(links(named.select("print"), radius, shard))
    rooted = named.join(roots, F.col("print") == F.col("node"), "left").select(
        "print", "least", F.coalesce("root", "print").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(rooted.join(names, "root").select("print", "component_id"), "print").select(
        "doc_id",
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op6_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(read(spark, sf_dir, "documents"))
