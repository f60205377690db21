"""Operator 12: hard negatives by integer inner products, multiplied the Strassen way.

Vectors are written as tiles of some thousand rows. Anchors and candidates meet in
cells of a grid: a cell gets a bounded group of anchor tiles and then, one after
another, the candidate tiles of its group. The scores of a tile of anchors and one of
candidates are a product of two 64-bit integer matrices, by Strassen's recursion:
odd sides get a row or column of zeros, seven products of quarters replace eight, and
below ``LEAF`` numpy multiplies. All sums are integer sums, so scores are exact.

Two passes go over the grid. The first keeps, per anchor, a heap of its best
candidates of the same label; heaps of cells are merged by a window. Its scores fix
the anchor's windows, and the second pass keeps per window the best candidates of
another label that lie in it. What a heap holds of a cell is at most its ``k``, so
what is shuffled grows with the anchors and cells, not with the scores.

Defined results: rows without id or label, with a null vector, without components or
with a null or non-finite component take no part; a zero vector is like any other;
vectors meet only those of the same length; every row counts for itself, so copies of
a vector and repeated ids are positives and negatives of their own and only the
anchor's own row is left out; equal scores go to the smaller id; an empty table gives
no rows. Components beyond 64 bits take the nearest such number, and scores are those
modulo 2**64. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesmill.llm.base import arrow_batch, read, saved, shuffle_width, small_batches
from salesmill.llm.vectors import usable

POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95  # a negative's score, in hundredths of its positive's
SCALE = 256
LEAF = 32  # sides up to this are multiplied by numpy
TILE = 2048  # rows of a tile of candidates
ANCHOR_TILE = 512
CELL_ANCHORS, CELL_TILES = 8, 32  # tiles a cell gets
NONE = np.iinfo(np.int64).min

TILES = pa.schema([("tile", pa.int64()), ("width", pa.int32())] + [(n, pa.binary()) for n in ("row", "id", "label", "v", "w")])
TILES_DDL = "tile long, width int, row binary, id binary, label binary, v binary, w binary"
FOUND = pa.schema([(n, pa.int64()) for n in ("row", "anchor_id", "place", "id", "score")])
FOUND_DDL = "row long, anchor_id long, place long, id long, score long"


def _padded(m: np.ndarray, rows: int, columns: int) -> np.ndarray:
    if m.shape == (rows, columns):
        return m
    out = np.zeros((rows, columns), np.int64)
    out[: m.shape[0], : m.shape[1]] = m
    return out


def multiplied(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Inner products of the rows of ``a`` with those of ``b``, by Strassen's recursion."""
    (m, k), n = a.shape, len(b)
    if min(m, n, k) <= leaf:
        return a @ b.T
    hm, hn, hk = -(-m // 2), -(-n // 2), -(-k // 2)
    a, b = _padded(a, 2 * hm, 2 * hk), _padded(b, 2 * hn, 2 * hk)
    a11, a12, a21, a22 = a[:hm, :hk], a[:hm, hk:], a[hm:, :hk], a[hm:, hk:]
    # b lies by rows of the transposed matrix: its quarter below the diagonal is b12.
    b11, b21, b12, b22 = b[:hn, :hk], b[:hn, hk:], b[hn:, :hk], b[hn:, hk:]
    p1 = multiplied(a11 + a22, b11 + b22, leaf)
    p2 = multiplied(a21 + a22, b11, leaf)
    p3 = multiplied(a11, b12 - b22, leaf)
    p4 = multiplied(a22, b21 - b11, leaf)
    p5 = multiplied(a11 + a12, b22, leaf)
    p6 = multiplied(a21 - a11, b11 + b12, leaf)
    p7 = multiplied(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * hm, 2 * hn), np.int64)
    np.add(p1, p4, out=out[:hm, :hn])
    out[:hm, :hn] -= p5
    out[:hm, :hn] += p7
    np.add(p3, p5, out=out[:hm, hn:])
    np.add(p2, p4, out=out[hm:, :hn])
    np.subtract(p1, p2, out=out[hm:, hn:])
    out[hm:, hn:] += p3
    out[hm:, hn:] += p6
    return out[:m, :n]


def whole_numbers(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """(row, id, label, v) of the rows that take part, each with a number of its own.

    The numbers are those of the written table, so every later reading agrees on them.
    """
    label = F.col("label").cast("long")
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))
    table = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable("embedding", True)).select(
        F.col("vec_id").cast("long").alias("id"),
        F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        whole.alias("v"),
    )
    return saved(table.withColumn("row", F.monotonically_increasing_id()), "whole-vectors")


def tiles(rows: DataFrame, count: int, per_tile: int) -> DataFrame:
    """Rows of one length, at most twice ``per_tile`` at a time, in order of label and id."""

    def packed(width: int, parts: list[dict], number: int) -> pa.RecordBatch:
        whole = {n: np.concatenate([p[n] for p in parts]) for n in ("row", "id", "label", "v", "w")}
        order = np.lexsort((whole["id"], whole["label"]))
        raw = {n: [np.ascontiguousarray(v[order]).tobytes()] for n, v in whole.items()}
        return arrow_batch(TILES, {"tile": [number], "width": [width], **raw})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[dict]] = {}
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            widths = np.asarray(batch.column("width"))
            for width in np.unique(widths).tolist():
                every = batch.filter(pa.array(widths == width))
                for start in range(0, every.num_rows, per_tile):
                    some = every.slice(start, per_tile)
                    part = {n: some.column(n).to_numpy() for n in ("row", "id", "label")}
                    part["v"] = some.column("v").flatten().to_numpy().reshape(-1, width)
                    part["w"] = some.column("w").flatten().to_numpy().reshape(-1, POSITIVES)
                    held.setdefault(width, []).append(part)
                    if sum(len(p["id"]) for p in held[width]) >= per_tile:
                        yield packed(width, held.pop(width), number)
                        number += 1
        for width, parts in held.items():
            yield packed(width, parts, number)
            number += 1

    if "w" not in rows.columns:
        rows = rows.withColumn("w", F.array_repeat(F.lit(0).cast("long"), POSITIVES))
    wanted = rows.select("row", "id", "label", "v", "w", F.size("v").alias("width"))
    # Some tiles a task at least, so that few are left half full.
    parts = max(1, -(-count // (8 * per_tile)))
    return saved(wanted.coalesce(parts).mapInArrow(run, TILES_DDL), "tiles")


class Tile:
    def __init__(self, width: int, row: bytes, id: bytes, label: bytes, v: bytes, w: bytes):
        self.width = width
        self.row, self.id, self.label = (np.frombuffer(b, np.int64) for b in (row, id, label))
        self.v = np.frombuffer(v, np.int64).reshape(len(self.id), width)
        self.w = np.frombuffer(w, np.int64).reshape(len(self.id), -1)

    def of_label(self, label: int) -> slice:
        return slice(*np.searchsorted(self.label, [label, label + 1]))


class Heaps:
    """The ``k`` best (score, id) of each of some owners, ties to the smaller id."""

    def __init__(self, owners: int, k: int):
        self.k = k
        self.floor = np.full(owners, NONE)  # the k-th score, once there is one
        self.owner = self.score = self.id = np.zeros(0, np.int64)

    def offer(self, owner: np.ndarray, scores: np.ndarray, may: np.ndarray | None, ids: np.ndarray) -> None:
        """A matrix of scores, a row per owner and a column per id; ``may`` tells which count."""
        floor = self.floor[owner]
        good = scores >= floor[:, None]
        if may is not None:
            good &= may
        if np.count_nonzero(good) > 4 * self.k * len(owner) and scores.shape[1] > self.k:
            shown = scores if may is None else np.where(good, scores, NONE)
            kth = np.partition(shown, scores.shape[1] - self.k, axis=1)[:, -self.k]
            good &= scores >= kth[:, None]
        at, column = np.nonzero(good)
        if not len(at):
            return
        self.owner = np.concatenate([self.owner, owner[at]])
        self.score = np.concatenate([self.score, scores[at, column]])
        self.id = np.concatenate([self.id, ids[column]])
        # The complement turns the order of whole numbers round without overflow.
        order = np.lexsort((self.id, ~self.score, self.owner))
        first = np.searchsorted(self.owner[order], self.owner[order])
        place = np.arange(len(order)) - first
        order = order[place < self.k]
        self.owner, self.score, self.id = self.owner[order], self.score[order], self.id[order]
        last = place[place < self.k] == self.k - 1
        self.floor[self.owner[last]] = self.score[last]


class Positives:
    """First pass of a cell: per anchor the best candidates of its label."""

    def __init__(self, anchors: Tile):
        self.anchors = anchors
        self.heaps = Heaps(len(anchors.id), POSITIVES)

    def meet(self, tile: Tile) -> None:
        own = self.anchors
        for label in np.intersect1d(own.label, tile.label).tolist():
            mine, theirs = own.of_label(label), tile.of_label(label)
            scores = multiplied(own.v[mine], tile.v[theirs])
            _, x, y = np.intersect1d(own.row[mine], tile.row[theirs], assume_unique=True, return_indices=True)
            may = None
            if len(x):
                may = np.ones(scores.shape, bool)
                may[x, y] = False
            self.heaps.offer(np.arange(mine.start, mine.stop), scores, may, tile.id[theirs])

    def found(self) -> dict:
        who = self.heaps.owner
        own = self.anchors
        return dict(row=own.row[who], anchor_id=own.id[who], place=who * 0, id=self.heaps.id, score=self.heaps.score)


def window(positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score of a negative, without products that could overflow."""
    part, rest = np.divmod(positive, 100)
    return part * LOW - (-(rest * LOW) // 100), part * HIGH + rest * HIGH // 100


class Negatives:
    """Second pass: per anchor and positive the best candidates of other labels in the window.

    ``w`` holds the scores of an anchor's positives; a negative one, or none (-1), has
    an empty window, as half of it is more than 0.95 of it.
    """

    def __init__(self, anchors: Tile):
        self.anchors = anchors
        self.heaps = [Heaps(len(anchors.id), NEGATIVES) for _ in range(POSITIVES)]
        self.windows = [window(w) for w in anchors.w.T]

    def meet(self, tile: Tile) -> None:
        own = self.anchors
        scores = multiplied(own.v, tile.v)
        other = own.label[:, None] != tile.label[None, :]
        every = np.arange(len(own.id))
        for heaps, (low, high), positive in zip(self.heaps, self.windows, own.w.T):
            some = every[positive >= 0]
            got = scores[some]
            may = other[some] & (got >= low[some, None]) & (got <= high[some, None])
            heaps.offer(some, got, may, tile.id)

    def found(self) -> dict:
        own = self.anchors
        who = np.concatenate([h.owner for h in self.heaps])
        place = np.repeat(np.arange(POSITIVES), [len(h.owner) for h in self.heaps])
        ids, scores = (np.concatenate([getattr(h, n) for h in self.heaps]) for n in ("id", "score"))
        return dict(row=own.row[who], anchor_id=own.id[who], place=place, id=ids, score=scores)


def met(anchors: DataFrame, candidates: DataFrame, kind: Callable) -> DataFrame:
    """What the cells of the grid of anchor and candidate tiles found.

    In a cell the anchor tiles come first and stay, candidate tiles pass by one at a
    time, so a task holds at most some ``CELL_ANCHORS`` tiles, one tile and its scores.
    """
    small_batches(anchors.sparkSession)  # tiles are large rows
    wide = shuffle_width(anchors.sparkSession)
    across = max(1, -(-anchors.count() // CELL_ANCHORS))
    n_tiles = max(1, candidates.count())
    along = max(-(-n_tiles // CELL_TILES), min(n_tiles, -(-wide // across)))

    def dealt(rows: DataFrame, own: int, other: int, kind: int) -> DataFrame:
        """Tiles go to a group of their side, and once to each group of the other."""
        group = F.pmod(F.xxhash64("tile"), F.lit(own))
        every = F.explode(F.sequence(F.lit(0), F.lit(other - 1)))
        return rows.withColumns({"mine": group, "theirs": every, "kind": F.lit(kind)})

    first = dealt(anchors, across, along, 0).withColumn("cell", F.expr(f"mine * {along} + theirs"))
    then = dealt(candidates, along, across, 1).withColumn("cell", F.expr(f"theirs * {along} + mine"))
    cells = across * along

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                if row["cell"] != cell:
                    yield from (arrow_batch(FOUND, h.found()) for h in held)
                    cell, held = row["cell"], []
                tile = Tile(*(row[n] for n in TILES.names[1:]))
                if row["kind"] == 0:
                    held.append(kind(tile))
                    continue
                for h in held:
                    if h.anchors.width == tile.width:
                        h.meet(tile)
        yield from (arrow_batch(FOUND, h.found()) for h in held)

    both = first.unionByName(then).select("cell", "kind", *TILES.names[1:])
    return both.repartition(cells, "cell").sortWithinPartitions("cell", "kind").mapInArrow(run, FOUND_DDL)


def _best(found: DataFrame, k: int) -> DataFrame:
    """The heaps of all cells merged: the k best of each anchor and place, in order."""
    order = Window.partitionBy("row", "place").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, is_anchor: F.Column) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` has ``vec_id``, ``embedding`` and ``label``; ``is_anchor`` is a condition
    on the column ``id``.
    """
    base = whole_numbers(rows)
    asked = base.where(is_anchor)
    n_asked = asked.count()
    candidates = tiles(base, base.count(), TILE)
    near = met(tiles(asked, n_asked, ANCHOR_TILE), candidates, Positives)
    positives = saved(
        _best(near, POSITIVES).select("row", (F.col("rank") - 1).alias("place"), "id", "score"), "positives"
    )
    scores = positives.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("place", "score"))).alias("p")  # five at most
    )
    lacking = F.array_repeat(F.lit(-1).cast("long"), POSITIVES)
    windowed = asked.join(scores, "row").withColumn("w", F.slice(F.concat("p.score", lacking), 1, POSITIVES))
    far = met(tiles(windowed, n_asked, ANCHOR_TILE), candidates, Negatives)
    negatives = _best(far, NEGATIVES).select(
        "row", "anchor_id", "place", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    named = positives.select(
        "row", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return negatives.join(named, ["row", "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(read(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)
