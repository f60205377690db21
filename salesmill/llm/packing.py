"""Operator 4: best-fit packing of documents into sequences, by bin completion.

Only lengths matter for packing, and there are at most as many different ones as
a sequence has tokens. So Spark counts the pieces of each length, the driver
packs that table of counts, and Spark deals the resulting places to the pieces.

The packer fills the sequence of the largest piece left: it lists fillings that
no other one dominates (none can take a larger piece instead of one it holds),
tries them in order of waste, and applies a filling to as many equal sequences as
the counts allow. A branch ends where the sequences so far and the total left,
rounded up, cannot beat the best packing known; the first one known is best-fit
decreasing. The search ends at the lower bound or after ``NODES`` nodes.

Defined results: a null or empty text is the end id alone; documents longer than
a sequence are cut so that the first piece is the shorter one; repeated rows are
pieces of their own; a null ``doc_id`` is kept; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesmill.llm.base import arrow_batch, lean, read, saved, shuffle_width, slices, small_batches, texts_of
from salesmill.llm.encode import BYTE_BPE, encoder

SEQUENCE = 2048
END_ID = 0
NODES = 4000  # of the search
FILLINGS = 6  # tried at each of its nodes
BATCH_BYTES = 2 << 20

PIECE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
    ]
)
PIECE_SQL = "doc_id long, piece int, start long, length long, ids_crc32 long"

Filling = tuple[tuple[int, int], ...]  # (length, how many) of one sequence


def _cutter(path: str, kind: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, kind)
        for batch in slices(batches, "text", BATCH_BYTES):
            rows: dict = {name: [] for name in PIECE.names}
            runs = encode.ids(texts_of(batch.column("text")))
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), runs):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                edges = list(range(len(ids), 0, -capacity))[::-1]
                for piece, (s, e) in enumerate(zip([0, *edges], edges)):
                    rows["doc_id"].append(doc_id)
                    rows["piece"].append(piece)
                    rows["start"].append(s)
                    rows["length"].append(e - s)
                    rows["ids_crc32"].append(zlib.crc32(ids[s:e].tobytes()))
            yield arrow_batch(PIECE, rows)

    return run


def pieces(
    docs: DataFrame,
    capacity: int = SEQUENCE,
    vocabulary: str = BYTE_BPE,
    kind: str = "byte",
    end_id: int = END_ID,
) -> DataFrame:
    """The documents' pieces, none longer than a sequence."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(lean(_cutter(vocabulary, kind, capacity, end_id)), PIECE_SQL)


class Packer:
    """Bin completion over a table of counts by length."""

    def __init__(self, counts: dict[int, int], capacity: int, nodes: int = NODES):
        self.capacity = capacity
        self.counts = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            self.counts[length] += n
        self.nodes = nodes
        self.total = int((np.arange(capacity + 1) * self.counts).sum())
        self.bound = self._lower_bound()
        self.best = self._best_fit()
        self.best_bins = sum(n for _, n in self.best)

    def _lower_bound(self) -> int:
        """No packing has fewer sequences: total, and pieces that need one each."""
        c, n, sizes = self.capacity, self.counts, np.arange(self.capacity + 1)
        best = -(-self.total // c)
        upto, mass = np.cumsum(n), np.cumsum(n * sizes)
        for k in range(1, c // 2 + 1):
            large = int(upto[c] - upto[c - k])
            middle = int(upto[c - k] - upto[c // 2])
            middle_mass = int(mass[c - k] - mass[c // 2])
            small_mass = int(mass[c // 2] - mass[k - 1])
            over = small_mass - (middle * c - middle_mass)
            best = max(best, large + middle + max(0, -(-over // c)))
        return best

    def _best_fit(self) -> list[tuple[Filling, int]]:
        """Best-fit decreasing, pieces of one length and bins of one kind at a time."""
        room: dict[int, dict[tuple[int, ...], int]] = {}
        free = []  # the rooms there are, ascending
        for length in np.flatnonzero(self.counts)[::-1].tolist():
            left = int(self.counts[length])
            while left:
                at = bisect_right(free, length - 1)
                if at == len(free):
                    fit = self.capacity // length
                    full, rest = divmod(left, fit)
                    for k, n in ((fit, full), (rest, 1 if rest else 0)):
                        if n:
                            self._put(room, free, self.capacity - k * length, (length,) * k, n)
                    break
                r = free[at]
                kind, n = next(iter(room[r].items()))
                k = min(n, left)
                room[r][kind] -= k
                if not room[r][kind]:
                    del room[r][kind]
                if not room[r]:
                    del room[r]
                    free.pop(at)
                self._put(room, free, r - length, (*kind, length), k)
                left -= k
        return [(_filling(kind), n) for kinds in room.values() for kind, n in kinds.items()]

    @staticmethod
    def _put(room: dict, free: list[int], r: int, kind: tuple[int, ...], n: int) -> None:
        if r not in room:
            room[r] = {}
            free.insert(bisect_right(free, r), r)
        room[r][kind] = room[r].get(kind, 0) + n

    def _fillings(self, counts: np.ndarray, largest: int) -> list[tuple[int, Filling]]:
        """(waste, filling) of the room beside the largest piece, undominated, best first."""
        counts[largest] -= 1
        have = np.flatnonzero(counts)
        found: set[tuple[int, ...]] = set()
        self._extend(counts, have, self.capacity - largest, (), found, [3 * FILLINGS])
        out = []
        for kind in found:
            waste = self.capacity - largest - sum(kind)
            if not self._dominated(counts, have, kind, waste):
                out.append((waste, len(kind), _filling((largest, *kind))))
        counts[largest] += 1
        out.sort(key=lambda f: (f[0], f[1], tuple(-length for length, _ in f[2])))
        return [(waste, filling) for waste, _, filling in out[:FILLINGS]]

    def _extend(self, counts, have, room, kind, found, budget) -> None:
        """Adds pieces to a filling, none larger than its last; exact ends come first."""
        top = min(room, kind[-1] if kind else room)
        fits = have[: np.searchsorted(have, top, side="right")]
        if len(kind):
            used = kind.count(kind[-1])
            if len(fits) and fits[-1] == kind[-1] and counts[kind[-1]] <= used:
                fits = fits[:-1]
        if not len(fits):
            found.add(kind)
            budget[0] -= 1
            return
        if room <= top and counts[room] > kind.count(room):
            found.add((*kind, room))
            budget[0] -= 1
        other = room - fits
        ends = fits[(other > 0) & (other <= fits)]
        ends = ends[counts[room - ends] > (2 * (room - ends) == room)]
        for a in ends[::-1][:2].tolist():
            if counts[a] > kind.count(a) and counts[room - a] > kind.count(room - a) + (2 * a == room):
                found.add((*kind, a, room - a))
                budget[0] -= 1
        for a in fits[::-1][:2].tolist():
            if budget[0] <= 0:
                return
            self._extend(counts, have, room - a, (*kind, a), found, budget)

    @staticmethod
    def _dominated(counts, have, kind: tuple[int, ...], waste: int) -> bool:
        """True if a larger piece fits in the place of one of the filling, or one more fits."""
        if not waste:
            return False
        for a in {*kind, 0}:
            larger = have[np.searchsorted(have, a, side="right") :]
            larger = larger[: np.searchsorted(larger, a + waste, side="right")]
            if any(counts[b] > kind.count(b) for b in larger[::-1][:8].tolist()):
                return True
        return False

    def solve(self) -> list[tuple[Filling, int]]:
        """Fillings and how many sequences each is used for."""
        stack: list = [(self.counts.copy(), self.total, 0, None)]
        nodes = 0
        while stack and self.best_bins > self.bound and nodes < self.nodes:
            counts, total, bins, path = stack.pop()
            while total:
                nodes += 1
                if bins + -(-total // self.capacity) >= self.best_bins or nodes >= self.nodes:
                    break
                largest = int(np.flatnonzero(counts)[-1])
                options = self._fillings(counts, largest)
                for _, other in reversed(options[1:]):
                    *after, n = self._apply(counts, total, bins, other)
                    stack.append((*after, ((other, n), path)))
                filling = options[0][1]
                counts, total, bins, n = self._apply(counts, total, bins, filling)
                path = ((filling, n), path)
            if not total and bins < self.best_bins:
                self.best_bins, self.best = bins, []
                while path:
                    self.best.append(path[0])
                    path = path[1]
        return self.best

    @staticmethod
    def _apply(counts, total, bins, filling: Filling):
        n = min(int(counts[length]) // k for length, k in filling)
        counts = counts.copy()
        for length, k in filling:
            counts[length] -= n * k
        return counts, total - n * sum(length * k for length, k in filling), bins + n, n


def _filling(kind: tuple[int, ...]) -> Filling:
    lengths = sorted(set(kind), reverse=True)
    return tuple((length, kind.count(length)) for length in lengths)


def places(plan: list[tuple[Filling, int]]) -> dict[int, np.ndarray]:
    """For each length its runs: first rank, first sequence, pieces per sequence, offset."""
    runs: dict[int, list] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for filling, bins in plan:
        offset = 0
        for length, k in filling:
            runs.setdefault(length, []).append((taken.get(length, 0), sequence, k, offset))
            taken[length] = taken.get(length, 0) + bins * k
            offset += length * k
        sequence += bins
    return {length: np.array(r, np.int64) for length, r in runs.items()}


def _placer(runs: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for one in np.unique(length).tolist():
                rows = np.flatnonzero(length == one)
                r = runs[one]
                at = r[np.searchsorted(r[:, 0], rank[rows], side="right") - 1]
                inside = rank[rows] - at[:, 0]
                sequence[rows] = at[:, 1] + inside // at[:, 2]
                offset[rows] = at[:, 3] + inside % at[:, 2] * one
            columns = {n: batch.column(n) for n in batch.schema.names if n != "rank"}
            columns |= {"sequence_id": pa.array(sequence), "offset": pa.array(offset)}
            yield pa.RecordBatch.from_pydict(columns)

    return run


def pack(cut: DataFrame, capacity: int = SEQUENCE, nodes: int = NODES) -> DataFrame:
    """Sequences and offsets of pieces in a written table, each with a number ``row`` of its own.

    A piece's rank among those of its length is its rank within a small group of
    them plus the sizes of the groups before, so that a length which many pieces
    share is still ranked by many tasks.
    """
    spark = cut.sparkSession
    names = [n for n in cut.columns if n != "row"]
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    runs = places(Packer(counts, capacity, nodes).solve())
    rows = cut.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(4 * shuffle_width(spark))))
    sizes = rows.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "salt", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inner = F.row_number().over(Window.partitionBy("length", "salt").orderBy("row"))
    ranked = rows.withColumn("inner", inner - 1).join(sizes, ["length", "salt"])
    ranked = ranked.select(*names, (F.col("base") + F.col("inner")).alias("rank"))
    schema = ", ".join(f"`{n}` {t}" for n, t in cut.dtypes if n != "row") + ", sequence_id long, offset long"
    return ranked.mapInArrow(_placer(runs), schema)


def pack_documents(docs: DataFrame, capacity: int = SEQUENCE) -> DataFrame:
    """Pieces of all documents with their places in as few sequences as were found."""
    small_batches(docs.sparkSession)
    # Numbers given here are fixed once they are written.
    cut = pieces(docs, capacity).withColumn("row", F.monotonically_increasing_id())
    return pack(saved(cut, "pieces"), capacity)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"))
