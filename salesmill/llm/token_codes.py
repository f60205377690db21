"""Operator 1: token ids in directly addressable codes.

An id is split into chunks of eight bits, lowest first. Level k holds the k-th
chunk of every id that has one, and a bitmap that says which of them go on to
level k+1. With a directory of set bits per block of the bitmap, the place of an
id on the next level is a rank, so any id is read without decoding others.

Files are Parquet tables of segments in ascending order of ``doc_id``: one row
holds the codes of whole documents, about ``SEGMENT_IDS`` ids. Beside them lies
a small table with the first id of each partition, from which the place of every
segment in the whole corpus follows.

Defined results: a null text is an empty one and keeps only its end id; a null
``doc_id`` sorts first; repeated rows are documents of their own, in the order of
a hash of their text; other columns are ignored; an empty table gives no segment
and no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesmill.llm.base import arrow_batch, read, shuffle_width, slices, small_batches, texts_of
from salesmill.llm.encode import WORD_BPE, encoder
from salesmill.session import scratch_path

END_ID = 1
SEGMENT_IDS = 1 << 19
STRETCH = 1 << 14  # ids of a segment that are looked up together
BLOCK = 512  # bits counted together in a rank directory
MAGIC = 0x31434144
BATCH_BYTES = 2 << 20

SEGMENT = pa.schema(
    [
        ("partition", pa.int32()),
        ("segment", pa.int32()),
        ("first", pa.int64()),
        ("n_ids", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
        ("codes", pa.binary()),
    ]
)
SEGMENT_SQL = (
    "partition int, segment int, first long, n_ids long,"
    " doc_ids array<long>, lengths array<long>, codes binary"
)


def pack(ids: np.ndarray) -> bytes:
    """The levels of a run of ids: counts first, then chunks, bitmap and directory of each."""
    rest = np.ascontiguousarray(ids, np.uint32)
    head, body = [], []
    while True:
        chunks = (rest & np.uint32(255)).astype(np.uint8)
        more = rest > 255
        bits = np.packbits(more, bitorder="little")
        sums = np.add.reduceat(more, np.arange(0, len(more), BLOCK), dtype=np.uint32)
        ranks = np.concatenate([[0], np.cumsum(sums)[:-1]]) if len(sums) else sums
        head.append(len(rest))
        body += [chunks.tobytes(), bits.tobytes(), ranks.astype("<u4").tobytes()]
        if not more.any():
            break
        rest = rest[more] >> np.uint32(8)
    return np.array([MAGIC, len(head), *head], "<u4").tobytes() + b"".join(body)


class Codes:
    """Random access to the ids of one packed run."""

    def __init__(self, blob: bytes):
        magic, levels = np.frombuffer(blob, "<u4", 2)
        if magic != MAGIC:
            raise ValueError("not a run of token codes")
        counts = np.frombuffer(blob, "<u4", int(levels), 8).astype(np.int64)
        at = 8 + 4 * int(levels)
        self.levels = []
        for n in counts.tolist():
            chunks = np.frombuffer(blob, np.uint8, n, at)
            at += n
            bits = np.frombuffer(blob, np.uint8, -(-n // 8), at)
            at += -(-n // 8)
            ranks = np.frombuffer(blob, "<u4", -(-n // BLOCK), at)
            at += 4 * (-(-n // BLOCK))
            self.levels.append((chunks, bits, ranks))

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def take(self, places: np.ndarray) -> np.ndarray:
        """The ids at any places, reading nothing of the others but bits of their block."""
        at = np.asarray(places, np.int64)
        out = np.zeros(len(at), np.uint32)
        who = np.arange(len(at))
        for level, (chunks, bits, ranks) in enumerate(self.levels):
            out[who] |= chunks[at].astype(np.uint32) << np.uint32(8 * level)
            on = (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            who, at = who[on], at[on]
            if not len(who):
                break
            at = _rank(bits, ranks, at)
        return out

    def slice(self, start: int, stop: int) -> np.ndarray:
        """Neighbouring ids: their chunks are neighbours on every level."""
        out = np.zeros(stop - start, np.uint32)
        who = np.arange(stop - start)
        for level, (chunks, bits, ranks) in enumerate(self.levels):
            out[who] |= chunks[start:stop].astype(np.uint32) << np.uint32(8 * level)
            byte = start >> 3
            on = np.unpackbits(bits[byte : -(-stop // 8)], bitorder="little")
            on = on[start - 8 * byte : stop - 8 * byte] == 1
            if not on.any():
                break
            who = who[on]
            start = int(_rank(bits, ranks, np.array([start]))[0])
            stop = start + len(who)
        return out


_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint32)


def _rank(bits: np.ndarray, ranks: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Set bits before each place: the directory, then the bytes of its block."""
    block = at // BLOCK
    first = block * (BLOCK // 8)
    columns = first[:, None] + np.arange(BLOCK // 8)
    whole = columns < (at >> 3)[:, None]
    counts = np.where(whole, _ONES[bits[np.minimum(columns, len(bits) - 1)]], 0).sum(1, dtype=np.int64)
    last = bits[np.minimum(at >> 3, len(bits) - 1)] & ((1 << (at & 7)) - 1).astype(np.uint8)
    return ranks[block].astype(np.int64) + counts + _ONES[last]


def _packer(path: str, kind: str, segment_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        partition = TaskContext.get().partitionId()
        encode = encoder(path, kind)
        first, segment = 0, 0
        doc_ids, runs, size = [], [], 0

        def closed() -> pa.RecordBatch:
            row = {
                "partition": [partition],
                "segment": [segment],
                "first": [first],
                "n_ids": [size],
                "doc_ids": [doc_ids],
                "lengths": [[len(r) for r in runs]],
                "codes": [pack(np.concatenate(runs))],
            }
            return arrow_batch(SEGMENT, row)

        for batch in slices(batches, "text", BATCH_BYTES):
            for doc_id, ids in zip(
                batch.column("doc_id").to_pylist(), encode.ids(texts_of(batch.column("text")))
            ):
                doc_ids.append(doc_id)
                runs.append(np.append(ids, np.uint32(END_ID)))
                size += len(runs[-1])
                if size >= segment_ids:
                    yield closed()
                    first, segment = first + size, segment + 1
                    doc_ids, runs, size = [], [], 0
        if runs:
            yield closed()

    return run


def write_codes(
    docs: DataFrame,
    path: str,
    vocabulary: str = WORD_BPE,
    kind: str = "word",
    segment_ids: int = SEGMENT_IDS,
) -> None:
    """Encodes all texts and writes their ids below ``path``, ordered by ``doc_id``.

    Texts are dealt by ranges of the key, so the only shuffle is the sort that
    the order asks for. Positions in the corpus need one number per partition.
    """
    spark = docs.sparkSession
    small_batches(spark)
    order = [F.col("doc_id"), F.xxhash64("text")]
    (
        docs.select(F.col("doc_id").cast("long"), "text")
        .repartitionByRange(shuffle_width(spark), *order)
        .sortWithinPartitions(*order)
        .mapInArrow(_packer(vocabulary, kind, segment_ids), SEGMENT_SQL)
        .write.parquet(f"{path}/segments")
    )
    totals = spark.read.parquet(f"{path}/segments").groupBy("partition").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)
    (
        totals.select("partition", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
        .coalesce(1)
        .write.parquet(f"{path}/directory")
    )


def segments(spark: SparkSession, path: str) -> DataFrame:
    """Segments with the place of their first id in the corpus, as ``start``."""
    directory = spark.read.parquet(f"{path}/directory")  # one row per partition
    rows = spark.read.parquet(f"{path}/segments").join(F.broadcast(directory), "partition")
    return rows.withColumn("start", F.col("start") + F.col("first"))


def read_ids(spark: SparkSession, path: str, summary, schema: str) -> DataFrame:
    """Applies ``summary(doc_id, start, ids)`` -> tuple to each document read from the files."""
    names = [part.split()[0] for part in schema.split(",")]

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                codes = Codes(row["codes"])
                ends = np.cumsum(row["lengths"])
                rows = [
                    summary(d, row["start"] + e - n, codes.slice(e - n, e))
                    for d, n, e in zip(row["doc_ids"], row["lengths"], ends.tolist())
                ]
                out = pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})
                yield pa.RecordBatch.from_pandas(out, preserve_index=False)

    return segments(spark, path).select("start", "doc_ids", "lengths", "codes").mapInArrow(run, schema)


def tokens_at(spark: SparkSession, path: str, places: DataFrame) -> DataFrame:
    """The id at each distinct ``place`` of the corpus; places beyond its end are left out.

    A place meets its segment by the segment's range; only the segments asked
    for are opened, and of those only the chunks on the way.
    """
    parts = segments(spark, path)
    asked = places.select(F.col("place").cast("long").alias("place")).where("place is not null")
    per = parts.select("partition", "segment", "start", "n_ids")
    cell = SEGMENT_IDS
    cells = per.withColumn(
        "cell",
        F.explode(F.sequence(F.expr(f"start div {cell}"), F.expr(f"(start + n_ids - 1) div {cell}"))),
    )
    found = asked.withColumn("cell", F.expr(f"place div {cell}")).join(cells, "cell")
    found = found.where("place >= start and place < start + n_ids").select(
        "partition", "segment", (F.col("place") - F.col("start")).alias("at"), "place"
    )
    # Distinct places of a stretch of a segment go together, a bounded number.
    lists = found.groupBy("partition", "segment", F.expr(f"at div {STRETCH}")).agg(
        F.collect_set(F.struct("at", "place")).alias("asked")
    )
    joined = lists.join(parts.select("partition", "segment", "codes"), ["partition", "segment"])

    def take(batches):
        for batch in batches:
            for asked, codes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = Codes(codes).take(np.array([a["at"] for a in asked]))
                yield pa.RecordBatch.from_pydict(
                    {"place": [a["place"] for a in asked], "id": ids.astype(np.int64)}
                )

    return joined.select("asked", "codes").mapInArrow(take, "place long, id long")


def op1_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded, written and read back: place, length and checksum of its ids."""
    path = scratch_path(spark, "token-codes")
    write_codes(read(spark, sf_dir, "documents"), path)

    def summary(doc_id, start, ids):
        return doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())

    return read_ids(
        spark, path, summary, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
