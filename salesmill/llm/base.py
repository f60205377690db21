"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmill.session import scratch_path


Mapper = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def small_batches(spark: SparkSession) -> None:
    """Texts go to Python and to files some megabytes at a time: rows are of very different sizes.

    A task that writes Parquet holds a whole row group, so these are smaller, too.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(2 << 20))
    spark.conf.set("parquet.block.size", str(32 << 20))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def saved(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared scratch space and read back: a cut in the lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def row_key() -> F.Column:
    """Identity of a document from its contents: copies of a row share it, wherever they lie."""
    return F.xxhash64(F.col("doc_id"), F.col("text"))


def held_out() -> F.Column:
    """Rows no model learns from. A null id is never held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def texts_of(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes, nulls as empty ones."""
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


def concatenated(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes in one array, and where each text starts (one more entry than texts)."""
    ends = np.cumsum([0, *map(len, texts)], dtype=np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), ends


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about ``limit`` bytes of a text column, one row at least."""
    for batch in batches:
        sizes = np.array([0 if n is None else n for n in _lengths(batch.column(column))], np.int64)
        done = 0
        while done < batch.num_rows:
            total = np.cumsum(sizes[done:])
            n = max(1, int(np.searchsorted(total, limit, side="right")))
            yield batch.slice(done, n)
            done += n


def _lengths(column: pa.Array) -> list[int | None]:
    import pyarrow.compute as pc

    return pc.binary_length(column).to_pylist()


def one_thread() -> None:
    """Tasks share a machine: native libraries inside one keep to one thread."""
    for name in ("RAYON_NUM_THREADS", "OMP_NUM_THREADS", "OPENBLAS_NUM_THREADS"):
        os.environ.setdefault(name, "1")
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


def lean(mapper: Mapper) -> Mapper:
    """The same, giving freed memory back at its end: workers wait for their next task idle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from mapper(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
                trim(0)

    return run


def arrow_batch(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], type=f.type) for f in schema], schema=schema
    )


class Filter:
    """Bits of the hashes in a column of numbers, to leave out rows before a shuffle.

    It has a fixed size, whatever the input: as it fills up it spares less, and
    the join behind it decides.
    """

    BITS = 1 << 26

    def __init__(self, hashes: DataFrame):
        (name,) = hashes.columns
        rows = (
            hashes.select(F.expr(f"`{name}` & {self.BITS - 1}").alias("slot"))
            .groupBy(F.expr("slot div 64").alias("at"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("bits"))
        )
        table = rows.toArrow()  # at most BITS / 64 rows
        bits = np.zeros(self.BITS // 64, np.int64)
        bits[table["at"].to_numpy()] = table["bits"].to_numpy()
        self.bits = bits.view(np.uint64)

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        slot = hashes.astype(np.int64) & (self.BITS - 1)
        return (self.bits[slot >> 6] >> (slot & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
