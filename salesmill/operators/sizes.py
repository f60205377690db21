"""Measured sizes, which decide whether a table is sent to all tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Tables of up to so many bytes are broadcast. A hash table takes some three times that.
BROADCAST_BYTES = 64 << 20
ROW_BYTES = 40  # what a row takes besides its texts


def measured_bytes(rows: DataFrame) -> int:
    """Bytes of all rows, by one pass over them: persist what is dear to compute."""
    texts = [F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in rows.dtypes if kind == "string"]
    size = F.lit(ROW_BYTES).cast("long")
    for text in texts:
        size = size + text
    return rows.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]


def fits(rows: DataFrame, at_most: int | None = None) -> bool:
    """Whether the rows are few and short enough to be sent to all tasks."""
    return measured_bytes(rows) <= (BROADCAST_BYTES if at_most is None else at_most)
