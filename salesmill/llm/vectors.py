"""Tables of vectors: which rows take part, shards, and queries that meet them in blocks."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GROUP = 64  # blocks of queries that one copy of a shard is sent for


def usable(column: str, zero_counts: bool) -> Column:
    """Vectors with components, all of them finite; without ``zero_counts`` not all zero."""
    v = F.col(column)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    ok = v.isNotNull() & (F.size(v) > 0) & fine
    if not zero_counts:
        ok = ok & F.exists(v, lambda x: x != 0)
    return F.coalesce(ok, F.lit(False))


def vectors(rows: DataFrame, key: str, column: str, zero_counts: bool) -> DataFrame:
    """(row, id, v) of the rows that take part; ``row`` numbers them in the order of their ids.

    Rows are told apart by number, not by id, so those of a repeated id all count.
    Write the result before use: numbers hold for one run of the plan only. As one
    range of ids is one partition, numbers grow from partition to partition; equal
    ids are spread by vector and place, so that none has to lie in one partition.
    """
    found = rows.where(F.col(key).isNotNull() & usable(column, zero_counts)).select(
        F.col(key).cast("long").alias("id"),
        F.col(column).cast("array<double>").alias("v"),
        F.monotonically_increasing_id().alias("place"),
    )
    spread = found.withColumn("h", F.xxhash64("v", "place"))
    ordered = spread.repartitionByRange("id", "h").sortWithinPartitions("id", "h")
    return ordered.select(F.monotonically_increasing_id().alias("row"), "id", "v")


def shard_count(count: int, per_shard: int) -> int:
    return max(1, -(-count // per_shard))


def shards(rows: DataFrame, n: int, build: Callable) -> DataFrame:
    """(shard, size, body, names): ``build(rows, matrix)`` of each of n shards, and the ids of its rows.

    Vectors of another length than most share no shard with those: the length is
    part of the shard.
    """
    dealt = rows.select("row", "id", "v", F.size("v").alias("size"), F.pmod(F.xxhash64("row"), F.lit(n)).alias("shard"))

    def built(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row")
        body = build(pdf["row"].to_numpy(), np.stack(pdf["v"].to_numpy()))
        names = pdf[["row", "id"]].to_numpy(np.int64).T.tobytes()
        out = {"shard": pdf["shard"].iloc[0], "size": pdf["size"].iloc[0], "body": body, "names": names}
        return pd.DataFrame({name: [value] for name, value in out.items()})

    return dealt.groupBy("shard", "size").applyInPandas(built, "shard long, size int, body binary, names binary")


def blocks(queries: DataFrame, count: int, per_block: int) -> DataFrame:
    """(block, size, rows, ids, vs): queries gathered about ``per_block`` at a time."""
    n = max(1, -(-count // per_block))
    return (
        queries.withColumn("size", F.size("v"))
        .withColumn("block", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(n)))
        .groupBy("block", "size")
        .agg(F.collect_list(F.struct("row", "id", "v")).alias("q"))
        .select("block", "size", F.col("q.row").alias("rows"), F.col("q.id").alias("ids"), F.flatten("q.v").alias("vs"))
    )


def met(
    shard_rows: DataFrame, block_rows: DataFrame, numbers: tuple[int, int], n_blocks: int, search: Callable, score: str
) -> DataFrame:
    """Every block searched in the shards of some numbers: the best found in each.

    Gives (query, query_id, vec, vec_id, score), ``query`` and ``vec`` being rows. The
    blocks that a shard meets are cut into groups of about ``GROUP``; a group is sent
    the shard once, ahead of its blocks, and is a task's work by itself. ``search(body,
    rows, queries, floors)`` gives places of queries, rows and scores; ``floors`` is
    None unless the blocks have such a column.
    """
    first, end = numbers
    n = max(1, -(-n_blocks // GROUP))
    floored = "floors" in block_rows.columns
    kind = "array<bigint>"
    asks = block_rows.select(
        F.explode(F.sequence(F.lit(first).cast("long"), F.lit(end - 1).cast("long"))).alias("shard"),
        "size",
        F.pmod("block", F.lit(n)).cast("long").alias("part"),
        F.lit(1).alias("turn"),
        F.lit(None).cast("binary").alias("body"),
        F.lit(None).cast("binary").alias("names"),
        F.col("rows").cast(kind).alias("rows"),
        F.col("ids").cast(kind).alias("ids"),
        F.col("vs").cast("array<double>").alias("vs"),
        (F.col("floors") if floored else F.lit(None)).cast(kind).alias("floors"),
    )
    opens = shard_rows.where(F.col("shard").between(first, end - 1)).select(
        "shard",
        "size",
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias("part"),
        F.lit(0).alias("turn"),
        "body",
        "names",
        *(F.lit(None).cast(kind).alias(c) for c in ("rows", "ids")),
        F.lit(None).cast("array<double>").alias("vs"),
        F.lit(None).cast(kind).alias("floors"),
    )
    group = ["shard", "size", "part"]
    dealt = opens.unionByName(asks).repartition(*group).sortWithinPartitions(*group, "turn")

    def run(batches):
        key = body = names = None
        for batch in batches:
            at = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            for i in range(batch.num_rows):
                own = tuple(at[c][i].as_py() for c in group)
                if at["turn"][i].as_py() == 0:
                    key, body = own, at["body"][i].as_py()
                    names = np.frombuffer(at["names"][i].as_py(), np.int64).reshape(2, -1)
                elif own == key:  # else no vector of this length is in the shard
                    rows, ids = (at[c][i].values.to_numpy() for c in ("rows", "ids"))
                    vs = at["vs"][i].values.to_numpy().reshape(len(rows), -1)
                    floors = at["floors"][i].values.to_numpy() if floored else None
                    who, found, scores = search(body, rows, vs, floors)
                    vec_ids = names[1][np.searchsorted(names[0], found)]
                    yield pa.RecordBatch.from_pydict(
                        {"query": rows[who], "query_id": ids[who], "vec": found, "vec_id": vec_ids, "score": scores}
                    )

    return dealt.mapInArrow(run, f"query long, query_id long, vec long, vec_id long, score {score}")


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query over all shards, ties to the smaller id; ``query`` is the query's row."""
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec")
    rows = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return rows.select("query", "query_id", "rank", "vec_id", "score")


def dumped(**arrays: np.ndarray) -> bytes:
    """Arrays as bytes."""
    import io

    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def loaded(body: bytes) -> dict[str, np.ndarray]:
    import io

    with np.load(io.BytesIO(body)) as arrays:
        return {name: arrays[name] for name in arrays.files}
