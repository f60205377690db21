"""Hard negatives against plain loops and against SQL; Strassen's product against numpy's."""

import pathlib
import random

import duckdb
import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from salesmill.llm import hard_negatives as hn
from salesmill.llm.queries import ORACLES

SF = "/root/testdata/sf0.001"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


@pytest.mark.parametrize("m,n,k,leaf", [(1, 1, 1, 1), (7, 5, 3, 1), (64, 33, 65, 2), (40, 90, 64, 32), (100, 3, 50, 8)])
def test_strassen_product(m, n, k, leaf):
    rng = np.random.default_rng(m)
    a, b = (rng.integers(-(1 << 20), 1 << 20, (rows_, k)) for rows_ in (m, n))
    assert (hn.multiplied(a, b, leaf) == a @ b.T).all()


def test_window_is_the_rule_in_whole_numbers():
    for positive in [*range(-250, 250), 10**17 + 7, 9 * 10**18]:
        low, high = (int(x[0]) for x in hn.window(np.array([positive])))
        for score in (low - 1, low, high, high + 1):
            inside = 50 * positive <= 100 * score <= 95 * positive
            assert inside == (low <= score <= high), (positive, score)


def plain(table):
    """Lists and sorting only."""
    taken = []
    for vec_id, v, label in table:
        fine = v and all(x is not None and np.isfinite(x) for x in v)
        if vec_id is None or label is None or not fine:
            continue
        own = (label + 1) % 10 if vec_id % 7 == 0 else label
        taken.append((vec_id, own, [int(np.floor(256 * float(x))) for x in v]))
    found = []
    for i, (anchor, label, v) in enumerate(taken):
        if anchor % 50:
            continue
        scored = [
            (-sum(x * y for x, y in zip(v, w)), other, own)
            for j, (other, own, w) in enumerate(taken)
            if j != i and len(w) == len(v)
        ]
        for p_score, positive, _ in sorted(s for s in scored if s[2] == label)[:5]:
            inside = sorted(s for s in scored if s[2] != label and 50 * -p_score <= 100 * -s[0] <= 95 * -p_score)
            for rank, (n_score, negative, _) in enumerate(inside[:3], 1):
                found.append((anchor, positive, rank, negative, -p_score, -n_score))
    return sorted(found)


def made(seed, n, width):
    draw = random.Random(seed)
    table = [
        (i, [round(draw.uniform(-0.2, 1), 2) for _ in range(width)], 3 if i % 3 else draw.randrange(10))
        for i in range(n)
    ]
    # Copies of one vector, an anchor among them, and repeated ids.
    table += [(1000 + i, table[50][1], i % 4) for i in range(60)] + table[40:60] + table[50:51]
    # Other lengths, zeros and what takes no part.
    table += [(2000 + i, [0.5] * (i % 4 + 1), i % 2) for i in range(40)] + [(2100, [0.0] * width, 1)]
    table += [(None, [1.0] * width, 1), (2150, None, 1), (2200, [], 1), (2250, [1.0] * width, None)]
    return [*table, (2300, [float("nan")] * width, 1), (2350, [None, *[1.0] * (width - 1)], 1), (2400, [float("inf")], 1)]


SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("small", [False, True])
def test_against_plain_loops(spark, monkeypatch, small):
    if small:
        for name, value in {"TILE": 16, "ANCHOR_TILE": 2, "CELL_ANCHORS": 1, "CELL_TILES": 2, "LEAF": 2}.items():
            monkeypatch.setattr(hn, name, value)
    table = made(1, 300, 9)
    frame = spark.createDataFrame(table, SCHEMA)
    as_stored = [tuple(r) for r in frame.collect()]
    odd = frame.repartition(5).withColumn("row", F.lit("x")).withColumn("cell", F.lit(1)).withColumn("v", F.lit(0))
    got = hn.hard_negatives(odd, F.col("id") % 50 == 0)
    assert got.columns == COLUMNS
    expected = plain(as_stored)
    assert len(expected) > 50 and rows(got, *COLUMNS) == sorted(expected, key=repr)


def test_query_agrees_with_sql(spark):
    connection = duckdb.connect()
    for path in pathlib.Path(SF).glob("embeddings.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    expected = connection.execute(f"SELECT {', '.join(COLUMNS)} FROM ({ORACLES['op12_hard_negatives']})").fetchall()
    assert expected
    assert rows(hn.op12_hard_negatives(spark, SF), *COLUMNS) == sorted(expected, key=repr)


def test_nothing_to_mine(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert hn.hard_negatives(empty, F.col("id") % 50 == 0).count() == 0
    alone = spark.createDataFrame([(50, [1.0], 1), (51, [1.0], 2)], SCHEMA)
    assert hn.hard_negatives(alone, F.col("id") % 50 == 0).count() == 0
