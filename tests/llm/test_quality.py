"""Quality: features against plain counting, tables against plain sums, held-out accuracy."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesmill.llm import quality as q

SF = "/root/testdata/sf0.01"


def plain(text):
    """Features by splitting and counting."""
    raw = text.encode()
    words = [w for w in re.split(rb"[ \t\n\v\f\r]+", raw) if w]
    lines = [line for line in raw.split(b"\n") if line]
    upper, lower = (len(re.findall(p, raw)) for p in (rb"[A-Z]", rb"[a-z]"))
    wide = len(re.findall(rb"[\x80-\xff]", raw))
    stops, signs = len(re.findall(rb"[.?]", raw)), len(re.findall(rb"""[,;:'"()-]""", raw))
    digits, blanks = len(re.findall(rb"[0-9]", raw)), len(re.findall(rb"[ \t\n\v\f\r]", raw))
    odd = len(raw) - upper - lower - wide - stops - signs - digits - blanks
    threes = list(zip(words, words[1:], words[2:]))
    size, n, m = max(1, len(raw)), max(1, len(words)), max(1, len(lines))
    line_words = [len([w for w in re.split(rb"[ \t\v\f\r]+", line) if w]) for line in lines]
    shouted = [w for w in words if len(re.findall(rb"[A-Z]", w)) > 1 and not re.search(rb"[a-z]", w)]
    return [
        np.log1p(len(raw)), np.log1p(len(words)), np.log1p(len(lines)), (upper + lower + wide) / size,
        upper / max(1, upper + lower), digits / size, wide / size, blanks / size, stops / n, signs / n, odd / n,
        sum(map(len, words)) / n, np.log1p(max(map(len, words), default=0)),
        len(shouted) / n, len([w for w in words if not re.search(rb"[A-Za-z\x80-\xff]", w)]) / n,
        len(set(words)) / n, len(set(threes)) / max(1, len(threes)),
        len(words) / m, sum(c < 4 for c in line_words) / m, 1 - len(set(lines)) / m,
        sum(line[-1:] in b".?" for line in lines) / m, len(re.findall(rb"(?<![^ \t\n\v\f\r])[A-Z]", raw)) / n,
    ]


def test_features(prose):
    texts = ["", "a", "A. B?\n\n\nA. B?\nline three, here", "SHOUT!! NOW!! x 12 | 3,4", "äöü ÄÖ\tß", " \n ", "wo rd " * 5000]
    texts += [prose(i, 30).title() + ".\n" + prose(i, 4) for i in range(20)]
    got = q.described([t.encode() for t in texts])
    assert got.shape == (len(texts), len(q.FEATURES))
    expected = np.array([plain(t) for t in texts])
    # Nothing to count is a share of 0, but no line repeats another where there is none.
    empty = [i for i, t in enumerate(texts) if not t.strip("\n")]
    expected[empty, q.FEATURES.index("repeated_lines")] = 1
    np.testing.assert_allclose(got, expected)


def test_tables_learn_single_and_paired_features():
    """A label of one feature, and one of two features that neither tells alone."""
    rng = np.random.default_rng(1)
    x = rng.random((4000, 4))
    alone = (x[:, 0] > 0.3).astype(float)
    model = q.fitted(x[:3000], alone[:3000])
    assert np.mean((model.scores(x[3000:]) > 0.5) == alone[3000:]) > 0.97
    both = ((x[:, 1] > 0.5) != (x[:, 2] > 0.5)).astype(float)
    model = q.fitted(x[:3000], both[:3000])
    assert model.pairs[0] == (1, 2)
    assert np.mean((model.scores(x[3000:]) > 0.5) == both[3000:]) > 0.93


def test_score_is_the_sum_of_the_entries():
    rng = np.random.default_rng(2)
    x, y = rng.random((500, 3)), rng.integers(0, 2, 500).astype(float)
    model = q.fitted(x, y)
    total = model.base
    for i, cuts in enumerate(model.cuts):
        total += model.tables[i][sum(c <= x[7, i] for c in cuts)]
    for (i, j), table in zip(model.pairs, model.pair_tables):
        bins = [sum(c <= x[7, k] for c in model.cuts[k]) for k in (i, j)]
        total += table[model.coarse[i][bins[0]], model.coarse[j][bins[1]]]
    assert model.scores(x[7:8])[0] == pytest.approx(1 / (1 + np.exp(-total)))


def test_order_and_copies_of_rows_teach_nothing():
    rng = np.random.default_rng(3)
    x = rng.random((300, 3))
    y = (x[:, 0] + 0.2 * rng.random(300) > 0.6).astype(float)
    order = np.concatenate([rng.permutation(300), np.zeros(500, np.int64)])
    assert (q.fitted(x, y).scores(x) == q.fitted(x[order], y[order]).scores(x)).all()


def corpus(prose, n):
    draw = random.Random(4)
    docs, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        text = prose(i, draw.randint(20, 120)).capitalize() + "."
        docs.append((i, " | ".join(w.upper() + "!!" for w in text.split()) if bad else text))
        labels.append((i, int(not bad), 0))
    return docs, labels


LABELS = "doc_id long, quality int, toxic int"


def test_held_out_documents_and_odd_rows(spark, documents, prose):
    docs, labels = corpus(prose, 500)
    odd = [(None, docs[1][1]), (900, None), (901, ""), (902, docs[1][1] * 400), (902, docs[1][1] * 400), (903, "\n\n")]
    table = spark.createDataFrame([*labels, (None, 1, 0), (1, None, 1), (7777, 0, 0)], LABELS)
    clashing = {n: F.lit("x") for n in ("score", "held_out", "quality", "predicted", "features")}
    got = q.quality(documents(*docs, *odd).withColumns(clashing), table).collect()
    assert len(got) == 506 and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in got)
    by_id = {r["doc_id"]: r for r in got}
    held = {i for i in range(500) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert all(by_id[i]["held_out"] == (i in held) for i in range(500))
    assert np.mean([by_id[i]["predicted"] == labels[i][1] for i in held]) > 0.97
    assert by_id[None]["predicted"] == 1 and not by_id[None]["held_out"]
    assert by_id[900]["score"] == by_id[901]["score"]
    assert len({r["score"] for r in got if r["doc_id"] == 902}) == 1


def test_small_samples_and_nothing_to_learn(spark, documents, prose):
    docs, labels = corpus(prose, 400)
    table = spark.createDataFrame(labels, LABELS)
    rows = q.training_rows(documents(*docs), table, 100)
    assert 50 < rows.num_rows < 150
    none = spark.createDataFrame([], LABELS)
    assert [r["score"] for r in q.quality(documents((1, "a")), none).collect()] == pytest.approx([0.0])
    good = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, 1, 0)], LABELS)
    assert q.quality(documents((1, "a"), (2, "b"), (3, "c")), good).first()["score"] == pytest.approx(1.0)
    assert q.quality(documents(), table).count() == 0


def test_query_on_held_out_labels(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("quality is not null")
    got = q.op11_quality(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert got.count() == docs.count()
    rows = got.where("held_out").join(labels, "doc_id").select("quality", "predicted").collect()
    assert np.mean([r["predicted"] for r in rows if r["quality"] == 1]) > 0.95
    assert np.mean([r["predicted"] for r in rows if r["quality"] == 0]) < 0.2
    assert got.where((F.col("score") < 0) | (F.col("score") > 1)).count() == 0
