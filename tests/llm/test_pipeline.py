"""The five stages one after another."""

import corpus_pipeline
from pyspark.sql import functions as F

from salesmill.llm.near_copies import near_copies
from salesmill.llm.surrogates import entities

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_take_effect(spark, documents, prose):
    passage = prose(7, 80)
    rows = [(i, prose(i, 120)) for i in range(30)]
    rows += [(100, rows[3][1]), (101, rows[3][1]), (102, "12 !"), (103, None), (None, prose(60, 50))]
    rows += [(104, prose(70, 60) + passage + prose(71, 60)), (105, prose(72, 60) + passage)]
    rows += [(106, prose(73, 50) + " write to a.b@example.com")]
    docs = documents(*rows)
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        kept[name] = docs = spark.createDataFrame(docs.collect(), docs.schema)
        if name != "packing":
            assert docs.columns == COLUMNS
    ids = {n: {r[0] for r in d.select("doc_id").collect()} for n, d in kept.items()}
    assert ids["language"] == {i for i, _ in rows} - {102, 103}
    assert len(ids["near copies"] & {3, 100, 101}) == 1
    assert ids["near copies"] - {3, 100, 101} == ids["language"] - {3, 100, 101}
    assert ids["repeated passages"] == ids["surrogates"] == ids["packing"] == ids["near copies"]
    texts = {r["doc_id"]: r["text"] for r in kept["surrogates"].collect()}
    assert passage not in texts[104] and passage not in texts[105]
    assert texts[1] == rows[1][1]
    assert "a.b@example.com" not in texts[106] and len(entities(texts[106])) == 1
    assert all(r["n_chars"] == len(r["text"]) for r in kept["surrogates"].collect())


def test_one_document_of_each_component_stays(spark, documents, prose):
    """The groups are those of the operator with its own words and bits."""
    rows = [(i, prose(i, 150)) for i in range(40)]
    for i in range(40):
        near = rows[i][1].split()
        near[75] = "other"
        rows += [(100 + i, " ".join(near)), (200 + i, rows[i][1].upper())][: 1 + i % 2]
    rows += [(300, ""), (301, None), (302, "12"), (rows[0]), (None, rows[1][1])]
    docs = documents(*rows)
    component = {}
    for r in near_copies(docs.withColumn("doc_id", F.coalesce("doc_id", F.lit(999)))).collect():
        component.setdefault(r["component_id"], set()).add(r["doc_id"])
    kept = corpus_pipeline.one_of_near_copies(spark, docs, "").select("doc_id").collect()
    kept = [999 if r[0] is None else r[0] for r in kept]
    assert len(kept) == len(set(kept)) == len(component)
    assert all(len(group & set(kept)) == 1 for group in component.values())


CLASHING = ["k", "runs", "kept", "_row", "_names", "lang_pred", "_key", "n_replaced", "score", "n_bytes", "_some"]


def test_further_columns_come_through_untouched(spark, documents, prose):
    passage = prose(7, 80)
    rows = [(i, prose(i, 60) + (passage if i < 2 else "")) for i in range(6)] + [(6, "Mail a.b@example.com " + prose(9, 9))]
    rows += [(7, "word " * 30_000 + prose(8, 40))]
    docs = documents(*rows).withColumns({c: F.concat(F.lit(c), F.col("doc_id")) for c in CLASHING})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == COLUMNS + CLASHING
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert all(r[c] == f"{c}{r['doc_id']}" for r in docs.collect() for c in CLASHING)
    assert docs.count() == 8
    assert {r[0] for r in corpus_pipeline.packed(spark, docs, "").select("doc_id").collect()} == set(range(8))


def test_empty_table(spark, documents):
    docs = documents()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "").count() == 0
