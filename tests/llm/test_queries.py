"""Every registered query of this part, and the pipeline, as it is on the smallest tables."""

import pathlib

import duckdb
import pytest

import corpus_pipeline
from salesmill.llm import queries

SF_DIR = pathlib.Path("/root/testdata/sf0.001")
COLUMNS = {
    "op1_token_codes": "doc_id start n_tokens ids_crc32",
    "op2_nearest": "query_id rank vec_id score",
    "op3_surrogates": "doc_id text n_replaced",
    "op4_best_fit_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op5_toxicity": "doc_id held_out score predicted",
    "op6_near_copies": "doc_id fingerprint component_id",
    "op7_repeated_passages": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op8_language": "doc_id held_out lang_pred score",
    "op9_exact_top_k": "query_id rank vec_id score",
    "op10_sentencepiece": "doc_id n_ids ids_crc32 text_crc32 same",
    "op11_quality": "doc_id held_out score predicted",
    "op12_hard_negatives": "anchor_id positive_id rank negative_id positive_score negative_score",
    "op13_token_alignment": "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
    "pipeline": "doc_id piece start length ids_crc32 sequence_id offset",
}
PER_DOCUMENT = [n for n, c in COLUMNS.items() if c.startswith("doc_id") and "piece" not in c.split()]

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="no tables")


@pytest.mark.parametrize("name", COLUMNS)
def test_query_runs_over_the_whole_table(spark, name):
    run = corpus_pipeline.run if name == "pipeline" else queries.QUERIES[name]
    got = run(spark, str(SF_DIR))
    rows = [tuple(r) for r in got.select(*COLUMNS[name].split()).collect()]
    assert rows
    if name in PER_DOCUMENT:
        ids = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id").collect()
        assert sorted(r[0] for r in rows) == sorted(r["doc_id"] for r in ids)
    if name in queries.ORACLES:
        db = duckdb.connect()
        db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_DIR}/embeddings.parquet'")
        wanted = ", ".join(COLUMNS[name].split())
        assert sorted(rows) == sorted(db.execute(f"SELECT {wanted} FROM ({queries.ORACLES[name]})").fetchall())


def test_every_query_is_listed():
    assert set(COLUMNS) == {*queries.QUERIES, "pipeline"}
