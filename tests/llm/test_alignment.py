"""Tokens of two vocabularies side by side, against a plain merge with the libraries."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from conftest import rows

from salesmill.llm import token_alignment
from salesmill.llm.token_alignment import aligned, alignments, byte_level, merged, op13_token_alignment, piece_bytes

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    return a, b, byte_level(public_tokenizers.path("byte_bpe_50k.json")), piece_bytes(b)


def plain(texts, libraries):
    """One document after another with sets of ends; a row per text in their order."""
    a, b, a_bytes, b_bytes = libraries
    found = []
    for text in texts:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        whole = (" " + text).encode() if text else b""
        if b"".join(a_bytes[i] for i in ids_a) != whole or b"".join(b_bytes[i] for i in ids_b) != whole:
            ids_a, ids_b = [], []
        ends_a, ends_b = (
            np.cumsum([len(of[i]) for i in ids]).tolist() for of, ids in ((a_bytes, ids_a), (b_bytes, ids_b))
        )
        cuts = sorted(set(ends_a) & set(ends_b))
        groups, links, s, t = [], [], 0, 0
        for cut in cuts:
            e, f = ends_a.index(cut) + 1, ends_b.index(cut) + 1
            groups.append(",".join(map(str, ids_a[s:e])) + "|" + ",".join(map(str, ids_b[t:f])))
            links.append((ids_a[e - 1], ids_b[f - 1]))
            s, t = e, f
        found.append((ids_a, ids_b, groups, links))
    counts = Counter(link for *_, links in found for link in links)
    most = {}
    for (_, b_id), n in counts.items():
        most[b_id] = max(n, most.get(b_id, 0))
    for ids_a, ids_b, groups, links in found:
        best = sum(counts[link] == most[link[1]] for link in links)
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        total = sum(counts[link] for link in links)
        yield len(ids_a), len(ids_b), len(groups), len(links), best, total, sha


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [
    "", None, "a", " a", "a  b   c\n\n\td", "x▁y", "▁", "<|endoftext|> <s> </s> <0x41>", "日本語 text 🎉🎉",
    "\x00 null", "tab\tand\r\nline", "naïve café", " " * 70, " wide　space", "don't DON'T 12,345.67",
    "word " * 700, "ab" * 1500,
]


def test_all_documents_of_a_table(spark, libraries):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    expected = [(r["doc_id"], *values) for r, values in zip(docs, plain([r["text"] for r in docs], libraries))]
    assert rows(op13_token_alignment(spark, SF), *COLUMNS) == sorted(expected, key=repr)


@pytest.mark.parametrize("lane,chunk", [(512, 8 << 20), (7, 50)])
def test_odd_texts(spark, documents, libraries, monkeypatch, lane, chunk):
    """Nulls, empty texts, copies, marks, long runs; lanes and chunks change nothing."""
    monkeypatch.setattr(token_alignment, "LANE", lane)
    monkeypatch.setattr(token_alignment, "CHUNK_BYTES", chunk)
    texts = [*ODD, "a", "a", "word " * 700]
    ids = [None if i == 2 else i % 15 for i in range(len(texts))]
    got = aligned(documents(*zip(ids, texts), extra=", chunk string").coalesce(2))
    expected = [(i, *values) for i, values in zip(ids, plain(texts, libraries))]
    assert rows(got, *COLUMNS) == sorted(expected, key=repr)


def test_full_output(documents):
    (row,) = alignments(documents((1, "hello wörld"))).collect()
    assert row["a_cuts"][-1] == len(row["a_ids"]) and row["b_cuts"][-1] == len(row["b_ids"])
    assert len(row["a_cuts"]) == len(row["b_cuts"])
    (none,) = alignments(documents((1, None))).collect()
    assert none["a_ids"] == none["b_ids"] == none["a_cuts"] == none["b_cuts"] == []


def test_empty_table(documents):
    assert aligned(documents()).count() == 0
    assert alignments(documents()).count() == 0


def test_lanes_of_the_merge():
    rng = np.random.default_rng(1)
    a, b = (np.unique(rng.integers(1, 3000, 900)) for _ in range(2))
    a, b = np.append(a, 3000), np.append(b, 3000)
    for edges in ([0, 3000], [0, 10, 11, 500, 2999, 3000]):
        x, y = merged(a, b, np.array(edges))
        assert (a[x] == b[y]).all() and a[x].tolist() == sorted(set(a) & set(b))
