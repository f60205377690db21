"""Token codes, packing and SentencePiece against the libraries and plain versions."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from salesmill.llm import packing, sentence_pieces, token_codes
from salesmill.llm.encode import BYTE_BPE, WORD_BPE, encoder
from salesmill.session import scratch_path

ODD = ["a", "B", " ", "  ", "\n", "\n\n", "\t", " \n", "1", "23", ".", "'s", "é", "́", "\xa0", "\x1c", "\x01",
       "Σ", "<|endoftext|>", "日本", "\x85", "!!", "\r\n", "'ll", "İ", "x" * 70, "▁", "😀", "the ", " ing"]


def odd_texts(n, seed=1):
    draw = random.Random(seed)
    return ["".join(draw.choice(ODD) for _ in range(draw.randint(0, 14))) for _ in range(n)]


@pytest.mark.parametrize("path,kind", [(WORD_BPE, "word"), (BYTE_BPE, "byte")])
def test_remembered_parts_give_the_library_ids(path, kind):
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    texts = odd_texts(3000)
    for _ in range(2):
        got = encoder(path, kind).ids([t.encode() for t in texts])
        assert [g.tolist() for g in got] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_codes_give_any_id():
    draw = np.random.default_rng(1)
    for n in (1, 7, 513, 5000):
        ids = draw.integers(0, draw.choice([200, 70_000, 1 << 32], n), dtype=np.uint64).astype(np.uint32)
        codes = token_codes.Codes(token_codes.pack(ids))
        assert len(codes) == n
        at = draw.integers(0, n, 100)
        assert (codes.take(at) == ids[at]).all()
        for s, e in ((0, n), (n // 3, n // 2), (n - 1, n)):
            assert (codes.slice(s, e) == ids[s:e]).all()


def test_code_files_hold_all_ids_in_order(spark, documents):
    rows = [(5, "The cat."), (1, None), (None, "a b"), (3, ""), (5, "The cat."), (2, "word " * 3000), (9, "x" * 5000)]
    docs = documents(*rows, extra=", start string")
    path = scratch_path(spark, "codes")
    token_codes.write_codes(docs, path, segment_ids=1000)
    got = token_codes.read_ids(
        spark, path, lambda d, s, i: (d, s, zlib.crc32(i.astype("<u4").tobytes())), "doc_id long, start long, crc long"
    ).collect()
    plain = Tokenizer.from_file(WORD_BPE)
    start, every, expected = 0, [], []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = plain.encode(text or "", add_special_tokens=False).ids + [token_codes.END_ID]
        expected.append((doc_id, start, zlib.crc32(np.array(ids, "<u4").tobytes())))
        start, every = start + len(ids), every + ids
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)
    asked = [0, 1, 2, 500, 2500, len(every) - 1, len(every), -1]
    places = spark.createDataFrame([(p,) for p in [*asked, 1, None]], "place long")
    found = {r["place"]: r["id"] for r in token_codes.tokens_at(spark, path, places).collect()}
    assert found == {p: every[p] for p in asked if 0 <= p < len(every)}


def test_empty_table_has_no_codes_and_no_pieces(spark, documents):
    path = scratch_path(spark, "codes")
    token_codes.write_codes(documents(), path)
    assert token_codes.read_ids(spark, path, lambda d, s, i: (d,), "doc_id long").count() == 0
    assert packing.pack_documents(documents()).count() == 0


@pytest.mark.parametrize("seed", range(8))
def test_packings_are_whole_and_near_the_bound(seed):
    draw = random.Random(seed)
    kinds = [
        lambda: min(100, max(1, int(draw.expovariate(1 / 30)))),
        lambda: draw.randint(1, 100),
        lambda: draw.choice([34, 35, 50, 51, 20]),
    ]
    counts = Counter(kinds[seed % 3]() for _ in range(draw.choice([1, 5, 60, 2000])))
    packer = packing.Packer(counts, 100)
    first = packer.best_bins
    plan = packer.solve()
    used = Counter()
    for filling, n in plan:
        assert sum(length * k for length, k in filling) <= 100
        for length, k in filling:
            used[length] += n * k
    assert used == counts
    assert packer.bound <= sum(n for _, n in plan) <= first


def least_bins(sizes, capacity):
    """Fewest bins by trying everything."""
    best = [len(sizes)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        for j in range(len(bins)):
            if bins[j] + sizes[i] <= capacity and bins[j] not in bins[:j]:
                place(i + 1, [*bins[:j], bins[j] + sizes[i], *bins[j + 1 :]])
        place(i + 1, [*bins, sizes[i]])

    place(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(30))
def test_small_packings_are_optimal(seed):
    draw = random.Random(seed)
    sizes = sorted((draw.randint(3, 60) for _ in range(11)), reverse=True)
    plan = packing.Packer(Counter(sizes), 100).solve()
    assert sum(n for _, n in plan) == least_bins(sizes, 100)


def test_pieces_fill_sequences_without_gaps(documents):
    docs = documents((1, "one two"), (1, "one two"), (None, None), (2, ""), (3, "alpha beta " * 3000), (4, "z " * 90))
    rows = packing.pack_documents(docs, capacity=64).collect()
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in by_sequence.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= 64
    plain = Tokenizer.from_file(BYTE_BPE)
    ids = plain.encode("alpha beta " * 3000, add_special_tokens=False).ids + [packing.END_ID]
    own = sorted((r for r in rows if r["doc_id"] == 3), key=lambda r: r["piece"])
    assert [r["piece"] for r in own] == list(range(len(own)))
    assert all(r["length"] == 64 for r in own[1:]) and sum(r["length"] for r in own) == len(ids)
    for r in own:
        part = ids[r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
    assert len([r for r in rows if r["doc_id"] == 1]) == 2


def test_sentencepiece_ids_and_texts_are_the_library_ones():
    library = sentencepiece.SentencePieceProcessor(model_file=sentence_pieces.MODEL)
    model = sentence_pieces.model()
    texts = odd_texts(3000, seed=2)
    got = model.encode(texts)
    assert [g.tolist() for g in got] == library.encode(texts, num_threads=1)
    assert [model.decode(g) for g in got] == [library.decode(g.tolist()) for g in got]


def test_unigram_lattice_finds_the_best_sum():
    model = sentence_pieces.Model(sentence_pieces.MODEL, kind=sentence_pieces.UNIGRAM)

    def best(word):
        value = [0.0] + [-np.inf] * len(word)
        for e in range(1, len(word) + 1):
            for s in range(max(0, e - model.longest), e):
                if word[s:e] in model.known:
                    value[e] = max(value[e], value[s] + model.scores[model.known[word[s:e]]])
        return value[-1]

    for word in ("▁international", "▁thing", "abcabc"):
        ids = model.lattice([word])[0]
        assert "".join(model.pieces[i] for i in ids) == word
        assert model.scores[ids].sum() == best(word)


def test_sentencepiece_frames(documents):
    docs = documents((1, "a b"), (2, None), (None, ""), (3, "word" * 500), extra=", ids string")
    back = sentence_pieces.decoded(sentence_pieces.encoded(docs)).collect()
    assert sorted(map(tuple, back), key=repr) == sorted([(1, "a b"), (2, ""), (None, ""), (3, "word" * 500)], key=repr)
    assert sentence_pieces.encoded(documents()).count() == 0


def test_sentencepiece_runs_of_blanks_and_long_words_are_the_library_ones():
    library = sentencepiece.SentencePieceProcessor(model_file=sentence_pieces.MODEL)
    model = sentence_pieces.model()
    draw = random.Random(7)
    texts = [" " * n + tail for n in range(1, 80) for tail in ("", "foo", "é", "😀x", "foo  bar")]
    texts += [" " * 100_000, "x" + " " * 50_001 + "y", "".join(draw.choices("abcdefgh+/=ABCDEF019", k=20_000))]
    texts += ["aab" * 5_000, "一二三四五六七" * 500]
    got = model.encode(texts)
    assert [g.tolist() for g in got] == library.encode(texts, num_threads=1)
    assert [model.decode(g) for g in got] == texts


def test_pair_answers_do_not_depend_on_what_was_asked_before():
    model = sentence_pieces.Model(sentence_pieces.MODEL)
    draw = np.random.default_rng(3)
    usable = np.array(sorted(model.known.values()))
    for _ in range(3):
        a, b = draw.choice(usable[:300], 20_000), draw.choice(usable[:300], 20_000)
        assert (model.beside(a, b) == model.apart(a, b)).all()


def test_repeated_rows_are_encoded_alike(documents):
    rows = sentence_pieces.encoded(documents((1, "some  words"), (1, "some  words"), (2, "some  words"))).collect()
    assert len(rows) == 3 and len({tuple(r["ids"]) for r in rows}) == 1
