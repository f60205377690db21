"""Near copies and repeated passages against plain versions."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from salesmill.llm import near_copies, suffix_arrays
from salesmill.llm.components import components
from salesmill.llm.suffix_arrays import LENGTH


def plain_print(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not found:
        return 0
    shingles = [" ".join(found[i : i + 3]) for i in range(max(1, len(found) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(prints, radius=2):
    root = list(range(len(prints)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return [top(i) for i in range(len(prints))]


def test_fingerprints_and_components_of_texts(documents, prose):
    base = prose(1, 400)
    texts = [base, base, base + " end", base.upper(), "", None, " \n\t", "one", "one two", "É é", prose(2, 50), "\xa0 a"]
    rows = list(enumerate(texts))
    got = near_copies.near_copies(documents(*rows, extra=", component_id string")).collect()
    prints = [plain_print(t or "") for t in texts]
    assert {r["doc_id"]: int(r["fingerprint"], 16) for r in got} == dict(enumerate(prints))
    assert {r["doc_id"]: r["component_id"] for r in got} == dict(enumerate(plain_roots(prints)))


def test_null_and_repeated_ids(documents):
    got = near_copies.near_copies(documents((None, "a"), (7, "a"), (7, "a"), (None, "b"))).collect()
    assert Counter((r["doc_id"], r["component_id"]) for r in got) == {(None, 7): 1, (7, 7): 2, (None, None): 1}
    assert near_copies.near_copies(documents()).count() == 0


@pytest.mark.parametrize("shard", [2, 30, 2000])
def test_links_connect_what_is_near(spark, shard):
    draw = random.Random(shard)
    prints = {draw.getrandbits(64) for _ in range(40)}
    for centre in list(prints)[:4]:
        for _ in range(60):
            x = centre
            for _ in range(draw.randint(1, 6)):
                x ^= 1 << draw.randrange(64)
            prints.add(x)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    table = spark.createDataFrame([(p,) for p in signed], "print long")
    found = {r["node"]: r["root"] for r in components(near_copies.links(table, shard=shard)).collect()}
    groups = {}
    for p, r in zip(signed, plain_roots(prints)):
        groups.setdefault(r, set()).add(p)
    expected = {p: min(g) for g in groups.values() for p in g if len(g) > 1}
    assert found == expected


def test_components_of_stars_and_chains(spark):
    links = [(0, i) for i in range(1, 200)] + [(i, i + 1) for i in range(300, 340)] + [(5, 5)]
    random.Random(1).shuffle(links)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(200)} | {i: 300 for i in range(300, 341)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_removal(texts):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + LENGTH] for t in raw for i in range(len(t) - LENGTH + 1))
    out = []
    for t in raw:
        gone = bytearray(len(t))
        for i in range(len(t) - LENGTH + 1):
            if seen[t[i : i + LENGTH]] > 1:
                gone[i : i + LENGTH] = b"\1" * LENGTH
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("shard", [1, 4, 128])
def test_repeated_bytes_go(documents, prose, shard):
    """A long passage in many texts, near copies, a text that repeats itself, short and odd ones."""
    base = prose(1, 300)
    passage = prose(2, 60)
    texts = ["", None, "short", "a" * 199, "b" * 201, "ab" * 300, passage, passage[:199]]
    for i in range(12):
        near = list(base)
        for at in random.Random(i).sample(range(len(near)), 3):
            near[at] = "Z"
        texts.append("".join(near))
        texts.append(prose(10 + i, 30) + passage[i : 230 + i] + prose(50 + i, 30))
    texts += [prose(99, 200), prose(99, 200), prose(98, 60) * 3, "é" * 150 + prose(97, 40), "é" * 150]
    docs = documents(*enumerate(texts), extra=", kept string")
    rows = suffix_arrays.without_repeats(docs, shard).collect()
    got = {
        r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in rows
    }
    assert got == dict(enumerate(plain_removal(texts)))


def test_repeated_rows_and_null_ids_lose_their_text(documents, prose):
    text = prose(3, 100)
    rows = suffix_arrays.without_repeats(documents((1, text), (1, text), (None, prose(4, 100)))).collect()
    assert sorted((r["n_removed"], r["n_spans"]) for r in rows) == [(0, 0)] + [(len(text), 1)] * 2
    assert suffix_arrays.without_repeats(documents()).count() == 0


def test_suffixes_and_prefixes():
    data = np.frombuffer(b"mississippi" * 5 + b"aaaaaaaaaaaaaaaaaaaaaaaa", np.uint8)
    raw = data.tobytes()
    key = suffix_arrays.words_at(data)
    order = suffix_arrays.sorted_suffixes(key)
    assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
    shared = suffix_arrays.common_prefixes(key, np.array([0, 30, 55, len(raw)]), order, 40)
    for i in range(1, len(raw)):
        a, b = raw[order[i - 1] :], raw[order[i] :]
        n = next((j for j, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert shared[i] == min(n, 40)


@pytest.mark.parametrize("raw", [b"\0" * 400, b"ab\0\0" * 3 + b"\0" * 400, b"a\0\0b\0\0", b"x\0" * 30 + b"\0" * 9])
def test_suffixes_of_texts_that_end_in_nul(raw):
    key = suffix_arrays.words_at(np.frombuffer(raw, np.uint8))
    assert suffix_arrays.sorted_suffixes(key).tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])


def test_rounds_leave_a_small_plan(documents, prose):
    """Each round's marks are stored: no join of any round is left to the plan of them all."""
    base = prose(5, 100)
    texts = [base[:i * 20] + "Z" + base[i * 20 :] for i in range(1, 12)]
    found = suffix_arrays.marks(documents(*enumerate(texts)).withColumnRenamed("doc_id", "k"), 2)
    assert found.count()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "MapInArrow" not in plan


def shard(contexts):
    """Arguments of contexts given as what is before a core, and behind it."""
    core = b"core" * (suffix_arrays.CORE // 4)
    bodies = [left + core + right for left, right in contexts]
    low, n = np.arange(len(bodies)) * 1000, len(bodies)
    a, b = np.full(n, suffix_arrays.CORE - LENGTH), np.zeros(n, np.int64)
    return bodies, np.full(n, 7), low + [len(left) for left, _ in contexts], low, a, b


def test_contexts_are_cut_to_what_they_may_share():
    """Nothing of contexts that share little more than their core is sorted; of the others, a stretch."""
    side = LENGTH - suffix_arrays.CORE
    left, right = bytes(range(1, side + 1)), bytes(range(100, 100 + side))
    contexts = [(b"x" * side, b"x" * side), (left, right), (b"y" * (side - 40) + left[-40:], right)]
    some, first, last = suffix_arrays.cropped(*shard(contexts))
    assert some.tolist() == [1, 2]
    assert (first - [1000, 2000]).tolist() == [side - 40] * 2 and (last - [1000, 2000]).tolist() == [side] * 2
    assert len(suffix_arrays.cropped(*shard(contexts[:2]))[0]) == 0


def test_columns_are_in_the_order_of_all_suffixes():
    """The induced order of each offset and the strings found, against all suffixes sorted and all strings counted."""
    draw, side = random.Random(3), LENGTH - suffix_arrays.CORE
    pick = lambda n: bytes(draw.choices(b"ab", k=n))
    lefts, rights = [pick(side) for _ in range(4)], [pick(side) for _ in range(4)]
    contexts = [(draw.choice(lefts)[draw.randrange(side) :], draw.choice(rights)) for _ in range(40)]
    bodies, core, place, low, a, b = shard(contexts)
    data, edges = suffix_arrays.concatenated(bodies)
    sizes = np.diff(edges) - LENGTH + 1
    order, alone = suffix_arrays.column_order(data, edges, sizes, core, edges[:-1] + place - low, a, b)
    assert sorted(order.tolist()) == [p for e, n in zip(edges.tolist(), sizes.tolist()) for p in range(e, e + n)]
    text = data.tobytes()
    for column in np.split(order, np.flatnonzero(alone)[1:]):
        strings = [text[p : p + LENGTH] for p in column.tolist()]
        assert strings == sorted(strings)
    context, offset = suffix_arrays.repeated(bodies, np.arange(40), core, place, low, a, b)
    seen = Counter(t[i : i + LENGTH] for t in bodies for i in range(len(t) - LENGTH + 1))
    want = {(c, i) for c, t in enumerate(bodies) for i in range(len(t) - LENGTH + 1) if seen[t[i : i + LENGTH]] > 1}
    assert set(zip(context.tolist(), offset.tolist())) == want and want


def test_a_shard_without_repeats_has_no_marks():
    import pyarrow as pa

    bodies, core, place, low, a, b = shard([(b"x" * 136, b"x" * 136), (b"y" * 136, b"y" * 136)])
    rows = {"core": core, "k": low, "place": place, "low": low, "a": a, "b": b, "body": bodies}
    assert [m.num_rows for m in suffix_arrays._sharder(iter([pa.RecordBatch.from_pydict(rows)]))] == [0]
