"""Operator 7: bytes of repeated passages removed, by suffix arrays of shards.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere
else in the corpus, within one text or in two.

*Shards.* Equal strings have to meet, so shards are made by content. Every string
of ``LENGTH`` bytes holds an anchor: a place whose ``CORE`` bytes have the
smallest hash among those of the string. Equal strings hold it at the same
offset. The strings that hold an anchor start in a range of places, and all of
them lie in the range's context. Ranges are gathered by their core:

- a core that occurs once is done: no string of the range is repeated;
- ranges with equal contexts are repeated whole, however many there are: they are
  only counted, and one of them stays as a witness for the others of the core;
- a core with up to ``SHARD`` different contexts goes to a shard;
- ranges of a core with more are cut in two. Each half has a longer core, so
  groups fall apart, and after eight rounds cores are the strings themselves.

*In a shard* contexts are cut down to what they may share with another one of
their core: the suffixes behind the cores are sorted, and those before them
backwards, and each context is compared with its neighbours. Then the suffixes of
what is left are sorted by induction, from one offset to the one before it. Common
prefixes of neighbours come by Kasai's rule, all contexts in step. Where neighbours share ``LENGTH`` bytes and lie at different
places of the corpus, both strings go. Suffix arrays of arbitrary shards would
have to be merged pairwise, which grows with the square of their number; here
equal strings are in one shard already, so no suffix is looked up in another one.
The runs that several shards find in one text are sorted and joined.

Equality of contexts is that of two 64-bit hashes and of lengths. Filters of
fixed size keep rows that cannot matter out of the shuffles.

Defined results: a null or empty text has no bytes and the digest of none;
repeated rows count as different texts, so they are removed whole from
``LENGTH`` bytes on; a null ``doc_id`` is kept; an empty table gives no rows.
Other columns are kept; ``kept``, ``n_bytes``, ``n_removed`` and ``n_spans``
are added in the place of columns of those names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmill.llm.base import (
    Filter,
    arrow_batch,
    concatenated,
    lean,
    read,
    row_key,
    saved,
    shuffle_width,
    slices,
    small_batches,
    texts_of,
)
from salesmill.llm.hashing import all_spans, mixed, prefixes, spans

LENGTH = 200
CORE = 64
SHARD = 128  # different contexts of one core in a shard
SHARD_BYTES = 1 << 20  # contexts sorted together
BODIES = 4096  # ranges that leave a text together
BATCH_BYTES = 1 << 20
FINDER_BYTES = 1 << 17  # texts hashed together, so that their arrays stay in the cache

# Strings that start from ``low`` to ``high`` in the text ``k`` and hold the same
# anchor, at ``place``; ``a`` and ``b`` are the ends that the range has where no
# end of the text cuts it, counted from the anchor.
RANGE = pa.schema(
    [("core", pa.int64()), ("context", pa.int64()), ("k", pa.int64())]
    + [(n, pa.int32()) for n in ("place", "low", "high", "a", "b")]
)
RANGE_SQL = "core long, context long, k long, place int, low int, high int, a int, b int"
BODY = pa.schema([*RANGE, ("several", pa.bool_()), ("body", pa.binary())])
BODY_SQL = f"{RANGE_SQL}, several boolean, body binary"
CORES = pa.schema([("core", pa.int64())])
MARK = pa.schema([("k", pa.int64()), ("start", pa.int32()), ("stop", pa.int32())])
MARK_SQL = "k long, start int, stop int"


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """The best of every ``width`` neighbours."""
    have = 1
    while 2 * have <= width:
        values = best(values[:-have], values[have:])
        have *= 2
    if have < width:
        values = best(values[: len(values) - (width - have)], values[width - have :])
    return values


def anchors(data: np.ndarray, edges: np.ndarray, prefix: np.ndarray) -> np.ndarray:
    """Places of the anchors of all strings of ``LENGTH`` bytes that lie within one text."""
    if len(data) < LENGTH:
        return np.zeros(0, np.int64)
    # 32 bits choose: neighbours with equal ones are both anchors, in all equal strings alike.
    h = (all_spans(prefix, CORE) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    window = LENGTH - CORE + 1
    low = _sliding(h, window, np.minimum)
    # Strings that cross into the next text choose nothing.
    inside = np.zeros(len(data) + 1, np.int32)
    sizes = np.diff(edges)
    long = sizes >= LENGTH
    np.add.at(inside, edges[:-1][long], 1)
    np.add.at(inside, (edges[1:] - LENGTH + 1)[long], -1)
    real = np.cumsum(inside)[: len(low)] > 0
    low[~real] = 0
    pad = np.zeros(window - 1, np.uint32)
    most = _sliding(np.concatenate([pad, low, pad]), window, np.maximum)
    # A place is the smallest of some string if the largest minimum around is its own.
    return np.flatnonzero(most == h)


def _cores(prefix: np.ndarray, place, a, b) -> np.ndarray:
    """Hashes of the cores of ranges, of which what a range is in itself is a part."""
    core = spans(prefix, place + b, place + a + LENGTH) ^ mixed((a * -512 - b).astype(np.uint64))
    return core.view(np.int64)


def _contexts(data: np.ndarray, place, low, high) -> np.ndarray:
    """Hashes of the contexts of ranges, of which how the text cuts them is a part."""
    cut = (place - low) * 1024 + (high - place) + 512
    context = spans(prefixes(data, 1), low, high + LENGTH, 1) ^ mixed(cut.astype(np.uint64))
    return context.view(np.int64)


def _finder(keep):
    """Cores of all anchors; with a filter, ranges of the cores it may hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", FINDER_BYTES):
            data, edges = concatenated(texts_of(batch.column("text")))
            prefix = prefixes(data)
            place = anchors(data, edges, prefix)
            a, b = np.full(len(place), CORE - LENGTH), np.zeros(len(place), np.int64)
            core = _cores(prefix, place, a, b)
            if keep is None:
                yield arrow_batch(CORES, {"core": core})
                continue
            some = np.flatnonzero(keep.value.may_hold(core))
            core, place, a, b = core[some], place[some], a[some], b[some]
            text = np.searchsorted(edges, place, side="right") - 1
            start = edges[text]
            low, high = np.maximum(place + a, start), np.minimum(place, edges[text + 1] - LENGTH)
            rows = {"core": core, "context": _contexts(data, place, low, high)}
            rows |= {"place": place - start, "low": low - start, "high": high - start, "a": a, "b": b}
            rows["k"] = batch.column("k").to_numpy()[text]
            yield arrow_batch(RANGE, rows)

    return run


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number that sorts like them."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    key = np.empty(-(-n // 8) * 8, np.uint64)
    for j in range(8):
        key[j::8] = np.frombuffer(padded, ">u8", len(key) // 8, j)
    return key[:n]


def sorted_suffixes(key: np.ndarray) -> np.ndarray:
    """Places in the order of what follows them, by Larsson-Sadakane refinement.

    ``key`` has the eight bytes from each place on.
    """
    n = len(key)
    order = np.argsort(key)
    fresh = np.ones(n, bool)
    fresh[1:] = key[order[1:]] != key[order[:-1]]
    # A suffix has the rank of the first place of its group.
    rank = np.zeros(n + 1, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0)) + 1
    have = 8
    # Places in groups of two or more.
    open_ = np.flatnonzero(~(fresh & np.append(fresh[1:], True)))
    while len(open_):
        suffix = order[open_]
        # Suffixes that end here are equal but for their length, and come before those that go on.
        after = np.where(suffix + have < n, rank[np.minimum(suffix + have, n)] + n, n - suffix)
        pair = rank[suffix] * (2 * n + 2) + after
        turn = np.argsort(pair)
        suffix, pair = suffix[turn], pair[turn]
        order[open_] = suffix
        parted = np.ones(len(open_), bool)
        parted[1:] = pair[1:] != pair[:-1]
        rank[suffix] = open_[np.maximum.accumulate(np.where(parted, np.arange(len(open_)), 0))] + 1
        open_ = open_[~(parted & np.append(parted[1:], True))]
        have *= 2
    return order


def equal_bytes(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """How many leading bytes two words have in common, up to eight.

    The exponent of the difference tells its highest bit; the bit below is cleared, so
    that rounding to a double cannot reach the next power of two.
    """
    differ = one ^ other
    differ &= ~(differ >> np.uint64(1))
    return (64 - np.frexp(differ.astype(np.float64))[1]) >> 3


def common_prefixes(
    key: np.ndarray, edges: np.ndarray, order: np.ndarray, limit: int, sizes=None, alone=None
) -> np.ndarray:
    """Bytes, up to ``limit``, that each suffix of the order shares with the one before it.

    By Kasai's rule, a suffix shares at least one byte less than the suffix one
    place before it, if the place after its neighbour is in the order, too; the
    first places of all contexts are taken together, then the second ones, and so on.
    The order may hold the first ``sizes`` places of each context only, and may start
    anew where ``alone`` says so: nothing is shared there.
    """
    n = len(key)
    before = np.full(n, -1, np.int64)  # the neighbour of each suffix
    before[order[1:]] = order[:-1]
    if alone is not None:
        before[order[alone]] = -1
    held = np.zeros(n + 1, bool)
    held[order] = True
    room = np.minimum(n - np.maximum(np.arange(n), before), limit)
    room[before < 0] = 0
    shared = np.zeros(n, np.int64)
    sizes = np.diff(edges) if sizes is None else sizes
    # The contexts that still go on are the first ones in order of size.
    by_size = np.argsort(-sizes, kind="stable")
    starts = edges[:-1][by_size]
    live = np.searchsorted(-sizes[by_size], -np.arange(int(sizes.max(initial=0))), side="left")
    have = np.zeros(len(sizes), np.int64)
    for j, m in enumerate(live.tolist()):
        i = starts[:m] + j
        most = room[i]
        h = np.minimum(np.maximum(have[:m] - 1, 0), most)
        if j:
            h[~held[before[i - 1] + 1]] = 0
        on = np.flatnonzero(h < most)
        while len(on):
            here = i[on]
            far = h[on]
            same = equal_bytes(key[here + far], key[before[here] + far])
            far += same
            h[on] = far
            on = on[(same == 8) & (far < most[on])]
        np.minimum(h, most, out=h)
        shared[i] = h
        have[:m] = h
    out = shared[order]
    out[:1] = 0
    return out


def column_order(data: np.ndarray, edges: np.ndarray, sizes: np.ndarray, core, anchor, a, b):
    """The first ``sizes`` places of contexts, in order within each core and offset from the anchor, and where these begin.

    Equal strings hold their anchor at the same offset, so suffixes at other offsets
    need no order between them. Cores are equal within; so the suffixes from the first
    places of the cores are in the order of those from the cores' ends. The order one
    place to the left is induced: it is that of its bytes and, where they are equal,
    the order found before.
    """
    start, stop = edges[:-1], edges[:-1] + sizes
    _, group = np.unique(core, return_inverse=True)
    group = group.astype(np.uint16 if len(group) < 1 << 16 else np.uint32)
    order = np.lexsort([*_words_from(data, anchor + a + LENGTH, a, b)[::-1], group])
    found, alone = [np.zeros(0, np.int64)], [np.zeros(0, bool)]
    for j in range(int((b - a).max(initial=-1)) + 1):
        at = anchor + b - j
        order = order[at[order] >= start[order]]
        if j:
            order = order[np.argsort(data[at[order]], kind="stable")]
            order = order[np.argsort(group[order], kind="stable")]
        member = order[at[order] < stop[order]]
        found.append(at[member])
        alone.append(np.diff(group[member].astype(np.int64), prepend=-1) != 0)
    return np.concatenate(found), np.concatenate(alone)


def repeated(bodies: list[bytes], text: np.ndarray, core, place, low, a, b) -> tuple[np.ndarray, np.ndarray]:
    """Contexts and offsets of strings that also start at another place of the corpus.

    A context is the bytes from ``low`` on of the text numbered ``text``.
    """
    data, edges = concatenated(bodies)
    owner = np.repeat(np.arange(len(bodies)), np.diff(edges))
    sizes = np.diff(edges) - LENGTH + 1  # other suffixes leave their context
    order, alone = column_order(data, edges, sizes, core, edges[:-1] + place - low, a, b)
    context = owner[order]
    run = np.cumsum(common_prefixes(words_at(data), edges, order, LENGTH, sizes, alone) < LENGTH)
    offset = order - edges[context]
    # The same string of the corpus can lie in several contexts.
    text, at = text[context], low[context] + offset
    turn = np.diff(run, prepend=-1) != 0
    other = ~turn
    other[1:] &= (text[1:] != text[:-1]) | (at[1:] != at[:-1])
    first = np.flatnonzero(turn)
    several = np.add.reduceat(other.astype(np.int64), first) > 0 if len(first) else turn
    hit = np.flatnonzero(several[np.cumsum(turn) - 1])
    return context[hit], offset[hit]


def _most_shared(words: np.ndarray, core: np.ndarray) -> np.ndarray:
    """Leading bytes that each column of words shares with the one of its core most like it, its neighbour when sorted."""
    order = np.lexsort([*words[::-1], core])
    one, other = words[:, order[1:]], words[:, order[:-1]]
    differ = np.concatenate([one != other, np.ones((1, len(order) - 1), bool)])
    at = differ.argmax(axis=0)
    last, column = np.minimum(at, len(words) - 1), np.arange(len(order) - 1)
    run = 8 * at + np.where(at < len(words), equal_bytes(one[last, column], other[last, column]), 0)
    run[core[order[1:]] != core[order[:-1]]] = 0
    most = np.zeros(len(order), np.int64)
    most[order[1:]] = run
    most[order[:-1]] = np.maximum(most[order[:-1]], run)
    return most


def _words_from(data: np.ndarray, start: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The bytes from each start on that strings may reach, in words; the first row has the first ones."""
    steps = 8 * np.arange(max(1, -(-int((b - a).max(initial=0)) // 8)))[:, None]
    return words_at(data)[np.minimum(start + steps, len(data) - 1)]


def cropped(bodies: list[bytes], core: np.ndarray, place, low, a, b) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts that may share a string with another one of their core, and the first and last start of such strings.

    A shared string is shared to both sides of the core. So the suffixes from the
    cores' ends are sorted, and backwards those from their starts: a context shares
    most with a neighbour. Bytes behind a context's end can only let more pass.
    """
    data, edges = concatenated(bodies)
    anchor = edges[:-1] + place - low
    left = _most_shared(_words_from(data[::-1], len(data) - anchor - b, a, b), core)
    right = _most_shared(_words_from(data, anchor + a + LENGTH, a, b), core)
    first = np.maximum(low, place + b - left)
    last = np.minimum(low + np.diff(edges) - LENGTH, place + a + right)
    some = np.flatnonzero(first <= last)
    return some, first[some], last[some]


def _sharder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks of the contexts of sorted rows, the rows of a core together."""
    for table in _whole_cores(batches):
        rows = {n: table[n].to_numpy().astype(np.int64) for n in ("core", "k", "place", "low", "a", "b")}
        bodies = texts_of(table["body"].combine_chunks())
        some, first, last = cropped(bodies, *(rows[n] for n in ("core", "place", "low", "a", "b")))
        cuts = first - rows["low"][some], last - rows["low"][some] + LENGTH
        bodies = [bodies[i][s:e] for i, s, e in zip(some.tolist(), *(c.tolist() for c in cuts))]
        rows = {n: c[some] for n, c in rows.items()} | {"low": first}
        texts, text = np.unique(rows["k"], return_inverse=True)
        context, offset = repeated(bodies, text, *(rows[n] for n in ("core", "place", "low", "a", "b")))
        # Neighbouring strings of a text are one run of bytes.
        name, start = text[context], first[context] + offset
        turn = np.lexsort((start, name))
        name, start = name[turn], start[turn]
        fresh = np.ones(len(name), bool)
        fresh[1:] = (name[1:] != name[:-1]) | (start[1:] > start[:-1] + LENGTH)
        last = np.append(np.flatnonzero(fresh)[1:], len(name)) - 1 if len(name) else np.zeros(0, np.int64)
        yield arrow_batch(MARK, {"k": texts[name[fresh]], "start": start[fresh], "stop": start[last] + LENGTH})


def _whole_cores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Sorted rows in tables of about ``SHARD_BYTES`` or more; a core lies in one."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        core = batch.column("core").to_numpy()
        turn = np.flatnonzero(core[1:] != core[:-1]) + 1
        # The last core of what is held may go on.
        cut = 0
        if held and len(core) and core[0] != held[-1].column("core")[-1].as_py():
            turn = np.append(0, turn)
        if size > SHARD_BYTES and len(turn):
            cut = int(turn[-1])
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held, size = [], 0
        if cut < batch.num_rows:
            held.append(batch.slice(cut))
            size += batch.column("body").slice(cut).nbytes
    if held:
        yield pa.Table.from_batches(held)


def _halver(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges cut in two, with the bytes of each half."""
    for batch in batches:
        bodies = texts_of(batch.column("body"))
        data, edges = concatenated(bodies)
        prefix = prefixes(data)
        old = {n: batch.column(n).to_numpy().astype(np.int64) for n in ("k", "place", "low", "high", "a", "b")}
        several = np.array(batch.column("several").to_pylist(), bool)
        middle = (old["a"] + old["b"]) // 2
        for a, b in ((old["a"], middle), (middle + 1, old["b"])):
            low = np.maximum(old["low"], old["place"] + a)
            high = np.minimum(old["high"], old["place"] + b)
            some = np.flatnonzero((low <= high) & (a <= b))
            shift = (edges[:-1] - old["low"])[some]  # from places in the text to places here
            rows = {"k": old["k"], "place": old["place"], "low": low, "high": high, "a": a, "b": b}
            rows = {n: c[some] for n, c in rows.items()}
            place, *ends = (rows[n] + shift for n in ("place", "low", "high"))
            rows |= {"core": _cores(prefix, place, rows["a"], rows["b"]), "context": _contexts(data, place, *ends)}
            rows["several"] = several[some]
            starts, stops = (low - old["low"])[some], (high - old["low"])[some] + LENGTH
            rows["body"] = [bodies[i][s:e] for i, s, e in zip(some.tolist(), starts.tolist(), stops.tolist())]
            yield arrow_batch(BODY, rows)


def _often(ranges: DataFrame) -> DataFrame:
    """Cores that occur more than once."""
    return ranges.groupBy("core").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("core")


def _passing(keep, inside: bool):
    """Rows whose ``k`` the filter may hold, or those it does not."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = keep.value.may_hold(batch.column("k").to_numpy())
            yield batch.filter(pa.array(held == inside))

    return run


def _bodies(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of ranges, fetched from the texts that hold any."""
    spark = docs.sparkSession
    per_text = wanted.groupBy("k").agg(F.collect_list(F.struct(*wanted.columns)).alias("ranges"))
    keep = spark.sparkContext.broadcast(Filter(wanted.select("k")))
    texts = docs.select("k", "text").mapInArrow(_passing(keep, True), "k long, text string")
    # Copies of a row share a key; one of them is enough.
    joined = texts.groupBy("k").agg(F.min("text").alias("text")).join(per_text, "k").select("text", "ranges")
    names = [n for n in wanted.columns if n != "body"]
    schema = ", ".join(f"{n} {t}" for n, t in wanted.dtypes) + ", body binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            for text, ranges in zip(texts_of(batch.column("text")), batch.column("ranges")):
                # A long text has many ranges; they leave some at a time.
                for start in range(0, len(ranges.values), BODIES):
                    rows = pa.Table.from_struct_array(ranges.values.slice(start, BODIES))
                    low, high = rows["low"].to_pylist(), rows["high"].to_pylist()
                    columns = {n: rows[n].combine_chunks() for n in names}
                    columns["body"] = pa.array([text[s : e + LENGTH] for s, e in zip(low, high)], pa.binary())
                    yield pa.RecordBatch.from_pydict(columns)

    return joined.mapInArrow(lean(run), schema)


def marks(docs: DataFrame, shard: int = SHARD) -> DataFrame:
    """(k, start, stop) of runs of bytes to remove, of texts with a key ``k``; runs may overlap."""
    spark = docs.sparkSession
    texts = docs.select("k", "text").where(F.octet_length("text") >= LENGTH)
    often = saved(_often(texts.mapInArrow(lean(_finder(None)), "core long")), "cores")
    keep = spark.sparkContext.broadcast(Filter(often))
    ranges = saved(texts.mapInArrow(lean(_finder(keep)), RANGE_SQL).join(often, "core"), "ranges")
    found = []
    while True:
        inline = "body" in ranges.columns
        one = F.min(F.struct(*(c for c in RANGE.names if c not in ("core", "context")))).alias("one")
        more = [F.max("several").alias("before"), F.min("body").alias("body")] if inline else []
        groups = ranges.groupBy("core", "context").agg(F.count(F.lit(1)).alias("n"), one, *more)
        before = F.col("before") if inline else F.lit(False)
        groups = groups.select(
            "core", "context", "one.*", "n", ((F.col("n") > 1) | before).alias("several"), *(["body"] if inline else [])
        )
        groups = saved(groups, "groups")
        equal = groups.where("n > 1").select("core", "context")
        fresh = ranges.where("not several") if inline else ranges
        whole = fresh.join(equal, ["core", "context"]).select(
            "k", F.col("low").alias("start"), (F.col("high") + LENGTH).alias("stop")
        )
        kinds = groups.groupBy("core").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
        wanted = groups.drop("n").join(kinds, "core")
        bodies = saved(wanted if inline else _bodies(docs, wanted), "bodies").select(*BODY.names, "kinds")
        small = bodies.where(F.col("kinds") <= shard).repartition(shuffle_width(spark), "core")
        rows = small.select("core", "k", "place", "low", "a", "b", "body").sortWithinPartitions("core")
        # Written round by round: all rounds in one plan would be planned and run at once.
        found.append(saved(whole.unionByName(rows.mapInArrow(lean(_sharder), MARK_SQL)), "marks"))
        large = bodies.where(F.col("kinds") > shard)
        if large.isEmpty():
            break
        halves = saved(large.select(*BODY.names).mapInArrow(lean(_halver), BODY_SQL), "halves")
        ranges = halves.join(_often(halves), "core")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def merged(runs: np.ndarray, size: int) -> np.ndarray:
    """Overlapping and touching runs joined, in order."""
    runs = runs[np.argsort(runs[:, 0], kind="stable")]
    stop = np.maximum.accumulate(runs[:, 1])
    fresh = np.ones(len(runs), bool)
    fresh[1:] = runs[1:, 0] > stop[:-1]
    starts = runs[fresh, 0]
    # The furthest stop before the next start, found in the rising row of stops.
    last = np.append(np.flatnonzero(fresh)[1:], len(runs)) - 1
    return np.stack([starts, np.minimum(stop[last], size)], 1)


def _remover(columns: list[str], marked: bool, as_text: bool, first=None):
    """Texts without their marked bytes; ``first`` is applied to the batches before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(first(batches) if first else batches, "text", BATCH_BYTES):
            texts = texts_of(batch.column("text"))
            runs = batch.column("runs").to_pylist() if marked else [None] * len(texts)
            kept, removed, count = [], [], []
            for text, found in zip(texts, runs):
                cut = np.zeros((0, 2), np.int64)
                if found:
                    cut = merged(np.array([(r["start"], r["stop"]) for r in found], np.int64), len(text))
                at, parts = 0, []
                for s, e in cut.tolist():
                    parts.append(text[at:s])
                    at = e
                kept.append(b"".join([*parts, text[at:]]))
                removed.append(int((cut[:, 1] - cut[:, 0]).sum()))
                count.append(len(cut))
            out = {c: batch.column(c) for c in columns}
            if as_text:
                # Characters that lost some of their bytes go.
                out["text"] = pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string())
            else:
                out["kept"] = pa.array(kept, pa.binary())
            out |= {
                "n_bytes": pa.array(map(len, texts), pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "n_spans": pa.array(count, pa.int64()),
            }
            yield pa.RecordBatch.from_pydict(out)

    return lean(run)


ADDED = ("kept", "n_bytes", "n_removed", "n_spans")


def without_repeats(docs: DataFrame, shard: int = SHARD, as_text: bool = False) -> DataFrame:
    """The documents with ``kept`` (bytes), ``n_bytes``, ``n_removed`` and ``n_spans``.

    With ``as_text`` the column ``text`` holds what is kept, in place of ``kept``.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.drop(*ADDED, "k", "runs").withColumn("k", row_key())
    runs = marks(docs, shard).groupBy("k").agg(F.collect_set(F.struct("start", "stop")).alias("runs"))
    runs = saved(runs, "runs")
    keep = spark.sparkContext.broadcast(Filter(runs.select("k")))
    typed = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes)
    own = [c for c in docs.columns if c != "k"]
    schema = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes if n != "k")
    schema += ("" if as_text else ", kept binary") + ", n_bytes long, n_removed long, n_spans long"
    # One function, not two in a row: each would keep a Python worker of its own.
    plain = docs.mapInArrow(_remover(own, False, as_text, _passing(keep, False)), schema)
    cut = docs.mapInArrow(_passing(keep, True), typed).join(runs, "k", "left")
    return plain.unionByName(cut.mapInArrow(_remover(own, True, as_text), schema))


def op7_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return without_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
