"""Suffix-array deduplication by two-stage sorting.

Every string of 400 bytes that occurs twice goes, wherever it starts. Sorting all suffixes of a corpus is not needed to find them:

* A string's anchor is the smallest hash among its first 64 grams, so equal strings have their anchor at the same place. All strings
  with one anchor lie between ``lo`` and ``hi + 400`` (its segment), and all of them hold the 337 bytes from the anchor on (its core).
* Cores that occur once settle their strings: they are unique. Segments that occur twice settle theirs: they are all repeated.
  Both are looked up by packed hashes.
* What is left are segments at the edges of repeats. They meet the other segments of the same core, and there a suffix array is
  made: suffixes smaller than their successor are sorted directly, the others are induced by a scan over the buckets, and neighbours
  in the array are compared for a common prefix of 400 bytes.

Segments of a core are dealt into slices when there are very many; each slice makes its suffix array, and distinct strings of
different slices meet by their hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passtrail.llm import common
from passtrail.llm.common import INDEX, KEY, MESSAGES, MORE, Replies
from passtrail.operators.stores import stored

GRAM, WINDOW = 16, 64
SLICE, BUCKET_SEGMENTS = 4096, 8192
RANGE = 5
CHUNK_BYTES = 4 << 20
_ROLL = 0x9FB21C651E98DF25
_POWER = 0xD1342543DE82EF95
_INVERSE = pow(_POWER, -1, 1 << 64)
_TABLE = np.random.default_rng(11).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOW = np.uint64(0xFFFFFFFF)
SEGMENTS = "core bigint, chunk bigint, place bigint, asks boolean, strings int, bytes binary"
FOUND = "hash binary, chunk bigint, first bigint, last bigint, matched boolean"


class Chunk:
    """A chunk's texts as one array of bytes, and the segments of its anchors.

    Places in the array travel from stage to stage, but a shuffle gives a chunk's rows in any order: they are ordered by id and text.
    """

    def __init__(self, table: pa.Table, length: int):
        ids, texts = table["_id"].to_pylist(), common.octets(table["_text"])
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, texts[i]))
        self.ids, self.texts, self.length = [ids[i] for i in order], [texts[i] for i in order], length
        self.number = table["_chunk"][0].as_py()
        self.data = np.frombuffer(b"".join(self.texts), np.uint8)
        sizes = np.array([len(t) for t in self.texts], np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        grams = common.rolled(_TABLE[self.data], GRAM, _ROLL)
        valid = np.zeros(len(self.data) + 1, np.int64)
        long = sizes >= length
        valid[self.starts[long]] += 1
        valid[self.ends[long] - length + 1] -= 1
        at = np.flatnonzero(np.cumsum(valid[:-1]))
        ranked = (grams & ~_LOW) | (_LOW - np.arange(len(grams), dtype=np.uint64))
        size = 1
        while size < WINDOW:
            ranked = np.minimum(ranked[:-size], ranked[size:]) if len(ranked) > size else ranked[:0]
            size *= 2
        anchor = (_LOW - (ranked[at] & _LOW)).astype(np.int64)
        fresh = np.ones(len(at), bool)
        fresh[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)
        first = np.flatnonzero(fresh)
        self.anchor, self.lo = anchor[first], at[first]
        self.hi = at[np.concatenate([first[1:], [len(at)]]) - 1] if len(at) else at
        self._hash()

    def _hash(self) -> None:
        sums = np.zeros(len(self.data) + 1, np.uint64)
        powers = np.full(len(self.data) + 1, _POWER, np.uint64)
        powers[0] = 1
        powers = np.cumprod(powers, dtype=np.uint64)
        np.cumsum(_TABLE[self.data] * powers[:-1], out=sums[1:])
        back = np.full(len(self.data) + 1, _INVERSE, np.uint64)
        back[0] = 1
        back = np.cumprod(back, dtype=np.uint64)

        def of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            return common.mixed((sums[b] - sums[a]) * back[a])

        core = self.length - WINDOW + 1
        self.cores = of(self.anchor, self.anchor + core)
        shape = ((self.hi - self.lo) * 4096 + (self.anchor - self.lo) + 1).astype(np.uint64)
        self.segments = common.mixed(of(self.lo, self.hi + self.length) + common.mixed(shape))

    def state(self, told: Replies) -> tuple[np.ndarray, np.ndarray]:
        """Anchors whose segments are repeated, and those that are open."""
        shared, repeated = told.has(self.cores), told.has(self.segments)
        return repeated, shared & ~repeated


def _hashed(table: pa.Table, length: int, buckets: int) -> pa.Table:
    chunk = Chunk(table, length)
    once, more = common.once_and_more(np.concatenate([chunk.cores, chunk.segments]))
    return common.messages(chunk.number, {KEY: once, MORE: more}, buckets, False)


def _asked(key: tuple, table: pa.Table, told: pa.Table, length: int, buckets: int) -> pa.Table:
    """The cores of repeated and open segments; those of open ones as the index."""
    if not table.num_rows or not told.num_rows:
        return common.messages(0, {}, buckets, False)
    chunk = Chunk(table, length)
    repeated, opened = chunk.state(Replies(told, buckets, False))
    return common.messages(
        chunk.number, {KEY: np.unique(chunk.cores[repeated]), INDEX: np.unique(chunk.cores[opened])}, buckets, False
    )


def _parted(told: pa.Table) -> tuple[pa.Table, pa.Table]:
    kind = np.array(told["kind"].to_pylist(), np.int64)
    return told.filter(pa.array(kind == KEY)), told.filter(pa.array(kind == INDEX))


def _segments(key: tuple, table: pa.Table, told: pa.Table, length: int, buckets: int) -> pa.Table:
    """Open segments, and of the repeated ones of their cores one of each kind."""
    names = [c.split()[0] for c in SEGMENTS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.binary()]
    if not table.num_rows or not told.num_rows:
        return pa.table([pa.array([], k) for k in kinds], names=names)
    chunk = Chunk(table, length)
    known, wanted = _parted(told)
    repeated, opened = chunk.state(Replies(known, buckets, False))
    others = np.flatnonzero(repeated & Replies(wanted, buckets, False).has(chunk.cores))
    others = others[np.unique(chunk.segments[others], return_index=True)[1]]
    rows = np.concatenate([np.flatnonzero(opened), others])
    whole = chunk.data.tobytes()
    lo, hi = chunk.lo[rows], chunk.hi[rows]
    columns = [
        chunk.cores[rows].view(np.int64), np.full(len(rows), chunk.number), lo, opened[rows], hi - lo + 1,
        [whole[a : b + length] for a, b in zip(lo.tolist(), hi.tolist())],
    ]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


# --------------------------------------------------------------------------------------------------------- suffix arrays


def suffix_order(texts: list[bytes], strings: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The array of those suffixes that start among the first ``strings[k]`` bytes of text ``k``, by two-stage sorting.

    Returns their places in the joined texts (with one place between texts), in order, and per place the text's number and its end.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    data = np.full(int(ends[-1]) + 1 if len(ends) else 0, -1, np.int16)  # -1 is the end of a text, smaller than any byte
    number = np.repeat(np.arange(len(texts)), sizes + 1)
    inside = np.ones(len(data), bool)
    inside[ends] = False
    data[inside] = np.frombuffer(b"".join(texts), np.uint8)
    # A suffix is smaller than its successor if the next different byte is larger. An end counts as sorted.
    turn = np.zeros(len(data), np.int8)
    turn[:-1] = np.sign(data[1:].astype(np.int32) - data[:-1])
    turn[ends] = 1
    following = np.where(turn != 0, np.arange(len(data)), len(data))
    following = np.minimum.accumulate(following[::-1])[::-1]
    direct = turn[following] > 0
    # Each wanted suffix needs its successors up to one that is sorted directly.
    last = np.where(direct, np.arange(len(data)), len(data))
    last = np.minimum.accumulate(last[::-1])[::-1][starts + np.array(strings, np.int64) - 1]
    mark = np.zeros(len(data) + 1, np.int64)
    np.add.at(mark, starts, 1)
    np.add.at(mark, last + 1, -1)
    wanted = np.cumsum(mark[:-1]) > 0
    width = int(sizes.max(initial=1))
    direct_at = np.flatnonzero(wanted & direct & inside)
    raw = np.concatenate([np.where(inside, data, 0).astype(np.uint8), np.zeros(width, np.uint8)])
    table = np.lib.stride_tricks.sliding_window_view(raw, width)[direct_at]
    beyond = np.arange(width) >= (ends[number[direct_at]] - direct_at)[:, None]
    table = np.where(beyond, 0, table).astype(np.uint8)
    direct_at = direct_at[np.argsort(np.ascontiguousarray(table).view(f"S{width}").ravel(), kind="stable")]
    induced_at = np.flatnonzero(wanted & ~direct)
    rank = np.full(len(data), -1, np.int64)
    order, done = [], 0
    direct_byte, induced_byte = data[direct_at], data[induced_at]
    for byte in np.unique(np.concatenate([direct_byte, induced_byte])):
        bucket = induced_at[induced_byte == byte]
        # Successors in earlier buckets give the first ones; then those whose successor has just been placed, and so on.
        front = bucket[data[bucket + 1] < byte]
        rest = bucket[data[bucket + 1] == byte]
        front = front[np.argsort(rank[front + 1], kind="stable")]
        while len(front):
            rank[front] = done + np.arange(len(front))
            done += len(front)
            order.append(front)
            ready = rank[rest + 1] >= 0
            front, rest = rest[ready], rest[~ready]
            front = front[np.argsort(rank[front + 1], kind="stable")]
        own = direct_at[direct_byte == byte]
        rank[own] = done + np.arange(len(own))
        done += len(own)
        order.append(own)
    array = np.concatenate(order) if order else np.zeros(0, np.int64)
    return array[array - starts[number[array]] < np.array(strings, np.int64)[number[array]]], number, starts


def repeated_strings(texts: list[bytes], strings: list[int], length: int) -> list[np.ndarray]:
    """For each text, which of its first strings of ``length`` bytes occur twice in all texts."""
    array, number, starts = suffix_order(texts, strings)
    owner = number[array]
    offset = array - starts[owner]
    found = [np.zeros(n, bool) for n in strings]
    pieces = [texts[k][p : p + length] for k, p in zip(owner.tolist(), offset.tolist())]
    for j in range(1, len(pieces)):
        if pieces[j] == pieces[j - 1]:
            for k in (j - 1, j):
                found[owner[k]][offset[k]] = True
    return found


def _sorted(table: pa.Table, length: int) -> pa.Table:
    """Matches among the segments of a bucket: ranges of an open segment's strings that are repeated, and where a core has several
    slices the hash of each distinct string, with the place of one that is still without a match."""
    cores, chunks, places, asks, strings, texts, slices = (table[c].to_pylist() for c in ("core", "chunk", "place", "asks", "strings", "bytes", "slices"))
    out: list[tuple] = []
    by_core: dict[int, list[int]] = {}
    for i, core in enumerate(cores):
        by_core.setdefault(core, []).append(i)
    batch: list[int] = []

    def flush() -> None:
        distinct: dict[tuple, int] = {}
        members = [i for i in batch if distinct.setdefault((cores[i], texts[i], strings[i]), i) == i]
        found = repeated_strings([texts[i] for i in members], [strings[i] for i in members], length) if members else []
        for i, mask in zip(members, found):
            if asks[i]:
                edges = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8))).reshape(-1, 2)
                out.extend((None, chunks[i], places[i] + int(a), places[i] + int(b) - 1, True) for a, b in edges)
        many = [(i, mask) for i, mask in zip(members, found) if slices[i] > 1]
        seen: set[bytes] = set()
        for i, mask in many:
            for k in range(strings[i]):
                digest = xxhash.xxh3_128_digest(texts[i][k : k + length])
                if digest not in seen:
                    seen.add(digest)
                    settled = bool(mask[k]) or not asks[i]
                    out.append((digest, chunks[i], places[i] + k, places[i] + k, settled))
        batch.clear()

    for members in by_core.values():
        batch += members
        if len(batch) >= 2048:
            flush()
    flush()
    columns = list(zip(*out)) or [()] * 5
    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=[c.split()[0] for c in FOUND.split(", ")])


def _cut(key: tuple, table: pa.Table, told: pa.Table, length: int, buckets: int) -> pa.Table:
    chunk = Chunk(table, length)
    kind = np.array(told["kind"].to_pylist(), np.int64)
    repeated, _ = chunk.state(Replies(told.filter(pa.array(kind == KEY)), buckets, False))
    ranges = np.frombuffer(b"".join(told.filter(pa.array(kind == RANGE))["keys"].to_pylist()), ">i8").reshape(-1, 2).astype(np.int64)
    first = np.concatenate([chunk.lo[repeated], ranges[:, 0]])
    last = np.concatenate([chunk.hi[repeated], ranges[:, 1]])
    edge = np.zeros(len(chunk.data) + 1, np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, last + length, -1)
    keep = np.cumsum(edge[:-1]) <= 0
    sizes, removed, spans, texts = [], [], [], []
    for text, a, b in zip(chunk.texts, chunk.starts.tolist(), chunk.ends.tolist()):
        mask = keep[a:b]
        turns = np.flatnonzero(np.diff(np.concatenate([[True], mask, [True]]).astype(np.int8))).reshape(-1, 2)
        sizes.append(b - a)
        removed.append(int((turns[:, 1] - turns[:, 0]).sum()))
        spans.append([{"start": int(s), "length": int(e - s)} for s, e in turns])
        texts.append(chunk.data[a:b][mask].tobytes() if removed[-1] else text)
    span = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
    arrays = [pa.array(chunk.ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, span), pa.array(texts, pa.binary())]
    return pa.table(arrays, names=["_id", "n_bytes", "n_removed", "spans", "kept"])


OUT = "_id bigint, n_bytes bigint, n_removed bigint, spans array<struct<start:bigint,length:bigint>>, kept binary"


def repeated_bytes(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = 400, chunk_bytes: int = CHUNK_BYTES,
    slice_size: int = SLICE,
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes``, ``n_removed``, ``spans`` (maximal removed runs), ``kept`` (the bytes that stay).

    Texts are UTF-8 bytes; null is empty. A byte goes if a string of ``length`` bytes that covers it also starts anywhere else, in the
    same text or another; strings do not cross texts, and are judged on the input. All copies go, the first one too. Rows that are
    equal are copies like any other. Cuts may fall inside a character. Other columns are not looked at. An empty table
    gives an empty result. Starts jobs.
    """
    if length < 2 * WINDOW + GRAM:
        raise ValueError(f"strings are of {2 * WINDOW + GRAM} bytes at least")
    mine = docs.select(F.col(id_column).cast("long").alias("_id"), F.col(text_column).alias("_text"))
    _, size = common.volume(mine, "_text")
    chunks = max(1, -(-size // chunk_bytes))
    buckets = common.power_of_two(size / (8 * chunk_bytes))
    by_chunk = mine.withColumn("_chunk", F.pmod(F.xxhash64("_id", "_text"), F.lit(chunks))).groupBy("_chunk")
    known = {"length": length, "buckets": buckets}
    hashed = by_chunk.applyInArrow(common.on_group(_hashed, **known), MESSAGES)
    twice = stored(common.found_twice(hashed, narrow=False), "suffix-twice")
    asked = by_chunk.cogroup(twice.groupBy("chunk")).applyInArrow(common.on_pair(_asked, **known), MESSAGES)
    wanted = common.found_indexed(asked, narrow=False).withColumn("kind", F.lit(INDEX))
    told = twice.union(wanted).groupBy("chunk")
    segments = stored(by_chunk.cogroup(told).applyInArrow(common.on_pair(_segments, **known), SEGMENTS), "suffix-segments")
    large = stored(segments.groupBy("core").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > slice_size), "suffix-large")
    large = large.select("core", F.ceil(F.col("n") / slice_size).cast("int").alias("slices"))
    dealt = segments.join(large, "core", "left").withColumn("slices", F.coalesce("slices", F.lit(1)))
    count = segments.count()
    part = F.pmod(F.xxhash64("core", F.pmod(F.xxhash64("chunk", "place"), F.col("slices"))), F.lit(max(1, count // BUCKET_SEGMENTS)))
    found = dealt.withColumn("bucket", part).groupBy("bucket").applyInArrow(common.on_group(_sorted, length=length), FOUND)
    found = stored(found, "suffix-found")
    own = found.filter("hash is null").select("chunk", "first", "last")
    across = found.filter("hash is not null")
    # A string that several slices have: at most one row from each.
    met = across.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    others = across.filter("not matched").join(met, "hash", "left_semi").select("chunk", "first", "last")
    ranges = own.union(others).select(
        F.lit(0).alias("bucket"), "chunk", F.lit(RANGE).alias("kind"),
        F.unhex(F.concat(F.lpad(F.hex("first"), 16, "0"), F.lpad(F.hex("last"), 16, "0"))).alias("keys"),
    )
    cut = common.on_pair(_cut, **known)
    return by_chunk.cogroup(twice.union(ranges).groupBy("chunk")).applyInArrow(cut, OUT).withColumnRenamed("_id", id_column)
