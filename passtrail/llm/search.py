"""Ranked lexical search by NRA: impact-sorted lists are read in sequence, and each document has a lower and an upper bound of its score.

Terms are maximal runs of ASCII letters and digits and of anything beyond ASCII, with A-Z in lower case; they are known by 64-bit
hashes. A document's score adds, over the terms of an item with repeats, the term's weight times the impact of the term in the document,
``(10^9 tf) div (1000 tf + 8 m)``, all in integers (see ``Impacts``).

The corpus is partitioned by documents. One pass over the texts stores the postings of the items' terms, a row per document. From there
each task takes documents in chunks of bounded size, turns their postings into lists sorted by impact, and reads the lists of an item in
rounds of doubling depth. What was read of a document is its lower bound; the upper bound adds, for each list in which it has not been
seen, the last impact read there. A first run reads only the beginnings of all lists: the tenth best lower bound of the whole corpus is
a threshold that no result falls below. The second run goes on in each chunk until no document whose upper bound reaches the threshold
has an open interval, so that membership, ties and final scores are settled without looking anything up. Chunks without a candidate end
after few reads. Only ten rows per item and task leave a task.

Items are searched in blocks of bounded size, whose terms, weights and thresholds are all that the driver holds.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from passtrail.llm import common
from passtrail.operators.stores import stored

#: Bytes of item texts that are searched for at a time, postings of a chunk, and documents of a chunk.
BLOCK_BYTES = 4 << 20
CHUNK_POSTINGS = 2 << 20
_DOC_BITS, _IMPACT_BITS = 20, 20
#: How far the first run reads each list, and the depth of the first round of the second.
FIRST_DEPTH = 512
_START_DEPTH = 256

_IN_TERM = np.array([chr(b).isalnum() if b < 128 else True for b in range(256)])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_VALUES = (np.random.default_rng(31).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1))[_LOWER]
_STEP = 0xD1342543DE82EF95
_BLOCK = 1 << 19


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, _STEP, np.uint64), np.full(size, pow(_STEP, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def terms_of(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Blocks of texts: the number of the first one, the hashes of all their terms, and which text of the block each is of.

    A hash is a polynomial of the term's bytes, taken from running sums, so no term becomes a Python object.
    """
    at, up, down = 0, *_powers(2 * _BLOCK)
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and (size == 0 or size + len(texts[stop]) < _BLOCK):
            size += len(texts[stop]) + 1
            stop += 1
        data = np.frombuffer(b" ".join(texts[at:stop]) + b" ", np.uint8)
        if len(data) > len(up):
            up, down = _powers(common.power_of_two(len(data)))
        turns = np.flatnonzero(np.diff(_IN_TERM[data], prepend=False))
        starts, ends = turns[::2], turns[1::2]
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUES[data] * up[: len(data)], out=sums[1:])
        limits = np.cumsum([len(t) + 1 for t in texts[at:stop]])
        yield at, common.mixed((sums[ends] - sums[starts]) * down[starts]), np.searchsorted(limits, starts, side="right")
        at = stop


def _counted(text: bytes) -> Counter:
    return Counter(h for _, hashes, _ in terms_of([text]) for h in hashes.tolist())


@dataclass
class Items:
    """A block of items: the distinct terms of all of them, and the places and counts of each one's terms."""

    ids: list
    vocabulary: np.ndarray = field(init=False)
    places: list[np.ndarray] = field(init=False)
    counts: list[np.ndarray] = field(init=False)

    def __init__(self, rows: list[tuple]):
        self.ids = [i for i, _ in rows]
        counted = [_counted((t or "").encode()) for _, t in rows]
        self.vocabulary = np.unique(np.array([h for c in counted for h in c], np.uint64))
        self.places = [np.searchsorted(self.vocabulary, np.array(list(c), np.uint64)) for c in counted]
        self.counts = [np.array(list(c.values()), np.int64) for c in counted]

    def place(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are terms of an item, and their places."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), bool), np.zeros(0, np.int64)
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == len(self.vocabulary)] = 0
        hit = self.vocabulary[at] == hashes
        return hit, at[hit]


POSTINGS = "id bigint, n bigint, terms binary, counts binary"


def postings(docs: DataFrame, items: Items) -> DataFrame:
    """A row for each document with at least one term: its number of terms, and the terms of items in it with their counts."""

    def of(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.batches(parts):
            ids, texts = part.column(0), common.octets(part.column(1))
            rows, numbers = [], []
            for first, hashes, owner in terms_of(texts):
                total = np.bincount(owner)
                hit, places = items.place(hashes)
                keys, counts = np.unique((owner[hit].astype(np.int64) << 32) | places, return_counts=True)
                cuts = np.searchsorted(keys, np.arange(len(total) + 1) << 32)
                terms, counts = keys.astype(np.uint32), counts.astype(np.uint32)
                for k in np.flatnonzero(total).tolist():
                    a, b = cuts[k], cuts[k + 1]
                    rows.append(first + k)
                    numbers.append((int(total[k]), terms[a:b].tobytes(), counts[a:b].tobytes()))
            columns = list(zip(*numbers)) or [(), (), ()]
            kinds = [pa.int64(), pa.binary(), pa.binary()]
            yield pa.record_batch(
                [ids.take(pa.array(rows, pa.int64())), *[pa.array(c, k) for c, k in zip(columns, kinds)]], names=["id", "n", "terms", "counts"]
            )

    return docs.select("id", "_text").mapInArrow(of, POSTINGS)


def frequencies(found: DataFrame, size: int) -> np.ndarray:
    """How many documents have each of the ``size`` terms."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for part in common.batches(parts):
            total += np.bincount(np.frombuffer(b"".join(part.column(0).to_pylist()), np.uint32), minlength=size)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at, pa.int64()), pa.array(total[at])], names=["term", "n"])

    if not size:
        return np.zeros(0, np.int64)
    sums = found.select("terms").mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(size, np.int64)
    out[sums["term"].to_numpy(np.int64)] = sums["n"].to_numpy(np.int64)
    return out


@dataclass
class Impacts:
    """The integers behind a score: ``total`` documents with terms, ``length`` terms in all of them."""

    total: int
    length: int

    def weight(self, having: int) -> int:
        return math.floor(1000 * math.log((2 * self.total + 2) / (2 * having + 1)))

    def of(self, counts: np.ndarray, n: np.ndarray) -> np.ndarray:
        m = 100 - 75 + (75 * n * self.total) // self.length
        return (1_000_000_000 * counts) // (1000 * counts + 8 * m)


class Lists:
    """The postings of some documents as one list per term, the highest impact first."""

    def __init__(self, terms: np.ndarray, docs: np.ndarray, impacts: np.ndarray, ids: list, size: int):
        falling = np.uint64((1 << _IMPACT_BITS) - 1) - impacts.astype(np.uint64)
        keys = (terms.astype(np.uint64) << np.uint64(_DOC_BITS + _IMPACT_BITS)) | (falling << np.uint64(_DOC_BITS)) | docs.astype(np.uint64)
        keys.sort()
        self.ids = ids
        self.docs = (keys & np.uint64((1 << _DOC_BITS) - 1)).astype(np.int64)
        self.impacts = ((1 << _IMPACT_BITS) - 1) - ((keys >> np.uint64(_DOC_BITS)) & np.uint64((1 << _IMPACT_BITS) - 1)).astype(np.int64)
        self.starts = np.searchsorted(keys, np.arange(size + 1, dtype=np.uint64) << np.uint64(_DOC_BITS + _IMPACT_BITS))


class Reader:
    """Sequential reads of the lists of one item, and the bounds that follow from them."""

    def __init__(self, lists: Lists, places: np.ndarray, weights: np.ndarray):
        begin, end = lists.starts[places], lists.starts[places + 1]
        use = (weights > 0) & (end > begin)
        self.lists, self.begin, self.end, self.weights = lists, begin[use].tolist(), end[use].tolist(), weights[use].tolist()
        self.at = list(self.begin)
        self.low = np.zeros(len(lists.ids), np.int64)

    def read(self, depth: int) -> None:
        """Go on in every list until ``depth`` of its postings have been read."""
        docs, impacts = self.lists.docs, self.lists.impacts
        for k, (at, begin, end, weight) in enumerate(zip(self.at, self.begin, self.end, self.weights)):
            to = min(end, begin + depth)
            if to > at:
                # A document is in a list once, so no place is added to twice.
                self.low[docs[at:to]] += weight * impacts[at:to]
                self.at[k] = to

    def high(self) -> tuple[np.ndarray, int]:
        """Upper bounds of all documents, and that of one that has not been seen at all."""
        docs, impacts = self.lists.docs, self.lists.impacts
        seen, unseen = np.zeros(len(self.low), np.int64), 0
        for at, begin, end, weight in zip(self.at, self.begin, self.end, self.weights):
            if at == end:
                continue
            last = weight * int(impacts[at - 1] if at > begin else impacts[begin])
            seen[docs[begin:at]] += last
            unseen += last
        return self.low + (unseen - seen), unseen


def resolved(reader: Reader, threshold: int, top: int, start: int = _START_DEPTH) -> np.ndarray:
    """Documents that can be among the ``top`` best and score at least ``threshold``; ``reader.low`` is then their score."""
    if reader.high()[1] < threshold:
        return np.zeros(0, np.int64)
    depth = start
    while True:
        reader.read(depth)
        if len(reader.low) > top:
            threshold = max(threshold, int(np.partition(reader.low, -top)[-top]))
        high, _ = reader.high()
        able = high >= max(threshold, 1)
        if not (able & (high > reader.low)).any():
            return np.flatnonzero(able)
        depth *= 2


def _chunks(parts: Iterator[pa.RecordBatch], impacts: Impacts, size: int, most: int) -> Iterator[Lists]:
    """Lists of documents in chunks: of ``most`` postings, but for the last document, and of no more documents than fit a key."""
    held: list[list] = [[], [], [], []]

    def lists() -> Lists:
        ids, n, terms, counts = held
        sizes = np.array([len(t) // 4 for t in terms], np.int64)
        owner = np.repeat(np.arange(len(ids)), sizes)
        tf = np.frombuffer(b"".join(counts), np.uint32).astype(np.int64)
        found = Lists(np.frombuffer(b"".join(terms), np.uint32), owner, impacts.of(tf, np.array(n, np.int64)[owner]), ids, size)
        return found

    total = 0
    for part in common.batches(parts):
        for row in zip(*[c.to_pylist() for c in part.columns]):
            for column, value in zip(held, row):
                column.append(value)
            total += len(row[2]) // 4
            if total >= most or len(held[0]) == 1 << _DOC_BITS:
                yield lists()
                held, total = [[], [], [], []], 0
    if held[0]:
        yield lists()


_NONE = float("inf")


def _place(score: int, doc) -> tuple:
    """The order of results, the best being the largest: by score, then by a smaller id; null ids come last."""
    return score, -_NONE if doc is None else -doc


def _best(rows: DataFrame, top: int, salts: int = 64) -> DataFrame:
    """The ``top`` best rows of each item with their rank; items are dealt out over salts first, so no task has all rows of one."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    spread = rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    first = spread.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    return first.drop("salt").withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= top)


FOUND = "item int, doc_id bigint, score bigint"


def _rows(found: dict[int, list]) -> pa.RecordBatch:
    rows = [(k, doc, score) for k, heap in found.items() for (score, _), doc in heap]
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64()))], names=["item", "doc_id", "score"])


def _keep(heap: list, entry: tuple, top: int) -> None:
    if len(heap) < top:
        heapq.heappush(heap, entry)
    elif entry[0] > heap[0][0]:
        heapq.heapreplace(heap, entry)


def search_block(
    docs: DataFrame, items: Items, top: int, chunk_postings: int = CHUNK_POSTINGS, first_depth: int = FIRST_DEPTH, start: int = _START_DEPTH
) -> DataFrame:
    """The best documents of each item of a block: ``item`` (its number), ``doc_id``, ``score``, ``rank``."""
    found = stored(postings(docs, items), "search-postings")
    sums = found.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("l")).first()
    impacts, size = Impacts(sums["n"], sums["l"] or 0), len(items.vocabulary)
    having = frequencies(found, size)
    weights = np.array([impacts.weight(n) for n in having.tolist()], np.int64)
    wanted = [(p, c * weights[p]) for p, c in zip(items.places, items.counts)]

    def begun(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The best lower bounds after the beginnings of all lists."""
        best: dict[int, list] = {k: [] for k in range(len(wanted))}
        for lists in _chunks(parts, impacts, size, chunk_postings):
            for k, (places, weight) in enumerate(wanted):
                reader = Reader(lists, places, weight)
                reader.read(first_depth)
                most = min(top, len(reader.low))
                for low in np.partition(reader.low, -most)[-most:].tolist():
                    if low:
                        _keep(best[k], (_place(low, None), None), top)
        yield _rows(best)

    bounds = _best(found.mapInArrow(begun, FOUND), top).filter(F.col("rank") == top).select("item", "score").collect()
    thresholds = {r["item"]: r["score"] for r in bounds}

    def ended(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The best documents of the task, with their final scores."""
        best: dict[int, list] = {k: [] for k in range(len(wanted))}
        for lists in _chunks(parts, impacts, size, chunk_postings):
            for k, (places, weight) in enumerate(wanted):
                least = max(thresholds.get(k, 1), best[k][0][0][0] if len(best[k]) == top else 1)
                reader = Reader(lists, places, weight)
                for d in resolved(reader, least, top, start).tolist():
                    _keep(best[k], (_place(int(reader.low[d]), lists.ids[d]), lists.ids[d]), top)
        yield _rows(best)

    return _best(found.mapInArrow(ended, FOUND), top)


def search(
    docs: DataFrame, items: DataFrame, top: int = 10, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id",
    item_text: str = "text", block_bytes: int = BLOCK_BYTES, **settings,
) -> DataFrame:
    """The ``top`` documents of each item with a score above 0: ``item_id``, ``rank`` (from 1), ``doc_id``, ``score``.

    Equal scores are ranked by ascending id, null ids last. Each row of ``docs`` is a document, also where rows are equal. A null or
    empty text has no terms: such a document is in no result, and such an item has none. Rows of ``items`` that are equal in id and text
    are one item; items that share an id are searched one by one. Without documents or items there are no rows. Other columns are
    not looked at. The texts are read once per block of items. Starts jobs.
    """
    spark = docs.sparkSession
    mine = docs.select(common.column(id_column).cast("long").alias("id"), F.coalesce(common.column(text_column), F.lit("")).alias("_text"))
    asked = items.select(common.column(item_column).cast("long").alias("item_id"), F.coalesce(common.column(item_text), F.lit("")).alias("_text"))
    asked = asked.filter("_text <> ''").distinct()
    _, size = common.volume(asked, "_text")
    blocks = -(-size // block_bytes)
    asked = stored(asked.withColumn("block", F.pmod(F.xxhash64("item_id", "_text"), F.lit(max(1, blocks)))), "search-items")
    out = None
    for block in range(blocks):
        rows = [(r["item_id"], r["_text"]) for r in asked.filter(F.col("block") == block).orderBy("item_id", "_text").collect()]
        if not rows:
            continue
        chosen = Items(rows)
        best = stored(search_block(mine, chosen, top, **settings), "search-best")
        named = spark.createDataFrame(list(enumerate(chosen.ids)), "item int, item_id long")
        part = best.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score")
        out = part if out is None else out.union(part)
    if out is None:
        out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return out.withColumnRenamed("item_id", item_column).withColumnRenamed("doc_id", id_column)
