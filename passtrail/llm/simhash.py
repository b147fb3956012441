"""SimHash near-duplicates, found in BK-trees of shards of fingerprints.

A fingerprint of 64 bits is cut into six blocks. Two that differ in at most four bits agree in two whole blocks, so they meet in a
shard named by those blocks: each fingerprint goes to fifteen shards, and each shard holds those few that share 20 to 22 bits. A
shard's fingerprints form a BK-tree (children keyed by their integer Hamming distance to the parent); a search follows only the
edges within the radius. The tree goes where its shard's searches are instead of to every executor, because all trees together grow
with the corpus. Shards with very many fingerprints are cut into slices, and each slice's tree is searched by every slice.

A shard gives links that keep its members connected (a spanning forest), not all pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passtrail.llm import common
from passtrail.operators.scale import fits_broadcast
from passtrail.operators.stores import stored

RADIUS = 4
BLOCKS = (11, 11, 11, 11, 10, 10)
SLICE = 4096
_ALL = (1 << 64) - 1


def bits_of(hashes: np.ndarray) -> int:
    """A bit is 1 if set in over half of the hashes; without any, all are 0."""
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64, seed 42, of each run of ``size`` words in lower-case ASCII, repeats included; of all words if there are fewer."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    if len(words) > size:
        starts, ends = starts[: len(words) - size + 1], ends[size - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    hashed = xxhash.xxh64_intdigest
    return np.array([hashed(line[a:b], 42) for a, b in zip(starts.tolist(), ends.tolist())], np.uint64)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, text: str, out: str = "fp", size: int = 4) -> DataFrame:
    """Replace the text column by its fingerprint as a signed 64-bit integer."""
    kept = [c for c in docs.columns if c != text]
    schema = docs.select(*kept).schema.add(out, "long")

    def of(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.batches(parts):
            found = [_signed(bits_of(shingle_hashes(t, size))) for t in common.octets(part.column(text))]
            yield pa.record_batch([*[part.column(c) for c in kept], pa.array(found, pa.int64())], names=[*kept, out])

    return docs.mapInArrow(of, schema)


class BKTree:
    """Integers by Hamming distance."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        self.values.append(value)
        self.children.append({})
        new = len(self.values) - 1
        at = 0
        while new:
            distance = (self.values[at] ^ value).bit_count()
            nearer = self.children[at].get(distance)
            if nearer is None:
                self.children[at][distance] = new
                return
            at = nearer

    def within(self, value: int, radius: int) -> list[tuple[int, int]]:
        """(distance, position) of the values that differ in at most ``radius`` bits."""
        found, todo = [], [0] if self.values else []
        while todo:
            at = todo.pop()
            distance = (self.values[at] ^ value).bit_count()
            if distance <= radius:
                found.append((distance, at))
            children = self.children[at]
            if len(children) <= 2 * radius:
                todo += [c for d, c in children.items() if -radius <= d - distance <= radius]
            else:
                todo += [children[d] for d in range(distance - radius, distance + radius + 1) if d in children]
        return found


Item = tuple[int, int]  # a fingerprint and the node that it stands for


def _forest(tree: list[Item], queries: list[Item], radius: int) -> Iterator[Item]:
    """Links between nodes of a shard that leave the same components as all links would."""
    both, searched = tree + queries, BKTree()
    for value, _ in tree if queries else ():
        searched.add(value & _ALL)
    parent = list(range(len(both)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(tree) if queries else 0, len(both)):
        value, node = both[i]
        for _, j in searched.within(value & _ALL, radius):
            a, b = root(i), root(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
                yield node, both[j][1]
        if not queries:
            searched.add(value & _ALL)


def _shard_keys(fp: Column) -> list[Column]:
    starts = [sum(BLOCKS[:i]) for i in range(len(BLOCKS))]
    block = [F.shiftrightunsigned(fp, s).bitwiseAND(F.lit((1 << w) - 1)) for s, w in zip(starts, BLOCKS)]
    pairs = [(i, j) for i in range(len(BLOCKS)) for j in range(i)]
    return [
        F.shiftleft(F.lit(k).cast("long"), 22).bitwiseOR(F.shiftleft(block[i], 11)).bitwiseOR(block[j]) for k, (i, j) in enumerate(pairs)
    ]


def links(nodes: DataFrame, how: Callable = _forest, radius: int = RADIUS, slice_size: int = SLICE) -> DataFrame:
    """Links (a, b) between nodes whose fingerprints differ in at most ``radius`` bits, by way of shards.

    ``nodes``: ``fp``, ``node`` and ``view``, which keeps fingerprints of several kinds apart; one row per (view, fp). A link may come
    more than once.
    """
    if radius > len(BLOCKS) - 2:
        raise ValueError("two fingerprints must agree in two whole blocks")
    tag = F.shiftleft(F.col("view").cast("long"), 40)
    item = F.struct("fp", "node").alias("item")
    keyed = nodes.select(item, F.explode(F.array(*[k.bitwiseOR(tag) for k in _shard_keys(F.col("fp"))])).alias("shard"))
    large = stored(keyed.groupBy("shard").count().filter(F.col("count") > slice_size), "simhash-large")
    large = large.select("shard", F.ceil(F.col("count") / slice_size).cast("int").alias("slices"))
    cut = keyed.join(large, "shard", "left").withColumn("slices", F.coalesce("slices", F.lit(1)))
    cut = cut.withColumn("slice", F.pmod(F.xxhash64("item.fp"), F.col("slices")).cast("int"))
    # Slices s and t meet in group (min, max), where the members of the smaller one are the tree.
    meets = F.transform(
        F.sequence(F.lit(0), F.col("slices") - 1),
        lambda t: F.struct(F.least(t, F.col("slice")).alias("lo"), F.greatest(t, F.col("slice")).alias("hi")),
    )
    dealt = cut.select("item.*", "shard", "slice", F.explode(meets).alias("m")).select("shard", "m.lo", "m.hi", "slice", "fp", "node")
    asks = (F.col("hi") > F.col("lo")) & (F.col("slice") == F.col("hi"))
    rows = dealt.select("shard", "lo", "hi", asks.alias("asks"), "fp", "node").repartition("shard", "lo", "hi")
    return rows.sortWithinPartitions("shard", "lo", "hi", "node").mapInArrow(lambda parts: _linked(parts, how, radius), "a bigint, b bigint")


def _linked(parts: Iterator[pa.RecordBatch], how: Callable, radius: int) -> Iterator[pa.RecordBatch]:
    """The links of each group of a shard's members."""
    for (_, lo, hi, asks, fps, nodes), begin, end in common.whole_groups(parts, 3):
        pairs: list[Item] = []
        for x, y in zip(begin.tolist(), end.tolist()):
            items = list(zip(fps[x:y].tolist(), nodes[x:y].tolist()))
            tree, queries = items, []
            if lo[x] != hi[x]:
                tree, queries = ([i for i, q in zip(items, asks[x:y].tolist()) if q is side] for side in (False, True))
                if not tree or not queries:
                    continue
            pairs += how(tree, queries, radius)
        yield pa.record_batch([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"])


def components(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = 4, radius: int = RADIUS) -> DataFrame:
    """One row per row of ``docs``: id, ``fingerprint`` (16 hex digits), ``component_id``.

    Fingerprints are of shingles of ``size`` words; those of null, empty and blank texts are zero and linked like any other.
    Fingerprints that differ in at most ``radius`` bits are linked, and ``component_id`` is the smallest id that can be reached over
    links; null ids only count where there is no other. Equal fingerprints are one node, however many rows have them. Other columns
    are not looked at. An empty table gives an empty result. Starts jobs.
    """
    mine = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("_text"))
    found = stored(fingerprints(mine, "_text", "fp", size), "simhash")
    nodes = stored(found.groupBy("fp").agg(F.min("id").alias("first")), "simhash-nodes")
    seen = nodes.select("fp", F.col("fp").alias("node"), F.lit(0).alias("view"))
    roots = common.connected(links(seen, radius=radius))
    smallest = nodes.join(roots, nodes["fp"] == roots["node"]).groupBy("root").agg(F.min("first").alias("least"))
    of_root = roots.join(smallest, "root").select(F.col("node").alias("fp"), "least")
    facts = nodes.join(of_root, "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id"))
    told = common.tell_groups(found, ["fp"], facts, F.col("id"))
    return told.select(F.col("id").alias(id_column), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def without_near_copies(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = 4, radius: int = RADIUS, slice_size: int = SLICE
) -> DataFrame:
    """The rows of ``docs``, with all their columns, but for near copies: of texts that are connected over links the first one stays.

    Fingerprints and links are those of ``components``; null, empty and blank texts have the fingerprint zero and are linked like any
    other. The first text is that with the smallest id (a null id comes last), then with the smallest hash of its text. Rows are found
    again by id and hash, so rows that are equal in both stay or go together. An empty table stays empty. Starts jobs.
    """
    place = [F.col(id_column).cast("long").alias("id"), F.xxhash64(F.coalesce(F.col(text_column), F.lit(""))).alias("mark")]
    found = stored(fingerprints(docs.select(*place, F.col(text_column).alias("_text")), "_text", "fp", size), "simhash")
    first = F.struct(F.col("id").isNull().alias("unnamed"), "id", "mark")
    nodes = stored(found.groupBy("fp").agg(F.min(first).alias("first")), "simhash-nodes")
    seen = nodes.select("fp", F.col("fp").alias("node"), F.lit(0).alias("view"))
    roots = common.connected(links(seen, radius=radius, slice_size=slice_size))
    of_node = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    keepers = of_node.groupBy("root").agg(F.min("first").alias("first")).select("first.id", "first.mark").distinct()
    gone = stored(common.null_safe_join(found.select("id", "mark"), keepers, ["id", "mark"], "left_anti").distinct(), "near-gone")
    gone = F.broadcast(gone) if fits_broadcast(gone) else gone
    marked = docs.select(F.struct("*").alias("_row"), *place)
    return common.null_safe_join(marked, gone, ["id", "mark"], "left_anti").select("_row.*")
