"""Set-similarity join of documents by chosen paths.

A document is the set of its distinct word shingles, known by 64-bit hashes, and has a signature of minwise tokens: under each of 64 hash
functions the shingle that comes first. A tree of paths branches the documents. At the root and at each node one of the 64 functions is
chosen by the node's own hash, in one of four nodes a second one, and documents with the same token go on to the same child. Two sets of
similarity ``t`` agree in a token with probability ``t``, so at 0.8 they have 0.8 * 1.25 = 1 child in common on average, while others part
quickly. Nodes that have become small are compared exhaustively. A tree misses some pairs; independent trees are repeated (``TREES``):
a pair of similarity 0.8 that meets at depth 1, 2 or 3 is missed by all ten about once in 10^7, 4 * 10^5 and 3 * 10^4 cases.

What is compared, and how it stays bounded:

* Documents of equal sets are a class of which one stands for all; hot classes are told their result over salts.
* A small node's members are compared by size and by a sketch. Its first part is a parity bitmap of 1,024 bits: sets that differ in d
  shingles differ in at most d bits, so it rules out no link. Its second part has a byte of each minwise token: of 64 tokens, two sets of
  similarity 0.8 have fewer in common than asked for once in 10^7 cases. Only members that may be linked go on, in the groups that such
  pairs form, and these are verified on the whole sets in one task. A group yields links that connect its components, not all pairs, and
  pairs that are connected already are not looked at. Groups of more than ``CELL_SHINGLES`` shingles are cut into slices that meet in pairs.
* Large nodes branch on. In the first trees, all members are compared with one of them in the same two steps, in cells of bounded size, so that
  a large group of near copies becomes one component at once. Nodes whose members are all of one component are done, and where few
  members are outside of the largest component, these are compared with slices of it and the node is done as well.
* Where the large nodes that are left can be cut into slices that meet in pairs with no more than ``COPIES`` rows for each class, that is
  done, and the same comparison follows; so it is at the last level, whatever it takes: nothing is capped.

The first trees are searched at depth 1 alone, which connects nearly all that is similar; after that all trees carry only what is still
apart.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passtrail.llm import common
from passtrail.operators.scale import fits_broadcast
from passtrail.operators.stores import stored

TOKENS = 64
BITS = 1024
#: Trees that are searched at depth 1 before all others, all trees, and how deep they go.
FIRST, TREES = 2, 10
LEVELS = 5
#: Rows that slices of large nodes may take for each class, so that another level is not worth its passes.
COPIES = 4
#: Members of a node that is compared at once, and shingles of a group that is verified at once.
SMALL = 1024
CELL_SHINGLES = 4 << 20

_ROLL = 0xA24BAED4963EE407
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = np.random.default_rng(13).integers(0, 1 << 63, TOKENS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


# ------------------------------------------------------------------------------------------------------------------- sets


def sets_of(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all texts, sorted by text and value, and where each text's begin (with the end as a last place)."""
    words, owner = common.words_of(texts)
    if not len(words):
        return words, np.zeros(len(texts) + 1, np.int64)
    counts = np.bincount(owner, minlength=len(texts))
    shingles = common.rolled(words, size, _ROLL)
    whole = owner[: len(shingles)] == owner[size - 1 :]
    found, of = [shingles[whole]], [owner[: len(shingles)][whole]]
    starts = np.cumsum(counts) - counts
    for width in range(1, size):  # a text of fewer words is one shingle
        short = np.flatnonzero(counts == width)
        if len(short):
            found.append(common.rolled(words, width, _ROLL)[starts[short]])
            of.append(short)
    tokens, of = np.concatenate(found), np.concatenate(of)
    order = np.lexsort((tokens, of))
    tokens, of = tokens[order], of[order]
    fresh = np.ones(len(tokens), bool)
    fresh[1:] = (tokens[1:] != tokens[:-1]) | (of[1:] != of[:-1])
    tokens, of = tokens[fresh], of[fresh]
    return tokens, np.searchsorted(of, np.arange(len(texts) + 1))


FACTS = "id bigint, mark bigint, n bigint, low bigint, high bigint, tokens binary, sketch binary"


def facts(docs: DataFrame, size: int) -> DataFrame:
    """A row per document: number of shingles, a digest of the set in two halves, minwise tokens, and the sketch."""

    def of(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.batches(parts, 256):
            tokens, cuts = sets_of(common.octets(part.column("_text")), size)
            counts = np.diff(cuts)
            full, starts = np.flatnonzero(counts), cuts[:-1][counts > 0]
            digest = np.zeros((2, part.num_rows), np.uint64)
            chosen = np.zeros((part.num_rows, TOKENS), np.uint32)
            if len(full):
                digest[0, full] = common.mixed(np.add.reduceat(tokens * _ODD, starts) ^ counts[full].astype(np.uint64))
                digest[1, full] = common.mixed(np.add.reduceat(common.mixed(tokens), starts))
                for k, seed in enumerate(_SEEDS):
                    chosen[full, k] = common.mixed(np.minimum.reduceat(tokens * seed, starts)).astype(np.uint32)
            owner = np.repeat(np.arange(part.num_rows), counts)
            place = (tokens >> np.uint64(54)).astype(np.int64)
            odd = np.bincount(owner * BITS + place, minlength=part.num_rows * BITS).astype(np.uint8) & 1
            sketch = np.hstack([np.packbits(odd.reshape(part.num_rows, BITS), axis=1), chosen.astype(np.uint8)])
            yield pa.record_batch(
                [
                    part.column("id"), part.column("mark"), pa.array(counts, pa.int64()), pa.array(digest[0].view(np.int64)),
                    pa.array(digest[1].view(np.int64)), pa.array([r.tobytes() for r in chosen], pa.binary()), pa.array([r.tobytes() for r in sketch], pa.binary()),
                ],
                names=[c.split()[0] for c in FACTS.split(", ")],
            )

    return docs.select("id", "mark", "_text").mapInArrow(of, FACTS)


def _least(size: np.ndarray, similarity: tuple[int, int]) -> np.ndarray:
    """The size of the smaller of two similar sets, at least."""
    up, down = similarity
    return -(-up * size // down)


def least_common(similarity: tuple[int, int], odds: float = 1e-7) -> int:
    """How many of the minwise tokens two sets of that similarity have in common, but for the given odds."""
    t, below, k = similarity[0] / similarity[1], 0.0, 0
    while k < TOKENS:
        below += math.comb(TOKENS, k) * t**k * (1 - t) ** (TOKENS - k)
        if below > odds:
            break
        k += 1
    return k


class Sketches:
    """What is known of the sets of some members without reading them."""

    def __init__(self, size: np.ndarray, sketch: np.ndarray, similarity: tuple[int, int]):
        packed = np.frombuffer(b"".join(sketch.tolist()), np.uint8).reshape(len(sketch), -1)
        self.size, self.similarity, self.common = np.asarray(size, np.int64), similarity, least_common(similarity)
        self.bits = np.ascontiguousarray(packed[:, : BITS // 8]).view(np.uint64)
        self.tokens = packed[:, BITS // 8 :]

    def may_link(self, a: np.ndarray | int, b: np.ndarray) -> np.ndarray:
        """Whether members ``a``, one or as many as ``b``, can be similar to the members ``b``."""
        up, down = self.similarity
        n, m = self.size[a], self.size[b]
        differ = np.bitwise_count(self.bits[a] ^ self.bits[b]).sum(axis=1, dtype=np.int64)
        # A Jaccard similarity of up / down leaves at most (n + m) (down - up) / (down + up) shingles that only one set has.
        may = (differ * (down + up) <= (n + m) * (down - up)) & (np.minimum(n, m) >= _least(np.maximum(n, m), self.similarity))
        return may & ((self.tokens[a] == self.tokens[b]).sum(axis=1) >= self.common)


def similar(a: np.ndarray, b: np.ndarray, similarity: tuple[int, int]) -> bool:
    up, down = similarity
    both = len(np.intersect1d(a, b, assume_unique=True))
    return down * both >= up * (len(a) + len(b) - both)


class Sets:
    """Members of a group that are joined step by step; members of one component are joined from the start."""

    def __init__(self, components: np.ndarray):
        _, first, of = np.unique(components, return_index=True, return_inverse=True)
        self.parent = first[of].tolist()

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        self.parent[max(a, b)] = min(a, b)
        return a != b

    def roots(self) -> np.ndarray:
        return np.array([self.root(i) for i in range(len(self.parent))])


# ------------------------------------------------------------------------------------------------------------------ paths


def _keys(chosen: np.ndarray, place: np.ndarray | int, parent: np.ndarray) -> np.ndarray:
    """The children of nodes, named by a function and a token."""
    token = chosen[np.arange(len(chosen)), place].astype(np.uint64)
    return common.mixed(parent * _ODD + common.mixed(token + (np.asarray(place, np.uint64) + np.uint64(1) << np.uint64(32))))


def _tokens(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, TOKENS)


ROWS = "key bigint, node bigint, comp bigint, n bigint, sketch binary"
_CARRIED = ["node", "comp", "n", "sketch"]


def branch(rows: DataFrame, level: int, trees: int = 0) -> DataFrame:
    """Rows (key, node, comp, n, sketch, tokens) to their children; at level 0 there is no key, and so many ``trees`` begin."""

    def of(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.batches(parts):
            chosen = _tokens(part.column("tokens"))
            if level:
                parents = [part.column("key").to_numpy().view(np.uint64)]
            else:
                parents = [np.full(len(chosen), common.mixed(np.array([t + 1], np.uint64) * _ODD)[0]) for t in range(trees)]
            for parent in parents:
                dice = common.mixed(parent + np.uint64(level + 1) * _ODD)
                first = (dice % np.uint64(TOKENS)).astype(np.int64)
                second = (first + 1 + ((dice >> np.uint64(16)) % np.uint64(TOKENS - 1)).astype(np.int64)) % TOKENS
                some = np.flatnonzero((dice >> np.uint64(40)) % np.uint64(4) == 0)
                for place, at in ((first, np.arange(len(chosen))), (second, some)):
                    keys = _keys(chosen[at], place[at], parent[at])
                    take = pa.array(at, pa.int64())
                    yield pa.record_batch([pa.array(keys.view(np.int64)), *[part.column(c).take(take) for c in _CARRIED]], names=["key", *_CARRIED])

    names = ["key"] * bool(level) + [*_CARRIED, "tokens"]
    return rows.select(*names).mapInArrow(of, ROWS)


def _met(rows: DataFrame, small: int, heavy: int) -> DataFrame:
    """Members of nodes that hold at least two components, with ``members`` of the node and whether it is ``large``.

    The nodes are broadcast if they are measured to be few; otherwise rows meet them over salts, as a node may hold very many.
    """
    counted = rows.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("weight"), F.min("comp").alias("a"), F.max("comp").alias("b"))
    several = counted.filter("a <> b").select("key", "members", ((F.col("members") > small) | (F.col("weight") > heavy)).alias("large"), "weight")
    several = stored(several, "paths-nodes")
    if fits_broadcast(several):
        return stored(rows.join(F.broadcast(several), "key"), "paths-met")
    return stored(common.tell_groups(rows, ["key"], several, F.col("node")), "paths-met")


CELLS = "cell bigint, node bigint, role int"
_COMPARED = ["key", "lo", "hi", "role", "node", "comp", "n", "sketch"]


def cells_of_nodes(members: DataFrame, similarity: tuple[int, int], heavy: int) -> DataFrame:
    """Groups to verify among members (key, lo, hi, role, node, comp, n, sketch): those that sizes and sketches may link, by such pairs.

    Where ``lo`` and ``hi`` differ, members of role 0 meet those of role 1. A group is named by its members, so that trees that come to the
    same group ask for it once.
    """

    def of(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, begin, end in common.whole_groups(parts, 3):
            out: list[tuple[int, np.ndarray, np.ndarray]] = []
            for x, y in zip(begin.tolist(), end.tolist()):
                out += _grouped([c[x:y] for c in columns], similarity, heavy)
            yield _cell_rows(out)

    dealt = members.select(*_COMPARED).repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "node")
    return dealt.mapInArrow(of, CELLS).distinct()


def _cell_rows(found: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    cell = np.repeat(np.array([c for c, _, _ in found], np.int64), [len(n) for _, n, _ in found])
    node, role = (np.concatenate([f[k] for f in found] or [np.zeros(0, np.int64)]) for k in (1, 2))
    return pa.record_batch([pa.array(cell, pa.int64()), pa.array(node, pa.int64()), pa.array(role, pa.int32())], names=["cell", "node", "role"])


def _grouped(columns: list[np.ndarray], similarity: tuple[int, int], heavy: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(cell, nodes, roles) of the groups that pairs which may be links form, among the members of a node."""
    _, lo, hi, role, node, comp, n, sketch = columns
    sketches = Sketches(n, sketch, similarity)
    groups, candidate = Sets(np.arange(len(node))), np.zeros(len(node), bool)
    across = lo[0] != hi[0]
    for i in range(len(node)):
        others = np.flatnonzero(role == 0) if across and role[i] else np.arange(0 if across else i)
        if across and not role[i]:
            continue
        others = others[comp[others] != comp[i]]
        if len(others):
            for j in others[sketches.may_link(i, others)].tolist():
                groups.join(i, j)
                candidate[i] = candidate[j] = True
    roots = groups.roots()
    for root in np.unique(roots[candidate]).tolist():
        at = np.flatnonzero(candidate & (roots == root))
        yield from _sliced(node[at], n[at], heavy)


def _named(*parts: np.ndarray) -> int:
    values = np.concatenate([np.asarray(p, np.int64).view(np.uint64) + np.uint64(k) * _ODD for k, p in enumerate(parts)])
    return int(common.mixed(common.mixed(values).sum(keepdims=True) * _ODD).view(np.int64)[0])


def _sliced(node: np.ndarray, n: np.ndarray, heavy: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """A group as one cell, or, where it is heavy, as a cell for each two of its slices."""
    if n.sum() <= heavy or len(node) < 3:
        yield _named(node), node, np.zeros(len(node), np.int64)
        return
    number = np.cumsum(n) // max(1, heavy // 2)
    slices = [np.flatnonzero(number == s) for s in np.unique(number)]
    for b, high in enumerate(slices):
        if len(high) > 1:
            yield _named(node[high]), node[high], np.zeros(len(high), np.int64)
        for low in slices[:b]:
            roles = np.repeat([0, 1], [len(low), len(high)])
            yield _named(node[low], node[high]), np.concatenate([node[low], node[high]]), roles


def cells_of_stars(members: DataFrame, similarity: tuple[int, int], small: int, heavy: int, classes: DataFrame) -> DataFrame:
    """For each large node one member against all others that it may be linked to, in cells of bounded size."""
    first = members.groupBy("key").agg(F.min(F.struct(F.xxhash64("node").alias("h"), "node", "comp")).alias("p"))
    first = stored(first.select("key", F.col("p.node").alias("pivot"), F.col("p.comp").alias("with")), "paths-first")
    few = fits_broadcast(first)
    told = members.join(F.broadcast(first), "key") if few else common.tell_groups(members, ["key"], first, F.col("node"))
    asked = told.filter("comp <> with")
    slices = F.greatest(F.ceil(F.col("members") / small), F.ceil(2 * F.col("weight") / heavy)).cast("long")
    pairs = asked.groupBy("pivot", "node").agg(F.max(slices).alias("slices")).join(classes.select("node", "n", "sketch"), "node")
    pivots = first.select(F.col("pivot").alias("node")).distinct().join(classes.select("node", "n", "sketch"), "node")
    pivots = stored(pivots.withColumnsRenamed({"node": "pivot", "n": "pivot_n", "sketch": "pivot_sketch"}), "paths-pivots")
    few = few and fits_broadcast(pivots)
    both = pairs.join(F.broadcast(pivots), "pivot") if few else common.tell_groups(pairs, ["pivot"], pivots, F.col("node"))

    def of(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.batches(parts):
            n, sketch, pivot_n, pivot_sketch = (part.column(c).to_numpy(zero_copy_only=False) for c in ("n", "sketch", "pivot_n", "pivot_sketch"))
            known = Sketches(np.concatenate([n, pivot_n]), np.concatenate([sketch, pivot_sketch]), similarity)
            at = np.arange(len(n))
            yield part.select(["pivot", "node", "slices"]).filter(pa.array(known.may_link(at, at + len(n))))

    kept = both.select("pivot", "node", "slices", "n", "sketch", "pivot_n", "pivot_sketch").mapInArrow(of, "pivot bigint, node bigint, slices bigint")
    dealt = stored(kept, "paths-stars").withColumn("cell", F.xxhash64("pivot", "slices", F.pmod(F.xxhash64("node"), F.col("slices"))))
    pivots = dealt.select("cell", F.col("pivot").alias("node"), F.lit(1).alias("role")).distinct()
    return dealt.select("cell", "node", F.lit(0).alias("role")).union(pivots)


def lopsided(members: DataFrame, small: int) -> DataFrame:
    """Members of large nodes with ``most``, the node's largest component, ``share``, its members, and ``rest``, the others' number."""
    by_comp = members.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("share"))
    largest = by_comp.groupBy("key").agg(F.max(F.struct("share", "comp")).alias("m"), F.sum("share").alias("all"))
    facts_of = largest.select("key", F.col("m.comp").alias("most"), F.col("m.share").alias("share"), (F.col("all") - F.col("m.share")).alias("rest"))
    facts_of = stored(facts_of, "paths-largest")
    if fits_broadcast(facts_of):
        told = members.join(F.broadcast(facts_of), "key")
    else:
        told = common.tell_groups(members, ["key"], facts_of, F.col("node"))
    return stored(told.withColumn("aside", F.col("rest") <= small), "paths-large")


def cells_of_rests(members: DataFrame, small: int) -> DataFrame:
    """The few members outside of the largest component of a node: with one another, and with each slice of that component."""
    outside = F.col("comp") != F.col("most")
    slices = F.ceil(F.col("share") / small).cast("int")
    mine = F.array(F.pmod(F.xxhash64("node"), F.col("slices")).cast("int"))
    dealt = members.withColumn("slices", slices).withColumn("lo", F.explode(F.when(outside, F.sequence(F.lit(-1), F.col("slices") - 1)).otherwise(mine)))
    # Where ``lo`` is -1 all of them meet; elsewhere they meet a slice.
    hi = F.when(F.col("lo") < 0, F.col("lo")).otherwise(F.col("slices"))
    role = (outside & (F.col("lo") >= 0)).cast("int")
    return dealt.select("key", "lo", hi.alias("hi"), role.alias("role"), *_CARRIED)


def _slices(small: int) -> Column:
    return F.ceil(2 * F.col("members") / small).cast("int")


def cells_of_slices(members: DataFrame, small: int) -> DataFrame:
    """Members of nodes that stay large, dealt into slices that meet in pairs."""
    cut = members.withColumn("slices", _slices(small)).withColumn("slice", F.pmod(F.xxhash64("node"), F.col("slices")).cast("int"))
    meets = F.transform(
        F.sequence(F.lit(0), F.col("slices") - 1),
        lambda t: F.struct(F.least(t, F.col("slice")).alias("lo"), F.greatest(t, F.col("slice")).alias("hi")),
    )
    role = ((F.col("slice") == F.col("hi")) & (F.col("lo") < F.col("hi"))).cast("int")
    met = cut.withColumn("m", F.explode(meets)).select("*", "m.lo", "m.hi")
    return met.select("key", "lo", "hi", role.alias("role"), *_CARRIED)


# ----------------------------------------------------------------------------------------------------------- verification

LINKS = "a bigint, b bigint"


def verified(cells: DataFrame, classes: DataFrame, docs: DataFrame, labels: DataFrame, size: int, similarity: tuple[int, int]) -> DataFrame:
    """Links that connect what is similar in each cell, by the whole sets."""
    wanted = classes.join(cells.select("node").distinct(), "node", "left_semi").select("node", "id", "mark", "sketch")
    wanted = stored(wanted.join(labels, "node"), "paths-wanted")
    wanted = F.broadcast(wanted) if fits_broadcast(wanted) else wanted

    def shingled(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.batches(parts, 256):
            tokens, cuts = sets_of(common.octets(part.column("_text")), size)
            data = [tokens[a:b].tobytes() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
            known = [part.column(c) for c in ("node", "comp", "sketch")]
            yield pa.record_batch([*known, pa.array(data, pa.binary())], names=["node", "comp", "sketch", "set"])

    read = common.null_safe_join(docs, wanted, ["id", "mark"]).select("node", "comp", "sketch", "_text")
    known = read.mapInArrow(shingled, "node bigint, comp bigint, sketch binary, set binary").dropDuplicates(["node"])
    # Cells that are measured to be narrow enough meet the sets where these are, so that sets move once.
    cells = F.broadcast(cells) if fits_broadcast(cells) else cells
    rows = known.join(cells, "node").select("cell", "role", "node", "comp", "sketch", "set")

    def of(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, begin, end in common.whole_groups(parts, 1):
            found: list[tuple[int, int]] = []
            for x, y in zip(begin.tolist(), end.tolist()):
                found += _linked([c[x:y] for c in columns[1:]], similarity)
            yield pa.record_batch([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return rows.repartition("cell").sortWithinPartitions("cell", "node").mapInArrow(of, LINKS).distinct()


def _linked(columns: list[np.ndarray], similarity: tuple[int, int]) -> Iterator[tuple[int, int]]:
    role, node, comp, sketch, sets = columns
    sets = [np.frombuffer(s, np.uint64) for s in sets.tolist()]
    sketches = Sketches(np.array([len(s) for s in sets]), sketch, similarity)
    joined, two_sided = Sets(comp), bool(role.any())
    begun = np.unique(joined.roots())
    for i in range(len(node)):
        if two_sided and not role[i]:
            continue
        others = np.flatnonzero(role == 0) if two_sided else np.arange(i)
        if not len(others):
            continue
        for j in others[sketches.may_link(i, others)].tolist():
            if joined.root(i) != joined.root(j) and similar(sets[i], sets[j], similarity):
                joined.join(i, j)
    # All links of a component go to one member, so that labels need few rounds to get everywhere.
    for i in begun.tolist():
        if joined.root(i) != i:
            yield int(node[i]), int(node[joined.root(i)])


# --------------------------------------------------------------------------------------------------------------- the join


def _roots(edges: DataFrame) -> DataFrame:
    """``common.connected`` of edges (a, b), where labels that are measured to be few are broadcast in each round."""
    both = stored(edges.union(edges.select("b", "a")).filter("a <> b").distinct(), "paths-edges")
    first = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("root")), "paths-roots")
    if not fits_broadcast(first):
        return common.connected(both)
    labels = first
    while True:
        near = both.join(F.broadcast(labels.withColumnsRenamed({"node": "b", "root": "near"})), "b").groupBy("a").agg(F.min("near").alias("near"))
        lower = near.join(F.broadcast(labels.withColumnsRenamed({"node": "a", "root": "was"})), "a")
        lower = lower.select(F.col("a").alias("node"), F.least("near", "was").alias("mid"), "was")
        jump = labels.withColumnsRenamed({"node": "mid", "root": "far"})
        after = stored(lower.join(F.broadcast(jump), "mid").select("node", F.least("mid", "far").alias("root"), "was"), "paths-roots")
        if after.filter("root <> was").isEmpty():
            return after.select("node", "root")
        labels = after.select("node", "root")


def _relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """(node, comp) of all classes after further links; a component is named by a node in it, so links are taken to components."""
    ends = links.join(labels.withColumnsRenamed({"node": "a", "comp": "x"}), "a").join(labels.withColumnsRenamed({"node": "b", "comp": "y"}), "b")
    roots = _roots(ends.select(F.col("x").alias("a"), F.col("y").alias("b"))).withColumnRenamed("node", "comp")
    roots = F.broadcast(roots) if fits_broadcast(roots) else roots
    return stored(labels.join(roots, "comp", "left").select("node", F.coalesce("root", "comp").alias("comp")), "paths-labels")


def _opened(members: DataFrame, classes: DataFrame, level: int) -> DataFrame:
    """The children of members (key, node, comp) of nodes that branch on. Classes are wide: they stay where they lie if the members are
    measured to be few, and otherwise they move once."""
    members = stored(members, "paths-open")
    wide = classes.select("node", "n", "sketch", "tokens")
    if fits_broadcast(members):
        return branch(wide.join(F.broadcast(members), "node"), level)
    return stored(branch(wide.join(members, "node"), level), "paths-children")


def components(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = 2, similarity: tuple[int, int] = (80, 100),
    first: int = FIRST, trees: int = TREES, levels: int = LEVELS, small: int = SMALL, heavy: int = CELL_SHINGLES,
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles``, ``component_id`` and ``kept``.

    Words are runs of characters outside [\\x20\\x09-\\x0D], with A-Z in lower case; a document's set holds its distinct shingles of ``size``
    words, or, if it has fewer words, all of them as one. Documents are linked if their sets have a Jaccard similarity of at least the
    ratio ``similarity``; each link is confirmed on whole sets. ``component_id`` is the smallest id that can be reached over links, itself
    included, and ``kept`` tells whether it is the row's own.

    A text that is null, empty or blank has no set and is linked with nothing. A null id only counts where there is no other: such a row
    is kept if no named one is connected with it. Rows that are equal in set are linked, rows that share an id are rows of their own.
    Other columns are not looked at. An empty table gives an empty result. Starts jobs.
    """
    text = F.coalesce(common.column(text_column), F.lit(""))
    mine = docs.select(common.column(id_column).cast("long").alias("id"), F.xxhash64(text).alias("mark"), text.alias("_text"))
    found = stored(facts(mine, size), "paths-facts")
    place = F.struct(F.col("id").isNull().alias("unnamed"), "id", "mark")
    classes = found.filter("n > 0").groupBy("low", "high").agg(F.min(place).alias("at"), *[F.first(c).alias(c) for c in ("n", "tokens", "sketch")])
    classes = stored(classes.select(F.monotonically_increasing_id().alias("node"), "low", "high", "at.id", "at.mark", "n", "tokens", "sketch"), "paths-classes")
    labels = classes.select("node", F.col("node").alias("comp"))
    most = COPIES * classes.count()
    # The first trees do not go deeper here: their large nodes come again with all trees.
    for number, deepest in ((first, 1), (trees, levels)):
        rows = branch(classes.join(labels, "node"), 0, number)
        for level in range(1, deepest + 1):
            met = _met(rows, small, heavy)
            whole = met.filter("not large").select("key", F.lit(0).alias("lo"), F.lit(0).alias("hi"), F.lit(0).alias("role"), *_CARRIED)
            many = met.filter("large")
            last, begins = many.isEmpty(), deepest == 1 < levels
            if not last and not begins:
                many = lopsided(many, small)
                whole = whole.union(cells_of_rests(many.filter("aside"), small))
                many = many.filter("not aside")
                copies = many.agg(F.sum(_slices(small))).first()[0] or 0
                last = not copies
                if not last and (level == levels or copies <= most):
                    whole, last = whole.union(cells_of_slices(many, small)), True
            cells = cells_of_nodes(whole, similarity, heavy)
            if not last and begins:
                cells = cells.union(cells_of_stars(many, similarity, small, heavy, classes))
            cells = stored(cells, "paths-cells")
            new = None if cells.isEmpty() else stored(verified(cells, classes, mine, labels, size, similarity), "paths-links")
            if new is not None and not new.isEmpty():
                labels = _relabelled(labels, new)
            if last or level == deepest:
                break
            rows = _opened(many.select("key", "node").join(labels, "node"), classes, level)
    least = classes.join(labels, "node").groupBy("comp").agg(F.min("id").alias("component_id"))
    of_class = labels.join(least, "comp").join(classes.select("node", "low", "high"), "node").select("low", "high", "component_id")
    told = common.tell_groups(found.filter("n > 0").select("id", "mark", "n", "low", "high"), ["low", "high"], of_class, F.struct("id", "mark"))
    alone = found.filter("n = 0").select("id", "n", F.col("id").alias("component_id"))
    out = told.select("id", "n", "component_id").union(alone)
    return out.select(
        F.col("id").alias(id_column), F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )
