"""Line deduplication by an exact set-similarity join.

A line is the set of its words. Words are ordered by rarity: counts of hashed words in 2^18 bins give each bin a rank, and the rank
followed by the rest of the hash is a word's key, so any two lines order their words alike and the rarest come first. Lines of equal
sets are classes, of which the first line stands for all. Two sets of a Jaccard similarity of at least ``t`` share a word among the
first ``n - ceil(t n) + 1`` of each, so only those prefixes are joined, with filters on length, on the position of the common word and
on a bitmap: sets that differ in d words differ in at most d bits of a parity bitmap. Candidates are verified on the whole sets.
A line goes if an earlier line is similar.

Texts are read where they lie: once for the counts, once for the lines (hash of the set, place, bitmap, prefix), and again for the few
documents whose lines must be verified or cut. Lines and the entries of their prefixes travel packed, dealt by set and by word. A
word's list is ordered by size, so that a line meets only those of compatible sizes; long lists are cut in slices, each of which meets
each. A line takes the nearest few candidates from a list; only lines whose candidates all fail and that have others are searched again
for all of them. So a cluster of similar lines gives about as many candidates as it has lines.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passtrail.llm import common
from passtrail.operators.scale import fits_broadcast
from passtrail.operators.stores import stored

BIN_BITS, PART_BITS = 18, 12
_REST = np.uint64((1 << (64 - BIN_BITS)) - 1)
SLICE = 4096
#: A line emits this many candidates from a word's list; if there are more, it is said so.
FEW = 2
#: Prefix words are counted in 2^16 bins, to find the lists that have to be cut in slices.
LIST_BITS = 16
#: Bytes of text, and pairs of entries, that are gone through at a time: their arrays stay in a core's cache.
BLOCK, PAIRS = 1 << 17, 1 << 16
#: ``rank`` never falls as the id grows; equal ranks are told apart by the whole place, (id, mark, line), in the end.
RANKS = 1 << 31
LINE = np.dtype(
    [("digest", "<i8"), ("there", "?"), ("id", "<i8"), ("mark", "<i8"), ("line", "<i4"), ("rank", "<u4"), ("size", "<u4"),
     ("low", "<u8"), ("high", "<u8"), ("words", "<u4")]
)
ENTRY = np.dtype(
    [("word", "<u4"), ("rank", "<u4"), ("size", "<u4"), ("place", "<u2"), ("open", "?"), ("digest", "<i8"), ("low", "<u8"), ("high", "<u8")]
)
#: Kinds of packed rows: lines with their prefixes, places of lines that repeat an earlier one, counts of prefix words by bin.
FIRST, REPEAT, COUNT = 0, 1, 2
PACKED = "bucket int, kind int, lines binary, words binary"
ENTRIES = "bucket int, lo int, hi int, slices int, entries binary"
PAIR = "line bigint, other bigint"
_PLACE = ("id", "mark", "line")


def rarity(docs: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """The rank of each bin of hashed words, by how often its words occur in the whole table; and the number of all words."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BIN_BITS, np.int64)
        for part in common.batches(parts):
            hashes = common.words_of(common.octets(part.column(0)), block=BLOCK)[0]
            total += np.bincount((hashes >> np.uint64(64 - BIN_BITS)).astype(np.int64), minlength=1 << BIN_BITS)
        pieces = [total[k : k + (1 << PART_BITS)].tobytes() for k in range(0, len(total), 1 << PART_BITS)]
        yield pa.record_batch([pa.array(range(len(pieces)), pa.int32()), pa.array(pieces, pa.binary())], names=["part", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b, np.int64) for b in table["counts"].to_pylist())
        return pa.table({"part": table["part"].slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})

    kinds = "part int, counts binary"
    counts = np.zeros(1 << BIN_BITS, np.int64)
    for row in docs.select(text).mapInArrow(count, kinds).groupBy("part").applyInArrow(add, kinds).collect():
        counts[row["part"] << PART_BITS : (row["part"] + 1) << PART_BITS] = np.frombuffer(row["counts"], np.int64)
    rank = np.empty(1 << BIN_BITS, np.uint64)
    rank[np.argsort(counts, kind="stable")] = np.arange(1 << BIN_BITS, dtype=np.uint64)
    return rank, int(counts.sum())


class Sets:
    """The lines of some texts as sets of ordered word keys."""

    def __init__(self, texts: list[bytes], rank: np.ndarray):
        self.text_of, self.number, parts = [], [], []
        for k, text in enumerate(texts):
            lines = text.split(b"\n")
            parts += lines
            self.text_of += [k] * len(lines)
            self.number += range(len(lines))
        self.count = len(parts)
        hashes, line = common.words_of(parts, block=BLOCK)
        keys = (rank[(hashes >> np.uint64(64 - BIN_BITS)).astype(np.int64)] << np.uint64(64 - BIN_BITS)) | (hashes & _REST)
        order = np.argsort(keys)
        order = order[np.argsort(line[order].astype(np.uint16 if self.count <= 1 << 16 else np.int64), kind="stable")]
        keys, line = keys[order], line[order]
        fresh = np.ones(len(keys), bool)
        fresh[1:] = (keys[1:] != keys[:-1]) | (line[1:] != line[:-1])
        self.keys, self.line = keys[fresh], line[fresh]
        self.sizes = np.bincount(self.line, minlength=self.count)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def of(self, k: int) -> np.ndarray:
        return self.keys[self.starts[k] : self.starts[k] + self.sizes[k]]

    def rows(self, similarity: float) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """What is kept of each line that has words, the texts that they are of, and the packed words of each prefix."""
        full = np.flatnonzero(self.sizes)
        size, start = self.sizes[full], self.starts[full]
        out = np.zeros(len(full), LINE)
        if not len(full):
            return out, full, []
        spread = common.mixed(self.keys)
        out["digest"] = common.mixed(np.add.reduceat(spread, start) ^ size.astype(np.uint64)).view(np.int64)
        at = np.uint64(1) << ((spread >> np.uint64(57)) & np.uint64(63))
        upper = spread >> np.uint64(63) > 0
        out["low"] = np.bitwise_xor.reduceat(np.where(upper, np.uint64(0), at), start)
        out["high"] = np.bitwise_xor.reduceat(np.where(upper, at, np.uint64(0)), start)
        out["size"], out["line"] = size, np.array(self.number)[full]
        out["words"] = length = size - np.ceil(similarity * size - 1e-9).astype(np.int64) + 1
        words = spread.astype(np.uint32).tobytes()
        return out, np.array(self.text_of)[full], [words[4 * a : 4 * (a + n)] for a, n in zip(start.tolist(), length.tolist())]


def _packed(rows: list[tuple]) -> pa.Table:
    names = [c.split()[0] for c in PACKED.split(", ")]
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return pa.table([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)


def _bucket(digests: np.ndarray, buckets: int) -> np.ndarray:
    """The top bits of a digest."""
    return (digests.view(np.uint64) >> np.uint64(64 - int(buckets).bit_length() + 1)).astype(np.int64)


def _first_lines(lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the first line of each set is, in the order of the sets, and the lines that come after it.

    A line that has the place of the first is the same line of a repeated row, and neither.
    """
    order = np.lexsort([lines[c] for c in ("line", "mark", "id", "there", "digest")])
    fresh = np.ones(len(order), bool)
    fresh[1:] = lines["digest"][order[1:]] != lines["digest"][order[:-1]]
    first = order[fresh]
    leader = first[np.cumsum(fresh) - 1]
    later = np.zeros(len(order), bool)
    for c in ("there", "id", "mark", "line"):
        later |= lines[c][order] != lines[c][leader]
    return first, order[later]


def line_rows(docs: DataFrame, rank: np.ndarray, similarity: float, buckets: int) -> DataFrame:
    """Packed lines with words, dealt by their sets, from (id, mark, rank, text): of lines equal within a task only the first."""

    def send(held: list[tuple], turn: int) -> pa.RecordBatch:
        lines, prefixes = np.concatenate([h[0] for h in held]), [p for h in held for p in h[1]]
        first, later = _first_lines(lines)
        rows = [(turn % buckets, REPEAT, lines[later].tobytes(), b"")] if len(later) else []
        bucket = _bucket(np.ascontiguousarray(lines["digest"][first]), buckets)
        order = np.argsort(bucket, kind="stable")
        first, bucket = first[order], bucket[order]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]]).tolist()
        for a, b in zip(cuts[:-1], cuts[1:]):
            rows.append((int(bucket[a]), FIRST, lines[first[a:b]].tobytes(), b"".join(prefixes[i] for i in first[a:b].tolist())))
        return _packed(rows).to_batches()[0]

    def of(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, turn = [], 0, 0
        for part in common.batches(parts, 256):
            lines, texts, prefixes = Sets(common.octets(part.column("_text")), rank).rows(similarity)
            if not len(lines):
                continue
            there = part.column("id").is_valid().to_numpy(zero_copy_only=False)
            lines["there"], lines["id"] = there[texts], part.column("id").fill_null(0).to_numpy()[texts]
            lines["mark"], lines["rank"] = part.column("mark").to_numpy()[texts], part.column("rank").to_numpy()[texts]
            held.append((lines, prefixes))
            size += len(lines)
            if size >= 1 << 16:
                yield send(held, turn)
                held, size, turn = [], 0, turn + 1
        if held:
            yield send(held, turn)

    return docs.select("id", "mark", "rank", "_text").mapInArrow(of, PACKED)


def _unpacked(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The lines of packed rows, and the words of their prefixes."""
    lines = np.frombuffer(b"".join(table["lines"].to_pylist()), LINE)
    return lines, np.frombuffer(b"".join(table["words"].to_pylist()), np.uint32)


def _of_kind(table: pa.Table, kind: int) -> pa.Table:
    return table.filter(pa.array(table["kind"].to_numpy() == kind))


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of the runs that begin at ``starts``."""
    return np.arange(sizes.sum()) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)


def _classes(table: pa.Table) -> pa.Table:
    """The first line of each set, in packed rows of bounded size; the other lines; how often prefix words fall into each bin."""
    number = table["bucket"][0].as_py()
    rows = [(number, REPEAT, b, b"") for b in _of_kind(table, REPEAT)["lines"].to_pylist()]
    lines, words = _unpacked(_of_kind(table, FIRST))
    if len(lines):
        first, later = _first_lines(lines)
        if len(later):
            rows.append((number, REPEAT, lines[later].tobytes(), b""))
        sizes = lines["words"].astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        counts = np.zeros(1 << LIST_BITS, np.int64)
        for a in range(0, len(first), 1 << 14):
            some = first[a : a + (1 << 14)]
            kept = words[_runs(starts[some], sizes[some])]
            counts += np.bincount(kept >> np.uint32(32 - LIST_BITS), minlength=len(counts))
            rows.append((number, FIRST, lines[some].tobytes(), kept.tobytes()))
        rows.append((number, COUNT, counts.astype(np.uint32).tobytes(), b""))
    return _packed(rows)


def long_lists(classes: DataFrame, slice_size: int) -> dict[int, int]:
    """The slices of each bin that holds many prefix words: more than ``slice_size``, and than four times the mean."""

    def split(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for b in part.column("lines").to_pylist():
                step = 4 << 12
                pieces = [b[k : k + step] for k in range(0, len(b), step)]
                yield pa.record_batch([pa.array(range(len(pieces)), pa.int32()), pa.array(pieces, pa.binary())], names=["part", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b, np.uint32).astype(np.int64) for b in table["counts"].to_pylist())
        return pa.table({"part": table["part"].slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})

    kinds = "part int, counts binary"
    sums = classes.filter(F.col("kind") == COUNT).select("lines").mapInArrow(split, kinds).groupBy("part").applyInArrow(add, kinds)
    total = np.zeros(1 << LIST_BITS, np.int64)
    for row in sums.collect():
        total[row["part"] << 12 : (row["part"] + 1) << 12] = np.frombuffer(row["counts"], np.int64)
    most = max(slice_size, 4 * int(total.sum()) >> LIST_BITS)
    return {int(k): int(-(-total[k] // most)) for k in np.flatnonzero(total > most)}


# ------------------------------------------------------------------------------------------------------------ candidates


def _entries(table: pa.Table, asks: np.ndarray | None, bins: np.ndarray | None, buckets: int, long: dict[int, int]) -> pa.Table:
    """Packed entries of the prefixes of first lines, dealt by word; words of long lists by slices, each of which meets each.

    With ``bins``, only words of those bins, and only lines of ``asks`` are open.
    """
    rows: list[tuple] = []
    for at in range(table.num_rows):
        lines, words = _unpacked(table.slice(at, 1))
        sizes = lines["words"].astype(np.int64)
        line = np.repeat(np.arange(len(lines)), sizes)
        list_bin = (words >> np.uint32(32 - LIST_BITS)).astype(np.int64)
        entries = np.zeros(len(words), ENTRY)
        entries["word"] = words
        entries["place"] = np.minimum(np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes), 65535)
        for c in ("rank", "size", "digest", "low", "high"):
            entries[c] = lines[c][line]
        entries["open"] = True if asks is None else np.isin(lines["digest"], asks)[line]
        if bins is not None:
            entries, list_bin = entries[bins[list_bin]], list_bin[bins[list_bin]]
        slices = np.ones(1 << LIST_BITS, np.int64)
        slices[list(long)] = list(long.values())
        much = slices[list_bin] > 1
        plain = entries[~much]
        bucket = (plain["word"].astype(np.uint64) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        plain, bucket = plain[order], bucket[order]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]]).tolist() if len(bucket) else [0]
        rows += [(int(bucket[a]), 0, 0, 1, plain[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:])]
        mine, own = entries[much], list_bin[much]
        part = _slice(mine["digest"], slices[own])
        order = np.lexsort((part, own))
        mine, own, part = mine[order], own[order], part[order]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(own) | np.diff(part)) + 1, [len(own)]]).tolist() if len(own) else [0]
        for a, b in zip(cuts[:-1], cuts[1:]):
            k, x, blob = int(own[a]), int(part[a]), mine[a:b].tobytes()
            rows += [(buckets + k, min(x, y), max(x, y), long[k], blob) for y in range(long[k])]
    names = [c.split()[0] for c in ENTRIES.split(", ")]
    kinds = [pa.int32()] * 4 + [pa.binary()]
    return pa.table([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)


def _slice(digests: np.ndarray, slices: int | np.ndarray) -> np.ndarray:
    return (common.mixed(np.ascontiguousarray(digests).view(np.uint64)) % np.asarray(slices, np.uint64)).astype(np.int64)


def _candidates(table: pa.Table, similarity: float, few: int | None) -> pa.Table:
    """(set, set of an earlier line) among the lists of a bucket, or between two slices of long lists: what passes the filters.

    A word's list is ordered by size, so that a line meets only those of compatible sizes. With ``few``, a line takes few candidates
    from a list, the nearest of the block where they are found, and a pair with itself says that there are others.
    """
    entries = np.frombuffer(b"".join(table["entries"].to_pylist()), ENTRY)
    lo, hi, slices = (table[c][0].as_py() for c in ("lo", "hi", "slices"))
    key = (entries["word"].astype(np.uint64) << np.uint64(32)) | entries["size"]
    order = np.argsort(key, kind="stable")
    key, entries = key[order], entries[order]
    size, place, rank, digest, low, high, asking = (
        np.ascontiguousarray(entries[c]) for c in ("size", "place", "rank", "digest", "low", "high", "open")
    )
    size = size.astype(np.int64)
    longest = np.minimum(np.floor(size / similarity + 1e-6), float((1 << 32) - 1)).astype(np.uint64)
    end = np.searchsorted(key, (key & ~np.uint64((1 << 32) - 1)) | longest, side="right")
    count = end - np.arange(len(key)) - 1
    part = _slice(digest, slices) if hi > lo else None
    after = np.concatenate([[0], np.cumsum(count)])
    taken = np.zeros(len(key), np.int64)
    lines, others, at = [], [], 0
    while at < len(key):
        stop = max(at + 1, int(np.searchsorted(after, after[at] + PAIRS, side="right")) - 1)
        a = np.repeat(np.arange(at, stop), count[at:stop])
        b = _runs(np.arange(at, stop) + 1, count[at:stop])
        at = stop
        good = asking[a] | asking[b]
        if part is not None:
            good &= part[a] != part[b]
        need = np.ceil(similarity / (1 + similarity) * (size[a] + size[b]) - 1e-9).astype(np.int64)
        good &= (np.minimum(size[a] - place[a], size[b] - place[b]) >= need) & (size[a] >= np.ceil(similarity * size[b] - 1e-9))
        a, b, need = a[good], b[good], need[good]
        differ = np.bitwise_count(low[a] ^ low[b]).astype(np.int64) + np.bitwise_count(high[a] ^ high[b])
        good = (differ <= size[a] + size[b] - 2 * need) & (digest[a] != digest[b])
        a, b, differ = a[good], b[good], differ[good]
        late, early, differ = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([differ, differ])
        good = asking[late] & (rank[early] <= rank[late])
        late, early, differ = late[good], early[good], differ[good]
        if few is not None:
            order = np.lexsort((differ, late))
            late, early = late[order], early[order]
            fresh = np.ones(len(late), bool)
            fresh[1:] = late[1:] != late[:-1]
            turn = np.arange(len(late)) - np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
            far = taken[late] + turn >= few
            more = np.unique(late[far])
            np.add.at(taken, late[~far], 1)
            late, early = np.concatenate([late[~far], more]), np.concatenate([early[~far], more])
        lines.append(digest[late])
        others.append(digest[early])
    found = np.unique(np.stack([np.concatenate(lines), np.concatenate(others)], axis=1), axis=0) if lines else np.zeros((0, 2), np.int64)
    return pa.table({"line": pa.array(found[:, 0]), "other": pa.array(found[:, 1])})


def _pairs(entries: DataFrame, similarity: float, few: int | None) -> DataFrame:
    """Candidates (line, other), by their sets, among packed entries."""
    return entries.groupBy("bucket", "lo", "hi").applyInArrow(common.on_group(_candidates, similarity=similarity, few=few), PAIR)


def _met(classes: DataFrame, digests: DataFrame, sets: int, function: Callable, schema: str, **settings) -> DataFrame:
    """A function of first lines and of some of their digests, by buckets of sets."""
    asked = digests.select(F.shiftrightunsigned("digest", 65 - sets.bit_length()).cast("int").alias("bucket"), "digest")
    firsts = classes.filter(F.col("kind") == FIRST).groupBy("bucket")
    return firsts.cogroup(asked.groupBy("bucket")).applyInArrow(common.on_pair(function, **settings), schema)


def _places(key: tuple, table: pa.Table, asked: pa.Table) -> pa.Table:
    lines = np.frombuffer(b"".join(table["lines"].to_pylist()), LINE)
    lines = lines[np.isin(lines["digest"], asked["digest"].to_numpy())]
    return _as_rows(lines)


def _as_rows(lines: np.ndarray) -> pa.Table:
    there = np.ascontiguousarray(lines["there"])
    ids = pa.array(np.ascontiguousarray(lines["id"]), mask=~there)
    return pa.table([pa.array(np.ascontiguousarray(lines["digest"])), ids, *[pa.array(np.ascontiguousarray(lines[c])) for c in ("mark", "line")]], names=["digest", *_PLACE])


PLACES = "digest bigint, id bigint, mark bigint, line int"


def _asked_bins(key: tuple, table: pa.Table, asked: pa.Table) -> pa.Table:
    found = np.zeros(1 << LIST_BITS, bool)
    lines, words = _unpacked(table)
    hit = np.repeat(np.isin(lines["digest"], asked["digest"].to_numpy()), lines["words"])
    found[words[hit] >> np.uint32(32 - LIST_BITS)] = True
    return pa.table({"bin": pa.array(np.flatnonzero(found).astype(np.int32))})


def _asked_entries(key: tuple, table: pa.Table, asked: pa.Table, bins: np.ndarray, buckets: int, long: dict[int, int]) -> pa.Table:
    return _entries(table, asked["digest"].to_numpy(), bins, buckets, long)


def _meet(docs: DataFrame, few: DataFrame) -> DataFrame:
    """Documents with what is known of some of them, by (id, mark). ``few`` is broadcast if it is measured to be small."""
    few = few.withColumnsRenamed({"id": "_i", "mark": "_m"})
    few = F.broadcast(few) if fits_broadcast(few) else few
    return docs.join(few, F.col("id").eqNullSafe(F.col("_i")) & (F.col("mark") == F.col("_m")), "left").drop("_i", "_m")


def _verified(pairs: DataFrame, wanted: DataFrame, docs: DataFrame, rank: np.ndarray, similarity: float) -> DataFrame:
    """The lines (by digest) that have an earlier similar one among ``pairs``, by the whole sets; ``wanted`` has all their places."""
    asked = wanted.groupBy("id", "mark").agg(F.collect_list(F.struct("line", "digest")).alias("asked"))
    found = _meet(docs, stored(asked, "lines-asked")).filter("asked is not null").select("_text", "asked")

    def sets(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.batches(parts, 256):
            wanted, found = [], []
            for text, asked in zip(common.octets(part.column("_text")), part.column("asked").to_pylist()):
                all_lines = text.split(b"\n")
                wanted += [item["digest"] for item in asked]
                found += [all_lines[item["line"]] for item in asked]
            lines = Sets(found, rank)
            rows = [(digest, lines.of(k).tobytes()) for k, digest in enumerate(wanted)]
            yield pa.record_batch([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["digest", "words"])

    # Rows that are equal in id and text give the same sets.
    known = stored(found.mapInArrow(sets, "digest bigint, words binary").dropDuplicates(["digest"]), "lines-sets")
    both = pairs.join(known.withColumnRenamed("digest", "line"), "line")
    both = both.join(known.select(F.col("digest").alias("other"), F.col("words").alias("words2")), "other")

    def of(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.batches(parts):
            similar = []
            for x, y in zip(part.column("words").to_pylist(), part.column("words2").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common_words = len(np.intersect1d(x, y, assume_unique=True))
                similar.append(common_words >= similarity * (len(x) + len(y) - common_words) - 1e-9)
            yield part.select(["line", "other"]).filter(pa.array(similar, pa.bool_()))

    similar = both.select("line", "other", "words", "words2").mapInArrow(of, "line bigint, other bigint")
    where = wanted.select("digest", F.struct(F.col("id").isNotNull().alias("there"), *_PLACE).alias("at"))
    placed = similar.join(where.withColumnsRenamed({"digest": "line", "at": "at_line"}), "line")
    placed = placed.join(where.withColumnsRenamed({"digest": "other", "at": "at_other"}), "other")
    return placed.select(F.when(F.col("at_line") > F.col("at_other"), F.col("line")).otherwise(F.col("other")).alias("digest")).distinct()


OUT = "_id bigint, n_lines bigint, n_removed bigint, kept_text string"


def without_similar_lines(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", similarity: float = 0.8, slice_size: int = SLICE
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_lines``, ``n_removed``, ``kept_text``.

    Lines end at line feeds. A line's words are runs of characters outside [\\x20\\x09-\\x0D], with A-Z in lower case, as a set. A line
    goes if its set has a Jaccard similarity of at least ``similarity`` with that of an earlier line: one of a document of a smaller id,
    or an earlier one of its own. Lines are judged on the input. Lines without words stay. Kept lines are joined by line feeds.

    Null counts as empty, which is one line without words. A null id comes before all others. Rows that share an id are ordered by
    a hash of their text; rows equal in id and text are one document that gives equal rows. Other columns are not looked at. An empty
    table gives an empty result. Starts jobs.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    mine = docs.select(F.col(id_column).cast("long").alias("id"), F.xxhash64(text).alias("mark"), text.alias("_text"))
    rank, words = rarity(mine, "_text")
    # A bucket holds some 100,000 lines, or 500,000 entries.
    sets, lists = max(2, common.power_of_two(words / (4 << 20))), common.power_of_two(words / (2 << 20))
    deal = common.ordered_chunk(mine, "id", RANKS)
    lines = line_rows(mine.withColumn("rank", deal(F.col("id"))), rank, similarity, sets)
    classes = stored(lines.groupBy("bucket").applyInArrow(common.on_group(_classes), PACKED), "lines-classes")
    long = long_lists(classes, slice_size)

    def entries(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.batches(parts, 1):
            yield from _entries(pa.Table.from_batches([part]), None, None, lists, long).to_batches()

    firsts = classes.filter(F.col("kind") == FIRST).select("lines", "words")
    found = stored(_pairs(firsts.mapInArrow(entries, ENTRIES), similarity, FEW).distinct(), "lines-pairs")
    pairs = found.filter("line <> other")

    def places(some: DataFrame) -> DataFrame:
        digests = some.select(F.explode(F.array("line", "other")).alias("digest")).distinct()
        return stored(_met(classes, digests, sets, _places, PLACES), "lines-wanted")

    wanted = places(pairs)
    near = stored(_verified(pairs, wanted, mine, rank, similarity), "lines-near")
    removed = wanted.join(near, "digest", "left_semi").select(*_PLACE)
    # Lines whose candidates all failed and that have others are compared with every candidate.
    again = stored(found.filter("line = other").select(F.col("line").alias("digest")).join(near, "digest", "left_anti"), "lines-open")
    if not again.isEmpty():
        bins = np.zeros(1 << LIST_BITS, bool)
        bins[[r["bin"] for r in _met(classes, again, sets, _asked_bins, "bin int").distinct().collect()]] = True
        listed = _met(classes, again, sets, _asked_entries, ENTRIES, bins=bins, buckets=lists, long=long)
        second = stored(_pairs(listed, similarity, None).distinct().join(pairs, ["line", "other"], "left_anti"), "lines-pairs")
        wanted = places(second)
        near = _verified(second, wanted, mine, rank, similarity)
        removed = removed.union(wanted.join(near, "digest", "left_semi").select(*_PLACE))

    def repeated(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.batches(parts, 16):
            yield from _as_rows(np.frombuffer(b"".join(part.column(0).to_pylist()), LINE)).to_batches()

    repeats = classes.filter(F.col("kind") == REPEAT).select("lines").mapInArrow(repeated, PLACES).select(*_PLACE)
    gone = stored(repeats.union(removed).groupBy("id", "mark").agg(F.collect_set("line").alias("gone")), "lines-gone")

    def clean(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.batches(parts):
            rows = []
            for i, t, drop in zip(part.column(0).to_pylist(), common.octets(part.column(1)), part.column(2).to_pylist()):
                all_lines = t.split(b"\n")
                drop = set(drop or ())
                rows.append((i, len(all_lines), len(drop), b"\n".join(x for k, x in enumerate(all_lines) if k not in drop) if drop else t))
            arrays = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate([pa.int64(), pa.int64(), pa.int64(), pa.binary()])]
            yield pa.record_batch([*arrays[:3], arrays[3].cast(pa.string())], names=[c.split()[0] for c in OUT.split(", ")])

    return _meet(mine, gone).select("id", "_text", "gone").mapInArrow(clean, OUT).withColumnRenamed("_id", id_column)
