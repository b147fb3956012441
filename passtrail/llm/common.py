"""Parts that several operators share: volumes, chunks, packed key exchange, facts of hot groups, connected components."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passtrail.operators.scan import give_back, small_batches  # noqa: F401
from passtrail.operators.stores import stored

#: What Python and Spark call white space in ASCII: the characters [\x20\x09-\x0D].
CHUNK_BYTES = 8 << 20
MESSAGES = "bucket int, chunk long, kind int, keys binary"


def column(name: str) -> Column:
    """The column of exactly that name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def volume(docs: DataFrame, text: str) -> tuple[int, int]:
    """Rows and UTF-8 bytes of a text column, from one scan."""
    row = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.col(text))).alias("b")).first()
    return row["n"], row["b"] or 0


def power_of_two(wanted: float) -> int:
    return 1 << max(0, int(np.ceil(np.log2(max(1.0, wanted)))))


def ordered_chunk(docs: DataFrame, key: str, chunks: int) -> Callable[[Column], Column]:
    """A column function from an integer key to a chunk number that never falls as the key grows; null keys are in chunk 0.

    1,024 quantiles of the key give a piecewise linear rank, so that any number of chunks comes out about equal in rows. The
    function depends on the key alone: every stage that computes it, and every repeated task, gets the same chunk.
    """
    steps = 1024
    ranks = [i / steps for i in range(steps + 1)]
    found = docs.agg(F.percentile_approx(F.col(key).cast("long"), ranks, 20_000).alias("q")).first()["q"] or [0]
    at = np.array(found, dtype=np.float64)
    up = np.linspace(0, 1, len(at)) if len(at) > 1 else np.zeros(1)
    at, last = np.unique(at, return_index=True)
    up = up[last]

    @F.pandas_udf("long")
    def chunk(keys: pd.Series) -> pd.Series:
        rank = np.interp(keys.fillna(-np.inf).to_numpy(dtype=np.float64), at, up)
        return pd.Series(np.minimum((rank * chunks).astype(np.int64), chunks - 1))

    return lambda column: chunk(column.cast("long"))


def placed_chunk(docs: DataFrame, key: str, mark: str, chunks: int) -> Callable[[Column, Column], Column]:
    """As ``ordered_chunk``, for rows that are ordered by an integer key, null first, and then by a 64-bit ``mark``.

    A key with many rows, null included, takes as many chunks as its rows do, and the mark says which: the marks of equal
    keys have to be hashes.
    """
    steps = 1024
    ranks = [i / steps for i in range(steps + 1)]
    number = F.col(key).cast("long")
    row = docs.agg(F.percentile_approx(number, ranks, 20_000).alias("q"), F.count(number).alias("named"), F.count(F.lit(1)).alias("all")).first()
    at = np.array(row["q"] or [0], dtype=np.float64)
    up = np.linspace(0, 1, len(at)) if len(at) > 1 else np.zeros(1)
    keys, first = np.unique(at, return_index=True)
    last = len(at) - 1 - np.unique(at[::-1], return_index=True)[1]
    unnamed = 1 - row["named"] / row["all"] if row["all"] else 0.0

    @F.pandas_udf("long")
    def chunk(numbers: pd.Series, marks: pd.Series) -> pd.Series:
        values = numbers.to_numpy(dtype=np.float64, na_value=np.nan)
        inside = (marks.to_numpy(dtype=np.float64) + 2.0**63) / 2.0**64
        below = np.clip(np.searchsorted(keys, values, side="right") - 1, 0, len(keys) - 1)
        above = np.minimum(below + 1, len(keys) - 1)
        # A key that is a quantile has the ranks from its first to its last one, and a key between two has one between theirs.
        begin, end = np.where(keys[below] == values, up[first][below], up[last][below]), np.where(keys[below] == values, up[last][below], up[first][above])
        end = np.maximum(begin, end)
        gap = np.where(keys[above] > keys[below], keys[above] - keys[below], 1.0)
        share = np.where(keys[below] == values, inside, np.clip((values - keys[below]) / gap, 0, 1))
        rank = np.where(values < keys[0], 0.0, begin + (end - begin) * share)
        rank = np.where(np.isnan(values), unnamed * inside, unnamed + (1 - unnamed) * rank)
        return pd.Series(np.minimum((rank * chunks).astype(np.int64), chunks - 1))

    return lambda numbers, marks: chunk(numbers.cast("long"), marks)


# ------------------------------------------------------------------------------------------------- word and window hashes

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits; a bijection."""
    x = values ^ (values >> np.uint64(30))
    x = x * _MIX1
    x ^= x >> np.uint64(27)
    x *= _MIX2
    return x ^ (x >> np.uint64(31))


class Memo(dict):
    """A function's results by argument, in two generations: when the young one is full it becomes the old one, and what is asked
    for again comes back. So memory is bounded, and frequent arguments stay. Long arguments are not kept.
    """

    def __init__(self, function: Callable, most: int = 400_000):
        super().__init__()
        self.function, self.half, self.old = function, most // 2, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.function(key)
            if isinstance(key, (str, bytes)) and len(key) > 64:
                return value
        if len(self) >= self.half:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def rolled(units: np.ndarray, width: int, multiplier: int) -> np.ndarray:
    """A 64-bit value for each run of ``width`` consecutive units: a polynomial in an odd multiplier, doubled up and mixed."""
    if len(units) < width:
        return np.zeros(0, np.uint64)
    done, out, power, size, step = 0, None, multiplier, 1, units
    while True:
        if width & size:
            tail = step[done : done + len(units) - width + 1]
            # The part that is there is followed by this one.
            out = tail if out is None else out[: len(tail)] * np.uint64(power) + tail
            done += size
        if done == width:
            return mixed(out)
        step = step[: len(step) - size] * np.uint64(power) + step[size:]
        power, size = power * power % 2**64, size * 2


_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_CASED = np.random.default_rng(23).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_UNCASED = _CASED[_LOWER]
_IN_WORD = np.array([not (b == 0x20 or 0x09 <= b <= 0x0D) for b in range(256)])
_STEP = 0xE7037ED1A0B428DB


@functools.lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse."""
    up, down = np.full(size, _STEP, np.uint64), np.full(size, pow(_STEP, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def words_of(texts: list[bytes], lower: bool = True, block: int = 1 << 19) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z in lower case if so asked, and the number of the text of each; without a Python object for any word.

    A word's hash is a polynomial of its bytes, taken from running sums over a block of texts.
    """
    hashes, owners, at, values = [], [], 0, _UNCASED if lower else _CASED
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and (size == 0 or size + len(texts[stop]) < block):
            size += len(texts[stop]) + 1
            stop += 1
        data = np.frombuffer(b" ".join(texts[at:stop]) + b" ", np.uint8)
        up, down = _powers(power_of_two(max(block, len(data)) + 1))
        inside = _IN_WORD[data]
        turns = np.flatnonzero(np.diff(inside, prepend=False))
        starts, ends = turns[::2], turns[1::2]
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[data] * up[: len(data)], out=sums[1:])
        hashes.append(mixed((sums[ends] - sums[starts]) * down[starts]))
        limits = np.cumsum([len(t) + 1 for t in texts[at:stop]])
        owners.append(at + np.searchsorted(limits, starts, side="right"))
        at = stop
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(owners)


# ------------------------------------------------------------------------------------------------------ packed key exchange


def messages(chunk: int, kinds: dict[int, np.ndarray], buckets: int, narrow: bool) -> pa.Table:
    """One row per (bucket, kind) with a chunk's distinct keys, sorted and packed.

    A bucket is the key's top bits after another mix. Narrow keys keep 32 bits beside the bucket, which is for filters whose
    survivors are looked at again; others keep all 64.
    """
    out: dict[str, list] = {"bucket": [], "chunk": [], "kind": [], "keys": []}
    for kind, keys in kinds.items():
        if not len(keys):
            continue
        bucket, kept = split_key(keys, buckets, narrow)
        order = np.lexsort((kept, bucket)) if buckets > 1 else np.argsort(kept)
        bucket, kept = bucket[order], kept[order]
        fresh = np.ones(len(kept), bool)
        fresh[1:] = (kept[1:] != kept[:-1]) | (bucket[1:] != bucket[:-1])
        bucket, kept = bucket[fresh], kept[fresh]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]]).tolist()
        for a, b in zip(cuts[:-1], cuts[1:]):
            out["bucket"].append(int(bucket[a]))
            out["chunk"].append(chunk)
            out["kind"].append(kind)
            out["keys"].append(kept[a:b].tobytes())
    return pa.table(
        {"bucket": pa.array(out["bucket"], pa.int32()), "chunk": pa.array(out["chunk"], pa.int64()),
         "kind": pa.array(out["kind"], pa.int32()), "keys": pa.array(out["keys"], pa.binary())}
    )


def split_key(keys: np.ndarray, buckets: int, narrow: bool) -> tuple[np.ndarray, np.ndarray]:
    if buckets > 1:
        bucket = (mixed(keys * _ODD) >> np.uint64(64 - int(buckets).bit_length() + 1)).astype(np.int32)
    else:
        bucket = np.zeros(len(keys), np.int32)
    return bucket, keys.astype(np.uint32) if narrow else keys


def once_and_more(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of a chunk, and those that it has several times."""
    ordered = np.sort(keys)
    first = np.ones(len(ordered), bool)
    first[1:] = ordered[1:] != ordered[:-1]
    return ordered[first], np.unique(ordered[~first])


#: Kinds of messages: the keys of a chunk, those that it has more than once, and those that are in the index.
KEY, MORE, INDEX = 0, 1, 2


def _blobs(table: pa.Table, kind: int, dtype) -> tuple[np.ndarray, np.ndarray]:
    """All keys of a kind, and the row that each comes from."""
    rows = [i for i, k in enumerate(table["kind"].to_pylist()) if k == kind]
    blobs = table["keys"].take(pa.array(rows, pa.int64())).to_pylist()
    sizes = [len(b) // np.dtype(dtype).itemsize for b in blobs]
    return np.frombuffer(b"".join(blobs), dtype), np.repeat(np.array(rows, np.int64), sizes)


def _reply(table: pa.Table, keys: np.ndarray, rows: np.ndarray) -> pa.Table:
    """The keys that count, to the chunk that each came from."""
    order = np.argsort(rows, kind="stable")
    keys, rows = keys[order], rows[order]
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(rows)) + 1, [len(rows)]]).tolist() if len(rows) else [0]
    took = pa.array([int(rows[a]) for a in cuts[:-1]], pa.int64())
    return pa.table(
        {"bucket": table["bucket"].take(took).combine_chunks(), "chunk": table["chunk"].take(took).combine_chunks(),
         "kind": pa.array([KEY] * len(took), pa.int32()),
         "keys": pa.array([keys[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())}
    )


def _found_twice(table: pa.Table, narrow: bool, indexed: bool) -> pa.Table:
    dtype = np.uint32 if narrow else np.uint64
    keys, rows = _blobs(table, KEY, dtype)
    more = np.unique(_blobs(table, MORE, dtype)[0])
    distinct, counts = np.unique(keys, return_counts=True)
    wanted = distinct[(counts > 1) | np.isin(distinct, more)]
    if indexed:
        wanted = np.intersect1d(wanted, _blobs(table, INDEX, dtype)[0])
    hit = np.isin(keys, wanted)
    return _reply(table, keys[hit], rows[hit])


def _found_before(table: pa.Table, narrow: bool) -> pa.Table:
    keys, rows = _blobs(table, KEY, np.uint32 if narrow else np.uint64)
    chunks = table["chunk"].to_numpy()[rows]
    order = np.lexsort((chunks, keys))
    later = np.zeros(len(keys), bool)
    later[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    return _reply(table, keys[later], rows[later])


def on_group(function: Callable, **settings) -> Callable:
    """A function of one group's table, with its settings; Spark does not take a partial."""
    def of(table):
        try:
            return function(table, **settings)
        finally:
            give_back()

    return of


def on_pair(function: Callable, **settings) -> Callable:
    """The same for the two tables of a key."""
    def of(key, left, right):
        try:
            return function(key, left, right, **settings)
        finally:
            give_back()

    return of


def found_twice(sent: DataFrame, narrow: bool, indexed: bool = False) -> DataFrame:
    """Replies to chunks: their keys that occur twice at least over all chunks (and, if so asked, are in the index)."""
    return sent.groupBy("bucket").applyInArrow(on_group(_found_twice, narrow=narrow, indexed=indexed), MESSAGES)


def _found_indexed(table: pa.Table, narrow: bool) -> pa.Table:
    dtype = np.uint32 if narrow else np.uint64
    keys, rows = _blobs(table, KEY, dtype)
    hit = np.isin(keys, _blobs(table, INDEX, dtype)[0])
    return _reply(table, keys[hit], rows[hit])


def found_indexed(sent: DataFrame, narrow: bool) -> DataFrame:
    """Replies to chunks: their keys that are in the index of any chunk."""
    return sent.groupBy("bucket").applyInArrow(on_group(_found_indexed, narrow=narrow), MESSAGES)


def found_before(sent: DataFrame, narrow: bool = False) -> DataFrame:
    """Replies to chunks: their keys that a chunk of a smaller number has too."""
    return sent.groupBy("bucket").applyInArrow(on_group(_found_before, narrow=narrow), MESSAGES)


class Replies:
    """A chunk's replies, to be asked about keys."""

    def __init__(self, table: pa.Table, buckets: int, narrow: bool):
        self.buckets, self.narrow = buckets, narrow
        blobs = table["keys"].to_pylist()
        keys = np.frombuffer(b"".join(blobs), np.uint32 if narrow else np.uint64)
        if narrow:
            sizes = [len(b) // 4 for b in blobs]
            bucket = np.repeat(np.array(table["bucket"].to_pylist(), np.uint64), sizes)
            keys = (bucket << np.uint64(32)) | keys.astype(np.uint64)
        self.keys = np.sort(keys)

    def __contains__(self, keys):
        raise TypeError("use has()")

    def has(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), bool)
        if self.narrow:
            bucket, kept = split_key(keys, self.buckets, True)
            keys = (bucket.astype(np.uint64) << np.uint64(32)) | kept.astype(np.uint64)
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        return self.keys[at] == keys


# ------------------------------------------------------------------------------------------------------- facts of groups


def share_in_groups(
    rows: DataFrame, keys: Sequence[str], facts: dict[str, tuple[Callable, Callable]], spread_by: Column, salts: int = 64
) -> DataFrame:
    """Add to each row facts of its group (aggregates over ``keys``), with no task that holds a whole group.

    ``facts``: name -> (aggregate of the rows, aggregate of the partial values under that name). A group is dealt over salts,
    aggregated by (keys, salt), then by keys; the result goes back to the at most ``salts`` rows per key and from there to the
    rows. Keys that are null are a group of their own.
    """
    keys = list(keys)
    salted = [*keys, "_salt"]
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    parts = dealt.groupBy(*salted).agg(*[f().alias(n) for n, (f, _) in facts.items()])
    whole = parts.groupBy(*keys).agg(*[g(n).alias(n) for n, (_, g) in facts.items()])
    back = null_safe_join(parts.select(*salted), whole, keys)
    return null_safe_join(dealt, back, salted).drop("_salt")


def tell_groups(rows: DataFrame, keys: Sequence[str], whole: DataFrame, spread_by: Column, salts: int = 64) -> DataFrame:
    """Join rows to facts that are there once per key, by way of the distinct (keys, salt), so that no task gets a whole group."""
    keys = list(keys)
    salted = [*keys, "_salt"]
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    back = null_safe_join(dealt.select(*salted).distinct(), whole, keys)
    return null_safe_join(dealt, back, salted).drop("_salt")


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join where null meets null; the columns of ``on`` come from the left side."""
    right = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    same = functools.reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on])
    return left.join(right, same, how).drop(*[f"_r_{c}" for c in on])


def connected(edges: DataFrame) -> DataFrame:
    """Components of a graph: ``edges`` (a, b) of any orientation -> (node, root), root being the component's smallest node.

    Each round takes the smallest label among neighbours and then the label's own label (pointer doubling). A round's labels
    are written to the shared folder, so that lineage stays short. Rounds are logarithmic in the usual case; the loop ends when
    no label changes. Only the number of changes comes to the driver.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("root")), "labels")
    while True:
        seen = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        lower = labels.join(seen, "node").select("node", F.least("root", "near").alias("mid"), F.col("root").alias("was"))
        jump = labels.select(F.col("node").alias("mid"), F.col("root").alias("far"))
        after = lower.join(jump, "mid").select("node", F.least("mid", "far").alias("root"), "was")
        after = stored(after, "labels")
        if after.filter("root <> was").isEmpty():
            return after.select("node", "root")
        labels = after.select("node", "root")


def batches(tables: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, none of them empty, so that few texts are Python objects at a time."""
    for table in tables:
        for at in range(0, table.num_rows, rows):
            yield table.slice(at, rows)
    give_back()


def whole_groups(parts: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
    """Columns of complete groups of rows that come sorted by the first ``keys`` columns, and where each group begins and ends.

    A group may go on in the next batch. Groups of one row are left out of the places.
    """

    def placed(rows: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        fresh = np.zeros(len(rows[0]), bool)
        fresh[:1] = True
        for c in rows[:keys]:
            fresh[1:] |= c[1:] != c[:-1]
        begin = np.flatnonzero(fresh)
        end = np.append(begin[1:], len(fresh))
        return rows, begin[end > begin + 1], end[end > begin + 1]

    held: list[np.ndarray] | None = None
    for part in parts:
        rows = [c.to_numpy(zero_copy_only=False) for c in part.columns]
        if held is not None:
            rows = [np.concatenate(pair) for pair in zip(held, rows)]
        if not len(rows[0]):
            continue
        last = np.ones(len(rows[0]), bool)
        for c in rows[:keys]:
            last &= c == c[-1]
        cut = int(np.argmax(last))  # where the last group begins
        held = [c[cut:].copy() for c in rows]
        if cut:
            yield placed([c[:cut] for c in rows])
    if held is not None:
        yield placed(held)
    give_back()


def octets(column) -> list[bytes]:
    """A string column as UTF-8; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.binary()).fill_null(b"").to_pylist()
