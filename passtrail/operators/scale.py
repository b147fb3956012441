"""Operators over ordered rows that stay balanced when one key owns a large part of the data.

A window partitioned by the key alone sends every row of a hot key to one task. The functions here cut each key's order
axis into bounded blocks, so that a window never holds more than one block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from passtrail.operators.stores import shared_folder

BROADCAST_BYTES = 64 * 1024 * 1024


def settle(rows: DataFrame) -> DataFrame:
    """Store narrow rows that were derived from texts and are used more than once, so that the texts are read once.

    The rows go to the shared folder and survive a lost executor; a cluster must name one. Starts a job.
    """
    shared_folder(rows.sparkSession)
    return rows.checkpoint()


def running_total_before(
    rows: DataFrame, keys: Sequence[str], order: str, value: str, out: str, width: int = 4096, levels: int = 2
) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all rows of the same keys that come earlier by the integer ``order``.

    Block sums are added up first, each level being ``width`` times smaller than the one below it, and each row adds the
    rows before it in its own block.
    """
    keys = list(keys)
    if levels == 0:
        before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return rows.withColumn(out, F.coalesce(F.sum(value).over(before), F.lit(0)))
    block, offset = f"_block{levels}", f"_offset{levels}"
    blocked = rows.withColumn(block, F.floor(F.col(order) / width).cast("long"))
    totals = blocked.groupBy(*keys, block).agg(F.sum(value).alias("_total"))
    offsets = running_total_before(totals, keys, block, "_total", offset, width, levels - 1)
    inside = Window.partitionBy(*keys, block).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        blocked.join(offsets.select(*keys, block, offset), [*keys, block])
        .withColumn(out, F.col(offset) + F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .drop(block, offset)
    )


def running_max_before(
    rows: DataFrame, keys: Sequence[str], order: str, value: str, out: str, width: int = 4096, levels: int = 2
) -> DataFrame:
    """Add ``out``: the largest ``value`` of all rows of the same keys that come earlier by the integer ``order``, or null.

    As with ``running_total_before``, maxima of blocks come first, so that no window holds more than a block.
    """
    keys = list(keys)
    if levels == 0:
        before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return rows.withColumn(out, F.max(value).over(before))
    block, offset = f"_block{levels}", f"_offset{levels}"
    blocked = rows.withColumn(block, F.floor(F.col(order) / width).cast("long"))
    maxima = blocked.groupBy(*keys, block).agg(F.max(value).alias("_max"))
    offsets = running_max_before(maxima, keys, block, "_max", offset, width, levels - 1)
    inside = Window.partitionBy(*keys, block).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        blocked.join(offsets.select(*keys, block, offset), [*keys, block])
        .withColumn(out, F.greatest(F.col(offset), F.max(value).over(inside)))
        .drop(block, offset)
    )


def previous_by_index(
    rows: DataFrame, keys: Sequence[str], index: str, value: str, out: str, width: int = 65_536
) -> DataFrame:
    """Add ``out``: ``value`` of the row whose dense ``index`` is one smaller, or null.

    The last row of each block is also sent to the next block, where it is only looked at; that costs one row in
    ``width`` and leaves a single shuffle on (keys, block).
    """
    block = F.floor(F.col(index) / width).cast("long")
    own = F.struct(block.alias("block"), F.lit(False).alias("guest"))
    onward = F.struct((block + 1).alias("block"), F.lit(True).alias("guest"))
    placed = rows.withColumn(
        "_at", F.explode(F.when((F.col(index) + 1) % width == 0, F.array(own, onward)).otherwise(F.array(own)))
    )
    neighbours = Window.partitionBy(*keys, F.col("_at.block")).orderBy(index)
    return placed.withColumn(out, F.lag(value).over(neighbours)).filter(~F.col("_at.guest")).drop("_at")


def keep_by_key(wide: DataFrame, keys: DataFrame, on: str | list[str], limit_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Join wide rows (whole texts) to the selected key rows without shuffling the wide side while that is safe.

    The key side is measured first. Up to ``limit_bytes`` it is broadcast, so texts that were not selected are dropped
    where they were read. Beyond that hashes of its keys are broadcast, if they are within the limit, to drop the others there, and
    the join shuffles what is left on ``on``, which is meant to be unique on both sides.
    """
    if fits_broadcast(keys, limit_bytes):
        return wide.join(F.broadcast(keys), on)
    names = [on] if isinstance(on, str) else list(on)
    mark = F.xxhash64(*names).alias("_mark")
    marks = keys.select(mark)
    # Equal values of different types have different hashes.
    if all(wide.schema[c].dataType == keys.schema[c].dataType for c in names) and fits_broadcast(marks, limit_bytes):
        wide = wide.select("*", mark).join(F.broadcast(marks), "_mark", "left_semi").drop("_mark")
    return wide.join(keys, on)


def left_join_unique(
    rows: DataFrame, unique: DataFrame, on: Sequence[str], hot_rows: int = 1_000_000, salts: int = 1024
) -> DataFrame:
    """Left join to a side with at most one row per key, where one key may own a large part of ``rows``.

    The adaptive skew join does not split a key when the other side is an aggregate, so it is done here. Keys with more than
    ``hot_rows`` rows are counted first; there are at most rows / hot_rows of them, and the limit is raised until they fit a
    broadcast. Their rows are dealt out over salts and their partners repeated per salt. Rows with a null key match nothing
    and are dealt out as well. The salt is a hash of the row, so that a repeated task deals alike.
    """
    on = list(on)
    counted = settle(rows.groupBy(*on).agg(F.count("*").alias("_n")).filter(F.col("_n") > hot_rows))
    if counted.isEmpty():
        return rows.join(unique, on, "left")
    hot = counted.dropna(subset=on)
    while not fits_broadcast(hot):
        hot_rows *= 10
        hot = hot.filter(F.col("_n") > hot_rows)
    shares = hot.select(*on, F.least(F.ceil(F.col("_n") / hot_rows), F.lit(salts)).cast("int").alias("_shares"))
    shares = F.broadcast(shares)
    dealt = F.pmod(F.xxhash64(*rows.columns), F.coalesce("_shares", F.lit(1)))
    no_key = F.array_contains(F.array(*[F.col(c).isNull() for c in on]), True)
    left = rows.join(shares, on, "left").withColumn(
        "_salt", F.when(no_key, F.pmod(F.xxhash64(*rows.columns), F.lit(salts))).otherwise(dealt).cast("int")
    )
    copies = F.sequence(F.lit(0), F.coalesce("_shares", F.lit(1)) - 1)
    right = unique.join(shares, on, "left").withColumn("_salt", F.explode(copies)).drop("_shares")
    return left.drop("_shares").join(right, [*on, "_salt"], "left").drop("_salt")


def fits_broadcast(rows: DataFrame, limit_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure narrow rows: bytes of strings and binaries, those of nested columns as JSON, plus sixteen bytes per column.

    Starts a job.
    """
    wide = [F.col(c) for c, t in rows.dtypes if t in ("string", "binary")]
    nested = [F.to_json(F.struct(c)) for c, t in rows.dtypes if "<" in t]
    text = [F.coalesce(F.octet_length(c), F.lit(0)) for c in [*wide, *nested]]
    size = sum(text, F.lit(16 * len(rows.columns))).cast("long")
    measured = rows.agg(F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
    return measured["bytes"] <= limit_bytes
