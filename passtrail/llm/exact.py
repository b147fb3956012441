"""Exact deduplication by distributed MSD radix partitioning.

Texts without their white space are split by successive bytes, most significant first: a round takes the next bytes of every
document whose group still has several members and splits each group by them. A group is done when it has one member, or when
its texts have ended, which makes them equal byte for byte; no digest decides. Rounds take 32 bytes first and four times as many
each time, so that their number is the logarithm of the longest text. Only documents that still share all their bytes with another
one are moved, and only by the bytes of the round. Group facts are aggregated over salts, so a group of copies that holds a third
of all rows is not gathered anywhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passtrail.llm import common
from passtrail.operators.scale import fits_broadcast
from passtrail.operators.stores import stored

FIRST_BYTES, GROWTH = 32, 4
_SPACE = b"\t\n\x0b\x0c\r "
_PREPARED = "uid bigint, id bigint, mark bigint, n_chars bigint, n_bytes bigint, text_sha256 string, bytes binary"


def _prepared(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    uid = TaskContext.get().partitionId() << 40
    for part in common.batches(parts):
        ids, marks, lengths, texts = part.columns
        plain = [t.translate(None, _SPACE) for t in common.octets(texts)]
        yield pa.record_batch(
            [
                pa.array(range(uid, uid + len(plain)), pa.int64()), ids, marks, lengths, pa.array(map(len, plain), pa.int64()),
                pa.array([hashlib.sha256(t).hexdigest() for t in plain]), pa.array(plain, pa.binary()),
            ],
            names=[c.split()[0] for c in _PREPARED.split(", ")],
        )
        uid += len(plain)


def copy_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` and ``mark``, a hash of the whole text.

    Texts are equal if they are identical without the characters [\\x20\\x09-\\x0D]; null counts as empty, and all empty texts are one
    group. The row with the most code points in its original text stays, of those the one with the smallest id; a null id comes
    last. Of rows that are equal in id and length too, one stays. ``text_sha256`` is of the text without white space. Other columns are
    not looked at. An empty table gives an empty result. Starts one job per round.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    mine = docs.select(
        F.col(id_column).cast("long").alias("id"), F.xxhash64(text).alias("mark"), F.length(text).cast("long").alias("n"), text.alias("t")
    )
    prepared = stored(mine.mapInArrow(_prepared, _PREPARED), "radix")
    classes = _classes(prepared)
    narrow = prepared.drop("bytes", "n_bytes")
    best = F.struct("n_chars", F.bitwise_not("id").alias("nid"), F.bitwise_not("uid").alias("nuid"))
    members = classes.join(narrow.select("uid", "id", "n_chars"), "uid")
    facts = {"_best": (lambda: F.max(best), F.max), "_n": (lambda: F.count(F.lit(1)), F.sum)}
    chosen = common.share_in_groups(members, ["gid"], facts, F.col("uid")).select(
        "uid", F.bitwise_not("_best.nid").alias("keep_id"), F.col("_n").alias("group_size"),
        (F.bitwise_not("_best.nuid") == F.col("uid")).alias("kept"),
    )
    alone = F.col("kept").isNull()
    return narrow.join(chosen, "uid", "left").select(
        F.col("id").alias(id_column), F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), F.coalesce("kept", F.lit(True)).alias("kept"),
        "text_sha256", "mark",
    )


def _classes(prepared: DataFrame) -> DataFrame:
    """(uid, gid) of all rows that have an equal; ``gid`` is the smallest uid among them."""
    done, active, at, width = [], None, 0, FIRST_BYTES
    while True:
        digit = F.substring("bytes", at + 1, width)
        rows = prepared.filter(F.col("n_bytes") >= at).select("uid", digit.alias("digit"), (F.col("n_bytes") <= at + width).alias("ended"))
        rows = rows.withColumn("gid", F.lit(0).cast("long")) if active is None else rows.join(active, "uid")
        facts = {"_first": (lambda: F.min("uid"), F.min), "_n": (lambda: F.count(F.lit(1)), F.sum)}
        split = common.share_in_groups(rows, ["gid", "digit", "ended"], facts, F.col("uid"))
        split = stored(split.filter("_n > 1").select("uid", F.col("_first").alias("gid"), "ended"), "radix-split")
        done.append(split.filter("ended").select("uid", "gid"))
        active = split.filter("not ended").select("uid", "gid")
        if active.isEmpty():
            break
        at, width = at + width, width * GROWTH
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out


def without_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows are found again by id and a hash of the whole text. Where rows are equal in both, one of them stays if one is to stay.
    """
    groups = copy_groups(docs, id_column, text_column).filter("group_size > 1")
    key = [F.col(id_column).cast("long").alias("_i"), "mark"]
    verdicts = stored(groups.groupBy(*key).agg(F.max("kept").alias("_stays"), F.count(F.lit(1)).alias("_rows")), "radix-verdicts")
    verdicts = verdicts.filter("not _stays or _rows > 1").withColumnRenamed("mark", "_m")
    side = F.broadcast(verdicts) if fits_broadcast(verdicts) else verdicts
    marked = docs.select(
        F.struct("*").alias("_row"), F.col(id_column).cast("long").alias("_key"),
        F.xxhash64(F.coalesce(F.col(text_column), F.lit(""))).alias("_mark"),
    )
    judged = marked.join(side, F.col("_key").eqNullSafe(F.col("_i")) & (F.col("_mark") == F.col("_m")), "left")
    clean = judged.filter("_stays is null").select("_row.*")
    single = judged.filter("_stays").dropDuplicates(["_key", "_mark"]).select("_row.*")
    return clean.union(single)
