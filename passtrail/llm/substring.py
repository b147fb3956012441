"""Substring deduplication by fixed-block anchors.

Reference blocks are the non-overlapping runs of ``window // 2`` words of each document; every rolling window of that length
probes the block index. A repeated window of ``window`` words holds a whole block, wherever the blocks of the other copy lie,
so no repeat is missed. Around hits all full windows are looked up among those of earlier documents, and runs of confirmed
windows are the maximal exact repeats.

Documents are dealt into chunks that follow their ids. A chunk sends its distinct hashes packed by hash range, so that a passage
that a third of the documents share is one hash per chunk; it gets back those that occur elsewhere. Chunks are ordered, so
"starts earlier" is "in a chunk of a smaller number, or earlier in this chunk", and no positions travel.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passtrail.llm import common
from passtrail.llm.common import KEY, INDEX, MORE, MESSAGES, Replies

SPANS = "array<struct<start:bigint,length:bigint>>"
OUT = f"n_words bigint, n_removed bigint, spans {SPANS}, kept_text string"
_ROLL = 0xD6E8FEB86659FD93


class Chunk:
    """A chunk's documents in order, as one array of word hashes.

    Rows of the same id are ordered by text; rows that are equal in both are one document.
    """

    def __init__(self, table: pa.Table):
        ids, texts = table["_id"].to_pylist(), common.octets(table["_text"])
        self.rows = [((i is not None, i or 0), t) for i, t in zip(ids, texts)]
        self.docs = sorted(set(self.rows))
        self.units, owner = common.words_of([t for _, t in self.docs], lower=False)
        sizes = np.bincount(owner, minlength=len(self.docs))
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        total = int(self.starts[-1])
        place = np.repeat(self.starts[:-1], sizes)
        self.offset = np.arange(total) - place
        self.left = np.repeat(self.starts[1:], sizes) - np.arange(total)

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The hash of each window that lies in one document, and where it starts."""
        keys = common.rolled(self.units, width, _ROLL)
        at = np.flatnonzero(self.left[: len(keys)] >= width)
        return keys[at], at


def _anchors(table: pa.Table, width: int, buckets: int) -> pa.Table:
    chunk = Chunk(table)
    keys, at = chunk.windows(width)
    once, more = common.once_and_more(keys)
    index = keys[chunk.offset[at] % width == 0]
    return common.messages(table["_chunk"][0].as_py(), {KEY: once, MORE: more, INDEX: index}, buckets, True)


def _extended(key: tuple, table: pa.Table, found: pa.Table, window: int, buckets: int) -> pa.Table:
    """Full windows with a hit inside."""
    if not table.num_rows or not found.num_rows:
        return common.messages(0, {}, buckets, False)
    chunk, width = Chunk(table), window // 2
    keys, at = chunk.windows(width)
    hits = np.zeros(len(chunk.units) + 1, np.int64)
    hits[at[Replies(found, buckets, True).has(keys)] + 1] = 1
    hits = np.cumsum(hits)
    keys, at = chunk.windows(window)
    near = hits[at + window - width + 1] > hits[at]
    return common.messages(key[0].as_py(), {KEY: np.unique(keys[near])}, buckets, False)


def _cut(key: tuple, table: pa.Table, earlier: pa.Table, window: int, buckets: int) -> pa.Table:
    chunk = Chunk(table)
    keys, at = chunk.windows(window)
    gone = Replies(earlier, buckets, False).has(keys)
    again = np.ones(len(keys), bool)
    again[np.unique(keys, return_index=True)[1]] = False
    starts = at[gone | again]
    edge = np.zeros(len(chunk.units) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    covered = np.cumsum(edge[:-1]) > 0
    results = {}
    for doc, a, b in zip(chunk.docs, chunk.starts[:-1].tolist(), chunk.starts[1:].tolist()):
        words = doc[1].split()
        mask = covered[a:b]
        removed = int(mask.sum())
        turns = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8))).reshape(-1, 2) if removed else ()
        spans = [{"start": int(s), "length": int(e - s)} for s, e in turns]
        results[doc] = (b - a, removed, spans, b" ".join(compress(words, ~mask) if removed else words))
    columns = list(zip(*(results[row] for row in chunk.rows))) or [()] * 4
    types = [pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())])), pa.binary()]
    arrays = [pa.array(c, t) for c, t in zip(columns, types)]
    arrays[3] = arrays[3].cast(pa.string())
    names = ["n_words", "n_removed", "spans", "kept_text"]
    return pa.table([*table.drop_columns("_chunk").columns, *arrays], names=[*table.drop_columns("_chunk").column_names, *names])


def repeated_words(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = 20, chunk_bytes: int = common.CHUNK_BYTES
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_words``, ``n_removed``, ``spans`` of removed words, ``kept_text``.

    Words are runs of characters outside [\\x20\\x09-\\x0D]. A word goes if a window of ``window`` consecutive words that covers
    it also starts earlier: in a document of a smaller id, or earlier in its own. Windows are judged on the input. Kept words
    are joined by one space.

    Null and empty texts have no words. Documents shorter than a window keep everything. A null id comes before all others.
    Rows that share an id are ordered by their text; rows equal in id and text are one document that gives equal rows. Other
    columns are not looked at. An empty table gives an empty result. A text is held whole in one task.
    """
    cut = _cut_rows(docs, id_column, text_column, window, chunk_bytes, ())
    return cut.drop("_text").withColumnRenamed("_id", id_column)


def _cut_rows(docs: DataFrame, id_column: str, text_column: str, window: int, chunk_bytes: int, carried: tuple) -> DataFrame:
    if window < 2:
        raise ValueError("a window has two words at least")
    row = [F.struct(*[common.column(c) for c in carried]).alias("_row")] if carried else []
    mine = docs.select(F.col(id_column).cast("long").alias("_id"), F.col(text_column).alias("_text"), *row)
    _, size = common.volume(mine, "_text")
    chunks = max(1, -(-size // chunk_bytes))
    buckets = common.power_of_two(size / (2 * chunk_bytes))
    deal = common.ordered_chunk(mine, "_id", chunks)
    dealt = mine.withColumn("_chunk", deal(F.col("_id")))
    by_chunk = dealt.groupBy("_chunk")
    anchors = by_chunk.applyInArrow(common.on_group(_anchors, width=window // 2, buckets=buckets), MESSAGES)
    hits = common.found_twice(anchors, narrow=True, indexed=True)
    extend = common.on_pair(_extended, window=window, buckets=buckets)
    full = by_chunk.cogroup(hits.groupBy("chunk")).applyInArrow(extend, MESSAGES)
    earlier = common.found_before(full)
    out = T.StructType([*mine.schema.fields, *T.StructType.fromDDL(OUT).fields])
    return by_chunk.cogroup(earlier.groupBy("chunk")).applyInArrow(common.on_pair(_cut, window=window, buckets=buckets), out)


def without_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length_column: str = "n_chars", window: int = 20,
    chunk_bytes: int = common.CHUNK_BYTES,
) -> DataFrame:
    """``docs`` with the repeated words of each text removed; all rows and columns stay.

    A text without repeats stays as it is, white space and null included. Where a text changed, the length column, if there is
    one, is set anew.
    """
    carried = tuple(c for c in docs.columns if c != text_column)
    cut = _cut_rows(docs, id_column, text_column, window, chunk_bytes, carried)
    changed = F.col("n_removed") > 0
    text = F.when(changed, F.col("kept_text")).otherwise(F.col("_text"))
    columns = {c: F.col("_row").getField(c) for c in carried} | {text_column: text}
    if length_column in carried:
        kind = docs.schema[length_column].dataType
        columns[length_column] = F.when(changed, F.length("kept_text").cast(kind)).otherwise(columns[length_column])
    return cut.select(*[columns[c].alias(c) for c in docs.columns])
