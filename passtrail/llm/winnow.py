"""Document fingerprints by winnowing.

Every run of ``gram`` code points has a hash; of each ``window`` consecutive hashes the smallest is kept, of equal ones the
rightmost, with its position. So any passage of ``gram + window - 1`` code points that two texts share (23 by default) gives them a
common hash, and as positions are kept, a shared hash says where in both texts to look. About two of ``window + 1`` grams are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passtrail.llm import common
from passtrail.operators.scale import fits_broadcast, running_max_before
from passtrail.operators.stores import stored

GRAM, WINDOW = 8, 16
_ROLL = 0xB5026F5AA96619E9
_LOW = np.uint64(0xFFFFFFFF)
PRINTS = T.ArrayType(T.StructType([T.StructField("hash", T.LongType()), T.StructField("position", T.LongType())]))


def chosen(text: str, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (32 bits) and positions of a text's fingerprint, by position.

    A text shorter than a gram is one gram; one with fewer grams than a window is one window. An empty text has none.
    """
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(points):
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    hashes = common.rolled(points.astype(np.uint64) + np.uint64(1), min(gram, len(points)), _ROLL)
    # Below the hash stands how far from the end of all places the gram is: the smallest is the rightmost of equal hashes.
    ranked = (hashes & ~_LOW) | (_LOW - np.arange(len(hashes), dtype=np.uint64))
    window, least, size = min(window, len(ranked)), ranked, 1
    while size * 2 <= window:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < window:  # two windows of a power of two that overlap
        least = np.minimum(least[: len(ranked) - window + 1], least[window - size :])
    fresh = np.ones(len(least), bool)
    fresh[1:] = least[1:] != least[:-1]
    kept = least[fresh]
    return (kept >> np.uint64(32)).astype(np.uint32), (_LOW - (kept & _LOW)).astype(np.int64)


def packed(hashes: np.ndarray) -> str:
    """The hashes of a fingerprint by position, eight hex digits each. Equal texts have equal ones."""
    return hashes.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of the hashes of two fingerprints; two empty ones are alike."""
    x, y = np.unique(a), np.unique(b)
    both = len(np.intersect1d(x, y, assume_unique=True))
    either = len(x) + len(y) - both
    return both / either if either else 1.0


def fingerprints(docs: DataFrame, text_column: str = "text", out: str = "prints", gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``docs`` with each text's kept hashes and positions, in order of position. Null and empty texts have none.

    A column that is named ``out`` is replaced; all others, the text included, are passed on.
    """
    kept = [c for c in docs.columns if c != out]
    rows = docs.select(F.struct(F.lit(0), *[common.column(c).alias(c) for c in kept]).alias("row"), common.column(text_column).alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("prints", PRINTS)])
    kind = pa.list_(pa.struct([("hash", pa.int64()), ("position", pa.int64())]))

    def of(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.batches(parts):
            found = []
            for text in part.column("text").to_pylist():
                hashes, places = chosen(text or "", gram, window)
                found.append([{"hash": h, "position": p} for h, p in zip(hashes.tolist(), places.tolist())])
            yield pa.record_batch([part.column("row"), pa.array(found, kind)], names=["row", "prints"])

    return rows.mapInArrow(of, schema).select(*[F.col("row").getField(c).alias(c) for c in kept], F.col("prints").alias(out))


EDITS = (
    "_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double,"
    " near_next double, positions array<int>"
)


def edited(text: str, following: str) -> str:
    """A text whose last third is the beginning of another."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def edits(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", gram: int = GRAM, window: int = WINDOW,
    chunk_bytes: int = common.CHUNK_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: its fingerprint with the positions of its hashes, that of its edited text, and how alike they are;
    and how alike its fingerprint and the next document's are.

    Documents follow each other by descending id, and after the last comes the first. A null id is smaller than any other. Rows that
    share an id follow each other by a hash of their text. The edited text ends with as many code points of the next document as a third
    of the text, rounded down, or all of it. Null counts as empty. A single document is its own next. Other columns are not looked
    at; an empty table gives an empty result.

    Texts are dealt once, into chunks of the order; the first document of a chunk is sent to the chunk before it as well. An id with
    very many rows, null included, is dealt over chunks by the hashes of their texts.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    mine = docs.select(F.col(id_column).cast("long").alias("_id"), F.xxhash64(text).alias("_mark"), text.alias("_text"))
    _, size = common.volume(mine, "_text")
    chunks = max(1, -(-size // chunk_bytes))
    deal = common.placed_chunk(mine, "_id", "_mark", chunks)
    dealt = mine.withColumn("_chunk", deal(F.col("_id"), F.col("_mark")))
    place = F.struct(F.col("_id").isNotNull().alias("there"), "_id", "_mark")
    firsts = dealt.select("_chunk", "_id", "_mark").groupBy("_chunk").agg(F.max(place).alias("_first"))
    # One row per chunk: the chunk that comes before it in descending order, or for the first one the last.
    firsts = stored(firsts.withColumn("_back", F.lit(chunks - 1) - F.col("_chunk")), "winnow-firsts")
    lowest = firsts.agg(F.min("_chunk")).first()[0]
    firsts = running_max_before(firsts, [], "_back", "_back", "_before")
    firsts = firsts.select(F.col("_chunk").alias("_own"), "_first", F.coalesce(F.lit(chunks - 1) - F.col("_before"), F.lit(lowest)).alias("_to"))
    firsts = F.broadcast(firsts) if fits_broadcast(firsts.select("_own", "_to", "_first._id", "_first._mark")) else firsts
    guests = dealt.join(firsts, (F.col("_chunk") == F.col("_own")) & (place == F.col("_first")))
    guests = guests.select("_id", "_mark", "_text", F.col("_to").alias("_chunk"), F.lit(True).alias("_guest"))
    both = dealt.withColumn("_guest", F.lit(False)).union(guests)

    def compared(table: pa.Table) -> pa.Table:
        rows = sorted(
            zip(table["_guest"].to_pylist(), [(i is not None, i or 0) for i in table["_id"].to_pylist()],
                [-m for m in table["_mark"].to_pylist()], table["_text"].to_pylist()),
            key=lambda r: (r[0], (not r[1][0], -r[1][1]), r[2]),
        )
        own = [r for r in rows if not r[0]]
        guest = rows[len(own)]
        out, prints = [], chosen(own[0][3], gram, window) if own else None
        for k, (_, (there, i), _, text) in enumerate(own):
            following = own[k + 1][3] if k + 1 < len(own) else guest[3]
            after = chosen(following, gram, window)
            changed = edited(text, following)
            other = chosen(changed, gram, window)[0]
            out.append(
                (i if there else None, len(text), hashlib.sha256(changed.encode()).hexdigest(), packed(prints[0]), packed(other),
                 likeness(prints[0], other), likeness(prints[0], after[0]), prints[1].astype(np.int32))
            )
            prints = after
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.list_(pa.int32())]
        columns = list(zip(*out)) or [()] * len(types)
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=[c.split()[0] for c in EDITS.split(", ")])

    found = both.groupBy("_chunk").applyInArrow(lambda table: compared(table), EDITS)
    return found.withColumnRenamed("_id", id_column)
