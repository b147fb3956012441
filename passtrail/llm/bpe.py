"""Byte-level BPE encoding and decoding by tree concatenation.

A long text is halved until its parts are short; the parts are rows, so different tasks encode them in parallel, cut off wherever the
halving fell. Then neighbours are joined, pair by pair up the tree: the text around a join is encoded again in a window that grows
until it agrees with what lies on both sides.

Why agreement is enough. The tokenizer first cuts text by a pattern that never looks back, then merges inside each cut.
(1) A cut of the left part that ends three or more characters before the part's end is a cut of the whole: the pattern looks at most
two characters ahead. (2) If the window and the right part have a common cut, all later cuts are the same, as the pattern depends only on
what follows. (3) Inside one cut, tokens are what the merges give if and only if every two neighbours are what the merges give for
their bytes together. So a token that window and part have in common, at the same place, in a cut that goes on, joins them exactly.
Without agreement the window grows to everything, which is plain encoding.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passtrail.llm import common, vocab

CUT = vocab.CUT
#: Characters of a part at most, and of the first window on each side of a join.
PART_CHARS, WINDOW_CHARS = 16_384, 64


def halves(text: str, most: int) -> list[str]:
    """The leaves of the tree, in order; all of one depth."""
    parts = [text]
    while max(map(len, parts)) > most:
        parts = [h for p in parts for h in (p[: len(p) // 2], p[len(p) // 2 :])]
    return parts


#: No cut, and no special token that covers it, depends on text further on than this many bytes.
_GUARD = 64


class Joiner:
    """Joins packed, marked ids of neighbouring parts."""

    def __init__(self, path: str):
        self.words = vocab.words(path, False, True)
        self.sizes = np.array([len(b) for b in vocab.token_bytes(path)], np.int64)

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.words.of_text(text), np.uint32)

    def join(self, left: tuple[bytes, np.ndarray], right: tuple[bytes, np.ndarray]) -> tuple[bytes, np.ndarray]:
        """Two parts as (UTF-8, ids) to one."""
        (a_text, a), (b_text, b) = left, right
        if not a_text or not b_text:
            return (a_text or b_text), (a if a_text else b)
        reach = WINDOW_CHARS
        while True:
            i, start, hard = self._start(a_text, a, reach)
            j, stop = self._stop(b_text, b, reach)
            window = self.encode((a_text[start:] + b_text[:stop]).decode())
            met = self._met(window, b[:j], len(a_text) - start, stop) if j < len(b) else (len(window), len(b))
            if met and (hard or (len(window) > 1 and window[0] & (CUT - 1) == a[i] & (CUT - 1) and not window[1] & CUT)):
                if not hard:  # it goes on with the cut that the left part is in
                    window = window.copy()
                    window[0] = a[i]
                return a_text + b_text, np.concatenate([a[:i], window[: met[0]], b[met[1] :]])
            reach *= 4

    def _start(self, text: bytes, ids: np.ndarray, reach: int) -> tuple[int, int, bool]:
        """Where the window starts in the left part: id, byte, and whether that is a cut of the whole text."""
        some = min(len(ids), reach + _GUARD)
        before_end = np.cumsum(self.sizes[(ids[len(ids) - some :] & (CUT - 1))[::-1]])[::-1]  # bytes from each id to the end
        far = np.flatnonzero(before_end >= _GUARD)
        cuts = far[(ids[len(ids) - some :][far] & CUT) > 0]
        if len(cuts):
            i = int(cuts[-1])
        elif some == len(ids):
            return 0, 0, True
        else:
            whole = [k for k in far.tolist() if text[len(text) - before_end[k]] & 0xC0 != 0x80]
            if not whole:
                return self._start(text, ids, reach * 4)
            i = whole[0]
        return len(ids) - some + i, len(text) - int(before_end[i]), bool(len(cuts))

    def _stop(self, text: bytes, ids: np.ndarray, reach: int) -> tuple[int, int]:
        """Where the window stops in the right part: the number of ids and of bytes, at the end of a character."""
        ends = np.cumsum(self.sizes[ids[: reach + _GUARD] & (CUT - 1)])
        for j in range(len(ends) - 1, -1, -1):
            if ends[j] == len(text) or text[ends[j]] & 0xC0 != 0x80:
                return j + 1, int(ends[j])
        return len(ids), len(text)

    def _met(self, window: np.ndarray, right: np.ndarray, m: int, stop: int) -> tuple[int, int] | None:
        """How many ids of the window to take, and how many of the right part to leave: the first place where both agree."""
        ends_w = np.cumsum(self.sizes[window & (CUT - 1)])
        ends_r = np.cumsum(self.sizes[right & (CUT - 1)]) + m
        place = {int(e): j for j, e in enumerate(ends_r.tolist()) if e <= m + stop - _GUARD}
        for e, end in enumerate(ends_w.tolist()):
            j = place.get(end)
            if j is None or end <= m or e + 1 >= len(window) or j + 1 >= len(right):
                continue
            cut_w, cut_r = window[e + 1] & CUT, right[j + 1] & CUT
            same = window[e] & (CUT - 1) == right[j] & (CUT - 1)
            if (cut_w and cut_r) or (same and not cut_w and not cut_r):
                return e + 1, j + 1
        return None

    def tree(self, parts: list[tuple[bytes, np.ndarray]]) -> tuple[bytes, np.ndarray]:
        """Join neighbours, level by level."""
        while len(parts) > 1:
            parts = [self.join(*parts[k : k + 2]) if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)]
        return parts[0]


ENCODED = "_id bigint, n_tokens bigint, ids binary"


def encode(
    docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text", part_chars: int = PART_CHARS,
    then: tuple[Callable[[pa.RecordBatch], pa.RecordBatch], str] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_tokens``, ``ids`` (packed little-endian unsigned 32-bit), of the whole text.

    ``then``, a function of result batches and the schema that it gives (its id column named ``_id``), is applied in the same process,
    so that ids that are only needed for something else do not travel on.

    Ids are those of the tokenizers library without special tokens added and without truncation or padding; a special token's
    string in a text gets its id. Texts of more than ``part_chars`` characters are encoded in parts on different tasks and
    joined. Null counts as empty; an empty text has no ids. Rows that repeat an id or a text are rows of their own. Other columns
    are not looked at. The ids of a document are one value of at most 2 GB.
    """
    last, schema = then or (lambda batch: batch, ENCODED)
    mine = docs.select(F.col(id_column).cast("long").alias("_id"), F.coalesce(F.col(text_column), F.lit("")).alias("_text"))

    def short(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocab.words(tokenizer_path, False, True)
        for part in common.batches(parts):
            yield last(_encoded(part.column(0), [np.frombuffer(words.of_text(t), np.uint32) for t in part.column(1).to_pylist()]))

    def leaf(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocab.words(tokenizer_path, False, True)
        for part in common.batches(parts):
            ids = [words.of_text(t) for t in part.column("part").to_pylist()]
            yield pa.record_batch([*part.columns, pa.array(ids, pa.binary())], names=[*part.schema.names, "ids"])

    def joined(table: pa.Table) -> pa.Table:
        joiner = Joiner(tokenizer_path)
        order = np.argsort(table["number"].to_numpy(), kind="stable").tolist()
        texts, ids = common.octets(table["part"]), table["ids"].to_pylist()
        _, found = joiner.tree([(texts[k], np.frombuffer(ids[k], np.uint32)) for k in order])
        return pa.Table.from_batches([last(_encoded(pa.array([table["_id"][0].as_py()], pa.int64()), [found]))])

    long = F.length("_text") > part_chars
    parts = mine.filter(long).withColumn("row", F.monotonically_increasing_id()).select("row", "_id", F.posexplode(_halved(part_chars)).alias("number", "part"))
    parts = parts.repartition("row", "number").mapInArrow(leaf, "row bigint, _id bigint, number int, part string, ids binary")
    whole = parts.groupBy("row").applyInArrow(lambda table: joined(table), schema)
    return mine.filter(~long).mapInArrow(short, schema).union(whole).withColumnRenamed("_id", id_column)


def _halved(most: int):
    """The leaves of a text's tree, cut by characters."""

    @F.pandas_udf("array<string>")
    def cut(texts):
        return texts.map(lambda t: halves(t, most))

    return cut(F.col("_text"))


def _encoded(ids: pa.Array, found: list[np.ndarray]) -> pa.RecordBatch:
    packed = [(f & (CUT - 1)).astype(np.uint32).tobytes() for f in found]
    return pa.record_batch(
        [ids, pa.array([len(f) for f in found], pa.int64()), pa.array(packed, pa.binary())], names=["_id", "n_tokens", "ids"]
    )


def decoded(ids: bytes, tokens: list[bytes]) -> str:
    """The text of packed ids; bytes that are not UTF-8 become U+FFFD, as in the library."""
    return b"".join(map(tokens.__getitem__, np.frombuffer(ids, np.uint32).tolist())).decode("utf-8", "replace")


def decode(encoded: DataFrame, tokenizer_path: str, ids_column: str = "ids", out: str = "text") -> DataFrame:
    """``encoded`` with the text of its ids, special tokens included. Null ids give a null text."""
    schema = encoded.select("*").schema.add(out, "string")

    def of(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = vocab.token_bytes(tokenizer_path)
        for part in common.batches(parts):
            texts = [None if i is None else decoded(i, tokens) for i in part.column(ids_column).to_pylist()]
            yield pa.record_batch([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, out])

    return encoded.mapInArrow(of, schema)


DIGESTS = "_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def digests(tokenizer_path: str) -> tuple[Callable[[pa.RecordBatch], pa.RecordBatch], str]:
    """For ``encode``: instead of ids two SHA-256, of their decimal forms joined by commas, and of the text that they decode to."""

    def of(part: pa.RecordBatch) -> pa.RecordBatch:
        tokens = vocab.token_bytes(tokenizer_path)
        digits = _decimals(len(tokens))
        found = []
        for packed in part.column("ids").to_pylist():
            line = b",".join(map(digits.__getitem__, np.frombuffer(packed, np.uint32).tolist()))
            found.append((hashlib.sha256(line).hexdigest(), hashlib.sha256(decoded(packed, tokens).encode()).hexdigest()))
        columns = [pa.array([f[k] for f in found], pa.string()) for k in (0, 1)]
        return pa.record_batch([part.column("_id"), part.column("n_tokens"), *columns], names=["_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return of, DIGESTS


@functools.lru_cache(maxsize=2)
def _decimals(count: int) -> list[bytes]:
    return [b"%d" % i for i in range(count)]
