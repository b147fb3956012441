"""Toxicity scores by FTRL-proximal logistic regression over hashed words, word pairs and skip-grams.

Learning rates are per coordinate and L1 keeps most weights at zero, so the model is a short list of (feature, weight) that goes to
the scoring tasks inside their function. Learning sees a bounded sample of labelled rows; every document is scored on its whole text
where it is read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passtrail.llm import common

FEATURE_BITS = 22
#: Bounds of the sample that is learned from: rows, and UTF-8 bytes of a text.
SAMPLE_ROWS, SAMPLE_TEXT_BYTES = 16_000, 1 << 16
BIAS = 0
#: Distances between the two words of a pair: next to each other, one or two words between.
GAPS = (1, 2, 3)

#: Lower case and no punctuation, in ASCII.
_PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256)
)


@dataclass(frozen=True)
class Settings:
    rate: float = 1.0
    smoothing: float = 1.0
    #: L1, and for each example of the sample: gradients add up over examples, so what they must exceed does too.
    l1: float = 4.0
    l1_each: float = 0.001
    l2: float = 1.0
    passes: int = 3
    #: What an example of label 1 counts, as it is the rarer one.
    weight_of_one: float = 4.0


def features(text: bytes) -> np.ndarray:
    """Hashed features, with repeats; the bias is not among them."""
    units = common.words_of([text.translate(_PLAIN)])[0]
    kinds = [units] + [
        units[:-gap] * np.uint64(0x9E3779B97F4A7C15) + units[gap:] * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(gap)
        for gap in GAPS
        if len(units) > gap
    ]
    hashed = common.mixed(np.concatenate(kinds))
    return (hashed >> np.uint64(64 - FEATURE_BITS)).astype(np.int64) | 1  # even places are free, so 0 is the bias


def learned(examples: list[tuple[bytes, int]], settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Features with a weight, and the weights."""
    # One flat array of all examples' features: many small ones would leave their memory in pieces.
    sizes, blocks = [0], [np.zeros(0, np.int32)]
    for k in range(0, len(examples), 1000):
        parts = [np.concatenate([[BIAS], np.unique(features(text))]).astype(np.int32) for text, _ in examples[k : k + 1000]]
        sizes += map(len, parts)
        blocks.append(np.concatenate(parts))
    flat, ends = np.concatenate(blocks), np.cumsum(sizes).tolist()
    del blocks
    size = 1 << FEATURE_BITS
    z, n, l1 = np.zeros(size), np.zeros(size), max(settings.l1, settings.l1_each * len(examples))
    for _ in range(settings.passes):
        for a, b, (_, label) in zip(ends, ends[1:], examples):
            at = flat[a:b]
            zi, ni = z[at], n[at]
            root = np.sqrt(ni)
            w = _weights(zi, root, l1, settings)
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            g *= settings.weight_of_one if label else 1.0
            z[at] = zi + g - (np.sqrt(ni + g * g) - root) / settings.rate * w
            n[at] = ni + g * g
    w = _weights(z, np.sqrt(n), l1, settings)
    at = np.flatnonzero(w)
    return at, w[at]


def _weights(z: np.ndarray, root: np.ndarray, l1: float, settings: Settings) -> np.ndarray:
    w = (np.sign(z) * l1 - z) / ((settings.smoothing + root) / settings.rate + settings.l2)
    return np.where(np.abs(z) <= l1, 0.0, w)


def held_out(id_column: Column, folds: int = 5) -> Column:
    """Whether a row is kept from learning; a null id is not."""
    return F.coalesce(F.pmod(F.crc32(id_column.cast("string").cast("binary")), F.lit(folds)) == 0, F.lit(False))


def fit(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic",
    settings: Settings = Settings(), sample_rows: int = SAMPLE_ROWS, sample_text_bytes: int = SAMPLE_TEXT_BYTES,
) -> tuple[np.ndarray, np.ndarray]:
    """Learn from at most ``sample_rows`` labelled documents that are not held out, chosen by a hash of the id.

    Texts beyond ``sample_text_bytes`` are not learned from. Null labels and null ids do not count; of several labels of an id the
    largest holds. The sample is learned in one task, in an order that the hash gives. Without any example there are no weights.
    """
    known = labels.select(F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("int").alias("label")).dropna()
    known = known.filter(~held_out(F.col("id"))).groupBy("id").agg((F.max("label") > 0).cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    mine = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    examples = mine.filter(F.octet_length("text") <= sample_text_bytes).join(F.broadcast(chosen), "id")

    def learn(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["id"].to_pylist(), common.octets(table["text"]), table["label"].to_pylist()))
        order = np.random.default_rng(5).permutation(len(rows)).tolist()
        at, w = learned([rows[i][1:] for i in order], settings)
        del rows
        common.give_back()
        return pa.table({"feature": pa.array(at, pa.int64()), "weight": pa.array(w, pa.float64())})

    # Repeated rows of an id could make the sample larger than it may be; one text of each id is learned from.
    single = examples.groupBy("id").agg(F.min("text").alias("text"), F.first("label").alias("label"))
    one_task = single.withColumn("all", F.lit(0)).groupBy("all")
    model = one_task.applyInArrow(lambda table: learn(table), "feature bigint, weight double").toPandas()
    return model["feature"].to_numpy(np.int64), model["weight"].to_numpy(np.float64)


@functools.lru_cache(maxsize=2)
def _dense(at: bytes, w: bytes) -> np.ndarray:
    table = np.zeros(1 << FEATURE_BITS, np.float32)
    table[np.frombuffer(at, np.int64)] = np.frombuffer(w, np.float64)
    return table


def score_of(text: bytes, table: np.ndarray) -> float:
    at = features(text)
    at = np.unique(at[table[at] != 0])
    return float(1.0 / (1.0 + np.exp(-np.clip(np.float64(table[BIAS]) + table[at].sum(dtype=np.float64), -35, 35))))


def scored(
    docs: DataFrame, model: tuple[np.ndarray, np.ndarray], text_column: str = "text", out: str = "score"
) -> DataFrame:
    """``docs`` without its text column, with the score (0 to 1) of each whole text.

    Null counts as empty; an empty text has the bias alone. A model without weights scores everything 0. All other columns are
    passed on, but for one named ``out``, which the score replaces.
    """
    at, w = model[0].astype(np.int64).tobytes(), model[1].astype(np.float64).tobytes()
    kept = [c for c in docs.columns if c not in (text_column, out)]
    rows = docs.select(F.struct(F.lit(0), *[common.column(c).alias(c) for c in kept]).alias("row"), F.col(text_column).alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())])

    def of(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _dense(at, w)
        for part in common.batches(parts):
            texts = common.octets(part.column("text"))
            found = [score_of(t, table) for t in texts] if at else [0.0] * len(texts)
            yield pa.record_batch([part.column("row"), pa.array(found, pa.float64())], names=["row", "score"])

    back = [F.col("row").getField(c).alias(c) for c in kept]
    return rows.mapInArrow(of, schema).select(*back, F.col("score").alias(out))


def judged(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", **settings) -> DataFrame:
    """One row per row of ``docs``: id, ``held_out``, ``score`` and ``predicted`` (1 from 0.5 on). Fits the model first."""
    model = fit(docs, labels, id_column, text_column, **settings)
    rows = scored(docs.select(F.col(id_column).cast("long").alias("_id"), F.col(text_column).alias("text")), model)
    return rows.select(
        F.col("_id").alias(id_column), held_out(F.col("_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def without_toxic(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", **settings) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score is below 0.5."""
    model = fit(docs, labels, id_column, text_column, **settings)
    rows = docs.select(F.struct("*").alias("_row"), F.col(text_column).alias("text"))
    return scored(rows, model).filter("score < 0.5").select("_row.*")
