"""Audit of how filters interact: what each one removes, and in vain, in every order in which they can be applied.

Each document becomes a mask of the filters that it fails, and all that is asked for follows from how many documents a part of the
corpus has of each mask: its cells. A recursive common table expression enumerates the orders. It begins with the empty prefix of each
part and extends each prefix by every letter that it has not used; the bits applied so far are carried along, the part's cells are
joined in, and each level of the recursion emits the metrics of that step. Orders with a common prefix share its rows, so n filters
cost the sum of n! / (n - k)! rows a part rather than n * n!.

Texts are read once, for a narrow row per document. Copies are told by SHA-256 over groups that are dealt out over salts, so a text with
a third of all rows is no task's own.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from passtrail.llm import common
from passtrail.operators.scale import left_join_unique
from passtrail.operators.stores import stored

#: White space between words: the characters [\x20\x09-\x0D].
_SPACE = " \t\n\x0b\f\r"
METRICS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def _words(text: Column) -> Column:
    return F.split(F.btrim(text, F.lit(_SPACE)), r"[ \x09-\x0D]+")


#: Filters that look at a text alone: letter -> whether ``t`` (the text), ``n`` (its words) or ``d`` (its distinct words) fail.
TEXT_FILTERS: dict[str, Callable[[], Column]] = {
    "A": lambda: F.col("n") < 100,
    "B": lambda: 100 * F.col("d") < 80 * F.col("n"),
    "C": lambda: 100 * F.regexp_count("t", F.lit("[A-Z]")).cast("long") > 10 * F.length("t").cast("long"),
    "D": lambda: F.col("t").rlike(r"[#$%&*|]"),
}
#: The filter that looks at the whole table: a text that a smaller id has too.
COPY = "E"


def failures(
    docs: DataFrame, filters: dict[str, Callable[[], Column]] | None = None, copy: str = COPY, id_column: str = "doc_id",
    text_column: str = "text", part_column: str = "lang",
) -> DataFrame:
    """A narrow row per row of ``docs``: ``id``, ``part`` and ``mask``, bit k being set if the k-th filter by letter fails.

    ``filters`` are conditions on the columns ``t``, ``n`` and ``d``; ``copy`` is the letter of the filter for texts that a smaller id has
    too. A null text is empty, and a null part is the empty string. A row without an id is not smaller than another and has no smaller
    one; rows that share an id are not smaller than each other. Other columns are not looked at. Starts jobs.
    """
    filters = TEXT_FILTERS if filters is None else filters
    letters = sorted([*filters, copy])
    text = F.coalesce(common.column(text_column), F.lit(""))
    read = docs.select(common.column(id_column).cast("long").alias("id"), F.coalesce(common.column(part_column).cast("string"), F.lit("")).alias("part"), text.alias("t"))
    words = read.withColumn("w", _words(F.col("t")))
    blank = F.btrim("t", F.lit(_SPACE)) == ""
    counted = words.withColumns(
        {
            "n": F.when(blank, 0).otherwise(F.size("w")).cast("long"),
            "d": F.when(blank, 0).otherwise(F.size(F.array_distinct("w"))).cast("long"),
        }
    )
    bits = sum((F.when(fails(), 1 << letters.index(letter)).otherwise(0) for letter, fails in filters.items()), F.lit(0))
    rows = counted.select("id", "part", bits.cast("int").alias("mask"), F.unhex(F.sha2("t", 256)).alias("digest"), F.monotonically_increasing_id().alias("row"))
    rows = stored(rows, "audit-rows")
    told = common.share_in_groups(rows, ["digest"], {"first": (lambda: F.min("id"), F.min)}, F.col("row"))
    later = F.when(F.col("id") > F.col("first"), 1 << letters.index(copy)).otherwise(0)
    return told.select("id", "part", (F.col("mask") + later).cast("int").alias("mask"))


def cells(failed: DataFrame, labels: DataFrame, id_column: str = "doc_id", good: str = "quality", toxic: str = "toxic") -> DataFrame:
    """How many documents a part has of each mask, and how many of them are labelled good and toxic.

    An id counts as good or toxic if any of its labels says so; null labels and labels without an id say nothing.
    """
    known = labels.select(common.column(id_column).cast("long").alias("id"), F.col(good).alias("g"), F.col(toxic).alias("x")).filter("id is not null")
    known = known.groupBy("id").agg(*[F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(c) for c in ("g", "x")])
    rows = left_join_unique(failed, known, ["id"])
    sums = [F.sum(F.coalesce(F.col(c), F.lit(0))).cast("long").alias(n) for c, n in (("g", "good"), ("x", "toxic"))]
    return rows.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), *sums)


_RECURSION = """
    WITH RECURSIVE prefixes AS (
        SELECT part, cast('' AS string) AS prefix, 0 AS applied, 0 AS step, cast('' AS string) AS letter, {zeros} FROM {parts}
        UNION ALL
        SELECT part, prefix || next.letter, applied | next.bit, step + 1, next.letter, {metrics}
        FROM (
            SELECT p.part, p.prefix, p.applied, p.step, c.cells,
                explode(filter({letters}, l -> (p.applied & l.bit) = 0)) AS next
            FROM prefixes p JOIN {parts} c ON p.part = c.part
        )
    )
    SELECT part, prefix, step, letter, {names} FROM prefixes WHERE step > 0
"""


def _metric(value: str, condition: str) -> str:
    return f"aggregate(filter(cells, c -> {condition}), 0L, (a, c) -> a + c.{value})"


def prefixes(counted: DataFrame, letters: str) -> DataFrame:
    """The metrics of each prefix of an order of ``letters``, for each part of the cells ``counted``.

    ``letters`` are in the order of the bits. The session's limit on rows of a recursion is raised if the parts need more.
    """
    spark = counted.sparkSession
    parts = stored(counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells")), "audit-parts")
    rows = parts.count() * sum(math.perm(len(letters), k) for k in range(len(letters) + 1))
    _allow_rows(spark, rows)
    here = "(c.mask & next.bit) <> 0 AND (c.mask & applied) = 0"
    sums = {
        "kept": _metric("n", "(c.mask & (applied | next.bit)) = 0"),
        "removed": _metric("n", here),
        "redundant": _metric("n", "(c.mask & next.bit) <> 0 AND (c.mask & applied) <> 0"),
        "unique_fails": _metric("n", "c.mask = next.bit"),
        "good_lost": _metric("good", here),
        "toxic_lost": _metric("toxic", here),
    }
    unused = ", ".join(f"named_struct('letter', '{c}', 'bit', {1 << k})" for k, c in enumerate(letters))
    found = spark.sql(
        _RECURSION.format(
            parts="{parts}", letters=f"array({unused})", zeros=", ".join(f"0L AS {m}" for m in METRICS),
            metrics=", ".join(sums[m] for m in METRICS), names=", ".join(METRICS),
        ),
        parts=parts,
    )
    return stored(found, "audit-prefixes")


def _allow_rows(spark: SparkSession, rows: int) -> None:
    key = "spark.sql.cteRecursionRowLimit"
    if -1 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, rows + 1)


def interactions(counted: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """A row for each part, order of all letters, and step, zeros included: ``part``, ``filter_order``, ``step``, the metrics, ``shapley``.

    ``kept`` and ``removed`` are of this step, ``redundant`` fails the step's filter but went before it, ``unique_fails`` fails no other
    filter, ``good_lost`` and ``toxic_lost`` are removed here, and ``shapley`` sums what the filter removes over all orders.
    No part gives no rows.
    """
    found = prefixes(counted, letters)
    full = len(letters)
    # A prefix of k letters begins (n - k)! orders.
    orders = F.element_at(F.array(*[F.lit(math.factorial(full - k)).cast("long") for k in range(1, full + 1)]), F.col("step"))
    shares = found.groupBy("part", "letter").agg(F.sum(F.col("removed") * orders).alias("shapley"))
    whole = found.filter(F.col("step") == full).select("part", F.col("prefix").alias("filter_order"))
    steps = whole.select("*", F.explode(F.sequence(F.lit(1), F.lit(full))).alias("step"))
    keyed = steps.withColumn("prefix", F.expr("substr(filter_order, 1, step)"))
    joined = keyed.join(found.drop("step"), ["part", "prefix"]).join(shares, ["part", "letter"])
    return joined.select("part", "filter_order", "step", *METRICS, "shapley")


def audit(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """``interactions`` of the filters A to E over all rows of ``docs``. Starts jobs."""
    filters = settings.pop("filters", TEXT_FILTERS)
    failed = failures(docs, filters, **settings)
    letters = "".join(sorted([*filters, settings.get("copy", COPY)]))
    return interactions(stored(cells(failed, labels, settings.get("id_column", "doc_id")), "audit-cells"), letters)
