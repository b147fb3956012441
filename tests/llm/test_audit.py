"""The filter audit against brute force, document by document and order by order."""

import collections
import itertools
import random
import re

import corpus
import pytest

from passtrail.llm import audit

LABELS = [(1, 1, 0), (4, 0, 1), (7, 1, 1), (10, None, 1), (13, 1, None), (13, 0, 0), (None, 1, 1), (19, 1, 0), (9999, 1, 1)]


def rows():
    rng = random.Random(12)
    texts = [r[:2] for r in corpus.rows()]
    texts += [(500 + k, "LOUD WORDS " * rng.randrange(1, 90)) for k in range(5)] + [(600, "some # sign"), (601, "some # sign"), (599, "some # sign")]
    texts += [(None, "some # sign"), (700, "a\x0bb\x0cc\rd"), (701, " lead and trail "), (702, "\t"), (703, "éÉ" * 10)]
    return [(i, t, rng.choice(["en", "fr", "", None])) for i, t in texts]


def failed(data):
    smallest = {}
    for i, t, _ in data:
        if i is not None:
            smallest[t or ""] = min(smallest.get(t or "", i), i)
    for i, t, part in data:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > smallest[t],
        }
        yield i, part or "", {c for c, f in fails.items() if f}


def brute_force(data, labels, letters):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    out, removed_by = {}, collections.Counter()
    all_failed = list(failed(data))
    for part in {p for _, p, _ in all_failed}:
        mine = [(i, f) for i, p, f in all_failed if p == part]
        for order in itertools.permutations(letters):
            left = mine
            for step, c in enumerate(order, 1):
                gone = [i for i, f in left if c in f]
                redundant = sum(c in f and bool(f & set(order[: step - 1])) for _, f in mine)
                left = [(i, f) for i, f in left if c not in f]
                out[part, "".join(order), step] = (
                    len(left), len(gone), redundant, sum(f == {c} for _, f in mine), sum(i in good for i in gone), sum(i in toxic for i in gone)
                )
                removed_by[part, c] += len(gone)
    return {k: (*v, removed_by[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def frames(spark, data, labels=LABELS):
    docs = spark.createDataFrame([(*r, "clash", 1, 2) for r in data], "doc_id long, text string, lang string, mask string, n int, part int").repartition(3)
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_every_order(spark):
    data = rows()
    data += data[3:5]
    got = audit.audit(*frames(spark, data)).collect()
    assert {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got} == brute_force(data, LABELS, "ABCDE") and len(got) % 600 == 0
    assert got[0].__fields__ == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_nothing(spark):
    assert audit.audit(*frames(spark, [])).collect() == []
    got = audit.audit(*frames(spark, [(1, None, None)], [])).collect()
    assert {(r.part, r.kept, r.removed) for r in got} == {("", 1, 0), ("", 0, 1), ("", 0, 0)} and len(got) == 600


@pytest.mark.parametrize("limit", ["5", "-1"])
def test_rows_of_the_recursion(spark, limit):
    """The session's limit is raised where it would end the recursion, and stays where there is none."""
    key = "spark.sql.cteRecursionRowLimit"
    was = spark.conf.get(key)
    spark.conf.set(key, limit)
    try:
        counted = spark.createDataFrame([("x", 1, 2, 1, 0), ("x", 3, 5, 0, 1), ("y", 0, 7, 0, 0)], "part string, mask int, n long, good long, toxic long")
        got = {(r.part, r.filter_order, r.step): r for r in audit.interactions(counted, "PQ").collect()}
        assert len(got) == 8 and spark.conf.get(key) in ("-1", "11")
    finally:
        spark.conf.set(key, was)
    assert (got["x", "PQ", 1].removed, got["x", "PQ", 2].removed, got["x", "PQ", 2].redundant, got["x", "QP", 1].removed) == (7, 0, 5, 5)
    assert (got["x", "PQ", 1].unique_fails, got["x", "PQ", 1].shapley, got["x", "PQ", 2].shapley, got["y", "QP", 2].kept) == (2, 9, 5, 7)


def test_other_filters(spark):
    from pyspark.sql import functions as F

    docs, labels = frames(spark, [(1, "x y", "en"), (2, "x y", "en"), (3, "z", "en")])
    got = audit.audit(docs, labels, filters={"Q": lambda: F.col("n") > 1}, copy="P").collect()
    assert {(r.filter_order, r.step): (r.kept, r.removed) for r in got} == {("PQ", 1): (2, 1), ("PQ", 2): (1, 1), ("QP", 1): (1, 2), ("QP", 2): (1, 0)}
