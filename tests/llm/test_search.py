"""Ranked search against a score of every document for every item."""

import collections
import math
import random
import re

import corpus
import numpy as np
import pytest

from passtrail.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def brute_force(docs, items, top=10):
    counted = [(i, collections.Counter(terms(t))) for i, t in docs]
    counted = [(i, c, c.total()) for i, c in counted if c]
    total, length = len(counted), sum(n for *_, n in counted)
    df = collections.Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in sorted(set(items), key=str):
        scores = []
        for i, c, n in counted:
            m = 100 - 75 + (75 * n * total) // length
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c)
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scores)[:top], 1)]
    return collections.Counter(out)


def rows():
    rng = random.Random(11)
    docs = [r[:2] for r in corpus.rows()]
    docs += [(1000 + k, " ".join(rng.choice(["alpha", "Beta", "gamma-ray", "delta", "é1"]) for _ in range(rng.randrange(1, 6)))) for k in range(300)]
    docs += [(2000, "...,,,"), (2001, "x" * 100_000), (2002, "alpha " * 4000)]
    items = [(1, docs[6][1]), (2, "alpha beta"), (2, "gamma"), (2, "gamma"), (3, None), (4, ""), (5, "nowhere to find"), (6, "É1 é1 DELTA delta alpha"), (None, "w1 w2 w3 the the")]
    items += [(7, "the of and " * 30 + "w77"), (8, " ".join(f"w{k}" for k in range(400)))]
    return docs, items


def frames(spark, docs, items, parts=3):
    d = spark.createDataFrame([(*r, "clash", 1, 2, 3) for r in docs], "doc_id long, text string, item string, rank int, score int, id int").repartition(parts)
    return d, spark.createDataFrame([(*r, 9) for r in items], "item_id long, text string, block int")


@pytest.mark.parametrize("settings", [{}, {"chunk_postings": 50, "first_depth": 2, "start": 1, "block_bytes": 300}, {"top": 3, "chunk_postings": 400, "start": 4}])
def test_ranking(spark, settings):
    docs, items = rows()
    got = search.search(*frames(spark, docs, items), **settings)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert collections.Counter(map(tuple, got.collect())) == brute_force(docs, items, settings.get("top", 10))


def test_nothing(spark):
    docs, items = rows()
    for d, i in (([], items), (docs, []), ([(1, None), (2, " ")], items), (docs, [(1, None), (2, "!?")])):
        assert search.search(*frames(spark, d, i)).collect() == []


def test_reads_end_early():
    """Documents that cannot reach the threshold leave the ends of the lists unread."""
    rng = np.random.default_rng(3)
    docs = np.tile(np.arange(5000), 4)
    lists = search.Lists(np.repeat(np.arange(4), 5000), docs, rng.integers(1, 1000, 20_000) ** 2, list(range(5000)), 4)
    sums = np.zeros(5000, np.int64)
    np.add.at(sums, lists.docs, lists.impacts)
    reader = search.Reader(lists, np.arange(4), np.ones(4, np.int64))
    assert len(search.resolved(reader, int(sums.max()) + 1, 10, 8)) == 0
    assert sum(a - b for a, b in zip(reader.at, reader.begin)) < 10_000
    reader = search.Reader(lists, np.arange(4), np.ones(4, np.int64))
    found = search.resolved(reader, 1, 10, 8)
    best = np.lexsort((np.arange(5000), -sums))[:10]
    assert set(best) <= set(found) and all(reader.low[d] == sums[d] for d in found)
    assert all(a == e for a, e in zip(reader.at, reader.end)) or sum(a - b for a, b in zip(reader.at, reader.begin)) < 20_000


def test_terms():
    texts = ["Tea's  time\x00a-b", "", "été2 ÉTÉ2 ete2", "tea S"]
    flat = [(first + k, h) for first, hashes, owner in search.terms_of([t.encode() for t in texts]) for k, h in zip(owner.tolist(), hashes.tolist())]
    words = [(k, w) for k, t in enumerate(texts) for w in terms(t)]
    assert [k for k, _ in flat] == [k for k, _ in words]
    assert len({h for _, h in flat}) == len({w for _, w in words}) == len(set(zip((h for _, h in flat), (w for _, w in words))))
