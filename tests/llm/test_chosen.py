"""The set-similarity join against all pairs."""

import collections
import random
import re

import corpus
import numpy as np
import pytest

from passtrail.llm import chosen

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size=2):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    return frozenset(tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))) if words else frozenset()


def brute_force(data, size=2, similarity=(80, 100)):
    sets = collections.defaultdict(list)
    for i, t in data:
        sets[shingles(t, size)].append(i)
    keys = [s for s in sets if s]
    root = {s: s for s in keys}

    def top(s):
        while root[s] is not s:
            s = root[s]
        return s

    for k, a in enumerate(keys):
        for b in keys[:k]:
            if min(len(a), len(b)) * similarity[1] >= similarity[0] * max(len(a), len(b)):
                both = len(a & b)
                if similarity[1] * both >= similarity[0] * (len(a) + len(b) - both):
                    root[top(a)] = top(b)
    ids = collections.defaultdict(list)
    for s in keys:
        ids[top(s)] += [i for i in sets[s] if i is not None]
    out = collections.Counter()
    for s, members in sets.items():
        for i in members:
            least = min(ids[top(s)], default=None) if s else i
            out[i, len(s), least, i == least] += 1
    return out


def frame(spark, data):
    return spark.createDataFrame([(*r, "clash", 1, 2, 3) for r in data], "doc_id long, text string, node string, n int, comp int, id int").repartition(3)


def near_copies(rng, first, count, base_words=120):
    """A text and edits of it: words changed, a passage cut, appended, or replaced, by about as much as 0.8 allows."""
    base = [f"v{rng.randrange(5000)}" for _ in range(base_words)]
    out = [(first, " ".join(base))]
    for k in range(1, count):
        words, kind = list(base), rng.randrange(4)
        amount = rng.randrange(1, base_words // 6 + 1)
        if kind == 0:
            for at in rng.sample(range(base_words), max(1, amount // 2)):
                words[at] = f"x{rng.randrange(10**6)}"
        elif kind == 1:
            words = words[amount:]
        elif kind == 2:
            words += [f"y{rng.randrange(10**6)}" for _ in range(amount)]
        else:
            words[10 : 10 + amount // 2] = [f"z{rng.randrange(10**6)}" for _ in range(amount // 2)]
        out.append((first + k, " ".join(words)))
    return out


def mixed_table():
    rng = random.Random(13)
    data = [r[:2] for r in corpus.rows()]
    for c in range(30):
        data += near_copies(rng, 10_000 + 100 * c, rng.randrange(2, 9), rng.randrange(6, 300))
    data += near_copies(rng, 20_000, 150)
    shared = " ".join(f"s{k}" for k in range(60))
    data += [(30_000 + k, shared + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 60)))) for k in range(150)]
    data += [(40_000 + k, "one two" if k % 3 else "ONE  two\n") for k in range(40)] + [(50_000 + k, f"one two w{k}") for k in range(40)]
    rng.shuffle(data)
    return data


@pytest.mark.parametrize("settings", [{}, {"small": 8, "heavy": 3000, "levels": 3}, {"small": 4, "levels": 1}])
def test_components(spark, settings):
    data = mixed_table()
    got = chosen.components(frame(spark, data), **settings)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert collections.Counter(map(tuple, got.collect())) == brute_force(data)


@pytest.mark.parametrize("few", [True, False])
def test_classes_do_not_move_again_for_nodes_that_branch_on(spark, monkeypatch, few):
    """Members that fit a broadcast go to the classes; otherwise the children are stored, as they are read twice."""
    data, seen, kept = mixed_table(), [], []

    def branch(rows, level, trees=0, of=chosen.branch):
        seen.extend([rows._jdf.queryExecution().optimizedPlan().toString()] * bool(level))
        return of(rows, level, trees)

    def stored(rows, name, of=chosen.stored):
        kept.append(name)
        return of(rows, name)

    monkeypatch.setattr(chosen, "branch", branch)
    monkeypatch.setattr(chosen, "stored", stored)
    if not few:
        monkeypatch.setattr(chosen, "fits_broadcast", lambda rows: False)
    monkeypatch.setattr(chosen, "COPIES", 0)
    got = chosen.components(frame(spark, data), small=4, levels=2)
    assert collections.Counter(map(tuple, got.collect())) == brute_force(data)
    assert seen and all(("strategy=broadcast" in plan) == few for plan in seen)
    assert kept.count("paths-children") == (0 if few else len(seen))


def test_other_sizes_and_similarities(spark):
    data = mixed_table()[::3]
    got = chosen.components(frame(spark, data), size=3, similarity=(1, 2)).collect()
    assert collections.Counter(map(tuple, got)) == brute_force(data, 3, (1, 2))


def test_nothing(spark):
    assert chosen.components(frame(spark, [])).collect() == []
    got = chosen.components(frame(spark, [(1, None), (2, ""), (None, " \t"), (2, "\n")])).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter([(1, 0, 1, True), (2, 0, 2, True), (2, 0, 2, True), (None, 0, None, True)])


def test_sketches_rule_out_no_link():
    rng = np.random.default_rng(5)
    for _ in range(300):
        base = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 3000), dtype=np.uint64) * np.uint64(2))
        cut = base[rng.random(len(base)) > rng.random() * 0.25]
        other = np.unique(np.concatenate([cut, rng.integers(0, 1 << 63, rng.integers(0, 1 + len(base) // 8), dtype=np.uint64)]))
        sets = [base, other if len(other) else base]
        bits = [np.packbits(np.bincount((s >> np.uint64(54)).astype(np.int64), minlength=1024).astype(np.uint8) & 1) for s in sets]
        tokens = [np.array([chosen.common.mixed((s * seed).min(keepdims=True))[0] & np.uint64(255) for seed in chosen._SEEDS], np.uint8) for s in sets]
        sketch = np.array([b.tobytes() + t.tobytes() for b, t in zip(bits, tokens)], object)
        known = chosen.Sketches(np.array([len(s) for s in sets]), sketch, (80, 100))
        may = known.may_link(0, np.array([1]))[0]
        assert known.may_link(np.array([0]), np.array([1]))[0] == may
        assert may or not chosen.similar(*sets, (80, 100))


def test_slices_meet():
    node, n = np.arange(10) * 7, np.full(10, 5)
    cells = list(chosen._sliced(node, n, 20))
    met = set()
    for _, nodes, role in cells:
        two = role.any()
        met |= {frozenset((int(a), int(b))) for a, r in zip(nodes, role) for b, q in zip(nodes, role) if a != b and (r != q or not two)}
    assert met == {frozenset((int(a), int(b))) for a in node for b in node if a != b} and all(len(c[1]) <= 6 for c in cells)
