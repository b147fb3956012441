"""Deduplication operators against brute force."""

import collections
import hashlib
import random

import corpus
import numpy as np
import pyarrow as pa
import pytest
import xxhash

from passtrail.llm import exact, lines, simhash, substring, suffix, toxicity

WHITE = " \t\n\x0b\x0c\r"


def plain(text):
    return (text or "").encode().translate(None, WHITE.encode())


def test_copies(docs):
    rows = exact.copy_groups(docs).collect()
    groups = collections.defaultdict(list)
    for r in corpus.rows():
        groups[plain(r[1])].append((-len(r[1] or ""), r[0] is None, r[0]))
    assert len(rows) == len(corpus.rows())
    kept = collections.Counter()
    for r in rows:
        group = next(g for t, g in groups.items() if hashlib.sha256(t).hexdigest() == r.text_sha256)
        assert (r.keep_id, r.group_size) == (min(group, key=lambda m: (m[0], m[1], m[2] or 0))[2], len(group))
        kept[r.text_sha256] += r.kept
    assert set(kept.values()) == {1}


def test_copies_go(docs):
    left = exact.without_copies(docs).collect()
    assert left[0].asDict().keys() == set(docs.columns)
    assert collections.Counter(plain(r.text) for r in left) == collections.Counter(set(plain(r[1]) for r in corpus.rows()))


def fingerprint(text, size=4):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[k : k + size]) for k in range(max(1, len(w) - size + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def test_simhash(docs):
    prints = {fingerprint(r[1]) for r in corpus.rows()}
    root = {p: p for p in prints}
    for _ in prints:
        for a in prints:
            root[a] = min(root[b] for b in prints if (a ^ b).bit_count() <= 4)
    ids = collections.defaultdict(list)
    for r in corpus.rows():
        if r[0] is not None:
            ids[root[fingerprint(r[1])]].append(r[0])
    got = simhash.components(docs).collect()
    assert len(got) == len(corpus.rows())
    want = collections.Counter((r[0], f"{fingerprint(r[1]):016x}", min(ids[root[fingerprint(r[1])]], default=None)) for r in corpus.rows())
    assert collections.Counter(map(tuple, got)) == want


def test_slices_find_the_same_links(spark):
    values = [(1 << k) | 7 for k in range(4, 40)] + [((1 << 60) | (1 << k)) for k in range(30)]
    nodes = spark.createDataFrame([(v, v, 0) for v in values], "fp long, node long, view int")
    whole = {frozenset(r) for r in simhash.common.connected(simhash.links(nodes)).collect()}
    cut = {frozenset(r) for r in simhash.common.connected(simhash.links(nodes, slice_size=3)).collect()}
    assert whole == cut and whole


@pytest.mark.parametrize("radius", [0, 2, 4])
def test_bk_tree(radius):
    import random

    rng = random.Random(radius)
    values = [rng.getrandbits(12) for _ in range(300)]
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for v in values[:40]:
        want = sorted(k for k, w in enumerate(values) if (v ^ w).bit_count() <= radius)
        assert sorted(k for _, k in tree.within(v, radius)) == want


def first_of_each_group(data):
    """Of (id, text) the rows that stay: the smallest id, then the smallest hash of the text, of each component of fingerprints."""

    def mark(text):
        value = xxhash.xxh64_intdigest((text or "").encode(), 42)
        return value - (1 << 64) if value >> 63 else value

    prints = {fingerprint(t) for _, t in data}
    root = {p: p for p in prints}
    for _ in prints:
        for a in prints:
            root[a] = min(root[b] for b in prints if (a ^ b).bit_count() <= 4)
    first = {}
    for i, t in data:
        place = (i is None, i or 0, mark(t))
        first[root[fingerprint(t)]] = min(first.get(root[fingerprint(t)], place), place)
    return collections.Counter((i, t) for i, t in data if first[root[fingerprint(t)]] == (i is None, i or 0, mark(t)))


@pytest.mark.parametrize("slice_size", [simhash.SLICE, 3])
def test_near_copies_go(docs, slice_size):
    left = simhash.without_near_copies(docs, slice_size=slice_size)
    assert left.columns == docs.columns
    assert collections.Counter((r.doc_id, r.text) for r in left.collect()) == first_of_each_group([(r[0], r[1] if r[1] is not None else None) for r in corpus.rows()])


def test_stage_keeps_one_text_of_each_group(spark):
    import random

    import corpus_pipeline

    rng = random.Random(8)
    data = []
    for first in range(0, 400, 10):
        base = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(5, 700))]
        edits = [base, base[:-1], ["new", *base[1:]], [*base, "tail"], base[: len(base) // 2]]
        data += [(first + k, " ".join(t)) for k, t in enumerate(edits)]
    data += [(900, ""), (901, None), (902, " \n ")]
    left = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(data, "doc_id long, text string").repartition(3), "")
    kept = collections.Counter((r.doc_id, r.text) for r in left.collect())
    assert kept == first_of_each_group(data) and 40 < kept.total() < len(data)


def test_stages_take_any_column_names(spark):
    import corpus_pipeline

    names = ["a.b", "c`d", "score", "_text", "row", "mark", "id"]
    rows = [(k, "some words that are toxic " * (k % 3), *[f"{n}{k}" for n in names]) for k in range(6)]
    fields = ["doc_id long", "text string", *["`" + n.replace("`", "``") + "` string" for n in names]]
    docs = spark.createDataFrame(rows, ", ".join(fields))
    labels = spark.createDataFrame([(0, 0)], "doc_id long, toxic int")
    for stage in (toxicity.without_toxic(docs, labels), exact.without_copies(docs), simhash.without_near_copies(docs), substring.without_repeats(docs)):
        assert stage.columns == docs.columns
        found = stage.collect()
        assert found and all(tuple(r)[2:] == rows[r[0]][2:] for r in found)
    scored = toxicity.scored(docs, toxicity.fit(docs, labels))
    assert scored.columns == ["doc_id", "a.b", "c`d", "_text", "row", "mark", "id", "score"] and scored.schema["score"].dataType.typeName() == "double"


def test_repeated_words(docs):
    seen, want = set(), {}
    for r in sorted(set(corpus.rows()), key=corpus.order_key):
        w = (r[1] or "").encode().split()
        gone = [False] * len(w)
        for k in range(len(w) - 19):
            window = tuple(w[k : k + 20])
            if window in seen:
                gone[k : k + 20] = [True] * 20
            seen.add(window)
        want[r[0], r[1]] = (len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode())
    for chunk_bytes in (5_000, 8 << 20):
        got = substring.repeated_words(docs, chunk_bytes=chunk_bytes).collect()
        assert collections.Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == collections.Counter(
            (r[0], *want[r[0], r[1]]) for r in corpus.rows()
        )
        assert all(sum(s.length for s in r.spans) == r.n_removed for r in got)


def test_passages_go_and_rows_stay(docs):
    left = substring.without_repeats(docs)
    assert left.columns == docs.columns and left.count() == docs.count()
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in left.collect())


@pytest.mark.parametrize("settings", [{}, {"chunk_bytes": 20_000, "slice_size": 2}])
def test_repeated_bytes(docs, settings):
    texts = [(r[0], (r[1] or "").encode()) for r in corpus.rows()]
    count = collections.Counter(t[k : k + 400] for _, t in texts for k in range(len(t) - 399))
    want = collections.Counter()
    for i, t in texts:
        gone = [False] * len(t)
        for k in range(len(t) - 399):
            if count[t[k : k + 400]] > 1:
                gone[k : k + 400] = [True] * 400
        runs = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        want[i, len(t), sum(gone), runs, bytes(x for x, g in zip(t, gone) if not g)] += 1
    got = suffix.repeated_bytes(docs, **settings).collect()
    assert collections.Counter((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in got) == want


def test_repeated_passages_go_from_400_bytes_on(spark):
    """Bytes decide, not words: a passage of over 50 words goes from every text if the repeat that holds it has 400 bytes."""
    rng = random.Random(9)

    def passage(words, size):
        text = " ".join(f"{k:02d}" + "".join(rng.choices("abcdefgh", k=3)) for k in range(words))
        return text + "".join(rng.choices("abcdefgh", k=size - len(text)))

    rows, want = [], {}
    for words, size, around in [(59, 394, ""), (59, 394, "same"), (55, 399, ""), (55, 400, ""), (55, 401, ""), (65, 399, ""), (60, 450, "")]:
        text = around + passage(words, size) + around
        for k in range(2):
            i = len(rows)
            # What is next to the passage is another byte in each text.
            rows.append((i, f"{i} begins{'xy'[k]}{text}{'yx'[k]}ends {i}", "en", 1, 1, "", "", 2, ""))
            want[i] = len(text) if len(text) >= 400 else 0
    got = suffix.repeated_bytes(corpus.frame(spark, rows)).collect()
    assert {r["doc_id"]: r["n_removed"] for r in got} == want
    assert all(r["n_bytes"] == len(rows[r["doc_id"]][1]) for r in got)


def test_repeated_bytes_take_rows_in_any_order():
    """A shuffle gives the rows of a chunk in any order, another one in each stage."""
    import numpy as np
    import pyarrow as pa

    text = "".join(chr(97 + k * k % 23) + str(k) for k in range(400))
    texts = [text[:700], text[100:900], "z" + text[300:850], None, "short", "é" + text[250:800], text[100:900]]
    ids = [5, 2, None, 4, 2, 1, 2]
    rows = pa.table({"_id": pa.array(ids, pa.int64()), "_text": pa.array(texts), "_chunk": pa.array([0] * 7, pa.int64())})
    other = rows.take([6, 3, 0, 5, 1, 4, 2])
    settings = {"length": 400, "buckets": 1}
    twice = suffix.common._found_twice(suffix._hashed(rows, **settings), False, False)
    asked = suffix._asked((0,), other, twice, **settings)
    kind = twice.schema.get_field_index("kind")
    wanted = suffix.common._found_indexed(asked, False)
    wanted = wanted.set_column(kind, "kind", pa.array([suffix.INDEX] * wanted.num_rows, pa.int32()))
    segments = suffix._segments((0,), rows, pa.concat_tables([twice, wanted]), **settings)
    found = suffix._sorted(segments.append_column("slices", pa.array([1] * segments.num_rows, pa.int32())), 400)
    ranges = np.array([found["first"].to_pylist(), found["last"].to_pylist()]).T.astype(">i8")
    assert len(ranges)
    told = pa.concat_tables([twice, pa.table([[0] * len(ranges), [0] * len(ranges), [suffix.RANGE] * len(ranges), [r.tobytes() for r in ranges]], schema=twice.schema)])

    def cut(table):
        out = suffix._cut((0,), table, told, **settings).to_pylist()
        return sorted((r["_id"] or 0, r["n_bytes"], r["n_removed"], str(r["spans"]), r["kept"]) for r in out)

    count = collections.Counter(t[k : k + 400] for t in [(t or "").encode() for t in texts] for k in range(len(t) - 399))
    want = []
    for i, t in zip(ids, [(t or "").encode() for t in texts]):
        gone = {p for k in range(len(t) - 399) if count[t[k : k + 400]] > 1 for p in range(k, k + 400)}
        want.append((i or 0, len(t), len(gone), bytes(x for k, x in enumerate(t) if k not in gone)))
    assert cut(rows) == cut(other)
    assert sorted((r[0], r[1], r[2], r[4]) for r in cut(other)) == sorted(want)


def test_suffix_array():
    import random

    rng = random.Random(2)
    for _ in range(200):
        texts = ["".join(rng.choice(rng.choice(["ab", "a", "xyz\x00"])) for _ in range(rng.randrange(6, 40))).encode() for _ in range(rng.randrange(1, 8))]
        strings = [rng.randrange(1, len(t) - 3) for t in texts]
        array, number, starts = suffix.suffix_order(texts, strings)
        found = [(texts[number[a]][a - starts[number[a]] :]) for a in array]
        assert len(found) == sum(strings)
        assert b"\x00" in b"".join(texts) or found == sorted(found)


def test_similar_lines(docs):
    seen, want = [], {}

    def mark(r):
        value = xxhash.xxh64_intdigest((r[1] or "").encode(), 42)
        return value - (1 << 64) if value >> 63 else value

    for r in sorted(set(corpus.rows()), key=lambda r: (r[0] is not None, r[0] or 0, mark(r))):
        parts, kept = (r[1] or "").encode().split(b"\n"), []
        for line in parts:
            s = frozenset(line.lower().split())
            if not (s and any(len(s & o) >= 0.8 * len(s | o) - 1e-9 for o in seen)):
                kept.append(line)
            seen.append(s)
        want[r[0], r[1]] = (len(parts), len(parts) - len(kept), b"\n".join(kept).decode())
    for settings in ({}, {"slice_size": 2}):
        got = lines.without_similar_lines(docs, **settings).collect()
        assert collections.Counter(map(tuple, got)) == collections.Counter((r[0], *want[r[0], r[1]]) for r in corpus.rows())


def test_line_candidates(spark, monkeypatch):
    """Lines that share rare words but are not alike give hardly any candidates, and candidates that fail cost no similar line."""
    counted = collections.defaultdict(list)

    def counting(rows, name, kept=lines.stored):
        rows = kept(rows, name)
        counted[name].append(rows.count())
        return rows

    def removed(parts):
        rows = [(i, line, "en", 1, 1, "", "", 2, "") for i, line in enumerate(parts)]
        return {r["doc_id"]: r["n_removed"] for r in lines.without_similar_lines(corpus.frame(spark, rows)).collect()}

    monkeypatch.setattr(lines, "stored", counting)
    rng = random.Random(8)
    texts = [" ".join(f"w{k}" for k in rng.sample(range(600), 120)) for _ in range(300)]
    assert set(removed(texts).values()) == {0} and sum(counted["lines-pairs"]) < 30
    # So long that no bitmap tells them apart: the nearest candidates are mostly false.
    counted.clear()
    monkeypatch.setattr(lines, "FEW", 1)
    words = [rng.sample(range(3500), 2000) for _ in range(15)]
    words += [rng.sample(w, 1850) + list(range(4000 + 150 * k, 4150 + 150 * k)) for k, w in enumerate(words)]
    sets = [set(w) for w in words]
    want = {i: int(any(len(s & o) >= 0.8 * len(s | o) for o in sets[:i])) for i, s in enumerate(sets)}
    assert removed([" ".join(f"w{k}" for k in w) for w in words]) == want and sum(want.values()) == 15 and counted["lines-open"][0] > 0


def test_line_candidates_of_a_long_list(monkeypatch):
    """A list that is gone through in many blocks gives each line a few candidates, not a few from each block."""
    monkeypatch.setattr(lines, "PAIRS", 100)
    entries = np.zeros(300, lines.ENTRY)
    entries["digest"] = entries["rank"] = np.arange(300)
    entries["size"], entries["open"] = 10, True
    table = pa.table({"lo": [0], "hi": [0], "slices": [1], "entries": [entries.tobytes()]})
    found = lines._candidates(table, 0.8, 2).to_pylist()
    taken = collections.Counter(r["line"] for r in found if r["line"] != r["other"])
    assert taken == {1: 1} | dict.fromkeys(range(2, 300), 2)
    assert {r["line"] for r in found if r["line"] == r["other"]} == set(range(3, 300))
    assert lines._candidates(table, 0.8, None).num_rows == 300 * 299 // 2


def test_empty_tables(nothing):
    assert exact.copy_groups(nothing).collect() == [] and exact.without_copies(nothing).collect() == []
    assert simhash.components(nothing).collect() == [] and simhash.without_near_copies(nothing).collect() == []
    assert substring.repeated_words(nothing).collect() == [] and substring.without_repeats(nothing).collect() == []
    assert suffix.repeated_bytes(nothing).collect() == [] and lines.without_similar_lines(nothing).collect() == []
