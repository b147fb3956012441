"""Archives, tokens, scores, fingerprints, packing and the pipeline."""

import collections
import hashlib
import random
import zlib

import corpus
import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from passtrail.llm import bpe, common, packing, toxicity, warc, winnow
from passtrail.operators.stores import new_folder

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
PAGES = "page_id long, url string, html string, content string, error int"


@pytest.fixture(scope="module")
def pages(spark):
    rng = random.Random(1)
    body = "A" * 99 + "é"
    rows = [
        (5, "http://a/ b\r\nWARC-Type: x", body), (3, None, body), (3, "u", body), (7, "u", None), (8, "u", ""), (9, "u", "short"),
        (10, "u", "short"), (None, "u", body), (11, "ü", "x" * 100), (12, "ü", "x" * 100), (13, "\x00", "\r\n\r\nWARC/1.1\r\n\r\n" * 20),
        (14, "u", "z" * 300_000), *((k, "u", corpus.words(rng, rng.randrange(300))) for k in range(20, 120)),
    ]
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], PAGES).repartition(2)


@pytest.mark.parametrize("archive_bytes", [500, 32 << 20])
def test_archives(spark, pages, archive_bytes):
    folder = new_folder(spark, "test-archives")
    manifest = warc.write_archives(warc.page_records(pages), folder, archive_bytes).collect()
    assert sum(r.records for r in manifest) == pages.count()
    back = warc.read_archives(warc.load_archives(spark, folder), strict=True).collect()
    payload = {r.page_id: (r.html or "").encode() for r in pages.collect()}
    first = {}
    for i, p in payload.items():
        if i is not None:
            first[p] = min(i, first.get(p, i))
    assert len(back) == pages.count() and not any(r.error for r in back)
    for r in back:
        i = int(r.record_id[9:]) if r.record_id != "urn:page:null" else None
        p = payload[i]
        again = len(p) >= 100 and i != first[p]
        assert (r.record_type, r.refers_to_id) == (("revisit", f"urn:page:{first[p]}") if again else ("response", None))
        assert (r.payload_length, r.payload_digest) == (len(p), hashlib.sha256(p).hexdigest())
        assert r.payload is None if again else bytes(r.payload) == p


def test_broken_archives(spark, pages):
    content = warc.write_archives(warc.page_records(pages)).first().content
    good = warc.record("urn:page:1", "response", b"payload", hashlib.sha256(b"payload").hexdigest(), "u")
    archive = warc.Archive([])
    for data in (good, good[:-1], good.replace(b"payload", b"pazload"), good.replace(b"WARC-Date", b"X-Date"), good.replace(b"WARC/1.1", b"WARC/2.0"), good + good, b"junk", b""):
        archive.add(data)
    rows = [("cut", bytes(content[:-3]), 1), ("junk", b"junk", 1), ("empty", b"", 1), ("null", None, 1), ("bad", archive.content(), 1)]
    got = warc.read_archives(spark.createDataFrame(rows, "name string, content binary, payload int")).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r.archive].append(r.error)
    assert by["cut"][-1] == "the frame: it is cut off" and not any(by["cut"][:-1])
    assert by["junk"] == [by["junk"][0]] and by["junk"][0] and "empty" not in by and "null" not in by
    assert by["bad"][0] is None and all(by["bad"][1:]) and len(by["bad"]) == 8


def test_no_pages(spark):
    nothing = spark.createDataFrame([], PAGES)
    assert warc.read_archives(warc.write_archives(warc.page_records(nothing))).collect() == []


@pytest.mark.parametrize("part_chars", [100, bpe.PART_CHARS])
def test_ids_and_texts(docs, part_chars):
    tokenizer = Tokenizer.from_file(BYTES)
    got = bpe.decode(bpe.encode(docs, BYTES, part_chars=part_chars), BYTES).collect()
    want = collections.Counter()
    for r in corpus.rows():
        ids = tokenizer.encode(r[1] or "", add_special_tokens=False).ids
        want[r[0], len(ids), tuple(ids), tokenizer.decode(ids, skip_special_tokens=False)] += 1
    assert collections.Counter((r.doc_id, r.n_tokens, tuple(np.frombuffer(r.ids, np.uint32).tolist()), r.text) for r in got) == want


def test_tree_on_hard_texts():
    tokenizer, joiner, rng = Tokenizer.from_file(BYTES), bpe.Joiner(BYTES), random.Random(3)
    pieces = ["a", "the", "ing", " ", "  ", "\n", "'s", "'re", "'", "1", "!?", "é", "日本", "\U0001f642", "<|endoftext|>", "<|endo", "\x1c", "A"]
    for _ in range(400):
        kind = rng.random()
        if kind < 0.4:
            text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 500)))
        elif kind < 0.7:
            text = "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(300, 2000)))
        else:
            text = rng.choice(pieces) * rng.randrange(50, 800)
        parts = [(h.encode(), joiner.encode(h)) for h in bpe.halves(text, rng.choice([20, 60, 300]))]
        assert (joiner.tree(parts)[1] & (bpe.CUT - 1)).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_packing(docs):
    tokenizer = Tokenizer.from_file(WORDS)
    want = {}
    for r in corpus.rows():
        want[r[0], tuple(tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [1])] = 0
    pieces = packing.pack(docs, WORDS, size=256, most_open=4).collect()
    sequences, total = collections.defaultdict(list), 0
    for p in pieces:
        ids = np.frombuffer(p.ids, np.uint32).tolist()
        whole = [k for k in want if k[0] == p.doc_id and list(k[1][p.start : p.start + p.length]) == ids and len(k[1]) == p.doc_tokens]
        assert whole and p.ids_crc32 == zlib.crc32(p.ids) and p.length == len(ids)
        sequences[p.sequence_id].append((p.offset, p.length))
        total += p.length
    assert total == sum(len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in corpus.rows())
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at == 256 or at & (at - 1) == 0


def test_levels_choose_the_smallest_sum_of_squares():
    rng, size = random.Random(5), 20
    levels, counts = packing.Levels(size), [0] * (size + 1)
    for n in range(400):
        length = rng.randrange(1, size)

        def squares(level):
            after = list(counts)
            if level:
                after[level] -= 1
            after[level + length] += 1
            return sum(c * c for c in after[1:size])

        allowed = [h for h in range(size - length + 1) if h == 0 or counts[h]]
        best = min(squares(h) for h in allowed)
        level = max(h for h in allowed if squares(h) == best)
        levels.place(length, (n, length, 0, length, b"x" * length))
        counts[level] -= bool(level)
        counts[level + length] += 1
        assert [len(w) for w in levels.windows][1:size] == counts[1:size]


def winnowed(text, gram=winnow.GRAM, window=winnow.WINDOW):
    """Window by window: the smallest hash, of equal ones the rightmost. A gram's hash is taken from a text that is that gram."""
    if not text:
        return []
    grams = [text[k : k + gram] for k in range(max(1, len(text) - gram + 1))]
    hashes = [int(winnow.chosen(g, gram, window)[0][0]) for g in grams]
    kept = set()
    for begin in range(max(1, len(hashes) - window + 1)):
        places = range(begin, min(begin + window, len(hashes)))
        least = min(hashes[k] for k in places)
        kept.add(max(k for k in places if hashes[k] == least))
    return [(hashes[k], k) for k in sorted(kept)]


def mark(text):
    value = xxhash.xxh64_intdigest((text or "").encode(), 42)
    return value - (1 << 64) if value >> 63 else value


@pytest.mark.parametrize("chunk_bytes, unnamed", [(5_000, 0), (4_000, 60), (8 << 20, 3)])
def test_fingerprints(spark, chunk_bytes, unnamed):
    rng = random.Random(7)
    data = [r for r in corpus.rows() if len(r[1] or "") < 4000] + [(None, corpus.words(rng, 40), "en", 1, 1, "", "", 2, "") for _ in range(unnamed)]
    rows = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, mark(r[1])), reverse=True)
    known = {t: winnowed(t) for t in {r[1] or "" for r in rows}}
    want = collections.Counter()
    for k, row in enumerate(rows):
        text, after = row[1] or "", rows[(k + 1) % len(rows)][1] or ""
        changed = text[: len(text) - len(text) // 3] + after[: len(text) // 3]
        prints, other, following = known[text], winnowed(changed), known[after]
        sets = [{h for h, _ in p} for p in (prints, other, following)]
        near = [len(sets[0] & s) / len(sets[0] | s) if sets[0] | s else 1.0 for s in sets[1:]]
        packed = ["".join(f"{h:08x}" for h, _ in p) for p in (prints, other)]
        want[row[0], len(text), hashlib.sha256(changed.encode()).hexdigest(), *packed, *near, tuple(p for _, p in prints)] += 1
    got = winnow.edits(corpus.frame(spark, data), chunk_bytes=chunk_bytes).collect()
    assert collections.Counter((*tuple(r)[:7], tuple(r.positions)) for r in got) == want


def test_kept_hashes_and_positions(spark):
    texts = ["", None, "short", "a" * 50, "abcabcabc" * 9, "éü\U0001f642 mixed text " * 5]
    docs = spark.createDataFrame([(k, t, "old", "x.y") for k, t in enumerate(texts)], "doc_id long, text string, prints string, `a.b` string")
    got = winnow.fingerprints(docs, gram=4, window=5)
    assert got.columns == ["doc_id", "text", "a.b", "prints"]
    for r in got.collect():
        assert [(p.hash, p.position) for p in r.prints] == winnowed(texts[r.doc_id] or "", 4, 5) and r["a.b"] == "x.y"


def test_chunks_follow_the_order_and_split_hot_ids(spark):
    rng = random.Random(3)
    rows = [(None if k % 3 == 0 else 77 if k % 3 == 1 else rng.randrange(-1000, 1000), rng.getrandbits(64) - (1 << 63)) for k in range(6000)]
    docs = spark.createDataFrame(rows, "id long, mark long").repartition(3)
    deal = common.placed_chunk(docs, "id", "mark", 30)
    got = sorted((r.id is not None, r.id or 0, r.mark, r.chunk) for r in docs.withColumn("chunk", deal(docs["id"], docs["mark"])).collect())
    chunks = [g[3] for g in got]
    sizes = collections.Counter(chunks)
    assert chunks == sorted(chunks) and max(sizes.values()) < 500 and len(sizes) > 25


def test_shared_passages_share_a_hash():
    rng = random.Random(8)
    for _ in range(50):
        passage = "".join(rng.choice("abc é\U0001f642") for _ in range(winnow.GRAM + winnow.WINDOW - 1))
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randrange(200))) for _ in range(2))
        (ha, pa), (hb, pb) = winnow.chosen(a + passage + b), winnow.chosen(b + passage)
        ia, ib = dict(zip(ha.tolist(), pa.tolist())), dict(zip(hb.tolist(), pb.tolist()))
        assert any(ia[h] - len(a) == ib[h] - len(b) for h in ia.keys() & ib.keys())


@pytest.fixture(scope="module")
def judged(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for k in range(1200):
        bad = k % 4 == 0
        text = corpus.words(rng, rng.randrange(20, 120)).split()
        if bad:
            text.insert(rng.randrange(len(text)), rng.choice(["horrid", "vile"]))
        rows.append((k, " ".join(text), "en", None, 1, "clash", "clash", 2, "clash"))
        labels.append((k, None if k % 50 == 7 else int(bad)))
    rows += [(5000, None, "en", None, 1, "", "", 2, ""), (5001, "", "en", None, 1, "", "", 2, ""), (None, "you vile thing", "en", None, 1, "", "", 2, "")]
    labels += [(9999, 1), (None, 1), (3, 0)]
    return corpus.frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_scores(judged):
    docs, labels = judged
    got = {r.doc_id: r for r in toxicity.judged(docs, labels).collect()}
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    assert all(r.held_out == (i is not None and zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    test = [r for i, r in got.items() if r.held_out and i < 1200]
    right = sum(r.predicted == (r.doc_id % 4 == 0) for r in test)
    assert right >= 0.97 * len(test) and len(test) > 150
    assert got[5000].score == got[5001].score and got[None].predicted == 1


def test_scores_without_labels(spark, judged, nothing):
    docs, labels = judged
    assert {r.score for r in toxicity.judged(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity.judged(nothing, labels).collect() == []
    left = toxicity.without_toxic(docs, labels)
    assert left.columns == docs.columns and 800 < left.count() < 1000


def test_no_documents(nothing):
    assert bpe.encode(nothing, BYTES).collect() == [] and packing.pack(nothing, WORDS).collect() == [] and winnow.edits(nothing).collect() == []


def test_pipeline(spark, tmp_path):
    """Stage by stage on a table with planted cases."""
    import corpus_pipeline

    rng = random.Random(9)
    passage, original = corpus.words(rng, 60), corpus.words(rng, 400).split()
    texts = {k: corpus.words(rng, 120) for k in range(300)}
    texts |= {300: texts[5].replace(" ", "\n"), 301: " ".join(original), 302: " ".join(["new", *original[1:]]), 303: passage + " " + corpus.words(rng, 50), 304: corpus.words(rng, 50) + " " + passage}
    texts |= {k: corpus.words(rng, 60) + " vile" for k in range(400, 700)}
    spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, int(k >= 400)) for k in [*range(200), *range(400, 650)]], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, str(tmp_path)), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept.append({r.doc_id for r in docs.select("doc_id").collect()})
    assert kept[0] == set(range(305)) and kept[1] == kept[0] - {300} and kept[2] == kept[1] - {302} and kept[3] == kept[2]
    left = {r.doc_id: r.text for r in docs.collect()}
    assert passage in left[303] and passage not in left[304] and left[304] == " ".join(texts[304].split()[:50])
    assert all(left[k] == texts[k] for k in range(300))
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {p.doc_id for p in pieces} == kept[3]
    tokenizer = Tokenizer.from_file(WORDS)
    assert sum(p.length for p in pieces) == sum(len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for t in left.values())
