"""Functions of texts in blocks against those of the whole text, for random cuts."""

import random

import pytest

import test_functions as whole
from passtrail.operators import block_spans, spans


def cut(rng, text, numbers):
    """Numbered blocks of whole lines, some of them empty of functions, with gaps between the numbers."""
    lines = text.splitlines(keepends=True)
    out, number = [], 0
    while lines:
        size = rng.choice([1, 1, 2, 3, 5, 9, 40])
        out.append((number, "".join(lines[:size])))
        lines, number = lines[size:], number + rng.randrange(1, numbers)
    return out


def expected(texts):
    out = set()
    for run, text in texts.items():
        lines = text.splitlines()
        for k, (a, b) in enumerate(whole.expected_spans(lines)):
            out.add((run, k, a, b, lines[a].strip(), *whole.KINDS[lines[a].strip()], "\n".join(lines[a : b + 1])))
    return out


def texts():
    rng = random.Random(31)
    out = {k: whole.random_text(rng, rng.choice([5, 40, 200])) for k in range(250)}
    deep = ["cir.func @outer {"] + ["llvm.func @inner {", "{", "}"] * 200 + ["}"] * 201 + ["cir.func @after()", "cir.func @open {", "op"]
    out[1000] = "\n".join(deep)
    out[1001] = "\n".join(["llvm.func @inner {"] * 90 + ["}"] * 40)
    out[1002] = "\n".join(["}"] * 50 + ["cir.func @main_1 {"] + ["{", "}"] * 60 + ["}", "cir.func @decl()"])
    return out


@pytest.mark.parametrize("width, levels, numbers", [(4096, 3, 5), (4, 6, 2), (3, 9, 40)])
def test_random_cuts(spark, width, levels, numbers):
    rng = random.Random(width)
    data = texts()
    rows = [(run, n, t) for run, text in data.items() for n, t in cut(rng, text, numbers)]
    rng.shuffle(rows)
    blocks = spark.createDataFrame(rows, "run_id int, block long, text string").repartition(5)
    found = block_spans.spans_in_blocks(blocks, width=width, levels=levels).collect()
    want = expected(data)
    assert {tuple(r)[:7] for r in found} == {w[:7] for w in want} and len(found) == len(want)
    numbered = {run: sorted(n for r, n, _ in rows if r == run) for run in data}
    assert all(r.start_block in numbered[r.run_id] and r.end_block in numbered[r.run_id] for r in found)


def test_bodies(spark):
    rng = random.Random(8)
    data = texts()
    blocks = spark.createDataFrame([(r, n, t) for r, text in data.items() for n, t in cut(rng, text, 3)], "run_id int, block long, text string")
    got = block_spans.functions_in_blocks(blocks, width=8)
    assert {(*tuple(r)[:7], r.body) for r in got.collect()} == expected(data)
    assert got.filter("n_lines <> end_line - start_line + 1").count() == 0
    one = spans.functions(blocks.limit(0).selectExpr("run_id", "text as ir_text"))
    assert set(one.columns) == set(got.columns)


def test_no_blocks(spark):
    empty = spark.createDataFrame([], "run_id int, block long, text string")
    assert block_spans.functions_in_blocks(empty).collect() == []
    quiet = spark.createDataFrame([(1, 0, None), (1, 1, ""), (2, 0, "} {\n")], "run_id int, block long, text string")
    assert block_spans.functions_in_blocks(quiet).collect() == []


@pytest.mark.parametrize("most_bytes", [0, 60, 400, 3000, 1 << 20])
def test_bodies_of_joined_blocks(spark, most_bytes):
    """Whatever number of blocks is joined, some texts are one block and some are several."""
    rng = random.Random(most_bytes)
    data = texts()
    rows = [(r, n - 3, t) for r, text in data.items() for n, t in cut(rng, text, 3)]
    rows += [(2000, 0, "é\ncir.func @open {\n"), (2000, 1 << 40, "}\nop"), (None, 0, "cir.func @a()")]
    blocks = spark.createDataFrame(rows, "run_id int, block long, text string").repartition(5)
    got = block_spans.functions_in_blocks(blocks, width=8, most_bytes=most_bytes)
    found = [(*tuple(r)[:7], r.body) for r in got.collect()]
    want = expected({**data, 2000: "é\ncir.func @open {\n}\nop"})
    assert set(found) == want and len(found) == len(want)
    merged = block_spans.merged_blocks(blocks, ["run_id"], "block", "text", most_bytes)
    longest = max(len(t.encode()) for _, _, t in rows)
    assert all(len(r.text.encode()) <= max(most_bytes, longest) for r in merged.collect())


def test_small_blocks_are_not_rows_of_every_pass(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(r, n, t) for r, text in texts().items() for n, t in cut(rng, text, 3)]
    kept = []

    def counted(found, name, keep=block_spans.stored):
        kept.append(keep(found, name))
        return kept[-1]

    monkeypatch.setattr(block_spans, "stored", counted)
    block_spans.functions_in_blocks(spark.createDataFrame(rows, "run_id int, block long, text string")).collect()
    assert sum(k.count() for k in kept) < 3 * len(texts()) < len(rows)


def test_repeated_block_numbers_are_an_error(spark):
    twice = spark.createDataFrame([(1, 0, "cir.func @a()\n"), (1, 0, "cir.func @a()\n")], "run_id int, block long, text string")
    with pytest.raises(Exception, match="block number twice"):
        block_spans.functions_in_blocks(twice).collect()
