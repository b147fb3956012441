"""Function spans, packing and prompts against a restatement with explicit line numbers."""

import itertools
import random

import pyarrow as pa
import pytest

from passtrail.operators import packing, scan, spans
from pyspark.sql import functions as F

LINES = [
    "cir.func @main_1 {", "  llvm.func @helper {", "cir.func @k_kernel() {", "llvm.func @_ZSt3 {", "cir.func @decl()",
    "!alias = !cir.func<x>", "llvm.func @one { }", "}cir.func @neg", "  op", "  }", "}", "}}", "{", "", " { } {", "cir.func @it_ratio {",
    "llvm.func @cudaLaunch_x {", "}",
]
# What each function line in these tests is: user code or not, and its rank among user code.
KINDS = {
    "cir.func @main_1 {": (True, 0),
    "cir.func @k_kernel() {": (True, 1),
    "llvm.func @helper {": (True, 2),
    "cir.func @decl()": (True, 2),
    "!alias = !cir.func<x>": (True, 2),
    "llvm.func @one { }": (True, 2),
    "}cir.func @neg": (True, 2),
    "llvm.func @cudaLaunch_x {": (True, 2),
    "cir.func @a { }": (True, 2),
    "cir.func @open {": (True, 2),
    "cir.func @outer {": (True, 2),
    "llvm.func @inner {": (True, 2),
    "cir.func @after()": (True, 2),
    "llvm.func @_ZSt3 {": (False, 2),
    "cir.func @it_ratio {": (False, 2),
}


def random_text(rng, longest=40):
    lines = [rng.choice(LINES) for _ in range(rng.randrange(longest))]
    return "\n".join(lines) + rng.choice(["", "\n", "\n\n"])


def expected_spans(lines):
    out, open_at, depth = [], None, 0
    for number, line in enumerate(lines):
        if open_at is None and "cir.func" not in line and "llvm.func" not in line:
            continue
        if open_at is None:
            open_at, depth = number, 0
        depth += line.count("{") - line.count("}")
        if depth <= 0:
            out.append((open_at, number))
            open_at = None
    return out + ([(open_at, len(lines) - 1)] if open_at is not None else [])


def expected_signal(text, max_lines):
    """Where each body begins follows from the lengths before it; the budget then says what is whole, cut or left out."""
    lines = text.splitlines()
    found = expected_spans(lines)
    users = [(KINDS[lines[a].strip()][1], n, "\n".join(lines[a : b + 1]).splitlines()) for n, (a, b) in enumerate(found) if KINDS[lines[a].strip()][0]]
    if not users:
        return "\n".join(lines[:max_lines]), 0, len(found)
    head = "\n".join(lines[: found[0][0]]).splitlines()
    top = head[:8] + [f"// ... ({len(head) - 8} more type/attr declarations)"] * (len(head) > 8) + [""]
    bodies = [body for _, _, body in sorted(users, key=lambda u: u[:2])]
    begins = [len(top), *itertools.accumulate((len(b) + 1 for b in bodies), initial=len(top))][1:-1]
    left = [max_lines - at for at in begins]
    shown = [b if room >= len(b) else b[:room] + ["    // ... (function body truncated to fit budget)"] for b, room in zip(bodies, left) if room > 0]
    out = top + [line for b in shown for line in (*b, "")]
    missing = len(bodies) - len(shown)
    return "\n".join(out + [f"// ... ({missing} more user functions omitted for length)"] * (missing > 0)), len(bodies), len(found)


def corpus(spark, values):
    rows = [("b", "p", n, value) for n, value in enumerate(values)]
    return spark.createDataFrame(
        rows, "benchmark_name string, pass_name string, pass_index int, ir_text string"
    ).repartition(4)


@pytest.fixture(scope="module")
def values():
    rng = random.Random(9)
    many = "\n".join(["cir.func @a { }"] * 1300 + ["cir.func @open {", "", "{"])
    nested = "\n".join(["cir.func @outer {"] + ["llvm.func @inner {"] * 600 + ["}"] * 601 + ["cir.func @after()"])
    return ["", "no functions\nat all\n", many, nested] + [random_text(rng) for _ in range(700)]


def test_spans(spark, values):
    got = (
        corpus(spark, values)
        .select("pass_index", scan.span_column(F.col("ir_text")).alias("s"))
        .orderBy("pass_index")
        .collect()
    )
    for value, row in zip(values, got):
        assert [(s.start, s.end) for s in row.s] == expected_spans(value.splitlines()), value[:300]


def test_scan_numbers_lines_as_python_does():
    rng = random.Random(3)
    breaks = ["\n", "\r\n", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x85", "\u2028", "\u2029"]
    pieces = [*LINES, "\xe9", "c ir.func", "cir.fun", "llvm.funcir.func {", "cir", "\u2019{", "\xc2"]
    texts = ["".join(rng.choice(pieces) + rng.choice(breaks) for _ in range(rng.randrange(12))) + rng.choice(["", *LINES]) for _ in range(2000)]
    # What a batch joins must not make a line end or a marker.
    texts += ["a\r", "\nb {", "cir", ".func {", "", "cir.fu", "nc {", "cir.func @x {\r", "", "\n}"]
    for text, found in zip(texts, scan.spans_of([t.encode() for t in texts])):
        assert found == expected_spans(text.splitlines()), text
    assert scan.spans_of([]) == [] and scan.spans_of([b""]) == [[]]


def test_null_texts(spark):
    rows = spark.createDataFrame([("b", "p", 1, None), ("b", "p", 2, "cir.func {")], "benchmark_name string, pass_name string, pass_index int, ir_text string")
    assert [r.pass_index for r in spans.functions(rows).collect()] == [2]
    assert {r.pass_index: r.s is None for r in rows.select("pass_index", scan.span_column(F.col("ir_text")).alias("s")).collect()} == {1: True, 2: False}


def test_function_rows(spark, values):
    rows = spans.functions(corpus(spark, values)).orderBy("pass_index", "ordinal").collect()
    got = {}
    for row in rows:
        got.setdefault(row.pass_index, []).append((row.ordinal, row.signature, row.body, row.n_lines, row.is_user))
    for number, value in enumerate(values):
        lines = value.splitlines()
        want = [
            (k, lines[s].strip(), "\n".join(lines[s : e + 1]), e - s + 1, KINDS[lines[s].strip()][0])
            for k, (s, e) in enumerate(expected_spans(lines))
        ]
        assert got.get(number, []) == want, value[:300]


@pytest.mark.parametrize("max_lines", [0, 1, 2, 5, 12, 200])
def test_signal(spark, values, max_lines):
    rows = packing.signal(corpus(spark, values), max_lines).orderBy("pass_index").collect()
    for value, row in zip(values, rows):
        assert (row.signal, row.n_user, row.n_total) == expected_signal(value, max_lines), value[:300]


def test_counts_and_prompts(spark, values):
    counts = spans.function_counts(corpus(spark, values)).orderBy("pass_index").collect()
    prompts = packing.prompts(corpus(spark, values), 30).orderBy("pass_index").collect()
    for value, count, prompt in zip(values, counts, prompts):
        signal, n_user, n_total = expected_signal(value, 30)
        assert (count.n_user, count.n_total) == (n_user, n_total)
        assert [m.role for m in prompt.messages] == ["system", "user"]
        assert prompt.messages[0].content == packing.SYSTEM_PROMPT
        assert f"```mlir\n{signal}\n```" in prompt.messages[1].content
        assert f"Kept {n_user} user functions out of {n_total} total" in prompt.messages[1].content


def test_late_filter_gives_the_same_rows(spark, values):
    rows = packing.signal(corpus(spark, values), 12)
    assert rows.filter("n_user > 2").count() == sum(expected_signal(v, 12)[1] > 2 for v in values)


def test_negative_budget_is_refused(spark, values):
    with pytest.raises(ValueError):
        packing.signal(corpus(spark, values), -1)


def test_a_batch_is_scanned_in_slices(spark, monkeypatch):
    rng = random.Random(12)
    texts = [None, "", *(random_text(rng, 400) for _ in range(300)), "cir.func @a() {\n" + "x" * 2_000_000 + "\n}", *(random_text(rng, 400) for _ in range(300)), None]
    raw = [(t or "").encode() for t in texts]
    want, seen = scan.spans_of(raw), []

    def spans_of(part, found=scan.spans_of):
        seen.append(part)
        return found(part)

    monkeypatch.setattr(scan, "spans_of", spans_of)
    got = scan._arrays(pa.array(texts)).to_pylist()
    assert [None if t is None else [{"start": a, "end": b} for a, b in w] for t, w in zip(texts, want)] == got
    assert [t for part in seen for t in part] == raw
    assert all(len(part) == 1 or sum(map(len, part)) <= 1 << 20 for part in seen) and scan._arrays(pa.array([], pa.string())).to_pylist() == []
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10_000)
    scan.with_spans(spark.range(1).selectExpr("'a' as t"), "t", "s")
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "1000"
