"""Text columns against Python's own text methods."""

import hashlib
import re

from pyspark.sql import functions as F

import strings
from passtrail.functions import batch as bx
from passtrail.functions import ir
from passtrail.functions import text as tx

T = F.col("t")


def test_lines_strip_and_counts(spark):
    values = strings.texts(1500)
    got = strings.column(
        spark,
        values,
        {
            "lines": tx.splitlines(T),
            "kept": tx.splitlines(T, keepends=True),
            "rstrip": tx.rstrip(T),
            "strip": tx.strip(T),
            "body": tx.finish_body(T),
            "rest": tx.drop_first_line(T),
            "sha": tx.sha256_hex(T),
            "bytes": tx.byte_count(T),
            "feeds": tx.line_count(T),
            "delta": ir.brace_delta(T),
        },
    )
    for value, row in zip(values, got):
        assert row["lines"] == value.splitlines(), repr(value)
        assert row["kept"] == value.splitlines(keepends=True), repr(value)
        assert row["rstrip"] == value.rstrip(), repr(value)
        assert row["strip"] == value.strip(), repr(value)
        assert row["body"] == value.rstrip() + "\n"
        assert row["rest"] == "".join(value.splitlines(keepends=True)[1:]), repr(value)
        assert row["sha"] == hashlib.sha256(value.encode()).hexdigest()
        assert row["bytes"] == len(value.encode())
        assert row["feeds"] == value.count("\n")
        assert row["delta"] == value.count("{") - value.count("}")


def test_decode_replaces_and_normalises(spark, tmp_path):
    cases = [
        b"plain\r\nnext\rlast", b"\xff", b"a\x80b", b"\xed\xa0\x80", b"\xc0\xaf", b"\xf0\x9f\x98", b"\xe4\xb8\xadok",
        b"\xf4\x90\x80\x80", b"", b"\r\r\n\n\r", "é\x85 ".encode(),
    ]
    rows = spark.createDataFrame(list(enumerate(cases)), "i int, c binary").orderBy("i")
    got = [r.t for r in rows.select(tx.decode_text(F.col("c")).alias("t")).collect()]
    for number, case in enumerate(cases):
        (tmp_path / str(number)).write_bytes(case)
        assert got[number] == (tmp_path / str(number)).read_text(encoding="utf-8", errors="replace"), case


def test_cap_keeps_whole_characters(spark):
    values = strings.texts(400, 25, seed=3)
    caps = [0, 1, 2, 3, 4, 5, 10, 17]
    got = strings.column(spark, values, {str(n): tx.utf8_cap(T, n) for n in caps})
    for value, row in zip(values, got):
        for cap in caps:
            expected = value.encode()[:cap].decode("utf-8", errors="ignore")
            assert row[str(cap)] == expected, (value, cap)


def test_dialects(spark):
    values = strings.texts(600, 20, seed=5, alphabet=["a", "bb", "_", "9", ".", "A", " ", "\xe9", chr(0x301), chr(0x663), "\n", "cir", "x.y"])
    values += [chr(0x1D400) + "ab.cd", chr(0x1F600) + "ab.cd", chr(0x10400) + "_x.yy", "main.cu", "a.bb.cc", "a.b", "z.aa y.aa z.bb", "é.aa", "9a.bb"]
    # Fixed value: dotted operation names.
    pattern = re.compile(r"\b([a-z_][a-z0-9_]*)\.[a-z_][a-z0-9_]+")
    got = strings.column(spark, values, {"d": ir.dialects(T), "short": ir.dialects(T, 6)})
    for value, row in zip(values, got):
        assert row["d"] == sorted({m.group(1) for m in pattern.finditer(value)}), repr(value)
        assert row["short"] == sorted({m.group(1) for m in pattern.finditer(value[:6])}), repr(value)


def test_dialects_beyond_the_cap_and_the_scan_window(spark):
    inside, edge, outside = ["x" * n + " late.op" for n in (100, 199_992, 199_996)]
    got = strings.column(spark, [inside, edge, outside], {"d": ir.dialects(T), "w": ir.dialects(T, 200_000), "c": tx.utf8_cap(T, 50)})
    assert [r["d"] for r in got] == [["late"]] * 3
    assert [r["w"] for r in got] == [["late"], ["late"], []]
    assert all(r["c"] == "x" * 50 for r in got)


def test_headers_and_file_names(spark):
    parts = ["// -----// IR Dump After ", "cir::A", ":", " ", chr(0x2003), "b-c", "\xe99", "(", "m)", "x", "\t", "\x1f", "_"]
    values = strings.texts(500, 8, seed=11, alphabet=parts)
    values += ["// -----// IR Dump After " + v for v in strings.texts(600, 8, seed=12, alphabet=parts[1:])]
    values += ["// -----// IR Dump After cir::A:" + v for v in strings.texts(600, 6, seed=13, alphabet=parts[3:])]
    values += ["// -----// IR Dump Before A: b (", "// -----// IR Dump After A Failed: b", "// -----// IR Dump After A:b("]
    values = ["".join(v.splitlines()) for v in values]
    # Fixed value: the banner line of a dump.
    pattern = re.compile(r"// -----// IR Dump After ([\w:]+):\s*([\w\-]+)\s*\(")
    got = strings.column(
        spark,
        values,
        {
            "is": ir.is_header(T), "c": ir.header_class(T), "p": ir.header_pass(T),
            "f": ir.snapshot_filename(F.lit(3), T), "g": ir.snapshot_filename(F.lit(123), T),
        },
    )
    hits = 0
    for value, row in zip(values, got):
        match = pattern.match(value)
        hits += bool(match)
        assert row["is"] == bool(match), repr(value)
        assert (row["c"], row["p"]) == (match.groups() if match else ("", "")), repr(value)
        slug = re.sub(r"[^\w\-]+", "_", value)
        assert (row["f"], row["g"]) == (f"03_{slug}.mlir", f"123_{slug}.mlir")
    assert hits > 20


def test_run_directory_names(spark):
    values = [
        "a-cuda-20240101-000000", "a-cuda-2-20240101-000000", "x-20240101-000000-20250101-010101", "batch-runs", "-20240101-000000",
        "123-20240101-000000", "a-20240101-00000", "a-20240101-0000000",
    ]
    got = strings.column(
        spark, values, {"n": ir.run_dir_benchmark(T), "t": ir.run_dir_timestamp(T), "is": ir.is_run_dir(T)}
    )
    for value, row in zip(values, got):
        match = re.match(r"^(.+)-(\d{8}-\d{6})$", value)
        assert row["is"] == bool(match)
        assert (row["n"], row["t"]) == (match.groups() if match else ("", ""))


def test_user_functions(spark):
    cases = {
        "": False, "cir.func @main()": True, "cir.func @_ZSt4main": False, "cir.func @_ZNSt4main": True, "cir.func @_ZNSt @MAIN": True,
        "llvm.func @__device_stub_std": True, "llvm.func @cudaLaunchX_std": True, "llvm.func @myKernel_random": True,
        "cir.func @iteration": False, "cir.func @stdout": False, "cir.func @helper": True, "cir.func @OPERATOR": False,
    }
    lines = ["", "func @x", "cir.fun c", "!cir.func<x>", "  llvm.func @y", "llvm.funcir.func", *cases]
    marked = strings.column(spark, lines, {"f": ir.is_function_line(T)})
    assert [r["f"] for r in marked] == [("cir.func" in c or "llvm.func" in c) for c in lines]
    got = strings.column(spark, list(cases), {"u": ir.is_user_function(T), "p": ir.function_priority(T)})
    assert [r["u"] for r in got] == list(cases.values())
    priority = dict(zip(cases, (r["p"] for r in got)))
    assert priority["cir.func @main()"] == 0 and priority["llvm.func @myKernel_random"] == 1
    assert priority["llvm.func @cudaLaunchX_std"] == 2


def test_batch_columns(spark):
    values = strings.texts(200, 40, alphabet=["a", ",", '"', "\n", "\r", ";", " ", "é", "b" * 30])
    got = strings.column(spark, values, {"c": bx.csv_clean(T)})
    for value, row in zip(values, got):
        cleaned = value.replace(",", ";").replace("\n", " ").replace("\r", " ").replace('"', "")
        assert row["c"] == cleaned[:200]
    codes = {0: "success", 1: "driver_error", 2: "compile_fail", 3: "parse_fail", 4: "roundtrip_fail", 5: "partial_kept",
             124: "timeout", 137: "killed", 99: "unknown_99", -1: "unknown_-1"}
    frame = spark.createDataFrame([(c,) for c in codes], "c int")
    assert {r.c: r.s for r in frame.select("c", bx.status_of(F.col("c")).alias("s")).collect()} == codes


def test_globs(spark):
    import fnmatch

    names = ["a-cuda", "a-cuda2", "-cuda", "b-omp", "a.cuda", "[x]-cuda", "ab-cuda"]
    for pattern in ["*-cuda", "?-cuda", "[ab]*", "[!ab]*", "a.cuda", "*", "a*a"]:
        got = strings.column(spark, names, {"m": T.rlike(bx.glob_regex(pattern))})
        assert [r["m"] for r in got] == [fnmatch.fnmatchcase(n, pattern) for n in names], pattern
