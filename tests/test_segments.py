"""Segmentation, chain and validity against a line-by-line restatement."""

import hashlib
import json
import random
import re

from pyspark.sql import functions as F

from passtrail.operators import batch, segments, validity
from passtrail.operators.scale import previous_by_index, running_total_before
from passtrail.sinks.tables import to_manifests
from passtrail.sources import runs, streams

# Fixed value: the banner line of a dump.
HEADER = re.compile(r"// -----// IR Dump After ([\w:]+):\s*([\w\-]+)\s*\(")
LINES = [
    "// -----// IR Dump After cir::A: cir-a (m) //----- //", "// -----// IR Dump After Flat: flat_b(", "text", "", "  ", "}",
    "// -----// IR Dump Before B: b (m)", "// -----// IR Dump After B Failed: b", " // -----// IR Dump After C: c (m)",
    "// -----// IR Dump After no-colon (m)", "\xe9\xa0",
]
ENDS = ["\n", "\n", "\n", "\x0b", "\x1c", "\x85", chr(0x2028), ""]


def expected_snapshots(stream):
    found = []
    for line in stream.splitlines(keepends=True):
        header = HEADER.match(line)
        if header:
            found.append([header[1], header[2], ""])
        elif found:
            found[-1][2] += line
    return [(c, p, body.rstrip() + "\n") for c, p, body in found]


def random_stream(rng):
    return "".join(rng.choice(LINES) + rng.choice(ENDS) for _ in range(rng.randrange(14)))


def test_whole_streams(spark):
    rng = random.Random(1)
    cases = ["", "no header\n", LINES[0], LINES[0] + "\n" + LINES[1], "\n" + LINES[0] + "\n\n \n"]
    cases += [random_stream(rng) for _ in range(500)]
    frame = spark.createDataFrame(list(enumerate(cases)), "run_id int, stream string").repartition(4)
    got = {}
    for row in segments.segment_streams(frame).orderBy("run_id", "index").collect():
        got.setdefault(row.run_id, []).append(row)
    for number, stream in enumerate(cases):
        want = expected_snapshots(stream)
        rows = got.get(number, [])
        assert [(r.pass_class, r.pass_name, r.body) for r in rows] == want, repr(stream)
        assert [r["index"] for r in rows] == list(range(len(want)))
        parent = None
        for row in rows:
            assert row.sha256 == hashlib.sha256(row.body.encode()).hexdigest()
            assert (row.bytes, row.lines) == (len(row.body.encode()), row.body.count("\n"))
            assert row.parent_sha256 == parent
            assert row.filename == f"{row['index']:02d}_{row.pass_name}.mlir"
            parent = row.sha256


def test_blocks_give_the_same_snapshots(spark):
    rng = random.Random(2)
    cases, blocks = [], []
    for run in range(120):
        lines = random_stream(rng).splitlines(keepends=True)
        cases.append("".join(lines))
        number = 0
        while lines:
            size = rng.randrange(1, 4)
            blocks.append((run, number, "".join(lines[:size])))
            lines, number = lines[size:], number + rng.randrange(1, 9000)
    frame = spark.createDataFrame(blocks, "run_id int, block long, text string").repartition(4)
    got = {}
    for row in segments.segment_blocks(frame).orderBy("run_id", "index").collect():
        got.setdefault(row.run_id, []).append((row.pass_class, row.pass_name, row.body))
    for run, stream in enumerate(cases):
        assert got.get(run, []) == expected_snapshots(stream), repr(stream)


def test_bodies_in_blocks_are_folded(spark):
    """Sizes and hashes are of whole bodies, whatever is kept of them, and blank pieces at the end of a body are not part of it."""
    rng = random.Random(21)
    blocks, want = [], {}
    for run in range(60):
        lines, number = random_stream(rng).splitlines(keepends=True) + [" \n", "\u2028"] * rng.randrange(4), 0
        want[run] = expected_snapshots("".join(lines))
        for line in lines:
            blocks.append((run, number, line))
            number += 1
    frame = spark.createDataFrame(blocks, "run_id int, block long, text string").repartition(3)
    for cap in (None, 0, 5):
        got = {}
        for r in segments.segment_blocks(frame, cap_bytes=cap).orderBy("run_id", "index").collect():
            got.setdefault(r.run_id, []).append((r.pass_class, r.pass_name, r.bytes, r.lines, r.sha256, r.body))
        for run, found in want.items():
            expected = []
            for c, p, body in found:
                data = body.encode()
                kept = data if cap is None else data[:cap].decode(errors="ignore").encode()
                expected.append((c, p, len(data), body.count("\n"), hashlib.sha256(data).hexdigest(), kept.decode()))
            assert got.get(run, []) == expected, (run, cap)


def test_one_shuffle_of_texts(spark):
    frame = spark.createDataFrame([(1, 0, LINES[0] + "\nx\n")], "run_id int, block long, text string")
    plan = segments.segment_blocks(frame)._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning(run_id" in line and "index" in line]
    assert len(shuffles) == 1 and "collect_list" not in plan


def test_no_snapshot_is_lost_when_the_scan_is_planned_anew(spark, tmp_path):
    folder = tmp_path / "run"
    folder.mkdir()
    count = 20_000
    text = "".join(f"{LINES[0]}\nbody {n} {'x' * (n % 500)}\n" for n in range(count))
    (folder / "snapshot-stream.txt").write_text(text)
    settings = {"spark.sql.leafNodeDefaultParallelism": "2", "spark.sql.files.maxPartitionBytes": "4m"}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        blocks = streams.read_stream_blocks(spark, str(tmp_path))
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "9")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700k")
        found = segments.segment_blocks(blocks)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "300k")
        bodies = found.select("index", "body").collect()
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert sorted((r["index"], r["body"].split()[1]) for r in bodies) == [(n, str(n)) for n in range(count)]


def test_large_files_are_read_in_blocks(spark, tmp_path):
    rng = random.Random(3)
    cases = {f"r{n}": random_stream(rng) for n in range(40)}
    cases["start"] = LINES[0] + "\nx\n" + LINES[1] + "\ny"
    cases["windows"] = "pre\r\n" + LINES[0] + "\r\nbody\r\n" + LINES[1] + "\r\nlast\r\n"
    cases["looks"] = "A: b (\n" + LINES[0] + "\nx\n"
    cases["long"] = "".join(LINES[n % 3] + "\n" + "z" * 40 + "\n" for n in range(400))
    for name, stream in cases.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "snapshot-stream.txt").write_bytes(stream.encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        blocks = streams.read_stream_blocks(spark, str(tmp_path))
        assert streams.stream_records(spark, f"{tmp_path}/long").rdd.getNumPartitions() > 4
        rows = segments.segment_blocks(blocks).orderBy("run_id", "index").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    got = {}
    for row in rows:
        got.setdefault(row.run_id, []).append((row.pass_class, row.pass_name, row.body))
    whole = streams.read_streams(spark, str(tmp_path))
    by_file = {}
    for row in segments.segment_streams(whole).orderBy("run_id", "index").collect():
        by_file.setdefault(row.run_id, []).append((row.pass_class, row.pass_name, row.body))
    for name, stream in cases.items():
        want = expected_snapshots(stream.replace("\r\n", "\n"))
        assert got.get(name, []) == want, (name, stream)
        assert by_file.get(name, []) == want, (name, stream)


def test_running_total_in_small_blocks(spark):
    rng = random.Random(4)
    rows = [("hot", n, rng.randrange(5)) for n in range(700)] + [("k%d" % (n % 5), n * 37, 1) for n in range(100)]
    frame = spark.createDataFrame(rows, "k string, o long, v int").repartition(4)
    got = {(r.k, r.o): r.t for r in running_total_before(frame, ["k"], "o", "v", "t", width=4).collect()}
    for key in {k for k, _, _ in rows}:
        total = 0
        for _, order, value in sorted(r for r in rows if r[0] == key):
            assert got[key, order] == total
            total += value


def test_previous_by_index_across_blocks(spark):
    rows = [("hot", n, f"h{n}") for n in range(50)] + [("b", n, f"b{n}") for n in range(7)] + [("c", 0, "c0")]
    frame = spark.createDataFrame(rows, "k string, i int, v string").repartition(4)
    got = {(r.k, r.i): r.p for r in previous_by_index(frame, ["k"], "i", "v", "p", width=3).collect()}
    assert len(got) == len(rows)
    assert all(got[k, i] == (f"{k[0]}{i - 1}" if i else None) for k, i, _ in rows)


def test_outcomes_and_status(spark):
    log = [
        ("r1", 0, "OK   00_a.mlir"), ("r1", 1, "DROP 01_b.mlir (roundtrip failed, exit 3)"),
        ("r1", 2, "----- first 10 lines of stderr -----"), ("r1", 3, "error: bad"), ("r2", 0, "OK   00_a.mlir"),
        ("r3", 0, "DROP 00_a.mlir (roundtrip failed, exit 134)"),
    ]
    outcomes = validity.roundtrip_outcomes(spark.createDataFrame(log, "run_id string, line_no int, line string"))
    found = {(r.run_id, r.filename): (r.outcome, r.exit_code) for r in outcomes.collect()}
    assert found["r1", "01_b.mlir"] == ("DROP", 3) and found["r2", "00_a.mlir"] == ("OK", None) and len(found) == 4
    snapshots = spark.createDataFrame(
        [("r1", 0, "00_a.mlir"), ("r1", 1, "01_b.mlir"), ("r2", 0, "00_a.mlir"), ("r3", 0, "00_a.mlir")],
        "run_id string, index int, filename string",
    )
    annotated = validity.annotate_roundtrip(snapshots, outcomes)
    counts = validity.kept_dropped(annotated)
    runs_seen = spark.createDataFrame([("r1", 0), ("r2", 0), ("r3", 0), ("r4", 0), ("r5", 1)], "run_id string, cc int")
    code = validity.run_exit_code(
        F.col("cc"), F.col("snapshot_count"), F.col("snapshots_kept"), F.col("snapshots_dropped")
    )
    status = {r.run_id: r.c for r in runs_seen.join(counts, "run_id", "left").select("run_id", code.alias("c")).collect()}
    assert status == {"r1": 5, "r2": 0, "r3": 4, "r4": 3, "r5": 2}
    assert {(r.run_id, r.filename) for r in validity.drop_failed(snapshots, outcomes).collect()} == {
        ("r1", "00_a.mlir"), ("r2", "00_a.mlir")
    }
    assert validity.dropped_only(snapshots, outcomes).count() == 2


def test_manifest_documents_and_parts(spark):
    rows = [("big", n) for n in range(7)] + [("small", 0)]
    frame = spark.createDataFrame(rows, "run_id string, index int").withColumns(
        {
            "pass_class": F.lit("A"), "pass_name": F.lit("a"), "filename": F.format_string("%02d_a.mlir", "index"),
            "bytes": F.lit(1).cast("long"), "lines": F.lit(1), "sha256": F.lit("s"),
            "parent_sha256": F.lit(None).cast("string"),
            "roundtrip_status": F.when(F.col("index") == 2, "failed").otherwise("ok"),
        }
    )
    heads = spark.createDataFrame(
        [("big", 7), ("small", 1), ("none", 0)], "run_id string, snapshot_count int"
    ).withColumns({c: F.lit(None).cast("string") for c in ("source", "source_sha256", "stream_file", "stream_sha256")})
    documents = {(r.run_id, r.manifest_part): json.loads(r.manifest) for r in to_manifests(frame, heads, part_size=3).collect()}
    assert set(documents) == {("big", 0), ("big", 1), ("big", 2), ("small", 0), ("none", 0)}
    indexes = [s["index"] for part in range(3) for s in documents["big", part]["snapshots"]]
    assert indexes == list(range(7))
    assert documents["big", 2]["snapshots_kept"] == 6 and documents["big", 0]["snapshots_dropped"] == 1
    assert documents["none", 0]["snapshots"] == [] and documents["none", 0]["snapshot_count"] == 0
    assert documents["small", 0]["source_sha256"] is None
    assert list(documents["small", 0]) == [
        "source", "source_sha256", "stream_file", "stream_sha256", "snapshot_count", "snapshots", "snapshots_kept",
        "snapshots_dropped",
    ]


def test_manifest_validity(spark):
    raw = {
        "ok": '{"source_sha256": "x", "snapshots": []}', "null": '{"source_sha256": null}', "absent": "{}", "cut": '{"a": 1',
        "empty": "", "list": "[]", "tail": "{} extra", "text": "nope",
    }
    frame = spark.createDataFrame(list(raw.items()), "name string, raw string")
    got = {r.name: (r.valid, r.source_sha256) for r in runs.decode_manifests(frame).select(
        "name", F.col("manifest").isNotNull().alias("valid"), "source_sha256").collect()}
    assert got["ok"] == (True, "x") and got["null"] == (True, None) and got["absent"] == (True, "")
    assert not any(got[n][0] for n in ("cut", "empty", "list", "tail", "text")), got


def test_provenance(spark):
    frame = spark.createDataFrame(
        [("a", "f", LINES[0] + "\nx\n"), ("b", "g", "nothing")], "run_id string, stream_file string, stream string"
    )
    rows = {r.run_id: r for r in segments.run_provenance(frame).collect()}
    assert rows["a"].snapshot_count == 1 and rows["b"].snapshot_count == 0 and rows["b"].source_sha256 is None
    assert rows["b"].stream_sha256 == hashlib.sha256(b"nothing").hexdigest()


def test_diagnostic_excerpts(spark):
    lines = [("f", n, t) for n, t in enumerate(["note", "In file included from a", "x: error: y", "2 errors generated."])]
    lines += [("q", n, f"l{n}") for n in range(30)]
    lines += [("m", n, f"a: warning: {n}") for n in range(15)]
    frame = spark.createDataFrame(lines, "run_id string, line_no int, line string").repartition(4)
    rows = batch.failure_excerpt(frame).orderBy("run_id", "rank").collect()
    shown = {k: [r.line for r in rows if r.run_id == k] for k in "fqm"}
    assert shown["f"] == ["x: error: y", "2 errors generated.", "In file included from a"]
    assert shown["q"] == [f"l{n}" for n in range(10, 30)]
    assert shown["m"] == [f"a: warning: {n}" for n in range(10)]
