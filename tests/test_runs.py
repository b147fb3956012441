"""A run tree on disk: manifests, fall-back to older runs, the written corpus, lookups and reports."""

import glob
import hashlib
import json

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from passtrail.operators import batch, chain, packing, reports
from passtrail.operators import corpus as cp
from passtrail.plans import flows
from passtrail.sinks import tables as sinks
from passtrail.sources import runs, streams, tables

STAMP = "2024-05-06T07:08:09Z"


def element(number, name, status="ok", **extra):
    out = {
        "index": number, "pass_class": f"C{name}", "pass_name": name, "filename": f"{number:02d}_{name}.mlir", "bytes": 1,
        "lines": 1, "sha256": "m", "parent_sha256": f"p{number}" if number else None,
    }
    if status:
        out["roundtrip_status"] = status
    out.update(extra)
    return {k: v for k, v in out.items() if v != "DROP"}


def write_run(root, name, elements, texts=None, missing=(), raw=None, **manifest):
    folder = root / name / "snapshots"
    folder.mkdir(parents=True)
    document = {"source": "s.cu", "source_sha256": f"src-{name}", "snapshots": elements, **manifest}
    document = {k: v for k, v in document.items() if v != "DROP"}
    (folder / "manifest.json").write_text(raw if raw is not None else json.dumps(document, indent=2))
    for item in elements:
        file = item.get("filename")
        if file and file not in missing:
            text = (texts or {}).get(file, f"{name} {file} cir.op\n")
            (folder / file).write_bytes(text if isinstance(text, bytes) else text.encode())


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("tree")
    old, new = "20240101-000000", "20240202-000000"
    write_run(root, f"alpha-cuda-{old}", [element(0, "a"), element(1, "b"), element(2, "c"), element(3, "d")])
    # The newest run: a is newer, b failed, c has no file, d is absent, e has no status.
    write_run(
        root,
        f"alpha-cuda-{new}",
        [element(0, "a"), element(1, "b", "failed"), element(2, "c"), element(4, "e", None)],
        missing=["02_c.mlir"],
        source_sha256=None,
    )
    # A pass repeated in one run keeps its first place; the source hash key is absent.
    write_run(root, f"beta-{old}", [element(0, "a"), element(1, "b"), element(2, "a")], source_sha256="DROP")
    # Digits only, and a name that itself ends like a time stamp.
    write_run(root, f"123-{old}", [element(0, "a")], {"00_a.mlir": "é" * 40 + "x.yy\r\nz\r"})
    write_run(root, f"g-{old}-{new}", [element(0, "a")], {"00_a.mlir": b"bad \xff byte\n"})
    write_run(root, f"broken-{old}", [element(0, "a")], raw="{not json")
    write_run(root, "batch-runs", [element(0, "a")])
    write_run(root, f"empty-{old}", [])
    write_run(root, f"noindex-{old}", [element(0, "a", index="DROP"), element(1, "b")])
    (root / f"nomanifest-{old}").mkdir()
    return str(root)


EXPECTED = {
    ("alpha-cuda", "a"): "20240202-000000", ("alpha-cuda", "b"): "20240101-000000", ("alpha-cuda", "c"): "20240101-000000",
    ("alpha-cuda", "d"): "20240101-000000", ("beta", "a"): "20240101-000000", ("beta", "b"): "20240101-000000",
    ("123", "a"): "20240101-000000", ("g-20240101-000000", "a"): "20240202-000000", ("noindex", "b"): "20240101-000000",
}


def test_nested_run_folders_are_out_of_scope(spark, tmp_path):
    write_run(tmp_path, "foo-20240101-000000", [element(0, "a")])
    write_run(tmp_path / "archive", "foo-20250101-000000", [element(0, "a")])
    assert [r.run_timestamp for r in flows.corpus_from_runs(spark, str(tmp_path), "t").collect()] == ["20240101-000000"]


def test_one_bad_element_stands_alone(spark, tmp_path):
    good = json.dumps(element(0, "a"))
    documents = {
        "text": f'{{"snapshots": [{json.dumps(element(1, "b", index="1"))}, {good}]}}',
        "float": f'{{"snapshots": [{good}, {json.dumps(element(1, "b", bytes=1.5))}, {json.dumps(element(2, "c", index=1.5))}, 7, null]}}',
        "nan": f'{{"score": NaN, "snapshots": [{good}], "snapshot_count": "x"}}',
        "twice": f'{{"source": "x", "source": "y", "snapshots": [{good}]}}',
        "more": f'{{"snapshots": [{good}]}} {{}}',
        "list": f"[{good}]",
        "other": '{"snapshots": 3}',
    }
    for name, raw in documents.items():
        write_run(tmp_path, f"{name}-20240101-000000", [element(0, "a"), element(1, "b")], raw=raw)
    rows = flows.corpus_from_runs(spark, str(tmp_path), "t").collect()
    assert {(r.benchmark_name, r.pass_name) for r in rows} == {
        ("text", "a"), ("text", "b"), ("float", "a"), ("float", "b"), ("nan", "a"), ("twice", "a"),
    }
    rejected = {r.run_dir.split("-")[0] for r in runs.rejected_manifests(spark, str(tmp_path)).collect()}
    assert rejected == {"more", "list", "other"}
    elements = cp.rejected_elements(cp.explode_snapshots(runs.read_manifests(spark, str(tmp_path))))
    assert elements.groupBy("benchmark_name").count().collect() == [("float", 3)]


def test_survivors(spark, tree):
    rows = cp.dedup_latest(flows.candidates(spark, tree)).collect()
    assert {(r.benchmark_name, r.pass_name): r.run_timestamp for r in rows} == EXPECTED
    index = {(r.benchmark_name, r.pass_name): r.pass_index for r in rows}
    assert index["beta", "a"] == 0 and index["noindex", "b"] == 1


def test_rejects(spark, tree):
    assert [r.run_dir for r in runs.rejected_manifests(spark, tree).collect()] == ["broken-20240101-000000"]
    rejected = cp.rejected_elements(cp.explode_snapshots(runs.read_manifests(spark, tree))).collect()
    assert [(r.benchmark_name, r.missing) for r in rejected] == [("noindex", ["pass_index"])]


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 26])
def test_corpus_rows(spark, tree, broadcast_bytes):
    rows = flows.corpus_from_runs(spark, tree, STAMP, cap_bytes=21, broadcast_bytes=broadcast_bytes)
    assert rows.columns == list(cp.CORPUS_COLUMNS)
    got = {(r.benchmark_name, r.pass_name): r for r in rows.collect()}
    assert {k: r.run_timestamp for k, r in got.items()} == EXPECTED
    whale = got["123", "a"]
    full = "é" * 40 + "x.yy\nz\n"
    assert (whale.ir_text, whale.truncated, whale.ir_bytes, whale.ir_lines) == ("é" * 10, True, len(full.encode()), 2)
    assert whale.ir_sha256 == hashlib.sha256(full.encode()).hexdigest()
    assert whale.dialects_present == []
    assert got["g-20240101-000000", "a"].ir_text == "bad � byte\n"
    assert got["beta", "a"].source_sha256 == "" and got["alpha-cuda", "a"].source_sha256 is None
    assert got["alpha-cuda", "b"].source_sha256 == "src-alpha-cuda-20240101-000000"
    assert got["alpha-cuda", "b"].parent_sha256 == "p1" and got["alpha-cuda", "a"].parent_sha256 is None
    assert got["alpha-cuda", "b"].dialects_present == ["cir"]
    assert {r.source_lang for r in got.values()} == {"cuda-host"} and {r.corpus_ingest_utc for r in got.values()} == {STAMP}


def test_write_read_and_rewrite(spark, tree, tmp_path):
    out = str(tmp_path / "corpus")
    found = flows.build_corpus(spark, tree, out, ingest_utc=STAMP)
    corpus = tables.read_corpus(spark, out)
    assert {(r.benchmark_name, r.pass_name) for r in corpus.collect()} == set(EXPECTED)
    assert dict(corpus.dtypes)["benchmark_name"] == "string"
    sizes = found["sizes"].first()
    assert sizes.n_rows == len(EXPECTED) and sizes.truncated_rows == 0 and sizes.bytes_before == sizes.bytes_after
    dedup = found["dedup"].first()
    assert (dedup.candidates, dedup.unique_snapshots, dedup.duplicates_dropped) == (11, 9, 2)
    assert [r.benchmark_name for r in found["partitions"].collect()] == sorted({b for b, _ in EXPECTED})
    files = glob.glob(f"{out}/benchmark_name=alpha-cuda/*.parquet")
    assert len(files) == 1
    meta = pq.ParquetFile(files[0]).metadata
    assert meta.row_group(0).column(0).compression == "ZSTD"
    assert [r["pass_index"] for r in pq.ParquetFile(files[0]).read(columns=["pass_index"]).to_pylist()] == [0, 1, 2, 3]
    # A later job that sees one benchmark replaces that partition only.
    one = corpus.filter("benchmark_name = 'beta' and pass_name = 'b'")
    kept = spark.createDataFrame(one.collect(), one.schema)
    sinks.write_corpus(kept.select(*cp.CORPUS_COLUMNS), out)
    left = {(r.benchmark_name, r.pass_name) for r in tables.read_corpus(spark, out).collect()}
    assert left == set(EXPECTED) - {("beta", "a")}


def test_reports_are_of_this_job_and_read_no_text(spark, tree, tmp_path):
    out = str(tmp_path / "corpus")
    first = flows.build_corpus(spark, tree, out, ingest_utc=STAMP)
    dry = flows.build_corpus(spark, tree, str(tmp_path / "none"), dry_run=True, ingest_utc=STAMP)
    for found in (first, dry):
        for name, report in found.items():
            assert "ir_text" not in report._jdf.queryExecution().executedPlan().toString(), name
    assert {n: r.collect() for n, r in first.items()} == {n: r.collect() for n, r in dry.items()}
    # A later job with the same stamp that sees one benchmark only: the others keep their partitions, but are not reported.
    write_run(tmp_path / "later", "beta-20250101-000000", [element(0, "z", "ok")], {"z": "new text"})
    again = flows.build_corpus(spark, str(tmp_path / "later"), out, ingest_utc=STAMP)
    assert [(r.benchmark_name, r.n_rows) for r in again["partitions"].collect()] == [("beta", 1)]
    assert again["sizes"].first().n_rows == 1 and again["planned_partitions"].first().partitions == 1
    assert tables.read_corpus(spark, out).count() == len(EXPECTED) - 2 + 1


def test_dry_run_and_empty_input(spark, tree, tmp_path):
    found = flows.build_corpus(spark, tree, str(tmp_path / "none"), dry_run=True)
    assert found["planned_partitions"].first().partitions == len({b for b, _ in EXPECTED})
    assert not (tmp_path / "none").exists()
    write_run(tmp_path, "x-20240101-000000", [element(0, "a", "failed")])
    with pytest.raises(ValueError):
        flows.build_corpus(spark, str(tmp_path), str(tmp_path / "none"))


def test_hot_benchmark_is_split_over_files(spark, tmp_path):
    rows = spark.range(4000).select(
        F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("b"), F.col("id") % 7)).alias("benchmark_name"),
        F.lit("cuda-host").alias("source_lang"), F.col("id").cast("int").alias("pass_index"), F.lit("C").alias("pass_class"),
        F.concat(F.lit("p"), "id").alias("pass_name"), F.sha2(F.col("id").cast("string"), 512).alias("ir_text"),
        F.lit(128).cast("long").alias("ir_bytes"), F.lit(0).alias("ir_lines"), F.lit("s").alias("ir_sha256"),
        F.lit("p").alias("parent_sha256"), F.lit(False).alias("truncated"),
        F.array(F.lit("cir")).alias("dialects_present"), F.lit("").alias("source_sha256"), F.lit("t").alias("run_timestamp"),
        F.lit(STAMP).alias("corpus_ingest_utc"),
    ).repartition(16)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "60k")
    try:
        sinks.write_corpus(rows, str(tmp_path / "c"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(glob.glob(f"{tmp_path}/c/benchmark_name=hot/*.parquet")) > 2
    groups = max(pq.ParquetFile(f).metadata.row_group(0).num_rows for f in glob.glob(f"{tmp_path}/c/*/*.parquet"))
    assert groups <= 512
    assert tables.read_corpus(spark, str(tmp_path / "c")).count() == 4000


def test_lookup_and_prompt(spark, tree, tmp_path):
    out = str(tmp_path / "corpus")
    flows.build_corpus(spark, tree, out, ingest_utc=STAMP)
    corpus = tables.read_corpus(spark, out)
    assert {r.pass_name for r in cp.lookup(corpus, "alpha-cuda").collect()} == set("abcd")
    assert cp.lookup(corpus, "alpha-cuda", "").count() == 4
    assert cp.first_match(cp.lookup(corpus, "alpha-cuda")).first().pass_name == "a"
    prompt = flows.prompt_rows(spark, out, "123").first()
    assert "Benchmark: 123\nPass stage: a (index 0)\nKept 0 user functions out of 0 total" in prompt.messages[1].content
    with pytest.raises(ValueError):
        flows.prompt_rows(spark, out, "nobody")
    report = reports.compression_report(corpus, tables.file_lengths(spark, out)).first()
    assert report.text_bytes > 0 and report.disk_bytes > 0
    links = {(r.benchmark_name, r.pass_name): r.link for r in chain.parent_links(corpus).collect()}
    assert links["alpha-cuda", "a"] == "root" and links["alpha-cuda", "b"] == "dangling"
    assert packing.prompts(corpus.select("benchmark_name", "pass_name", "pass_index", "ir_text")).count() == len(EXPECTED)


def test_lookup_prunes_partitions_and_columns(spark, tree, tmp_path):
    out = str(tmp_path / "corpus")
    flows.build_corpus(spark, tree, out, ingest_utc=STAMP)
    plan = cp.lookup(tables.read_corpus(spark, out), "beta", "b").select("ir_lines")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(benchmark_name" in text
    assert "EqualTo(pass_name,b)" in text and "ReadSchema: struct<pass_name:string,ir_lines:int>" in text


def test_capture_and_manifests(spark, tmp_path):
    banner = "// -----// IR Dump After "
    for run, stream in {
        "x-20240101-000000": f"pre\n{banner}A: a (m)\nbody {{\n}}\n{banner}B: b (m)\nrest\n", "y-20240101-000000": "nothing\n",
    }.items():
        (tmp_path / run).mkdir()
        (tmp_path / run / "snapshot-stream.txt").write_text(stream)
    whole = flows.capture(spark, str(tmp_path))
    blocks = flows.capture(spark, str(tmp_path), large_files=True)
    columns = ["run_id", "index", "pass_name", "filename", "sha256", "parent_sha256", "bytes", "lines", "body"]
    assert sorted(whole.select(*columns).collect()) == sorted(blocks.select(*columns).collect())
    sources = spark.createDataFrame([("x-20240101-000000", "main.cu", "int x;")], "run_id string, source string, source_text string")
    documents = [
        sorted((r.run_id, r.manifest_part, r.manifest) for r in flows.run_manifests(spark, str(tmp_path), sources, large_files=large).collect())
        for large in (False, True)
    ]
    assert documents[0] == documents[1] and len(documents[0]) == 2
    head = json.loads(documents[0][0][2])
    stream = (tmp_path / "x-20240101-000000" / "snapshot-stream.txt").read_text()
    assert (head["stream_sha256"], head["snapshot_count"]) == (hashlib.sha256(stream.encode()).hexdigest(), 2)
    assert head["stream_file"].endswith("/x-20240101-000000/snapshot-stream.txt") and head["source"] == "main.cu"
    out = str(tmp_path / "bodies")
    sinks.write_snapshot_files(whole, out)
    file = glob.glob(f"{out}/run_id=x-20240101-000000/filename=00_a.mlir/*.txt")
    assert open(file[0]).read() == "body {\n}\n"


def test_summary_csv(spark, tmp_path):
    rows = [("a", 0, "success", 4, 7, ""), ("b", 2, "compile_fail", 0, 1, "  x\\y; 'q' 100% "), ("c", 99, "unknown_99", 0, 2, "é")]
    summary = spark.createDataFrame(rows, tables.SUMMARY_TYPE)
    sinks.write_summary(summary, str(tmp_path / "s"))
    text = "".join(open(f).read() for f in sorted(glob.glob(f"{tmp_path}/s/*.csv")))
    assert "benchmark,exit_code,status,snapshots,wall_seconds,first_error" in text and "a,0,success,4,7,\n" in text
    assert sorted(map(tuple, tables.read_summary(spark, str(tmp_path / "s")).collect())) == sorted(rows)
    report = flows.batch_report(tables.read_summary(spark, str(tmp_path / "s")))
    assert report["ok"].first().not_success == 2 and report["retention"].first().retained == 1
    assert [(r.status, r.n) for r in report["status"].collect()][0] == ("unknown_99", 1)


def test_logs_and_listing(spark, tmp_path):
    (tmp_path / "logs").mkdir()
    (tmp_path / "logs" / "a-cuda.log").write_bytes(b"one\r\nerror: two\x0bthree\n")
    lines = streams.read_logs(spark, str(tmp_path / "logs")).orderBy("line_no").collect()
    assert [(r.benchmark, r.line_no, r.line) for r in lines] == [
        ("a-cuda", 0, "one"), ("a-cuda", 1, "error: two"), ("a-cuda", 2, "three")
    ]
    for path in ("src/a-cuda/main.cu", "src/a-cuda/src/main.cu", "src/b-cuda/x/y.cu", "src/b-cuda/z.cu", "src/c-cuda/r.md",
                 "src/d-omp/main.cu", "src/e-cuda/p/q/main.cu"):
        (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / path).write_text("x")
    listing = tables.benchmark_listing(spark, str(tmp_path / "src"))
    chosen = {r.benchmark: r for r in flows.batch_selection(listing, limit=0).collect()}
    assert set(chosen) == {"a-cuda", "b-cuda", "c-cuda", "e-cuda"}
    assert chosen["a-cuda"].source_path == "main.cu" and not chosen["a-cuda"].ambiguous
    assert chosen["b-cuda"].source_path == "x/y.cu" and chosen["b-cuda"].ambiguous
    assert chosen["c-cuda"].source_path is None and chosen["c-cuda"].error and chosen["e-cuda"].error
    assert flows.batch_selection(listing, limit=2).count() == 2


def test_error_tables(spark, tmp_path):
    lines = spark.createDataFrame([("r1", 0, "x: error: y"), ("r2", 0, "In file included from z")], "run_id string, line_no int, line string")
    outcomes = spark.createDataFrame([("r1", "00_a.mlir", "OK", None)], "run_id string, filename string, outcome string, exit_code int")
    sinks.write_error_tables(batch.diagnostics(lines), outcomes, str(tmp_path / "e"))
    assert spark.read.parquet(str(tmp_path / "e/diagnostics")).count() == 2
    assert spark.read.parquet(str(tmp_path / "e/roundtrip")).first().filename == "00_a.mlir"


def scanned(rows):
    """Rows that the file scans of a query gave to it, and the files that they read."""
    rows.collect()
    found, nodes = [0, 0], [rows._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            nodes.append(node.executedPlan())
            continue
        if node.nodeName().startswith("Scan"):
            for k, name in enumerate(("numOutputRows", "numFiles")):
                found[k] += node.metrics().apply(name).value()
        children = node.children()
        nodes += [children.apply(k) for k in range(children.size())]
    return found


def test_errors_of_a_run_tree(spark, tmp_path):
    for run, stream in {"bad": "x.cu:1: error: no\nnote\nIn file included from a.h\n1 errors generated.\n", "good": "warning: fine\n"}.items():
        (tmp_path / run).mkdir()
        (tmp_path / run / "snapshot-stream.txt").write_text(stream)
        (tmp_path / run / "roundtrip.log").write_text("OK   00_a.mlir\nDROP 01_b.mlir (roundtrip failed, exit 2)\n")
    compiled = spark.createDataFrame([("bad", 1), ("good", 0)], "run_id string, compiler_exit int")
    flows.write_run_errors(spark, str(tmp_path), str(tmp_path / "e"), compiled)
    found = sinks.read_errors(spark, str(tmp_path / "e"), "diagnostics", "bad").orderBy("group_no", "line_no").collect()
    assert [(r.group_no, r.line_no) for r in found] == [(0, 0), (0, 3), (1, 2)]
    assert sinks.read_errors(spark, str(tmp_path / "e"), "diagnostics").count() == 3
    outcomes = sinks.read_errors(spark, str(tmp_path / "e"), "roundtrip", "good").collect()
    assert sorted((r.filename, r.outcome, r.exit_code) for r in outcomes) == [("00_a.mlir", "OK", None), ("01_b.mlir", "DROP", 2)]


def test_errors_of_a_run_are_looked_up(spark, tmp_path):
    """Folders are bounded, one run's rows come from one of them, and a run that is written again replaces its rows alone."""
    out = str(tmp_path / "e")
    lines = spark.range(6000).select(
        F.concat(F.lit("r"), F.col("id") % 600).alias("run_id"), F.lit(0).alias("group_no"), F.col("id").cast("int").alias("line_no"), F.lit("error: x").alias("line")
    )
    outcomes = lines.select("run_id", F.concat(F.lit("f"), "line_no").alias("filename"))
    sinks.write_error_tables(lines, outcomes, out, buckets=16)
    assert len(glob.glob(f"{out}/diagnostics/bucket=*")) == 16 == len(glob.glob(f"{out}/roundtrip/bucket=*"))
    one = sinks.read_errors(spark, out, "diagnostics", "r17", buckets=16)
    assert sorted(r.line_no for r in one.collect()) == [17 + 600 * k for k in range(10)] and one.columns == lines.columns
    rows, files = scanned(sinks.read_errors(spark, out, "diagnostics", "r17", buckets=16))
    assert files == 1 and rows < 1000
    again = lines.filter("run_id = 'r17'").withColumn("line", F.lit("error: y")).limit(3)
    sinks.write_error_tables(again, outcomes.limit(0), out, buckets=16)
    everything = sinks.read_errors(spark, out, "diagnostics")
    assert everything.count() == 6000 - 7 and {r.line for r in everything.filter("run_id = 'r17'").collect()} == {"error: y"}
    assert sinks.read_errors(spark, out, "roundtrip").count() == 6000
    # A run that no file holds: its folder's bloom filter says so.
    absent = next(f"r{k}" for k in range(1000, 2000) if not sinks.read_errors(spark, out, "diagnostics", f"r{k}", buckets=16).count())
    assert scanned(sinks.read_errors(spark, out, "diagnostics", absent, buckets=16))[0] == 0


def test_lookup_by_pass_skips_row_groups(spark, tmp_path):
    rows = spark.range(8000).select(
        F.concat(F.lit("b"), F.col("id") % 4).alias("benchmark_name"), F.lit("cuda-host").alias("source_lang"), F.col("id").cast("int").alias("pass_index"),
        F.lit("C").alias("pass_class"), F.concat(F.lit("p"), (F.col("id") * 7919) % 8000).alias("pass_name"), F.lit("text").alias("ir_text"),
        F.lit(4).cast("long").alias("ir_bytes"), F.lit(0).alias("ir_lines"), F.lit("s").alias("ir_sha256"), F.lit("p").alias("parent_sha256"),
        F.lit(False).alias("truncated"), F.array(F.lit("cir")).alias("dialects_present"), F.lit("").alias("source_sha256"),
        F.lit("t").alias("run_timestamp"), F.lit(STAMP).alias("corpus_ingest_utc"),
    )
    sinks.write_corpus(rows, str(tmp_path / "c"))
    found = cp.lookup(tables.read_corpus(spark, str(tmp_path / "c")), pass_name="p4242").select("benchmark_name", "pass_index")
    assert found.count() == 1 and scanned(found)[0] <= 2 * 512


def test_latest_run_by_parsed_name(spark):
    rows = [("foo-20240101-000000", 5), ("foo-bar-20240101-000000", 9), ("foo-20240102-000000", 7)]
    found = chain.latest_run(runs.scan_runs(spark.createDataFrame(rows, "run_dir string, modified int"))).collect()
    assert {r.benchmark_name: r.run_dir for r in found} == {
        "foo": "foo-20240102-000000", "foo-bar": "foo-bar-20240101-000000"
    }


def test_batch_summary_from_files(spark, tmp_path):
    import os

    logs, tree = tmp_path / "logs", tmp_path / "runs"
    logs.mkdir()
    old, new = "20240101-000000", "20240102-000000"
    files = {
        f"bad-{old}/compile-errors.txt": "old: error: no\n", f"bad-{new}/compile-errors.txt": 'x.cu:1: error: "a", b\nmore\n',
        f"bad-more-{new}/compile-errors.txt": "other: error: c\n", f"rt-{new}/roundtrip.log": "OK   00_a.mlir\nDROP 01_b.mlir (r)\n",
        f"good-{new}/driver.log": "x\n",
    }
    for number, (name, text) in enumerate(sorted(files.items())):
        (tree / name).parent.mkdir(parents=True, exist_ok=True)
        (tree / name).write_text(text)
        os.utime(tree / name, (1_700_000_000 + number, 1_700_000_000 + number))
    texts = {
        "good": "Parsed 5 snapshots into x\nparser exit=0, snapshots=5\n", "bad": "error: late\n", "rt": "Parsed 3 snapshots\n",
        "slow": "x\n", "drv": "note\nerror: could not\n", "odd": "a: error: b\n", "parse": "no parser here\n", "part": "2 snapshots\n",
    }
    for name, text in texts.items():
        (logs / f"{name}.log").write_text(text)
    codes = {"good": 0, "drv": 1, "bad": 2, "parse": 3, "rt": 4, "part": 5, "slow": 124, "odd": 99}
    attempts = spark.createDataFrame(
        [(n, c, 100, 107) for n, c in codes.items()], "benchmark string, exit_code int, start_epoch long, end_epoch long"
    )
    rows = flows.summarize_batch(spark, attempts, str(logs), str(tree)).collect()
    got = {r.benchmark: (r.status, r.snapshots, r.first_error) for r in rows}
    assert got == {
        "good": ("success", 5, ""), "drv": ("driver_error", 0, "error: could not"),
        "bad": ("compile_fail", 0, "x.cu:1: error: a; b"), "parse": ("parse_fail", 0, "no parser here"),
        "rt": ("roundtrip_fail", 3, "DROP 01_b.mlir (r)"), "part": ("partial_kept", 2, ""),
        "slow": ("timeout", 0, "killed after 60s"), "odd": ("unknown_99", 0, "a: error: b"),
    }
    assert {r.wall_seconds for r in rows} == {7}


def test_chain_links(spark):
    rows = [
        ("b", 0, "a", "t1", "h0", None), ("b", 1, "b", "t1", "h1", "h0"), ("b", 2, "c", "t2", "h2", "hx"),
        ("b", 3, "d", "t2", "h1", "h1"), ("b", 4, "e", "t1", "h4", "h1"), ("c", 0, "a", "t1", "h9", "h0"),
    ]
    corpus = spark.createDataFrame(
        rows,
        "benchmark_name string, pass_index int, pass_name string, run_timestamp string, ir_sha256 string, parent_sha256 string",
    )
    got = {(r.benchmark_name, r.pass_name): (r.link, r.parent_pass_index, r.parent_run_timestamp)
           for r in chain.parent_links(corpus).collect()}
    assert got == {
        ("b", "a"): ("root", None, None), ("b", "b"): ("linked", 0, "t1"), ("b", "c"): ("dangling", None, None),
        ("b", "d"): ("linked", 1, "t1"), ("b", "e"): ("linked", 1, "t1"), ("c", "a"): ("dangling", None, None),
    }
    report = {r.benchmark_name: (r.root, r.linked, r.dangling) for r in chain.chain_report(corpus).collect()}
    assert report == {"b": (1, 3, 1), "c": (0, 0, 1)}


def test_from_dump_streams_to_the_corpus(spark, tmp_path):
    """Streams and round-trip logs to manifests and bodies, laid out as a run tree, to the corpus."""
    banner = "// -----// IR Dump After "
    for stamp, word in (("20240101-000000", "old"), ("20240202-000000", "new")):
        run = tmp_path / "dumps" / f"x-cuda-{stamp}"
        run.mkdir(parents=True)
        run.joinpath("snapshot-stream.txt").write_text(
            f"pre\n{banner}A: a (m)\n{word} cir.func @main {{\n}}\n\n{banner}B: b (m)\n{word} llvm.op\n{banner}C: c (m)\n{word}\n"
        )
        dropped = "01_b.mlir" if word == "new" else "02_c.mlir"
        run.joinpath("roundtrip.log").write_text(
            "".join(f"OK   {f}\n" for f in ("00_a.mlir", "01_b.mlir", "02_c.mlir") if f != dropped)
            + f"DROP {dropped} (roundtrip failed, exit 1)\n----- first 10 lines of stderr -----\noops\n"
        )
    dumps = str(tmp_path / "dumps")
    for row in flows.run_manifests(spark, dumps).collect():
        document = json.loads(row.manifest)
        assert (document["snapshot_count"], document["snapshots_kept"], document["snapshots_dropped"]) == (3, 2, 1)
        assert document["stream_sha256"] and document["source"] is None
        folder = tmp_path / "tree" / row.run_id / "snapshots"
        folder.mkdir(parents=True)
        (folder / "manifest.json").write_text(row.manifest)
    snapshots = flows.capture(spark, dumps)
    for row in snapshots.collect():
        (tmp_path / "tree" / row.run_id / "snapshots" / row.filename).write_text(row.body)
    flows.build_corpus(spark, str(tmp_path / "tree"), str(tmp_path / "corpus"), ingest_utc=STAMP)
    rows = {r.pass_name: r for r in tables.read_corpus(spark, str(tmp_path / "corpus")).collect()}
    assert {p: r.ir_text.split()[0] for p, r in rows.items()} == {"a": "new", "b": "old", "c": "new"}
    links = {r.pass_name: r.link for r in chain.parent_links(tables.read_corpus(spark, str(tmp_path / "corpus"))).collect()}
    # The newest b was dropped, so the newest c points at a parent that is not published, and the old b at an old a.
    assert links == {"a": "root", "b": "dangling", "c": "dangling"}
    assert rows["a"].dialects_present == ["cir"] and rows["a"].source_sha256 is None
