"""Incremental ingest against one build over the same run tree."""

import glob
import os
import shutil

import test_runs
from passtrail.plans import flows
from passtrail.sources import tables
from passtrail.streaming import ingest

STAMP = test_runs.STAMP


def rows(spark, path):
    return sorted(map(str, tables.read_corpus(spark, path).collect()))


def runs(root):
    old, new = "20240101-000000", "20240202-000000"
    element, write_run = test_runs.element, test_runs.write_run
    yield [(f"alpha-cuda-{new}", [element(0, "a"), element(1, "b", "failed")]), (f"beta-{old}", [element(0, "a"), element(1, "b"), element(2, "a")])]
    yield [(f"alpha-cuda-{old}", [element(0, "a"), element(1, "b")]), (f"123-{old}", [element(0, "a")]), ("batch-runs", [element(0, "a")])]
    yield [(f"beta-{new}", [element(0, "b"), element(1, "c")]), (f"broken-{old}", None)]


def test_batches_give_what_one_build_gives(spark, tmp_path):
    root, out, state = str(tmp_path / "tree"), str(tmp_path / "corpus"), str(tmp_path / "state")
    for batch in runs(root):
        for name, elements in batch:
            test_runs.write_run(tmp_path / "tree", name, elements or [], raw=None if elements is not None else "{not json")
        ingest.ingest_new_runs(spark, root, out, state, STAMP)
    flows.build_corpus(spark, root, str(tmp_path / "whole"), ingest_utc=STAMP)
    whole = rows(spark, str(tmp_path / "whole"))
    assert rows(spark, out) == whole and len(whole) == 6
    # Nothing new: nothing is written. All manifests once more, as after the loss of the stream's state: nothing changes.
    files = sorted(glob.glob(f"{out}/*/*.parquet"))
    ingest.ingest_new_runs(spark, root, out, state, STAMP)
    assert sorted(glob.glob(f"{out}/*/*.parquet")) == files
    shutil.rmtree(state)
    ingest.ingest_new_runs(spark, root, out, str(tmp_path / "state2"), STAMP, files_per_batch=2)
    assert rows(spark, out) == whole


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    root, out = tmp_path / "tree", str(tmp_path / "corpus")
    element = test_runs.element
    test_runs.write_run(root, "x-20240101-000000", [element(0, "a"), element(1, "b")])
    test_runs.write_run(root, "x-20240202-000000", [element(0, "a")], missing=["00_a.mlir"])
    read = lambda pattern: spark.read.format("binaryFile").option("pathGlobFilter", "manifest*.json").load(f"{root}/{pattern}/snapshots")
    assert ingest.merge_batch(read("x-20240101*"), out, STAMP) == 2
    first = rows(spark, out)
    assert ingest.merge_batch(read("x-20240101*"), out, STAMP) == 2 and rows(spark, out) == first
    # The newer run's file is missing, so the older row stays; an older run never replaces a newer one.
    assert ingest.merge_batch(read("x-20240202*"), out, STAMP) == 0 and rows(spark, out) == first
    with open(os.path.join(root, "x-20240202-000000", "snapshots", "00_a.mlir"), "w") as f:
        f.write("newer\n")
    assert ingest.merge_batch(read("x-20240202*"), out, STAMP) == 1
    after = {r.pass_name: (r.run_timestamp, r.ir_text) for r in tables.read_corpus(spark, out).collect()}
    assert after["a"] == ("20240202-000000", "newer\n") and after["b"][0] == "20240101-000000"
    assert ingest.merge_batch(read("x-20240101*"), out, STAMP) == 1
    assert {r.pass_name: (r.run_timestamp, r.ir_text) for r in tables.read_corpus(spark, out).collect()} == after
