"""What the plans must look like to hold at scale: few shuffles, narrow ones, early reduction, pruned scans."""

import re

import pytest
from pyspark.sql import functions as F

from passtrail.operators import batch, chain, packing, reports, scale, segments, spans
from passtrail.operators import corpus as cp


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "c")
    spark.range(40).select(
        F.concat(F.lit("b"), F.col("id") % 3).alias("benchmark_name"), F.lit("p").alias("pass_name"),
        F.col("id").cast("int").alias("pass_index"), F.lit("20240101-000000").alias("run_timestamp"),
        F.col("id").alias("manifest_pos"), F.lit("cir.func @main {\n}\n").alias("ir_text"),
        F.lit(3).cast("long").alias("ir_bytes"), F.array(F.lit("cir")).alias("dialects_present"), F.lit("h").alias("sha256"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_row_wise_operators_do_not_shuffle(corpus):
    streams = corpus.select(F.col("pass_index").alias("run_id"), F.col("ir_text").alias("stream"))
    lines = corpus.select(F.col("pass_index").alias("run_id"), F.lit(0).alias("line_no"), F.col("ir_text").alias("line"))
    for df in (
        segments.segment_streams(streams), packing.prompts(corpus), spans.functions(corpus), spans.user_functions(corpus),
        batch.diagnostics(lines), corpus.withColumns(cp.text_columns("ir_text")),
    ):
        assert "Exchange" not in plan(df)


def test_text_is_parsed_once(corpus):
    for df in (packing.signal(corpus), spans.function_counts(corpus), spans.user_functions(corpus)):
        assert plan(df).count("{2028}") == 1


def test_dedup_reduces_narrow_rows_before_the_shuffle(corpus):
    text = plan(cp.dedup_latest(corpus.drop("ir_text", "dialects_present")))
    assert "Window" not in text and "ir_text" not in text
    assert text.count("Exchange hashpartitioning") == 1 and "partial_max_by" in text


def test_excerpt_limits_before_the_shuffle_and_reads_once(corpus):
    lines = corpus.select(F.col("benchmark_name").alias("run_id"), F.col("pass_index").alias("line_no"), F.col("ir_text").alias("line"))
    text = plan(batch.failure_excerpt(lines))
    assert re.search(r"WindowGroupLimit .*Partial", text) and text.count("FileScan") == 1


def test_chain_shuffles_once_by_run_and_block(corpus):
    rows = corpus.select(F.col("benchmark_name").alias("run_id"), F.col("pass_index").alias("index"), "sha256")
    text = plan(segments.hash_chain(rows))
    assert len(re.findall(r"Exchange hashpartitioning\(run_id#\d+, _w0#\d+L", text)) == 1
    assert text.count("Exchange") == 1


def test_reports_reduce_first_and_read_few_columns(corpus):
    text = plan(reports.dialect_frequency(corpus))
    assert "partial_count" in text and "TakeOrderedAndProject" in text
    assert "ReadSchema: struct<dialects_present:array<string>>" in text
    assert "ReadSchema: struct<benchmark_name:string,ir_bytes:bigint>" in plan(reports.partition_report(corpus))


def test_broadcast_only_within_its_limit(corpus):
    keys = corpus.select("manifest_pos", "pass_name")
    wide = corpus.select("manifest_pos", "ir_text")
    assert scale.fits_broadcast(keys) and not scale.fits_broadcast(keys, 10)
    hinted = scale.keep_by_key(wide, keys, "manifest_pos")._jdf.queryExecution().optimizedPlan().toString()
    plain = scale.keep_by_key(wide, keys, "manifest_pos", 10)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in hinted and "strategy=broadcast" not in plain


def test_rows_that_were_not_selected_are_dropped_before_the_shuffle(spark):
    wide = spark.createDataFrame([(k % 50 if k % 7 else None, k, f"t{k}") for k in range(300)], "a long, b int, text string")
    keys = spark.createDataFrame([(k % 50 if k % 3 else None, k, "x" * 1000) for k in range(0, 300, 10)], "a long, b int, info string")
    want = sorted((k % 50, k, f"t{k}", "x" * 1000) for k in range(0, 300, 10) if k % 7 and k % 3)
    for limit, semi in ((100_000, False), (1000, True), (10, False)):
        kept = scale.keep_by_key(wide, keys, ["a", "b"], limit)
        assert kept.columns == ["a", "b", "text", "info"] and sorted(map(tuple, kept.collect())) == want
        assert ("LeftSemi" in kept._jdf.queryExecution().optimizedPlan().toString()) == semi
    other = keys.withColumn("b", F.col("b").cast("long"))
    assert sorted(map(tuple, scale.keep_by_key(wide, other, ["a", "b"], 1000).collect())) == want


def test_hashes_are_not_shuffled_to_choose_survivors(spark, monkeypatch):
    from passtrail.operators import segments
    from passtrail.plans import flows

    text = "// -----// IR Dump After A: a (m) //----- //\none %s\n// -----// IR Dump After B: b (m) //----- //\ntwo %s\n"
    streams = spark.createDataFrame([(k, text % (k, k)) for k in range(6)], "run_id long, stream string")
    snapshots = segments.segment_streams(streams)
    outcomes = snapshots.select("run_id", "filename", F.when(F.col("run_id") == 5, "DROP").otherwise("OK").alias("outcome"), F.lit(0).alias("exit_code"))
    runs_of = streams.selectExpr("run_id", "'b' || run_id % 2 as benchmark_name", "'t' || run_id as run_timestamp", "null as source_sha256")
    runs_of = runs_of.withColumn("source_sha256", F.col("source_sha256").cast("string"))
    plans = []

    def settle(rows, keep=scale.settle):
        plans.append(plan(rows))
        return keep(rows)

    monkeypatch.setattr(scale, "settle", settle)
    rows = flows.corpus_from_snapshots(snapshots, outcomes, runs_of, "now").select("benchmark_name", "pass_name", "run_timestamp", "ir_sha256", "parent_sha256")
    found = {tuple(r) for r in rows.collect()}
    hashes = {(r.run_id, r.pass_name): (r.sha256, r.parent_sha256) for r in snapshots.collect()}
    assert found == {(f"b{k % 2}", p, f"t{k}", *hashes[k, p]) for k in (3, 4) for p in ("a", "b")}
    assert all(h[1] == hashes[k, "a"][0] for (k, p), h in hashes.items() if p == "b")
    assert len(plans) == 1 and "parent_sha256" not in plans[0].split("Exchange")[0] and "max_by" in plans[0]


def test_hot_key_stays_in_bounded_groups(spark):
    rows = spark.range(5000).select(F.lit("hot").alias("k"), F.col("id").alias("o"), F.lit(1).alias("v"))
    total = scale.running_total_before(rows, ["k"], "o", "v", "t", width=16)
    assert total.filter("t <> o").count() == 0 and total.count() == 5000
    previous = scale.previous_by_index(rows, ["k"], "o", "o", "p", width=16)
    assert previous.filter("not (p <=> if(o = 0, null, o - 1))").count() == 0 and previous.count() == 5000


def test_hot_parent_is_dealt_out(spark):
    hot = F.col("id") % 3 == 0
    root = F.col("id") % 3 == 1
    rows = spark.range(9000).select(
        F.when(hot | root, "hot").otherwise(F.concat(F.lit("b"), F.col("id") % 50)).alias("benchmark_name"),
        F.concat(F.lit("p"), "id").alias("pass_name"), F.col("id").cast("int").alias("pass_index"),
        F.lit("20240101-000000").alias("run_timestamp"), F.sha2(F.col("id").cast("string"), 256).alias("ir_sha256"),
        F.when(hot, F.sha2(F.lit("3"), 256)).when(root, None).otherwise(F.sha2((F.col("id") - 50 * 3).cast("string"), 256))
        .alias("parent_sha256"),
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dealt, plain = chain.parent_links(rows, hot_rows=100), chain.parent_links(rows)
        text = plan(dealt)
        assert "_salt" in text and "SortMergeJoin" in text
        assert sorted(map(str, dealt.collect())) == sorted(map(str, plain.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    links = {r.link: r["count"] for r in dealt.groupBy("link").count().collect()}
    assert links["root"] == 3000 and links["linked"] >= 3000 and sum(links.values()) == 9000
    # The largest group that meets in one task is a small part of the hot parent's children.
    keys = ["benchmark_name", "parent_sha256"]
    unique = rows.select(*keys).dropna().distinct().withColumn("x", F.lit(1))
    joined = scale.left_join_unique(rows, unique, keys, hot_rows=100)
    assert joined.count() == 9000 and joined.filter("x is null").count() == 3000
