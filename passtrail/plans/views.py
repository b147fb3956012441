"""Corpus-shaped inputs derived from general tables, row by row, so that no view gathers a group into one value."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{name}.parquet")


def documents(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "documents")


def pages(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "pages")


def snapshots(spark: SparkSession, base: str) -> DataFrame:
    """Conversations as candidate snapshots: twenty benchmarks, one run per conversation, the role as pass."""
    return table(spark, base, "conversations").selectExpr(
        "conv_id as run_id",
        "'b' || (conv_id % 20) as benchmark_name",
        "'20240101-' || lpad(cast(conv_id as string), 6, '0') as run_timestamp",
        "cast(turn as int) as pass_index",
        "'Role::' || role as pass_class",
        "role as pass_name",
        "text as ir_text",
        "case when length(text) % 7 = 0 then 'failed' else 'ok' end as roundtrip_status",
        "turn as manifest_pos",
    )


def stream_blocks(spark: SparkSession, base: str) -> DataFrame:
    """One dump stream per conversation, with a preamble before the first header, delivered in blocks.

    A turn gives three blocks: its header, and its words in two blocks that end in different places, so that bodies cross blocks and
    blocks hold parts of two bodies.
    """
    cut = table(spark, base, "conversations").selectExpr(
        "conv_id as run_id",
        "turn",
        r"if(turn = 0, 'preamble\n', '') || '// -----// IR Dump After Role::' || role || ': ' || role || '-' || turn || ' (m)\n' as head",
        r"concat(regexp_replace(text, ' ', '\n'), '  \n') as body",
    ).selectExpr("*", r"instr(substr(body, cast(length(body) / 3 as int) + 1), '\n') + cast(length(body) / 3 as int) as at")
    blocks = "stack(3, 0L, head, 1L, substr(body, 1, at), 2L, substr(body, at + 1)) as (part, text)"
    return cut.selectExpr("run_id", "turn", blocks).selectExpr("run_id", "turn * 3 + part as block", "text")


def streams(spark: SparkSession, base: str) -> DataFrame:
    """One dump stream per document: each sentence but the first becomes a snapshot."""
    return documents(spark, base).selectExpr(
        "doc_id as run_id",
        "'doc-' || doc_id as stream_file",
        "source",
        "text as source_text",
        r"'preamble\n' || replace(text, '. ', '.\n// -----// IR Dump After Doc::' || lang || ': ' || lang || '-step (m)\n')"
        " as stream",
    )


def document_snapshots(spark: SparkSession, base: str) -> DataFrame:
    """Documents as snapshots: the source as benchmark, the language as pass, time stamps with ties."""
    return documents(spark, base).selectExpr(
        "doc_id",
        "source as benchmark_name",
        "lang as pass_name",
        "'Lang::' || lang as pass_class",
        "'20240101-' || lpad(cast(doc_id % 50 as string), 6, '0') as run_timestamp",
        "cast(doc_id as int) as pass_index",
        "doc_id as manifest_pos",
        "text",
    )


def modules(spark: SparkSession, base: str) -> DataFrame:
    """One module text per document: each word becomes a line, a function header or a brace, by its length and ends."""
    line = r"""
      case when length(w) % 10 between 1 and 5 then '  ' || w
        when length(w) % 10 = 6 then '  }'
        when length(w) % 10 = 7 then '}'
        when length(w) % 10 = 8 then
          case when left(w, 1) in ('e', 't') then 'cir.func @main_' when left(w, 1) in ('s', 'd') then 'llvm.func @_ZSt3'
               when left(w, 1) in ('a', 'é') then '  cir.func @kernel_'
               when left(w, 1) in ('i', 'o') then 'llvm.func private @cudaLaunch_' else 'cir.func @helper_' end
          || w || case when right(w, 1) in ('n', 'e', 't', 'r') then ' {' else '()' end
        when length(w) % 10 = 9 then '  scf.if ' || w || ' {'
        else '' end
    """
    return documents(spark, base).selectExpr(
        "source as benchmark_name",
        "lang as pass_name",
        "cast(doc_id as int) as pass_index",
        f"array_join(transform(split(text, ' '), w -> {line}), '\\n') as ir_text",
    )


def module_blocks(spark: SparkSession, base: str) -> DataFrame:
    """The modules in blocks of whole lines, cut before some of the nested braces, so that many functions cross blocks."""
    cut = r"posexplode(split(ir_text, '(?<=\\n)(?=  (?:scf|op|[a-e]))')) as (block, text)"
    return modules(spark, base).selectExpr("pass_index", cut)


def batch(spark: SparkSession, base: str) -> DataFrame:
    """One attempted benchmark per event, with every kind of exit code and raw errors that need cleaning."""
    return table(spark, base, "events").selectExpr(
        "'bench-' || user_id || '-' || event_id as benchmark",
        """cast(case event_type when 'view' then 0 when 'click' then 5 when 'signup' then 2
             when 'error' then case event_id % 3 when 0 then 1 when 1 then 124 else 99 end
             else case event_id % 4 when 0 then 0 when 1 then 3 when 2 then 4 else 137 end end as int) as exit_code""",
        "cast(event_id % 8 as int) as snapshots",
        "cast(floor(value) as int) as wall_seconds",
        r"""case when event_type = 'view' then '' else 'error: in "f' || (event_id % 6) || '.h",\ncode  ' || (event_id % 4)
             || ', ' || repeat('x', cast(event_id % 250 as int)) end as raw_error""",
    )


def attempts(spark: SparkSession, base: str) -> DataFrame:
    """One attempted benchmark per user; its lines are in ``log_lines``."""
    return (
        table(spark, base, "events")
        .groupBy("user_id")
        .agg({"event_id": "max"})
        .selectExpr(
            "'u' || user_id as benchmark",
            """cast(case user_id % 9 when 6 then 124 when 7 then 137 when 8 then 99 else user_id % 9 end as int)
               as exit_code""",
            "user_id as start_epoch",
            "user_id + `max(event_id)` as end_epoch",
        )
    )


def log_lines(spark: SparkSession, base: str) -> DataFrame:
    """One log line per event, numbered by event within its user's run."""
    return table(spark, base, "events").selectExpr(
        "'u' || user_id as benchmark",
        "event_id as line_no",
        """case event_type when 'error' then 'f.cu:' || event_id || ': error: bad ' || (event_id % 9)
             when 'signup' then 'In file included from f' || (event_id % 5) || '.h'
             when 'purchase' then case when event_id % 3 = 0 then 'a.h:1: warning: w'
               when event_id % 3 = 1 then '2 errors generated.'
               else 'Parsed ' || (event_id % 8) || ' snapshots into out' end
             when 'click' then 'error: driver ' || event_id else 'note ' || event_id end as line""",
    )


def log_texts(spark: SparkSession, base: str) -> DataFrame:
    """One log text per document: a word becomes a line of some kind by its length."""
    line = """
      case length(w) % 17
        when 12 then 'f.cu:' || i || ': error: bad ' || w
        when 13 then 'In file included from ' || w || '.h'
        when 14 then 'a.h:1: warning: ' || w
        when 15 then i || ' errors generated.'
        when 16 then 'Parsed ' || i || ' snapshots into ' || w
        when 11 then 'error: driver ' || w
        when 10 then 'the parser said ' || w
        else 'note ' || w end
    """
    return documents(spark, base).selectExpr(
        "doc_id as run_id", f"array_join(transform(split(text, ' '), (w, i) -> {line}), '\\n') as text"
    )


def listing(spark: SparkSession, base: str) -> DataFrame:
    """Source files of benchmarks in several layouts."""
    return table(spark, base, "part").selectExpr(
        "'p' || (p_partkey % 900) || case when p_partkey % 900 % 4 = 3 then '-omp' else '-cuda' end as benchmark",
        """case p_partkey % 7 when 0 then 'main.cu' when 1 then 'src/main.cu' when 2 then 'lib/main.cu'
             when 3 then 'kernel' || p_size || '.cu' when 4 then 'util.cuh' when 5 then 'a/b/main.cu'
             else 'src/' || p_partkey || '.cu' end as rel_path""",
    )


def run_listing(spark: SparkSession, base: str) -> DataFrame:
    """Run directories of all conversations, with names that hold a dash, and some directories that are no runs."""
    runs = table(spark, base, "conversations").groupBy("conv_id").agg(F.max(F.length("text")).alias("modified"))
    return runs.selectExpr(
        """case when conv_id % 11 = 0 then 'batch-runs' else 'bench-' || (conv_id % 20) || '-cuda-20240101-'
             || lpad(cast(conv_id as string), 6, '0') end as run_dir""",
        "modified",
    )
