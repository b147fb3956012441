"""The same results as the registered queries, as SQL that another engine can run on the same tables."""

from __future__ import annotations


# Patterns, marker words and output texts below are fixed values, as in the operators.

# Inputs, as in ``views``.

_SNAP = """snap as (
  select conv_id as run_id, 'b' || (conv_id % 20) as benchmark_name,
    '20240101-' || lpad(cast(conv_id as varchar), 6, '0') as run_timestamp, cast(turn as integer) as pass_index,
    'Role::' || role as pass_class, role as pass_name, text as ir_text,
    case when length(text) % 7 = 0 then 'failed' else 'ok' end as roundtrip_status, turn as manifest_pos,
    printf('%02d_%s.mlir', turn, role) as filename
  from conversations)"""

_CHAINED = f"""{_SNAP},
chained as (
  select *, sha256(ir_text) as sha256, strlen(ir_text) as bytes,
    cast(length(ir_text) - length(replace(ir_text, chr(10), '')) as integer) as lines,
    lag(sha256(ir_text)) over (partition by run_id order by pass_index) as parent_sha256
  from snap)"""

_LATEST = """latest as (
  select * from (
    select *, row_number() over (
      partition by benchmark_name, pass_name order by run_timestamp desc, manifest_pos) as rn
    from chained where roundtrip_status = 'ok')
  where rn = 1)"""

_STREAM = """stream as (
  select doc_id as run_id, 'doc-' || doc_id as stream_file, source, text as source_text,
    'preamble' || chr(10) || replace(text, '. ', '.' || chr(10) || '// -----// IR Dump After Doc::' || lang || ': ' || lang
      || '-step (m)' || chr(10)) as stream
  from documents)"""

_CONV_STREAM = """stream as (
  select conv_id as run_id, 'preamble' || chr(10) || string_agg('// -----// IR Dump After Role::' || role || ': ' || role
    || '-' || turn || ' (m)' || chr(10) || replace(text, ' ', chr(10)) || '  ' || chr(10), '' order by turn) as stream
  from conversations group by conv_id)"""

# Lines, running header count, and bodies put together again.
_SEGMENTS = r"""line as (
  select run_id, unnest(string_split(stream, chr(10))) as line, generate_subscripts(string_split(stream, chr(10)), 1) as i
  from stream),
header as (
  select *, regexp_extract(line, '^// -----// IR Dump After ([\w:]+):\s*([\w\-]+)\s*\(', ['c', 'p']) as h from line),
numbered as (
  select *, sum(case when h.p <> '' then 1 else 0 end) over (partition by run_id order by i) - 1 as seg from header),
segment as (
  select run_id, cast(seg as integer) as index, max(case when h.p <> '' then h.c end) as pass_class,
    max(case when h.p <> '' then h.p end) as pass_name,
    regexp_replace(coalesce(string_agg(line, chr(10) order by i) filter (where h.p = ''), ''), '\s+$', '') || chr(10)
      as body
  from numbered where seg >= 0 group by run_id, seg)"""

_DOC = """doc as (
  select doc_id, source as benchmark_name, lang as pass_name, 'Lang::' || lang as pass_class,
    '20240101-' || lpad(cast(doc_id % 50 as varchar), 6, '0') as run_timestamp, cast(doc_id as integer) as pass_index, text
  from documents)"""

# The longest prefix of at most so many bytes, found among all prefix lengths that can fit.
_CAPPED = """case when strlen(text) > {0} then left(text, list_max(list_filter(range({0} // 4, {0} + 1),
    lambda k: strlen(left(text, k)) <= {0}))) else text end"""
_CAP = _CAPPED.format(4096)
_WHOLE_CAP = _CAPPED.format(2097152)

_DIALECTS = r"""coalesce(array_to_string(list_sort(list_distinct(regexp_extract_all({0},
    '(?:^|[^\pL\pN_])([a-z_][a-z0-9_]*)\.[a-z_][a-z0-9_]+', 1))), ','), '')"""

_RUNS = r"""listed as (
  select case when conv_id % 11 = 0 then 'batch-runs' else 'bench-' || (conv_id % 20) || '-cuda-20240101-'
    || lpad(cast(conv_id as varchar), 6, '0') end as run_dir, cast(max(length(text)) as integer) as modified
  from conversations group by conv_id),
run as (
  select *, regexp_extract(run_dir, '^(.+)-(\d{8}-\d{6})$', 1) as benchmark_name,
    regexp_extract(run_dir, '^(.+)-(\d{8}-\d{6})$', 2) as run_timestamp
  from listed where regexp_matches(run_dir, '^(.+)-(\d{8}-\d{6})$'))"""

_STATUS = """case exit_code when 0 then 'success' when 1 then 'driver_error' when 2 then 'compile_fail'
    when 3 then 'parse_fail' when 4 then 'roundtrip_fail' when 5 then 'partial_kept' when 124 then 'timeout'
    when 137 then 'killed' else 'unknown_' || exit_code end"""

_CLEAN = """left(replace(replace(replace(replace({0}, ',', ';'), chr(10), ' '), chr(13), ' '), '"', ''), 200)"""

_SUMMARY = f"""attempt as (
  select 'bench-' || user_id || '-' || event_id as benchmark,
    cast(case event_type when 'view' then 0 when 'click' then 5 when 'signup' then 2
      when 'error' then case event_id % 3 when 0 then 1 when 1 then 124 else 99 end
      else case event_id % 4 when 0 then 0 when 1 then 3 when 2 then 4 else 137 end end as integer) as exit_code,
    cast(event_id % 8 as integer) as snapshots, cast(floor(value) as integer) as wall_seconds,
    case when event_type = 'view' then '' else 'error: in "f' || (event_id % 6) || '.h",' || chr(10) || 'code  '
      || (event_id % 4) || ', ' || repeat('x', cast(event_id % 250 as integer)) end as raw_error
  from events),
summary as (
  select benchmark, exit_code, {_STATUS} as status, snapshots, wall_seconds,
    {_CLEAN.format('raw_error')} as first_error
  from attempt)"""

_LOG = """log as (
  select 'u' || user_id as benchmark, event_id as line_no,
    case event_type when 'error' then 'f.cu:' || event_id || ': error: bad ' || (event_id % 9)
      when 'signup' then 'In file included from f' || (event_id % 5) || '.h'
      when 'purchase' then case when event_id % 3 = 0 then 'a.h:1: warning: w'
        when event_id % 3 = 1 then '2 errors generated.'
        else 'Parsed ' || (event_id % 8) || ' snapshots into out' end
      when 'click' then 'error: driver ' || event_id else 'note ' || event_id end as line
  from events),
diag as (
  select benchmark, 0 as group_no, line_no, line from log
  where regexp_matches(line, '(error|fatal error|warning): |errors generated')
  union all
  select benchmark, 1, line_no, line from log where line like 'In file included from %'),
facts as (
  select benchmark, arg_min(line, line_no) filter (where line like 'error:%') as first_driver_error,
    arg_min(line, line_no) filter (where line like '%parser%' or line like '%error%') as first_parse_error,
    arg_min(line, line_no) filter (where line like '%error:%') as first_any_error,
    arg_min(try_cast(regexp_extract(line, '([0-9]+) snapshots', 1) as integer), line_no)
      filter (where regexp_matches(line, '[0-9]+ snapshots')) as counted_snapshots
  from log group by benchmark)"""

_LOG_TEXT = """log as (
  select doc_id as run_id, array_to_string(list_transform(string_split(text, ' '), lambda w, j: case length(w) % 17
    when 12 then 'f.cu:' || (j - 1) || ': error: bad ' || w
    when 13 then 'In file included from ' || w || '.h'
    when 14 then 'a.h:1: warning: ' || w
    when 15 then (j - 1) || ' errors generated.'
    when 16 then 'Parsed ' || (j - 1) || ' snapshots into ' || w
    when 11 then 'error: driver ' || w
    when 10 then 'the parser said ' || w
    else 'note ' || w end), chr(10)) as text
  from documents),
whole as (
  select run_id, string_split(case when ends_with(text, chr(10)) then left(text, length(text) - 1) else text end, chr(10))
    as lines from log),
line as (
  select run_id, unnest(lines) as line, cast(generate_subscripts(lines, 1) - 1 as integer) as line_no from whole),
diag as (
  select run_id, 0 as group_no, line_no, line from line
  where regexp_matches(line, '(error|fatal error|warning): |errors generated')
  union all
  select run_id, 1, line_no, line from line where line like 'In file included from %')"""

_LISTING = """listing as (
  select 'p' || (p_partkey % 900) || case when p_partkey % 900 % 4 = 3 then '-omp' else '-cuda' end as benchmark,
    case p_partkey % 7 when 0 then 'main.cu' when 1 then 'src/main.cu' when 2 then 'lib/main.cu'
      when 3 then 'kernel' || p_size || '.cu' when 4 then 'util.cuh' when 5 then 'a/b/main.cu'
      else 'src/' || p_partkey || '.cu' end as rel_path
  from part)"""

_MODULE_LINE = """case length(w) % 10
    when 8 then
      case when left(w, 1) in ('e', 't') then 'cir.func @main_' when left(w, 1) in ('s', 'd') then 'llvm.func @_ZSt3'
           when left(w, 1) in ('a', 'é') then '  cir.func @kernel_'
           when left(w, 1) in ('i', 'o') then 'llvm.func private @cudaLaunch_' else 'cir.func @helper_' end
      || w || case when right(w, 1) in ('n', 'e', 't', 'r') then ' {' else '()' end
    when 9 then '  scf.if ' || w || ' {'
    when 7 then '}'
    when 6 then '  }'
    when 0 then ''
    else '  ' || w end"""

# Spans in set form: a function ends at the first line at which the running depth is back to where it started, and only
# functions that no earlier function covers are kept.
_FUNCTIONS = f"""module as (
  select source as benchmark_name, lang as pass_name, cast(doc_id as integer) as pass_index,
    array_to_string(list_transform(string_split(text, ' '), lambda w: {_MODULE_LINE}), chr(10)) as ir_text
  from documents),
whole as (
  select *, case when ir_text = '' then [] when ends_with(ir_text, chr(10)) then string_split(left(ir_text,
    length(ir_text) - 1), chr(10)) else string_split(ir_text, chr(10)) end as lines
  from module),
line as (
  select pass_index, unnest(lines) as line, generate_subscripts(lines, 1) - 1 as i from whole),
delta as (
  select *, contains(line, 'cir.func') or contains(line, 'llvm.func') as f,
    (length(line) - length(replace(line, '{{', ''))) - (length(line) - length(replace(line, '}}', ''))) as d
  from line),
depth as (
  select *, sum(d) over (partition by pass_index order by i) as c, max(i) over (partition by pass_index) as last
  from delta),
closing as (
  select s.pass_index, s.i, s.line, coalesce(min(x.i), any_value(s.last)) as e
  from depth s left join depth x on x.pass_index = s.pass_index and x.i >= s.i and x.c <= s.c - s.d and x.d <= 0
  where s.f group by all),
outermost as (
  select *, max(e) over (partition by pass_index order by i rows between unbounded preceding and 1 preceding) as covered
  from closing),
func as (
  select pass_index, cast(row_number() over (partition by pass_index order by i) - 1 as integer) as ordinal,
    cast(i as integer) as start_line, cast(e as integer) as end_line,
    regexp_replace(line, '^\\s+|\\s+$', '', 'g') as signature
  from outermost where covered is null or covered < i),
described as (
  select *, lower(signature) as low,
    signature <> '' and (contains(low, '@main') or contains(low, 'device_stub') or contains(low, 'cudalaunch')
      or contains(low, 'kernel') or not regexp_matches(low,
      'std|chrono|random|_zst|__gnu|basic_string|allocator|char_traits|ratio|duration|operator')) as is_user,
    case when contains(low, '@main') then 0 when contains(low, 'device_stub') or contains(low, 'kernel') then 1
      else 2 end as priority
  from func),
counted as (
  select w.pass_index, cast(count(d.ordinal) as integer) as n_total,
    cast(count(d.ordinal) filter (where is_user) as integer) as n_user
  from whole w left join described d on d.pass_index = w.pass_index group by w.pass_index)"""


def _packed(max_lines: int) -> str:
    """Budget by prefix sums over unclipped lengths, which is the same as a running remainder."""
    return f"""{_FUNCTIONS},
header as (
  select w.pass_index, case when len(h) > 0 and h[-1] = '' then h[:-2] else h end as hl
  from (select pass_index, lines[1:coalesce((select min(start_line) from func f where f.pass_index = w.pass_index), 0)] as h
        from whole w) w),
top as (
  select pass_index, list_concat(hl[1:8], case when len(hl) > 8 then ['// ... (' || (len(hl) - 8)
    || ' more type/attr declarations)'] else [] end, ['']) as shown
  from header),
block as (
  select d.pass_index, d.ordinal, d.priority, lines[start_line + 1:end_line + 1] as raw,
    case when raw[-1] = '' and len(raw) > 1 then raw[:-2] else raw end as body
  from described d join whole w on w.pass_index = d.pass_index where is_user),
budgeted as (
  select b.*, {max_lines} - len(t.shown) as budget, coalesce(sum(len(body) + 1) over (partition by b.pass_index
    order by priority, ordinal rows between unbounded preceding and 1 preceding), 0) as used
  from block b join top t on t.pass_index = b.pass_index),
emitted as (
  select *, array_to_string(case when len(body) > budget - used
    then list_concat(body[1:cast(budget - used as bigint)], ['    // ... (function body truncated to fit budget)', ''])
    else list_concat(body, ['']) end, chr(10)) as out
  from budgeted where used < budget),
joined as (
  select pass_index, count(*) as taken, string_agg(out, chr(10) order by priority, ordinal) as out from emitted group by 1),
packed as (
  select w.benchmark_name, w.pass_name, w.pass_index, n_user, n_total,
    case when n_user = 0 then array_to_string(lines[1:{max_lines}], chr(10))
    else array_to_string(t.shown, chr(10)) || coalesce(chr(10) || out, '') || case when coalesce(taken, 0) < n_user
      then chr(10) || '// ... (' || (n_user - coalesce(taken, 0)) || ' more user functions omitted for length)' else '' end
    end as signal
  from whole w join counted c on c.pass_index = w.pass_index join top t on t.pass_index = w.pass_index
    left join joined j on j.pass_index = w.pass_index)"""


_TIER = """case when s >= 0.95 then 'universal' when s >= 0.7 then 'common' when s >= 0.3 then 'half'
    when s >= 0.01 then 'selective' else 'rare' end"""

ORACLES: dict[str, str] = {
    "decode_text": """with d as (select doc_id, replace(text, '. ', '.' || chr(10)) || chr(10) || chr(65533) || 'end' as t
        from documents)
        select doc_id, sha256(t) as sha256, cast(strlen(t) as bigint) as bytes,
          cast(length(t) - length(replace(t, chr(10), '')) as integer) as lines from d""",
    "line_table": """with d as (select doc_id, case when ends_with(text, chr(10)) then left(text, length(text) - 1)
          else text end as t from documents where text <> '')
        select doc_id, unnest(string_split(t, chr(10))) as line,
          cast(generate_subscripts(string_split(t, chr(10)), 1) - 1 as integer) as line_no from d""",
    "finish_body": r"""with d as (select doc_id, regexp_replace(text, '\s+$', '') || chr(10) as t from documents)
        select doc_id, sha256(t) as sha256, cast(strlen(t) as bigint) as bytes from d""",
    "cap_text": f"""with d as (select doc_id, strlen(text) > 4096 as truncated, {_CAP} as t from documents)
        select doc_id, truncated, sha256(t) as sha256, cast(strlen(t) as bigint) as bytes from d""",
    "dialects": f"select page_id, {_DIALECTS.format('html')} as dialects from pages",
    "snapshot_filename": rf"""with {_SNAP} select run_id, pass_index, printf('%02d_%s.mlir', pass_index,
        regexp_replace(pass_name || ' / ' || pass_class, '[^\w\-]+', '_', 'g')) as filename from snap""",
    "run_dir_parse": f"with {_RUNS} select run_dir, benchmark_name, run_timestamp from run",
    "segment_stream": f"with {_CONV_STREAM}, {_SEGMENTS} select run_id, index, pass_class, pass_name, body from segment",
    "segment_rows": f"""with {_STREAM}, {_SEGMENTS} select run_id, index, pass_class, pass_name,
        printf('%02d_%s.mlir', index, pass_name) as filename, cast(strlen(body) as bigint) as bytes,
        cast(length(body) - length(replace(body, chr(10), '')) as integer) as lines, sha256(body) as sha256,
        lag(sha256(body)) over (partition by run_id order by index) as parent_sha256 from segment""",
    "segment_provenance": f"""with {_STREAM}, {_SEGMENTS},
        n as (select run_id, count(*) as c from segment group by 1)
        select s.run_id, source, sha256(source_text) as source_sha256, stream_file, sha256(stream) as stream_sha256,
          cast(coalesce(c, 0) as integer) as snapshot_count
        from stream s left join n on n.run_id = s.run_id""",
    "hash_chain": f"""with {_CHAINED} select run_id, pass_index, cast(bytes as bigint) as bytes, lines, sha256,
        parent_sha256 from chained""",
    "roundtrip_outcomes": f"""with {_SNAP} select run_id, filename,
        case roundtrip_status when 'ok' then 'OK' else 'DROP' end as outcome,
        case when roundtrip_status <> 'ok' then cast(run_id as integer) end as exit_code from snap""",
    "roundtrip_annotate": f"with {_SNAP} select run_id, pass_index as index, filename, roundtrip_status from snap",
    "drop_failed": f"with {_SNAP} select run_id, pass_index as index, filename from snap where roundtrip_status = 'ok'",
    "dropped_only": f"""with {_SNAP} select run_id, pass_index as index, filename from snap
        where roundtrip_status <> 'ok'""",
    "kept_dropped": f"""with {_SNAP} select run_id, cast(count(*) as integer) as snapshot_count,
        cast(count(*) filter (where roundtrip_status = 'ok') as integer) as snapshots_kept,
        cast(count(*) filter (where roundtrip_status = 'failed') as integer) as snapshots_dropped from snap group by 1""",
    "run_status": f"""with {_SNAP}, n as (select run_id, cast(count(*) as integer) as snapshot_count,
        cast(count(*) filter (where roundtrip_status = 'ok') as integer) as snapshots_kept,
        cast(count(*) filter (where roundtrip_status = 'failed') as integer) as snapshots_dropped from snap group by 1),
        c as (select *, case when run_id % 10 = 0 then 2 when snapshots_dropped = 0 then 0 when snapshots_kept = 0 then 4
          else 5 end as exit_code from n)
        select *, {_STATUS} as status from c""",
    "manifest_roundtrip": f"""with {_CHAINED}, n as (select run_id, cast(count(*) as integer) as snapshot_count,
          cast(count(*) filter (where roundtrip_status = 'ok') as integer) as snapshots_kept from snap group by 1)
        select c.run_id, case when c.run_id % 3 <> 0 then sha256(cast(c.run_id as varchar)) end as source_sha256,
          snapshots_kept, snapshot_count, pass_index as index, pass_class, pass_name, filename,
          cast(bytes as bigint) as bytes, lines, sha256, parent_sha256, roundtrip_status
        from chained c join n on n.run_id = c.run_id""",
    "manifest_elements": f"""with {_CHAINED}
        select 'b' || (run_id % 20) as benchmark_name, cast(run_id as varchar) as run_timestamp,
          case when run_id % 5 = 2 then '' when run_id % 3 <> 0 then sha256(cast(run_id as varchar)) end as source_sha256,
          cast(pass_index // 3 as bigint) * 2147483648 + pass_index % 3 as manifest_pos, 'runs/' || run_id || '/' || filename as path,
          pass_index, pass_class, pass_name, filename, sha256 as manifest_sha256, parent_sha256, roundtrip_status
        from chained where not (run_id % 7 = 3 and pass_index = 1)""",
    "valid_only": f"with {_SNAP} select run_id, pass_index, pass_name from snap where roundtrip_status = 'ok'",
    "dedup_latest": f"""with {_CHAINED}, {_LATEST} select benchmark_name, pass_name, run_timestamp, pass_index
        from latest""",
    "corpus_order": f"""with {_CHAINED}, {_LATEST} select benchmark_name, pass_index, pass_name, run_timestamp
        from latest order by 1, 2, 4, 3""",
    "dedup_report": f"""with {_SNAP} select count(*) as candidates,
        count(distinct benchmark_name || '/' || pass_name) as unique_snapshots,
        count(*) - count(distinct benchmark_name || '/' || pass_name) as duplicates_dropped
        from snap where roundtrip_status = 'ok'""",
    "capture_to_corpus": f"""with {_STREAM}, {_SEGMENTS},
        named as (select *, printf('%02d_%s.mlir', index, pass_name) as filename, sha256(body) as sha256, strlen(body) as n from segment),
        linked as (select *, lag(sha256) over (partition by run_id order by index) as parent_sha256,
          'b' || (run_id % 20) || '-' || cast(floor(run_id / 50) as bigint) as benchmark_name,
          '20240101-' || lpad(cast(run_id % 50 as varchar), 6, '0') as run_timestamp from named),
        ranked as (select *, row_number() over (partition by benchmark_name, pass_name order by run_timestamp desc, index) as rn
          from linked where n % 7 <> 0)
        select benchmark_name, 'cuda-host' as source_lang, index as pass_index, pass_class, pass_name, body as ir_text,
          cast(n as bigint) as ir_bytes, cast(length(body) - length(replace(body, chr(10), '')) as integer) as ir_lines,
          sha256 as ir_sha256, parent_sha256, false as truncated, {_DIALECTS.format('body')} as dialects_present,
          cast(null as varchar) as source_sha256, run_timestamp, '2024-01-01T00:00:00Z' as corpus_ingest_utc
        from ranked where rn = 1""",
    "compression_report": """with t as (select cast(coalesce(sum(strlen(text)), 0) as bigint) as text_bytes from documents),
        f as (select cast(coalesce(sum(strlen(html)), 0) as bigint) as disk_bytes from pages)
        select text_bytes, disk_bytes, case when disk_bytes > 0 then text_bytes / disk_bytes end as ratio from t, f""",
    "ir_hash_dedup": f"""with {_DOC}, d as (select *, sha256(text) as ir_sha256 from doc),
        k as (select *, row_number() over w as rn, count(*) over (partition by ir_sha256) as copies from d
          window w as (partition by ir_sha256 order by benchmark_name, pass_index, run_timestamp, pass_name))
        select benchmark_name, pass_name, pass_index, run_timestamp, ir_sha256, copies from k where rn = 1""",
    "lookup_pass": f"with {_DOC} select benchmark_name, pass_name, pass_index from doc where pass_name = 'de'",
    "corpus_rows": f"""with {_DOC}, ranked as (select *, row_number() over (partition by benchmark_name, pass_name
          order by run_timestamp desc, doc_id) as rn from doc)
        select benchmark_name, 'cuda-host' as source_lang, pass_index, pass_class, pass_name, {_WHOLE_CAP} as ir_text,
          cast(strlen(text) as bigint) as ir_bytes,
          cast(length(text) - length(replace(text, chr(10), '')) as integer) as ir_lines, sha256(text) as ir_sha256,
          cast(null as varchar) as parent_sha256, strlen(text) > 2097152 as truncated,
          {_DIALECTS.format('text')} as dialects_present, cast(null as varchar) as source_sha256, run_timestamp,
          '2024-01-01T00:00:00Z' as corpus_ingest_utc
        from ranked where rn = 1""",
    "size_report": f"""select count(*) as n_rows, count(*) filter (where strlen(text) > 4096) as truncated_rows,
        cast(sum(strlen(text)) as bigint) as bytes_before, cast(sum(strlen({_CAP})) as bigint) as bytes_after
        from documents""",
    "partition_report": """select source as benchmark_name, count(*) as n_rows, cast(sum(strlen(text)) as bigint) as ir_bytes
        from documents group by 1 order by 1""",
    "planned_partitions": f"""with {_SNAP} select count(distinct benchmark_name) as partitions from snap
        where roundtrip_status = 'ok'""",
    "dialect_frequency": f"""with p as (select {_DIALECTS.format('html')} as ds from pages),
        x as (select unnest(string_split(ds, ',')) as dialect from p where ds <> '')
        select dialect, count(*) as n from x group by 1 order by n desc, dialect limit 12""",
    "distinct_dialects": f"""with p as (select {_DIALECTS.format('html')} as ds from pages),
        x as (select unnest(string_split(ds, ',')) as dialect from p where ds <> '')
        select count(distinct dialect) as distinct_dialects from x""",
    "pass_frequency": f"""with {_SNAP}, v as (select * from snap where roundtrip_status = 'ok'),
        t as (select count(distinct benchmark_name) as total_benchmarks from v),
        p as (select pass_name, count(distinct benchmark_name) as benchmarks from v group by 1),
        q as (select *, benchmarks / total_benchmarks as s from p, t)
        select pass_name, benchmarks, total_benchmarks, round(s, 6) as share, {_TIER} as tier from q""",
    "snapshots_per_benchmark": f"""with {_SNAP}, {_RUNS},
        p as (select benchmark_name, count(*) as n from snap where roundtrip_status = 'ok' group by 1),
        t as (select count(distinct run_dir) as attempted from listed)
        select min(n) as min_snapshots, max(n) as max_snapshots, cast(sum(n) as bigint) as total_snapshots,
          count(*) as benchmarks, round(sum(n) / count(*), 6) as avg_present, any_value(attempted) as attempted,
          round(sum(n) / any_value(attempted), 6) as avg_attempted from p, t""",
    "lookup": f"""with {_DOC} select benchmark_name, pass_name, pass_index from doc
        where benchmark_name = 'src3' and pass_name = 'en'""",
    "lookup_first": f"""with {_DOC} select benchmark_name, pass_name, pass_index, sha256(text) as sha256 from doc
        where benchmark_name = 'src3' order by pass_index limit 1""",
    "parent_links": f"""with {_CHAINED}, {_LATEST},
        p as (select *, row_number() over (partition by benchmark_name, sha256 order by pass_index, pass_name, run_timestamp)
          as k from latest)
        select c.benchmark_name, c.pass_index, c.pass_name, c.run_timestamp, c.sha256 as ir_sha256, c.parent_sha256,
          p.pass_index as parent_pass_index, p.pass_name as parent_pass_name, p.run_timestamp as parent_run_timestamp,
          case when c.parent_sha256 is null then 'root' when p.sha256 is null then 'dangling' else 'linked' end as link
        from latest c left join p on p.benchmark_name = c.benchmark_name and p.sha256 = c.parent_sha256 and p.k = 1""",
    "chain_report": f"""with {_CHAINED}, {_LATEST},
        x as (select *, exists (select 1 from latest p where p.benchmark_name = c.benchmark_name
          and p.sha256 = c.parent_sha256) as found from latest c)
        select benchmark_name, count(*) filter (where parent_sha256 is null) as root,
          count(*) filter (where found) as linked,
          count(*) filter (where parent_sha256 is not null and not found) as dangling from x group by 1""",
    "latest_run": f"""with {_RUNS}, k as (select *, row_number() over (partition by benchmark_name
          order by modified desc, run_dir desc) as rn from run)
        select benchmark_name, run_dir, modified from k where rn = 1""",
    "batch_summary": f"with {_SUMMARY} select * from summary",
    "status_breakdown": f"with {_SUMMARY} select status, count(*) as n from summary group by 1 order by 2 desc, 1 desc",
    "failure_modes": f"""with {_SUMMARY}, k as (select status || ': ' || left(first_error, 60) as k, count(*) as n
          from summary where status <> 'success' group by 1 order by n desc, k desc limit 15)
        select trim(regexp_replace(k, '[ \\t\\n]+', ' ', 'g')) as failure_mode, n from k""",
    "not_success": f"with {_SUMMARY} select benchmark, status from summary where status <> 'success'",
    "batch_ok": f"""with {_SUMMARY}, k as (select count(*) filter (where status <> 'success') as not_success from summary)
        select not_success, not_success = 0 as ok from k""",
    "retention": f"""with {_SUMMARY}, k as (select count(*) as attempted,
          count(*) filter (where status in ('success', 'partial_kept')) as retained from summary)
        select *, round(retained / attempted, 6) as retention from k""",
    "diagnostics": f"with {_LOG} select benchmark, group_no, line_no, line from diag",
    "failure_excerpt": f"""with {_LOG},
        d as (select benchmark, line, cast(row_number() over (partition by benchmark order by group_no, line_no) as integer)
          as rank from diag),
        r as (select benchmark, line, line_no, row_number() over (partition by benchmark order by line_no desc) as b
          from log where benchmark not in (select benchmark from diag)),
        t as (select benchmark, line, cast(row_number() over (partition by benchmark order by line_no) as integer) as rank
          from r where b <= 20)
        select benchmark, rank, line, 'diagnostic' as kind from d where rank <= 10
        union all select benchmark, rank, line, 'raw' from t""",
    "log_facts": f"with {_LOG} select * from facts",
    "first_error": f"""with {_LOG},
        attempt as (select 'u' || user_id as benchmark, cast(case user_id % 9 when 6 then 124 when 7 then 137 when 8 then 99
            else user_id % 9 end as integer) as exit_code, cast(max(event_id) as integer) as wall_seconds
          from events group by user_id),
        dfirst as (select benchmark, line from diag qualify row_number() over (partition by benchmark
          order by group_no, line_no) = 1),
        note as (select benchmark, 'DROP ' || arg_min(line, line_no) as line from log where line like 'note%' group by 1),
        s as (select *, {_STATUS} as status from attempt),
        e as (select s.*, f.*, coalesce(nullif(case status when 'compile_fail' then d.line
              when 'roundtrip_fail' then n.line when 'driver_error' then first_driver_error
              when 'timeout' then 'killed after 60s' when 'killed' then 'killed after 60s'
              when 'parse_fail' then first_parse_error end, ''),
            case when exit_code <> 0 then first_any_error end, '') as err
          from s left join facts f on f.benchmark = s.benchmark left join dfirst d on d.benchmark = s.benchmark
            left join note n on n.benchmark = s.benchmark)
        select benchmark, exit_code, status, case when exit_code in (0, 4, 5) then coalesce(counted_snapshots, 0) else 0 end
          as snapshots, wall_seconds, {_CLEAN.format('err')} as first_error from e""",
    "text_diagnostics": f"with {_LOG_TEXT} select run_id, group_no, line_no, line from diag",
    "text_excerpt": f"""with {_LOG_TEXT},
        d as (select *, row_number() over (partition by run_id order by group_no, line_no) as k from diag),
        s as (select run_id, string_agg(line, chr(10) order by k) as shown from d where k <= 10 group by 1)
        select w.run_id, case when s.shown is null then 'raw' else 'diagnostic' end as kind,
          coalesce(s.shown, array_to_string(list_reverse(list_reverse(lines)[1:20]), chr(10))) as shown
        from whole w left join s on s.run_id = w.run_id""",
    "text_log_facts": f"""with {_LOG_TEXT}
        select run_id, arg_min(line, line_no) filter (where line like 'error:%') as first_driver_error,
          arg_min(line, line_no) filter (where line like '%parser%' or line like '%error%') as first_parse_error,
          arg_min(line, line_no) filter (where line like '%error:%') as first_any_error,
          arg_min(try_cast(regexp_extract(line, '([0-9]+) snapshots', 1) as integer), line_no)
            filter (where regexp_matches(line, '[0-9]+ snapshots')) as counted_snapshots
        from line group by run_id""",
    "discover_benchmarks": f"""with {_LISTING} select distinct benchmark as name from listing
        where benchmark like '%-cuda' order by 1 limit 20""",
    "discover_all_benchmarks": f"""with {_LISTING} select distinct benchmark as name from listing
        where benchmark like '%-cuda' order by 1""",
    "select_source_file": f"""with {_LISTING},
        r as (select *, case when rel_path = 'main.cu' then 1 when rel_path = 'src/main.cu' then 2
            when rel_path like '%main.cu' and regexp_matches(rel_path, '^[^/]+/main.cu$') then 3
            when ends_with(rel_path, '.cu') and length(rel_path) - length(replace(rel_path, '/', '')) <= 1 then 4 end as rank
          from listing),
        k as (select *, row_number() over (partition by benchmark order by rank nulls last, rel_path) as rn,
          count(distinct rel_path) filter (where rank = 4) over (partition by benchmark) as n4 from r)
        select benchmark, case when rank is not null then rel_path end as source_path, rank,
          coalesce(rank = 4 and n4 > 1, false) as ambiguous,
          case when rank is null then 'could not find a source file' end as error from k where rn = 1""",
    "function_spans": f"with {_FUNCTIONS} select pass_index, ordinal, start_line, end_line from func",
    "functions": f"""with {_FUNCTIONS} select w.benchmark_name, w.pass_name, f.pass_index, ordinal, signature,
          cast(end_line - start_line + 1 as integer) as n_lines,
          sha256(array_to_string(lines[start_line + 1:end_line + 1], chr(10))) as body_sha256
        from func f join whole w on w.pass_index = f.pass_index""",
    "functions_in_blocks": f"""with {_FUNCTIONS} select d.pass_index, ordinal, signature, is_user, priority,
          cast(end_line - start_line + 1 as integer) as n_lines,
          sha256(array_to_string(lines[start_line + 1:end_line + 1], chr(10))) as body_sha256
        from described d join whole w on w.pass_index = d.pass_index""",
    "user_functions": f"""with {_FUNCTIONS} select pass_index, ordinal, priority, signature,
        cast(end_line - start_line + 1 as integer) as n_lines from described where is_user""",
    "snapshot_summary": f"""with {_FUNCTIONS} select w.benchmark_name, w.pass_name, w.pass_index,
          cast(length(ir_text) - length(replace(ir_text, chr(10), '')) as integer) as ir_lines,
          cast(strlen(ir_text) as bigint) as ir_bytes, n_user, n_total
        from whole w join counted c on c.pass_index = w.pass_index""",
    "pack_signal": f"""with {_packed(200)} select pass_index, n_user, n_total, sha256(signal) as signal_sha256,
        cast(length(signal) as integer) as signal_chars from packed""",
    "pack_signal_tight": f"with {_packed(24)} select pass_index, n_user, n_total, signal from packed",
    "prompts": f"""with {_packed(200)} select benchmark_name, pass_name, pass_index, n_user, n_total,
          'system' as first_role, sha256('You are a compiler engineer fluent in MLIR and Python. '
            || 'You are given the SIGNAL portion of an MLIR module (ClangIR/LLVM dialects) produced by lowering a CUDA/C++ program. '
            || 'Library boilerplate has been stripped; what remains is the user''s own functions (main, CUDA kernel stubs, helpers). '
            || 'Write a short, readable Python program that performs the same high-level computation. '
            || 'Focus on observable behavior, not literal op-by-op translation. '
            || 'Output only a Python code block and one or two sentences of explanation.') as system_sha256, 'user' as second_role,
          sha256('Benchmark: ' || benchmark_name || chr(10) || 'Pass stage: ' || pass_name || ' (index ' || pass_index || ')'
            || chr(10) || 'Kept ' || n_user || ' user functions out of ' || n_total || ' total in the module.' || chr(10)
            || chr(10) || 'MLIR (signal only):' || chr(10) || '```mlir' || chr(10) || signal || chr(10) || '```' || chr(10)
            || chr(10) || 'Write equivalent Python.') as user_sha256
        from packed""",
}
