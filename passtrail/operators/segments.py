"""Dump streams to ordered snapshots with a hash chain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passtrail.functions import ir
from passtrail.functions import text as tx
from passtrail.operators.pieces import BODY, RECORDS, fold_pieces
from passtrail.operators.scale import BROADCAST_BYTES, fits_broadcast, previous_by_index, running_total_before, settle

SNAPSHOT_COLUMNS = ("index", "pass_class", "pass_name", "filename", "bytes", "lines", "sha256", "parent_sha256")


def _pieces(text: Column) -> Column:
    return F.split(text, ir.HEADER_START, -1)


def segment_array(stream: Column) -> Column:
    """Snapshots of one whole stream as an array. Nothing leaves the row, so there is no shuffle."""

    def with_bodies(pieces: Column) -> Column:
        bodies = F.transform(pieces, lambda p: tx.finish_body(tx.drop_first_line(p)))
        return tx.let(bodies, lambda texts: tx.let(F.transform(texts, tx.sha256_hex), lambda hashes: rows(pieces, texts, hashes)))

    def rows(pieces: Column, bodies: Column, hashes: Column) -> Column:
        def row(piece: Column, i: Column) -> Column:
            body, name = F.get(bodies, i), ir.header_pass(piece)
            return F.struct(
                i.cast("int").alias("index"),
                ir.header_class(piece).alias("pass_class"),
                name.alias("pass_name"),
                ir.snapshot_filename(i.cast("int"), name).alias("filename"),
                tx.byte_count(body).alias("bytes"),
                tx.line_count(body).alias("lines"),
                F.get(hashes, i).alias("sha256"),
                F.get(hashes, i - 1).alias("parent_sha256"),
                body.alias("body"),
            )

        return F.transform(pieces, row)

    # A cut is made where a header starts, so only what comes before the first one has none.
    def headed(pieces: Column) -> Column:
        return F.when(ir.is_header(F.get(pieces, F.lit(0))), pieces).otherwise(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))))

    return tx.let(tx.let(_pieces(stream), headed), with_bodies)


def segment_streams(streams: DataFrame, keep: Sequence[str] = ("run_id",), stream: str = "stream") -> DataFrame:
    """One row per snapshot of each stream; a stream without a header gives no rows."""
    return streams.select(*keep, F.inline(segment_array(F.col(stream))))


def narrow_streams(streams: DataFrame, run: str = "run_id") -> DataFrame:
    """What a manifest needs of (run, stream_file, stream), from one reading: the stream's hash and its snapshots without bodies."""
    snapshot = F.transform(segment_array(F.col("stream")), lambda s: F.struct(*[s[c].alias(c) for c in SNAPSHOT_COLUMNS]))
    return streams.select(run, "stream_file", tx.sha256_hex(F.col("stream")).alias("stream_sha256"), snapshot.alias("snapshots"))


def segment_blocks(
    blocks: DataFrame, run: str = "run_id", block: str = "block", text: str = "text", cap_bytes: int | None = None
) -> DataFrame:
    """Snapshots of streams that arrive in numbered blocks of whole lines, for streams too large for one value: the run, ``index``,
    ``pass_class``, ``pass_name``, ``filename``, ``bytes``, ``lines``, ``sha256`` and ``body``.

    A block's text before its first header belongs to the snapshot that was open when the block began, so each block
    needs the number of headers in earlier blocks. The counts are taken in one pass over the texts and added up without
    them; a second pass cuts the texts. Both passes must see the same numbers: ``blocks`` has to be stored, or to follow from
    its input alone.

    Pieces of bodies are shuffled once and folded in order, so a snapshot need not fit a value: size, lines and hash are always of
    the whole body, and ``cap_bytes`` bounds what is kept of its text. Starts a job.
    """
    pieces = segment_pieces(blocks, run, block, text)
    folded = fold_pieces(pieces, [run, "index"], ["block", "from_end"], "piece", BODY, cap_bytes, ["pass_class", "pass_name"])
    return folded.select(
        run, "index", "pass_class", "pass_name", ir.snapshot_filename(F.col("index"), F.col("pass_name")).alias("filename"), "bytes",
        "lines", "sha256", F.col("head").alias("body"),
    )


def segment_pieces(blocks: DataFrame, run: str = "run_id", block: str = "block", text: str = "text") -> DataFrame:
    """The bodies of snapshots in pieces: the run, ``index``, ``block``, ``from_end``, ``pass_class``, ``pass_name``, ``piece``.

    (``block``, ``from_end``) orders the pieces of a snapshot, and the first one has the names. Bodies are not yet stripped.
    """
    counted = settle(blocks.select(run, block, header_count(F.col(text)).alias("_headers")))
    before = running_total_before(counted, [run], block, "_headers", "_before").select(run, block, "_before", "_headers")
    # The stored counts have as many rows as the running totals and are cheaper to measure.
    if fits_broadcast(counted, BROADCAST_BYTES // 2):
        before = F.broadcast(before)
    placed = blocks.select(run, block, F.col(text).alias("_text")).join(before, [run, block], "left")
    # A block without a count means that the blocks were numbered differently the second time.
    lost = F.raise_error(F.concat(F.lit("no header count for block "), F.col(block).cast("string")))
    placed = placed.withColumn("_before", F.coalesce("_before", lost.cast("long")))
    cut = F.filter(_pieces(F.col("_text")), lambda p: p != "")
    # At most the first piece of a block has no header, so a piece's place from the end gives its snapshot number.
    numbered = tx.let(
        cut,
        lambda ps: F.transform(ps, lambda p, i: F.struct((i - F.size(ps)).alias("from_end"), p.alias("piece"))),
    )
    pieces = placed.select(run, F.col(block).alias("block"), "_before", "_headers", F.inline(numbered).alias("from_end", "_piece"))
    headed, piece = ir.is_header(F.col("_piece")), F.col("_piece")
    return (
        pieces.withColumn("index", (F.col("_before") + F.col("_headers") + F.col("from_end")).cast("int"))
        .filter("index >= 0")
        .select(
            run, "index", "block", "from_end", F.when(headed, ir.header_class(piece)).alias("pass_class"),
            F.when(headed, ir.header_pass(piece)).alias("pass_name"),
            F.when(headed, tx.drop_first_line(piece)).otherwise(piece).alias("piece"),
        )
    )


def hash_chain(
    snapshots: DataFrame, run: str = "run_id", index: str = "index", sha: str = "sha256", width: int = 65_536
) -> DataFrame:
    """Each snapshot's predecessor hash, valid or not. Rows that carry bodies need a small ``width``."""
    return previous_by_index(snapshots, [run], index, sha, "parent_sha256", width)


def header_count(stream: Column) -> Column:
    """Number of snapshots in a whole stream, without cutting it."""
    return F.regexp_count(stream, F.lit(ir.HEADER_START)).cast("int")


def block_provenance(
    blocks: DataFrame, sources: DataFrame | None = None, run: str = "run_id", end: str = RECORDS
) -> DataFrame:
    """``run_provenance`` of streams in blocks (run, stream_file, block, text): the hash is folded over a run's blocks in order.

    ``end`` says how the stream ends: as ``RECORDS`` where each block got a line feed that its record had lost.
    """
    counted = blocks.withColumn("_headers", header_count(F.col("text")))
    counts = counted.groupBy(run).agg(F.sum("_headers").cast("int").alias("snapshot_count"))
    heads = fold_pieces(blocks, [run], ["block"], "text", end, 0, ["stream_file"]).select(
        run, "stream_file", F.col("sha256").alias("stream_sha256")
    )
    return with_sources(heads.join(counts, run), sources, run)


def run_provenance(streams: DataFrame, sources: DataFrame | None = None, run: str = "run_id") -> DataFrame:
    """Run-level manifest fields of whole streams; a run without snapshots has a count of zero.

    ``streams`` has (run, stream_file, stream); ``sources``, if given, has (run, source, source_text). Texts become hashes
    and counts where they are read, so that only narrow rows are joined.
    """
    stream = F.col("stream")
    heads = streams.select(
        run,
        "stream_file",
        tx.sha256_hex(stream).alias("stream_sha256"),
        header_count(stream).alias("snapshot_count"),
    )
    return with_sources(heads, sources, run)


def with_sources(heads: DataFrame, sources: DataFrame | None, run: str = "run_id") -> DataFrame:
    """Run-level rows with the name and the hash of each run's source, if it has one."""
    if sources is None:
        nothing = F.lit(None).cast("string")
        return heads.withColumns({"source": nothing, "source_sha256": nothing})
    named = sources.select(run, "source", tx.sha256_hex(F.col("source_text")).alias("source_sha256"))
    return heads.join(named, run, "left")
