"""Functions of texts that come in numbered blocks of whole lines, for texts too large for one value. A function may cross blocks.

Each block is read once for a summary that does not depend on what came before it: its lines, its net brace depth, the lines at which the
depth falls to a new low, the functions that a scan from its first line finds, and the one among them that it leaves open. Running
sums over the summaries give each block's first line and depth. An open function ends in the first later block whose lowest depth is
down to where the function began; those are found per group of blocks, and from group to group for the first function that a group
leaves open, as that one covers the later ones. Functions are nested or apart, so a block's own finds hold but for those that an earlier
function covers, and this is told by the furthest end of all earlier ones.

Neither a window nor a task ever holds more than ``width`` blocks of a text. Small blocks are first joined to larger ones, so that
most texts are one block, whose functions are found where it lies. For the others, what a block found travels once, beside narrow rows
for places and ends.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passtrail.functions import ir
from passtrail.functions import text as tx
from passtrail.operators import spans
from passtrail.operators.scale import fits_broadcast, running_max_before, running_total_before
from passtrail.operators.scan import Lines, give_back, slices, small_batches
from passtrail.operators.stores import stored

_SUMMARY = (
    "struct<n_lines:bigint,net:bigint,low:bigint,falls:array<struct<line:int,depth:bigint>>,"
    "spans:array<struct<start:int,end:int>>,open:int,base:bigint>"
)
_ARROW = pa.struct(
    [
        ("n_lines", pa.int64()), ("net", pa.int64()), ("low", pa.int64()),
        ("falls", pa.list_(pa.struct([("line", pa.int32()), ("depth", pa.int64())]))),
        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("open", pa.int32()), ("base", pa.int64()),
    ]
)
MERGED_BYTES = 8 << 20
#: A block number beyond all others: the end of a function that is never closed.
NEVER = (1 << 63) - 1


def summaries_of(texts: list[bytes]) -> list[dict]:
    """The summary of each block; see the module. ``low`` is null if the block has no line that alters the depth."""
    lines = Lines(texts)
    out = [dict(n_lines=int(n), net=0, low=None, falls=[], spans=[], open=None, base=None) for n in lines.count.tolist()]
    for t, n, d, f in lines:
        block = out[t]
        before = block["net"]
        after = block["net"] = before + d
        if block["low"] is None or after < block["low"]:
            block["low"] = after
            # An open function's base is below the depth at which a block begins.
            if after < 0:
                block["falls"].append({"line": n, "depth": after})
        if block["open"] is None:
            if not f:
                continue
            block["open"], block["base"] = n, before
        if after <= block["base"]:
            block["spans"].append({"start": block["open"], "end": n})
            block["open"] = block["base"] = None
    return out


def block_summaries(blocks: DataFrame, keys: Sequence[str], block: str, text: str) -> DataFrame:
    """A narrow row per block; its functions carry their signatures, so that texts are not needed again for them."""

    @F.arrow_udf(_SUMMARY)
    def summary(texts: pa.Array) -> pa.Array:
        found = [summary for part in slices(texts) for summary in summaries_of(part)]
        give_back()
        return pa.array(found, _ARROW)

    small_batches(blocks.sparkSession)

    read = blocks.select(*keys, F.col(block).cast("long").alias("block"), F.col(text).alias("_text")).withColumn("s", summary("_text"))

    def described(lines: Column) -> Column:
        def of(start: Column, end: Column) -> Column:
            signature = tx.strip(F.get(lines, start))
            return tx.let(
                ir.function_rank(signature),
                lambda rank: F.struct(
                    start.cast("long").alias("start"), end.cast("long").alias("end"), signature.alias("signature"),
                    (rank >= 0).alias("is_user"), ir.shown_rank(rank).alias("priority"),
                ),
            )

        closed = F.transform("s.spans", lambda s: of(s["start"], s["end"]))
        return F.struct(closed.alias("closed"), F.when(F.col("s.open").isNotNull(), of(F.col("s.open"), F.lit(None).cast("int"))).alias("opened"))

    found = read.select(*keys, "block", "s", tx.let(tx.splitlines(F.col("_text")), described).alias("f"))
    return found.select(*keys, "block", "s.n_lines", "s.net", "s.low", "s.falls", "s.base", "f.closed", "f.opened")


def _run_of_numbers(blocks: DataFrame, keys: list[str], block: str, text: str, most_bytes: int) -> int:
    """How many block numbers may be joined so that no joined block has more than ``most_bytes``, from sums over runs of 256 numbers."""
    sizes = blocks.groupBy(*keys, F.floor(F.col(block).cast("long") / 256).alias("run"))
    size = F.octet_length(text)
    sizes = stored(sizes.agg(F.sum(size).alias("bytes"), F.max(size).alias("largest")), "span-sizes")
    for several in (256, 16, 1):
        joined = sizes.groupBy(*keys, F.floor(F.col("run") / several).alias("run")).agg(F.sum("bytes").alias("bytes"))
        if (joined.agg(F.max("bytes")).first()[0] or 0) <= most_bytes:
            return 256 * several
    return min(256, most_bytes // sizes.agg(F.max("largest")).first()[0])


def merged_blocks(blocks: DataFrame, keys: Sequence[str], block: str, text: str, most_bytes: int = MERGED_BYTES) -> DataFrame:
    """The same texts in fewer blocks (keys, ``block``, ``text``): runs of block numbers are joined, so many that no block has more than
    ``most_bytes``.

    Runs of a large text go to different tasks. A block number that a text has twice is an error. Starts jobs.
    """
    keys = list(keys)
    blocks = blocks.select(*keys, F.col(block).cast("long").alias(block), text)
    run = _run_of_numbers(blocks, keys, block, text, most_bytes)
    if run < 2:
        return blocks
    digits = len(str(run - 1))
    place = F.lpad(F.pmod(F.col(block), F.lit(run)).cast("string"), digits, "0")
    dealt = blocks.select(*keys, F.floor(F.col(block) / run).alias(block), F.concat(place, F.coalesce(F.col(text), F.lit(""))).alias("_part"))
    parts = dealt.groupBy(*keys, block).agg(F.sort_array(F.collect_list("_part")).alias("_parts"))

    def joined(p: Column) -> Column:
        twice = F.size(F.array_distinct(F.transform(p, lambda x: F.left(x, F.lit(digits))))) < F.size(p)
        return F.when(twice, F.raise_error(F.lit("a text has a block number twice")).cast("string")).otherwise(
            F.array_join(F.transform(p, lambda x: F.substring(x, digits + 1, 1 << 30)), "")
        )

    return stored(parts.select(*keys, block, tx.let(F.col("_parts"), joined).alias(text)), "span-merged")


def _first_low(units: pa.Table) -> pa.Table:
    """Within a group of units: for each one that asks, the first later unit whose low is not above its base.

    The smallest unit that finds none asks on behalf of the group.
    """
    unit, low, base, ask = (units[c].to_pylist() for c in ("unit", "low", "base", "ask"))
    order = sorted(range(len(unit)), key=unit.__getitem__, reverse=True)
    # From the back: later units that are lower than all between, the nearest and highest last.
    lows: list[int] = []
    at: list[int] = []
    found = [None] * len(unit)
    for i in order:
        if base[i] is not None:
            # ``lows`` rises, so those not above the base come first, and the last of them is the nearest.
            k = bisect_right(lows, base[i])
            found[i] = at[k - 1] if k else None
        if low[i] is not None:
            while lows and lows[-1] >= low[i]:
                lows.pop()
                at.pop()
            lows.append(low[i])
            at.append(unit[i])
    return units.append_column("found", pa.array(found, pa.int64()))


def _ends(units: DataFrame, keys: Sequence[str], width: int, levels: int) -> DataFrame:
    """(keys, ask, base, end): the unit in which what ``ask`` left open ends, or ``NEVER``; without those that another one covers.

    ``units`` has (keys, unit, low, base, ask), one row per unit.
    """
    keys = list(keys)
    grouped = units.withColumn("group", (F.floor(F.col("unit") / width) if levels else F.lit(0)).cast("long"))
    kind = T.StructType([*grouped.schema.fields, T.StructField("found", T.LongType())])
    searched = stored(grouped.groupBy(*keys, "group").applyInArrow(_first_low, kind), "span-ends")
    here = searched.filter("base is not null and found is not null").select(*keys, "ask", "base", F.col("found").alias("end"))
    left = searched.filter("base is not null and found is null")
    if not levels:
        return here.union(left.select(*keys, "ask", "base", F.lit(NEVER).alias("end")))
    first = left.groupBy(*keys, "group").agg(F.min_by(F.struct("ask", "base"), "unit").alias("first"))
    above = searched.groupBy(*keys, "group").agg(F.min("low").alias("low")).join(first, [*keys, "group"], "left")
    above = above.select(*keys, F.col("group").alias("unit"), "low", F.col("first.base").alias("base"), F.col("first.ask").alias("ask"))
    later = _ends(above, keys, width, levels - 1)
    # The group that holds the end is known; now its first unit that is low enough.
    members = searched.select(*keys, F.col("group").alias("end"), "unit", "low")
    inside = later.filter(F.col("end") < NEVER).join(members, [*keys, "end"]).filter("low <= base")
    inside = inside.groupBy(*keys, "ask", "base").agg(F.min("unit").alias("end"))
    return here.union(inside).union(later.filter(F.col("end") == NEVER))


def spans_in_blocks(
    blocks: DataFrame, keys: Sequence[str] = ("run_id",), block: str = "block", text: str = "text", width: int = 4096, levels: int = 3
) -> DataFrame:
    """One row per outermost function of texts in blocks: keys, ``ordinal``, ``start_line``, ``end_line`` (of the whole text),
    ``signature``, ``is_user``, ``priority``, and ``start_block``, ``end_block``.

    Each block but a text's last ends with a line end. Blocks are ordered by their number, which may leave numbers out. A text without
    a function has no row. Starts jobs.
    """
    keys = list(keys)
    seen = stored(block_summaries(blocks, keys, block, text), "span-blocks")
    placed = running_total_before(seen.drop("falls", "closed", "opened"), keys, "block", "n_lines", "line", width)
    placed = stored(running_total_before(placed, keys, "block", "net", "depth", width), "span-places")
    units = placed.select(
        *keys, F.col("block").alias("unit"), (F.col("depth") + F.col("low")).alias("low"), (F.col("depth") + F.col("base")).alias("base"),
        F.col("block").alias("ask"),
    )
    ends = stored(_ends(units, keys, width, levels), "span-far")
    told = placed.join(ends.select(*keys, F.col("ask").alias("block"), F.col("end").alias("ends")), [*keys, "block"], "left")
    covered = running_max_before(told, keys, "block", "ends", "until", width)
    # A function that an earlier one covers is none; one that begins in the block in which an earlier one ends is one.
    free = F.col("until").isNull() | (F.col("until") <= F.col("block"))
    own = stored(covered.withColumn("free", free).withColumn("valid", free & F.col("ends").isNotNull()), "span-own")
    across = own.filter("valid").join(seen.filter("opened is not null").select(*keys, "block", "opened"), [*keys, "block"])
    across = across.select(*keys, F.col("block").alias("start_block"), F.col("ends").alias("end_block"), "opened", F.col("line").alias("start_at"), (F.col("depth") + F.col("base")).alias("from"))
    wanted = across.select(*keys, F.col("end_block").alias("block")).distinct()
    falls = seen.select(*keys, "block", "falls").filter("size(falls) > 0").join(wanted, [*keys, "block"], "left_semi")
    closing = own.select(*keys, "block", "line", "depth").join(falls, [*keys, "block"])
    closing = closing.select(*keys, F.col("block").alias("end_block"), F.col("line").alias("end_at"), F.col("depth").alias("end_depth"), "falls")
    met = across.join(closing, [*keys, "end_block"], "left")
    fall = F.get(F.filter("falls", lambda f: F.col("end_depth") + f["depth"] <= F.col("from")), F.lit(0))["line"]
    totals = seen.groupBy(*keys).agg(F.sum("n_lines").alias("total"), F.max("block").alias("last_block"))
    crossing = stored(met.withColumn("end_line", F.col("end_at") + fall).drop("falls"), "span-crossing")
    # What a block found itself counts from where the function that it was in ends.
    until = crossing.filter(F.col("end_line").isNotNull()).select(*keys, F.col("end_block").alias("block"), "end_line")
    mine = own.filter("free").select(*keys, "block", "line").join(until, [*keys, "block"], "left")
    mine = mine.join(seen.filter("size(closed) > 0").select(*keys, "block", "closed"), [*keys, "block"])
    later = F.filter("closed", lambda s: F.col("end_line").isNull() | (F.col("line") + s["start"] > F.col("end_line")))
    inside = mine.select(*keys, "block", "line", F.inline(later)).select(
        *keys, F.col("block").alias("start_block"), F.col("block").alias("end_block"), (F.col("line") + F.col("start")).alias("start_line"),
        (F.col("line") + F.col("end")).alias("end_line"), "signature", "is_user", "priority",
    )
    far = crossing.join(totals, keys).select(
        *keys, "start_block", F.least("end_block", "last_block").alias("end_block"), (F.col("start_at") + F.col("opened.start")).alias("start_line"),
        F.coalesce("end_line", F.col("total") - 1).alias("end_line"), "opened.signature", "opened.is_user", "opened.priority",
    )
    rows = stored(inside.union(far), "span-rows")
    counts = rows.groupBy(*keys, "start_block").agg(F.count(F.lit(1)).alias("n"))
    before = running_total_before(counts, keys, "start_block", "n", "before", width).drop("n")
    return _numbered(rows, before, keys)


def _numbered(rows: DataFrame, before: DataFrame, keys: list[str]) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy(*keys, "start_block").orderBy("start_line")) - 1
    out = rows.join(before, [*keys, "start_block"]).withColumn("ordinal", (F.col("before") + nth).cast("int"))
    return out.select(*keys, "ordinal", "start_line", "end_line", "signature", "is_user", "priority", "start_block", "end_block")


def function_pieces(
    blocks: DataFrame, spans: DataFrame, keys: Sequence[str] = ("run_id",), block: str = "block", text: str = "text", width: int = 4096
) -> DataFrame:
    """The lines of functions as ordered pieces: keys, ``ordinal``, ``block``, ``piece``; a body is its pieces, joined by line feeds.

    ``spans`` are some rows of ``spans_in_blocks`` of the same blocks. A block is joined to the functions that begin in it and to
    the one that reaches into it. Starts jobs.
    """
    keys = list(keys)
    lines = stored(blocks.select(*keys, F.col(block).cast("long").alias("block"), F.size(tx.splitlines(F.col(text))).cast("long").alias("n")), "piece-lines")
    places = running_total_before(lines, keys, "block", "n", "line", width)
    wanted = spans.select(*keys, "ordinal", "start_line", "end_line", "start_block", "end_block")
    begun = wanted.withColumn("block", F.col("start_block"))
    reach = wanted.filter("end_block > start_block")
    reached = F.struct("start_block", "end_block", "ordinal", "start_line", "end_line")
    last = reach.groupBy(*keys, F.col("start_block").alias("block")).agg(F.max(reached).alias("far"))
    open_at = running_max_before(places.join(last, [*keys, "block"], "left"), keys, "block", "far", "from", width)
    inside = open_at.filter("from.end_block >= block").select(*keys, "from.ordinal", "from.start_line", "from.end_line", "block")
    asked = begun.select(*keys, "ordinal", "start_line", "end_line", "block").union(inside)
    asked = asked.join(places.select(*keys, "block", "line", "n"), [*keys, "block"])
    start = F.greatest(F.col("start_line") - F.col("line"), F.lit(0)).cast("int")
    stop = F.least(F.col("end_line") - F.col("line"), F.col("n") - 1).cast("int")
    cuts = asked.groupBy(*keys, "block").agg(F.collect_list(F.struct("ordinal", start.alias("a"), stop.alias("b"))).alias("cuts"))
    texts = blocks.select(*keys, F.col(block).cast("long").alias("block"), F.col(text).alias("_text")).join(cuts, [*keys, "block"])

    def cut(all_lines: Column) -> Column:
        return F.transform(
            "cuts", lambda c: F.struct(c["ordinal"].alias("ordinal"), F.array_join(F.slice(all_lines, c["a"] + 1, c["b"] - c["a"] + 1), "\n").alias("piece"))
        )

    return texts.select(*keys, "block", F.inline(tx.let(tx.splitlines(F.col("_text")), cut))).filter("piece is not null")


def functions_in_blocks(
    blocks: DataFrame, keys: Sequence[str] = ("run_id",), block: str = "block", text: str = "text", width: int = 4096,
    most_bytes: int = MERGED_BYTES,
) -> DataFrame:
    """The functions of texts in blocks with their bodies, as ``spans.functions`` gives them for whole texts. A body is one value.

    Texts whose blocks were all joined into one are read where they lie; only the others are searched from block to block. Starts jobs.
    """
    keys = list(keys)
    blocks = merged_blocks(blocks.dropna(subset=keys), keys, block, text, most_bytes)
    several = stored(blocks.filter(F.col(block) != 0).select(*keys).distinct(), "span-several")
    one = blocks.filter(F.col(block) == 0)
    if several.isEmpty():
        return _functions_of_one(one, keys, text)
    known = F.broadcast(several) if fits_broadcast(several) else several
    long = _functions_of_several(blocks.join(known, keys, "left_semi"), keys, block, text, width)
    return long.unionByName(_functions_of_one(one.join(known, keys, "left_anti"), keys, text))


def _functions_of_one(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    found = spans.functions(texts.select(*keys, text), text)
    return found.withColumns({c: F.col(c).cast("long") for c in ("start_line", "end_line")})


def _functions_of_several(blocks: DataFrame, keys: list[str], block: str, text: str, width: int) -> DataFrame:
    found = stored(spans_in_blocks(blocks, keys, block, text, width), "span-functions")
    pieces = function_pieces(blocks, found, keys, block, text, width)
    bodies = pieces.groupBy(*keys, "ordinal").agg(F.sort_array(F.collect_list(F.struct("block", "piece"))).alias("p"))
    bodies = bodies.select(*keys, "ordinal", F.array_join(F.transform("p", lambda p: p["piece"]), "\n").alias("body"))
    return found.drop("start_block", "end_block").join(bodies, [*keys, "ordinal"]).withColumn(
        "n_lines", (F.col("end_line") - F.col("start_line") + 1).cast("int")
    )
