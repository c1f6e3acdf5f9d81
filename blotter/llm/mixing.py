"""Mixing sources to target weights by a low-discrepancy schedule.

The points of the van der Corput sequence on a grid of 2^k >= M slots are
mapped through the cumulative slot shares of the sources: a source owns as
many grid points as it has slots, and the slot number of a grid point is its
bits reversed. Slots of every source are thus spread evenly over the mix, and
the n-th slot of a source (its rank by slot number) takes the source's n-th
block. Blocks are runs of equally many words of the source's documents in a
hashed order; when they are used up, the next pass starts again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.operators.position import with_position, with_running_sums

from .common import bounded_side, cut, running_total, word_count

#: Words in a block.
BLOCK = 256
#: Slots are made in runs of this many, so that no task makes a source's all.
RUN = 1 << 14


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5,
                   most: int = 2) -> DataFrame:
    """``source, source_size, target, source_at`` (place by code point) from
    ``sizes(source, source_size)``.

    The mix has ``share`` times all words. Sources by code point (null last)
    weigh ``weights`` in turn; none gets more than ``most`` times its size, and
    what is cut off is shared by weight among the others until none is above.

    Solved in one pass: sources by room per weight; all up to the first that
    stays below its room are capped, the others share the rest by weight. The
    frame has one row per source.
    """
    w = F.array(*[F.lit(float(x)) for x in weights])
    placed = with_position(sizes.select("source", "source_size"), [F.col("source").isNull(), F.col("source")], "source_at")
    rows = placed.withColumn("weight", F.element_at(w, (F.col("source_at") % len(weights) + 1).cast("int"))) \
        .withColumn("cap", F.col("source_size") * F.lit(float(most)))
    rows = cut(rows.withColumn("room", F.col("cap") / F.col("weight")), "weights")
    words, all_weights = rows.agg(F.sum("source_size"), F.sum("weight")).first()
    total = (words or 0) * share
    by_room = with_running_sums(rows.select("room", "source_at", "cap", "weight"), [F.col("room"), F.col("source_at")],
                                {"capped": "cap", "passed": "weight"})
    level = (F.lit(float(total)) - F.col("capped")) / (F.lit(all_weights) - F.col("passed"))
    levels = by_room.select("room", level.alias("level")).filter("level < room")
    level = levels.agg(F.min(F.struct("room", "level"))["level"]).first()[0]
    target = F.col("cap") if level is None else F.least("cap", F.col("weight") * F.lit(float(level)))
    return rows.select("source", "source_size", target.alias("target"), "source_at")


def _reversed_bits(x, bits: int):
    """The lowest ``bits`` (at most 62) bits of a long column in reverse."""
    masks = [(1, 0x5555555555555555), (2, 0x3333333333333333), (4, 0x0F0F0F0F0F0F0F0F),
             (8, 0x00FF00FF00FF00FF), (16, 0x0000FFFF0000FFFF)]
    for step, mask in masks:
        low = F.shiftleft(x.bitwiseAND(F.lit(mask)), step)
        x = low.bitwiseOR(F.shiftrightunsigned(x, step).bitwiseAND(F.lit(mask)))
    x = F.shiftleft(x, 32).bitwiseOR(F.shiftrightunsigned(x, 32))
    return F.shiftrightunsigned(x, 64 - bits)


def mix_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2,
               block: int = BLOCK, seed: int = 0, row_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, pieces).

    rows: ``row, doc_id, source, size, source_size, target`` per input row.
    pieces: ``slot, source_no, pass, row, from_word, to_word``: what each slot
    of the mix holds (words of a row, from zero, end exclusive), in order of
    slot and place in the block.

    A source's pieces add up to its target, rounded down to a word, and no
    document is used more than ``most`` times. Null texts have no words; null
    is a source of its own; ids may be null or repeat, every row is a document
    (``row`` numbers them, or ``row_col`` if given). Sources and documents
    without words take no slot. Equal input gives an equal mix: order depends
    on ids and texts only. An empty table gives empty results.
    """
    row = F.monotonically_increasing_id() if row_col is None else F.col(row_col)
    text = F.col(text_col)
    rows = cut(docs.select(row.alias("row"), F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                           word_count(text).alias("size"), F.xxhash64(text).alias("text_hash")), "sizes")
    totals = cut(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "source_sizes")
    targets = source_targets(totals, weights, share, most)

    # Whole passes over a source, then the words of a last, partial pass.
    target, size = F.floor("target").cast("long"), F.col("source_size")
    last = F.col("last")
    plan = (targets.withColumn("passes", F.when(size > 0, F.expr("floor(target) div source_size")).otherwise(F.lit(0)))
            .withColumn("last", F.when(size > 0, target - F.col("passes") * size).otherwise(F.lit(0)))
            .withColumn("blocks", F.ceil(size / F.lit(block)).cast("long"))
            .withColumn("quota", F.col("passes") * F.col("blocks") + F.ceil(last / F.lit(block)).cast("long"))
            .withColumn("source_no", (F.col("source_at") + 1).cast("int")).drop("source_at"))
    plan = cut(with_running_sums(plan, [F.col("source_no")], {"start": "quota"}).drop("position"), "plan")
    slots_in_all = plan.agg(F.sum("quota")).first()[0] or 0
    bits = max(1, (slots_in_all - 1).bit_length()) if slots_in_all else 1

    small = bounded_side(plan.select("source", "source_no", "source_size", "target"))
    same = F.col("r.source").eqNullSafe(F.col("p.source"))
    known = rows.alias("r").join(small.alias("p"), same).select(
        "row", "doc_id", "r.source", "size", "source_size", "target", "source_no", "text_hash")

    # Documents in hashed order, cut into blocks.
    placed = running_total(
        known.filter("size > 0").withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "text_hash"))
        .select("source_no", "h", "doc_id", "text_hash", "row", "size"),
        "source_no", ["h", "doc_id", "text_hash", "row"], F.col("size"), "at")
    parts = placed.select("source_no", "row", "size", "at", F.explode(F.expr(
        f"sequence(at div {block}, (at + size - 1) div {block})")).alias("block"))
    from_word = F.greatest(F.col("block") * block - F.col("at"), F.lit(0))
    to_word = F.least((F.col("block") + 1) * block - F.col("at"), F.col("size"))
    parts = parts.select("source_no", "block", "row", "at", from_word.alias("from_word"), to_word.alias("to_word"))

    # Grid points of each source, their slots, and the slots' ranks.
    runs = plan.filter("quota > 0").select("source_no", "passes", "last", "blocks", "start", "quota", F.explode(
        F.expr(f"sequence(0L, (quota - 1) div {RUN})")).alias("run"))
    points = runs.repartition("source_no", "run").select("source_no", "passes", "last", "blocks", F.explode(F.expr(
        f"sequence(start + run * {RUN}, start + least(quota, (run + 1) * {RUN}) - 1)")).alias("point"))
    slots = points.withColumn("slot", _reversed_bits(F.col("point"), bits)).withColumn(
        "order", F.shiftleft(F.col("slot"), 64 - bits).bitwiseXOR(F.lit(-(1 << 63)).cast("long")))
    ranked = running_total(slots, "source_no", ["order"], F.lit(1).cast("long"), "rank")
    taken = ranked.select("source_no", "slot", "passes", "last", F.expr("rank div blocks").alias("pass"),
                          F.expr("rank % blocks").alias("block"))
    # Both sides grow with the documents: a merge join, whatever Spark's own
    # estimate says.
    pieces = taken.join(parts.hint("merge"), ["source_no", "block"])
    end = F.when(F.col("pass") == F.col("passes"), F.least("to_word", last - F.col("at"))).otherwise(F.col("to_word"))
    pieces = pieces.select("slot", "source_no", "pass", "row", "from_word", end.alias("to_word")).filter(
        "to_word > from_word")
    return known.select("row", "doc_id", "source", "size", "source_size", "target"), pieces


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """``row, doc_id, size, source_size, target, taken`` of every row: what the
    mix of ``mix_blocks`` takes of it, repeats counted."""
    rows, pieces = mix_blocks(docs, **options)
    taken = pieces.groupBy("row").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken"))
    return rows.join(taken.hint("merge"), "row", "left").select(
        "row", "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
