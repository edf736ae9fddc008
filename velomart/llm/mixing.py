"""Mixing sources to target weights by a low-discrepancy schedule.

The mix is a row of slots, each one block of ``block`` words.  Slot k takes the
golden-ratio point frac(k * phi), found through the cumulative target shares, so any
stretch of the mix holds the sources close to their shares.  The r-th slot of a source
takes the r-th block of that source: its documents in a shuffled order, end to end,
repeated up to three times.  The schedule gives the order; how much a source gives is its
target, rounded to words (one at least if the target is above 0), with a shorter last
block: slots beyond a source's last block stay empty, and blocks for which it drew no slot
follow after the others.  A document's share of the taken words is what the mix takes of it.

Everything is counted over all rows with DataFrame operations.  Positions inside a
source come from two levels (sums of buckets of the shuffle key, then sums within a
bucket), and ranks of slots likewise, so one source with a third of all rows is many
groups, not one.  The shuffle key is a digest of id and text, so rows of one id are spread
too; the buckets grow in number with the rows, which changes no position.

Defined cases: a null text has size 0; a null source is a source of its own and comes
last; sources of no words have target 0; equal rows are separate documents (those alike in
id and text share a bucket); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize

WORD = r"[^\x20\x09-\x0D]+"
REPEATS = 3
WEIGHTS = 3  # the sources weigh 1, 2, 3, 1, 2, 3, ...
BLOCK_WORDS = 4096  # the block of a slot
BUCKET_ROWS = 1 << 16  # rows for which one more bucket of a source is made
GOLDEN = 2654435769  # 2**32 / golden ratio
SLOT_CHUNK = 1 << 16
SHARE_CELLS = 1024


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame) -> DataFrame:
    """source, source_size, target and the share [low, high) of all slots; one row per
    source.  Targets are the least of 3 * source_size and a common level times the
    weight; the windows see one row per source."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = sources.withColumn("weight", (F.row_number().over(by_name) - 1) % WEIGHTS + 1).withColumn("most", F.col("source_size") * REPEATS)
    by_level = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(every)
    level = (total - F.coalesce(F.sum("most").over(before), F.lit(0))) / F.sum("weight").over(after)
    fits = F.when(F.col("level") <= F.col("most") / F.col("weight"), F.struct(F.col("most") / F.col("weight"), F.col("level").alias("level")))
    levelled = (
        weighed.withColumn("total", total)
        .withColumn("level", level)
        .withColumn("common", F.min(fits).over(every)["level"])
        .withColumn("target", F.least(F.col("most").cast("double"), F.col("common") * F.col("weight")))
    )
    cumulative = F.sum("target").over(by_name.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return levelled.withColumn("high", F.when(F.col("total") > 0, cumulative / F.col("total")).otherwise(0.0)).withColumn(
        "low", F.coalesce(F.lag("high").over(by_name), F.lit(0.0))
    ).withColumn("high", F.when(F.row_number().over(Window.orderBy(F.col("source").desc_nulls_first())) == 1, F.lit(1.0)).otherwise(F.col("high"))).select(
        "source", "source_size", "target", "total", "low", "high"
    )


def slot_schedule(targets: DataFrame, total: int, block: int) -> DataFrame:
    """slot, source, block_no: which block of which source each slot of the mix takes."""
    spark = targets.sparkSession
    # Half of the 2**32 steps are used, so that the product stays within 64 bits.
    point = F.expr(f"pmod(pmod(id, 2147483648) * {GOLDEN}L, 4294967296L) / 4294967296.0D")
    slots = spark.range(-(-total // block)).select(F.col("id").alias("slot"), point.alias("point"))
    slots = slots.withColumn("cell", F.floor(F.col("point") * SHARE_CELLS).cast("int"))
    shares = targets.where("high > low").withColumn(
        "cell", F.explode(F.sequence(F.floor(F.col("low") * SHARE_CELLS).cast("int"), F.least(F.floor(F.col("high") * SHARE_CELLS).cast("int"), F.lit(SHARE_CELLS - 1))))
    )
    drawn = (
        slots.join(shares.select("source", "low", "high", "cell"), "cell")
        .where("point >= low and point < high")
        .select("slot", "source", F.expr(f"slot div {SLOT_CHUNK}").alias("chunk"))
    )
    within = F.row_number().over(Window.partitionBy("source", "chunk").orderBy("slot")) - 1
    counts = drawn.groupBy("source", "chunk").count()
    earlier = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("source").alias("s"), F.col("chunk").alias("c"), F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("offset"))
    ranked = drawn.withColumn("within", within)
    return ranked.join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("chunk") == F.col("c"))).select(
        "slot", "source", (F.col("offset") + F.col("within")).alias("block_no")
    )


def full_schedule(targets: DataFrame, total: int, block: int) -> DataFrame:
    """slot, source, block_no: one slot for each block that a source is to give.

    Of the slots drawn those beyond a source's last block are left out; blocks without a
    slot, a few of each source, come after all drawn slots."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())  # one row per source
    sources = targets.select(F.col("source").alias("t"), F.ceil(F.col("quota") / block).alias("blocks"), F.row_number().over(by_name).alias("nth"), F.count("*").over(Window.partitionBy()).alias("sources"))
    slots = slot_schedule(targets, total, block)
    drawn = slots.join(sources.select("t", "blocks"), F.col("source").eqNullSafe(F.col("t"))).where("block_no < blocks").select("slot", "source", "block_no")
    counts = slots.groupBy(F.col("source").alias("d")).agg(F.count("*").alias("drawn"))
    held = F.coalesce("drawn", F.lit(0))
    after = (
        sources.join(counts, F.col("t").eqNullSafe(F.col("d")), "left")
        .where(F.col("blocks") > held)
        .select("t", "nth", "sources", held.alias("drawn"), F.explode(F.sequence(held, F.col("blocks") - 1)).alias("block_no"))
        .select((F.lit(-(-total // block)) + (F.col("block_no") - F.col("drawn")) * F.col("sources") + F.col("nth")).alias("slot"), F.col("t").alias("source"), "block_no")
    )
    return drawn.union(after)


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", extra: dict[str, Column] | None = None, block: int = BLOCK_WORDS
) -> DataFrame:
    """doc_id, size, source_size, target, taken, source and slot (the first of the mix
    that holds words of it, null if none does) for each row of ``docs``, and the columns
    ``extra`` of it."""
    extra = extra or {}
    # The shuffle key is a digest of the row, so that reruns and retries agree.
    key = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(text_col).cast("string"), F.lit(""))).cast("binary"))
    sized = materialize(
        docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), key.alias("key"), *(c.alias(n) for n, c in extra.items())), "sized"
    )
    return mix_sized(sized, list(extra), block)


def mix_sized(sized: DataFrame, keep: list[str], block: int = BLOCK_WORDS) -> DataFrame:
    """The mix of stored rows doc_id, source, size, key (32 hex digits) and ``keep``."""
    goal = F.when(F.col("target") > 0, F.greatest(F.round("target"), F.lit(1.0))).otherwise(0.0).cast("long")
    targets = materialize(source_targets(sized).withColumn("quota", goal), "targets")
    total = targets.agg(F.max("total")).first()[0] or 0
    digits = 3  # 4096 stretches of each source's shuffled order, or more
    rows = sized.count()
    while rows > BUCKET_ROWS << (4 * digits):
        digits += 1

    bucket = F.substring("key", 1, digits)
    lined = sized.withColumn("bucket", bucket)
    sums = lined.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("source", F.col("bucket").alias("b"), F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset"))
    facts = targets.select(F.col("source").alias("t"), "source_size", "target", "quota")
    # What holds for a source goes to its buckets, so that its rows are never dealt by it.
    offsets = offsets.join(facts, F.col("source").eqNullSafe(F.col("t"))).withColumnRenamed("source", "s")
    nth = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size", *keep)
    inside = nth.rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        lined.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .withColumn("nth", F.row_number().over(nth))
        .join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
        .withColumn("start", F.col("offset") + F.col("inside"))
    )
    # The line of a source repeats; of each lap the pieces that meet a block of the quota.
    laps = placed.withColumn("lap", F.explode_outer(F.expr(f"filter(sequence(0, {REPEATS - 1}), l -> size > 0 and start + l * source_size < quota)")))
    laps = laps.withColumn("lap_start", F.col("start") + F.col("lap") * F.col("source_size"))
    end = F.least(F.col("lap_start") + F.col("size"), F.col("quota"))
    pieces = laps.withColumn("end", end).withColumn("block", F.explode_outer(F.when(F.col("lap").isNotNull(), F.sequence(F.expr(f"lap_start div {block}"), F.expr(f"(end - 1) div {block}")))))
    taken_blocks = full_schedule(targets, total, block).select(F.col("source").alias("x"), "block_no", "slot")
    overlap = F.least(F.col("end"), (F.col("block") + 1) * block) - F.greatest("lap_start", F.col("block") * block)
    joined = pieces.join(taken_blocks, F.col("source").eqNullSafe(F.col("x")) & (F.col("block") == F.col("block_no")), "left")
    return (
        joined.groupBy("source", "bucket", "nth", "doc_id", "size", "source_size", "target", *keep)
        .agg(F.sum(F.when(F.col("block_no").isNotNull(), overlap).otherwise(0)).alias("taken"), F.min("slot").alias("slot"))
        .select("doc_id", "size", "source_size", "target", "taken", "source", "slot", *keep)
    )
