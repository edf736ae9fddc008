"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Each shard owns ``replicas`` points of a ring of 2**32 positions.  A row belongs to
the first point clockwise of its own position; where that point's shard is full, it
goes on clockwise to the next point whose shard has room.  The loads are row counts
and the bound is exact (law ``rows``): of n rows, every shard takes floor(n/shards)
or one more, so balance is guaranteed, and rows other than the overflow of full
shards stay where plain consistent hashing puts them.

Rows are moved by whole stretches: one grouping counts the rows of each arc between
two points (``shards * replicas`` counts, a bound set by the parameters), the walk
along the ring is done on these counts, and gives for each arc which ranks of its
rows go to which shard.  A window per arc ranks the rows; shard and slot follow by a
join with the stretches.

Defined cases: a null text has no bytes (crc32 of nothing, size 8); null ids are rows
like others; equal rows are placed as separate rows; an empty table gives no rows;
columns beyond id and text are ignored whatever their names.
"""

from __future__ import annotations

import json
from bisect import bisect_left

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

RING_BITS = 32
CELL_BITS = 12  # cells of the ring by which a row finds its arc
ROW_OVERHEAD = 8


def _table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table as a literal in the plan; its callers state the bound."""
    names = [part.split()[0] for part in schema.split(", ")]
    text = json.dumps([dict(zip(names, row, strict=True)) for row in rows])
    fields = ", ".join(part.replace(" ", ": ") for part in schema.split(", "))
    item = F.explode(F.from_json(F.lit(text), f"array<struct<{fields}>>"))
    return spark.range(1).select(item.alias("t")).select("t.*")


def _position(*columns) -> F.Column:
    return F.shiftrightunsigned(F.xxhash64(*columns), 64 - RING_BITS)


def ring_points(spark: SparkSession, shards: int, replicas: int) -> list[tuple[int, int]]:
    """(position, shard) of every virtual node, clockwise; ``shards * replicas`` rows."""
    points = spark.range(shards * replicas).select(
        F.expr(f"cast(id div {replicas} as int)").alias("shard"), F.expr(f"cast(id % {replicas} as int)").alias("replica")
    )
    found = points.select(_position(F.lit("shard"), "shard", "replica").alias("position"), "shard").collect()
    return sorted((row.position, row.shard) for row in found)


def _cells(spark: SparkSession, points: list[tuple[int, int]]) -> DataFrame:
    """For each cell of the ring: the points before it, and the points in it."""
    positions = [p for p, _ in points]
    width = 1 << (RING_BITS - CELL_BITS)
    rows = []
    for cell in range(1 << CELL_BITS):
        first, end = bisect_left(positions, cell * width), bisect_left(positions, (cell + 1) * width)
        rows.append((cell, first, positions[first:end]))
    return _table(spark, rows, "cell int, first int, inside array<bigint>")


def capacities(rows: int, shards: int) -> list[int]:
    """Exact bounds of the loads: they sum to the rows and differ by one at most."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def walk(counts: list[int], owners: list[int], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Places the rows of each arc clockwise: (arc, first rank, end rank, shard, slot of
    the first).  Rows that come from a nearer arc take a shard's room first."""
    left = list(counts)
    free, used = list(room), [0] * len(room)
    placed, waiting, hop = [], [a for a, n in enumerate(counts) if n], 0
    while waiting:
        still = []
        for arc in waiting:
            shard = owners[(arc + hop) % len(owners)]
            n = min(left[arc], free[shard])
            if n:
                first = counts[arc] - left[arc]
                placed.append((arc, first, first + n, shard, used[shard]))
                left[arc] -= n
                free[shard] -= n
                used[shard] += n
            if left[arc]:
                still.append(arc)
        waiting, hop = still, hop + 1
        if hop > len(owners):
            raise ValueError("the capacities hold fewer rows than there are")
    return placed


def shard_rows(docs: DataFrame, shards: int = 24, replicas: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for each row of ``docs``."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + F.lit(ROW_OVERHEAD)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        _position(F.col(id_col), text).alias("position"),
    )
    points = ring_points(spark, shards, replicas)
    n_points = len(points)
    cell = F.shiftright("position", RING_BITS - CELL_BITS).cast("int")
    cells = F.broadcast(_cells(spark, points))  # 2**CELL_BITS rows and shards * replicas positions
    arcs = (
        rows.withColumn("cell", cell)
        .join(cells, "cell")
        .withColumn("arc", (F.col("first") + F.size(F.filter("inside", lambda p: p < F.col("position")))) % n_points)
        .drop("cell", "first", "inside")
    )
    counts = [0] * n_points
    for row in arcs.groupBy("arc").count().collect():  # at most shards * replicas rows
        counts[row["arc"]] = row["count"]
    placed = walk(counts, [s for _, s in points], capacities(sum(counts), shards))
    stretches = _table(spark, placed, "arc int, first bigint, end bigint, shard int, base bigint")
    order = Window.partitionBy("arc").orderBy("position", "doc_id", "text_crc32", "size")
    ranked = arcs.withColumn("rank", F.row_number().over(order).cast("long") - 1)
    return (
        ranked.join(F.broadcast(stretches), "arc")  # at most one row per arc and two per shard
        .where("rank >= first and rank < end")
        .select(
            "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
            (F.col("base") + F.col("rank") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        )
    )
