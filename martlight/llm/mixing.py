"""Mixing sources to target weights by Pfair scheduling of blocks.

Block j of a source of weight w may run from floor(j / w) on and must have run before ceil((j + 1) / w). In every slot the
released block with the earliest deadline runs. The weights add up to one, so no slot is empty, every block runs in its
window, and no source is ever a whole block ahead of or behind its weight, however long the mix is.

The schedule is made in cycles of slots, each in a task of its own. A cycle starts from a state it can tell without the
slots before: of the blocks that may have run, those run with the earliest deadlines. Two runs of the rule from
different states agree once the deadlines of the blocks they differ in are over, since the run that lacks a block takes
it no later than its deadline. So each task begins the longest window before its cycle, and what it keeps is the one
schedule.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlight.llm.common import bucket_starts, buckets_for, importable
from martlight.session import materialize

#: Weights are whole parts, in units of this share of their sum.
UNIT = 1 << 50
#: Slots of a cycle, if the longest window is not a quarter of it or more.
CYCLE = 1 << 16


def windows(parts: list[int], total: int, k: int, j: int) -> tuple[int, int]:
    """Release and deadline of a block."""
    return j * total // parts[k], -(-(j + 1) * total // parts[k])


def longest_window(parts: list[int]) -> int:
    return -(-sum(parts) // min(parts)) + 2


def state_at(parts: list[int], slot: int) -> list[int]:
    """Blocks of each source that have run before ``slot``, in a run that can go on without missing a deadline.

    All blocks with a deadline up to the slot, and of the released others those with the earliest deadlines.
    """
    total = sum(parts)
    done = [slot * e // total for e in parts]
    released = [(windows(parts, total, k, done[k])[1], k) for k, e in enumerate(parts) if slot * e % total]
    for _, k in heapq.nsmallest(slot - sum(done), released):
        done[k] += 1
    return done


def schedule(parts: list[int], start: int, stop: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(source, block, release, deadline, slot) for each slot from ``start`` to before ``stop``."""
    total, at = sum(parts), max(0, start - longest_window(parts))
    done = state_at(parts, at)
    waiting = [(*windows(parts, total, k, j), k, j) for k, j in enumerate(done)]
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int, int]] = []
    for slot in range(at, stop):
        while waiting and waiting[0][0] <= slot:
            release, deadline, k, j = heapq.heappop(waiting)
            heapq.heappush(ready, (deadline, k, j, release))
        deadline, k, j, release = heapq.heappop(ready)
        if slot >= deadline:
            raise AssertionError("a block missed its deadline")
        if slot >= start:
            yield k, j, release, deadline, slot
        heapq.heappush(waiting, (*windows(parts, total, k, j + 1), k, j + 1))


def tempered(docs: DataFrame, power: float = 0.5) -> DataFrame:
    """(source, weight): a power of the row counts, between equal shares (0) and the shares as they are (1)."""
    counts = docs.groupBy("source").agg(F.count(F.lit(1)).alias("weight"))
    return counts.select("source", F.pow("weight", F.lit(power)).alias("weight"))


def placed_blocks(sources: DataFrame, block_rows: int) -> DataFrame:
    """(k, block, release, deadline, slot) of all blocks of ``sources`` (k, parts, rows), made in one task for each cycle.

    The driver and every task hold two numbers for each source. There are as many slots as the source that lasts
    longest at its weight needs.
    """
    spark = sources.sparkSession
    held = sources.select("k", "parts", "rows").orderBy("k").toArrow()
    parts = [int(e) for e in held["parts"].to_pylist()]
    blocks = [-(-int(n) // block_rows) for n in held["rows"].to_pylist()]
    total = sum(parts)
    slots = max((-(-b * total // e) for b, e in zip(blocks, parts, strict=True) if b), default=0)
    cycle = max(CYCLE, 4 * longest_window(parts)) if parts else CYCLE
    importable(spark)
    shared = spark.sparkContext.broadcast((np.array(parts, dtype=np.int64), np.array(blocks, dtype=np.int64)))
    names = ["k", "block", "release", "deadline", "slot"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_parts, own_blocks = (a.tolist() for a in shared.value)
        for batch in batches:
            for n in batch.column(0).to_pylist():
                out: list[tuple] = []
                for row in schedule(own_parts, n * cycle, min(slots, (n + 1) * cycle)):
                    if row[1] < own_blocks[row[0]]:
                        out.append(row)
                        if len(out) == 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names)
                            out = []
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names)

    n_cycles = -(-slots // cycle)
    return spark.range(0, n_cycles, 1, max(1, min(n_cycles, 4096))).mapInArrow(run, ", ".join(f"{n} long" for n in names))


def mix(docs: DataFrame, weights: DataFrame, block_rows: int = 32) -> DataFrame:
    """All rows and columns of ``docs`` with mix_block, mix_release, mix_deadline, mix_slot and mix_position.

    ``weights`` has a positive ``weight`` for each ``source`` (null is one); their sum need not be one. Each source is
    cut into blocks of ``block_rows`` rows in hash order. Ordered by mix_position, the blocks interleave with less than
    one block of deviation from the weights for as long as every source lasts; the slots of a source that has ended
    stay empty, and the rest keep their proportion. No row is dropped or repeated, and any number of sources may occur.
    Weights count in units of 2^-50 of their sum. A source without a weight, or with two, is an error; a weight without
    rows leaves empty slots. Columns of ``docs`` named like the new ones are replaced; others may have any name.
    Repeated rows are interchangeable. An empty table gives no rows.
    """
    new = ("mix_block", "mix_release", "mix_deadline", "mix_slot", "mix_position")
    docs = docs.drop(*new)
    counts = docs.groupBy(F.col("source").alias("s")).agg(F.count(F.lit(1)).alias("rows"))
    listed = weights.select("source", F.col("weight").cast("double").alias("weight"))
    known = materialize(listed.join(counts, F.col("source").eqNullSafe(F.col("s")), "full"), "sources")
    twice = known.groupBy("source").count().agg(F.max("count")).first()[0]
    facts = known.agg(F.sum("weight").alias("sum"), F.min("weight").alias("least"), F.sum("rows").alias("rows"), F.count_if(F.col("weight").isNull()).alias("without")).first()
    if facts["without"] or (twice or 0) > 1:
        raise ValueError("every source needs one weight")
    if facts["least"] is not None and not facts["least"] > 0:
        raise ValueError("weights must be positive")
    # One row for each source; the number orders ties.
    k = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_first())) - 1
    parts = F.greatest(F.lit(1), F.round(F.col("weight") / F.lit(facts["sum"] or 1.0) * UNIT).cast("long"))
    sources = materialize(known.select("source", k.cast("long").alias("k"), parts.alias("parts"), F.coalesce("rows", F.lit(0)).alias("rows")), "sources")
    placed = placed_blocks(sources, block_rows)

    # The caller's row is one column from here on, so its names clash with none.
    named = sources.select(F.col("source").alias("s"), "k")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.join(named, F.col("row.source").eqNullSafe(F.col("s"))).select("row", "k")
    order = [F.col("row.doc_id"), F.col("row")]
    buckets = buckets_for(facts["rows"] or 0)
    rows = rows.withColumn("b", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    # Each bucket has the places of the blocks it has rows of, so the rows are joined once, where the window has them.
    starts = materialize(bucket_starts(rows, ["k"], "b", buckets), "buckets")
    first, last = F.expr(f"_start div {block_rows}"), F.expr(f"(_start + _n - 1) div {block_rows}")
    wanted = starts.select("k", "b", F.explode(F.sequence(first, last)).alias("block"))
    place = F.struct("block", "release", "deadline", "slot")
    found = wanted.join(placed, ["k", "block"]).groupBy("k", "b").agg(F.array_sort(F.collect_list(place)).alias("places"))
    found = found.join(starts.select("k", "b", "_start"), ["k", "b"])
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("k", "b").orderBy(*order)) - 1)
    joined = ranked.join(found, ["k", "b"]).withColumn("at", F.col("_start") + F.col("rank"))
    block = F.expr(f"at div {block_rows}")
    joined = joined.withColumn("place", F.get("places", (block - F.expr(f"_start div {block_rows}")).cast("int")))
    return joined.select(
        "row.*", F.col("place.block").alias("mix_block"), F.col("place.release").alias("mix_release"), F.col("place.deadline").alias("mix_deadline"),
        F.col("place.slot").alias("mix_slot"), (F.col("place.slot") * block_rows + F.col("at") % block_rows).alias("mix_position"),
    )
