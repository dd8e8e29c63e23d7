"""Sharding by a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlight.llm.common import text_of

#: Places on the ring; keys and virtual nodes share them. This bounds every table the driver holds.
PLACES = 1 << 16


def ring(shards: int, virtual: int = 128) -> list[int]:
    """For each place, the shard of the first virtual node at or after it, clockwise."""
    import xxhash

    nodes: dict[int, int] = {}
    for shard in range(shards):
        for n in range(virtual):
            place = xxhash.xxh64_intdigest(f"{shard}:{n}", 42) % PLACES
            nodes.setdefault(place, shard)
    owner, last = [0] * PLACES, nodes[min(nodes)]
    for place in range(PLACES - 1, -1, -1):
        last = nodes.get(place, last)
        owner[place] = last
    return owner


def capacities(total: int, shards: int, slack: float = 0.0) -> list[int]:
    """The most rows a shard may hold; without slack, shares that differ by at most one."""
    if slack:
        return [-int(-total * (1 + slack) // shards)] * shards
    return [total // shards + (shard < total % shards) for shard in range(shards)]


def place_loads(counts: dict[int, int], owner: list[int], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(place, from rank, to rank, shard, slot of the first) for the keys of each place, ranks from 0.

    Places are filled in clockwise order; what finds its shard full goes on clockwise to the next virtual node of a
    shard with room.
    """
    load, pieces = [0] * len(room), []
    for place in sorted(counts):
        done, at = 0, place
        while done < counts[place]:
            shard = owner[at % PLACES]
            take = min(counts[place] - done, room[shard] - load[shard])
            if take:
                pieces.append((place, done, done + take, shard, load[shard]))
                load[shard] += take
                done += take
            at += 1
            if at - place > PLACES:
                raise ValueError("the shards together have too little room")
    return pieces


def shard_documents(docs: DataFrame, shards: int = 16, virtual: int = 128, slack: float = 0.0) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row of ``docs``; slots count from 0 without gaps in a shard.

    The place of a row on the ring is a hash of its doc_id (of its text where the doc_id is null, so that such rows
    spread). With ``slack`` 0 the row counts of shards differ by at most one; more slack moves fewer rows when
    shards are added. The driver holds one count for each place, at most 65,536, whatever the input. Within a place,
    rows are ranked by hash, doc_id and text checksum; repeated rows are interchangeable and each gets its own slot.
    Size is the UTF-8 length plus 1, 1 for null and empty texts, whose checksum is 0. An empty table gives no rows.
    """
    body = F.encode(text_of(), "UTF-8")
    key = F.when(F.col("doc_id").isNull(), F.xxhash64(text_of())).otherwise(F.xxhash64("doc_id"))
    rows = docs.select(
        "doc_id", (F.length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"), key.alias("_key")
    ).withColumn("_place", F.shiftrightunsigned("_key", 48).cast("int"))
    # Counted on the ids alone; the texts are read once, by the second pass.
    counted = docs.select(key.alias("_key")).groupBy(F.shiftrightunsigned("_key", 48).cast("int").alias("p")).count()
    counts = {r["p"]: r["count"] for r in counted.collect()}
    pieces = place_loads(counts, ring(shards, virtual), capacities(sum(counts.values()), shards, slack))
    spark = docs.sparkSession
    schema = "p int, lo long, hi long, shard int, base long"
    table = spark.createDataFrame(pd.DataFrame(pieces, columns=["p", "lo", "hi", "shard", "base"]), schema) if pieces else spark.createDataFrame([], schema)
    rank = F.row_number().over(Window.partitionBy("_place").orderBy("_key", "doc_id", "text_crc32", "size")) - 1
    ranked = rows.withColumn("_rank", rank.cast("long"))
    # At most one piece for each place and each shard that ran full: bounded, whatever the input.
    match = (F.col("_place") == F.col("p")) & (F.col("_rank") >= F.col("lo")) & (F.col("_rank") < F.col("hi"))
    return ranked.join(F.broadcast(table), match).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("_rank") - F.col("lo")).alias("slot")
    )
