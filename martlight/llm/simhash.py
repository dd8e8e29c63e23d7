"""SimHash near-duplicates by anchor points of a covering code."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlight.llm.common import components, small_batches, text_of
from martlight.session import materialize


#: Shingles that are hashed at once.
PART = 4096


def fingerprint_of(text: bytes, shingle: int = 3) -> int:
    """The 64-bit SimHash of a text: A-Z lower-cased, words between ASCII white space, shingles with repeats.

    Fewer words than ``shingle`` make one shingle of all; no word gives 0. A bit is 1 where it is set in over half
    of the XXH64 values (seed 42).
    """
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    k = min(shingle, len(words))
    n = len(words) - k + 1
    del words
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_digest
    counts = np.zeros(64, dtype=np.int64)
    # In parts, so that a very long text takes little more memory than its bytes.
    for at in range(0, n, PART):
        spans = zip(starts[at : min(n, at + PART)].tolist(), ends[at + k - 1 : min(n, at + PART) + k - 1].tolist(), strict=True)
        hashes = np.frombuffer(b"".join([digest(joined[a:b], 42) for a, b in spans]), dtype=np.uint8).reshape(-1, 8)
        counts += np.unpackbits(hashes, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp) of every document; fp is the fingerprint as a signed long."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            values = [fingerprint_of(texts[n].as_py(), shingle) for n in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.int64())], ["doc_id", "fp"])

    source = docs.select("doc_id", F.encode(text_of(), "UTF-8").alias("text"))
    return source.mapInArrow(run, f"doc_id {dict(source.dtypes)['doc_id']}, fp long")


#: Check masks of the Hamming code of length 31: mask k has the places whose number has bit k.
MASKS = [sum(1 << (place - 1) for place in range(1, 32) if place >> bit & 1) for bit in range(5)]


def _bit(place: Column) -> Column:
    """The bit of a place from 1 to 31; place 0 stands for no bit."""
    return F.when(place == 0, F.lit(0).cast("long")).otherwise(F.call_function("shiftleft", F.lit(1).cast("long"), (place - 1).cast("int")))


def _syndrome(word: Column) -> Column:
    total = F.lit(0)
    for bit, mask in enumerate(MASKS):
        total = total + (F.bit_count(word.bitwiseAND(F.lit(mask))) % 2) * (1 << bit)
    return total


def links(fps: DataFrame, threshold: int = 3) -> DataFrame:
    """(a, b) of all distinct fingerprints ``fp`` with 1 to ``threshold`` differing bits (at most 3), a < b.

    Of two such fingerprints, one half of 32 bits differs in at most one bit. The anchors of a half are the 2^26
    words of the Hamming code on its low 31 bits: covering radius 1, so every half has an anchor within one bit, its
    home. With one more bit of difference the other half is within two bits of that home. Each half is therefore
    sent to every anchor within radius + 1 (at most 16), and compared there with the halves at home. Spark's skew
    join splits hot anchors; only pairs within the threshold leave the join.
    """
    if not 0 <= threshold <= 3:
        raise ValueError("the two halves cover thresholds from 0 to 3")
    halves = fps.select("fp").distinct().select(
        "fp",
        F.explode(F.array(*[
            F.struct(F.lit(n).alias("side"), F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit(0x7FFFFFFF)).alias("word"))
            for n, shift in enumerate((0, 32))
        ])).alias("half"),
    ).select("fp", "half.*").withColumn("syndrome", _syndrome(F.col("word")))
    home = halves.select(F.col("fp").alias("a"), "side", F.col("word").bitwiseXOR(_bit(F.col("syndrome"))).alias("anchor"))
    places = F.expr("IF(syndrome = 0, array(0), filter(sequence(0, 31), i -> i < (i ^ syndrome)))")
    sent = halves.select("fp", "side", "word", "syndrome", F.explode(places).alias("i"))
    other = F.when(F.col("syndrome") == 0, F.lit(0)).otherwise(F.expr("i ^ syndrome"))
    sent = sent.select(
        F.col("fp").alias("b"), F.col("side").alias("side_b"),
        F.col("word").bitwiseXOR(_bit(F.col("i"))).bitwiseXOR(_bit(other)).alias("anchor_b"),
    )
    distance = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    near = (F.col("anchor") == F.col("anchor_b")) & (F.col("side") == F.col("side_b")) & (F.col("a") != F.col("b")) & (distance <= threshold)
    # a at home, b sent: both orders occur, and either one suffices. The places sent are many times the fingerprints, by
    # whose size Spark would take them for a table to broadcast.
    return home.hint("merge").join(sent.hint("merge"), near).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, threshold: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id, n_links) of every row of ``docs``.

    ``component_id`` is the smallest doc_id reachable over links between fingerprints with at most ``threshold``
    differing bits, ``n_links`` the number of other fingerprints linked. Copies share a fingerprint, which is
    compared once. Null texts count as empty; rows without words have fingerprint zero and link like others. Rows
    with a null doc_id link like others, but give a component no name: its component_id is null if no row has an
    id. Repeated rows are repeated in the result. An empty table gives no rows. Other columns are ignored.
    """
    marked = materialize(fingerprints(docs, shingle), "fingerprints")
    classes = marked.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    pairs = materialize(links(classes, threshold), "links")
    both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = both.groupBy("a").agg(F.count(F.lit(1)).alias("n_links")).select(F.col("a").alias("fp_d"), "n_links")
    roots = components(pairs)
    named = classes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    names = named.groupBy("root").agg(F.min("first_id").alias("component_id")).withColumnRenamed("root", "r")
    found = named.join(names, F.col("root") == F.col("r")).join(degree, F.col("fp") == F.col("fp_d"), "left")
    found = found.select(F.col("fp").alias("fp_c"), "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return marked.join(found, F.col("fp") == F.col("fp_c")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "n_links"
    )
