"""Quality scores by nearest-neighbour voting among labelled latent-semantic vectors."""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlight.llm.common import free_name, small_batches, text_of

#: Hashed byte trigrams, and pseudo terms for how much of a text repeats the word before.
TRIGRAMS, REPEATS = 4096, 8
TERMS = TRIGRAMS + REPEATS
#: At most so many labelled texts of each label are learned from: this bounds the model and the driver.
PER_LABEL, LATENT, NEIGHBOURS = 2048, 64, 24
THRESHOLD = 0.3


def term_counts(text: bytes) -> np.ndarray:
    """How often each term occurs in a text."""
    counts = np.zeros(TERMS, dtype=np.float32)
    b = np.frombuffer(text, dtype=np.uint8).astype(np.uint32)
    if len(b) >= 3:
        mixed = b[:-2] * np.uint32(2654435761) ^ b[1:-1] * np.uint32(2246822519) ^ b[2:] * np.uint32(3266489917)
        counts[:TRIGRAMS] = np.bincount((mixed ^ mixed >> 15) % TRIGRAMS, minlength=TRIGRAMS)
    words = text.split()
    if len(words) > 1:
        share = sum(map(eq, words, words[1:])) / (len(words) - 1)
        counts[TRIGRAMS + min(int(share * REPEATS), REPEATS - 1)] = len(words)
    return counts


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of unit length: logarithm of the counts times idf. Takes little more memory than the result."""
    rows = np.log1p(counts)
    rows *= idf
    for at in range(0, len(rows), 256):
        part = rows[at : at + 256]
        part /= np.maximum(np.linalg.norm(part, axis=1, keepdims=True), 1e-9)
    return rows


class Model:
    """Term weights, the latent basis, and the labelled vectors in it."""

    def __init__(self, counts: np.ndarray, labels: np.ndarray) -> None:
        seen = (counts > 0).sum(axis=0)
        self.idf = np.log((1 + len(counts)) / (1 + seen)).astype(np.float32) + np.float32(0.5)
        rows = weighted(counts, self.idf)
        # Randomised truncated decomposition with two power steps.
        rank = min(LATENT, *rows.shape)
        basis = np.random.default_rng(7).standard_normal((rows.shape[1], min(rank + 16, rows.shape[1]))).astype(np.float32)
        for _ in range(3):
            basis, _ = np.linalg.qr(rows.T @ (rows @ basis))
        _, _, turn = np.linalg.svd(rows @ basis, full_matrices=False)
        self.basis = np.ascontiguousarray((basis @ turn.T)[:, :rank], dtype=np.float32)
        self.labels = labels.astype(np.float32)
        self.prior = float(labels.mean()) if len(labels) else 0.5
        self.vectors = self._turned(rows)

    def project(self, counts: np.ndarray) -> np.ndarray:
        return self._turned(weighted(counts, self.idf))

    def _turned(self, rows: np.ndarray) -> np.ndarray:
        rows = rows @ self.basis
        return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """Share of label 1 among the nearest neighbours, weighted by the square of their cosine.

        Neighbours as near as the last one count too, so ties do not depend on an order.
        """
        if not len(self.labels):
            return np.full(len(counts), self.prior)
        near = np.round(self.project(counts) @ self.vectors.T, 5)
        k = min(NEIGHBOURS, near.shape[1])
        least = np.partition(near, near.shape[1] - k, axis=1)[:, -k][:, None]
        votes = np.where(near >= np.maximum(least, 0), near, 0).astype(np.float64) ** 2
        total = votes.sum(axis=1)
        return np.where(total > 0, votes @ self.labels / np.maximum(total, 1e-12), self.prior)


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Model:
    """Learns from at most ``per_label`` labelled texts of either label, the first in hash order, none held out.

    Rows of ``labels`` with a null doc_id or quality are left out; of several for one doc_id the lowest quality counts,
    and of several rows of ``docs`` the smallest text, so repeated ids do not lift the bound.
    """
    spark = docs.sparkSession
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = known.where(~held_out())
    chosen = [known.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label) for q in (0, 1)]
    # At most twice per_label rows.
    picked = F.broadcast(chosen[0].union(chosen[1]).withColumnRenamed("doc_id", "_id"))
    rows = docs.select("doc_id", F.encode(text_of(), "UTF-8").alias("body")).join(picked, F.col("doc_id") == F.col("_id"))
    rows = rows.groupBy("doc_id", "quality").agg(F.min("body").alias("body"))
    small_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [term_counts(text) for text in batch.column(1).to_pylist()]
            terms = [np.flatnonzero(c) for c in found]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "quality": batch.column(2),
                "terms": pa.array([t.astype("<i4").tobytes() for t in terms], pa.binary()),
                "counts": pa.array([c[t].astype("<f4").tobytes() for c, t in zip(found, terms, strict=True)], pa.binary()),
            })

    kinds = dict(rows.dtypes)
    got = rows.select("doc_id", "body", "quality").mapInArrow(
        run, f"doc_id {kinds['doc_id']}, quality {kinds['quality']}, terms binary, counts binary"
    ).collect()
    got = sorted(got, key=lambda r: (r.doc_id, r.terms, r.counts))
    counts = np.zeros((len(got), TERMS), dtype=np.float32)
    for n, r in enumerate(got):
        counts[n, np.frombuffer(r.terms, dtype="<i4")] = np.frombuffer(r.counts, dtype="<f4")
    return Model(counts, np.array([r.quality for r in got], dtype=np.float32))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """All rows and columns of ``docs`` with ``score`` (0 to 1, higher for label 1), replacing a column of that name.

    Every document is compared with every labelled vector, in blocks of rows. Only the text is an input. Null and
    empty texts, and texts like no labelled one, get the share of label 1 in the sample. Repeated rows are repeated.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    name = free_name(docs, "body")
    rows = docs.drop("score").withColumn(name, F.encode(text_of(), "UTF-8"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            body = batch.column(names.index(name))
            counts = np.empty((batch.num_rows, TERMS), dtype=np.float32)
            for n in range(batch.num_rows):
                counts[n] = term_counts(body[n].as_py())
            kept = [n for n, other in enumerate(names) if other != name]
            scores = pa.array(shared.value.scores(counts), pa.float64())
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in kept], scores], [*[names[n] for n in kept], "score"])

    kept = docs.drop("score")
    return rows.mapInArrow(run, ", ".join([f"`{c}` {kind}" for c, kind in kept.dtypes] + ["score double"]))
