"""Hard negatives by exact integer scores in a residue number system.

Vectors are integers. Blocks of anchors meet blocks of rows; a block's scores are matrix products modulo a few primes,
each exact in float32, and the Chinese remainder theorem gives the signed integers back. Positives are the best rows of
the anchor's own label; negatives are the best of the others in a window below each positive's score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlight.llm.common import importable
from martlight.session import materialize

#: Rows and anchors of a block; rows of a block that are multiplied at once.
ROWS, ANCHORS, STRIP = 8192, 2048, 2048
#: Components multiplied at once: residues are at most 254 in size, and 256 * 254 * 254 < 2^24.
SLAB = 256
#: The largest primes below 512.
PRIMES = (509, 503, 499, 491, 487, 479, 467, 463)
LEAST = np.iinfo(np.int64).min


def residues(vectors: np.ndarray, prime: int) -> np.ndarray:
    """Integers modulo an odd prime, between -prime/2 and prime/2, as float32."""
    half = prime // 2
    return ((vectors + half) % prime - half).astype(np.float32)


def primes_for(bound: int) -> tuple[int, ...]:
    """As few of the primes as tell all integers from -bound to bound apart."""
    product = 1
    for n, prime in enumerate(PRIMES):
        product *= prime
        if product > 2 * bound:
            return PRIMES[: max(n + 1, 2)]
    raise ValueError("the scores do not fit a long integer")


class Residues:
    """Integer vectors by their residues for each prime; ``scores`` multiplies two sets of them."""

    def __init__(self, vectors: np.ndarray, primes: tuple[int, ...]) -> None:
        self.primes, self.parts = primes, [residues(vectors, p) for p in primes]

    def take(self, rows) -> Residues:
        out = object.__new__(Residues)
        out.primes, out.parts = self.primes, [part[rows] for part in self.parts]
        return out

    def scores(self, other: Residues) -> np.ndarray:
        """All inner products, as exact signed integers."""
        mixed: list[np.ndarray] = []
        for prime, a, b in zip(self.primes, self.parts, other.parts, strict=True):
            half = prime // 2
            total = np.zeros((len(a), len(b)), dtype=np.int32)
            for at in range(0, a.shape[1], SLAB):
                total += (a[:, at : at + SLAB] @ b[:, at : at + SLAB].T).astype(np.int32)
                total %= prime
            # Mixed radix: the digit of this prime is what the earlier digits leave, divided by the earlier primes.
            for before, digit in zip(self.primes, mixed, strict=False):
                total -= digit
                total *= pow(before, -1, prime)
                total %= prime
            mixed.append((total + half) % prime - half)
        out = mixed[-1].astype(np.int64)
        for prime, digit in zip(self.primes[-2::-1], mixed[-2::-1], strict=True):
            out *= prime
            out += digit
        return out


def best_columns(scores: np.ndarray, left_out: np.ndarray, k: int) -> list[np.ndarray]:
    """Places of the ``k`` largest scores of each row that are not left out; of equal scores the first."""
    n = scores.shape[1]
    k = min(k, n)
    if int(np.abs(scores).max()) < (1 << 61) // n:
        keys = scores * n + np.arange(n)[::-1]
        keys[left_out] = LEAST
        best = np.argpartition(keys, n - k, axis=1)[:, n - k :]
    else:
        best = np.argsort(np.where(left_out, np.iinfo(np.int64).max, -scores), axis=1, kind="stable")[:, :k]
    return [row[~out[row]] for row, out in zip(best, left_out, strict=True)]


def valid(rows: DataFrame) -> DataFrame:
    """(vec_id, label, vector, row) of the rows that take part; a row that is repeated takes part once.

    Left out are rows with a null label, a null vector or a null or non-finite component. ``vector`` has the components
    floor(256 * x); ``row`` tells rows with the same vec_id apart. Null ids are allowed: such a row is no anchor.
    """
    good = F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where(good).select("vec_id", "label", F.transform("embedding", lambda x: F.floor(x * 256)).alias("vector"))
    return rows.dropDuplicates().withColumn("row", F.xxhash64("label", "vector"))


def _blocked(side: DataFrame, own: str, own_count: int, other: str, other_count: int, columns: list[str]) -> DataFrame:
    """Deals rows to blocks by hash and repeats each for every block of the other side."""
    block = F.pmod(F.xxhash64("vec_id", "row", F.lit(7)), F.lit(own_count)).cast("int")
    return side.select(*columns, block.alias(own), F.explode(F.sequence(F.lit(0), F.lit(other_count - 1))).alias(other))


def _matrix(column: pa.ChunkedArray | pa.ListArray, width: int) -> np.ndarray:
    """Vectors as rows of a matrix; short ones end in zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat, ends = column.flatten().to_numpy(), np.cumsum(column.value_lengths().to_numpy())
    if len(flat) == len(column) * width:
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width), dtype=np.int64)
    for n, row in enumerate(np.split(flat, ends[:-1])):
        out[n, : len(row)] = row
    return out


def _ordered(table: pa.Table) -> pa.Table:
    """Rows by vec_id (nulls last) and row, so that of equal scores the first column comes first."""
    return table.sort_by([("vec_id", "ascending"), ("row", "ascending")])


class Miner:
    """The two block jobs; holds parameters alone."""

    def __init__(self, width: int, primes: tuple[int, ...], positives: int, negatives: int, window: tuple[int, int]) -> None:
        self.width, self.primes, self.positives, self.negatives, self.window = width, primes, positives, negatives, window

    def _sides(self, rows: pa.Table, anchors: pa.Table) -> tuple:
        rows = _ordered(rows)
        return rows, Residues(_matrix(rows["vector"], self.width), self.primes), Residues(_matrix(anchors["vector"], self.width), self.primes)

    def best_positives(self, rows: pa.Table, anchors: pa.Table) -> pa.Table:
        """For each anchor of the block the best other rows of its label in the block."""
        out: list[tuple] = []
        if rows.num_rows and anchors.num_rows:
            rows, right, left = self._sides(rows, anchors)
            ids, keys, labels = rows["vec_id"].to_pylist(), rows["row"].to_numpy(), rows["label"].to_numpy()
            of = anchors["label"].to_numpy()
            names, marks = anchors["vec_id"].to_pylist(), anchors["row"].to_numpy()
            id_of = np.array([-1 if i is None else i for i in ids], dtype=np.int64)
            known = np.array([i is not None for i in ids])
            for label in np.unique(of):
                mine, theirs = np.flatnonzero(of == label), np.flatnonzero(labels == label)
                for at in range(0, len(theirs), STRIP):
                    some = theirs[at : at + STRIP]
                    found = left.take(mine).scores(right.take(some))
                    own = (id_of[some][None, :] == np.array([names[m] for m in mine])[:, None]) & known[some][None, :] & (keys[some][None, :] == marks[mine][:, None])
                    for m, best in enumerate(best_columns(found, own, self.positives)):
                        a = mine[m]
                        out += [(names[a], marks[a], ids[some[c]], keys[some[c]], found[m, c]) for c in best]
        return _table(out, POSITIVE)

    def best_negatives(self, rows: pa.Table, anchors: pa.Table) -> pa.Table:
        """For each anchor and positive the best rows of other labels in the block with a score in the window."""
        out: list[tuple] = []
        if rows.num_rows and anchors.num_rows:
            rows, right, left = self._sides(rows, anchors)
            ids, labels, keys = rows["vec_id"].to_pylist(), rows["label"].to_numpy(), rows["row"].to_numpy()
            of, names, marks = anchors["label"].to_numpy(), anchors["vec_id"].to_pylist(), anchors["row"].to_numpy()
            low, high = self.window
            # Whole scores: at least ceil(low * p / 100), at most floor(high * p / 100).
            sets = [[(p["id"], p["row"], p["score"], -(-low * p["score"] // 100), high * p["score"] // 100) for p in row] for row in anchors["positives"].to_pylist()]
            least = np.array([min(p[3] for p in row) for row in sets], dtype=np.int64)
            most = np.array([max(p[4] for p in row) for row in sets], dtype=np.int64)
            for at in range(0, rows.num_rows, STRIP):
                found = left.scores(right.take(slice(at, at + STRIP)))
                fits = (found >= least[:, None]) & (found <= most[:, None]) & (labels[at : at + STRIP][None, :] != of[:, None])
                for a in np.flatnonzero(fits.any(axis=1)):
                    columns = np.flatnonzero(fits[a])
                    scores = found[a, columns]
                    columns = columns[np.lexsort((columns, -scores))]
                    scores = found[a, columns]
                    for name, row, score, lo, hi in sets[a]:
                        first = int(np.searchsorted(-scores, -hi))
                        for c, s in zip(columns[first : first + self.negatives], scores[first : first + self.negatives], strict=True):
                            if s >= lo:
                                out.append((names[a], marks[a], name, row, score, ids[at + c], keys[at + c], s))
        return _table(out, NEGATIVE)


POSITIVE = {"anchor_id": pa.int64(), "anchor_row": pa.int64(), "positive_id": pa.int64(), "positive_row": pa.int64(), "positive_score": pa.int64()}
NEGATIVE = POSITIVE | {"negative_id": pa.int64(), "negative_row": pa.int64(), "negative_score": pa.int64()}


def _table(rows: list[tuple], kinds: dict) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in kinds]
    return pa.table({n: pa.array(list(c), k) for (n, k), c in zip(kinds.items(), columns, strict=True)})


def _ddl(kinds: dict) -> str:
    return ", ".join(f"{name} long" for name in kinds)


def mine(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, window: tuple[int, int] = (50, 95),
    block_rows: int = ROWS, block_anchors: int = ANCHORS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the hard negatives.

    ``rows`` has vec_id, embedding and label; ``is_anchor`` picks the anchors among the rows that take part (``valid``).
    An anchor's positives are its best ``positives`` other rows of the same label, its negatives for a positive of score
    p the best ``negatives`` rows of other labels with window[0] * p <= 100 * score <= window[1] * p. Higher scores come
    first, then smaller vec_id (null last), then the hash of label and vector. Vectors of unequal length are compared as
    if the short one ended in zeros. An empty table gives no rows; other columns are ignored.

    Every anchor is scored against every row, in blocks dealt by hash, so no label or vector gathers in a task; nothing
    is broadcast and no block's scores leave its task but the best. Scores over 2^62 in size are an error.
    """
    spark = rows.sparkSession
    importable(spark)
    known = materialize(valid(rows), "vectors")
    square = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x)
    facts = known.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width"), F.max(square).alias("square")).first()
    # By Cauchy-Schwarz no score is above the largest square of a vector; the margin is for the sum in doubles.
    bound = int((facts["square"] or 0) * (1 + 1e-9)) + 1
    if bound >= 1 << 62:
        raise ValueError("the scores do not fit a long integer")
    anchors = known.where(is_anchor & F.col("vec_id").isNotNull())
    n_anchors = anchors.count()
    miner = Miner(facts["width"] or 0, primes_for(bound), positives, negatives, window)
    row_blocks, anchor_blocks = max(1, -(-facts["n"] // block_rows)), max(1, -(-n_anchors // block_anchors))
    columns = ["vec_id", "row", "label", "vector"]

    def in_blocks(job, some_anchors: DataFrame, kinds: dict, more: list[str]) -> DataFrame:
        left = _blocked(known, "r", row_blocks, "a", anchor_blocks, columns)
        right = _blocked(some_anchors, "a", anchor_blocks, "r", row_blocks, [*columns, *more])
        # Both sides stem from one table; new names keep them apart.
        right = right.toDF(*[f"{c}_" if c in ("r", "a") else c for c in right.columns])
        return left.groupBy("r", "a").cogroup(right.groupBy("r_", "a_")).applyInArrow(lambda rows, anchors: job(rows, anchors), _ddl(kinds))

    def ranked(found: DataFrame, by: list[str], score: str, name: str, most: int) -> DataFrame:
        order = [F.col(score).desc(), F.col(f"{name}_id").asc_nulls_last(), F.col(f"{name}_row")]
        return found.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= most)

    near = ranked(in_blocks(miner.best_positives, anchors, POSITIVE, []), ["anchor_id", "anchor_row"], "positive_score", "positive", positives)
    pair = F.struct(F.col("positive_id").alias("id"), F.col("positive_row").alias("row"), F.col("positive_score").alias("score"))
    # At most ``positives`` entries for each anchor.
    chosen = near.groupBy("anchor_id", "anchor_row").agg(F.collect_list(pair).alias("positives"))
    anchored = materialize(anchors.join(chosen, (F.col("vec_id") == F.col("anchor_id")) & (F.col("row") == F.col("anchor_row"))).select(*columns, "positives"), "anchors")
    found = in_blocks(miner.best_negatives, anchored, NEGATIVE, ["positives"])
    by = ["anchor_id", "anchor_row", "positive_id", "positive_row"]
    found = ranked(found, by, "negative_score", "negative", negatives)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def relabelled(rows: DataFrame) -> DataFrame:
    """The rows whose vec_id is divisible by 7 get the next of ten labels."""
    return rows.select(
        "vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).cast("int").alias("label")
    )


def mine_sql() -> str:
    """DuckDB SQL for ``mine(relabelled(embeddings), vec_id % 50 = 0)`` on tables whose rows and ids do not repeat."""
    return """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vector
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_dot_product(a.vector, b.vector) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.other_id AS negative_id,
       p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)
QUALIFY row_number() OVER w <= 3
"""
