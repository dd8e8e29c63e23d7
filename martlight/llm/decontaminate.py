"""Benchmark decontamination by spaced seeds."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlight.llm.common import let, text_of, words_of
from martlight.session import materialize

#: Places of a mask that are hashed; together they hit every pattern of two changes in twelve or more words.
MASKS = ((0, 2, 3, 5, 6, 7), (0, 1, 2, 4, 8, 9), (0, 1, 2, 5, 6, 8))
#: An overlap is checked in windows of so many words (the whole item if it has fewer).
WINDOW, SIMILARITY = 13, 0.8
#: Rows up to which the seeds of the benchmark, and the rows to verify, are broadcast; beyond, Spark joins by shuffle.
MOST_SEEDS, MOST_CANDIDATES = 2_000_000, 500_000


def masks_for(size: int, similarity: float = SIMILARITY) -> list[tuple[int, ...]]:
    """Masks of which one fits on any ``size`` words with at least ``similarity`` equal words.

    With c changes, of c + 2 parts two stay whole (of c + 1 parts one, where only one word must be equal): the masks
    are all choices of so many parts.
    """
    changes = max((c for c in range(size) if (size - c) / size >= similarity), default=0)
    if changes <= 2 and size >= 12:
        return list(MASKS)
    whole = min(2, size - changes)
    cuts = [size * n // (changes + whole) for n in range(changes + whole + 1)]
    parts = [tuple(range(a, b)) for a, b in zip(cuts, cuts[1:], strict=False)]
    chosen = (sum(some, ()) for some in combinations(parts, whole))
    return sorted({tuple(n - places[0] for n in places) for places in chosen})


def _seeds(words: Column, masks: dict) -> Column:
    """Array of (place, seed): the hash of each of the numbered masks at each place where it fits."""

    def masked(h: Column, kept: tuple[int, ...]) -> Column:
        last = F.size(h) - (kept[-1] + 1)

        def seed(i: Column) -> Column:
            return F.struct(i.alias("place"), F.xxhash64(F.lit(masks[kept]), *[F.get(h, i + n) for n in kept]).alias("seed"))

        places = F.sequence(F.lit(0), F.greatest(last, F.lit(0)))
        return F.transform(F.filter(places, lambda i: i <= last), seed)

    def hashed(h: Column) -> Column:
        return F.concat(*[masked(h, kept) for kept in masks])

    return let(F.transform(words, lambda w: F.xxhash64(w)), hashed)


def _bounded(df: DataFrame, most: int) -> DataFrame:
    """``df`` with a broadcast hint if it is counted to have at most ``most`` rows."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, item_id, doc_start, overlap, n_equal): one row for each document and benchmark item that overlap.

    Words are lower-cased runs of letters and digits. Where a mask gives the same hash in a document and an item, the
    two are laid over each other at that place; they overlap if in some ``window`` consecutive words of the item (all
    of them if it has fewer) at least ``similarity`` of the words are equal. ``overlap`` is that share in the best
    window, ``n_equal`` the equal words of the whole item, ``doc_start`` the word of the document on the item's first
    word (negative if the item starts before the text); of several places the best counts, then the first. Every
    overlap has a mask that fits; items of fewer words than a window have masks of their own. Items without words are
    not looked for. Null texts count as empty; a null doc_id or item_id is a value
    like any other; repeated rows give one row; empty tables give none; other columns are ignored.
    """
    items = benchmark.select("item_id", words_of(text_of()).alias("item")).distinct()
    # At most one row for each size below the window.
    sizes = [r[0] for r in items.select(F.least(F.size("item"), F.lit(window))).where(F.size("item") > 0).distinct().collect()]
    fitting = {size: masks_for(size, similarity) for size in sorted({window, *sizes})}
    masks = {kept: number for number, kept in enumerate(sorted({kept for some in fitting.values() for kept in some}))}
    item_seeds = _seeds(F.col("item"), {kept: masks[kept] for kept in fitting[window]})
    for size in sizes:
        if size < window:
            item_seeds = F.when(F.size("item") == size, _seeds(F.col("item"), {kept: masks[kept] for kept in fitting[size]})).otherwise(item_seeds)
    tested = _bounded(
        items.select("item_id", "item", F.explode(item_seeds).alias("s")).select(
            "item_id", "item", F.col("s.place").alias("item_place"), F.col("s.seed").alias("item_seed")
        ).select("item_id", "item_place", "item_seed").distinct(),
        MOST_SEEDS,
    )
    seeded = docs.select("doc_id", F.explode(_seeds(words_of(text_of()), masks)).alias("s"))
    hits = seeded.select("doc_id", F.col("s.place").alias("place"), F.col("s.seed").alias("seed")).join(
        tested, F.col("seed") == F.col("item_seed")
    )
    laid = hits.select("doc_id", "item_id", (F.col("place") - F.col("item_place")).alias("doc_start")).distinct()
    to_verify = laid.select(F.col("doc_id").alias("d"), F.col("item_id").alias("i"), "doc_start")
    to_verify = _bounded(materialize(to_verify, "candidates"), MOST_CANDIDATES)
    texts = docs.select("doc_id", text_of().alias("text"))
    pairs = texts.join(to_verify, F.col("doc_id").eqNullSafe(F.col("d")))
    pairs = pairs.join(_bounded(items, MOST_CANDIDATES), F.col("item_id").eqNullSafe(F.col("i")))

    def laid_over(words: Column) -> Column:
        same = F.transform(
            F.col("item"),
            lambda w, n: F.when((F.col("doc_start") + n >= 0) & (F.get(words, F.greatest(F.col("doc_start") + n, F.lit(0))) == w), 1).otherwise(0),
        )

        def best(same: Column) -> Column:
            n = F.least(F.size(same), F.lit(window))
            shares = F.transform(
                F.sequence(F.lit(1), F.size(same) - n + 1),
                lambda s: F.aggregate(F.slice(same, s, n), F.lit(0), lambda a, x: a + x) / n,
            )
            total = F.aggregate(same, F.lit(0), lambda a, x: a + x)
            return F.struct(F.array_max(shares).alias("overlap"), total.cast("long").alias("n_equal"))

        return let(same, best)

    verified = pairs.select("doc_id", "item_id", F.col("doc_start").cast("long").alias("doc_start"), let(words_of(F.col("text")), laid_over).alias("v"))
    verified = verified.select("doc_id", "item_id", "doc_start", "v.*").where(F.col("overlap") >= similarity)
    best = F.max(F.struct("overlap", "n_equal", (-F.col("doc_start")).alias("before"))).alias("b")
    return verified.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", (-F.col("b.before")).alias("doc_start"), "b.overlap", "b.n_equal"
    )
