"""Document fingerprints by invertible Bloom lookup sketches of paragraph digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlight.llm.common import let, text_of

#: A paragraph is a line, or a part of at most so many characters of one, cut at white space where there is some.
PARAGRAPH = 200
#: A sketch is a power of two of blocks with three tables of SLOTS cells; it starts with a block for each PER_BLOCK digests.
TABLES, SLOTS, PER_BLOCK = 3, 4, 8
CELLS = TABLES * SLOTS
#: How often a sketch is doubled where the digests of a difference can't be recovered.
RETRIES = 18
#: Rows of a bucket of neighbouring ids.
PER_BUCKET = 1024


def digests(text: Column) -> Column:
    """The distinct digests of the paragraphs of a text."""
    parts = F.regexp_extract_all(text, F.lit(rf"[^\n]{{1,{PARAGRAPH}}}(?=\s|\z)|[^\n]{{1,{PARAGRAPH}}}"), F.lit(0))
    return F.array_distinct(F.transform(F.filter(F.transform(parts, lambda p: F.trim(p)), lambda p: p != ""), lambda p: F.xxhash64(p)))


def blocks_for(n: Column) -> Column:
    """The blocks of a sketch of ``n`` digests: a power of two, at least 1."""
    return F.call_function("shiftleft", F.lit(1), F.ceil(F.log2(F.greatest(n / PER_BLOCK, F.lit(1.0)))).cast("int"))


def _check(key: Column) -> Column:
    return F.xxhash64(F.lit(977), key).bitwiseAND(F.lit(0xFFFFFFFF))


def _block(key: Column, blocks: Column) -> Column:
    return key.bitwiseAND(blocks - 1)


def _placed(n: Column, key: Column) -> Column:
    """A key with the number of times it counts, its check hash, and the bits of its cells, one in each table.

    Keys are hashes; their low bits give the block, high ones the cells.
    """
    bits = F.lit(0)
    for t in range(TABLES):
        slot = F.shiftrightunsigned(key, 62 - 2 * t).bitwiseAND(F.lit(SLOTS - 1)).cast("int")
        bits = bits + F.call_function("shiftleft", F.lit(1 << t * SLOTS), slot)
    return F.struct(n.alias("n"), key.alias("key"), _check(key).alias("check"), bits.alias("bits"))


def block_cells(keys: Column) -> Column:
    """The cells (n, key, check) of one block: the count of its keys, and the XOR of them and of their check hashes."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("key"), F.lit(0).cast("long").alias("check"))

    def added(cell: Column, k: Column) -> Column:
        return F.struct(
            (cell["n"] + k["n"]).alias("n"), cell["key"].bitwiseXOR(k["key"]).alias("key"), cell["check"].bitwiseXOR(k["check"]).alias("check")
        )

    def cells(keyed: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.lit(CELLS - 1))
        return F.transform(numbers, lambda cell: F.aggregate(F.filter(keyed, lambda k: F.getbit(k["bits"], cell) == 1), zero, added))

    return let(F.transform(keys, lambda k: _placed(F.lit(1), k)), cells)


def sketch(keys: Column, blocks: Column) -> Column:
    """The cells of each block of a sketch."""
    numbers = F.sequence(F.lit(0), blocks - 1)
    return F.transform(numbers, lambda b: block_cells(F.filter(keys, lambda k: _block(k, blocks) == b)))


def subtract(one: Column, other: Column) -> Column:
    """Cell by cell, one block less another: common keys vanish."""
    return F.zip_with(one, other, lambda x, y: F.struct(
        (x["n"] - y["n"]).alias("n"), x["key"].bitwiseXOR(y["key"]).alias("key"), x["check"].bitwiseXOR(y["check"]).alias("check"),
    ))


def _filled(cells: Column) -> Column:
    return F.exists(cells, lambda c: (c["n"] != 0) | (c["key"] != 0) | (c["check"] != 0))


def _none() -> Column:
    return F.array().cast("array<bigint>")


def peel(cells: Column) -> Column:
    """(ok, gone, new): whether a subtracted block could be taken apart, and the digests on either side.

    A cell with a count of 1 or -1 whose check fits holds one digest; it is taken out of all its cells, which may
    leave other cells with one. The block is done when all cells are zero.
    """

    def pure(cells: Column) -> Column:
        alone = F.filter(cells, lambda c: ((c["n"] == 1) | (c["n"] == -1)) & (c["check"] == _check(c["key"])))

        def placed(alone: Column, n: int) -> Column:
            keys = F.array_distinct(F.transform(F.filter(alone, lambda c: c["n"] == n), lambda c: c["key"]))
            return F.transform(keys, lambda key: _placed(F.lit(n), key))

        return let(alone, lambda alone: F.concat(placed(alone, 1), placed(alone, -1)))

    def less(cell: Column, p: Column) -> Column:
        return F.struct(
            (cell["n"] - p["n"]).alias("n"), cell["key"].bitwiseXOR(p["key"]).alias("key"), cell["check"].bitwiseXOR(p["check"]).alias("check")
        )

    def without(cells: Column, found: Column) -> Column:
        return F.transform(cells, lambda c, n: F.aggregate(F.filter(found, lambda p: F.getbit(p["bits"], n) == 1), c, less))

    def step(state: Column, _: Column) -> Column:
        def taken(found: Column) -> Column:
            return F.when(F.size(found) == 0, F.struct(
                state["cells"].alias("cells"), state["gone"].alias("gone"), state["new"].alias("new"), F.lit(False).alias("going"),
            )).otherwise(F.struct(
                without(state["cells"], found).alias("cells"),
                F.concat(state["gone"], F.transform(F.filter(found, lambda p: p["n"] > 0), lambda p: p["key"])).alias("gone"),
                F.concat(state["new"], F.transform(F.filter(found, lambda p: p["n"] < 0), lambda p: p["key"])).alias("new"),
                F.lit(True).alias("going"),
            ))

        return F.when(state["going"], let(pure(state["cells"]), taken)).otherwise(state)

    start = F.struct(cells.alias("cells"), _none().alias("gone"), _none().alias("new"), F.lit(True).alias("going"))

    def done(state: Column) -> Column:
        return F.struct((~_filled(state["cells"])).alias("ok"), state["gone"].alias("gone"), state["new"].alias("new"))

    empty = F.struct(F.lit(True).alias("ok"), _none().alias("gone"), _none().alias("new"))
    # Every step but the last takes out a digest of the block, which has no more than cells that can be pure.
    return F.when(_filled(cells), let(F.aggregate(F.sequence(F.lit(0), F.lit(CELLS)), start, step), done)).otherwise(empty)


def fold(cells: Column, blocks: Column) -> Column:
    """A sketch of fewer ``blocks``: blocks with the same low bits are added, cell by cell."""

    def add(one: Column, other: Column) -> Column:
        return F.zip_with(one, other, lambda x, y: F.struct(
            (x["n"] + y["n"]).alias("n"), x["key"].bitwiseXOR(y["key"]).alias("key"), x["check"].bitwiseXOR(y["check"]).alias("check"),
        ))

    def folded(b: Column) -> Column:
        parts = F.filter(cells, lambda _, n: n.bitwiseAND((blocks - 1).cast("int")) == b)
        return F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), parts[0], add)

    return F.when(F.size(cells) == blocks, cells).otherwise(F.transform(F.sequence(F.lit(0), (blocks - 1).cast("int")), folded))


def recovered(one: Column, other: Column, one_cells: Column, other_cells: Column, retries: int = RETRIES) -> Column:
    """(gone, new): the digests that only one side has, recovered by peeling the difference of their sketches.

    The larger sketch is folded to the size of the smaller one, and the two are subtracted block by block. A block that
    can't be taken apart is sketched again at twice the size: its digests go to two blocks. After ``retries`` doublings
    digests would have to agree in all their low bits and share all their cells; what is left is compared as sets.
    """
    blocks = F.least(F.size(one_cells), F.size(other_cells)).cast("long")

    def attempt(b: Column, size: Column) -> Column:
        def in_block(keys: Column) -> Column:
            return F.filter(keys, lambda k: _block(k, size) == b)

        def tried(cells: Column) -> Column:
            return let(peel(cells), lambda p: F.struct(b.alias("b"), p["ok"].alias("ok"), p["gone"].alias("gone"), p["new"].alias("new")))

        return let(subtract(block_cells(in_block(one)), block_cells(in_block(other))), tried)

    def level(state: Column, _: Column) -> Column:
        def next_state(parts: Column) -> Column:
            good = F.filter(parts, lambda p: p["ok"])
            bad = F.filter(parts, lambda p: ~p["ok"])
            return F.struct(
                F.flatten(F.transform(bad, lambda p: F.array(p["b"], p["b"] + state["size"]))).alias("pending"),
                (state["size"] * 2).alias("size"),
                F.concat(state["gone"], F.flatten(F.transform(good, lambda p: p["gone"]))).alias("gone"),
                F.concat(state["new"], F.flatten(F.transform(good, lambda p: p["new"]))).alias("new"),
            )

        tries = F.transform(state["pending"], lambda b: attempt(b, state["size"]))
        return F.when(F.size(state["pending"]) > 0, let(tries, next_state)).otherwise(state)

    def first(one_cells: Column, other_cells: Column) -> Column:
        """The state after the two sketches themselves."""

        def tried(cells: Column, b: Column) -> Column:
            return let(peel(cells), lambda p: F.struct(b.cast("long").alias("b"), p["ok"].alias("ok"), p["gone"].alias("gone"), p["new"].alias("new")))

        def state(parts: Column) -> Column:
            good, bad = F.filter(parts, lambda p: p["ok"]), F.filter(parts, lambda p: ~p["ok"])
            return F.struct(
                F.flatten(F.transform(bad, lambda p: F.array(p["b"], p["b"] + blocks))).alias("pending"), (blocks * 2).alias("size"),
                F.flatten(F.transform(good, lambda p: p["gone"])).alias("gone"), F.flatten(F.transform(good, lambda p: p["new"])).alias("new"),
            )

        return let(F.transform(F.zip_with(one_cells, other_cells, subtract), tried), state)

    start = let(fold(one_cells, blocks), lambda x: let(fold(other_cells, blocks), lambda y: first(x, y)))

    def rest(state: Column) -> Column:
        def left(keys: Column) -> Column:
            return F.filter(keys, lambda k: F.array_contains(state["pending"], _block(k, state["size"])))

        plain = F.struct(
            F.concat(state["gone"], F.array_except(left(one), left(other))).alias("gone"),
            F.concat(state["new"], F.array_except(left(other), left(one))).alias("new"),
        )
        return F.when(F.size(state["pending"]) == 0, F.struct(state["gone"].alias("gone"), state["new"].alias("new"))).otherwise(plain)

    return let(F.aggregate(F.slice(F.sequence(F.lit(0), F.lit(retries)), 2, F.lit(retries)), start, level), rest)


def likeness(one: Column, other: Column, one_cells: Column, other_cells: Column) -> Column:
    """The share of common digests in all digests of two texts (1 for two without any), by their sketches."""

    def share(d: Column) -> Column:
        common = F.size(one) - F.size(d["gone"])
        whole = F.size(one) + F.size(d["new"])
        return F.when(whole > 0, common.cast("double") / whole).otherwise(F.lit(1.0))

    return let(recovered(one, other, one_cells, other_cells), share)


def own_sketch(keys: Column) -> Column:
    """The sketch of a text, at the size that the number of its digests gives it."""
    return let(blocks_for(F.size(keys)), lambda blocks: sketch(keys, blocks))


def fingerprint(keys: Column, cells: Column) -> Column:
    """The sketch as text: the number of digests, then count, key and check of each cell in hexadecimal."""
    written = F.transform(F.flatten(cells), lambda c: F.concat_ws(".", F.hex(c["n"]), F.hex(c["key"]), F.hex(c["check"])))
    return F.concat_ws(" ", F.size(keys).cast("string"), F.array_join(written, " "))


def with_next(docs: DataFrame, per_bucket: int = PER_BUCKET) -> DataFrame:
    """(doc_id, text, keys, next_text, next_keys): each row and its digests with the text of the next one by doc_id and text; the last has the first's.

    Rows are cut into buckets of neighbouring ids, with one window for each. A bucket also gets a copy of the rows
    that the bucket after it starts with, so each text is shuffled once. Null ids come first and form a bucket.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    rows = rows.withColumn("keys", digests(F.col("text")))
    low, high, n = rows.agg(F.min("doc_id"), F.max("doc_id"), F.count("doc_id")).first()
    low = 0 if low is None else low
    width = max(1, -(-((high or 0) - low + 1) // max(1, -(-n // per_bucket))))
    bucket = F.coalesce(F.floor((F.col("doc_id") - low) / width), F.lit(-1)).cast("long")
    rows = rows.withColumn("bucket", bucket)
    firsts = rows.groupBy("bucket").agg(F.min("doc_id").alias("first_id")).withColumn("top", F.floor(F.col("bucket") / 1024))
    tops = firsts.groupBy("top").agg(F.max("bucket").alias("last"))
    # One row for each 1024 buckets, a million rows of the table.
    tops = tops.select(F.col("top").alias("t"), F.lag("last").over(Window.orderBy("top")).alias("last_before"), F.max("last").over(Window.partitionBy()).alias("end"))
    inside = F.lag("bucket").over(Window.partitionBy("top").orderBy("bucket"))
    firsts = firsts.withColumn("inside", inside).join(tops, F.col("top") == F.col("t"))
    firsts = firsts.select(F.col("bucket").alias("b"), "first_id", F.coalesce("inside", "last_before", "end").alias("to"))
    copies = rows.join(firsts, (F.col("bucket") == F.col("b")) & F.col("doc_id").eqNullSafe(F.col("first_id")))
    every = rows.withColumn("copy", F.lit(0)).union(copies.select("doc_id", "text", "keys", F.col("to").alias("bucket"), F.lit(1).alias("copy")))
    order = Window.partitionBy("bucket").orderBy("copy", F.col("doc_id").asc_nulls_first(), "text")
    every = every.withColumn("next_text", F.lead("text").over(order)).withColumn("next_keys", F.lead("keys").over(order))
    return every.where("copy = 0").select("doc_id", "text", "keys", "next_text", "next_keys")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    The edited text has the last quarter of its code points replaced by as many of the next row's first (all, if it
    has fewer). Likeness is recovered from the sketches that are returned, and
    where their difference can't be peeled, from larger ones. Null texts count as empty; an empty text has a sketch
    of no digests, alike to another empty one. Rows with equal ids follow by text; a single row is its own next one.
    An empty table gives no rows; other columns are ignored.
    """
    n = F.length("text")
    edited = F.concat(F.left(F.col("text"), n - F.expr("length(text) div 4")), F.left(F.col("next_text"), F.expr("length(text) div 4")))
    rows = with_next(docs).withColumn("edited", edited)

    # One projection after another: each is resolved by itself, and a sketch is made once for all that reads it.
    rows = rows.withColumn("other", digests(F.col("edited")))
    rows = rows.withColumns({f"{c}_cells": own_sketch(F.col(c)) for c in ("keys", "other", "next_keys")})
    near = {
        f"near_{name}": likeness(F.col("keys"), F.col(c), F.col("keys_cells"), F.col(f"{c}_cells")) for name, c in (("edited", "other"), ("next", "next_keys"))
    }
    written = {"fingerprint": fingerprint(F.col("keys"), F.col("keys_cells")), "edited_fingerprint": fingerprint(F.col("other"), F.col("other_cells"))}
    rows = rows.withColumns(near | written)
    return rows.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    )
