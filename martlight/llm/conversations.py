"""Repair of the role structure of conversations by a min-plus DP over grammar-compressed sequences.

A conversation is a row of signs, one for each turn: its role and its fault. Re-Pair finds the pairs of signs that recur
over all conversations and names them by rules. Each sign and each rule has one transfer matrix: for every state of the
role automaton before and after it the cheapest edits, their cost and their audit, kept as a rope of the two halves.
Conversations multiply the matrices of what is left of them, so what they share is evaluated once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlight.llm.common import small_batches
from martlight.session import materialize

#: ASCII white space.
BLANKS = " \t\n\x0b\x0c\r"
#: A sign of the statistics: "A" + 4 * (place of the role's initial in "sua", else 3) + fault, and the DP's sign for it.
#: Faults: none 0, blank 1, duplicate 2, truncated 3. Blank and duplicate turns have to go, whatever their role.
KINDS, SIGNS = "ABCDEFGHIJKLMNOP", "sxxSuxxUaxxAoxxO"
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
#: Pairs of neighbouring role places that the grammar has: su, ua, au.
LEGAL = {(0, 1), (1, 2), (2, 1)}
#: Turns of a chunk, the unit that is compressed and evaluated; long conversations have several.
CHUNK = 1024
#: Rules have names from here on.
FIRST_RULE = 0x100

START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after an output with this initial; (s?(ua)+)? ends in START or ASSISTANT.
AFTER = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ENDS = (START, ASSISTANT)
#: What an inserted or re-roled turn is in a state: the alternation leaves no choice.
NEXT = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
REROLE, DELETE, INSERT, CUT = 2, 3, 2, 1


class Rope:
    """A text as a leaf, or as two ropes in a row."""

    __slots__ = ("left", "right", "size", "text")

    def __init__(self, text: str = "", left: Rope | None = None, right: Rope | None = None) -> None:
        self.text, self.left, self.right = text, left, right
        self.size = len(text) if left is None else left.size + right.size

    def __str__(self) -> str:
        out, stack = [], [self]
        while stack:
            node = stack.pop()
            if node.left is None:
                out.append(node.text)
            else:
                stack += (node.right, node.left)
        return "".join(out)


def join(a: Rope, b: Rope) -> Rope:
    return b if not a.size else a if not b.size else Rope("", a, b)


def less(a: Rope, b: Rope) -> bool:
    """Whether ``a`` comes before ``b``; parts that both share at the same place are passed over whole."""
    one, two = [a], [b]
    while one and two:
        x, y = one.pop(), two.pop()
        if x is y:
            continue
        if x.left is None and y.left is None:
            n = min(x.size, y.size)
            if x.text[:n] != y.text[:n]:
                return x.text[:n] < y.text[:n]
            if x.size > n:
                one.append(Rope(x.text[n:]))
            if y.size > n:
                two.append(Rope(y.text[n:]))
        elif y.left is None or (x.left is not None and x.size >= y.size):
            one += (x.right, x.left)
            two.append(y)
        else:
            two += (y.right, y.left)
            one.append(x)
    return bool(two) and not one


#: A matrix: for each state before, for each state after, (cost, audit) or None.
Matrix = list[list[tuple[int, Rope] | None]]


def better(a: tuple[int, Rope] | None, b: tuple[int, Rope] | None) -> bool:
    if a is None or b is None:
        return b is None and a is not None
    return a[0] < b[0] or (a[0] == b[0] and less(a[1], b[1]))


def inserts(state: int) -> list[tuple[int, int]]:
    """(state, number of inserted turns) reachable without a turn of the input; more inserts lead to no new state."""
    found, n = [(state, 0)], 0
    while True:
        state, n = AFTER[state, NEXT[state]], n + 1
        if any(s == state for s, _ in found):
            return found
        found.append((state, n))


def of_sign(sign: str) -> Matrix:
    """The edits of one turn and of the inserts before it."""
    out: Matrix = [[None] * 4 for _ in range(4)]
    cut = CUT if sign.isupper() else 0
    for p in range(4):
        for state, n in inserts(p):
            ways = [(state, DELETE, "D")]
            if sign != "x":
                ways.append((AFTER[state, NEXT[state]], REROLE + cut, "R"))
                if (state, sign.lower()) in AFTER:
                    ways.append((AFTER[state, sign.lower()], cut, "K"))
            for q, cost, edit in ways:
                found = (INSERT * n + cost, Rope("I" * n + edit))
                if better(found, out[p][q]):
                    out[p][q] = found
    return out


def times(a: Matrix, b: Matrix) -> Matrix:
    out: Matrix = [[None] * 4 for _ in range(4)]
    for p in range(4):
        for r in range(4):
            if (left := a[p][r]) is None:
                continue
            for q in range(4):
                if (right := b[r][q]) is None:
                    continue
                cost, best = left[0] + right[0], out[p][q]
                if best is None or cost < best[0]:
                    out[p][q] = (cost, join(left[1], right[1]))
                elif cost == best[0]:
                    found = (cost, join(left[1], right[1]))
                    if better(found, best):
                        out[p][q] = found
    return out


def ended(row: list[tuple[int, Rope] | None]) -> tuple[int, Rope]:
    """The best of a row of states, with the inserts that may end it."""
    best = None
    for state, entry in enumerate(row):
        if entry is not None:
            for last, n in inserts(state):
                if last in ENDS:
                    found = (entry[0] + INSERT * n, join(entry[1], Rope("I" * n)))
                    best = found if better(found, best) else best
    return best


class Tables:
    """The matrices of the signs and, bottom-up, of the rules; a rule names the pair of symbols it stands for."""

    def __init__(self, rules: list[str]) -> None:
        self.rules = rules
        self.of = {sign: of_sign(sign) for sign in sorted(set(SIGNS))}
        for n, (a, b) in enumerate(rules):
            self.of[chr(FIRST_RULE + n)] = times(self.of[a], self.of[b])

    def matrix(self, symbols: str) -> Matrix:
        """The matrix of a compressed, non-empty sequence."""
        found = self.of[symbols[0]]
        for symbol in symbols[1:]:
            found = times(found, self.of[symbol])
        return found


def learn_rules(sequences: DataFrame, most: int = 256, per_round: int = 64) -> tuple[list[str], DataFrame]:
    """Re-Pair over the distinct ``signs`` with their numbers ``n``: the rules, and (signs, symbols) compressed by them.

    Every round counts all pairs of neighbouring symbols and replaces the ``per_round`` most frequent ones, in that
    order, until ``most`` rules exist or no pair occurs twice. The driver gets ``per_round`` rows a round. What has
    no rule stays as it is, so the bound costs sharing, never results.
    """
    rules: list[str] = []
    current = materialize(sequences.select("signs", F.col("signs").alias("symbols"), "n"), "sequences")
    while len(rules) < most:
        places = F.sequence(F.lit(1), F.length("symbols") - 1)
        pairs = current.where(F.length("symbols") > 1).select(
            F.explode(F.transform(places, lambda i: F.substr("symbols", i, F.lit(2)))).alias("pair"), "n"
        )
        top = pairs.groupBy("pair").agg(F.sum("n").alias("n")).where("n > 1")
        top = top.orderBy(F.desc("n"), "pair").limit(min(per_round, most - len(rules))).collect()
        if not top:
            break
        symbols = F.col("symbols")
        for r in top:
            symbols = F.replace(symbols, F.lit(r["pair"]), F.lit(chr(FIRST_RULE + len(rules))))
            rules.append(r["pair"])
        current = materialize(current.select("signs", symbols.alias("symbols"), "n"), "sequences")
    return rules, current.select("signs", "symbols")


def turns_of(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, digest, kind) of every row; null roles and texts are one space.

    ``digest`` names (role, text) by 128 bits; turns with the same number are ordered by it.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    turns = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    shown = F.rtrim(F.col("text"), F.lit(BLANKS))
    place = _role_place(F.col("role"))
    fault = F.when(shown == "", BLANK).when(F.substr(shown, F.length(shown), F.lit(1)).isin(".", "!", "?"), 0).otherwise(TRUNCATED)
    digest = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))))
    return turns.withColumn("digest", digest).withColumn("kind", (place * 4 + fault).cast("int"))


def _role_place(role: Column) -> Column:
    initial = F.substr(role, F.lit(1), F.lit(1))
    return F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)


def chunks(turns: DataFrame) -> DataFrame:
    """(conv_id, part, no, kinds, lo, hi, n_turns): the signs of every conversation in order, in chunks.

    Equal rows are counted before they are sorted, and the rows are dealt by ranges of (conv_id, turn, digest), so a
    conversation of any length is spread; (part, no) orders its chunks. ``lo``, ``hi`` and ``n_turns`` are the smallest,
    largest and number of distinct known turns of a chunk.
    """
    rows = turns.groupBy("conv_id", "turn", "digest", "kind").agg(F.count(F.lit(1)).alias("n"))
    order = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    first = rows.groupBy(F.col("conv_id").alias("c"), F.col("digest").alias("d")).agg(F.count(F.lit(1)).alias("m"), F.min(order).alias("first"))
    first = first.where("m > 1").select("c", "d", "first.*").withColumnsRenamed({"known": "again", "turn": "first"})
    rows = rows.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")), "left")
    later = F.col("again").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first"))
    kind = F.when(later & (F.col("kind") % 4 != BLANK), F.col("kind") - F.col("kind") % 4 + DUPLICATE).otherwise(F.col("kind"))
    keys = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("digest").asc_nulls_first()]
    rows = rows.select("conv_id", "turn", "digest", kind.alias("kind"), "n").repartitionByRange(*keys).sortWithinPartitions(*keys)
    id_type = dict(turns.dtypes)["conv_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, out = TaskContext.get().partitionId(), []
        conv, no, kinds, size, lo, hi, count = None, -1, [], 0, None, None, 0

        def close() -> None:
            nonlocal kinds, size, lo, hi, count, no
            if size:
                no += 1
                out.append((conv, part, no, "".join(kinds), lo, hi, count))
            kinds, size, lo, hi, count = [], 0, None, None, 0

        for batch in batches:
            for new, turn, kind, n in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if new != conv:
                    close()
                    conv = new
                again = KINDS[kind if kind % 4 == BLANK else kind - kind % 4 + DUPLICATE]
                left, sign = n, KINDS[kind]
                while left:
                    if size >= CHUNK:
                        close()
                    if turn is not None and turn != hi:
                        lo, hi, count = turn if lo is None else lo, turn, count + 1
                    some = min(left, CHUNK - size)
                    kinds.append(sign + again * (some - 1))
                    size, left, sign = size + some, left - some, again
            if len(out) >= 1000:
                yield _batch(out, names, types)
                out = []
        close()
        if out:
            yield _batch(out, names, types)

    names = ["conv_id", "part", "no", "kinds", "lo", "hi", "n_turns"]
    types = [_arrow(id_type), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    small_batches(turns.sparkSession, 1024)
    found = rows.select("conv_id", "turn", "kind", "n")
    return found.mapInArrow(run, f"conv_id {id_type}, part int, no long, kinds string, lo long, hi long, n_turns long")


def _batch(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def _arrow(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]


def matrices(compressed: DataFrame, rules: list[str]) -> DataFrame:
    """(signs, costs, audits) of the distinct sequences: the 16 entries of each matrix, null where there is no way."""
    small_batches(compressed.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables(rules)
        for batch in batches:
            costs, audits = [], []
            for symbols in batch.column(1).to_pylist():
                entries = [e for row in tables.matrix(symbols) for e in row]
                costs.append([None if e is None else e[0] for e in entries])
                audits.append([None if e is None else str(e[1]) for e in entries])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(costs, pa.list_(pa.int64())), pa.array(audits, pa.list_(pa.string()))], ["signs", "costs", "audits"]
            )

    return compressed.mapInArrow(run, "signs string, costs array<bigint>, audits array<string>")


FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def audits(rows: DataFrame, most_rules: int = 256) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation of ``rows``.

    ``rows`` has conv_id, turn, role and text; other columns are ignored. A null conv_id is a conversation too. Turns
    come in order, nulls first, and equal ones by the digest of role and text. An empty table gives no rows.
    """
    kinds = materialize(chunks(turns_of(rows)), "chunks")
    kinds = kinds.withColumn("signs", F.translate("kinds", KINDS, SIGNS))
    rules, compressed = learn_rules(kinds.groupBy("signs").agg(F.count(F.lit(1)).alias("n")), most_rules)
    found = matrices(compressed, rules).withColumnRenamed("signs", "s")
    placed = kinds.join(found, F.col("signs") == F.col("s")).select("conv_id", "part", "no", "kinds", "lo", "hi", "n_turns", "costs", "audits")
    placed = placed.repartition("conv_id").sortWithinPartitions("conv_id", "part", "no")
    id_type = dict(kinds.dtypes)["conv_id"]
    names = ["conv_id", *FIGURES, "audit"]
    types = [_arrow(id_type), *[pa.int64()] * 6, pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: _Conversation | None = None
        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held is None or held.conv_id != row[0]:
                    if held is not None:
                        out.append(held.result())
                    held = _Conversation(row[0])
                held.add(*row[3:])
            if out:
                yield _batch(out, names, types)
        if held is not None:
            yield _batch([held.result()], names, types)

    return placed.mapInArrow(run, f"conv_id {id_type}, {', '.join(f'{f} long' for f in FIGURES)}, audit string")


class _Conversation:
    """Joins the chunks of one conversation in order; holds four ropes of edits, no turns."""

    def __init__(self, conv_id) -> None:
        self.conv_id, self.row = conv_id, [(0, Rope()), None, None, None]
        self.faults, self.illegal, self.lo, self.hi, self.n, self.last = [0] * 4, 0, None, None, 0, None

    def add(self, kinds: str, lo: int | None, hi: int | None, n: int, costs: list, audits: list) -> None:
        numbers = [KINDS.index(k) for k in kinds]
        for fault in range(4):
            self.faults[fault] += sum(k % 4 == fault for k in numbers)
        places = [k // 4 for k in numbers]
        before = places if self.last is None else [self.last, *places]
        self.illegal += sum(pair not in LEGAL for pair in zip(before, before[1:], strict=False))
        self.last = places[-1]
        if n:
            self.n += n - (self.hi is not None and self.hi == lo)
            self.lo, self.hi = lo if self.lo is None else self.lo, hi
        entries = [None if c is None else (c, Rope(a)) for c, a in zip(costs, audits, strict=True)]
        self.row = times([self.row, *[[None] * 4] * 3], [entries[p * 4 : p * 4 + 4] for p in range(4)])[0]

    def result(self) -> tuple:
        cost, audit = ended(self.row)
        gaps = self.hi - self.lo + 1 - self.n if self.n else 0
        return (self.conv_id, gaps, *self.faults[1:], self.illegal, cost, str(audit))


def repaired(rows: DataFrame, names: DataFrame | None = None, most_rules: int = 256) -> DataFrame:
    """The repaired turns, in order within their conversation, and one row that ends each conversation.

    Columns: conv_id, place (from 0; of the ending row: the number of turns), edit (K, R or I; null in the ending row),
    role, text, and in the ending row the columns of ``audits`` and ``repaired_sha256``, the SHA-256 of its
    ``role:text`` lines joined by a line break. Turns that are deleted have no row; an inserted turn has an empty
    text. ``names`` may have further conv_id values, which get an ending row with zeros, an empty audit and the hash of
    an empty text. The hash is one chain, so the turns of a conversation are streamed through one task, in sorted order
    and one at a time; none holds a conversation.
    """
    turns, found = turns_of(rows), audits(rows, most_rules)
    id_type = dict(turns.dtypes)["conv_id"]
    none = F.lit(None)
    heads = found.select(
        "conv_id", F.lit(0).alias("n"), none.cast("long").alias("turn"), none.cast("binary").alias("digest"), none.cast("string").alias("role"),
        F.col("audit").alias("text"), F.array(*FIGURES).alias("figures"),
    )
    lines = turns.select("conv_id", F.lit(1).alias("n"), "turn", "digest", "role", "text", none.cast("array<bigint>").alias("figures"))
    if names is not None:
        known = names.select("conv_id").distinct()
        heads = heads.unionByName(known.select(
            "conv_id", F.lit(-1).alias("n"), none.cast("long").alias("turn"), none.cast("binary").alias("digest"), none.cast("string").alias("role"),
            none.cast("string").alias("text"), none.cast("array<bigint>").alias("figures"),
        ))
    order = [F.col("conv_id").asc_nulls_first(), "n", F.col("turn").asc_nulls_first(), "digest"]
    dealt = heads.unionByName(lines).repartition("conv_id").sortWithinPartitions(*order)
    columns = ["conv_id", "place", "edit", "role", "text", *FIGURES, "audit", "repaired_sha256"]
    types = [_arrow(id_type), pa.int64(), *[pa.string()] * 3, *[pa.int64()] * 6, pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: _Repair | None = None
        for batch in batches:
            out = []
            for conv, n, role, text, figures in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held is None or held.conv_id != conv:
                    if held is not None:
                        out += held.end()
                    held = _Repair(conv)
                if n == 0:
                    held.audit, held.figures = text, figures
                elif n == 1:
                    out += held.turn(role, text)
            if out:
                yield _batch(out, columns, types)
        if held is not None:
            yield _batch(held.end(), columns, types)

    small_batches(rows.sparkSession, 1024)
    schema = f"conv_id {id_type}, place long, edit string, role string, text string, {', '.join(f'{f} long' for f in FIGURES)}, audit string, repaired_sha256 string"
    return dealt.select("conv_id", "n", "role", "text", "figures").mapInArrow(run, schema)


class _Repair:
    """Applies an audit to the turns of one conversation, one after another."""

    def __init__(self, conv_id) -> None:
        self.conv_id, self.audit, self.figures = conv_id, "", [0] * len(FIGURES)
        self.at, self.state, self.place, self.hash = 0, START, 0, hashlib.sha256()

    def _put(self, edit: str, role: str, text: str, state: int) -> tuple:
        if self.place:
            self.hash.update(b"\n")
        self.hash.update(f"{role}:{text}".encode())
        row = (self.conv_id, self.place, edit, role, text, *[None] * 8)
        self.state, self.place = state, self.place + 1
        return row

    def _new(self, edit: str, text: str) -> tuple:
        initial = NEXT[self.state]
        return self._put(edit, {"u": "user", "a": "assistant"}[initial], text, AFTER[self.state, initial])

    def _inserted(self) -> list[tuple]:
        out = []
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            out.append(self._new("I", ""))
            self.at += 1
        return out

    def turn(self, role: str, text: str) -> list[tuple]:
        out = self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            out.append(self._new("R", text))
        elif edit == "K":
            out.append(self._put("K", role, text, AFTER[self.state, role[0]]))
        return out

    def end(self) -> list[tuple]:
        out = self._inserted()
        return [*out, (self.conv_id, self.place, *[None] * 3, *self.figures, self.audit, self.hash.hexdigest())]


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the damage that crc32 of ``conv_id:turn`` modulo 20 deals; nulls are one space.

    0 drops a row, 1 empties its text, 2 takes out its full stops, exclamation and question marks, 3 repeats it, 4 makes
    its role user.
    """
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    dealt = (F.crc32(key.cast("binary")) % 20).alias("dealt")
    role, text = (F.coalesce(F.col(c).cast("string"), blank).alias(c) for c in ("role", "text"))
    rows = rows.select("conv_id", "turn", role, text, dealt).where("dealt <> 0")
    changed = F.when(F.col("dealt") == 1, "").when(F.col("dealt") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("dealt") == 4, "user").otherwise(F.col("role")).alias("role"), changed.alias("text"),
        F.explode(F.when(F.col("dealt") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")
