import hashlib
import itertools
import random
import zlib
from collections import defaultdict

import pytest

from martlight.llm import conversations, registry
from martlight.llm.common import table

ASCII_BLANKS = " \t\n\x0b\x0c\r"


def name(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        dealt = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if dealt == 1:
            text = ""
        if dealt == 2:
            text = "".join(c for c in text if c not in ".!?")
        if dealt == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if dealt == 0 else 2 if dealt == 3 else 1)
    return out


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        shown = text.strip(ASCII_BLANKS)
        out.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def grammar(initials):
    rest = initials[1:] if initials[:1] == "s" else initials
    return (rest == "ua" * (len(rest) // 2)) and (rest or not initials)


def plain_edits(rows, faults):
    """Dijkstra-free DP over prefixes of the output's automaton, whole audits kept."""
    after = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    best = {0: (0, "", ())}

    def put(table, state, entry):
        if state not in table or entry[:2] < table[state][:2]:
            table[state] = entry

    def spread(table):
        for _ in range(4):
            for state, (cost, audit, out) in list(table.items()):
                for initial, role in (("u", "user"), ("a", "assistant")):
                    if (state, initial) in after:
                        put(table, after[state, initial], (cost + 2, audit + "I", (*out, f"{role}:")))

    spread(best)
    for (_, role, text), fault in zip(rows, faults, strict=True):
        new = {}
        for state, (cost, audit, out) in best.items():
            put(new, state, (cost + 3, audit + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            more = 1 if fault == "truncated" else 0
            if (state, role[:1]) in after:
                put(new, after[state, role[:1]], (cost + more, audit + "K", (*out, f"{role}:{text}")))
            for initial, to in (("u", "user"), ("a", "assistant")):
                if (state, initial) in after:
                    put(new, after[state, initial], (cost + 2 + more, audit + "R", (*out, f"{to}:{text}")))
        best = new
        spread(best)
    return min(best[s] for s in (0, 3) if s in best)


def plain(rows):
    """The figures of one conversation; ``rows`` are (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, name(r[1], r[2])))
    faults, turns = faults_of(rows), {r[0] for r in rows} - {None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    cost, audit, out = plain_edits(rows, faults)
    digest = hashlib.sha256("\n".join(out).encode()).hexdigest()
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)


def plain_all(rows):
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn, role, text))
    return {conv: plain(found) for conv, found in groups.items()}


def results(frame):
    return {r.conv_id: tuple(r)[1:] for r in frame.collect()}


def query_of(spark, rows, kind="long"):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], f"conv_id {kind}, turn long, role string, text string, n string, audit int")
    found = conversations.repaired(conversations.damaged(frame), frame.select("conv_id"))
    return found.where("repaired_sha256 IS NOT NULL").select("conv_id", *conversations.FIGURES, "audit", "repaired_sha256")


def test_dp_against_all_edits():
    """Every way to edit short rows, tried in full."""
    after = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    def ways(signs, state, room):
        if state in (0, 3) and not signs:
            yield 0, ""
        for initial in "ua":
            if room and (state, initial) in after:
                yield from ((c + 2, "I" + a) for c, a in ways(signs, after[state, initial], room - 1))
        if signs:
            sign, rest = signs[0], signs[1:]
            yield from ((c + 3, "D" + a) for c, a in ways(rest, state, room))
            if sign != "x":
                more = int(sign.isupper())
                if (state, sign.lower()) in after:
                    yield from ((c + more, "K" + a) for c, a in ways(rest, after[state, sign.lower()], room))
                for initial in "ua":
                    if (state, initial) in after:
                        yield from ((c + 2 + more, "R" + a) for c, a in ways(rest, after[state, initial], room))

    tables = conversations.Tables(["ua", chr(0x100) * 2, "aa", "xo"])
    for n in range(4):
        for signs in itertools.product("suaoSUAOx", repeat=n):
            row = tables.matrix("".join(signs))[0] if signs else [(0, conversations.Rope()), None, None, None]
            cost, audit = conversations.ended(row)
            assert (cost, str(audit)) == min(ways("".join(signs), 0, 4)), signs


def test_rules_change_nothing():
    dice = random.Random(5)
    rules = ["ua", chr(0x100) * 2, chr(0x101) * 2, "aa", "uu", "xx", chr(0x104) + chr(0x103)]
    tables = conversations.Tables(rules)
    for _ in range(200):
        signs = "".join(dice.choice(["ua", "ua", "ua", "uu", "aa", "xx", "u", "a", "o", "S", "A"]) for _ in range(dice.randint(1, 40)))
        packed = signs
        for n, pair in enumerate(rules):
            packed = packed.replace(pair, chr(conversations.FIRST_RULE + n))
        plain_way, packed_way = tables.matrix(signs), tables.matrix(packed)
        for a, b in zip(itertools.chain(*plain_way), itertools.chain(*packed_way), strict=True):
            assert (a is None) == (b is None) and (a is None or (a[0], str(a[1])) == (b[0], str(b[1]))), signs


def test_rope_order():
    dice = random.Random(2)

    def rope(n):
        return conversations.Rope("".join(dice.choice("DK") for _ in range(dice.randint(0, 3)))) if n < 2 else conversations.join(rope(n // 2), rope(n - n // 2))

    for _ in range(3000):
        a, b = rope(dice.randint(1, 6)), rope(dice.randint(1, 6))
        if dice.random() < 0.5:
            a, b = conversations.join(a, b), conversations.join(a, a)
        assert conversations.less(a, b) == (str(a) < str(b))


def test_query_on_whole_table(spark, small):
    rows = [tuple(r) for r in table(spark, small, "conversations").select("conv_id", "turn", "role", "text").collect()]
    want = plain_all(plain_damage(rows))
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    got = registry.op12_conversation_repair(spark, small)
    assert dict(got.dtypes) == {"conv_id": "bigint"} | dict.fromkeys(conversations.FIGURES, "bigint") | {"audit": "string", "repaired_sha256": "string"}
    found = got.collect()
    assert {r.conv_id: tuple(r)[1:] for r in found} == {r[0]: want.get(r[0], none) for r in rows}
    assert len(found) == len({r[0] for r in rows})


@pytest.mark.parametrize("chunk", [1024, 3])
def test_random_rows(spark, monkeypatch, chunk):
    monkeypatch.setattr(conversations, "CHUNK", chunk)
    dice = random.Random(chunk)
    rows = []
    for _ in range(700):
        conv = dice.choice([None, 7, 7, 7, *range(60)])
        turn = dice.choice([None, *range(9), 40])
        role = dice.choice([None, "", "system", "user", "user", "assistant", "assistant", "tool", "User"])
        text = dice.choice([None, "", " \n", "a.", "b", "c? \t", "d!\x1c", "é", "e . f", "😀"])
        rows.append((conv, turn, role, text))
    want = plain_all(plain_damage(rows))
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert results(query_of(spark, rows)) == {r[0]: want.get(r[0], none) for r in rows}


def test_one_long_conversation(spark, monkeypatch):
    """A conversation of many chunks, equal turns among them, over all partitions."""
    monkeypatch.setattr(conversations, "CHUNK", 64)
    dice = random.Random(9)
    rows = [(1, n // 3, dice.choice(["user", "assistant", "system"]), dice.choice(["x.", "y", f"{n}.", f"{n}"])) for n in range(4000)]
    rows += [(1, 5000, "user", "again.")] * 500 + [(2, None, "user", "a" * 300_000 + ".")]
    assert results(query_of(spark, rows)) == plain_all(plain_damage(rows))


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "a."), (1, 1, "user", "b."), (1, 2, "assistant", "c")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = conversations.repaired(frame).orderBy("place").collect()
    assert [(r.place, r.edit, r.role, r.text) for r in out if r.edit] == [(0, "K", "user", "a."), (1, "I", "assistant", ""), (2, "K", "user", "b."), (3, "K", "assistant", "c")]
    assert [(r.place, r.audit, r.cost, r.illegal) for r in out if r.audit] == [(4, "KIKK", 3, 1)]


def test_odd_tables(spark):
    assert query_of(spark, []).count() == 0
    text_ids = [("a", 1, "user", "x."), ("a", 2, "assistant", "y."), (None, None, None, None)]
    want = plain_all(plain_damage(text_ids))
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert results(query_of(spark, text_ids, "string")) == {k: want.get(k, none) for k in ("a", None)}
