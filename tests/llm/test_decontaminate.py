import re
from collections import defaultdict

from martlight.llm import decontaminate, registry

ITEM = " ".join(f"q{n}x" for n in range(30))


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower) if w]


def plain(docs, items, window=13, similarity=0.8):
    """Every placement of an item on a document with ten equal words in eleven is tried, without seeds."""
    found = {}
    for item_id, item in items:
        item, where = words(item), defaultdict(list)
        if len(item) < 10:
            continue
        for n, w in enumerate(item):
            where[w].append(n)
        for doc_id, text in docs:
            doc = words(text)
            for at in {p - n for p, w in enumerate(doc) for n in where.get(w, ())}:
                same = [0 <= at + n < len(doc) and doc[at + n] == w for n, w in enumerate(item)]
                size = min(window, len(same))
                best = max(sum(same[s : s + size]) / size for s in range(len(same) - size + 1))
                if best >= similarity:
                    old = found.get((doc_id, item_id), (0, 0, 0))
                    found[doc_id, item_id] = max(old, (best, sum(same), -at))
    return {k: (b, n, -at) for k, (b, n, at) in found.items()}


def as_dict(rows):
    return {(r.doc_id, r.item_id): (r.overlap, r.n_equal, r.doc_start) for r in rows}


def test_whole_table_against_brute_force(spark, small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    got, want = as_dict(registry.op6_benchmark_leaks(spark, small).collect()), plain(docs, items)
    assert set(got) <= set(want) and all(got[k] == want[k] for k in got if got[k][0] > 0.93)
    # a mask needs ten words in a row with few differences; overlaps at the very limit may have none
    assert {k for k, v in want.items() if v[0] > 0.9} <= set(got)


def test_substitutions_and_ends(spark):
    swapped = ITEM.split()
    swapped[2] = swapped[12] = swapped[22] = "other"
    docs = [(1, f"before {ITEM.upper()}, after"), (2, " ".join(swapped)), (3, " ".join(ITEM.split()[8:])), (4, " ".join(ITEM.split()[::2])), (5, "")]
    got = as_dict(decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(9, ITEM)], "item_id long, text string")).collect())
    assert got == {(1, 9): (1.0, 30, 1), (2, 9): (12 / 13, 27, 0), (3, 9): (1.0, 22, -8)}


def test_odd_rows(spark):
    schema = "doc_id long, text string, item_id long, seed string, item string"
    rows = [(None, ITEM, 1, "", ""), (None, ITEM, 1, "", ""), (2, None, None, None, None), (3, "z " * 60_000 + ITEM, 5, "", "")]
    items = [(None, ITEM, "x"), (4, None, "x"), (5, "too short", "x"), (6, ITEM, None), (6, ITEM, None)]
    bench = spark.createDataFrame(items, "item_id long, text string, doc_id string")
    docs = spark.createDataFrame(rows, schema)
    got = decontaminate.leaks(docs, bench)
    assert as_dict(got.collect()) == {(d, i): (1.0, 30, s) for d, s in ((None, 0), (3, 60_000)) for i in (None, 6)} and got.count() == 4
    assert decontaminate.leaks(docs.limit(0), bench).count() == decontaminate.leaks(docs, bench.limit(0)).count() == 0


def test_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "MOST_SEEDS", 3)
    monkeypatch.setattr(decontaminate, "MOST_CANDIDATES", 0)
    docs = spark.createDataFrame([(1, ITEM)], "doc_id long, text string")
    assert decontaminate.leaks(docs, docs.toDF("item_id", "text")).count() == 1
