import itertools
import re

import xxhash

from martlight.llm import registry, simhash

LONG = " ".join(f"w{n % 977}" for n in range(60_000))


def plain_fingerprint(text, k=3):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[n : n + k]) for n in range(max(1, len(words) - k + 1))] if words else []
    values = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(v >> bit & 1 for v in values) > len(values))


def plain_components(rows, threshold=3):
    root = {fp: fp for fp in rows.values()}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(root), 2):
        if (a ^ b).bit_count() <= threshold:
            root[find(b)] = find(a)
    least = {}
    for doc, fp in rows.items():
        least[find(fp)] = min(least.get(find(fp), doc), doc)
    return {doc: least[find(fp)] for doc, fp in rows.items()}


def test_whole_table_against_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    want = {r.doc_id: plain_fingerprint(r.text) for r in docs.collect()}
    got = registry.op9_simhash(spark, small).collect()
    assert {r.doc_id: int(r.fingerprint, 16) for r in got} == want
    assert {r.doc_id: r.component_id for r in got} == plain_components(want)


def test_links_within_threshold(spark):
    import random

    rand = random.Random(5)
    fps = [0]
    for _ in range(120):
        base = rand.getrandbits(64)
        fps.append(base)
        for bits in range(1, 6):
            fps.append(base ^ sum(1 << b for b in rand.sample(range(64), bits)))
    signed = [(n, fp - (1 << 64) if fp >> 63 else fp) for n, fp in enumerate(fps)]
    got = {(r.a, r.b) for r in simhash.links(spark.createDataFrame(signed, "doc_id long, fp long")).collect()}
    values = sorted({fp for _, fp in signed})
    want = {(a, b) for a, b in itertools.combinations(values, 2) if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    assert got == want


def test_odd_rows(spark):
    rows = [(1, None, 9), (2, "", 9), (3, "one two", 9), (3, "one two", 9), (None, "one two", 9), (4, LONG, 9), (None, "a b c d", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp long")
    got = sorted((r.doc_id or 0, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect())
    assert len(got) == 7
    assert [(d, c) for d, f, c in got if f == "0" * 16] == [(1, 1), (2, 1)]
    assert sorted(c for d, f, c in got if int(f, 16) == plain_fingerprint("one two")) == [3, 3, 3]
    assert [c for d, f, c in got if int(f, 16) == plain_fingerprint("a b c d")] == [None]
    assert [int(f, 16) for d, f, c in got if d == 4] == [plain_fingerprint(LONG)]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_places_of_few_fingerprints_are_not_broadcast(spark):
    fps = spark.createDataFrame([(n * 0x9E3779B97F4A7C15 % (1 << 63),) for n in range(50)] + [(1,), (3,)], "fp long")
    found = simhash.links(fps)
    assert (1, 3) in {tuple(r) for r in found.collect()}
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
