import hashlib
from collections import Counter

import numpy as np

from martlight.llm import registry, suffixes

SCHEMA = "doc_id long, text string, body string, chunk string"


def plain(rows):
    texts = [(text or "").encode() for _, text in rows]
    counts = Counter(t[n : n + 200] for t in texts for n in range(len(t) - 199))
    out = []
    for (doc_id, _), t in zip(rows, texts, strict=True):
        gone = np.zeros(len(t) + 1, dtype=bool)
        for n in range(len(t) - 199):
            if counts[t[n : n + 200]] > 1:
                gone[n : n + 200] = True
        kept = bytes(b for b, g in zip(t, gone, strict=False) if not g)
        spans = int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])).sum()) if len(t) else 0
        out.append((doc_id, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_cover():
    assert {(a - b) % suffixes.PERIOD for a in suffixes.COVER for b in suffixes.COVER} == set(range(suffixes.PERIOD))


def test_whole_table_against_brute_force(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert got(registry.op5_repeated_bytes(spark, small)) == plain(rows)


def test_edges_and_odd_rows(spark):
    rand = np.random.default_rng(2)

    def some(n):
        return "".join(map(chr, rand.integers(97, 123, n)))

    a, b, c = some(200), some(700), some(333)
    rows = [
        (1, some(50) + a + some(61)), (2, some(17) + a), (3, a[:199]), (4, b), (5, some(400) + b[250:451] + some(3)), (6, c + c), (7, "x" * 201),
        (8, "y" * 200), (9, None), (9, ""), (None, some(90) + "é" * 100), (None, some(33) + "é" * 100), (10, some(5000) + c[:205] + some(300)),
        (11, some(300)), (11, None), (12, "ab" * 40_000), *[(20 + n, some(n) + c[n : n + 260] + some(9)) for n in range(60)],
    ]
    rows += [rows[13]]
    docs = spark.createDataFrame([(d, t, "x", None) for d, t in rows], SCHEMA).repartition(3)
    assert got(suffixes.remove_repeats(docs)) == plain(rows)
    assert suffixes.remove_repeats(docs.limit(0)).count() == 0


def test_texts_are_shuffled_once(spark, small):
    frame = registry.op5_repeated_bytes(spark, small)
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("ReusedExchange") >= 2


def test_long_documents_in_pieces(monkeypatch):
    monkeypatch.setattr(suffixes, "PIECE", 700)
    rand = np.random.default_rng(4)
    texts = [rand.integers(97, 123, 5000).astype(np.uint8).tobytes() for _ in range(3)]
    texts[1] = texts[1][:900] + texts[0][1200:1650] + texts[1][1350:] + texts[0][650:850]
    first = suffixes.first_names(texts, 3)
    masks = suffixes.covered(texts, first, suffixes.second_names(texts, first))
    want = plain([(n, t.decode()) for n, t in enumerate(texts)])
    assert [(n, int(m.sum())) for n, m in enumerate(masks)] == [(n, gone) for n, _, gone, _, _ in want]
