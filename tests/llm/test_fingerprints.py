import hashlib
import re

import pytest
from pyspark.sql import functions as F

from martlight.llm import fingerprints, registry

SCHEMA = "doc_id long, text string, keys string, bucket string, copy int"


def paragraphs(text):
    parts = re.findall(r"[^\n]{1,200}(?=[ \t\n\x0b\f\r]|\Z)|[^\n]{1,200}", text)
    return {p.strip(" ") for p in parts} - {""}


def plain(rows):
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for n, (doc_id, text) in enumerate(rows):
        after, k = rows[(n + 1) % len(rows)][1], len(text) // 4
        edited = text[: len(text) - k] + after[:k]
        a, b, c = paragraphs(text), paragraphs(edited), paragraphs(after)
        near = [len(a & x) / len(a | x) if a | x else 1.0 for x in (b, c)]
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), *near))
    return out


def as_rows(frame):
    return sorted(
        ((r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in frame.collect()), key=lambda r: (r[0] is not None, r[0] or 0)
    )


def test_whole_table_against_brute_force(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    frame = registry.op3_fingerprints(spark, small)
    got = frame.collect()
    assert as_rows(frame) == plain(rows)
    texts = dict(rows)
    first = {}
    for r in got:
        assert first.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
    assert "Python" not in frame._jdf.queryExecution().toString()


def test_buckets_do_not_show(spark, monkeypatch):
    rows = [(n * n, f"text {n}\nline {n % 3}") for n in range(40)] + [(None, "a"), (None, "b"), (16, "twin"), (16, "text 4\nline 1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = sorted((d or -1, t, order[(n + 1) % len(order)][1]) for n, (d, t) in enumerate(order))
    for size in (1, 3, 1000):
        got = [(-1 if r.doc_id is None else r.doc_id, r.text, r.next_text) for r in fingerprints.with_next(docs, size).collect()]
        assert sorted((d or 0 if d != -1 else -1, t, x) for d, t, x in got) == sorted((-1 if d is None else d, t, order[(n + 1) % len(order)][1]) for n, (d, t) in enumerate(order))
    assert len(want) == len(rows)


@pytest.mark.parametrize("retries", [18, 7, 1, 0])
def test_differences_are_recovered(spark, retries):
    import random

    rand = random.Random(3)
    rows = []
    for n in (0, 1, 2, 9, 60, 400):
        for m in (0, 1, 30, 400):
            keys = [rand.randrange(-(2**63), 2**63) for _ in range(2 * n + m)]
            one, other = keys[: n + m // 2], keys[n // 2 :]
            rows.append((one, other, sorted(set(one) - set(other)), sorted(set(other) - set(one))))
    frame = spark.createDataFrame(rows, "one array<long>, other array<long>, gone array<long>, new array<long>")
    cells = [fingerprints.own_sketch(F.col(c)).alias(f"{c}_cells") for c in ("one", "other")]
    frame = frame.select("*", *cells)
    found = fingerprints.recovered(*[F.col(c) for c in ("one", "other", "one_cells", "other_cells")], retries)
    got = frame.select("gone", "new", found.alias("d")).collect()
    assert len(got) == 24 and all(sorted(r.d.gone) == r.gone and sorted(r.d.new) == r.new for r in got)


def test_odd_rows(spark):
    rows = [(None, None), (None, ""), (1, "é" * 1001 + "\n" + "b " * 400), (1, "same"), (1, "same"), (2, "word " * 40_000), (9, "\n \n"), (10, "x\ty\n\tz")]
    docs = spark.createDataFrame([(d, t, "x", None, 1) for d, t in rows], SCHEMA)
    key = [(x[0] is None, x[0] or 0, x[1:]) for x in plain(rows)]
    got = [(x[0] is None, x[0] or 0, x[1:]) for x in as_rows(fingerprints.edited_fingerprints(docs))]
    assert sorted(got, key=str) == sorted(key, key=str)
    one = fingerprints.edited_fingerprints(docs.where("doc_id = 2")).first()
    assert (one.near_next, one.n_chars) == (1.0, 200_000)
    assert fingerprints.edited_fingerprints(docs.limit(0)).count() == 0


def test_folded_sketches_are_smaller_sketches(spark):
    import random

    rand = random.Random(4)
    frame = spark.createDataFrame([([rand.randrange(-(2**63), 2**63) for _ in range(n)],) for n in (0, 1, 50, 300)], "keys array<long>")
    for blocks in (1, 4, 32):
        small = fingerprints.sketch(F.col("keys"), F.lit(blocks))
        folded = fingerprints.fold(fingerprints.sketch(F.col("keys"), F.lit(32)), F.lit(blocks).cast("long"))
        assert frame.where(small != folded).count() == 0
