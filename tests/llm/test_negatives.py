import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from martlight.llm import negatives, registry
from martlight.llm.common import table


def plain(rows):
    """(anchor, positive, rank, negative, scores) by Python integers; ``rows`` are (vec_id, embedding, label)."""
    known = set()
    for vec_id, embedding, label in rows:
        if label is None or embedding is None or any(x is None or not math.isfinite(x) for x in embedding):
            continue
        known.add((vec_id, (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label, tuple(math.floor(256 * x) for x in embedding)))
    out = []
    for anchor in known:
        if anchor[0] is None or anchor[0] % 50:
            continue
        others = [(sum(a * b for a, b in zip(anchor[2], r[2], strict=False)), r) for r in known if r != anchor]
        others.sort(key=lambda x: (-x[0], x[1][0] is None, x[1][0] or 0))
        for p, positive in [x for x in others if x[1][1] == anchor[1]][:5]:
            found = [x for x in others if x[1][1] != anchor[1] and 50 * p <= 100 * x[0] <= 95 * p][:3]
            out += [(anchor[0], positive[0], n, r[0], p, s) for n, (s, r) in enumerate(found, 1)]
    return sorted(out, key=str)


def query_of(spark, rows, **more):
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, label int, row int, vector string")
    return negatives.mine(negatives.relabelled(frame), F.col("vec_id") % 50 == 0, **more)


@pytest.mark.parametrize("size", [3, 300, 70_000, 2**31 - 1])
def test_scores_are_exact(size):
    dice = np.random.default_rng(size)
    for width in (1, 64, 700):
        if size * size * width >= 1 << 62:
            continue
        a, b = dice.integers(-size, size + 1, (9, width)), dice.integers(-size, size + 1, (11, width))
        a[0], b[0], b[1] = size, size, -size
        primes = negatives.primes_for(size * size * width)
        got = negatives.Residues(a, primes).scores(negatives.Residues(b, primes))
        assert got.tolist() == [[sum(int(x) * int(y) for x, y in zip(r, s, strict=True)) for s in b] for r in a]


def test_query_against_sql_and_brute_force(spark, small):
    got = registry.op13_hard_negatives(spark, small)
    assert got.dtypes == [("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"), ("positive_score", "bigint"), ("negative_score", "bigint")]
    found = sorted(map(tuple, got.collect()))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{small}/embeddings.parquet'")
    assert found == sorted(db.execute(negatives.mine_sql()).fetchall()) and found
    assert sorted(found, key=str) == plain([tuple(r) for r in table(spark, small, "embeddings").select("vec_id", "embedding", "label").collect()])


@pytest.mark.parametrize("blocks", [{}, {"block_rows": 64, "block_anchors": 3}])
def test_hot_label_ties_and_odd_rows(spark, blocks):
    """A third of the rows are one vector, most have one label; nulls, empty, short and endless vectors among them."""
    dice = random.Random(4)
    rows = []
    for n in range(600):
        vector = [0.5, 0.25, 0.0, -0.1] if n % 3 == 0 else [dice.choice([0.5, 0.3, 0.2, 0.1, -0.4]) for _ in range(4)]
        rows.append((n, vector, 3 if dice.random() < 0.6 else dice.randint(0, 9)))
    rows += rows[:40]
    rows += [(50, [0.5, 0.5, 0.5, 0.5], 2), (50, None, 2), (100, [0.1, None, 0.3, 0.2], 2), (150, [float("nan")] * 4, 2), (200, [float("inf")] * 4, 2), (250, [1.0] * 4, None)]
    rows += [(300, [], 5), (350, [0.5, 0.2], 3), (None, [0.4, 0.2, 0.1, 0.0], 3), (None, [0.3, 0.2, 0.1, 0.0], 4)]
    found = query_of(spark, rows, **blocks).collect()
    assert sorted(map(tuple, found), key=str) == plain(rows)


def test_strips(spark, monkeypatch):
    monkeypatch.setattr(negatives, "STRIP", 7)
    dice = random.Random(6)
    rows = [(n, [dice.uniform(-1, 1) for _ in range(5)], dice.randint(0, 2)) for n in range(300)]
    monkeypatch.setattr(negatives, "SLAB", 2)
    miner = negatives.Miner(5, negatives.primes_for(10**6), 5, 3, (50, 95))
    frame = negatives.relabelled(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    import pyarrow as pa

    known = pa.Table.from_pylist([r.asDict() for r in negatives.valid(frame).collect()])
    anchors = known.filter(pa.array([i % 50 == 0 for i in known["vec_id"].to_pylist()]))
    near = {}
    for r in sorted(miner.best_positives(known, anchors).to_pylist(), key=lambda r: (-r["positive_score"], r["positive_id"])):
        near.setdefault(r["anchor_id"], []).append({"id": r["positive_id"], "row": r["positive_row"], "score": r["positive_score"]})
    anchors = anchors.append_column("positives", pa.array([near[i][:5] for i in anchors["vec_id"].to_pylist()]))
    kept = {}
    for r in sorted(miner.best_negatives(known, anchors).to_pylist(), key=lambda r: (-r["negative_score"], r["negative_id"])):
        kept.setdefault((r["anchor_id"], r["positive_id"], r["positive_score"]), []).append((r["negative_id"], r["negative_score"]))
    got = [(a, p, n, i, ps, s) for (a, p, ps), best in kept.items() for n, (i, s) in enumerate(best[:3], 1)]
    assert sorted(got, key=str) == plain(rows)


def test_large_scores_and_empty_tables(spark):
    best = negatives.best_columns(np.array([[1 << 60, 1 << 60, -(1 << 60), 1 << 60]]), np.array([[False, True, False, False]]), 2)
    assert best[0].tolist() == [0, 3]
    assert query_of(spark, []).count() == 0
    assert query_of(spark, [(0, None, 1)]).count() == 0
    with pytest.raises(ValueError, match="long"):
        query_of(spark, [(0, [3e38], 1), (1, [3e38], 1)])
