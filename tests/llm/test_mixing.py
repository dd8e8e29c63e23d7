import random
from collections import Counter

import pytest

from martlight.llm import mixing, registry

SCHEMA = "doc_id long, source string, mix_slot string, text string"


def weights_of(spark, weights):
    return spark.createDataFrame(list(weights.items()), "source string, weight double")


@pytest.mark.parametrize("parts", [[1], [7, 2, 1], [333, 333, 334], [998, 1, 1], [900, *[2] * 50], [3, 5, 7, 11, 1, 1, 1], [10**15 // 3, 10**14, 77]])
def test_every_block_in_its_window_and_less_than_a_block_from_the_weights(parts):
    total, done = sum(parts), Counter()
    stop = min(3 * total, 3000)
    for n, (k, j, release, deadline, slot) in enumerate(mixing.schedule(parts, 0, stop)):
        assert slot == n and j == done[k] and release <= slot < deadline
        done[k] += 1
        for i, e in enumerate(parts):
            assert abs(done[i] * total - e * (slot + 1)) < total


def test_cycles_are_the_one_schedule():
    """Each cycle starts anew from a state told by the weights; together they are the run from the first slot on."""
    dice = random.Random(8)
    for _ in range(60):
        parts = [dice.choice([1, 2, 3, 50, 1000, dice.randint(1, 200)]) for _ in range(dice.randint(1, 25))]
        size = dice.randint(1, 40)
        whole = list(mixing.schedule(parts, 0, 400))
        cut = [row for n in range(0, 400, size) for row in mixing.schedule(parts, n, min(400, n + size))]
        assert cut == whole, parts


def test_the_state_is_that_of_a_run_up_to_its_own_choice():
    parts = [17, 5, 3, 3, 1]
    for slot in range(200):
        done = mixing.state_at(parts, slot)
        assert sum(done) == slot and all(abs(d * 29 - e * slot) < 29 for d, e in zip(done, parts, strict=True))


@pytest.mark.parametrize("cycle", [mixing.CYCLE, 16])
def test_mix_follows_the_weights(spark, monkeypatch, cycle):
    monkeypatch.setattr(mixing, "CYCLE", cycle)
    docs = spark.range(6000).selectExpr("id AS doc_id", "CASE WHEN id % 10 < 6 THEN 'hot' WHEN id % 10 < 9 THEN 'b' END AS source")
    weights = {"hot": 2.0, "b": 1.7, None: 0.31}
    got = sorted(mixing.mix(docs, weights_of(spark, weights), block_rows=8).collect(), key=lambda r: r.mix_position)
    assert sorted(r.doc_id for r in got) == list(range(6000)) and len({r.mix_position for r in got}) == 6000
    assert all(r.mix_release <= r.mix_slot < r.mix_deadline for r in got)
    by_slot = {r.mix_slot: r for r in got}
    ended = min(max(r.mix_slot for r in got if r.source == s) for s in weights)  # the first source to run out
    head, total = Counter(), sum(weights.values())
    for slot in range(ended):
        r = by_slot[slot]
        assert r.mix_block == head[r.source]
        head[r.source] += 1
        for s, w in weights.items():
            assert abs(head[s] - w / total * (slot + 1)) < 1


def test_the_weights_of_many_sources_hold_over_many_cycles(spark, monkeypatch):
    """One source of weight 0.9 among fifty, and a hot third at square roots: no slot is lost, at any length."""
    for weights in ([0.9, *[0.1 / 49] * 49], [(1 / 3) ** 0.5, *[(2 / 3 / 19) ** 0.5] * 19]):
        total = sum(weights)
        parts = [max(1, round(w / total * mixing.UNIT)) for w in weights]
        done = Counter()
        for k, _, _, _, slot in mixing.schedule(parts, 0, 30_000):
            done[k] += 1
            if slot % 997 == 0 or slot == 29_999:
                assert all(abs(done[i] - w / total * (slot + 1)) < 1 for i, w in enumerate(weights))


@pytest.mark.parametrize("n", [1001, 20_000])
def test_any_number_of_sources(spark, n):
    docs = spark.range(2 * n).selectExpr("id AS doc_id", f"IF(id < {n}, CONCAT('s', id), 's0') AS source")
    got = mixing.mix(docs, mixing.tempered(docs), block_rows=4)
    assert got.count() == 2 * n and got.select("mix_position").distinct().count() == 2 * n
    assert got.where("mix_slot < mix_release OR mix_slot >= mix_deadline").count() == 0


def test_whole_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = registry.op4_source_mix(spark, small).collect()
    assert sorted((r.doc_id, r.source) for r in got) == sorted((r.doc_id, r.source) for r in docs.collect())
    assert len({r.mix_position for r in got}) == len(got)
    for source in {r.source for r in got}:
        blocks = Counter(r.mix_block for r in got if r.source == source)
        assert set(blocks) == set(range(len(blocks))) and all(n == 32 for b, n in blocks.items() if b + 1 < len(blocks))


def test_odd_rows(spark):
    rows = [(None, None, "x", None), (1, "s", "x", ""), (1, "s", "x", ""), (2, "s", None, "long " * 50_000)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mix(docs, weights_of(spark, {None: 1.0, "s": 3.0, "unused": 1.0}), block_rows=1)
    assert got.columns[:3] == ["doc_id", "source", "text"] and got.count() == 4
    for bad in ({"s": 1.0}, {"s": 1.0, None: 0.0}, {"s": 1.0, None: -1.0}):
        with pytest.raises(ValueError):
            mixing.mix(docs, weights_of(spark, bad))
    twice = spark.createDataFrame([("s", 1.0), ("s", 2.0), (None, 1.0)], "source string, weight double")
    with pytest.raises(ValueError):
        mixing.mix(docs, twice)
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(empty, weights_of(spark, {"s": 1.0})).count() == mixing.mix(empty, mixing.tempered(empty)).count() == 0


def test_names_of_the_caller(spark):
    """Columns may be named like anything the operator uses inside; their values come back."""
    names = ["doc_id", "source", "k", "b", "at", "rank", "row", "s", "place", "places", "_start", "_n", "_cycle", "_bucket", "_rank", "_top", "block"]
    docs = spark.createDataFrame([(n, f"s{n % 2}", *range(n, n + 15)) for n in range(9)], ", ".join(f"{c} {'string' if c == 'source' else 'long'}" for c in names))
    got = mixing.mix(docs, mixing.tempered(docs), block_rows=2)
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(map(tuple, docs.collect()))
