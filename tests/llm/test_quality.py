import tracemalloc
import zlib

import numpy as np
import pytest

from martlight.llm import quality, registry
from martlight.llm.common import table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return quality.train(table(spark, SF, "documents"), table(spark, SF, "labels"))


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    rows = registry.op8_quality(spark, SF).collect()
    assert len(rows) == table(spark, SF, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    good = [r.score for r in rows if r.held_out and labels.get(r.doc_id) == 1]
    bad = [r.score for r in rows if r.held_out and labels.get(r.doc_id) == 0]
    assert np.mean([a > b for a in good for b in bad]) > 0.97
    assert np.mean([s >= 0.3 for s in good]) > 0.97 and np.mean([s < 0.3 for s in bad]) > 0.7


def test_votes_against_brute_force(spark, model):
    texts = [r.text for r in table(spark, SF, "documents").orderBy("doc_id").limit(60).collect()]
    counts = np.array([quality.term_counts(t.encode()) for t in texts])
    for row, got in zip(model.project(counts), model.scores(counts), strict=True):
        near = sorted(((round(float(np.dot(row, v)), 5), y) for v, y in zip(model.vectors, model.labels, strict=True)), reverse=True)
        votes = [(max(s, 0) ** 2, y) for s, y in near if s >= near[quality.NEIGHBOURS - 1][0]]
        assert abs(got - sum(w * y for w, y in votes) / sum(w for w, _ in votes)) < 1e-3


def test_held_out_labels_are_not_learned_from(spark, model):
    labels = table(spark, SF, "labels")
    turned = labels.selectExpr("doc_id", "IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0, 1 - quality, quality) AS quality")
    again = quality.train(table(spark, SF, "documents"), turned)
    assert np.array_equal(again.vectors, model.vectors) and np.array_equal(again.labels, model.labels)


def test_odd_rows(spark, model):
    rows = [(None, None, 0.5, "x"), (1, "", 0.5, "x"), (1, "ab", None, None), (2, "word " * 60_000, 0.5, "x"), (2, "word " * 60_000, 0.5, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double, quality string")
    got = quality.score(docs, model).collect()
    assert [r.doc_id for r in got] == [None, 1, 1, 2, 2] and got[0].score == got[1].score == pytest.approx(model.prior) and got[3].score == got[4].score
    labels = spark.createDataFrame([(1, None, 1), (None, 1, 1), (4, 1, 0), (4, 0, 0), (9, 1, 1)], "doc_id long, quality int, text int")
    untaught = quality.train(docs.limit(0), labels)
    assert {r.score for r in quality.score(docs, untaught).collect()} == {0.5}
    assert quality.score(docs.limit(0), model).count() == 0


def test_learning_takes_little_more_than_the_counts_and_their_weights():
    counts = np.random.default_rng(1).integers(0, 3, (1024, quality.TERMS)).astype(np.float32)
    labels = np.arange(1024, dtype=np.float32) % 2
    tracemalloc.start()
    model = quality.Model(counts, labels)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2.5 * counts.nbytes
    assert np.array_equal(model.vectors, model.project(counts))
