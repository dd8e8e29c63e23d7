import numpy as np
import pytest
from test_decontaminate import plain as plain_leaks
from test_simhash import plain_components, plain_fingerprint
from test_tokens import crc
from test_tokens import plain as plain_ids

import corpus_pipeline
from martlight.llm import mixing, quality
from martlight.llm.common import table
from martlight.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, small):
    docs = [table(spark, small, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(materialize(stage(spark, docs[-1], small), "stage"))
    return docs


def test_each_stage_against_brute_force(spark, small, stages):
    start, good, single, clean, mixed, written = [d.collect() for d in stages]
    assert all(d.columns == COLUMNS for d in stages[:-1])
    model = quality.train(stages[0], table(spark, small, "labels"))
    counts = np.array([quality.term_counts((r.text or "").encode()) for r in start])
    assert {r.doc_id for r in good} == {r.doc_id for r, s in zip(start, model.scores(counts), strict=True) if s >= 0.3} != {r.doc_id for r in start}
    roots = plain_components({r.doc_id: plain_fingerprint(r.text) for r in good})
    assert sorted(r.doc_id for r in single) == sorted(set(roots.values())) and len(single) < len(good)
    items = [(r.item_id, r.text) for r in table(spark, small, "benchmark").collect()]
    leaks = {d for (d, _), (overlap, _, _) in plain_leaks([(r.doc_id, r.text) for r in single], items).items() if overlap > 0.9}
    assert leaks and sorted(r.doc_id for r in clean) == sorted(r.doc_id for r in single if r.doc_id not in leaks)
    assert sorted(map(tuple, mixed)) == sorted(map(tuple, clean))
    order = mixing.mix(stages[3], mixing.tempered(stages[3])).orderBy("mix_position").collect()
    ids, at, want = plain_ids([r.text for r in order]), 0, []
    for r, x in zip(order, ids, strict=True):
        want.append((r.doc_id, at, len(x), crc(x)))
        at += len(x)
    assert sorted(map(tuple, written), key=lambda r: r[1]) == want


def test_run(spark, small, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, small).collect())) == sorted(map(tuple, stages[-1].collect()))


def test_odd_rows(spark, small):
    rows = [(None, None, None, None, None), (None, "a b c", "en", "s", 5), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "word " * 50_000, "en", None, 250_000)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, score string")
    for name, stage in corpus_pipeline.STAGES:
        full = materialize(docs, "odd")
        assert stage(spark, full, small).count() <= 5, name
        assert stage(spark, materialize(docs.limit(0), "odd"), small).count() == 0, name
