import hashlib
import random

import numpy as np
import pytest

from martlight.llm import pieces, registry
from martlight.llm.common import table


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=registry.piece_model_path())


@pytest.fixture(scope="module")
def own():
    with open(registry.piece_model_path(), "rb") as file:
        return pieces.Pieces(file.read())


def ids_of(own, text):
    return np.frombuffer(own.encode(text), dtype="<i4").tolist()


def strings():
    dice = random.Random(7)
    signs = " ▁\n\t.,<>/s0xA1aeiouthéßñ中文日😀́ａ\u0000﻿​'\"-_=()#*"
    for _ in range(6000):
        yield "".join(dice.choice(signs) for _ in range(dice.randint(0, 25)))
        yield "".join(chr(dice.choice([dice.randint(1, 127), dice.randint(1, 2047), dice.randint(0xE000, 0x1FFFF)])) for _ in range(dice.randint(0, 12)))


def test_ids_and_texts_equal_the_library(own, library):
    dice, words = random.Random(1), list(own.ids)
    rows = list(strings()) + ["".join(dice.choice(words) for _ in range(dice.randint(0, 6))) for _ in range(6000)]
    rows += ["", " ", "   ", "\n", "<s> </s> <unk> <0x0A>", "aa" * 5000, " " * 333, "▁▁a", "x" * 70_000, "中" * 999]
    for text, want in zip(rows, library.encode(rows, add_eos=True, num_threads=1), strict=True):
        got = ids_of(own, text)
        assert got == want, text
        assert own.decode(got) == library.decode(want), text


def test_any_ids_decode_like_the_library(own, library):
    dice = random.Random(3)
    for _ in range(8000):
        ids = [dice.choice([dice.randint(0, 300), dice.randint(0, 31999)]) for _ in range(dice.randint(0, 8))]
        assert own.decode(ids) == library.decode(ids), ids


def test_last_tokens_are_those_of_the_prefixes(own, library):
    text = "▁unbelievably▁neatest"
    last = own.last_tokens(text)
    for n in range(2, len(text) + 1):
        assert last[n] == library.encode(text[1:n].replace("▁", " "))[-1]


def test_bounded_memories(own, monkeypatch, library):
    monkeypatch.setattr(pieces, "MEMO", 3)
    monkeypatch.setattr(pieces, "PAIRS", 3)
    for text in ("one two three four five six", "one two three four five seven"):
        assert ids_of(own, text) == library.encode(text, add_eos=True)


def test_query_on_whole_table(spark, small, library):
    rows = table(spark, small, "documents").select("doc_id", "text").collect()
    want = {}
    for r in rows:
        ids = library.encode(r.text or "", add_eos=True)
        text = library.decode(ids)
        want[r.doc_id] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    got = registry.op11_pieces(spark, small)
    assert got.dtypes == [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    assert {r.doc_id: tuple(r)[1:] for r in got.collect()} == want and len(rows) == len(want)


def test_odd_rows(spark, library):
    rows = [(None, None), (None, "a"), (1, ""), (1, ""), (2, "word " * 60_000), (3, None)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, ids string, _body int")
    model = registry.piece_model_path()
    found = pieces.decode(pieces.encode(docs, model), model)
    got = sorted(((r.doc_id, r.ids, r.text) for r in found.collect()), key=str)
    want = sorted(((d, library.encode(t or "", add_eos=True), t or "") for d, t in rows), key=str)
    assert got == want
    assert pieces.decode(pieces.encode(docs.limit(0), model), model).count() == 0
    empty = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert pieces.decode(empty, model).first().text is None


def test_other_models_are_refused(tmp_path):
    with pytest.raises(Exception):  # noqa: B017
        pieces.Pieces(b"no model")
