import zlib

import numpy as np
from pyspark.sql import functions as F

from martlight.llm import registry, tokens
from martlight.session import work_path

ODD = ["", "don't we'll  A'S", "x y\x1cz\x85w", "Ａｂｃ Ç é İ ΑΣ", "a" * 3000, "\U0001f600 !!?? 12345\t\r\n", " \n ", "end.) it's- caf\u0301! caf\u00e9!? \u2014! o\u0301k? \u01c5a \u02b0b x1. 1x.. a'! ...a \u0bcd\u0b95"]


def plain(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(registry.tokenizer_path())
    return [[*tokenizer.encode(t, add_special_tokens=False).ids, 1] for t in texts]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_pieces_give_the_ids_of_the_text():
    encoder = tokens.Encoder(registry.tokenizer_path())
    assert [[*x.tolist(), 1] for x in encoder.encode([t.encode() for t in ODD])] == plain(ODD)


def test_special_tokens_in_any_spelling():
    texts = ["<|ENDOFTEXT|> a", "<|endoftext|>a", "foo<|endoftext|>bar Z", "a <|EndOfText|>b", "x!<|startoftext|>. <|STARTOFTEXT|>, THE end", "<|endoftext|", "İ<|endoftext|> A."]
    encoder = tokens.Encoder(registry.tokenizer_path())
    assert encoder.by_piece and [[*x.tolist(), 1] for x in encoder.encode([t.encode() for t in texts])] == plain(texts)


def test_other_tokenizers_encode_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, tokenizer = tokens.Encoder(path), Tokenizer.from_file(path)
    assert not encoder.by_piece
    assert [x.tolist() for x in encoder.encode([t.encode() for t in ODD])] == [tokenizer.encode(t, add_special_tokens=False).ids for t in ODD]


def test_names_of_the_caller(spark):
    docs = spark.createDataFrame([(1, "a b", "x", "y", "z"), (1, "c", "x", "y", "z")], "doc_id long, text string, _body string, body string, Body_ string")
    path = work_path(spark, "tokens")
    tokens.write_tokens(docs, path, registry.tokenizer_path(), 1, [F.col("doc_id")])
    assert sorted(r.n_tokens for r in tokens.read_tokens(spark, path).collect()) == [2, 3]


def test_segment_round_trip_and_access():
    rand = np.random.default_rng(3)
    ids = np.concatenate([rand.integers(0, 300, 900), rand.integers(0, 2**32, 400), rand.integers(0, 70_000, 700), [0, 2**32 - 1]]).astype(np.uint32)
    segment = tokens.Segment(tokens.pack(ids, [None, 5], [900, 1102], 17))
    assert segment.ids().tolist() == ids.tolist()
    assert [segment.id_at(n) for n in range(len(ids))] == ids.tolist()
    assert (segment.doc_ids, segment.lengths.tolist(), segment.before) == ([None, 5], [900, 1102], 17)


def test_whole_table(spark, small):
    docs = sorted(spark.read.parquet(f"{small}/documents.parquet").collect(), key=lambda r: r.doc_id)
    start, want = 0, []
    for r, ids in zip(docs, plain([r.text or "" for r in docs]), strict=True):
        want.append((r.doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(map(tuple, registry.op1_token_files(spark, small).collect())) == want


def test_odd_rows(spark):
    rows = [(None, None, 1), (None, "z", 2), (3, "", 1), (3, "", 1), (2, "word " * 30_000, 4), *[(10 + n, t, 0) for n, t in enumerate(ODD)]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, payload int")
    for segment in (1, 40, 1 << 20):
        path = work_path(spark, "tokens")
        tokens.write_tokens(docs, path, registry.tokenizer_path(), 1, [F.col("doc_id").asc_nulls_first()], segment)
        got = sorted(tokens.read_tokens(spark, path).collect(), key=lambda r: r.start)
        hashes = {r.t: r.h for r in docs.select(F.coalesce("text", F.lit("")).alias("t"), F.xxhash64(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("h")).collect()}
        want = plain([t or "" for _, t, _ in sorted(rows, key=lambda r: (r[0] or 0, hashes[r[1] or ""]))])
        assert [(r.n_tokens, r.ids_crc32) for r in got] == [(len(x), crc(x)) for x in want]
        assert [r.start for r in got] == [sum(map(len, want[:n])) for n in range(len(want))]
    path = work_path(spark, "tokens")
    tokens.write_tokens(docs.limit(0), path, registry.tokenizer_path(), 1, [])
    assert tokens.read_tokens(spark, path).count() == 0
