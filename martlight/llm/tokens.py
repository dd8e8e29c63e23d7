"""Token ids in files of directly addressable codes (DAC).

A file is a Parquet file of segments; the payload of a segment is the format: a header, the directory of its
documents, and the ids as chunk levels. Level 0 holds the low byte of each id; a continuation bitmap marks the ids
that go on, whose next byte is in level 1, and so on. A rank directory over each bitmap finds the place in the next
level, so any id is read by a few array accesses, without decoding a block.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martlight.llm.common import free_name, small_batches, text_of

MAGIC = 0x31434144
RANK_BITS = 512
#: Ids of a segment, unless one document alone has more; chunks of text in the memo of a worker.
SEGMENT, MEMO = 1 << 20, 900_000
_BITS = np.array([bin(n).count("1") for n in range(256)], dtype=np.uint32)


def pack(ids: np.ndarray, doc_ids: list, lengths: list, before: int) -> bytes:
    """The payload of a segment. ``before``: ids of earlier segments of the same shard."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        low, rest = (rest & 255).astype(np.uint8), rest >> 8
        more = rest != 0
        bitmap = np.packbits(more, bitorder="little")
        bitmap = np.pad(bitmap, (0, -len(bitmap) % (RANK_BITS // 8)))
        blocks = _BITS[bitmap].reshape(-1, RANK_BITS // 8).sum(axis=1, dtype=np.uint32)
        levels.append((low, bitmap, np.concatenate([[0], np.cumsum(blocks)]).astype(np.uint32)))
        if not more.any():
            break
        rest = rest[more]
    known = np.array([d is not None for d in doc_ids], dtype=np.uint8)
    docs = np.array([0 if d is None else d for d in doc_ids], dtype="<i8")
    head = np.array([MAGIC, len(ids), len(doc_ids), len(levels), before], dtype="<u8")
    parts = [head, docs, known, np.array(lengths, dtype="<u8"), np.array([len(x[0]) for x in levels], dtype="<u8")]
    for low, bitmap, ranks in levels:
        parts += [low, bitmap, ranks.astype("<u4")]
    return b"".join(p.tobytes() for p in parts)


class Segment:
    """A view of a payload; nothing is decoded until it is asked for."""

    def __init__(self, payload: bytes) -> None:
        at = 0

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(payload, dtype=kind, count=n, offset=at)
            at += out.nbytes
            return out

        magic, self.n_ids, n_docs, n_levels, self.before = (int(x) for x in take("<u8", 5))
        if magic != MAGIC:
            raise ValueError("not a segment")
        docs, known = take("<i8", n_docs), take("u1", n_docs)
        self.doc_ids = [d if k else None for d, k in zip(docs.tolist(), known.tolist(), strict=True)]
        self.lengths = take("<u8", n_docs).astype(np.int64)
        sizes = take("<u8", n_levels).tolist()
        self.levels = []
        for n in sizes:
            blocks = -(-n // RANK_BITS)
            self.levels.append((take("u1", n), take("u1", blocks * RANK_BITS // 8), take("<u4", blocks + 1)))

    def id_at(self, place: int) -> int:
        """The id at a place, by one access and one rank for each level it uses."""
        if not 0 <= place < self.n_ids:
            raise IndexError(place)
        value, shift = 0, 0
        for low, bitmap, ranks in self.levels:
            value |= int(low[place]) << shift
            byte, bit = place >> 3, place & 7
            if not bitmap[byte] >> bit & 1:
                break
            block = place // RANK_BITS
            start = block * RANK_BITS // 8
            inside = int(_BITS[bitmap[start:byte]].sum()) + int(_BITS[int(bitmap[byte]) & ((1 << bit) - 1)])
            place, shift = int(ranks[block]) + inside, shift + 8
        return value

    def ids(self) -> np.ndarray:
        """All ids of the segment, as little-endian unsigned 32-bit integers."""
        out = np.zeros(self.n_ids, dtype="<u4")
        places = None
        for n, (low, bitmap, _) in enumerate(self.levels):
            chunk = low.astype(np.uint32) << np.uint32(8 * n)
            if places is None:
                out |= chunk
            else:
                out[places] |= chunk
            more = np.flatnonzero(np.unpackbits(bitmap, bitorder="little", count=len(low)))
            places = more if places is None else places[more]
        return out


class Encoder:
    """Encodes texts by the pieces between ASCII white space.

    The tokenizer splits at white space and drops it, so the ids of a text are those of its pieces, joined; ASCII
    letters are lower-cased, which it does too, but for pieces that hold the name of a special token in any spelling.
    It also splits where an ASCII letter is followed by other ASCII signs than an apostrophe, so such an ending is
    encoded apart. Pieces recur; each worker keeps a bounded memo of them. Tokenizers of which these rules are not
    known to hold, by their normalizer and splitter, encode whole texts.
    """

    # The normalizer and the splitting pattern that the rules are for.
    NORMALIZER = ("NFC", "Replace", "Lowercase")
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    ENDINGS = b".,!?;:*|$%&#()[]-"
    LETTERS = frozenset(b"abcdefghijklmnopqrstuvwxyz")

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer, self.memo = Tokenizer.from_file(path), {}
        vocabulary = self.tokenizer.get_vocab()
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.specials = [t.content.lower().encode() for t in added]
        self.by_piece = self._splits(json.loads(self.tokenizer.to_str())) and not any(t.normalized or t.single_word for t in added)
        self.last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.last[[n for word, n in vocabulary.items() if word.endswith("</w>")]] = True

    def _splits(self, settings: dict) -> bool:
        """Whether the tokenizer's settings are those the pieces are for."""
        normalizer = (settings["normalizer"] or {}).get("normalizers") or [{}]
        splitter = ((settings["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0]
        return (
            tuple(n.get("type") for n in normalizer) == self.NORMALIZER
            and (normalizer[1].get("pattern"), normalizer[1].get("content")) == ({"Regex": r"\s+"}, " ")
            and (splitter.get("type"), splitter.get("pattern"), splitter.get("invert")) == ("Split", {"Regex": self.PATTERN}, True)
            and settings["model"].get("end_of_word_suffix") == "</w>"
        )

    def _pieces(self, text: bytes) -> list[bytes]:
        lowered = text.lower()
        if not any(s in lowered for s in self.specials):
            return lowered.split()
        # Only one spelling is the special token, so these pieces keep theirs.
        return [p if any(s in p.lower() for s in self.specials) else p.lower() for p in text.split()]

    def _plain(self, pieces: list[bytes]) -> None:
        for at in range(0, len(pieces), 8192):
            some = pieces[at : at + 8192]
            for p, e in zip(some, self.tokenizer.encode_batch_fast([p.decode() for p in some], add_special_tokens=False), strict=True):
                self.memo[p] = np.array(e.ids, dtype="<u4").tobytes()

    def _words(self, words: list[bytes]) -> None:
        """Words of letters only, encoded in rows; each ends with an id that ends a word, which cuts the rows."""
        rows = [words[at : at + 512] for at in range(0, len(words), 512)]
        found = self.tokenizer.encode_batch_fast([b" ".join(row).decode() for row in rows], add_special_tokens=False)
        for row, e in zip(rows, found, strict=True):
            ids = np.array(e.ids, dtype="<u4")
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(row) or ends[-1] != len(ids):
                self._plain(row)
                continue
            raw, start = ids.tobytes(), 0
            for word, end in zip(row, (ends * 4).tolist(), strict=True):
                self.memo[word] = raw[start:end]
                start = end

    def _learn(self, new: list[bytes]) -> None:
        cut = {}
        for p in new:
            core = p.rstrip(self.ENDINGS)
            cut[p] = core if core and core[-1] in self.LETTERS else p
        parts = set(cut.values()) | {p[len(core) :] for p, core in cut.items() if len(core) < len(p)}
        parts = [p for p in parts if p not in self.memo]
        words = [p for p in parts if p.decode().isalpha()]
        self._words(words)
        self._plain([p for p in parts if p not in self.memo])
        for p, core in cut.items():
            if len(core) < len(p):
                self.memo[p] = self.memo[core] + self.memo[p[len(core) :]]

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        if not self.by_piece:
            found = self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
            return [np.array(e.ids, dtype="<u4") for e in found]
        pieces = [self._pieces(text) for text in texts]
        if len(self.memo) > MEMO:
            self.memo.clear()
        memo = self.memo
        self._learn([p for p in set().union(*pieces) if p not in memo])
        return [np.frombuffer(b"".join(map(memo.__getitem__, row)), dtype="<u4") for row in pieces]


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, order: list[Column], segment: int = SEGMENT) -> None:
    """Encodes every text of ``docs`` and writes the ids, in the given order, to a folder of shards at ``path``.

    Null texts count as empty and give the end id alone. Repeated rows are written again; null ids come first. Ties
    of ``order`` are broken by doc_id and a hash of the text. The rows are range-partitioned before they are encoded, one shard for
    each partition; a shard is written a segment at a time. An empty table writes an empty folder.
    """
    spark = docs.sparkSession
    small_batches(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*order, F.col("doc_id").asc_nulls_first()]
    body = free_name(docs, "body")
    rows = docs.select("*", F.encode(text_of(), "UTF-8").alias(body))
    # Rows that share an id are dealt by their texts too.
    rows = rows.repartitionByRange(n, *keys, F.xxhash64(body)).sortWithinPartitions(*keys, F.xxhash64(body), body)
    rows = rows.select(F.col("doc_id").cast("long"), body)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        encoder = _encoder(tokenizer)
        ids, names, lengths, held, before = [], [], [], 0, 0

        def flush() -> pa.RecordBatch:
            payload = pack(np.concatenate(ids), names, lengths, before)
            return pa.RecordBatch.from_pydict(
                {"shard": pa.array([shard], pa.int32()), "n_ids": pa.array([held], pa.int64()), "payload": pa.array([payload], pa.binary())}
            )

        for batch in batches:
            found = encoder.encode(batch.column(1).to_pylist())
            for name, row in zip(batch.column(0).to_pylist(), found, strict=True):
                ids.append(np.append(row, np.uint32(end_id)))
                names.append(name)
                lengths.append(len(row) + 1)
                held += len(row) + 1
                if held >= segment:
                    yield flush()
                    before, held = before + held, 0
                    ids, names, lengths = [], [], []
        if names:
            yield flush()

    rows.mapInArrow(run, "shard int, n_ids long, payload binary").write.option("compression", "zstd").parquet(path)


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """One encoder for each worker process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files at ``path``, read from their payloads."""
    spark.conf.set("spark.sql.parquet.enableVectorizedReader", "true")
    segments = spark.read.schema("shard int, n_ids long, payload binary").parquet(path)
    sums = segments.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    # One row for each shard; shards are as many as the partitions that wrote them.
    window = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(F.col("shard").alias("s"), F.coalesce(F.sum("n").over(window), F.lit(0)).alias("base"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, payload in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                segment = Segment(payload.as_buffer())
                raw = memoryview(segment.ids()).cast("B")
                ends = np.cumsum(segment.lengths)
                starts = ends - segment.lengths
                sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(segment.doc_ids, pa.int64()), "start": pa.array(starts + base + segment.before, pa.int64()),
                    "n_tokens": pa.array(segment.lengths, pa.int64()), "ids_crc32": pa.array(sums, pa.int64()),
                })

    placed = segments.join(F.broadcast(starts), F.col("shard") == F.col("s")).select("base", "payload")
    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
