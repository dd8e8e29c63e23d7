"""Removal of repeated byte strings by a difference-cover sample of suffixes.

Only the first 200 bytes of suffixes matter, so the recursion of the difference-cover algorithm ends after one level:

* The suffixes at sampled places (place modulo 133 in a difference cover) are named by their first 68 bytes, and
  names are sorted and compared with their neighbours. Two places with equal strings of 200 bytes have, at the
  same distance of at most 132, a sampled place each, and these have equal names.
* If all places of a name agree in all bytes that such strings can take in (132 before and 200 from the place), the
  name settles the strings around it: they repeat if the name does.
* The suffixes from which another repeated name is within reach, and only those, are named by their first 200 bytes.
  Sorting these names, the merge of sampled and other suffixes, puts equal prefixes side by side.

Names are hashes of rolling polynomials. Instead of single names, tasks exchange sorted arrays of them, and get back
bits for each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlight.llm.common import importable, text_of

#: Length of the strings, period of the cover, and its residues: every difference modulo the period occurs.
LENGTH, PERIOD = 200, 133
COVER = (1, 10, 11, 13, 27, 31, 68, 75, 83, 110, 115, 121)
#: What two sampled suffixes at the same distance share at least.
SHARED = LENGTH - PERIOD + 1
#: Bytes hashed at once; bytes of text for each chunk of documents and for each bucket of names.
PIECE, PER_CHUNK, PER_BUCKET = 1 << 21, 2 << 20, 16 << 20
#: Bytes of a name that are sent: the first level is a filter, the second decides. With the first goes its context.
WIDTHS = (5, 8)
#: The context of a place where the task that sends it has seen several.
SEVERAL = 0

_SAMPLED = np.zeros(PERIOD, dtype=bool)
_SAMPLED[list(COVER)] = True
_BYTES = np.random.default_rng(11).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 6364136223846793005
_powers: list[np.ndarray] = []


def _tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if not _powers or len(_powers[0]) < n:
        _powers[:] = [np.cumprod(np.full(n, x, dtype=np.uint64)) for x in (_BASE, pow(_BASE, -1, 1 << 64))]
    return _powers


class Slab:
    """Pieces of documents, joined, with the hashes of the strings in them.

    A long document is cut; a piece then also has the bytes around its own places that strings and contexts take in.
    """

    def __init__(self, pieces: list[tuple[int, int, bytes, int, int, int]]) -> None:
        self.pieces = pieces  # document, offset, bytes, first and last own place, size of the document
        sizes = np.array([len(p[2]) for p in pieces])
        self.starts = np.cumsum(sizes) - sizes
        data = np.frombuffer(b"".join([p[2] for p in pieces]), dtype=np.uint8)
        inside = np.arange(len(data)) - np.repeat(self.starts, sizes)

        def of(n: int) -> np.ndarray:
            return np.repeat([p[n] for p in pieces], sizes)

        self.place = inside + of(1)
        self.left = np.repeat(sizes, sizes) - inside
        self.rest = of(5) - self.place
        self.own = (self.place >= of(3)) & (self.place < of(4))
        power, self._inverse = _tables(len(data))
        with np.errstate(over="ignore"):
            self._sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(_BYTES[data] * power[: len(data)])])

    def names(self, at: np.ndarray, length: int | np.ndarray) -> np.ndarray:
        h = (self._sums[at + length] - self._sums[at]) * self._inverse[at]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0x9E3779B97F4A7C15)
        return h ^ (h >> np.uint64(29))

    def contexts(self, at: np.ndarray) -> np.ndarray:
        """Hashes of all that strings with the place within reach take in, up to the ends of the document."""
        before, after = np.minimum(self.place[at], PERIOD - 1), np.minimum(self.rest[at], LENGTH)
        h = self.names(at - before, before + after) + (before * 1009 + after).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        return np.maximum((h >> np.uint64(32)).astype(np.uint32), np.uint32(SEVERAL + 1))

    def sampled(self) -> np.ndarray:
        return np.flatnonzero(_SAMPLED[self.place % PERIOD] & (self.left >= SHARED))

    def within_reach(self, sampled: np.ndarray) -> np.ndarray:
        """Whether each place is an own one, of a whole string that has one of the places ``sampled`` within reach."""
        marks = np.zeros(len(self.left) + PERIOD + 1, dtype=np.int32)
        marks[sampled + 1] = 1
        seen = np.cumsum(marks)
        return self.own & (self.rest >= LENGTH) & (seen[PERIOD : PERIOD + len(self.left)] > seen[: len(self.left)])


def slabs(texts: list[bytes]) -> Iterator[Slab]:
    held, size = [], 0
    for n, text in enumerate(texts):
        for own in range(0, len(text), PIECE):
            end = min(own + PIECE, len(text))
            offset = max(0, own - PERIOD + 1)
            part = text[offset : end + PERIOD + LENGTH]
            held.append((n, offset, part, own, end, len(text)))
            size += len(part)
            if size >= PIECE:
                yield Slab(held)
                held, size = [], 0
    if held:
        yield Slab(held)


class Names:
    """The distinct names of a chunk, in the order in which they are sent to buckets."""

    def __init__(self, names: np.ndarray, buckets: int, contexts: np.ndarray | None = None) -> None:
        self.names, first, counts = np.unique(names, return_index=True, return_counts=True)
        self.repeated = counts > 1
        self.contexts = None
        if contexts is not None:
            self.contexts = contexts[first]
            mixed = np.flatnonzero(contexts != self.contexts[np.searchsorted(self.names, names)])
            self.contexts[np.searchsorted(self.names, names[mixed])] = SEVERAL
            self.settled = self.contexts != SEVERAL
        self.buckets = buckets
        bucket = self.names % np.uint64(buckets)
        self.order = np.argsort(bucket, kind="stable")
        self.bounds = np.searchsorted(bucket[self.order], np.arange(buckets + 1, dtype=np.uint64))

    def sent(self) -> Iterator[tuple[int, bytes, bytes | None]]:
        width = WIDTHS[self.contexts is None]
        rest = (self.names // np.uint64(self.buckets) if self.contexts is not None else self.names)[self.order]
        for b in np.flatnonzero(np.diff(self.bounds)).tolist():
            part = slice(self.bounds[b], self.bounds[b + 1])
            context = self.contexts[self.order[part]].astype("<u4").tobytes() if self.contexts is not None else None
            yield b, rest[part].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes(), context

    def told(self, answers: list[tuple[int, bytes, bytes | None]]) -> None:
        for b, repeated, settled in answers:
            inside = self.order[self.bounds[b] : self.bounds[b + 1]]
            self.repeated[inside] |= np.unpackbits(np.frombuffer(repeated, dtype=np.uint8), count=len(inside)).astype(bool)
            if settled is not None:
                self.settled[inside] &= np.unpackbits(np.frombuffer(settled, dtype=np.uint8), count=len(inside)).astype(bool)

    def number(self, names: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.names, names)


def _joined(parts: list[np.ndarray], kind: type) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, dtype=kind)


def first_names(texts: list[bytes], buckets: int) -> Names:
    names, contexts = [], []
    for slab in slabs(texts):
        at = slab.sampled()
        at = at[slab.own[at]]
        names.append(slab.names(at, SHARED))
        contexts.append(slab.contexts(at))
    return Names(_joined(names, np.uint64), buckets, _joined(contexts, np.uint32))


def _reach(slab: Slab, first: Names) -> tuple[np.ndarray, np.ndarray]:
    """Places of strings that a settled name says repeat; places of those that another repeated name leaves open."""
    at = slab.sampled()
    number = first.number(slab.names(at, SHARED))
    repeated, settled = first.repeated[number], first.settled[number]
    return np.flatnonzero(slab.within_reach(at[repeated & settled])), np.flatnonzero(slab.within_reach(at[repeated & ~settled]))


def second_names(texts: list[bytes], first: Names) -> Names:
    parts = []
    for slab in slabs(texts):
        _, at = _reach(slab, first)
        parts.append(slab.names(at, LENGTH))
    return Names(_joined(parts, np.uint64), first.buckets)


def covered(texts: list[bytes], first: Names, second: Names) -> list[np.ndarray]:
    """For each text, which of its bytes are covered by a repeated string."""
    masks = [np.zeros(len(t), dtype=bool) for t in texts]
    for slab in slabs(texts):
        sure, at = _reach(slab, first)
        starts = np.zeros(len(slab.left) + LENGTH + 1, dtype=np.int32)
        starts[sure] = 1
        if len(at):
            starts[at[second.repeated[second.number(slab.names(at, LENGTH))]]] = 1
        steps = starts.copy()
        steps[LENGTH:] -= starts[:-LENGTH]
        inside = np.cumsum(steps) > 0
        for (n, offset, part, *_), start in zip(slab.pieces, slab.starts.tolist(), strict=True):
            masks[n][offset : offset + len(part)] |= inside[start : start + len(part)]
    return masks


def _decode(blob: bytes, width: int) -> np.ndarray:
    raw = np.frombuffer(blob, dtype=np.uint8).reshape(-1, width)
    whole = np.zeros((len(raw), 8), dtype=np.uint8)
    whole[:, :width] = raw
    return whole.reshape(-1).view("<u8")


def _answers(sent: DataFrame, level: int) -> DataFrame:
    """(chunk, bucket, level, repeated, settled): bits for each array of names.

    They say which names another chunk has too, and at the first level which have one context everywhere.
    """
    width = WIDTHS[level]

    def compare(rows: pa.Table) -> pa.Table:
        parts = [_decode(b, width) for b in rows.column("names").to_pylist()]
        names = np.concatenate(parts)
        order = np.argsort(names, kind="stable")
        same = names[order][1:] == names[order][:-1]
        repeated = np.zeros(len(names), dtype=bool)
        repeated[order[1:][same]] = True
        repeated[order[:-1][same]] = True
        ends = np.cumsum([len(p) for p in parts])

        def bits(flags: np.ndarray) -> pa.Array:
            return pa.array([np.packbits(flags[e - len(p) : e]).tobytes() for p, e in zip(parts, ends.tolist(), strict=True)], pa.binary())

        settled = pa.nulls(len(parts), pa.binary())
        if level == 0:
            contexts = np.frombuffer(b"".join(rows.column("contexts").to_pylist()), dtype="<u4")[order]
            group = np.concatenate([[0], np.cumsum(~same)])
            mixed = np.zeros(group[-1] + 1, dtype=bool)
            mixed[group[contexts == SEVERAL]] = True
            mixed[group[1:][same & (contexts[1:] != contexts[:-1])]] = True
            flags = np.empty(len(names), dtype=bool)
            flags[order] = ~mixed[group]
            settled = bits(flags)
        levels = pa.array(np.full(len(parts), level, dtype=np.int32))
        return pa.table({"chunk": rows.column("chunk"), "bucket": rows.column("bucket"), "level": levels, "repeated": bits(repeated), "settled": settled})

    return sent.groupBy("bucket").applyInArrow(compare, "chunk long, bucket int, level int, repeated binary, settled binary")


def _told(answers: pa.Table, level: int) -> list[tuple[int, bytes, bytes | None]]:
    columns = (answers.column(c).to_pylist() for c in ("level", "bucket", "repeated", "settled"))
    return [(b, repeated, settled) for x, b, repeated, settled in zip(*columns, strict=True) if x == level]


def _rows(chunk: int, names: Names) -> pa.Table:
    sent = list(names.sent())
    return pa.table({
        "chunk": pa.array([chunk] * len(sent), pa.int64()), "bucket": pa.array([b for b, _, _ in sent], pa.int32()),
        "names": pa.array([x for _, x, _ in sent], pa.binary()), "contexts": pa.array([x for _, _, x in sent], pa.binary()),
    })


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row of ``docs``.

    A byte is removed if it is in a string of 200 bytes that also starts elsewhere, in any row; strings are judged on
    the input. Null texts count as empty; texts of less than 200 bytes are kept. Repeated rows are repetitions of each
    other. An empty table gives no rows; other columns are ignored.

    Documents go to chunks of about 2 MB by a hash of id and text, so that a pass over them can be repeated. The texts
    are shuffled once, by chunk: all three passes read the same exchange. Names go to buckets by their hash, at most one
    array for each chunk and bucket, so a string that a third of the rows have adds one name for each chunk. Two
    different strings of 200 bytes are taken for equal with a chance of 2^-64 for each pair, two different contexts of
    equal names with one of 2^-32.
    """
    spark: SparkSession = docs.sparkSession
    importable(spark)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks, buckets = (max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // size)) for size in (PER_CHUNK, PER_BUCKET))
    key = F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).alias("chunk")
    rows = docs.select("doc_id", F.encode(text_of(), "UTF-8").alias("body"), key)
    schema = "chunk long, bucket int, names binary, contexts binary"

    def first(group: pa.Table) -> pa.Table:
        return _rows(group.column("chunk")[0].as_py(), first_names(group.column("body").to_pylist(), buckets))

    def second(group: pa.Table, answers: pa.Table) -> pa.Table:
        texts = group.column("body").to_pylist()
        names = first_names(texts, buckets)
        names.told(_told(answers, 0))
        return _rows(group.column("chunk")[0].as_py() if texts else 0, second_names(texts, names))

    def result(group: pa.Table, answers: pa.Table) -> pa.Table:
        texts = group.column("body").to_pylist()
        names = first_names(texts, buckets)
        names.told(_told(answers, 0))
        more = second_names(texts, names)
        more.told(_told(answers, 1))
        masks = covered(texts, names, more)
        spans = [int(m[:1].sum() + (m[1:] & ~m[:-1]).sum()) for m in masks]
        kept = [hashlib.sha256(np.frombuffer(t, dtype=np.uint8)[~m].tobytes()).hexdigest() for t, m in zip(texts, masks, strict=True)]
        return pa.table({
            "doc_id": group.column("doc_id"), "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
            "n_removed": pa.array([int(m.sum()) for m in masks], pa.int64()), "n_spans": pa.array(spans, pa.int64()),
            "kept_sha256": pa.array(kept, pa.string()),
        })

    texts = rows.groupBy("chunk")
    answered = _answers(texts.applyInArrow(first, schema), 0)
    sent = texts.cogroup(answered.groupBy("chunk")).applyInArrow(second, schema)
    answers = answered.union(_answers(sent, 1))
    kind = dict(rows.dtypes)["doc_id"]
    return texts.cogroup(answers.groupBy("chunk")).applyInArrow(
        result, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
