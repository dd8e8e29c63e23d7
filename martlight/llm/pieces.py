"""SentencePiece (BPE) encoding by a table of last tokens, and decoding.

The encoding of a text is the row of tokens in which each neighbouring pair stays apart when the pair alone is encoded.
So every prefix of a text has one last token: the token that ends the prefix and goes with the last token of the prefix
before it. An automaton of all pieces gives the tokens that end at a place, pairs are tested by replaying their merges,
and the ids are read from the table backwards. The table takes time in proportion to the text, whatever its words.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlight.llm.common import small_batches, text_of

SPACE = "▁"
#: Units and pairs that a worker remembers; longer units are encoded anew each time.
MEMO, PAIRS, LONGEST = 600_000, 400_000, 64
NEVER = 1 << 60


class Pieces:
    """Encoder and decoder for the bytes of one model file."""

    def __init__(self, model: bytes) -> None:
        import ahocorasick
        import sentencepiece

        known = sentencepiece.SentencePieceProcessor(model_proto=model)
        probe = " a  bééａ\n"
        if known.normalize(probe) != SPACE + probe.replace(" ", SPACE):
            raise ValueError("only models that keep the text, with a space put before it, are supported")
        self.end_id = known.eos_id()
        n = known.get_piece_size()
        self.piece = [known.id_to_piece(i) for i in range(n)]
        kinds = {i: (known.is_control(i), known.is_unknown(i), known.is_byte(i), known.is_unused(i)) for i in range(n)}
        if any(unused for *_, unused in kinds.values()):
            raise ValueError("models with unused pieces are not supported")
        normal = [i for i, kind in kinds.items() if not any(kind)]
        places = {s: r for r, s in enumerate(sorted({known.get_score(i) for i in normal}, reverse=True))}
        self.ids = {self.piece[i]: i for i in normal}
        self.rank = {self.piece[i]: places[known.get_score(i)] for i in normal}
        self.bytes_of = [0] * 256
        for i, (_, _, byte, _) in kinds.items():
            if byte:
                self.bytes_of[int(self.piece[i][1:-1], 16)] = i
        if not all(self.bytes_of):
            raise ValueError("the model must have a piece for every byte")
        if any(c not in self.ids for p in self.ids for c in p):
            raise ValueError("every character of a piece must be a piece")
        self.automaton = ahocorasick.Automaton()
        for p, i in self.ids.items():
            self.automaton.add_word(p, (len(p), i))
        self.automaton.make_automaton()
        self.unit = re.compile(_units({pair for p in self.ids for pair in zip(p, p[1:], strict=False)}))
        self.replays: dict[int, tuple | None] = {}
        self.pairs: dict[int, bool] = {}
        self.memo: dict[str, bytes] = {}
        surface = [b"" if c else b" \xe2\x81\x87 " if u else bytes([int(p[1:-1], 16)]) if b else p.replace(SPACE, " ").encode()
                   for p, (c, u, b, _) in zip(self.piece, kinds.values(), strict=True)]
        self.surface, self.is_byte = surface, [kinds[i][2] for i in range(n)]
        self.silent = {i for i in range(n) if kinds[i][0]}

    def replay(self, token: int) -> tuple | None:
        """The merges that make a token from its characters: (rank, left edge after it, right edge after it).

        The first entry has the edges before any merge. None for a token that its own text is not encoded as.
        """
        if token in self.replays:
            return self.replays[token]
        row = list(self.piece[token])
        steps = [(-1, self.ids[row[0]], self.ids[row[-1]])]
        while len(row) > 1:
            rank, at = min((self.rank.get(a + b, NEVER), n) for n, (a, b) in enumerate(zip(row, row[1:], strict=False)))
            if rank == NEVER:
                break
            row[at : at + 2] = [row[at] + row[at + 1]]
            steps.append((rank, self.ids[row[0]], self.ids[row[-1]]))
        self.replays[token] = found = tuple(steps) if len(row) == 1 else None
        return found

    def apart(self, a: int, b: int) -> bool:
        """Whether the text of tokens ``a`` and ``b`` is encoded as these two.

        Both replays run side by side, the better rank first and the left one of equals. A merge over the border
        comes before merges of a lower rank, after equal ones to its left and before equal ones to its right.
        """
        left, right = self.replay(a), self.replay(b)
        if left is None or right is None:
            return False
        i, j, piece, rank = 1, 1, self.piece, self.rank
        while True:
            over = rank.get(piece[left[i - 1][2]] + piece[right[j - 1][1]], NEVER)
            next_left = left[i][0] if i < len(left) else NEVER
            next_right = right[j][0] if j < len(right) else NEVER
            if over < next_left and over <= next_right and over != NEVER:
                return False
            if next_left == next_right == NEVER:
                return True
            if next_left <= next_right:
                i += 1
            else:
                j += 1

    def last_tokens(self, text: str) -> list[int]:
        """The last token of every prefix of ``text``, by its length; 0 where the last character is in no piece."""
        last, pairs = [0] * (len(text) + 1), self.pairs
        for end, (length, token) in self.automaton.iter(text):
            end += 1
            if last[end]:
                continue
            before = last[end - length]
            if not before:  # the start, or a character that nothing merges with
                if self.replay(token) is not None:
                    last[end] = token
                continue
            pair = before << 32 | token
            fits = pairs.get(pair)
            if fits is None:
                fits = pairs[pair] = self.apart(before, token)
            if fits:
                last[end] = token
        return last

    def encode_unit(self, text: str) -> bytes:
        """The ids of a text without end id, as little-endian 32-bit integers."""
        last, at, out = self.last_tokens(text), len(text), []
        while at:
            token = last[at]
            if token:
                out.append(token)
                at -= len(self.piece[token])
            else:
                at -= 1
                out.extend(self.bytes_of[b] for b in reversed(text[at].encode()))
        if len(self.pairs) > PAIRS:
            self.pairs.clear()
        return np.array(out[::-1], dtype="<i4").tobytes()

    def encode(self, text: str) -> bytes:
        """The ids of a text with the end id, as little-endian 32-bit integers."""
        units, memo = self.unit.findall(SPACE + text.replace(" ", SPACE)) if text else [], self.memo
        if len(memo) > MEMO:
            memo.clear()
        parts = []
        for u in units:
            ids = memo.get(u)
            if ids is None:
                ids = self.encode_unit(u)
                if len(u) <= LONGEST:
                    memo[u] = ids
            parts.append(ids)
        parts.append(self.end_id.to_bytes(4, "little"))
        return b"".join(parts)

    def decode(self, ids: list[int]) -> str:
        """The text of a row of ids, as the library decodes it: bytes that are no UTF-8 become U+FFFD one by one."""
        if ids and ids[-1] in self.silent:
            ids = ids[:-1]
        first = next((n for n, i in enumerate(ids) if i not in self.silent), len(ids))
        cut = first < len(ids) and self.piece[ids[first]].startswith(SPACE)
        if self.silent.isdisjoint(ids):  # elsewhere such ids end a run of bytes
            try:
                return b"".join(map(self.surface.__getitem__, ids))[cut:].decode()
            except UnicodeDecodeError:
                pass
        out, run = [], b""
        for i in ids:
            if self.is_byte[i]:
                run += self.surface[i]
                continue
            out.append(_mended(run) + self.surface[i].decode())
            run = b""
        return ("".join(out) + _mended(run))[cut:]


def _units(pairs: set[tuple[str, str]]) -> str:
    """A pattern that cuts texts where no piece goes on; ``pairs`` are the neighbouring characters in pieces.

    Cuts are before a space sign, around line breaks, and between letters or digits and those signs that no piece has
    beside one. Other signs are not cut off on either side.
    """
    if any(b == SPACE != a for a, b in pairs):
        return "(?s:.+)"
    words = {c for pair in pairs for c in pair if c.isalpha() or c.isdecimal()}
    signs = {c for pair in pairs for c in pair if c not in words and c != SPACE} | set(string.punctuation)
    joined = {c for a, b in pairs for c, d in ((a, b), (b, a)) if c in signs and d in words}
    breaks = "" if any("\n" in pair for pair in pairs) else "\n"
    free, bound = ("".join(map(re.escape, sorted(some - {"\n"}))) for some in (signs - joined, signs & joined))
    runs = f"(?:[^{SPACE}{breaks}{free}{bound}]+" + (f"|[{free}]+)" if free else ")")
    glued = f"(?:[{bound}]+{runs}?)" if bound else "(?!)"
    return f"{SPACE}*(?:{runs}{glued}*|{glued}+)|{SPACE}+" + (f"|{breaks}" if breaks else "")


def _mended(run: bytes) -> str:
    out, at = [], 0
    while at < len(run):
        for size in (1, 2, 3, 4):
            try:
                out.append(run[at : at + size].decode())
                break
            except UnicodeDecodeError:
                pass
        else:
            out.append("�")
            size = 1
        at += size
    return "".join(out)


_loaded: dict[bytes, Pieces] = {}


def _pieces(model: bytes) -> Pieces:
    """One encoder for each model and worker process."""
    if model not in _loaded:
        _loaded[model] = Pieces(model)
    return _loaded[model]


def _rows(column: pa.ListArray) -> list[list[int] | None]:
    """The lists of a column; much faster than its ``to_pylist``."""
    values, ends = column.flatten().to_numpy().tolist(), np.cumsum([0, *(n or 0 for n in column.value_lengths().to_pylist())]).tolist()
    known = column.is_valid().to_pylist()
    return [values[a:b] if k else None for a, b, k in zip(ends, ends[1:], known, strict=False)]


def _read(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids array<int>) of every row: the ids of the whole text and the end id, as the library gives them.

    ``model`` is the path of a model file on the driver; tasks get its bytes. Null and empty texts give the end id
    alone. Rows with null or repeated ids are encoded like others; an empty table gives no rows; other columns are
    ignored, whatever their names. Texts may have any length; nothing is shuffled.
    """
    small_batches(docs.sparkSession)
    content = _read(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(content)
        for batch in batches:
            found = [pieces.encode(t) for t in batch.column(1).to_pylist()]
            ends = np.cumsum([0, *[len(f) // 4 for f in found]]).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(found), dtype="<i4"), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), values)], ["doc_id", "ids"])

    source = docs.select("doc_id", text_of().alias("text"))
    return source.mapInArrow(run, f"doc_id {dict(source.dtypes)['doc_id']}, ids array<int>")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids, text) of every row of (doc_id, ids); the text is that of the ids. Null ids give a null text."""
    small_batches(encoded.sparkSession)
    content = _read(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(content)
        for batch in batches:
            texts = [None if row is None else pieces.decode(row) for row in _rows(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    source = encoded.select("doc_id", F.col("ids").cast("array<int>").alias("ids"))
    return source.mapInArrow(run, f"doc_id {dict(source.dtypes)['doc_id']}, ids array<int>, text string")


def digests(decoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of the rows of ``decode``."""
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("text"), 256).alias("decoded_sha256"),
    )
