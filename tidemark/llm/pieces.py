"""SentencePiece (BPE) encoding and decoding by a table of distinct chunks.

White space becomes the marker U+2581 and one marker goes in front of the text.
A chunk is a run of markers with the characters after it, up to the next
marker. Where no piece of the model holds a marker behind another character,
no merge crosses the start of a chunk, so a text's ids are its chunks' ids laid
end to end. A task takes texts in blocks: the chunks of a block are listed by
position, each distinct chunk that is not in the table yet is segmented once,
and the ids are joined back to the positions. (If a model has such a piece, a
whole text is one chunk: the same result, without the gain.)

Segmenting a chunk: the pair of neighbours whose joined piece has the highest
score is merged, the leftmost of equal ones first. The new chunks of a block are
the rows of a matrix of symbols and are merged together, one pair per row and
step; long chunks go one by one, by a heap over a linked list. Characters that
are no piece become byte pieces.

Nulls are empty texts; an empty text has no ids and decodes to the empty text.
Repeated rows are encoded each by itself, an empty table gives no rows, and
columns that share a name with the result's column are replaced. Work is per
row: no shuffle and nothing collected. Memory is bounded by BLOCK_CHARS, the
table (TABLE_CHUNKS chunks of at most TABLE_CHARS characters; when it is full,
those of the block at hand stay) and the longest text; a chunk of n characters takes n log n steps.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import NEVER as NO_PAIR
from tidemark.llm.bpe import PairTable
from tidemark.llm.common import tidy

MARK = "▁"
BLOCK_CHARS = 1 << 20  # texts are encoded together up to so many characters
TABLE_CHUNKS = 300_000
TABLE_CHARS = 48  # longer chunks are not kept
LONG_CHUNK = 64  # longer chunks are merged by a heap
ROWS_AT_ONCE = 20_000
NEVER = NO_PAIR >> 24  # rank of two symbols that do not join
PROBES = ("", " ", "  a  b ", "x\ty\nz", "Ａ① é é ﬁ", "​﻿ .", "a▁b")


def _each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    """One replacement character for each byte that begins no character."""
    return "�", error.start + 1


codecs.register_error("tidemark-each-byte", _each_byte)


class PieceModel:
    """The pieces of one SentencePiece BPE model with byte fallback."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        library = SentencePieceProcessor(model_file=path)
        size = library.get_piece_size()
        self.pieces = [library.id_to_piece(i) for i in range(size)]
        self.bytes = [b""] * size  # what an id decodes to
        self.byte_ids = [-1] * 256
        self.ids: dict[str, int] = {}
        scores: dict[str, float] = {}
        for i, piece in enumerate(self.pieces):
            if library.is_byte(i):
                value = int(piece[3:5], 16)
                self.bytes[i], self.byte_ids[value] = bytes([value]), i
            elif library.is_unknown(i):
                self.bytes[i] = " ⁇ ".encode()
            elif not library.is_control(i):
                self.bytes[i] = piece.replace(MARK, " ").encode()
                self.ids[piece], scores[piece] = i, library.get_score(i)
        order = {s: k for k, s in enumerate(sorted(set(scores.values()), reverse=True))}
        self.ranks = {piece: order[s] for piece, s in scores.items()}
        crossing = any(MARK in p.lstrip(MARK) for p in self.ids)
        self.chunks = (lambda text: [text]) if crossing else re.compile(
            f"{MARK}+[^{MARK}]*|[^{MARK}]+").findall
        self._pairs()
        for text in PROBES:
            chunks = self.chunks(self.marked(text))
            own = b"".join(map(self.segment(chunks).get, chunks))
            if min(self.byte_ids) < 0 or np.frombuffer(own, "<i4").tolist() != library.encode(text):
                raise ValueError(f"{path}: only BPE models with byte fallback, a marker before the "
                                 "text and no change of characters are supported")

    def marked(self, text: str) -> str:
        return (MARK + text).replace(" ", MARK) if text else ""

    def _pairs(self) -> None:
        """Which symbols join to a piece. A symbol is a piece's id, or the number
        of pieces plus the code point of a character that is no piece."""
        size = len(self.pieces)
        self.symbols = np.arange(size, size + 0x110000, dtype=np.int64)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.symbols[ord(piece)] = i

        def symbol(part: str) -> int | None:
            return int(self.symbols[ord(part)]) if len(part) == 1 else self.ids.get(part)

        found = {}
        for piece, i in self.ids.items():
            for cut in range(1, len(piece)):
                a, b = symbol(piece[:cut]), symbol(piece[cut:])
                if a is not None and b is not None:
                    found[a, b] = self.ranks[piece] << 24 | i
        # rank and id of what a pair joins to; NEVER has the largest rank
        self._joined = PairTable(found).pair_ranks

    def segment(self, chunks: Iterable[str]) -> dict[str, bytes]:
        """The ids of each chunk."""
        out: dict[str, bytes] = {}
        by_width: dict[int, list[str]] = {}
        for chunk in chunks:
            by_width.setdefault(-(-len(chunk) // 4) * 4, []).append(chunk)
        for width, rows in by_width.items():
            if width > LONG_CHUNK:
                for chunk in rows:
                    pieces = _merge_long(chunk, self.ranks)
                    out[chunk] = self._bytes([self.ids.get(p, len(self.pieces) + ord(p[0]))
                                              for p in pieces])
                continue
            for lo in range(0, len(rows), ROWS_AT_ONCE):
                self._merge_rows(rows[lo:lo + ROWS_AT_ONCE], width, out)
        return out

    def _bytes(self, symbols: list[int]) -> bytes:
        size, ids = len(self.pieces), []
        for s in symbols:
            ids += [s] if s < size else [self.byte_ids[b] for b in chr(s - size).encode()]
        return np.array(ids, dtype="<i4").tobytes()

    def _merge_rows(self, chunks: list[str], width: int, out: dict[str, bytes]) -> None:
        n, column = len(chunks), np.arange(width)
        left = np.array([len(c) for c in chunks])
        flat = np.frombuffer("".join(c.ljust(width, "\0") for c in chunks).encode("utf-32-le"),
                             dtype="<u4")
        rows = self.symbols[flat].reshape(n, width)
        # best[r, i]: rank of joining symbols i and i + 1 of row r
        best = np.full((n, width), NEVER, dtype=np.int64)
        r, c = np.nonzero(column + 1 < left[:, None])
        best[r, c] = self._joined(rows[r, c], rows[r, c + 1]) >> 24
        done = np.empty_like(rows)
        live = np.arange(n)
        while True:
            at = best.argmin(axis=1)
            go = best[np.arange(len(live)), at] < NEVER
            done[live[~go]] = rows[~go]
            live, rows, best, at = live[go], rows[go], best[go], at[go]
            if not len(live):
                break
            k = np.arange(len(live))
            joined = self._joined(rows[k, at], rows[k, at + 1]) & 0xFFFFFF
            # the symbols behind the pair move one place to the left
            source = np.minimum(column + (column > at[:, None]), width - 1)
            rows = np.take_along_axis(rows, source, axis=1)
            rows[k, at] = joined
            best = np.take_along_axis(best, np.minimum(column + (column >= at[:, None]), width - 1), axis=1)
            left[live] -= 1
            best[k, at] = NEVER
            has = np.flatnonzero(at + 1 < left[live])
            best[has, at[has]] = self._joined(joined[has], rows[has, at[has] + 1]) >> 24
            has = np.flatnonzero(at > 0)
            best[has, at[has] - 1] = self._joined(rows[has, at[has] - 1], joined[has]) >> 24
        kept = column < left[:, None]
        ids = done[kept]
        ends = np.cumsum(left)
        odd = np.flatnonzero((np.where(kept, done, 0) >= len(self.pieces)).any(axis=1))
        data, stops = ids.astype("<i4").tobytes(), (ends * 4).tolist()
        out.update(zip(chunks, (data[a:b] for a, b in zip([0, *stops], stops))))
        for i in odd.tolist():
            out[chunks[i]] = self._bytes(done[i, :left[i]].tolist())

    def decode(self, ids: list[int]) -> str:
        """The text of ids: markers are spaces, that of the first piece goes,
        bytes that form no character are replacement characters."""
        data = b"".join(map(self.bytes.__getitem__, ids))
        for i in ids:
            if self.bytes[i]:
                if self.pieces[i].startswith(MARK):
                    data = data[1:]
                break
        return data.decode("utf-8", "tidemark-each-byte")


def _merge_long(chunk: str, ranks: dict[str, int]) -> list[str]:
    n, get = len(chunk), ranks.get
    longest = max(map(len, ranks), default=0)
    end = list(range(1, n + 1))  # of the live symbol that starts here; 0: merged away
    before = list(range(-1, n))  # start of the live symbol before this one
    heap = []

    def offer(i: int) -> None:
        j = end[i]
        if j < n and end[j] - i <= longest:
            rank = get(chunk[i:end[j]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, j, end[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, j, stop = heapq.heappop(heap)
        if end[i] != j or j >= n or end[j] != stop:
            continue  # one of the two has been merged since
        end[i], end[j] = stop, 0
        if stop < n:
            before[stop] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    out, i = [], 0
    while i < n:
        out.append(chunk[i:end[i]])
        i = end[i]
    return out


class PieceCodec:
    """Encoder and decoder of one model, with the worker's table of chunks. Ids
    are little-endian 32-bit integers."""

    def __init__(self, path: str):
        self.model = PieceModel(path)
        self._table: dict[str, bytes] = {}

    def encode_all(self, texts: Iterable[str | None], marked: bool = False) -> Iterator[bytes]:
        """The ids of each text, in order. marked: the texts are parts of one that
        has its markers already."""
        block, chars = [], 0
        for text in texts:
            whole = text if marked else self.model.marked(text or "")
            block.append(self.model.chunks(whole) if whole else [])
            chars += len(text or "")
            if chars >= BLOCK_CHARS:
                yield from self._encode_block(block)
                block, chars = [], 0
        yield from self._encode_block(block)

    def _encode_block(self, block: list[list[str]]) -> Iterator[bytes]:
        distinct = set().union(*block)
        fresh = distinct.difference(self._table)
        if len(self._table) + len(fresh) > TABLE_CHUNKS:
            # what this block uses stays
            self._table = {c: self._table[c] for c in distinct.difference(fresh)}
        table, once = self._table, self.model.segment(c for c in fresh if len(c) > TABLE_CHARS)
        table.update(self.model.segment(c for c in fresh if len(c) <= TABLE_CHARS))
        find = table.__getitem__ if not once else lambda c: table.get(c) or once[c]
        for chunks in block:
            yield b"".join(map(find, chunks))


@functools.lru_cache(maxsize=2)
def codec(path: str) -> PieceCodec:
    """One codec per Python worker."""
    return PieceCodec(path)


def _values(batch: pa.RecordBatch, column: int) -> Iterator:
    return (v.as_py() for v in batch.column(column))


def encode(df: DataFrame, text_col: str, path: str, ids_col: str = "piece_ids") -> DataFrame:
    """`df` with its pieces' ids (array of int) in `ids_col`."""
    from pyspark.sql import types as T
    rest = [c for c in df.columns if c != ids_col]
    source = df.select(*[F.col(f"`{c}`") for c in rest],
                       F.col(f"`{text_col}`").cast("string").alias("__text"))
    schema = T.StructType([df.schema[c] for c in rest]
                          + [T.StructField(ids_col, T.ArrayType(T.IntegerType()))])

    @tidy
    def run(batches):
        c = codec(path)
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                part = batch.slice(lo, 2000)
                at = part.num_columns - 1
                ids = [np.frombuffer(x, dtype="<i4") for x in c.encode_all(_values(part, at))]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
                column = pa.ListArray.from_arrays(
                    pa.array(offsets, pa.int32()),
                    pa.array(np.concatenate([np.array([], dtype="<i4"), *ids]), pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns[:at], column],
                                                 names=[*rest, ids_col])

    return source.mapInArrow(run, schema)


def decode(df: DataFrame, ids_col: str, path: str, text_col: str = "decoded") -> DataFrame:
    """`df` with the text of the ids in `text_col` (NULL ids: empty)."""
    from pyspark.sql import types as T
    rest = [c for c in df.columns if c != text_col]
    at = rest.index(ids_col)
    schema = T.StructType([df.schema[c] for c in rest] + [T.StructField(text_col, T.StringType())])

    @tidy
    def run(batches):
        model = codec(path).model
        for batch in batches:
            texts = [model.decode(ids or []) for ids in _values(batch, at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             names=[*rest, text_col])

    return df.select(*[F.col(f"`{c}`") for c in rest]).mapInArrow(run, schema)


def round_trip(df: DataFrame, id_col: str, text_col: str, path: str) -> DataFrame:
    """Per row: the id, how many pieces its text has, the digest of the ids in
    decimal, joined by commas, and the digest of the text they decode to."""
    kind = dict(df.dtypes)[id_col]
    source = df.select(F.col(f"`{id_col}`").alias(id_col),
                       F.col(f"`{text_col}`").cast("string").alias("__text"))

    @tidy
    def run(batches):
        c = codec(path)
        for batch in batches:
            n, ids_sha, text_sha = [], [], []
            for data in c.encode_all(_values(batch, 1)):
                ids = np.frombuffer(data, dtype="<i4").tolist()
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
                text_sha.append(hashlib.sha256(c.model.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()),
                 pa.array(text_sha, pa.string())],
                names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    return source.mapInArrow(
        run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
