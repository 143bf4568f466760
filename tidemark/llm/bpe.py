"""Byte-level BPE encoding and decoding.

Each match of the split pattern is encoded by itself. Its bytes are the leaves
of a segment tree; leaf i holds rank(pair starting at i) and the position i in
one integer, so an inner node's minimum is the leftmost pair of least rank and
the root names the next merge. A merge of positions (i, j) touches three
leaves: i (its new pair), the live neighbour before i (its new pair), and j
(dead); each update walks to the root in log2(bytes) steps.

Texts repeat their matches, so matches are encoded once per task chunk and kept
in a bounded cache. The trees of all new matches of a chunk are updated
together: one row of a matrix per match, one numpy operation per tree level.

Nulls are empty texts; an empty text has no ids. Work is per row: no shuffle,
nothing collected, and memory is bounded by CHUNK_CHARS, the cache and the
longest text.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import tidy

CHUNK_CHARS = 1 << 20  # texts are encoded together up to so many characters
CACHE_PIECES = 300_000  # matches kept by a Python worker
CACHE_BYTES = 32  # longer matches are not kept
NEVER = np.int64(1) << 60  # rank of a pair that does not merge
POS_BITS = 24  # of a position in a matrix tree, which has at most WIDE leaves
WIDE = 64  # longer matches get a tree of their own
WIDTHS = (1, 2, 4, 8, 16, 32, 64)  # leaves of a tree
ROWS_AT_ONCE = 10_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a file: lines of a base64 token and its rank, or the
    JSON of a byte-level BPE model whose ids follow its merges. There a byte that
    prints stands for itself and the others for the code points from 256 on."""
    with open(path, "rb") as f:
        data = f.read()
    if not path.endswith(".json"):
        return {base64.b64decode(a): int(b)
                for a, b in (line.split() for line in data.splitlines() if line.strip())}
    parsed = json.loads(data)
    prints = [*range(0x21, 0x7f), *range(0xa1, 0xad), *range(0xae, 0x100)]
    byte_of = {chr(b): b for b in prints}
    others = [b for b in range(256) if b not in set(prints)]
    byte_of.update((chr(256 + k), b) for k, b in enumerate(others))
    special = {t["content"] for t in parsed.get("added_tokens", [])}
    return {bytes(map(byte_of.__getitem__, token)): rank
            for token, rank in parsed["model"]["vocab"].items() if token not in special}


class PairTable:
    """Values of pairs of ids (below 2^24) as a hash table of numpy arrays, so that
    many pairs are looked up at once."""

    def __init__(self, pairs: dict[tuple[int, int], int]):
        self._build(np.array([a << 24 | b for a, b in pairs], dtype=np.int64),
                    np.array(list(pairs.values()), dtype=np.int64))

    def _build(self, keys: np.ndarray, merged: np.ndarray) -> None:
        bits = max(4, int(len(keys) * 3).bit_length())
        self._shift, self._mask = np.uint64(64 - bits), (1 << bits) - 1
        self._keys = np.full(1 << bits, -1, dtype=np.int64)
        self._vals = np.full(1 << bits, NEVER, dtype=np.int64)
        slot, left = self._slots(keys), np.arange(len(keys))
        while len(left):
            free = self._keys[slot[left]] == -1
            take = left[free]
            first = np.unique(slot[take], return_index=True)[1]
            won = take[first]
            self._keys[slot[won]] = keys[won]
            self._vals[slot[won]] = merged[won]
            left = np.setdiff1d(left, won, assume_unique=True)
            slot[left] = (slot[left] + 1) & self._mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> self._shift).astype(np.int64)

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Value (rank) of each pair, NEVER where it has none."""
        keys = a << 24 | b
        slot = self._slots(keys)
        found = self._keys[slot]
        out = np.where(found == keys, self._vals[slot], NEVER)
        left = np.flatnonzero((found != keys) & (found != -1))
        while len(left):
            slot[left] = (slot[left] + 1) & self._mask
            found = self._keys[slot[left]]
            hit = found == keys[left]
            out[left[hit]] = self._vals[slot[left[hit]]]
            left = left[~hit & (found != -1)]
        return out


class Vocabulary(PairTable):
    """Ranks of one file, and the ranks of the pairs that join to a token."""

    def __init__(self, path: str):
        self.ranks = read_ranks(path)
        self.size = max(self.ranks.values()) + 1
        self.tokens: list[bytes] = [b""] * self.size
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        keys, merged = [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a = self.ranks.get(token[:cut])
                b = self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    keys.append(a << 24 | b)
                    merged.append(rank)
        self._build(np.array(keys, dtype=np.int64), np.array(merged, dtype=np.int64))


def merge_rows(vocab: Vocabulary, pieces: list[bytes], width: int) -> list[bytes]:
    """Ids of each piece (little-endian, 32 bits); every piece has at most
    `width` bytes (a power of two). Row r of `tree` is the segment tree of piece
    r: the root at 1, the leaves from `width`."""
    n = len(pieces)
    size = np.array([len(p) for p in pieces], dtype=np.int64)
    flat = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), dtype=np.uint8)
    # column `width` stands for "no neighbour"
    token = np.full((n, width + 1), -1, dtype=np.int64)
    token[:, :width] = vocab.byte_ids[flat].reshape(n, width)
    column = np.arange(width, dtype=np.int64)
    after = np.empty((n, width + 1), dtype=np.int64)
    after[:, :width] = np.where(column + 1 < size[:, None], column + 1, width)
    after[:, width] = width
    before = np.empty((n, width + 1), dtype=np.int64)
    before[:, :width] = np.where(column > 0, column - 1, width)
    before[:, width] = width

    tree = np.full((n, 2 * width), NEVER << 1, dtype=np.int64)
    if width > 1:
        live = column[None, :-1] + 1 < size[:, None]
        r, c = np.nonzero(live)
        tree[r, width + c] = _leaf(vocab.pair_ranks(token[r, c], token[r, c + 1]), c)
    for node in range(width - 1, 0, -1):
        np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1], out=tree[:, node])

    live = np.flatnonzero(tree[:, 1] < NEVER)
    while len(live):
        root = tree[live, 1]
        at, new = root & ((1 << POS_BITS) - 1), root >> POS_BITS
        gone = after[live, at]
        nxt, prev = after[live, gone], before[live, at]
        token[live, at] = new
        token[live, gone] = -1
        after[live, at] = nxt
        before[live, nxt] = at
        before[live, width] = width
        _update(tree, live, gone, np.full(len(live), NEVER << 1), width)
        own = np.full(len(live), NEVER << 1)
        has = np.flatnonzero(nxt < width)
        own[has] = _leaf(vocab.pair_ranks(new[has], token[live[has], nxt[has]]), at[has])
        _update(tree, live, at, own, width)
        has = np.flatnonzero(prev < width)
        if len(has):
            rank = vocab.pair_ranks(token[live[has], prev[has]], new[has])
            _update(tree, live[has], prev[has], _leaf(rank, prev[has]), width)
        live = live[tree[live, 1] < NEVER]
    kept = (token[:, :width] >= 0) & (column < size[:, None])
    ids = token[:, :width][kept].astype("<u4").tobytes()
    ends = (np.cumsum(kept.sum(axis=1)) * 4).tolist()
    return [ids[a:b] for a, b in zip([0, *ends], ends)]


def _leaf(rank: np.ndarray, position: np.ndarray) -> np.ndarray:
    return np.where(rank >= NEVER, NEVER << 1, rank << POS_BITS | position)


def _update(tree, rows, position, value, width) -> None:
    """Point update of one leaf in each of `rows`, up to the root."""
    node = position + width
    tree[rows, node] = value
    while True:
        node = node >> 1
        if not node[0]:
            return
        tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])


def merge_one(vocab: Vocabulary, piece: bytes) -> list[int]:
    """Ids of one long piece, by a tree in plain Python. Its integers have no
    bound, so the position takes as many bits as the piece needs."""
    n, ranks = len(piece), vocab.ranks
    bits = max(1, (n - 1).bit_length())
    width, never = 1 << bits, vocab.size << bits
    end = list(range(1, n + 1))  # where the live token that starts here ends
    start = list(range(-1, n))  # the live token before the one that starts here
    tree = [never] * (2 * width)

    def leaf(i: int) -> int:
        j = end[i]
        rank = ranks.get(piece[i:end[j]]) if j < n else None
        return never if rank is None else rank << bits | i

    def update(i: int, value: int) -> None:
        node = i + width
        tree[node] = value
        while node > 1:
            node >>= 1
            a, b = tree[2 * node], tree[2 * node + 1]
            tree[node] = a if a < b else b

    for i in range(n - 1):
        tree[width + i] = leaf(i)
    for node in range(width - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])
    mask = width - 1
    while tree[1] < never:
        i = tree[1] & mask
        j = end[i]
        end[i] = end[j]
        if end[i] < n:
            start[end[i]] = i
        update(j, never)
        update(i, leaf(i))
        if start[i] >= 0:
            update(start[i], leaf(start[i]))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


class Codec:
    """Encoder and decoder of one vocabulary file and split pattern. Ids are
    little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, pattern: str):
        import regex
        self.vocab = Vocabulary(path)
        self._find = regex.compile(pattern).findall
        self._cache: dict[str, bytes] = {}

    def _learn(self, matches: Iterable[str]) -> dict[str, bytes]:
        """Ids of matches that are not in the cache; long ones stay out of it."""
        cache, vocab = self._cache, self.vocab
        by_width = [([], []) for _ in range(WIDE + 1)]  # matches and bytes by length
        extra: dict[str, bytes] = {}
        fresh = [m for m in matches if m not in cache]
        if len(cache) + len(fresh) > CACHE_PIECES:
            kept = {m: cache[m] for m in matches if m in cache}  # what these texts use stays
            cache.clear()
            cache.update(kept)
        for match in fresh:
            piece = match.encode("utf-8")
            n = len(piece)
            if n > WIDE:
                extra[match] = np.array(
                    [vocab.ranks[piece]] if piece in vocab.ranks else merge_one(vocab, piece),
                    dtype="<u4").tobytes()
            else:
                names, rows = by_width[n]
                names.append(match)
                rows.append(piece)
        whole = vocab.ranks.get
        for width in WIDTHS:
            names = [m for n in range(width // 2 + 1, width + 1) for m in by_width[n][0]]
            rows = [p for n in range(width // 2 + 1, width + 1) for p in by_width[n][1]]
            keep = cache if width <= CACHE_BYTES else extra
            for lo in range(0, len(rows), ROWS_AT_ONCE):
                part = rows[lo:lo + ROWS_AT_ONCE]
                keep.update(zip(names[lo:lo + ROWS_AT_ONCE], merge_rows(vocab, part, width)))
            # a match that is a token is that token, whatever the merges give
            for match, piece in zip(names, rows):
                rank = whole(piece)
                if rank is not None:
                    keep[match] = rank.to_bytes(4, "little")
        return extra

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of each text, in order."""
        chunk, chars = [], 0
        for text in texts:
            matches = self._find(text) if text else []
            chunk.append(matches)
            chars += len(text or "")
            if chars >= CHUNK_CHARS:
                yield from self._encode_chunk(chunk)
                chunk, chars = [], 0
        yield from self._encode_chunk(chunk)

    def _encode_chunk(self, chunk: list[list[str]]) -> Iterator[bytes]:
        extra = self._learn(set().union(*chunk))
        get = self._cache.__getitem__
        if not extra:
            for matches in chunk:
                yield b"".join(map(get, matches))
            return
        cache = self._cache
        for matches in chunk:
            yield b"".join([cache.get(m) or extra[m] for m in matches])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocab.tokens.__getitem__,
                            np.frombuffer(ids, dtype="<u4").tolist()))


@functools.lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One codec per Python worker."""
    return Codec(path, pattern)


def _rows(batch: pa.RecordBatch, column: int) -> Iterator:
    """Values one by one, so that a batch of long texts is not held twice."""
    return (v.as_py() for v in batch.column(column))


def encode(df: DataFrame, text_col: str, path: str, pattern: str,
           ids_col: str = "token_ids") -> DataFrame:
    """`df` with its tokens' ids (array of int) in `ids_col`, which replaces a
    column of that name."""
    from pyspark.sql import types as T
    rest = [c for c in df.columns if c != ids_col]
    source = df.select(*[F.col(f"`{c}`") for c in rest],
                       F.col(f"`{text_col}`").cast("string").alias("__text"))
    schema = T.StructType([df.schema[c] for c in rest]
                          + [T.StructField(ids_col, T.ArrayType(T.IntegerType()))])

    @tidy
    def run(batches):
        c = codec(path, pattern)
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                part = batch.slice(lo, 2000)
                ids = [np.frombuffer(x, dtype="<i4") for x in
                       c.encode_all(_rows(part, part.num_columns - 1))]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
                values = np.concatenate(ids) if ids else np.array([], dtype=np.int32)
                column = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()),
                                                  pa.array(values, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(part.num_columns - 1)] + [column],
                    names=[*rest, ids_col])

    return source.mapInArrow(run, schema)


def decode(df: DataFrame, ids_col: str, path: str, pattern: str,
           bytes_col: str = "decoded") -> DataFrame:
    """`df` with the bytes of the ids in `bytes_col` (binary; NULL ids: empty).
    The bytes of ids cut out of a text need not be valid UTF-8."""
    from pyspark.sql import types as T
    rest = [c for c in df.columns if c != bytes_col]
    schema = T.StructType([df.schema[c] for c in rest] + [T.StructField(bytes_col, T.BinaryType())])
    source = df.select(*[F.col(f"`{c}`") for c in rest])
    at = rest.index(ids_col)

    @tidy
    def run(batches):
        c = codec(path, pattern)
        for batch in batches:
            out = [c.decode(np.array(x or [], dtype="<u4").tobytes()) for x in _rows(batch, at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())],
                                             names=[*rest, bytes_col])

    return source.mapInArrow(run, schema)


def round_trip(df: DataFrame, id_col: str, text_col: str, path: str, pattern: str) -> DataFrame:
    """Per row: the id, how many tokens its text has, the digest of the ids and
    the digest of the bytes that the ids decode to. Ids stay in the task."""
    kind = dict(df.dtypes)[id_col]
    source = df.select(F.col(f"`{id_col}`").alias(id_col),
                       F.col(f"`{text_col}`").cast("string").alias("__text"))

    @tidy
    def run(batches):
        c = codec(path, pattern)
        for batch in batches:
            n, ids_sha, bytes_sha = [], [], []
            for ids in c.encode_all(_rows(batch, 1)):
                n.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                bytes_sha.append(hashlib.sha256(c.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()),
                 pa.array(bytes_sha, pa.string())],
                names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    return source.mapInArrow(
        run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
