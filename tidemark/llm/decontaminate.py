"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

A document leaks a benchmark item if some passage of it is within k edits of
the whole item, k = floor(RATE * m) for an item of m characters. Texts are
compared with case and white space made equal; positions are reported in the
document as it is.

Filtering. Of the m - q + 1 q-grams of an item, one edit spoils at most q, so a
passage within k edits shares at least T = m - q + 1 - k * q of them. q is Q where
the item is long enough, else the largest one with T >= 1, down to the whole of an
item without a budget; the q-grams of each length have a table of their own. Since
k edits shift an alignment by at most k diagonals (position in the document
minus position in the item), those matches lie on at most k + 1 neighbouring
diagonals. Diagonals are cut into bands of width 2 * (k + 1) that overlap by
half, so that every such run of diagonals lies in one band. A band with T
matches or more is a region to verify; a band also bounds the place in the
document, as an item position is less than m.

Verification aligns the item with the region inside the band's diagonals
(widened by k) and takes the end with the fewest edits.

Documents are scanned where they are read: hashed q-grams are looked up in a
table of the benchmark's q-grams. The benchmark is shipped to tasks in shards
of at most SHARD_CHARS characters; with more shards the documents are scanned
once per shard. Nothing of the documents is shuffled.

Items of no characters (after white space is made equal) match nothing; an item of
one character matches wherever it stands. Null and empty texts leak nothing; repeated rows and items are reported each by itself; an empty table
gives no rows.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import tidy

Q = 8
RATE = 0.1
SHARD_CHARS = 4_000_000
CHUNK_CHARS = 1 << 20  # documents are scanned together up to so many characters
HITS_AT_ONCE = 1 << 19
TABLE_BITS = 22
BASE = 0x9E3779B97F4A7C15
SPACE = np.uint32(32)
GAP = np.uint32(0x110000)  # no character: stands between documents


def _lower_table() -> np.ndarray:
    """Lower case of each character of the basic plane that has one of one
    character; white space becomes a space."""
    table = np.arange(1 << 16, dtype=np.uint32)
    for c in range(1 << 16):
        if 0xD800 <= c < 0xE000:
            continue
        low = chr(c).lower()
        if chr(c).isspace():
            table[c] = 32
        elif len(low) == 1:
            table[c] = ord(low)
    return table


_LOWER: np.ndarray | None = None


def normal(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(characters, their positions in `text`): lower case, white space runs as
    one space, none at the ends."""
    global _LOWER
    if _LOWER is None:
        _LOWER = _lower_table()
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    small = raw < (1 << 16)
    chars = _LOWER[raw] if small.all() else np.where(small, _LOWER[np.where(small, raw, 0)], raw)
    blank = chars == SPACE
    keep = ~blank
    keep[1:] |= blank[1:] & ~blank[:-1]
    if len(blank):
        keep[0] = not blank[0]
    at = np.flatnonzero(keep)
    if len(at) and blank[at[-1]]:
        at = at[:-1]
    return chars[at], at


def qgram_hashes(chars: np.ndarray, q: int = Q) -> np.ndarray:
    """Hash of the q characters that begin at each position."""
    h = chars.astype(np.uint64)
    if q != Q:
        n = max(0, len(h) - q + 1)
        out = np.zeros(n, np.uint64)
        for j in range(q):
            out = out * np.uint64(BASE) + h[j:j + n]
        return out
    for step in (1, 2, 4):
        if len(h) <= step:
            return np.empty(0, np.uint64)
        h = h[:-step] * np.uint64(pow(BASE, step, 1 << 64)) + h[step:]
    return h


def _slot(h: np.ndarray) -> np.ndarray:
    return ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


class QGrams:
    """The q-grams of one length, sorted by hash, with item and position."""

    def __init__(self, items: list[tuple[int, np.ndarray]], q: int):
        self.q = q
        hashes = [qgram_hashes(chars, q) for _, chars in items]
        h = np.concatenate(hashes)
        order = np.argsort(h, kind="stable")
        self.hashes = h[order]
        self.owner = np.repeat([i for i, _ in items], [len(x) for x in hashes])[order]
        self.place = np.concatenate([np.arange(len(x), dtype=np.int64) for x in hashes])[order]
        self.table = np.zeros(1 << TABLE_BITS, dtype=bool)
        self.table[_slot(self.hashes)] = True


class Benchmark:
    """Some items, their budgets and the q-grams of each length that they need."""

    def __init__(self, items: list[tuple[object, str]], rate: float = RATE):
        self.ids, self.chars, self.edits, self.least = [], [], [], []
        by_q: dict[int, list[tuple[int, np.ndarray]]] = {}
        for item_id, text in items:
            chars, _ = normal(text or "")
            m = len(chars)
            if not m:
                continue
            k = int(rate * m)
            q = max(1, min(Q, m // (k + 1)))
            by_q.setdefault(q, []).append((len(self.ids), chars))
            self.ids.append(item_id)
            self.chars.append(chars)
            self.edits.append(k)
            self.least.append(m - q + 1 - k * q)
        self.grams = [QGrams(some, q) for q, some in sorted(by_q.items())]
        self.edits = np.array(self.edits, dtype=np.int64)
        self.least = np.array(self.least, dtype=np.int64)

    def regions(self, chars: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, lowest diagonal, highest diagonal) of the bands that reach
        their item's bound, in characters of `chars`."""
        return [region for grams in self.grams for region in self._regions(grams, chars)]

    def _regions(self, grams: QGrams, chars: np.ndarray) -> list[tuple[int, int, int]]:
        h = qgram_hashes(chars, grams.q)
        if not len(h):
            return []
        at = np.flatnonzero(grams.table[_slot(h)])
        low = np.searchsorted(grams.hashes, h[at], "left")
        times = np.searchsorted(grams.hashes, h[at], "right") - low
        at, low, times = at[times > 0], low[times > 0], times[times > 0]
        if not len(at):
            return []
        span = len(chars) + max(len(c) for c in self.chars) + 2 * int(self.edits.max()) + 8
        found = []
        runs = np.cumsum(times) // HITS_AT_ONCE
        for k in range(int(runs[-1]) + 1):
            a, b, n = at[runs == k], low[runs == k], times[runs == k]
            if not len(n):
                continue
            entry = np.repeat(b - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            item = grams.owner[entry]
            diagonal = np.repeat(a, n) - grams.place[entry]
            width = self.edits[item] + 1
            band = (diagonal + span) // width
            # the band that begins here, and the one that began a width before
            found.append(np.concatenate([item, item]) * (4 * span)
                         + np.concatenate([band, band - 1]))
        keys, counts = self._count(found)
        item = keys // (4 * span)
        good = counts >= self.least[item]
        item, band = item[good], (keys - item * (4 * span))[good]
        width = self.edits[item] + 1
        low_d = band * width - span
        return list(zip(item.tolist(), low_d.tolist(), (low_d + 2 * width - 1).tolist()))

    @staticmethod
    def _count(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Counts per key; each part is counted by itself and the counts are
        added, so that what is held is a part and the keys."""
        keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)
        for part in parts:
            k, c = np.unique(part, return_counts=True)
            both = np.concatenate([keys, k])
            keys, back = np.unique(both, return_inverse=True)
            counts = np.bincount(back, weights=np.concatenate([counts, c])).astype(np.int64)
        return keys, counts

    def align(self, item: int, chars: np.ndarray, low: int, high: int
              ) -> tuple[int, int, int] | None:
        """(edits, start, end) of the best passage of `chars` for the whole item
        on diagonals low - k .. high + k, None beyond the budget."""
        pattern, k = self.chars[item], int(self.edits[item])
        m, n = len(pattern), len(chars)
        low, high = low - k, high + k
        width = high - low + 1
        # The region, with gaps where it leaves the text. A passage that holds
        # gaps is no better than the same one without them.
        first, last = max(0, low), min(n, high + m)
        if first >= last:
            return None
        place = chars[first:last].tobytes().find(pattern.tobytes())
        if place >= 0 and place % 4 == 0:
            return 0, first + place // 4, first + place // 4 + m
        region = np.full(width + m, GAP, dtype=np.uint32)
        region[first - low:last - low] = chars[first:last]
        # cost[d]: edits to have the first i characters of the item end at
        # position i + d of the region; origin[d]: where that passage starts.
        offsets = np.arange(width)
        cost, origin = np.zeros(width, dtype=np.int64), offsets.copy()
        skip, skip_from = np.empty(width, np.int64), np.empty(width, np.int64)
        skip[-1], skip_from[-1] = 1 << 30, 0
        for i in range(m):
            new = cost + (region[i:i + width] != pattern[i])
            skip[:-1], skip_from[:-1] = cost[1:], origin[1:]
            skip[:-1] += 1  # an item character left out
            origin = np.where(skip < new, skip_from, origin)
            # a document character too many: running minimum along the row
            slope = np.minimum(skip, new) - offsets
            best = np.minimum.accumulate(slope)
            source = np.maximum.accumulate(np.where(best < slope, 0, offsets))
            cost, origin = best + offsets, origin[source]
            if i % 8 == 7 and cost.min() > k:
                return None
        at = int(np.argmin(cost))
        if cost[at] > k:
            return None
        start, end = int(origin[at]) + low, at + low + m
        return int(cost[at]), max(0, start), min(n, end)


def scan(bench: Benchmark, texts: list[str]) -> list[list[tuple[int, int, int, int]]]:
    """Per text its leaks (item, start, end, edits), positions in the text."""
    out: list[list] = [[] for _ in texts]
    held, size = [], 0

    def flush():
        if not held:
            return
        starts, parts, at = [], [], 0
        for _, chars, _ in held:
            starts.append(at)
            parts += [chars, np.array([GAP], dtype=np.uint32)]
            at += len(chars) + 1
        joined = np.concatenate(parts)
        for item, low, high in bench.regions(joined):
            # The region may touch more than one text; each is aligned alone.
            m = len(bench.chars[item])
            first = int(np.searchsorted(starts, max(0, low), "right")) - 1
            while first < len(held) and starts[first] < high + m:
                index, chars, places = held[first]
                if len(chars):
                    hit = bench.align(item, chars, low - starts[first], high - starts[first])
                    if hit is not None and hit[2] > hit[1]:
                        out[index].append((item, int(places[hit[1]]),
                                           int(places[hit[2] - 1]) + 1, hit[0]))
                first += 1
        held.clear()

    for i, text in enumerate(texts):
        chars, places = normal(text or "")
        held.append((i, chars, places))
        size += len(chars)
        if size >= CHUNK_CHARS:
            flush()
            size = 0
    flush()
    return [_best(x) for x in out]


def _best(leaks: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Overlapping bands find one passage twice: of the overlapping finds of one
    item the one with the fewest edits stays."""
    kept: dict[int, list[tuple[int, int, int]]] = {}  # by item, apart from each other, by start
    for item, start, end, edits in sorted(set(leaks), key=lambda x: (x[0], x[3], x[1], x[2])):
        own = kept.setdefault(item, [])
        at = bisect.bisect_left(own, (start,))
        if (at == 0 or own[at - 1][1] <= start) and (at == len(own) or own[at][0] >= end):
            own.insert(at, (start, end, edits))
    return sorted(((item, *leak) for item, own in kept.items() for leak in own),
                  key=lambda x: (x[1], x[0]))


def _items(benchmark: DataFrame, item_col: str, item_text: str) -> tuple[DataFrame, int]:
    """(item, text) of the items with text, and into how many shards they go."""
    items = benchmark.select(F.col(f"`{item_col}`").alias("item"),
                             F.col(f"`{item_text}`").cast("string").alias("text")).filter(
        F.length("text") > 0)
    chars = items.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    return items, max(1, -(-chars // SHARD_CHARS))


def _shards(spark, items: DataFrame, shards: int):
    """The broadcast items of each shard."""
    for shard in range(shards):
        part = items if shards == 1 else items.filter(
            F.pmod(F.xxhash64("item", "text"), F.lit(shards)) == shard)
        yield spark.sparkContext.broadcast([tuple(r) for r in part.collect()])


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text: str = "text", rate: float = RATE) -> DataFrame:
    """(id_col, item_col, start, end, edits) of every passage of `docs` that is
    within the edit budget of a whole item of `benchmark`."""
    spark = docs.sparkSession
    kind, item_kind = dict(docs.dtypes)[id_col], dict(benchmark.dtypes)[item_col]
    items, shards = _items(benchmark, item_col, item_text)
    source = docs.select(F.col(f"`{id_col}`").alias("id"),
                         F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = f"`{id_col}` {kind}, `{item_col}` {item_kind}, `start` int, `end` int, edits int"

    def scanner(shared):
        @tidy
        def run(batches):
            bench, names = Benchmark(shared.value, rate), [id_col, item_col, "start", "end", "edits"]
            for batch in batches:
                for lo in range(0, batch.num_rows, 500):
                    cut = batch.slice(lo, 500)
                    hits = scan(bench, cut.column(1).to_pylist())
                    rows = [(i, *x) for i, xs in enumerate(hits) for x in xs]
                    if not rows:
                        continue
                    ids = cut.column(0).take(pa.array([r[0] for r in rows], pa.int32()))
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array([bench.ids[r[1]] for r in rows]),
                         *(pa.array([r[i] for r in rows], pa.int32()) for i in (2, 3, 4))],
                        names=names)

        return run

    found = None
    for shared in _shards(spark, items, shards):
        one = source.mapInArrow(scanner(shared), schema)
        found = one if found is None else found.unionByName(one)
    return found


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          rate: float = RATE) -> DataFrame:
    """The rows of `docs` without a leak, all columns as they are. Each row is judged
    by its own text where it is read, whatever its id: nothing is joined."""
    items, shards = _items(benchmark, "item_id", "text")
    names, schema = docs.columns, docs.schema
    kept = docs.select(*[F.col(f"`{c}`") for c in names],
                       F.col(f"`{text_col}`").cast("string").alias("__text"))

    def sieve(shared):
        @tidy
        def run(batches):
            bench = Benchmark(shared.value, rate)
            for batch in batches:
                for lo in range(0, batch.num_rows, 500):
                    cut = batch.slice(lo, 500)
                    hits = scan(bench, cut.column(len(names)).to_pylist())
                    yield cut.filter(pa.array([not x for x in hits], pa.bool_()))

        return run

    whole = kept.schema
    for shared in _shards(docs.sparkSession, items, shards):
        kept = kept.mapInArrow(sieve(shared), whole)
    return kept.select(*[F.col(f"`{c}`") for c in names])
