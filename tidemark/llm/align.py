"""Alignment of two tokenizers' tokens of the same texts.

Both tokenizers see a space and the text. Each token ends at a byte offset of
that string, so a text has two ascending lists of ends. Where a value stands in
both, the text can be cut for both tokenizers at once: between two such cuts
lies a group of tokens A and tokens B that cover the same bytes.

* Common ends are found by a galloping intersection: the ends of the shorter
  list are looked up in the longer one by an exponential search from a known
  lower bound and a binary search in the range it leaves. A space behind a
  character that is no white space begins a token of both tokenizers, whatever
  stands around it, so a text is cut there into units and each distinct unit of a
  block of texts is tokenized and aligned once. The units are laid end to end: one
  call serves a block, and its searches run as vectors, first every STRIDE-th end
  from the start of the list, then the others from the place of the one before.
* The places of the common ends in both lists slice the groups; the differences
  of their ranks are the groups' sizes, that is, the range of tokens B that
  every token A of the group overlaps.
* A group links each of its tokens A with each of its tokens B. An id pair's
  count is the number of documents that hold it linked, over the whole corpus.

Spark's part: tasks align blocks of texts and write, per block, its distinct id
pairs with the number of its documents that hold them, and per document the
places of its pairs in that list (`blocks`). Pairs are counted by a sum over
blocks (`pair_counts`), and the counts are joined back to the blocks' lists, never
to the documents' links (`score`). What is shuffled is a row per block and
distinct pair; a pair that every document holds is one row per block. Blocks are
written in the shared folder once; a lost executor costs reading them again.

Texts that are null, empty or not given back byte for byte (those with U+2581,
which B turns into a space) have no tokens, groups or links. Repeated
rows and rows with equal or null ids are documents of their own; an empty table
gives no rows; only the two named columns are read, so others cannot clash. A
block holds BLOCK_CHARS characters or one longer text. Links of large groups are
counted by distinct ids, so a group's memory is that of its distinct pairs.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import bpe, pieces
from tidemark.llm.common import compress, decompress, persist, tidy

BLOCK_CHARS = 1 << 22
STRIDE = 64
WIDE_GROUP = 64  # links from which a group is counted by distinct ids
ID_BITS = 20  # of a token id


def lower_bounds(values: np.ndarray, into: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For each value the first place in the ascending `into` that holds it or a
    larger one, by galloping from `start`, which no result lies before."""
    n = len(into)
    low, high = start.copy(), start.copy()
    going = np.flatnonzero(into[np.minimum(high, n - 1)] < values)
    going = going[high[going] < n]
    step = 1
    while len(going):
        low[going] = high[going] + 1
        high[going] = np.minimum(high[going] + step, n)
        step *= 2
        going = going[high[going] < n]
        going = going[into[high[going]] < values[going]]
    going = np.flatnonzero(low < high)
    while len(going):
        middle = (low[going] + high[going]) >> 1
        below = into[middle] < values[going]
        low[going[below]] = middle[below] + 1
        high[going[~below]] = middle[~below]
        going = going[low[going] < high[going]]
    return low


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in both ascending lists of the values that they share. The shorter
    list drives the search."""
    if len(a) > len(b):
        at_b, at_a = common_ends(b, a)
        return at_a, at_b
    if not len(a):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    anchors = lower_bounds(a[::STRIDE], b, np.zeros(-(-len(a) // STRIDE), dtype=np.int64))
    found = lower_bounds(a, b, np.repeat(anchors, STRIDE)[:len(a)])
    at = np.flatnonzero(b[np.minimum(found, len(b) - 1)] == a)
    return at, found[at]


class Units:
    """Tokens of some strings laid end to end, cut into groups. Group g holds the
    tokens a_end[g] - a_n[g] .. a_end[g] and b_end[g] - b_n[g] .. b_end[g]."""

    def __init__(self, a: np.ndarray, b: np.ndarray, a_size: np.ndarray, b_size: np.ndarray,
                 stops: np.ndarray):
        """Ids of both tokenizers, the sizes of all ids in bytes, where units end."""
        self.a, self.b = a.astype(np.int64), b.astype(np.int64)
        ends_a, ends_b = np.cumsum(a_size[self.a]), np.cumsum(b_size[self.b])
        self.n_a, self.n_b = (np.diff(np.searchsorted(ends, stops, "right"), prepend=0)
                              for ends in (ends_a, ends_b))
        at_a, at_b = common_ends(ends_a, ends_b)
        self.a_end, self.b_end = at_a + 1, at_b + 1
        self.a_n, self.b_n = np.diff(self.a_end, prepend=0), np.diff(self.b_end, prepend=0)
        self.unit = np.repeat(np.arange(len(stops)), self.n_a)[at_a]  # of each group
        self.n_groups = np.bincount(self.unit, minlength=len(stops))
        self.n_links = _sums(self.a_n * self.b_n, self.n_groups)

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(unit, id pair, times) for each unit and distinct linked pair, by unit
        and pair. A pair is A's id << ID_BITS | B's id."""
        size = self.a_n * self.b_n
        few = np.flatnonzero(size <= WIDE_GROUP)
        n = size[few]
        group = np.repeat(few, n)
        k = np.arange(len(group)) - np.repeat(np.cumsum(n) - n, n)
        width = self.b_n[group]
        a = self.a[self.a_end[group] - self.a_n[group] + k // width]
        b = self.b[self.b_end[group] - width + k % width]
        owner, pairs = [self.unit[group]], [a << ID_BITS | b]
        times = [np.ones(len(group), dtype=np.int64)]
        for g in np.flatnonzero(size > WIDE_GROUP).tolist():
            a, n_a = np.unique(self.a[self.a_end[g] - self.a_n[g]:self.a_end[g]], return_counts=True)
            b, n_b = np.unique(self.b[self.b_end[g] - self.b_n[g]:self.b_end[g]], return_counts=True)
            pairs.append((a[:, None] << ID_BITS | b).ravel())
            owner.append(np.full(len(pairs[-1]), self.unit[g]))
            times.append((n_a[:, None] * n_b).ravel())
        return _summed(np.concatenate(owner), np.concatenate(pairs), np.concatenate(times))

    def listed(self, words: list[bytes], a_words: int) -> Iterator[bytes]:
        """Per unit its groups as text. words: for each id of A and then each of B
        (from a_words on) the text inside a group, and the text at the end of a
        list."""
        n = len(self.a) + len(self.b)
        order = np.empty(n, dtype=np.int64)
        last_a, last_b = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        last_a[self.a_end - 1] = 1
        last_b[self.b_end - 1] = 1
        before_b = np.repeat(self.b_end - self.b_n, self.a_n)
        order[np.arange(len(self.a)) + before_b] = 2 * self.a + last_a
        order[np.arange(len(self.b)) + np.repeat(self.a_end, self.b_n)] = (
            a_words + 2 * self.b + last_b)
        listed = list(map(words.__getitem__, order.tolist()))
        stop = 0
        for n in (self.n_a + self.n_b).tolist():
            yield b"".join(listed[stop:stop + n])
            stop += n


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums over neighbouring runs of the given sizes."""
    total, stop = np.concatenate([[0], np.cumsum(values)]), np.cumsum(sizes)
    return total[stop] - total[stop - sizes]


def _gathered(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of the runs that begin at `starts`, one run after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def _summed(owner: np.ndarray, pairs: np.ndarray, times: np.ndarray):
    """Times added up by owner and pair, in that order."""
    keys = owner << 2 * ID_BITS | pairs
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1) != 0)
    if not len(first):
        return keys, keys, times
    keys = keys[first]
    return keys >> 2 * ID_BITS, keys & ((1 << 2 * ID_BITS) - 1), np.add.reduceat(times, first)


class Block:
    """Some texts as lists of units. codes: the units of all texts in order; sizes:
    how many each text has."""

    def __init__(self, units: Units, codes: np.ndarray, sizes: np.ndarray):
        self.units, self.codes, self.sizes = units, codes, sizes
        self.n_a, self.n_b, self.n_groups, self.n_links = (
            _sums(x[codes], sizes) for x in (units.n_a, units.n_b, units.n_groups, units.n_links))

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """`Units.links` by text."""
        unit, pair, times = self.units.links()
        n = np.bincount(unit, minlength=len(self.units.n_a))
        start = np.cumsum(n) - n
        text = np.repeat(np.arange(len(self.sizes)), self.sizes)
        both, again = np.unique(text << 32 | self.codes, return_counts=True)
        text, code = both >> 32, both & 0xFFFFFFFF
        at = _gathered(start[code], n[code])
        return _summed(np.repeat(text, n[code]), pair[at], times[at] * np.repeat(again, n[code]))

    def listed(self, words: list[bytes], a_words: int) -> Iterator[bytes]:
        of_unit = list(self.units.listed(words, a_words))
        listed, stop = list(map(of_unit.__getitem__, self.codes.tolist())), 0
        for n in self.sizes.tolist():
            yield b"".join(listed[stop:stop + n])[:-1]
            stop += n

    def tokens(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and of B of all texts, and the groups' ends in both, counted
        from the start of each text."""
        u, c = self.units, self.codes
        a = u.a[_gathered((np.cumsum(u.n_a) - u.n_a)[c], u.n_a[c])]
        b = u.b[_gathered((np.cumsum(u.n_b) - u.n_b)[c], u.n_b[c])]
        groups = _gathered((np.cumsum(u.n_groups) - u.n_groups)[c], u.n_groups[c])
        ends = []
        for n, whole in ((u.a_n, self.n_a), (u.b_n, self.n_b)):
            ends.append(np.cumsum(n[groups]) - np.repeat(np.cumsum(whole) - whole, self.n_groups))
        return a, b, *ends


_BLANK_AND_SPACE = re.compile(r"\s ").search


def _cut_units(text: str) -> list[str]:
    """The units of a space and the text, without the space that each begins with."""
    parts = text.split(" ")
    if not _BLANK_AND_SPACE(" " + text):
        return parts
    units = parts[:1]
    for part in parts[1:]:
        if not units[-1] or units[-1][-1].isspace():
            units[-1] += " " + part  # white space may be one token with the space
        else:
            units.append(part)
    return units


class Aligner:
    """The two tokenizers of a Python worker."""

    def __init__(self, path_a: str, pattern: str, path_b: str):
        self.a = bpe.codec(path_a, pattern)
        self.b = pieces.codec(path_b)
        a_tokens, b_tokens = self.a.vocab.tokens, self.b.model.bytes
        if max(len(a_tokens), len(b_tokens)) > 1 << ID_BITS:
            raise ValueError(f"token ids of more than {ID_BITS} bits")
        if any(re.search(r"\S ", t.decode("utf-8", "replace")) for t in self.a.vocab.ranks):
            raise ValueError("tokens of A go on behind the end of a word")
        # all tokens' bytes one after the other, and their sizes
        self.a_bytes, self.b_bytes = (np.frombuffer(b"".join(t), dtype=np.uint8)
                                      for t in (a_tokens, b_tokens))
        self.a_size, self.b_size = (np.array([len(x) for x in t], dtype=np.int64)
                                    for t in (a_tokens, b_tokens))
        self.a_words = 2 * len(a_tokens)
        self.words = [w for i in range(len(a_tokens)) for w in (b"%d," % i, b"%d|" % i)]
        self.words += [w for i in range(len(b_tokens)) for w in (b"%d," % i, b"%d;" % i)]

    def block(self, texts: list[str | None]) -> Block:
        """The texts' tokens; none for texts that hold a marker, which B turns into a
        space. Both tokenizers give all others back, which is checked."""
        listed, sizes = [], []
        for text in texts:
            units = _cut_units(text) if text and pieces.MARK not in text else []
            sizes.append(len(units))
            listed += units
        coded = pa.array(listed, pa.string()).dictionary_encode()
        codes, sizes = coded.indices.to_numpy().astype(np.int64), np.array(sizes, dtype=np.int64)
        distinct = coded.dictionary.to_pylist()
        # a unit that ends in white space has to be the last one of what is encoded
        ends_blank = [k for k, u in enumerate(distinct) if not u or u[-1].isspace()]
        order = np.array(ends_blank + np.setdiff1d(np.arange(len(distinct)), ends_blank).tolist(), dtype=np.int64)
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        whole = [" " + distinct[k] for k in order.tolist()]
        n = len(ends_blank)
        parts = whole[:n] + (["".join(whole[n:])] if len(whole) > n else [])
        a = np.frombuffer(b"".join(self.a.encode_all(parts)), "<i4")
        b = np.frombuffer(b"".join(self.b.encode_all(
            [p.replace(" ", pieces.MARK) for p in parts], marked=True)), "<i4")
        data = "".join(parts).encode()
        for ids, tokens, size in ((a, self.a_bytes, self.a_size), (b, self.b_bytes, self.b_size)):
            at = _gathered((np.cumsum(size) - size)[ids], size[ids])
            if tokens[at].tobytes() != data:
                raise ValueError("a tokenizer does not give back a text without markers")
        stops = np.cumsum([len(u.encode()) for u in whole], dtype=np.int64)
        return Block(Units(a, b, self.a_size, self.b_size, stops), place[codes], sizes)


def _aligner(path_a: str, pattern: str, path_b: str, kept={}) -> Aligner:
    """One per Python worker."""
    key = (path_a, pattern, path_b)
    if key not in kept:
        kept.clear()
        kept[key] = Aligner(*key)
    return kept[key]


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """(ids as Arrow scalars, texts) of blocks of at most BLOCK_CHARS or one text."""
    ids, texts, chars = [], [], 0
    for batch in batches:
        for i, t in zip(batch.column(0), batch.column(1)):
            text = t.as_py()
            if ids and chars + len(text or "") > BLOCK_CHARS:
                yield ids, texts
                ids, texts, chars = [], [], 0
            ids.append(i)
            texts.append(text)
            chars += len(text or "")
    if ids:
        yield ids, texts


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()),
                                    pa.array(values, pa.int32()))


def align(df: DataFrame, id_col: str, text_col: str, path_a: str, pattern: str,
          path_b: str) -> DataFrame:
    """Per row: the id, the ids of both tokenizers, and the groups as the number
    of tokens A and of tokens B up to the end of each."""
    kind = dict(df.dtypes)[id_col]
    source = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string"))

    @tidy
    def run(batches):
        aligner = _aligner(path_a, pattern, path_b)
        for ids, texts in _cut(batches):
            block = aligner.block(texts)
            a, b, a_ends, b_ends = block.tokens()
            yield pa.RecordBatch.from_arrays(
                [pa.array([i.as_py() for i in ids], ids[0].type),
                 _lists(a, block.n_a), _lists(b, block.n_b),
                 _lists(a_ends, block.n_groups), _lists(b_ends, block.n_groups)],
                names=["id", "a_ids", "b_ids", "a_ends", "b_ends"])

    return source.mapInArrow(run, f"id {kind}, a_ids array<int>, b_ids array<int>,"
                                  " a_ends array<int>, b_ends array<int>")


def blocks(df: DataFrame, id_col: str, text_col: str, path_a: str, pattern: str,
           path_b: str) -> DataFrame:
    """One written row per block: its distinct id pairs, how many of its
    documents hold each, and per document the figures and packed links."""
    kind = dict(df.dtypes)[id_col]
    source = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string"))

    @tidy
    def run(batches):
        from pyspark import TaskContext
        aligner = _aligner(path_a, pattern, path_b)
        number = TaskContext.get().partitionId() << 32
        for ids, texts in _cut(batches):
            block = aligner.block(texts)
            doc, pair, times = block.links()
            pairs, at, held = np.unique(pair, return_inverse=True, return_counts=True)
            digests = [hashlib.sha256(x).hexdigest() if x else ""
                       for x in block.listed(aligner.words, aligner.a_words)]
            n_pairs = np.bincount(doc, minlength=len(ids))
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([pairs], pa.list_(pa.int64())),
                 pa.array([held], pa.list_(pa.int32())),
                 pa.array([[i.as_py() for i in ids]], pa.list_(ids[0].type)),
                 *(pa.array([x], pa.list_(pa.int64())) for x in
                   (block.n_a, block.n_b, block.n_groups, block.n_links, n_pairs)),
                 pa.array([digests], pa.list_(pa.string())),
                 pa.array([_pack(at)], pa.binary()), pa.array([_pack(times)], pa.binary())],
                names=["block", "pairs", "held", "ids", *FIGURES, "n_pairs", "groups_sha256",
                       "link_at", "link_times"])
            number += 1

    return persist(source.mapInArrow(
        run, f"block long, pairs array<long>, held array<int>, ids array<{kind}>, "
        + ", ".join(f"{f} array<long>" for f in [*FIGURES, "n_pairs"])
        + ", groups_sha256 array<string>, link_at binary, link_times binary"), "alignment")


FIGURES = ("n_a", "n_b", "n_groups", "n_links")


def _pack(values: np.ndarray) -> bytes:
    """Differences of neighbours, compressed."""
    return compress(np.diff(values, prepend=0).astype("<i8").tobytes())


def _unpack(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(decompress(data), "<i8"))


def pair_counts(found: DataFrame) -> DataFrame:
    """(pair, docs, best): over the whole corpus, how many documents hold each
    linked pair, and whether no other pair of its token A has more."""
    counts = (found.select(F.explode(F.arrays_zip("pairs", "held")).alias("p"))
              .groupBy(F.col("p.pairs").alias("pair"))
              .agg(F.sum(F.col("p.held").cast("long")).alias("docs")))
    counts = persist(counts.withColumn("a", F.shiftright("pair", ID_BITS)), "pair-counts")
    most = counts.groupBy("a").agg(F.max("docs").alias("most"))
    # At most 2^ID_BITS rows of tokens A, and a row per pair: the planner sees both sizes.
    return counts.join(most, "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def score(df: DataFrame, id_col: str, text_col: str, path_a: str, pattern: str,
          path_b: str) -> DataFrame:
    """Per document: id_col, n_a, n_b, n_groups, n_links, n_best (links whose pair
    is a best one of its token A), count_sum (the pairs' counts over all links),
    groups_sha256."""
    kind = dict(df.dtypes)[id_col]
    found = blocks(df, id_col, text_col, path_a, pattern, path_b)
    counts = pair_counts(found)
    listed = found.select("block", F.posexplode("pairs").alias("place", "pair"))
    known = (listed.join(counts.hint("merge"), "pair")
             .groupBy("block").agg(F.collect_list(F.struct("place", "docs", "best")).alias("known"))
             .select("block", F.col("known.place").alias("place"), F.col("known.docs").alias("docs"),
                     F.col("known.best").alias("best")))
    joined = (found.drop("pairs", "held").hint("merge").join(known, "block", "left"))
    names = [id_col, *FIGURES, "n_best", "count_sum", "groups_sha256"]
    columns = joined.columns

    @tidy
    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                row = {c: batch.column(k)[r] for k, c in enumerate(columns)}
                at, times = (_unpack(row[c].as_py()) for c in ("link_at", "link_times"))
                docs = best = np.zeros(0, dtype=np.int64)
                if row["place"].is_valid:
                    place = row["place"].values.to_numpy()
                    docs, best = np.empty(len(place), np.int64), np.empty(len(place), np.int64)
                    docs[place] = row["docs"].values.to_numpy()
                    best[place] = row["best"].values.to_numpy(zero_copy_only=False)
                stop = np.cumsum(row["n_pairs"].values.to_numpy())
                sums = [np.concatenate([[0], np.cumsum(times * w[at])]) for w in (best, docs)]
                start = np.concatenate([[0], stop[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [row["ids"].values, *(row[f].values for f in FIGURES),
                     *(pa.array(s[stop] - s[start], pa.int64()) for s in sums),
                     row["groups_sha256"].values], names=names)

    return joined.mapInArrow(run, f"`{id_col}` {kind}, " + ", ".join(
        f"{c} long" for c in names[1:-1]) + ", groups_sha256 string")
