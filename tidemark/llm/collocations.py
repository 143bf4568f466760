"""Phrase collocations by vertical partitioning of the words' suffixes.

A text is cut into pieces, a piece into words. Every word begins a suffix, cut
off at the end of its piece and after `max_words` words. The suffixes of all
texts form a tree of words whose node totals are the phrases' counts; it is built
in parts that fit in memory:

1. Scan: tasks read texts in blocks and emit each block's distinct words with
   their counts; a sum gives every word's count. Words fall into SLOTS prefix
   classes by a hash; a class's total is the number of suffixes that begin with
   its words (`word_counts`).
2. Partition: classes are packed into groups of at most `budget` suffixes. A
   class above the budget is extended by the next word: a second scan counts its
   suffixes by a hash of their second word, finely enough for parts far below the
   budget, and these parts are packed the same way. A part that is still too
   large holds one frequent pair of words; it is dealt out by the third word
   (`plan_groups`).
3. Subtrees: a third scan sends each block's distinct suffixes, with their counts
   and as packed bytes, to their groups. A group sorts its suffixes; runs of
   equal first words are the nodes, and a node's total is the sum of its leaves.
   Only nodes of `min_count` and more leave the task. A pair that was dealt out
   by its third word is summed over its groups (`phrase_counts`).
4. Scores, the containment rule and the first phrases of each language are joins
   and windows over these nodes (`collocations`).

The driver holds class and part totals only: SLOTS, and at most 2 * PARTS * total
/ budget, where budget is at least total / MAX_GROUPS. Blocks are pre-aggregated
before each shuffle, so a word, line or document that fills the table costs one
row per block. Nothing is cached; a lost executor costs repeating its tasks.

Counts are per language; a NULL language is `und`. Null and empty texts have no
words. Repeated rows count each time; an empty table gives no rows; only the two
named columns are read, so others cannot clash. Words and texts have no limit of
length; a block holds BLOCK_BYTES or one longer piece. Equal scores go by count,
then by the bytes of the phrase.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import compress, decompress, persist, tidy

BLOCK_BYTES = 1 << 22
SLOTS = 1 << 16
BUDGET = 1 << 20  # suffixes of a group
MAX_GROUPS = 1 << 20
PARTS = 8  # parts of an extended class per budget
SHARES = 16  # of a language's phrases, ranked by themselves first
BREAKS = b".,;:!?\n\x0b\x0c\r"
_BREAK = re.compile(rb"[.,;:!?\n-\r]")
# ASCII letters to lower case, what ends a piece to a byte that is in no UTF-8 text
CLEAN = bytes(0xff if b in BREAKS else b + 32 if 65 <= b <= 90 else 32 if b == 9 else b
              for b in range(256))


class Block:
    """The suffixes of some texts. words: the distinct words; codes: the words in
    order, -1 at each end of a piece."""

    def __init__(self, texts: Iterable[bytes], max_words: int):
        cleaned = b"\xff".join(t.translate(CLEAN) for t in texts)
        # only spaces are left to split at: all other white space has become 0xff
        listed = pa.array(cleaned.replace(b"\xff", b" \xff ").split(), pa.binary())
        coded = listed.dictionary_encode()
        codes = coded.indices.to_numpy().astype(np.int64)
        self.words: list[bytes] = coded.dictionary.to_pylist()
        if b"\xff" in self.words:
            end = self.words.index(b"\xff")
            codes[codes == end] = -1
        self.codes = np.concatenate([codes, np.full(max_words, -1)])
        self.depth = max_words
        starts = np.flatnonzero(self.codes >= 0)
        self.counts = np.bincount(self.codes[starts], minlength=len(self.words))
        self.starts, self.n = self._distinct(starts)

    def _distinct(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A start and the count of each distinct suffix, in the order of codes."""
        base, key, top = len(self.words) + 1, np.zeros(len(starts), dtype=np.int64), 1
        live = np.ones(len(starts), dtype=bool)
        for k in range(self.depth):
            code = self.codes[starts + k]
            live &= code >= 0
            if top * base >= 1 << 62:  # ranks in place of keys that have become too long
                key = np.unique(key, return_inverse=True)[1]
                top = len(starts)
            key = key * base + np.where(live, code + 1, 0)
            top *= base
        _, first, n = np.unique(key, return_index=True, return_counts=True)
        return starts[first], n

    def suffixes(self) -> np.ndarray:
        """Codes of the distinct suffixes, a row each, -1 behind their end."""
        rows = self.codes[self.starts[:, None] + np.arange(self.depth)]
        return np.where(np.logical_and.accumulate(rows >= 0, axis=1), rows, -1)

    def hashes(self) -> np.ndarray:
        """A hash per word; the last entry stands for the end of a piece."""
        import xxhash
        return np.array([xxhash.xxh64_intdigest(w) for w in self.words] + [0], dtype=np.uint64)


def _pieces(text: bytes) -> Iterator[bytes]:
    """A long text in parts that end where a piece does: no phrase crosses them."""
    lo = 0
    while len(text) - lo > BLOCK_BYTES:
        end = _BREAK.search(text, lo + BLOCK_BYTES)
        if end is None:
            break
        yield text[lo:end.end()]
        lo = end.end()
    if lo < len(text):
        yield text[lo:]


def _blocks(batches: Iterable[pa.RecordBatch], max_words: int) -> Iterator[tuple[str, Block]]:
    """(language, block) over columns (lang, text as binary)."""
    waiting: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}
    total = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            for data in _pieces(text.as_py() or b""):
                waiting.setdefault(lang, []).append(data)
                size[lang] = size.get(lang, 0) + len(data)
                total += len(data)
                if total >= BLOCK_BYTES:
                    # the largest goes, so that what waits stays below the bound
                    full = max(size, key=size.get)
                    total -= size.pop(full)
                    yield full, Block(waiting.pop(full), max_words)
    for lang, texts in waiting.items():
        yield lang, Block(texts, max_words)


def _texts(df: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    return df.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
                     F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"))


def _slots(hashes: np.ndarray, lang: str) -> np.ndarray:
    """Prefix class of each word of a language."""
    import xxhash
    seed = np.uint64(xxhash.xxh64_intdigest(lang.encode()))
    mixed = (hashes ^ seed) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(48)).astype(np.int64) % SLOTS


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, word as binary, slot, f) of every word, written."""
    @tidy
    def run(batches):
        for lang, block in _blocks(batches, 1):
            words = [w for w in block.words if w != b"\xff"]
            n = block.counts if len(words) == len(block.words) else np.delete(
                block.counts, block.words.index(b"\xff"))
            block.words = words
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(words), pa.string()), pa.array(words, pa.binary()),
                 pa.array(_slots(block.hashes()[:-1], lang), pa.int32()), pa.array(n, pa.int64())],
                names=["lang", "word", "slot", "f"])

    found = texts.mapInArrow(run, "lang string, word binary, slot int, f long")
    return persist(found.groupBy("lang", "word").agg(F.first("slot").alias("slot"),
                                                     F.sum("f").alias("f")), "words")


class Groups:
    """Where suffixes go. group[s]: the group of class s, or -1; an extended class
    s has the parts first[s] .. first[s] + parts[s], chosen by the second word;
    part_group and, for parts dealt out by the third word, part_spread."""

    def __init__(self, totals: np.ndarray, budget: int):
        self.budget = max(budget, int(totals.sum()) // MAX_GROUPS)
        large = totals > self.budget
        self.group = np.where(large, -1, _pack(np.where(large, 0, totals), self.budget))
        self.next = int(self.group.max(initial=-1)) + 1
        self.parts = np.where(large, -(-totals // self.budget) * PARTS, 0)
        self.first = np.cumsum(self.parts) - self.parts
        self.part_group = np.zeros(0, dtype=np.int64)
        self.part_spread = np.ones(0, dtype=np.int64)

    def part(self, slots: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Part of suffixes of extended classes, by the hash of their second word."""
        mixed = second * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(20)
        return self.first[slots] + (mixed % self.parts[slots].astype(np.uint64)).astype(np.int64)

    def extend(self, totals: np.ndarray) -> None:
        self.part_spread = np.maximum(1, -(-totals // self.budget))
        packed = _pack(np.where(self.part_spread > 1, 0, totals), self.budget)
        single = self.next + packed
        self.next += int(packed.max(initial=-1)) + 1
        many = np.where(self.part_spread > 1, self.part_spread, 0)
        self.part_group = np.where(self.part_spread > 1, self.next + np.cumsum(many) - many, single)
        self.next += int(many.sum())

    def of(self, slots: np.ndarray, second: np.ndarray, third: np.ndarray) -> np.ndarray:
        found = self.group[slots]
        far = np.flatnonzero(found < 0)
        if len(far):
            part = self.part(slots[far], second[far])
            mixed = third[far] * np.uint64(0x165667B19E3779F9) >> np.uint64(20)
            spread = self.part_spread[part].astype(np.uint64)
            found[far] = self.part_group[part] + (mixed % spread).astype(np.int64)
        return found


def _pack(totals: np.ndarray, budget: int) -> np.ndarray:
    """Group of each class, next fit: neighbours share a group while their totals
    stay within the budget."""
    out, group, used = np.zeros(len(totals), dtype=np.int64), 0, 0
    for i, n in enumerate(totals.tolist()):
        if used and used + n > budget:
            group, used = group + 1, 0
        out[i] = group
        used += n
    return out


def plan_groups(texts: DataFrame, words: DataFrame, max_words: int, budget: int) -> Groups:
    """Group word prefixes so that no group has many more than `budget` suffixes."""
    totals = np.zeros(SLOTS, dtype=np.int64)
    for row in words.groupBy("slot").agg(F.sum("f").alias("n")).collect():  # SLOTS rows at most
        totals[row.slot] = row.n
    groups = Groups(totals, budget)
    if not groups.parts.any():
        return groups
    sent = texts.sparkSession.sparkContext.broadcast(groups)

    @tidy
    def run(batches):
        plan = sent.value
        for lang, block in _blocks(batches, max_words):
            hashes = block.hashes()
            rows = block.suffixes()
            slots = _slots(hashes, lang)[rows[:, 0]]
            far = plan.group[slots] < 0
            second = hashes[rows[far, 1]]
            part, at = np.unique(plan.part(slots[far], second), return_inverse=True)
            n = np.bincount(at, weights=block.n[far], minlength=len(part)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(n, pa.int64())],
                                             names=["part", "n"])

    totals = np.zeros(int(groups.parts.sum()), dtype=np.int64)
    counted = texts.mapInArrow(run, "part long, n long").groupBy("part").agg(F.sum("n").alias("n"))
    for row in counted.collect():  # PARTS * total / budget rows, and one PARTS per class, at most
        totals[row.part] = row.n
    groups.extend(totals)
    return groups


def _send(block: Block, rows: np.ndarray, n: np.ndarray) -> bytes:
    """Suffixes as bytes: their number, the words that occur, codes, counts. One
    suffix takes little more than its words, for where groups are many."""
    used, codes = np.unique(rows, return_inverse=True)
    words = b" ".join([block.words[c] for c in used[used >= 0].tolist()])
    codes = codes.reshape(rows.shape) - int(used[0] < 0)  # -1 stays -1
    return compress(struct.pack("<qq", len(n), len(words)) + words
                    + codes.T.astype("<i4").tobytes() + n.astype("<i8").tobytes())


def _read(sent: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    data = decompress(sent)
    rows, size = struct.unpack_from("<qq", data)
    words, rest = data[16:16 + size].split(b" "), data[16 + size:]
    n = np.frombuffer(rest[-8 * rows:], "<i8")
    return words, np.frombuffer(rest[:-8 * rows], "<i4").reshape(-1, rows), n


def subtree(sent: Iterable[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """The nodes of the tree over some suffixes, depth by depth from 2 on: word
    codes of the nodes (a column each), totals, words."""
    known: dict[bytes, int] = {}
    columns, counts = [], []
    for data in sent:
        words, codes, n = _read(data)
        names = np.array([known.setdefault(w, len(known)) for w in words] + [-1], dtype=np.int64)
        columns.append(names[codes])
        counts.append(n)
    rows, n = np.concatenate(columns, axis=1), np.concatenate(counts)
    order = np.lexsort(rows[::-1])
    rows, n = rows[:, order], n[order]
    words = list(known)
    new = np.zeros(rows.shape[1], dtype=bool)  # a node of this depth begins here
    new[0] = True
    for depth, column in enumerate(rows, start=1):
        new[1:] |= column[1:] != column[:-1]
        if depth > 1:
            first = np.flatnonzero(new)
            totals = np.add.reduceat(n, first)
            real = column[first] >= 0
            yield rows[:depth, first[real]], totals[real], words


def phrase_counts(texts: DataFrame, groups: Groups, max_words: int, min_count: int) -> DataFrame:
    """(lang, phrase, words, f) of all phrases of 2 to `max_words` words that occur
    at least `min_count` times, written."""
    routes = texts.sparkSession.sparkContext.broadcast(groups)

    @tidy
    def send(batches):
        plan = routes.value
        for lang, block in _blocks(batches, max_words):
            hashes, rows = block.hashes(), block.suffixes()
            inner = rows[:, 1] >= 0  # single words are counted
            rows, n = rows[inner], block.n[inner]
            to = plan.of(_slots(hashes, lang)[rows[:, 0]], hashes[rows[:, 1]],
                         hashes[rows[:, min(2, max_words - 1)]])
            order = np.argsort(to, kind="stable")
            first = np.flatnonzero(np.diff(to[order], prepend=-1))
            parts = np.split(order, first[1:]) if len(order) else []
            for lo in range(0, len(parts), 1000):
                some = parts[lo:lo + 1000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([to[part[0]] for part in some], pa.int64()),
                     pa.array([lang] * len(some), pa.string()),
                     pa.array([_send(block, rows[part], n[part]) for part in some], pa.binary())],
                    names=["group", "lang", "sent"])

    spread = groups.part_spread > 1
    several = groups.part_group[spread]
    last = several + groups.part_spread[spread]

    def build(key: tuple, table: pa.Table) -> pa.Table:
        out = {"lang": [], "phrase": [], "words": [], "f": []}
        group, lang = (k.as_py() for k in key)
        shared = bool(((several <= group) & (group < last)).any())
        for rows, totals, words in subtree(table.column("sent").to_pylist()):
            depth = len(rows)
            # a pair that is dealt out by its third word has a part of its count here
            keep = totals >= (1 if shared and depth == 2 else min_count)
            phrases = [b" ".join([words[c] for c in node]).decode()
                       for node in rows[:, keep].T.tolist()]
            out["lang"] += [lang] * len(phrases)
            out["phrase"] += phrases
            out["words"] += [depth] * len(phrases)
            out["f"] += totals[keep].tolist()
        return pa.table(out, schema=NODES)

    sent = texts.mapInArrow(send, "group long, lang string, sent binary")
    nodes = sent.groupBy("group", "lang").applyInArrow(
        build, "lang string, phrase string, words int, f long")
    whole = nodes.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f"))
    return persist(whole.filter(F.col("f") >= min_count), "phrases")


NODES = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()),
                   ("f", pa.int64())])


def collocations(df: DataFrame, lang_col: str = "lang", text_col: str = "text", max_words: int = 3,
                 min_count: int = 10, covered: int = 50, top: int = 2000,
                 budget: int = BUDGET) -> DataFrame:
    """Per language its `top` phrases: lang, rank, phrase, a (count), l and r
    (counts of the parts at the lowest-scoring cut), n (all words of the
    language), score = floor(1000000 * a * a / (l * r)). A phrase goes if some
    longer one that holds it has at least `covered` percent of its count."""
    if max_words < 2:
        raise ValueError("a phrase has two words at least")
    texts = _texts(df, lang_col, text_col)
    words = word_counts(texts)
    groups = plan_groups(texts, words, max_words, budget)
    phrases = phrase_counts(texts, groups, max_words, min_count)
    total = words.groupBy("lang").agg(F.sum("f").alias("n"))
    # Every part of a phrase occurs at least as often as the phrase.
    parts = phrases.select("lang", "phrase", "f").unionByName(
        words.filter(F.col("f") >= min_count)
        .select("lang", F.col("word").cast("string").alias("phrase"), "f"))
    split = phrases.withColumn("w", F.split("phrase", " "))
    cuts = split.select("lang", "phrase", F.col("f").alias("a"), "words", F.explode(F.expr(
        """transform(sequence(1, words - 1), k -> struct(k as k,
             array_join(slice(w, 1, k), ' ') as head,
             array_join(slice(w, k + 1, words - k), ' ') as tail))""")).alias("cut"))
    left = parts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    scored = (cuts.select("lang", "phrase", "a", "cut.*").join(left, ["lang", "head"])
              .join(right, ["lang", "tail"])
              .withColumn("score", exact_score("a", "l", "r")))
    best = (scored.groupBy("lang", "phrase")
            .agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("best"))
            .select("lang", "phrase", "best.score", "best.a", "best.l", "best.r"))
    inside = (split.filter(F.col("words") > 2)
              .select("lang", F.col("f").alias("longer"), F.explode(F.expr(
                  """flatten(transform(sequence(2, words - 1), m ->
                       transform(sequence(1, words - m + 1), i -> array_join(slice(w, i, m), ' '))))"""
              )).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    kept = (best.join(inside, ["lang", "phrase"], "left")
            .filter(F.col("longer").isNull()
                    | (F.lit(100).cast("decimal(20,0)") * F.col("longer")
                       < F.lit(covered).cast("decimal(20,0)") * F.col("a"))))
    # A language's first phrases are among the first of each of its shares, so that
    # the last sort holds SHARES * top phrases of it, however many it has.
    best_first = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    share = F.pmod(F.xxhash64("phrase"), F.lit(SHARES))
    some = kept.withColumn("share", share).withColumn("rank", F.row_number().over(
        Window.partitionBy("lang", "share").orderBy(*best_first))).filter(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(*best_first))).filter(F.col("rank") <= top)
    return (ranked.join(total, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
                    "score"))


def exact_score(a: str, l: str, r: str):
    """floor(1000000 * a * a / (l * r)) for a <= l, r. With x = a * 1000000, the
    products of two counts need up to 126 bits: decimals of 38 digits hold them
    below 10^16, and a quotient of whole decimals is exact."""
    wide = "decimal(38,0)"
    return F.expr(f"""cast((cast({a} as {wide}) * 1000000 * {a}) div
                           (cast({l} as {wide}) * {r}) as bigint)""")
