"""N-gram Jaccard join by vertical partitioning, and its components.

A document is its set of distinct word n-grams (64-bit hashes). Two documents
link when 100 * |A & B| >= percent * |A | B|. The result is the component of
every document: what is reachable by links.

All sets are ordered by one global n-gram order: n-grams that were counted in
many documents ("hot") last, the others by hash. The order is cut into
FRAGMENTS hash ranges and one fragment of hot n-grams; a set is cut into
segments accordingly. The overlap of a pair is counted fragment by fragment
and summed per pair; a pair is given up as soon as the fragments still to come
cannot lift the sum to the bound. Before that a pair is given up if the parity
bitmaps of its sets (two bits per n-gram) differ in too many bits for a link.

Which pairs are counted:

1. Documents with equal sets are one node (128-bit digests; nodes are named by
   64 bits of them). Linked sets share an n-gram among the first
   n - ceil(percent * n / 100) + 1 of each (their prefixes), and the smaller has
   at least percent % of the larger's n-grams.
2. An n-gram in the prefixes of at most HOT nodes gives all its pairs, so at
   most (HOT - 1) / 2 per entry.
3. An n-gram in more prefixes gives a star: every node is paired with one
   centre, that of the fewest rare n-grams (the least edited copy). The nodes around one
   centre are a group. After the links so far are joined into components,
   the nodes of a group outside its largest component are compared with all
   nodes of the group, in blocks of bounded size, each block pair counting the
   overlaps of its documents fragment by fragment. Two nodes of the largest
   component need no comparison: they are connected. So no link that could
   change a component is missed, and no group emits all its pairs.

Hot n-grams are found by counting and are at most MAX_HOT (the proven bound of
what is broadcast); which n-grams are hot changes the work, never the result. Texts are not shuffled: sets are computed where the texts are read, and
those of the nodes to compare are computed again.

Words are runs of bytes other than space and \\x09-\\x0D, with A-Z lowered. Fewer
words than n are one n-gram; null or blank texts have no n-gram, link with
nothing and are their own component. A row's id may repeat: equal texts join,
other texts stay apart as nodes and meet in the id. An empty table gives none. A task
holds the set of the longest text. Only the two named columns are read, so others
cannot clash. Nodes are named by 64 bits: among 10^10 different sets about three pairs
of them share a name and would be joined.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import anti_join, maybe_members, persist, tidy, with_row_key

HOT = 16  # nodes in whose prefixes an n-gram may be before it is treated as a star
MAX_HOT = 1 << 22  # 32 MB
COUNTED = 0.6  # part of the order, from its beginning, whose n-grams are all counted
FRAGMENTS = 4  # hash ranges; the hot fragment comes after them
COUNT_AT_ONCE = 1 << 21  # n-grams counted together
BLOCK_NGRAMS = 100_000  # n-grams of one side of a block pair
MATCHES_AT_ONCE = 1 << 22


# A random-looking number per byte, the same in every worker.
_BYTE = np.array([int.from_bytes(hashlib.blake2b(bytes([b]), digest_size=8).digest(), "little")
                  for b in range(256)], dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2 ** 64
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least n of each."""
    global _powers
    if len(_powers[0]) < n:
        size = max(1 << 16, 1 << n.bit_length())
        inverse = pow(_BASE, -1, 1 << 64)
        _powers = tuple(np.multiply.accumulate(np.concatenate(
            [np.ones(1, np.uint64), np.full(size, x, np.uint64)])) for x in (_BASE, inverse))
    return _powers


def ngrams(text: str | None, n: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams of a text. An n-gram is its
    words joined by single spaces; its hash is that of the bytes as a polynomial
    modulo 2 ** 64, taken from running sums, and mixed with the length."""
    words = text.encode("utf-8").lower().split() if text else []
    if not words:
        return np.empty(0, dtype=np.int64)
    joined = np.frombuffer(b" ".join(words), dtype=np.uint8)
    up, down = _grown(len(joined) + 1)
    sums = np.zeros(len(joined) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[joined] * up[:len(joined)], out=sums[1:])
    blanks = np.flatnonzero(joined == 32)
    ends = np.append(blanks, len(joined))[min(n, len(words)) - 1:]
    starts = np.append(0, blanks + 1)[:len(ends)]
    found = (sums[ends] - sums[starts]) * down[starts]
    found ^= (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        found = (found ^ (found >> np.uint64(shift))) * np.uint64(factor)
    return np.unique((found ^ (found >> np.uint64(31))).view(np.int64))


def parity(grams: np.ndarray) -> bytes:
    """A bitmap of twice as many bits as n-grams or more (a power of two): bit i
    tells whether an odd number of them has i as its last bits."""
    bits = 64
    while bits < 2 * len(grams):
        bits <<= 1
    odd = np.bincount(grams & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def most_overlap(n_a: int, parity_a: bytes, n_b: int, parity_b: bytes) -> int:
    """At least the overlap of two sets: bits that differ, once the larger
    bitmap is folded, are as many n-grams at least that only one of them has."""
    a, b = np.frombuffer(parity_a, np.uint8), np.frombuffer(parity_b, np.uint8)
    while len(a) != len(b):
        if len(a) < len(b):
            a, b = b, a
        a = a[:len(a) // 2] ^ a[len(a) // 2:]
    return (n_a + n_b - int(np.bitwise_count(a ^ b).sum())) // 2


def prefix_length(size: int, percent: int) -> int:
    return size - (percent * size + 99) // 100 + 1


def _is_hot(sorted_hot: np.ndarray, grams: np.ndarray) -> np.ndarray:
    if not len(sorted_hot):
        return np.zeros(len(grams), dtype=bool)
    at = np.searchsorted(sorted_hot, grams)
    at[at == len(sorted_hot)] = 0
    return sorted_hot[at] == grams


def _digest(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def _node(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def _fragment_of(grams: np.ndarray) -> np.ndarray:
    """Hash range of cold n-grams, in their order."""
    step = (1 << 64) // FRAGMENTS
    return ((grams.view(np.uint64) ^ np.uint64(1 << 63)) // np.uint64(step)).astype(np.int64)


# ------------------------------------------------------------------ 1: sets
def hot_ngrams(docs: DataFrame, text_col: str, n: int) -> np.ndarray:
    """N-grams counted in more than HOT documents, or in more than the least power
    of two times HOT that leaves at most MAX_HOT of them. Counts are taken in chunks of a task's documents and summed. Prefixes
    lie at the beginning of the order, so n-grams of its first part are counted
    all; from the rest, what occurs once in a chunk is left out of the sum."""
    begins = np.uint64(int(COUNTED * (1 << 64)))

    @tidy
    def count(batches):
        held, seen, size = [], set(), 0

        def flush():
            grams, times = np.unique(np.concatenate(held), return_counts=True)
            kept = (times > 1) | ((grams.view(np.uint64) ^ np.uint64(1 << 63)) < begins)
            grams, times = grams[kept], times[kept].astype(np.int32)
            for lo in range(0, len(grams), 200_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams[lo:lo + 200_000]), pa.array(times[lo:lo + 200_000])],
                    names=["gram", "times"])

        for batch in batches:
            for text in batch.column(0):
                grams = ngrams(text.as_py(), n)
                key = hash(grams.tobytes())
                if key in seen:
                    continue
                seen.add(key)
                held.append(grams)
                size += len(grams)
                if size >= COUNT_AT_ONCE:
                    yield from flush()
                    held, seen, size = [], set(), 0
        if held:
            yield from flush()

    counted = persist(docs.select(F.col(f"`{text_col}`").cast("string"))
               .mapInArrow(count, "gram long, times int")
               .groupBy("gram").agg(F.sum("times").alias("times"))
               .filter(F.col("times") > HOT), "jaccard-hot")
    least = HOT
    while counted.filter(F.col("times") > least).count() > MAX_HOT:
        least *= 2
    found = counted.filter(F.col("times") > least).select("gram").toArrow().column(0)
    return np.sort(found.to_numpy().astype(np.int64))


def signatures(docs: DataFrame, id_col: str, text_col: str, n: int, percent: int,
               hot: np.ndarray) -> DataFrame:
    """Per document: id, set size, node, number of cold n-grams, parity bitmap,
    and the cold and hot part of its prefix (packed 64-bit hashes)."""
    kind = dict(docs.dtypes)[id_col]
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    @tidy
    def run(batches):
        hot = shared.value
        for batch in batches:
            sizes, nodes, colds, bitmaps, cold_parts, hot_parts = [], [], [], [], [], []
            for text in batch.column(1):
                grams = ngrams(text.as_py(), n)
                warm = _is_hot(hot, grams)
                cold, take = grams[~warm], prefix_length(len(grams), percent)
                take = take if len(grams) else 0
                sizes.append(len(grams))
                nodes.append(_node(_digest(grams)) if len(grams) else None)
                colds.append(len(cold))
                bitmaps.append(parity(grams))
                cold_parts.append(cold[:take].tobytes())
                hot_parts.append(grams[warm][:max(0, take - len(cold))].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int32()), pa.array(nodes, pa.int64()),
                 pa.array(colds, pa.int32()), pa.array(bitmaps, pa.binary()),
                 pa.array(cold_parts, pa.binary()), pa.array(hot_parts, pa.binary())],
                names=["id", "n", "node", "n_cold", "parity", "cold", "hot"])

    return docs.select(F.col(f"`{id_col}`").alias("id"),
                       F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(
        run, f"id {kind}, n int, node long, n_cold int, parity binary, cold binary, hot binary")


# ------------------------------------------------------------------ 2: candidates
def _entries(nodes: DataFrame, part: str, size: str) -> DataFrame:
    """(gram, node, size): one row per n-gram of that part of the prefix."""
    @tidy
    def run(batches):
        for batch in batches:
            grams = [np.frombuffer(x.as_py(), dtype=np.int64) for x in batch.column(2)]
            times = np.array([len(g) for g in grams], dtype=np.int64)
            columns = [np.repeat(batch.column(i).to_numpy(zero_copy_only=False), times)
                       for i in range(2)]
            flat = np.concatenate(grams) if grams else np.empty(0, np.int64)
            for lo in range(0, len(flat), 200_000):
                cut = slice(lo, lo + 200_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(flat[cut]), *(pa.array(c[cut]) for c in columns)],
                    names=["gram", "node", "size"])

    return (nodes.select("node", size, part).filter(F.octet_length(part) > 0)
            .mapInArrow(run, "gram long, node long, size int"))


def _pairs_of(gram, node, size, percent):
    """All pairs of equal n-grams in sorted arrays that pass the size bound."""
    left, right = [], []
    for step in range(1, HOT):
        at = np.flatnonzero(gram[:-step] == gram[step:]) if step < len(gram) else []
        if not len(at):
            break
        a, b = size[at], size[at + step]
        at = at[(100 * np.minimum(a, b) >= percent * np.maximum(a, b))
                & (node[at] != node[at + step])]
        left.append(node[at])
        right.append(node[at + step])
    if not left:
        return np.empty((0, 2), np.int64)
    a, b = np.concatenate(left), np.concatenate(right)
    return np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)


def _cold_candidates(nodes: DataFrame, percent: int) -> DataFrame:
    """(a, b, star): pairs of n-grams in at most HOT prefixes; for others the
    pairs with the centre a, the first node."""
    @tidy
    def run(batches) -> Iterator[pa.RecordBatch]:
        held = np.empty((0, 3), np.int64)  # rows of the last n-gram seen
        star = False  # it has more than HOT rows; held is its centre

        def out(pairs, is_star):
            return pa.RecordBatch.from_arrays(
                [pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy()),
                 pa.array(np.full(len(pairs), is_star))], names=["a", "b", "star"])

        def with_centre(rows, centre):
            others = np.unique(rows[:, 1])
            others = others[others != centre]
            return np.stack([np.full(len(others), centre), others], axis=1)

        for batch in batches:
            if not batch.num_rows:
                continue
            new = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64)
                            for i in range(3)], axis=1)
            if star:
                same = new[:, 0] == held[0, 0]
                if same.any():
                    yield out(with_centre(new[same], held[0, 1]), True)
                    new = new[~same]
                if not len(new):
                    continue
                held, star = np.empty((0, 3), np.int64), False
            rows = np.concatenate([held, new])
            first = np.flatnonzero(np.concatenate([[True], rows[1:, 0] != rows[:-1, 0]]))
            count = np.diff(np.concatenate([first, [len(rows)]]))
            done = count <= HOT
            done[-1] = False
            small = np.repeat(done & (count > 1), count)
            pairs = _pairs_of(*rows[small].T, percent)
            if len(pairs):
                yield out(pairs, False)
            for i in np.flatnonzero(count > HOT):
                bucket = rows[first[i]:first[i] + count[i]]
                yield out(with_centre(bucket, bucket[0, 1]), True)
            star = count[-1] > HOT
            held = rows[first[-1]:first[-1] + 1] if star else rows[first[-1]:]
        if not star and len(held) > 1:
            pairs = _pairs_of(*held.T, percent)
            if len(pairs):
                yield out(pairs, False)

    return (_entries(nodes, "cold", "n").repartition("gram")
            .sortWithinPartitions("gram", "node")
            .mapInArrow(run, "a long, b long, star boolean"))


def _hot_stars(nodes: DataFrame) -> DataFrame:
    """(a, b): centre and node of every hot n-gram, the centre with itself too.
    Centres meet by partial minima; AQE splits an n-gram of many nodes."""
    entries = _entries(nodes, "hot", "n_cold")
    centres = entries.groupBy("gram").agg(F.min(F.struct("size", "node")).alias("c")).select(
        "gram", F.col("c.node").alias("a"))
    return (entries.join(centres, "gram")
            .select("a", F.col("node").alias("b")).distinct())


def _possible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sizes and parity bitmaps allow a link."""
    def side(name: str) -> DataFrame:
        return nodes.select(F.col("node").alias(name), F.col("n").alias(f"n_{name}"),
                            F.col("parity").alias(f"parity_{name}"))

    both = (pairs.join(side("a"), "a").join(side("b"), "b")
            .filter(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
            .select("a", "b", "n_a", "n_b", "parity_a", "parity_b"))

    @tidy
    def run(batches):
        for batch in batches:
            n_a, n_b = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            fits = [(100 + percent) * most_overlap(x, p.as_py(), y, q.as_py()) >= percent * (x + y)
                    for x, y, p, q in zip(n_a, n_b, batch.column(4), batch.column(5))]
            keep = pa.array(np.flatnonzero(fits))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(keep), batch.column(1).take(keep)], names=["a", "b"])

    return both.mapInArrow(run, "a long, b long")


# ------------------------------------------------------------------ 3: overlaps
def _segments(docs: DataFrame, id_col: str, text_col: str, n: int, hot: np.ndarray,
              chosen: DataFrame, known: DataFrame) -> DataFrame:
    """(node, n, fragment, size, grams) of the chosen nodes, one row per
    fragment. `known` says which document has which node."""
    ids = (known.join(chosen, "node").groupBy("node").agg(F.min("id").alias("id"))
           .select("id").filter("id is not null"))
    shared = docs.sparkSession.sparkContext.broadcast(hot)
    near = maybe_members(
        docs.select(F.col(f"`{id_col}`").alias("id"),
                    F.col(f"`{text_col}`").cast("string").alias("text")), "id", ids, "id",
        "maybe").filter("maybe or id is null").select("text")

    @tidy
    def run(batches):
        hot, names = shared.value, ["node", "n", "fragment", "size", "grams"]
        for batch in batches:
            rows = []
            for text in batch.column(0):
                grams = ngrams(text.as_py(), n)
                if not len(grams):
                    continue
                node, warm = _node(_digest(grams)), _is_hot(hot, grams)
                cold = grams[~warm]
                cuts = np.searchsorted(_fragment_of(cold), np.arange(FRAGMENTS + 1))
                parts = [cold[a:b] for a, b in zip(cuts[:-1], cuts[1:])] + [grams[warm]]
                rows += [(node, len(grams), f, len(p), p.tobytes()) for f, p in enumerate(parts)]
                if len(rows) >= 2000:
                    yield _batch(rows, names)
                    rows = []
            if rows:
                yield _batch(rows, names)

    found = near.mapInArrow(run, "node long, n int, fragment int, size int, grams binary")
    return found.join(chosen, "node", "left_semi").dropDuplicates(["node", "fragment"])


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)


def _partial_overlaps(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """(a, b, n_a, n_b, rest_a, rest_b, overlap) per pair and fragment of
    `segments`: the overlap of the segments, and what both have elsewhere."""
    def side(name: str) -> DataFrame:
        return segments.select(
            F.col("node").alias(name), F.col("fragment").alias(f"f_{name}"),
            F.col("n").alias(f"n_{name}"), (F.col("n") - F.col("size")).alias(f"rest_{name}"),
            F.col("grams").alias(f"grams_{name}"))

    left = pairs.join(side("a"), "a")
    both = left.join(side("b").withColumnRenamed("b", "b2"),
                     (F.col("b") == F.col("b2")) & (F.col("f_a") == F.col("f_b")))

    @tidy
    def run(batches):
        for batch in batches:
            overlap = [len(np.intersect1d(np.frombuffer(x.as_py(), np.int64),
                                          np.frombuffer(y.as_py(), np.int64), assume_unique=True))
                       for x, y in zip(batch.column(6), batch.column(7))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:6], pa.array(overlap, pa.int32())],
                names=["a", "b", "n_a", "n_b", "rest_a", "rest_b", "overlap"])

    return both.select("a", "b", "n_a", "n_b", "rest_a", "rest_b", "grams_a",
                       "grams_b").mapInArrow(
        run, "a long, b long, n_a int, n_b int, rest_a int, rest_b int, overlap int")


def _verified(pairs: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """Linked pairs (a, b): the first fragment is counted for all pairs, the
    others for those that can still reach the bound; partial overlaps are
    summed per pair."""
    reach = f"(100 + {percent}) * {{}} >= {percent} * (n_a + n_b)"
    first = persist(
        _partial_overlaps(pairs, segments.filter("fragment = 0"))
        .filter(reach.format("(overlap + least(rest_a, rest_b))")), "jaccard-first")
    rest = _partial_overlaps(first.select("a", "b"), segments.filter("fragment > 0"))
    summed = (first.select("a", "b", "n_a", "n_b", "overlap")
              .unionByName(rest.select("a", "b", "n_a", "n_b", "overlap"))
              .groupBy("a", "b", "n_a", "n_b").agg(F.sum("overlap").alias("overlap")))
    return summed.filter(reach.format("overlap")).select("a", "b")


def _block_links(groups: DataFrame, labels: DataFrame, segments: DataFrame,
                 percent: int) -> DataFrame:
    """Links (a, b) between the nodes of a group outside its largest component
    and all nodes of the group: for each such node one link into every
    component it has links with."""
    members = groups.join(labels, groups["node"] == labels["l_node"], "left").select(
        "centre", "node", F.coalesce("label", "node").alias("label"))
    sized = members.groupBy("centre", "label").agg(F.count("*").alias("size"))
    largest = sized.groupBy("centre").agg(
        F.max(F.struct("size", "label")).alias("m"), F.count("*").alias("parts")).filter(
        "parts > 1").select("centre", F.col("m.label").alias("main"))
    members = persist(
        members.join(largest, "centre").join(
            segments.filter("fragment = 0").select("node", "n"), "node")
        .withColumn("away", F.col("label") != F.col("main")).drop("main"), "jaccard-groups")
    counts = members.groupBy("centre").agg(
        F.ceil(F.sum("n") / BLOCK_NGRAMS).alias("blocks"),
        F.ceil(F.sum(F.expr("if(away, n, 0)")) / BLOCK_NGRAMS).alias("away_blocks"))
    placed = members.join(counts, "centre")
    hashed = F.xxhash64("node")
    whole = placed.select(
        "centre", "node", "label", F.pmod(hashed, "blocks").alias("block"), F.lit(False).alias("q"),
        F.explode(F.expr("sequence(0L, away_blocks - 1)")).alias("away_block"))
    queries = placed.filter("away").select(
        "centre", "node", "label", F.explode(F.expr("sequence(0L, blocks - 1)")).alias("block"),
        F.lit(True).alias("q"), F.pmod(hashed, "away_blocks").alias("away_block"))
    rows = whole.unionByName(queries).join(
        segments.select("node", "n", "fragment", "grams"), "node")

    def compare(key, frame):
        return _compare_block(frame, percent)

    return rows.groupBy("centre", "block", "away_block").applyInPandas(compare, "a long, b long")


def _compare_block(frame, percent: int):
    """Overlaps of the queries with the other rows of a block, fragment by
    fragment, summed in a table of counts."""
    import pandas as pd
    sides = []
    for q in (True, False):
        part = frame[frame["q"] == q]
        nodes = part.drop_duplicates("node").sort_values("node")
        sides.append((part, nodes["node"].to_numpy(), nodes["n"].to_numpy(np.int64),
                      nodes["label"].to_numpy()))
    (part_q, node_q, n_q, label_q), (part_d, node_d, n_d, label_d) = sides
    total = np.zeros((len(node_q), len(node_d)), dtype=np.int32)
    for fragment in range(FRAGMENTS + 1):
        rows_d = part_d[part_d["fragment"] == fragment]
        grams_d = [np.frombuffer(x, np.int64) for x in rows_d["grams"]]
        if not grams_d:
            continue
        owner = np.repeat(np.searchsorted(node_d, rows_d["node"].to_numpy()),
                          [len(g) for g in grams_d])
        flat = np.concatenate(grams_d)
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        rows_q = part_q[part_q["fragment"] == fragment]
        for node, raw in zip(rows_q["node"].to_numpy(), rows_q["grams"]):
            grams = np.frombuffer(raw, np.int64)
            low, high = np.searchsorted(flat, grams, "left"), np.searchsorted(flat, grams, "right")
            row = total[np.searchsorted(node_q, node)]
            # Matches of one n-gram with many documents are added in bounded runs.
            times = high - low
            runs = np.cumsum(times) // MATCHES_AT_ONCE
            for k in range(int(runs[-1]) + 1 if len(runs) else 0):
                lo, n = low[runs == k], times[runs == k]
                at = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                row += np.bincount(owner[at], minlength=len(row)).astype(np.int32)
    links = []
    for i, node in enumerate(node_q):
        ok = np.flatnonzero(((100 + percent) * total[i].astype(np.int64)
                             >= percent * (n_q[i] + n_d)) & (label_d != label_q[i]))
        _, one = np.unique(label_d[ok], return_index=True)
        links += [(node, node_d[j]) for j in ok[one]]
    return pd.DataFrame(links, columns=["a", "b"]).astype("int64")


# ------------------------------------------------------------------ components
def connected_components(edges: DataFrame) -> DataFrame:
    """(l_node, label): the smallest node of each node's component, for all
    nodes with an edge (a, b). Large-star and small-star steps alternate, each
    round written to the shared folder, until every node has one edge, to the
    centre of a star. An edge always points to the smaller node."""
    now = persist(edges.filter("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    while not _stars_only(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.filter("v > u").join(least, "u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                              F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")
        ).select("e.u", "e.v").filter("u <> v").distinct()
        now = persist(small, "cc")
    return now.select(F.col("u").alias("l_node"), F.col("v").alias("label")).unionByName(
        now.select(F.col("v").alias("l_node"), F.col("v").alias("label")).distinct())


def _stars_only(edges: DataFrame) -> bool:
    """No node has two edges to smaller ones, and no centre has any."""
    ends = edges.select("u", F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("u"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter(
        "up + down > 1").isEmpty()


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                percent: int = 80) -> DataFrame:
    """The rows of `docs` of which each component keeps one, all columns as they
    are: the row of the smallest id that is not null, the first of equal ones.
    Rows are told apart by where they stand, so repeated and null ids are rows like
    others. Rows without words are near copies of nothing and stay."""
    keyed = with_row_key(docs)
    named = keyed.withColumn("__id", F.struct(
        F.col(f"`{id_col}`").isNull().alias("lost"), F.col(f"`{id_col}`").alias("id"),
        F.col("__row").alias("row")))
    found = near_duplicates(named.select("__id", text_col), "__id", text_col, words, percent)
    copies = persist(found.filter("__id <> component_id").select("__id.row"), "near-copies")
    return anti_join(keyed, "__row", copies, "row").drop("__row")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words: int = 5, percent: int = 80) -> DataFrame:
    """(id_col, n_shingles, component_id) for every row of `docs`: the size of
    its set, and the smallest id reachable by links, itself included."""
    hot = hot_ngrams(docs, text_col, words)
    known = persist(signatures(docs, id_col, text_col, words, percent, hot).withColumn(
        "row", F.monotonically_increasing_id()), "jaccard-sets")
    # One row per node. Only rows of equal sets move.
    firsts = known.filter("n > 0").groupBy("node").agg(
        F.min("row").alias("first"), F.count("*").alias("rows")).filter("rows > 1")
    copies = persist(known.select("node", "row").join(firsts, "node").filter("row > first")
                     .select("row"), "jaccard-copies")
    nodes = anti_join(known.filter("n > 0"), "row", copies, "row")
    cold = persist(_cold_candidates(nodes, percent).distinct(), "jaccard-candidates")
    stars = persist(
        cold.filter("star").select("a", "b").unionByName(_hot_stars(nodes)).distinct(),
        "jaccard-stars")
    pairs = cold.filter("not star").select("a", "b").unionByName(
        stars.filter("a <> b").select(F.least("a", "b").alias("a"),
                                      F.greatest("a", "b").alias("b"))).distinct()
    pairs = persist(_possible(pairs, nodes, percent), "jaccard-pairs")
    light = known.select("id", "n", "node")
    chosen = persist(
        pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(
            stars.select("a")).union(stars.select("b")).distinct(), "jaccard-nodes")
    segments = persist(_segments(docs, id_col, text_col, words, hot, chosen, light),
                       "jaccard-segments")
    links = persist(_verified(pairs, segments, percent), "jaccard-links")
    labels = connected_components(links)
    groups = stars.filter("a <> b").select(F.col("a").alias("centre"), F.col("b").alias("node"))
    groups = groups.union(groups.select("centre", "centre")).distinct()
    more = persist(_block_links(groups, labels, segments, percent), "jaccard-block-links")

    # Links found in blocks join the components found before.
    def of(name: str) -> DataFrame:
        return labels.select(F.col("l_node").alias(name), F.col("label").alias(f"label_{name}"))

    joins = more.join(of("a"), "a", "left").join(of("b"), "b", "left").select(
        F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b"))
    merged = connected_components(joins).select(F.col("l_node").alias("part"),
                                                F.col("label").alias("whole"))
    ends = labels.select("l_node", "label").unionByName(
        more.select(F.explode(F.array("a", "b")).alias("l_node")).distinct()
        .join(labels, "l_node", "left_anti").select("l_node", F.col("l_node").alias("label")))
    final = ends.join(merged, F.col("label") == F.col("part"), "left").select(
        "l_node", F.coalesce("whole", "label").alias("label"))

    named = light.join(final, light["node"] == final["l_node"], "left").select(
        "id", "n", F.coalesce("label", "node").alias("key"))
    smallest = named.filter("key is not null").groupBy("key").agg(F.min("id").alias("smallest"))
    return named.join(smallest, "key", "left").select(
        F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"),
        F.expr("if(n = 0, id, smallest)").alias("component_id"))
