"""URL rules by a sort-merge range join.

A rule is (host, path, verdict). It fits a url whose host is the rule's host or
a subdomain of it, and whose path starts with the rule's path. The longest rule
wins: first the longest host, then the longest path.

Written from its last label to its first, with a closing dot, a host is a
string key ("de.example." for example.de), and a host with all its subdomains
is the interval of keys that begin with the host's key. Intervals of hosts are
either nested or apart. So urls and rules are put on one axis of keys:

* pivots (quantiles of the urls' keys) cut the axis into as many pieces as
  there are tasks' worth of rows; a key that fills several quantiles (a hot
  host) gets that many pieces, among which its rows are dealt;
* a url goes to its piece, a rule to every piece its interval touches; a pivot
  lies in at most as many rules as its host has labels, so the copies are
  bounded by rules + pivots * labels;
* each piece is sorted by key and swept once: a stack holds the rules whose
  interval contains the current key, the innermost on top. Rules of one host
  share a frame, in which the rules' paths are intervals again (of path
  strings), looked up by binary search and their chain of enclosing paths.

The sweep streams: it holds the stack and one batch. A piece with a hot key
is as large as any other.

Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased;
path: from there up to `?`, `#` or the end. A url that is null or has no `://`
has an empty host and an empty path, fits no rule and gets the default verdict.
Of equal rules, "block" wins over "allow" (the smaller word). Repeated rows are judged
each by itself; an empty table gives no rows, and without rules every url gets the
default. Urls have no limit of length: a task holds the longest one. Only the two
named columns are read, so others cannot clash.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

ROWS_PER_PIECE = 100_000
MAX_PIECES = 10_000  # the driver holds about 20 keys per piece, tasks one


def host_key(host):
    """Column: labels from last to first, each closed by a dot."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def split_url(df: DataFrame, url_col: str) -> DataFrame:
    """`df` with `host` and `path`."""
    url = F.col(f"`{url_col}`")
    rest = F.when(url.contains("://"),
                  F.expr(f"substring(`{url_col}`, instr(`{url_col}`, '://') + 3)")).otherwise("")
    host = F.regexp_extract(F.col("__rest"), r"^([^/?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return (df.withColumn("__rest", F.coalesce(rest, F.lit("")))
            .withColumn("host", lower)
            .withColumn("path", F.regexp_extract("__rest", r"^[^/?#]*([^?#]*)", 1))
            .drop("__rest"))


def apply_rules(spark: SparkSession, urls: DataFrame, rules: DataFrame, id_col: str = "page_id",
                url_col: str = "url", default: str = "allow", pieces: int | None = None
                ) -> DataFrame:
    """(id_col, host, path, rule, verdict) for every row of `urls`. rules:
    (host, path, verdict), any number. rule: host and path of the rule that
    decides, NULL if none fits."""
    kind = dict(urls.dtypes)[id_col]
    id_type = to_arrow_type(urls.schema[id_col].dataType)
    parts = split_url(urls.select(F.col(f"`{id_col}`").alias("id"),
                                  F.col(f"`{url_col}`").cast("string").alias("__url")), "__url")
    keyed = parts.select("id", "host", "path", host_key(F.col("host")).alias("key"))
    rules = (rules.filter("host is not null and host <> ''")
             .select(F.lower("host").alias("host"), F.coalesce("path", F.lit("")).alias("path"),
                     "verdict")
             .groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
             .withColumn("key", host_key(F.col("host"))))

    n = keyed.count()
    if pieces is None:
        pieces = min(MAX_PIECES, max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                                     n // ROWS_PER_PIECE + 1))
    names, spans = _axis(_pivots(keyed, pieces, n))
    axis = spark.sparkContext.broadcast((names, spans))

    # Pieces are found per row by binary search over the pivots.
    def place_urls(batches):
        names, spans = axis.value
        for batch in batches:
            out = []
            for key, mix in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                first, parts = spans[_slot(names, key)]
                out.append(first + mix % parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out, pa.int32()), pa.array([1] * len(out), pa.int32()),
                 *batch.columns[:4], pa.nulls(len(out), pa.string())],
                names=["piece", "kind", "id", "host", "path", "key", "verdict"])

    def place_rules(batches):
        names, spans = axis.value
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                key = row["key"]
                low, high = _slot(names, key), _slot(names, key + "\U0010ffff")
                last, n = spans[high]
                out += [(p, 0, None, row["host"], row["path"], key, row["verdict"])
                        for p in range(spans[low][0], last + n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate(
                    (pa.int32(), pa.int32(), id_type, pa.string(), pa.string(), pa.string(),
                     pa.string()))],
                names=["piece", "kind", "id", "host", "path", "key", "verdict"])

    schema = (f"piece int, kind int, id {kind}, host string, path string, key string,"
              " verdict string")
    rows = (keyed.select("id", "host", "path", "key", F.pmod(F.hash("id", "path"), F.lit(1 << 30)).alias("mix"))
            .mapInArrow(place_urls, schema)
            .unionByName(rules.mapInArrow(place_rules, schema)))
    swept = (rows.repartition(sum(spans[-1]), "piece")
             .sortWithinPartitions("piece", "key", "kind", "path"))

    def sweep(batches):
        piece, stack = None, []
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in (0, 1, 3, 4, 5, 6)]
            keep, found, verdicts = [], [], []
            for i, (p, kind_, host, path, key, verdict) in enumerate(zip(*columns)):
                if p != piece:
                    piece, stack = p, []
                while stack and not key.startswith(stack[-1].key):
                    stack.pop()
                if kind_ == 0:
                    if not stack or stack[-1].key != key:
                        stack.append(Frame(key, host))
                    stack[-1].add(path, verdict)
                    continue
                keep.append(i)
                for frame in reversed(stack):
                    hit = frame.find(path)
                    if hit is not None:
                        found.append(hit[0])
                        verdicts.append(hit[1])
                        break
                else:
                    found.append(None)
                    verdicts.append(default)
            take = pa.array(keep, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(2).take(take), batch.column(3).take(take),
                 batch.column(4).take(take), pa.array(found, pa.string()),
                 pa.array(verdicts, pa.string())],
                names=[id_col, "host", "path", "rule", "verdict"])

    return swept.mapInArrow(
        sweep, f"`{id_col}` {kind}, host string, path string, rule string, verdict string")


class Frame:
    """The rules of one host: paths in order, each with its enclosing path."""

    def __init__(self, key: str, host: str):
        self.key, self.host = key, host
        self.paths: list[str] = []
        self.verdicts: list[str] = []
        self.outer: list[int] = []

    def add(self, path: str, verdict: str) -> None:
        """Paths arrive in order."""
        at = len(self.paths) - 1
        while at >= 0 and not path.startswith(self.paths[at]):
            at = self.outer[at]
        self.paths.append(path)
        self.verdicts.append(verdict)
        self.outer.append(at)

    def find(self, path: str) -> tuple[str, str] | None:
        at = bisect_right(self.paths, path) - 1
        while at >= 0 and not path.startswith(self.paths[at]):
            at = self.outer[at]
        return (self.host + self.paths[at], self.verdicts[at]) if at >= 0 else None


def _pivots(keyed: DataFrame, pieces: int, n: int) -> list[str]:
    """pieces - 1 keys of the urls in order, about evenly apart by rows; a key
    that holds several parts of the rows is listed as often. Taken from a
    uniform sample of about 20 rows per piece: pivots only balance the work."""
    if pieces <= 1 or not n:
        return []
    share = min(1.0, 20.0 * pieces / n)
    sample = keyed if share >= 1.0 else keyed.sample(share, seed=7)
    keys = sorted(r[0] for r in sample.select("key").collect())
    return [keys[len(keys) * i // pieces] for i in range(1, pieces)] if keys else []


def _axis(pivots: list[str]) -> tuple[list[str], list[tuple[int, int]]]:
    """Distinct pivots, and for every slot of the axis (before the first pivot,
    at it, between it and the next, ...) its first piece and its number of
    pieces: as many as the pivot is listed, else one."""
    names, spans, piece = [], [(0, 1)], 1
    for name, times in sorted(Counter(pivots).items()):
        names.append(name)
        spans += [(piece, times), (piece + times, 1)]
        piece += times + 1
    return names, spans


def _slot(names: list[str], key: str) -> int:
    """Slot of a key: 0 before the first pivot, 2i - 1 at pivot i, 2i after it."""
    at = bisect_right(names, key)
    return 2 * at - 1 if at and names[at - 1] == key else 2 * at
