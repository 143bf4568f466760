"""WARC records in ZIP packages, read by byte ranges.

Writing. Each task streams its pages into one ZIP file: the stored (that is,
uncompressed) member `archive/data.warc` with the records one after another,
and the stored member `indexes/index.csv` with a line per record (offset,
length, id, type, target id). Sizes and offsets of 4 GiB or more are written in
ZIP64 form. Pages with equal payloads are stored once: the page of the smallest
id is a `response` record, every other one a `revisit` record without payload
that refers to it. A response of one archive may be referred to from another.

Reading. The reader never extracts a member. It reads the end of the file,
follows the ZIP64 locator if there is one, parses the central directory, takes
the place of each stored member from its local header, and then reads only the
ranges it is asked for: the index, or single records. Archives are cut into
ranges of records, which are dealt out to tasks.

Payload digests are the SHA-1 of the full payload in base32, as WARC writers
put them into `WARC-Payload-Digest`.

Nulls are empty payloads, and an empty payload takes part like any other;
a null URL is written as an empty one. Rows of the same id and payload: one of
them is the response, the others revisit it. An empty table gives no archive.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import maybe_members, open_shared, persist, read_tasks, scratch_dir

# Fixed values of the ZIP format (APPNOTE 4.3): signatures, and the marks that
# say "see the ZIP64 field".
LOCAL, CENTRAL, END, END64, LOCATOR = (b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06",
                                       b"PK\x06\x06", b"PK\x06\x07")
MARK32, MARK16, STORED = 0xFFFFFFFF, 0xFFFF, 0
FLAGS = 8 | 1 << 11  # sizes and checksum come after the member; names are UTF-8
WARC_MEMBER, INDEX_MEMBER = "archive/data.warc", "indexes/index.csv"
RECORDS_AT_ONCE = 2000  # records of one range that a task reads


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


# ------------------------------------------------------------------ records
def record(kind: str, page: str, url: str, digest: str, payload: bytes,
           refers_to: str | None) -> bytes:
    """One WARC/1.1 record; a revisit has no block."""
    head = [b"WARC/1.1", b"WARC-Type: " + kind.encode(),
            b"WARC-Record-ID: <urn:page:" + page.encode() + b">",
            b"WARC-Target-URI: " + url.encode("utf-8").replace(b"\r", b"").replace(b"\n", b""),
            b"WARC-Payload-Digest: sha1:" + digest.encode()]
    if refers_to is not None:
        head += [b"WARC-Profile: "
                 b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 b"WARC-Refers-To: <urn:page:" + refers_to.encode() + b">"]
        payload = b""
    head.append(b"Content-Length: " + str(len(payload)).encode())
    return b"\r\n".join(head) + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers by lower-case name, block) of one whole record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {}
    for line in lines[1:]:
        name, _, value = line.partition(":")
        headers[name.strip().lower()] = value.strip()
    size = int(headers["content-length"])
    if len(rest) < size + 4 or rest[size:size + 4] != b"\r\n\r\n":
        raise ValueError("a WARC record is cut short")
    return headers, rest[:size]


def _page_of(uri: str) -> str:
    return uri.removeprefix("<urn:page:").removesuffix(">")


# ------------------------------------------------------------------ ZIP
class ZipWriter:
    """Streams stored members; nothing of a member is held. `zip64` forces the
    ZIP64 forms (they are taken anyway where a value needs them)."""

    def __init__(self, out, zip64: bool = False):
        self._out, self._at, self._members, self._force = out, 0, [], zip64

    def _put(self, data: bytes) -> None:
        self._out.write(data)
        self._at += len(data)

    def begin(self, name: str) -> None:
        self._name, self._start = name.encode("utf-8"), self._at
        self._size, self._crc = 0, 0
        self._put(LOCAL + struct.pack("<5H3L2H", 45, FLAGS, STORED, 0, 0x21, 0, 0, 0,
                                      len(self._name), 0) + self._name)

    def write(self, data: bytes) -> None:
        self._crc = zlib.crc32(data, self._crc)
        self._size += len(data)
        self._put(data)

    def finish(self) -> None:
        wide = self._force or self._size >= MARK32
        self._put(b"PK\x07\x08" + struct.pack("<LQQ" if wide else "<LLL", self._crc,
                                              self._size, self._size))
        self._members.append((self._name, self._start, self._size, self._crc))

    def close(self, comment: bytes = b"") -> int:
        """Write the directories; returns the size of the file."""
        first = self._at
        for name, start, size, crc in self._members:
            extra = b""
            wide_size, wide_start = (self._force or size >= MARK32,
                                     self._force or start >= MARK32)
            if wide_size:
                extra += struct.pack("<QQ", size, size)
            if wide_start:
                extra += struct.pack("<Q", start)
            if extra:
                extra = struct.pack("<HH", 1, len(extra)) + extra
            short = MARK32 if wide_size else size
            self._put(CENTRAL + struct.pack(
                "<6H3L5H2L", 45, 45, FLAGS, STORED, 0, 0x21, crc, short, short, len(name),
                len(extra), 0, 0, 0, 0, MARK32 if wide_start else start) + name + extra)
        size, n = self._at - first, len(self._members)
        if self._force or first >= MARK32 or size >= MARK32 or n >= MARK16:
            end64 = self._at
            self._put(END64 + struct.pack("<Q2H2L4Q", 44, 45, 45, 0, 0, n, n, size, first))
            self._put(LOCATOR + struct.pack("<LQL", 0, end64, 1))
        self._put(END + struct.pack(
            "<4H2LH", 0, 0, min(n, MARK16), min(n, MARK16), min(size, MARK32),
            MARK32 if self._force else min(first, MARK32), len(comment)) + comment)
        return self._at


class ZipReader:
    """Members of a ZIP file by ranges. `source` has size() and read_at(n, at)
    (a pyarrow random access file)."""

    def __init__(self, source):
        self._source = source
        self.members = dict(self._directory())

    def _directory(self) -> Iterator[tuple[str, tuple[int, int]]]:
        total = self._source.size()
        tail_at = max(0, total - (1 << 16) - 22)
        tail = self._source.read_at(total - tail_at, tail_at)
        at = tail.rfind(END)
        while at >= 0:  # the comment may hold the signature: its length must fit
            if at + 22 <= len(tail) and at + 22 + struct.unpack_from(
                    "<H", tail, at + 20)[0] == len(tail):
                break
            at = tail.rfind(END, 0, at)
        if at < 0:
            raise ValueError("no end of a central directory: not a ZIP file, or cut short")
        n, size, first = struct.unpack_from("<H2L", tail, at + 10)
        if at >= 20 and tail[at - 20:at - 16] == LOCATOR or (
                MARK32 in (size, first) or n == MARK16) and at + tail_at >= 20:
            locator = self._source.read_at(20, tail_at + at - 20)
            if locator[:4] == LOCATOR:
                end64 = self._source.read_at(56, struct.unpack_from("<Q", locator, 8)[0])
                if end64[:4] != END64:
                    raise ValueError("the ZIP64 end of the central directory is missing")
                n, size, first = struct.unpack_from("<3Q", end64, 32)
        directory, at = self._source.read_at(size, first), 0
        for _ in range(n):
            if directory[at:at + 4] != CENTRAL:
                raise ValueError("the central directory is damaged")
            method = struct.unpack_from("<H", directory, at + 10)[0]
            packed, plain = struct.unpack_from("<2L", directory, at + 20)
            n_name, n_extra, n_comment = struct.unpack_from("<3H", directory, at + 28)
            start = struct.unpack_from("<L", directory, at + 42)[0]
            name = directory[at + 46:at + 46 + n_name].decode("utf-8")
            wide = self._wide(directory[at + 46 + n_name:at + 46 + n_name + n_extra])
            if plain == MARK32:
                plain = next(wide)
            if packed == MARK32:
                packed = next(wide)
            if start == MARK32:
                start = next(wide)
            at += 46 + n_name + n_extra + n_comment
            if method == STORED:
                head = self._source.read_at(30, start)
                if head[:4] != LOCAL:
                    raise ValueError(f"the local header of {name} is missing")
                yield name, (start + 30 + sum(struct.unpack_from("<2H", head, 26)), packed)

    @staticmethod
    def _wide(extra: bytes) -> Iterator[int]:
        """The 64-bit values of the ZIP64 field."""
        at = 0
        while at + 4 <= len(extra):
            kind, size = struct.unpack_from("<HH", extra, at)
            if kind == 1:
                yield from struct.unpack_from(f"<{size // 8}Q", extra, at + 4)
            at += 4 + size

    def read(self, name: str, start: int = 0, size: int | None = None) -> bytes:
        """A range of a stored member."""
        at, whole = self.members[name]
        size = whole - start if size is None else min(size, whole - start)
        return self._source.read_at(size, at + start)


class _Ranges:
    """size() and read_at() over a pyarrow file (whose read_at gives a Buffer
    or bytes by version)."""

    def __init__(self, file):
        self._file = file

    def size(self) -> int:
        return self._file.size()

    def read_at(self, n: int, at: int) -> bytes:
        return bytes(self._file.read_at(n, at))


# ------------------------------------------------------------------ Spark
def _records(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    """(id, url, payload, digest, n). Equal length and SHA-1 stand for equal
    payloads, as in any WARC revisit."""
    url, text = F.col(f"`{url_col}`").cast("string"), F.col(f"`{payload_col}`").cast("string")
    return (pages.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                         F.coalesce(url, F.lit("")).alias("url"),
                         F.encode(F.coalesce(text, F.lit("")), "UTF-8").alias("payload"))
            .withColumn("digest", F.unhex(F.sha1("payload")))
            .withColumn("n", F.octet_length("payload")))


def _with_targets(records: DataFrame, min_bytes: int) -> DataFrame:
    """(id, url, payload, target): the smallest id of the equal payloads, NULL
    for the response itself. Digests meet by partial minima; only payloads that
    occur more than once are joined, and only their pages leave their task. A
    row without id is always a response."""
    light = records.select("id", "digest", "n").filter(f"n >= {min_bytes} and id is not null")
    shared = (light.groupBy("digest", "n").agg(F.min("id").alias("target"),
                                               F.count("*").alias("copies"))
              .filter("copies > 1").drop("copies"))
    targets = persist(light.join(shared, ["digest", "n"]).groupBy("id", "digest", "n").agg(
        F.max("target").alias("target"), F.count("*").alias("same")), "warc-targets")
    flagged = maybe_members(records, "id", targets, "id", "maybe")
    alone = flagged.filter("not maybe or id is null").select(
        "id", "url", "payload", F.lit(None).cast("long").alias("target"))
    near = (flagged.filter("maybe and id is not null").drop("maybe")
            .join(targets, ["id", "digest", "n"], "left"))
    single = near.filter("same is null or same = 1 or id <> target").select(
        "id", "url", "payload", F.expr("if(id = target, null, target)").alias("target"))
    # Rows that repeat the id of their own response: one of them is it.
    first = Window.partitionBy("id", "digest").orderBy("url")
    repeated = (near.filter("same > 1 and id = target").withColumn(
        "k", F.row_number().over(first))
        .select("id", "url", "payload", F.expr("if(k = 1, null, target)").alias("target")))
    return alone.unionByName(single).unionByName(repeated)


def write_archives(pages: DataFrame, id_col: str, url_col: str, payload_col: str, folder: str,
                   min_bytes: int = 0, zip64: bool = False) -> DataFrame:
    """One archive per task under `folder`; payloads of fewer than `min_bytes`
    bytes are always stored. Returns (archive, n_records, n_bytes), written as
    Parquet; an attempt of a task that is not committed leaves at most an
    archive that no row names."""
    joined = _with_targets(_records(pages, id_col, url_col, payload_col), min_bytes)

    def run(batches):
        filesystem, base = open_shared(folder)
        name, out, zipped, index, at, n = f"{uuid.uuid4().hex}.wacz", None, None, io.BytesIO(), 0, 0
        for batch in batches:
            if out is None:
                filesystem.create_dir(base, recursive=True)
                out = filesystem.open_output_stream(f"{base}/{name}")
                zipped = ZipWriter(out, zip64)
                zipped.begin(WARC_MEMBER)
            columns = [batch.column(i) for i in range(batch.num_columns)]
            for i in range(batch.num_rows):
                id_, url, payload, target = (c[i].as_py() for c in columns)
                kind = "response" if target is None else "revisit"
                page = "" if id_ is None else str(id_)
                data = record(kind, page, url, payload_digest(payload), payload,
                              None if target is None else str(target))
                zipped.write(data)
                index.write(f"{at},{len(data)},{page},{kind}\n".encode())
                at += len(data)
                n += 1
        if out is not None:
            zipped.finish()
            zipped.begin(INDEX_MEMBER)
            zipped.write(index.getvalue())
            zipped.finish()
            size = zipped.close()
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([name], pa.string()), pa.array([n], pa.int64()),
                 pa.array([size], pa.int64())], names=["archive", "n_records", "n_bytes"])

    return persist(joined.mapInArrow(run, "archive string, n_records long, n_bytes long"),
                   "warc-archives")


def read_archives(spark: SparkSession, archives: DataFrame, folder: str) -> DataFrame:
    """(id, url, record_type, refers_to, payload_digest, payload) of every record
    of the named archives, payload empty for a revisit. Each archive's index is
    read by its range; ranges of records are dealt out and read one by one."""
    def plan(batches):
        filesystem, base = open_shared(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with filesystem.open_input_file(f"{base}/{name}") as f:
                    package = ZipReader(_Ranges(f))
                    lines = package.read(INDEX_MEMBER).decode().splitlines()
                    first = package.members[WARC_MEMBER][0]
                places = [tuple(map(int, line.split(",")[:2])) for line in lines]
                parts = [places[i:i + RECORDS_AT_ONCE]
                         for i in range(0, len(places), RECORDS_AT_ONCE)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(parts), pa.string()),
                     pa.array([[first + a for a, _ in p] for p in parts], pa.list_(pa.int64())),
                     pa.array([[n for _, n in p] for p in parts], pa.list_(pa.int64()))],
                    names=["archive", "offsets", "sizes"])

    def fetch(batches):
        filesystem, base = open_shared(folder)
        for batch in batches:
            for row in batch.to_pylist():
                out, held = [], 0
                with filesystem.open_input_file(f"{base}/{row['archive']}") as f:
                    for at, size in zip(row["offsets"], row["sizes"]):
                        headers, block = parse_record(bytes(f.read_at(size, at)))
                        page = _page_of(headers["warc-record-id"])
                        target = headers.get("warc-refers-to")
                        out.append((int(page) if page else None, headers["warc-target-uri"],
                                    headers["warc-type"],
                                    None if target is None else int(_page_of(target)),
                                    headers["warc-payload-digest"].removeprefix("sha1:"), block))
                        held += size
                        if held > 1 << 24:
                            yield _record_batch(out)
                            out, held = [], 0
                if out:
                    yield _record_batch(out)

    total = archives.agg(F.sum("n_bytes"), F.count(F.lit(1)), F.sum(
        F.ceil(F.col("n_records") / RECORDS_AT_ONCE))).first()
    n_bytes = total[0] or 0
    ranges = (archives.select("archive")
              .repartition(read_tasks(spark, n_bytes, total[1]), "archive")
              .mapInArrow(plan, "archive string, offsets array<long>, sizes array<long>"))
    return (ranges.repartition(read_tasks(spark, n_bytes, total[2] or 0), "archive", F.expr("offsets[0]"))
            .mapInArrow(fetch, "id long, url string, record_type string, refers_to long,"
                               " payload_digest string, payload binary"))


def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary())
    names = ("id", "url", "record_type", "refers_to", "payload_digest", "payload")
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=list(names))


def round_trip(spark: SparkSession, pages: DataFrame, id_col: str = "page_id",
               url_col: str = "url", payload_col: str = "html", folder: str | None = None
               ) -> DataFrame:
    """Write the archives, read them back: (id_col, payload_bytes,
    payload_digest, record_type, refers_to). The size of a revisit's payload is
    that of the response it refers to, both found in the archives."""
    folder = folder or scratch_dir(spark, "warc")
    archives = write_archives(pages, id_col, url_col, payload_col, folder)
    back = read_archives(spark, archives, folder).select(
        "id", "record_type", "refers_to", "payload_digest",
        F.octet_length("payload").cast("long").alias("n"))
    back = persist(back, "warc-read")
    # Equal digests are equal payloads, and each has one response record; its
    # size answers for all revisits.
    sizes = (back.filter("record_type = 'response'").join(
        back.filter("record_type = 'revisit'").select("payload_digest").distinct(),
        "payload_digest", "left_semi")
        .groupBy("payload_digest").agg(F.max("n").alias("full")))
    responses = back.filter("record_type = 'response'").select(
        "id", F.col("n").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
    revisits = back.filter("record_type = 'revisit'").join(sizes, "payload_digest").select(
        "id", F.col("full").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
    return responses.unionByName(revisits).withColumnRenamed("id", id_col)
