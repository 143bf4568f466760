"""WARC in ZIP: the format, ZIP64, ranges, and the revisits."""
import base64
import hashlib
import io
import zipfile

import pytest

from tidemark.llm import warc


class Source:
    """Counts what is read."""

    def __init__(self, data):
        self.data, self.read = data, 0

    def size(self):
        return len(self.data)

    def read_at(self, n, at):
        self.read += n
        return self.data[at:at + n]


def package(members, zip64=False, comment=b""):
    out = io.BytesIO()
    writer = warc.ZipWriter(out, zip64)
    for name, parts in members.items():
        writer.begin(name)
        for part in parts:
            writer.write(part)
        writer.finish()
    size = writer.close(comment)
    assert size == len(out.getvalue())
    return out.getvalue()


@pytest.mark.parametrize("zip64", [False, True])
@pytest.mark.parametrize("comment", [b"", b"PK\x05\x06 looks like an end " + b"x" * 40])
def test_members_by_ranges(zip64, comment):
    members = {"a/b.warc": [b"x" * 70000, b"yz"], "empty": [], "é": [b"PK\x01\x02"]}
    data = package(members, zip64, comment)
    source = Source(data)
    reader = warc.ZipReader(source)
    assert {n: reader.read(n) for n in reader.members} == {n: b"".join(p) for n, p in members.items()}
    assert reader.read("a/b.warc", 69999, 2) == b"xy" and reader.read("a/b.warc", 70001) == b"z"
    if comment:  # the library looks for the signature alone, and so is misled
        return
    with zipfile.ZipFile(io.BytesIO(data)) as other:
        assert other.testzip() is None
        assert {n: other.read(n) for n in other.namelist()} == {
            n: b"".join(p) for n, p in members.items()}


def test_archives_of_other_writers():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("s", b"stored", zipfile.ZIP_STORED)
        z.writestr("d", b"deflated" * 9, zipfile.ZIP_DEFLATED)
        with z.open("wide", "w", force_zip64=True) as f:
            f.write(b"zip64")
    reader = warc.ZipReader(Source(out.getvalue()))
    assert {n: reader.read(n) for n in reader.members} == {"s": b"stored", "wide": b"zip64"}


def test_a_range_reads_little():
    source = Source(package({"big": [b"q" * 5_000_000]}))
    warc.ZipReader(source).read("big", 1_000_000, 10)
    assert source.read < 70_000


@pytest.mark.parametrize("data", [b"", b"no zip", package({"a": [b"x"]})[:-5]])
def test_broken_packages(data):
    with pytest.raises(ValueError):
        warc.ZipReader(Source(data))


def test_records():
    data = warc.record("response", "7", "http://é/\r\nX: y", "D", b"a\r\n\r\nb", None)
    headers, block = warc.parse_record(data)
    assert block == b"a\r\n\r\nb" and headers["warc-target-uri"] == "http://é/X: y"
    headers, block = warc.parse_record(warc.record("revisit", "8", "u", "D", b"gone", "7"))
    assert block == b"" and headers["warc-refers-to"] == "<urn:page:7>"
    for bad in (data[:-1], b"HTTP/1.1\r\n\r\n"):
        with pytest.raises(ValueError):
            warc.parse_record(bad)


def brute(rows):
    out, first = [], {}
    for i, _, text in rows:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    taken = set()
    for i, _, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        payload = (text or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        main = i is None or (first[text or ""] == i and (text or "") not in taken)
        if i is not None and main:
            taken.add(text or "")
        out.append((i, len(payload), digest, "response" if main else "revisit",
                    None if main else first[text or ""]))
    return sorted(out, key=repr)


def test_round_trip(spark):
    rows = [(5, "u5", "same"), (3, "u3", "same"), (9, "u9", "same"), (4, None, "é alone"),
            (7, "u7", None), (8, "u8", ""), (2, "u2", "x" * 300000), (3, "u3", "same"),
            (4, "again", "same"), (None, "n", "same"), (6, "u6", "same\r\n\r\n")]
    rows += [(100 + i, f"h{i}", "hot") for i in range(400)]
    df = spark.createDataFrame([(*r, "clash") for r in rows],
                               "page_id long, url string, html string, record_type string")
    got = sorted(map(tuple, warc.round_trip(spark, df.repartition(4)).collect()), key=repr)
    assert got == brute(rows)


def test_zip64_archives_and_small_payloads(spark, tmp_path):
    rows = [(1, "a", "tiny"), (2, "b", "tiny"), (3, "c", "large enough"), (4, "d", "large enough")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    archives = warc.write_archives(df, "page_id", "url", "html", str(tmp_path), min_bytes=5,
                                   zip64=True)
    got = {r.id: (r.record_type, r.refers_to, bytes(r.payload), r.url)
           for r in warc.read_archives(spark, archives, str(tmp_path)).collect()}
    assert got == {1: ("response", None, b"tiny", "a"), 2: ("response", None, b"tiny", "b"),
                   3: ("response", None, b"large enough", "c"), 4: ("revisit", 3, b"", "d")}


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(spark, df).collect() == []
