import collections
import glob
import hashlib
import os

import pyarrow.fs as pafs
import pytest

from staffmart.llm import warc
from staffmart.llm.common import shared_path

DDL = "page_id long, url string, html string, digest string, salt int, payload string"


def pages():
    big = "<html>" + "same " * 100
    return [(1, "u1", "<p>one</p>", "x", 1, "y"), (2, None, None, None, None, None), (3, "u\r\n3", big, "x", 1, "y"), (4, "u4", big, "x", 1, "y"), (9, "u9", big, "x", 1, "y"), (9, "u9", big, "x", 1, "y"),
            (3, "u3", big, "x", 1, "y"), (5, "u5", "WARC/1.1\r\n\r\nWARC/1.0\r\n" * 20, "x", 1, "y"), (6, "u6", "é" * 50, "", 0, ""), (7, "u7", "é" * 50, "", 0, ""), (None, "u", "null id", "", 0, ""), (8, "u8", "<p>one</p>", "", 0, ""), (10, "u", "z" * 3_000_000, "", 0, "")]


def want(rows):
    first = {}
    for r in rows:
        b = (r[2] or "").encode()
        if len(b) >= 100:
            first[b] = min(first.get(b, r[0]), r[0])
    out = []
    for r in rows:
        b = (r[2] or "").encode()
        other = first[b] if b in first and first[b] != r[0] else None
        out.append((r[0], len(b), hashlib.sha256(b).hexdigest(), "revisit" if other is not None else "response", other))
    return collections.Counter(out)


def test_round_trip(spark):
    df = spark.createDataFrame(pages(), DDL).repartition(3)
    assert collections.Counter(map(tuple, warc.digest(warc.round_trip(spark, df)).collect())) == want(pages())
    assert warc.digest(warc.round_trip(spark, df.where("false"))).collect() == []


def write_one(spark, compress, n=40):
    rows = spark.createDataFrame([(i, f"u{i}", f"<p>page {i} " + "text " * (20 + i)) for i in range(n)], "page_id long, url string, html string").coalesce(1)
    folder = shared_path(spark, "warc-test")
    warc.write_archives(warc.with_revisits(rows).coalesce(1), folder, compress=compress, file_bytes=1 << 30).collect()
    (path,) = glob.glob(folder.removeprefix("file://") + "/*.warc*")
    return path


def read(path):
    with pafs.LocalFileSystem().open_input_file(path) as f:
        return list(warc.salvage(f))


@pytest.mark.parametrize("compress", [True, False])
def test_salvage(spark, compress, tmp_path):
    path = write_one(spark, compress)
    clean = read(path)
    assert [r["kind"] for r in clean] == ["response"] * 40 and sum(r["bytes"] for r in clean) == os.path.getsize(path)
    data = bytearray(open(path, "rb").read())
    for i in (3, 10, 11, 39):                        # damage inside records, the last one cut off
        at = clean[i]["position"] + clean[i]["bytes"] - 40      # in the payload
        data[at:at + 8] = b"\x00" * 8
    data[clean[20]["position"]:clean[20]["position"]] = b"junk \x1f\x8b\x08 WARC/1.1 junk"
    broken = str(tmp_path / "broken")
    open(broken, "wb").write(bytes(data[:-30]))
    found = read(broken)
    good = [r["page_id"] for r in found if r["kind"] == "response"]
    lost = {clean[i]["page_id"] for i in (3, 10, 11, 39)}
    assert good == [r["page_id"] for r in clean if r["page_id"] not in lost]
    gaps = [r for r in found if r["kind"] == "gap"]
    assert len(gaps) == 4 and all(g["reason"] for g in gaps)
    assert sum(r["bytes"] for r in found) == os.path.getsize(broken)      # every byte is a record's or a gap's
    at = 0
    for r in found:
        assert r["position"] == at
        at += r["bytes"]


def test_gaps_reach_the_table(spark):
    path = write_one(spark, True)
    data = bytearray(open(path, "rb").read())
    data[60:64] = b"\xff\x00\xff\x00"         # in the first member's deflated bytes
    open(path, "wb").write(bytes(data))
    manifest = spark.createDataFrame([(path, len(data), 40)], warc.MANIFEST_DDL)
    kinds = collections.Counter(r.kind for r in warc.read_archives(manifest).collect())
    assert kinds["gap"] == 1 and kinds["response"] == 39


def test_long_plain_header(spark):
    rows = spark.createDataFrame([(1, "u" * 70_000, "<p>one</p>"), (2, "u2", "<p>two</p>")], "page_id long, url string, html string")
    folder = shared_path(spark, "warc-test")
    manifest = warc.write_archives(warc.with_revisits(rows), folder, compress=False)
    back = {r.page_id: (r.kind, len(r.url)) for r in warc.read_archives(manifest).collect()}
    assert back == {1: ("response", 70_000), 2: ("response", 2)}


def test_a_record_that_is_missing_is_told(spark):
    path = write_one(spark, True)
    clean = read(path)
    data = open(path, "rb").read()
    cut = clean[5]["position"]
    open(path, "wb").write(data[:cut] + data[cut + clean[5]["bytes"]:])       # a whole member less: no check of a record fails
    manifest = spark.createDataFrame([(path, len(data), 40)], warc.MANIFEST_DDL)
    records = warc.read_archives(manifest)
    assert [(r.kind, r.reason) for r in records.collect() if r.kind == "gap"] == [("gap", "39 records read, 40 written")]
    with pytest.raises(Exception, match="damaged archive"):
        warc.digest(records).collect()


@pytest.mark.parametrize("junk", [b"WARC/1.1\r\n", b"\x1f\x8b\x08\x00", b"WARC/1.1\r\nb\r\n", b"WARC/1.1\r\n\x1f\x8b\x08\x00"])
def test_false_marks_are_searched_in_linear_time(spark, tmp_path, monkeypatch, junk):
    good = open(write_one(spark, True, 3), "rb").read()
    got = 0
    real = warc._Source.read

    def counted(self, position, n):
        nonlocal got
        out = real(self, position, n)
        got += len(out)
        return out

    monkeypatch.setattr(warc._Source, "read", counted)
    work = []
    for n in (2000, 8000):
        path = str(tmp_path / f"junk{n}")
        open(path, "wb").write(junk * n + good)
        got = 0
        found = read(path)
        assert [r["kind"] for r in found] == ["gap"] + ["response"] * 3 and found[0]["bytes"] == len(junk) * n
        work.append(got)
    assert work[1] < 8 * work[0]
