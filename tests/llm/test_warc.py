from __future__ import annotations

import gzip
import hashlib
import io
import random

import pytest

from scanyard.llm import warc
from scanyard.llm.warc import Gap, Record, Salvage, member, record, sha1_text


class Bytes(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def salvage(data, **options):
    return list(Salvage(Bytes(data), **options))


def one(n, packed=True, size=300):
    body = bytes(random.Random(n).randbytes(size))
    data = record("response", f"urn:page:{n}", f"http://x/{n}", body, sha1_text(body))
    return member(data) if packed else data


def names(found):
    return [r.headers.get("warc-record-id") if isinstance(r, Record) else (r.offset, r.length)
            for r in found]


@pytest.mark.parametrize("packed", [True, False])
def test_round_trip(packed):
    data = b"".join(one(n, packed) for n in range(5))
    found = salvage(data)
    assert names(found) == [f"<urn:page:{n}>" for n in range(5)]
    assert [r.payload for r in found] == [random.Random(n).randbytes(300) for n in range(5)]
    assert found[0].offset == 0 and found[-1].offset + found[-1].length == len(data)
    if packed:
        assert gzip.decompress(data).count(b"WARC/1.0\r\n") == 5


@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("place", [0, 1, 5, 30, 150, 400, -30, -5, -1])
def test_a_changed_byte_loses_one_record_and_is_logged(packed, place):
    parts = [one(n, packed) for n in range(3)]
    middle = bytearray(parts[1])
    middle[place] ^= 0xFF
    data = parts[0] + bytes(middle) + parts[2]
    found = salvage(data)
    assert names(found)[0] == "<urn:page:0>" and names(found)[-1] == "<urn:page:2>"
    gaps = [g for g in found if isinstance(g, Gap)]
    # Every byte outside the records is in a gap, unless the byte was of no account.
    covered = sum(x.length for x in found)
    assert covered == len(data) and (gaps or len(found) == 3)
    assert all(g.reason for g in gaps)


@pytest.mark.parametrize("junk", [b"junk", b"\x1f\x8b\x08junk", b"WARC/1.0\r\n", b"WARC/1.0 x",
                                  b"\x00" * 300_000])
def test_junk_between_records_is_a_gap(junk):
    for packed in (True, False):
        a, b = one(1, packed), one(2, packed)
        assert names(salvage(junk + a + junk + b + junk)) == [
            (0, len(junk)), "<urn:page:1>", (len(junk) + len(a), len(junk)), "<urn:page:2>",
            (2 * len(junk) + len(a) + len(b), len(junk))]


def test_cut_files_and_mixed_forms():
    assert salvage(b"") == []
    whole = one(1) + one(2, False) + one(3)
    assert names(salvage(whole)) == [f"<urn:page:{n}>" for n in (1, 2, 3)]
    for cut in range(1, len(one(3)), 37):
        found = salvage(whole[:-cut])
        assert names(found)[:2] == ["<urn:page:1>", "<urn:page:2>"]
        assert isinstance(found[-1], Gap)


def test_records_of_a_broken_member_are_kept():
    several = bytearray(gzip.compress(one(1, False, 2000) + one(2, False, 400_000)))
    several[-6] ^= 1
    found = salvage(bytes(several) + one(3))
    assert names(found)[0] == "<urn:page:1>" and names(found)[-1] == "<urn:page:3>"
    assert any(isinstance(g, Gap) for g in found)


def test_too_long_a_record_is_a_gap():
    found = salvage(one(1, size=5000) + one(2), most=2000)
    assert names(found)[-1] == "<urn:page:2>" and isinstance(found[0], Gap)


def test_written_archives_read_back(spark, tmp_path):
    big, other = "a" * 1500, "é" * 600
    rows = [(1, "http://a", big), (2, None, big), (3, "x\r\ny", "small"), (4, "u", "small"),
            (5, "u", None), (6, "u", ""), (7, "u", big), (7, "u", big), (None, "u", "no id"),
            (8, "u", other), (9, "u", other)]
    schema = "page_id long, url string, html string, id int, sha string, head int"
    pages = spark.createDataFrame([(*r, 1, "s", 2) for r in rows], schema)
    folder = f"file:{tmp_path}"
    manifest = warc.write(pages, folder, file_bytes=400)
    got = warc.read(manifest, folder)
    assert got.where("gap is not null").count() == 0
    back = sorted(((r.record_id.removeprefix("urn:page:"), r.type, r.payload_bytes, r.payload_sha1,
                    (r.refers_to or "").removeprefix("urn:page:")) for r in got.collect()))

    def expected(i, body, kind="response", refers=""):
        data = (body or "").encode()
        return str(i or ""), kind, len(data), hashlib.sha1(data).hexdigest(), refers

    assert back == sorted([
        expected(1, big, "revisit", "7"), expected(2, big, "revisit", "7"), expected(3, "small"),
        expected(4, "small"), expected(5, ""), expected(6, ""), expected(7, big), expected(7, big),
        expected(None, "no id"), expected(8, other, "revisit", "9"), expected(9, other)])
    assert sum(r.records for r in manifest.collect()) == len(rows)
    assert warc.read(warc.write(pages.where("false"), folder), folder).count() == 0


def test_damage_in_written_files_is_logged(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", f"text {i} " * 50) for i in range(20)],
                                  "page_id long, url string, html string").coalesce(1)
    folder = f"file:{tmp_path}"
    manifest = warc.write(pages, folder)
    name = manifest.first().file
    data = bytearray((tmp_path / name).read_bytes())
    data[len(data) // 2] ^= 0xFF
    (tmp_path / name).write_bytes(data)
    got = warc.read(manifest, folder)
    assert got.where("gap is null").count() == 19 and got.where("gap is not null").count() == 1


@pytest.mark.parametrize("packed", [True, False])
def test_headers_may_be_long(packed):
    data = one(1, packed=False).replace(b"\r\n", b"\r\nX-Long: " + b"y" * 200_000 + b"\r\n", 1)
    assert data.index(b"\r\n\r\n") > 200_000
    found = salvage((member(data) if packed else data) + one(2, packed))
    assert names(found) == ["<urn:page:1>", "<urn:page:2>"]
    assert found[0].payload == random.Random(1).randbytes(300)
    if not packed:
        cut = salvage(data + one(2, packed), headers=1 << 16)
        assert isinstance(cut[0], Gap) and names(cut)[-1] == "<urn:page:2>"


def test_the_bound_of_a_record_is_the_readers(docs):
    pages = docs([(1, "x" * 5000), (2, "y" * 100)]).withColumnRenamed("doc_id", "page_id")
    pages = pages.selectExpr("page_id", "'http://a/' as url", "text as html")
    folder = warc.new_folder(pages)
    manifest = warc.write(pages, folder)
    assert sorted(r.payload_bytes for r in warc.read(manifest, folder).collect()) == [100, 5000]
    some = warc.read(manifest, folder, most=2000).collect()
    assert sorted(r.gap is None for r in some) == [False, True]
