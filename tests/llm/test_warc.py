"""Archives: round trips, the normaliser on whole-file streams and on members, damaged files."""

import gzip
import io
from hashlib import sha256

import pytest

from ratingloom.llm import warc
from ratingloom.session import scratch_folder

LONG = "<p>" + "x é " * 200
PAGES = [(5, "http://a/", LONG), (3, "http://b/\r\nX: y", LONG), (9, None, LONG), (1, "u", "short"),
         (2, "u", "short"), (4, "", ""), (6, "n", None), (None, "z", LONG), (None, "y", "only " * 50),
         (None, "y", "only " * 50), (7, "crlf", "a\r\n\r\nWARC/1.1\r\n\r\n" * 20), (8, "rep", "r" * 150),
         (8, "rep", "r" * 150), (10, "big", "0123456789" * 300_000)]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "k") for r in rows],
                                 "page_id long, url string, html string, payload string").repartition(3)


@pytest.mark.parametrize("roll", [500, 1 << 26])
def test_round_trip(spark, roll):
    found = warc.archive_pages(pages(spark, PAGES), scratch_folder(spark, "warc-test"), roll=roll).collect()
    got = sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"],
                  str(r["refers_to"])) for r in found)
    want = []
    for page_id, _, html in PAGES:
        body = (html or "").encode()
        first = 3 if html == LONG and page_id != 3 else None
        want.append((str(page_id), len(body), sha256(body).hexdigest(),
                     "response" if first is None else "revisit", str(first)))
    assert got == sorted(want)
    for r in found:
        if r["record_type"] == "response":
            assert sha256(bytes(r["payload"])).hexdigest() == r["payload_digest"]
        else:
            assert r["payload"] == b""


def test_no_pages(spark):
    found = warc.archive_pages(pages(spark, []), scratch_folder(spark, "warc-test"))
    assert found.count() == 0 and "payload_digest" in found.columns


def test_members_stand_alone_and_the_index_finds_them(spark, tmp_path):
    records = [warc.record(i, f"http://h/{i}", b"p" * i, "d", None) for i in (0, 1, 70_000, 3)]
    (tmp_path / "one.warc.gz").write_bytes(gzip.compress(b"".join(records)))
    (tmp_path / "many.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    names = spark.createDataFrame([("one.warc.gz",), ("many.warc.gz",)], "name string")
    out = f"file://{tmp_path}/out"
    files = warc.normalise(names, f"file://{tmp_path}", out)
    index = warc.read_index(spark, files, out).collect()
    assert len(index) == 8 and files.agg({"records": "sum"}).first()[0] == 8
    for line in index:
        data = (tmp_path / "out" / line["archive"]).read_bytes()[line["offset"]:line["offset"] + line["length"]]
        assert gzip.decompress(data) == records[[0, 1, 70_000, 3].index(int(line["page"]))]
    ends = {}
    for line in sorted(index, key=lambda x: (x["archive"], x["offset"])):
        assert ends.get(line["archive"], 0) == line["offset"]
        ends[line["archive"]] = line["offset"] + line["length"]


@pytest.mark.parametrize("pieces", [1, 7, 1 << 20])
def test_stream_gives_records_in_pieces(pieces, monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", pieces)
    records = [warc.record(i, "u", bytes(range(256)) * i, "d", None) for i in (0, 1, 2)]
    stream = warc.Inflated(io.BytesIO(gzip.compress(records[0] + records[1]) + gzip.compress(records[2])))
    out = []
    while (header := stream.header()) is not None:
        size = int(warc.header_fields(header)["content-length"])
        out.append(header + b"".join(stream.pieces(size)) + b"\r\n\r\n")
    assert out == records


@pytest.mark.parametrize("damage", [lambda raw: gzip.compress(raw)[:-20], lambda raw: gzip.compress(raw[:-50]),
                                    lambda raw: gzip.compress(b"no archive\r\n\r\n" + raw)])
def test_damaged_streams_raise(damage):
    stream = warc.Inflated(io.BytesIO(damage(warc.record(1, "u", bytes(300), "d", None))))
    with pytest.raises(ValueError):
        while (header := stream.header()) is not None:
            list(stream.pieces(int(warc.header_fields(header)["content-length"])))


def test_files_of_lost_attempts_are_not_read(spark):
    folder = scratch_folder(spark, "warc-test")
    made = warc.write_archives(warc.with_roles(pages(spark, PAGES[:3])), f"{folder}/raw")
    kept = warc.normalise(made, f"{folder}/raw", f"{folder}/records")
    warc.normalise(made, f"{folder}/raw", f"{folder}/records")  # the same work again, not reported
    assert warc.read_index(spark, kept, f"{folder}/records").count() == 3
