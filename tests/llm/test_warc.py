"""Web archives against hashlib and against the bytes of their bundles."""

from __future__ import annotations

import hashlib
from pathlib import Path

import pytest
import zstandard

from lendscope.llm import queries, warc

SF = "/root/testdata/sf0.001"
LONG = "é" * 700
ROWS = [
    (1, "http://a/1", "<p>short</p>"),
    (2, "http://a/2", "<p>short</p>"),
    (3, "http://a/3 x\r\ny", LONG),
    (9, None, LONG),
    (4, "http://a/4", LONG),
    (None, "http://a/n", LONG),
    (None, None, "n" * 2000),
    (None, None, "n" * 2000),
    (5, "http://a/5", None),
    (6, "http://a/6", ""),
    (7, "http://a/7", "x" * 999),
    (8, "http://a/8", "x" * 999),
    (10, "u", "y" * 1000),
    (11, "u", "y" * 1000),
    (11, "u", "y" * 1000),
    (12, "u", "\r\n\r\nWARC/1.1\r\n" + "long text " * 200_000),
]


def brute(rows):
    """The contract, row by row."""
    want = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        copies = [r[0] for r in rows if (r[2] or "").encode() == payload]
        known = [c for c in copies if c is not None]
        target = max(known) if len(payload) >= 1000 and len(copies) > 1 and known else None
        revisit = target is not None and page_id != target
        want.append(
            (page_id, len(payload), hashlib.sha1(payload).hexdigest(),
             "revisit" if revisit else "response", target if revisit else None)
        )
    return want


def rows_of(df):
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return sorted(map(tuple, df.select(names).collect()), key=repr)


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("warc") / "out")
    # Columns whose names the operator uses itself.
    pages = spark.createDataFrame(
        [(*r, "x", b"y", 3) for r in ROWS],
        "page_id long, url string, html string, record_id string, payload binary, frame int",
    )
    warc.write(pages, folder)
    return folder


def test_archives_say_what_the_rows_say(spark, written):
    assert rows_of(warc.resolved(warc.read_records(spark, written))) == sorted(brute(ROWS), key=repr)


def test_bundles_are_plain_zstandard_and_seekable(spark, written):
    index = warc.read_index(spark, written).collect()
    assert len(index) == len(ROWS)
    for name in {row.bundle for row in index}:
        path = Path(written, "bundles", name)
        reader = zstandard.ZstdDecompressor().stream_reader(path.read_bytes(), read_across_frames=True)
        plain = reader.readall()
        sizes, start = [], 0
        import pyarrow.fs as pafs

        with pafs.LocalFileSystem().open_input_file(str(path)) as source:
            for _, _, size in warc.read_seek_table(source):
                sizes.append(start)
                start += size
        assert start == len(plain)
        for row in (r for r in index if r.bundle == name):
            at = sizes[row.frame] + row.offset
            assert plain[at : at + 8] == b"WARC/1.1"
            assert plain[at : at + row.length].endswith(b"\r\n\r\n")
            assert row.record_id.encode() in plain[at : at + 200]


def test_a_record_is_read_from_its_own_frame(spark, written):
    index = warc.read_index(spark, written)
    wanted = index.where("page_id in (1, 4, 12)").select("record_id")
    got = {r.page_id: r for r in warc.fetch(spark, written, wanted).collect()}
    assert bytes(got[1].payload) == b"<p>short</p>"
    assert got[4].payload is None and got[4].record_type == "revisit"
    target = spark.createDataFrame([(got[4].refers_to_id,)], "record_id string")
    (full,) = warc.fetch(spark, written, target).collect()
    assert bytes(full.payload).decode() == LONG and full.page_id == 9
    assert bytes(got[12].payload).decode() == ROWS[-1][2]


def test_frames_end_behind_the_record_that_fills_them(tmp_path, monkeypatch):
    import pyarrow.fs as pafs

    monkeypatch.setattr(warc, "FRAME_BYTES", 600)
    fs = pafs.LocalFileSystem()
    bundle = warc._Bundle(fs, str(tmp_path))
    assert [bundle.add(b"a" * n) for n in (500, 99, 1, 5000, 7)] == [(0, 0), (0, 500), (0, 599), (1, 0), (2, 0)]
    bundle.close()
    with fs.open_input_file(str(tmp_path / bundle.name)) as source:
        assert [size for _, _, size in warc.read_seek_table(source)] == [600, 5000, 7]
    (tmp_path / "c").write_bytes(b"x" * 40)
    with fs.open_input_file(str(tmp_path / "c")) as source, pytest.raises(ValueError, match="seek table"):
        warc.read_seek_table(source)


def test_a_damaged_payload_is_refused():
    row = {"payload": b"abc", "record_id": "<r>", "url": None, "page_id": 1, "refers_to_id": None,
           "sha1": hashlib.sha1(b"abc").hexdigest()}
    record = warc.record_bytes(row)
    assert warc.parse_record(record, 0)[0]["payload"] == b"abc"
    with pytest.raises(ValueError, match="digest"):
        warc.parse_record(record.replace(b"abc", b"abd"), 0)


def test_an_empty_table_gives_no_rows(spark, tmp_path):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write(empty, str(tmp_path / "e"))
    assert rows_of(warc.resolved(warc.read_records(spark, str(tmp_path / "e")))) == []


def test_the_query_covers_all_pages(spark):
    pages = queries.table(spark, SF, "pages")
    rows = [(r.page_id, r.url, r.html) for r in pages.collect()]
    assert rows_of(queries.QUERIES["op11_seekable_warc"](spark, SF)) == sorted(brute(rows), key=repr)
