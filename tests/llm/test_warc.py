"""Archives written and read back, and their bytes as any reader sees them."""

import glob
import hashlib
import io

import zstandard

from starfold.llm import warc

PAGES = "page_id long, url string, html string, digest string"


def archived(spark, folder, rows):
    pages = spark.createDataFrame([(*r, "clash") for r in rows], PAGES)
    warc.write_archives(pages, folder)
    return {(r.page_id, r.record_type, r.refers_to): r for r in warc.read_archives(spark, folder).collect()}


def test_records(spark, tmp_path):
    long, other = "ä" * 60, "b" * 100
    rows = [(5, "http://x/5", long), (3, "http://x/3", long), (9, None, long), (4, "u\r\nv", other), (1, "u", "short"), (2, "u", "short"), (7, "u", None), (8, "u", "")]
    found = archived(spark, str(tmp_path / "w"), rows)
    assert set(found) == {
        (3, "response", None), (5, "revisit", 3), (9, "revisit", 3), (4, "response", None), (1, "response", None), (2, "response", None), (7, "response", None), (8, "response", None),
    }
    for (i, kind, _), r in found.items():
        html = dict((p, h or "") for p, _, h in rows)[i].encode()
        assert r.payload_bytes == len(html) and r.payload_digest == hashlib.sha256(html).hexdigest()
        assert r.payload is None if kind == "revisit" else bytes(r.payload) == html
    assert found[9, "revisit", 3].url is None and found[4, "response", None].url == "u%0D%0Av"


def test_repeated_rows_and_nulls(spark, tmp_path):
    body = "x" * 200
    pages = spark.createDataFrame([(1, "u", body, ""), (1, "u", body, ""), (None, "u", body, ""), (None, None, "y" * 200, "")], PAGES)
    warc.write_archives(pages, str(tmp_path / "w"))
    found = sorted((str(r.page_id), r.record_type, str(r.refers_to)) for r in warc.read_archives(spark, str(tmp_path / "w")).collect())
    assert found == [("1", "response", "None"), ("1", "response", "None"), ("None", "response", "None"), ("None", "revisit", "1")]


def test_empty_table(spark, tmp_path):
    assert archived(spark, str(tmp_path / "w"), []) == {}


def test_files_are_zstandard_with_a_leading_dictionary(spark, tmp_path):
    archived(spark, str(tmp_path / "w"), [(i, f"http://x/{i}", f"<html>{i} " + "word " * (20 + i) + "</html>") for i in range(60)])
    names = glob.glob(str(tmp_path / "w" / "*.warc.zst"))
    records = 0
    for name in names:
        data = open(name, "rb").read()
        size = int.from_bytes(data[4:8], "little")
        assert data[:4] == warc.DICTIONARY_MAGIC
        reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8:8 + size]))
        whole = reader.stream_reader(io.BytesIO(data), read_across_frames=True).read()  # skips the skippable frames by itself
        assert whole == b"".join(warc.records_of(data))
        records += whole.count(b"WARC/1.1\r\n")
    assert names and records == 60


def test_very_long_payload(spark, tmp_path):
    found = archived(spark, str(tmp_path / "w"), [(1, "u", "0123456789" * 500_000), (2, "u", "z")])
    assert found[1, "response", None].payload_bytes == 5_000_000
