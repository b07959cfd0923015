"""Archives: round trip, revisits, frames as other readers see them."""

import hashlib
import struct

import pytest
import zstandard

from citeloom.llm import warc


def test_frames_follow_the_format():
    records = [(f"record {i} " + "common words of many pages " * 20).encode() for i in range(300)]
    frames = list(warc.archive_frames(iter(records)))
    assert frames[0][:4] == bytes.fromhex("5d2a4d18")
    size = struct.unpack_from("<I", frames[0], 4)[0]
    assert size == len(frames[0]) - 8 > 0
    dictionary = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(frames[0][8:]))
    reader = zstandard.ZstdDecompressor(dict_data=dictionary)
    assert [reader.decompress(f) for f in frames[1:]] == records
    gap = warc.EMPTY_FRAME.encode()
    assert list(warc.read_frames(gap.join(frames) + gap)) == records
    plain = sum(len(zstandard.ZstdCompressor(level=warc.LEVEL).compress(r)) for r in records)
    assert sum(map(len, frames[1:])) < plain


def test_archives_without_a_dictionary_and_empty_ones():
    assert list(warc.archive_frames(iter([]))) == []
    frames = list(warc.archive_frames(iter([b"", b"one"])))
    assert list(warc.read_frames(b"".join(frames))) == [b"", b"one"]


def test_archives_roll_over_by_bytes():
    records = [bytes([65 + k % 26]) * 50 + str(k * 7919).encode() * (k % 40) for k in range(2000)]
    left, archives = iter(records), []
    while frames := list(warc.archive_frames(left, 9_000)):
        archives.append(frames)
    assert len(archives) > 2
    assert all(f[0][:4] == warc.DICTIONARY_FRAME for f in archives)
    # The first records are always in; beyond them the limit is passed by one record at most.
    assert all(sum(map(len, f[:-1])) < 9_000 or len(f) <= 1 + warc.DICTIONARY_RECORDS for f in archives)
    assert [r for f in archives for r in warc.read_frames(b"".join(f))] == records


def test_very_long_pages_and_small_archives(spark, tmp_path):
    rows = [(i, f"u{i}", f"<p>page {i}</p>" * (1 + i % 90)) for i in range(1500)]
    rows += [(5000, "long", "wörter " * 400_000), (5001, "long", "wörter " * 400_000), (5002, "line", "x" * 3_000_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(2)
    path = str(tmp_path / "archives")
    warc.write_archives(df, path, archive_bytes=20_000)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    assert files.where("archive > 0").count() > 0
    assert files.where("hex(substring(content, 1, 4)) <> '5D2A4D18'").count() == 0
    got = {r.page_id: r for r in warc.read_archives(spark, path).collect()}
    assert len(got) == len(rows)
    assert got[5000].record_type == "revisit" and got[5000].refers_to == 5001
    for i, _, html in rows:
        assert got[i].payload_digest == hashlib.sha1(html.encode()).hexdigest()
        assert got[i].payload == (None if i == 5000 else html.encode())


def test_cut_archive_is_reported():
    data = b"".join(warc.archive_frames(iter([b"x" * 5000, b"y" * 9000])))
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(warc.read_frames(data[:-3]))


def test_changed_payload_is_reported():
    digest = hashlib.sha1(b"page").hexdigest()
    record = warc.format_record(1, "u", b"page", digest, None)
    assert warc.parse_record(record)["payload"] == b"page"
    with pytest.raises(ValueError, match="digest"):
        warc.parse_record(record.replace(b"page\r\n", b"pagf\r\n"))


def test_round_trip(spark, tmp_path):
    long, longer = "wört " * 250, "\r\n\r\nWARC/1.1\r\n" * 200
    rows = [(i, f"http://e/{i}", f"<p>{i}</p>" + "body " * (i % 50)) for i in range(200)]
    rows += [(300 + i, "http://copy", long) for i in range(9)] + [(400, None, longer), (401, "a\r\nb", longer)]
    rows += [(500, "u", "short")] * 2 + [(501, "u", "short"), (502, "u", None), (None, "u", ""), (None, "u", long)]
    rows += [(600, "u", "same " * 300)] * 2
    df = spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, row int").repartition(3)
    path = str(tmp_path / "archives")
    warc.write_archives(df, path)
    got = warc.read_archives(spark, path).collect()
    assert len(got) == len(rows)
    main = {long: 308, longer: 401}
    for r in got:
        if r.record_type == "response":
            assert hashlib.sha1(r.payload).hexdigest() == r.payload_digest
            assert len(r.payload) == r.payload_bytes and r.refers_to is None
        else:
            assert r.payload is None and r.payload_bytes >= 1000
    by_id = {r.page_id: r for r in got if r.page_id is not None}
    for i, _, html in rows:
        if i is not None and i != 600:
            data = (html or "").encode()
            expected = "revisit" if html in main and i != main[html] else "response"
            assert by_id[i].record_type == expected
            assert by_id[i].refers_to == (main[html] if expected == "revisit" else None)
            assert by_id[i].payload_digest == hashlib.sha1(data).hexdigest()
    # A row given twice is a response twice.
    assert [r.record_type for r in got if r.page_id == 600] == ["response", "response"]
    assert sorted(r.record_type for r in got if r.page_id is None) == ["response", "revisit"]
    assert by_id[401].url == "ab"
    assert warc.archive_round_trip(df.where("false")).count() == 0
