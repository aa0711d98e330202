import hashlib
import io
import random
from pathlib import Path

import pytest

from starloom.llm.warc import (
    Gap,
    Record,
    member,
    op2_warc_salvage,
    quarantined,
    read_archives,
    record,
    records,
    salvage,
    undamaged,
    write_archives,
)


def raw(i, payload=b"<html>text</html>" * 20):
    return record(i, f"http://h/{i}", payload, hashlib.sha256(payload).hexdigest(), None, False)


def parts_of(data):
    found = list(salvage(io.BytesIO(data), len(data)))
    return [x.name for x in found if isinstance(x, Record)], [x for x in found if isinstance(x, Gap)]


def names(*ids):
    return [f"<urn:page:{i}>" for i in ids]


def test_whole_files_have_no_gaps():
    members = [member(raw(i)) for i in range(5)]
    assert parts_of(b"".join(members)) == (names(*range(5)), [])
    assert parts_of(b"".join(raw(i) for i in range(5))) == (names(*range(5)), [])
    assert parts_of(b"") == ([], [])


def test_a_damaged_member_is_quarantined_and_later_records_recovered():
    members = [member(raw(i)) for i in range(5)]
    bad = bytearray(members[2])
    bad[len(bad) // 2] ^= 0x55
    data = members[0] + members[1] + bytes(bad) + members[3] + members[4]
    start = len(members[0] + members[1])
    got, gaps = parts_of(data)
    assert got == names(0, 1, 3, 4)
    assert [(g.start, g.end) for g in gaps] == [(start, start + len(bad))] and gaps[0].reason


def test_garbage_cuts_and_wrong_digests():
    a, b, c = (member(raw(i)) for i in range(3))
    assert parts_of(b"junk\x1f\x8b\x08junk" + a + b)[0] == names(0, 1)
    got, gaps = parts_of(a + b + c[:-20])
    assert got == names(0, 1) and gaps[0].end == len(a + b + c) - 20
    wrong = raw(1).replace(b"<html>text", b"<html>tex!")
    assert parts_of(a + member(wrong) + c)[0] == names(0, 2)
    got, gaps = parts_of(raw(0) + wrong + raw(2))
    assert got == names(0, 2) and (gaps[0].start, gaps[0].end) == (len(raw(0)), len(raw(0) + wrong))
    assert parts_of(raw(0) + a + raw(2) + c)[0] == names(0, 0, 2, 2)


def test_marks_across_pieces_are_found():
    noise = random.Random(1).randbytes(3 << 20).replace(b"\x1f\x8b", b"\x00\x00")
    got, gaps = parts_of(noise + member(raw(1)) + noise[: (1 << 20) - 5] + member(raw(2)))
    assert got == names(1, 2) and len(gaps) == 2


def test_odd_pages(spark, tmp_path):
    long_ = "<p>" + "y" * 300_000
    rows = [(5, "http://a/\r\nx", "same" * 50, 1), (3, None, "same" * 50, 1), (9, "u", "same" * 50, 1), (1, "u", None, 1),
            (2, "u", "", 1), (4, "u", "tiny", 1), (6, "u", "tiny", 1), (None, "u", "same" * 50, 1), (7, "u", long_, 1), (7, "u", long_, 1)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, digest int")
    entries = read_archives(write_archives(pages, str(tmp_path), file_bytes=2000))
    assert quarantined(entries).count() == 0
    got = sorted((str(r.page_id), r.record_type, r.refers_to, r.payload_bytes) for r in records(entries).collect())
    n = len(long_)
    assert got == sorted([
        ("5", "revisit", 3, 200), ("3", "response", None, 200), ("9", "revisit", 3, 200), ("1", "response", None, 0),
        ("2", "response", None, 0), ("4", "response", None, 4), ("6", "response", None, 4), ("None", "revisit", 3, 200),
        ("7", "response", None, n), ("7", "response", None, n),
    ])
    payload = [bytes(r.payload) for r in records(entries).where("page_id = 3").collect()]
    assert payload == [b"same" * 50]
    assert read_archives(write_archives(pages.where("false"), str(tmp_path / "none"))).count() == 0


def test_damage_does_not_pass_unseen(spark, tmp_path):
    pages = spark.createDataFrame([(n, "u", f"{n}" * 90, 1) for n in range(20)], "page_id bigint, url string, html string, digest int")
    archives = write_archives(pages, str(tmp_path))
    assert undamaged(read_archives(archives)).count() == 20
    path = Path(archives.select("file").first()[0].removeprefix("file://").removeprefix("file:"))
    path.write_bytes(path.read_bytes()[:-9])
    assert quarantined(read_archives(archives)).count() == 1
    with pytest.raises(Exception, match="damaged archive"):
        undamaged(read_archives(archives)).select("page_id").collect()


def test_query_returns_every_page(spark, tables):
    assert op2_warc_salvage(spark, tables).count() == spark.read.parquet(f"{tables}/pages.parquet").count()
