from __future__ import annotations

import base64
import gzip
import hashlib

import pytest

from reviewloom.llm import files, warc
from reviewloom.staging import fresh_path

SCHEMA = "page_id long, url string, html string, payload string, offset long, refers_to long"
ROWS = [
    (1, "https://a.org/x", "<p>é</p>"),
    (2, "http://b.org/", "<p>other</p>"),
    (3, None, "<p>é</p>"),
    (9, "http://c.org/\r\nX: y z", "<p>é</p>"),
    (4, "no scheme", None),
    (5, "", ""),
    (6, "http://long.org", "long " * 400_000),
    (None, "http://d.org", "<p>other</p>"),
    (2, "http://b.org/", "<p>other</p>"),
    (7, "http://e.org", "Content-Length: 3\r\n\r\nWARC/1.1\r\n\r\n"),
]


def pages(spark):
    return spark.createDataFrame([(*r, "clash", -1, -1) for r in ROWS], SCHEMA).repartition(3)


def expected() -> list[tuple]:
    out = []
    for page_id, _, html in ROWS:
        payload = (html or "").encode()
        same = [i for i, _, h in ROWS if (h or "") == (html or "") and i is not None]
        last = max(same, default=None)
        visit = page_id is not None and page_id != last
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((page_id, len(payload), digest, "revisit" if visit else "response", last if visit else None))
    return sorted(out, key=repr)


def test_round_trip(spark):
    got = warc.archive_pages(pages(spark)).drop("url").collect()
    assert sorted(map(tuple, got), key=repr) == expected()


def test_payloads_come_back_whole_and_selected(spark):
    index = warc.write_archives(pages(spark), fresh_path(spark, "archives"))
    some = warc.read_records(index.where("page_id in (6, 7, 9)")).collect()
    assert {r["page_id"]: r["payload"].decode() for r in some} == {6: ROWS[6][2], 7: ROWS[9][2], 9: ROWS[3][2]}
    assert {r["page_id"]: r["url"] for r in some}[9] == "http://c.org/%0D%0AX:%20y%20z"
    place = index.where("page_id = 9").first()
    raw = files.Reader().read(place["path"], place["offset"], place["length"])
    assert gzip.decompress(raw).startswith(b"WARC/1.1\r\nWARC-Type: response\r\n")


def test_small_payloads_are_all_responses(spark):
    got = warc.archive_pages(pages(spark), least=9).collect()
    assert {r["record_type"] for r in got if r["payload_bytes"] < 9} == {"response"}
    assert {r["page_id"] for r in got if r["record_type"] == "revisit"} == {1, 3}


def test_neighbours_are_read_at_once():
    places = [("a", 0, 10), ("a", 10, 5), ("a", 20, 5), ("a", 20 + warc.GAP + 6, 5), ("b", 0, warc.RANGE + 1), ("b", warc.RANGE + 1, 2)]
    assert [r[3] for r in warc._ranges(places)] == [[0, 1, 2], [3], [4], [5]]


def test_damage_is_noticed():
    raw = warc._record(1, "u", b"payload", "WRONG", None, warc.DATE)
    assert warc.parse_record(raw)[1] == b"payload"
    with pytest.raises(Exception):
        warc.parse_record(raw[:-9] + bytes(9))


def test_empty_table(spark):
    assert warc.archive_pages(spark.createDataFrame([], SCHEMA)).collect() == []
