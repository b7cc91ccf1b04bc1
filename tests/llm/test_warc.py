"""Archives: exact round trips, any cut into ranges, damage, odd rows."""

import gzip
import hashlib
import io
import random

import pytest

from tablesync.llm import queries, warc
from tests.compare import differences

SCHEMA = "page_id bigint, url string, html string, bytes int"


def archive(count: int, rng: random.Random) -> tuple[bytes, list[int], list[bytes]]:
    data, places, payloads = b"", [], []
    for n in range(count):
        payload = rng.randbytes(rng.choice([0, 10, 5000])) + warc.MAGIC * rng.randrange(3)
        places.append(len(data))
        payloads.append(payload)
        data += warc.record("response", f"urn:page:{n}", None, "http://a/", payload,
                            hashlib.sha1(payload).digest())
    return data, places, payloads


def owned(data: bytes, step: int) -> list[tuple[int, bytes]]:
    members = warc.Members(io.BytesIO(data), len(data))
    return [x for at in range(0, len(data), step)
            for x in members.owned(at, min(at + step, len(data)))]


@pytest.mark.parametrize("step", [1, 7, 1000, 5003, 10**9])
def test_every_record_is_read_once_whatever_the_ranges(step):
    data, places, payloads = archive(12, random.Random(step))
    got = owned(data, step)
    assert [at for at, _ in got] == places
    assert [warc.parse(plain)["payload"] for _, plain in got] == payloads


def test_damage_costs_only_the_damaged_record():
    data, places, payloads = archive(9, random.Random(4))
    broken = bytearray(data)
    middle = (places[4] + places[5]) // 2
    broken[middle] ^= 0xFF
    for step in (999, 10**9):
        got = [warc.parse(plain)["payload"] for _, plain in owned(bytes(broken), step)]
        assert got == payloads[:4] + payloads[5:]


@pytest.mark.parametrize("number", [0, 4, 8])
def test_a_strict_reader_overlooks_no_damage(number):
    data, places, _ = archive(9, random.Random(4))
    broken = bytearray(data)
    broken[(places[number] + [*places, len(data)][number + 1]) // 2] ^= 0xFF

    def read(content: bytes, step: int) -> list:
        members = warc.Members(io.BytesIO(content), len(content))
        return [at for begin in range(0, len(content), step)
                for at, _ in members.owned(begin, min(begin + step, len(content)), strict=True)]

    for step in (999, 5003, places[number] or 77, 10**9):
        assert read(data, step) == places
        with pytest.raises(ValueError, match="damaged member"):
            read(bytes(broken), step)
        with pytest.raises(ValueError, match="damaged member"):
            read(data[:-3], step)


def test_members_are_plain_gzip():
    data, _, payloads = archive(3, random.Random(1))
    assert gzip.decompress(data).count(b"WARC/1.1\r\nWARC-Type: response") == 3


def test_query_equals_sql(spark, sf_dir, duck):
    df = queries.QUERIES["op2_warc"](spark, sf_dir)
    assert differences(df, duck, queries.SQL["op2_warc"]) == []


def test_small_ranges_and_payloads(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r["page_id"]: r for r in warc.archive_round_trip(pages, range_bytes=3000).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for row in rows:
        r = got[row["page_id"]]
        assert r["url"] == row["url"]
        held = got[r["refers_to"]] if r["record_type"] == "revisit" else r
        assert bytes(held["payload"]) == (row["html"] or "").encode()


def test_odd_rows(spark):
    big = "é" * 600
    rows = [(1, None, big, 0), (2, "http://a/\r\nX: y", big, 0), (2, "u", big, 0), (None, "u", big, 0),
            (3, "u", None, 0), (4, "u", "", 0), (5, "u", "x" * 999, 0), (6, "u", "x" * 999, 0),
            (7, "u %41", "long " * 2_000_000, 0)]
    got = warc.archive_round_trip(spark.createDataFrame(rows, SCHEMA), range_bytes=500).collect()
    kinds = sorted((str(r["page_id"]), r["record_type"], r["refers_to"]) for r in got)
    assert kinds == [
        ("1", "revisit", 2), ("2", "response", None), ("2", "response", None), ("3", "response", None),
        ("4", "response", None), ("5", "response", None), ("6", "response", None),
        ("7", "response", None), ("None", "revisit", 2)]
    by = {r["page_id"]: r for r in got}
    assert by[1]["url"] is None and by[7]["url"] == "u %41" and by[7]["payload_bytes"] == 10_000_000
    assert {r["url"] for r in got if r["page_id"] == 2} == {"u", "http://a/\r\nX: y"}
    assert by[3]["payload_digest"] == hashlib.sha1(b"").hexdigest()
    assert by[1]["payload_bytes"] == 1200
    empty = spark.createDataFrame([], SCHEMA)
    assert warc.archive_round_trip(empty).collect() == []
    nameless = spark.createDataFrame([(None, "u", big, 0)] * 2, SCHEMA)
    assert [r["record_type"] for r in warc.archive_round_trip(nameless).collect()] == ["response"] * 2
