"""Round trips, against SQL and against a plain reader of gzip files."""

import glob
import gzip
import hashlib
import os
import random

import pytest

from lettora.llm.warc import WarcSpec, archive_round_trip, inflated, member, normalise, read_index, read_pages, read_places, split_records, write_monolithic

SCHEMA = "page_id long, url string, html string"


def test_query_equals_sql(equals_sql):
    equals_sql("op5_warc")


def plain(rows):
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        same = [p for p, _, h in rows if p is not None and (h or "").encode() == payload] if len(payload) >= 1000 else []
        refers_to = max(same) if same and page_id != max(same) else None
        out.append((page_id, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if refers_to is not None else "response", refers_to))
    return sorted(out, key=repr)


def test_odd_pages_and_hot_copies(spark):
    rng = random.Random(2)
    body = "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n" * 40
    noise = "".join(map(chr, rng.choices(range(32, 5000), k=400_000)))
    rows = [(1, "http://a/\r\nX: y", body), (2, None, body), (3, "u", body + "é"), (4, "u", None), (5, "u", ""), (6, "u", "x" * 999)]
    rows += [(7, "u", "x" * 999), (8, "u", "\r\n\r\n" * 300), (9, "u", noise), (9, "u", noise), (None, "n", body), (None, "n", "z" * 2000)]
    rows += [(100 + i, f"u{i}", "same " * 300) for i in range(40)] + [(139, "again", "same " * 300)]
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], SCHEMA + ", keeper string, n int")
    found = archive_round_trip(df, WarcSpec(records_per_file=7))
    assert sorted((tuple(r)[:5] for r in found.collect()), key=repr) == plain(rows)
    assert archive_round_trip(df.limit(0)).count() == 0


def test_files_are_gzip_members_at_the_indexed_places(spark, tmp_path):
    rows = [(i, f"http://x/{i}", f"<p>{i}</p>" * (i + 1)) for i in range(25)]
    write_monolithic(spark.createDataFrame(rows, SCHEMA).coalesce(2), str(tmp_path / "mono"))
    normalise(spark, str(tmp_path / "mono"), str(tmp_path / "normal"))
    whole = {name: open(name, "rb").read() for name in glob.glob(str(tmp_path / "mono/*.gz"))}
    texts = sorted(gzip.decompress(data) for data in whole.values() if gzip.decompress(data))
    files = {os.path.basename(os.path.dirname(f))[8:]: open(f, "rb").read() for f in glob.glob(str(tmp_path / "normal/part=archives/*/*.txt"))}
    assert sorted(map(gzip.decompress, files.values())) == texts
    places = read_index(spark, str(tmp_path / "normal"))
    index = places.collect()
    assert len(index) == 25
    for row in index:
        one = gzip.decompress(files[row.archive][row.offset : row.offset + row.length])
        assert one.startswith(b"WARC/1.1\r\n") and one.count(row.record_id.encode()) == 1
    assert {r.page_id for r in read_pages(spark, str(tmp_path / "normal")).collect()} == set(range(25))
    some = read_places(spark, str(tmp_path / "normal"), places.where("length % 2 = 0")).collect()
    ids = {int(r.record_id.split(":")[2]) for r in index if r.length % 2 == 0}
    assert {r.page_id for r in some} == ids and len(some) == len(ids) > 0


def test_files_of_long_pages_are_bounded_by_bytes(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, "u", "".join(rng.choices("abcdefgh", k=1_000_000))) for i in range(24)]
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    write_monolithic(df, str(tmp_path / "mono"), WarcSpec(file_bytes=5_000_000))
    sizes = [len(gzip.decompress(open(name, "rb").read())) for name in glob.glob(str(tmp_path / "mono/*.gz"))]
    assert len(sizes) >= 5 and max(sizes) <= 5_000_000
    found = archive_round_trip(df, WarcSpec(file_bytes=5_000_000))
    assert sorted((tuple(r)[:5] for r in found.collect()), key=repr) == plain(rows)


def test_members_end_in_zero_and_damage_is_reported():
    for raw in (b"", b"abc", bytes(17 << 20)):
        packed = member(raw)
        assert packed[-1] == 0 and gzip.decompress(packed) == raw
    record = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [block for _, block, _ in split_records([record, record])] == [b"abc"] * 2
    assert b"".join(inflated(memoryview(gzip.compress(record) + gzip.compress(record)))) == record * 2
    for bad in (record[:-1], record[:20], b"HTTP/1.1\r\n\r\n", record.replace(b"3", b"2")):
        with pytest.raises(ValueError):
            list(split_records([bad]))
    with pytest.raises(ValueError):
        list(inflated(memoryview(gzip.compress(record)[:-9])))
