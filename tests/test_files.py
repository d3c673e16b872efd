"""Lines of files: offsets and ranges under any split size, order of files."""

import random

import pytest
from pyspark.sql import functions as F

from sparklog.sources import files


@pytest.fixture
def split(spark):
    """Sets the bytes of a split, for one test."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(k) for k in keys]
    yield lambda n: [spark.conf.set(k, v) for k, v in zip(keys, (str(n), "1"))]
    for k, v in zip(keys, before):
        spark.conf.set(k, v)


def some_file(rng, mark=False):
    data = b"\xef\xbb\xbf" if mark else b""
    for _ in range(rng.randrange(1, 300)):
        data += bytes(rng.choice(b"ab\r\xff\xc3\xa9") for _ in range(rng.choice([0, 0, 3, 10, 200]))) + b"\n"
    return data + rng.choice([b"", b"tail", b"\r"])


def lines_of(data):
    """(offset, line without what ends it) of each line."""
    at = 3 if data.startswith(b"\xef\xbb\xbf") else 0
    parts = data[at:].split(b"\n")
    out = []
    for x in parts if parts[-1] else parts[:-1]:
        out.append((at, x.rstrip(b"\r\n")))
        at += len(x) + 1
    return out


@pytest.mark.parametrize("size", [97, 1000, 5000, 1 << 27])
def test_offsets_do_not_depend_on_splits(spark, tmp_path, split, size):
    rng = random.Random(4)
    made = {f"{name}.log": some_file(rng, mark=name == "m") for name in "abcm"}
    for name, data in made.items():
        (tmp_path / name).write_bytes(data)
    split(size)
    got = files.read_lines(spark, "*.log", str(tmp_path), offsets=True)
    if size < 1000:
        assert got.select("file_path", "block").distinct().count() > 20
    for name, data in made.items():
        rows = got.where(F.col("file_path").endswith(f"/{name}")).orderBy("file_seq", "offset").collect()
        assert [(r.offset, bytes(r.payload)) for r in rows] == lines_of(data)
        assert [r.offset for r in sorted(rows, key=lambda r: (r.block, r.line_id))] == [r.offset for r in rows]
    assert [r.file_path[-5] for r in got.select("file_path", "file_seq").distinct().orderBy("file_seq").collect()] == list("abcm")


def ranges_of(data, n):
    """Starts of up to n ranges: multiples of a part of the bytes, each moved behind the next newline."""
    part = -(-len(data) // n)
    starts = {0}
    for k in range(1, n):
        end = data.find(b"\n", k * part)
        if end >= 0 and end + 1 < len(data):
            starts.add(end + 1)
    return sorted(starts)


@pytest.mark.parametrize("size,n", [(150, 4), (1 << 27, 4), (700, 40), (150, 1)])
def test_ranges_and_ids(spark, tmp_path, split, size, n):
    data = some_file(random.Random(9)) * 3
    (tmp_path / "x.log").write_bytes(data)
    split(size)
    got = files.read_text_events(spark, "x.log", str(tmp_path), name="in", instances=n)
    want = {}
    starts = ranges_of(data, min(n, 32))
    for at, line in lines_of(data):
        want.setdefault(max(k for k, s in enumerate(starts) if s <= at), []).append(line)
    have = {}
    for r in got.collect():
        have.setdefault(r.src_key, []).append(bytes(r.payload))
    assert sorted(map(sorted, have.values())) == sorted(map(sorted, want.values()))
    if n == 1:
        assert set(have) == {"in"}
        return
    ids = {r.event_id for r in got.collect()}
    assert len(ids) == len(lines_of(data))
    split(333)
    assert {r.event_id for r in files.read_text_events(spark, "x.log", str(tmp_path), name="in", instances=n).collect()} == ids


def test_listing_reads_no_file(spark, tmp_path):
    for name in ("b/x.bin", "a/x.bin", "a/w.bin"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"12345")
    got = files.listed_files(spark, f"{tmp_path}/*/*.bin").orderBy("file_seq").collect()
    assert [(r.file_path[-7:], r.file_size) for r in got] == [("a/w.bin", 5), ("a/x.bin", 5), ("b/x.bin", 5)]
    plan = files.listed_files(spark, f"{tmp_path}/*/*.bin")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_empty_and_missing(spark, tmp_path):
    (tmp_path / "e.log").write_bytes(b"")
    assert files.read_lines(spark, "e.log", str(tmp_path), offsets=True).count() == 0
    for name in ("none.log", "none*.log"):
        with pytest.raises(Exception):
            files.read_lines(spark, name, str(tmp_path))
