"""Large Arrow files: runs of record batches, found by the headers of messages."""

import io
import random

import pyarrow as pa
import pytest

from sparklog.sources import arrow


def made(rng, batches, dictionary=False, rows=50):
    out = []
    for k in range(batches):
        words = pa.array([f"w{rng.randrange(9)}" if rng.random() < 0.9 else None for _ in range(rows)])
        # Each batch has a dictionary of its own, so the stream replaces it.
        out.append(pa.record_batch([pa.array(range(k * rows, (k + 1) * rows)), words.dictionary_encode() if dictionary else words], names=["n", "w"]))
    return out


def rows_of(batches):
    return [tuple(r.values()) for b in batches for r in b.to_pylist()]


@pytest.mark.parametrize("dictionary", [False, True])
@pytest.mark.parametrize("range_bytes", [1, 3000, 1 << 30])
def test_runs_hold_all_batches_in_order(dictionary, range_bytes):
    batches = made(random.Random(1), 12, dictionary)
    data = arrow.encode_stream(batches)
    got, places = [], []
    for _, head, begin, end in arrow.stream_ranges(io.BytesIO(data), len(data), range_bytes=range_bytes):
        part = b"".join([*(data[at : at + n] for at, n in head), data[begin:end], arrow._END])
        got += rows_of(arrow.stream_batches(part))
        places.append((begin, end))
    assert got == rows_of(batches) and all(a[1] <= b[0] for a, b in zip(places, places[1:]))
    assert len(places) == (12 if range_bytes == 1 else 1 if range_bytes > 1 << 20 else len(places))


@pytest.mark.parametrize("wire", arrow.WIRE)
@pytest.mark.parametrize("range_bytes", [1000, 1 << 26])
def test_read(spark, rows, tmp_path, wire, range_bytes):
    rng = random.Random(2)
    want = []
    for name in ("a", "b c", "d"):
        batches = made(rng, 9, dictionary=name == "d")
        data = arrow.encode_frame(f"tag-{name}", batches) if wire == "arrow_framed" else arrow.encode_stream(batches) + arrow.encode_stream(batches[:2])
        (tmp_path / f"{name}.arrow").write_bytes(data)
        want += rows_of(batches) + (rows_of(batches[:2]) if wire == "arrow_ipc" else [])
    (tmp_path / "none.arrow").write_bytes(b"")
    got = arrow.read_arrow(spark, "*.arrow", str(tmp_path), wire, range_bytes=range_bytes)
    assert rows(got) == sorted(want, key=repr)
    if range_bytes == 1000:
        assert got.rdd.getNumPartitions() > 9
    if wire == "arrow_framed":
        tagged = arrow.read_arrow(spark, "*.arrow", str(tmp_path), wire, tag="t", range_bytes=range_bytes)
        assert {r.t for r in tagged.collect()} == {"tag-a", "tag-b c", "tag-d"}
    else:
        assert arrow.read_arrow(spark, "a.arrow", str(tmp_path), segments="first").count() == 450


@pytest.mark.parametrize("broken", ["cut", "noise"])
def test_broken_files(spark, tmp_path, broken):
    """A file that breaks off: an error, or all batches before."""
    data = arrow.encode_stream(made(random.Random(3), 6))
    data = data[: len(data) - 300] if broken == "cut" else data + b"no message at all"
    (tmp_path / "x.arrow").write_bytes(data)
    with pytest.raises(Exception):
        arrow.read_arrow(spark, "x.arrow", str(tmp_path)).collect()
    assert arrow.read_arrow(spark, "x.arrow", str(tmp_path), on_error="keep_prefix", range_bytes=1).count() == (250 if broken == "cut" else 300)


def test_no_rows(spark, tmp_path):
    sink = pa.BufferOutputStream()
    pa.ipc.new_stream(sink, pa.schema([("n", pa.int64())])).close()
    (tmp_path / "x.arrow").write_bytes(sink.getvalue().to_pybytes())
    got = arrow.read_arrow(spark, "x.arrow", str(tmp_path))
    assert got.count() == 0 and got.columns == ["n"]
    with pytest.raises(Exception):
        arrow.read_arrow(spark, "y*.arrow", str(tmp_path))


def test_bodies_are_not_read():
    """The index takes the headers, a small share of the bytes."""
    data = arrow.encode_stream(made(random.Random(4), 5, rows=20_000))

    class Counted(io.BytesIO):
        taken = 0

        def read(self, n=-1):
            got = super().read(n)
            Counted.taken += len(got)
            return got

    assert len(list(arrow.stream_ranges(Counted(data), len(data), range_bytes=1))) == 5
    assert Counted.taken < len(data) / 100


def test_failures_as_rows(spark, rows):
    """One row for each payload that fails, of each class, and none for those that do not."""
    good = arrow.encode_stream(made(random.Random(5), 3))
    *_, (_, _, c, end) = arrow.stream_ranges(io.BytesIO(good), len(good), range_bytes=1)
    cases = {1: good, 2: good[: c + 9], 3: good[: end - 40], 4: good + b"text", 5: None, 6: b"", 7: good + good, 8: b"none at all"}
    df = spark.createDataFrame([(k, None if v is None else bytearray(v)) for k, v in cases.items()], "k int, payload binary")
    got = {r.k: (r.error_class, r.position, r.raw if r.raw is None else bytes(r.raw)) for r in arrow.arrow_failures(df).collect()}
    assert got == {2: ("end", c, cases[2][c:]), 3: ("end", c, cases[3][c:]), 4: ("decode", len(good), b"text"), 5: ("connect", None, None), 8: ("decode", 0, b"none at all")}
    kept = arrow.decode_arrow(df.where("k = 3"), on_error="keep_prefix", schema=None)
    assert kept.count() == 100
