"""One long connection in slices against the sequential walk."""

import random
import re

import pytest

from sparklog.operators import framing, long_streams
from tests.test_framing import plain


def noise(rng, mode):
    """Frames as lengths and lines, with bytes that look like lengths and ends of lines inside of them."""
    out = b""
    for _ in range(rng.randrange(3, 60)):
        m = b"".join(rng.choice([b"3 ", b"12 ab", b"\n", b"0 ", b"x", b"7", b" ", b"\r\n", b"99999999999 ", b"long " * 9]) for _ in range(rng.randrange(0, 6)))
        out += b"%d %s" % (len(m), m) if mode.startswith("len") or (mode.startswith("auto") and rng.random() < 0.6) else m + b"\n"
    return out + rng.choice([b"", b"50 open\n", b"4", b"open"])


def step(data, x, mode):
    """Where the frame from x ends, -1 if it is not whole."""
    found = None if mode.startswith("line") else re.match(rb"([0-9]{1,10}) ", data[x : x + 11])
    if found and (mode.endswith("live") or 0 < int(found[1]) < framing.MOST_BYTES):
        end = x + found.end() + int(found[1])
        return end if end <= len(data) else -1
    return -1 if mode.startswith("len") else data.find(b"\n", x) + 1 or -1


@pytest.mark.parametrize("mode", ["auto", "line", "len", "line_live", "len_live"])
def test_frames_from_every_byte(mode):
    """For every cut and every byte, what a slice says is what a walk from that byte does."""
    rng = random.Random(mode)
    for _ in range(40):
        data = noise(rng, mode)
        a, b = sorted(rng.randrange(len(data) + 1) for _ in range(2))
        line = data.find(b"\n", b)
        p = long_streams.Piece(data[a:b], a, len(data), data[b : b + 11], line if line >= 0 else None, mode, framing.MOST_BYTES)
        for at in range(a, b):
            x = at
            while 0 <= x < b:
                x = step(data, x, mode)
            assert p.exits()[at - a] == x, (data, a, b, at)


@pytest.mark.parametrize("mode", ["auto", "line", "len", "line_live", "len_live"])
def test_one_connection_in_slices(spark, rows, mode):
    rng = random.Random(mode + "2")
    streams = {"hot": b"".join(noise(rng, mode).removesuffix(b"50 open\n").removesuffix(b"open").removesuffix(b"4") for _ in range(40)) + b"9 lost", "cold": noise(rng, mode), None: b"".join(noise(rng, "line") for _ in range(30))}
    chunks = []
    for conn, data in streams.items():
        at, seq = 0, 0
        while at < len(data):
            n = rng.choice([1, 2, 5, 9, 400]) if conn == "cold" else rng.choice([1, 3, 8, 20])
            chunks.append((conn, seq, bytearray(data[at : at + n])))
            at, seq = at + n, seq + 1
    rng.shuffle(chunks)
    df = spark.createDataFrame(chunks, "conn string, seq long, bytes binary")
    got = framing.reframe(df, mode=mode, tail=True, slice_rows=60)
    want = []
    for conn, data in streams.items():
        messages, rest = plain(data, mode)
        want += [(conn, i, m) for i, m in enumerate(messages)] + ([(conn, None, rest)] if rest else [])
    assert rows(got) == sorted(want, key=repr)
