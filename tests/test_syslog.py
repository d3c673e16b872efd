"""Syslog headers: lines made of parts by the rules, and the patterns against a byte walk."""

import datetime
import random
import re

import pytest
from pyspark.sql import functions as F

from sparklog.functions import syslog

MONTHS = [datetime.date(2001, m, 1).strftime("%b") for m in range(1, 13)]


def token(rng):
    return "".join(rng.choice("abyz019.-/é") for _ in range(rng.randrange(1, 8)))


def parts_5424(rng):
    """Priority, version, five tokens, structured data: each with what follows it."""
    data = rng.choice(["-", "[]", f"[{token(rng)} {token(rng)}=\"{token(rng)}\"]"])
    return [f"<{rng.randrange(0, 200)}>", f"{rng.randrange(1, 12)} ", *(token(rng) + " " for _ in range(5)), data]


def parts_3164(rng):
    """Priority, month, day, time, host, tag: each with what follows it."""
    day = rng.randrange(1, 32)
    return [f"<{rng.randrange(0, 200)}>", rng.choice(MONTHS) + " ", rng.choice([f"{day:2d} ", f"{day} ", f"{day:02d} "]), "{:02d}:{:02d}:{:02d} ".format(*(rng.randrange(k) for k in (24, 60, 60))), token(rng) + " ", token(rng) + ": "]


def names(pri):
    """The standard's rule: facility times eight plus severity, of which 255 bounds what is kept."""
    facility = pri // 8 % 256
    return pri & 255, syslog.FACILITIES[facility] if facility < 24 else "unknown", syslog.SEVERITIES[pri % 8]


def normalized(spark, lines):
    df = spark.createDataFrame(list(enumerate(lines)), "i int, line string")
    return [r.n for r in df.select("i", syslog.normalize(F.col("line")).alias("n")).orderBy("i").collect()]


def test_lines_made_of_parts(spark):
    rng = random.Random(11)
    made = []
    for _ in range(300):
        message = " ".join(token(rng) for _ in range(rng.randrange(0, 4)))
        kind = rng.choice([parts_5424, parts_3164])
        parts = kind(rng)
        made.append(("".join(parts) + (" " if kind is parts_5424 and message else "") + message, message, int(parts[0][1:-1])))
    for (line, message, pri), n in zip(made, normalized(spark, [x[0] for x in made])):
        assert (n.message, n.pri, n.facility, n.severity) == (message, *names(pri)), line
        assert line.encode()[n.msg_start : n.msg_end].decode() == message and line.startswith(n.header) and n.header == n.header.rstrip()


def test_a_part_that_lacks_makes_all_of_it_message(spark):
    """Every part but a token of the newer form (whose place the next word takes) is needed."""
    rng = random.Random(12)
    broken = []
    for _ in range(60):
        for parts, needed in ((parts_5424(rng), (0, 1, 7)), (parts_3164(rng), (0, 1, 2, 3, 5))):
            for k in needed:
                broken.append("".join(parts[:k] + parts[k + 1 :]) + "é")
    broken = [x for x in broken if not re.match(syslog.R5424, x)]
    assert len(broken) > 300
    for line, n in zip(broken, normalized(spark, broken)):
        assert (n.message, n.header, n.pri, n.msg_start, n.msg_end) == (line, None, None, 0, len(line.encode())), line


def test_priorities(spark):
    """Up to 16 bits; a larger number, or none, leaves the message and no priority."""
    given = [*range(0, 66000, 997), 191, 192, 65535, 65536, 10**12, ""]
    for pri, n in zip(given, normalized(spark, [f"<{p}>1 a b c d e - z" for p in given])):
        assert n.message == "z" and (n.pri, n.facility, n.severity) == (names(pri) if pri != "" and pri < 65536 else (None, None, None))


def test_only_the_first_data_is_header(spark):
    assert [n.message for n in normalized(spark, ["<8>2 a b c d e [q][r] s", "<8>2 a b c d e - - s", "<8>2 a b c d e -"])] == ["[r] s", "- s", ""]


@pytest.mark.parametrize("names_,keeps,tagged", [(("raw", "KEEP"), True, False), (("skip", "Strip"), False, False), (("tag", "PARSE"), False, True)])
def test_modes(spark, names_, keeps, tagged):
    line = "<46>Jun 03 07:08:09 lab9 job: finished"
    df = spark.createDataFrame([(bytearray(line.encode()), {"team": "x", "syslog.pri": "old"})], "payload binary, tags map<string,string>")
    for mode in names_:
        r = syslog.apply_header_mode(df, mode).first()
        assert bytes(r.payload).decode() == (line if keeps else "finished")
        assert r.tags == {"team": "x", **({"syslog.pri": "46", "syslog.facility": "syslog", "syslog.severity": "info"} if tagged else {"syslog.pri": "old"})}


def test_mode_errors_and_bytes(spark):
    with pytest.raises(ValueError):
        syslog.header_mode("other", lenient=False)
    with pytest.warns(UserWarning, match="other"):
        assert syslog.header_mode("other") == "tag"
    # What is no UTF-8 is left alone.
    raw = b"<46>Jun 03 07:08:09 lab9 job: \xfe"
    r = syslog.apply_header_mode(spark.createDataFrame([(bytearray(raw),)], "payload binary"), "tag").first()
    assert bytes(r.payload) == raw and r.tags == {}


def test_encoded_lines_come_back(spark):
    """Days have two digits; a newline is added once, and only if asked for."""
    at = F.lit("2019-03-04 05:06:07").cast("timestamp")
    encode = lambda m, **more: syslog.encode_rfc3164(F.lit(m), at, **more)
    r = spark.range(1).select(encode("up again", pri=84, host="lab9", app="job").alias("a"), encode("x", newline=True).alias("b"), encode("x\n", newline=True).alias("c")).first()
    assert r.a == "<84>Mar 04 05:06:07 lab9 job: up again"
    assert r.b == r.c and r.b.endswith(": x\n") and r.b.startswith("<13>")
    n = normalized(spark, [r.a])[0]
    assert (n.message, n.pri, n.header) == ("up again", 84, "<84>Mar 04 05:06:07 lab9 job:")


def test_one_pattern_for_each_line(spark):
    df = spark.createDataFrame([("<13>x", {})], "payload string, tags map<string,string>")
    for mode in ("skip", "tag"):
        plan = syslog.apply_header_mode(df, mode)._jdf.queryExecution().optimizedPlan().toString()
        assert len(re.findall("(?i)regexp_|rlike", plan)) == 1
    r = df.select(syslog.normalize(F.lit(None).cast("string")).alias("n"), syslog.strip_lenient(F.lit(None).cast("string")).alias("s")).first()
    assert r.n is None and r.s is None


def scan_5424(s):
    """A byte walk, to hold the pattern against."""
    m = re.match(r"<([0-9]*)>", s)
    if not m:
        return None
    rest = s[m.end() :]
    v = re.match(r"[0-9]+ ", rest)
    if not v:
        return None
    rest = rest[v.end() :]
    for _ in range(5):
        if " " not in rest:
            return None
        rest = rest.split(" ", 1)[1]
    if rest[:1] == "-":
        rest = rest[1:]
    elif rest[:1] == "[" and "]" in rest:
        rest = rest.split("]", 1)[1]
    else:
        return None
    return rest[1:] if rest[:1] == " " else rest


def test_pattern_against_walk(spark):
    rng = random.Random(5)
    lines = []
    for _ in range(4000):
        s = list("".join(rng.choice([parts_5424, parts_5424, parts_3164])(rng)) + rng.choice(["", " ", " m\nn"]))
        for _ in range(rng.randint(0, 3)):
            i = rng.randrange(len(s) + 1)
            s[i : i + rng.randint(0, 2)] = rng.choice(["", " ", "-", "[", "]", ">", "<", ":", ": ", "7", "\n", "é"])
        lines.append("".join(s))
    df = spark.createDataFrame(list(enumerate(lines)), "i int, line string")
    got = [r.m for r in df.select("i", syslog.parse_rfc5424(F.col("line"))["message"].alias("m")).orderBy("i").collect()]
    assert got == [scan_5424(x) for x in lines] and sum(x is not None for x in got) > 500
