"""Typed columns: random values against the rules of each type, written out in Python."""

import datetime
import json
import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparklog.functions import coerce, payload
from sparklog.operators import ndjson, records
from sparklog.sinks import text

KINDS = {"t": T.StringType(), "i": T.LongType(), "f": T.DoubleType(), "b": T.BooleanType(), "w": T.TimestampNTZType()}
SCHEMA = T.StructType([T.StructField(k, v) for k, v in KINDS.items()])


def table(spark, *lines, **more):
    return ndjson.ndjson_to_table(spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1), SCHEMA, **more)


# What a JSON value becomes, by type. A value is its JSON text; a text's own characters where it is a string.


def as_text(v):
    return v if isinstance(v, str) else json.dumps(v, separators=(",", ":"), ensure_ascii=False)


def as_long(v):
    """A whole number written with digits and a sign only, within 64 bits."""
    s = as_text(v)
    return int(s) if re.fullmatch("[+-]?[0-9]+", s) and -(1 << 63) <= int(s) < 1 << 63 else None


def as_double(v):
    """A decimal number, or inf, infinity or nan in any case."""
    s = as_text(v)
    ok = re.fullmatch(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?", s, re.A) or re.fullmatch("[+-]?(inf|infinity|nan)", s, re.I)
    return float(s) if ok and not isinstance(v, (bool, list, dict)) else None


def as_bool(v):
    """true or false, as such or as text, in small letters."""
    return {"true": True, "false": False}.get(as_text(v))


VALUES = [0, -7, 31, 2**62, 2**70, 1.5, -2.5e-3, True, False, "0", "+12", "-12", "12 ", " 12", "1e2", ".5", "5.", "0x1", "12d", "true", "false", "True", "no", "inf", "-Infinity", "NaN", "infinit", "", "é\"\\", [1, "a"], {"k": {"l": [None]}}, 9223372036854775807, "9223372036854775808", "-9223372036854775808"]


@pytest.mark.parametrize("field,rule", [("t", as_text), ("i", as_long), ("f", as_double), ("b", as_bool)])
def test_every_value_under_every_type(spark, field, rule):
    got = [r[field] for r in table(spark, *(json.dumps({"more": 1, field: v}) for v in VALUES)).collect()]
    plain = lambda x: None if x is None else repr(x)
    want = [rule(v) for v in VALUES]
    if field == "t":
        # Spark writes numbers its own way; their value counts.
        keep = [i for i, v in enumerate(VALUES) if not isinstance(v, float)]
        got, want = [got[i] for i in keep], [want[i] for i in keep]
    assert list(map(plain, got)) == list(map(plain, want))


def test_times(spark):
    """RFC 3339 with a zone; seconds up to 60; nothing else."""
    rng = random.Random(2)
    lines, want = [], []
    for _ in range(60):
        utc = datetime.datetime(1970, 1, 1) + datetime.timedelta(seconds=rng.randrange(0, 2**32), microseconds=rng.randrange(10**6))
        shift = rng.choice([0, 90, -330, 720])
        there = utc + datetime.timedelta(minutes=shift)
        zone = rng.choice("Zz") if shift == 0 else f"{'+' if shift > 0 else '-'}{abs(shift) // 60:02d}:{abs(shift) % 60:02d}"
        lines.append(there.strftime(f"%Y-%m-%d{rng.choice('Tt ')}%H:%M:%S.%f") + zone)
        want.append(utc)
    for bad in ("2020-05-06T07:08:09", "2020-05-06", "07:08:09Z", "2020-5-6T07:08:09Z", "20200506T070809Z", "1588748889", "3000-01-01T00:00:00Z"):
        lines.append(bad)
        want.append(None)
    lines.append("2016-12-31T23:59:60Z")
    want.append(datetime.datetime(2017, 1, 1))
    assert [r.w for r in table(spark, *(json.dumps({"w": x}) for x in lines)).collect()] == want


def test_rows(spark, rows):
    """Missing fields and nulls are null, others are ignored, no lines give no rows, of a key that repeats the last holds."""
    assert rows(table(spark, "{}", '{"z":5}', '{"i":null}', ' {"i":1,"i":2} ')) == sorted([(None,) * 5] * 3 + [(None, 2, None, None, None)], key=repr)
    assert table(spark).count() == 0


NO_OBJECT = ["", "  ", "plain words", "[]", '[{"i":1}]', "7", "null", '"i"', '{"i":7} 8', '{"i":7},{"i":8}', "{", '{"i":}', "{'i':7,}"]


@pytest.mark.parametrize("line", NO_OBJECT)
def test_lines_that_are_no_object(spark, line):
    with pytest.raises(Exception):
        table(spark, line).collect()
    good, bad = ndjson.split_good_bad(table(spark, line, '{"i":3}', on_error="rescue"))
    assert [r.i for r in good.collect()] == [3]
    assert [(r.error_class, r.raw) for r in bad.collect()] == [("decode", line)]


def test_declared_types(spark):
    lines = spark.createDataFrame([("{}",)], "value string")
    for kind in (T.DateType(), T.IntegerType(), T.ArrayType(T.LongType())):
        with pytest.raises(ValueError, match=re.escape(kind.simpleString())):
            ndjson.ndjson_to_table(lines, T.StructType([T.StructField("d", kind)]))
    with pytest.raises(Exception, match="declared not null"):
        ndjson.ndjson_to_table(lines, T.StructType([T.StructField("q", T.LongType(), False)])).collect()


def test_line_decoding(spark):
    df = spark.createDataFrame([(" aGk= ", "aGk", " 6869 ", "abc", "aGl=")], "b string, b_bad string, h string, h_bad string, b_bits string")
    r = df.select(payload.decode_base64(F.col("b")).alias("b"), payload.decode_base64(F.col("b_bad"), "null").alias("x"), payload.decode_hex(F.col("h")).alias("h"), payload.decode_hex(F.col("h_bad"), "null").alias("y"), payload.decode_base64(F.col("b_bits"), "null").alias("z")).first()
    assert (bytes(r.b), r.x, bytes(r.h), r.y, r.z) == (b"hi", None, b"hi", None, None)
    for bad in (payload.decode_base64(F.col("b_bad")), payload.decode_hex(F.col("h_bad"))):
        with pytest.raises(Exception):
            df.select(bad).collect()
    with pytest.raises(ValueError):
        payload.decode_line(F.col("b"), "rot13")


def test_tags_and_text(spark):
    df = spark.createDataFrame([(["zone:north", "p:q=r", "bare", "zone=south", "=v"], bytearray(b"\xffA"))], "t array<string>, p binary")
    r = df.select(payload.parse_tags(F.col("t")).alias("t"), payload.payload_to_text(F.col("p")).alias("p")).first()
    assert r.t == {"zone": "south", "p:q": "r", "": "v"} and r.p == "�A"


# What a record's value becomes, by the kind it says it is.


def out_long(v, meta):
    if meta == "float":
        x = float(v)
        return 0 if x != x else max(-(1 << 63), min((1 << 63) - 1, int(x) if abs(x) < 1e30 else (1 << 63 if x > 0 else -(1 << 63))))
    return as_long(v) if meta in ("digit", "chars", "ip") else None


def out_bool(v, meta):
    return v.lower() == "true" if meta in ("bool", "chars", "ip") else None


def out_double(v, meta):
    return as_double(v) if meta in ("digit", "float", "chars", "ip") else None


def test_record_numbers(spark):
    given = {"digit": ["0", "-31", "9223372036854775807"], "float": ["2.75", "-2.75", "4e200", "-4e200", "NaN"], "bool": ["true", "false"], "chars": ["88", "8.5", "eight", "TRUE", "tRuE", "nope", "-Inf"], "ip": ["1.2.3.4"], "hex": ["10"], "obj": ["{}"]}
    cases = [(m, v) for m, vs in given.items() for v in vs]
    df = spark.createDataFrame(cases, "m string, v string").coalesce(1)
    m, v = F.col("m"), F.col("v")
    for kind, rule in ((T.LongType(), out_long), (T.DoubleType(), out_double), (T.BooleanType(), out_bool)):
        got = [r.x for r in df.select(coerce.egress(v, m, kind).alias("x")).collect()]
        assert list(map(repr, got)) == [repr(rule(x, k)) for k, x in cases]
    # Ports wrap into 32 bits, or with strict are null.
    wide = [0, 2**31 - 1, 2**31, 2**32 + 5, -(2**31) - 1, 2**63 - 1]
    df = spark.createDataFrame([(str(x),) for x in wide], "v string").coalesce(1)
    got = df.select(coerce.out_int(v, F.lit("digit")).alias("a"), coerce.out_int(v, F.lit("digit"), strict=True).alias("b")).collect()
    assert [r.a for r in got] == [(x + 2**31) % 2**32 - 2**31 for x in wide]
    assert [r.b for r in got] == [x if -(2**31) <= x < 2**31 else None for x in wide]


def test_record_times_and_bytes(spark):
    at = datetime.datetime(2033, 4, 5, 6, 7, 8)
    ms = int((at - datetime.datetime(1970, 1, 1)).total_seconds() * 1000)
    times = [("chars", "2033-04-05T08:07:08+02:00", at), ("chars", "2033-04-05 06:07:08", at), ("digit", str(ms), at), ("digit", str(ms + 9), at + datetime.timedelta(milliseconds=9)), ("chars", "soon", None), ("float", "1.5", None), ("bool", "true", None)]
    # Hex is a number, high byte first, without leading zeros; anything else is its own bytes.
    bytes_ = [("hex", f"{n:x}", n.to_bytes(max(1, (n.bit_length() + 7) // 8), "big")) for n in (0, 1, 255, 256, 0xABCDE, 2**127 - 1)] + [("hex", "0x0007", b"\x07"), ("chars", "zé", "zé".encode()), ("digit", "12", b"12")]
    for kind, cases in ((T.TimestampNTZType(), times), (T.BinaryType(), bytes_)):
        df = spark.createDataFrame([c[:2] for c in cases], "m string, v string").coalesce(1)
        got = [r.x for r in df.select(coerce.egress(F.col("v"), F.col("m"), kind).alias("x")).collect()]
        assert [bytes(x) if isinstance(x, bytearray) else x for x in got] == [c[2] for c in cases]


def test_nested_values_are_json(spark):
    """Arrays, maps and structs as JSON, the rest as its text; what is null is missing."""
    df = spark.range(1).select(
        F.struct(F.lit(1).alias("p"), F.array(F.lit("q"), F.lit('r"')).alias("s")).alias("o"), F.array(F.lit(1.5), F.lit(2.0)).alias("l"), F.create_map(F.lit("k"), F.struct(F.lit(True).alias("x"))).alias("m"),
        F.lit(None).cast("struct<a:int>").alias("none"), F.array().cast("array<int>").alias("empty"), F.lit(4).alias("n"), F.lit("[text").alias("t"),
    )
    rec = df.select(records.record([(c, "auto", F.col(c)) for c in df.columns]).alias("rec")).first().rec
    assert {f.name: f.value for f in rec} == {"o": '{"p":1,"s":["q","r\\""]}', "l": "[1.5,2.0]", "m": '{"k":{"x":true}}', "empty": "[]", "n": "4", "t": "[text"}


def test_schema_of_first(spark):
    """The record of the smallest order key says which columns there are; kinds in any case; what is to be ignored is left out."""
    def rec(**fields):
        return [{"name": k, "meta": m, "value": v} for k, (m, v) in fields.items()]

    given = [(7, rec(late=("chars", "x"))), (3, rec(no=("DIGIT", "6"), drop=("Ignore", "z"), when=("time_iso", "2033-04-05 06:07:08"), many=("array<int>", "[1]")))]
    df = spark.createDataFrame(given, T.StructType([T.StructField("o", T.IntegerType()), T.StructField("rec", records.RECORD)]))
    schema = records.schema_of_first(df, "o")
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in schema] == [("no", "bigint", True), ("when", "timestamp_ntz", True), ("many", "string", True)]
    got = {r.o: (r.no, r.many) for r in records.records_to_table(df, schema, keep=("o",)).collect()}
    assert got == {3: (6, "[1]"), 7: (None, None)}
    empty = records.empty_table(spark, schema)
    assert empty.count() == 0 and empty.schema == schema
    with pytest.raises(ValueError):
        coerce.record_type("other")
    assert len(coerce.RECORD_TYPES) == 35


def test_formats(spark):
    df = spark.createDataFrame([(1, 'a "q", b\nc', None, True)], "n int, s string, z string, b boolean")
    line = {f: text.format_lines(df, f).first().value for f in text.FORMATS}
    assert line["kv"] == 'n: 1, s: "a \\"q\\", b\\nc", b: true'
    assert line["proto-text"] == 'n: 1 s: "a \\"q\\", b\\nc" b: true'
    assert line["json"] == '{"n":1,"s":"a \\"q\\", b\\nc","b":true}'
    assert "\n" not in line["raw"] and line["raw"].startswith('1 a "q", b c')
    with pytest.raises(ValueError):
        text.format_lines(df, "xml")


def test_times_of_whole_numbers_reach_as_far_as_microseconds(spark):
    epoch, day = datetime.datetime(1970, 1, 1), 86_400_000
    given = [n for k in (0, 106_751, 106_752, 900_000, 2_932_896, -106_753, -719_000) for n in (k * day, k * day - 1, k * day + 5)]
    out = coerce.out_timestamp(F.col("v"), F.lit("digit"))
    got = spark.createDataFrame([(str(n),) for n in given], "v string").select("v", out.alias("at")).collect()
    assert {r.v: r.at for r in got} == {str(n): epoch + datetime.timedelta(milliseconds=n) for n in given}
    most = 9_223_372_036_854_775
    ends = [most, most + 1, -most, -most - 1, 106_751_991 * day - 1, 2**63 - 1, -(2**63)]
    at = F.expr("unix_micros(cast(at as timestamp))").alias("us")
    got = spark.createDataFrame([(str(n),) for n in ends], "v string").select("v", out.alias("at")).select("v", at).collect()
    assert {r.v: r.us for r in got} == {str(n): n * 1000 if abs(n) <= most else None for n in ends}
