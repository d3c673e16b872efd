import os
import socket
import socketserver
import tempfile
import threading

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparklog.operators import events as ev
from sparklog.sinks import files as sink_files
from sparklog.sinks import net, options, text
from sparklog.sources import arrow, files
from sparklog.streaming.reframe import reframe_stream
from sparklog.functions import syslog


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="spark-io-")


def put(folder, name, data):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)
    return path


def test_lines(spark, rows, folder):
    put(folder, "b.log", b"b1\r\nb\rx\n\nb3")
    put(folder, "a.log", b"a1\n\xff\n")
    put(folder, "sub/a.log", b"s1\n")
    put(folder, "c.txt", b"no\n")
    got = files.read_lines(spark, "*.log", folder)
    ordered = got.orderBy("file_seq", "block", "line_id").select("payload").collect()
    assert [bytes(r.payload) for r in ordered] == [b"a1", b"\xff", b"b1", b"b\rx", b"", b"b3"]
    both = files.read_lines(spark, "{a.log,sub/a.log}", folder)
    assert [bytes(r.payload) for r in both.orderBy("file_seq", "line_id").select("payload").collect()] == [b"a1", b"\xff", b"s1"]


def test_line_splits_do_not_matter(spark, rows, folder):
    data = b"".join(b"line %d\n" % i for i in range(20000))
    put(folder, "x.log", data)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        got = files.read_text_events(spark, "x.log", folder, tags=["zone:north", "rack=b7"], instances=40)
        assert files.read_lines(spark, "x.log", folder).select("block").distinct().count() > 5
        assert rows(got.select("payload")) == sorted(((x,) for x in data.splitlines()), key=repr)
        tags = got.first().tags
        assert tags["zone"] == "north" and tags["rack"] == "b7" and tags["access_source"].endswith("x.log")
        assert got.select("event_id").distinct().count() == 20000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_source_errors(spark, folder):
    for call in (lambda: files.resolve("a", "/tmp/*"), lambda: files.resolve("a", path="x"), lambda: files.data_format("xml"), lambda: files.read_text_events(spark, "a", folder, encode="rot")):
        with pytest.raises(ValueError):
            call()
    with pytest.raises(Exception):
        files.read_lines(spark, "none*.log", folder).count()
    assert files.data_format(None) == "ndjson"


def test_whole_files(spark, folder):
    put(folder, "1.bin", b"one")
    put(folder, "2.bin", b"")
    put(folder, "3.bin", b"three")
    got = files.read_whole_files(spark, "*.bin", folder, "in").orderBy("file_seq").collect()
    assert [(bytes(r.payload), r.src_key.rsplit("-", 1)[0]) for r in got] == [(b"one", "in"), (b"three", "in")]


def stream(*batches):
    return arrow.encode_stream([pa.RecordBatch.from_pydict(b) for b in batches])


def payloads(spark, *data):
    return spark.createDataFrame([(bytearray(d),) for d in data], "payload binary")


X = T.StructType([T.StructField("x", T.StringType())])


def test_arrow_streams(spark, rows):
    ab, c = {"x": ["a", "b"]}, {"x": ["c"]}
    assert rows(arrow.decode_arrow(payloads(spark, stream(ab, c)))) == [("a",), ("b",), ("c",)]
    assert rows(arrow.decode_arrow(payloads(spark, stream(ab), stream(c)))) == [("a",), ("b",), ("c",)]
    two = stream(ab) + stream(c)
    assert len(rows(arrow.decode_arrow(payloads(spark, two)))) == 3
    assert len(rows(arrow.decode_arrow(payloads(spark, two), segments="first"))) == 2
    empty = pa.BufferOutputStream()
    pa.ipc.new_stream(empty, pa.schema([("x", pa.string())])).close()
    assert arrow.decode_arrow(payloads(spark, empty.getvalue().to_pybytes())).count() == 0
    with pytest.raises(Exception):
        arrow.decode_arrow(payloads(spark, b"ARROW?? not really"), X).collect()
    cut = stream(ab) + b"ARROW?? not really"
    assert len(rows(arrow.decode_arrow(payloads(spark, cut), X, on_error="keep_prefix"))) == 2
    ns = stream({"t": pa.array([1_700_000_000_123_456_789], pa.timestamp("ns")), "u": pa.array([7], pa.uint8())})
    r = arrow.decode_arrow(payloads(spark, ns)).first()
    assert r.t.microsecond == 123456 and r.u == 7


def test_arrow_frames(spark, rows):
    batch = pa.RecordBatch.from_pydict({"x": ["a"]})
    good, blank = arrow.encode_frame("my_tag", [batch]), arrow.encode_frame("", [batch])
    df = payloads(spark, good, blank, b"\0\0", b"\xff\xff\xff\xff\0")
    assert rows(arrow.decode_arrow(df, X, wire="arrow_framed", tag="tag")) == [("", "a"), ("my_tag", "a")]
    assert rows(arrow.count_skipped_frames(df)) == [(4, 2)]
    assert arrow.encode_frame("header", []) == b"\0\0\0\x06header"
    with pytest.raises(Exception):
        arrow.decode_arrow(payloads(spark, b"\0\0\0\x01tbroken body"), X, wire="arrow_framed").collect()


def test_exact_nanoseconds(spark):
    times = [1_700_000_000_123_456_789, -1, None]
    batch = pa.record_batch([pa.array(times, pa.timestamp("ns")), pa.array([1, 2, 3])], names=["at", "n"])
    df = spark.createDataFrame([(bytearray(arrow.encode_stream([batch])),)], "payload binary")
    assert arrow.decode_arrow(df).columns == ["at", "n"]
    got = arrow.decode_arrow(df, exact_ns=True)
    assert got.columns == ["at", "at_ns", "n"] and [r.at_ns for r in got.orderBy("n").collect()] == times


def test_ids_do_not_change_with_other_files(spark, folder):
    put(folder, "m.log", b"".join(b"m %d\n" % i for i in range(2000)))
    ids = lambda: {(bytes(r.payload), r.event_id) for r in files.read_text_events(spark, "*.log", folder).collect() if r.payload.startswith(b"m ")}
    before = ids()
    put(folder, "a.log", b"a\n" * 500)
    put(folder, "z.log", b"z\n" * 5)
    assert ids() == before and len(before) == 2000


def test_file_sinks(spark, rows, folder):
    sink_files.register(spark)
    df = spark.range(5).select(F.col("id").cast("string").alias("value")).coalesce(1)
    for _ in range(2):
        df.write.format("file_lines").options(base=folder, file="out/x.dat").mode("append").save()
    for name in ("x.dat", "x.2.dat"):
        with open(f"{folder}/out/{name}", "rb") as f:
            assert f.read() == b"0\n1\n2\n3\n4\n"
    spark.range(6).select(F.col("id").cast("string").alias("value")).repartition(2).write.format("file_lines").options(base=folder, file="out/two.dat").mode("append").save()
    assert {x for x in os.listdir(f"{folder}/out") if x.startswith("two")} == {"two-r1.dat", "two-r2.dat"}
    with pytest.raises(Exception):
        spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("stop"))).otherwise("x").alias("value")).coalesce(1).write.format("file_lines").options(base=folder, file="out/bad.dat").mode("append").save()
    assert not [x for x in os.listdir(f"{folder}/out") if x.startswith("bad")]
    foreign = put(folder, "out/other.dat.lock", b"")
    one = spark.range(1).coalesce(1)
    for _ in range(2):
        one.write.format("file_arrow").options(base=folder, file="out/a.arrow").mode("append").save()
    d = spark.read.format("binaryFile").load(f"{folder}/out/a*.arrow").select(F.col("content").alias("payload"))
    assert d.count() == 2 and arrow.decode_arrow(d).count() == 2
    both = d.agg(F.expr("concat(max(payload), min(payload))").alias("payload"))
    assert arrow.decode_arrow(both).count() == 2 and arrow.decode_arrow(both, segments="first").count() == 1
    spark.range(0).coalesce(1).write.format("file_arrow").options(base=folder, file="none.arrow").mode("append").save()
    assert not [x for x in os.listdir(folder) if x.startswith("none")]
    spark.createDataFrame([], "x int").repartition(1).write.format("file_arrow").options(base=folder, file="f.arrow", data_format="arrow_framed", tag="header").mode("append").save()
    assert not [x for x in os.listdir(f"{folder}/out") if x.endswith(".lock") and x != os.path.basename(foreign)]
    assert sink_files.replica_name("d/lines.csv", 3, 5) == "d/lines-r3.csv" and sink_files.replica_name("d/lines", 1, 1) == "d/lines"
    assert sink_files.replica_name("d/lines.csv.lock", 3, 5) == "d/lines-r3.csv.lock"
    text.write_raw(spark.createDataFrame([("a\n",), ("b",)], "payload string"), f"{folder}/raw")
    assert sorted(r.value for r in spark.read.text(f"{folder}/raw").collect()) == ["a", "b"]
    text.drop_all(df)


def test_options():
    for bad in ({}, {"addr": "h", "port": "70000"}, {"addr": "h", "port": "x"}, {"addr": "h", "protocol": "smoke"}):
        with pytest.raises(ValueError):
            options.tcp_options(bad)
    for bad in ({"addr": "h", "protocol": "smoke"}, {"addr": "h", "port": "70000"}, {"addr": "h", "app_name": "7"}):
        with pytest.raises(ValueError):
            options.syslog_options(bad)
    assert options.syslog_options({"addr": "h"})["port"] == 514 and options.tcp_options({"addr": "h"})["port"] == 9000
    with pytest.raises(ValueError):
        options.file_options({"protocol": "arrow"})


class Server:
    """Collects what TCP clients send."""

    def __enter__(self):
        self.data = []
        outer = self

        class Handler(socketserver.BaseRequestHandler):
            def handle(self):
                got = b""
                while part := self.request.recv(65536):
                    got += part
                outer.data.append(got)

        self.server = socketserver.ThreadingTCPServer(("127.0.0.1", 0), Handler)
        self.port = self.server.server_address[1]
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        return self

    def __exit__(self, *_):
        self.server.shutdown()
        self.server.server_close()


def test_tcp(spark):
    net.register(spark)
    df = spark.range(300).select(F.concat(F.lit("m"), F.col("id").cast("string")).alias("value")).repartition(2)
    for framing in ("line", "len"):
        with Server() as s:
            df.write.format("tcp_lines").options(addr="127.0.0.1", port=s.port, framing=framing).mode("append").save()
        from sparklog.operators.framing import split_frames

        got = [m for d in s.data for m in split_frames(d, framing)[0]]
        assert sorted(got) == sorted(b"m%d" % i for i in range(300))
    with Server() as s:
        spark.range(6).select("id", (F.col("id") % 2).cast("string").alias("kind")).coalesce(1).write.format("tcp_lines").options(addr="127.0.0.1", port=s.port, protocol="arrow", data_format="arrow_framed", tag_column="kind").mode("append").save()
    frames = [arrow.unframe(f) for f in split_frames(s.data[0], "len")[0]]
    assert {t: sum(b.num_rows for b in arrow.stream_batches(x)) for t, x in frames} == {"0": 3, "1": 3}


def test_retry_and_failure(spark):
    probe = socket.socket()
    probe.bind(("127.0.0.1", 0))
    port = probe.getsockname()[1]
    probe.close()
    with pytest.raises(OSError):
        net.Connection("127.0.0.1", port, attempts=2, first_wait=0.05).send(b"x")


def test_connects_anew(monkeypatch):
    """A server that is away three times: waits double up to a bound, and nothing is lost."""
    with Server() as s:
        waits, connect, away = [], socket.create_connection, [3]

        def flaky(to, timeout):
            if away[0]:
                away[0] -= 1
                raise ConnectionRefusedError
            return connect(to, timeout)

        monkeypatch.setattr(net.time, "sleep", waits.append)
        monkeypatch.setattr(net.socket, "create_connection", flaky)
        c = net.Connection("127.0.0.1", s.port)
        c.send(b"one ")
        assert waits == [1.0, 2.0, 4.0]
        # The connection breaks: the next send connects anew.
        c.socket.shutdown(socket.SHUT_RDWR)
        c.send(b"two")
        c.close()
        long = net.Connection("127.0.0.1", s.port, attempts=8)
        away[0], waits[:] = 7, []
        long.send(b"!")
        assert waits == [1.0, 2.0, 4.0, 8.0, 16.0, 30.0, 30.0]
        long.close()
        for _ in range(100):
            if sorted(s.data) == [b"!", b"one ", b"two"]:
                break
            threading.Event().wait(0.1)
    assert sorted(s.data) == [b"!", b"one ", b"two"]


def test_syslog_out(spark):
    df = spark.createDataFrame([("one",), ("two",), ("three",)], "m string").withColumn("ts", F.lit("2024-01-02 03:04:05").cast("timestamp")).coalesce(1)
    with Server() as s:
        net.write_syslog(df, "m", "ts", addr="127.0.0.1", port=s.port, protocol="tcp", app_name="lab")
    assert s.data[0].count(b"\n") == 3 and b"<13>Jan 02 03:04:05 localhost lab: one\n" in s.data[0]
    udp = socket.socket(socket.AF_INET, socket.SOCK_DGRAM)
    udp.bind(("127.0.0.1", 0))
    udp.settimeout(10)
    net.write_syslog(df, "m", "ts", addr="127.0.0.1", port=udp.getsockname()[1])
    got = sorted(udp.recv(65536) for _ in range(3))
    assert all(not g.endswith(b"\n") for g in got) and got[0].endswith(b": one")


def test_events(spark, rows):
    df = spark.createDataFrame([("1.2.3.4", bytearray(b"<13>Oct 11 22:14:15 h a: b\n"), False), ("bad", bytearray(b"x"), False), ("1.1.1.1", bytearray(b"y"), True), ("1.1.1.1", bytearray(b"z" * 65536), None)], "ip string, bytes binary, truncated boolean")
    got = ev.udp_syslog(df, "tag", tags=["env=lab"])
    assert sorted((bytes(r.payload), r.ups_ip, r.tags["access_ip"], r.tags["env"], r.tags.get("syslog.pri")) for r in got.collect()) == [(b"b\n", "1.2.3.4", "1.2.3.4", "lab", "13"), (b"x", "127.0.0.1", "127.0.0.1", "lab", None)]
    chunks = spark.createDataFrame([("c", 0, "::1", bytearray(b"one\ntw")), ("c", 1, "::1", bytearray(b"o\n"))], "conn string, seq long, ip string, bytes binary")
    got = ev.tcp_messages(chunks, "in", instances=3)
    assert sorted(bytes(r.payload) for r in got.collect()) == [b"one", b"two"] and all(r.src_key == "in#" + r.tags["instance"] for r in got.collect())
    assert {r.tags.get("access_ip") for r in ev.tcp_syslog(chunks, "skip").collect()} == {None}
    assert rows(spark.createDataFrame([("x",), ("9.9.9.9",)], "ip string").select(ev.ip_text(F.col("ip")))) == [("9.9.9.9",), ("unknown",)]


def test_stream_restart(spark, rows, folder):
    """A frame cut between micro-batches, the query stopped between them."""
    schema = T.StructType([T.StructField("conn", T.StringType()), T.StructField("seq", T.LongType()), T.StructField("bytes", T.BinaryType())])
    parts = [[("a", 0, bytearray("11 hé".encode()[:5])), ("b", 0, bytearray(b"x\ny"))], [("a", 1, bytearray("11 hé".encode()[5:] + b" world!!")), ("b", 1, bytearray(b"\n"))]]
    for i, part in enumerate(parts):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{folder}/in/{i}")
        stream = reframe_stream(spark.readStream.schema(schema).parquet(f"{folder}/in/*"))
        q = stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
        q.awaitTermination()
    got = rows(spark.read.parquet(f"{folder}/out"))
    assert got == [("a", 0, "hé world!!".encode()), ("b", 0, b"x"), ("b", 1, b"y")]


def test_stream_headers(spark, folder):
    schema = T.StructType([T.StructField("payload", T.StringType())])
    spark.createDataFrame([("<13>Oct 11 22:14:15 host app: body",)], schema).write.parquet(f"{folder}/in")
    out = syslog.apply_header_mode(spark.readStream.schema(schema).parquet(f"{folder}/in"), "tag")
    q = out.writeStream.format("memory").queryName("heads").trigger(availableNow=True).start()
    q.awaitTermination()
    r = spark.table("heads").first()
    assert r.payload == "body" and r.tags["syslog.severity"] == "notice"


def test_counted(spark):
    from pyspark.sql import Observation

    df = spark.createDataFrame([("ab",), ("cde",)], "payload string")
    seen = Observation("egress")
    watched = text.counted(df, "payload", seen)
    watched.collect()
    assert seen.get["sent"] == 2 and seen.get["bytes"] == 5
