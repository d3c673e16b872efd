"""Registered queries over the library's operators, each with the same rows as DuckDB SQL where SQL can say it."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from sparklog.functions import coerce, payload, syslog
from sparklog.operators import events as ev
from sparklog.operators import framing, ndjson, records
from sparklog.sinks import files as sink_files
from sparklog.sinks import net, text
from sparklog.sinks import published as sink_published
from sparklog.sources import arrow, files
from sparklog.streaming.records import write_records
from sparklog.streaming.reframe import reframe_stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession) -> str:
    """A new folder under the one that all executors share, or a temporary one where none is set and Spark runs in one process."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="spark-work-")
    return f"{base.rstrip('/')}/work-{uuid.uuid4().hex}"


def local(path: str) -> str:
    """The path of a file: address, for sinks that write with the operating system's calls; other schemes are refused."""
    scheme, colon, rest = path.partition(":")
    if colon and "/" not in scheme and scheme != "file":
        raise ValueError(f"named files need a mounted folder, not {path!r}")
    return "/" + rest.lstrip("/") if scheme == "file" and colon else path


# --- syslog -----------------------------------------------------------------

MESSAGE = "event_type || ' ' || user_id"
ENCODED = "'<' || (event_id % 192) || '>' || strftime(ts, '%b %d %H:%M:%S') || ' host' || (user_id % 5) || ' app: ' || event_type || ' ' || user_id"
#: One line in five has no month that exists, one in five no priority, one in five is in the newer form.
LINES_SQL = f"""SELECT event_id, CASE event_id % 5
    WHEN 0 THEN {ENCODED}
    WHEN 1 THEN replace({ENCODED}, strftime(ts, '%b'), 'Xyz')
    WHEN 2 THEN '<>1 ' || event_id || ' h a p m [x y][z] ' || event_type
    WHEN 3 THEN '<' || (event_id % 70000) || '>1 2024-01-01T00:00:00Z host app ' || user_id || ' - - ' || event_type || chr(10) || 'more'
    ELSE event_type || ': plain > text: ' || user_id END AS line FROM events"""
R5424, R3164 = syslog.R5424, syslog.R3164
IS5, IS3 = f"regexp_matches(line, '{R5424}')", f"regexp_matches(line, '{R3164}')"
PRI_TEXT = f"CASE WHEN {IS5} THEN regexp_extract(line, '{R5424}', 1) WHEN {IS3} THEN regexp_extract(line, '{R3164}', 1) END"
BODY = f"CASE WHEN {IS5} THEN regexp_extract(line, '{R5424}', 2) WHEN {IS3} THEN regexp_extract(line, '{R3164}', 2) ELSE line END"
FACILITIES = "[" + ", ".join(f"'{x}'" for x in syslog.FACILITIES) + "]"
SEVERITIES = "[" + ", ".join(f"'{x}'" for x in syslog.SEVERITIES) + "]"


def decoded_sql(pri: str) -> str:
    return (
        f"CAST({pri} & 255 AS INT) AS pri, CASE WHEN {pri} IS NULL THEN NULL ELSE coalesce({FACILITIES}[CAST(({pri} // 8) % 256 + 1 AS INT)], 'unknown') END AS facility, "
        f"{SEVERITIES}[CAST({pri} % 8 + 1 AS INT)] AS severity"
    )


def encoded(events: DataFrame):
    message = F.concat("event_type", F.lit(" "), F.col("user_id").cast("string"))
    return syslog.encode_rfc3164(message, F.col("ts"), F.col("event_id") % 192, F.concat(F.lit("host"), (F.col("user_id") % 5).cast("string")), "app")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    n, line = F.col("event_id"), encoded(e)
    out = (
        F.when(n % 5 == 0, line)
        .when(n % 5 == 1, F.replace(line, F.date_format("ts", "MMM"), F.lit("Xyz")))
        .when(n % 5 == 2, F.concat(F.lit("<>1 "), n.cast("string"), F.lit(" h a p m [x y][z] "), "event_type"))
        .when(n % 5 == 3, F.concat(F.lit("<"), (n % 70000).cast("string"), F.lit(">1 2024-01-01T00:00:00Z host app "), F.col("user_id").cast("string"), F.lit(" - - "), "event_type", F.lit("\nmore")))
        .otherwise(F.concat("event_type", F.lit(": plain > text: "), F.col("user_id").cast("string")))
    )
    return e.select("event_id", out.alias("line"))


@query(f"""WITH l AS (SELECT event_id, {ENCODED} AS line FROM events),
    p AS (SELECT TRY_CAST(regexp_extract(line, '{R3164}', 1) AS BIGINT) AS pri FROM l WHERE {IS3})
    SELECT facility, severity, count(*) AS n FROM (SELECT {decoded_sql('pri')} FROM p) GROUP BY ALL""")
def facility_severity_rollup(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    tagged = syslog.apply_header_mode(e.select(encoded(e).cast("binary").alias("payload")), "tag")
    return tagged.groupBy(F.col("tags")["syslog.facility"].alias("facility"), F.col("tags")["syslog.severity"].alias("severity")).agg(F.count("*").alias("n"))


@query(f"SELECT event_id, {ENCODED} AS line FROM events")
def syslog_encode(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_id", encoded(e).alias("line"))


@query(f"WITH l AS ({LINES_SQL}) SELECT event_id, regexp_extract(line, '{R5424}', 2) AS message, CASE WHEN TRY_CAST(nullif(regexp_extract(line, '{R5424}', 1), '') AS BIGINT) <= 65535 THEN TRY_CAST(nullif(regexp_extract(line, '{R5424}', 1), '') AS INT) END AS pri FROM l WHERE {IS5}")
def syslog_parse_5424(spark, sf_dir):
    return lines(spark, sf_dir).withColumn("p", syslog.parse_rfc5424(F.col("line"))).where("p IS NOT NULL").select("event_id", "p.message", "p.pri")


@query(f"WITH l AS ({LINES_SQL}) SELECT event_id, regexp_extract(line, '{R3164}', 2) AS message, TRY_CAST(regexp_extract(line, '{R3164}', 1) AS INT) AS pri FROM l WHERE {IS3}")
def syslog_parse_3164(spark, sf_dir):
    return lines(spark, sf_dir).withColumn("p", syslog.parse_rfc3164(F.col("line"))).where("p IS NOT NULL").select("event_id", "p.message", "p.pri")


NORMAL_SQL = f"""WITH l AS ({LINES_SQL}), p AS (SELECT event_id, line, {BODY} AS message, {PRI_TEXT} AS t FROM l),
    q AS (SELECT *, CASE WHEN TRY_CAST(nullif(t, '') AS BIGINT) <= 65535 THEN CAST(t AS BIGINT) END AS n FROM p)"""


@query(f"""{NORMAL_SQL} SELECT event_id, CASE WHEN t IS NOT NULL THEN regexp_replace(left(line, length(line) - length(message)), '\\s+$', '') END AS header, message,
    {decoded_sql('n')}, CAST(strlen(line) - strlen(message) AS INT) AS msg_start, CAST(strlen(line) AS INT) AS msg_end FROM q""")
def syslog_normalize(spark, sf_dir):
    return lines(spark, sf_dir).select("event_id", syslog.normalize(F.col("line")).alias("n")).select("event_id", "n.*")


@query(f"WITH p AS (SELECT event_id, event_id * 13 % 70000 AS x FROM events), q AS (SELECT event_id, CASE WHEN x <= 65535 THEN x END AS n FROM p) SELECT event_id, {decoded_sql('n')} FROM q")
def pri_decode(spark, sf_dir):
    p = syslog.priority((F.col("event_id") * 13 % 70000).cast("string"))
    return table(spark, sf_dir, "events").select("event_id", syslog.pri_value(p).alias("pri"), syslog.facility_name(p).alias("facility"), syslog.severity_name(p).alias("severity"))


def by_mode(spark, sf_dir, mode):
    rows = lines(spark, sf_dir).withColumn("tags", F.create_map(F.lit("a"), F.lit("b"))).withColumn("payload", F.col("line").cast("binary"))
    out = syslog.apply_header_mode(rows, mode)
    tag = lambda k: F.col("tags")[f"syslog.{k}"].alias(k)
    return out.select("event_id", F.col("payload").cast("string").alias("payload"), F.col("tags")["a"].alias("a"), tag("pri"), tag("facility"), tag("severity"))


@query(f"WITH l AS ({LINES_SQL}) SELECT event_id, line AS payload, 'b' AS a, CAST(NULL AS VARCHAR) AS pri, CAST(NULL AS VARCHAR) AS facility, CAST(NULL AS VARCHAR) AS severity FROM l")
def header_mode_raw(spark, sf_dir):
    return by_mode(spark, sf_dir, "keep")


@query(f"WITH l AS ({LINES_SQL}) SELECT event_id, {BODY} AS payload, 'b' AS a, CAST(NULL AS VARCHAR) AS pri, CAST(NULL AS VARCHAR) AS facility, CAST(NULL AS VARCHAR) AS severity FROM l")
def header_mode_skip(spark, sf_dir):
    return by_mode(spark, sf_dir, "Strip")


@query(f"{NORMAL_SQL} SELECT event_id, message AS payload, 'b' AS a, CAST(pri AS VARCHAR) AS pri, facility, severity FROM (SELECT event_id, message, {decoded_sql('n')} FROM q)")
def header_mode_tag(spark, sf_dir):
    return by_mode(spark, sf_dir, "parse")


@query(f"""WITH l AS ({LINES_SQL}), d AS (SELECT event_id, line FROM l UNION ALL SELECT -doc_id - 1, text FROM documents)
    SELECT event_id, CASE WHEN regexp_matches(line, '{syslog.LENIENT_5424}') THEN regexp_extract(line, '{syslog.LENIENT_5424}', 1)
      WHEN instr(line, '>') > 0 AND instr(line, ': ') > instr(line, '>') THEN substr(line, instr(line, ': ') + 2)
      WHEN instr(line, ' sender: ') > 0 THEN substr(line, instr(line, ' sender: ') + 9) ELSE {BODY} END AS message FROM d""")
def strip_lenient(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select((-F.col("doc_id") - 1).alias("event_id"), F.col("text").alias("line"))
    return lines(spark, sf_dir).unionByName(d).select("event_id", syslog.strip_lenient(F.col("line"), (" sender: ",)).alias("message"))


@query(f"""SELECT doc_id, CASE WHEN regexp_matches(line, '{syslog.LENIENT_5424}') THEN regexp_extract(line, '{syslog.LENIENT_5424}', 1)
      WHEN instr(line, '>') > 0 AND instr(line, ': ') > instr(line, '>') THEN substr(line, instr(line, ': ') + 2)
      WHEN instr(line, ' sender: ') > 0 THEN substr(line, instr(line, ' sender: ') + 9) ELSE {BODY} END AS message FROM (SELECT doc_id, text AS line FROM documents)""")
def strip_lenient_texts(spark, sf_dir):
    """Whole texts, of any length."""
    return table(spark, sf_dir, "documents").select("doc_id", syslog.strip_lenient(F.col("text"), (" sender: ",)).alias("message"))


@query("SELECT c_custkey, coalesce(nullif(trim(CASE c_custkey % 3 WHEN 0 THEN '  ' WHEN 1 THEN ' ' || c_mktsegment || ' ' END), ''), c_name) AS app FROM customer")
def app_names(spark, sf_dir):
    given = F.when(F.col("c_custkey") % 3 == 0, "  ").when(F.col("c_custkey") % 3 == 1, F.concat(F.lit(" "), "c_mktsegment", F.lit(" ")))
    return table(spark, sf_dir, "customer").select("c_custkey", syslog.resolved_app_name(given, F.col("c_name")).alias("app"))


# --- sources ----------------------------------------------------------------


@query("SELECT CASE WHEN event_id % 2 = 0 THEN 'even' ELSE 'odd' END AS source, event_type || ',' || event_id AS payload, 'x' AS env FROM events")
def text_scan(spark, sf_dir):
    e, d = table(spark, sf_dir, "events"), work_dir(spark)
    line = F.concat("event_type", F.lit(","), F.col("event_id").cast("string"), F.when(F.col("event_id") % 3 == 0, "\r").otherwise(""))
    for name, rest in (("even", 0), ("odd", 1)):
        e.where(F.col("event_id") % 2 == rest).select(line).write.option("lineSep", "\n").text(f"{d}/{name}")
    out = files.read_text_events(spark, "*/*.txt", d, tags=["env=x"], instances=4)
    source = F.element_at(F.split(F.col("tags")["access_source"], "/"), -2)
    return out.select(source.alias("source"), F.col("payload").cast("string").alias("payload"), F.col("tags")["env"].alias("env"))


@query("SELECT doc_id, text FROM documents")
def base64_lines(spark, sf_dir):
    d = table(spark, sf_dir, "documents").withColumn("line", F.concat(F.lit(" "), F.regexp_replace(F.base64(F.col("text").cast("binary")), "[\r\n]", "")))
    return d.select("doc_id", payload.decode_base64(F.col("line")).cast("string").alias("text"))


def encoded_scan(spark, sf_dir, encode):
    """Documents as lines of base64 or hex in files, decoded by the reader."""
    d = work_dir(spark)
    data = F.coalesce("text", F.lit("")).cast("binary")
    line = F.regexp_replace(F.base64(data), "[\r\n]", "") if encode == "base64" else F.hex(data)
    table(spark, sf_dir, "documents").select(F.concat(F.lit(" "), line)).write.option("lineSep", "\n").text(d)
    return files.read_text_events(spark, "*.txt", d, encode=encode).select(F.col("payload").cast("string").alias("text"))


@query("SELECT coalesce(text, '') AS text FROM documents")
def base64_scan(spark, sf_dir):
    return encoded_scan(spark, sf_dir, "base64")


@query("SELECT coalesce(text, '') AS text FROM documents")
def hex_scan(spark, sf_dir):
    return encoded_scan(spark, sf_dir, "hex")


@query("SELECT doc_id, CASE WHEN doc_id % 10 <> 0 THEN text END AS text FROM documents")
def hex_lines(spark, sf_dir):
    line = F.concat(F.hex(F.col("text").cast("binary")), F.when(F.col("doc_id") % 10 == 0, "0").otherwise(" "))
    return table(spark, sf_dir, "documents").select("doc_id", payload.decode_hex(line, "null").cast("string").alias("text"))


@query("SELECT p_partkey, coalesce(p_brand, '') AS b, p_type AS t, CAST(p_size AS VARCHAR) AS s FROM part")
def tags_parse(spark, sf_dir):
    items = F.array(F.lit("none"), F.concat(F.lit("b:"), "p_type"), F.concat(F.lit("b:"), F.coalesce("p_brand", F.lit(""))), F.concat(F.lit("k:t="), "p_type"), F.concat(F.lit("s="), F.col("p_size").cast("string")))
    tags = payload.parse_tags(items)
    return table(spark, sf_dir, "part").select("p_partkey", tags["b"].alias("b"), tags["k:t"].alias("t"), tags["s"].alias("s"))


@query("SELECT event_id, 'n' AS src_key, 'lab' AS env, event_type AS kind FROM events")
def event_envelope(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", F.col("props").alias("payload"), F.create_map(F.lit("kind"), F.col("event_type"), F.lit("id"), F.col("event_id").cast("string")).alias("tags"))
    out = ev.to_events(rows, "n", tags=["env:lab", "kind=none"])
    return out.select(F.col("tags")["id"].cast("long").alias("event_id"), "src_key", F.col("tags")["env"].alias("env"), F.col("tags")["kind"].alias("kind"))


@query(f"""{NORMAL_SQL.replace("events", "(SELECT * FROM events WHERE event_id % 7 <> 0)")} SELECT event_id, message, facility, '10.0.0.' || (event_id % 200) AS access_ip FROM (SELECT event_id, message, {decoded_sql('n')} FROM q)""")
def udp_syslog(spark, sf_dir):
    rows = lines(spark, sf_dir).select(F.concat(F.lit("10.0.0."), (F.col("event_id") % 200).cast("string")).alias("ip"), F.col("line").cast("binary").alias("bytes"), (F.col("event_id") % 7 == 0).alias("truncated"), "event_id")
    out = ev.udp_syslog(rows.withColumn("bytes", F.concat("bytes", F.lit("\u0001").cast("binary"), F.col("event_id").cast("string").cast("binary"))), "tag")
    parts = F.split(F.col("payload").cast("string"), "\u0001")
    return out.select(parts[1].cast("long").alias("event_id"), parts[0].alias("message"), F.col("tags")["syslog.facility"].alias("facility"), F.col("tags")["access_ip"].alias("access_ip"))


@query("SELECT CASE WHEN n > 1 THEN 'in-' || (part + 1) ELSE 'in' END AS src_key, count(*) AS n FROM (SELECT event_id % 3 AS part, 3 AS n FROM events) GROUP BY ALL")
def shard_keys(spark, sf_dir):
    return table(spark, sf_dir, "events").select(ev.shard_key("in", F.col("event_id") % 3, 3).alias("src_key")).groupBy("src_key").agg(F.count("*").alias("n"))


@query("SELECT user_id, (row_number() OVER (ORDER BY first, user_id) - 1) % 4 AS reader FROM (SELECT user_id, min(event_id) AS first FROM events GROUP BY 1)")
def reader_assignment(spark, sf_dir):
    conns = table(spark, sf_dir, "events").groupBy("user_id").agg(F.min("event_id").alias("first"))
    return framing.with_reader(conns, "user_id", "first", 4).select("user_id", "reader")


# --- framing ----------------------------------------------------------------


@query("WITH s AS (SELECT doc_id, string_split(replace(text, chr(13), ''), chr(10)) AS l FROM documents) SELECT doc_id, CAST(unnest(range(len(l) - 1)) AS INT) AS msg_no, unnest(l[:-2]) AS payload FROM s WHERE len(l) > 1")
def line_frames(spark, sf_dir):
    return framing.line_frames(table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("payload")))


@query("WITH s AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents), u AS (SELECT doc_id, CAST(unnest(range(len(l) - 1)) AS INT) AS msg_no, unnest(l[:-2]) AS p FROM s WHERE len(l) > 1) SELECT doc_id, msg_no, rtrim(p, ' ' || chr(9) || chr(13)) AS payload FROM u")
def line_frames_strict(spark, sf_dir):
    return framing.line_frames(table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("payload")), strict=True)


@query("SELECT doc_id, strlen(text) || ' ' || text AS framed, CASE WHEN right(text, 1) = chr(10) THEN text ELSE text || chr(10) END AS line FROM documents")
def frame_encode(spark, sf_dir):
    t = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", payload.frame_length(t).alias("framed"), payload.frame_line(t).alias("line"))


#: A length frame that never becomes whole, though a newline stands in it.
OPEN = "99999 open\n"


def blobs(spark, sf_dir, key="doc_id", rest=""):
    """Each document as a connection: its lines as length frames, then as lines, in turn; rest at its end."""
    d = table(spark, sf_dir, "documents").where("text IS NOT NULL")
    parts = F.transform(F.split("text", "\n", -1), lambda s: F.concat(s, F.lit("|x")))
    framed = F.transform(parts, lambda s, i: F.when(i % 2 == 0, payload.frame_length(s)).otherwise(F.concat(s, F.lit("\n"))))
    return d.select(F.col(key).alias("conn"), F.concat(F.array_join(framed, ""), F.lit(rest)).alias("bytes"))


FRAMED_SQL = "WITH s AS (SELECT doc_id AS conn, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL) SELECT conn, CAST(unnest(range(len(l))) AS BIGINT) AS msg_no, unnest(l) || '|x' AS payload FROM s"


@query(FRAMED_SQL)
def auto_frames(spark, sf_dir):
    """Strict: the frame that is not whole waits, newline or not."""
    return framing.frames(blobs(spark, sf_dir, rest=OPEN), "bytes").select("conn", "msg_no", F.col("bytes").cast("string").alias("payload"))


@query(FRAMED_SQL + " UNION ALL SELECT doc_id, CAST(len(string_split(text, chr(10))) AS BIGINT), '99999 open' FROM documents WHERE text IS NOT NULL")
def auto_frames_live(spark, sf_dir):
    """Live: the newline ends it."""
    return framing.frames(blobs(spark, sf_dir, rest=OPEN), "bytes", "auto_live").select("conn", "msg_no", F.col("bytes").cast("string").alias("payload"))


@query("WITH s AS (SELECT doc_id AS conn, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL) SELECT conn, CAST(unnest(range(len(list_filter(l, lambda x: x <> '')))) AS BIGINT) AS msg_no, unnest(list_filter(l, lambda x: x <> '')) AS payload FROM s")
def len_frames(spark, sf_dir):
    d = table(spark, sf_dir, "documents").where("text IS NOT NULL")
    parts = F.transform(F.filter(F.split("text", "\n", -1), lambda s: s != ""), payload.frame_length)
    return framing.frames(d.select(F.col("doc_id").alias("conn"), F.array_join(parts, "").alias("bytes")), "bytes", "len").select("conn", "msg_no", F.col("bytes").cast("string").alias("payload"))


def chunks(spark, sf_dir, size=37):
    b = blobs(spark, sf_dir).withColumn("bytes", F.col("bytes").cast("binary"))
    # All chunks of a connection at once, so that its bytes are not copied for each of them.
    cut = lambda data: F.transform(F.sequence(F.lit(0), F.floor(F.octet_length(data) / size).cast("int")), lambda i: F.substring(data, i * size + 1, F.lit(size)))
    return b.select("conn", F.posexplode(F.transform(F.array("bytes"), cut)[0]).alias("seq", "bytes")).select("conn", F.col("seq").cast("long").alias("seq"), "bytes")


@query(FRAMED_SQL)
def reframe_chunks(spark, sf_dir):
    return framing.reframe(chunks(spark, sf_dir)).withColumn("payload", F.col("payload").cast("string"))


@query("WITH s AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL), u AS (SELECT doc_id, unnest(range(len(l))) AS i, unnest(l) || '|x' AS payload FROM s) SELECT CAST(0 AS BIGINT) AS conn, row_number() OVER (ORDER BY doc_id, i) - 1 AS msg_no, payload FROM u")
def reframe_one(spark, sf_dir):
    """All documents as one connection, framed in slices."""
    one = chunks(spark, sf_dir, 4000).select((F.col("conn") * 0).alias("conn"), (F.col("conn") * 1_000_000 + F.col("seq")).alias("seq"), "bytes")
    return framing.reframe(one, slice_rows=40).withColumn("payload", F.col("payload").cast("string"))


def greedy_sql(size: str, full: str, where: str = "") -> str:
    """Batches document by document within ranges of 64 ids; full says when the one at hand is closed before a row r."""
    return f"""WITH RECURSIVE r AS (SELECT doc_id // 64 AS key, doc_id, text, row_number() OVER (PARTITION BY doc_id // 64 ORDER BY doc_id) AS i, {size} AS size FROM documents {where}),
    g AS (SELECT key, doc_id, text, i, size, 0::BIGINT AS batch_no, size AS total, 1 AS n FROM r WHERE i = 1
          UNION ALL SELECT r.key, r.doc_id, r.text, r.i, r.size, batch_no + ({full})::INT, CASE WHEN {full} THEN r.size ELSE total + r.size END, CASE WHEN {full} THEN 1 ELSE n + 1 END
          FROM g JOIN r ON r.key = g.key AND r.i = g.i + 1)"""


def ranged(spark, sf_dir, *more):
    """Documents with a key for each range of 64 ids, so that keys grow in number, not in size."""
    return table(spark, sf_dir, "documents").select(F.floor(F.col("doc_id") / 64).alias("key"), "doc_id", *more)


@query("SELECT doc_id // 64 AS key, doc_id, (row_number() OVER (PARTITION BY doc_id // 64 ORDER BY doc_id) - 1) // 8 AS batch_no FROM documents")
def pack_batches(spark, sf_dir):
    return framing.pack_batches(ranged(spark, sf_dir, "text"), "key", "doc_id", payload="text", max_rows=8, max_bytes=1 << 40).drop("text")


@query(greedy_sql("coalesce(strlen(text), 0)", "n >= 128 OR total >= 8192") + " SELECT key, doc_id, batch_no FROM g")
def pack_batches_bytes(spark, sf_dir):
    """Closed once the bytes are reached."""
    return framing.pack_batches(ranged(spark, sf_dir, "text"), "key", "doc_id", payload="text", max_bytes=8192, rule="after").drop("text")


@query(greedy_sql("coalesce(strlen(text), 0)", "n >= 128 OR total + r.size > 8192") + " SELECT key, doc_id, batch_no FROM g")
def pack_batches_before(spark, sf_dir):
    """Closed before the bytes would be exceeded."""
    return framing.pack_batches(ranged(spark, sf_dir, "text"), "key", "doc_id", payload="text", max_bytes=8192).drop("text")


@query(greedy_sql("coalesce(strlen(text), 0)", "n >= 128 OR total + r.size > 8192").replace("doc_id // 64", "doc_id * 0") + " SELECT key, doc_id, batch_no FROM g")
def pack_one_key(spark, sf_dir):
    """All rows under one key, which is packed in slices."""
    one = table(spark, sf_dir, "documents").select((F.col("doc_id") * 0).alias("key"), "doc_id", "text")
    return framing.pack_batches(one, "key", "doc_id", payload="text", max_bytes=8192, slice_rows=100).drop("text")


@query("WITH b AS (SELECT doc_id // 64 AS key, doc_id, (row_number() OVER (PARTITION BY doc_id // 64 ORDER BY doc_id) - 1) // 8 AS batch_no, coalesce(text, '') AS p FROM documents) SELECT key, batch_no, string_agg(CASE WHEN right(p, 1) = chr(10) THEN p ELSE p || chr(10) END, '' ORDER BY doc_id) AS payload FROM b GROUP BY key, batch_no")
def merge_batches(spark, sf_dir):
    d = ranged(spark, sf_dir, F.coalesce("text", F.lit("")).alias("payload"))
    return framing.merge_batches(framing.pack_batches(d, "key", "doc_id", max_rows=8, max_bytes=1 << 40), "key", "doc_id")


@query("SELECT doc_id, make_valid.t AS text FROM documents, LATERAL (SELECT text AS t) make_valid")
def payload_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", payload.payload_to_text(F.col("text").cast("binary")).alias("text"))


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN coalesce(text, '') || chr(65533) || 'z' ELSE text END AS text FROM documents")
def payload_repair(spark, sf_dir):
    """A byte that is no UTF-8 becomes U+FFFD."""
    broken = F.concat(F.coalesce("text", F.lit("")).cast("binary"), F.lit(b"\xffz"))
    data = F.when(F.col("doc_id") % 2 == 0, broken).otherwise(F.col("text").cast("binary"))
    return table(spark, sf_dir, "documents").select("doc_id", payload.payload_to_text(data).alias("text"))


# --- typed columns ----------------------------------------------------------

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("name", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("ok", T.BooleanType()), T.StructField("at", T.TimestampNTZType()), T.StructField("missing", T.StringType())])


def json_lines_of(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    n = F.col("event_id")
    k = F.when(n % 4 == 0, F.concat(F.lit('"'), n.cast("string"), F.lit('"'))).when(n % 4 == 1, n.cast("string")).when(n % 4 == 2, F.lit('" 42"')).otherwise(F.lit("1.0"))
    ok = F.when(n % 4 == 0, F.lit("true")).when(n % 4 == 1, F.lit('"false"')).when(n % 4 == 2, F.lit('"yes"')).otherwise(F.lit("1"))
    score = F.when(n % 3 == 0, (n * 0.5).cast("string")).when(n % 3 == 1, F.lit('"1d"')).otherwise(F.lit('"2.25"'))
    at = F.when(n % 2 == 0, F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    line = F.concat(F.lit('{"k":'), k, F.lit(',"name":"'), "event_type", F.lit('","score":'), score, F.lit(',"ok":'), ok, F.lit(',"at":"'), at, F.lit('","extra":[1]}'))
    return e.select("event_id", line.alias("value"))


TYPED_SQL = """CASE event_id % 4 WHEN 0 THEN event_id WHEN 1 THEN event_id END AS k, event_type AS name,
    CASE event_id % 3 WHEN 0 THEN event_id * 0.5::DOUBLE WHEN 2 THEN 2.25::DOUBLE END AS score, CASE event_id % 4 WHEN 0 THEN true WHEN 1 THEN false END AS ok,
    CASE WHEN event_id % 2 = 0 THEN date_trunc('second', ts) - INTERVAL 2 HOUR END AS at, CAST(NULL AS VARCHAR) AS missing"""


@query(f"SELECT {TYPED_SQL} FROM events")
def ndjson_typed(spark, sf_dir):
    return ndjson.ndjson_to_table(json_lines_of(spark, sf_dir), SCHEMA)


@query(f"SELECT {TYPED_SQL} FROM events")
def ndjson_scan(spark, sf_dir):
    d = work_dir(spark)
    json_lines_of(spark, sf_dir).select("value").write.option("lineSep", "\n").text(d)
    return files.read_ndjson(spark, "*.txt", SCHEMA, d)


@query("SELECT count(*) AS n, CASE event_id % 6 WHEN 0 THEN 'decode' WHEN 1 THEN 'decode' WHEN 2 THEN 'decode' END AS error_class FROM events GROUP BY ALL")
def rescue_split(spark, sf_dir):
    rows = json_lines_of(spark, sf_dir)
    line = F.when(F.col("event_id") % 6 == 0, "").when(F.col("event_id") % 6 == 1, F.concat("value", F.lit(" x"))).when(F.col("event_id") % 6 == 2, "[1]").otherwise(F.col("value"))
    good, bad = ndjson.split_good_bad(ndjson.ndjson_to_table(rows.select(line.alias("value")), SCHEMA, on_error="rescue"))
    return good.select(F.lit(None).cast("string").alias("error_class")).unionByName(bad.select("error_class")).groupBy("error_class").agg(F.count("*").alias("n"))


@query("""SELECT 'error_class: "decode", raw: "' || event_type || ' ' || event_id || '"' AS value FROM events WHERE event_id % 3 = 0""")
def rescue_written(spark, sf_dir):
    """Rejected lines, written as kv lines and read again; the good ones are dropped."""
    d = work_dir(spark)
    n = F.col("event_id")
    line = F.when(n % 3 == 0, F.concat("event_type", F.lit(" "), n.cast("string"))).otherwise(F.concat(F.lit('{"k":'), n.cast("string"), F.lit("}")))
    good, bad = ndjson.split_good_bad(ndjson.ndjson_to_table(table(spark, sf_dir, "events").select(line.alias("value")), SCHEMA, on_error="rescue"))
    text.write_rejected(bad, d)
    text.drop_all(good)
    return files.read_lines(spark, "*.txt", d, ordered=False).select(F.col("payload").cast("string").alias("value"))


@query("SELECT count(*) AS sent, CAST(sum(strlen(event_type || ' ' || event_id)) AS BIGINT) AS bytes FROM events")
def egress_counts(spark, sf_dir):
    """What an observation counts while rows pass on their way out."""
    seen = Observation("egress")
    text.drop_all(text.counted(table(spark, sf_dir, "events").select(F.concat("event_type", F.lit(" "), F.col("event_id").cast("string")).alias("payload")), name=seen))
    return spark.createDataFrame([(seen.get["sent"], seen.get["bytes"])], "sent long, bytes long")


def guarded(spark, sf_dir, column):
    return table(spark, sf_dir, "orders").select("o_orderkey", column.alias("v"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_custkey WHEN o_orderkey % 3 = 1 THEN -o_custkey END AS v FROM orders")
def ingest_int(spark, sf_dir):
    k = F.col("o_custkey").cast("string")
    return guarded(spark, sf_dir, coerce.to_long(F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("+"), k)).when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("-0"), k)).otherwise(F.concat(F.lit(" "), k))))


@query("SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN o_custkey + 0.5 WHEN 1 THEN o_custkey * 1000.0 WHEN 2 THEN CAST('-inf' AS DOUBLE) END::DOUBLE AS v FROM orders")
def ingest_float(spark, sf_dir):
    k, n = F.col("o_custkey").cast("string"), F.col("o_orderkey") % 4
    return guarded(spark, sf_dir, coerce.to_double(F.when(n == 0, F.concat(k, F.lit(".5"))).when(n == 1, F.concat(k, F.lit("e3"))).when(n == 2, F.lit("-INF")).otherwise(F.concat(k, F.lit("d")))))


@query("SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN true WHEN 1 THEN false END AS v FROM orders")
def ingest_bool(spark, sf_dir):
    n = F.col("o_orderkey") % 4
    return guarded(spark, sf_dir, coerce.to_boolean(F.when(n == 0, "true").when(n == 1, "false").when(n == 2, "TRUE").otherwise("1")))


@query("SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN o_orderdate WHEN 1 THEN o_orderdate - INTERVAL 90 MINUTE WHEN 2 THEN o_orderdate + INTERVAL 60 SECOND END AS v FROM orders")
def ingest_ts(spark, sf_dir):
    d, n = F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderkey") % 4
    return guarded(spark, sf_dir, coerce.to_timestamp(F.when(n == 0, F.concat(d, F.lit("t00:00:00z"))).when(n == 1, F.concat(d, F.lit("T00:00:00+01:30"))).when(n == 2, F.concat(d, F.lit("T00:00:60Z"))).otherwise(d)))


def customer_records(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    fields = [("key", "digit", F.col("c_custkey")), ("name", "chars", F.col("c_name")), ("bal", "float", F.col("c_acctbal")), ("port", "port", F.col("c_nationkey") + 70000), ("rich", "bool", F.col("c_acctbal") > 5000), ("skip", "ignore", F.lit("x")), ("code", "hex", F.hex(F.col("c_custkey"))), ("seen", "time", F.timestamp_seconds(F.col("c_custkey") * 3600))]
    return c.select("c_custkey", records.record(fields).alias("rec"))


@query("SELECT c_custkey AS key, c_name AS name, c_acctbal AS bal, c_nationkey + 70000 AS port, c_acctbal > 5000 AS rich, unhex(CASE WHEN length(printf('%X', c_custkey)) % 2 = 1 THEN '0' ELSE '' END || printf('%X', c_custkey)) AS code, TIMESTAMP '1970-01-01' + to_hours(c_custkey) AS seen FROM customer")
def records_to_table(spark, sf_dir):
    rows = customer_records(spark, sf_dir)
    return records.records_to_table(rows, records.schema_of_first(rows, "c_custkey"))


@query("SELECT c_custkey, trunc(c_acctbal)::BIGINT AS as_long, CASE WHEN c_custkey % 2 = 0 THEN c_custkey END AS text_long, CAST(c_custkey AS DOUBLE) AS as_double, c_custkey % 2 = 0 AS as_bool, TIMESTAMP '1970-01-01' + to_milliseconds(c_custkey * 86400000 + 5) AS as_time, encode(c_name) AS as_binary, CAST(c_custkey AS VARCHAR) AS as_text, CAST((c_custkey * 1000000007 + 2147483648) % 4294967296 - 2147483648 AS INT) AS wrapped FROM customer")
def record_coercions(spark, sf_dir):
    even = F.col("c_custkey") % 2 == 0
    fields = [
        ("as_long", "float", F.col("c_acctbal")), ("text_long", "chars", F.when(even, F.col("c_custkey").cast("string")).otherwise("abc")), ("as_double", "digit", F.col("c_custkey")),
        ("as_bool", "chars", F.when(even, "TRUE").otherwise("no")), ("as_time", "digit", F.col("c_custkey") * 86400000 + 5), ("as_binary", "chars", F.col("c_name")), ("as_text", "digit", F.col("c_custkey")), ("wrapped", "digit", F.col("c_custkey") * 1000000007),
    ]
    kinds = [T.LongType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.TimestampNTZType(), T.BinaryType(), T.StringType(), T.IntegerType()]
    rows = table(spark, sf_dir, "customer").select("c_custkey", records.record(fields).alias("rec"))
    return records.records_to_table(rows, T.StructType([T.StructField(n, k) for (n, _, _), k in zip(fields, kinds)]), keep=("c_custkey",))


@query("""SELECT c_custkey, '{"key":' || c_custkey || ',"name":"' || c_name || '"}' AS whole, '["' || c_mktsegment || '","b"]' AS parts, '{"' || c_mktsegment || '":' || c_nationkey || '}' AS pairs, CAST(c_nationkey AS VARCHAR) AS plain,
    CASE WHEN c_custkey % 2 = 0 THEN '{"key":' || c_custkey || '}' END AS some FROM customer""")
def record_json(spark, sf_dir):
    """Objects, arrays and maps of a record as JSON, under a schema of text for all its names."""
    c = table(spark, sf_dir, "customer")
    key = F.struct(F.col("c_custkey").alias("key"))
    fields = [
        ("whole", "obj", F.struct(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))), ("parts", "array(chars)", F.array("c_mktsegment", F.lit("b"))), ("pairs", "json", F.create_map("c_mktsegment", "c_nationkey")),
        ("plain", "digit", F.col("c_nationkey")), ("some", "obj", F.when(F.col("c_custkey") % 2 == 0, key)),
    ]
    rows = c.select("c_custkey", records.record(fields).alias("rec"))
    return records.records_to_table(rows, records.text_schema([n for n, _, _ in fields]), keep=("c_custkey",))


# --- sinks ------------------------------------------------------------------

PART_COLUMNS = ("p_partkey", "p_name", "p_size")


def part(spark, sf_dir):
    return table(spark, sf_dir, "part").select(*PART_COLUMNS)


@query("""SELECT 'p_partkey: ' || p_partkey || ', p_name: "' || p_name || '", p_size: ' || p_size AS value FROM part""")
def kv_lines(spark, sf_dir):
    return text.format_lines(part(spark, sf_dir), "kv")


@query("""SELECT '{"p_partkey":' || p_partkey || ',"p_name":"' || p_name || '","p_size":' || p_size || '}' AS value FROM part""")
def json_lines(spark, sf_dir):
    return text.format_lines(part(spark, sf_dir), "json")


@query("SELECT p_partkey || ',' || p_name || ',' || p_size AS value FROM part")
def csv_lines(spark, sf_dir):
    return text.format_lines(part(spark, sf_dir), "csv")


@query("SELECT p_partkey || ' ' || p_name || ' ' || p_size AS value FROM part")
def raw_lines(spark, sf_dir):
    return text.format_lines(part(spark, sf_dir), "raw")


@query("""SELECT 'p_partkey = ' || p_partkey || ' | p_name = "' || p_name || '" | p_size = ' || p_size AS value FROM part""")
def show_lines(spark, sf_dir):
    return text.format_lines(part(spark, sf_dir), "show")


@query("""SELECT 'p_partkey: ' || p_partkey || ' p_name: "' || p_name || '" p_size: ' || p_size AS value FROM part""")
def proto_text_lines(spark, sf_dir):
    return text.format_lines(part(spark, sf_dir), "proto-text")


@query("SELECT o_orderkey || ' ' || o_orderstatus AS value FROM orders")
def text_roundtrip(spark, sf_dir):
    d = work_dir(spark)
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    for rest in (0, 1):  # the second write appends
        text.write_lines(rows.where(F.col("o_orderkey") % 2 == rest), d, "raw")
    return files.read_lines(spark, "*.txt", d, ordered=False).select(F.col("payload").cast("string").alias("value"))


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def arrow_ipc_payloads(spark, sf_dir):
    return arrow.decode_arrow(arrow.encode_arrow(table(spark, sf_dir, "orders")))


@query("SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate, 'orders' AS tag FROM orders")
def arrow_framed_payloads(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    return arrow.decode_arrow(arrow.encode_arrow(o, "arrow_framed", "orders"), o.schema, wire="arrow_framed", tag="tag")


def arrow_files(spark, sf_dir, wire):
    d = work_dir(spark)
    sink_files.register(spark)
    table(spark, sf_dir, "orders").write.format("file_arrow").options(base=local(d), file="orders.arrow", data_format=wire, tag="orders").mode("append").save()
    return arrow.read_arrow(spark, "*.arrow", d, wire)


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def arrow_ipc_roundtrip(spark, sf_dir):
    return arrow_files(spark, sf_dir, "arrow_ipc")


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def arrow_framed_roundtrip(spark, sf_dir):
    return arrow_files(spark, sf_dir, "arrow_framed")


@query("SELECT p_partkey || ',' || p_name || ',' || p_size AS value FROM part")
def named_files_roundtrip(spark, sf_dir):
    d = work_dir(spark)
    sink_files.register(spark)
    lines = text.format_lines(part(spark, sf_dir), "csv")
    lines.write.format("file_lines").options(base=local(d), file="part.csv").mode("append").save()
    return files.read_lines(spark, "part*.csv", d, ordered=False).select(F.col("payload").cast("string").alias("value"))


@query("SELECT p_partkey || ',' || p_name || ',' || p_size AS value FROM part")
def named_files_append(spark, sf_dir):
    """The second write publishes further parts beside those of the first."""
    d = work_dir(spark)
    sink_files.register(spark)
    for rest in (0, 1):
        lines = text.format_lines(part(spark, sf_dir).where(F.col("p_partkey") % 2 == rest), "csv")
        lines.write.format("file_lines").options(base=local(d), file="part.csv").mode("append").save()
    return files.read_lines(spark, "part*.csv", d, ordered=False).select(F.col("payload").cast("string").alias("value"))


@query("SELECT p_partkey || ',' || p_name || ',' || p_size AS value FROM part")
def published_lines(spark, sf_dir):
    """Files that a manifest names, from two jobs."""
    d = work_dir(spark)
    sink_published.register(spark)
    for rest in (0, 1):
        lines = text.format_lines(part(spark, sf_dir).where(F.col("p_partkey") % 2 == rest), "csv")
        lines.write.format("published_lines").options(base=d, file="part.csv").mode("append").save()
    return sink_published.read_published_lines(spark, d, "part.csv").select(F.col("payload").cast("string").alias("value"))


@query("SELECT count(*) AS lines, CAST(sum(strlen(p_partkey || ',' || p_name || ',' || p_size) + 1) AS BIGINT) AS bytes FROM part")
def published_counts(spark, sf_dir):
    """What was written, by the manifests."""
    d = work_dir(spark)
    sink_published.register(spark)
    text.format_lines(part(spark, sf_dir), "csv").write.format("published_lines").options(base=d, file="part.csv").mode("append").save()
    return sink_published.published(spark, d, "part.csv").agg(F.sum("rows").alias("lines"), F.sum("bytes").alias("bytes"))


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def published_arrow(spark, sf_dir):
    d = work_dir(spark)
    sink_published.register(spark)
    o = table(spark, sf_dir, "orders")
    o.write.format("published_arrow").options(base=d, file="orders.arrow", data_format="arrow_framed", tag="orders").mode("append").save()
    return sink_published.read_published_arrow(spark, d, "orders.arrow", o.schema, "arrow_framed")


# --- streams ----------------------------------------------------------------


@query("SELECT event_type || ' ' || event_id AS value FROM events")
def stream_published(spark, sf_dir):
    """A stream into files; each micro-batch is published once."""
    d = work_dir(spark)
    sink_published.register(spark)
    rows = table(spark, sf_dir, "events").select(F.concat("event_type", F.lit(" "), F.col("event_id").cast("string")).alias("value"))
    rows.write.parquet(f"{d}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 4).parquet(f"{d}/in")
    q = stream.writeStream.format("published_lines").options(base=f"{d}/out", file="events.txt", checkpointLocation=f"{d}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return sink_published.read_published_lines(spark, f"{d}/out", "events.txt").select(F.col("payload").cast("string").alias("value"))


def drained(stream: DataFrame, d: str) -> DataFrame:
    q = stream.writeStream.format("parquet").option("path", f"{d}/out").option("checkpointLocation", f"{d}/state").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{d}/out")


@query(FRAMED_SQL)
def stream_reframe(spark, sf_dir):
    d = work_dir(spark)
    rows = chunks(spark, sf_dir, 4000)
    rows.write.parquet(f"{d}/in")
    out = reframe_stream(spark.readStream.schema(rows.schema).parquet(f"{d}/in"))
    return drained(out, d).withColumn("payload", F.col("payload").cast("string"))


@query(f"WITH l AS ({LINES_SQL}) SELECT event_id, {BODY} AS payload FROM l")
def stream_header_mode(spark, sf_dir):
    d = work_dir(spark)
    rows = lines(spark, sf_dir).select("event_id", F.col("line").alias("payload"))
    rows.write.parquet(f"{d}/in")
    return drained(syslog.apply_header_mode(spark.readStream.schema(rows.schema).parquet(f"{d}/in"), "skip"), d)


@query("SELECT c_custkey, c_custkey AS key, c_name AS name, c_acctbal AS bal FROM customer")
def stream_records(spark, sf_dir):
    """Records of a stream, under the schema that its first one froze."""
    d = work_dir(spark)
    fields = [("key", "digit", F.col("c_custkey")), ("name", "chars", F.col("c_name")), ("bal", "float", F.col("c_acctbal")), ("none", "ignore", F.lit("x"))]
    rows = table(spark, sf_dir, "customer").select("c_custkey", records.record(fields).alias("rec"))
    rows.write.parquet(f"{d}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{d}/in")
    write_records(stream, f"{d}/schema", "c_custkey", lambda df, n: df.write.mode("overwrite").parquet(f"{d}/out/batch={n}"), f"{d}/state", keep=("c_custkey",)).awaitTermination()
    return spark.read.parquet(f"{d}/out").drop("batch")


@query("WITH s AS (SELECT doc_id AS conn, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL), u AS (SELECT conn, unnest(l) || '|x' AS payload FROM s) SELECT payload, '10.1.1.1' AS access_ip, 'Tcp' AS protocol, count(*) AS n FROM u GROUP BY payload")
def tcp_syslog(spark, sf_dir):
    out = ev.tcp_syslog(chunks(spark, sf_dir, 4000).withColumn("ip", F.lit("10.1.1.1")), "tag")
    return out.groupBy(F.col("payload").cast("string").alias("payload"), F.col("tags")["access_ip"].alias("access_ip"), F.col("tags")["syslog_protocol"].alias("protocol")).agg(F.count("*").alias("n"))


# --- the rest ---------------------------------------------------------------


@query("SELECT c_nationkey AS nation, count(*) AS n, CAST(sum(strlen(c_name)) AS BIGINT) AS bytes FROM customer GROUP BY 1")
def whole_files_scan(spark, sf_dir):
    d = work_dir(spark)
    table(spark, sf_dir, "customer").select("c_nationkey", "c_name").write.partitionBy("c_nationkey").text(d)
    got = files.read_whole_files(spark, "*/*.txt", d)
    nation = F.regexp_extract("file_path", "c_nationkey=([0-9]+)", 1).cast("int")
    names = framing.line_frames(got.select(nation.alias("nation"), "payload"))
    return names.groupBy("nation").agg(F.count("*").alias("n"), F.sum(F.octet_length("payload")).alias("bytes"))


@query("SELECT event_type || ' ' || event_id AS value FROM events")
def raw_write_roundtrip(spark, sf_dir):
    d = work_dir(spark)
    line = F.concat("event_type", F.lit(" "), F.col("event_id").cast("string"), F.when(F.col("event_id") % 2 == 0, "\n").otherwise(""))
    text.write_raw(table(spark, sf_dir, "events").select(line.alias("payload")), d)
    return files.read_lines(spark, "*.txt", d, ordered=False).select(F.col("payload").cast("string").alias("value"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '10.0.' || (event_id % 256) || '.1' WHEN event_id % 3 = 1 THEN 'fe80::' || (event_id % 9) ELSE '127.0.0.1' END AS ip, CASE WHEN event_id % 3 = 0 THEN '10.0.' || (event_id % 256) || '.1' WHEN event_id % 3 = 1 THEN 'fe80::' || (event_id % 9) ELSE 'unknown' END AS shown FROM events")
def peer_addresses(spark, sf_dir):
    n = F.col("event_id")
    ip = F.when(n % 3 == 0, F.concat(F.lit("10.0."), (n % 256).cast("string"), F.lit(".1"))).when(n % 3 == 1, F.concat(F.lit("fe80::"), (n % 9).cast("string"))).otherwise(F.concat(F.lit("10.0.300."), n.cast("string")))
    return table(spark, sf_dir, "events").select("event_id", ev.ip_or_local(ip).alias("ip"), ev.ip_text(ip).alias("shown"))


@query("SELECT * FROM (VALUES ('key', 'bigint'), ('name', 'string'), ('bal', 'double'), ('port', 'int'), ('rich', 'boolean'), ('code', 'binary'), ('seen', 'timestamp_ntz')) AS t(name, type)")
def schema_first_record(spark, sf_dir):
    return records.schema_table(customer_records(spark, sf_dir), "c_custkey")


@query("WITH s AS (SELECT doc_id AS conn, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL) SELECT conn, CAST(unnest(range(len(l))) AS BIGINT) AS msg_no, unnest(l) AS payload FROM s")
def len_frames_live(spark, sf_dir):
    """Live length framing keeps empty messages."""
    d = table(spark, sf_dir, "documents").where("text IS NOT NULL")
    parts = F.transform(F.split("text", "\n", -1), payload.frame_length)
    return framing.frames(d.select(F.col("doc_id").alias("conn"), F.array_join(parts, "").alias("bytes")), "bytes", "len_live").select("conn", "msg_no", F.col("bytes").cast("string").alias("payload"))


@query("SELECT CASE WHEN doc_id % 2 = 0 THEN 'good' ELSE 'short' END AS frame, count(*) AS n FROM documents GROUP BY 1")
def skipped_frames(spark, sf_dir):
    """Frames that are too short for their header are skipped, and counted."""
    d = table(spark, sf_dir, "documents")
    head = F.when(F.col("doc_id") % 2 == 0, F.unhex(F.lit("0000000161"))).otherwise(F.unhex(F.lit("FFFFFFFF61")))
    n = arrow.count_skipped_frames(d.select(head.alias("payload")))
    return n.select(F.explode(F.array(F.struct(F.lit("good").alias("frame"), (F.col("frames") - F.col("skipped")).alias("n")), F.struct(F.lit("short").alias("frame"), F.col("skipped").alias("n")))).alias("x")).select("x.*")


# --- order, prefixes, appends, instances ------------------------------------


#: Parts of 500 keys, in files of one name in two folders.
IN_FILES = """SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'even' ELSE 'odd' END AS folder, 'x-r' || (c_custkey // 500 + 1) || '.log' AS name, c_custkey || ',' || c_name || CASE WHEN c_custkey % 3 = 0 THEN chr(13) ELSE '' END AS line FROM customer"""


def two_folders(spark, sf_dir):
    d = work_dir(spark)
    sink_files.register(spark)
    line = F.concat(F.col("c_custkey").cast("string"), F.lit(","), "c_name", F.when(F.col("c_custkey") % 3 == 0, "\r").otherwise(""))
    c = table(spark, sf_dir, "customer").withColumn("part", F.floor(F.col("c_custkey") / 500).cast("int"))
    # The parts grow in number, not in size.
    n = c.agg(F.max("part")).first()[0] + 1
    for name, rest in (("even", 0), ("odd", 1)):
        rows = c.where(F.col("c_custkey") % 2 == rest).repartitionById(max(n, 2), F.col("part")).sortWithinPartitions("c_custkey")
        rows.select(line.alias("value")).write.format("file_lines").options(base=f"{local(d)}/{name}", file="x.log").mode("append").save()
    return d


def of_line(got: DataFrame, *more) -> DataFrame:
    path = F.split("file_path", "/")
    key = F.split(F.col("payload").cast("string"), ",")[0].cast("long")
    return got.select(F.element_at(path, -2).alias("folder"), F.element_at(path, -1).alias("name"), key.alias("c_custkey"), *more)


@query(f"WITH l AS ({IN_FILES}) SELECT folder, name, c_custkey, CAST(dense_rank() OVER (ORDER BY name, folder) - 1 AS INT) AS file_seq, CAST(row_number() OVER (PARTITION BY folder, name ORDER BY c_custkey) AS INT) AS line_no FROM l")
def file_order(spark, sf_dir):
    """Files in the order of name and path, lines in that of the file."""
    got = files.read_lines(spark, "{even,odd}/x-r*.log", two_folders(spark, sf_dir))
    by = W.partitionBy("file_path").orderBy("block", "line_id")
    return of_line(got.withColumn("line_no", F.row_number().over(by)), "file_seq", "line_no")


@query(f"WITH l AS ({IN_FILES}) SELECT folder, name, c_custkey, CAST(coalesce(sum(strlen(line) + 1) OVER (PARTITION BY folder, name ORDER BY c_custkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS \"offset\" FROM l")
def line_offsets(spark, sf_dir):
    """The byte of its file at which each line begins."""
    return of_line(files.read_lines(spark, "{even,odd}/x-r*.log", two_folders(spark, sf_dir), ordered=False, offsets=True), "offset")


@query(f"""WITH l AS ({IN_FILES}), o AS (SELECT *, coalesce(sum(strlen(line) + 1) OVER (PARTITION BY folder, name ORDER BY c_custkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start, sum(strlen(line) + 1) OVER (PARTITION BY folder, name) AS size FROM l)
    SELECT folder, c_custkey, 'in-' || CAST(CASE WHEN start > 0 THEN (start - 1) // ((size + 2) // 3) ELSE 0 END + 1 AS BIGINT) AS src_key FROM o""")
def line_ranges(spark, sf_dir):
    """Lines in three ranges of each file's bytes; the key names the range."""
    out = files.read_text_events(spark, "{even,odd}/x-r*.log", two_folders(spark, sf_dir), name="in", instances=3)
    return of_line(out.withColumn("file_path", F.col("tags")["access_source"]), "src_key").drop("name")


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def arrow_keep_prefix(spark, sf_dir):
    """A stream behind which half of another one stands: the whole one counts."""
    o = table(spark, sf_dir, "orders")
    broken = arrow.encode_arrow(o).select(F.expr("concat(payload, substr(payload, 1, cast(octet_length(payload) / 2 as int)))").alias("payload"))
    return arrow.decode_arrow(broken, o.schema, on_error="keep_prefix")


@query(FRAMED_SQL.replace("SELECT conn, CAST(unnest(range(len(l))) AS BIGINT) AS msg_no, unnest(l) || '|x' AS payload FROM s", "SELECT unnest(l) || '|x' AS payload, '10.2.' || (conn % 7) || '.9' AS ups_ip, 'tcp#' || (conn % 4 + 1) AS src_key, CAST(conn % 4 + 1 AS VARCHAR) AS instance, 'b' AS a FROM s"))
def tcp_capture(spark, sf_dir):
    """Captured connections with four instances: key, tag and address of each message."""
    c = chunks(spark, sf_dir, 4000).withColumn("ip", F.concat(F.lit("10.2."), (F.col("conn") % 7).cast("string"), F.lit(".9")))
    out = ev.tcp_messages(c, "tcp", instances=4, tags=["a=b"], instance=F.col("conn") % 4)
    return out.select(F.col("payload").cast("string").alias("payload"), "ups_ip", "src_key", F.col("tags")["instance"].alias("instance"), F.col("tags")["a"].alias("a"))


SOME_STREAM = arrow.encode_stream([pa.record_batch([pa.array([1, 2])], names=["n"])])


@query(f"""SELECT doc_id, CASE WHEN text IS NULL THEN 'connect' WHEN doc_id % 3 = 1 THEN 'decode' ELSE 'end' END AS error_class,
    CASE WHEN text IS NULL THEN NULL ELSE CAST({len(SOME_STREAM)} AS BIGINT) END AS position, CASE WHEN doc_id % 3 = 1 THEN text WHEN text IS NOT NULL THEN 'cut ' || (doc_id % 10) END AS raw FROM documents WHERE text IS NULL OR (doc_id % 3 > 0 AND text <> '')""")
def arrow_failures(spark, sf_dir):
    """Streams with text or with half a message behind them: what is wrong, where, and what stands there."""
    half = F.concat(F.lit(b"\xff\xff\xff\xff\xff\xff\x00\x00"), F.concat(F.lit("cut "), (F.col("doc_id") % 10).cast("string")).cast("binary"))
    n = F.col("doc_id") % 3
    behind = F.when((n == 0) | (F.col("text") == ""), F.lit(b"")).when(n == 1, F.col("text").cast("binary")).otherwise(half)
    data = F.when(F.col("text").isNotNull(), F.concat(F.lit(SOME_STREAM), behind))
    got = arrow.arrow_failures(table(spark, sf_dir, "documents").select("doc_id", data.alias("payload")))
    raw = F.when(F.col("error_class") == "end", F.substring("raw", 9, 1 << 30)).otherwise(F.col("raw"))
    return got.select("doc_id", "error_class", "position", raw.cast("string").alias("raw"))


# --- what goes over the network, byte by byte -------------------------------

LINE = "CASE WHEN right(coalesce(text, ''), 1) = chr(10) THEN text ELSE coalesce(text, '') || chr(10) END"
BATCH = " SELECT key, batch_no, count(*) AS n, CAST(sum(size) AS BIGINT) AS bytes, md5(string_agg({frame}, '' ORDER BY doc_id)) AS digest FROM g GROUP BY key, batch_no"


def sent(spark, sf_dir, framing_):
    out = net.wire_batches(ranged(spark, sf_dir, F.col("text").alias("payload")), "key", "doc_id", framing=framing_)
    return out.select("key", "batch_no", F.col("n").alias("n"), F.octet_length("data").cast("long").alias("bytes"), F.md5("data").alias("digest"))


@query(greedy_sql(f"strlen({LINE})", "n >= 128 OR total + r.size > 65536") + BATCH.format(frame=LINE))
def tcp_line_batches(spark, sf_dir):
    """The bytes of each send of a text sink with lines: up to 128 rows or 64 KiB."""
    return sent(spark, sf_dir, "line")


LENGTH = "(strlen(coalesce(text, '')) || ' ' || coalesce(text, ''))"


@query(greedy_sql(f"strlen({LENGTH})", "n >= 128 OR total + r.size > 65536") + BATCH.format(frame=LENGTH))
def tcp_length_batches(spark, sf_dir):
    return sent(spark, sf_dir, "len")


@query("SELECT o_orderkey, o_totalprice, o_orderdate, o_orderstatus AS tag FROM orders")
def arrow_tcp_frames(spark, sf_dir):
    """What an Arrow sink sends, a frame for each tag behind its length, taken apart again."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus")
    bytes_ = net.arrow_messages(o, "arrow_framed", tag_column="o_orderstatus")
    return arrow.decode_arrow(framing.frames(bytes_, "data", "len"), o.drop("o_orderstatus").schema, payload="data", wire="arrow_framed", tag="tag")


@query("SELECT o_orderkey, o_totalprice FROM orders")
def arrow_tcp_streams(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return arrow.decode_arrow(net.arrow_messages(o, "arrow_ipc"), o.schema, payload="data")


@query(f"SELECT event_id, '<13>' || strftime(ts, '%b %d %H:%M:%S') || ' localhost lab: ' || event_type || chr(10) AS data FROM events")
def syslog_tcp_lines(spark, sf_dir):
    """The bytes of a syslog sink over TCP."""
    e = table(spark, sf_dir, "events")
    out = net.to_syslog(e, "event_type", "ts", "lab", keep=("event_id",))
    return out.select("event_id", payload.frame_line(F.col("value")).alias("data"))
