"""The event table: event_id, src_key, payload, tags, ups_ip."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparklog.functions.payload import parse_tags
from sparklog.functions.syslog import apply_header_mode, header_mode
from sparklog.operators.framing import frames, reframe

UNKNOWN_IP = "127.0.0.1"
_IP = r"^(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$|^[0-9a-fA-F:]*:[0-9a-fA-F:.]*$"


def ip_or_local(ip: Column) -> Column:
    """The address, or 127.0.0.1 for what is none."""
    return F.when(ip.rlike(_IP), ip).otherwise(F.lit(UNKNOWN_IP))


def ip_text(ip: Column) -> Column:
    return F.when(ip.rlike(_IP), ip).otherwise(F.lit("unknown"))


def to_events(df: DataFrame, src_key: str | Column, payload: str = "payload", tags: list[str] | None = None, ip: str | None = None, stable_id: tuple[str, ...] = ()) -> DataFrame:
    """df as an event table. ``stable_id`` names columns whose hash is the id, the same on each replay; else ids are just unique."""
    event_id = F.xxhash64(*stable_id) if stable_id else F.monotonically_increasing_id()
    own = parse_tags(F.array(*map(F.lit, tags or [])).cast("array<string>"))
    old = F.coalesce(F.col("tags"), F.create_map().cast("map<string,string>")) if "tags" in df.columns else F.create_map().cast("map<string,string>")
    merged = F.map_concat(F.map_filter(own, lambda k, v: ~F.map_contains_key(old, k)), old)
    return df.select(
        event_id.alias("event_id"),
        (src_key if isinstance(src_key, Column) else F.lit(src_key)).alias("src_key"),
        F.col(payload).cast("binary").alias("payload"),
        merged.alias("tags"),
        (F.col(ip) if ip else F.lit(None).cast("string")).alias("ups_ip"),
    )


def shard_key(name: str | Column, shard: Column, shards: Column | int) -> Column:
    """``name``, or ``name-1`` and so on where there are several shards (numbered from 0)."""
    name = name if isinstance(name, Column) else F.lit(name)
    return F.when((shards if isinstance(shards, Column) else F.lit(shards)) > 1, F.concat(name, F.lit("-"), (shard + 1).cast("string"))).otherwise(name)


def tcp_messages(chunks: DataFrame, name: str = "tcp", framing: str = "auto", instances: int = 1, tags: list[str] | None = None, instance: Column | None = None) -> DataFrame:
    """Captured chunks (conn, seq, ip, bytes) -> events of their messages; with several instances the key is ``name#k`` and a tag tells the instance.

    ``instance`` says which one (from 0) has taken a connection, by its columns; else a hash of conn does.
    """
    if not 1 <= instances <= 16:
        raise ValueError("instances must be 1 to 16")
    taken = (F.pmod(F.xxhash64("conn"), F.lit(instances)) if instance is None else instance).cast("int") + 1
    messages = reframe(chunks.withColumn("conn", F.struct("conn", "ip", taken.alias("taken"))), mode=framing)
    messages = messages.select(F.col("conn.conn").alias("conn"), ip_or_local(F.col("conn.ip")).alias("ip"), "msg_no", "payload", F.col("conn.taken").alias("instance"))
    key = F.concat(F.lit(name + "#"), F.col("instance").cast("string")) if instances > 1 else F.lit(name)
    if instances > 1:
        messages = messages.withColumn("tags", F.create_map(F.lit("instance"), F.col("instance").cast("string")))
    return to_events(messages, key, tags=tags, ip="ip", stable_id=("conn", "msg_no"))


def udp_syslog(datagrams: DataFrame, mode: str = "skip", name: str = "syslog", tags: list[str] | None = None) -> DataFrame:
    """Datagrams (ip, bytes, truncated) -> events; truncated ones and those of 65 536 bytes are dropped, access_ip is always tagged."""
    header_mode(mode)
    rows = datagrams.where((F.octet_length("bytes") < 65536) & ~F.coalesce(F.col("truncated"), F.lit(False)))
    fixed = {"access_source": F.lit("syslog"), "syslog_protocol": F.lit("Udp"), "access_ip": ip_or_local(F.col("ip"))}
    rows = rows.withColumn("tags", F.create_map(*(x for k, v in fixed.items() for x in (F.lit(k), v)))).withColumn("ip", ip_or_local(F.col("ip")))
    return apply_header_mode(to_events(rows, name, "bytes", tags, "ip"), mode)


def tcp_syslog(chunks: DataFrame, mode: str = "skip", name: str = "syslog", framing: str = "auto", tags: list[str] | None = None) -> DataFrame:
    """Captured chunks (conn, seq, ip, bytes) of syslog connections -> events; access_ip is tagged in mode ``tag`` only."""
    kind = header_mode(mode)
    messages = reframe(chunks.withColumn("conn", F.struct("conn", "ip")), mode=framing)
    ip = ip_or_local(F.col("conn.ip"))
    fixed = {"access_source": F.lit("syslog"), "syslog_protocol": F.lit("Tcp")} | ({"access_ip": ip} if kind == "tag" else {})
    messages = messages.select("msg_no", "payload", F.col("conn.conn").alias("conn"), ip.alias("ip"), F.create_map(*(x for k, v in fixed.items() for x in (F.lit(k), v))).alias("tags"))
    return apply_header_mode(to_events(messages, name, tags=tags, ip="ip", stable_id=("conn", "msg_no")), mode)


__all__ = ["frames", "ip_or_local", "ip_text", "shard_key", "tcp_messages", "tcp_syslog", "to_events", "udp_syslog"]
