"""Not-modified revisit records, resolved to the latest earlier full response of their canonical URL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sparklog.llm.common import cut, hot_join

#: Header fields of a not-modified answer that replace those of the stored response.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Query parameters that do not tell pages apart.
TRACKING = "^(utm_[^=]*|gclid|fbclid|sessionid|jsessionid|phpsessid)(=|$)"
#: Distinct capture times of one URL that one task orders; a URL with more is cut into spans of time.
MOST_TIMES = 200_000
SPANS = 64


def canonical_url(url: Column) -> Column:
    """Host in lower case without user, ``www`` and default port; path without trailing slashes; query sorted, without tracking parameters; no scheme, no fragment."""
    rest = F.regexp_replace(F.regexp_replace(F.trim(url), "(?s)#.*$", ""), "^[A-Za-z][A-Za-z0-9+.\\-]*://", "")
    host = F.lower(F.regexp_extract(rest, "^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, "^[^@]*@", ""), ":(80|443)$", ""), "^www[0-9]*\\.", "")
    path = F.regexp_replace(F.regexp_extract(rest, "^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.split(F.regexp_extract(rest, "(?s)\\?(.*)$", 1), "&")
    query = F.array_join(F.array_sort(F.filter(query, lambda q: (q != "") & ~F.lower(q).rlike(TRACKING))), "&")
    return F.concat(host, F.when(path == "", "/").otherwise(path), F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))


def _lower_keys(headers: Column) -> Column:
    """Names in lower case; of names that are then equal, the last one's value."""
    entries = F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>")))
    names = F.array_distinct(F.transform(entries, lambda e: F.lower(e["key"])))
    return F.map_from_arrays(names, F.transform(names, lambda k: F.element_at(F.filter(entries, lambda e: F.lower(e["key"]) == k), -1)["value"]))


def _latest_before(points: DataFrame, most_times: int) -> DataFrame:
    """points(url_key, ts, response) -> with source_id, the response of the latest earlier time."""
    sizes = points.groupBy("url_key").agg(F.count("*").alias("n")).where(F.col("n") > most_times)
    sizes = cut(sizes)
    if sizes.isEmpty():
        return points.withColumn("source_id", F.last("response", True).over(W.partitionBy("url_key").orderBy("ts").rowsBetween(W.unboundedPreceding, -1)))
    hot = points.join(sizes, "url_key").groupBy("url_key", "n").agg(F.percentile_approx("ts", [i / SPANS for i in range(1, SPANS)], 10_000).alias("cuts"))
    points = hot_join(points, cut(hot), "url_key", "n", "ts")
    points = cut(points.withColumn("span", F.size(F.filter(F.coalesce("cuts", F.array().cast("array<bigint>")), lambda c: c < F.col("ts")))).drop("cuts"))
    inside = F.last("response", True).over(W.partitionBy("url_key", "span").orderBy("ts").rowsBetween(W.unboundedPreceding, -1))
    ends = points.groupBy("url_key", "span").agg(F.max_by("response", F.when(F.col("response").isNotNull(), F.col("ts"))).alias("response"))
    ends = ends.withColumn("carried", F.last("response", True).over(W.partitionBy("url_key").orderBy("span").rowsBetween(W.unboundedPreceding, -1))).drop("response")
    return points.withColumn("inside", inside).join(ends, ["url_key", "span"]).withColumn("source_id", F.coalesce("inside", "carried")).drop("inside", "carried", "span")


def resolve_revisits(captures: DataFrame, permitted: tuple[str, ...] = PERMITTED, most_times: int = MOST_TIMES) -> DataFrame:
    """captures(record_id long, url, ts long, kind, status, headers map, digest) -> a row for each revisit.

    record_id, url_key, ts, source_id, resolution, headers, digest. source_id
    is the latest response with status 200 and an earlier time (of several at
    one time that with the largest id). resolution says which validator
    agrees: ``etag`` (weak comparison), ``last_modified`` or ``digest``;
    ``..._mismatch`` where one does not, ``no_validator`` where none is on
    both sides, ``no_earlier_response`` where there is no response to compare
    with, which holds for a null url or time too. Where resolved, headers are
    those of the response with the permitted fields of the revisit, and digest
    is the response's; else both are null. Of responses that repeat a record
    id the first by digest and headers counts; each row of a revisit is
    resolved by itself. Rows of other kinds are left out, further columns
    ignored, whatever their names; urls and headers may have any length. An
    empty table gives no rows.
    """
    rows = captures.select("record_id", canonical_url(F.col("url")).alias("url_key"), "ts", "kind", "status", _lower_keys(F.col("headers")).alias("headers"), "digest")
    full = (F.col("kind") == "response") & (F.col("status") == 200)
    times = rows.where((full | (F.col("kind") == "revisit")) & F.col("url_key").isNotNull() & F.col("ts").isNotNull())
    points = times.groupBy("url_key", "ts").agg(F.max(F.when(full, F.col("record_id"))).alias("response"))
    asof = _latest_before(points, most_times).select("url_key", "ts", "source_id").where("source_id IS NOT NULL")
    revisits = rows.where(F.col("kind") == "revisit")
    # A null url or time has no earlier response; such rows are kept out of the join, where they would be one large group.
    placed = F.col("url_key").isNotNull() & F.col("ts").isNotNull()
    found = revisits.where(placed).join(asof, ["url_key", "ts"], "left").unionByName(revisits.where(~placed).withColumn("source_id", F.lit(None).cast("long")))
    found = cut(found.drop("kind", "status"))
    uses = found.where("source_id IS NOT NULL").groupBy("source_id").agg(F.count("*").alias("n"))
    sources = rows.where(full).select(F.col("record_id").alias("source_id"), F.col("headers").alias("_headers"), F.col("digest").alias("_digest"))
    order = F.concat_ws(" ", F.coalesce("_digest", F.lit("")), F.to_json("_headers"))
    used = sources.join(uses, "source_id").groupBy("source_id", "n").agg(F.min_by(F.struct("_headers", "_digest"), order).alias("s")).select("source_id", "n", "s.*")
    known = hot_join(found.where("source_id IS NOT NULL"), cut(used), "source_id", "n", "record_id", "inner")
    none = found.where("source_id IS NULL").withColumns({"_headers": F.lit(None).cast("map<string,string>"), "_digest": F.lit(None).cast("string")})

    def tag(headers: str) -> Column:
        return F.regexp_replace(F.col(headers)["etag"], "^W/", "")

    mine, theirs = tag("headers"), tag("_headers")
    dated, dates = F.col("headers")["last-modified"], F.col("_headers")["last-modified"]
    digests = F.col("digest").isNotNull() & F.col("_digest").isNotNull()
    resolution = (
        F.when(F.col("source_id").isNull(), "no_earlier_response")
        .when(mine != theirs, "etag_mismatch")
        .when(mine.isNull() | theirs.isNull(), F.when(dated != dates, "last_modified_mismatch"))
    )
    resolution = F.coalesce(
        resolution,
        F.when(digests & (F.col("digest") != F.col("_digest")), "digest_mismatch"),
        F.when(mine == theirs, "etag").when(dated == dates, "last_modified").when(digests, "digest").otherwise("no_validator"),
    )
    out = known.unionByName(none).withColumn("resolution", resolution)
    good = F.col("resolution").isin("etag", "last_modified", "digest")
    changed = F.map_filter("headers", lambda k, v: k.isin(*permitted))
    merged = F.map_concat(F.map_filter("_headers", lambda k, v: ~F.array_contains(F.map_keys(changed), k)), changed)
    return out.select("record_id", "url_key", "ts", "source_id", "resolution", F.when(good, merged).alias("headers"), F.when(good, F.col("_digest")).alias("digest"))


def captures_of(pages: DataFrame) -> DataFrame:
    """pages(page_id, url, html) as captures: for each page a response, a later one after the page has changed, and a conditional request in between or after that was answered with not-modified.

    One page in twenty is the same front page, so its responses compete; some
    responses are 404s, so that some requests have no earlier full response.
    """
    n = F.col("page_id")
    url = F.when(n % 20 == 0, "http://WWW.Example.com:80/?utm_source=x#top").otherwise(F.col("url"))
    html = F.coalesce("html", F.lit(""))

    def quoted(digest: Column) -> Column:
        return F.concat(F.lit('"'), F.substring(digest, 1, 16), F.lit('"'))

    def response(k: int, ts: Column, missing: Column, digest: Column, changed: Column) -> DataFrame:
        return pages.select(
            (n * 4 + k).alias("record_id"), url.alias("url"), ts.alias("ts"), F.lit("response").alias("kind"), F.when(missing, 404).otherwise(200).alias("status"),
            F.create_map(F.lit("ETag"), quoted(digest), F.lit("Last-Modified"), changed.cast("string"), F.lit("Content-Type"), F.lit("text/html"), F.lit("Date"), ts.cast("string")).alias("headers"),
            digest.alias("digest"),
        )

    first, again = F.md5(html), F.md5(F.concat(html, F.lit("2")))
    asked = n * 10 + 5 + (n % 50) * 15
    validators = (
        F.when(n % 6 == 0, F.create_map(F.lit("ETag"), F.concat(F.lit("W/"), quoted(first))))
        .when(n % 6 == 1, F.create_map(F.lit("last-modified"), (n % 1000).cast("string")))
        .when(n % 6 == 3, F.create_map(F.lit("ETag"), F.lit('"other"')))
        .when(n % 6 == 4, F.create_map(F.lit("ETag"), quoted(first), F.lit("Cache-Control"), F.lit("max-age=60")))
        .otherwise(F.create_map(F.lit("Server"), F.lit("any")))
    )
    revisit = pages.select(
        (n * 4 + 2).alias("record_id"), F.regexp_replace(url, "^http://", "HTTPS://").alias("url"), asked.alias("ts"), F.lit("revisit").alias("kind"), F.lit(304).alias("status"),
        F.map_concat(F.create_map(F.lit("Content-Type"), F.lit("text/plain"), F.lit("Date"), asked.cast("string")), validators).alias("headers"),
        F.when(n % 6 == 2, first).alias("digest"),
    )
    return response(0, n * 10, n % 7 == 3, first, n % 1000).unionByName(response(1, n * 10 + 350 + (n % 3) * 50, n % 11 == 4, again, (n + 1) % 1000)).unionByName(revisit)
