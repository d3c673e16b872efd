"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparklog.llm import exact_dedup, fingerprint, langid, line_dedup, mixing, packing, phrases, sharding, simhash, spelling, suffix_dedup, toxicity, warc
from sparklog.llm.common import table


def op1_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.resolve_revisits(warc.captures_of(table(spark, sf_dir, "pages")))
    lines = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"])))
    return found.withColumn("headers", F.array_join(lines, "; "))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "rate")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict_language(table(spark, sf_dir, "documents")).drop("langs")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_groups(table(spark, sf_dir, "documents"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.document_fingerprints(table(spark, sf_dir, "documents"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"), damage=199)


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_digest(sharding.shuffle_into_shards(table(spark, sf_dir, "documents")))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_warc_revisits": op1_warc_revisits,
    "op2_mixing": op2_mixing,
    "op3_toxicity": op3_toxicity,
    "op4_simhash": op4_simhash,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_language": op6_language,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_packing": op8_packing,
    "op9_line_dedup": op9_line_dedup,
    "op10_fingerprints": op10_fingerprints,
    "op11_spelling": op11_spelling,
    "op12_sharding": op12_sharding,
    "op13_phrases": op13_phrases,
}

ORACLE = {
    "op1_warc_revisits": r"""
        WITH p AS (
            SELECT page_id AS n, md5(coalesce(html, '')) AS first, md5(coalesce(html, '') || '2') AS again,
                   regexp_replace(regexp_replace(trim(CASE WHEN page_id % 20 = 0 THEN 'http://WWW.Example.com:80/?utm_source=x#top' ELSE url END), '#.*$', '', 's'), '^[A-Za-z][A-Za-z0-9+.\-]*://', '') AS rest
            FROM pages),
        q AS (
            SELECT n, first, again,
                   regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), '^[^@]*@', ''), ':(80|443)$', ''), '^www[0-9]*\.', '') AS host,
                   regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
                   array_to_string(list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1, 's'), '&'),
                       lambda x: x <> '' AND NOT regexp_matches(lower(x), '^(utm_[^=]*|gclid|fbclid|sessionid|jsessionid|phpsessid)(=|$)'))), '&') AS query
            FROM p),
        k AS (SELECT n, first, again, host || CASE path WHEN '' THEN '/' ELSE path END || CASE query WHEN '' THEN '' ELSE '?' || query END AS url_key FROM q),
        full_ AS (
            SELECT n * 4 AS s, url_key, n * 10 AS ts, first AS theirs, n % 1000 AS changed FROM k WHERE n % 7 <> 3
            UNION ALL SELECT n * 4 + 1, url_key, n * 10 + 350 + n % 3 * 50, again, (n + 1) % 1000 FROM k WHERE n % 11 <> 4),
        one AS (SELECT url_key, ts, max(s) AS s, arg_max(theirs, s) AS theirs, arg_max(changed, s) AS changed FROM full_ GROUP BY ALL),
        r AS (SELECT n, url_key, n * 10 + 5 + (n % 50) * 15 AS ts, CASE n % 6 WHEN 0 THEN first WHEN 4 THEN first WHEN 3 THEN 'other' END AS mine,
                     CASE n % 6 WHEN 1 THEN n % 1000 END AS dated, CASE n % 6 WHEN 2 THEN first END AS digest FROM k),
        j AS (SELECT r.*, s, theirs, changed FROM r ASOF LEFT JOIN one ON r.url_key = one.url_key AND r.ts > one.ts),
        v AS (SELECT *, CASE WHEN s IS NULL THEN 'no_earlier_response' WHEN left(mine, 16) <> left(theirs, 16) THEN 'etag_mismatch' WHEN mine IS NOT NULL THEN 'etag'
                             WHEN dated <> changed THEN 'last_modified_mismatch' WHEN dated = changed THEN 'last_modified'
                             WHEN digest <> theirs THEN 'digest_mismatch' WHEN digest = theirs THEN 'digest' ELSE 'no_validator' END AS resolution FROM j)
        SELECT n * 4 + 2 AS record_id, url_key, ts, s AS source_id, resolution,
               CASE WHEN resolution IN ('etag', 'last_modified', 'digest') THEN
                   CASE n % 6 WHEN 4 THEN 'cache-control: max-age=60; ' ELSE '' END || 'content-type: text/html; date: ' || ts || '; etag: '
                   || CASE n % 6 WHEN 0 THEN 'W/' ELSE '' END || '"' || left(theirs, 16) || '"; last-modified: ' || changed END AS headers,
               CASE WHEN resolution IN ('etag', 'last_modified', 'digest') THEN theirs END AS digest
        FROM v
    """,
    "op5_exact_dedup": """
        WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, text_sha256
        FROM t WINDOW w AS (PARTITION BY text_sha256)
    """,
    "op13_phrases": r"""
        WITH p AS (SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents WHERE text IS NOT NULL),
        w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
        g AS (SELECT lang, 1 AS k, unnest(w) AS phrase FROM w
              UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w WHERE len(w) > 1
              UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM w WHERE len(w) > 2),
        f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL),
        n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
        c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS s FROM f WHERE k > 1 AND a >= 10),
        cuts AS (SELECT lang, phrase, k, a, s, 1 AS cut, s[1] AS x, array_to_string(s[2:], ' ') AS y FROM c
                 UNION ALL SELECT lang, phrase, k, a, s, 2, s[1] || ' ' || s[2], s[3] FROM c WHERE k = 3),
        scored AS (SELECT cuts.lang, cuts.phrase, cuts.a, cut, l.a AS l, r.a AS r, CAST(1000000 * cuts.a::HUGEINT * cuts.a // (l.a::HUGEINT * r.a) AS BIGINT) AS score
                   FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = x JOIN f r ON r.lang = cuts.lang AND r.phrase = y),
        best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
        longer AS (SELECT lang, phrase, max(b) AS b FROM (SELECT lang, s[1] || ' ' || s[2] AS phrase, a AS b FROM c WHERE k = 3 UNION ALL SELECT lang, s[2] || ' ' || s[3], a FROM c WHERE k = 3) GROUP BY ALL)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
        FROM best LEFT JOIN longer USING (lang, phrase) JOIN n USING (lang) WHERE b IS NULL OR 100 * b < 50 * a
        QUALIFY rank <= 2000
    """,
}
