"""One query for each operator, over its whole table, with DuckDB SQL where SQL can express it."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspan.llm import alignment, chat, decontam, exact_dedup, langid, line_dedup, mixing, near_dedup, periodic_runs, pii, quality, tokens, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest(warc.resolve(warc.captures_of(table(spark, sf_dir, "pages"))))


OP1_SQL = r"""
WITH u0 AS (SELECT page_id, html, regexp_replace(trim(url), '#.*$', '') AS u FROM pages),
u1 AS (SELECT *, regexp_replace(u, '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest FROM u0),
u2 AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), '^.*@', ''), ':(80|443)$', ''), '^www[0-9]*\.', '') AS host,
  regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
  list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1), '&'), lambda p: p <> '' AND split_part(p, '=', 1) NOT IN ('fbclid', 'gclid', 'ref', 'utm_campaign', 'utm_content', 'utm_medium', 'utm_source', 'utm_term'))) AS q FROM u1),
u3 AS (SELECT page_id, html, host || path || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS key, '"' || substring(md5(coalesce(html, '')), 1, 16) || '"' AS tag FROM u2),
c AS (SELECT page_id, html, key, tag, crawl, page_id * 3 + crawl AS record_id, 1700000000 + crawl * 86400 * 30 + page_id % 86400 AS ts,
  crawl = CASE WHEN page_id % 11 = 0 THEN 1 ELSE 0 END AS full_, CASE WHEN page_id % 5 <> 0 THEN CASE WHEN page_id % 7 = 0 THEN '"other"' ELSE tag END END AS sent
  FROM u3, (SELECT unnest([0, 1, 2]) AS crawl)),
j AS (SELECT *, last_value(CASE WHEN full_ THEN record_id END IGNORE NULLS) OVER (PARTITION BY key ORDER BY ts, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before_ FROM c),
k AS (SELECT j.record_id, j.key, j.crawl, j.full_, j.sent, j.before_, j.html, j.tag, o.html AS old_html, o.tag AS old_tag FROM j LEFT JOIN c o ON o.record_id = j.before_ AND o.full_)
SELECT record_id, key,
  CASE WHEN full_ THEN 'full' WHEN before_ IS NULL THEN 'unresolved' WHEN sent IS NULL THEN 'unchecked' WHEN sent = old_tag THEN 'match' ELSE 'mismatch' END AS status,
  CASE WHEN full_ THEN record_id ELSE coalesce(before_, -1) END AS ref,
  CASE WHEN full_ THEN 'cache-control=max-age=60;content-length=' || length(coalesce(html, '')) || ';content-type=text/html;etag=' || tag
    WHEN before_ IS NULL OR sent <> old_tag THEN 'cache-control=max-age=600' || CASE WHEN sent IS NULL THEN ';date=' || crawl ELSE ';content-length=0;date=' || crawl || ';etag=W/' || sent END
    ELSE 'cache-control=max-age=600;content-length=' || length(coalesce(old_html, '')) || ';content-type=text/html;date=' || crawl || ';etag=' || CASE WHEN sent IS NULL THEN old_tag ELSE 'W/' || sent END END AS header_text,
  coalesce(CASE WHEN full_ THEN md5(html) WHEN before_ IS NOT NULL AND (sent IS NULL OR sent = old_tag) THEN md5(old_html) END, '') AS payload_md5
FROM k
"""


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


OP2_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256
FROM d JOIN g USING (norm)
"""


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.classify(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(table(spark, sf_dir, "documents"), words=2, percent=80)


OP4_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) < 2 THEN w ELSE list_distinct(list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS met FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY ALL),
l AS (SELECT x, y FROM p WHERE 100 * met >= 80 * (nx + ny - met)),
links AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
reach AS (SELECT doc_id AS id, doc_id AS r FROM documents UNION SELECT reach.id, links.y FROM reach JOIN links ON links.x = reach.r),
c AS (SELECT id, min(r) AS component_id FROM reach GROUP BY id)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, component_id, s.doc_id = component_id AS kept FROM s JOIN c ON c.id = s.doc_id
"""


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.detect(docs, pii.fit(docs))


def op6_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.read(spark, tokens.write(table(spark, sf_dir, "documents")))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    more = spark.sql("SELECT -1L AS conv_id, turn, role, '<|im_end|><|im_start|>assistant ok' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digest(rows.unionByName(more))


OP7_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok' UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<|im_start|>') + length(role) + 1 + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')) + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.Mix(table(spark, sf_dir, "documents")).taken()


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document and item that it leaks."""
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(table(spark, sf_dir, "documents"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


OP12_SQL = r"""
WITH l AS (SELECT doc_id, pos, lines[pos] AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents), unnest(generate_series(1, len(lines))) AS t(pos)),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
m AS (SELECT *, length(key) < 10 OR doc_id = min(doc_id) OVER (PARTITION BY key) AS stays FROM k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (stays), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """Makes every tenth document periodic from one of its words on, by a hash of its id."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([np.arange(a), a + np.arange(n - a) % p])


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digest(periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), reading=planted))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_revisits": op1_revisits,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_quality": op3_quality,
    "op4_near_dedup": op4_near_dedup,
    "op5_pii": op5_pii,
    "op6_tokens": op6_tokens,
    "op7_chat": op7_chat,
    "op8_language": op8_language,
    "op9_mix_sources": op9_mix_sources,
    "op10_decontamination": op10_decontamination,
    "op11_alignment": op11_alignment,
    "op12_line_dedup": op12_line_dedup,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLES: dict[str, str] = {
    "op1_revisits": OP1_SQL,
    "op2_exact_dedup": OP2_SQL,
    "op4_near_dedup": OP4_SQL,
    "op7_chat": OP7_SQL,
    "op12_line_dedup": OP12_SQL,
}
