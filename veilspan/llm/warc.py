"""Not-modified revisits of web archives.

A revisit record says that a server answered 304 Not Modified. It is resolved by an
as-of join on the canonical URL: the latest full response before it, in order of capture
time and record id. The revisit's validators (ETag, Last-Modified) are checked against
that response's; where they agree, the payload is the response's, and the headers are the
response's, overwritten by those of the revisit that a 304 may update.

The as-of join deals out all captures by range of (URL, time, record id, row digest), so
that a URL with very many captures, even at one moment, is split over tasks. The latest
response is found within each part and URL; for the URLs that a cut runs through, at most
one for each part, the latest of the parts before is added. Each revisit then has the
place of the response it refers to, by which the payload is joined; revisits of a response
with very many of them are salted.

Defined results:

* each record of the input comes out once, however often records or their ids are repeated
* a record with a null URL or time, and a revisit before any response, is ``unresolved``
* an ETag on both sides decides, compared weakly (without ``W/``); with none,
  Last-Modified on both sides; without validators on both sides the revisit is
  ``unchecked`` and resolved; where they differ it is ``mismatch`` and not resolved
* records at the same time come in the order of their ids, a null id first; with equal ids
  in the order of a hash of their contents
* a response without an id is referred to like others; ``ref`` is null then
* header names that differ in case only are one header, with the last value
* responses are returned as they are, ``full``; an empty table gives an empty one
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from veilspan import scratch

#: A response with more than this share of all revisits is salted; there are at most 1/share of them.
HOT_SHARE, HOT_LEAST = 0.001, 1000
#: Headers that a 304 doesn't update, lower case.
NOT_UPDATED = ("connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive", "proxy-authenticate", "proxy-authorization", "te", "trailer", "transfer-encoding", "upgrade")
#: Query parameters that name where a visit came from.
TRACKING = ("fbclid", "gclid", "ref", "utm_campaign", "utm_content", "utm_medium", "utm_source", "utm_term")
HEADERS = "map<string,string>"


def canonical_url(url: Column) -> Column:
    """Without scheme, user, ``www.``, default port, fragment, tracking parameters and closing slash; host in lower case, parameters sorted."""
    u = F.regexp_replace(F.trim(url), r"#.*$", "")
    rest = F.regexp_replace(u, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(rest, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":(80|443)$", "")
    host = F.regexp_replace(host, r"^www\d*\.", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.split(F.regexp_extract(rest, r"\?(.*)$", 1), "&")
    kept = F.array_sort(F.filter(query, lambda p: (p != "") & ~F.substring_index(p, "=", 1).isin(*TRACKING)))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit("")))


def _low(headers: Column) -> Column:
    """Names in lower case; of names that are then equal, the last one counts."""
    entries = F.transform(F.map_entries(F.coalesce(headers, F.create_map().cast(HEADERS))), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    later = F.transform(entries, lambda e, i: F.struct(e.alias("e"), F.slice(F.transform(entries, lambda x: x["key"]), i + 2, F.size(entries)).alias("rest")))
    return F.map_from_entries(F.transform(F.filter(later, lambda x: ~F.array_contains(x["rest"], x["e"]["key"])), lambda x: x["e"]))


def merged_headers(stored: Column, fresh: Column) -> Column:
    """The stored headers, with those of the 304 that it may update put over them; both with names in lower case."""
    allowed = F.map_filter(fresh, lambda k, _: ~k.isin(*NOT_UPDATED))
    left = F.map_filter(stored, lambda k, _: ~F.map_contains_key(allowed, k))
    return F.map_from_entries(F.array_sort(F.concat(F.map_entries(left), F.map_entries(allowed))))


def check(stored: Column, fresh: Column) -> Column:
    """match, mismatch or unchecked, from headers with names in lower case."""

    def pair(name: str) -> tuple[Column, Column]:
        return tuple(F.regexp_replace(F.element_at(h, name), "^W/", "") for h in (stored, fresh))

    (e1, e2), (m1, m2) = pair("etag"), pair("last-modified")

    def say(a: Column, b: Column) -> Column:
        return F.when(a == b, "match").otherwise("mismatch")

    return F.when(e1.isNotNull() & e2.isNotNull(), say(e1, e2)).when(m1.isNotNull() & m2.isNotNull(), say(m1, m2)).otherwise("unchecked")


def latest_response(captures: DataFrame, parts: int | None = None) -> DataFrame:
    """``captures`` (record_id, key, ts, uid, is_full, ...), a written table, with ``ref``: place (record_id, ts, uid) of the latest full response of the key before each row, by (ts, record_id, uid)."""
    spark = captures.sparkSession
    order = [F.col("ts").asc(), F.col("record_id").asc_nulls_first(), F.col("uid").asc()]
    dealt = captures.repartitionByRange(parts or int(spark.conf.get("spark.sql.shuffle.partitions")), F.col("key"), *order).withColumn("part", F.spark_partition_id())
    rows = scratch.written(dealt, "revisit-parts")
    own = F.when(F.col("is_full"), F.struct("record_id", "ts", "uid"))
    within = Window.partitionBy("part", "key").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("near", F.last(own, ignorenulls=True).over(within))
    sort_key = F.struct("ts", F.col("record_id").isNotNull().alias("known"), "record_id", "uid")
    ends = rows.groupBy("key", "part").agg(F.max_by(own, F.when(F.col("is_full"), sort_key)).alias("top"))
    cut = ends.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.collect_list(F.struct("part", "top")).alias("t")).where("n > 1")  # at most a row for each part
    cut = cut.select("key", F.explode("t").alias("t")).select("key", "t.*")
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    far = scratch.written(cut.select("key", "part", F.last("top", ignorenulls=True).over(before).alias("far")), "revisit-cuts")
    return rows.join(F.broadcast(far), ["key", "part"], "left").withColumn("ref", F.coalesce("near", "far")).drop("part", "near", "far")


def resolve(records: DataFrame) -> DataFrame:
    """For each record (record_id, url, ts long, kind 'response' or 'revisit', headers map, payload): record_id, key, status, ref, headers, payload."""
    rows = records.select(F.col("record_id").cast("long").alias("record_id"), canonical_url(F.col("url")).alias("key"), F.col("ts").cast("long").alias("ts"), F.coalesce(F.col("kind") == "response", F.lit(False)).alias("is_full"), _low(F.col("headers")).alias("headers"), F.col("payload").cast("string").alias("payload"))
    rows = rows.withColumn("uid", F.xxhash64("record_id", "key", "ts", F.array_sort(F.map_entries("headers")), "payload"))
    light = rows.select("record_id", "key", "ts", "uid", "is_full", F.when(~F.col("is_full"), F.col("headers")).alias("fresh"))
    light = scratch.written(light, "revisit-records")
    placed = light.where("key is not null and ts is not null")
    found = latest_response(placed).where("not is_full").select("record_id", "key", "uid", "fresh", "ref")
    found = scratch.written(found, "revisit-found")

    total = found.count()
    per = max(HOT_LEAST, int(total * HOT_SHARE))
    refs = found.where("ref is not null").groupBy("ref", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > per)
    hot = scratch.written(refs.select(F.col("ref").alias("hot_ref"), F.col("key").alias("hot_key"), F.ceil(F.col("n") / per).cast("int").alias("salts")), "revisit-hot")  # at most 1 / HOT_SHARE rows
    salts = F.coalesce("salts", F.lit(1))
    revisits = found.join(F.broadcast(hot), (F.col("ref") == F.col("hot_ref")) & (F.col("key") == F.col("hot_key")), "left")
    revisits = revisits.select("record_id", "key", "fresh", "ref", F.pmod(F.xxhash64("record_id", "uid", F.lit("salt")), salts).cast("int").alias("salt"))
    # the place's columns, none of them null where there is a place, so that one exchange serves the distinct rows and the join
    place = lambda r: {"at_known": r["record_id"].isNotNull(), "at_id": F.coalesce(r["record_id"], F.lit(0)), "at_ts": r["ts"], "at_uid": r["uid"]}
    revisits = revisits.withColumns(place(F.col("ref")))
    stored = rows.where("is_full and key is not null and ts is not null").select(F.struct("record_id", "ts", "uid").alias("own"), "key", F.col("headers").alias("stored"), "payload")
    stored = stored.join(F.broadcast(hot), (F.col("own") == F.col("hot_ref")) & (F.col("key") == F.col("hot_key")), "left")
    stored = stored.withColumns(place(F.col("own"))).withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    on = ["key", "salt", "at_known", "at_id", "at_ts", "at_uid"]
    # rows of one place are equal in all that counts: one of them is enough
    stored = stored.select(*on, "stored", "payload").dropDuplicates(on)
    joined = revisits.join(stored, on, "left")
    status = F.when(F.col("ref").isNull(), "unresolved").otherwise(check(F.col("stored"), F.col("fresh")))
    done = joined.withColumn("status", status)
    good = F.col("status").isin("match", "unchecked")
    done = done.select("record_id", "key", "status", F.col("ref.record_id").alias("ref"), F.when(good, merged_headers(F.col("stored"), F.col("fresh"))).otherwise(F.col("fresh")).alias("headers"), F.when(good, F.col("payload")).alias("payload"))
    plain = rows.where("is_full").select("record_id", "key", F.lit("full").alias("status"), F.col("record_id").alias("ref"), "headers", "payload")
    lost = light.where("not is_full and (key is null or ts is null)").select("record_id", "key", F.lit("unresolved").alias("status"), F.lit(None).cast("long").alias("ref"), F.col("fresh").alias("headers"), F.lit(None).cast("string").alias("payload"))
    return plain.unionByName(done).unionByName(lost)


def captures_of(pages: DataFrame) -> DataFrame:
    """Records of three crawls of ``pages``: a full response of each page, then two 304 answers with validators by fixed rules: every 7th has another ETag, every 5th none, every 11th page is first asked before its response."""
    etag = F.concat(F.lit('"'), F.substring(F.md5(F.coalesce("html", F.lit(""))), 1, 16), F.lit('"'))
    crawl = F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("crawl")
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", etag.alias("etag"), crawl)
    first = F.col("crawl") == F.when(F.col("page_id") % 11 == 0, 1).otherwise(0)
    headers = F.when(first, F.map_from_arrays(F.array(F.lit("Content-Type"), F.lit("Content-Length"), F.lit("ETag"), F.lit("Cache-Control")), F.array(F.lit("text/html"), F.length(F.coalesce("html", F.lit(""))).cast("string"), F.col("etag"), F.lit("max-age=60"))))
    other = F.concat(F.lit("W/"), F.when(F.col("page_id") % 7 == 0, F.lit('"other"')).otherwise(F.col("etag")))
    with_tag = F.map_from_arrays(F.array(F.lit("Date"), F.lit("ETag"), F.lit("Content-Length"), F.lit("Cache-Control")), F.array(F.col("crawl").cast("string"), other, F.lit("0"), F.lit("max-age=600")))
    without = F.map_from_arrays(F.array(F.lit("Date"), F.lit("Cache-Control")), F.array(F.col("crawl").cast("string"), F.lit("max-age=600")))
    headers = headers.when(F.col("page_id") % 5 == 0, without).otherwise(with_tag)
    ts = F.lit(1_700_000_000) + F.col("crawl") * 86_400 * 30 + F.col("page_id") % 86_400
    return p.select((F.col("page_id") * 3 + F.col("crawl")).alias("record_id"), "url", ts.cast("long").alias("ts"), F.when(first, "response").otherwise("revisit").alias("kind"), headers.alias("headers"), F.when(first, F.col("html")).alias("payload"))


def digest(resolved: DataFrame) -> DataFrame:
    """record_id, key, status, ref (-1 for none), header_text (name=value, by name), payload_md5 (empty for none)."""
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return resolved.select("record_id", "key", "status", F.coalesce("ref", F.lit(-1).cast("long")).alias("ref"), F.array_join(lines, ";").alias("header_text"), F.coalesce(F.md5("payload"), F.lit("")).alias("payload_md5"))
