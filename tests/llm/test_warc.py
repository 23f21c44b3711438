import random

import pytest
from pyspark.sql import functions as F

from veilspan.llm import warc


def low(h):
    return {k.lower(): v for k, v in (h or {}).items()}


def place(r):
    """By time, then id, a null one first."""
    return (r["ts"], r["record_id"] is not None, r["record_id"] or 0)


def brute(rows, key):
    out = []
    full = [r for r in rows if r["kind"] == "response" and r["ts"] is not None and key[r["url"]] is not None]
    for r in rows:
        if r["kind"] == "response":
            out.append((r["record_id"], "full", r["record_id"], low(r["headers"]), r["payload"]))
            continue
        old = [] if r["ts"] is None else [f for f in full if key[f["url"]] == key[r["url"]] and place(f) < place(r)]
        if not old:
            out.append((r["record_id"], "unresolved", None, low(r["headers"]), None))
            continue
        f = max(old, key=place)
        a, b = low(f["headers"]), low(r["headers"])
        status = "unchecked"
        for name in ("etag", "last-modified"):
            if name in a and name in b:
                status = "match" if a[name].removeprefix("W/") == b[name].removeprefix("W/") else "mismatch"
                break
        if status == "mismatch":
            out.append((r["record_id"], status, f["record_id"], b, None))
        else:
            out.append((r["record_id"], status, f["record_id"], a | {k: v for k, v in b.items() if k not in warc.NOT_UPDATED}, f["payload"]))
    return out


SCHEMA = "record_id long, url string, ts long, kind string, headers map<string,string>, payload string"


def frame(spark, rows):
    df = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA)
    for name in ("key", "ref", "span", "part", "uid", "salt", "fresh", "stored", "status"):
        df = df.withColumn(name, F.lit(1))
    return df


def plain(rows):
    return sorted(((r[0], r[1], r[2], sorted(r[3].items()), r[4]) for r in rows), key=str)


def resolved(df):
    return plain((r.record_id, r.status, r.ref, r.headers, r.payload) for r in warc.resolve(df).collect())


def keys(df):
    return {r.url: r.k for r in df.select("url", warc.canonical_url(F.col("url")).alias("k")).distinct().collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_as_of_join(spark, seed, monkeypatch):
    monkeypatch.setattr(warc, "HOT_LEAST", 20)  # so that some responses are salted
    rng = random.Random(seed)
    urls = ["http://a.com/x", "https://www.a.com/x/", "http://b.org/?utm_source=q&z=1", "http://hot.net/"] + [None]
    rows = []
    for i in range(900):
        u = "http://hot.net/" if rng.random() < 0.5 else rng.choice(urls)
        kind = "response" if rng.random() < 0.1 else "revisit"
        headers = {k: v for k, v in {"ETag": rng.choice(['"1"', 'W/"1"', '"2"']), "Last-Modified": rng.choice(["m", "n"]), "Content-Type": kind, "X": str(i), "x": str(i)}.items() if rng.random() < 0.7}
        ts = rng.choice([None, *range(40)]) if rng.random() < 0.05 else 7 if u == "http://hot.net/" and rng.random() < 0.6 else rng.randrange(40) * 50
        rows.append({"record_id": i, "url": u, "ts": ts, "kind": kind, "headers": headers if rng.random() < 0.95 else None, "payload": f"p{i}" if kind == "response" and rng.random() < 0.95 else None})
    for k in range(12):  # without an id, each at a time of its own
        rows.append({"record_id": None, "url": urls[k % 4], "ts": 11 + 100 * k, "kind": "response" if k % 3 else "revisit", "headers": {"ETag": '"1"'}, "payload": f"null id {k}"})
    rows += [dict(r) for r in rng.sample(rows, 200)] * 2  # whole records again
    df = frame(spark, rows)
    got, want = resolved(df), plain(brute(rows, keys(df)))
    assert got == want and len(got) == len(rows)
    assert warc.resolve(df.limit(0)).count() == 0


def test_one_url_at_one_moment_is_split(spark):
    rows = [{"record_id": i, "url": "http://hot.net/", "ts": 5, "kind": "response" if i in (3, 2000) else "revisit", "headers": {}, "payload": f"p{i}" if i in (3, 2000) else None} for i in range(4000)]
    out = {r.record_id: r.payload for r in warc.resolve(frame(spark, rows)).collect()}
    assert out == {i: None if i < 3 else "p3" if i < 2000 else "p2000" for i in range(4000)}
    light = frame(spark, rows).select("record_id", F.lit("k").alias("key"), "ts", F.xxhash64("record_id").alias("uid"), (F.col("kind") == "response").alias("is_full"))
    assert warc.latest_response(light, 6).where("not is_full").groupBy("ref.record_id").count().count() == 3


def test_equal_ids_with_other_contents(spark):
    rows = [{"record_id": 1, "url": "u.org", "ts": 1, "kind": "response", "headers": {}, "payload": p} for p in ("a", "b", "b")]
    rows += [{"record_id": k, "url": "u.org", "ts": 2, "kind": "revisit", "headers": {}, "payload": None} for k in (2, 2, 3)]
    out = warc.resolve(frame(spark, rows)).collect()
    assert sorted((r.record_id, r.status, r.ref) for r in out) == [(1, "full", 1)] * 3 + [(2, "unchecked", 1)] * 2 + [(3, "unchecked", 1)]
    assert len({r.payload for r in out if r.record_id > 1}) == 1


def test_canonical_urls(spark):
    cases = {
        "HTTP://User@WWW.Example.com:80/A/b/?utm_source=x&b=2&a=1#top": "example.com/A/b?a=1&b=2",
        "https://example.com": "example.com",
        "http://example.com/?ref=x": "example.com",
        "https://m.example.com/en/25#top": "m.example.com/en/25",
        "": "",
    }
    df = spark.createDataFrame([(u,) for u in cases], "u string")
    assert {r.u: r.k for r in df.select("u", warc.canonical_url(F.col("u")).alias("k")).collect()} == cases
