import random
import string

import pytest
from pyspark.sql import functions as F

from veilspan.llm import line_dedup as ld

LOW = {ord(a): a.lower() for a in string.ascii_uppercase}


def brute(rows, least=10):
    first = {}

    def key(line):
        return line.strip(ld.SPACE).translate(LOW)

    last = float("inf")
    for i, text in rows:
        for line in (text or "").split("\n"):
            k = key(line)
            first[k] = min(first.get(k, last), last if i is None else i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < least or first[key(x)] == (last if i is None else i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def got(df):
    return sorted([tuple(r) for r in df.select("doc_id", "n_lines", "n_dropped", "kept_text").collect()], key=str)


LICENSE = "Permission is hereby granted"
ROWS = [
    (5, f"{LICENSE}\nown line of five\n\n{LICENSE}"),
    (3, f"\t {LICENSE.upper()}\r\nshort\nshort\n{LICENSE} "),
    (9, f"short\n{LICENSE}\n{'é' * 10}\n{'É' * 10}"),
    (4, ""),
    (2, None),
    (None, f"{LICENSE}\nonly null has it\nonly null has it"),
    (None, "only null has it\nßßßßßßßßßß"),
    (8, f"{'é' * 10}\n{'é' * 9}\n ßßßßßßßßßß"),
    (8, f"another text of eight\n{'é' * 10}\nnine char"),
    (8, f"another text of eight\n{'é' * 10}\nnine char"),
    (11, "another text of eight\nnine char\n" + "a" + " " * 50_000 + "b\n" + "x" * 100_000),
    (12, "a" + " " * 50_000 + "b\n" + "X" * 100_000 + "\n no-break spaces stay\n\x1cso do others\x1c"),
    (13, "no-break spaces stay\n\x1cso do others\x1c\nso do others"),
]


def test_cases(make_docs):
    assert got(ld.line_dedup(make_docs(ROWS))) == brute(ROWS)


@pytest.mark.parametrize("parts", [1, 7])
def test_hot_lines_are_cut_into_slices(make_docs, parts):
    rng = random.Random(parts)
    rows = [(i, "\n".join(rng.choice([LICENSE, "a common boilerplate line", f"line number {rng.randrange(3000)}", "x"]) for _ in range(rng.randrange(1, 9)))) for i in rng.sample(range(10_000), 1500)]
    docs = make_docs(rows).repartition(parts)
    assert got(ld.line_dedup(docs)) == brute(rows)


def test_slices(spark, make_docs):
    from veilspan import scratch

    rows = make_docs([(i, "") for i in range(4000)], clash=False).select(F.when(F.col("doc_id") % 3 == 0, F.unhex(F.lit("00"))).otherwise(F.unhex(F.sha2(F.col("doc_id").cast("string"), 256))).alias("k"), F.col("doc_id").alias("doc"), F.lit(1).cast("long").alias("uid"), F.lit(0).alias("pos"))
    cut = ld.sliced(scratch.written(rows, "line-rows")).groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("slice").alias("s")).orderBy(F.desc("n")).collect()
    assert cut[0]["n"] == 1334 and cut[0]["s"] > 8


def test_bitmaps_are_compressed(spark, make_docs):
    text = "\n".join(f"line of number {i:05}" for i in range(20_000))
    docs = make_docs([(1, text), (2, text), (3, f"new line of three\n{text}\nand its end line"), (4, "x\n" * 6400 + text.split("\n")[7])])
    maps = {r.doc: r for r in ld.keep_bitmaps(docs).collect()}
    assert sorted(maps) == [2, 3, 4]
    assert [tuple(r) for r in maps[2].keep] == [(0, 312, 0), (0, 1, -1 << 32)]
    assert [(r.skip, r.n) for r in maps[3].keep] == [(0, 1), (0, 311), (0, 1)] and maps[3].n_dropped == 20_000
    assert [tuple(r) for r in maps[4].keep] == [(100, 1, -2)]


def test_many_short_lines_in_one_text(make_docs):
    rows = [(1, "\n" * 300_000), (2, "a common boilerplate line\n" * 100_000), (3, "a common boilerplate line\nx\n" * 100_000)]
    assert got(ld.line_dedup(make_docs(rows))) == brute(rows)


def test_empty(make_docs):
    assert ld.line_dedup(make_docs([])).count() == 0


def test_no_python_in_its_plan(spark, small):
    plan = ld.line_dedup(spark.read.parquet(f"{small}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_whole_table_and_sql(spark, small):
    import duckdb

    from veilspan.llm.queries import OP12_SQL, op12_line_dedup

    docs = spark.read.parquet(f"{small}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert got(ld.line_dedup(docs)) == want
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    sql = c.execute(OP12_SQL)
    assert [d[0] for d in sql.description] == op12_line_dedup(spark, small).columns
    assert sorted(sql.fetchall()) == sorted(tuple(r) for r in op12_line_dedup(spark, small).collect())
