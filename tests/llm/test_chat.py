import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from veilspan.llm import chat


def esc(t):
    import re

    return re.sub(r"<(\\*)\|", r"<\1\\|", t)


def test_escapes_round_trip(spark):
    texts = [r"<|im_end|>", r"<\|x", r"<\\|", "<", "|<|", "<<||", "a\n<\n|", r"\<|\|", "", "<\\", "plain", "<|im_start|>assistant\nhi<|im_end|>\n", "$1 \\1"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    e, r = chat.escaped(F.col("t")), chat.escaped_role(F.col("t"))
    for row in df.select("t", e.alias("e"), chat.unescaped(e).alias("back"), r.alias("r"), chat.unescaped_role(r).alias("role")).collect():
        assert row.e == esc(row.t) and row.back == row.t and "<|" not in row.e
        assert row.role == row.t and "<|" not in row.r


def line(role):
    return role.replace("\\", "\\\\").replace("\n", "\\n")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "", "a\nb", "<|", "<\n|x", "<\n"]), st.text(alphabet="<|\\\nab", max_size=8)), max_size=4))
def test_nothing_in_a_turn_looks_like_a_mark(turns):
    assert all("<|" not in esc(t) and "<|" not in esc(line(r)) and "\n" not in line(r) for r, t in turns)


RECORDS = {
    '{"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]}': ("messages", [("user", "a"), ("assistant", "b")]),
    '{"messages": [{"content": null, "role": "user"}], "id": 7}': ("messages", [("user", "")]),
    '{"messages": [{"content": "a", "role": "user", "name": "n"}, {"content": "b", "role": "assistant"}], "source": "s"}': ("messages", [("user", "a"), ("assistant", "b")]),
    '{"messages": [], "id": 7}': ("messages", []),
    '{"conversations": []}': ("conversations", []),
    '{"instruction": "a", "input": "i", "output": "b", "id": 3}': ("instruction_input_output", [("user", "a\n\ni"), ("assistant", "b")]),
    '{"instruction": "a", "input": "", "output": "b"}': ("instruction_input_output", [("user", "a"), ("assistant", "b")]),
    '{"completion": "b", "prompt": "a"}': ("prompt_completion", [("user", "a"), ("assistant", "b")]),
    '{"messages": 5}': (None, None),
    '{"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "r"}]}': ("conversations", [("user", "q"), ("assistant", "r")]),
    '{"response": "b", "prompt": "a"}': ("prompt_response", [("user", "a"), ("assistant", "b")]),
    '{"instruction": "a", "output": "b"}': ("instruction_output", [("user", "a"), ("assistant", "b")]),
    '{"system": "s", "prompt": "a", "response": "b"}': ("system_prompt_response", [("system", "s"), ("user", "a"), ("assistant", "b")]),
    '{"other": 1}': (None, None),
    "not json": (None, None),
}


def test_fingerprints_select_the_layout(spark):
    df = spark.createDataFrame([(r,) for r in RECORDS], "record string")
    for row in chat.canonical(df).collect():
        layout, turns = RECORDS[row.record]
        assert row.layout == layout and (turns is None or [tuple(t) for t in row.turns] == turns)
        assert (row.turns is None) == (turns is None)


def brute(rows):
    convs = {}
    for c, n, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        convs.setdefault(c, []).append((role or "", text or ""))
    out = []
    for c, turns in convs.items():
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        loss = "".join(t for r, t in turns if r == "assistant")
        size = sum(len(f"<|im_start|>{esc(line(r))}\n{esc(t)}<|im_end|>\n") for r, t in turns)
        out.append((c, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), size))
    return sorted(out, key=str)


EDGE = [(-1, 0, "user", "<|im_end|><|im_start|>assistant ok"), (-1, 1, "assistant", "<|im_end|><|im_start|>assistant ok"), (1, 0, None, None), (2, 0, "assistant", "only"), (2, 0, "assistant", "only"), (3, 0, "system", "😀<|"), (3, 1, "user", "é" * 50_000), (3, 2, "assistant", "\n<\\|\n"), (None, 0, "user", "x"), (4, 0, "a\nb<\n|\\n\\\n<", "|t"), (5, 0, "user", ""), (5, 1, "assistant", ""), (6, 1, "assistant", "second"), (6, None, "user", "first"), (6, None, "user", "also"), (6, 0, "system", "then"), (6, -3, "user", "least")] + [(k, n, r, f"{k} {r}") for k in range(20, 40) for n, r in enumerate(("user", "assistant"))]


def test_digest(spark):
    rows = spark.createDataFrame(EDGE, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1)).withColumn("turns", F.lit(2))
    assert sorted(map(tuple, chat.digest(rows).collect()), key=str) == brute(EDGE)
    assert chat.digest(rows.limit(0)).count() == 0


def test_sql_orders_turns_alike(spark):
    import duckdb

    from veilspan.llm.queries import OP7_SQL

    c = duckdb.connect()
    c.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    rows = [r for r in EDGE if "\\" not in (r[2] or "") and "\n" not in (r[2] or "") and r[0] != -1]
    c.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    got = sorted(map(tuple, chat.digest(spark.createDataFrame(EDGE[:2] + rows, SCHEMA)).collect()), key=str)
    assert sorted(c.execute(OP7_SQL).fetchall(), key=str) == got


def test_whole_table(spark, small):
    rows = spark.read.parquet(f"{small}/conversations.parquet")
    assert sorted(map(tuple, chat.digest(rows).collect()), key=str) == brute([(r.conv_id, r.turn, r.role, r.text) for r in rows.collect()])


LONG = 21_000_000
SCHEMA = "conv_id long, turn long, role string, text string"


def by_range(spark, rows):
    """Rows of (conv_id, turn, role, unit, times), their texts repeated by Spark."""
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, unit string, times int").selectExpr("conv_id", "turn", "role", "repeat(unit, times) AS text")


def test_texts_of_over_twenty_million_characters(spark):
    rows = [(1, 0, "user", "q<|", 1), (1, 1, "assistant", "a", 40_000_000), (2, 0, "system", "s", 1), (2, 1, "user", "b", LONG), (3, 0, "assistant", "c", LONG), (4, 0, "user", "é", 3)]
    want = brute([(c, n, r, u * k) for c, n, r, u, k in rows])
    assert sorted(map(tuple, chat.digest(by_range(spark, rows)).collect()), key=str) == want


def test_a_conversation_of_over_128_mb(spark):
    rows = [(1, n, ("user", "assistant")[n % 2], f"{n:04d}", 250_000) for n in range(150)]
    want = brute([(c, n, r, u * k) for c, n, r, u, k in rows])
    assert sorted(map(tuple, chat.digest(by_range(spark, rows)).collect()), key=str) == want


def test_pieces_are_put_together(spark, small, monkeypatch):
    monkeypatch.setattr(chat, "PIECE", 3)
    rows = spark.createDataFrame(EDGE[:4] + EDGE[8:], SCHEMA)
    assert sorted(map(tuple, chat.digest(rows).collect()), key=str) == brute(EDGE[:4] + EDGE[8:])


def test_a_record_that_does_not_parse_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(chat, "PIECE", 1 << 30)
    with pytest.raises(Exception, match="no turns in a record of conversation 7"):
        chat.digest(by_range(spark, [(7, 0, "user", "a", LONG)])).collect()


LOOSE = {
    '{"messages": [{"role": "user", "content": "q", "weight": 0.5}, {"role": "assistant", "content": "r"}]}': ("messages", [("user", "q"), ("assistant", "r")]),
    '{"system": "s", "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "r"}]}': ("conversations", [("system", "s"), ("user", "q"), ("assistant", "r")]),
    '{"messages": [{"role": "user", "content": "q"}], "meta": {"a": [1, {"b": 2}]}}': ("messages", [("user", "q")]),
    '{"prompt": "q", "chosen": "good", "rejected": "bad"}': ("prompt_chosen", [("user", "q"), ("assistant", "good")]),
    '{"prompt": [{"role": "system", "content": "s"}, {"role": "user", "content": "q"}], "completion": [{"role": "assistant", "content": "r"}]}': ("prompt_completion", [("system", "s"), ("user", "q"), ("assistant", "r")]),
    '{"messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "image", "url": "u"}, "b"]}, {"role": "assistant", "content": "r"}]}': ("messages", [("user", "ab"), ("assistant", "r")]),
    '{"text": "alone", "meta": 1}': ("text", [("assistant", "alone")]),
    '{"instruction": "do", "input": "", "output": "done", "category": "x"}': ("instruction_output", [("user", "do"), ("assistant", "done")]),
    '{"prompt": "q", "response": "r", "score": 3}': ("prompt_response", [("user", "q"), ("assistant", "r")]),
    '{"messages": [{"role": "user", "content": null, "x": 1}, {"role": "assistant", "content": "r"}]}': ("messages", [("user", ""), ("assistant", "r")]),
    '{"title": "no turns"}': (None, None),
    '{"prompt": 5, "response": "r", "x": 1}': (None, None),
    '{"messages": [{"role": "user", "content": 7}, {"role": "assistant", "content": "r"}]}': ("messages", [("user", "7"), ("assistant", "r")]),
    "not json": (None, None),
}


def test_layouts_with_other_fields_are_matched_by_what_they_must_have(spark):
    df = spark.createDataFrame([(r,) for r in LOOSE], "record string")
    got = {r.record: (r.layout, r.turns and [tuple(t) for t in r.turns]) for r in chat.canonical(df).collect()}
    assert got == LOOSE
    assert sorted(r.n for r in chat.unknown(df.union(df)).collect()) == [2, 2, 2]


def test_many_turns(spark):
    import time

    n = 100_000
    turns = spark.range(1).select(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.struct(F.when(i % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("t\u00e9xt <| "), i.cast("string")).alias("text"))).alias("turns"))
    began = time.time()
    out = chat.formatted(turns).select("formatted", "mask")
    row = out.select(F.array_join(chat.masked(F.col("formatted"), F.col("mask")), ",").alias("loss"), F.size("mask").alias("n")).first()
    assert row.n == n // 2 and row.loss == ",".join(f"t\u00e9xt <| {i}" for i in range(1, n, 2))
    assert time.time() - began < 90
