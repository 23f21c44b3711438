import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from veilspan.operators import hooks, words
from veilspan.sources import files


def test_files_are_sniffed(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF-1.7 x")
    (tmp_path / "b.png").write_bytes(b"\x89PNG\r\n\x1a\n")
    (tmp_path / "c.jpg").write_bytes(b"\xff\xd8\xff\xe0")
    got = {r.path[-5:]: r.format for r in files.documents(spark, str(tmp_path)).collect()}
    assert got == {"a.pdf": "pdf", "b.png": "image", "c.jpg": "image"}
    (tmp_path / "d.txt").write_bytes(b"hello")
    with pytest.raises(Exception, match="unsupported"):
        files.documents(spark, str(tmp_path)).collect()


WORD = {"text": "Ada", "box": {"x": 1, "y": 2, "w": 3, "h": 4}, "conf": 90, "line_id": "1:1:1", "char_span": {"start": 0, "end": 3}}


def test_pages_of_saved_envelopes(spark, tmp_path):
    page = {"page_index": 4, "image_dimensions": {"width": 10, "height": 20}, "text": "Ada", "lines": [], "words": [WORD], "extra": 1}
    (tmp_path / "one.json").write_text(json.dumps({"page_count": 1, "pages": [page]}))
    (tmp_path / "list.json").write_text(json.dumps([{"page_count": 1, "pages": [dict(page, page_index=None)]}]))
    got = files.pages_json(spark, str(tmp_path)).collect()
    (tmp_path / "back.json").write_text(json.dumps({"page_count": 2, "pages": [page, dict(page, page_index=1)]}))
    assert [r.page_index for r in files.pages_json(spark, f"{tmp_path}/back.json").collect()] == [1, 4]
    assert sorted(r.page_index for r in got) == [0, 4] and all(r.words[0].text == "Ada" for r in got)
    (tmp_path / "bad.json").write_text(json.dumps({"page_count": 1, "pages": [dict(page, words=[])]}))
    with pytest.raises(Exception, match="without words"):
        files.pages_json(spark, str(tmp_path)).collect()


def test_payloads(spark):
    ddl = "page_index INT, words ARRAY<STRING>"
    ok = files.payload(F.lit('{"page_index": 1, "words": [], "more": 2}'), ddl, ("page_index", "words"))
    assert tuple(spark.range(1).select(ok.alias("p")).first().p) == (1, [])
    for text, match in (('{"words": []}', "no page_index"), ("{nope", ".")):
        with pytest.raises(Exception, match=match):
            spark.range(1).select(files.payload(F.lit(text), ddl, ("page_index",)).alias("p")).collect()


def test_manifests(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"dpi": 200, "page_width_px": 5, "page_height_px": 6, "elements": [{"id": "s", "type": "stamp", "box_px": [1, 2, 3, 4], "expected_unaccounted": True}]}))
    r = files.manifests(spark, str(tmp_path)).first()
    assert (r.id, r.left, r.top, r.right, r.bottom, r.expected_unaccounted) == ("s", 1, 2, 3, 4, True)


def test_words_to_pages(spark):
    raw = spark.createDataFrame([(1, 0, "Hello", "96", 1, 1, 1), (1, 1, "", "-1", 1, 1, 1), (1, 2, " wörld ", "12.7", 1, 1, 1), (1, 3, "next", "-1", 1, 1, 2), (1, 4, "line", "0", 2, 1, 1), (1, 5, "x", None, 2, 1, 1)], "page int, seq int, text string, conf string, block_num int, par_num int, line_num int")
    raw = raw.withColumn("x", F.col("seq") * 10).withColumn("y", F.lit(5)).withColumn("w", F.lit(8)).withColumn("h", F.lit(9))
    w = words.with_char_spans(words.kept_words(words.with_line_id(raw)), ["page"])
    assert [(r.text, r.start, r.end, r.conf) for r in w.orderBy("seq").collect()] == [("Hello", 0, 5, 96), ("wörld", 6, 11, 12), ("line", 12, 16, 0)]
    lines = words.line_rows(w, ["page"])
    assert words.page_text(lines, ["page"]).first().text == "Hello wörld\nline"
    page = words.nested_pages(w, lines, ["page"]).first()
    assert [x.text for x in page.words] == ["Hello", "wörld", "line"] and [tuple(x.box) for x in page.lines] == [(0, 5, 28, 9), (40, 5, 8, 9)]


def renderer(batches):
    """A page for each letter of the content, a number for its place."""
    for batch in batches:
        for path, content in zip(batch["path"].to_pylist(), batch["content"].to_pylist(), strict=True):
            rows = [{"path": path, "page_index": int(chr(c)), "image": b"x", "width": 1, "height": 1} for c in content]
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("path", pa.string()), ("page_index", pa.int32()), ("image", pa.binary()), ("width", pa.int32()), ("height", pa.int32())]))


def test_rendered_pages_are_checked(spark):
    files_of = lambda *contents: spark.createDataFrame([(f"f{i}", bytearray(c)) for i, c in enumerate(contents)], "path string, content binary")
    got = hooks.rasterize(files_of(b"012", b"0"), renderer).collect()
    assert sorted((r.path, r.page_index) for r in got) == [("f0", 0), ("f0", 1), ("f0", 2), ("f1", 0)]
    for bad, said in ((b"", "has no pages"), (b"021", "out of order"), (b"1", "out of order")):
        with pytest.raises(Exception, match=said):
            hooks.rasterize(files_of(b"01", bad), renderer).collect()


def test_drawing_gets_the_boxes_of_its_page(spark):
    images = spark.createDataFrame([("d", 0, bytearray(b"A")), ("d", 1, bytearray(b"B"))], "doc_id string, page_index int, image binary")
    boxes = spark.createDataFrame([("d", 0, 5, 1, 9, 2), ("d", 0, 1, 1, 2, 2), ("e", 0, 1, 1, 2, 2)], "doc_id string, page_index int, left int, top int, right int, bottom int")

    def fn(batches):
        for b in batches:
            said = [i + str([x["left"] for x in own or []]).encode() for i, own in zip(b["image"].to_pylist(), b["boxes"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["page_index"], pa.array(said, pa.binary())], ["doc_id", "page_index", "image"])

    assert sorted(bytes(r.image) for r in hooks.draw(images, boxes, ["doc_id", "page_index"], fn).collect()) == [b"A[1, 5]", b"B[]"]


def test_writing_gets_elements_in_order(spark):
    rows = [("d", 1, 0, 0, "body", "last", None, True), ("d", 0, 1, 0, "row", None, ["c"], False), ("d", 0, 0, 0, "h1", "first", None, False)]
    df = spark.createDataFrame(rows, "doc_id string, page_index int, block_idx int, item_idx int, style string, text string, cells array<string>, break_before boolean")

    def fn(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array([",".join(e["style"] for e in own).encode() for own in b["elements"].to_pylist()], pa.binary())], ["doc_id", "content"])

    assert bytes(hooks.write_documents(df, ["doc_id"], fn).first().content) == b"h1,row,body"


def test_pages_are_written_and_read_back(spark, tmp_path):
    df = spark.createDataFrame([("d", 0, "t\n"), ("d", 1, None)], "doc_id string, page_index int, text string")
    for fmt in ("parquet", "json"):
        files.write_pages(df, f"{tmp_path}/{fmt}", fmt)
        assert sorted(spark.read.schema(df.schema).format(fmt).load(f"{tmp_path}/{fmt}").collect()) == sorted(df.collect())


def test_hooks_fail_without_a_function(spark):
    df = spark.createDataFrame([("d", 0, "t")], "doc_id string, page_index int, text string")
    images = df.withColumn("path", F.col("doc_id")).withColumn("content", F.lit(b"")).withColumn("image", F.lit(b""))
    boxes = df.select("doc_id", "page_index", *[F.lit(1).alias(c) for c in ("left", "top", "right", "bottom")])
    for step in (hooks.recognize, hooks.named_entities, hooks.translate, hooks.rasterize, lambda d: hooks.draw(d, boxes, ["doc_id", "page_index"])):
        with pytest.raises(NotImplementedError):
            step(images)
    assert hooks.translate(df, hooks.identity()).collect() == df.collect()
