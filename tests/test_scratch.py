from pathlib import Path

import pytest

from veilspan import scratch


def test_tables_go_with_their_scope(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(scratch, "root", lambda spark: str(tmp_path))
    kept = scratch.written(spark.range(5), "kept")
    with scratch.scope(spark):
        inner = scratch.written(spark.range(3), "inner")
        with pytest.raises(KeyError), scratch.scope(spark):
            scratch.written(spark.range(2), "lost")
            raise KeyError
        assert inner.count() == 3 and len(list(Path(tmp_path).iterdir())) == 2
    assert kept.count() == 5 and len(list(Path(tmp_path).iterdir())) == 1
    scratch.drop(kept)
    assert not list(Path(tmp_path).iterdir())


def test_no_conf_is_set(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    scratch.written(spark.range(1), "x")
    assert spark.conf.get("spark.checkpoint.dir", None) == before
