"""Saved pages as a data source: ranges, commits, streams."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from tidepoint.sources.pages import SCHEMA, read_pages, save_pages, stream_pages, use_pages


def _saved(spark, path, rows, parts=1):
    save_pages(spark.createDataFrame(rows, SCHEMA).coalesce(parts), path)


def _texts(frame):
    return sorted(r.response for r in frame.select("response").collect())


def test_only_pages_in_the_range_are_opened(spark, tmp_path):
    path = str(tmp_path / "pages")
    _saved(spark, path, [("old", 0, 9), ("older", -5, -1)])
    (gone,) = glob.glob(f"{path}/data/*.pages")
    os.truncate(gone, 0)
    os.truncate(gone.replace(".pages", ".index"), 0)  # a file outside is not even looked up
    _saved(spark, path, [("aé", 100, 199), ("bad", 300, 399), ("c", 150, 350), ("d", None, None)])
    (held,) = set(glob.glob(f"{path}/data/*.pages")) - {gone}
    data = bytearray(open(held, "rb").read())
    data[3:6] = b"\xff" * 3  # the page "bad" is not text any more
    open(held, "wb").write(data)
    assert _texts(read_pages(spark, path, 100, 300)) == ["aé", "c"]
    assert _texts(read_pages(spark, path, 199, 200)) == ["aé", "c"]
    assert _texts(read_pages(spark, path, 200, 300)) == ["c"]
    assert _texts(read_pages(spark, path, 400, 500)) == []


def test_filters_on_one_frame_do_not_meet(spark, tmp_path):
    path = "file:" + str(tmp_path / "pages")
    rows = [(f"p{i}", i * 10, i * 10 + 9) for i in range(50)] + [(None, 7, 8), ("x", None, 3)]
    _saved(spark, path, rows, parts=4)
    pages = read_pages(spark, path)
    assert sorted(map(tuple, pages.collect()), key=str) == sorted(rows, key=str)
    assert _texts(pages.where("first_ns = 70 and response <> 'q'")) == ["p7"]
    assert _texts(pages.where("first_ns > 480 or last_ns = 9")) == ["p0", "p49"]
    assert _texts(pages.where("first_ns is null")) == ["x"]
    assert _texts(pages.where("first_ns = 10").union(pages.where("first_ns = 20"))) == ["p1", "p2"]
    assert _texts(read_pages(spark, path, 480).where("last_ns < 490")) == ["p48"]
    assert pages.where("first_ns in (10, 20) and last_ns <= 19").count() == 1


def test_writes_that_die_and_empty_tables(spark, tmp_path):
    path = str(tmp_path / "pages")
    assert read_pages(spark, path).isEmpty()
    _saved(spark, path, [])
    broken = spark.range(100).select(
        F.when(F.col("id") == 99, F.raise_error(F.lit("stop")))
        .otherwise("page")
        .cast("string")
        .alias("response"),
        F.col("id").alias("first_ns"),
        F.col("id").alias("last_ns"),
    )
    with pytest.raises(Exception, match="stop"):
        save_pages(broken, path)
    assert read_pages(spark, path).isEmpty()
    with pytest.raises(Exception, match="only appended"):
        pages = use_pages(spark).createDataFrame([("a", 1, 1)], SCHEMA)
        pages.write.format("saved_pages").mode("overwrite").save(path)


def test_a_stream_takes_each_commit_once(spark, tmp_path):
    path, out, marks = (str(tmp_path / n) for n in ("pages", "out", "marks"))

    def advance():
        run = (
            stream_pages(spark, path)
            .writeStream.format("parquet")
            .option("checkpointLocation", marks)
            .trigger(availableNow=True)
            .start(out)
        )
        run.awaitTermination()
        return _texts(spark.read.schema(SCHEMA).parquet(out))

    _saved(spark, path, [("a", 1, 2), ("b", 5, 6)])
    _saved(spark, path, [("c", 0, 1)])
    assert advance() == ["a", "b", "c"]
    assert advance() == ["a", "b", "c"]
    _saved(spark, path, [("a", 1, 2)], parts=2)
    assert advance() == ["a", "a", "b", "c"]
