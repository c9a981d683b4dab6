"""The tasks of a scan list the objects; the rows are those of Spark's own scan."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from corpusloom.sources import objects

NAMES = (
    "a.txt", "b.md", "sp ace.txt", "per%20cent.txt", "é.txt", "br[1].txt", "q?.txt", "back\\s.txt", "new\nline.txt", "plus+.txt",
    ".hidden.txt", "_left.txt", "_key=1.txt", "_metadata.txt", "copied.txt._COPYING_", "empty.txt",
    "d/1.txt", "d/e/2.txt", "d/e/f/3.md", "k=1/4.txt", "_d/5.txt", ".d/6.txt", "_k=2/7.txt", "_metadata/8.txt", "d._COPYING_/9.txt", "dir.txt/x.bin",
)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    top = tmp_path_factory.mktemp("scan")
    for name in NAMES:
        (top / name).parent.mkdir(parents=True, exist_ok=True)
        (top / name).write_text("" if name == "empty.txt" else f"text of {name}")
    (top / "link").symlink_to(top / "d")
    (top / "broken.txt").symlink_to(top / "nowhere")
    return top


def rows(frame):
    return sorted(tuple(row) for row in frame.collect())


def by_spark(spark, folder, pattern=None):
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    found = (reader.option("pathGlobFilter", pattern) if pattern else reader).load(folder)
    return found.select("path", F.decode("content", "UTF-8").alias("content"))


def test_the_driver_does_not_list_the_objects(spark, tmp_path):
    for k in range(300):
        (tmp_path / str(k % 5)).mkdir(exist_ok=True)
        (tmp_path / str(k % 5) / f"{k}.txt").write_text(str(k))
    found = objects.read_objects(spark, f"file://{tmp_path}", "*.txt")
    # the files that the plan knows are those of the listing
    assert len(found.inputFiles()) < 50
    assert {int(row.content) for row in found.collect()} == set(range(300))


@pytest.mark.parametrize("pattern", [None, "*.txt", "[ab]*", "[!a]*.txt", "{a,é,1}.txt", "?.txt", "q\\?.txt", "a.tx", "*1*"])
def test_names_and_patterns_are_those_of_spark(spark, folder, pattern):
    assert rows(objects.read_objects(spark, f"file://{folder}", pattern)) == rows(by_spark(spark, f"file://{folder}", pattern))


@pytest.mark.parametrize("below", ["d//", "a.txt", ".hidden.txt", "empty.txt", ".d", "d*/*", "{d,d/e}", "*.txt", "*", "d/e/f"])
@pytest.mark.parametrize("scheme", ["file://", ""])
def test_folders_are_those_of_spark(spark, folder, below, scheme):
    found, wanted = (read(spark, f"{scheme}{folder}/{below}") for read in (objects.read_objects, by_spark))
    assert rows(found) == rows(wanted)
    assert found.schema == wanted.schema


def test_nothing_to_read(spark, folder, tmp_path):
    (tmp_path / "in").mkdir()
    assert rows(objects.read_objects(spark, f"file://{tmp_path}")) == []
    for below in ("nowhere", "no*where"):
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            objects.read_objects(spark, f"file://{folder}/{below}")


def test_objects_that_come_later_are_not_read(spark, tmp_path):
    (tmp_path / "1.txt").write_text("one")
    found = objects.read_objects(spark, f"file://{tmp_path}")
    (tmp_path / "2.txt").write_text("two")
    assert [row.content for row in found.collect()] == ["one"]


def test_spark_lists_what_the_storage_client_does_not_reach(spark, folder, monkeypatch):
    class Nowhere(objects.DefaultResolver):
        def __call__(self, path):
            raise objects.ObjectError(path)

    monkeypatch.setattr(objects, "DefaultResolver", Nowhere)
    assert rows(objects.read_objects(spark, f"file://{folder}", "*.txt")) == rows(by_spark(spark, f"file://{folder}", "*.txt"))
