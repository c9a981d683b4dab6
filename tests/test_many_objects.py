"""Many small objects: few tasks to scan them, few calls to ask for them."""

from __future__ import annotations

import pyarrow as pa
from pyarrow import fs

from corpusloom.sources import objects


def test_a_scan_joins_parts_of_small_objects(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(objects, "SCAN_TASKS", 1)
    for k in range(1200):
        (tmp_path / f"{k}.txt").write_text(str(k))
    found = objects.read_objects(spark, f"file://{tmp_path}", "*.txt")
    cores = spark.sparkContext.defaultParallelism
    assert found.rdd.getNumPartitions() <= max(cores, 1200 // 32 // objects.SCANNED_PARTS + 1)
    assert {int(r.content) for r in found.collect()} == set(range(1200))


def test_objects_are_asked_for_together(tmp_path):
    calls = []

    class Counting:
        def get_file_info(self, inner):
            calls.append(inner)
            return fs.LocalFileSystem().get_file_info(inner)

    system = Counting()

    def resolve(path):
        objects.split_path(path)
        return system, path.removeprefix("file://")

    for k in range(200):
        (tmp_path / f"{k}.txt").write_text("x")
    paths = [f"file://{tmp_path}/{k}.txt" for k in range(400)] + [None]
    (found,) = objects.exists_udf(resolve, 4, "fail").func(iter([pa.array(paths)]))
    assert found.to_pylist() == [True] * 200 + [False] * 200 + [None]
    assert len(calls) <= 8
    # a wrong address is null, and only that
    (found,) = objects.exists_udf(resolve, 1, "null").func(iter([pa.array(["nowhere", paths[0], paths[399]])]))
    assert found.to_pylist() == [None, True, False]
