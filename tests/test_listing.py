import os
import uuid

import pytest
from pyspark.sql import functions as F

from corpusloom.sources.listing import objects_exist_by_listing
from corpusloom.sources.objects import DefaultResolver, objects_exist


class Counted(DefaultResolver):
    """Leaves a file for each call."""

    def __init__(self, folder):
        super().__init__()
        self._folder = str(folder)

    def __call__(self, path):
        with open(f"{self._folder}/{uuid.uuid4().hex}", "w") as file:
            file.write(path)
        return super().__call__(path)

    def __getstate__(self):
        return {"_known": {}, "_folder": self._folder}

    def calls(self):
        return [open(f"{self._folder}/{name}").read() for name in os.listdir(self._folder)]


@pytest.fixture
def asked(spark, tmp_path):
    root = f"file://{tmp_path}/objects"
    for folder in ("a", "b/c", "lone"):
        (tmp_path / "objects" / folder).mkdir(parents=True)
    for name in ("a/1", "a/2", "a/3", "b/c/1", "b/c/é x", "lone/1"):
        (tmp_path / "objects" / name).write_text("x")
    names = ["a/1", "a/2", "a/9", "a/", "b/c/1", "b/c/é x", "b/c", "lone/1", "gone/1", "gone/2", None]
    rows = [(k, None if n is None else f"{root}/{n}") for k, n in enumerate(names)]
    return spark.createDataFrame(rows + [(100 + k, f"{root}/a/1") for k in range(50)], "id int, path string")


def answers(frame):
    return {r.id: r.found for r in frame.collect()}


def test_answers_are_those_of_the_probes(asked, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    counted = Counted(calls)
    found = answers(objects_exist_by_listing(asked, "path", resolver=counted))
    assert found == answers(objects_exist(asked, "path")) and len(found) == 61
    assert found[0] and found[5] and found[7] and found[149] and found[10] is None
    assert not any(found[k] for k in (2, 3, 6, 8, 9))
    # a, b/c and gone are listed; lone/1 and b/c, each the only name of its folder, are probed
    made = counted.calls()
    assert len(made) == 5 and sum(path.endswith("/") for path in made) == 3


def test_nulls_and_wrong_addresses(spark, asked):
    assert answers(objects_exist_by_listing(asked, "path", null_compat=True))[10] is False
    for wrong in (["nowhere"], ["zip://a/b", "zip://a/c"]):
        df = spark.createDataFrame([(k, p) for k, p in enumerate(wrong)], "id int, path string")
        with pytest.raises(Exception, match="must start with"):
            objects_exist_by_listing(df, "path").collect()
        assert set(answers(objects_exist_by_listing(df, "path", on_error="null")).values()) == {None}
    assert objects_exist_by_listing(asked.where(F.lit(False)), "path").collect() == []
    with pytest.raises(ValueError, match="least"):
        objects_exist_by_listing(asked, "path", least=0)
