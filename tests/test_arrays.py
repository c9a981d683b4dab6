"""JSON arrays in files, read in splits of a few bytes, against the json library."""

import json
import random

import pytest

from corpusloom.sources.arrays import payload_text, payloads_from_file


@pytest.fixture(params=["7b", "64b", "1m"])
def splits(spark, request):
    names = {"spark.sql.files.maxPartitionBytes": request.param, "spark.sql.files.openCostInBytes": "1b", "spark.sql.files.minPartitionNum": "1"}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield request.param
    for name in names:
        spark.conf.unset(name)


def read(spark, path):
    rows = payloads_from_file(spark, str(path)).collect()
    assert sorted(r.position for r in rows) == list(range(len(rows)))
    return [r.payload for r in sorted(rows)]


ODD = ['a,b', 'q"x', "back\\", '\\"', "[", "]}", "", "é, \U0001f600", {"a,": [1, {"b": "],"}]}, [], [[]], {}, None, 1.5, -3, True, "x" * 90, [1, 2, 3], ",,,", "\n"]


def test_any_split_finds_the_elements(spark, splits, tmp_path):
    rng = random.Random(3)
    for k, indent in enumerate((None, 1)):
        values = ODD + rng.choices(ODD, k=30)
        (tmp_path / f"{k}.json").write_text(json.dumps(values, indent=indent, ensure_ascii=bool(k)))
        assert read(spark, tmp_path / f"{k}.json") == [payload_text(v) for v in values]
    for text, wanted in (("[]", []), (" [ ] \n", []), ("[[]]", ["[]"]), ('["a"]', ["a"]), ("[1]", ["1"]), ('[""]', [""])):
        (tmp_path / "small.json").write_text(text)
        assert read(spark, tmp_path / "small.json") == wanted


WRONG = ["", "  ", "{}", '"a"', "[1", "[1,", "[1,]", "[1],", "[,1]", "[1,,2]", "[1]]", "[1}", "[1],[2]", "[1] [2]", "x[1]", "[1]x", '["a]', '["a\\,b"]', "[{]", "[{},{]}]", "not valid json"]


def test_wrong_arrays(spark, splits, tmp_path):
    for text in WRONG:
        (tmp_path / "wrong.json").write_text(text)
        with pytest.raises(Exception, match="Invalid payloads JSON"):
            payloads_from_file(spark, str(tmp_path / "wrong.json")).collect()


def test_a_folder_of_files(spark, tmp_path):
    (tmp_path / "d").mkdir()
    for k in range(3):
        (tmp_path / f"d/{k}.json").write_text(json.dumps([f"{k}-{i}" for i in range(4)]))
    rows = payloads_from_file(spark, str(tmp_path / "d")).collect()
    assert sorted((r.payload, r.position) for r in rows) == [(f"{k}-{i}", i) for k in range(3) for i in range(4)]
