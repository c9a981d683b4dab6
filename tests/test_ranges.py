import pytest

from corpusloom.sources.objects import ObjectError, write_objects
from corpusloom.sources.ranges import read_lines

TEXTS = [
    "one\r\ntwo\n\nvier é\n", "", "\n", "\n\n", "no end", "end\r", "\r\n", "é" * 50 + "\n" + "ü\n" * 30, "x" * 300, "\n" * 40,
    "a\r\r\nb", "last\n" + "y" * 64,
]


def lines_of(text):
    """Written as the definition says, one text at a time."""
    lines = text.split("\n")
    if lines[-1] == "":
        lines.pop()
        return [line.removesuffix("\r") for line in lines]
    return [line.removesuffix("\r") for line in lines[:-1]] + lines[-1:]


@pytest.fixture
def stored(spark, tmp_path):
    rows = [(k, f"file://{tmp_path}/objects/{k}", text) for k, text in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "id int, path string, text string")
    write_objects(df, "path", "text").collect()
    return df.drop("text")


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64, 1 << 20])
def test_lines_do_not_depend_on_ranges(stored, size):
    found = read_lines(stored, "path", range_bytes=size).orderBy("id", "line_no").collect()
    wanted = [(k, n, line) for k, text in enumerate(TEXTS) for n, line in enumerate(lines_of(text))]
    assert [(r.id, r.line_no, r.line) for r in found] == wanted


def test_rows_that_name_no_object(spark, stored, tmp_path):
    more = spark.createDataFrame([(99, None), (98, f"file://{tmp_path}/gone"), (97, f"file://{tmp_path}/objects/4")], "id int, path string")
    with pytest.raises(Exception, match="Failed to fetch"):
        read_lines(more, "path").collect()
    assert [(r.id, r.line) for r in read_lines(more, "path", on_error="null").collect()] == [(97, "no end")]
    assert read_lines(stored.limit(0), "path").collect() == []


def test_repeated_rows_and_clashing_names(spark, stored):
    twice = stored.where("id = 7").withColumnRenamed("id", "no").selectExpr("path", "no", "'old' AS line", "1 AS size", "2 AS begin", "3 AS row")
    found = read_lines(twice.union(twice), "path", range_bytes=9)
    assert found.columns == ["path", "no", "size", "begin", "row", "line_no", "line"]
    assert found.where("line_no = 0 AND line <> 'old'").count() == 2 and found.count() == 62


def test_a_character_that_is_no_text(spark, tmp_path):
    (tmp_path / "broken").write_bytes(b"good\r\n\xff\n" + b"more\n" * 10)
    df = spark.createDataFrame([(f"file://{tmp_path}/broken",)], "path string")
    with pytest.raises(Exception, match="not valid UTF-8"):
        read_lines(df, "path", range_bytes=5).collect()
    rest = read_lines(df, "path", range_bytes=5, on_error="null").orderBy("line_no").collect()
    assert [r.line for r in rest] == ["good", None] + ["more"] * 10


def test_wrong_arguments(stored):
    with pytest.raises(ValueError, match="range_bytes"):
        read_lines(stored, "path", range_bytes=0)
    with pytest.raises(ValueError, match="names the lines"):
        read_lines(stored.withColumnRenamed("path", "line"), "line")
    assert issubclass(ObjectError, ValueError)
