import pytest
from pyspark.sql import functions as F

from corpusloom.sources.objects import (
    ObjectError,
    fetch_objects,
    fetch_stripped,
    fetch_with_mode,
    fetch_with_script,
    object_exists,
    objects_exist,
    parse_path,
    put_text,
    read_objects,
    split_path,
    write_objects,
)


@pytest.fixture
def root(tmp_path):
    return f"file://{tmp_path}/objects"


@pytest.fixture
def stored(spark, root):
    rows = [(1, f"{root}/a/1.txt", "one\r\nTwo"), (2, f"{root}/b/2.txt", " zwei é "), (3, None, "x"), (4, f"{root}/4", None)]
    df = spark.createDataFrame(rows, "id int, path string, text string")
    written = [r.written for r in write_objects(df, "path", "text").orderBy("id").collect()]
    assert written == [rows[0][1], rows[1][1], None, None]
    return df


def by_id(frame, column):
    return [r[column] for r in frame.orderBy("id").collect()]


def test_round_trip(stored):
    known = stored.where("id < 4")
    assert by_id(fetch_objects(known, "path"), "content") == ["one\r\nTwo", " zwei é ", None]
    assert by_id(fetch_objects(known, "path", null_compat=True), "content")[2] == ""


def test_a_null_content_writes_nothing(stored):
    assert by_id(objects_exist(stored, "path"), "found") == [True, True, None, False]
    assert by_id(objects_exist(stored, "path", null_compat=True), "found")[2] is False


def test_overwrite(spark, root, stored):
    df = spark.createDataFrame([(1, f"{root}/a/1.txt")], "id int, path string")
    df.select(put_text("path", F.lit("new"))).collect()
    assert by_id(fetch_objects(df, "path"), "content") == ["new"]


def test_transforms(stored):
    known = stored.where("id < 3")
    assert by_id(fetch_stripped(known, "path"), "content") == ["one Two", " zwei é "]
    assert by_id(fetch_with_mode(known, "path", "upper"), "content") == ["ONE\r\nTWO", " ZWEI É "]
    modes = F.when(F.col("id") == 1, "oneline").otherwise("trim")
    assert by_id(fetch_with_mode(known, "path", modes), "content") == ["one Two", "zwei é"]
    assert by_id(fetch_with_script(known, "path", "take_lines(text, 1)"), "content") == ["one", " zwei é "]
    scripted = known.withColumn("script", F.when(F.col("id") == 1, "lower(text)"))
    assert by_id(fetch_with_script(scripted, "path", script_col="script", scripts=["lower(text)"]), "content") == [
        "one\r\ntwo", " zwei é ",
    ]


def test_repeated_addresses_are_read_once(spark, stored, root):
    class Counting:
        def __init__(self):
            self.inner = None

        def __call__(self, path):
            from corpusloom.sources.objects import DefaultResolver

            if self.inner is not None:
                raise AssertionError("asked twice")
            self.inner = DefaultResolver()
            return self.inner(path)

    df = spark.range(0, 500, numPartitions=1).select("id", F.lit(f"{root}/a/1.txt").alias("path"))
    texts = {r.content for r in fetch_objects(df, "path", resolver=Counting()).collect()}
    assert texts == {"one\r\nTwo"}


def test_scan_form(spark, stored, root):
    found = {r.path.rsplit("/", 1)[1]: r.content for r in read_objects(spark, root).collect()}
    assert found == {"1.txt": "one\r\nTwo", "2.txt": " zwei é "}
    assert read_objects(spark, root, "2*").count() == 1


@pytest.mark.parametrize(
    "path, message",
    [
        ("invalid_path", "must start with s3://"), ("s3://bucket-only", "Invalid S3 path format"),
        ("file:///no/such/object", "Failed to fetch S3 object"),
    ],
)
def test_errors(spark, path, message):
    df = spark.createDataFrame([(1, path)], "id int, path string")
    with pytest.raises(Exception, match=message):
        fetch_objects(df, "path").collect()
    assert by_id(fetch_objects(df, "path", on_error="null"), "content") == [None]
    with pytest.raises(Exception, match=message):
        fetch_stripped(df, "path").collect()
    if message != "Failed to fetch S3 object":
        with pytest.raises(Exception, match=message):
            df.select(put_text("path", F.lit("x"))).collect()
        with pytest.raises(Exception, match=message):
            df.select(object_exists("path")).collect()
    with pytest.raises(ValueError, match="on_error"):
        fetch_objects(df, "path", on_error="row")


def test_put_failure(spark):
    df = spark.createDataFrame([("file:///proc/no/such/place",)], "path string")
    with pytest.raises(Exception, match="Failed to put S3 object"):
        df.select(put_text("path", F.lit("x"))).collect()


def test_text_that_is_not_utf8(spark, tmp_path):
    (tmp_path / "latin.txt").write_bytes("é".encode("latin-1"))
    df = spark.createDataFrame([(f"file://{tmp_path}/latin.txt",)], "path string")
    with pytest.raises(Exception, match="not valid UTF-8"):
        fetch_objects(df, "path").collect()
    with pytest.raises(Exception):
        read_objects(spark, f"file://{tmp_path}", "*.txt").collect()


def test_paths(spark):
    assert split_path("s3://bucket/a/b c") == ("s3", "bucket", "a/b c")
    with pytest.raises(ObjectError):
        split_path("ftp://bucket/key")
    df = spark.createDataFrame([("s3a://b/k/x",), ("nope",)], "path string")
    rows = [tuple(r[0]) for r in df.select(parse_path("path")).collect()]
    assert rows == [("s3a", "b", "k/x"), ("", "", "")]


def test_contents_are_not_shuffled(stored):
    plan = fetch_with_mode(stored, "path", "trim")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_large_objects_are_read_one_by_one(spark, tmp_path):
    from corpusloom.functions.retry import InFlight

    rows = []
    for k in range(40):
        (tmp_path / f"{k}").write_text(f"{k}" * (1000 if k % 3 else 60_000))
        rows += [(k, f"file://{tmp_path}/{k}")] * (1 + k % 2)
    df = spark.createDataFrame(rows, "k int, path string").coalesce(1)
    found = fetch_objects(df, "path", max_bytes=50_000, max_in_flight=8).collect()
    assert [r.content for r in found] == [f"{k}" * (1000 if k % 3 else 60_000) for k, _ in rows]

    running, most = [0], [0]

    def call(size, claim):
        claim(size)
        running[0] += size
        most[0] = max(most[0], running[0])
        return size

    with InFlight(8, 100) as flight:
        for size in flight.map(call, [60] * 30, claims=True):
            running[0] -= size
    assert most[0] <= 180


def test_strict_paths(spark):
    from corpusloom.sources.objects import parse_path

    df = spark.createDataFrame([("s3://b/k/x",), (None,)], "path string")
    first, none = df.select(parse_path("path", strict=True).alias("p")).collect()
    assert tuple(first.p) == ("s3", "b", "k/x") and none.p.key is None
    for bad, said in (("http://b/k", "must start with s3://"), ("s3://bucket", "Invalid S3 path format")):
        with pytest.raises(Exception, match=said):
            spark.createDataFrame([(bad,)], "path string").select(parse_path("path", strict=True)).collect()
