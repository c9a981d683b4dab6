import pytest
from pyspark.sql import functions as F

from corpusloom.operators.scripts import ScriptError, transform_text, transform_text_per_row


@pytest.fixture
def df(spark):
    return spark.createDataFrame(
        [(1, "hello world"), (2, "hello    123 world"), (3, None)], "id int, body string"
    )


def values(frame, name="out"):
    return [r[name] for r in frame.orderBy("id").collect()]


@pytest.mark.parametrize(
    "script, expected",
    [
        ("upper(text)", "HELLO WORLD"),
        ("truncate(text, 5)", "hello"),
        ("text", "hello world"),
        (None, "hello world"),
        ("regex_replace(text, '[o]', '0')", "hell0 w0rld"),
        (["upper(text)", "truncate(text, 3)"], "HEL"),
    ],
)
def test_golden_values(df, script, expected):
    assert values(transform_text(df, "body", script, "out"))[0] == expected


def test_null_text_gives_null(df):
    assert values(transform_text(df, "body", "upper(text)", "out"))[2] is None
    assert values(transform_text(df, "body", "upper(text)", "out", null_compat=True))[2] == ""


def test_replaces_the_column_and_keeps_the_others(df):
    done = transform_text(df, "body", "squeeze_whitespace(text)")
    assert sorted(done.columns) == ["body", "id"]
    assert values(done, "body")[1] == "hello 123 world"


def test_a_column_called_text_does_not_hide_the_bound_one(spark):
    df = spark.createDataFrame([(1, "own", "other")], "id int, text string, body string")
    done = transform_text(df, "body", "upper(text)", "out").first()
    assert (done["text"], done["out"]) == ("own", "OTHER")


@pytest.mark.parametrize("script", ["invalid syntax +++", "no_such_function(text)", "id + 1"])
def test_wrong_scripts_fail_on_the_driver(df, script):
    with pytest.raises(ScriptError, match="Script compilation error"):
        transform_text(df, "body", script, "out")


def test_the_result_must_be_a_string(df):
    with pytest.raises(ScriptError, match="Script execution error"):
        transform_text(df, "body", "length(text)", "out")


def test_script_per_row(spark):
    df = spark.createDataFrame(
        [(1, "Ab", "upper(text)"), (2, "Ab", "lower(text)"), (3, "Ab", None), (4, None, "upper(text)")],
        "id int, body string, script string",
    )
    scripts = ["upper(text)", "lower(text)"]
    assert values(transform_text_per_row(df, "body", "script", scripts, "out")) == ["AB", "ab", "Ab", None]
    listed = df.select("script")
    assert values(transform_text_per_row(df, "body", "script", listed, "out")) == ["AB", "ab", "Ab", None]


def test_scripts_given_up_front(spark):
    df = spark.createDataFrame([(1, "Ab", "upper(text)")], "id int, body string, script string")
    listed = transform_text_per_row(df, "body", "script", ["upper(text)"], "out")
    assert values(listed) == ["AB"]
    with pytest.raises(Exception, match="script not listed"):
        transform_text_per_row(df, "body", "script", ["lower(text)"], "out").collect()
    with pytest.raises(Exception, match="script not listed"):
        transform_text_per_row(df, "body", "script", [], "out").collect()


def test_many_scripts(spark):
    scripts = [f"concat(text, 'é{i}')" for i in range(1500)]
    df = spark.createDataFrame(list(enumerate(scripts)), "id int, script string").withColumn("body", F.lit("a"))
    found = values(transform_text_per_row(df, "body", "script", scripts, "out"))
    assert found == [f"aé{i}" for i in range(1500)]


def test_scripts_are_one_plain_projection(df):
    plan = transform_text(df, "body", ["upper(text)", "truncate(text, 3)"], "out")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and text.count("Project") == 1
