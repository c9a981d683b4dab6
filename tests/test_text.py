import pytest
from pyspark.sql import functions as F

from corpusloom.functions import text as T

TEXTS = [
    "a\r\nb\n",
    "\n",
    "",
    "  x\xa0 y　",
    "a\n\nb",
    "tab\there\x0bthere end",
    "lone\rreturn\r",
    "a\r\r\nb",
    None,
]


def apply(spark, texts, **columns):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, text string")
    named = [c.alias(n) for n, c in columns.items()]
    return [r.asDict() for r in df.select("i", *named).orderBy("i").collect()]


def column(spark, texts, expression):
    return [r["x"] for r in apply(spark, texts, x=expression)]


def plain_lines(text):
    """Lines end at \\n or \\r\\n, a final line end opens no line."""
    if text is None:
        return None
    pieces = text.split("\n")
    ended = pieces[:-1]
    last = [pieces[-1]] if pieces[-1] else []
    return [p.removesuffix("\r") for p in ended] + last


def test_golden_values(spark):
    assert column(spark, ["hello    world"], T.squeeze_whitespace("text")) == ["hello world"]
    assert column(spark, ["hello 123 world"], T.regex_replace("text", "[0-9]+", "NUM")) == [
        "hello NUM world"
    ]
    assert column(spark, ["hello world"], T.truncate("text", 5)) == ["hello"]
    assert column(spark, ["hello world"], T.uppercase("text")) == ["HELLO WORLD"]


def test_lines_and_their_parts(spark):
    rows = apply(
        spark, TEXTS, lines=T.lines("text"), first=T.take_lines("text", 1),
        rest=T.skip_lines("text", 1), none=T.take_lines("text", -3), all=T.skip_lines("text", -3),
        many=T.take_lines("text", 9), past=T.skip_lines("text", 9),
    )
    for text, row in zip(TEXTS, rows):
        lines = plain_lines(text)
        assert row["lines"] == lines
        if text is None:
            assert row["first"] is None and row["rest"] is None
            continue
        assert row["first"] == "\n".join(lines[:1])
        assert row["rest"] == "\n".join(lines[1:])
        assert row["none"] == "" and row["past"] == ""
        assert row["all"] == row["many"] == "\n".join(lines)


def test_white_space(spark):
    rows = apply(
        spark, TEXTS, trimmed=T.trim_text("text"), words=T.word_count("text"),
        squeezed=T.squeeze_whitespace("text"), line=T.strip_newlines("text"),
    )
    for text, row in zip(TEXTS, rows):
        if text is None:
            assert set(row.values()) == {None, row["i"]}
            continue
        assert row["trimmed"] == text.strip(T.WHITE_SPACE)
        assert row["words"] == len(text.split())
        assert row["line"] == text.replace("\n", " ").replace("\r", "")
    # separators that Python, but not Unicode, takes for white space
    assert column(spark, ["a\x1cb"], T.word_count("text")) == [1]
    assert column(spark, ["a \t\n b "], T.squeeze_whitespace("text")) == ["a b "]


def test_truncate(spark):
    texts = ["héllo", "日本語テキスト", ""]
    assert column(spark, texts, T.truncate("text", 3)) == ["hél", "日本語", ""]
    assert column(spark, texts, T.truncate("text", 0)) == ["", "", ""]
    assert column(spark, texts, T.truncate("text", -1)) == texts
    assert column(spark, texts, T.truncate("text", 100)) == texts


def test_case_mapping(spark):
    assert column(spark, ["straße", "ΑΣ"], T.uppercase("text")) == ["STRASSE", "ΑΣ"]
    assert column(spark, ["STRASSE", "ΑΣ"], T.lowercase("text")) == ["strasse", "ας"]


@pytest.mark.parametrize(
    "mode, expected",
    [
        ("strip_newlines", " A b "), ("OneLine", " A b "), ("stripnewlines", " A b "),
        ("trim", "A\nb"), ("lower", " a\nb "), ("LOWERCASE", " a\nb "), ("Upper", " A\nB "),
        ("uppercase", " A\nB "), ("none", " A\nb "), ("raw", " A\nb "), ("else", " A b "),
        (None, " A b "),
    ],
)
def test_modes(spark, mode, expected):
    assert column(spark, [" A\nb "], T.text_mode("text", mode)) == [expected]
    as_column = F.lit(mode).cast("string")
    assert column(spark, [" A\nb "], T.text_mode("text", as_column)) == [expected]


@pytest.mark.parametrize(
    "pattern, replacement, text, expected",
    [
        (r"(\d+)-(\d+)", "$2-$1", "10-20", "20-10"),
        (r"(\d)(\d)", "${2}0$1", "12", "201"),
        (r"(?P<y>\d+)", "<$y>", "in 1999", "in <1999>"),
        (r"(?<y>\d+)", "<${y}>", "in 1999", "in <1999>"),
        ("a", "$5|$none|", "bab", "b||b"),
        ("a", "$$1", "bab", "b$1b"),
        ("a", r"\n", "bab", r"b\nb"),
        ("(a)", "$1x", "bab", "bb"),
        ("b$", "X", "ab\nb\n", "ab\nb\n"),
        ("b$", "X", "ab\nb", "ab\nX"),
        ("(?m)b$", "X", "ab\nb", "aX\nX"),
        ("[$]", "USD", "5$", "5USD"),
        (r"\$", "USD", "5$", "5USD"),
        (".", "x", "a\rb\n", "xxx\n"),
        (r"\w+", "W", "naïve", "W"),
        (r"\d", "D", "٣", "D"),
    ],
)
def test_regex_dialect(spark, pattern, replacement, text, expected):
    assert column(spark, [text], T.regex_replace("text", pattern, replacement)) == [expected]


def test_regex_match_is_a_search(spark):
    assert column(spark, ["say hello", "no", None], T.regex_match("text", "l+o")) == [
        True, False, None,
    ]


def test_sql_names_agree_with_columns(spark):
    T.register_sql(spark)
    pairs = {
        "strip_newlines(text)": T.strip_newlines("text"),
        "trim_text(text)": T.trim_text("text"),
        "text_mode(text, 'UPPER')": T.uppercase("text"),
        "text_mode(text, 'x')": T.strip_newlines("text"),
        "text_mode(text, NULL)": T.strip_newlines("text"),
        "lines(text)": T.lines("text"),
        "take_lines(text, 1)": T.take_lines("text", 1),
        "skip_lines(text, 1)": T.skip_lines("text", 1),
        "truncate(text, 2)": T.truncate("text", 2),
        "truncate(text, -2)": T.truncate("text", -2),
        "squeeze_whitespace(text)": T.squeeze_whitespace("text"),
        "word_count(text)": T.word_count("text"),
        "regex_match(text, 'b$')": T.regex_match("text", "b$"),
        r"regex_replace(text, r'(\w)$', '<$1>')": T.regex_replace("text", r"(\w)$", "<$1>"),
        "regex_replace(text, 'a', '$$')": T.regex_replace("text", "a", "$$"),
    }
    for sql, expression in pairs.items():
        assert column(spark, TEXTS, F.expr(sql)) == column(spark, TEXTS, expression), sql


def test_filled_nulls(spark):
    filled = T.fill_nulls(T.trim_text("text"), "", True)
    assert column(spark, [None, " a"], filled) == ["", "a"]


def test_text_functions_stay_in_the_jvm(spark):
    df = spark.range(1).select(F.lit("a b").alias("text"))
    plan = df.select(
        T.trim_text("text"), T.squeeze_whitespace("text"), T.take_lines("text", 1),
        T.text_mode("text", F.col("text")), T.regex_replace("text", "a", "b"), T.word_count("text"),
    )._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_posix_classes_and_absent_groups(spark):
    cases = [
        ("[[:digit:]]+", "<$0>", "abc DEF <12>: al"), ("[[:upper:]]{3}", "X", "abc X 12: al"), ("[[:^alpha:]]", "_", "abc_DEF_____al"),
        ("(?P<x>[a-z]+)", "[$x|${x}]", "[abc|abc] DEF 12: [al|al]"), ("[a-c]+", "<$1$name>", "<> DEF 12: <>l"), ("(a)", "${1}0", "a0bc DEF 12: a0l"),
    ]
    T.register_sql(spark)
    for pattern, replacement, wanted in cases:
        df = spark.createDataFrame([("abc DEF 12: al", pattern, replacement)], "text string, p string, r string")
        assert df.select(T.regex_replace("text", pattern, replacement)).first()[0] == wanted
        assert df.selectExpr("regex_replace(text, p, r)").first()[0] == wanted
    with pytest.raises(ValueError, match="unknown class"):
        T.java_pattern("[[:nope:]]")
    with pytest.raises(Exception, match="unknown class"):
        spark.sql("SELECT regex_match('a', '[[:nope:]]')").collect()


def test_no_number_of_lines(spark):
    T.register_sql(spark)
    row = spark.createDataFrame([("a\nb", None)], "text string, n int").select(T.take_lines("text", F.col("n")), F.expr("take_lines(text, n)"), T.skip_lines("text", F.col("n")))
    assert tuple(row.first()) == (None, None, None)
