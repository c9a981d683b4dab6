"""Script transforms: a script is a Spark SQL expression over ``text``.

Scripts may use every built-in Spark function and the text functions of
:mod:`corpusloom.functions.text`. They are analysed on the driver and compiled into the
surrounding projection, so a wrong script fails before any task starts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from corpusloom.functions.text import fill_nulls, register_sql

IDENTITY = "text"

# Fixed value: how the message of a script that does not compile begins.
COMPILATION_ERROR = "Script compilation error: "


class ScriptError(ValueError):
    """A script does not compile or does not give a string."""


def _compile(script: str) -> Column:
    try:
        return F.expr(script)
    except ParseException as error:
        raise ScriptError(f"{COMPILATION_ERROR}{error}") from error


def _hidden(df: DataFrame, name: str) -> str:
    return f"__c{df.columns.index(name)}"


def _apply(df: DataFrame, text_col: str, build, out: str) -> DataFrame:
    """Evaluate ``build()`` where ``text`` is ``text_col`` and the columns go by hidden names.

    Plain projections, which the optimizer merges.
    """
    register_sql(df.sparkSession)
    bound = df.select(
        *[F.col(f"`{c}`").alias(_hidden(df, c)) for c in df.columns],
        F.col(f"`{text_col}`").alias("text"),
    )
    kept = [F.col(_hidden(df, c)).alias(c) for c in df.columns if c != out]
    try:
        evaluated = bound.select("*", build().alias("__out"))
        data_type = evaluated.schema["__out"].dataType
    except (ParseException, AnalysisException) as error:
        raise ScriptError(f"{COMPILATION_ERROR}{error}") from error
    if not isinstance(data_type, StringType):
        raise ScriptError(
            f"Script execution error: the result is {data_type.simpleString()}, not a string"
        )
    return evaluated.select(*kept, F.col("__out").alias(out))


def transform_text(
    df: DataFrame,
    text_col: str,
    script: str | Sequence[str] | None,
    out: str | None = None,
    null_compat: bool = False,
) -> DataFrame:
    """Add ``out`` = the script applied to ``text_col``; a list of scripts runs left to right.

    ``None`` leaves the text as it is. ``out`` defaults to replacing ``text_col``.
    """
    out = out or text_col
    steps = [IDENTITY] if script is None else [script] if isinstance(script, str) else list(script)
    source = text_col
    for step in steps:
        df = _apply(df, source, lambda step=step: _compile(step), out)
        source = out
    return df.withColumn(out, fill_nulls(F.col(f"`{out}`"), "", null_compat))


def transform_text_per_row(
    df: DataFrame,
    text_col: str,
    script_col: str,
    scripts: Sequence[str] | DataFrame,
    out: str | None = None,
    null_compat: bool = False,
) -> DataFrame:
    """Apply to each row the script that ``script_col`` holds (NULL: the text as it is).

    Scripts are code, so they are declared: ``scripts`` lists them, or is a table with one column
    of them. A row whose script is not among them raises. They become the leaves of a tree of
    comparisons, so a row meets about as many as the logarithm of their number.
    """
    out = out or text_col
    if isinstance(scripts, DataFrame):
        scripts = [row[0] for row in scripts.distinct().collect()]
    # Spark compares strings by their bytes
    declared = sorted({s for s in scripts if s is not None}, key=str.encode)
    chosen = F.col(_hidden(df, script_col))
    unknown = F.raise_error(F.concat(F.lit("script not listed: "), chosen)).cast("string")

    def tree(low: int, high: int) -> Column:
        if high == low:
            return unknown
        if high - low == 1:
            return F.when(chosen == F.lit(declared[low]), _compile(declared[low])).otherwise(unknown)
        middle = (low + high) // 2
        return F.when(chosen < F.lit(declared[middle]), tree(low, middle)).otherwise(tree(middle, high))

    def build() -> Column:
        return F.when(chosen.isNull(), F.col("text")).otherwise(tree(0, len(declared)))

    done = _apply(df, text_col, build, out)
    return done.withColumn(out, fill_nulls(F.col(f"`{out}`"), "", null_compat))


__all__ = ["ScriptError", "transform_text", "transform_text_per_row"]
