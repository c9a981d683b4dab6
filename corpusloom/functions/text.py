"""Text cleaning as column expressions.

Every function takes and returns a ``Column``, stays inside the JVM and is NULL in, NULL out.
The same functions are offered to SQL text (and so to scripts) by :func:`register_sql`.
"""

from __future__ import annotations

import re
import weakref
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession, functions as F

# The Unicode White_Space characters, which decide trimming and word borders.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Accepted mode names, lower case.
MODE_NAMES = {
    "strip_newlines": ("strip_newlines", "stripnewlines", "oneline"),
    "trim": ("trim",),
    "lowercase": ("lowercase", "lower"),
    "uppercase": ("uppercase", "upper"),
    "none": ("none", "raw"),
}


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _runs_of_texts(texts: pa.Array, limit: int) -> Iterator[pa.Array]:
    """The array in runs of at most ``limit`` bytes, one text at least; an empty array as it is."""
    start = held = 0
    for at, size in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if at > start and held + size > limit:
            yield texts.slice(start, at - start)
            start, held = at, 0
        held += size
    yield texts.slice(start)


def fill_nulls(result: Column, fill: Column | str | int | bool, null_compat: bool) -> Column:
    """Replace NULL results by ``fill`` when a caller asks for filled instead of NULL rows."""
    if not null_compat:
        return result
    return F.coalesce(result, fill if isinstance(fill, Column) else F.lit(fill))


def strip_newlines(text: Column | str) -> Column:
    """Line feeds become spaces, carriage returns go."""
    return F.translate(as_column(text), "\n\r", " ")


def trim_text(text: Column | str) -> Column:
    """Strip Unicode white space from both ends (SQL ``trim`` strips the plain space only)."""
    return F.btrim(as_column(text), F.lit(WHITE_SPACE))


def lowercase(text: Column | str) -> Column:
    """Full Unicode lower case."""
    return F.lower(as_column(text))


def uppercase(text: Column | str) -> Column:
    """Full Unicode upper case."""
    return F.upper(as_column(text))


def identity(text: Column | str) -> Column:
    """The text as it is."""
    return as_column(text)


_MODE_FUNCTIONS = {
    "strip_newlines": strip_newlines,
    "trim": trim_text,
    "lowercase": lowercase,
    "uppercase": uppercase,
    "none": identity,
}


def text_mode(text: Column | str, mode: Column | str | None) -> Column:
    """Apply a named mode. A ``str`` mode is one name for all rows, a ``Column`` names one per row.

    Names ignore case; an unknown or NULL name means ``strip_newlines``.
    """
    column = as_column(text)
    if not isinstance(mode, Column):
        wanted = (mode or "").lower()
        for name, aliases in MODE_NAMES.items():
            if wanted in aliases:
                return _MODE_FUNCTIONS[name](column)
        return strip_newlines(column)
    chosen = F.lower(mode)
    result = None
    for name, aliases in MODE_NAMES.items():
        if name == "strip_newlines":
            continue
        test, value = chosen.isin(*aliases), _MODE_FUNCTIONS[name](column)
        result = F.when(test, value) if result is None else result.when(test, value)
    return result.otherwise(strip_newlines(column))


# --- regular expressions ------------------------------------------------------------------

# Java flags for Unicode classes and for "\n is the only line end".
_JAVA_FLAGS = "(?dU)"
_PATTERN_PIECE = re.compile(r"\\.|\[\^?\]?(?:\\.|\[:\^?\w+:\]|[^\]\\])*\]|\$", re.S)
_REPLACEMENT_PIECE = re.compile(r"\$\$|\$\{(\w+)\}|\$(\w+)|[\\$]")
_GROUP_OPEN = re.compile(r"\\.|\[\^?\]?(?:\\.|[^\]\\])*\]|\((?!\?)|\(\?P?<(?![=!])(\w+)>", re.S)


def java_pattern(pattern: str) -> str:
    """Spell a pattern so that Java gives ``$``, ``.`` and the classes their usual Unicode reading.

    A ``$`` outside a class means the very end of the text, unless the pattern turns on
    multi-line mode itself.
    """
    body = pattern.replace("(?P<", "(?<")
    if not re.search(r"\(\?[a-zA-Z]*m", body):
        body = _PATTERN_PIECE.sub(lambda m: r"\z" if m[0] == "$" else m[0], body)
    body = _PATTERN_PIECE.sub(lambda m: _spelled_out(m[0]) if m[0][0] == "[" else m[0], body)
    return _JAVA_FLAGS + body


# The classes that POSIX names, ASCII only.
POSIX_CLASSES = {
    "alnum": "0-9A-Za-z",
    "alpha": "A-Za-z",
    "ascii": r"\x00-\x7F",
    "blank": r"\t ",
    "cntrl": r"\x00-\x1F\x7F",
    "digit": "0-9",
    "graph": "!-~",
    "lower": "a-z",
    "print": " -~",
    "punct": r"!-/:-@\[-`{-~",
    "space": r"\t\n\x0B\f\r ",
    "upper": "A-Z",
    "word": "0-9A-Za-z_",
    "xdigit": "0-9A-Fa-f",
}
_POSIX = re.compile(r"\[:(\^?)(\w+):\]")


def _spelled_out(bracket: str) -> str:
    """A bracket expression with its POSIX classes written as ranges."""

    def ranges(piece: re.Match) -> str:
        if piece[2] not in POSIX_CLASSES:
            raise ValueError(f"unknown class {piece[0]} in a pattern")
        return f"[^{POSIX_CLASSES[piece[2]]}]" if piece[1] else POSIX_CLASSES[piece[2]]

    return _POSIX.sub(ranges, bracket)


def library_pattern(pattern: str):
    """The pattern compiled in Python with the reading that :func:`java_pattern` gives it."""
    import regex

    body = pattern
    if not re.search(r"\(\?[a-zA-Z]*m", body):
        body = _PATTERN_PIECE.sub(lambda m: r"\Z" if m[0] == "$" else m[0], body)
    # the library knows POSIX classes, but as Unicode ones
    body = _PATTERN_PIECE.sub(lambda m: _spelled_out(m[0]) if m[0][0] == "[" else m[0], body)
    return regex.compile(body, regex.VERSION1)


def java_replacement(pattern: str, replacement: str) -> str:
    """Translate ``$1``, ``${1}``, ``$name`` and ``$$``; a group the pattern lacks gives nothing."""
    names, count = set(), 0
    for piece in _GROUP_OPEN.finditer(pattern):
        if piece[0].startswith("("):
            count += 1
            if piece[1]:
                names.add(piece[1])

    def spell(piece: re.Match) -> str:
        if piece[0] == "$$":
            return r"\$"
        name = piece[1] or piece[2]
        if name is None:
            return "\\" + piece[0]
        if name.isdigit():
            # an escaped empty spelling keeps a digit that follows out of the group number
            return f"${int(name)}" if int(name) <= count else ""
        return "${" + name + "}" if name in names else ""

    translated, last = [], 0
    for piece in _REPLACEMENT_PIECE.finditer(replacement):
        translated.append(replacement[last : piece.start()])
        translated.append(spell(piece))
        last = piece.end()
        # "${1}0" must not become group 10: escape the digit
        if piece[1] and piece[1].isdigit() and replacement[last : last + 1].isdigit():
            translated.append("\\")
    translated.append(replacement[last:])
    return "".join(translated)


def regex_replace(text: Column | str, pattern: str, replacement: str) -> Column:
    """Replace every match of ``pattern``."""
    return F.regexp_replace(
        as_column(text), java_pattern(pattern), java_replacement(pattern, replacement)
    )


def regex_match(text: Column | str, pattern: str) -> Column:
    """True where ``pattern`` occurs anywhere."""
    return as_column(text).rlike(java_pattern(pattern))


# --- lines --------------------------------------------------------------------------------


def _joined_lines(text: Column) -> Column:
    """The lines joined by plain line feeds, without the line end that closes the last one."""
    return F.regexp_replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), r"\n\z", "")


def lines(text: Column | str) -> Column:
    """Split at ``\\n`` or ``\\r\\n``; a final line end opens no further line; '' has no lines."""
    column = as_column(text)
    return F.when(column == "", F.array().cast("array<string>")).otherwise(
        F.split(_joined_lines(column), "\n")
    )


def take_lines(text: Column | str, n: Column | int) -> Column:
    """The first ``n`` lines joined by ``\\n`` (none for a negative ``n``)."""
    count = n if isinstance(n, Column) else F.lit(n)
    joined = _joined_lines(as_column(text))
    wanted = F.when(count < 0, 0).otherwise(count).cast("int")
    return F.call_function("substring_index", joined, F.lit("\n"), wanted)


def skip_lines(text: Column | str, n: Column | int) -> Column:
    """All but the first ``n`` lines joined by ``\\n``."""
    count = n if isinstance(n, Column) else F.lit(n)
    joined = _joined_lines(as_column(text))
    head = F.call_function("substring_index", joined, F.lit("\n"), count.cast("int"))
    return F.when(count <= 0, joined).otherwise(
        F.substring(joined, F.length(head) + 2, F.length(joined))
    )


def truncate(text: Column | str, n: Column | int) -> Column:
    """The first ``n`` characters; a negative ``n`` keeps the text."""
    column = as_column(text)
    count = n if isinstance(n, Column) else F.lit(n)
    return F.when(count < 0, column).otherwise(F.left(column, count))


def squeeze_whitespace(text: Column | str) -> Column:
    """Every run of Unicode white space becomes one space; the ends are not trimmed."""
    return F.regexp_replace(as_column(text), r"(?U)\s+", " ")


def word_count(text: Column | str) -> Column:
    """Number of pieces between runs of Unicode white space."""
    pieces = F.split(as_column(text), r"(?U)\s+")
    return F.size(F.filter(pieces, lambda piece: piece != "")).cast("int")


# --- SQL ----------------------------------------------------------------------------------

# A "$" is preceded by whole escapes and classes only; \G walks from one "$" to the next.
_SQL_DOLLAR = r"\G((?:\\.|\[(?:\\.|[^\]\\])*\]|[^$\\\[])*)\$"


def _sql_classes() -> str:
    """``pattern`` with Java's named groups and with POSIX classes written as ranges."""
    spelled = "replace(pattern, '(?P<', '(?<')"
    for name, ranges in POSIX_CLASSES.items():
        spelled = f"replace({spelled}, '[:{name}:]', r'{ranges}')"
        spelled = f"replace({spelled}, '[:^{name}:]', r'[^{ranges}]')"
    return spelled


_SQL_PATTERN = (
    "CASE WHEN pattern RLIKE r'\\[[^\\]]*\\[:\\^?\\w+:\\]' "
    f"AND NOT pattern RLIKE r'\\[:\\^?({'|'.join(POSIX_CLASSES)}):\\]' "
    "THEN raise_error(concat('unknown class in a pattern: ', pattern)) "
    f"ELSE concat('{_JAVA_FLAGS}', CASE WHEN pattern RLIKE r'\\(\\?[a-zA-Z]*m' THEN {_sql_classes()} "
    f"ELSE regexp_replace({_sql_classes()}, r'{_SQL_DOLLAR}', r'$1\\\\z') END) END"
)
# Groups that never take part, so that a group the pattern lacks gives nothing: nine more numbers,
# and the names in the replacement that the pattern does not have.
_SQL_ABSENT = (
    "concat('(?:(?!)()()()()()()()()()', array_join(transform(filter(array_distinct("
    "regexp_extract_all(replacement, r'\\$\\{?([A-Za-z][A-Za-z0-9]*)', 1)), "
    "name -> instr(pattern, concat('<', name, '>')) = 0), "
    "name -> concat('(?<', name, '>)')), ''), ')?')"
)
# "$$" is set aside as a control character while "${1}" and "$name" get Java's spelling; a digit
# after "${1}" is escaped.
_SQL_REPLACEMENT = (
    r"replace(regexp_replace(regexp_replace(regexp_replace(replace(replace(replacement, r'\', r'\\'), "
    r"'$$', '\u0001'), r'\$\{(\d+)\}(\d)', r'\$$1\\$2'), r'\$\{(\d+)\}', r'\$$1'), "
    r"r'\$([A-Za-z_]\w*)', r'\$\{$1\}'), "
    r"'\u0001', r'\$')"
)

_SQL_LINES = r"regexp_replace(replace(text, '\r\n', '\n'), r'\n\z', '')"

_SQL_MODES = " ".join(
    f"WHEN lower(mode) IN ({', '.join(repr(alias) for alias in aliases)}) THEN {body}"
    for (name, aliases), body in zip(
        [item for item in MODE_NAMES.items() if item[0] != "strip_newlines"],
        ["trim_text(text)", "lower(text)", "upper(text)", "text"],
        strict=True,
    )
)

SQL_FUNCTIONS = {
    "strip_newlines": ("text STRING", "STRING", r"translate(text, '\n\r', ' ')"),
    "trim_text": (
        "text STRING",
        "STRING",
        "trim(BOTH '{}' FROM text)".format(
            "".join(f"\\u{ord(c):04x}" for c in WHITE_SPACE)
        ),
    ),
    "text_mode": (
        "text STRING, mode STRING",
        "STRING",
        f"CASE {_SQL_MODES} ELSE strip_newlines(text) END",
    ),
    "regex_replace": (
        "text STRING, pattern STRING, replacement STRING",
        "STRING",
        f"regexp_replace(text, concat({_SQL_PATTERN}, {_SQL_ABSENT}), {_SQL_REPLACEMENT})",
    ),
    "regex_match": (
        "text STRING, pattern STRING",
        "BOOLEAN",
        f"text RLIKE {_SQL_PATTERN}",
    ),
    "lines": (
        "text STRING",
        "ARRAY<STRING>",
        rf"CASE WHEN text = '' THEN cast(array() AS ARRAY<STRING>) "
        rf"ELSE split({_SQL_LINES}, '\n') END",
    ),
    "take_lines": (
        "text STRING, n INT",
        "STRING",
        rf"substring_index({_SQL_LINES}, '\n', CASE WHEN n < 0 THEN 0 ELSE n END)",
    ),
    "skip_lines": (
        "text STRING, n INT",
        "STRING",
        rf"CASE WHEN n <= 0 THEN {_SQL_LINES} ELSE substring({_SQL_LINES}, "
        rf"length(substring_index({_SQL_LINES}, '\n', n)) + 2, length(text)) END",
    ),
    "truncate": (
        "text STRING, n INT",
        "STRING",
        "CASE WHEN n < 0 THEN text ELSE left(text, n) END",
    ),
    "squeeze_whitespace": (
        "text STRING",
        "STRING",
        r"regexp_replace(text, r'(?U)\s+', ' ')",
    ),
    "word_count": (
        "text STRING",
        "INT",
        r"size(filter(split(text, r'(?U)\s+'), piece -> piece <> ''))",
    ),
}


_registered: weakref.WeakSet[SparkSession] = weakref.WeakSet()


def register_sql(spark: SparkSession) -> None:
    """Make the text functions callable from SQL text; Catalyst inlines their bodies."""
    if spark in _registered:
        return
    for name, (parameters, result, body) in SQL_FUNCTIONS.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) "
            f"RETURNS {result} RETURN {body}"
        )
    _registered.add(spark)
