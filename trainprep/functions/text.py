"""Shared column expressions (all built-in, JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's ``str.strip()`` removes (``str.isspace``),
# written as one regex character class that Java regex and RE2 read alike.
PY_WHITESPACE_CLASS = (
    r"[\t\n\x0b\x0c\r\x1c-\x1f \x85\xa0\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def char_length(c: str | Column) -> Column:
    """Length in Unicode code points, as ``long`` (Python ``len``)."""
    return F.length(_col(c)).cast("long")


def py_strip(c: str | Column) -> Column:
    """Python ``str.strip()``: removes Unicode whitespace at both ends."""
    ws = PY_WHITESPACE_CLASS
    return F.regexp_replace(_col(c), f"^{ws}+|{ws}+$", "")


def is_blank(c: str | Column) -> Column:
    """True when the value is null or only Python whitespace."""
    return _col(c).isNull() | (F.length(py_strip(c)) == 0)


def normalize_newlines(c: str | Column) -> Column:
    """Universal-newline read: ``\\r\\n`` and lone ``\\r`` become ``\\n``."""
    return F.regexp_replace(_col(c), "\r\n?", "\n")


def json_string(c: str | Column) -> Column:
    """A string encoded as a JSON string literal (quotes included); null is
    ``null``.  Cut by length, as a pattern would stop at line separators."""
    whole = F.to_json(F.struct(_col(c).alias("v")), {"ignoreNullFields": "false"})
    return F.substr(whole, F.lit(6), F.length(whole) - 6)


def json_query(c: str | Column) -> Column:
    """``{"query": <text>}`` with a space after the colon, non-ASCII kept."""
    return F.concat(F.lit('{"query": '), json_string(c), F.lit("}"))


def json_reply(reasoning: str | Column, responding: str | Column) -> Column:
    """Compact reply object ``{"reasoning":…,"responding":…}``, non-ASCII kept."""
    return F.to_json(F.struct(_col(reasoning).alias("reasoning"), _col(responding).alias("responding")))


def zero_pad(c: str | Column, width: int) -> Column:
    """``f"{n:0{width}d}"`` for non-negative integers."""
    n = _col(c).cast("long")
    return F.when(n.isNotNull(), F.format_string(f"%0{width}d", n))


# Python ``float()`` string syntax (digit groups may use single
# underscores), and its special words, case-insensitive.
PY_FLOAT_PATTERN = r"^[+-]?(?:(?:\d(?:_?\d)*)?\.\d(?:_?\d)*|\d(?:_?\d)*\.?)(?:[eE][+-]?\d(?:_?\d)*)?$"
PY_FLOAT_SPECIAL = r"(?i)^[+-]?(?:inf|infinity|nan)$"


def py_float(c: str | Column) -> Column:
    """Python ``float(str)``: null where Python would raise.

    ``try_cast`` alone differs both ways (it takes ``1d``, rejects ``1_0``),
    so the text is checked against Python's syntax before the cast.
    """
    raw = _col(c)
    stripped = py_strip(raw)

    def number(s: Column) -> Column:
        return F.translate(s, "_", "").cast("double")

    # common case first: no surrounding whitespace, so no strip is evaluated
    return (
        F.when(raw.rlike(PY_FLOAT_PATTERN), number(raw))
        .when(raw.rlike(PY_FLOAT_SPECIAL), number(raw))
        .when(stripped.rlike(PY_FLOAT_PATTERN) | stripped.rlike(PY_FLOAT_SPECIAL), number(stripped))
    )


def lossy_utf8(c: str | Column) -> Column:
    """Invalid UTF-8 byte sequences replaced by U+FFFD."""
    return F.call_function("make_valid_utf8", _col(c))
