"""String cleaning and scalar predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's ``str.strip()`` removes (its
# whitespace set), as code points: 0x09-0x0D, 0x1C-0x1F, 0x20, 0x85, 0xA0,
# 0x1680, 0x2000-0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000.
PY_WHITESPACE_CODEPOINTS = (
    *range(0x09, 0x0E),
    *range(0x1C, 0x21),
    0x85,
    0xA0,
    0x1680,
    *range(0x2000, 0x200B),
    0x2028,
    0x2029,
    0x202F,
    0x205F,
    0x3000,
)
PY_WHITESPACE = "".join(chr(c) for c in PY_WHITESPACE_CODEPOINTS)

# The e-mail pattern of both contracts, and the UUID shape
# checked on the lower-cased id.  Python's ``$`` also matches before one
# final newline, so the end anchor is written ``\n?\z`` for Java and RE2.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}\n?\z"
UUID_PATTERN = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\n?\z"
# Allowed genders.
GENDERS = ("male", "female", "other")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: Column | str) -> Column:
    """Python ``str.strip()``: removes exactly Python's whitespace set."""
    return F.trim(_col(c), F.lit(PY_WHITESPACE))


def clean_string(c: Column | str, default: str | None = "", max_length: int | None = None, strip: bool = True) -> Column:
    """Null -> default; strip; then cut to ``max_length`` (0/None = no cut).

    The input must already be text (use ``variant.py_text`` for JSON values).
    """
    out = _col(c)
    if strip:
        out = py_strip(out)
    if max_length:
        out = F.substring(out, 1, int(max_length))
    return F.coalesce(out, F.lit(default)) if default is not None else out


def clean_email(c: Column | str) -> Column:
    """Null -> "", strip, lower."""
    return F.coalesce(F.lower(py_strip(_col(c))), F.lit(""))


def normalize_gender(c: Column | str) -> Column:
    """Lower-cased if allowed, otherwise ``other`` (null stays null)."""
    low = F.lower(_col(c))
    return F.when(low.isin(*GENDERS), low).when(low.isNotNull(), F.lit("other"))


def is_email(c: Column | str) -> Column:
    """The contracts' e-mail pattern, Python ``re.match`` semantics."""
    return _col(c).rlike(EMAIL_PATTERN)


def is_uuid(c: Column | str) -> Column:
    """36 characters and the hex-group shape, case-blind."""
    c = _col(c)
    return (F.length(c) == 36) & F.lower(c).rlike(UUID_PATTERN)


def error_text(message: Column | str, status: Column | str | None = None,
               field: Column | str | None = None, value: Column | str | None = None,
               value_chars: int | None = None) -> Column:
    """C11: ``message [HTTP n]`` or ``message [field=f] [value=v]``, v cut to ``value_chars`` if given.

    Parts are appended only when set (status non-zero, field non-empty,
    value non-null), as the error classes format themselves.
    """
    parts = [_col(message)]
    if status is not None:
        s = _col(status)
        parts.append(F.when(s.isNotNull() & (s != 0), F.concat(F.lit("[HTTP "), s.cast("string"), F.lit("]"))))
    if field is not None:
        f = _col(field)
        parts.append(F.when(f.isNotNull() & (f != ""), F.concat(F.lit("[field="), f, F.lit("]"))))
    if value is not None:
        v = _col(value)
        shown = F.substring(v.cast("string"), 1, value_chars) if value_chars else v.cast("string")
        parts.append(F.when(v.isNotNull(), F.concat(F.lit("[value="), shown, F.lit("]"))))
    return F.concat_ws(" ", *parts)


def py_str_repr(s: Column) -> Column:
    """Python ``repr()`` of a str for the common cases.

    Single quotes unless the text holds a single quote and no double quote;
    backslash, the active quote, tab, newline and carriage return escaped.
    Other non-printable characters are kept as they are (documented gap).
    """
    base = F.replace(s, F.lit("\\"), F.lit("\\\\"))
    base = F.replace(F.replace(F.replace(base, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r")), F.lit("\t"), F.lit("\\t"))
    use_double = F.contains(s, F.lit("'")) & ~F.contains(s, F.lit('"'))
    return F.when(use_double, F.concat(F.lit('"'), base, F.lit('"'))).otherwise(
        F.concat(F.lit("'"), F.replace(base, F.lit("'"), F.lit("\\'")), F.lit("'"))
    )


def py_list_repr(arr: Column) -> Column:
    """Python ``repr()`` of a list of str, e.g. ``['a', "it's"]``."""
    return F.concat(F.lit("["), F.array_join(F.transform(arr, py_str_repr), ", "), F.lit("]"))
